"""Market-data feature engine on Spark DataFrames.

Raw exchange archives -> typed bars and trades -> daily aggregates -> rolling
features -> model features -> training and scoring.  Every step is a function from
DataFrame to DataFrame; Catalyst and AQE choose the physical plan.
"""
