"""DataFrame operators: aggregation, windows, joins, features, load planning."""
