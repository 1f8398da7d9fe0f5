"""Training set, model fitting and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Imputer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.constants import (
    CATEGORICAL_FEATURES,
    LABEL,
    LABEL_HORIZON,
    LABEL_SOURCE,
    MODEL_PARAMS,
    NON_MODEL_FEATURES,
    NON_NUMERIC_FEATURES,
    PREDICTION,
    RAW_SCALE_MARKERS,
    RESCALED_MARKERS,
    TAIL_MARKERS,
    TRAINING_DAYS,
)
from tickloom.functions.scalar import clean_floats
from tickloom.functions.sqltext import q
from tickloom.session import ensure_checkpoint_dir

_NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)


def forward_label(df: DataFrame, col: str = LABEL_SOURCE, n: int = LABEL_HORIZON, name: str = LABEL) -> DataFrame:
    """The value ``n`` rows later, per symbol."""
    return df.selectExpr("*", f"lead({q(col)}, {n}) OVER (PARTITION BY symbol_id ORDER BY date) AS {name}")


def left_out(name: str) -> bool:
    """Whether a feature column is kept from the model, by its name."""
    if name in NON_NUMERIC_FEATURES or name in NON_MODEL_FEATURES:
        return True
    if any(marker in name for marker in TAIL_MARKERS):
        return True
    raw_scale = any(marker in name for marker in RAW_SCALE_MARKERS)
    return raw_scale and not any(marker in name for marker in RESCALED_MARKERS)


def with_futures(features: DataFrame) -> DataFrame:
    """Rows with a futures close, NaN and infinities turned into nulls."""
    return clean_floats(features).where(F.col("close_futures").isNotNull())


def training_set(features: DataFrame, run_date: str, days: int = TRAINING_DAYS) -> DataFrame:
    """Model inputs and label for the ``days`` before ``run_date``.

    The label looks ahead within the window only, so nothing after it leaks in.  The date
    filter reaches the scan as a partition filter.
    """
    window = training_window(features, run_date, days)
    labelled = forward_label(with_futures(window)).where(F.col(LABEL).isNotNull())
    return labelled.select(*[q(c) for c in labelled.columns if c == LABEL or not left_out(c)])


def training_window(features: DataFrame, run_date: str, days: int = TRAINING_DAYS) -> DataFrame:
    """Rows of the ``days`` before ``run_date``; a partition filter where ``date`` is a folder."""
    run = F.lit(run_date).cast("date")
    return features.where((F.col("date") >= F.date_sub(run, days)) & (F.col("date") < run))


def train(
    features: DataFrame,
    run_date: str,
    force: bool = False,
    trees: int | None = None,
    steps: Sequence[Estimator | Transformer] = (),
) -> PipelineModel | None:
    """Boosted trees on the training set; only on the first of a month unless forced.

    ``steps`` are fitted on the rows of the training window, in order, before the inputs are
    chosen; they open the pipeline that is returned, so scoring applies them as fitted.

    Boosting reads its input once per tree level, so the assembled set is checkpointed
    once and every pass starts from there, also after losing executors.
    """
    if not force and not run_date.endswith("-01"):
        return None
    spark = features.sparkSession
    ensure_checkpoint_dir(spark)
    fitted = Pipeline(stages=list(steps)).fit(with_futures(training_window(features, run_date)))
    data = training_set(fitted.transform(with_futures(features)), run_date).checkpoint()

    categorical = [c for c in CATEGORICAL_FEATURES if c in data.columns]
    numeric = [
        f.name
        for f in data.schema.fields
        if isinstance(f.dataType, _NUMERIC) and f.name not in (*categorical, LABEL)
    ]
    # One row of counts: an input without any value cannot be imputed, and the widest
    # category decides the number of bins.
    seen = data.agg(
        *[F.count(q(c)).alias(c) for c in numeric],
        *[F.count_distinct(c).alias(c) for c in categorical],
    ).first()
    numeric = [c for c in numeric if seen[c]]
    indexed, filled = [f"{c}_index" for c in categorical], [f"{c}_filled" for c in numeric]
    stages = [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        Imputer(inputCols=numeric, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=[*indexed, *filled], outputCol="inputs"),
        GBTRegressor(
            featuresCol="inputs",
            labelCol=LABEL,
            predictionCol=PREDICTION,
            maxIter=trees or MODEL_PARAMS["trees"],
            maxDepth=MODEL_PARAMS["depth"],
            stepSize=MODEL_PARAMS["learning_rate"],
            subsamplingRate=MODEL_PARAMS["bagging_fraction"],
            featureSubsetStrategy=str(MODEL_PARAMS["feature_fraction"]),
            seed=MODEL_PARAMS["seed"],
            maxBins=max(32, *[seen[c] + 1 for c in categorical]),
        ),
    ]
    inner = Pipeline(stages=stages).fit(data.select(*categorical, *[F.col(q(c)).cast("double").alias(c) for c in numeric], LABEL))
    return PipelineModel([*fitted.stages, *inner.stages])


def split_stages(model: PipelineModel) -> tuple[PipelineModel, PipelineModel]:
    """The user's fitted steps and the model proper, which begins with its indexer."""
    first = next(i for i, s in enumerate(model.stages) if isinstance(s, StringIndexerModel))
    return PipelineModel(model.stages[:first]), PipelineModel(model.stages[first:])


def model_inputs(model: PipelineModel) -> list[str]:
    """Columns the model reads, in order; kept with the pipeline itself."""
    indexer, imputer = split_stages(model)[1].stages[:2]
    return [*indexer.getInputCols(), *imputer.getInputCols()]


def predict(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Forecast per symbol and date, for rows with a futures close."""
    steps, inner = split_stages(model)
    rows = steps.transform(with_futures(features))
    inputs = model_inputs(model)
    categorical = set(inner.stages[0].getInputCols())
    chosen = [F.col(q(c)) if c in categorical else F.col(q(c)).cast("double").alias(c) for c in inputs]
    scored = inner.transform(rows.select("date", *chosen))
    return scored.select("symbol_id", "date", PREDICTION)
