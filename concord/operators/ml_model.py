"""The classifier as an ML pipeline (S09, M01, M02): tokens, hashed features, logistic
regression, saved and loaded as a whole with its settings.

Warm start: ``LogisticRegression`` cannot begin from given weights. The stated substitute
keeps the base pipeline's stages, frozen, and gives the new regression one feature more, the
base's margin: training starts from what the base knows and learns what to add to it. The
result is again one pipeline that scores raw text.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators.model import N_BUCKETS, TOKEN_SPLIT

SETTINGS = "settings"
DEFAULTS = {"n_buckets": N_BUCKETS, "max_iter": 20, "reg": 0.01, "generation": 0}
LABEL, WEIGHT = "objectionable", "weight"


def balanced(rows: DataFrame) -> DataFrame:
    """The rows with ``weight``: both classes weigh the same.

    The counts, one row a class, are broadcast: a shuffle by class would leave all rows to as
    many tasks as there are classes.
    """
    n = rows.groupBy(LABEL).agg(F.count("*").alias("_n"))
    return rows.join(F.broadcast(n), LABEL).withColumn(WEIGHT, 1.0 / F.col("_n")).drop("_n")


def _regression(name: str, features: str, settings: dict) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=LABEL, weightCol=WEIGHT, maxIter=settings["max_iter"],
        regParam=settings["reg"], rawPredictionCol=f"{name}_raw",
        probabilityCol=f"{name}_probability", predictionCol=f"{name}_prediction")


def _texts(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"text": F.coalesce("text", F.lit("")),
                             LABEL: F.col(LABEL).cast("double")})


def train(rows: DataFrame, **settings) -> tuple[PipelineModel, dict]:
    """(fitted pipeline, its settings) of rows (text, objectionable); M01 + M02."""
    settings = {**DEFAULTS, **settings}
    tokens = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=TOKEN_SPLIT,
                            toLowercase=True)
    counts = HashingTF(inputCol="tokens", outputCol="counts", numFeatures=settings["n_buckets"])
    stages = [tokens, counts, _regression("m0", "counts", settings)]
    return Pipeline(stages=stages).fit(balanced(_texts(rows))), settings


def train_further(base: PipelineModel, base_settings: dict, rows: DataFrame, **settings
                  ) -> tuple[PipelineModel, dict]:
    """A pipeline that starts from a base: the base's margin is a feature of the new one."""
    old = f"m{base_settings['generation']}"
    settings = {**base_settings, **settings, "generation": base_settings["generation"] + 1}
    new = f"m{settings['generation']}"
    margin = VectorSlicer(inputCol=f"{old}_raw", outputCol=f"{new}_margin", indices=[1])
    joined = VectorAssembler(inputCols=["counts", f"{new}_margin"], outputCol=f"{new}_features")
    later = Pipeline(stages=[margin, joined, _regression(new, f"{new}_features", settings)])
    fitted = later.fit(base.transform(balanced(_texts(rows))))
    return PipelineModel(stages=[*base.stages, *fitted.stages]), settings


def score(rows: DataFrame, model: PipelineModel, settings: dict) -> DataFrame:
    """M04 + O02: the rows with ``logits`` (array of two) and ``prediction``."""
    name, keep = f"m{settings['generation']}", rows.columns
    out = model.transform(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    return out.select(*(rows_col for rows_col in keep),
                      vector_to_array(f"{name}_raw").alias("logits"),
                      F.col(f"{name}_prediction").cast("int").alias("prediction"))


def save(model: PipelineModel, settings: dict, folder: str, spark: SparkSession) -> None:
    """The pipeline, its weights and its settings below one folder; saved again, it
    replaces what was there."""
    model.write().overwrite().save(f"{folder}/pipeline")
    rows = [(k, float(v)) for k, v in sorted(settings.items())]
    spark.createDataFrame(rows, "name string, value double").coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/{SETTINGS}")


def load(spark: SparkSession, folder: str) -> tuple[PipelineModel, dict]:
    """The pipeline and its settings (a handful of rows)."""
    kept = {r.name: r.value for r in spark.read.parquet(f"{folder}/{SETTINGS}").collect()}
    settings = {k: type(DEFAULTS[k])(v) for k, v in kept.items()}
    return PipelineModel.load(f"{folder}/pipeline"), settings
