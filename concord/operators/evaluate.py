"""Evaluation report: confusion counts, per-class and average metrics.

Everything is computed from the confusion table, whose size is
groups x classes^2; the per-row data is read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R = 6


def confusion(scored: DataFrame, label: str, group: list[str]) -> DataFrame:
    """``(group..., label, prediction, n)``."""
    return (scored.groupBy(*group, F.col(label).alias("label"), "prediction")
            .agg(F.count("*").alias("n")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(conf: DataFrame, group: list[str]) -> DataFrame:
    """Per class precision, recall, f1 and support; zero denominators give 0.

    Each confusion cell feeds its true class (support, true positives) and its
    predicted class (predicted count) through one generate; no cross join.
    """
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n"))
                 .otherwise(F.lit(0)).alias("tp"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("predicted")))
    per = (conf.select(*group, F.inline(sides))
           .groupBy(*group, "class")
           .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                F.sum("predicted").alias("predicted")))
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    per = per.withColumn("precision", p).withColumn("recall", r)
    f1 = _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return per.withColumn("f1", f1).select(*group, "class", "tp", "support", "precision",
                                           "recall", "f1")


def summary_rows(per_class: DataFrame, group: list[str]) -> DataFrame:
    """Accuracy, macro average and weighted average rows."""
    s = per_class.groupBy(*group).agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("total"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    tot = F.col("total")
    def line(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"))
    rows = F.array(
        line("accuracy", F.lit(None), F.lit(None), _safe_div(F.col("tp"), tot)),
        line("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        line("weighted avg", _safe_div(F.col("wp"), tot), _safe_div(F.col("wr"), tot),
             _safe_div(F.col("wf"), tot)))
    return s.select(*group, F.inline(rows), tot.alias("support"))


def report(scored: DataFrame, label: str, group: list[str]) -> DataFrame:
    """Full report, one row per class and per summary line:
    ``(group..., class string, precision, recall, f1, support)``, rounded."""
    per = class_report(confusion(scored, label, group), group)
    per_rows = per.select(*group, F.col("class").cast("string").alias("class"),
                          "precision", "recall", "f1", "support")
    out = per_rows.unionByName(summary_rows(per, group))
    for c in ("precision", "recall", "f1"):
        out = out.withColumn(c, F.round(c, R))
    return out


def wrong_predictions(scored: DataFrame, label: str) -> DataFrame:
    """Rows where the prediction differs from the label."""
    return scored.filter(F.col("prediction") != F.col(label))


def compare(rep: DataFrame, model_col: str, pairs: list[tuple[str, str]],
            on: list[str]) -> DataFrame:
    """Metric differences ``b - a`` for pairs (a, b) of models.

    The report is aggregated once, with a column per model and metric; NULL
    metrics (averages without them) stay NULL.
    """
    cols = ["precision", "recall", "f1"]
    models = sorted({m for p in pairs for m in p})
    wide = rep.groupBy(*on).agg(*(
        F.max(F.when(F.col(model_col) == m, F.col(c))).alias(f"{m}_{c}")
        for m in models for c in cols))
    lines = F.array(*(F.struct(
        F.lit(f"{b}-{a}").alias("pair"),
        *(F.round(F.col(f"{b}_{c}") - F.col(f"{a}_{c}"), R).alias(f"d_{c}") for c in cols))
        for a, b in pairs))
    return wide.select(*on, F.inline(lines))
