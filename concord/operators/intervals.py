"""Interval join by time buckets: which points lie in which kinds of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sorts before every event of its time.
BEFORE_ALL = -(1 << 62)


def bucket_of(at, bucket_seconds: int):
    """Number of the time bucket of a time in microseconds."""
    return F.floor(at / (bucket_seconds * 1_000_000))


def in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], kinds: list[str],
                 bucket_seconds: int = 3600) -> DataFrame:
    """The points with a boolean column for each kind: whether an interval of it holds them.

    ``points``: keys, ``at`` (microseconds) and ``seq``, which together tell them apart and
    order them. ``intervals``: keys, ``kind``, ``lo_at``, ``lo_seq``, ``hi_at``: they hold what
    comes after (lo_at, lo_seq) and before hi_at. Both sides meet by an equi-join on the keys
    and the time bucket, so a key with a third of all points is spread over its buckets; an
    interval is repeated once for each bucket it touches. Intervals may overlap; empty ones
    (hi_at <= lo_at) hold nothing.
    """
    spans = intervals.filter("hi_at > lo_at").withColumn("_b", F.explode(F.sequence(
        bucket_of(F.col("lo_at"), bucket_seconds),
        bucket_of(F.col("hi_at") - 1, bucket_seconds))))
    after = (F.col("at") > F.col("lo_at")) | (
        (F.col("at") == F.col("lo_at")) & (F.col("seq") > F.col("lo_seq")))
    hits = (points.select(*keys, "at", "seq", bucket_of(F.col("at"), bucket_seconds).alias("_b"))
            .join(spans, [*keys, "_b"]).filter(after & (F.col("at") < F.col("hi_at"))))
    flags = hits.groupBy(*keys, "seq").agg(
        *(F.max(F.col("kind") == k).alias(k) for k in kinds))
    return points.join(flags, [*keys, "seq"], "left").withColumns(
        {k: F.coalesce(k, F.lit(False)) for k in kinds})
