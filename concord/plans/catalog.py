"""All registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from concord.plans import averaging_job, corpus_job, live_job, round_job, rounds_job

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for module in (corpus_job, averaging_job, rounds_job, live_job, round_job):
        out.update(module.QUERIES)
    return out
