"""Ingest of client uploads: decode, hash, name, admit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions import names


def ingest(records: DataFrame, body: str = "body") -> DataFrame:
    """Parse upload bodies into ``(..., content_hash, object_name, sample_size, size, status)``.

    The model bytes are base64-decoded and content-addressed by SHA-256. A body
    without a decodable model, or with a sample size that is not an integer of at
    least 1, is kept as a row with ``status = 'rejected'``; no body fails the job.
    """
    parsed = records.withColumn("_u", F.from_json(F.col(body), names.UPLOAD_SCHEMA))
    out = (parsed
           .withColumn("_m", F.try_to_binary("_u.model", F.lit("base64")))
           .withColumn("content_hash", names.content_hash(F.col("_m")))
           .withColumn("size", F.octet_length("_m").cast("bigint"))
           .withColumn("sample_size", names.parse_sample_size(F.col("_u.sample_size")))
           .withColumn("object_name", names.local_object_name(F.col("version"),
                                                              F.col("content_hash"))))
    fine = F.col("content_hash").isNotNull() & F.coalesce(F.col("sample_size") >= 1, F.lit(False))
    return (out.withColumn("status", F.when(fine, F.lit("accepted")).otherwise(F.lit("rejected")))
            .drop("_u", "_m", body))


def accepted(records: DataFrame, body: str = "body") -> DataFrame:
    """The accepted uploads of ``ingest``.

    A filter on the status would be pushed below the projection and decode every body once
    more; generating no row for a rejected body keeps it to one decode.
    """
    rows = ingest(records, body)
    return rows.select(F.inline(F.when(F.col("status") == "accepted",
                                       F.array(F.struct(*rows.columns)))))
