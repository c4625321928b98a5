"""Cross-entropy difference of two matched n-gram models (operator 6).

The target model is trained on the trusted documents, the background model on
all documents; both have the same order and smoothing and share one vocabulary:
the words that all documents hold at least ``words`` times (0: the byte symbols
they hold at least ``LEAST`` times), every other one being one unknown symbol. A document's score is the mean over its tokens of
target loss minus background loss; lower is closer to the target.

Edge cases: null and empty texts have no tokens and null losses; without any
trusted document the target model is uniform; repeated documents are separate
rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm import ngram_lm as L
from concord.llm import word_losses as W
from concord.llm.common import table, written
from concord.llm.quality_classifier import marked

ORDER = 4
LEAST = 50
#: Parts of the grams that go through the disk one after the other.
PARTS = 3
#: The symbol of all bytes outside the vocabulary (a control character otherwise).
UNKNOWN = 1


def vocabulary(texts: DataFrame, least: int = LEAST) -> np.ndarray:
    """Symbol of each byte value; at most 256 counts reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            data, off = K.byte_column(batch.column(0))
            for i, j in K.pieces(off):
                total += np.bincount(data[off[i]:off[j]], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)],
                                         names=["byte", "n"])

    counts = texts.select("text").mapInArrow(run, "byte long, n long").groupBy("byte").agg(
        F.sum("n").alias("n")).collect()
    symbols = L.identity()
    for r in counts:
        if r.n < least:
            symbols[r.byte] = UNKNOWN
    return symbols


def differences(docs: DataFrame, labels: DataFrame, order: int = ORDER,
                least: int = LEAST, words: int = 0) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, difference of each document."""
    rows = marked(docs, labels, F.lit(""))
    if words:
        scored = W.text_losses(rows, order, L.Words(rows, words), ("chosen", "every"), PARTS)
    else:
        scored = _over_bytes(rows, order, least)
    n = F.when(F.col("n_tokens") > 0, F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", (F.col("sums")[0] / n).alias("target_loss"),
                         (F.col("sums")[1] / n).alias("background_loss"),
                         ((F.col("sums")[0] - F.col("sums")[1]) / n).alias("difference"))


def _over_bytes(rows: DataFrame, order: int, least: int) -> DataFrame:
    unit = L.Bytes(vocabulary(rows, least))
    counts = written(L.gram_counts(rows, order, unit), "grams")
    both = F.explode(F.array(F.struct(F.lit("target").alias("model"), F.col("chosen").alias("n")),
                             F.struct(F.lit("background").alias("model"),
                                      F.col("every").alias("n")))).alias("x")
    train = counts.select("hi", "gram", both).select("x.model", "hi", "gram", "x.n")
    loss = L.losses(train, order, unit)
    of = {m: F.max(F.when(F.col("model") == m, F.col("loss"))) for m in ("target", "background")}
    pair = written(loss.groupBy("hi", "gram").agg(F.array(of["target"], of["background"])
                                                  .alias("values")), "losses")
    return L.score(rows, pair.withColumn("model", F.lit("")), 2, order, unit)


def op6_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses and score of every row of ``documents``."""
    return differences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                       words=L.LEAST_WORDS)
