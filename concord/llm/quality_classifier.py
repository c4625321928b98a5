"""Quality by perplexity under a Kneser-Ney model of trusted text (operator 1).

Per language, the trusted documents (labelled good and not toxic) train an
interpolated modified Kneser-Ney model, except one in ``HELD_OUT`` of them (by a
hash of the id); every document of the language gets its perplexity over its words
(``words``: least count of a word of the vocabulary; 0: over its bytes), and is kept
when that is at most the ``QUANTILE`` of the held-out trusted documents of its
language (of all its documents where none is held out).

Edge cases: a null language is the language ""; null and empty texts have no
tokens, a null perplexity and are not kept; a language without trusted text is
scored uniformly; labels without a document and repeated labels do not matter;
repeated documents are separate rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import ngram_lm as L
from concord.llm import word_losses as W
from concord.llm.common import broadcast_if_small, table, written

QUANTILE = 0.99
HELD_OUT = 5
#: Accuracy of the quantile sketch (relative rank error 1 / ACCURACY).
ACCURACY = 10_000


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return good.filter("q = 1 AND coalesce(t, 0) = 0").select("doc_id")


def marked(docs: DataFrame, labels: DataFrame, model) -> DataFrame:
    """(doc_id, model, chosen, text) of all documents."""
    ids = broadcast_if_small(trusted_ids(labels).withColumn("chosen", F.lit(True)))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), model.alias("model"),
                        F.col("text").cast("string").alias("text"))
            .join(ids, "doc_id", "left")
            .withColumn("chosen", F.coalesce("chosen", F.lit(False))))


def classify(docs: DataFrame, labels: DataFrame, order: int = L.ORDER,
             quantile: float = QUANTILE, words: int = 0) -> DataFrame:
    """doc_id, lang, n_tokens, perplexity, threshold, kept of each document."""
    rows = marked(docs, labels, F.coalesce(F.col("lang").cast("string"), F.lit("")))
    held = F.col("chosen") & (F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    rows = rows.withColumns({"held": held, "chosen": F.col("chosen") & ~held})
    if words:
        scored = W.text_losses(rows, order, L.Words(rows, words), ("chosen",))
    else:
        unit = L.Bytes()
        counts = written(L.gram_counts(rows, order, unit), "grams")
        loss = L.losses(counts.select(*L.KEY, F.col("chosen").alias("n")), order, unit)
        loss = written(loss.select(*L.KEY, F.array("loss").alias("values")), "losses")
        scored = L.score(rows, loss, 1, order, unit)
    scored = written(scored.withColumn(
        "perplexity", F.when(F.col("n_tokens") > 0,
                             F.exp(F.col("sums")[0] / F.col("n_tokens")))), "scored")
    at = F.percentile_approx
    limits = scored.groupBy("model").agg(
        at(F.when(F.col("held"), F.col("perplexity")), quantile, ACCURACY).alias("good"),
        at("perplexity", quantile, ACCURACY).alias("any"))
    limits = limits.select("model", F.coalesce("good", "any").alias("threshold"))
    return (scored.join(broadcast_if_small(limits, 100_000), "model", "left")
            .select("doc_id", F.col("model").alias("lang"), "n_tokens", "perplexity", "threshold",
                    F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
                    .alias("kept")))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every row of ``documents``, trained on its labelled rows."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                    words=L.LEAST_WORDS)
