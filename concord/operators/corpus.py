"""Corpus preparation: unify labelled sources, count, deduplicate, split.

Every function maps DataFrame -> DataFrame. The class of a row comes from
its source's label encoding; one row may land in both classes (as it does
when its votes disagree), so tagging is a generate, not a CASE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.sources.fixtures import SOURCE_TEXT_COLUMNS

LABEL = "objectionable"
SPLIT_SEED = 42


def split_key(text: Column, seed: int = SPLIT_SEED) -> Column:
    """Pseudo-random order key of a text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


@dataclass(frozen=True)
class SourceSpec:
    """How one source encodes the two classes (SQL boolean expressions)."""
    name: str
    seq: int
    offensive: str
    inoffensive: str


# Class rules of each source encoding.
SOURCE_SPECS = (
    SourceSpec("onehot", 1, "m1 + m2 + m3 = 1", "p1 = 1"),
    SourceSpec("multifile", 2, "oh_label = 1", "oh_label = 0"),
    SourceSpec("binary", 3, "hateful = 1", "hateful = 0"),
    SourceSpec("ordinal", 4, "`class` < 2", "`class` = 2"),
)


def _by_source(attr: str) -> Column:
    expr = None
    for spec in SOURCE_SPECS:
        cond = F.col("source") == spec.name
        rule = F.expr(getattr(spec, attr))
        expr = F.when(cond, rule) if expr is None else expr.when(cond, rule)
    return expr


def normalise_raw(frames: dict[str, DataFrame]) -> DataFrame:
    """Raw per-source frames (original text column names) -> one wide frame.

    ``frames`` maps a source name to its frame; label columns a source does
    not have become NULL (``unionByName(allowMissingColumns=True)``).
    """
    out = None
    for name, df in frames.items():
        spec = next(s for s in SOURCE_SPECS if s.name == name)
        df = (df.withColumnRenamed(SOURCE_TEXT_COLUMNS[name], "text")
              .withColumn("source", F.lit(name)).withColumn("seq", F.lit(spec.seq)))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def tag_classes(wide: DataFrame, keep: list[str] | None = None,
                drop_blank: bool = True) -> DataFrame:
    """``(source, seq, [keep...], text, objectionable)``, 0-2 rows per input row.

    A NULL label compares false and the row falls in neither class.
    ``drop_blank`` drops NULL / blank text (the reference keeps it).
    """
    keep = keep or []
    classes = F.array_compact(F.array(
        F.when(_by_source("offensive"), F.lit(1)),
        F.when(_by_source("inoffensive"), F.lit(0))))
    df = wide
    if drop_blank:
        df = df.filter(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0))
    return df.select("source", "seq", *keep, "text", F.explode(classes).alias(LABEL))


#: A source part: files of a multi-file source are read one by one (file is NULL elsewhere).
PART = ["source", "seq", "file"]


def source_distinct(tagged: DataFrame) -> DataFrame:
    """Distinct text within source, file and class: ``(source, seq, file, objectionable, text)``."""
    return tagged.select(*PART, LABEL, "text").distinct()


def source_counts(tagged: DataFrame) -> DataFrame:
    """Rows and distinct texts per source, file and class.

    One shuffle on (source, file, class, text) with map-side partial counts; the
    second aggregation reads only the small per-text counts.
    """
    per_text = tagged.groupBy(*PART, LABEL, "text").agg(F.count("*").alias("n"))
    return (per_text.groupBy(*PART, LABEL)
            .agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct")))


def running_totals(counts: DataFrame) -> DataFrame:
    """Totals of distinct texts per class after each source part is added.

    The window runs over the per-part result, whose size is bounded by the
    number of source files.
    """
    per_part = counts.groupBy(*PART).agg(
        F.sum(F.when(F.col(LABEL) == 1, F.col("n_distinct")).otherwise(0)).alias("n_offensive"),
        F.sum(F.when(F.col(LABEL) == 0, F.col("n_distinct")).otherwise(0)).alias("n_inoffensive"))
    upto = Window.orderBy("seq", "file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_part.select(
        *PART, "n_offensive", "n_inoffensive",
        F.sum("n_offensive").over(upto).alias("cum_offensive"),
        F.sum("n_inoffensive").over(upto).alias("cum_inoffensive"))


def bag_union(distinct_rows: DataFrame) -> DataFrame:
    """UNION ALL of every source part's distinct texts: ``(text, objectionable)``."""
    return distinct_rows.select("text", LABEL)


def dedupe_corpus(tagged: DataFrame) -> DataFrame:
    """Distinct ``(text, objectionable)`` across sources: the unified corpus.

    Equivalent to per-source distinct then union then distinct; a single
    aggregation with map-side partial dedup does it in one shuffle.
    """
    return tagged.select("text", LABEL).distinct()


def vote_totals(wide: DataFrame) -> DataFrame:
    """Votes summed per text over offensive one-hot rows."""
    rows = wide.filter((F.col("source") == "onehot") & F.expr(SOURCE_SPECS[0].offensive))
    return rows.groupBy("text").agg(
        F.sum(F.col("m1").cast("int")).alias("votes_1"),
        F.sum(F.col("m2").cast("int")).alias("votes_2"),
        F.sum(F.col("m3").cast("int")).alias("votes_3"))


def label_conflicts(rows: DataFrame) -> DataFrame:
    """Texts carrying both classes: ``(text_hash, n_labels, n_rows)``.

    Keyed by the SHA-256 of the text so the shuffle key is 64 bytes, not the
    whole text.
    """
    keyed = rows.select(F.sha2(F.col("text"), 256).alias("text_hash"), LABEL)
    return (keyed.groupBy("text_hash")
            .agg(F.countDistinct(LABEL).alias("n_labels"), F.count("*").alias("n_rows"))
            .filter(F.col("n_labels") > 1))


def stratified_split(corpus: DataFrame, seed: int = SPLIT_SEED, holdout_tenths: int = 3,
                     bucket_hex: int = 4) -> DataFrame:
    """Deterministic stratified split 70 / 15 / 15 per class.

    Rows of a class are ranked by ``md5('<seed>:' || text), text``. With n
    rows in the class: hold = ceil(n * holdout_tenths / 10), test =
    ceil(hold / 2), val = hold - test, train = n - hold; ranks 1..train are
    train, then val, then test.

    The rank is computed without a per-class window (a class may hold half
    the corpus): rows are bucketed by the first ``bucket_hex`` hex digits of
    the key, which preserves key order. Bucket counts (at most
    classes x 16**bucket_hex rows) are prefix-summed, broadcast back, and the
    row_number runs inside each (class, bucket).
    """
    keyed = (corpus.withColumn("split_key", split_key(F.col("text"), seed))
             .withColumn("_bucket", F.conv(F.substring("split_key", 1, bucket_hex), 16, 10)
                         .cast("int")))
    counts = keyed.groupBy(LABEL, "_bucket").agg(F.count("*").alias("_nb"))
    before = (Window.partitionBy(LABEL).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(
        LABEL, "_bucket",
        F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_offset"),
        F.sum("_nb").over(Window.partitionBy(LABEL)).alias("_n"))
    # bounded: one row per (class, bucket), 16**bucket_hex buckets per class
    ranked = keyed.join(F.broadcast(offsets), [LABEL, "_bucket"], "inner")
    in_bucket = Window.partitionBy(LABEL, "_bucket").orderBy("split_key", "text")
    ranked = ranked.withColumn("_rank", F.row_number().over(in_bucket) + F.col("_offset"))
    hold = F.expr(f"({holdout_tenths} * _n + 9) div 10")
    test = F.expr(f"(({holdout_tenths} * _n + 9) div 10 + 1) div 2")
    n_train = F.col("_n") - hold
    n_val = hold - test
    split = (F.when(F.col("_rank") <= n_train, F.lit("train"))
             .when(F.col("_rank") <= n_train + n_val, F.lit("val"))
             .otherwise(F.lit("test")))
    return ranked.select("text", LABEL, "split_key", split.alias("split"))


def split_summary(split_df: DataFrame) -> DataFrame:
    """Rows and positive share per split."""
    return split_df.groupBy("split").agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg(F.col(LABEL).cast("double")), 6).alias("positive_rate"))


def as_training_frame(split_df: DataFrame, split: str) -> DataFrame:
    """Rename by position to ``(text, labels)`` for one split."""
    return split_df.filter(F.col("split") == split).select("text", LABEL).toDF("text", "labels")



#: log2 of the registers of a sketch; the relative error is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 14


def distinct_sketches(tagged: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """A02 / A03, opt-in: a mergeable sketch of the distinct texts of each source file and class.

    Sketches of parts add up (``sketched_counts``), so a table of them kept per file takes a
    new file by reading that file only; a sketch has at most 2 ** bits registers.
    """
    return tagged.groupBy("source", "file", LABEL).agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg("text", bits).alias("sketch"))


def sketched_counts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and estimated distinct texts of the union of the sketches of each group."""
    return sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
