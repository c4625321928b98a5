"""Quality rules by distribution divergence (operator 8).

Every text gets two histograms: code points by character class, and words by
the common words of its language (one bin each, one bin for all others). The
reference of a language is the pooled histogram of all its documents that pass
the base rules. A document is rejected when its Jensen-Shannon distance (base
2, square root of the divergence) to a reference exceeds the limit of that
histogram. Short texts have noisy histograms, so each histogram has a minimum
length under which it is not judged, and the squared limit is widened by
the divergence that sampling alone gives, ``(bins - 1) / (8 ln 2 length)``.

Edge cases: a null or empty text has zero counts, no words, fails the base
rules and is not kept; a null language counts as the language "", which has no
common words; duplicate ids are separate rows; columns other than id, text and
language are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import kernels as K
from concord.llm.common import broadcast_if_small, table, written

# Common function words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that for it was on are as with be at by this from or an have not",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o",
}
# Character classes, in bin order.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "quote", "other",
           "high")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Limits of the Jensen-Shannon distance, and the least length judged.
CHAR_LIMIT, CHAR_MIN = 0.22, 200
WORD_LIMIT, WORD_MIN = 0.22, 50

FEATURES = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, "
            "n_dup_lines long, n_repeat_words long, chars array<long>, words array<long>")


def class_table() -> np.ndarray:
    """Class of each lead byte; continuation bytes get the extra class 10."""
    t = np.full(256, 8, np.int64)
    t[0x61:0x7B], t[0x41:0x5B], t[0x30:0x3A] = 0, 1, 2
    t[[32, 9]], t[[10, 13]] = 3, 4
    t[[ord(c) for c in ".,;:!?"]] = 5
    t[[ord(c) for c in "#*$%&|<>"]] = 6
    t[[ord(c) for c in "'\"-()"]] = 7
    t[0xC0:], t[0x80:0xC0] = 9, 10
    return t


def is_symbol() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in "#*$%&|<>"]] = True
    return t


def common_index(languages: dict[str, str]):
    """(sorted hashes of all common words, language -> bin of each hash, -1 if none)."""
    words = sorted({w for ws in languages.values() for w in ws.split()})
    data, off = K.byte_column(pa.array(words))
    hashes = K.word_hashes(data, off, K.not_space())[0]
    order = np.argsort(hashes)
    bins = {}
    for lang, ws in languages.items():
        place = {w: i for i, w in enumerate(ws.split())}
        bins[lang] = np.array([place.get(words[k], -1) for k in order])
    return hashes[order], bins


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive bounds."""
    acc = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return acc[bounds[1:]] - acc[bounds[:-1]]


def repeated_words(words: np.ndarray, first: np.ndarray, width: int = 3) -> np.ndarray:
    """Words of each text inside a window of ``width`` words found at least twice in it."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = K.window_hashes(words, width)
    inside = text[:len(grams)] == text[width - 1:]
    at = np.flatnonzero(inside)
    keys = K.mix(grams[at] ^ K.mix(text[at].astype(K.U64), 11), 5)
    _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    twice = at[count[back] > 1]
    hit = np.zeros(len(words), bool)
    for j in range(width):
        hit[twice + j] = True
    return per_text(hit, first)


def duplicate_lines(data, off, word_first_byte, values) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    base, raw = off[0], data[off[0]:off[-1]]
    if not len(raw):
        return np.zeros(len(off) - 1, np.int64)
    cuts = np.flatnonzero(raw == 10)
    starts = np.unique(np.concatenate((off[:-1] - base, cuts + 1)))
    starts = starts[starts < len(raw)]
    ends = np.concatenate((starts[1:], [len(raw)]))
    # a line ends at its line break or at the end of its text
    ends = ends - ((ends > starts) & (raw[np.maximum(ends - 1, 0)] == 10))
    text = np.searchsorted(off[1:] - base, starts, side="right")
    has = np.searchsorted(word_first_byte, starts) < np.searchsorted(word_first_byte, ends)
    starts, ends, text = starts[has], ends[has], text[has]
    keys = K.mix(K.run_hashes(values, starts, ends) ^ K.mix(text.astype(K.U64), 13), 6)
    _, seen = np.unique(keys, return_index=True)
    n = len(off) - 1
    return np.bincount(text, minlength=n) - np.bincount(text[seen], minlength=n)


def text_features(data, off, langs: list, index) -> dict[str, np.ndarray | list]:
    """All counts of the texts between consecutive offsets."""
    hashes, bins = index
    n, base = len(off) - 1, off[0]
    raw, bounds = data[off[0]:off[-1]], off - off[0]
    inside = K.not_space()
    starts, ends, first = K.spans(data, off, inside)
    lead = (raw & 0xC0) != 0x80
    exact = K.BYTE_VALUE[raw]
    words = K.run_hashes(exact, starts, ends)
    cls = class_table()[raw]
    size = len(CLASSES) + 1
    text_of_byte = np.repeat(np.arange(n), np.diff(bounds))
    chars = np.bincount(text_of_byte * size + cls, minlength=n * size).reshape(n, size)[:, :-1]
    folded = K.run_hashes(K.BYTE_VALUE[K.LOWER[raw]], starts, ends)
    at = np.minimum(np.searchsorted(hashes, folded), len(hashes) - 1)
    known = hashes[at] == folded
    hist = []
    for i in range(n):
        table_ = bins.get(langs[i])
        a, b = first[i], first[i + 1]
        if table_ is None:
            hist.append(np.array([b - a]))
            continue
        place = table_[at[a:b][known[a:b]]]
        top = int(table_.max()) + 1
        found = np.bincount(place[place >= 0], minlength=top)
        hist.append(np.concatenate((found, [b - a - found.sum()])))
    return {
        "n_words": np.diff(first), "word_chars": per_text(lead & inside[raw], bounds),
        "n_symbols": per_text(is_symbol()[raw], bounds),
        "n_dup_lines": duplicate_lines(data, off, starts, exact),
        "n_repeat_words": repeated_words(words, first),
        "chars": chars, "words": hist,
    }


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", languages: dict[str, str] = COMMON_WORDS) -> DataFrame:
    """One row of counts per document; whole texts, in pieces of bounded size."""
    index = common_index(languages)
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()),
                        *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols",
                                                    "n_dup_lines", "n_repeat_words")),
                        ("chars", pa.list_(pa.int64())), ("words", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        K.begin("rules")
        for batch in batches:
            data, off = K.byte_column(batch.column(2))
            for i, j in K.pieces(off):
                langs = batch.column(1).slice(i, j - i).to_pylist()
                f = text_features(data, off[i:j + 1], langs, index)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(langs, pa.string()),
                     *(pa.array(f[c], pa.int64()) for c in schema.names[2:7]),
                     pa.array(list(f["chars"]), pa.list_(pa.int64())),
                     pa.array(f["words"], pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, FEATURES)


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def references(feats: DataFrame) -> DataFrame:
    """Pooled histograms of each language over all documents that pass the base rules."""
    good = feats.filter(~base_failed())

    def pooled(col: str) -> DataFrame:
        sums = (good.select("lang", F.posexplode(col).alias("bin", "n"))
                .groupBy("lang", "bin").agg(F.sum("n").alias("n")))
        return sums.groupBy("lang").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("bin", "n"))), lambda s: s["n"])
            .alias(f"ref_{col}"))  # at most one entry per bin

    return pooled("chars").join(pooled("words"), "lang")


def distance(p: str, q: str):
    """Jensen-Shannon distance (base 2) of two histograms of the same bins."""
    return F.expr(f"""
      sqrt(greatest(0D, aggregate(
        zip_with(transform({p}, x -> x / greatest(1D, aggregate({p}, 0D, (s, x) -> s + x))),
                 transform({q}, x -> x / greatest(1D, aggregate({q}, 0D, (s, x) -> s + x))),
                 (a, b) -> 0.5D * ((CASE WHEN a > 0 THEN a * log2(2 * a / (a + b)) ELSE 0D END)
                                 + (CASE WHEN b > 0 THEN b * log2(2 * b / (a + b)) ELSE 0D END))),
        0D, (s, x) -> s + x)))""")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", char_limit: float = CHAR_LIMIT,
          word_limit: float = WORD_LIMIT) -> DataFrame:
    """Counts, distances and the verdict of every document.

    The counts are computed once and written to the shared folder; references
    and distances are JVM-side expressions over those narrow rows.
    """
    feats = written(features(docs, id_col, text_col, lang_col), "rules")
    ref = broadcast_if_small(references(feats), 10_000)  # one row per language
    rows = (feats.join(ref, "lang", "left")
            .withColumn("n_chars", F.expr("aggregate(chars, 0L, (s, x) -> s + x)"))
            .withColumn("char_distance", distance("chars", "ref_chars"))
            .withColumn("word_distance", distance("words", "ref_words"))
            .withColumn("base_failed", base_failed()))

    def far(hist: str, length: str, least: int, limit: float):
        noise = (F.size(hist) - 1) / (F.col(length) * 8 * math.log(2))
        d = F.col(f"{hist[:-1]}_distance")
        return F.coalesce((F.col(length) >= least) & (d * d > limit * limit + noise), F.lit(False))

    return rows.withColumn("kept", ~F.col("base_failed")
                           & ~far("chars", "n_chars", CHAR_MIN, char_limit)
                           & ~far("words", "n_words", WORD_MIN, word_limit)).select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "char_distance", "word_distance")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every row of ``documents``."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
