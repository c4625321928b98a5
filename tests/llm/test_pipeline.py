"""The pipeline's stages against brute force on the smallest tables."""

import collections
import hashlib
import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import test_decontamination as decon  # noqa: E402
import test_jaccard_join as jaccard  # noqa: E402
import test_quality_rules as rules  # noqa: E402

import corpus_pipeline  # noqa: E402
from concord.llm import bpe, quality_rules  # noqa: E402

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def cut(text, others):
    """A text without the bytes of 400-byte strings that start elsewhere, whole characters."""
    body = text.encode()
    gone = np.zeros(len(body), bool)
    for p in range(len(body) - 399):
        if others[body[p:p + 400]] > 1:
            gone[p:p + 400] = True
    k = 0
    while k < len(body):  # characters of which only a part goes stay
        e = k + 1
        while e < len(body) and body[e] & 0xC0 == 0x80:
            e += 1
        if not gone[k:e].all():
            gone[k:e] = False
        k = e
    return bytes(b for b, g in zip(body, gone, strict=True) if not g).decode()


def kept_by_rules(rows):
    refs, judged = {}, []
    for r in rows:
        base, chars, words = rules.brute(r["text"], r["lang"])
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        judged.append((r, base, chars, words, failed))
        if not failed:
            a, b = refs.setdefault(r["lang"], ([0] * len(chars), [0] * len(words)))
            refs[r["lang"]] = ([x + y for x, y in zip(a, chars)], [x + y for x, y in zip(b, words)])
    out = []
    for r, base, chars, words, failed in judged:
        if failed:
            continue
        near = True
        for hist, ref, n, least, limit in (
                (chars, refs[r["lang"]][0], sum(chars), quality_rules.CHAR_MIN,
                 quality_rules.CHAR_LIMIT),
                (words, refs[r["lang"]][1], base[0], quality_rules.WORD_MIN,
                 quality_rules.WORD_LIMIT)):
            noise = (len(hist) - 1) / (n * 8 * math.log(2))
            near &= n < least or rules.distance(hist, ref) ** 2 <= limit ** 2 + noise
        if near:
            out.append(r)
    return out


def test_every_stage(spark, words_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = [r.asDict() for r in docs]
    rows = kept_by_rules(rows)
    group = {d: c for d, _, c in jaccard.brute([(r["doc_id"], r["text"]) for r in rows], words_of)}
    rows = [r for r in rows if group[r["doc_id"]] == r["doc_id"]]
    seen = collections.Counter()
    for r in rows:
        b = r["text"].encode()
        seen.update(b[p:p + 400] for p in range(len(b) - 399))
    for r in rows:
        r["text"] = cut(r["text"], seen)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    found = decon.brute([(r["doc_id"], r["text"]) for r in rows],
                        [(b.item_id, b.text) for b in bench])
    bad = {x[0] for x in found if x[5]}
    rows = [r for r in rows if r["doc_id"] not in bad]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(bpe.default_ranks()))
    want = {}
    for r in rows:
        ids = library.encode_ordinary(r["text"])
        want[r["doc_id"]] = (r["lang"], r["source"], len(ids), np.array(ids, "<u4").tobytes(),
                             hashlib.sha256(r["text"].encode()).hexdigest())
    got = {x.doc_id: (x.lang, x.source, x.n_tokens, bytes(x.ids), x.decoded_sha256)
           for x in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
    assert 0 < len(got) < len(docs)


def test_stages_keep_columns_and_handle_odd_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = " ".join(f"the word{i} of and" for i in range(90))
    odd = spark.createDataFrame(
        [(None, text, "en", "s", 1), (1, text, "en", "s", 1), (1, text, "en", "s", 1),
         (2, None, None, None, None), (3, "", "en", None, 0), (None, None, None, None, None)],
        schema)
    for frame in (odd, odd.limit(0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
    one = corpus_pipeline.one_of_each_group(spark, odd, SF)
    assert sorted((r.doc_id for r in one.collect()), key=str) == [1, 2, 3, None]


def test_stages_hand_texts_to_workers_in_bounded_batches(spark):
    import pyarrow as pa
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])

    text = "word " * 100_000
    docs = spark.range(60).selectExpr("id AS doc_id", f"repeat('word ', {len(text) // 5}) AS text",
                                      "'en' AS lang", "'s' AS source").coalesce(1)
    for _, stage in corpus_pipeline.STAGES[-1:]:
        spark.conf.unset(name)
        try:
            stage(spark, docs, SF)
            most = docs.mapInArrow(sizes, "size long").agg({"size": "max"}).first()[0]
        finally:
            spark.conf.unset(name)
        assert len(text) <= most <= 6_000_000
    assert all(stage.__wrapped__.__name__ for _, stage in corpus_pipeline.STAGES)
