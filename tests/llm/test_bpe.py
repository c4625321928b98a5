"""Encoding against the public library, decoding against the texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from concord.llm import bpe, kernels

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(bpe.default_ranks())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.Coder(ranks)


ALPHABET = "ab's\n\t trelvdmT1½Ⅷé!#　\xa0\x1c日本ñ🙂́"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=25) | st.text(max_size=15),
                max_size=12))
def test_equals_library(coder, library, texts):
    data, off = kernels.byte_column(pa.array(texts, pa.string()))
    ids, bounds = coder.encode(data, off)
    for k, t in enumerate(texts):
        assert list(ids[bounds[k]:bounds[k + 1]]) == library.encode_ordinary(t)
    assert coder.decode(ids, bounds) == [t.encode() for t in texts]


def test_memory_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    small = bpe.Coder(ranks)
    for k in range(6):
        texts = [f"wordlike{k}x{i} again" for i in range(9)]
        data, off = kernels.byte_column(pa.array(texts))
        ids, bounds = small.encode(data, off)
        assert [list(ids[a:b]) for a, b in zip(bounds, bounds[1:])] == [
            library.encode_ordinary(t) for t in texts]
        assert len(small.known) <= 60


def test_query_columns(spark, library):
    rows = [(1, "Hello there's  more\n\nof it", 7), (1, None, 8), (None, "", 9),
            (4, "x" * 3000 + " y" * 3000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = bpe.digests(df, bpe.default_ranks()).collect()
    for row, (doc, text, _) in zip(got, rows, strict=True):
        want = library.encode_ordinary(text or "")
        assert (row.doc_id, row.n_tokens) == (doc, len(want))
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    apart = bpe.decode(bpe.encode(df, bpe.default_ranks()), bpe.default_ranks())
    assert [bytes(r.decoded) for r in apart.collect()] == [(t or "").encode() for _, t, _ in rows]
    empty = spark.createDataFrame([], df.schema)
    assert bpe.digests(empty, bpe.default_ranks()).count() == 0


def test_unknown_id_fails(coder):
    with pytest.raises(ValueError):
        coder.decode(np.array([0, 60000], np.int32), np.array([0, 2]))


def thue_morse(n, letters="ab"):
    """Texts that collide under powers of any odd base modulo 2 ** 64."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def test_pieces_that_collide_under_powers_of_a_base(coder, library):
    texts = [*thue_morse(1024), *thue_morse(2048), *thue_morse(2048, "xy")]
    data, off = kernels.byte_column(pa.array(texts))
    assert len(set(kernels.word_hashes(data, off, kernels.not_space())[0].tolist())) == len(texts)
    ids, bounds = coder.encode(data, off)
    for k, t in enumerate(texts):
        assert list(ids[bounds[k]:bounds[k + 1]]) == library.encode_ordinary(t)


def test_equal_hashes_are_told_apart_by_bytes(ranks, library, monkeypatch):
    """With a first hash of four values, the second one finds the clash."""
    whole = kernels.run_hashes
    monkeypatch.setattr(bpe.K, "run_hashes", lambda v, a, b, salt=0: (
        whole(v, a, b, salt) if salt else whole(v, a, b) & kernels.U64(3)))
    small = bpe.Coder(ranks)
    for texts in (["one"], ["alpha beta gamma delta", "beta of words"], ["two more of these words"]):
        data, off = kernels.byte_column(pa.array(texts))
        ids, bounds = small.encode(data, off)
        assert [list(ids[a:b]) for a, b in zip(bounds, bounds[1:])] == [
            library.encode_ordinary(t) for t in texts]


def test_long_pieces_equal_the_library(coder, library):
    r = np.random.default_rng(3)
    letters = "".join(map(chr, r.integers(97, 123, 12_000)))
    chinese = "".join(map(chr, r.integers(0x4E00, 0x9FA5, 3_000)))
    texts = [letters, chinese, "a" * 5_001, "ab" * 2_000 + "aab" * 999, "\n" * 1_500]
    data, off = kernels.byte_column(pa.array(texts))
    ids, bounds = coder.encode(data, off)
    for k, t in enumerate(texts):
        assert list(ids[bounds[k]:bounds[k + 1]]) == library.encode_ordinary(t)


def test_runs_hash_alike_wherever_they_stand():
    """Long runs are hashed in parts, short ones many at once; equal bytes, equal hash."""
    n = kernels.PIECE
    text = ("x" * 10 + "y") * (n // 5)
    data, off = kernels.byte_column(pa.array([text + " ab  " + text, "ab " + text, "ab"]))
    hashes, first = kernels.word_hashes(data, off, kernels.not_space())
    assert list(first) == [0, 3, 5, 6] and hashes[0] == hashes[2] == hashes[4]
    assert hashes[1] == hashes[3] == hashes[5] != hashes[0]


def test_workers_drop_the_coder_for_other_operators(ranks):
    """A worker process that goes on to the quality rules keeps no merge table of this operator."""
    bpe._coder(ranks)
    kernels.begin("bpe")
    assert kernels.KEPT["bpe"]
    kernels.begin("rules")
    assert not kernels.KEPT["bpe"]


def test_new_pieces_leave_the_ids_of_others_where_they_are(ranks, library):
    """The ids remembered are not copied into another order with each new chunk of texts."""
    own = bpe.Coder(ranks)
    for k in range(5):
        before = own.ids.copy()
        texts = [f"wordlike{k}x{i} qzjxv{k}{i}" for i in range(20)] + ["wordlike0x1 qzjxv01"]
        data, off = kernels.byte_column(pa.array(texts))
        ids, bounds = own.encode(data, off)
        assert [list(ids[a:b]) for a, b in zip(bounds, bounds[1:])] == [
            library.encode_ordinary(t) for t in texts]
        assert len(own.ids) > len(before) and (own.ids[:len(before)] == before).all()
    assert (own.known[1:] > own.known[:-1]).all()
