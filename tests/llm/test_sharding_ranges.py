import collections
import random

import pytest

from concord.llm import sharding as S


@pytest.mark.parametrize("ids", ["sparse", "null", "one"])
def test_ranges_are_few_and_small(spark, monkeypatch, ids):
    monkeypatch.setattr(S, "ID_RANGE", 64)
    r = random.Random(6)
    pick = {"sparse": lambda: r.randrange(-1 << 63, 1 << 63), "null": lambda: None,
            "one": lambda: 7 if r.random() < .8 else r.randrange(20)}[ids]
    rows = [(pick(), r.randrange(1, 9), r.randrange(1 << 32), r.randrange(2))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, size long, text_crc32 long, old int")
    size = collections.Counter((x.old, x._range) for x in S.ranged(df, "old").collect())
    assert len(size) <= 2 * (2 * 25 + 256 * 2)
    assert max(size.values()) <= 4 * 64
    got = S.numbered(df, "old", "n").collect()
    order = lambda x: (x[0] is not None, x[0] or 0, x[2], x[1])
    for old in (0, 1):
        mine = sorted((x for x in got if x.old == old), key=lambda x: x.n)
        assert [x.n for x in mine] == list(range(len(mine)))
        assert [(x.doc_id, x.size, x.text_crc32, x.old) for x in mine] == sorted(
            (x for x in rows if x[3] == old), key=order)
