import hashlib
import os
import random
import sys

sys.path.insert(0, os.path.dirname(__file__))
from test_warc import File  # noqa: E402

from concord.llm import warc as W  # noqa: E402


def long_url(n):
    return "http://h/" + random.Random(n).randbytes(n // 2).hex()  # hardly compresses


def test_as_many_records_read_as_written(spark, tmp_path):
    rows = [(1, "u", "a"), (2, long_url(3 << 20), "long url " * 30), (3, "v", "b"),
            (4, long_url((1 << 20) + 2), "long url " * 30), (5, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    folder = f"file://{tmp_path}/arc"
    n = W.write_archives(W.with_types(df), folder)
    for per_task in (100_000, W.RANGE):
        got = W.read_archives(spark, folder, per_task).collect()
        assert len(got) == n == len(rows)
        assert {x.page_id: x.url for x in got} == {i: u for i, u, _ in rows}


def test_first_line_decides():
    """A member that only starts like a header is passed over, and the next record found."""
    digest = hashlib.sha256(b"abc").hexdigest()
    good = W.record(7, "u", b"abc", digest, None, False)
    packed = [W.zlib.compress(x, wbits=31) for x in (
        b"WARC/1." + b"0" * 2_000_000, b"WARC/1.x\r\nContent-Length: 0\r\n\r\n",
        b"WARC/1.0\r\nno end of header " + random.Random(1).randbytes(200_000).hex().encode())]
    data = b"".join(p + good for p in packed)
    for size in (100, 4096, len(data)):
        found = [r for s in range(0, len(data), size)
                 for r in W.records_of_range(File(data), s, s + size)]
        assert [(r[0], r[2]) for r in found] == [(7, b"abc")] * 3
