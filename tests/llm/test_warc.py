import gzip
import hashlib
import io
import random

import pytest

from concord.llm import warc as W


def rows(seed):
    r = random.Random(seed)
    body = lambda n: "".join(r.choice("<p>aé\r\n WARC/1.0") for _ in range(n))
    big = body(300_000)
    out = [(i, f"http://h/{i}\r\n%41", body(r.choice([0, 5, 99, 100, 2000]))) for i in range(60)]
    same = body(150)
    out += [(100 + i, None, same) for i in range(5)] + [(200, "u", big), (90, "v", big)]
    out += [(300, "w", "short"), (301, "w", "short"), (302, None, None), (None, "n", same),
            (None, "n", None), (400, "r", same), (400, "r", same)]
    return out


def expected(data):
    first = {}
    for i, _, h in data:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in data:
        b = (h or "").encode()
        again = b in first and (i is None or i > first[b])
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    first[b] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_task", [1, 777, 50_000, W.RANGE])
def test_round_trip_at_any_split(spark, tmp_path, per_task):
    data = rows(3)
    if per_task == 1:  # one task for each byte: a few small records
        data = [x for x in data if len(x[2] or "") < 50][:3]
    df = spark.createDataFrame([(*x, 0) for x in data],
                               "page_id long, url string, html string, digest int").repartition(3)
    folder = f"file://{tmp_path}/arc"
    assert W.write_archives(W.with_types(df), folder) == len(data)
    got = W.read_archives(spark, folder, per_task).collect()
    assert sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to)
                   for x in got), key=str) == expected(data)
    urls = {x.page_id: x.url for x in got}
    assert all(urls[i] == u for i, u, _ in data if i is not None)
    bodies = {x.page_id: bytes(x.payload) for x in got if x.record_type == "response"}
    assert all(bodies[i] == (h or "").encode() for i, _, h in data if i in bodies and i is not None)


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


def test_false_magic_is_not_a_record():
    good = W.record(7, "u", b"x" * 300, hashlib.sha256(b"x" * 300).hexdigest(), None, False)
    noise = W.MAGIC + b"\x00" * 20 + gzip.compress(b"not a record") + W.MAGIC
    data = noise + good + noise + good[:40]
    for size in (1, 10, 64, 4096):
        found = [r for s in range(0, len(data), size)
                 for r in W.records_of_range(File(data), s, s + size)]
        assert [(r[0], r[3]) for r in found] == [(7, 300)]


def test_damaged_payload_fails():
    bad = W.record(7, "u", b"abc", hashlib.sha256(b"abd").hexdigest(), None, False)
    with pytest.raises(ValueError):
        list(W.records_of_range(File(bad), 0, len(bad)))
