import random
import re

import pytest

from concord.llm import license_scan as S


def grams(text):
    w = re.findall("[a-z0-9]+", (text or "").lower())
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def brute(text, templates):
    g, out = grams(text), []
    for name, t in templates.items():
        own = set(grams(t))
        m = 1
        while m < len(own):
            m *= 2
        for k in range(0, len(g) + 1, m):
            if 100 * len(own & set(g[k:k + 2 * m])) >= S.PERCENT * len(own):
                out.append(name)
                break
    return ",".join(sorted(out))


def test_against_brute_force(spark):
    r = random.Random(1)
    word = lambda: r.choice(["under", "the", "License", "of", "x", "Apache", "work", "is"])
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(r.randrange(0, 60))) for i in range(20)]
    for i, t in enumerate(list(S.TEMPLATES.values()) * 6):
        w = t.split()
        for _ in range(r.randrange(0, 3)):
            w[r.randrange(len(w))] = "other"
        rows.append((100 + i, text(r.randrange(0, 40)) + ". " + " ".join(w).upper() + "\n" + text(9)))
    rows += [(None, rows[-1][1]), (None, None), (7, ""), (7, "MIT License"), (5, rows[30][1]),
             (5, rows[30][1]), (6, (S.TEMPLATES["MIT"] + "\n") * 400)]
    df = spark.createDataFrame([(*x, 0) for x in rows],
                               "doc_id long, text string, licenses int").repartition(3)
    got = sorted(((x.doc_id, x.n_licenses, x.licenses) for x in S.licenses(df).collect()), key=str)
    want = [(d, brute(t, S.TEMPLATES)) for d, t in rows]
    assert got == sorted(((d, len([x for x in s.split(",") if x]), s) for d, s in want), key=str)
    assert sum(bool(s) for _, s in want) > 20


def test_edges(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.licenses(df).count() == 0
    with pytest.raises(ValueError):
        S.template_rows(spark, {"x": "three words only"})
