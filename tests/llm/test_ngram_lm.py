import collections
import math
import random

import pytest

from concord.llm import cross_entropy as X
from concord.llm import ngram_lm as L
from concord.llm import quality_classifier as Q


class Brute:
    """Interpolated modified Kneser-Ney over bytes, by the textbook's recursion."""

    def __init__(self, texts, order, vocabulary):
        self.order, self.vocabulary = order, vocabulary
        top = collections.Counter()
        for t in texts:
            s = bytes(order - 1) + t
            top.update(s[i:i + order] for i in range(len(t)))
        self.a = {order: top}
        for k in range(order - 1, 0, -1):
            self.a[k] = collections.Counter(g[1:] for g in self.a[k + 1])
        self.d = {}
        for k, a in self.a.items():
            n = collections.Counter(a.values())
            self.d[k] = []
            for i in (1, 2, 3):
                if n[1] and n[i] and n[i + 1]:
                    d = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i]
                else:
                    d = 0.5 * i
                self.d[k].append(max(0.1, min(i, d)))

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / self.vocabulary
        cut = lambda c: self.d[k][min(c, 3) - 1]
        same = [c for g, c in self.a[k].items() if g[:-1] == gram[:-1]]
        low = self.p(gram[1:])
        if not same:
            return low
        c = self.a[k][gram]
        return ((c - cut(c)) if c else 0) / sum(same) + sum(map(cut, same)) / sum(same) * low

    def loss(self, t):
        s = bytes(self.order - 1) + t
        return -sum(math.log(self.p(s[i:i + self.order])) for i in range(len(t)))


def corpus():
    r = random.Random(3)
    text = lambda n: "".join(r.choice("aabbcé d") for _ in range(n))
    docs = [(i, r.choice(["en", "de", None]), text(r.randrange(0, 40))) for i in range(40)]
    docs += [(40, "xx", "only here"), (41, "en", None), (41, "en", "zz#"), (3, "en", "twice"),
             (3, "en", "twice"), (None, "de", "abc")]
    labels = [(i, i % 3 and 1, int(i % 7 == 0)) for i in range(0, 40, 1)] + [(1, 1, 0), (999, 1, 0)]
    return docs, labels


def test_perplexity(spark):
    docs, labels = corpus()
    df = spark.createDataFrame([(*d, 1) for d in docs],
                               "doc_id long, lang string, text string, kept int").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.classify(df, lab, order=3).collect()
    assert len(got) == len(docs)
    good = {i for i, q, t in labels if q == 1 and t == 0}
    held = {r[0] for r in spark.createDataFrame([(i,) for i in good], "doc_id long").selectExpr(
        "doc_id", f"pmod(xxhash64(doc_id), {Q.HELD_OUT}) = 0 as h").filter("h").collect()}
    models = {}
    for lang in {d[1] or "" for d in docs}:
        models[lang] = Brute([(t or "").encode() for i, g, t in docs
                              if (g or "") == lang and i in good - held], 3, 256)
    want = collections.Counter()
    for i, lang, t in docs:
        b = (t or "").encode()
        ppl = round(math.exp(models[lang or ""].loss(b) / len(b)), 3) if b else None
        want[i, lang or "", len(b), ppl] += 1
    assert collections.Counter((x.doc_id, x.lang, x.n_tokens, x.perplexity and round(
        x.perplexity, 3)) for x in got) == want
    assert all(x.kept == bool(x.perplexity and x.perplexity <= x.threshold) for x in got)


def test_difference(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = X.differences(df, lab, order=3, least=3).collect()
    good = {i for i, q, t in labels if q == 1 and t == 0}
    count = collections.Counter(b for _, _, t in docs for b in (t or "").encode())
    fold = lambda t: bytes(b if count[b] >= 3 else X.UNKNOWN for b in (t or "").encode())
    size = len({b if count[b] >= 3 else X.UNKNOWN for b in range(256)})
    target = Brute([fold(t) for i, _, t in docs if i in good], 3, size)
    every = Brute([fold(t) for _, _, t in docs], 3, size)
    want = collections.Counter()
    for i, _, t in docs:
        b = fold(t)
        a, c = (round(m.loss(b) / len(b), 4) if b else None for m in (target, every))
        want[i, len(b), a, c] += 1
    rounded = lambda v: None if v is None else round(v, 4)
    assert collections.Counter((x.doc_id, x.n_tokens, rounded(x.target_loss), rounded(
        x.background_loss)) for x in got) == want
    assert all(x.difference is None or abs(x.difference - x.target_loss + x.background_loss) < 1e-6
               for x in got)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.classify(docs, labels).count() == 0
    assert X.differences(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "en", "abc")], docs.schema)
    assert Q.classify(one, labels).first().perplexity == pytest.approx(256, rel=1e-4)
