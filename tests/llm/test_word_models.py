"""The models over words, against the brute force of the models over bytes."""

import collections
import math
import os
import random
import sys
import threading

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from test_ngram_lm import Brute  # noqa: E402

from concord.llm import cross_entropy as X  # noqa: E402
from concord.llm import ngram_lm as L  # noqa: E402
from concord.llm import quality_classifier as Q  # noqa: E402
from concord.llm import word_losses as W  # noqa: E402

LEAST = 3


def corpus():
    r = random.Random(9)
    words = "The the of über a$ cat dog mat on sat  x".split(" ")
    text = lambda n: "".join(
        r.choice(words) + r.choice([" ", "\n", "\t "]) for _ in range(n))
    docs = [(i, r.choice(["en", "de", None]), text(r.randrange(0, 30))) for i in range(40)]
    docs += [(40, "xx", "the rare"), (41, "en", None), (42, "en", " \n "), (3, "en", "the dog"),
             (3, "en", "the dog"), (None, "de", "cat"), (43, "en", "seldom " * 2)]
    labels = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(40)]
    return docs, labels


def symbols(docs):
    """Each text as one byte a word (0 is the start, 1 the unknown word), and their number."""
    fold = lambda t: "".join(
        c.lower() if "A" <= c <= "Z" else c for c in t or "")
    split = lambda t: [w for w in fold(t).replace("\n", " ").replace("\t", " ").split(" ") if w]
    count = collections.Counter(w for _, _, t in docs for w in split(t))
    known = sorted(w for w, n in count.items() if n >= LEAST)
    place = {w: i + 2 for i, w in enumerate(known)}
    return [bytes(place.get(w, 1) for w in split(t)) for _, _, t in docs], len(known) + 1


def frames(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3)
    return docs, labels, df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def rounded(v):
    return None if v is None else round(v, 4)


@pytest.mark.parametrize("order", [2, 5])  # the grams of order 5 take two numbers
def test_perplexity_over_words(spark, order):
    docs, labels, df, lab = frames(spark)
    got = Q.classify(df, lab, order=order, words=LEAST).collect()
    body, size = symbols(docs)
    good = {i for i, q, t in labels if q == 1 and t == 0}
    held = {r[0] for r in df.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {Q.HELD_OUT}) = 0 as h")
            .filter("h").collect()}
    want = collections.Counter()
    models = {lang: Brute([b for (i, g, _), b in zip(docs, body, strict=True)
                           if (g or "") == lang and i in good - held], order, size)
              for lang in {g or "" for _, g, _ in docs}}
    for (i, lang, _), b in zip(docs, body, strict=True):
        ppl = math.exp(models[lang or ""].loss(b) / len(b)) if b else None
        want[i, lang or "", len(b), rounded(ppl)] += 1
    assert collections.Counter((x.doc_id, x.lang, x.n_tokens, rounded(x.perplexity))
                               for x in got) == want


def test_threshold_is_the_quantile(spark):
    docs, labels, df, lab = frames(spark)
    got = Q.classify(df, lab, order=2, words=LEAST).collect()
    good = {i for i, q, t in labels if q == 1 and t == 0}
    held = {r[0] for r in df.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {Q.HELD_OUT}) = 0 as h")
            .filter("h").collect()} & good
    seen = set()
    for lang in {x.lang for x in got}:
        mine = [x.perplexity for x in got if x.lang == lang and x.doc_id in held and x.perplexity]
        every = [x.perplexity for x in got if x.lang == lang and x.perplexity]
        seen.add(bool(mine))
        # 0.99 of so few is the largest
        assert {x.threshold for x in got if x.lang == lang} == {max(mine or every)}
    assert True in seen


def test_difference_over_words(spark):
    docs, labels, df, lab = frames(spark)
    got = X.differences(df, lab, words=LEAST).collect()
    body, size = symbols(docs)
    good = {i for i, q, t in labels if q == 1 and t == 0}
    target = Brute([b for (i, _, _), b in zip(docs, body, strict=True) if i in good],
                   X.ORDER, size)
    every = Brute(body, X.ORDER, size)
    want = collections.Counter()
    for (i, _, _), b in zip(docs, body, strict=True):
        a, c = (m.loss(b) / len(b) if b else None for m in (target, every))
        want[i, len(b), rounded(a), rounded(c)] += 1
    assert collections.Counter((x.doc_id, x.n_tokens, rounded(x.target_loss), rounded(
        x.background_loss)) for x in got) == want


def test_word_order_counts(spark):
    """Shuffled words are much worse than the text; a model of letters hardly sees it."""
    r = random.Random(4)
    names, verbs = [f"name{i}" for i in range(30)], [f"verb{i}" for i in range(30)]
    line = lambda: f"the {r.choice(names)} will {r.choice(verbs)} a {r.choice(names)} ."
    docs = [(i, "en", " ".join(line() for _ in range(20))) for i in range(60)]
    mixed = [(100 + i, "en", " ".join(r.sample(t.split(), len(t.split()))))
             for i, _, t in docs[:10]]
    df = spark.createDataFrame(docs + mixed, "doc_id long, lang string, text string")
    lab = spark.createDataFrame([(i, 1, 0) for i in range(60)],
                                "doc_id long, quality int, toxic int")
    got = {x.doc_id: x.perplexity for x in Q.classify(df, lab, words=LEAST).collect()}
    assert min(v for k, v in got.items() if k >= 100) > 3 * max(
        v for k, v in got.items() if k < 100)


def test_sums_do_not_depend_on_tasks(spark):
    r = random.Random(2)
    texts = ["".join(r.choice("abcdef") for _ in range(r.randrange(200))) for _ in range(30)]
    rows = [(i, "m", t) for i, t in enumerate(texts)] + [(0, "m", texts[0]), (90, "m", None)]
    loss = {c: r.random() * 9 for c in "abcde"}
    table = spark.createDataFrame([("m", 0, ord(c), [v]) for c, v in loss.items()],
                                  "model string, hi long, gram long, values array<double>")
    want = sorted((i, len(t or ""), sum(round(loss.get(c, 0) * L.STEPS) for c in t or "") / L.STEPS)
                  for i, _, t in rows)
    for tasks in (1, 7, 3):
        df = spark.createDataFrame(rows, "doc_id long, model string, text string")
        got = L.score(df.repartition(tasks), table, 1, 1).collect()
        assert sorted((x.doc_id, x.n_tokens, x.sums[0]) for x in got) == want


def test_vocabulary_is_the_most_frequent_words(spark, monkeypatch):
    texts = spark.createDataFrame([("a a a a b b b c c c",), ("d d a",)], "text string")
    assert L.Words(texts, 2).size == 5       # a b c d and the unknown word
    monkeypatch.setattr(L.Words, "MOST", 2)  # a, and b or c by hash: never by the table's size
    unit = L.Words(texts.repartition(3), 2)
    words = {r.word: r.n for r in L.word_counts(texts).collect()}
    tied = min(w for w, n in words.items() if n == 3)
    most = next(w for w, n in words.items() if n == 5)
    assert unit.kept.value.tolist() == sorted([most, tied])


def test_empty_over_words(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.classify(docs, labels, words=LEAST).count() == 0
    assert X.differences(docs, labels, words=LEAST).count() == 0


@pytest.mark.parametrize("order", [3, 5])
def test_spread_contexts_give_the_same_losses(spark, monkeypatch, order):
    """Contexts of one and two words whose grams lie in many buckets."""
    monkeypatch.setattr(W, "BUCKET", 16)
    monkeypatch.setattr(W, "HOT", 12)
    seen, of = [], W.hot_contexts
    monkeypatch.setattr(W, "hot_contexts", lambda *a: seen.append(of(*a)) or seen[-1])
    test_perplexity_over_words(spark, order)
    if order == 5:
        test_difference_over_words(spark)
    assert {words for _, words, _, _ in seen[0]} == set(range(1, min(2, order - 2) + 1))


def test_grams_do_not_fill_the_disk(spark):
    """Shuffle files and tables take less than twice the text while a model of random words, nearly
    all of whose grams are different, is trained and used."""
    r = random.Random(5)
    words = [f"word{int(4000 * r.random() ** 3)}" for _ in range(400_000)]
    docs = [(i, "en", " ".join(words[200 * i:200 * i + 200])) for i in range(2000)]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(4)
    lab = spark.createDataFrame([(i, 1, 0) for i in range(0, 2000, 3)],
                                "doc_id long, quality int, toxic int")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [str(d) for d in disk.localDirsString()] + [spark.conf.get("spark.checkpoint.dir")]
    most, done = [0], threading.Event()

    def used():
        size = 0
        for top in tops:
            for folder, _, files in os.walk(top):
                for f in files:
                    try:
                        size += os.path.getsize(os.path.join(folder, f))
                    except OSError:
                        pass
        return size

    def watch():
        while not done.wait(0.05):
            most[0] = max(most[0], used())

    floor, watcher = used(), threading.Thread(target=watch)
    watcher.start()
    try:
        assert Q.classify(df, lab, words=LEAST).count() == 2000
    finally:
        done.set()
        watcher.join()
    assert most[0] - floor < 2 * sum(len(t) for _, _, t in docs)
