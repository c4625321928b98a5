import collections
import math
import random
import re

from concord.llm import quality_rules as Q


def brute(text, lang):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    base = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))
    fold = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
    common = Q.COMMON_WORDS.get(lang, "").split()
    count = collections.Counter(map(fold, words))
    bins = [count[w] for w in common]
    classes = collections.Counter()
    for c in text:
        classes["lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else
                "digit" if "0" <= c <= "9" else "space" if c in " \t" else
                "newline" if c in "\r\n" else "stop" if c in ".,;:!?" else
                "symbol" if c in "#*$%&|<>" else "quote" if c in "'\"-()" else
                "high" if c > "\x7f" else "other"] += 1
    return base, [classes[k] for k in Q.CLASSES], [*bins, len(words) - sum(bins)]


def distance(p, q):
    p, q = [x / max(1, sum(p)) for x in p], [x / max(1, sum(q)) for x in q]
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0
    return math.sqrt(max(0, sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2))


def corpus():
    r = random.Random(5)
    words = "the of and Haus über x1 it's a$$ |b".split()
    text = lambda n: "".join(
        r.choice(words) + r.choice([" ", " ", "\n", "\t", "  ", " \n"]) for _ in range(n))
    rows = [(i, r.choice(["en", "de", "zz", None]), text(r.randrange(0, 130))) for i in range(60)]
    line = "same line here\n"
    rows += [(60, "en", line * 40), (61, "en", ""), (62, "de", None), (63, "en", " \n \n"),
             (64, "en", "SHOUT!! " * 20 + " ".join(f"W{i}!!" for i in range(300))),
             (65, "en", " ".join(f"word{chr(97 + i % 26)} the of and" for i in range(80))),
             (65, "en", "x" * 5000), (None, "fr", "de la " * 60)]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x, True) for x in rows],
                               "doc_id long, lang string, text string, kept boolean").repartition(3)
    judged = Q.judge(df).collect()
    assert len(judged) == len(rows)
    got = {(x.doc_id, x.n_words, x.word_chars): x for x in judged}
    want = [(d, lang, *brute(t, lang)) for d, lang, t in rows]
    refs = {}
    for d, lang, base, chars, words in want:
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        if not failed:
            a, b = refs.setdefault(lang, ([0] * len(chars), [0] * len(words)))
            refs[lang] = ([x + y for x, y in zip(a, chars)], [x + y for x, y in zip(b, words)])
    assert len(got) == len(rows)
    for d, lang, base, chars, words in want:
        x = got[d, base[0], base[1]]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert x.base_failed == failed
        if failed:
            assert not x.kept
            continue
        near = True
        for hist, ref, n, least, limit in (
                (chars, refs[lang][0], sum(chars), Q.CHAR_MIN, Q.CHAR_LIMIT),
                (words, refs[lang][1], base[0], Q.WORD_MIN, Q.WORD_LIMIT)):
            noise = (len(hist) - 1) / (n * 8 * math.log(2))
            near &= n < least or distance(hist, ref) ** 2 <= limit ** 2 + noise
        assert x.kept == near


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert Q.judge(df).count() == 0


def test_words_that_collide_under_powers_of_a_base(spark):
    from concord.llm import quality_rules
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = ("".join("ab"[b ^ k] for b in bits) for k in (0, 1))
    df = spark.createDataFrame([(1, f"{one} b c\n{two} b c", "en"), (2, f"{one} b c\n{one} b c", "en")],
                               "doc_id long, text string, lang string")
    got = {r.doc_id: (r.n_repeat_words, r.n_dup_lines) for r in quality_rules.features(df).collect()}
    assert got == {1: (0, 0), 2: (6, 1)}
