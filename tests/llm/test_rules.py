import math
import random
import re
from collections import Counter

import pytest
import regex

from larkspur.llm import rules
from larkspur.llm.queries import QUERIES

KEYS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"]


def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def base(text):
    w, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    held = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for j in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(held)


def classes(text):
    out, rest = [], text or ""
    for p in rules.CLASSES:
        less = regex.sub(p, "", rest)
        out.append(len(rest) - len(less))
        rest = less
    return [*out, len(rest)]


def distance(p, q):
    p, q = ([x / max(1, sum(v)) for x in v] for v in (p, q))
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x) / 2
    return math.sqrt(max(0.0, half(p, q) + half(q, p)))


def plain(rows, common=16, min_words=50, least=1000):
    """The contract and the method over (doc_id, lang, text) rows, in plain Python."""
    by, chars = {}, {}
    for _, lang, text in rows:
        by.setdefault(lang, Counter()).update(words_of(text))
        chars[lang] = [a + b for a, b in zip(chars.get(lang, [0] * 6), classes(text))]
    out = []
    for d, lang, text in rows:
        n, *rest = base(text)
        failed = n < min_words or 100 * rest[-1] > 50 * n
        cd = wd = None
        ref = by[lang]
        if n >= min_words and sum(ref.values()) >= least:
            top = sorted(ref, key=lambda w: (-ref[w], w.encode()))[:common]
            own = Counter(words_of(text))
            wd = distance([own[w] for w in top] + [n - sum(own[w] for w in top)], [ref[w] for w in top] + [sum(ref.values()) - sum(ref[w] for w in top)])
            cd = distance(classes(text), chars[lang])
        kept = not failed and not (cd or 0) > rules.CHAR_LIMIT and not (wd or 0) > rules.WORD_LIMIT
        out.append((d, n, *rest, failed, kept, cd, wd))
    return out


def check(got, want):
    order = lambda r: tuple(map(str, r[:8]))
    got, want = sorted((tuple(r) for r in got), key=order), sorted(want, key=order)
    assert [r[:8] for r in got] == [r[:8] for r in want]
    for g, w in zip(got, want):
        assert g[8:] == tuple(None if x is None else pytest.approx(x, abs=2e-6) for x in w[8:])


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()]
    out = QUERIES["op13_quality_rules"](spark, sf)
    assert out.columns == KEYS
    check(out.collect(), plain(rows))


def test_labelled_documents(spark, sf):
    """Good documents of 50 words stay, and most bad ones go, though no label is read."""
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r["kept"]) for r in QUERIES["op13_quality_rules"](spark, sf).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good, bad = ([k for y, k in got if y == v] for v in (1, 0))
    assert all(good) and len(good) > 10
    assert not bad or sum(bad) <= 0.2 * len(bad)


def test_odd_rows(spark):
    """Null and empty texts, null ids and languages, a language of little text, every white byte, characters beyond
    ASCII, windows that overlap and cross, lines of blanks, repeated rows, a long text, clashing columns, an empty table."""
    rng = random.Random(3)
    prose = lambda n, k=60: " ".join(rng.choice(["the", "of", "and", "to", "in"]) if rng.random() < 0.5 else f"w{rng.randrange(k)}" for _ in range(n))
    rows = [(i, "en", prose(rng.randint(40, 160))) for i in range(40)]
    rows += [(100, "en", None), (101, "en", ""), (102, None, prose(1200)), (103, None, None), (None, "en", prose(80)), (104, "xx", prose(60))]
    rows += [(105, "en", "a b a b a b " * 30), (106, "en", "a\x0bb\x0cc\rd\te\nf \n\n \t\n" * 20), (107, "en", "é 𝄞# Ünï|< " * 30), (108, "en", prose(30_000, 5000))]
    rows += [(109, "en", "#### $$$$ %%%% " * 40 + prose(60)), (110, "en", "x y z " + prose(55) + " x y z"), (111, "en", "THE OF AND " + prose(70).upper())] + [(3, "en", rows[3][2])] * 3
    df = spark.createDataFrame([(*r, [1], "z", 4.0) for r in rows], "doc_id long, lang string, text string, words array<int>, ref string, n_words double")
    check(rules.quality_rules(df).collect(), plain(rows))
    assert rules.quality_rules(df.limit(0)).count() == 0


def test_references_beyond_the_broadcast_bound(spark, sf, monkeypatch):
    """The join without a broadcast gives the same rows."""
    want = QUERIES["op13_quality_rules"](spark, sf).collect()
    monkeypatch.setattr(rules, "BROADCAST_BYTES", -1)
    assert sorted(map(str, QUERIES["op13_quality_rules"](spark, sf).collect())) == sorted(map(str, want))
