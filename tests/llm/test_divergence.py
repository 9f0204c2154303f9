import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from trawl.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term int, n int"
WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _brute(rows, min_docs, top=10):
    docs = [(lang or "", source or "", Counter(WORD.findall(_lower(text or "")))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = [t for t in df if df[t] >= min_docs]
        whole = Counter()
        groups = {d[1]: Counter() for d in own}
        for _, source, words in own:
            for t in kept:
                whole[t] += words[t]
                groups[source][t] += words[t]

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + (10**9 * (c[t] + 2)) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            term = [(-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, i.decode(), -v, r + 1) for r, (v, i) in enumerate(items)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = ["the", "The", "naïve", "x", "été", "longerthaneight", "longerthaneighteen", "abcdefgh", "abcdefghi", "日本", "a1b", "z" * 40]
    out = [(i, " ".join(rng.choice(words, rng.integers(0, 30))) + rng.choice(["", ".", "\x00end"]),
            str(rng.choice(["en", "fr"])), f"s{rng.integers(0, 7)}") for i in range(200)]
    out += [(500 + i, "the same words", "en", "hot") for i in range(120)]           # a third of all rows
    out += [(900, None, "en", "silent"), (901, "", None, None), (None, "the x", "fr", None), (902, "the x", "xx", "one"),
            (902, "the x", "xx", "two"), (903, "the été " * 20_000, "en", "s1")]
    return out


def _table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)


@pytest.mark.parametrize("sources,term_rows", [(512, 200_000), (3, 40)])
def test_against_brute_force(spark, rows, monkeypatch, sources, term_rows):
    monkeypatch.setattr(divergence, "SOURCES", sources)
    monkeypatch.setattr(divergence, "TERM_ROWS", term_rows)
    got = sorted(tuple(r) for r in divergence.audit(_table(spark, rows)).collect())
    assert got == _brute(rows, 10)


def test_empty(spark, rows):
    assert divergence.audit(_table(spark, rows).limit(0)).collect() == []


def test_multikey_sort_groups_equal_words():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("ab"), rng.integers(1, 30))) for _ in range(3000)] + ["a" * 8, "a" * 9, "a" * 16, "a" * 17] * 3
    buf = divergence._TERM[np.frombuffer(" ".join(words).encode(), np.uint8)]
    ptr, size = divergence.word_pointers(buf, np.array([0]))
    order, first = divergence.multikey_sort(buf, ptr, size)
    assert [words[i] for i in order] == sorted(words)
    assert first.tolist() == [True] + [a != b for a, b in zip(sorted(words), sorted(words)[1:])]


def test_words_end_with_their_text_and_slices_are_views():
    texts = pa.array(["skip", "ab", "", "cd", "AB ab"])[1:]
    words, term, group, n, df = divergence.shard_counts(texts, np.array([0, 0, 1, 0]))
    got = sorted(zip([words[t] for t in term], group.tolist(), n.tolist(), df.tolist()))
    assert got == [(b"ab", 0, 3, 2), (b"cd", 1, 1, 1)]


def test_exact_probabilities_beyond_64_bits(spark):
    n, total, terms = 7 * 10**18, 9 * 10**18, 10**9
    df = spark.range(1).selectExpr(f"{n}L AS n", f"{total}L AS total", f"{terms}L AS terms")
    assert df.select(divergence.probability("n", "total", "terms")).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * terms)
