import random
import re
from itertools import combinations

import numpy as np
import pytest

from trawl.llm import common, graph, neardup


def _sets(rows, size):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append(frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)] if w else []))
    return out


def _brute(rows, size, percent):
    sets = _sets(rows, size)
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        both = len(a & b)
        if a and b and 100 * both >= percent * (len(a) + len(b) - both):
            x, y = find(rows[i][0]), find(rows[j][0])
            parent[max(x, y)] = min(x, y)
    return sorted((r[0], len(s), find(r[0]), find(r[0]) == r[0]) for r, s in zip(rows, sets, strict=True))


def _corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 12, 40, 150]))]
        for _ in range(rng.choice([1, 2, 5, 14])):
            copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.03, 0.06]) else w for w in base]
            rows.append(" ".join(copy))
    rows += ["", None, " \t\n", "One", "one", "one  ", "two words", "TWO\nwords", "é À", "É À", "x " * 30_000]
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("size", [2, 5])
def test_matches_brute_force(spark, size):
    rows = _corpus()
    docs = spark.createDataFrame([(d, t, "c", 0) for d, t in rows], "doc_id long, text string, set_key string, n int")
    got = neardup.near_duplicates(docs, size, 80)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, size, 80)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = _corpus(8)
    monkeypatch.setattr(neardup, "LIST_BLOCK", 3)
    monkeypatch.setattr(neardup, "GROUP_BLOCK_DOCS", 4)
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs, 2, 80).collect()) == _brute(rows, 2, 80)


def test_chains_at_and_below_the_threshold(spark):
    # Windows of 100 words, 99 shingles: 11 words on, 88 of 110 shingles are shared; 12 words on, 87 of 111.
    ids = list(range(5000))
    random.Random(4).shuffle(ids)
    rows = [(i, " ".join(f"{'ab'[at % 2]}{w}" for w in range(at // 2 * (11 + at % 2), at // 2 * (11 + at % 2) + 100)))
            for at, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 2, 80).collect()}
    assert {found[i] for i in ids[0::2]} == {min(ids[0::2])}
    assert all(found[i] == i for i in ids[1::2])


def test_drop_keeps_one_of_each_group(spark):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "other words here entirely now ok"), (9, "other words here entirely now ok"),
            (None, "a b c d e f"), (7, None), (8, "")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, kept int")
    got = neardup.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == [2, 7, 8, 9]       # the row without an id is a copy


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(docs).collect() == []
    assert neardup.drop_near_duplicates(docs).collect() == []


@pytest.mark.parametrize("hub", [0, 3, 1000])
def test_components(spark, monkeypatch, hub):
    monkeypatch.setattr(graph, "HUB", hub)
    rng = random.Random(5)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(3, 3), (None, 4)] + [(200, 300 + i) for i in range(40)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in label:
        for a, b in edges:
            if a is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


@pytest.mark.parametrize("hub", [0, 1000])
def test_the_plans_of_a_round_are_short(spark, monkeypatch, hub):
    exchanges = []

    def noted(df, name):
        exchanges.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return common.written(df, name)

    monkeypatch.setattr(graph, "HUB", hub)
    monkeypatch.setattr(graph, "written", noted)
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(0, 100 + i) for i in range(60)], "a long, b long")
    assert {r.component for r in graph.components(chain).collect()} == {0}
    assert max(exchanges) <= 8


def test_stars_need_no_round(spark, monkeypatch):
    names = []
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or common.written(df, name))
    stars = spark.createDataFrame([(1, i) for i in range(10, 20)] + [(20, 2), (21, 2), (2, 20)], "a long, b long")
    got = {r.id: r.component for r in graph.components(stars).collect()}
    assert got == {i: 1 if i < 20 and i != 2 else 2 for i in [1, 2, *range(10, 22)]}
    assert "stars" not in names


def test_a_hub_is_more_than_a_tasks_share():
    assert graph._hub_size(100, 8) == graph.HUB
    assert graph._hub_size(400_000, 200) == 4000 and graph._hub_size(10 ** 9, 10 ** 5) == 20_000
    assert graph._hub_size(10 ** 12, 10 ** 7) * graph.BROADCAST_BYTES >= 10 ** 12 * graph.ROW_BYTES


def test_needed_matches():
    rng = np.random.default_rng(1)
    for p, n in ((0.8, neardup.COORDS), (0.8 ** neardup.WIDTH, neardup.POSTED)):
        worst = min((rng.random((50_000, n)) < p).sum(axis=1))
        assert n / 5 <= neardup.matches_needed(p, n) <= worst


def test_word_hashes_tell_words_apart():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé0") for _ in range(rng.randrange(1, 9))) for _ in range(5000)})
    found, counts = common.word_hashes([" ".join(words), "", "  ", words[0].upper() if words[0].isascii() else words[0]])
    assert counts.tolist() == [len(words), 0, 0, 1] and len(set(found.tolist())) == len(words)
