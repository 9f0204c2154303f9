import random
import re

import duckdb

from trawl.llm import decontam

RNG = random.Random(11)
VOCAB = [f"w{i}" for i in range(400)]


def _text(n):
    return " ".join(RNG.choice(VOCAB) for _ in range(n))


def _tables():
    items = [(i, _text(RNG.choice([2, 4, 5, 9, 20, 57, 130, 700]))) for i in range(30)] + [(50, ""), (51, None), (52, "?!"), (None, _text(12)), (53, "Solo")]
    items += [items[9], items[9], (54, items[4][1].upper())]                  # repeated items, one set with two ids
    docs = []
    for d in range(80):
        words = _text(RNG.choice([0, 3, 50, 3000])).split()
        for _ in range(RNG.choice([0, 1, 2])):
            item = (RNG.choice(items[:30])[1]).split()
            if RNG.random() < 0.5:
                item = [w.upper() + RNG.choice(["", ",", "!"]) for w in item]
            if RNG.random() < 0.4 and len(item) > 8:                        # a part, or an altered copy
                item = item[: int(len(item) * RNG.choice([0.5, 0.75, 0.9]))]
            at = RNG.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((d, "  ".join(words)))
    docs += [(200, None), (201, ""), (None, items[3][1]), (7, items[5][1]), (7, items[5][1]), (202, "solo")]
    return items, docs


def _brute(items, docs, percent=80):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def grams(w, m):
        return {tuple(w[k:k + m]) for k in range(len(w) - m + 1)}

    out = []
    for d, t in docs:
        if t is None:
            continue
        w = words(t)
        for i, x in items:
            v = words(x)
            if v:
                own = grams(v, min(5, len(v)))
                n = len(own & grams(w, min(5, len(v))))
                if 100 * n >= percent * len(own):
                    out.append((d, i, n, len(own), n / len(own)))
    return sorted(out, key=str)


def test_matches_brute_force_and_sql(spark, monkeypatch):
    items, docs = _tables()
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, item_id string, shared int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _brute(items, docs)
    assert len(want) > 30
    assert sorted((tuple(r) for r in decontam.contaminated(frame, bench).collect()), key=str) == want
    monkeypatch.setattr(decontam, "INDEX_BYTES", 0)                          # the shuffle join
    assert sorted((tuple(r) for r in decontam.contaminated(frame, bench).collect()), key=str) == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.execute(decontam.ORACLE_SQL).fetchall(), key=str) == want


def test_common_passage_by_both_ways(spark, monkeypatch):
    """A passage in most documents, in very long ones too, and texts that repeat."""
    item = _text(80)
    docs = [(d, f"{_text(6)} {item} {_text(d % 7)}") for d in range(120)] + [(d, f"copy {item}") for d in range(120, 200)]
    docs += [(200, f"{_text(150_000)} {item} {_text(1_000)}"), (None, f"copy {item}"), (201, _text(90)), (202, " ".join(item.split()[:70])), (203, " ".join(item.split()[:60]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, _text(40))], "item_id long, text string")
    want = _brute([(1, item)], docs)
    assert len(want) == 203
    for limit in (decontam.INDEX_BYTES, 0):
        monkeypatch.setattr(decontam, "INDEX_BYTES", limit)
        assert sorted((tuple(r) for r in decontam.contaminated(frame, bench).collect()), key=str) == want
        assert sorted(r.doc_id for r in decontam.clean(frame, bench).collect()) == [201, 203]


def test_documents_are_scanned_once(spark, monkeypatch):
    """However many items there are, the last plan reads the documents once."""
    docs, bench = (spark.createDataFrame([(i, _text(30)) for i in range(40)], f"{c} long, text string") for c in ("doc_id", "item_id"))
    for limit, scans in ((decontam.INDEX_BYTES, 1), (0, 1)):
        monkeypatch.setattr(decontam, "INDEX_BYTES", limit)
        plan = decontam.contaminated(docs, bench)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == scans


def test_empty_tables(spark, monkeypatch):
    docs, items = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    full = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    for limit in (decontam.INDEX_BYTES, -1):
        monkeypatch.setattr(decontam, "INDEX_BYTES", limit)
        assert decontam.contaminated(docs, items).collect() == decontam.contaminated(full, items).collect() == []
        assert decontam.contaminated(docs, full.withColumnRenamed("doc_id", "item_id")).collect() == []
