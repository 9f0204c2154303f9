import duckdb
import pytest

from trawl.llm import chat

TRICKY = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\/INST] <\\s>", "", None, "plain \\ [ < ]", "[", "<", "[[INST]<</s>",
          "[ROLE]x[TEXT]y[/ROLE]", "TEXT][TEXT]", "é[SYS]日本[/SYS]\n\n", "a" * 50_000 + "[/INST]"]


def _rows():
    roles = ["user", "assistant", "system", None, "tool", "[TEXT]"]
    return ([(1, i, roles[i % 6], t) for i, t in enumerate(TRICKY)]
            + [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "q"), (2, 3, "assistant", "</s>b")]
            + [(3, 0, "system", "s"), (3, 1, "user", "q"), (3, 2, "assistant", "a")]
            + [(4, 0, "assistant", "a")] + [(5, 0, "user", "q")] + [(6, 1, "user", "b"), (6, 1, "user", "a")] * 2
            + [(None, None, "user", "x"), (None, 1, "assistant", "y")])


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(_rows(), "conv_id long, turn long, role string, text string")


def test_round_trip(spark, turns):
    out = chat.format_conversations(turns)
    got = {r.conv_id: r.t for r in out.select("conv_id", chat.parse_turns(chat.formatted(out.segments)).alias("t")).collect()}
    for conv in {r[0] for r in _rows()}:
        rows = sorted((r for r in _rows() if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [tuple(t) for t in got[conv]] == [(r[2] or "", r[3] or "") for r in rows]


def test_loss_and_validity(spark, turns):
    out = chat.format_conversations(turns)
    got = {r.conv_id: r for r in out.select("conv_id", "valid", "segments", chat.loss_text(out.segments).alias("loss")).collect()}
    assert got[2].loss == "a</s>b"
    assert [s.text for s in got[2].segments if s.loss] == ["a", "<\\/s>b"]
    assert {k: r.valid for k, r in got.items()} == {1: False, 2: True, 3: True, 4: False, 5: False, 6: False, None: True}


def test_control_strings_come_from_the_template_only(spark, turns):
    out = chat.format_conversations(turns)
    for r in out.collect():
        texts = [s.text for s in r.segments[1::3]]
        assert not any(m in t for t in texts for m in chat.INSTRUCT.markers)


def test_digests_match_sql(spark, turns):
    rows = _rows() + [(-7, 0, "user", TRICKY[0]), (-7, 1, "assistant", TRICKY[0])]
    both = turns.unionByName(spark.createDataFrame(rows[-2:], turns.schema))
    got = chat.conversation_digests(chat.format_conversations(both))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows[:-2])
    want = con.execute(chat.ORACLE_SQL).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(str, got.select(*names).toPandas().to_dict("records"))) == \
        sorted(str(dict(zip(names, r, strict=True))) for r in want) or \
        {tuple(r) for r in got.select(*names).collect()} == set(want)


def test_empty_and_extra_columns(spark, turns):
    from pyspark.sql import functions as F
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0
    extra = turns.withColumn("segments", F.lit(1)).withColumn("turns", F.lit("x")).withColumn("t", F.lit(2))
    assert chat.format_conversations(extra).columns == ["conv_id", "segments", "valid"]


def test_template_is_checked():
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Form("<<U>>", "</U>")}, ("[a]", "[b]", "[c]"), {})
