"""Analyzers and text helpers."""

from pyspark.sql import functions as F

from trawl.functions.analyzers import analyze
from trawl.functions.text import extract_tag, java_trim


def run(spark, text, name):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(analyze("t", name).alias("a")).first()["a"]


def test_standard(spark):
    text = "The U.S. economy grew 3.14% in 1,000 days; O'Neill's e_mail: foo,bar x;y"
    assert run(spark, text, "standard") == [
        "u.s", "economy", "grew", "3.14", "1,000", "days", "o'neill's", "e_mail", "foo", "bar", "x", "y"]


def test_standard_joins_by_class(spark):
    assert run(spark, "foo,bar x;y 1,000 12:30 wi-fi u.s a.1 1.a b_.c cafe\u0301's x:y", "standard") == [
        "foo", "bar", "x", "y", "1,000", "12", "30", "wi", "fi", "u.s", "1", "1", "b_", "c", "cafe\u0301's", "x:y"]


def test_standard_tokens_match_the_two_step_sql(spark):
    import duckdb
    from trawl.plans.oracle import tokens
    texts = ["foo,bar x;y 1,000 12:30 wi-fi u.s.a. a.1 1.a 1.2.3 b_.c _.x", "cafe\u0301's O’Neill l·l 3,14;15 a..b a.\ue000b", "'a' .b. c:d:e"]
    for t in texts:
        [want] = duckdb.execute(f"SELECT {tokens('t')} FROM (SELECT ? AS t)", [t]).fetchone()
        assert run(spark, t, "standard") == want


def test_simple_stop_keyword(spark):
    text = "The Fox's 2 dogs and THE cat"
    assert run(spark, text, "simple") == ["the", "fox", "s", "dogs", "and", "the", "cat"]
    assert run(spark, text, "stop") == ["fox", "s", "dogs", "cat"]
    assert run(spark, text, "keyword") == [text]


def test_long_tokens_stay_unless_a_limit_is_asked_for(spark):
    from trawl.functions.analyzers import standard
    assert [len(t) for t in run(spark, "c" * 3000, "simple")] == [3000]
    assert [len(t) for t in run(spark, "b" * 256 + " ok", "standard")] == [256, 2]
    df = spark.createDataFrame([("b" * 256 + " ok",)], "t string")
    assert df.select(standard(F.col("t"), max_token_len=255).alias("a")).first()["a"] == ["ok"]


def test_null_text_gives_no_tokens(spark):
    df = spark.createDataFrame([(None,)], "t string")
    for name in ("standard", "keyword", "simple", "stop"):
        assert df.select(analyze("t", name).alias("a")).first()["a"] == []


def test_java_trim_and_tags(spark):
    df = spark.createDataFrame([("\t\n x  \t", "<P>a\nb</p><p> c </p><p></p>", "x")],
                               "a string, h string, w string")
    r = df.select(java_trim(F.col("a")).alias("a"), extract_tag(F.col("h"), "p").alias("p")).first()
    assert r["a"] == "x  "  # only characters <= U+0020 are trimmed
    assert r["p"] == "a\nb c"


SCRIPTS = [
    ("漢字とカタカナ", ["漢", "字", "と", "カタカナ"]),
    ("東京タワーへ行く", ["東", "京", "タワー", "へ", "行", "く"]),
    ("ﾊﾝｶｸ全角ＡＢ１２", ["ﾊﾝｶｸ", "全", "角", "ａｂ１２"]),
    ("日本word語99", ["日", "本", "word", "語", "99"]),
    ("ภาษาไทย thai", ["ภาษาไทย", "thai"]),
    ("abcไทย", ["abc", "ไทย"]),
    ("한국어 텍스트", ["한국어", "텍스트"]),
    ("soft­ware co‍op", ["soft­ware", "co‍op"]),
    ("zero​width", ["zero", "width"]),
    ("かo\u3099\u30acb", ["か", "o\u3099", "\u30ac", "b"]),
    ("カタ_カナ_x ___ _y_", ["カタ_カナ_x", "_y_"]),
    ("can't 3.14 a.1 1,000.5 x:y e.g. ’tis", ["can't", "3.14", "1", "1,000.5", "x:y", "e.g", "tis"]),
    ("צה\"ל שלום", ["צה\"ל", "שלום"]),
    ("x² ½ Ⅷ", ["x", "ⅷ"]),
    ("́lone mark", ["lone", "mark"]),
    ("\U00020000\U00020001b", ["\U00020000", "\U00020001", "b"]),
    ("カ.カ 漢.漢", ["カ", "カ", "漢", "漢"]),
]


def test_standard_of_other_scripts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(SCRIPTS)], "i int, t string")
    got = {r.i: r.x for r in df.select("i", analyze("t", "standard").alias("x")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(SCRIPTS)}


def test_other_scripts_match_the_sql(spark):
    import duckdb
    from trawl.plans.oracle import tokens
    for t, want in SCRIPTS:
        if '"' not in t:                                   # gershayim are not in the SQL
            assert duckdb.execute(f"SELECT {tokens('t')} FROM (SELECT ? AS t)", [t]).fetchone() == (want,)


def test_standard_tokens_of_any_length(spark):
    long = ["a" * 300_000, "a." * 100_000 + "a", "カ" * 200_000, "_a" * 100_000, "ก" * 200_000, "a1" * 150_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(long)], "i int, t string")
    assert [r.x for r in df.select("i", analyze("t", "standard").alias("x")).orderBy("i").collect()] == [[t] for t in long]
