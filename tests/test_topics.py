"""Topic-file reader."""

from conftest import write_files

from trawl.sources.topics import read_topics, to_topic_blocks

TOPICS = """<top>

<head> Tipster Topic Description
<num> Number: 051
<dom> Domain: International Economics

<title> Topic:  Airbus Subsidies

<desc> Description:
Document will discuss government assistance

to Airbus Industrie.

<smry> Summary:
</top>

<top>
<num> Number: 052 <dom> Domain: x
<title> Topic: South African Sanctions
<desc> Description: sanctions
<smry> Summary:
</top>
<top>
<num> Number: 053
<title> Topic: unfinished
"""


def test_topics_parse(spark, tmp_path):
    folder = write_files(tmp_path / "t", {"topics.51-100": TOPICS})
    topics, rejected = read_topics(spark, folder)
    rows = sorted(tuple(r) for r in topics.collect())
    assert rows == [
        (51, "Airbus Subsidies", "Document will discuss government assistance to Airbus Industrie."),
        (52, "South African Sanctions", "sanctions"),
    ]
    assert rejected.count() == 0


def test_bad_number_goes_to_reject(spark, tmp_path):
    body = "<top>\n<num> Number: 05x\n<dom> d\n<title> Topic: a\n<desc> Description: b\n<smry>\n</top>\n"
    topics, rejected = read_topics(spark, write_files(tmp_path / "t", {"t.txt": body}))
    assert topics.count() == 0
    assert "05x" in rejected.first()["reason"]


def test_written_blocks_parse_back(spark, tmp_path):
    src = spark.createDataFrame([(7, "a b c", "line one\n\nline two")], "query_id int, title string, desc string")
    folder = str(tmp_path / "w")
    to_topic_blocks(src).write.text(folder)
    topics, _ = read_topics(spark, folder)
    assert [tuple(r) for r in topics.collect()] == [(7, "a b c", "line one line two")]
