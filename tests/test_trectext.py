"""TREC-text reader on hand-written files (the cases of FIXTURES.md §4)."""

import pytest
from conftest import write_files

from trawl.sources.trectext import read_records, read_trectext


def docs_of(spark, folder, **kw):
    docs, rejected = read_trectext(spark, folder, **kw)
    rows = sorted((r["docno"], r["head"], r["text"]) for r in docs.collect())
    return rows, rejected.collect()


def test_glued_lines_and_line_join(spark, tmp_path):
    folder = write_files(tmp_path / "c", {"a.txt": "<DOC>\n<DOCNO>d1</DOCNO>\n<TEXT>\nfoo bar\nbaz\n</TEXT>\n</DOC>\n"})
    rows, _ = docs_of(spark, folder)
    assert rows == [("d1", "", "foo barbaz")]
    rows, _ = docs_of(spark, folder, line_join=" ")
    assert rows == [("d1", "", "foo bar baz")]


def test_repeated_tag_joined_by_space_and_edges_trimmed(spark, tmp_path):
    body = "<DOC>\n<DOCNO>d1</DOCNO>\n<HEAD>one\t</HEAD>\n<HEAD> two </HEAD>\n<TEXT>t</TEXT>\n</DOC>\n"
    rows, _ = docs_of(spark, write_files(tmp_path / "c", {"a.txt": body}))
    assert rows == [("d1", "one two", "t")]


def test_empty_element(spark, tmp_path):
    body = "<DOC>\n<DOCNO>d1</DOCNO>\n<HEAD></HEAD>\n<TEXT>t</TEXT>\n</DOC>\n"
    rows, _ = docs_of(spark, write_files(tmp_path / "c", {"a.txt": body}))
    assert rows == [("d1", "", "t")]


def test_empty_element_runs_on_to_later_close(spark, tmp_path):
    body = "<DOC>\n<DOCNO>d1</DOCNO>\n<HEAD></HEAD>\n<TEXT>t</TEXT>\n<HEAD>x</HEAD>\n</DOC>\n"
    rows, _ = docs_of(spark, write_files(tmp_path / "c", {"a.txt": body}))
    assert rows == [("d1", "</HEAD><TEXT>t</TEXT><HEAD>x", "t")]


def test_trailing_junk_unfinished_record_and_blank_tail(spark, tmp_path):
    folder = write_files(tmp_path / "c", {
        "a.txt": ("<DOC>\n<DOCNO>d1</DOCNO>\n<TEXT>one</TEXT>\n</DOC> junk after close\n"
                  "<DOC>\n<DOCNO>d2</DOCNO>\n<TEXT>two</TEXT>\n</DOC>\n"
                  "<DOC>\n<DOCNO>d3</DOCNO>\n<TEXT>never closed</TEXT>\n"),
        "b.txt": "<DOC>\n<DOCNO>d4</DOCNO>\n<TEXT>four</TEXT>\n</DOC>\n\n\n",
    })
    rows, rejected = docs_of(spark, folder)
    assert rows == [("d1", "", "one"), ("d2", "", "two"), ("d4", "", "four")]
    assert len(rejected) == 1
    assert rejected[0]["path"].endswith("a.txt")
    assert "never closed" in rejected[0]["raw"]


def test_close_line_at_file_start_and_crlf(spark, tmp_path):
    folder = write_files(tmp_path / "c", {
        "a.txt": "<DOC>\r\n<DOCNO>d1</DOCNO>\r\n<TEXT>\r\nx\r\ny\r\n</TEXT>\r\n</DOC>\r\n"})
    rows, _ = docs_of(spark, folder, line_join=" ")
    assert rows == [("d1", "", "x y")]


def test_record_lines_drop_doc_open_lines(spark, tmp_path):
    folder = write_files(tmp_path / "c", {"a.txt": "<DOC> id=1\n<DOCNO>d1</DOCNO>\n</DOC>\n"})
    recs, _ = read_records(spark, folder)
    assert [r["record"] for r in recs.collect()] == ["<DOCNO>d1</DOCNO>"]


FILES = {
    "no_docno.txt": "<DOC>\n<DOCNO>d1</DOCNO>\n</DOC>\n<DOC>\n<HEAD>h</HEAD>\n</DOC>\n<DOC>\n<DOCNO>d2</DOCNO>\n</DOC>\n",
    "unfinished.txt": "<DOC>\n<DOCNO>d3</DOCNO>\n</DOC> junk\n<DOC>\n<DOCNO>d4</DOCNO>\nnever closed",
    "crlf.txt": "<DOC>\r\n<DOCNO>d5</DOCNO>\r\n<TEXT>\r\nx\r\ny\r\n</TEXT>\r\n</DOC>\r\n<DOC>\r\n<DOCNO>d6</DOCNO>\r\n</DOC>\r\n",
    "no_newline.txt": "<DOC>\n<DOCNO>d7</DOCNO>\n</DOC>\n<DOC>\n<DOCNO>d8 é</DOCNO>\n</DOC>",
    "blank_tail.txt": "<DOC>\n<DOCNO>d9</DOCNO>\n</DOC>\n \n\n",
    "only_tail.txt": "<DOC>\n<DOCNO>d10</DOCNO>\n",
    "many.txt": "".join(f"<DOC>\n<DOCNO>m{i}</DOCNO>\n<TEXT>{'word ' * (i % 50)}</TEXT>\n</DOC>\n" for i in range(400)),
}


def test_split_and_whole_give_the_same(spark, tmp_path):
    from trawl.sources.trectext import number_documents
    folder = write_files(tmp_path / "c", FILES)
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "700")                      # many splits in a file
    try:
        got = {}
        for mode in ("whole", "split"):
            records, rejected = read_records(spark, folder, mode=mode)
            docs, _ = read_trectext(spark, folder, mode=mode)
            name = lambda p: p.rsplit("/", 1)[1]
            got[mode] = (sorted((name(r.path), r.rec_pos, r.record) for r in records.collect()),
                         sorted((name(r.path), r.raw, r.reason) for r in rejected.collect()),
                         sorted((r.doc_id, r.docno, r.head, r.text) for r in number_documents(docs).collect()))
    finally:
        spark.conf.set(key, old)
    assert got["split"] == got["whole"]
    records, rejected, docs = got["split"]
    assert len(records) == 3 + 1 + 2 + 2 + 1 + 400 and [r[0] for r in rejected] == ["only_tail.txt", "unfinished.txt"]
    assert [d[0] for d in docs] == list(range(len(records)))


def test_other_encoding(spark, tmp_path):
    folder = tmp_path / "l1"
    folder.mkdir()
    (folder / "a.txt").write_bytes("<DOC>\n<DOCNO>d1</DOCNO>\n<TEXT>café naïve</TEXT>\n</DOC>\n".encode("latin-1"))
    rows, _ = docs_of(spark, str(folder), encoding="ISO-8859-1", mode="whole")
    assert rows == [("d1", "", "café naïve")]


def test_number_documents_dense_and_ordered(spark, tmp_path):
    from trawl.sources.trectext import number_documents
    folder = write_files(tmp_path / "c", {
        "a.txt": "".join(f"<DOC>\n<DOCNO>a{i}</DOCNO>\n<TEXT>x</TEXT>\n</DOC>\n" for i in range(3)),
        "b.txt": "".join(f"<DOC>\n<DOCNO>b{i}</DOCNO>\n<TEXT>y</TEXT>\n</DOC>\n" for i in range(2)),
    })
    docs, _ = read_trectext(spark, folder)
    got = sorted((r["doc_id"], r["docno"]) for r in number_documents(docs).collect())
    assert got == [(0, "a0"), (1, "a1"), (2, "a2"), (3, "b0"), (4, "b1")]


def _both_modes(spark, folder, **kw):
    got = {}
    for mode in ("whole", "split"):
        records, rejected = read_records(spark, folder, mode=mode, **kw)
        got[mode] = (sorted((r.path.rsplit("/", 1)[1], r.rec_pos, r.record) for r in records.collect()),
                     sorted((r.path.rsplit("/", 1)[1], r.raw, r.reason) for r in rejected.collect()))
    assert got["split"] == got["whole"]
    return got["split"]


def test_split_and_whole_read_other_charsets_and_line_ends(spark, tmp_path):
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "600")
    body = "".join(f"<DOC>\n<DOCNO>d{i}</DOCNO>\n<TEXT>caf\u00e9 \u00df {'\u00fc ' * (i % 40)}\nna\u00efve</TEXT>\n</DOC> rest\n" for i in range(120))
    try:
        for name, encoding, line_end, text in (("latin", "ISO-8859-1", "\n", body + "<DOC>\nopen \u00e9"),
                                               ("utf16", "UTF-16LE", "\n", body), ("utf16be", "UTF-16BE", "\r", body.replace("\n", "\r")),
                                               ("cr", "utf-8", "\r", body.replace("\n", "\r") + "<DOC>\ropen"),
                                               ("latin_cr", "ISO-8859-1", "\r", body.replace("\n", "\r")),
                                               ("crlf", "ISO-8859-1", "\n", body.replace("\n", "\r\n"))):
            folder = tmp_path / name
            folder.mkdir()
            (folder / "a.txt").write_bytes(text.encode(encoding))
            (folder / "b.txt").write_bytes(text[:300].encode(encoding))
            records, rejected = _both_modes(spark, str(folder), encoding=encoding, line_end=line_end)
            assert len(records) > 120 and "caf\u00e9" in records[0][2] and "</DOC>" not in "".join(r[2] for r in records)
            assert len(rejected) in (1, 2)
    finally:
        spark.conf.set(key, old)


def test_an_unreadable_file_is_one_reject(spark, tmp_path):
    import gzip
    folder = tmp_path / "c"
    folder.mkdir()
    good = "".join(f"<DOC>\n<DOCNO>g{i}</DOCNO>\n</DOC>\n" for i in range(5))
    (folder / "a.txt").write_text(good)
    (folder / "b.txt.gz").write_bytes(gzip.compress(good.replace("g", "z").encode()))
    (folder / "c.txt.gz").write_bytes(b"\x1f\x8b\x08\x00 this is no deflate stream" * 20)
    (folder / "empty.txt").write_bytes(b"")
    records, rejected = _both_modes(spark, str(folder))
    assert [r[0] for r in records] == ["a.txt"] * 5 + ["b.txt.gz"] * 5
    assert rejected == [("c.txt.gz", None, "nothing could be read of the file")]
    records, _ = read_records(spark, str(folder), unreadable="fail")
    with pytest.raises(Exception):
        records.collect()
    # A file that breaks off: what came before is kept, the open record is the reject.
    (folder / "c.txt.gz").unlink()
    import random
    text = "".join(f"<DOC>\n<DOCNO>t{i}</DOCNO>\n<TEXT>{random.Random(i).random()}</TEXT>\n</DOC>\n" for i in range(20_000))
    (folder / "d.txt.gz").write_bytes(gzip.compress(text.encode())[:-60_000])
    records, rejected = read_records(spark, str(folder))
    assert records.where("path like '%/d.txt.gz'").count() > 1000
    assert [r.path.rsplit("/", 1)[1] for r in rejected.collect()] == ["d.txt.gz"]


def test_merge_joins_give_the_same_records(spark, tmp_path, monkeypatch):
    from trawl.sources import trectext
    folder = write_files(tmp_path / "c", FILES)

    def read():
        docs, rejected = read_trectext(spark, folder)
        return (sorted((r.doc_id, r.docno, r.rec_pos) for r in trectext.number_documents(docs).collect()),
                sorted((r.path, r.raw, r.reason) for r in rejected.collect()))
    want = read()
    monkeypatch.setattr(trectext, "BROADCAST_ROWS", 0)
    assert read() == want
    docs, _ = read_trectext(spark, folder)
    assert "SortMergeJoin" in docs._jdf.queryExecution().executedPlan().toString()
