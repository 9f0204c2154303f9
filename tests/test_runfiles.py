"""Run-file sinks: layout on disk and read-back."""

import glob
import os

from trawl.sources.runfiles import (MODELS_HEADER_LINE, read_models_run, read_tfidf_run,
                                    write_models_run, write_tfidf_run)

ROWS = [(51, "Q0", "d7", 1, 12.5, "myAlgo_short"), (51, "Q0", "d3", 2, 1.0e-5, "myAlgo_short"),
        (52, "Q1", "d1", 1, 3.25, "myAlgo_long")]


def run_df(spark):
    return spark.createDataFrame(ROWS, "query_id int, q string, docno string, rank int, score double, run_id string")


def first_lines(folder):
    files = sorted(glob.glob(os.path.join(folder, "_run=*", "part-*")))
    out = {}
    for f in files:
        with open(f) as fh:
            lines = fh.read().splitlines()
        if lines:
            out.setdefault(os.path.basename(os.path.dirname(f)), []).extend(lines)
    return out


def test_tfidf_run_file(spark, tmp_path):
    path = write_tfidf_run(run_df(spark), str(tmp_path / "r"))
    files = first_lines(path)
    assert set(files) == {"_run=myAlgo_short", "_run=myAlgo_long"}
    assert files["_run=myAlgo_long"] == ["QueryId\tQ\tDocID\tRank\tScore\tRunID", "52\tQ1\td1\t1\t3.25\tmyAlgo_long"]
    assert sorted(tuple(r) for r in read_tfidf_run(spark, path).collect()) == sorted(ROWS)


def test_parts_in_name_order_are_the_run_file(spark, tmp_path):
    rows = [(q, "Q0", f"d{r}", r, 100.0 / r, f"m{m}_short") for m in range(3) for q in range(40) for r in range(1, 30)]
    run = spark.createDataFrame(rows, "query_id int, q string, docno string, rank int, score double, run_id string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = first_lines(write_tfidf_run(run, str(tmp_path / "r")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for m in range(3):
        want = ["\t".join(map(str, r)) for r in sorted((r for r in rows if r[-1] == f"m{m}_short"), key=lambda r: (r[0], r[3]))]
        assert files[f"_run=m{m}_short"] == ["QueryId\tQ\tDocID\tRank\tScore\tRunID", *want]


def test_models_run_file(spark, tmp_path):
    path = write_models_run(run_df(spark), str(tmp_path / "m"))
    files = first_lines(path)
    assert files["_run=myAlgo_long"] == [MODELS_HEADER_LINE, "52\t\tQ1\t\td1\t\t1\t\t3.25\t\tmyAlgo_long"]
    assert sorted(tuple(r) for r in read_models_run(spark, path).collect()) == sorted(ROWS)
