"""The registered queries of the operators: contracts and SQL oracles on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest
from trawl.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
            "base_sha256": "string", "spans": "string"},
    "op4": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
            "formatted_chars": "bigint"},
    "op5": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op7": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op8": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op9": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op11": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"},
    "op12": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op13": {"doc_id": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint", "rank": "bigint"},
}


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_columns_and_rows(spark, key):
    df = QUERIES[key](spark, SF)
    types = dict(df.dtypes)
    want = COLUMNS.get(key.split("_")[0], {})
    assert {c: types.get(c) for c in want} == want
    rows = [tuple(r) for r in df.collect()]
    per_row = {"op1": "documents", "op3": "documents", "op5": "documents", "op6": "documents", "op7": "pages", "op9": "documents",
               "op12": "documents", "op13": "documents"}
    if (table := per_row.get(key.split("_")[0])):
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if key in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        want = con.execute(ORACLES[key]).fetchall()
        names = [d[0] for d in con.description]
        assert sorted(names) == sorted(df.columns) and digest(df.columns, rows) == digest(names, want)
