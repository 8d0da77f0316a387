"""The queries of the problems on the test tables, those with SQL against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from leafmill.llm import queries

COLUMNS = {
    "p1_found": [("page_id", "bigint"), ("segment_no", "bigint"), ("lang", "string")], "p2_found": [("id_a", "bigint"), ("id_b", "bigint")], "p3_found": [("page_id", "bigint"), ("line_no", "bigint"), ("kind", "string")],
    "p4_found": [("page_id", "bigint"), ("line_no", "bigint")], "p5_found": [("page_id", "bigint"), ("forced", "bigint")], "p6_found": [("page_id_a", "bigint"), ("page_id_b", "bigint")], "p7_found": [("page_id", "bigint")],
    "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p10_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    rows = df.collect()
    if name not in queries.SQL:
        return
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(queries.SQL[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert sorted(df.columns) == order
    assert sorted((repr(tuple(r[c] for c in order)) for r in rows)) == sorted(repr(tuple(r[columns.index(c)] for c in order)) for r in result.fetchall())
