"""Corpus queries against their DuckDB statements, on the driver's tables and on awkward documents."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from depthloom.llm import queries as llm

NAMES = sorted(llm.oracle_sql())


def same(spark, folder, name):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}{'/*.parquet' if file.is_dir() else ''}')")
    df = llm.queries()[name](spark, str(folder))
    said = con.sql(llm.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(said.columns)
    at = [said.columns.index(c) for c in columns]
    got = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    assert got == sorted(tuple(str(r[i]) for i in at) for r in said.fetchall())
    return got


@pytest.mark.parametrize("name", NAMES)
def test_driver_tables(spark, sf_dir, name):
    assert len(same(spark, sf_dir, name)) == 200


@pytest.fixture(scope="module")
def awkward(spark, docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    docs.write.parquet(f"{folder}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [(1, text[4][:400]), (2, "One"), (3, None), (4, ""), (5, text[9]), (5, text[9]), (None, text[12]), (6, text[11][:30])]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_awkward_documents(spark, awkward, name):
    assert len(same(spark, awkward, name)) == 60


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, empty, tmp_path, name):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert same(spark, tmp_path, name) == []


def test_line_templates_of_rows_that_share_ids(spark, odd, tmp_path):
    """Null and repeated doc_ids: each row loses its own recurring lines in SQL too."""
    common = "all rights are reserved here"
    rows = [(None, f"{common}\nclean apples"), (None, f"plums stay clean too\n{common}"), (None, "nothing of it in this one line"), (7, f"{common}\na"), (7, f"b\n{common}"), (7, f"b\n{common}"), (8, common)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert len(same(spark, tmp_path, "op6_line_templates")) == df.count()
