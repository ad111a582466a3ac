"""The jobs against their SQL, over growing input, after a break, and from the command line."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from depthloom.operators import chain
from jobs import common, package_audit, queries, scene_chains

ROOT = Path(__file__).resolve().parents[1]
EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def said(folder, sql):
    con = duckdb.connect()
    for name in ("documents", "labels", "events"):
        at = Path(f"{folder}/{name}.parquet")
        if at.exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{at}{'/*.parquet' if at.is_dir() else ''}')")
    out = con.sql(sql)
    return out.columns, sorted(tuple(map(str, r)) for r in out.fetchall())


def rows(df, columns):
    return sorted(tuple(map(str, r)) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(queries.queries()))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_jobs(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    before = spark.conf.getAll
    df = queries.queries()[name](spark, folder)
    columns, expected = said(folder, queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(columns) and rows(df, columns) == expected and len(expected) >= 200
    assert before == spark.conf.getAll
    assert not spark.streams.active


@pytest.fixture
def package(spark, tmp_path):
    long = "word " * 400
    docs = [(1, long, "en", "a", len(long)), (2, long, "en", "a", len(long)), (3, long + "x", "en", "a", 7), (4, "few words", "en", "a", 9), (5, None, "en", "a", None), (6, " \t\n", "en", "b", 3), (7, "été à", "fr", None, 5), (7, "été à", "fr", None, 5), (8, long, "en", None, None), (9, "", None, "b", 0), (None, "no id", "en", "a", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (5, 1, 1), (99, 0, 0), (99, 0, 0), (None, 1, 1)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    return tmp_path


def _audit(folder):
    return package_audit.Params(f"{folder}/documents.parquet", f"{folder}/labels.parquet", f"{folder}/out")


def test_audit_findings(spark, package):
    got = {r.item: r for r in package_audit.run(spark, _audit(package)).collect()}
    assert {k: r.issue for k, r in got.items()} == {1: "ok", 2: "copy", 3: "size", 4: "low_count", 5: "no_text", 6: "empty", 7: "low_count", 8: "copy", 9: "empty", 99: "missing"}
    assert [r.first_copy for r in (got[1], got[2], got[8], got[7])] == [1, 1, 1, None] and got[99].words is None and got[5].labelled and not got[4].labelled
    columns, expected = said(package, package_audit.SQL)
    assert rows(spark.read.schema(spark.read.parquet(f"{package}/out/manifest").schema).parquet(f"{package}/out/manifest"), columns) == expected
    report = [json.loads(x) for f in sorted(Path(f"{package}/out/report").glob("*.json")) for x in f.read_text().splitlines()]
    assert sum(r["items"] for r in report) == 10 and {r["issue"] for r in report if r.get("source") == "a"} == {"ok", "copy", "size", "low_count", "no_text"}


def test_audit_reruns_and_follows_its_input(spark, package):
    p = _audit(package)
    first = rows(package_audit.run(spark, p), package_audit.COLUMNS)
    assert rows(package_audit.run(spark, p), package_audit.COLUMNS) == first
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality long, toxic long").write.mode("append").parquet(p.labels)
    spark.createDataFrame([(30, "new here", "en", "c", 8)], "doc_id long, text string, lang string, source string, n_chars long").write.mode("append").parquet(p.documents)
    again = package_audit.run(spark, p)
    assert len(rows(again, package_audit.COLUMNS)) == len(first) + 1 and {r.item for r in again.where("labelled").collect()} == {1, 4, 5, 99}
    assert Path(f"{p.out}/manifest/source=c").is_dir()


def test_audit_of_empty_tables(spark, package, tmp_path):
    for name in ("documents", "labels"):
        df = spark.read.parquet(f"{package}/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert package_audit.run(spark, _audit(f"{tmp_path}/none")).collect() == []


def _events(ids, users=3, days=4):
    return [(i, f"2024-01-0{1 + i % days} 0{i % 7}:{i % 60:02d}:00", i % users, "view", float(i), None) for i in ids]


def _drop(spark, folder, number, events):
    stamped = spark.createDataFrame(events, EVENT.replace("timestamp_ntz", "string")).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    stamped.coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def _intake(folder):
    return scene_chains.Params(f"{folder}/events.parquet", f"{folder}/out", f"{folder}/checkpoint")


def _batches(folder):
    return sorted(int(f.name) for f in Path(f"{folder}/checkpoint/commits").iterdir() if f.name.isdigit())


def test_intake_of_growing_input(spark, tmp_path):
    p = _intake(tmp_path)
    _drop(spark, tmp_path, 0, _events(range(60)))
    scene_chains.run(spark, p)
    files = {f: f.stat().st_mtime_ns for f in Path(p.out).rglob("*.parquet")}
    assert _batches(tmp_path) == [0]
    scene_chains.run(spark, p)  # nothing new: no batch, no file written
    assert _batches(tmp_path) == [0] and {f: f.stat().st_mtime_ns for f in Path(p.out).rglob("*.parquet")} == files
    # late frames of one day, one of them known (with another value), and frames of a new user
    late = [(4, "2024-01-01 04:04:00", 1, "click", -1.0, None), (400, "2024-01-01 00:00:30", 1, "view", 1.0, None), (401, "2024-01-01 09:00:00", 8, "view", 1.0, None)]
    _drop(spark, tmp_path, 1, late)
    out = scene_chains.run(spark, p)
    assert _batches(tmp_path) == [0, 1]
    touched = {f.parent.name for f in Path(p.out).rglob("*.parquet") if files.get(f) != f.stat().st_mtime_ns}
    assert touched == {"day=2024-01-01"}  # other days are as they were
    columns, expected = said(tmp_path, scene_chains.SQL.replace("FROM events WHERE", "FROM events WHERE NOT (event_id = 4 AND event_type = 'view') AND"))
    assert rows(out, columns) == expected and len(expected) == 62
    assert {r.value for r in out.where("event_id = 4").collect()} == {-1.0}


def test_intake_of_a_batch_that_ran_before(spark, tmp_path):
    """A lost commit makes the same batch run again: the frames take their own places."""
    p = _intake(tmp_path)
    _drop(spark, tmp_path, 0, _events(range(40)))
    once = rows(scene_chains.run(spark, p), scene_chains.KNOWN + ["prev", "next", "nbr_samples"])
    for name in ("0", ".0.crc"):
        Path(f"{tmp_path}/checkpoint/commits/{name}").unlink(missing_ok=True)
    assert rows(scene_chains.run(spark, p), scene_chains.KNOWN + ["prev", "next", "nbr_samples"]) == once
    assert _batches(tmp_path) == [0]


def test_intake_of_broken_rows_and_of_nothing(spark, tmp_path):
    p = _intake(tmp_path)
    _drop(spark, tmp_path, 0, [])
    assert scene_chains.run(spark, p).collect() == []
    _drop(spark, tmp_path, 1, [(None, "2024-01-01 00:00:00", 1, "view", 1.0, None), (1, None, 1, "view", 1.0, None), (2, "2024-01-01 00:00:00", None, "view", 1.0, None), (3, "2024-01-01 00:00:00", 1, None, None, None), (3, "2024-01-01 00:00:00", 1, "view", None, None)])
    got = scene_chains.run(spark, p).collect()
    assert [(r.event_id, r.kind, r.prev, r.next, r.nbr_samples) for r in got] == [(3, "view", "EOF", "EOF", 1)]


@pytest.mark.parametrize("chars", [10, 13, 16, 26])
def test_chains_by_slices_equal_whole_ones(spark, chars):
    frames = scene_chains.frames(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).persist()
    got = rows(scene_chains.linked(frames, chars), ["token", "prev", "next"])
    assert got == rows(chain.linked(frames, "scene", ["taken_at", "token"]), ["token", "prev", "next"])


def test_configuration(tmp_path):
    file = tmp_path / "c.json"
    file.write_text('{"low_share": 0.2, "out": "a"}')
    got = common.configured(package_audit.Params, str(file), {"out": "b", "salts": None})
    assert (got.low_share, got.out, got.salts) == (0.2, "b", 32)
    file.write_text('{"lowshare": 1}')
    with pytest.raises(ValueError, match="lowshare"):
        common.configured(package_audit.Params, str(file), {})
    for name, kind in (("package_audit", package_audit.Params), ("scene_chains", scene_chains.Params)):
        common.configured(kind, f"{ROOT}/jobs/{name}.json", {})


def test_command_line(spark, package):
    got = subprocess.run([sys.executable, f"{ROOT}/jobs/package_audit.py", "--config", f"{ROOT}/jobs/package_audit.json", "--documents", f"{package}/documents.parquet", "--labels", f"{package}/labels.parquet", "--out", f"{package}/by-hand"], capture_output=True, text=True, timeout=300, check=True)
    assert "wrote 10 manifest rows" in got.stderr and spark.read.parquet(f"{package}/by-hand/manifest").count() == 10
