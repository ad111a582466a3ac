from __future__ import annotations

import shutil

import duckdb

from depthloom.streaming import incremental


def test_windowed_counts_of_events(spark, sf_dir, tmp_path):
    (tmp_path / "in").mkdir()
    shutil.copy(f"{sf_dir}/events.parquet", tmp_path / "in" / "events.parquet")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    counts = incremental.windowed_counts(stream, "ts", "1 day", "1 hour", ["event_type"])
    query = counts.writeStream.outputMode("complete").format("memory").queryName("event_days").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.start.date(), r.event_type): r.n for r in spark.sql("SELECT window.start AS start, event_type, n FROM event_days").collect()}
    want = duckdb.sql(f"SELECT CAST(ts AS DATE), event_type, count(*) FROM read_parquet('{sf_dir}/events.parquet') GROUP BY ALL").fetchall()
    assert got == {(d, e): n for d, e, n in want}
