"""Streams run to their end against the same aggregation in one go; rows that come too late."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillcast.streaming import events as streams

T = dt.datetime
SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def _files(spark, folder, batches):
    """One file per batch, read in this order."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_finished_stream_equals_the_batch(spark, tmp_path):
    draw = random.Random(3)
    rows = [(k, T(2024, 1, 1) + dt.timedelta(minutes=draw.randrange(6000)), draw.randrange(4), draw.choice("ab"), draw.randint(0, 99) / 4) for k in range(300)]
    folder = _files(spark, str(tmp_path / "events"), [rows[:100], rows[100:200], rows[200:]])
    stream = streams.event_stream(spark, folder, SCHEMA, files_per_batch=1)
    got, late = streams.run_to_end(streams.daily_totals(stream, ["event_type"], "30 days"), ["event_type", "day"])
    want = {}
    for _, ts, _, kind, value in rows:
        n, total = want.get((kind, ts.date()), (0, 0.0))
        want[kind, ts.date()] = (n + 1, total + value)
    assert late == 0 and {(r.event_type, r.day): (r.n, r.value) for r in got.collect()} == want
    baskets, _ = streams.run_to_end(streams.sessions(stream, "user_id", "30 minutes", "30 days"), ["user_id", "start"], "complete")
    batch = spark.createDataFrame(rows, SCHEMA).groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, baskets.select("user_id", "start", "end", "n").collect())) == sorted(map(tuple, batch.select("user_id", "w.start", "w.end", "n").collect()))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    batches = [[(1, T(2024, 1, 10, 12), 1, "a", 1.0)], [(2, T(2024, 1, 20, 12), 1, "a", 2.0)],
               [(5, T(2024, 1, 20, 13), 1, "b", 3.0)],  # a batch drops by what was known when the one before it began
               [(3, T(2024, 1, 10, 13), 1, "a", 4.0), (4, T(2024, 1, 19, 1), 1, "a", 8.0)]]
    folder = _files(spark, str(tmp_path / "events"), batches)
    stream = streams.event_stream(spark, folder, SCHEMA, files_per_batch=1)
    got, late = streams.run_to_end(streams.daily_totals(stream, ["event_type"], "2 days"), ["event_type", "day"])
    assert late == 1  # ten days behind the newest row; the one of the 19th still counts
    assert {r.day.day: (r.n, r.value) for r in got.where("event_type = 'a'").collect()} == {10: (1, 1.0), 19: (1, 8.0), 20: (1, 2.0)}
