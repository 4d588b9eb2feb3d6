"""Queries that run a stream over the events until it is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillcast.plans.registry import query
from tillcast.streaming import events as streams


def _stream(src):
    return streams.event_stream(src.spark, f"{src.folder}/events.parquet", src.table("events").schema)


@query("stream_daily_sales", """
SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(round(value * 10000) AS BIGINT)) AS DOUBLE) / 10000 AS value
FROM events GROUP BY ALL""")
def stream_daily_sales(src):
    return streams.run_to_end(streams.daily_totals(_stream(src), ["event_type"], "3650 days"), ["event_type", "day"])[0]


@query("stream_baskets", """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events),
     g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM e)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM g GROUP BY user_id, nth""")
def stream_baskets(src):
    known = _stream(src).where(F.col("user_id").isNotNull())
    out = streams.run_to_end(streams.sessions(known, "user_id", late="3650 days"), ["user_id", "start"], "complete")[0]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
