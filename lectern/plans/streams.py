"""Queries: streams run over all of ``events``, held against batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.plans.queueing import LADDER_SQL, attempts
from lectern.plans.registry import query
from lectern.streaming import streams


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*)::BIGINT AS n, max(value) AS top FROM events GROUP BY 1, 2")
def stream_tumbling(spark, sf):
    made = streams.run_once(streams.tumbling(streams.file_events(spark, sf, "events.parquet"), "1 day", "1 hour"), "tumbling")
    return made.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", "top")


@query("""
WITH w AS (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 12 HOURS, date_trunc('day', ts) + INTERVAL 12 HOURS]) AS s, ts, event_type, value FROM events)
SELECT strftime(s, '%Y-%m-%d %H') AS start, event_type, count(*)::BIGINT AS n, max(value) AS top FROM w WHERE ts >= s AND ts < s + INTERVAL 24 HOURS GROUP BY 1, 2""")
def stream_sliding(spark, sf):
    made = streams.run_once(streams.tumbling(streams.file_events(spark, sf, "events.parquet"), "24 hours", "1 hour", "12 hours"), "sliding")
    return made.select(F.date_format("start", "yyyy-MM-dd HH").alias("start"), "event_type", "n", "top")


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*)::BIGINT AS n FROM s GROUP BY user_id, no""")
def stream_session(spark, sf):
    made = streams.run_once(streams.sessions(streams.file_events(spark, sf, "events.parquet"), "6 hours", "1 hour"), "sessions")
    return made.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query(LADDER_SQL)
def stream_ladder(spark, sf):
    made = streams.run_once(streams.ladder(attempts(streams.file_events(spark, sf, "events.parquet"))), "ladder", "update")
    # a user's last state has the most attempts logged
    return made.groupBy("user_id").agg(F.max_by(F.struct("tier", "status", "logged"), "logged").alias("s")).select("user_id", "s.tier", "s.status", "s.logged")
