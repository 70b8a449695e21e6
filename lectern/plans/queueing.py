"""Queries: the work queue's ladder, selection, staleness, claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import workqueue
from lectern.plans.registry import query, table

_KIND = "CASE event_type WHEN 'error' THEN 'validation' WHEN 'click' THEN 'needs_context' ELSE 'other' END"
LADDER_SQL = f"""
WITH RECURSIVE a AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS tier, {_KIND} AS kind, CAST(event_id % 2 AS VARCHAR) AS error FROM events),
s AS (SELECT DISTINCT user_id, 0::BIGINT AS i, 1 AS tier, 'pending' AS status, 0 AS lt, '' AS lk, '' AS le, FALSE AS asked, 0 AS logged FROM a
UNION ALL
SELECT user_id, i,
 CASE WHEN done OR rep OR stale OR retry THEN tier WHEN tier < 3 THEN tier + 1 ELSE tier END,
 CASE WHEN done OR rep OR stale OR retry OR tier < 3 THEN status ELSE 'exhausted' END,
 CASE WHEN done OR rep THEN lt ELSE att END, CASE WHEN done OR rep THEN lk ELSE kind END, CASE WHEN done OR rep THEN le ELSE error END,
 CASE WHEN done OR rep OR stale THEN asked ELSE retry END,
 CASE WHEN done OR rep THEN logged ELSE logged + 1 END
FROM (SELECT s.*, a.i AS ai, a.kind, a.error, CASE WHEN a.tier = 0 THEN s.tier ELSE a.tier END AS att,
  status = 'exhausted' AS done,
  a.kind = 'validation' AND lk = 'validation' AND le = a.error AND lt = CASE WHEN a.tier = 0 THEN s.tier ELSE a.tier END AS rep,
  s.tier <> CASE WHEN a.tier = 0 THEN s.tier ELSE a.tier END AS stale, a.kind = 'needs_context' AND NOT asked AS retry
  FROM s JOIN a ON a.user_id = s.user_id AND a.i = s.i + 1) t(user_id, i_, tier, status, lt, lk, le, asked, logged, i, kind, error, att, done, rep, stale, retry))
SELECT user_id, tier, status, logged FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1"""


def attempts(events):
    kind = F.when(F.col("event_type") == "error", "validation").when(F.col("event_type") == "click", "needs_context").otherwise("other")
    tier = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    return events.select("user_id", "ts", "event_id", tier.alias("tier"), kind.alias("kind"), (F.col("event_id") % 2).cast("string").alias("error"))


@query(LADDER_SQL)
def ladder_fold(spark, sf):
    return workqueue.fold_attempts(attempts(table(spark, sf, "events")), "user_id", ["ts", "event_id"])


_QUEUE = "SELECT o_orderkey AS seg_id, o_custkey % 20 AS book, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'pending' ELSE 'in_progress' END AS status, (substr(o_orderpriority, 1, 1)::INT + 1) // 2 AS tier, o_orderdate AS claimed FROM orders"


def queue(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "pending").otherwise("in_progress")
    tier = F.floor((F.substring("o_orderpriority", 1, 1).cast("int") + 1) / 2).cast("int")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("seg_id"), (F.col("o_custkey") % 20).alias("book"), status.alias("status"), tier.alias("tier"), F.col("o_orderdate").alias("claimed"))


@query(f"SELECT book, count(*) FILTER (WHERE status = 'pending')::BIGINT AS pending, count(*) FILTER (WHERE status = 'in_progress')::BIGINT AS in_progress, count(*) FILTER (WHERE status = 'done')::BIGINT AS done, count(*) FILTER (WHERE status = 'exhausted')::BIGINT AS exhausted, count(*) FILTER (WHERE tier = 1)::BIGINT AS tier_1, count(*) FILTER (WHERE tier = 2)::BIGINT AS tier_2, count(*) FILTER (WHERE tier = 3)::BIGINT AS tier_3 FROM ({_QUEUE}) GROUP BY 1")
def queue_summary(spark, sf):
    return workqueue.summary(queue(spark, sf))


@query(f"WITH q AS ({_QUEUE}), p AS (SELECT *, min(tier) OVER (PARTITION BY book) AS t, FROM q WHERE status = 'pending') SELECT book, seg_id, tier FROM p WHERE tier = t QUALIFY row_number() OVER (PARTITION BY book ORDER BY seg_id) <= 5")
def queue_select(spark, sf):
    return workqueue.select_work(queue(spark, sf), "seg_id", 5).select("book", "seg_id", "tier")


@query(f"SELECT seg_id, CASE WHEN status = 'in_progress' AND seg_id % 7 <> 0 AND claimed < TIMESTAMP '1998-06-15 12:00:00' - INTERVAL 60 MINUTES THEN 'pending' ELSE status END AS status FROM ({_QUEUE})")
def stale_reset(spark, sf):
    # some claim times are no times; such work is not stale
    rows = queue(spark, sf).withColumn("claimed", F.when(F.col("seg_id") % 7 == 0, "soon").otherwise(F.col("claimed").cast("string")))
    return workqueue.reset_stale(rows, "claimed", F.lit("1998-06-15 12:00:00").cast("timestamp")).select("seg_id", "status")


@query("""
WITH k AS (SELECT l_partkey + l_linenumber * 100 AS path, count(DISTINCT l_suppkey)::BIGINT AS n_claims, min(l_suppkey) AS first_claim FROM lineitem GROUP BY 1),
j AS (SELECT k.*, CASE WHEN p_partkey IS NOT NULL THEN p_size END AS owner FROM k LEFT JOIN part ON p_partkey = path)
SELECT path, n_claims, CASE WHEN n_claims > 1 THEN 'multiple' WHEN owner IS NULL THEN 'missing' ELSE 'other_owner' END AS trouble FROM j WHERE n_claims > 1 OR owner IS NULL OR owner <> first_claim""")
def claims_audit(spark, sf):
    claims = table(spark, sf, "lineitem").select((F.col("l_partkey") + F.col("l_linenumber") * 100).alias("path"), "l_suppkey")
    owners = table(spark, sf, "part").select(F.col("p_partkey").alias("path"), F.col("p_size").alias("owner"))
    return workqueue.audit_claims(claims, owners, "path", "l_suppkey").select("path", "n_claims", "trouble")


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'proposed_type' WHEN 1 THEN 'needs_context' WHEN 2 THEN 'no_content' WHEN 3 THEN 'records' ELSE 'invalid' END AS outcome FROM events""")
def reply_outcomes(spark, sf):
    k = F.col("event_id") % 5
    reply = F.when(k == 0, '{"proposed_type": "item", "no_content": true}').when(k == 1, '{"needs_context": true, "records": [1]}').when(k == 2, '{"no_content": true}').when(k == 3, '{"records": [{"id": 1}]}').otherwise('{"a": 1, "a": 2}')
    return table(spark, sf, "events").select("event_id", workqueue.reply_outcome(F.try_parse_json(reply)).alias("outcome"))


@query("SELECT l_orderkey, bool_and(l_discount <= 0.08) AS passed, count(*) FILTER (WHERE l_discount > 0.08)::BIGINT AS n_errors FROM lineitem GROUP BY 1")
def group_write_back(spark, sf):
    from lectern.operators import validate

    results = table(spark, sf, "lineitem").select("l_orderkey", validate.check(F.col("l_discount") > 0.08, "discount too large").alias("errors"))
    return validate.group_verdict(results, ["l_orderkey"])
