"""Queries: validation, traceability, evaluation, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import evals, validate
from lectern.plans.registry import query, table

SCHEMA = {
    "type": "object",
    "required": ["k", "kind"],
    "additionalProperties": False,
    "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 90}, "kind": {"enum": ["click", "error", "signup"]}, "tags": {"type": "array", "minItems": 1, "items": {"type": "string", "minLength": 3}}},
    "allOf": [{"if": {"properties": {"kind": {"const": "error"}}}, "then": {"properties": {"k": {"maximum": 50}}}}],
}


@query("""
WITH e AS (SELECT event_id, event_type AS t, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 4 AS m FROM events),
x AS (SELECT event_id, '$.k: is less than 10' AS e FROM e WHERE k < 10
UNION ALL SELECT event_id, '$.k: is more than 90' FROM e WHERE k > 90
UNION ALL SELECT event_id, '$.k: is more than 50' FROM e WHERE t = 'error' AND m <> 0 AND k > 50
UNION ALL SELECT event_id, '$.k: is more than 50' FROM e WHERE m = 0 AND k > 50
UNION ALL SELECT event_id, '$: lacks kind' FROM e WHERE m = 0
UNION ALL SELECT event_id, '$.kind: is not in ["click", "error", "signup"]' FROM e WHERE m <> 0 AND t NOT IN ('click', 'error', 'signup')
UNION ALL SELECT event_id, '$: has unknown more' FROM e WHERE m = 1
UNION ALL SELECT event_id, '$.tags[1]: is shorter than 3' FROM e WHERE m = 2
UNION ALL SELECT event_id, '$.tags: has fewer than 1 items' FROM e WHERE m = 3)
SELECT event_id, string_agg(e, '; ' ORDER BY e) AS errors, count(*)::INT AS n FROM x GROUP BY 1""")
def validate_errors_array(spark, sf):
    m = F.col("event_id") % 4
    kind = F.when(m != 0, F.concat(F.lit(', "kind": "'), "event_type", F.lit('"'))).otherwise("")
    more = F.when(m == 1, ', "more": 1').when(m == 2, ', "tags": ["long", "no"]').when(m == 3, ', "tags": []').otherwise("")
    record = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), kind, more, F.lit("}"))
    rows = table(spark, sf, "events").select("event_id", F.try_parse_json(record).alias("v"))
    out = rows.select("event_id", validate.all_errors(validate.schema_errors(F.col("v"), SCHEMA)).alias("e")).filter("size(e) > 0")
    return out.select("event_id", F.array_join("e", "; ").alias("errors"), F.size("e").alias("n"))


@query("""
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_tax = 0) AS blanks, count(*) FILTER (WHERE l_tax = 0.01) AS dashes FROM lineitem GROUP BY 1, 2),
r AS (SELECT l_orderkey, string_agg('row ' || i || ' has ' || n || ' cells', '; ' ORDER BY i) FILTER (WHERE n <> 1) AS ragged FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS i FROM g) GROUP BY 1)
SELECT l_orderkey, coalesce(ragged, '') AS ragged FROM r""")
def table_rect_check(spark, sf):
    lines = table(spark, sf, "lineitem")
    rows = lines.groupBy("l_orderkey", "l_linenumber").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("cells"))
    grids = rows.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "cells"))), lambda x: x["cells"]).alias("rows"))
    return grids.select("l_orderkey", F.array_join(validate.rectangular(F.array(F.lit("part")), F.col("rows")), "; ").alias("ragged"))


@query("""
SELECT l_orderkey, CASE WHEN bool_or(l_tax = 0) AND bool_or(l_tax = 0.01) THEN 'column tax mixes blank and dash' ELSE '' END AS mixed FROM lineitem GROUP BY 1""")
def table_blank_style(spark, sf):
    cell = F.when(F.col("l_tax") == 0, " ").when(F.col("l_tax") == 0.01, "—").otherwise(F.col("l_tax").cast("string"))
    grids = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.array(F.lit("p"), cell)).alias("rows"))
    return grids.select("l_orderkey", F.array_join(validate.one_blank_style(F.array(F.lit("part"), F.lit("tax")), F.col("rows")), "; ").alias("mixed"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'dice do not add up to the count' ELSE '' END AS dice, CASE WHEN p_size % 3 = 0 THEN 'rating differs from its text' ELSE '' END AS rating FROM part")
def monster_numbers(spark, sf):
    n = F.col("p_size")
    dice = F.concat(n.cast("string"), F.lit("d8+"), n.cast("string"))
    count = F.when(n % 4 == 0, n + 1).otherwise(n)
    hp = F.floor(n * 4.5 + n)
    rating = F.when(n % 3 == 0, n / 2).otherwise(F.lit(0.5))
    return table(spark, sf, "part").select("p_partkey", F.array_join(validate.hit_dice(count, hp, dice), "; ").alias("dice"), F.array_join(validate.challenge(rating, F.lit("1/2")), "; ").alias("rating"))


@query("""SELECT p_partkey, concat_ws('; ', CASE WHEN p_size % 5 = 0 THEN 'type differs from its folder' END, CASE WHEN p_size % 7 = 0 THEN 'slug does not follow from the name' END, CASE WHEN p_size % 3 = 0 THEN 'schema version is not current' END) AS errors FROM part""")
def envelope_checks(spark, sf):
    n = F.col("p_size")
    slug = F.when(n % 7 == 0, "other").otherwise(F.translate("p_name", " ", "-"))
    folder = F.when(n % 5 == 0, "feat").otherwise("spell")
    return table(spark, sf, "part").select("p_partkey", F.array_join(validate.envelope(F.lit("spell"), folder, F.col("p_name"), slug, F.when(n % 3 == 0, 2).otherwise(3), 3), "; ").alias("errors"))


_CONTAINS = "SELECT item_id, doc_id FROM (SELECT item_id, text AS b, substr(text, 1, 12) AS k FROM benchmark) JOIN (SELECT doc_id, text AS t FROM documents) ON contains(t, b)"


def benchmark_in_documents(spark, sf):
    """(item_id, doc_id, b, t): documents that hold a benchmark text, by a join on its second to sixth words.

    The first and last token of an item may be glued to other text in a document; the inner ones
    stand there as they are.  Every position of a document where these words could stand is one
    row, so the join is an equi-join; the whole text is then compared.  Items of fewer than seven
    words have too few inner ones and are compared with every document.
    """
    split = lambda c: F.filter(F.split(c, r"\s+", -1), lambda w: w != "")
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("b"), split("text").alias("w"))
    long = items.filter("size(w) >= 7").select("item_id", "b", F.array_join(F.slice("w", 2, 5), " ").alias("key"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("t"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))), lambda i: F.array_join(F.slice(F.col("w"), i, F.lit(5)), " "))
    starts = docs.withColumn("w", split("t")).select("doc_id", F.explode(F.array_distinct(grams)).alias("key"))
    pairs = starts.join(long.select("item_id", "key"), "key").select("item_id", "doc_id").distinct()
    found = pairs.join(long.select("item_id", "b"), "item_id").join(docs, "doc_id").filter(F.contains("t", "b")).select("item_id", "doc_id", "b", "t")
    short = items.filter("size(w) < 7").select("item_id", "b")
    return found.union(docs.join(short, F.contains("t", "b")).select("item_id", "doc_id", "b", "t"))


@query(_CONTAINS)
def cells_traceable(spark, sf):
    return benchmark_in_documents(spark, sf).filter(validate.traceable(F.substring_index("b", "\n", 1), F.col("t"))).select("item_id", "doc_id")


@query(f"SELECT item_id, doc_id, (strpos(t, b) - 1)::INT AS start, (strpos(t, b) - 1 + length(b))::INT AS end_, doc_id % 3 <> 0 AS valid FROM (SELECT item_id, doc_id, text AS b FROM ({_CONTAINS}) JOIN benchmark USING (item_id)) JOIN (SELECT doc_id, text AS t FROM documents) USING (doc_id)")
def evidence_spans(spark, sf):
    found = benchmark_in_documents(spark, sf)
    start = F.instr(F.col("t"), F.col("b")) - 1
    forged = F.when(F.col("doc_id") % 3 == 0, F.concat("b", F.lit("!"))).otherwise(F.col("b"))
    spans = found.select("item_id", F.col("doc_id").alias("block"), start.alias("start"), (start + F.length("b")).alias("end"), forged.alias("quote"))
    docs = table(spark, sf, "documents")
    return evals.evidence(spans, docs, "doc_id", "text").select("item_id", F.col("block").alias("doc_id"), "start", F.col("end").alias("end_"), "valid")


@query("""
WITH c AS (SELECT doc_id AS case_id, quality, toxic FROM labels),
d AS (SELECT doc_id - doc_id % 7 // 6 AS case_id, (n_chars > 400)::INT AS q, 0 AS t FROM documents),
k AS (SELECT case_id, count(*) AS n FROM d GROUP BY 1),
m AS (SELECT c.*, q, t, d.case_id IS NOT NULL AS found FROM c LEFT JOIN (SELECT d.* FROM d JOIN k USING (case_id) WHERE n = 1) d USING (case_id)),
s AS (SELECT found, coalesce((quality = q)::INT, 0) + coalesce((toxic = t)::INT, 0) AS ok FROM m)
SELECT count(*)::BIGINT AS cases, count(*) FILTER (WHERE found)::BIGINT AS found, count(*) FILTER (WHERE NOT found)::BIGINT AS missing, (2 * count(*))::BIGINT AS assertions, sum(ok)::BIGINT AS correct, count(*) FILTER (WHERE ok = 2)::BIGINT AS passed,
(SELECT coalesce(sum(n), 0)::BIGINT FROM k WHERE case_id NOT IN (SELECT case_id FROM c)) AS extra, (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM k JOIN c USING (case_id)) AS duplicates, FALSE AS release_ready FROM s""")
def eval_score_cases(spark, sf):
    cases = table(spark, sf, "labels").select(F.col("doc_id").alias("case_id"), "quality", "toxic")
    named = (F.col("doc_id") - F.expr("doc_id % 7 div 6")).alias("case_id")
    given = table(spark, sf, "documents").select(named, (F.col("n_chars") > 400).cast("int").alias("q"), F.lit(0).alias("t"))
    matched, totals = evals.match_candidates(cases, given)
    return evals.summary(evals.field_scores(matched, {"quality": "q", "toxic": "t"}), totals, reviewed=True)


@query("""
WITH a AS (SELECT doc_id AS id, md5(text) AS body FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), b AS (SELECT doc_id AS id, CASE WHEN doc_id % 10 = 0 THEN 'changed' ELSE md5(text) END AS body FROM documents)
SELECT b.id, CASE WHEN a.id IS NULL THEN 'added' WHEN a.body = b.body THEN 'same' ELSE 'conflict' END AS outcome FROM b LEFT JOIN a USING (id)""")
def snapshot_append_conflict(spark, sf):
    from lectern.sources.stores import append_outcome

    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("body"))
    new = docs.withColumn("body", F.when(F.col("id") % 10 == 0, "changed").otherwise(F.col("body")))
    return append_outcome(docs.join(table(spark, sf, "labels").select(F.col("doc_id").alias("id")), "id", "left_semi"), new, "id", "body").select("id", "outcome")
