"""Queries: text clean-up, headings, contents entries, string and number functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import jsons, numbers
from lectern.functions import text as T
from lectern.operators import cleanup, segments
from lectern.plans.registry import query, table

_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents"
_KEY = "trim(regexp_replace(lower(regexp_replace(line, '[0-9]', '', 'g')), '\\s+', ' ', 'g'))"
_RUNNING = f"SELECT key, count(DISTINCT doc_id) AS n_pages FROM (SELECT doc_id, {_KEY} AS key FROM l) WHERE key <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= greatest(3, ceil(0.02 * (SELECT count(DISTINCT doc_id) FROM l)))"


@query(f"WITH l AS ({_LINES}) {_RUNNING}")
def running_lines(spark, sf):
    each = cleanup.lines(table(spark, sf, "documents"), "doc_id", "text")
    return cleanup.running_lines(each, "doc_id", "line", 0.02, 3)


@query(f"WITH l AS ({_LINES}), r AS ({_RUNNING}) SELECT doc_id, count(*)::BIGINT AS n_lines, sum(length(line))::BIGINT AS n_chars FROM l WHERE {_KEY} NOT IN (SELECT key FROM r) GROUP BY 1")
def strip_running_lines(spark, sf):
    each = cleanup.lines(table(spark, sf, "documents"), "doc_id", "text")
    kept = cleanup.strip_running(each, "line", cleanup.running_lines(each, "doc_id", "line", 0.02, 3))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query(r"SELECT DISTINCT w AS word FROM (SELECT regexp_replace(lower(unnest(regexp_split_to_array(text, '\s+'))), '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') AS w FROM documents) WHERE w <> ''")
def vocabulary(spark, sf):
    return cleanup.vocabulary(table(spark, sf, "documents"), "text")


@query("""
WITH w AS (SELECT doc_id, split_part(text, ' ', 2) AS a, split_part(text, ' ', 3) AS b, doc_id % 2 = 0 AS known FROM documents),
c AS (SELECT doc_id, regexp_replace(a, '[^a-z]', '', 'g') AS a, regexp_replace(b, '[^a-z]', '', 'g') AS b, known FROM w)
SELECT doc_id, CASE WHEN known THEN 'see ' || a || b || ' here' ELSE 'see ' || a || '-' || b || ' here' END AS text FROM c WHERE a <> '' AND b <> ''""")
def dehyphenate_known(spark, sf):
    part = lambda k: F.regexp_replace(F.coalesce(F.get(F.split("text", " ", -1), F.lit(k)), F.lit("")), "[^a-z]", "")
    docs = table(spark, sf, "documents").select("doc_id", part(1).alias("a"), part(2).alias("b")).filter("a <> '' AND b <> ''")
    known = F.when(F.col("doc_id") % 2 == 0, F.array(F.concat("a", "b"))).otherwise(F.array().cast("array<string>"))
    lines = F.array(F.concat(F.lit("see "), "a", F.lit("-")), F.concat("b", F.lit(" here")))
    each = docs.select("doc_id", known.alias("known"), F.posexplode(lines).alias("pos", "line"))
    return cleanup.join_words(each, ["doc_id"], "pos", "line", F.col("known"))


@query(f"WITH l AS ({_LINES}), o AS (SELECT doc_id, list_sort(list(length(line))) AS v FROM l GROUP BY 1) SELECT doc_id, v[len(v) // 2 + 1]::INT AS median FROM o")
def upper_median_line_length(spark, sf):
    each = cleanup.lines(table(spark, sf, "documents"), "doc_id", "text").select("doc_id", F.length("line").alias("n"))
    return cleanup.body_height(each, ["doc_id"], "n")


def paragraph_stream(spark, sf):
    each = cleanup.lines(table(spark, sf, "documents"), "doc_id", "text")
    return each.withColumn("is_heading", F.size(T.words(F.col("line"))).between(1, 4))


_STREAM = f"WITH l AS (SELECT * FROM ({_LINES})), h AS (SELECT *, len(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')) BETWEEN 1 AND 4 AS is_heading FROM l)"


@query(f"{_STREAM} SELECT doc_id, pos::INT AS pos, last_value(CASE WHEN is_heading THEN line END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS heading FROM h")
def headings_ffill(spark, sf):
    stream = paragraph_stream(spark, sf)
    return segments.fill_headings(stream, ["doc_id"], "pos", F.col("is_heading"), F.col("line")).select("doc_id", "pos", "heading")


@query(f"""{_STREAM}, m AS (SELECT *, length(line) % 5 = 0 AS st, is_heading AND length(line) % 5 <> 0 AS en FROM h),
n AS (SELECT *, sum(st::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS no FROM m),
c AS (SELECT *, max(en::INT) OVER (PARTITION BY doc_id, no ORDER BY pos) AS closed FROM n)
SELECT doc_id, no::BIGINT AS segment, count(*)::BIGINT AS n_lines, min(pos)::INT AS first_pos FROM c WHERE no > 0 AND closed = 0 GROUP BY 1, 2""")
def segment_by_trigger(spark, sf):
    stream = paragraph_stream(spark, sf)
    cut = segments.cut_segments(stream, ["doc_id"], "pos", F.length("line") % 5 == 0, F.col("is_heading"))
    return cut.filter("segment IS NOT NULL").groupBy("doc_id", "segment").agg(F.count(F.lit(1)).alias("n_lines"), F.min("pos").alias("first_pos"))


@query("SELECT doc_id, printf('%s-p%04d-%02d', source, (n_chars % 90)::INT, (row_number() OVER (PARTITION BY source, n_chars % 90 ORDER BY doc_id))::INT) AS seg_id FROM documents")
def segment_ids(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", (F.col("n_chars") % 90).alias("page"))
    numbered = segments.ordinals(docs, ["source", "page"], "doc_id")
    return numbered.select("doc_id", segments.segment_id(F.col("source"), F.col("page"), F.col("ordinal")).alias("seg_id"))


@query(r"""
WITH w AS (SELECT p_brand, list_filter(regexp_split_to_array(lower(p_name), '\s+'), lambda x: x <> '') AS w FROM part),
g AS (SELECT p_brand, n, array_to_string(w[len(w) - n + 1:], ' ') AS gram FROM (SELECT p_brand, w, unnest(range(1, least(4, len(w)) + 1)) AS n FROM w)),
t AS (SELECT p_brand, count(*) AS total FROM part GROUP BY 1),
c AS (SELECT p_brand, n, gram, count(*) AS k FROM g GROUP BY 1, 2, 3),
r AS (SELECT c.*, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, k DESC, gram) AS r FROM c JOIN t USING (p_brand) WHERE k >= greatest(3, ceil(total / 16)))
SELECT p_brand, n::INT AS len, gram, k::BIGINT AS n FROM r WHERE r = 1""")
def suffix_ngram_vote(spark, sf):
    # a lower bar than one half, so that the vote has winners on this table
    titles = table(spark, sf, "part").select("p_brand", "p_name")
    tails = segments.suffix_vote(titles, ["p_brand"], "p_name", 4, 3, share=16)
    return tails


@query(r"""
WITH s AS (SELECT p_partkey, p_name || ' ..... ' || p_size || chr(10) || p_type || ' . . . . ' || (p_size * 7) || chr(10) || 'no entry 12' AS t FROM part),
m AS (SELECT p_partkey, regexp_extract_all(t, '([^.\n•][^.\n]*?)\s*(?:[.•]\s*){3,}([0-9]{1,4})', 1) AS a, regexp_extract_all(t, '([^.\n•][^.\n]*?)\s*(?:[.•]\s*){3,}([0-9]{1,4})', 2) AS b FROM s)
SELECT p_partkey, trim(unnest(a)) AS title, unnest(b)::INT AS printed FROM m""")
def toc_entries_regex(spark, sf):
    page = F.concat("p_name", F.lit(" ..... "), F.col("p_size").cast("string"), F.lit("\n"), "p_type", F.lit(" . . . . "), (F.col("p_size") * 7).cast("string"), F.lit("\nno entry 12"))
    return table(spark, sf, "part").select("p_partkey", F.inline(segments.contents_entries(page)))


_TITLES = ["Chapter 3: Classes", "Racial Traits", "Monster Skills and Feats", "Combat Options", "Glossary", "Of Kings", "Prestige Classes", "Spells"]


@query("""
WITH t AS (SELECT p_partkey, (['Chapter 3: Classes', 'Racial Traits', 'Monster Skills and Feats', 'Combat Options', 'Glossary', 'Of Kings', 'Prestige Classes', 'Spells'])[p_partkey % 8 + 1] AS title, CASE WHEN p_partkey % 11 = 0 THEN 'races' END AS chapter FROM part)
SELECT p_partkey, title, coalesce(chapter, CASE p_partkey % 8 WHEN 0 THEN 'classes' WHEN 1 THEN 'races' WHEN 2 THEN 'monsters' WHEN 3 THEN 'combat' WHEN 4 THEN 'basics' WHEN 5 THEN 'uncategorized' WHEN 6 THEN 'prestige-classes' ELSE 'magic' END) AS category, CASE WHEN p_partkey % 8 IN (0, 4) THEN 1 ELSE 2 END AS level FROM t""")
def category_rules(spark, sf):
    title = F.get(F.array(*map(F.lit, _TITLES)), (F.col("p_partkey") % 8).cast("int"))
    rows = table(spark, sf, "part").select("p_partkey", title.alias("title"), F.when(F.col("p_partkey") % 11 == 0, "races").alias("chapter"))
    return rows.select("p_partkey", "title", segments.category(F.col("title"), chapter=F.col("chapter")).alias("category"), segments.entry_level(F.col("title")).alias("level"))


@query(r"""
SELECT page_id, len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::INT AS n_links, len(regexp_extract_all(html, '<p[^>]*>', 0))::INT AS n_paragraphs, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS links FROM pages""")
def xml_blocks(spark, sf):
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return table(spark, sf, "pages").select("page_id", F.size(links).alias("n_links"), F.size(F.regexp_extract_all("html", F.lit("<p[^>]*>"), F.lit(0))).alias("n_paragraphs"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.array_join(links, " ").alias("links"))


_SLUG = r"regexp_replace(regexp_replace(lower(replace(regexp_replace(strip_accents(regexp_replace(x, '\p{Pd}', '-', 'g')), '[^\x00-\x7F]', '', 'g'), '''', '')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) || ' — O''Neil–Ünïted' AS x FROM documents) SELECT doc_id, {_SLUG} AS slug FROM t")
def slugify(spark, sf):
    line = F.concat(F.substring_index("text", "\n", 1), F.lit(" — O'Neil–Ünïted"))
    return table(spark, sf, "documents").select("doc_id", T.slugify(line).alias("slug"))


@query(r"""
WITH t AS (SELECT doc_id, substr(text, 1, 40) || ' (Note ' || doc_id || ') End' AS x FROM documents),
n AS (SELECT doc_id, lower(regexp_replace(x, '\([^()]*\)', '', 'g')) AS y FROM t)
SELECT doc_id, regexp_replace(y, '[^\p{L}\p{N}]+', '', 'g') AS key, trim(regexp_replace(y, '[^\p{L}\p{N}]+', ' ', 'g')) AS tokens FROM n""")
def normalize_heading(spark, sf):
    x = F.concat(F.substring("text", 1, 40), F.lit(" (Note "), F.col("doc_id").cast("string"), F.lit(") End"))
    return table(spark, sf, "documents").select("doc_id", T.heading_key(x).alias("key"), F.array_join(T.heading_tokens(x), " ").alias("tokens"))


@query(rf"""
WITH l AS ({_LINES}),
n AS (SELECT doc_id, pos, lower(regexp_replace(line, '\([^()]*\)', '', 'g')) AS y FROM l)
SELECT doc_id, pos::INT AS pos, regexp_replace(y, '[^\p{{L}}\p{{N}}]+', '', 'g') AS key, trim(regexp_replace(y, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS tokens FROM n""")
def normalize_heading_lines(spark, sf):
    """Whole lines, all of each text."""
    each = cleanup.lines(table(spark, sf, "documents"), "doc_id", "text")
    return each.select("doc_id", "pos", T.heading_key(F.col("line")).alias("key"), F.array_join(T.heading_tokens(F.col("line")), " ").alias("tokens"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' ' || 'ability' WHEN 1 THEN p_name || ' body' WHEN 2 THEN p_name || ' glass' ELSE p_name || ' box' END AS token FROM part""")
def special_token_norm(spark, sf):
    k = F.col("p_partkey") % 4
    cell = (
        F.when(k == 0, F.concat(F.lit("1st "), "p_name", F.lit(" Abilities (Ex)")))
        .when(k == 1, F.concat("p_name", F.lit(" bodies 30 ft.")))
        .when(k == 2, F.concat("p_name", F.lit(" glass +2d6")))
        .otherwise(F.concat("p_name", F.lit(" Boxes 3/day")))
    )
    return table(spark, sf, "part").select("p_partkey", T.special_token(cell).alias("token"))


@query("SELECT p_partkey, p_name || '|' || p_brand || ' (a, b)|' || p_type AS parts, 3 AS n FROM part")
def split_outside_parens(spark, sf):
    cell = F.concat("p_name", F.lit(", "), "p_brand", F.lit(" (a, b), —, "), "p_type")
    parts = T.split_outside_parentheses(cell)
    return table(spark, sf, "part").select("p_partkey", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n"))


@query("""
WITH l AS (SELECT n_nationkey, i::INT AS level, (['good', 'average', 'poor'])[n_nationkey % 3 + 1] AS kind FROM nation, range(1, 21) t(i)),
b AS (SELECT *, CASE kind WHEN 'good' THEN level WHEN 'average' THEN 3 * level // 4 ELSE level // 2 END AS b FROM l)
SELECT n_nationkey, level, CASE WHEN b <= 0 THEN '+0' ELSE array_to_string(list_transform(list_filter([b, b - 5, b - 10, b - 15], lambda x: x > 0), lambda x: '+' || x), '/') END AS attack,
'+' || CASE kind WHEN 'good' THEN 2 + level // 2 ELSE level // 3 END AS save FROM b""")
def bab_save_progression(spark, sf):
    kind = F.get(F.array(F.lit("good"), F.lit("average"), F.lit("poor")), (F.col("n_nationkey") % 3).cast("int"))
    rows = table(spark, sf, "nation").select("n_nationkey", kind.alias("kind"), F.explode(F.sequence(F.lit(1), F.lit(20))).alias("level"))
    return rows.select("n_nationkey", "level", numbers.attack_cell(F.col("level"), F.col("kind")).alias("attack"), numbers.save_cell(F.col("level"), F.col("kind")).alias("save"))


@query("""
SELECT p_partkey, 0 AS pos, CASE WHEN p_size % 3 = 0 THEN 0.5 ELSE p_size END::DOUBLE AS count, 8 AS die, p_size * 2 AS bonus FROM part
UNION ALL SELECT p_partkey, 1, 2, 6, 0 FROM part""")
def dice_terms(spark, sf):
    count = F.when(F.col("p_size") % 3 == 0, F.lit("1/2")).otherwise(F.col("p_size").cast("string"))
    cell = F.concat(count, F.lit("d8 + "), (F.col("p_size") * 2).cast("string"), F.lit(" plus 2d6 (hp)"))
    rows = table(spark, sf, "part").select("p_partkey", F.posexplode(numbers.dice_terms(cell)).alias("pos", "t"))
    return rows.select("p_partkey", "pos", "t.count", "t.die", "t.bonus")


@query("SELECT p_partkey, (p_size || 'th Level') AS cell, p_size AS level, p_size / 4.0 AS quarter, CASE WHEN p_size % 4 = 0 THEN CAST(p_size // 4 AS VARCHAR) ELSE CAST(p_size / 4.0 AS VARCHAR) END AS shown FROM part")
def ordinal_and_number_text(spark, sf):
    cell = F.concat(F.col("p_size").cast("string"), F.lit("th Level"))
    quarter = F.col("p_size") / F.lit(4.0)
    return table(spark, sf, "part").select("p_partkey", cell.alias("cell"), numbers.ordinal(cell).alias("level"), quarter.alias("quarter"), numbers.number_text(quarter).alias("shown"))


@query("SELECT event_id, json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND CAST(json_extract(props, '$.k') AS BIGINT) = 42 AS equal_int, FALSE AS equal_double, FALSE AS equal_string FROM events")
def typed_json_equality(spark, sf):
    v = jsons.resolve(jsons.strict(F.col("props")), "/k")
    same = lambda text: jsons.typed_equal(v, F.parse_json(F.lit(text)))
    return table(spark, sf, "events").select("event_id", same("42").alias("equal_int"), same("42.5").alias("equal_double"), same('"42"').alias("equal_string"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE '{"a":' || event_id || ',"k":' || json_extract(props, '$.k') || '}' END AS doc FROM events""")
def strict_json_load(spark, sf):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"a":1,"a":'), k, F.lit("}"))).otherwise(F.concat(F.lit('{"k": '), k, F.lit(', "a": '), F.col("event_id").cast("string"), F.lit("}")))
    fenced = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Here:\n```json\n"), text, F.lit("\n```"))).otherwise(text)
    return table(spark, sf, "events").select("event_id", jsons.canonical(jsons.reply_json(fenced)).alias("doc"))


@query("SELECT page_id, sha256(html) AS artifact, sha256(url || chr(0) || CAST(page_id AS VARCHAR)) AS identity, substr(sha256(html), 1, 20) || '-p' || printf('%04d', page_id) AS block_id FROM pages")
def snapshot_identity(spark, sf):
    artifact = F.sha2("html", 256)
    block = F.concat(F.substring(artifact, 1, 20), F.format_string("-p%04d", "page_id"))
    return table(spark, sf, "pages").select("page_id", artifact.alias("artifact"), jsons.identity_digest(F.col("url"), F.col("page_id").cast("string")).alias("identity"), block.alias("block_id"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'pdf p. ' || doc_id WHEN n_chars % 4 = 0 THEN 'p. ' || doc_id ELSE 'pp. ' || doc_id || '-' || (doc_id + n_chars % 4) END AS citation FROM documents")
def citations(spark, sf):
    first = F.col("doc_id")
    return table(spark, sf, "documents").select("doc_id", T.citation(first, first + F.col("n_chars") % 4, first % 3 != 0).alias("citation"))
