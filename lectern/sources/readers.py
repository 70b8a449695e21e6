"""Sources: manifests, page text with sidecars, page geometry, records, word lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "book_id string, title string, short_title string, file string, edition string, kind string, published string, applies_to string, scanned boolean, preferred_over array<string>, exclude_reason string"
OVERRIDE_KINDS = ["errata", "update"]


class ManifestError(ValueError):
    """A manifest breaks its own rules."""


def manifest(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Books from parsed manifest entries (the manifest is one curated file, read on the driver)."""
    known = {part.strip().split()[0] for part in MANIFEST.split(",")}
    for e in entries:
        if extra := set(e) - known:
            raise ManifestError(f"{e.get('book_id')}: unknown keys {sorted(extra)}")
    rows = [{k: (str(v) if k == "published" and v is not None else v) for k, v in e.items()} for e in entries]
    return spark.createDataFrame([tuple(r.get(part.strip().split()[0]) for part in MANIFEST.split(",")) for r in rows], MANIFEST)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """YAML where a parser is installed, else JSON, which is YAML too."""
    text = spark.read.text(path, wholetext=True).first().value
    try:
        import yaml
    except ImportError:
        return manifest(spark, json.loads(text)["entries"])
    return manifest(spark, yaml.safe_load(text)["entries"])


def manifest_problems(books: DataFrame) -> DataFrame:
    """(book_id, problem) of every broken rule; joins only, nothing on the driver."""
    ids = books.select(F.col("book_id").alias("ref")).distinct()
    twice = books.groupBy("book_id").count().filter("count > 1").select("book_id", F.lit("id is not unique").alias("problem"))
    targets = books.filter(F.col("kind").isin(OVERRIDE_KINDS)).select("book_id", F.col("applies_to").alias("ref"))
    lost = targets.join(ids, "ref", "left_anti").select("book_id", F.lit("applies_to names no book").alias("problem"))
    beaten = books.select("book_id", F.explode("preferred_over").alias("ref")).join(ids, "ref", "left_anti")
    worse = beaten.select("book_id", F.lit("preferred_over names no book").alias("problem"))
    silent = books.filter("kind = 'excluded' AND coalesce(trim(exclude_reason), '') = ''").select("book_id", F.lit("excluded without a reason").alias("problem"))
    undated = books.filter("published IS NOT NULL AND NOT published RLIKE '^[0-9]{4}-(0[1-9]|1[0-2])$'").select("book_id", F.lit("published is not YYYY-MM").alias("problem"))
    return twice.union(lost).union(worse).union(silent).union(undated)


def scope(books: DataFrame) -> DataFrame:
    """``scope``: duplicate, override, index, excluded, in_scope or out_of_scope, the first that holds."""
    beaten = books.select(F.explode("preferred_over").alias("book_id")).distinct().withColumn("_dup", F.lit(True))
    updated = books.filter("kind = 'update'").select(F.col("applies_to").alias("book_id")).distinct().withColumn("_new", F.lit(True))
    joined = books.join(beaten, "book_id", "left").join(updated, "book_id", "left")
    status = (
        F.when(F.col("_dup"), "duplicate")
        .when(F.col("kind").isin(OVERRIDE_KINDS), "override")
        .when(F.col("kind") == "index", "index")
        .when(F.col("kind") == "excluded", "excluded")
        .when((F.col("edition") == "3.5") | F.col("_new"), "in_scope")
        .otherwise("out_of_scope")
    )
    return joined.withColumn("scope", status).drop("_dup", "_new")


def listing(spark: SparkSession, folder: str, ignore: list[str] = ()) -> DataFrame:
    """Paths below a folder; contents are not read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    name = F.element_at(F.split("path", "/", -1), -1)
    return paths.filter(~name.isin(*ignore) if ignore else F.lit(True))


def json_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file: path, text, and the variant (null for what is no strict JSON object)."""
    from lectern.functions.jsons import strict

    rows = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    name = F.element_at(F.split("path", "/", -1), -1)
    return rows.filter(~F.startswith(name, F.lit("."))).withColumn("record", strict(F.col("text")))


def records(spark: SparkSession, root: str) -> DataFrame:
    """Record files ``<root>/<book>/<type>/<file>.json``; what cannot be parsed has an error instead."""
    rows = json_files(spark, f"{root}/*/*/*.json")
    parts = F.split("path", "/", -1)
    return rows.select("path", F.element_at(parts, -3).alias("book_id"), F.element_at(parts, -2).alias("type"), "record", F.when(F.col("record").isNull(), "not a JSON object").alias("error"))


def first_of_each(rows: DataFrame, id_: Column) -> DataFrame:
    """Of records with equal ids the first path stays; those without an id all stay."""
    from pyspark.sql.window import Window as W

    known = rows.withColumn("_id", id_)
    first = known.filter("_id IS NOT NULL").withColumn("_n", F.row_number().over(W.partitionBy("_id").orderBy("path"))).filter("_n = 1").drop("_n")
    return first.unionByName(known.filter("_id IS NULL")).drop("_id")


def paragraphs(texts: DataFrame, sidecars: DataFrame, keys: list[str]) -> DataFrame:
    """Paragraphs (split at blank lines) with their sidecar entries; ``missing`` marks pages that do not match one to one."""
    parts = texts.select(*keys, F.filter(F.split("text", "\n\n", -1), lambda p: F.trim(p) != "").alias("_p"))
    both = parts.join(sidecars.select(*keys, F.col("entries").alias("_e")), keys, "full_outer")
    wrong = F.col("_p").isNull() | F.col("_e").isNull() | (F.size("_p") != F.size("_e"))
    each = F.when(wrong, F.array(F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast(sidecars.schema["entries"].dataType.elementType).alias("entry")))).otherwise(F.zip_with("_p", "_e", lambda p, e: F.struct(p.alias("text"), e.alias("entry"))))
    return both.select(*keys, F.coalesce(wrong, F.lit(True)).alias("missing"), F.posexplode(each).alias("pos", "x")).select(*keys, "missing", "pos", "x.text", "x.entry")


def geometry(xhtml: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Words of word-box XHTML: id, page, block, line, pos, box and text; control characters dropped."""
    clean = F.regexp_replace(text_col, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")

    def parts(df: DataFrame, tag: str, name: str, of: str) -> DataFrame:
        inner = F.regexp_extract_all(of, F.lit(rf"(?s)<{tag}\b[^>]*?(?:/>|>(.*?)</{tag}>)"), F.lit(1))
        return df.select("*", F.posexplode(inner).alias(name, f"_{name}"))

    pages = parts(xhtml.select(F.col(id_col), clean.alias("_all")), "page", "page", "_all")
    lines = parts(parts(pages, "block", "block", "_page"), "line", "line", "_block")
    words = lines.select(id_col, "page", "block", "line", F.posexplode(F.regexp_extract_all("_line", F.lit(r"(?s)<word\b[^>]*>.*?</word>"), F.lit(0))).alias("pos", "w"))
    number = lambda k: F.regexp_extract("w", rf'{k}="([^"]*)"', 1).try_cast("double")
    text = F.regexp_extract("w", r"(?s)>(.*)<", 1)
    # numeric entities by their number, wherever one is left
    numeric = F.transform(F.split(text, "&#"), lambda part, i: F.when((i == 0) | ~part.rlike("^(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), F.when(i == 0, part).otherwise(F.concat(F.lit("&#"), part))).otherwise(_code_point(part)))
    text = F.when(F.contains(text, F.lit("&#")), F.array_join(numeric, "")).otherwise(text)
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return words.select(id_col, "page", "block", "line", "pos", number("xMin").alias("x0"), number("yMin").alias("y0"), number("xMax").alias("x1"), number("yMax").alias("y1"), text.alias("text"))


def _code_point(part: Column) -> Column:
    """What ``65;rest`` or ``x41;rest`` stands for: the character, then the rest; a number that is no character stays as it is."""
    told = F.regexp_extract(part, "^([^;]*);", 1)
    number = F.when(told.rlike("^[xX]"), F.conv(F.substring(told, 2, 8), 16, 10)).otherwise(told).cast("long")
    real = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    utf32 = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(real, F.concat(utf32, F.regexp_extract(part, "(?s)^[^;]*;(.*)", 1))).otherwise(F.concat(F.lit("&#"), part))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).filter("word != ''").distinct()


def manifest_counts(books: DataFrame) -> DataFrame:
    """What a manifest holds: (of, value, n) by kind and by scope."""
    each = scope(books).select(F.explode(F.array(F.struct(F.lit("kind").alias("of"), F.col("kind").alias("value")), F.struct(F.lit("scope").alias("of"), F.col("scope").alias("value")))).alias("x"))
    return each.groupBy("x.of", "x.value").agg(F.count(F.lit(1)).alias("n"))


class PagesMissing(ValueError):
    """Pages whose paragraphs and sidecar entries do not match one to one."""


def checked_paragraphs(texts: DataFrame, sidecars: DataFrame, keys: list[str], named: int = 50) -> DataFrame:
    """:func:`paragraphs`, or an error that names the pages that do not match (at most ``named`` of them, and their number)."""
    made = paragraphs(texts, sidecars, keys)
    bad = made.filter("missing").select(*keys)
    rows = bad.orderBy(*keys).limit(named).collect()
    if rows:
        raise PagesMissing(f"{bad.count()} pages without matching sidecars: " + ", ".join("/".join(map(str, r)) for r in rows))
    return made.drop("missing")
