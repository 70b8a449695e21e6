"""Prefix search over names and aliases, with a substring fallback."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lectern.functions.text import ascii_fold

LEAST, MOST, USUAL = 2, 50, 20


def tokens(text: Column) -> Column:
    """Lower-case words without accents; underscores separate."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " "), " ", -1), lambda t: t != ""))


def query_words(q: str) -> list[str]:
    if len(q.strip()) < LEAST:
        raise ValueError(f"a query needs {LEAST} characters")
    return [w for w in re.split(r"[\W_]+", q.lower()) if w]


def token_index(records: DataFrame, id_col: str, names: Column) -> DataFrame:
    """(token, id), to be written partitioned or sorted by token."""
    return records.select(F.explode(tokens(names)).alias("token"), id_col)


def names_and_aliases(name: str, aliases: str | None) -> Column:
    """What the index of a record holds: its name and its aliases (a list, may be null)."""
    return F.concat_ws(" ", F.col(name), F.array_join(F.col(aliases), " ")) if aliases else F.col(name)


def prefix_hits(index: DataFrame, id_col: str, words: list[str]) -> DataFrame:
    """Ids with a token for every word that begins with it: one scan, one aggregation."""
    if not words:
        return index.select(id_col).limit(0)
    hit = F.array(*(F.startswith("token", F.lit(w)) for w in words))
    rows = index.select(id_col, F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(len(words) - 1)), lambda k: F.when(F.get(hit, k), k)), lambda k: k.isNotNull())).alias("w"))
    return rows.groupBy(id_col).agg(F.countDistinct("w").alias("n")).filter(F.col("n") == len(words)).select(id_col)


def search(records: DataFrame, id_col: str, name: str, q: str, limit: int = USUAL, index: DataFrame | None = None) -> DataFrame:
    """Prefix hits first, then substring hits, each once, by name and id, at most ``limit``."""
    limit = max(1, min(limit, MOST))
    index = index if index is not None else token_index(records, id_col, F.col(name))
    first = records.join(prefix_hits(index, id_col, query_words(q)), id_col, "left_semi").withColumn("src", F.lit(0))
    then = records.filter(F.contains(F.lower(name), F.lit(q.strip().lower()))).withColumn("src", F.lit(1))
    best = first.unionByName(then).groupBy(*records.columns).agg(F.min("src").alias("src"))
    return best.orderBy("src", F.lower(name), id_col).limit(limit)


def grouped(hits: DataFrame, kind: str, id_col: str, name: str) -> DataFrame:
    """Hits of each kind as one ordered list, from a (limited) search."""
    order = W.partitionBy(kind).orderBy("src", F.lower(name), id_col)
    rows = hits.withColumn("_n", F.row_number().over(order))
    return rows.groupBy(kind).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(name).alias("name")))), lambda x: x["name"]).alias("names"), F.count(F.lit(1)).alias("n"))


def folded(text: Column) -> Column:
    return F.lower(ascii_fold(text))
