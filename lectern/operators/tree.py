"""Browse trees: rolled-up counts, ordered sections, per-item values, levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNSECTIONED = "(Unsectioned)"


def rolled(records: DataFrame, levels: list[str], page: str) -> DataFrame:
    """Counts and first page of every node, level by level, in one aggregation."""
    flags = [F.grouping(c).cast("int").alias(f"all_{c}") for c in levels[1:]]
    return records.rollup(*levels).agg(F.count(F.lit(1)).alias("n"), F.min(page).alias("first_id"), *flags)


def sections(records: DataFrame, chapter: str, section: str, name: str, id_col: str, page: str) -> DataFrame:
    """Per chapter and section its items by name, and its first page (the order of sections)."""
    item = F.struct(F.lower(name).alias("o"), F.col(id_col).alias("i"), F.concat(F.col(name), F.lit("#"), F.col(id_col).cast("string")).alias("shown"))
    rows = records.groupBy(F.col(chapter).alias("chapter"), F.coalesce(section, F.lit(UNSECTIONED)).alias("section"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["shown"]).alias("items"), F.min(page).alias("first_page"))


def nested(made: DataFrame) -> DataFrame:
    """Chapters with their sections, ordered by first page and then label."""
    part = F.struct("first_page", "section", "items")
    return made.groupBy("chapter").agg(F.array_sort(F.collect_list(part)).alias("sections"), F.min("first_page").alias("first_page"))


def values_by_key(rows: DataFrame, id_col: str, key: str, value: str, order: str) -> DataFrame:
    """A map from key to values in order, for each item."""
    lists = rows.groupBy(id_col, key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"]).alias("v"))
    return lists.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct(key, "v"))).alias("values"))


def by_level(records: DataFrame, levels: str, owner: str, owner_value, level: str, name: str) -> DataFrame:
    """Records with a level for one owner, by level and name."""
    rows = records.withColumn("_x", F.explode(F.filter(levels, lambda x: x[owner] == owner_value)))
    return rows.select(*records.columns, f"_x.{owner}", f"_x.{level}").orderBy(level, name)


def shown_field(value: Column, kind: str) -> Column:
    """A field as text: lists by comma, objects as ``k: v``; empty ones null."""
    text = F.array_join(value, ", ") if kind == "list" else F.array_join(F.transform(F.map_entries(value), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), ", ")
    return F.when(text != "", text)


def merged(primary: DataFrame, others: DataFrame, types: list[str]) -> DataFrame:
    """The filtered records of a tree with all records of the types that are merged into it, unfiltered."""
    return primary.unionByName(others.filter(F.col("type").isin(types)))


def field_groups(fields: DataFrame, owner: str) -> DataFrame:
    """Per owner its shown fields by group: groups by their least order, then name; rows by order, then key.

    ``fields``: owner, key, label, group, order and value; fields without a value are left out,
    those without a group are in ``other``, those without an order come first.
    """
    shown = fields.filter("value IS NOT NULL").withColumns({"group": F.coalesce("group", F.lit("other")), "order": F.coalesce("order", F.lit(0)), "label": F.coalesce("label", "key")})
    rows = shown.groupBy(owner, "group").agg(F.min("order").alias("order"), F.array_sort(F.collect_list(F.struct("order", "key", "label", "value"))).alias("rows"))
    return rows.groupBy(owner).agg(F.array_sort(F.collect_list(F.struct("order", "group", "rows"))).alias("groups"))


def type_counts(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts (type, n) with their labels, types without records dropped, by label."""
    return labels.join(counts, "type").filter("n > 0").select("type", "label", "n").orderBy("label")
