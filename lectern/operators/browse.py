"""Filtered, sorted, paged lists and facet counts over records and their flattened fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.numbers import number_text

MAX_PAGE_SIZE, PAGE_SIZE = 200, 50


@dataclass
class Query:
    filters: dict[str, list[str]] = field(default_factory=dict)
    sort: str | None = None
    descending: bool = False
    page: int = 1
    page_size: int = PAGE_SIZE


def parse_query(pairs: Sequence[tuple[str, str]], filterable: Sequence[str], sortable: Sequence[str]) -> Query:
    """Request parameters to a query; unknown keys and bad pages are errors."""
    out = Query()
    for key, value in pairs:
        if key == "sort":
            out.sort, out.descending = value.removeprefix("-"), value.startswith("-")
            if out.sort not in {"name", *sortable}:
                raise ValueError(f"cannot sort by {out.sort!r}")
        elif key in {"page", "page_size"}:
            if not value.isdecimal() or int(value) < 1:
                raise ValueError(f"{key} must be a positive number")
            setattr(out, key, min(int(value), MAX_PAGE_SIZE) if key == "page_size" else int(value))
        elif key in filterable:
            out.filters.setdefault(key, []).append(value)
        else:
            raise ValueError(f"unknown parameter {key!r}")
    return out


def where_field(records: DataFrame, eav: DataFrame, id_col: str, key: str, values: Sequence[str], numeric: bool = False) -> DataFrame:
    """Records with a row of ``key`` whose value is one of ``values``, case aside; numbers by value."""
    rows = eav.filter(F.col("key") == key)
    if numeric:
        numbers = [float(v) for v in values if _is_number(v)]
        rows = rows.filter(F.col("num_value").isin(numbers)) if numbers else rows.filter(F.lit(False))
    else:
        rows = rows.filter(F.lower("text_value").isin([v.lower() for v in values]))
    return records.join(rows.select(F.col("record_id").alias(id_col)), id_col, "left_semi")


def _is_number(v: str) -> bool:
    try:
        float(v)
        return True
    except ValueError:
        return False


def same_element(elements: Column, wanted: Mapping[str, Sequence]) -> Column:
    """One element of an array of structs has a wanted value in every named field."""

    def test(e: Column) -> Column:
        out = F.lit(True)
        for name, values in wanted.items():
            value = F.lower(e[name]) if all(isinstance(v, str) for v in values) else e[name]
            out = out & value.isin([v.lower() if isinstance(v, str) else v for v in values])
        return out

    return F.exists(elements, test)


def any_element(elements: Column, wanted: Mapping[str, Sequence]) -> Column:
    """Every named field has a wanted value in some element, not always the same one."""
    out = F.lit(True)
    for name, values in wanted.items():
        out = out & same_element(elements, {name: values})
    return out


def sort_by_name(records: DataFrame, name: str, id_col: str, descending: bool = False) -> DataFrame:
    way = F.desc if descending else F.asc
    return records.withColumn("_name", F.lower(name)).orderBy(way("_name"), way(id_col)).drop("_name")


def sort_by_field(records: DataFrame, eav: DataFrame, id_col: str, key: str, descending: bool = False) -> DataFrame:
    """By the first value of a field, missing ones first when ascending; then by id."""
    first = eav.filter(F.col("key") == key).groupBy("record_id").agg(F.min_by(F.struct("num_value", "text_value"), "ord").alias("_v"))
    joined = records.join(first.withColumnRenamed("record_id", id_col), id_col, "left")
    way = (F.desc_nulls_last if descending else F.asc_nulls_first)
    return joined.orderBy(way("_v.num_value"), way("_v.text_value"), F.asc(id_col)).drop("_v")


def page(sorted_records: DataFrame, number: int, size: int) -> DataFrame:
    size = min(size, MAX_PAGE_SIZE)
    return sorted_records.offset((number - 1) * size).limit(size)


def facet(records: DataFrame, eav: DataFrame, id_col: str, key: str, numeric: bool = False) -> DataFrame:
    """Distinct records by value: count down, then value."""
    value = number_text(F.col("num_value")) if numeric else F.col("text_value")
    rows = eav.filter(F.col("key") == key).select(F.col("record_id").alias(id_col), value.alias("value"))
    return rows.join(records.select(id_col), id_col, "left_semi").groupBy("value").agg(F.countDistinct(id_col).alias("n"))


def facet_bundle(records: DataFrame, columns: Mapping[str, str], filters: Mapping[str, Column]) -> DataFrame:
    """All facets of single-valued columns in one scan: (facet, value, n).

    Each facet counts the rows that pass every filter but its own.  A row is expanded once per
    facet that it counts in; one aggregation with map-side combining makes all counts.
    """
    flags = records.select(*(F.col(c).cast("string").alias(f"v_{name}") for name, c in columns.items()), *(F.coalesce(cond, F.lit(False)).alias(f"f_{name}") for name, cond in filters.items()))
    rows = []
    for name in columns:
        passes = F.lit(True)
        for other in filters:
            if other != name:
                passes = passes & F.col(f"f_{other}")
        rows.append(F.when(passes, F.struct(F.lit(name).alias("facet"), F.col(f"v_{name}").alias("value"))))
    each = flags.select(F.explode(F.array_compact(F.array(*rows))).alias("x"))
    return each.groupBy("x.facet", "x.value").agg(F.count(F.lit(1)).alias("n"))
