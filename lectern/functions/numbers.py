"""Game-table arithmetic, number text and dice terms as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _signed(n: Column) -> Column:
    return F.concat(F.when(n >= 0, "+").otherwise(""), n.cast("string"))


def attack_cell(level: Column, kind: Column) -> Column:
    """Base attack text: good L, average 3L/4, poor L/2; further attacks at -5 while positive, four at most."""
    base = F.when(kind == "good", level).when(kind == "average", F.floor(level * 3 / 4)).otherwise(F.floor(level / 2)).cast("int")
    steps = F.filter(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: base - 5 * k), lambda v: v > 0)
    return F.when(F.size(steps) == 0, F.lit("+0")).otherwise(F.array_join(F.transform(steps, _signed), "/"))


def save_cell(level: Column, kind: Column) -> Column:
    """Save text: good 2 + L/2, poor L/3."""
    return _signed(F.when(kind == "good", 2 + F.floor(level / 2)).otherwise(F.floor(level / 3)).cast("int"))


def fraction(text: Column) -> Column:
    """1/2 as 0.5; plain numbers as they are; else null."""
    parts = F.split(F.trim(text), "/", -1)
    top, bottom = F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")
    return F.when(F.size(parts) == 1, top).when((F.size(parts) == 2) & (bottom != 0), top / bottom)


def dice_terms(text: Column) -> Column:
    """Structs count, die, bonus of every term such as 3d8+6 or 1/2d4."""
    pattern = r"([0-9]+(?:/[0-9]+)?)d([0-9]+)(?:\s*([+-])\s*([0-9]+)(?![0-9]*d))?"
    part = lambda k: F.regexp_extract_all(text, F.lit(pattern), F.lit(k))
    zipped = F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), part(4).alias("d"))
    return F.transform(
        zipped,
        lambda z: F.struct(
            fraction(z["a"]).alias("count"),
            z["b"].cast("int").alias("die"),
            F.coalesce(F.concat(z["c"], z["d"]).try_cast("int"), F.lit(0)).alias("bonus"),
        ),
    )


def ordinal(text: Column) -> Column:
    """1st as 1, or null."""
    return F.regexp_extract(text, r"^\s*([0-9]+)(?:st|nd|rd|th)\b", 1).try_cast("int")


def number_text(n: Column) -> Column:
    """3.0 as 3; fractions as they are."""
    d = n.cast("double")
    return F.when(d == F.floor(d), F.floor(d).cast("long").cast("string")).otherwise(d.cast("string"))


def overlap(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a_high, b_high) - F.greatest(a_low, b_low))


def upper_median(values: Column) -> Column:
    """Element n // 2 of the sorted values (the upper of two middle ones)."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))
