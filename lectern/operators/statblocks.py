"""Checks of classes against their level tables, of monsters against themselves, and of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import numbers
from lectern.functions import text as T
from lectern.operators.sourcetext import described_by
from lectern.operators.validate import check, none

# What a stat block may say, and the columns of a level table.
SIZES = ["Fine", "Diminutive", "Tiny", "Small", "Medium", "Large", "Huge", "Gargantuan", "Colossal"]
TYPES = [
    "Aberration", "Animal", "Construct", "Dragon", "Elemental", "Fey", "Giant", "Humanoid", "Magical Beast",
    "Monstrous Humanoid", "Ooze", "Outsider", "Plant", "Undead", "Vermin",
]
SUBTYPES = [
    "Air", "Angel", "Aquatic", "Archon", "Augmented", "Baatezu", "Chaotic", "Cold", "Demon", "Devil", "Dwarf", "Earth",
    "Eladrin", "Elf", "Evil", "Extraplanar", "Fire", "Formian", "Giant", "Gnoll", "Gnome", "Goblinoid", "Good",
    "Guardinal", "Halfling", "Human", "Incorporeal", "Inevitable", "Lawful", "Lycanthrope", "Native", "Orc",
    "Reptilian", "Shapechanger", "Slaadi", "Swarm", "Tanar'ri", "Water", "Yugoloth",
]
TABLE_COLUMNS = {"level": "Level", "attack": "Base Attack Bonus", "fort": "Fort Save", "ref": "Ref Save", "will": "Will Save"}
SPELL_COLUMN, SPELL_SLOT = "(?i)per day|known|points", r"(?i)per day\s+([0-9]+)(?:st|nd|rd|th)?\s*$"
ZERO_FROM = 5


def slot_levels(columns: Column) -> Column:
    """Spell levels that headers such as Spells per Day 3rd name."""
    found = F.transform(columns, lambda c: F.regexp_extract(c, SPELL_SLOT, 1).try_cast("int"))
    return F.array_distinct(F.filter(found, lambda n: n.isNotNull()))


def level_cell(cell: Column) -> Column:
    """1st or 1 as 1, or null."""
    return F.regexp_extract(F.trim(cell), "^([0-9]+)(?:st|nd|rd|th)?$", 1).try_cast("int")


def class_table_errors(classes: DataFrame, tables: DataFrame) -> DataFrame:
    """``id`` and ``errors`` of classes against their level tables.

    ``classes``: id, level_table, tables (ids), max_level, attack (good, average, poor), saves (struct
    fort, ref, will: good or poor), features (name, level, text_md), caster, base.  ``tables``: id, columns, rows.
    """
    found = tables.select(F.col("id").alias("level_table"), "columns", "rows", F.lit(True).alias("_there"))
    rows = classes.join(found, "level_table", "left")
    for key in [*TABLE_COLUMNS, "special"]:
        at = F.array_position(F.transform("columns", lambda c: F.contains(F.lower(c), F.lit(key))), F.lit(True))  # noqa: B023
        rows = rows.withColumn(f"_{key}", at - 1)
    cell = lambda r, key: F.when(F.col(f"_{key}") >= 0, F.get(r, F.col(f"_{key}").cast("int")))
    levels = F.filter(F.transform("rows", lambda r: level_cell(cell(r, "level"))), lambda n: n.isNotNull())
    rows = rows.withColumns({"_levels": levels, "_slots": slot_levels(F.col("columns"))})

    def wrong(key: str, label: str, expected) -> Column:
        bad = F.filter("rows", lambda r: F.coalesce(T.cell_key(cell(r, key)) != expected(level_cell(cell(r, "level"))), F.lit(False)))
        return F.transform(bad, lambda r: F.concat(F.lit(f"{label} is off at level "), level_cell(cell(r, "level")).cast("string")))

    tokens = F.flatten(F.transform(F.filter("rows", lambda r: level_cell(cell(r, "level")).isNotNull() & cell(r, "special").isNotNull()), lambda r: T.split_outside_parentheses(cell(r, "special"))))
    named = F.transform("features", lambda f: T.special_token(f["name"]))
    rows = rows.withColumns({"_tokens": F.array_distinct(F.transform(tokens, T.special_token)), "_named": named})
    lone = F.filter("_tokens", lambda t: ~F.exists("_named", lambda n: described_by(t, n)))
    repeated = F.filter(F.array_distinct("_named"), lambda n: F.size(F.filter("_named", lambda m: m == n)) > 1)
    say = lambda items, label: F.coalesce(F.transform(items, lambda x: F.concat(F.lit(label), x)), none())
    empty = lambda c: F.coalesce(c, none())
    there = F.coalesce("_there", F.lit(False))
    expected_levels = F.sequence(F.lit(1), F.greatest(F.col("max_level"), F.lit(1)))
    table_errors = F.concat(
        check(~F.array_contains(F.coalesce("tables", none()), F.col("level_table")), "level table is not listed"),
        check(F.col("caster") & ~F.exists("columns", lambda c: c.rlike(SPELL_COLUMN)), "no spell column"),
        check(F.col("caster") & F.col("base") & (F.array_max("_slots") >= ZERO_FROM) & ~F.array_contains("_slots", 0), "no column of level 0 spells"),
        *(check(F.col(f"_{key}") < 0, f"no {label} column") for key, label in TABLE_COLUMNS.items()),
        check((F.col("_level") >= 0) & (F.size("rows") != F.col("max_level")), "rows are not as many as levels"),
        check((F.col("_level") >= 0) & (F.col("_levels") != expected_levels), "levels have a gap"),
        empty(wrong("attack", "attack", lambda n: F.when(F.col("attack").isin("good", "average", "poor"), numbers.attack_cell(n, F.col("attack"))))),
        *(empty(wrong(k, k, lambda n, k=k: F.when(F.col(f"saves.{k}").isin("good", "poor"), numbers.save_cell(n, F.col(f"saves.{k}"))))) for k in ("fort", "ref", "will")),
        say(lone, "no feature for "),
        say(F.transform(F.filter("features", lambda f: f["level"].isNotNull() & ~F.array_contains("_levels", f["level"])), lambda f: f["name"]), "level is not in the table: "),
        say(F.transform(F.filter("features", lambda f: F.coalesce(F.trim(f["text_md"]) == "", F.lit(True))), lambda f: f["name"]), "no text: "),
        say(repeated, "repeats: "),
        check(F.col("caster") & ~F.array_contains("_named", F.lit("spell")), "no Spells feature"),
    )
    return rows.select("id", F.array_sort(F.when(there, table_errors).otherwise(F.array(F.lit("level table is not found")))).alias("errors"))


def classification_errors(size: Column, type_: Column, subtypes: Column) -> Column:
    """Size and type are known as written; subtypes in any case, or Augmented and a type."""
    lower = lambda values: F.array(*(F.lit(v.lower()) for v in values))
    known = lambda s: F.array_contains(lower(SUBTYPES), F.lower(s)) | F.array_contains(lower(TYPES), F.trim(F.regexp_extract(F.lower(s), "^augmented (.*)$", 1)))
    return F.concat(
        check(F.coalesce(~size.isin(SIZES), F.lit(True)), "size is unknown"),
        check(F.coalesce(~type_.isin(TYPES), F.lit(True)), "type is unknown"),
        F.coalesce(F.transform(F.filter(subtypes, lambda s: ~known(s)), lambda s: F.concat(F.lit("subtype is unknown: "), s)), none()),
    )


def group_errors(name: Column, group: Column, variant: Column) -> Column:
    """Group and variant are both there or neither, and then make up the name."""
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    wanted = F.concat(F.trim(group), F.lit(", "), F.trim(variant))
    return F.concat(
        check(has(group) != has(variant), "group and variant go together"),
        check(has(group) & has(variant) & F.coalesce(F.lower(F.trim(name)) != F.lower(wanted), F.lit(True)), "name is not group and variant"),
    )


def stale(records: DataFrame, types: DataFrame) -> DataFrame:
    """Records whose version is missing or older than their type's (type, version), with it as ``current``.

    ``bumped`` says that the version is all that stands between a record and the current schema:
    ``errors_at_current`` are those of the record read as if it had the current version.
    """
    old = records.join(types.select("type", F.col("version").alias("current")), "type").filter(F.coalesce(F.col("schema_version") < F.col("current"), F.lit(True)))
    return old.withColumn("bumped", F.size("errors_at_current") == 0)
