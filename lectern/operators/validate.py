"""Validation: every check is a column of error messages, composed without actions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import numbers, text

ERRORS = "array<string>"
KINDS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "boolean": "BOOLEAN", "object": "OBJECT.*", "array": "ARRAY.*", "null": "VOID"}


def none() -> Column:
    return F.array().cast(ERRORS)


def check(broken: Column, message: Column | str) -> Column:
    said = F.lit(message) if isinstance(message, str) else message
    return F.when(F.coalesce(broken, F.lit(False)), F.array(said)).otherwise(none())


def all_errors(*checks: Column) -> Column:
    return F.array_sort(F.concat(*checks))


def schema_errors(value: Column, schema: dict, path: str | Column = "$") -> Column:
    """Messages for a variant against the used part of JSON Schema.

    type, enum, const, required, properties, additionalProperties, items, minimum, maximum,
    minLength, minItems, allOf and if/then are compiled to expressions.  A value, its type and its
    keys are bound once for all checks on them.
    """
    needed = {"v": value}
    if "type" in schema or "minLength" in schema:
        needed["kind"] = F.schema_of_variant(value)
    if any(k in schema for k in ("required", "properties", "additionalProperties", "allOf")):
        needed["keys"] = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    once = F.array(F.struct(*(c.alias(n) for n, c in needed.items())))
    return F.flatten(F.transform(once, lambda x: _schema_errors({n: x[n] for n in needed}, schema, path)))


def _schema_errors(at: dict[str, Column], schema: dict, path: str | Column) -> Column:
    value, here = at["v"], path if isinstance(path, Column) else F.lit(path)
    say = lambda what: F.concat(here, F.lit(f": {what}"))
    out = []
    if "type" in schema:
        wanted = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        out.append(check(value.isNull() | ~at["kind"].rlike("^(" + "|".join(KINDS[w] for w in wanted) + ")$"), say("is not of type " + " or ".join(wanted))))
    for key in ("enum", "const"):
        if key in schema:
            allowed = schema[key] if key == "enum" else [schema[key]]
            out.append(check(~F.to_json(value).isin([json.dumps(a, separators=(",", ":"), ensure_ascii=False) for a in allowed]), say(f"is not in {json.dumps(allowed)}")))
    number = F.try_variant_get(value, "$", "double")
    if "minimum" in schema:
        out.append(check(number < schema["minimum"], say(f"is less than {schema['minimum']}")))
    if "maximum" in schema:
        out.append(check(number > schema["maximum"], say(f"is more than {schema['maximum']}")))
    if "minLength" in schema:
        out.append(check((at["kind"] == "STRING") & (F.length(F.try_variant_get(value, "$", "string")) < schema["minLength"]), say(f"is shorter than {schema['minLength']}")))
    if "minItems" in schema or "items" in schema:
        items = F.try_variant_get(value, "$", "array<variant>")
        if "minItems" in schema:
            out.append(check(F.size(items) < schema["minItems"], say(f"has fewer than {schema['minItems']} items")))
        if schema.get("items"):
            inner = lambda x, i: schema_errors(x, schema["items"], F.concat(here, F.lit("["), i.cast("string"), F.lit("]")))
            out.append(F.coalesce(F.flatten(F.transform(items, inner)), none()))
    for name in schema.get("required", []):
        out.append(check(~F.array_contains(at["keys"], name), say(f"lacks {name}")))
    for name, inner_schema in schema.get("properties", {}).items():
        found = schema_errors(F.try_variant_get(value, f"$['{name}']", "variant"), inner_schema, F.concat(here, F.lit(f".{name}")))
        out.append(F.when(F.coalesce(F.array_contains(at["keys"], name), F.lit(False)), found).otherwise(none()))
    if schema.get("additionalProperties") is False:
        extra = F.array_except(at["keys"], F.array(*map(F.lit, schema.get("properties", {}))).cast(ERRORS))
        out.append(F.coalesce(F.transform(extra, lambda k: F.concat(here, F.lit(": has unknown "), k)), none()))
    for rule in schema.get("allOf", []):
        # rules on the same value share its keys; what else they need is bound inside
        part = lambda s: _schema_errors(at, s, path) if "type" not in s and "minLength" not in s else schema_errors(value, s, path)
        if "if" in rule:
            out.append(F.when(F.size(part(rule["if"])) == 0, part(rule["then"])).otherwise(none()))
        else:
            out.append(part(rule))
    return F.concat(*out) if out else none()


def rectangular(columns: Column, rows: Column) -> Column:
    """Every row has a cell for every column."""
    bad = F.filter(F.transform(rows, lambda r, i: F.when(F.size(r) != F.size(columns), F.concat(F.lit("row "), i.cast("string"), F.lit(" has "), F.size(r).cast("string"), F.lit(" cells")))), lambda m: m.isNotNull())
    return bad


def one_blank_style(columns: Column, rows: Column) -> Column:
    """No column has both blank and dash cells."""

    def mixed(name: Column, k: Column) -> Column:
        cells = F.transform(rows, lambda r: text.cell_key(F.coalesce(F.get(r, k), F.lit("x"))))
        return F.when(F.exists(cells, lambda c: c == "") & F.exists(cells, lambda c: c == "-"), F.concat(F.lit("column "), name, F.lit(" mixes blank and dash")))

    return F.filter(F.transform(columns, mixed), lambda m: m.isNotNull())


def envelope(type_: Column, directory: Column, name: Column, slug: Column, version: Column, current: int) -> Column:
    return F.concat(
        check(type_ != directory, "type differs from its folder"),
        check(slug != text.slugify(name), "slug does not follow from the name"),
        check(version != current, "schema version is not current"),
    )


def override_name(name: Column, target: Column, page: Column) -> Column:
    paged = F.concat(target, F.lit(" (p. "), page.cast("string"), F.lit(")"))
    return check(~((name == target) | (name == paged)), "name is not its target")


def pages_within(pages: Column, allowed: Column) -> Column:
    return F.transform(F.array_except(pages, allowed), lambda p: F.concat(F.lit("page "), p.cast("string"), F.lit(" is outside the segment")))


def source_pages(first: Column, last: Column, pages: Column) -> Column:
    return check((first != F.array_min(pages)) | (last != F.array_max(pages)), "source pages are not those of the pages")


def hit_dice(count: Column, hp: Column, dice_text: Column) -> Column:
    """Dice in the text add up to the count, and its average to the hit points."""
    terms = numbers.dice_terms(dice_text)
    total = F.aggregate(terms, F.lit(0.0), lambda a, t: a + t["count"])
    mean = F.aggregate(terms, F.lit(0.0), lambda a, t: a + F.when(t["count"] < 1, 0.5 * (t["die"] + 1) / 2).otherwise(t["count"] * (t["die"] + 1) / 2) + t["bonus"])
    return F.concat(check(F.abs(total - count) > 0.005, "dice do not add up to the count"), check(F.abs(F.floor(mean) - hp) > 1, "hit points are not the dice's average"))


def challenge(number: Column, shown: Column) -> Column:
    return check(F.abs(numbers.fraction(shown) - number) > 0.005, "rating differs from its text")


def unique_sections(sections: Column) -> Column:
    return check(F.size(F.array_distinct(F.transform(sections, lambda s: F.lower(s)))) < F.size(sections), "sections repeat")


def progression(rows: DataFrame, key: list[str], level: str, attack: str, kind: str) -> DataFrame:
    """Level rows whose level does not follow from its row number or whose attack cell is not that of its kind."""
    from pyspark.sql.window import Window as W

    numbered = rows.withColumn("expected_level", F.row_number().over(W.partitionBy(*key).orderBy(level)))
    wanted = numbers.attack_cell(F.col("expected_level"), F.col(kind))
    return numbered.withColumn("errors", F.concat(check(F.col(level) != F.col("expected_level"), "levels have a gap"), check(text.cell_key(F.col(attack)) != wanted, "attack cell is off"))).filter("size(errors) > 0")


def traceable(cell: Column, source: Column) -> Column:
    """A cell is found in the source text.

    Blank and dash cells pass.  Cells without three letters in a row must be a substring; others
    may also be an ordered run of tokens, each a prefix of a source token or the other way round.
    """
    c, s = text.plain_table_text(cell), text.plain_table_text(source)
    wanted = F.filter(F.split(c, " ", -1), lambda t: t != "")

    def advance(at: Column, token: Column) -> Column:
        next_ = F.get(wanted, at)
        hit = (at < F.size(wanted)) & (F.startswith(token, next_) | (F.startswith(next_, token) & (F.length(token) >= 3)))
        return F.when(hit, at + 1).otherwise(at)

    ordered = F.aggregate(F.split(s, " ", -1), F.lit(0), advance) == F.size(wanted)
    return (c == "") | (c == "-") | F.contains(s, c) | (c.rlike("[a-z]{3}") & ordered)


def group_verdict(results: DataFrame, group: list[str]) -> DataFrame:
    """Records of a segment pass or fail together."""
    return results.groupBy(*group).agg(F.bool_and(F.size("errors") == 0).alias("passed"), F.sum(F.size("errors")).alias("n_errors"))


# What a record of a type must have, and why it fails.
PRESENT = {"spell": {"levels": "levels must be a non-empty list", "school": "school must be a non-empty string"}, "feat": {"benefit": "benefit must be a non-empty string"}, "rules_section": {"topic": "topic must be a non-empty string"}}
SAVES, ABILITIES = ["fort", "ref", "will"], ["str", "dex", "con", "int", "wis", "cha"]
PRINTED_HP = r"(?i)\(\s*([0-9]+)\s*hp\s*\)"


def present(type_: str, fields: Column) -> Column:
    """Messages for the fields (a variant) that a record of the type must have."""
    is_object = F.schema_of_variant(fields).startswith("OBJECT")
    out = []
    for name, message in PRESENT[type_].items():
        at = f"$.{name}"
        full = F.size(F.try_variant_get(fields, at, "array<variant>")) > 0 if name == "levels" else (F.schema_of_variant(F.try_variant_get(fields, at, "variant")) == "STRING") & (F.trim(F.try_variant_get(fields, at, "string")) != "")
        out.append(check(~F.coalesce(full, F.lit(False)), message))
    return F.when(F.coalesce(is_object, F.lit(False)), F.concat(*out)).otherwise(F.array(F.lit("fields is missing or not an object")))


def _integer(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).isin("BIGINT", "INT"), F.lit(False))


def scores(fields: Column) -> Column:
    """Messages for a monster's saves, all of them whole numbers, and abilities, each a whole number or null."""
    part = lambda of, key: F.try_variant_get(fields, f"$.{of}.{key}", "variant")
    keys = lambda of: F.map_keys(F.try_variant_get(fields, f"$.{of}", "map<string,variant>"))
    object_ = lambda of: F.coalesce(F.schema_of_variant(F.try_variant_get(fields, f"$.{of}", "variant")).startswith("OBJECT"), F.lit(False))
    saves = F.concat(*(check(~_integer(part("saves", k)), f"saves.{k} is missing or not an integer") for k in SAVES))

    def ability(k: str) -> Column:
        there = F.coalesce(F.array_contains(keys("abilities"), k), F.lit(False))
        odd = ~_integer(part("abilities", k)) & ~F.coalesce(F.schema_of_variant(part("abilities", k)) == "VOID", F.lit(True))
        return F.concat(check(~there, f"abilities.{k} is missing"), check(there & odd, f"abilities.{k} is neither an integer nor null"))

    return F.concat(
        F.when(object_("saves"), saves).otherwise(F.array(F.lit("saves is missing or not an object"))),
        F.when(object_("abilities"), F.concat(*map(ability, ABILITIES))).otherwise(F.array(F.lit("abilities is missing or not an object"))),
    )


def printed_hit_points(hp: Column, die: Column, dice_text: Column) -> Column:
    """Hit points and die agree with those printed in the dice line, where it prints them."""
    printed = F.regexp_extract(dice_text, PRINTED_HP, 1)
    first = F.get(numbers.dice_terms(dice_text), F.lit(0))["die"]
    return F.concat(check((printed != "") & (printed.try_cast("bigint") != hp), "hit points differ from those printed"), check(die.isNotNull() & (first != die), "die differs from the first one printed"))


def group_name(name: Column, group: Column, variant: Column) -> Column:
    """A grouped entry has a group and a label, and is named by both."""
    has = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    return F.concat(check(has(group) != has(variant), "group and variant label must be set together"), check(has(group) & has(variant) & (name != F.concat_ws(", ", group, variant)), "name is not group and variant label"))
