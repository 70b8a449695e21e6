"""Checks of records against the text that they were taken from.

Records and their segment's text come joined in one row; a null or blank text passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lectern.functions import text as T
from lectern.operators.validate import ERRORS, check, none

# Shapes of printed headings, and labels in a class entry that name no feature.
ABILITY_TAG = r"\s*(?:\((?:ex|su|sp)\))?\s*:"
RUN_IN = r"([A-Z][A-Za-z'\x{2019},()/ -]{1,59}):"
SENTENCE_END = r"[.!?][)\]\"\x{201d}\x{2019}]*$"
HEADING_TOKENS, SHORT_TOKEN, CAPS_CHARS, PROSE_WORDS = 8, 3, 60, 20
FEATURE_SHARE = 0.75
TIERS = ["greater", "improved", "lesser", "mighty", "tireless", "superior", "mass", "advanced"]
NO_FEATURE = [
    "Weapon and Armor Proficiency", "Note", "Notes", "Exception", "Exceptions", "Example", "Examples", "Special",
    "Abilities", "Alignment", "Hit Die", "Class Skills", "Class Features", "Other Features",
    "Skill Points at 1st Level", "Skill Points at Each Additional Level", "Adventures", "Characteristics", "Religion",
    "Background", "Races", "Other Classes", "Role", "Starting Package", "Skill Selection", "Armor", "Weapon",
    "Weapons", "Gear", "Spells Known", "Spells Prepared", "Deity/Domains",
]


def heading_words(text: Column) -> Column:
    """A printed heading for comparison: no parentheticals, lower case, singular words."""
    plain = F.trim(F.lower(F.regexp_replace(F.regexp_replace(text, r"\([^()]*\)", " "), "[^0-9A-Za-z]+", " ")))
    return F.array_join(F.transform(F.split(plain, " "), T.singular), " ")


def _literal(text: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("")), F.lit("\\E"))


def prints_run_in(text: Column, name: Column) -> Column:
    """``name`` stands in ``text`` as a heading with a colon; both as plain table text."""
    return (name != "") & F.regexp_like(text, F.concat(_literal(name), F.lit(ABILITY_TAG)))


def described_by(token: Column, feature: Column) -> Column:
    """The feature's words are a run of the token's, and what is left names no other tier of it."""
    padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    at = F.position(padded(feature), padded(token))
    left = F.concat(F.left(padded(token), at), F.substring(padded(token), at + F.length(feature) + 1, F.length(token) + 2))
    return (token != "") & (feature != "") & (at > 0) & ~F.arrays_overlap(F.split(left, " "), F.array(*map(F.lit, TIERS)))


def monster_errors(name: Column, group: Column, variant: Column, abilities: Column, tokens: Column, missing: Column, text: Column) -> Column:
    """The heading is printed (of grouped records the variant will do), abilities are printed
    run-in, tokens printed run-in are among the abilities, and ``missing`` scores show a dash."""
    plain = T.plain_table_text(text)
    has = lambda what: F.contains(plain, T.plain_table_text(what))
    grouped = F.coalesce(group.isNotNull() & has(variant), F.lit(False))
    heading = check(~has(name) & ~grouped, "heading is not printed")
    said = lambda what, a: F.concat(F.lit(f"{what} "), a)
    unprinted = F.transform(F.filter(abilities, lambda a: ~prints_run_in(plain, T.plain_table_text(a))), lambda a: F.concat(F.lit("ability is not printed: "), a))
    known = lambda t: F.exists(abilities, lambda a: described_by(T.special_token(t), T.special_token(a)))
    dropped = F.transform(F.filter(tokens, lambda t: ~t.rlike(r"^\s*(?:\p{Pd}|\x{2212})?\s*$") & ~known(t) & prints_run_in(plain, T.plain_table_text(t))), lambda t: F.concat(F.lit("described but not recorded: "), t))
    dashless = F.transform(F.filter(missing, lambda k: ~F.regexp_like(plain, F.concat(F.lit(r"\b"), _literal(F.lower(k)), F.lit(r"\s*-")))), lambda k: said("no dash for", k))
    empty = lambda c: F.coalesce(c, none())
    found = F.concat(heading, empty(unprinted), empty(dropped), empty(dashless))
    return F.when(F.coalesce(F.trim(text) != "", F.lit(False)), found).otherwise(none())


def template_errors(applies_to: Column, modifications: Column) -> Column:
    """``applies_to`` is there; modifications (section, text_md) are there, labelled, filled and distinct."""
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    labels = F.transform(F.filter(modifications, lambda m: ~blank(m["section"])), lambda m: heading_words(m["section"]))
    return F.concat(
        check(blank(applies_to), "applies_to is empty"),
        check(F.coalesce(F.size(modifications) == 0, F.lit(True)), "modifications are empty"),
        check(F.exists(modifications, lambda m: blank(m["section"])), "a modification has no section"),
        check(F.exists(modifications, lambda m: ~blank(m["section"]) & blank(m["text_md"])), "a modification has no text"),
        check(F.size(F.array_distinct(labels)) < F.size(labels), "sections repeat"),
    )


def is_caps_heading(line: Column) -> Column:
    return ~F.contains(line, F.lit("\t")) & (F.length(line) <= CAPS_CHARS) & line.rlike("[A-Z]") & ~line.rlike("[a-z]")


def _shaped(heading: Column) -> Column:
    tokens = T.words(heading)
    word = lambda t: F.regexp_replace(t, "^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "")
    return F.size(tokens).between(1, HEADING_TOKENS) & F.forall(tokens, lambda t: (F.length(word(t)) <= SHORT_TOKEN) | word(t).rlike("^[A-Z]"))


def run_ins(paragraph: Column) -> Column:
    """Structs heading and span (what follows it up to the next) of a paragraph's run-in headings.

    The first struct has a null heading and what comes before any.
    """
    found, pieces = F.regexp_extract_all(paragraph, F.lit(RUN_IN), F.lit(1)), F.split(paragraph, RUN_IN, -1)
    one = "array<struct<heading:string,span:string>>"
    start = F.array(F.struct(F.lit(None).cast("string").alias("heading"), F.get(pieces, F.lit(0)).alias("span"))).cast(one)
    steps = F.transform(found, lambda h, i: F.struct(h.alias("h"), F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"), i.alias("i")))

    def add(acc: Column, x: Column) -> Column:
        lead = F.regexp_replace(x["before"], r"\s+$", "")
        opens = _shaped(F.trim(x["h"])) & (((x["i"] == 0) & (lead == "")) | lead.rlike(SENTENCE_END))
        last = F.element_at(acc, -1)
        fresh = F.concat(acc, F.array(F.struct(F.trim(x["h"]).alias("heading"), x["after"].alias("span"))).cast(one))
        longer = F.struct(last["heading"].alias("heading"), F.concat(last["span"], x["h"], F.lit(":"), x["after"]).alias("span"))
        return F.when(opens, fresh).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer).cast(one)))

    return F.aggregate(steps, start, add)


def class_errors(records: DataFrame, id_col: str = "id") -> DataFrame:
    """``id`` and sorted ``errors`` of class records with id, name, features (name, text_md), sections (headings) and text.

    Printed Ex- and starting package headings are recorded; every run-in heading among the class
    features is a feature or a known label; a feature's text has three quarters of its printed
    words or more, a column break's continuation included; a printed Abilities label is a section.
    """
    has = records.filter((F.trim("text") != "") & (F.trim("name") != ""))
    name = _literal(F.col("name"))
    extra = F.concat(F.lit(r"(?i)^(?:(?:[A-Za-z'\x{2019}-]+\s+)*"), name, F.lit(r"(?:es|s)?\s+Starting\s+Package|Ex[-\x{2010}-\x{2015}]"), name, F.lit(r"(?:es|s)?)$"))
    rows = has.withColumn("lines", F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s+|\s+$", "")))).withColumn("extra", extra)
    is_extra = lambda x: F.regexp_like(x, F.col("extra"))
    recorded = F.transform(F.concat(F.coalesce("sections", none()), F.coalesce(F.col("features")["name"], none())), heading_words)
    rows = rows.withColumn("unrecorded", F.array_distinct(F.filter("lines", lambda x: is_extra(x) & ~F.array_contains(recorded, heading_words(x)))))
    first = lambda test: F.array_position(F.transform("lines", test), F.lit(True))
    opens = lambda x: (F.lower(x) == "class features") | F.lower(x).startswith("all of the following are class features")
    rows = rows.withColumns({"at": first(opens), "rules_at": first(lambda x: F.lower(x) == "game rule information")})
    rest = lambda at: F.slice("lines", F.col(at) + 1, F.size("lines"))
    until = lambda at, ends: F.array_position(F.transform(rest(at), ends), F.lit(True))
    rows = rows.withColumns({"end": until("at", lambda x: is_extra(x) | is_caps_heading(x)), "rules_end": until("rules_at", lambda x: (F.lower(x) == "class skills") | is_caps_heading(x))})
    cut = lambda at, end: F.when(F.col(at) > 0, F.when(F.col(end) > 0, F.slice("lines", F.col(at), F.col(end).cast("int"))).otherwise(F.slice("lines", F.col(at), F.size("lines")))).otherwise(none())
    label = F.exists(cut("rules_at", "rules_end"), lambda p: F.exists(run_ins(p), lambda r: F.coalesce(heading_words(r["heading"]) == heading_words(F.lit("Abilities")), F.lit(False))))
    listed = F.array_contains(F.transform(F.coalesce("sections", none()), heading_words), heading_words(F.lit("Abilities")))
    whole = F.concat(F.transform("unrecorded", lambda x: F.concat(F.lit("section is not recorded: "), x)), check(label & ~listed, "abilities are not recorded"))
    rows = rows.select(F.col(id_col).alias("id"), "features", whole.alias("whole"), cut("at", "end").alias("window"))

    each = rows.select("id", "features", F.posexplode("window").alias("i", "p")).withColumn("parts", run_ins(F.col("p")))
    prose = ~F.contains("p", F.lit("\t")) & (F.size(T.words(F.col("p"))) >= PROSE_WORDS)
    each = each.withColumns({"open": prose & ~F.col("p").rlike(SENTENCE_END), "goes_on": prose & F.col("p").rlike(r"^\p{Ll}"), "hyphen": F.col("p").rlike(r"[A-Za-z][-\x{2010}\x{2011}]$")})
    mine = W.partitionBy("id")
    alone = (F.count_if("open").over(mine) == 1) & (F.count_if("goes_on").over(mine) == 1) & ~F.col("goes_on")
    tail = F.max(F.when(F.col("goes_on"), F.get("parts", F.lit(0))["span"])).over(mine)
    each = each.withColumn("tail", F.when(alone & F.col("open") & F.col("hyphen"), tail))
    heads = each.select("id", "features", "tail", F.size("parts").alias("n"), F.posexplode("parts").alias("k", "part")).filter("part.heading IS NOT NULL")
    key = heading_words(F.col("part.heading"))
    printed = F.when(F.col("k") == F.col("n") - 1, F.concat_ws(" ", "part.span", "tail")).otherwise(F.col("part.span"))
    feature = F.get(F.filter("features", lambda f: heading_words(f["name"]) == F.col("key")), F.lit(0))
    heads = heads.withColumns({"key": key, "words": F.size(T.words(printed))}).withColumn("feature", feature)
    lone = F.col("feature").isNull() & ~F.array_contains(F.transform(F.array(*map(F.lit, NO_FEATURE)), heading_words), F.col("key"))
    short = (F.col("words") > 0) & (F.size(T.words(F.coalesce("feature.text_md", F.lit("")))) < FEATURE_SHARE * F.col("words"))
    error = F.when(lone, F.concat(F.lit("heading is no feature: "), "part.heading")).when(F.col("feature").isNotNull() & short, F.concat(F.lit("feature is condensed: "), "part.heading"))
    parts = heads.select("id", error.alias("e")).filter("e IS NOT NULL").union(rows.select("id", F.explode("whole").alias("e")))
    return parts.groupBy("id").agg(F.array_sort(F.collect_list("e")).cast(ERRORS).alias("errors"))
