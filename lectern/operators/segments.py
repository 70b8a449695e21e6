"""Contents entries, categories, headings, and cutting an ordered paragraph stream into segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

ENTRY = r"([^.\n\x{2022}][^.\n]*?)\s*(?:[.\x{2022}]\s*){3,}([0-9]{1,4})(?![0-9])"

# Title patterns of each category, in the order they are tried, without case.
CATEGORY_RULES = [
    ("Abilities|Description|Alignment|Ability Scores|Character Creation Summary|Vital Statistics", "character-creation"),
    ("Races?|Racial", "races"),
    ("Prestige Class(?:es)?", "prestige-classes"),
    ("Classes|Class Descriptions", "classes"),
    ("Monsters?|Creatures?|Animals|Vermin", "monsters"),
    ("Skills?", "skills"),
    ("Feats?", "feats"),
    ("Equipment|Goods and Services|Weapons|Armor|Wealth and Money", "equipment"),
    ("Combat|Initiative|Special Attacks|Injury and Death", "combat"),
    ("Adventuring|Movement|Exploration|Carrying Capacity|Treasure", "adventuring"),
    ("Magic|Spells|Spellcasting|Psionics", "magic"),
    ("Running the Game|Dungeon Master|Campaigns|Rewards|Traps", "running-the-game"),
    ("Introduction|Prologue|Foreword|Appendix|Glossary|Index|Character Sheet", "basics"),
]
UNCATEGORIZED = "uncategorized"


def contents_entries(text: Column) -> Column:
    """Structs title, printed of every ``Title ..... 12`` in a text."""
    part = lambda k: F.regexp_extract_all(text, F.lit(ENTRY), F.lit(k))
    both = F.arrays_zip(part(1), part(2))
    return F.transform(both, lambda z: F.struct(F.regexp_replace(F.trim(F.regexp_replace(z["0"], r"\s+", " ")), r"^[. ]+|[. ]+$", "").alias("title"), z["1"].cast("int").alias("printed")))


def is_contents_page(text: Column, number: Column) -> Column:
    return number.between(1, 12) & (F.size(contents_entries(text)) >= 3)


def category(title: Column, rules: list[tuple[str, str]] = CATEGORY_RULES, override: Column | None = None, chapter: Column | None = None) -> Column:
    """Override, else the chapter's category, else the first rule that matches, else none."""
    plain = F.regexp_replace(title, r"(?i)^Chapter\s+[0-9]+\s*:\s*", "")
    found = F.lit(None).cast("string")
    for pattern, key in reversed(rules):
        found = F.when(plain.rlike(f"(?i){pattern}"), key).otherwise(found)
    first = [c for c in (override, chapter) if c is not None]
    return F.coalesce(*first, found, F.lit(UNCATEGORIZED))


def entry_level(title: Column) -> Column:
    """1 for chapters, named front and back matter, appendices; else 2."""
    return F.when(title.rlike("(?i)^(Chapter [0-9]+:|Appendix|Introduction$|Glossary$|Index$)"), 1).otherwise(2)


def fill_headings(stream: DataFrame, by: list[str], pos: str, is_heading: Column, heading: Column) -> DataFrame:
    """``heading``: the latest heading at or before each paragraph."""
    w = W.partitionBy(*by).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    return stream.withColumn("heading", F.last(F.when(is_heading, heading), True).over(w))


def cut_segments(stream: DataFrame, by: list[str], pos: str, starts: Column, ends: Column) -> DataFrame:
    """``segment``: number of the trigger that a paragraph follows, null outside.

    A segment starts at a trigger and ends before the next trigger or ``ends`` paragraph.
    """
    w = W.partitionBy(*by).orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    mark = stream.withColumns({"_start": starts, "_end": ends & ~starts})
    numbered = mark.withColumn("_no", F.sum(F.col("_start").cast("int")).over(w))
    inside = W.partitionBy(*by, "_no").orderBy(pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    closed = F.max(F.col("_end").cast("int")).over(inside)
    return numbered.withColumn("segment", F.when((F.col("_no") > 0) & (closed == 0), F.col("_no"))).drop("_start", "_end", "_no")


def ordinals(stream: DataFrame, by: list[str], pos: str) -> DataFrame:
    return stream.withColumn("ordinal", F.row_number().over(W.partitionBy(*by).orderBy(pos)))


def segment_id(book: Column, page: Column, ordinal: Column) -> Column:
    return F.format_string("%s-p%04d-%02d", book, page, ordinal)


def suffix_vote(titles: DataFrame, by: list[str], title: str, most: int = 4, least: int = 3, share: int = 2) -> DataFrame:
    """The longest last words (1 to ``most``) that max(least, 1/share) or more of a group's titles have."""
    w = F.filter(F.split(F.lower(title), r"\s+", -1), lambda x: x != "")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size("w"))), lambda n: F.struct(n.alias("len"), F.array_join(F.slice(F.col("w"), -n, n), " ").alias("gram")))
    words = titles.withColumn("w", w).filter("size(w) > 0")
    total = titles.groupBy(*by).agg(F.count(F.lit(1)).alias("total"))
    counts = words.select(*by, F.inline(tails)).groupBy(*by, "len", "gram").agg(F.count(F.lit(1)).alias("n"))
    won = counts.join(total, by).filter(F.col("n") >= F.greatest(F.lit(least), F.ceil(F.col("total") / share)))
    return won.groupBy(*by).agg(F.min_by(F.struct("len", "gram", "n"), F.struct(-F.col("len"), -F.col("n"), F.col("gram"))).alias("x")).select(*by, "x.*")


def coverage_gap(pages: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    return pages.select(*keys).distinct().join(segments.select(*keys).distinct(), keys, "left_anti")
