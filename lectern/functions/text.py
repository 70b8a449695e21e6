"""Text functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folds() -> tuple[str, str, list[tuple[str, str]]]:
    """Letters whose compatibility decomposition has ASCII in it, up to Latin Extended Additional."""
    one, many = {}, []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2070, 0x20A0), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one[chr(code)] = plain
        elif len(plain) > 1:
            many.append((chr(code), plain))
    return "".join(one), "".join(one.values()), many


_FROM, _TO, _MANY = _folds()


def ascii_fold(text: Column) -> Column:
    """Compatibility-decomposed text without what is not ASCII (Latin scripts and symbols)."""
    folded = F.translate(text, _FROM, _TO)
    out = F.when(folded.rlike("[^\\x00-\\x7F]"), _many(folded)).otherwise(folded)
    return F.regexp_replace(out, "[^\\x00-\\x7F]", "")


def _many(text: Column) -> Column:
    for old, new in _MANY:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def slugify(name: Column) -> Column:
    """Dashes unified, accents dropped, lower case, runs of other characters one dash."""
    out = F.regexp_replace(ascii_fold(F.regexp_replace(name, r"\p{Pd}", "-")), "'", "")
    return F.regexp_replace(F.regexp_replace(F.lower(out), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def without_parentheses(text: Column) -> Column:
    return F.regexp_replace(text, r"\([^()]*\)", "")


def heading_key(text: Column) -> Column:
    """For matching owners: no parentheticals, no case, letters and digits only."""
    return F.regexp_replace(F.lower(without_parentheses(text)), r"[^\p{L}\p{N}]+", "")


def heading_tokens(text: Column) -> Column:
    words = F.split(F.regexp_replace(F.lower(without_parentheses(text)), r"[^\p{L}\p{N}]+", " "), " ", -1)
    return F.filter(words, lambda w: w != "")


def tokens_contain(outer: Column, inner: Column) -> Column:
    """``inner`` is a contiguous run of ``outer``."""
    padded = lambda a: F.concat(F.lit(" "), F.array_join(a, " "), F.lit(" "))
    return (F.size(inner) > 0) & F.contains(padded(outer), padded(inner))


def plural_equal(a: Column, b: Column) -> Column:
    """Equal but for one trailing s on either side."""
    return (a == b) | (F.concat(a, F.lit("s")) == b) | (F.concat(b, F.lit("s")) == a)


def singular(word: Column) -> Column:
    """ies to y (longer than 4), sibilant es dropped (longer than 3), s dropped unless ss, us, is."""
    n = F.length(word)
    return (
        F.when((n > 4) & word.endswith("ies"), F.concat(F.left(word, n - 3), F.lit("y")))
        .when((n > 3) & word.rlike("(s|x|z|ch|sh)es$"), F.left(word, n - 2))
        .when((n > 1) & word.endswith("s") & ~word.rlike("(ss|us|is)$"), F.left(word, n - 1))
        .otherwise(word)
    )


def special_token(text: Column) -> Column:
    """A special-ability token without count, ordinal, distance, bonus; lower case, singular words."""
    out = F.trim(F.lower(without_parentheses(text)))
    for pattern in (r"^[0-9]+(?:st|nd|rd|th)\s+", r"\s+[0-9]+/[a-z]+$", r"\s+[0-9]+\s*(?:ft\.?|feet|miles?)$", r"\s+\+[0-9]+(?:d[0-9]+)?$", r"\s+[0-9]+$", r"\.$"):
        out = F.regexp_replace(out, pattern, "")
    words = F.filter(F.split(out, r"\s+", -1), lambda w: w != "")
    return F.array_join(F.transform(words, singular), " ")


def split_outside_parentheses(text: Column) -> Column:
    """Parts between commas that no parenthesis encloses; dashes alone are no part."""
    parts = F.transform(F.split(text, r",(?![^(]*\))", -1), lambda p: F.trim(p))
    return F.filter(parts, lambda p: (p != "") & ~p.rlike(r"^[-\x{2013}\x{2014}]$"))


def plain_table_text(text: Column) -> Column:
    """Dashes and quotes unified, superscripts dropped, no case, single spaces, none after a slash."""
    out = F.regexp_replace(text, r"\p{Pd}|\x{2212}", "-")
    out = F.translate(out, "‘’“”¹²³", "''\"\"")
    out = F.regexp_replace(F.lower(out), r"/\s+", "/")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def cell_key(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\s+", ""), r"\p{Pd}|\x{2212}", "-")


def repetition_key(line: Column) -> Column:
    """What a running header has in common over pages: no digits, single spaces, lower case."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, "[0-9]", "")), r"\s+", " "))


def strip_edges(word: Column) -> Column:
    """Without punctuation at either end."""
    return F.regexp_replace(word, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+", -1), lambda w: w != "")


def title_variants(title: Column) -> Column:
    """A title, its parenthetical dropped and inlined, its comma halves swapped."""
    dropped = F.trim(F.regexp_replace(title, r"\s*\([^()]*\)", ""))
    inlined = F.trim(F.regexp_replace(F.translate(title, "()", "  "), r"\s+", " "))
    swapped = F.regexp_replace(dropped, r"^([^,]+),\s*([^,]+)$", "$2 $1")
    return F.array_distinct(F.transform(F.array(title, dropped, inlined, swapped), F.lower))


def group_name(title: Column) -> Column:
    """The parenthetical at a title's end, or null."""
    found = F.regexp_extract(title, r"\(([^()]*)\)\s*$", 1)
    return F.when(found != "", found)


def title_or_upper(text: Column) -> Column:
    """Every word of letters begins with a capital."""
    letters = F.filter(words(text), lambda w: w.rlike(r"\p{L}"))
    return (F.size(letters) > 0) & F.forall(letters, lambda w: w.rlike(r"^[^\p{L}]*\p{Lu}"))


def is_heading(text: Column, height: Column, body_height: Column, line_count: Column) -> Column:
    """One line, not only a bracketed tag, and tall, or short, upper case and with a letter."""
    tall = height >= 1.15 * body_height
    loud = (F.size(words(text)) <= 8) & (F.upper(text) == text) & text.rlike(r"\p{L}")
    return (line_count == 1) & ~text.rlike(r"^\s*\[[^\]]*\]\s*$") & (tall | loud)


def citation(first: Column, last: Column, printed: Column) -> Column:
    """p. N, pp. A-B, or pdf p. N where no printed page is known."""
    return (
        F.when(~printed, F.concat(F.lit("pdf p. "), first.cast("string")))
        .when(first == last, F.concat(F.lit("p. "), first.cast("string")))
        .otherwise(F.concat(F.lit("pp. "), first.cast("string"), F.lit("-"), last.cast("string")))
    )


def dehyphenate(lines: Column, known: Column) -> Column:
    """Join lines; a word broken at a line's end loses its hyphen only if the whole is ``known``."""

    def join(acc: Column, line: Column) -> Column:
        head, tail = F.regexp_extract(acc, r"(\S+)-$", 1), F.regexp_extract(line, r"^(\S+)", 1)
        whole = F.lower(strip_edges(F.concat(head, tail)))
        broken = acc.rlike(r"\S-$") & (tail != "")
        glued = F.when(F.array_contains(known, whole), F.concat(F.left(acc, F.length(acc) - 1), line)).otherwise(F.concat(acc, line))
        return F.when(acc == "", line).when(broken, glued).otherwise(F.concat(acc, F.lit(" "), line))

    return F.aggregate(lines, F.lit(""), join)


# Abbreviations of class names.
CLASS_NAMES = {
    "Adp": "Adept", "Asn": "Assassin", "Brd": "Bard", "Blk": "Blackguard", "Clr": "Cleric", "Drd": "Druid", "Ftr": "Fighter",
    "Mnk": "Monk", "Pal": "Paladin", "Rgr": "Ranger", "Rog": "Rogue", "Sor": "Sorcerer", "Wiz": "Wizard",
}


def expand_class(token: Column) -> Column:
    """Class names of a token such as Sor/Wiz; what is no abbreviation only gets a first capital."""
    names = F.create_map(*(F.lit(x) for pair in CLASS_NAMES.items() for x in pair))
    one = lambda t: F.coalesce(F.try_element_at(names, t), F.concat(F.upper(F.left(t, F.lit(1))), F.substring(t, 2, 10_000)))
    return F.transform(F.split(F.trim(token), "/"), lambda t: one(F.trim(t)))


def staged_target(path: Column, staging: Column, book: Column) -> Column:
    """Where a file staged as ``staging``/type/file goes: records/book/type/file.

    Null for a path that is not exactly that deep or that leaves the folder; ``.`` and ``..`` are
    resolved first.
    """
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    step = lambda acc, p: F.when(p != "..", F.concat(acc, F.array(p))).when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.array(F.lit("..")))
    real = F.aggregate(parts, F.array().cast("array<string>"), step)
    root = F.filter(F.split(staging, "/"), lambda p: (p != "") & (p != "."))
    depth = F.size(root)
    inside = (F.size(real) == depth + 2) & (F.slice(real, 1, depth) == root) & (F.startswith(path, F.lit("/")) == F.startswith(staging, F.lit("/")))
    return F.when(inside, F.concat_ws("/", F.lit("records"), book, F.get(real, depth), F.get(real, depth + 1)))


def shown_list(values: Column) -> Column:
    """Non-empty values joined by commas; null if there is none."""
    some = F.filter(values, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(some) > 0, F.array_join(some, ", "))


def shown_pairs(names: list[str], value: Column) -> Column:
    """The non-empty fields of a struct as ``name: value``, joined by commas; null if there is none."""
    one = lambda n: F.when(value[n].isNotNull() & (value[n].cast("string") != ""), F.concat(F.lit(f"{n}: "), value[n].cast("string")))
    return shown_list(F.array(*map(one, names)))


def shown_objects(names: list[str], values: Column) -> Column:
    """Structs of a list, each as its non-empty fields joined by spaces; joined by commas."""
    one = lambda v: F.concat_ws(" ", *(F.when(v[n].cast("string") != "", v[n].cast("string")) for n in names))
    return shown_list(F.transform(F.filter(values, lambda v: v.isNotNull()), one))


def level_of(values: Column, list_name: Column) -> Column:
    """The number after ``list_name`` in the first combined value (as in Cleric 3) that has one."""
    prefix = F.concat(list_name, F.lit(" "))
    levels = F.transform(F.filter(values, lambda v: F.startswith(v, prefix)), lambda v: F.substring(v, F.length(prefix) + 1, F.lit(100)).try_cast("int"))
    return F.get(F.filter(levels, lambda n: n.isNotNull()), F.lit(0))
