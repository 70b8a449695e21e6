"""JSON functions: strict parsing, pointers, typed equality, canonical text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict(text: Column) -> Column:
    """The variant of a JSON object; null for duplicate keys, NaN, Infinity and other top levels."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def pointer_path(pointer: str) -> str:
    """A JSON pointer (~0 and ~1 escapes, list indexes without leading zeros) as a variant path."""
    if pointer and not pointer.startswith("/"):
        raise ValueError(f"not a JSON pointer: {pointer!r}")
    out = "$"
    for part in pointer.split("/")[1:]:
        if re.search("~(?![01])", part):
            raise ValueError(f"not a JSON pointer: {pointer!r}")
        key = part.replace("~1", "/").replace("~0", "~")
        out += f"[{key}]" if re.fullmatch("0|[1-9][0-9]*", key) else "['" + key.replace("'", "\\'") + "']"
    return out


def resolve(variant: Column, pointer: str) -> Column:
    return F.try_variant_get(variant, pointer_path(pointer), "variant") if pointer else variant


def typed_equal(a: Column, b: Column) -> Column:
    """Equal in value and type: 1, 1.0 and true all differ; null equals null."""
    kind = lambda v: F.regexp_replace(F.schema_of_variant(v), r"DECIMAL\([0-9,]+\)|DOUBLE|FLOAT", "NUMBER")
    return F.coalesce((kind(a) == kind(b)) & (F.to_json(a) == F.to_json(b)), F.lit(False))


def canonical(text: Column) -> Column:
    """Sorted keys, no spaces; null if not strict JSON."""
    return F.to_json(F.try_parse_json(text))


def reply_json(text: Column) -> Column:
    """The JSON of a reply: of a fenced block, else from the first { to the last }, else the whole."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braced = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(fenced != "", F.trim(fenced)).when(braced != "", braced).otherwise(text)


def identity_digest(*parts: Column) -> Column:
    """SHA-256 of NUL-joined parts."""
    return F.sha2(F.concat_ws("\x00", *parts), 256)
