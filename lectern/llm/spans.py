"""Positions of pattern matches, in code points, with built-in functions only.

A text with many matches costs time in proportion to its length and to their number: running
sums go over chunks, and chunks of chunks, as appending to one array copies it each time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64
#: Code points of the blocks in which texts are cut for slicing.
BLOCK = 512


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, op: Callable[[Column, Column], Column], zero: int, depth: int = 2) -> Column:
    """For an array of n integers, n + 1: ``zero``, then the fold of ever more values by an associative ``op``."""

    def plain(part: Column) -> Column:
        return F.aggregate(part, F.array(F.lit(zero)), lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, -1), x))))

    if not depth:
        return plain(values)

    def chunked(all_: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(all_) - 1, F.lit(CHUNK))
        inner = F.transform(starts, lambda at: plain(F.slice(all_, at + 1, F.lit(CHUNK))))

        def joined(x: Column) -> Column:
            bases = running(F.transform(x, lambda part: F.element_at(part, -1)), op, zero, depth - 1)

            def shifted(both: Column) -> Column:
                parts = F.transform(both["parts"], lambda part, k: F.transform(F.slice(part, 2, CHUNK), lambda v: op(F.get(both["bases"], k), v)))
                return F.concat(F.array(F.lit(zero)), F.flatten(parts))

            return bound(F.struct(x.alias("parts"), bases.alias("bases")), shifted)

        return bound(inner, joined)

    return bound(values, lambda v: F.when(F.size(v) <= CHUNK, plain(v)).otherwise(chunked(v)))


def matches(text: Column, patterns: list[tuple[str, str, str]], context: int = 32) -> Column:
    """Leftmost non-overlapping matches of each kind, kind after kind, as structs kind, rank, start, end, text, before, after.

    ``patterns`` has (kind, pattern, a pattern without which no wanted match exists: most texts
    stop there).  The text splits at the matches; a match starts where all earlier pieces and
    matches end.  ``before`` and ``after`` hold up to ``context`` code points beside the match
    (none of them reaching into a neighbouring match).
    """

    def scanned(rank: int, kind: str, pattern: str, only_if: str) -> Column:
        once = F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
        return F.when(text.rlike(only_if), once)

    def place(x: Column) -> Column:
        steps = F.transform(x["found"], lambda m, i: F.length(F.get(x["pieces"], i)) + F.length(m))

        def row(ends: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                end = F.get(ends, i + 1)
                return F.struct(
                    x["kind"].alias("kind"),
                    x["rank"].alias("rank"),
                    (end - F.length(m)).alias("start"),
                    end.alias("end"),
                    m.alias("text"),
                    F.right(F.get(x["pieces"], i), F.lit(context)).alias("before"),
                    F.left(F.get(x["pieces"], i + 1), F.lit(context)).alias("after"),
                )

            return F.transform(x["found"], one)

        return bound(running(steps, lambda a, b: a + b, 0), row)

    all_ = F.array(*(scanned(rank, *p) for rank, p in enumerate(patterns)))
    return F.flatten(F.transform(F.filter(all_, lambda x: x.isNotNull() & (F.size(x["found"]) > 0)), place))


def clear_of(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others.

    In order of starts, a span is clear if all others up to it end by its start, and the next
    one after it starts at its end or later.
    """
    last = 2**31 - 1

    def by_start(x: Column) -> Column:
        of = lambda part, rank: F.transform(part, lambda s, i: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), i.alias("i")))
        return F.array_sort(F.concat(of(x["others"], 0), of(x["spans"], 1)))

    def judge(x: Column) -> Column:
        def keep(s: Column) -> Column:
            ended = running(F.transform(s, lambda e: F.when(e["rank"] == 0, e["end"]).otherwise(0)), F.greatest, 0)
            ahead = running(F.transform(F.reverse(s), lambda e: F.when(e["rank"] == 0, e["start"]).otherwise(last)), F.least, last)

            def both(r: Column) -> Column:
                flagged = F.transform(s, lambda e, i: F.struct(e.alias("e"), ((F.get(r["ended"], i) <= e["start"]) & (F.get(r["ahead"], F.size(s) - 1 - i) >= e["end"])).alias("ok")))
                picked = F.filter(flagged, lambda e: e["ok"] & (e["e"]["rank"] == 1))
                return F.transform(F.array_sort(F.transform(picked, lambda e: e["e"]["i"])), lambda i: F.get(x["spans"], i))

            return bound(F.struct(ended.alias("ended"), ahead.alias("ahead")), both)

        return bound(by_start(x), keep)

    either = F.struct(spans.alias("spans"), others.alias("others"))
    return bound(either, lambda x: F.when((F.size(x["spans"]) == 0) | (F.size(x["others"]) == 0), x["spans"]).otherwise(judge(x)))


def replaced(text: Column, spans: Column, name: Callable[[Column], Column]) -> Column:
    """``text`` with every span (structs with start and end) replaced by its ``name``; of spans that overlap the first names the whole."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(blocks: Column, low: Column, high: Column) -> Column:
        """The code points from ``low`` to before ``high``."""
        cut = lambda b: F.substring(F.get(blocks, b), F.greatest(low - b * BLOCK, F.lit(0)) + 1, F.least(high - b * BLOCK, F.lit(BLOCK)) - F.greatest(low - b * BLOCK, F.lit(0)))
        return F.when(low < high, F.array_join(F.transform(F.sequence(F.floor(low / BLOCK).cast("int"), F.floor((high - 1) / BLOCK).cast("int")), cut), "")).otherwise("")

    def work(x: Column) -> Column:
        def placed(until: Column) -> Column:
            first = F.filter(F.transform(x["spans"], lambda s, i: F.struct(s.alias("s"), F.get(until, i).alias("at"))), lambda p: p["s"]["start"] >= p["at"])
            parts = F.transform(first, lambda p: F.concat(piece(x["blocks"], p["at"], p["s"]["start"]), name(p["s"])))
            return F.concat(F.array_join(parts, ""), piece(x["blocks"], F.element_at(until, -1), x["length"]))

        return bound(running(F.transform(x["spans"], lambda s: s["end"]), F.greatest, 0), placed)

    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return bound(F.struct(order.alias("spans"), blocks.alias("blocks"), F.length(text).alias("length")), work)


def written(spans: Column, *keys: str) -> Column:
    """kind:start:end of spans (structs with kind, order, start, end), comma-joined, sorted by ``keys``."""
    sorted_ = F.array_sort(F.transform(spans, lambda s: F.struct(*(s[k].alias(k) for k in keys), s["start"].alias("b"), s["end"].alias("e"), s["kind"].alias("n"))))
    return F.array_join(F.transform(sorted_, lambda s: F.concat_ws(":", s["n"], s["b"].cast("string"), s["e"].cast("string"))), ",")
