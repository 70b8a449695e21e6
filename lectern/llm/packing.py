"""Packing token sequences: shortest-pack-first over the length histogram.

Documents become pieces of at most ``max_tokens`` ids.  Only the histogram of piece lengths (at
most ``max_tokens`` numbers, however many documents) reaches the driver.  There lengths are
placed longest first, always into the pack with the most room, by updating counts of packing
patterns.  Each final pattern owns a run of sequence numbers; each of its slots owns a run of
ranks within one length.  Pieces are ranked within their length by hash bucket, in two levels, so
no length is ranked in one task, and find sequence and offset by joining length and rank.

Defined results: a null or empty text is the end id alone; a null id is kept; repeated rows are
separate pieces; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lectern.llm.common import local_table, materialize, pick

#: Words whose ids a Python worker remembers; others are merged again when they come.
KEPT_WORDS = 700_000

# The normaliser and word pattern for which WordEncoder has a short way.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

#: Texts of these characters only (up to Latin Extended-A; no controls, no special tokens, no
#: letter whose lower case is longer) are in NFC, and the pattern is the one below.
OTHER = re.compile("[^\x09-\x0d\x20-\x7e\xa1-\u017f]|\u0130|<\\|")
LETTER, NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe"
SHORT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\\s{LETTER}{NUMBER}]+")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(spare)) for b in range(256)}


class WordEncoder:
    """Ids of whole texts; words are merged by the tokenizer's model once and then remembered.

    Texts outside the short way's characters, and other kinds of tokenizers, take the
    tokenizer's own way.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        told = json.loads(spec)
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.short = (
            told.get("normalizer") == NORMALIZER
            and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": PATTERN}
            and steps[0]["invert"]
            and not (steps[1]["add_prefix_space"] or steps[1]["use_regex"])
            and all(x["content"].startswith("<|") for x in told["added_tokens"])
        )

    @classmethod
    def shared(cls, spec: str) -> WordEncoder:
        """One for each worker process and tokenizer, whatever the task."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = sys.modules.setdefault("_lectern_encoders", types.ModuleType("_lectern_encoders"))
        name = f"e{zlib.crc32(spec.encode())}"
        if not hasattr(held, name):
            setattr(held, name, cls(spec))
        return getattr(held, name)

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        if not text:
            return b""
        if not self.short or OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        words = SHORT.findall(text.lower())
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            return b"".join([self.known.get(w) or self._word(w) for w in words])

    def _word(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.letters)
        ids = np.array([t.id for t in self.model.tokenize(shown)], dtype="<u4").tobytes()
        if len(self.known) < KEPT_WORDS:
            self.known[word] = ids
        return ids


def pieces(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens and, with ``with_ids``, ids."""
    rows = pick(docs, id_col, text_col).select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.shared(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(texts), 500):
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for k, text in enumerate(texts.slice(at, 500).to_pylist()):
                    b = encoder.encode(text) + end
                    n = len(b) // 4
                    for s in range(0, n, max_tokens):
                        part = b[4 * s : 4 * (s + max_tokens)]
                        row.append(at + k)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        total.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                columns = [batch.column(0).take(pa.array(row, pa.int32())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(ids, pa.list_(pa.int32()))] if with_ids else [])], names)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else ""))


def shortest_pack_first(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of each packing pattern; counts of lengths add up to the histogram."""
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = max((r for r, packs in room.items() if packs and r >= length), default=None)
            if free is None:
                each = max_tokens // length
                full, rest = divmod(left, each)
                if full:
                    room[max_tokens - each * length].append((full, (length,) * each))
                if rest:
                    room[max_tokens - rest * length].append((1, (length,) * rest))
                break
            count, pack = room[free].pop()
            used = min(count, left)
            if used < count:
                room[free].append((count - used, pack))
            room[free - length].append((used, (*pack, length)))
            left -= used
    return [p for r in sorted(room) for p in room[r]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[dict]:
    """Runs of ranks: pieces of ``length`` ranked from ``low`` to below ``high`` go to sequences from ``first``."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for count, pack in patterns:
        offset = 0
        for length in pack:
            out.append({"length": length, "low": used[length], "high": used[length] + count, "first": sequence, "offset": offset})
            used[length] += count
            offset += length
        sequence += count
    return out


def pack(made: DataFrame, *, id_col: str = "doc_id", max_tokens: int = 2048, bucket_pieces: int = 8192) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces."""
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most max_tokens rows
    runs = slots(shortest_pack_first(histogram, max_tokens))
    table = local_table(made.sparkSession, runs, "length bigint, low bigint, high bigint, first bigint, offset bigint")
    if len(runs) <= 100_000:
        table = F.broadcast(table)
    buckets = max(1, sum(histogram.values()) // bucket_pieces)
    made = made.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(buckets)))
    counts = made.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = W.partitionBy("length", "_bucket").orderBy(id_col, "start", "ids_crc32", "doc_tokens")
    ranked = made.join(bases, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.row_number().over(inside) - 1)
    on = (ranked["length"] == table["length"]) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    placed = ranked.join(table, on).select(*(ranked[c] for c in made.columns if c != "_bucket"), (F.col("first") + F.col("_rank") - F.col("low")).alias("sequence_id"), "offset")
    return placed


def packed(docs: DataFrame, *, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    made = materialize(pieces(docs, tokenizer=tokenizer, id_col=id_col, text_col=text_col, max_tokens=max_tokens, end_id=end_id, with_ids=with_ids), "pieces")
    return pack(made, id_col=id_col, max_tokens=max_tokens)


def sequences(placed: DataFrame, *, max_tokens: int = 2048, pad_id: int = 0) -> DataFrame:
    """The training sequences: ids in order of offset, padded unless their number is a power of two."""
    whole = placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
    n = F.size("ids")
    power = n.bitwiseAND(n - 1) == 0
    return whole.select("sequence_id", F.when(power, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(max_tokens) - n))).alias("ids"), n.alias("tokens"))
