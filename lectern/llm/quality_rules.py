"""Quality rules: an isolation forest on rule statistics.

Each text is reduced to rule statistics (word and line counts, symbols, repeats, case).  A tree of
random splits is grown on ``SAMPLE`` rows, as the method has it, drawn for each tree from all labelled rows, bad
ones among them as a small share (``max_bad_share`` of the good ones), so that they are isolated early; documents that
few splits isolate are anomalous.  The threshold on the anomaly score, which has ``LEVELS`` levels, comes from the
scores of all labelled rows: it catches the most bad rows for the good rows lost, which are at most
``max_good_rejected`` of all good ones.  Labelled rows count by level; no sample stands for them.

Defined results: a null or empty text has no words, zero statistics, and fails the base rule; a
null id is kept as it is and matches no label; repeated rows get equal verdicts; without labelled
rows of both kinds the forest rejects nothing beyond the base rule; other columns are untouched
(columns named like results must not exist in ``docs`` of :func:`apply_rules`, but may in :func:`kept_documents`).
"""

from __future__ import annotations

import operator
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import forget, materialize, pick, shielded

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Deleting these leaves one byte for each code point of a word.
NOT_CHARS = SPACE + bytes(range(0x80, 0xC0))
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
MARKS = b"!?#*$%&|<>@^~=_+{}[]\\"

FEATURES = 10
#: Rows that a tree is grown on, and levels of the anomaly score.
SAMPLE, LEVELS = 256, 1 << 16
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULT = [*BASE, "base_failed", "anomaly", "kept"]


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    flags = np.fromiter((seen[w] > 1 for w in windows), dtype=bool, count=len(windows))
    marked = np.zeros(len(words), dtype=bool)
    for k in range(3):
        marked[k : k + len(flags)] |= flags
    return int(marked.sum())


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The base counts, and the features that the forest splits on."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, 0, 0, 0], [0.0] * FEATURES
    chars = len(text.translate(None, NOT_CHARS))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    upper = len(text) - len(text.translate(None, UPPER))
    lower = len(text) - len(text.translate(None, LOWER))
    marks = len(text) - len(text.translate(None, MARKS))
    distinct = len(set(words))
    features = [
        float(np.log1p(n)),
        chars / n,
        symbols / chars,
        dup / max(1, len(lines)),
        repeat / n,
        upper / max(1, upper + lower),
        marks / n,
        float(np.log(distinct) / np.log(n + 1.0)) if n > 1 else 1.0,
        float(np.log1p(chars / max(1, len(lines)))),
        sum(map(operator.eq, words, words[1:])) / n,
    ]
    return [n, chars, symbols, dup, repeat], features


class Forest:
    """An isolation forest as flat arrays, one block of nodes per tree."""

    def __init__(self, rows: np.ndarray, trees: int = 100, sample: int = SAMPLE, seed: int = 42, drawn: list[np.ndarray] | None = None):
        """Of ``rows``, or of each tree's own rows, ``drawn``."""
        rng = np.random.default_rng(seed)
        self.feature, self.split, self.child, self.depth, self.roots = [], [], [], [], []
        self.sample = max(map(len, drawn)) if drawn else min(sample, len(rows))
        limit = max(1, int(np.ceil(np.log2(max(2, self.sample)))))
        for k in range(len(drawn) if drawn else trees):
            self.roots.append(len(self.feature))
            self._grow(drawn[k] if drawn else rows[rng.choice(len(rows), self.sample, replace=False)], 0, limit, rng)
        self.feature, self.split = np.array(self.feature), np.array(self.split)
        self.child, self.depth = np.array(self.child), np.array(self.depth)

    def _grow(self, rows: np.ndarray, depth: int, limit: int, rng: np.random.Generator) -> int:
        at = len(self.feature)
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero(high > low)
        self.feature.append(0)
        self.split.append(np.inf)
        self.child.append((at, at))
        self.depth.append(depth + expected_depth(len(rows)))
        if depth < limit and len(rows) > 1 and len(open_):
            f = int(rng.choice(open_))
            cut = rng.uniform(low[f], high[f])
            left = rows[:, f] < cut
            if left.any() and not left.all():
                self.feature[at], self.split[at] = f, cut
                self.child[at] = (self._grow(rows[left], depth + 1, limit, rng), self._grow(rows[~left], depth + 1, limit, rng))
        return at

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; high where few splits isolate the row."""
        limit = max(1, int(np.ceil(np.log2(max(2, self.sample))))) + 1
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(limit):
                node = self.child[node, (rows[every, self.feature[node]] >= self.split[node]).astype(int)]
            total += self.depth[node]
        return 2.0 ** (-total / len(self.roots) / max(expected_depth(self.sample), 1e-9))


def expected_depth(n: int) -> float:
    """Mean depth of an unsuccessful search in a random binary tree over n rows."""
    return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def _each(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    both = [statistics(t) for t in texts.cast(pa.binary()).to_pylist()]
    return (np.array([b for b, _ in both], dtype=np.int64).reshape(-1, 5), np.array([f for _, f in both], dtype=np.float64).reshape(-1, FEATURES))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", max_good_rejected: float = 0.02, max_bad_share: float = 0.02, trees: int = 100, seed: int = 42) -> tuple[Forest | None, float]:
    """Grow the forest and set its threshold on all rows of ``docs`` with a label; of several labels of an id each counts."""
    marks = pick(labels, id_col, quality_col).select(F.col(id_col).alias("_id"), F.col(quality_col).cast("int").alias("_q")).filter("_q in (0, 1) and _id is not null")
    marks = marks.groupBy("_id").agg(F.sum("_q").alias("good"), F.sum(1 - F.col("_q")).alias("bad"))
    texts = pick(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, features = _each(batch.column(1))
            ok = ~((base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), pa.array(list(features[ok]), pa.list_(pa.float64()))], ["_id", "features"])

    # statistics join, never texts, and on both sides by merge: labels may be as many as documents
    rows = texts.mapInArrow(measure, f"_id {texts.schema['_id'].dataType.simpleString()}, features array<double>").join(marks.hint("merge"), "_id")
    rows = materialize(rows.select("good", "bad", F.xxhash64(F.lit(seed), "_id", "features").alias("key"), "features"), "labelled")
    total = rows.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    if not total.good or not total.bad:
        forget(rows)
        return None, 2.0
    few = max(1, int(max_bad_share * total.good))
    forest = Forest(None, seed=seed, drawn=draws(rows, min(1.0, few / total.bad), total.good + min(few, total.bad), trees))
    level, good, bad = levels(rows, forest)
    forget(rows)
    return forest, threshold(level / LEVELS, good, bad, max_good_rejected)


def _features(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, FEATURES)


def draws(rows: DataFrame, bad_weight: float, weight: float, trees: int) -> list[np.ndarray]:
    """Each tree's ``SAMPLE`` rows of all (good, bad, key, features): those of the lowest hashes over weights.

    About 1.5 times as many hashes are low enough to reach the driver, whatever the number of rows.
    """
    least = min(1.0, 1.5 * SAMPLE / weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, bad, key = (np.asarray(batch.column(k)) for k in range(3))
            w = good + bad * bad_weight
            for tree in range(trees):
                x = key.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2**64)  # splitmix64
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                u = (x ^ (x >> np.uint64(31))) / 2.0**64 / w
                low = np.flatnonzero(u < least)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), tree, dtype=np.int32)), pa.array(u[low]), batch.column(3).take(pa.array(low))], ["tree", "u", "features"])

    found = rows.select("good", "bad", "key", "features").mapInArrow(run, "tree int, u double, features array<double>").toArrow().combine_chunks()
    tree, u, x = np.asarray(found.column("tree")), np.asarray(found.column("u")), _features(found.column("features").combine_chunks())
    order = np.lexsort((*x.T[::-1], u, tree))
    cuts = np.searchsorted(tree[order], np.arange(trees + 1))
    return [x[order[a:b][:SAMPLE]] for a, b in zip(cuts, cuts[1:])]


def graded(score: np.ndarray) -> np.ndarray:
    """The level of an anomaly score."""
    return np.round(score * LEVELS).astype(np.int64)


def levels(rows: DataFrame, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Levels, ascending, and how many good and bad labels they have among all rows (good, bad, features)."""
    blob = pickle.dumps(forest.__dict__)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = Forest.__new__(Forest)
        grown.__dict__.update(pickle.loads(blob))
        for batch in batches:
            level, at = np.unique(graded(grown.anomaly(_features(batch.column(2)))), return_inverse=True)
            sums = [np.bincount(at, np.asarray(batch.column(k)), len(level)).astype(np.int64) for k in range(2)]
            yield pa.RecordBatch.from_arrays([pa.array(level), *map(pa.array, sums)], ["level", "good", "bad"])

    each = rows.select("good", "bad", "features").mapInArrow(run, "level long, good long, bad long").groupBy("level").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    found = each.toArrow().sort_by("level")  # at most LEVELS + 1 rows
    return tuple(np.asarray(found.column(c)) for c in ("level", "good", "bad"))


def calibrate(score: np.ndarray, q: np.ndarray, max_good_rejected: float) -> float:
    """The threshold of single scores."""
    cuts, at = np.unique(score, return_inverse=True)
    return threshold(cuts, np.bincount(at, q == 1, len(cuts)), np.bincount(at, q == 0, len(cuts)), max_good_rejected)


def threshold(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray, max_good_rejected: float) -> float:
    """Scores above it go: the most bad rows less the share of good rows, within what good rows may lose; counts by score."""
    lost, caught = 1 - np.cumsum(good) / good.sum(), 1 - np.cumsum(bad) / bad.sum()
    gain = np.where(lost <= max_good_rejected, caught - lost, -np.inf)
    best = len(cuts) - 1 - int(np.argmax(gain[::-1]))
    return float(cuts[best])


def apply_rules(docs: DataFrame, model: tuple[Forest | None, float], *, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its statistics, anomaly score and verdict."""
    forest, threshold = model
    blob = pickle.dumps(forest.__dict__ if forest else None)
    at = docs.columns.index(text_col)
    names = [*docs.columns, *RESULT]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = None
        if (state := pickle.loads(blob)) is not None:
            grown = Forest.__new__(Forest)
            grown.__dict__.update(state)
        for batch in batches:
            base, features = _each(batch.column(at))
            failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
            score = graded(grown.anomaly(features)) / LEVELS if grown else np.zeros(len(base))
            kept = ~failed & (score <= threshold)
            new = [*(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(score), pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(judge, f"{fields}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, anomaly double, kept boolean")


def kept_documents(docs: DataFrame, model: tuple[Forest | None, float], *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs`` whatever their names."""
    return shielded(docs, [text_col], lambda d: apply_rules(d, model, text_col=text_col).filter("kept"))
