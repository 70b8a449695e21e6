"""Quality classifier: Bradley-Terry pairwise ranking.

A document's score is linear in binned text statistics.  It is learned from preference pairs, a
row labelled good over a row labelled bad, by logistic loss on the difference of their features
(Newton steps with a small ridge).  A quantile of the training scores is the threshold; scores
are mapped to 0..1 by a logistic curve on which the threshold lies at ``at`` (0.3).

The fit reads at most ``max_labelled`` labels and rows that are not held out and ``pairs_per_row`` pairs for
each row of the rarer label; every row of the table is scored over its whole text.  Ids, labels, languages and
sources are no input of a score.

Defined results: null and empty texts are scored by their (zero) statistics; a null id counts as
held out; repeated rows score alike; without labels of both kinds every score is ``at``; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import crc_mod, pick
from lectern.llm.quality_rules import statistics

BINS = 16


def features(text: bytes | None) -> list[float]:
    base, values = statistics(text)
    n = base[0]
    repeat_rate = base[4] / n if n else 0.0
    return [*values, float(n < 50), float(n == 0), float(repeat_rate > 0.5)]


WIDTH = len(features(None))


class Ranker:
    """Bin edges, weights by bin, threshold and scale."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, threshold: float, scale: float, at: float):
        self.edges, self.weights, self.threshold, self.scale, self.at = edges, weights, threshold, scale, at

    def raw(self, x: np.ndarray) -> np.ndarray:
        return one_hot(x, self.edges) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.at)
        z = (self.raw(x) - self.threshold) / self.scale + np.log(self.at / (1 - self.at))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def one_hot(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """A linear term and one flag per quantile bin, for each statistic."""
    parts = []
    for k, e in enumerate(edges):
        at = np.searchsorted(e, x[:, k], side="right")
        parts.append(np.eye(len(e) + 1)[at])
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(x), 0))


def learn(x: np.ndarray, q: np.ndarray, *, pairs_per_row: int = 20, ridge: float = 1.0, at: float = 0.3, drop_quantile: float | None = None, seed: int = 42) -> Ranker:
    if not (q == 1).any() or not (q == 0).any():
        return Ranker([], np.zeros(0), 0.0, 1.0, at)
    bad_share = np.concatenate([np.quantile(x[q == 0], np.linspace(0, 1, BINS // 2 + 1), axis=0), np.quantile(x, np.linspace(0, 1, BINS // 2 + 1)[1:-1], axis=0)])
    edges = [np.unique(bad_share[:, k]) for k in range(x.shape[1])]
    h = one_hot(x, edges)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(q == 1), np.flatnonzero(q == 0)
    few, many = (good, bad) if len(good) < len(bad) else (bad, good)
    first = np.repeat(few, pairs_per_row)
    second = rng.choice(many, len(first))
    over, under = (first, second) if few is good else (second, first)
    d = h[over] - h[under]
    w = np.zeros(h.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))  # of the pair turning out the other way
        slope = d.T @ p - ridge * w
        curve = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    raw = h @ w
    if drop_quantile is None:
        drop_quantile = best_quantile(raw, q)
    threshold = float(np.quantile(raw, drop_quantile))
    scale = max(float(np.std(raw)) / 2, 1e-9)
    return Ranker(edges, w, threshold, scale, at)


def best_quantile(raw: np.ndarray, q: np.ndarray) -> float:
    """The quantile of the scores below which dropping rows classes most of both labels right."""
    grid = np.linspace(0, 1, 1001)[:-1]
    cuts = np.quantile(raw, grid)
    kept_good = 1 - np.searchsorted(np.sort(raw[q == 1]), cuts) / (q == 1).sum()
    dropped_bad = np.searchsorted(np.sort(raw[q == 0]), cuts) / (q == 0).sum()
    gain = kept_good + dropped_bad
    ties = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(grid[ties[len(ties) // 2]])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality", folds: int = 5, held_fold: int = 0, max_labelled: int = 20_000, seed: int = 42, **more) -> Ranker:
    chosen = pick(labels, id_col, quality_col).select(F.col(id_col).alias("_id"), F.col(quality_col).cast("int").alias("_q")).filter("_q in (0, 1) and _id is not null")
    chosen = chosen.filter(crc_mod(F.col("_id"), folds) != held_fold).orderBy(F.xxhash64(F.lit(seed), "_id"), "_id", "_q").limit(max_labelled)
    texts = pick(docs, id_col, text_col).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    texts = texts.join(F.broadcast(chosen), "_id").select("_q", "_text")  # at most max_labelled ids

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["q", "x"])

    # as many rows as labels, by hash order, if ids repeat
    rows = texts.mapInArrow(measure, "q int, x array<double>").orderBy(F.xxhash64(F.lit(seed), "x", "q"), "x", "q").limit(max_labelled).collect()
    rows.sort(key=lambda r: (r.x, r.q))
    x = np.array([r.x for r in rows]).reshape(len(rows), WIDTH)
    return learn(x, np.array([r.q for r in rows]), seed=seed, **more)


def classify(docs: DataFrame, ranker: Ranker, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0) -> DataFrame:
    rows = pick(docs, id_col, text_col).select(F.col(id_col), (crc_mod(F.col(id_col), folds) == held_fold).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    state = ranker.__dict__

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Ranker(**state)
        for batch in batches:
            x = np.array([features(t) for t in batch.column(2).cast(pa.binary()).to_pylist()]).reshape(batch.num_rows, WIDTH)
            score = made.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= made.at).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")
