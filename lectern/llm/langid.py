"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Lower-cased texts are cut into n-grams of one to three code points, hashed into ``2**bits``
features.  Document frequencies are counted over every learnable row.  Weights are trained by
follow-the-regularised-leader with elastic-net penalties on a bounded sample (``max_docs`` rows,
spread over languages); a part of the sample sets the softmax temperature.  The driver gets the
sample's sparse counts (at most ``2**bits`` numbers a row), never texts.

Defined results: a null text or one without a letter is ``und`` with score 0; a null id is not
held out; without learnable rows every text is ``und``; repeated rows are classed alike; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import crc_mod, pick

SLICE = 1_000_000


def counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram features of a text and how often each occurs."""
    total = np.zeros(1 << bits, dtype=np.int64)
    text = text.lower()
    for at in range(0, max(1, len(text)), SLICE):
        c = np.frombuffer(text[max(0, at - 2) : at + SLICE].encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        new = min(2, at)  # code points that only begin n-grams
        one = c[new:] * np.uint64(0x9E3779B97F4A7C15)
        two = (c[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[1:] * np.uint64(0x165667B19E3779F9))[max(0, new - 1) :] * np.uint64(0x9E3779B97F4A7C15)
        three = (c[:-2] * np.uint64(0x27D4EB2F165667C5) + c[1:-1] * np.uint64(0x85EBCA77C2B2AE63) + c[2:] * np.uint64(0xFF51AFD7ED558CCD)) * np.uint64(0x9E3779B97F4A7C15)
        for codes in (one, two, three):
            if len(codes):
                total += np.bincount((codes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    at = np.flatnonzero(total)
    return at, total[at]


def _ints(x: pa.ListScalar) -> np.ndarray:
    return np.asarray(x.values)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float, bits: int):
        self.langs, self.idf, self.weights, self.bias, self.temperature, self.bits = langs, idf, weights, bias, temperature, bits

    def vector(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = (1 + np.log(n)) * self.idf[at]
        return at, v / max(float(np.sqrt(v @ v)), 1e-12)

    def logits(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        at, v = self.vector(at, n)
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        p = softmax(self.logits(*counts(text, self.bits)) / self.temperature)
        k = int(np.argmax(p))
        return self.langs[k], float(p[k])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(model: Model, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, *, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 2, seed: int = 42) -> None:
    """Per-coordinate proximal steps; a weight is zero until its gradients outweigh ``l1``."""
    d, k = model.weights.shape
    z, n = np.zeros((d + 1, k)), np.zeros((d + 1, k))
    rng = np.random.default_rng(seed)

    def weights(at: np.ndarray) -> np.ndarray:
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    vectors = [model.vector(*r) for r in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = vectors[i]
            at, v = np.append(at, d), np.append(v, 1.0)  # the last weight is the bias
            w = weights(at)
            p = softmax(v @ w)
            p[y[i]] -= 1
            g = v[:, None] * p[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(d + 1))
    model.weights, model.bias = w[:d], w[d]


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss; one unseen row's worth of doubt keeps it off zero."""
    if not len(y):
        return 1.0
    doubt = 1 / (len(y) + 2)
    grid = np.exp(np.linspace(np.log(0.005), np.log(20), 400))
    z = logits - logits.max(axis=1, keepdims=True)
    aim = (1 - doubt) * z[np.arange(len(y)), y] + doubt * z.mean(axis=1)
    loss = [float(np.mean(np.log(np.exp(z / t).sum(axis=1)) - aim / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3, held_fold: int = 1, max_docs: int = 6_000, calibration: float = 0.2, bits: int = 14, seed: int = 42, **more) -> Model:
    rows = pick(docs, id_col, text_col, lang_col).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    rows = rows.filter(crc_mod(F.col("_id"), folds) != held_fold).filter("_lang is not null and _text is not null")
    by_lang = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(by_lang)
    if not langs:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0, bits)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                total[counts(t, bits)[0]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = rows.select("_text").mapInArrow(frequencies, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # at most 2**bits rows
    df = np.zeros(1 << bits)
    df[[r["at"] for r in found]] = [r["n"] for r in found]
    idf = np.log((1 + sum(by_lang.values())) / (1 + df)) + 1

    share = max_docs / len(langs)
    rate = F.create_map(*(x for lang in langs for x in (F.lit(lang), F.lit(min(1.0, 1.2 * share / by_lang[lang])))))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "_id", F.xxhash64("_text")))
    drawn = rows.filter(F.pmod("_h", F.lit(1 << 30)) / float(1 << 30) < F.element_at(rate, F.col("_lang")))
    chosen = drawn.groupBy("_h").agg(F.min("_lang").alias("_lang")).orderBy(F.xxhash64(F.lit(seed + 1), "_h"), "_h").limit(max_docs)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [k for k, t in enumerate(batch.column(2).to_pylist()) if has_letter(t)]
            found = [counts(batch.column(2)[k].as_py(), bits) for k in keep]
            picked = [c.take(pa.array(keep, pa.int64())) for c in batch.columns[:2]]
            yield pa.RecordBatch.from_arrays([*picked, pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())), pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))], ["h", "lang", "at", "n"])

    taken = rows.join(F.broadcast(chosen), ["_h", "_lang"]).select("_h", "_lang", "_text")  # at most max_docs keys
    taken = taken.mapInArrow(counted, "h long, lang string, at array<int>, n array<int>").dropDuplicates(["h"]).orderBy(F.xxhash64(F.lit(seed + 1), "h"), "h").toArrow()
    model = Model(langs, idf, np.zeros((1 << bits, len(langs))), np.zeros(len(langs)), 1.0, bits)
    sample = [(langs.index(lang), (_ints(at), _ints(n))) for b in taken.to_batches() for lang, at, n in zip(b.column("lang").to_pylist(), b.column("at"), b.column("n"))]
    cut = int(len(sample) * (1 - calibration)) if len(sample) >= 50 else len(sample)
    ftrl(model, [r for _, r in sample[:cut]], np.array([y for y, _ in sample[:cut]], dtype=np.int64), seed=seed, **more)
    model.temperature = best_temperature(np.array([model.logits(*r) for _, r in sample[cut:]]), np.array([y for y, _ in sample[cut:]], dtype=np.int64))
    return model


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 3, held_fold: int = 1) -> DataFrame:
    rows = pick(docs, id_col, text_col).select(F.col(id_col), (crc_mod(F.col(id_col), folds) == held_fold).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    state = model.__dict__

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Model(**state)
        for batch in batches:
            found = [made.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([p for _, p in found], pa.float64())], [id_col, "held_out", "lang_pred", "score"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")
