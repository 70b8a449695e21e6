"""The registered queries on whole tables against their contracts, in plain loops; models against plain ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from lectern.llm import bt_quality, langid, licenses, mixing, pii, quality_rules, simhash, spans
from tests.llm.test_operators import brute_components, brute_fingerprint, brute_pii, brute_secrets, brute_statistics, frame, split

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def run(spark):
    made = {}

    def get(name):
        if name not in made:
            made[name] = entry.queries()[name](spark, SF).collect()
        return made[name]

    return get


def test_op1(rows, run):
    got = run("op1_mix")
    assert sorted(r.doc_id for r in got) == sorted(r["doc_id"] for r in rows)
    size = {r["doc_id"]: len(split(r["text"])) for r in rows}
    total = Counter()
    for r in rows:
        total[r["source"]] += size[r["doc_id"]]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    # water-filling, written out anew: the level at which open sources share by weight
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, left, open_ = {}, 1.5 * sum(total.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        for s in full or open_:
            want[s] = 2 * total[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(want[s] for s in full)
        open_ -= full
    source = {r["doc_id"]: r["source"] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == total[s] and r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r["size"]
        assert r.taken == sum(p.words for p in r.placements) and all(0 <= p.shard < 64 for p in r.placements)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in total)


def test_op1_shards_are_shuffled_and_whole(spark, rows):
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["source"], 7, 8) for r in rows], "doc_id long, text string, source string, _row int, _shard int")
    got = mixing.mixed_documents(docs, shards=4, block_docs=8, shard_columns=True).toDF("doc_id", "text", "source", "_row", "mine", "shard", "order").collect()
    assert {r["_row"] for r in got} == {7} and {r.mine for r in got} == {8} and {r.shard for r in got} == {0, 1, 2, 3}
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r)
    assert all([r.order for r in p] == sorted(r.order for r in p) and [r.doc_id for r in p] != sorted(r.doc_id for r in p) for p in per.values())
    seen = [r.shard for r in got]
    assert all(seen.index(s) + seen.count(s) - 1 == len(seen) - 1 - seen[::-1].index(s) for s in per)  # together
    assert sum(len(split(r.text)) for r in got) == pytest.approx(1.5 * sum(len(split(r["text"])) for r in rows), abs=4)


def test_op2(rows, run):
    text = {r["doc_id"]: r["text"] for r in rows}
    got = run("op2_quality_rules")
    assert len(got) == len(rows)
    for r in got:
        n, chars, symbols, dup, repeat = brute_statistics(text[r.doc_id])
        if repeat is None:
            w = split(text[r.doc_id])
            windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
            seen = Counter(windows)
            repeat = len({k for i, x in enumerate(windows) if seen[x] > 1 for k in (i, i + 1, i + 2)})
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n) and not (r.base_failed and r.kept)


def test_forest_scores_are_path_lengths():
    x = np.random.default_rng(1).normal(size=(300, quality_rules.FEATURES))
    forest = quality_rules.Forest(x, trees=10, sample=64, seed=3)
    got = forest.anomaly(x[:40])
    c = lambda n: 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n
    for row, score in zip(x[:40], got):
        depths = []
        for root in forest.roots:
            node = root
            while np.isfinite(forest.split[node]):
                node = forest.child[node][int(row[forest.feature[node]] >= forest.split[node])]
            depths.append(forest.depth[node])
        assert score == pytest.approx(2 ** (-sum(depths) / len(depths) / c(64)))
    far = forest.anomaly(np.full((1, quality_rules.FEATURES), 9.0))[0]
    assert far > np.quantile(got, 0.9)


def test_threshold_by_trying_every_cut():
    rng = np.random.default_rng(2)
    score, q = rng.random(200), (rng.random(200) < 0.7).astype(int)
    score[q == 0] += 0.3
    cut = quality_rules.calibrate(score, q, 0.05)
    gain = lambda t: ((score > t) & (q == 0)).sum() / (q == 0).sum() - ((score > t) & (q == 1)).sum() / (q == 1).sum()
    allowed = [t for t in score if ((score > t) & (q == 1)).sum() / (q == 1).sum() <= 0.05]
    assert gain(cut) == pytest.approx(max(map(gain, allowed)))


def test_op3(run):
    t = pq.read_table(f"{SF}/embeddings.parquet")
    ids, x = np.array(t["vec_id"]), np.array(t["embedding"].to_pylist(), dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    by = defaultdict(list)
    for r in sorted(run("op3_ann"), key=lambda r: (r.query_id, r["rank"])):
        by[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        s = (x * x[i]).sum(axis=1) / (norm * norm[i])
        best = [int(ids[j]) for j in np.lexsort((ids, -s)) if j != i][:5]
        hits, total = hits + len(set(best) & {v for v, _ in by[ids[i]]}), total + len(best)
        assert all(score == pytest.approx(s[list(ids).index(v)], abs=1e-12) for v, score in by[ids[i]])
    assert hits >= 0.9 * total


def test_op4(rows, run):
    want = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows}
    root = brute_components(sorted(set(want.values())))
    least = {}
    for i in sorted(want):
        least.setdefault(root[want[i]], i)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in run("op4_simhash")} == {(i, f"{f:016x}", least[root[f]]) for i, f in want.items()}


def test_segments_change_keys_but_not_components(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    near = [int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 63, (4, 2))]
    dense = [int(base[0]) ^ (1 << x) for x in range(40)] + [int(base[0]) ^ (3 << x) for x in range(40)]
    table = spark.createDataFrame([(v,) for v in {*map(int, base), *near, *dense}], "fp long")
    keys, roots = [], []
    for segments, cell in ((1, 4096), (2, 4096), (2, 40), (3, 4096), (4, 50)):
        keys.append(simhash._tables(table, segments, 2).select("key").distinct().count())
        found = simhash.links(table, segments=segments, cell=cell)
        assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in found.collect())
        roots.append({(r.node, r.root) for r in simhash.components(found).collect()})
    assert len({*keys}) > 2 and all(r == roots[0] for r in roots) and roots[0]
    wide = simhash.components(simhash.links(table, distance=3)).count()
    assert wide >= len(roots[0])


def test_op5_op6(rows, run):
    text = {r["doc_id"]: r["text"] for r in rows}
    for name, brute in (("op5_secrets", brute_secrets), ("op6_pii", brute_pii)):
        got = run(name)
        assert len(got) == len(rows)
        for r in got:
            want = brute(text[r.doc_id])
            assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
            counts = Counter(x.split(":")[0] for x in want.split(",") if x)
            assert all(r[f"n_{k}"] == counts[k] for k in (("assign", "access", "hex") if name == "op5_secrets" else pii.BASE))
            if name == "op6_pii":
                p = [float(x) for x in r.probabilities.split(",") if x]
                assert len(p) == len([x for x in r.spans.split(",") if x]) and r.n_likely == sum(x >= 0.5 for x in p)


def test_many_matches_in_one_text(spark):
    """Positions, overlaps and redaction go over chunks; their number of matches is beyond two levels of them."""
    from lectern.llm import secrets

    n = 9000
    text = "".join(f"é a{i}@b.org {i % 10} jane{i} [at] x [dot] org token = abcdef{i}, " for i in range(n))
    docs = frame(spark, [(1, text, "en", "s")])
    found = pii.digest(pii.detect(docs, keep=["doc_id"])).collect()[0]
    assert found.n_email == n and found.base_sha256 == hashlib.sha256(brute_pii(text).encode()).hexdigest()
    clean = pii.redact(docs).toDF(*map(str, range(len(docs.columns)))).collect()[0][1]
    assert clean == "".join(f"é [EMAIL] {i % 10} [MAIL] token = abcdef{i}, " for i in range(n))
    kept = secrets.digest(secrets.scan(docs)).collect()[0]
    assert kept.n_assign == n and kept.base_sha256 == hashlib.sha256(brute_secrets(text).encode()).hexdigest()


def test_running_sums_and_clear_spans(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 9, n).tolist() for n in (0, 1, 63, 64, 65, 4096, 5000)]
    got = spark.createDataFrame([(x,) for x in lists], "v array<int>").select("v", spans.running(F.col("v"), lambda a, b: a + b, 0).alias("s")).collect()
    assert all(r.s == [0, *np.cumsum(r.v).tolist()] for r in got)
    draw = lambda n: [(int(a), int(a) + int(w)) for a, w in zip(rng.integers(0, 900, n), rng.integers(1, 9, n))]
    table = spark.createDataFrame([(draw(a), draw(b)) for a, b in ((0, 5), (5, 0), (40, 30), (200, 90))], "a array<struct<start:int,end:int>>, b array<struct<start:int,end:int>>")
    for r in table.select("a", "b", spans.clear_of(F.col("a"), F.col("b")).alias("c")).collect():
        assert [tuple(x) for x in r.c] == [tuple(x) for x in r.a if not any(o.start < x.end and x.start < o.end for o in r.b)]


def test_loose_kinds(spark):
    text = "ssn 123-45-6789, Dr. Jane Smith, 12 Oak Park Road, 212-555-0199, Main Street 5"
    got = pii.detect(frame(spark, [(1, text, "en", "s"), (2, None, None, None)]), keep=["doc_id"], at_least=0.0).collect()
    assert {(s.kind, text[s.start : s.end]) for s in got[0].spans} == {("ssn", "123-45-6789"), ("name", "Dr. Jane Smith"), ("street", "12 Oak Park Road"), ("tel", "212-555-0199")}
    assert all(0 < s.probability < 1 for s in got[0].spans) and got[1].spans == []


@pytest.mark.skipif(not Path("/usr/share/common-licenses").is_dir(), reason="the system has no licence texts")
def test_long_licences(spark):
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {k: Path("/usr/share/common-licenses", f).read_text() for k, f in files.items() if Path("/usr/share/common-licenses", f).is_file()}
    form = lambda t: "Copyright (c) 2024 A. Person\n" + re.sub(r"[ \t]+", "  ", t.upper().replace(",", " , ")).replace("LICENSE", "LICENCE")
    rows = [(k, t) for k, t in texts.items()] + [(k, form(t)) for k, t in texts.items()]
    got = licenses.scan(frame(spark, [(i, t, "", "") for i, (_, t) in enumerate(rows)])).collect()
    assert {r.doc_id: r.license_id for r in got} == {i: k for i, (k, _) in enumerate(rows)}
    cut = licenses.scan(frame(spark, [(i, t[:-40], "", "") for i, t in enumerate(texts.values())])).collect()
    assert {r.license_id for r in cut} == {None}


def test_op8(rows, run):
    from tokenizers import Tokenizer

    from lectern.llm.queries import word_tokenizer

    tokenizer, text = Tokenizer.from_str(word_tokenizer()), {r["doc_id"]: r["text"] for r in rows}
    per, place = defaultdict(list), defaultdict(list)
    for r in run("op8_pack"):
        per[r.doc_id].append(r)
        place[r.sequence_id].append((r.offset, r.length))
    assert set(per) == set(text)
    for i, parts in per.items():
        ids = tokenizer.encode(text[i] or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in place.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(place) <= math.ceil(sum(n for p in place.values() for _, n in p) / 2048) + 1  # little padding


def test_op9(rows, run):
    got = {r.doc_id: r for r in run("op9_quality")}
    assert set(got) == {r["doc_id"] for r in rows}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    judged = [(label[i], r.predicted) for i, r in got.items() if r.held_out and label.get(i) is not None]
    assert not judged or np.mean([a == b for a, b in judged]) >= 0.85
    twice = defaultdict(set)
    for x in rows:
        twice[x["text"]].add(got[x["doc_id"]].score)
    assert all(len(s) == 1 for s in twice.values())  # equal texts score alike


def test_bradley_terry_is_at_the_optimum():
    """The gradient of the pairwise loss with its ridge is zero, in plain loops over the same pairs."""
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(60, 3)), np.array([0] * 20 + [1] * 40)
    x[q == 1] += 0.8
    ranker = bt_quality.learn(x, q, pairs_per_row=5, seed=9)
    h = bt_quality.one_hot(x, ranker.edges)
    draw = np.random.default_rng(9)
    good, bad = np.flatnonzero(q == 1), np.flatnonzero(q == 0)
    under = np.repeat(bad, 5)
    over = draw.choice(good, len(under))
    slope = -ranker.weights.copy()
    for g, b in zip(over, under):
        d = h[g] - h[b]
        slope += d / (1 + math.exp(float(d @ ranker.weights)))
    assert np.abs(slope).max() < 1e-4
    s = ranker.score(x)
    assert np.mean([s[g] > s[b] for g in good for b in bad]) > 0.8


def test_op10(rows, run):
    text = {r["doc_id"]: (r["text"], r["lang"]) for r in rows}
    got = run("op10_langid")
    assert sorted(r.doc_id for r in got) == sorted(text)
    langs = {lang for _, lang in text.values()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        t = text[r.doc_id][0]
        assert r.lang_pred in langs if t and any(map(str.isalpha, t)) else r.lang_pred == "und"
    held = [r.lang_pred == text[r.doc_id][1] for r in got if r.held_out and text[r.doc_id][1] and r.lang_pred != "und"]
    assert np.mean(held) >= 0.9


def test_ftrl_by_single_coordinates():
    """The same updates in scalar loops."""
    data = ["ab ab", "cd cd", "abc", "cde d", "a b", "d c"]
    y, bits = np.array([0, 1, 0, 1, 0, 1]), 6
    rows = [langid.counts(t, bits) for t in data]
    model = langid.Model(["x", "y"], np.ones(1 << bits), np.zeros((1 << bits, 2)), np.zeros(2), 1.0, bits)
    langid.ftrl(model, rows, y, alpha=0.5, beta=1.0, l1=0.02, l2=0.03, epochs=2, seed=7)
    z, n = defaultdict(float), defaultdict(float)

    def weight(f, k):
        if abs(z[f, k]) <= 0.02:
            return 0.0
        return -(z[f, k] - math.copysign(0.02, z[f, k])) / ((1.0 + math.sqrt(n[f, k])) / 0.5 + 0.03)

    rng = np.random.default_rng(7)
    for _ in range(2):
        for i in rng.permutation(len(rows)):
            at, v = model.vector(*rows[i])
            features = [*zip(at.tolist(), v.tolist()), ("bias", 1.0)]
            logit = [sum(x * weight(f, k) for f, x in features) for k in range(2)]
            p = [math.exp(a) / sum(map(math.exp, logit)) for a in logit]
            for k in range(2):
                for f, x in features:
                    g, w = x * (p[k] - (y[i] == k)), weight(f, k)
                    z[f, k] += g - (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / 0.5 * w
                    n[f, k] += g * g
    for f in range(1 << bits):
        assert model.weights[f] == pytest.approx([weight(f, 0), weight(f, 1)], abs=1e-9)
    assert model.bias == pytest.approx([weight("bias", 0), weight("bias", 1)], abs=1e-9)


def test_one_language_and_repeated_rows(spark):
    rows = [(i, "the same words here", "en", "s") for i in range(30)] + [(5, "the same words here", "en", "s")] * 40
    table = frame(spark, rows)
    model = langid.fit(table, max_docs=20)
    got = langid.predict(table, model).collect()
    assert {r.lang_pred for r in got} == {"en"} and len(got) == len(rows) and {round(r.score, 6) for r in got} == {1.0}
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    ranker = bt_quality.fit(table, labels)  # ties everywhere
    assert len({r.score for r in bt_quality.classify(table, ranker).collect()}) == 1
    forest = quality_rules.fit(table, labels)
    assert quality_rules.kept_documents(table, forest).count() == 0  # too few words


def test_pipeline_against_its_parts(spark, run, rows):
    """What run() packs: ids of kept, deduplicated, redacted and mixed texts, each piece once."""
    from tokenizers import Tokenizer

    from lectern.llm.queries import word_tokenizer

    got = run("pipeline")
    kept = {r.doc_id for r in run("op2_quality_rules") if r.kept}
    assert {r.doc_id for r in got} <= kept
    text = {r["doc_id"]: r["text"] for r in rows}
    shingles = lambda t: frozenset(zip(*(split(t.lower())[k:] for k in range(5))))
    sets = {i: shingles(text[i]) for i in kept}
    packed = {r.doc_id for r in got}
    for i in packed:  # of two alike texts the smaller id stays
        assert not any(j < i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in packed if sets[j])
    tokenizer = Tokenizer.from_str(word_tokenizer())
    clean = {i: brute_redacted(text[i]) for i in packed}
    for r in got:
        ids = tokenizer.encode(clean[r.doc_id], add_special_tokens=False).ids
        part = list(r.ids)
        whole = part[:-1] if part[-1] == 1 else part
        assert whole == ids[r.start : r.start + len(whole)]  # a document taken in part is a prefix


def brute_redacted(text):
    found = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in brute_pii(text).split(",") if x))
    out, at = "", 0
    for a, b, k in found:
        if a >= at:
            out += text[at:a] + f"[{k.upper()}]"
        at = max(at, b)
    return out + text[at:]
