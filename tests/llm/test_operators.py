"""The ten operators against plain versions, and over nulls, empty texts, ties, repeated rows and empty tables."""

import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbstone.llm import components, fingerprint, licences, linededup, minhash, mixing, packing, quality, queries, sharding, toxicity, vectors, words
from kerbstone.llm.mphf import Index

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, n_lines int, id string"
BASE = " ".join(f"w{i}" for i in range(300))
LINE = "this line is shared by many documents"
TEXTS = [
    (0, "a b\n\nc d"), (1, None), (2, ""), (3, BASE), (4, BASE), (5, BASE.replace("w7 ", "x ")), (6, f"one\n{LINE}\ntwo"), (7, f"  {LINE.upper()} \nthree"), (8, f"{LINE}\n{LINE}\nfour"),
    (9, "Released under the MIT License.\nother words"), (10, "é" * 500 + "\n日本語 テスト"), (11, "word " * 30_000), (12, "a b\n\nc d"), (13, " \t\n "), (13, " \t\n "), (14, "idiot\x00\x1c x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, f"s{i % 3}", 0, 0.5, 3, "k") for i, t in TEXTS], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def grams(text):
    t = (text or "").encode().lower().split()
    return Counter(tuple(t[i : i + 5]) for i in range(len(t) - 4)) if len(t) > 4 else Counter([tuple(t)] if t else [])


def classes(texts, threshold=0.8):
    """Brute force: the least id of each class."""
    sets, up = {i: grams(t) for i, t in texts}, {i: i for i, _ in texts}

    def root(i):
        return i if up[i] == i else root(up[i])

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both, all_ = sum((sets[a] & sets[b]).values()), sum((sets[a] | sets[b]).values())
            if (both / all_ if all_ else 1.0) >= threshold:
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: root(i) for i in ids}


def test_word_hashes_do_not_cross_texts():
    data, at = words.utf8_column(pa.array(["ab", "c d", None, "AB\tc", "abc"]))
    w = words.Words(data, at)
    assert w.count.tolist() == [1, 2, 0, 2, 1] and w.hash[0] == w.hash[3] and w.hash[1] == w.hash[4] and len(set(w.hash.tolist())) == 4


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, (20_000, 2)).astype(np.uint64)
    made = Index.build(h[:10_000, 0], h[:10_000, 1], np.arange(10_000), np.arange(10_000) * 7, 3)
    assert sorted(made.ranks(h[:10_000, 0], h[:10_000, 1])) == list(range(10_000))
    found, count, keeper = Index.of(made.arrays(), 3).probe(h[:, 0], h[:, 1])
    assert found[:10_000].all() and found[10_000:].mean() < 0.002 and (count[:10_000] == np.minimum(np.arange(10_000), 255)).all()
    assert (keeper[3:10_000] == np.arange(3, 10_000) * 7).all() and not keeper[:3].any()
    assert len(made.bits) * 8 < 6 * 10_000 and sum(map(len, made.arrays().values())) < 4 * 10_000 + 8 * 9_997
    assert not Index.build(*np.zeros((2, 0), np.uint64), [], []).probe(h[:5, 0], h[:5, 1])[0].any()


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_line_dedup(docs, spark, broadcast_bytes):
    got = sorted((r.doc_id, r.text, r.n_dropped) for r in linededup.dedup_lines(spark, docs, counted=True, broadcast_bytes=broadcast_bytes).collect())
    want = {i: (t or "", 0) for i, t in TEXTS} | {6: ("one\ntwo", 1), 7: ("three", 1)}
    assert got == sorted((i, *want[i]) for i, _ in TEXTS)


def plain_lines(rows, min_docs=3, min_chars=20):
    """Brute force: (doc_id, kept text, dropped) of rows (doc_id, text)."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    held = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                held[k].append(-math.inf if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), [])) < min_docs or max(held[key(x)]) == (-math.inf if i is None else i)]
        out.append((i, "\n".join(kept), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_line_dedup_against_brute_force(spark, broadcast_bytes, monkeypatch):
    rng = np.random.default_rng(11)
    pool = [f"Shared line number {k} of the pool" + " \t" * (k % 3) for k in range(60)] + ["short"]
    rows = [(None if k % 17 == 0 else int(rng.integers(400)), None if k % 50 == 0 else "\n".join(rng.choice(pool, int(rng.integers(1, 6)))) + f"\nown line of text {k} only here") for k in range(900)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, __id int, __away string").repartition(5)
    monkeypatch.setattr(linededup.gone_lines, "__defaults__", (3, 20, 200))  # many copies of a shard
    monkeypatch.setattr(linededup.line_index, "__defaults__", (3, 20, 100))
    found = linededup.dedup_lines(spark, docs, counted=True, broadcast_bytes=broadcast_bytes)
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0], r[1], r[2]))
    assert order((r.doc_id, r.text, r.n_dropped) for r in found.collect()) == order(plain_lines(rows))
    assert found.columns == ["doc_id", "text", "__id", "__away", "n_lines", "n_dropped"]


def test_dealt_lines_probe_the_index_instead_of_joining_lines(docs, spark):
    index, shards = linededup.line_index(spark, docs)
    plan = linededup.gone_lines(spark, docs, index, shards)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "h1" in plan
    joins = [x for x in plan.split("\n") if "Join" in x]
    assert joins and all("shard" in x and "h1" not in x and "h2" not in x for x in joins)


def test_near_duplicates_against_brute_force(docs, spark):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark, docs).collect()}
    assert got == classes(dict(TEXTS).items())
    assert minhash.near_duplicates(spark, docs).count() == len(TEXTS)


def test_near_duplicate_stage_keeps_one_row_a_class(spark):
    import corpus_pipeline

    near = BASE.replace("w7 ", "x ")
    rows = [(5, BASE), (3, BASE), (3, BASE), (3, near), (4, "one clean text of its own"), (4, "another clean text that shares the id"), (8, "a b c"), (8, "a b c"), (None, "clean without an id"), (None, "clean without an id"), (None, near), (None, None), (9, " "), (6, "")]
    rows += [(7, "many times")] * 50
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id long").repartition(3)
    class_of = classes(list(enumerate(t for _, t in rows)))
    want = Counter()
    for c in set(class_of.values()):
        mine = [rows[k] for k in class_of if class_of[k] == c]
        want[min((i for i, _ in mine if i is not None), default=None)] += 1
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    got = out.collect()
    assert out.columns == docs.columns and Counter(r.doc_id for r in got) == want
    assert len({class_of[rows.index((r.doc_id, r.text))] for r in got}) == len(got)


def test_near_duplicate_chain_and_cross_blocks(spark):
    rng = np.random.default_rng(2)
    texts, now = [], [f"b{i}" for i in range(200)]
    for i in range(40):  # each like the one before, ends far apart
        now = list(now)
        now[int(rng.integers(200))] = f"n{i}"
        texts.append((i, " ".join(now)))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == classes(texts)
    import pandas as pd

    frame = pd.DataFrame([(i, i, t) for i, t in texts], columns=["id", "component", "text"])
    links = minhash._cross(frame, 0.8)
    parts = {i: i for i, _ in texts}
    for a, b in links.itertuples(index=False):
        low, high = sorted((parts[a], parts[b]))
        parts = {k: low if v == high else v for k, v in parts.items()}
    assert parts == classes(texts)


def test_leader_of_many_pairs_is_copied(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LEADER_PAIRS", 3)
    texts = [(i, BASE if i == 0 else BASE.replace(f"w{i} ", "x ")) for i in range(12)]
    docs = minhash.numbered(spark, spark.createDataFrame(texts, "doc_id long, text string"))
    number = {r.doc_id: r[minhash.ROW] for r in docs.collect()}
    pairs = spark.createDataFrame([(number[0], number[i]) for i in range(1, 12)], "a long, b long")
    assert {r.b for r in minhash.verified(spark, pairs, docs).collect()} == {number[i] for i in range(1, 12)}


def test_signature_estimates_multiset_similarity():
    a, b = BASE, BASE + " " + " ".join(BASE.split()[:80])
    data, at = words.utf8_column(pa.array([a, b]))
    sig = minhash.bag_minhash(*minhash.counted(words.Words(data, at)), 2, 4000)
    true = sum((grams(a) & grams(b)).values()) / sum((grams(a) | grams(b)).values())
    assert abs((sig[0] == sig[1]).mean() - true) < 0.03


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in components.connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


def test_packing_round_trip(docs, spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.word_bpe())
    t.encode_special_tokens = True
    rows = packing.pack(spark, docs, queries.word_bpe()).collect()
    true = defaultdict(list)
    for i, text in TEXTS:
        true[i].append([*t.encode(text or "", add_special_tokens=False).ids, 1])
    seqs, seen = defaultdict(list), Counter()
    for r in rows:
        ids = list(struct.unpack(f"<{r.length}I", r.ids))
        assert any(len(x) == r.doc_tokens and x[r.start : r.start + r.length] == ids for x in true[r.doc_id])
        seqs[r.sequence_id].append((r.offset, r.length))
        seen[r.doc_id] += r.length
    assert seen == {i: sum(map(len, x)) for i, x in true.items()}
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(1 for p in seqs.values() if sum(n for _, n in p) < 2000) <= 1


def test_plain_chunks_have_the_tokenizers_ids():
    """Every character that is taken as plain, alone, in pairs and in random joins with others, against the whole tokenizer."""
    known = packing.Tokens(queries.word_bpe())
    assert known.known
    plain = [chr(c) for c in range(0x3000) if packing._PLAIN.fullmatch(chr(c))]
    assert len(plain) > 250
    rng = np.random.default_rng(21)
    odd = ["\u0130", "\u0149", "\u00aa", "\u00ad", "\u0301", "\u00a0", "\x1c", "\x85", "\u4e2d", "\U0001f600", " ", "\n", "\t", "\r", "'s", "'LL", "_", "<|endoftext|>", "1", "9"]
    texts = [*plain, *("".join(rng.choice(plain, 2)) for _ in range(20_000)), *("".join(rng.choice(plain, int(n))) for n in rng.integers(3, 60, 6000))]
    texts += ["".join(rng.choice([*plain[:94], *odd], int(n))) for n in rng.integers(1, 60, 6000)]
    texts += [" ".join("".join(rng.choice(list("etaoinshrdlu'"), int(n))) for n in rng.integers(1, 9, 30)).upper() for _ in range(500)]
    for text in texts:
        assert known.encode(text) == known.ids(text), repr(text)


def test_other_tokenizers_are_not_known(tmp_path):
    import json

    made = json.loads(open(queries.word_bpe()).read())
    made["normalizer"]["normalizers"][1]["content"] = "_"
    path = tmp_path / "t.json"
    path.write_text(json.dumps(made))
    other = packing.Tokens(str(path))
    assert not other.known and other.encode("Plain text") == other.ids("Plain text")


@pytest.mark.parametrize("length", [1, 2, 682, 683, 1023, 1024, 1025, 2047, 2048, 2049, 9999])
def test_cuts(length):
    pieces = packing.cuts(length)
    assert [p[0] for p in pieces] == list(np.cumsum([0, *[p[1] for p in pieces[:-1]]])) and sum(p[1] for p in pieces) == length
    assert all(n * j <= 2048 and 2048 - n * j <= 0.02 * 2048 + j for _, n, j in pieces)


def test_sharding(docs, spark):
    rows = sharding.shard_by_bytes(spark, docs, buckets=3).collect()
    assert len(rows) == len(TEXTS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    placed = defaultdict(set)
    by = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): t for i, t in TEXTS}
    for r in rows:
        placed[by[r.doc_id, r.size, r.text_crc32]].add(r.shard)
    assert all(len(s) == 1 for s in placed.values())


def test_differencing_is_tight():
    sizes = np.random.default_rng(3).integers(1, 10_000, 600)
    sums = np.zeros((600, 8), np.int64)
    sums[:, 0] = sizes
    place = sharding.difference(sums, list(range(600)))
    total = np.bincount(place[:, 0], sizes, minlength=8)
    assert total.max() - total.min() <= 20 and (np.sort(place, 1) == np.arange(8)).all()


def test_fingerprints(docs, spark):
    got = {r.doc_id: r for r in fingerprint.fingerprints(spark, docs).collect()}
    order = sorted(dict(TEXTS))
    text = {i: t or "" for i, t in TEXTS}
    for k, i in enumerate(order):
        half, nxt = len(text[i]) // 2, text[order[k - 1]]
        edited = text[i][: len(text[i]) - half] + nxt[:half]
        assert got[i].n_chars == len(text[i]) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[0].fingerprint == got[12].fingerprint == got[12].fingerprint and got[3].fingerprint == got[4].fingerprint != got[5].fingerprint
    assert got[4].near_next == 1.0 and got[1].fingerprint == got[2].fingerprint


def test_fingerprint_is_a_homomorphism(spark):
    texts = {"whole": "x a b c d e f\ny\nz", "part": "z\nx a b c d e f", "rest": "y", "other": "z\ny\nx a b c d e f"}
    rows = spark.createDataFrame(list(texts.items()), "name string, text string")
    lanes = fingerprint.with_lanes(rows, ["name"], "text")
    r = lanes.groupBy().pivot("name", list(texts)).agg(F.first("lanes"))
    r = r.select("*", fingerprint.combined(F.col("part"), F.col("rest")).alias("i"), fingerprint.combined(F.col("whole"), F.col("rest"), -1).alias("d")).first()
    assert r.whole == r.other == r.i and r.d == r.part and r.part != r.whole


def test_licences(docs):
    got = [(r.doc_id, r.level, r.position, r.licence, r.dice) for r in licences.scan(docs).collect()]
    assert sorted(got) == [(9, "line", 0, "MIT", 1.0), (9, "text", 0, "MIT", 0.833333)]


@pytest.mark.parametrize("threshold", [0.6, 0.8, 0.9])
def test_licence_anchors_never_miss(threshold):
    held = set(licences.anchors(threshold))
    for name, b in licences.template_bigrams():
        touched = sum(any(w in held for w in g.split(" ")) for g in b)
        assert touched > len(b) - licences.bounds(len(b), threshold)[0], name


def test_mixing_meets_its_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 3 else "de", "big" if i % 4 else "small") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    cells = mixing.probabilities(spark, docs, targets={"source": {"big": 0.5, "small": 0.5}}).collect()
    total = sum(c.t * c.p for c in cells)
    assert abs(sum(c.t * c.p for c in cells if c["__source"] == "small") / total - 0.5) < 1e-6
    kept = mixing.mix(spark, docs, targets={"source": {"big": 0.5, "small": 0.5}})
    n = {r.source: r.n for r in kept.groupBy("source").agg(F.sum(mixing.tokens(F.col("text"))).alias("n")).collect()}
    assert abs(n["small"] / (n["small"] + n["big"]) - 0.5) < 0.05 and kept.columns == docs.columns


def test_classifiers(docs, spark):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(15)] + [(3, None, None)], "doc_id long, quality int, toxic int")
    for model, score in ((toxicity.fit_toxicity(spark, docs, labels), toxicity.score_toxicity), (quality.fit_quality(spark, docs, labels), quality.score_quality)):
        got = score(spark, docs, model).collect()
        assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
        by = defaultdict(set)
        for r in got:
            by[dict(TEXTS)[r.doc_id]].add(r.score)
        assert all(len(s) == 1 for s in by.values())
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_toxicity(spark, docs, toxicity.fit_toxicity(spark, docs, empty)).collect()} == {0.5}
    assert toxicity.reject_toxic(spark, docs, toxicity.ToxicityModel(), 0.6).count() == len(TEXTS)


def test_toxic_words_are_learned(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"v{k}" for k in rng.integers(0, 500, 40)) + (" vileword here" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(spark, docs, docs.select("doc_id", "toxic"))
    both = toxicity.score_toxicity(spark, docs, model).join(docs.select("doc_id", "toxic"), "doc_id").where(toxicity.held_out()).collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in both]) > 0.98
    assert len(model.index) < 200


def test_scores_depend_on_the_model_alone(docs, spark):
    def model(bias, n):
        return toxicity.ToxicityModel(np.arange(n, dtype=np.int64) * 7 % (1 << 20), np.full(n, 0.5, np.float32), bias)

    made = [model(0.1 * k, 150_000 * (k % 4)) for k in range(8)]
    column = pa.array([t for _, t in TEXTS])
    want = [toxicity._scores(column, m, toxicity.dense(m)) for m in made]
    for k in list(range(8)) * 2:
        got = {(r.doc_id, r.score) for r in toxicity.score_toxicity(spark, docs, made[k]).collect()}
        assert got == {(i, float(x)) for (i, _), x in zip(TEXTS, want[k], strict=True)}
    assert len({tuple(w) for w in want}) == 8


def test_ftrl_against_a_plain_loop():
    rng = np.random.default_rng(12)
    rows = [(k, int(rng.random() < 0.4), np.unique(rng.integers(0, 40, 8)).astype(np.int32)) for k in range(300)]
    how = toxicity.Ftrl(l1=0.5, calibration=0.25)
    w, bias = toxicity.ftrl(list(rows), how)
    seen = Counter(int(f) for _, _, x in rows for f in x)
    kept = [(y, [int(f) for f in x if seen[f] >= how.min_docs]) for _, y, x in rows]
    z, n, b, nb = defaultdict(float), defaultdict(float), 0.0, 0.0

    def weight(f):
        if abs(z[f]) <= how.l1:
            return 0.0
        return -(z[f] - math.copysign(how.l1, z[f])) / ((how.beta + math.sqrt(n[f])) / how.alpha + how.l2)

    for _ in range(how.epochs):
        for y, x in kept[:225]:
            ws = {f: weight(f) for f in x}
            g = 1 / (1 + math.exp(-(b + sum(ws.values())))) - y
            for f in x:
                z[f] += g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / how.alpha * ws[f]
                n[f] += g * g
            nb += g * g
            b -= how.alpha * g / (how.beta + math.sqrt(nb))
    plain = np.array([weight(f) for f in range(40)])
    scale = (w[:40] @ plain) / (plain @ plain)
    assert np.allclose(w[:40], scale * plain, atol=1e-9) and 0 < (plain != 0).sum() and not w[40:].any()
    # Platt: no other scale and bias has a lesser loss on the part that was kept apart
    def loss(a, c):
        return sum(math.log1p(math.exp(-(2 * y - 1) * (a * sum(plain[f] for f in x) + c))) for y, x in kept[225:]) + 5e-3 * ((a - 1) ** 2 + (c - b) ** 2)

    assert all(loss(scale, bias) <= loss(scale + d, bias + e) + 1e-9 for d in (-0.05, 0, 0.05) for e in (-0.05, 0, 0.05))


def _pu(rng, n_p=3000, n_u=6000, share=0.7):
    good = rng.normal(0, 1, (n_p + n_u, len(quality.STATISTICS)))
    bad = rng.normal(2.5, 1, (n_u, len(quality.STATISTICS)))
    y = rng.random(n_u) < share
    u = np.where(y[:, None], good[n_p:], bad)
    edges = np.quantile(u, np.linspace(0, 1, quality.BINS + 1)[1:-1], axis=0).T
    return good[:n_p], u, y, edges


def test_positive_unlabelled_risk_against_plain_means():
    rng = np.random.default_rng(5)
    p, u, _, edges = _pu(rng, 300, 500)
    w = rng.normal(0, 0.2, quality.SIZE + 1)
    m_p, m_u = quality.moments_of(p, edges), quality.moments_of(u, edges)

    def f(x):
        return np.array([sum(w[int(np.sum(x[i, k] >= edges[k])) + k * (quality.BINS + 1)] for k in range(x.shape[1])) + w[-1] for i in range(len(x))])

    prior, fp, fu = 0.6, f(p), f(u)
    want = prior * np.mean((1 - fp) ** 2) / 4, np.mean((1 + fu) ** 2) / 4 - prior * np.mean((1 + fp) ** 2) / 4
    assert np.allclose(quality.risk(w, prior, m_p, m_u), want)
    own, rest = quality.gradients(w, prior, m_p, m_u)
    for k in rng.integers(0, len(w), 20):
        step = np.zeros(len(w))
        step[k] = 1e-5
        up, down = quality.risk(w + step, prior, m_p, m_u), quality.risk(w - step, prior, m_p, m_u)
        assert np.allclose([(a - b) / 2e-5 for a, b in zip(up, down, strict=True)], [own[k], rest[k]], atol=1e-6)


def test_positive_unlabelled_model_and_curve():
    p, u, y, edges = _pu(np.random.default_rng(6))
    m_p, m_u = quality.moments_of(p, edges), quality.moments_of(u, edges)
    w = quality.fit_apart(quality.moments_of(p[:1500], edges), quality.moments_of(u[:3000], edges))
    first = quality.QualityModel(edges, w[:-1], w[-1], 0.5)
    bar = np.median(first.value(p[1500:]))
    prior = quality.prior_of((first.value(u[3000:]) >= bar).mean(), (first.value(p[1500:]) >= bar).mean())
    assert abs(prior - 0.7) < 0.05
    w = quality.fit_risk(prior, m_p, m_u)
    assert quality.risk(w, prior, m_p, m_u)[1] > -0.01  # the negatives' part stays at or over nothing
    model = quality.QualityModel(edges, w[:-1], w[-1], prior)
    assert ((model.value(u) > 0) == y).mean() > 0.97

    def counts(x):
        return np.bincount(np.clip(np.rint(model.value(x) / quality.VALUE_STEP), -quality.VALUE_BINS, quality.VALUE_BINS).astype(int) + quality.VALUE_BINS, minlength=2 * quality.VALUE_BINS + 1)

    model.slope, model.shift = quality.curve(prior, counts(p), counts(u))
    score = model.score(u)
    assert ((score >= 0.3) == y).mean() > 0.97 and abs(score.mean() - prior) < 0.02 and 0 <= score.min() and score.max() <= 1


def test_quality_is_learned_from_all_documents(spark):
    """Held-out accuracy; labels of 0 and of the held-out fifth change nothing."""
    rng = np.random.default_rng(13)
    good = rng.random(6000) < 0.7
    texts = [" ".join(f"word{k}" for k in rng.integers(0, 300, 40)) + "." if g else "BUY!! " * int(rng.integers(10, 60)) + "### $$$" for g in good]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good) if i % 3 == 0], "doc_id long, quality int")
    scored, model = quality.classify(spark, docs, labels)
    got = {r.doc_id: r.score for r in scored.collect()}
    held = {r.doc_id for r in docs.where(toxicity.held_out()).collect()}
    assert 1000 < len(held) < 1400 and np.mean([(got[i] >= 0.3) == good[i] for i in held]) > 0.98 and abs(model.prior - 0.7) < 0.1
    flipped = labels.withColumn("quality", F.when(toxicity.held_out(), 1 - F.col("quality")).when(F.col("quality") == 0, None).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.classify(spark, docs, flipped)[0].collect()}
    assert again == pytest.approx(got, abs=1e-9)


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 16))
    x = np.concatenate([x, x[:60] + 0.05 * rng.normal(size=(60, 16)), x[:20], np.tile(x[5], (30, 1)) + 0.08 * rng.normal(size=(30, 16))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None]), (905, [1.0, 2.0]), (906, [1e200, 2e200]), (905, [2.0, 4.0])]
    got = vectors.near_duplicate_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), how=vectors.Graph(shard_rows=100, crowd=3)).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    n = {r.vec_id: r.n_links for r in got if r.vec_id < 900}
    assert len(got) == len(rows) and sum(n.values()) >= 0.97 * close.sum() and all(n[i] <= close[i].sum() for i in n)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got if 900 <= r.vec_id < 905} == {i: (0, i) for i in range(900, 905)}
    assert [r.n_links for r in got if r.vec_id in (905, 906)] == [2, 2, 2]


def test_vector_audit_sees_small_groups(spark):
    rng = np.random.default_rng(8)
    pairs = rng.normal(size=(100, 64))
    x = np.concatenate([pairs, pairs + 0.02 * rng.normal(size=(100, 64)), rng.normal(size=64) + 0.02 * rng.normal(size=(300, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    reps = spark.createDataFrame([(i, 64, v.tobytes(), 1) for i, v in enumerate(x)], "id long, dim int, vec binary, n long")
    hot = spark.createDataFrame([(i, 299) for i in range(200, 500)], "id long, links long")  # every pair is lost
    assert vectors.audit(spark, reps, hot, 0.95, 400) < 0.5
    assert vectors.audit(spark, reps, hot.unionByName(spark.createDataFrame([(i, 1) for i in range(200)], "id long, links long")), 0.95, 400) == 1.0


def test_vectors_are_compared_exactly_where_recall_stays_low(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 16))
    x = np.concatenate([x, x + 0.25 * rng.normal(size=x.shape)])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    # a graph that finds few links, and a bar that no recall reaches
    poor = vectors.Graph(shard_rows=20, overlap=1, nearest=1, random=0, degree=1, beam=1, entries=1, block=64, audit=1.01)
    got = {r.vec_id: r.n_links for r in vectors.near_duplicate_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"), how=poor).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    np.fill_diagonal(close, False)
    assert got == dict(enumerate(close.sum(1).tolist()))


def pairs_of(n, dims=64, seed=14):
    """Isolated pairs of cosine 0.95 to 0.99."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=(n, dims))
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    c = rng.uniform(0.951, 0.99, (n, 1))
    return np.concatenate([x, c * x + np.sqrt(1 - c * c) * y])


def test_isolated_pairs_over_many_shards(spark):
    x = np.concatenate([pairs_of(1200), np.random.default_rng(15).normal(size=(600, 64))])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    how = vectors.Graph(shard_rows=100, audit=0.0)  # what the graph itself finds
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    reps = frame.select(F.col("vec_id").alias("id"), F.lit(64).alias("dim"), F.expr("embedding").alias("e")).rdd.map(lambda r: (r.id, r.dim, (np.array(r.e) / np.linalg.norm(r.e)).tobytes())).toDF("id long, dim int, vec binary")
    members, _ = vectors._dealt(spark, reps, how)
    sizes = [r["count"] for r in members.groupBy("shard").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= how.crowd * how.shard_rows
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicate_vectors(spark, frame, how=how).collect()}
    found = sum(got[i] == (1, i) and got[i + 1200] == (1, i) for i in range(1200))
    assert found >= 0.99 * 1200 and all(got[i] == (0, i) for i in range(2400, 3000))


def test_search_walks_into_other_shards():
    # 0-1-2 on a way, 2 from another shard
    turn = lambda a: np.array([np.cos(a), np.sin(a)])
    x = np.array([turn(0.0), turn(0.2), turn(0.4), turn(2.0)])
    graph = vectors.Adjacency.of([np.array([1]), np.array([0, 2]), np.zeros(0, np.int64), np.array([0])])
    a, b = vectors.search(x, graph, np.array([0, 1, 3]), np.array([3]), 4, 0.95)
    assert sorted(zip([(0, 1, 3)[k] for k in a], b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (3, 3)]


def test_rows_that_share_a_vec_id_have_counts_of_their_own(spark):
    e = np.eye(4)
    rows = [(1, e[0]), (1, e[1]), (2, e[0] * 2), (3, e[0] + 0.01 * e[2]), (4, e[1]), (None, e[3]), (None, e[3] * 3), (None, None), (7, e[3])]
    frame = spark.createDataFrame([(i, None if v is None else [float(c) for c in v], 0) for i, v in rows], "vec_id long, embedding array<double>, id int")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicate_vectors(spark, frame).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 1, 1), (2, 2, 1), (3, 2, 1), (4, 1, 1), (None, 2, 7), (None, 2, 7), (7, 2, 7), (None, 0, None)], key=str)


def test_near_duplicate_recall_is_measured(spark):
    rng = np.random.default_rng(16)
    texts = []
    for k in range(40):
        base = [f"k{k}w{j}" for j in range(120)]
        for c in range(4):
            now = list(base)
            for j in rng.integers(0, 120, c):
                now[j] = f"c{c}j{j}"
            texts.append((4 * k + c, " ".join(now)))
    docs = minhash.numbered(spark, spark.createDataFrame(texts, "doc_id long, text string"))
    found = minhash.near_duplicates(spark, docs)
    assert minhash.recall(spark, docs, found, 160) >= 0.99
    assert minhash.recall(spark, docs, found.withColumn("class_id", F.col("doc_id")), 160) == 0.0
    # brute force: which links are lost if the first text of each family stands alone
    lost = found.withColumn("class_id", F.when(F.col("doc_id") % 4 == 0, -1 - F.col("doc_id")).otherwise(F.floor(F.col("doc_id") / 4)))
    sets = [grams(t) for _, t in texts]
    near = [[b for b in range(160) if b != a and sum((sets[a] & sets[b]).values()) >= 0.8 * sum((sets[a] | sets[b]).values())] for a in range(160)]
    want = np.mean([np.mean([a % 4 > 0 and b % 4 > 0 for b in x]) for a, x in enumerate(near) if x])
    assert abs(minhash.recall(spark, docs, lost, 160) - want) < 1e-9 and 0.1 < want < 0.9


def test_fingerprint_likeness_of_one_line(spark):
    rng = np.random.default_rng(17)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 2000, 200))) for i in range(60)]
    got = fingerprint.fingerprints(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.near_edited > r.near_next for r in got) and abs(np.mean([r.near_edited for r in got]) - 0.5) < 0.05


def test_licence_notices_inside_longer_texts(spark):
    t = licences.TEMPLATES
    bsd = "\n\n".join(["BSD 2-Clause License", "Copyright (c) 2020, Foo", *(t["BSD-2-Clause"][k] for k in (2, 3, 4, 5))])
    apache = "# " + t["Apache-2.0"][4].replace("; ", ";\n# ").replace("at http", "at\n#\n#    http").replace("2.0 Unless", "2.0\n#\n# Unless") + "\nimport os"
    rows = [
        (1, "// Copyright 2020 Foo. Licensed under the MIT License. Thanks to all."), (2, "Licensed under the Apache License,\nVersion 2.0. Some more prose goes on here"), (3, "Our tools are free to use. Released under the MIT License."),
        (4, bsd), (5, apache), (6, "\n".join(["Released under the MIT License."] * 1200)), (7, "clean words only."), (7, None), (None, "This work is licensed under a\nCreative Commons Attribution 4.0 International License. More."),
    ]
    got = defaultdict(set)
    for r in licences.scan(spark.createDataFrame([(i, x, "y") for i, x in rows], "doc_id long, text string, segment string")).collect():
        got[r.doc_id].add((r.level, r.licence))
    assert got[1] == {("sentence", "MIT")} and ("sentence", "Apache-2.0") in got[2] and got[3] == {("sentence", "MIT")} and ("sentence", "CC-BY-4.0") in got[None]
    assert {("text", "BSD-2-Clause"), ("line", "BSD-2-Clause")} <= got[4] and {x for _, x in got[5]} == {"Apache-2.0"} and 7 not in got
    # each line, and the text, whose distinct bigrams are the line's and one more
    assert licences.scan(spark.createDataFrame(rows[5:6], "doc_id long, text string")).count() == 1201


def test_sharding_levels_and_balance(spark):
    rng = np.random.default_rng(18)
    docs = spark.createDataFrame([(i, "x" * int(rng.integers(0, 3000))) for i in range(3000)] + [(None, None), (5, ""), (6, None)], "doc_id long, text string").repartition(4)
    rows = sharding.shard_by_bytes(spark, docs, buckets=30, fan=4).collect()
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    assert len(rows) == 3003 and max(total.values()) - min(total.values()) <= 100
    assert len({r.shard for r in rows if r.size == 1}) == 1  # null and empty texts are one group


def test_mixing_tells_of_targets_that_contradict_each_other(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "x"), (2, "c d", "de", "y")], "doc_id long, text string, lang string, source string")
    with pytest.warns(UserWarning, match="contradict"):
        mixing.mix(spark, docs, targets={"source": {"x": 0.9, "y": 0.1}, "lang": {"en": 0.1, "de": 0.9}}).count()


#: What every stage has to live with: null ids and texts, empty texts, ties, repeated rows, clashing names, a very long text.
CLASHING = "doc_id long, text string, lang string, source string, p double, id int, __id int, __away string, shard int, sha string, row int, lanes int, score int, n_lines int, __p int, class int"
ODD = [(None, "clean without an id"), (None, None), (None, "clean without an id"), (1, None), (1, ""), (2, "tie one two three four five"), (2, "tie one two three four five"), (3, " \n\t\n"), (4, "word " * 40_000), (5, "x" * 300_000), (6, f"{LINE}\n" * 4), (7, LINE), (8, LINE), (9, "é\x00\U0001f600 z")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None if k % 3 else "en", None if k % 4 else "s", 0.5, k, k, "a", 1, "h", 2, 3, 4, 5, 6, 7) for k, (i, t) in enumerate(ODD)], CLASHING).repartition(3)


def ids(frame):
    return sorted((r.doc_id for r in frame.select("doc_id").collect()), key=str)


EVERY = sorted((i for i, _ in ODD), key=str)


@pytest.mark.parametrize("name", ["licences", "packing", "sharding", "mixing", "minhash", "fingerprint", "linededup", "quality", "toxicity"])
def test_odd_rows(odd, spark, name):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in (1, 1, 2, 2, 3, 4, 6, 7, 8, 9)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    if name == "licences":
        assert licences.scan(odd).count() == 0
    elif name == "packing":
        rows = packing.pack(spark, odd, queries.word_bpe()).collect()
        assert sorted({r.doc_id for r in rows}, key=str) == sorted(set(EVERY), key=str) and sum(r.length for r in rows if r.doc_id == 1) == 2
    elif name == "sharding":
        found = sharding.shard_by_bytes(spark, odd)
        assert ids(found) == EVERY and len({r.shard for r in found.where("size = 1").collect()}) == 1
    elif name == "mixing":
        found = mixing.mixed(spark, odd)
        assert ids(found) == EVERY and found.columns[: len(odd.columns)] == odd.columns and found.columns[-2] == "___p"
        assert mixing.mix(spark, odd).columns == odd.columns
    elif name == "minhash":
        found = minhash.near_duplicates(spark, odd)
        # one row stays of: no words, the text without an id, the tie, the two short lines, and each of the others
        assert ids(found) == EVERY and ids(found.where("kept")) == sorted([None, 1, 2, 4, 5, 6, 7, 9], key=str)
    elif name == "fingerprint":
        found = fingerprint.fingerprints(spark, odd).collect()
        assert sorted((r.doc_id for r in found), key=str) == EVERY
        by = defaultdict(set)
        text = {(i, len(t or "")): t or "" for i, t in ODD}
        for r in found:
            by[text[r.doc_id, r.n_chars]].add(r.fingerprint)
        assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)
    elif name == "linededup":
        found = linededup.dedup_lines(spark, odd)
        assert found.columns == odd.columns
        order = lambda rows: sorted(rows, key=str)
        assert order((r.doc_id, r.text) for r in found.collect()) == order((i, t) for i, t, _ in plain_lines(ODD))
    elif name == "quality":
        found, _ = quality.classify(spark, odd, labels)
        assert ids(found) == EVERY
    else:
        model = toxicity.fit_toxicity(spark, odd, labels)
        assert ids(toxicity.score_toxicity(spark, odd, model)) == EVERY and toxicity.reject_toxic(spark, odd, model).columns == odd.columns


def test_odd_rows_through_the_pipeline(odd, spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(2, 1, 0), (4, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        assert name == "packing" or docs.columns == before.columns
    assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0


def test_arrow_bounds_are_only_lowered(spark):
    from kerbstone.llm.workspace import BATCH_ROWS, bounded_batches

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    bounded_batches(spark)
    assert spark.conf.get(key) == "50"
    spark.conf.set(key, "50000")
    bounded_batches(spark)
    assert spark.conf.get(key) == str(BATCH_ROWS)
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_contract_query(spark, name):
    """Every query over the smallest tables, against its SQL twin where it has one."""
    import os

    import duckdb
    from test_queries import sorted_rows

    folder = "/root/testdata/sf0.001"
    found = queries.queries()[name](spark, folder)
    rows = found.collect()
    if name not in queries.oracle_sql():
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()} and (name == "op3_packing" or len(rows) == docs.count())
        return
    c = duckdb.connect()
    for f in os.listdir(folder):
        c.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    got = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in got.description]
    assert sorted_rows(found.columns, rows) == sorted_rows(names, got.fetchall())


def test_empty_tables(none, spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    made = [
        linededup.dedup_lines(spark, none), minhash.near_duplicates(spark, none), packing.pack(spark, none, queries.word_bpe()), sharding.shard_by_bytes(spark, none), fingerprint.fingerprints(spark, none),
        licences.scan(none), mixing.mix(spark, none), vectors.near_duplicate_vectors(spark, empty), toxicity.score_toxicity(spark, none, toxicity.fit_toxicity(spark, none, labels)), quality.score_quality(spark, none, quality.fit_quality(spark, none, labels)),
    ]
    assert [d.count() for d in made] == [0] * len(made)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs, before = spark.read.parquet(str(tmp_path / name)), docs
        if name != "packing":
            assert docs.columns == columns and docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_pipeline_against_plain_stages(spark, tmp_path):
    """Planted toxic documents, copies and shared lines: every stage against a plain version of it, on what the stage before left."""
    import corpus_pipeline

    rng = np.random.default_rng(23)
    shared = [f"This passage number {k} is printed at the foot of many pages of the site" for k in range(5)]
    rows = []
    for i in range(900):
        words = [f"v{k}" for k in rng.integers(0, 800, int(rng.integers(30, 90)))]
        toxic = i % 6 == 0
        if toxic:
            words[3:3] = ["vileword", "nastyword", "vileword"]
        text = " ".join(words)
        if i % 4 == 1:
            text += "\n" + shared[i % 5]
        rows.append((i, text, int(toxic)))
    rows += [(900 + k, rows[7 * k + 1][1] if k % 2 else rows[7 * k + 1][1].replace("v1", "x1", 1), rows[7 * k + 1][2]) for k in range(60)]
    docs = spark.createDataFrame([(i, t, "en" if i % 3 else "de", f"s{i % 2}", len(t)) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages, left = dict(corpus_pipeline.STAGES), {}
    for name, stage in stages.items():
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left[name] = docs.collect()
    truth = {i: y for i, _, y in rows}
    kept = {r.doc_id for r in left["toxicity"]}
    assert sum(truth[i] for i in kept) <= 2 and len(kept) >= 0.995 * sum(1 - y for y in truth.values())
    before = [(r.doc_id, r.text) for r in left["toxicity"]]
    assert sorted((r.doc_id, r.text) for r in left["line dedup"]) == sorted((i, t) for i, t, _ in plain_lines(before)) and all(r.n_chars == len(r.text) for r in left["line dedup"])
    before = [(r.doc_id, r.text) for r in left["line dedup"]]
    assert {r.doc_id for r in left["near-dedup"]} == set(classes(before).values()) < {i for i, _ in before}
    # the draws are of hashes, with probabilities of a plain raking of the same cells
    cells, tokens = defaultdict(int), {r.doc_id: len(r.text.split()) for r in left["near-dedup"]}
    cell = {r.doc_id: (r.source, r.lang, "short" if tokens[r.doc_id] < 100 else "article") for r in left["near-dedup"]}
    for i, c in cell.items():
        cells[c] += tokens[i]
    margins = []
    for m, name in enumerate(mixing.MARGINS):
        sums = Counter()
        for c, t in cells.items():
            sums[c[m]] += t
        powered = {v: t ** corpus_pipeline.TEMPER[name] for v, t in sums.items()}
        margins.append({v: p / sum(powered.values()) for v, p in powered.items()})
    w = {c: float(t) for c, t in cells.items()}
    for _ in range(200):
        for m in range(3):
            sums = Counter()
            for c, x in w.items():
                sums[c[m]] += x
            w = {c: x * margins[m][c[m]] / sums[c[m]] for c, x in w.items()}
    most = max(w[c] / cells[c] for c in cells)
    want = {i for i, c in cell.items() if int(hashlib.md5(f"7:{i}".encode()).hexdigest()[:13], 16) / 2**52 < w[c] / cells[c] / most}
    assert {r.doc_id for r in left["mixing"]} == want and 0 < len(want) < len(cell)
    pieces = defaultdict(list)
    for r in left["packing"]:
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert set(pieces) == want
    for found in pieces.values():
        at = 0
        for start, length, total in sorted(found):
            assert start == at
            at += length
        assert at == total
