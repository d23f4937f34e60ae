from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleloom.llm import hnsw, minhash, rare_lists, set_join
from saleloom.llm.components import components
from saleloom.llm.shingles import shingle_sets
from tests.llm.conftest import TEXTS, prose

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(docs, width, percent):
    sets = [(i, shingles(t, width)) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    low = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            low[find(x)] = min(low.get(find(x), i), i)
    return [(i, len(s), low.get(find(x))) for x, (i, s) in enumerate(sets)]


def key(row):
    return tuple((v is not None, v or 0) for v in row)


def noisy_docs():
    draw = random.Random(11)
    docs, n = [], 0
    for size in (1, 3, 6, 9, 10, 11, 12, 14, 15, 16, 17, 18, 19, 20, 24, 40, 80, 200):
        base = [f"w{draw.randint(0, 400)}" for _ in range(size)]
        for _ in range(14):
            words = list(base)
            for _ in range(draw.randint(0, 3)):
                at = draw.randrange(len(words) + 1)
                words[at : at + draw.randint(0, 2)] = [f"x{draw.randint(0, 5)}" for _ in range(draw.randint(0, 2))]
            docs.append((n, " ".join(words)))
            n += 1
    common = " ".join(f"c{i}" for i in range(30))
    docs += [(n + i, common + " " + prose(i, 10)) for i in range(20)]
    return docs


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 70)])
def test_links_equal_brute_force(spark, width, percent):
    docs = noisy_docs()
    found = set_join.link_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), width, percent)
    assert sorted(map(tuple, found.collect())) == sorted(brute_components(docs, width, percent))


def test_parts_alone_lose_no_link():
    docs = [shingles(t, 4) for _, t in noisy_docs()]
    sets = [np.array(sorted(hash(s) & 0xFFFFFFFFFFFFFFFF for s in d), dtype=np.uint64) for d in docs]
    for percent in (70, 80, 85, 95):
        small = set_join.boundary(percent)
        parts = [set(set_join._part_keys(s, percent, small).tolist()) if len(s) else set() for s in sets]
        for x, a in enumerate(docs):
            for y in range(x):
                b = docs[y]
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    assert parts[x] & parts[y]


def test_group_that_resembles_without_linking(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"t{i}" for i in range(240)]
    docs = []
    for i in range(300):
        words = list(base)
        for at in draw.sample(range(len(words)), 9):  # about 0.74 alike in shingles of four words
            words[at] = f"own{i}x{at}"
        docs.append((i, " ".join(words)))
    for i in range(40):
        docs.append((1000 + i, docs[i][1] + f" tail{i}"))
    seen = []
    verified = set_join._verified
    monkeypatch.setattr(set_join, "_verified", lambda pairs, *rest: seen.append(pairs.count()) or verified(pairs, *rest))
    found = set_join.link_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), 4, 85)
    assert sorted(map(tuple, found.collect())) == sorted(brute_components(docs, 4, 85))
    assert sum(seen) <= 20 * len(docs)


def test_frequent_shingles_are_listed_last(spark, monkeypatch):
    monkeypatch.setattr(rare_lists, "LEAST_SETS", 2)
    monkeypatch.setattr(rare_lists, "BUCKET_SHINGLES", 200)
    docs = noisy_docs() * 2
    docs = [(i, text) for i, (_, text) in enumerate(docs)]
    found = set_join.link_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), 4, 85)
    assert sorted(map(tuple, found.collect())) == sorted(brute_components(docs, 4, 85))


def test_link_edge_rows(edge_docs, no_docs):
    found = set_join.link_components(edge_docs).collect()
    assert sorted(map(key, found)) == sorted(map(key, brute_components(TEXTS, 4, 85)))
    assert set_join.link_components(no_docs).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minhash_estimates_jaccard():
    a, b = prose(1, 300), prose(1, 200) + " " + prose(9, 100)
    one, other = minhash.fingerprint_texts(__import__("pyarrow").array([a, b]))
    x, y = shingles(a, 5), shingles(b, 5)
    assert abs(minhash.likeness(one, other) - len(x & y) / len(x | y)) < 0.12
    assert minhash.likeness("", "") == 1.0
    assert minhash.likeness("", one) == 0.0


def test_near_duplicates_are_verified(spark):
    docs = noisy_docs()
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=80)
    want = {i: c for i, _, c in brute_components(docs, 5, 80)}
    got = dict(map(tuple, found.collect()))
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)
    assert all(got[i] >= want[i] for i in want)


def test_edited_texts(edge_docs, no_docs, spark):
    import hashlib

    rows = minhash.fingerprint_edits(edge_docs).collect()
    ordered = sorted(((i, t or "") for i, t in TEXTS), key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    want = []
    for n, (i, text) in enumerate(ordered):
        after, half = ordered[(n + 1) % len(ordered)][1], len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted(map(key, [(r.doc_id, r.n_chars, r.edited_sha256) for r in rows])) == sorted(map(key, want))
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[5].fingerprint
    assert by_id[3].fingerprint == ""
    alone = minhash.fingerprint_edits(spark.createDataFrame([(4, "a b c d e f")], "doc_id long, text string")).collect()
    assert [(r.near_next, r.n_chars) for r in alone] == [(1.0, 11)]
    assert minhash.fingerprint_edits(no_docs).count() == 0
    assert minhash.fingerprints(edge_docs).count() == len(TEXTS)


def test_neighbours_reach_recall(spark):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(20, 16))
    vectors = (centres[draw.integers(0, 20, 1500)] + 0.3 * draw.normal(size=(1500, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    dealt = hnsw.nearest(df, F.col("vec_id") % 50 == 0).collect()
    v, hits = vectors.astype(np.float64), 0
    for q in range(0, 1500, 50):
        score = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        score[q] = np.inf
        best = np.lexsort((np.arange(1500), score))[:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in dealt if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert np.allclose([m[2] for m in mine], score[[m[1] for m in mine]])
        hits += len(set(best.tolist()) & {m[1] for m in mine})
    assert hits >= 0.9 * 300


def test_neighbours_of_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.5, 0.5]), (101, None), (102, [0.0, 0.0]), (103, [float("nan"), 1.0]),
            (104, [None, 1.0]), (105, [float("inf"), 1.0]), (106, []), (107, [1.0]), (None, [1.0, 1.0]), (100, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, key string, shard int")
    found = hnsw.nearest(df, F.col("vec_id").isin(0, 100, 101, 102)).collect()
    by = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 100)}
    assert by == {0: list(range(1, 11)), 100: list(range(10))}
    assert {r.query_id for r in found} == {0, 100}
    few = hnsw.nearest(df.where("vec_id in (1, 2, 100)"), F.col("vec_id") == 1).collect()
    assert sorted(r.vec_id for r in few) == [2, 100]
    assert hnsw.nearest(df.where("false"), F.lit(True)).count() == 0


def test_queries_meet_many_shards_in_stored_portions(spark, monkeypatch):
    """No join or broadcast holds queries x shards: each portion's result is stored, with k rows a query."""
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 16)
    monkeypatch.setattr(hnsw, "PORTION_BYTES", 10_000)
    vectors = np.random.default_rng(5).normal(size=(200, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "key long, vector array<double>")
    index = hnsw.build_index(df, shard_rows=8)
    assert index.count() > 10
    found = hnsw.search_index(index, df.withColumnRenamed("key", "query_id"), 3)
    files = {f.split("/saleloom/")[1].split("/")[0] for f in found.inputFiles()}
    assert len(files) == 2 and all(f.startswith("found-") for f in files)
    score = np.sqrt(((vectors[:, None] - vectors) ** 2).sum(axis=2))
    want = {(q, k) for q in range(200) for k in np.argsort(score[q])[:3].tolist()}
    rows = found.collect()
    assert len(rows) == 600 and {(r.query_id, r.key) for r in rows} == want
    assert np.allclose([r.score for r in rows], [score[r.query_id, r.key] for r in rows])


def test_shingles_of_a_slice_are_hashed_in_portions():
    texts = pa.array([prose(n % 50, 400) for n in range(2000)] + ["", "one", prose(1, 400_000)])
    assert texts.nbytes > 7 << 20
    tracemalloc.start()
    flat, bounds = rare_lists.flat_sets(texts.slice(3), 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 * texts.nbytes
    assert all(np.array_equal(flat[a:b], s) for a, b, s in zip(bounds, bounds[1:], shingle_sets(texts.slice(3), 5), strict=False))
    assert len(bounds) == len(texts) - 3 + 1 and rare_lists.flat_sets(texts[:0], 5)[1].tolist() == [0]


def loose_copies(n, edits):
    """Copies of one text with so many changed words that only some pairs of them link."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    docs = []
    for i in range(n):
        words = list(base)
        for k in range(draw.choice(edits)):
            words[draw.randrange(len(words))] = f"x{i}y{k}"
        docs.append((i, " ".join(words)))
    return docs


def test_hubs_link_loose_copies_before_the_last_scan(spark, monkeypatch):
    stored, freeze = [], set_join.freeze
    monkeypatch.setattr(set_join, "freeze", lambda df, name: stored.append((name, freeze(df, name))) or stored[-1][1])
    docs = loose_copies(160, (2, 2, 2, 2, 1, 5))
    found = set_join.link_components(spark.createDataFrame(docs, "doc_id long, text string"))
    expected = brute_components(docs, 4, 85)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert 1 < len({c for _, _, c in expected}) < 100
    pairs = [t for name, t in stored if name == "pairs"]
    links = [t for name, t in stored if name == "links"]
    assert links[-1].count() <= 5
    assert pairs[-1].count() <= 160


def test_candidates_leave_out_sets_that_differ_too_much(spark):
    rng = np.random.default_rng(3)
    sets = [rng.integers(1, 1 << 62, 100, dtype=np.int64).astype(np.uint64) for _ in range(40)]
    sets += [np.append(sets[0][:-3], np.arange(3, dtype=np.uint64))]  # links to the first
    rows = [(n, 7, 0, 100, n, set_join._parity(s).tolist()) for n, s in enumerate(sets)]
    lists = spark.createDataFrame(rows, "class long, key long, place long, n_shingles long, label long, parity array<long>")
    assert [tuple(r) for r in set_join._candidates(lists, 85).collect()] == [(0, 40)]


def test_a_full_bucket_is_counted_in_little_memory():
    n, row = rare_lists.BUCKET_SHINGLES, 10_000
    draw = np.random.default_rng(4)
    rows = [(0, draw.bytes(6 * row), (np.arange(row, dtype=np.uint32) // 500).tobytes(), list(range(i, i + 20))) for i in range(0, n, row)]
    columns = dict(zip(("bucket", "names", "owners", "classes"), map(list, zip(*rows, strict=True)), strict=True))
    table = pa.table(columns)
    tracemalloc.start()
    rare_lists._count(1)(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 90e6, peak
