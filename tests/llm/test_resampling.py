from __future__ import annotations

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleloom.llm import resampling
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]


def brute(rows, target, percent=25, min_words=20, buckets=10_000):
    def totals(texts):
        return Counter(crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = totals(x for _, x in rows), totals(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, found = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
                for b in (crc32(f.encode()) % buckets for f in found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def found(docs, target, **options):
    return sorted((tuple(r) for r in resampling.resample(docs, target, **options).collect()), key=str)


def corpus():
    rows = [(i, prose(i, 15 + i % 40) + " ÄRGER 漢字漢字 it's x" + " the end" * (i % 7)) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n.,"), (203, "one"), (None, prose(3, 50)), (None, prose(3, 50)), (204, "w" * 5000 + " a " + "漢" * 300),
             (205, prose(9, 9000)), (7, prose(1, 30)), (206, "a\x00b c\x7fd é")]
    return rows


@pytest.mark.parametrize("options", [{}, {"head_words": 4, "head_pairs": 3}, {"percent": 60, "min_words": 1, "buckets": 97}])
def test_equals_brute_force(spark, options):
    rows, target = corpus(), [prose(i, 30) for i in range(0, 40, 3)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = {k: v for k, v in options.items() if not k.startswith("head")}
    assert found(docs, spark.createDataFrame([(t,) for t in target], "text string"), **options) == brute(rows, target, **wanted)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    named = edge_docs.withColumn("rank", F.lit(1)).withColumn("score", F.lit(2)).withColumn("a.b", F.lit(3)).withColumn("n", F.lit(4))
    target = spark.createDataFrame([("alpha beta",)], "text string")
    assert found(named, target) == brute(rows, ["alpha beta"])
    assert found(named, target.limit(0)) == brute(rows, [])
    assert found(no_docs, target) == []


def test_hot_copies_and_frequent_pairs(spark):
    rows = [(i, "the same words again and again in many texts " * 4) for i in range(2000)] + [(None, prose(1, 40))] * 700
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    target = ["the same words"]
    assert found(docs, spark.createDataFrame([(t,) for t in target], "text string")) == brute(rows, target)


def test_direct_crc_of_any_length():
    words = resampling.Words(pa.array(["a " + "b" * 63 + " " + "c" * 64 + " " + "d" * 65 + " é " + "漢" * 4000]))
    names = words.distinct.to_pylist()
    first = np.repeat(np.arange(len(names)), len(names))
    second = np.tile(np.arange(len(names)), len(names))
    states = np.array([crc32(w) for w in names], dtype=np.uint32)
    want = [crc32(names[a] + b" " + names[b]) for a, b in zip(first, second, strict=True)]
    assert resampling.direct_crc(states[first], words.distinct, second).tolist() == want


def test_vocabulary_is_bounded_and_finds_frequent_words(spark):
    docs = spark.createDataFrame([(f"common pair word{i} filler{i} common pair",) for i in range(500)], "text string").repartition(4)
    known = resampling.vocabulary(docs, 100, head_words=8, head_pairs=8)
    assert set(known.states) == {b"common", b"pair"}
    assert len(known.pair_keys) == 1
