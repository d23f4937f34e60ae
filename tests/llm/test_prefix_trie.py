from __future__ import annotations

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleloom.llm import head_tail, prefix_trie
from saleloom.llm.parentheses import Parentheses

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p],
                    sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **options):
    rows = prefix_trie.conversation_trie(df, **options)
    return sorted((tuple(r) for r in rows.collect()), key=str)


def talks(n, width=3):
    rng = np.random.default_rng(n)
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(0, 9))):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"tëxt {int(rng.integers(0, width)) ** t}"))
    return rows


@pytest.mark.parametrize("shard_turns", [1, 40, 300, 200_000])
def test_equals_brute_force(spark, shard_turns):
    rows = talks(420)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4), shard_turns=shard_turns) == brute(rows)


def test_hot_conversation_and_first_turn(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 900) for t in range(7)]
    rows += [(1000 + c, t, "user", "same 0" if t == 0 else f"own {c} {t}") for c in range(300) for t in range(3)]
    rows += [(5001, t, "user", "long" * (t % 5)) for t in range(500)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(8), shard_turns=500) == brute(rows)


def test_edge_rows(spark, monkeypatch):
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, None, None), (7, 1, "assistant", ""), (None, 0, "user", "x"),
            (-3, 0, "user", "a"), (-3, 1, "user", "b"), (-100, 0, "user", "c"), (4, 2, "b", "x"), (4, 2, "a", "y"), (300, 0, "", "ab"),
            (301, 5, "", "z" * 70000), (302, 1, "us", "er"), (303, 1, "use", "r")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit(1)).withColumn("key", F.lit(2)).withColumn("a.b", F.lit(3))
    assert found(df) == brute(rows)
    monkeypatch.setattr(prefix_trie, "look_up", lambda *a, **k: head_tail.look_up(*a, **k, head_keys=1))
    assert found(df, shard_turns=2) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_parentheses_against_a_stack():
    rng = np.random.default_rng(5)
    for n in (1, 2, 63, 64, 65, 700, 5000):
        parents = [-1] + [int(rng.integers(max(0, i - 4), i)) if n % 2 else i - 1 for i in range(1, n)]
        kids = [[] for _ in range(n)]
        for i, p in enumerate(parents[1:], 1):
            kids[p].append(i)
        bits, stack = [], [(0, False)]
        while stack:
            node, done = stack.pop()
            bits.append(0 if done else 1)
            if not done:
                stack.append((node, True))
                stack.extend((k, False) for k in reversed(kids[node]))
        opened, want, above = [], {}, []
        for i, b in enumerate(bits):
            if b:
                above.append(want_parent := (opened[-1] if opened else -1))
                opened.append(i)
            else:
                want[opened.pop()] = i
        tree = Parentheses(np.array(bits, dtype=np.int8))
        close = tree.find_close(tree.opens)
        assert close.tolist() == [want[i] for i in tree.opens.tolist()]
        number = {p: k for k, p in enumerate(tree.opens.tolist())}
        assert tree.parents().tolist() == [number.get(p, -1) for p in above]
        assert tree.leaves(tree.opens, close)[0] == sum(not k for k in kids)
