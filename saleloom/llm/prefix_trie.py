"""Trie of conversation prefixes, with the tokens that sharing each prefix saves.

Conversations are range-partitioned by the sequence of their turn hashes, then by id, so that equal prefixes are
neighbours and copies of one conversation spread over many tasks. A run of neighbours is a shard. Its trie is encoded as
balanced parentheses: findclose gives a node's subtree, the rank of leaf pairs its leaves, cumulative arrays its members
and savings. Only nodes on a shard's first or last path, its spines, may have members in another shard. They are merged
by the hash of their prefix; all other nodes are complete.

Turns travel as 128-bit hashes and lengths, texts never. Two unequal turns or prefixes agree with a probability of 2**-128.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.head_tail import look_up
from saleloom.llm.parentheses import Parentheses
from saleloom.operators.work import freeze

SHARD_TURNS = 200_000  # a shard is closed when it has so many turns
GROUP, HEADS = 100, 6  # a conversation takes up to HEADS - 1 first turns of its group's first conversation
_ROOT = md5(b"").digest()
_EMPTY = sha256(b"").hexdigest()
_NODES = ("path string, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, chars long, "
          "n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, ends_from long")


def rebuild(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """conv_id, path array<binary> (turn hashes), chars array<int>: each conversation with the shared head it is given.

    The head of conversation c are the first h turns of conversation ``c - c % group`` (fewer if it has fewer, none if it
    does not exist), and replace c's own first h turns; h is the crc32 of c in decimal, modulo ``heads``.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), hashed.alias("hash"), F.char_length(text).alias("chars"))
    known = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    short = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["hash"].alias("hash"), t["chars"].alias("chars")))
    own = freeze(known.groupBy("conv_id").agg(short.alias("turns")), "turns")
    first = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("turns", 1, heads - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = own.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("first_id"), "left")
    given = F.coalesce(F.slice("head", 1, h), F.slice("turns", 1, 0))
    whole = F.concat(given, F.slice("turns", h + 1, F.size("turns")))
    joined = joined.select("conv_id", whole.alias("whole"))
    return joined.select("conv_id", F.col("whole.hash").alias("path"), F.col("whole.chars").alias("chars"))


def _range_min(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value of each range [start, end), by a table of the minima of all power-of-two ranges."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        step, below = 1 << (len(table) - 1), table[-1]
        table.append(np.minimum(below[:-step], below[step:]))
    power = np.frexp(end - start)[1] - 1
    out = np.empty(len(start), dtype=values.dtype)
    for p in np.unique(power):
        at = np.flatnonzero(power == p)
        out[at] = np.minimum(table[p][start[at]], table[p][end[at] - (1 << p)])
    return out


def _common(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Length of the prefix that each path shares with the one before it."""
    size = np.diff(bounds)
    compared = np.append(0, np.minimum(size[1:], size[:-1])) if len(size) else size
    ends = np.cumsum(compared)
    step = np.arange(ends[-1]) - np.repeat(ends - compared, compared)
    now = np.repeat(bounds[:-1], compared) + step
    before = np.repeat(np.append(0, bounds[:-2]), compared) + step
    differs = np.where((hashes[now] != hashes[before]).any(axis=1), step, np.iinfo(np.int64).max)
    common = compared.copy()
    some = np.flatnonzero(compared)
    if len(some):
        common[some] = np.minimum(compared[some], np.minimum.reduceat(differs, (ends - compared)[some]))
    return common


def shard_nodes(ids: np.ndarray, bounds: np.ndarray, hashes: np.ndarray, chars: np.ndarray, name: str) -> list[list]:
    """Columns of ``_NODES`` for the conversations of one shard, sorted by path and id.

    ``hashes`` (two words a turn) and ``chars`` hold all turns, ``bounds`` the range of each conversation. A node that is
    not on a spine is complete, and has a ``parent_key`` if its parent is on one. A row of a spine has ``path`` and
    ``key``; its sums leave out what lies on a spine, and its ends are the ids themselves.
    """
    size, common = np.diff(bounds), _common(hashes, bounds)
    opened = size - common
    opened[0] += 1  # the root
    counts = np.zeros(2 * len(ids) + 1, dtype=np.int64)
    counts[2:-1:2] = size[:-1] - common[1:]
    counts[1::2] = opened
    counts[-1] = size[-1] + 1
    tree = Parentheses(np.repeat((np.arange(len(counts)) % 2).astype(np.int8), counts))
    depth, parent = tree.depth().astype(np.int64), tree.parents()
    close = tree.find_close(tree.opens)
    width = (close - tree.opens + 1) // 2
    number = np.arange(len(depth))

    owner = np.repeat(np.arange(len(ids)), opened)  # the conversation that opened a node
    turn = bounds[owner] + depth - 1
    text = np.append(chars, 0)[np.where(depth > 0, turn, len(chars))]
    end_node = np.cumsum(opened) - 1
    ending = np.bincount(end_node, minlength=len(depth))
    ended = np.append(0, np.cumsum(ending))
    members = ended[number + width] - ended[number]
    least = _range_min(ids, ended[number], ended[number] + members)

    first_path = np.arange(size[0] + 1)
    last_path = [int(end_node[-1])]
    while last_path[-1] > 0:
        last_path.append(int(parent[last_path[-1]]))
    last_path = np.array(last_path[::-1])
    spine = np.zeros(len(depth), dtype=bool)
    spine[first_path] = spine[last_path] = True

    def inside(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(np.where(spine, 0, values)))
        return total[number + width] - total[number]

    leaf = tree.bits[tree.opens + 1] == 0
    leaves = tree.leaves(tree.opens, close) - (np.append(0, np.cumsum(leaf & spine))[number + width] - np.append(0, np.cumsum(leaf & spine))[number])
    children = np.bincount(parent[~spine], minlength=len(depth)) if len(depth) > 1 else np.zeros(1, dtype=np.int64)
    saved = inside((members - 1) * text)

    keys: dict[int, bytes] = {0: _ROOT}
    words = hashes.tobytes()
    for path in (first_path, last_path):
        for node in path[1:].tolist():
            if node not in keys:
                at = 16 * int(turn[node])
                keys[node] = md5(keys[int(parent[node])] + words[at : at + 16]).digest()

    def ends(node: int) -> str:
        return ",".join(map(str, ids[ended[node] : ended[node] + ending[node]].tolist()))

    inner = np.flatnonzero(~spine)
    above = parent[inner]
    known = spine[above]
    columns = [
        [None] * len(inner), [None] * len(inner),
        [keys[n] if k else None for n, k in zip(above.tolist(), known.tolist(), strict=True)],
        least[inner].tolist(), depth[inner].tolist(),
        [None if k else c for c, k in zip(least[above].tolist(), known.tolist(), strict=True)],
        [None] * len(inner), members[inner].tolist(), children[inner].tolist(), leaves[inner].tolist(), saved[inner].tolist(),
        [sha256(ends(n).encode()).hexdigest() if ending[n] else _EMPTY for n in inner.tolist()], [None] * len(inner),
    ]
    seen: set[int] = set()
    for side, path in enumerate((first_path, last_path)):
        for node in path.tolist():
            again = node in seen  # on both spines: its sums count once
            seen.add(node)
            has = ending[node] > 0 and not again
            row = (f"{name}-{side}", keys[node], keys.get(int(parent[node])), int(least[node]), int(depth[node]), None, int(text[node]),
                   0 if again else int(members[node]), 0 if again else int(children[node]), 0 if again else int(leaves[node]),
                   0 if again else int(saved[node]), ends(node) if has else None, int(ids[ended[node]]) if has else None)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
    return columns


def _shards(shard_turns: int):
    """Arrow function: sorted conversations to node rows, shard by shard."""
    types = [pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string(), pa.int64()]
    names = [part.split()[0] for part in _NODES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        turns = count = 0

        def encode() -> pa.RecordBatch:
            ids, size, words, chars = (np.concatenate(part) for part in zip(*held, strict=True))
            name = f"{TaskContext.get().partitionId()}.{count}"
            columns = shard_nodes(ids, np.append(0, np.cumsum(size)), words, chars, name)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in slices(batches, rows=10_000):
            path = batch.column(1)
            size = path.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = path.flatten().cast(pa.binary(16))
            words = np.frombuffer(flat.buffers()[1], dtype=np.uint64)[2 * flat.offset : 2 * (flat.offset + len(flat))].reshape(-1, 2)
            chars = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append((batch.column(0).to_numpy(zero_copy_only=False), size, words, chars))
            turns += len(words) + len(size)
            if turns >= shard_turns:
                yield encode()
                held, turns, count = [], 0, count + 1
        if held:
            yield encode()

    return run


def _merge_spines(rows: DataFrame) -> DataFrame:
    """The nodes on spines, one row each, with the children, leaves and savings that lie on spines added."""
    none = F.lit(_EMPTY)
    ids = F.array_sort(F.collect_list(F.when(F.col("ends").isNotNull(), F.struct("ends_from", "ends"))))
    merged = rows.groupBy("key").agg(
        F.first("parent_key", ignorenulls=True).alias("parent_key"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("chars").alias("chars"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"), ids.alias("parts"),
        F.min(F.struct("path")).alias("from_path"))
    digest = F.when(F.size("parts") == 0, none).otherwise(F.sha2(F.array_join(F.col("parts.ends"), ",").cast("binary"), 256))
    merged = freeze(merged.withColumn("ends_sha256", digest).drop("parts"), "spines")

    below = merged.where("depth > 0").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    known = merged.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))

    # A node's own leaf and savings count for all nodes above it: once, along one of the paths that hold it.
    own = known.select("key", F.col("from_path.path").alias("path"), (F.col("n_children") == 0).cast("long").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
    up = Window.partitionBy("path").orderBy(F.col("depth").desc())
    zero = F.lit(0)
    placed = rows.select("path", "key", "depth").join(own, ["path", "key"], "left").select(
        "key", F.sum(F.coalesce("leaf", zero)).over(up).alias("leaves"), F.sum(F.coalesce("own", zero)).over(up).alias("saved"))
    total = placed.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    done = known.join(total, "key").join(parents, "parent_key", "left")
    return done.select("key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves")).alias("n_leaves"),
                       (F.col("saved_tokens") + F.col("saved")).alias("saved_tokens"), "ends_sha256")


def trie_nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens long, ends_sha256: one row per node.

    ``paths`` is what ``rebuild`` returns, one row per conversation. The root is there if there is any conversation.
    """
    stored = freeze(paths, "paths")
    ordered = stored.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = freeze(ordered.select("conv_id", "path", "chars").mapInArrow(_shards(shard_turns), _NODES), "trie")
    spines = freeze(_merge_spines(nodes.where("path is not null")), "spines")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = nodes.where("path is null").withColumnRenamed("ends", "ends_sha256")
    under = inner.where("parent_key is not null").drop("parent_conv_id")
    above = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("uses"))
    found = look_up(under, above, ["parent_key"], "uses", total=spines.agg(F.sum("n_children")).first()[0] or 0)
    return spines.select(*names).unionByName(inner.where("parent_key is null").select(*names)).unionByName(found.select(*names))


def conversation_trie(turns: DataFrame, group: int = GROUP, heads: int = HEADS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The prefix trie of all rebuilt conversations, see ``rebuild`` and ``trie_nodes``.

    Turns are ordered by number (null first), equal numbers by role, then by the hash of their text; repeated rows are
    turns of their own. Null role and text count as empty. Rows without a conv_id belong to no conversation and have no
    node. Other columns are ignored. A conversation may end up without turns: it is a member of the root. No input, no
    rows. The ids that end at one node are one text, as their digest needs them; they come from the shards already
    sorted and joined.
    """
    return trie_nodes(rebuild(turns.select("conv_id", "turn", "role", "text"), group, heads), shard_turns)
