"""Approximate nearest neighbours: one navigable small-world graph per shard, shard results merged.

Equal vectors are indexed once. The distinct vectors are dealt to shards by hash; a task builds each shard's
hierarchical graph and stores it as flat arrays (vectors, neighbours, levels). Queries are packed in blocks and broadcast
in portions to the tasks that hold the shards; each block meets each shard once and is scored there. The nearest of all
shards are merged and expanded to the rows that own the vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleloom.operators.work import ARROW_BYTES, freeze

M = 16  # neighbours of a node on the upper levels; twice as many on the lowest
BUILD_WIDTH = 100  # candidates kept while a node is put in
SEARCH_WIDTH = 160  # candidates kept while a query is searched
SHARD_ROWS = 4096  # vectors of a shard
QUERY_BLOCK = 4096  # queries of a block at most; of fewer, if there are too few shards for all cores
PORTION_BYTES = 32 * 1024 * 1024  # of query vectors that are broadcast at a time
SCORED = 256  # queries whose scores are computed together


class Graph:
    """Hierarchical navigable small world over the rows of a float64 matrix, as flat neighbour arrays.

    ``links[level]`` is an array (nodes x width) of neighbours, padded with -1.
    """

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry
        self.squares = np.einsum("ij,ij->i", vectors, vectors)

    def _distances(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.squares[nodes] - 2.0 * (self.vectors[nodes] @ query)

    def _nearest(self, query: np.ndarray, starts: np.ndarray, level: int, width: int, seen: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search on one level: the ``width`` nearest found and their distances, nearest first.

        Each step opens the few nearest candidates that are not open yet and looks at all their neighbours at once.
        """
        nodes = np.asarray(starts)
        seen[nodes] = mark
        near = self._distances(query, nodes)
        order = np.argsort(near, kind="stable")[:width]
        nodes, near = nodes[order], near[order]
        opened = np.zeros(len(nodes), dtype=bool)
        links = self.links[level]
        while True:
            fresh = np.flatnonzero(~opened)[:4]
            if not len(fresh):
                return nodes, near
            opened[fresh] = True
            around = links[nodes[fresh]].ravel()
            around = around[around >= 0]
            around = around[seen[around] != mark]
            if not len(around):
                continue
            around = np.unique(around)
            seen[around] = mark
            distance = self._distances(query, around)
            if len(nodes) >= width:
                better = distance < near[-1]
                around, distance = around[better], distance[better]
                if not len(around):
                    continue
            nodes, near = np.concatenate([nodes, around]), np.concatenate([near, distance])
            opened = np.concatenate([opened, np.zeros(len(around), dtype=bool)])
            order = np.argsort(near, kind="stable")[:width]
            nodes, near, opened = nodes[order], near[order], opened[order]

    def search(self, query: np.ndarray, k: int, width: int, seen: np.ndarray, mark: int) -> np.ndarray:
        """About the ``k`` nearest nodes."""
        starts = np.array([self.entry])
        for level in range(len(self.links) - 1, 0, -1):
            seen[:] = -1
            starts, _ = self._nearest(query, starts, level, 1, seen, mark)
        seen[:] = -1
        return self._nearest(query, starts, 0, max(width, k), seen, mark)[0][:k]

    def _choose(self, nodes: np.ndarray, near: np.ndarray, limit: int) -> np.ndarray:
        """Neighbours in different directions: a candidate closer to a chosen one than to the node is passed over."""
        if len(nodes) <= limit:
            return nodes
        points = self.vectors[nodes]
        gram = points @ points.T
        squares = self.squares[nodes]
        chosen: list[int] = []
        closest = np.full(len(nodes), np.inf)
        for i in range(len(nodes)):
            if closest[i] >= near[i]:
                chosen.append(i)
                if len(chosen) == limit:
                    break
                closest = np.minimum(closest, squares + squares[i] - 2.0 * gram[i])
        if len(chosen) < limit:
            passed = [i for i in range(len(nodes)) if i not in set(chosen)]
            chosen += passed[: limit - len(chosen)]
        return nodes[chosen]

    def _connect(self, node: int, others: np.ndarray, level: int, limit: int) -> None:
        links = self.links[level]
        links[node, : len(others)] = others
        for other in others.tolist():
            row = links[other]
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
            else:
                all_of = np.append(row, node)
                distance = self._distances(self.vectors[other], all_of) + self.squares[other]
                order = np.argsort(distance, kind="stable")
                kept = self._choose(all_of[order], distance[order], limit)
                row[:] = -1
                row[: len(kept)] = kept

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """Put the rows in one after another. Levels are drawn by row number, so that a repeated task agrees."""
        n = len(vectors)
        draws = np.random.default_rng(n).random(n)
        levels = np.minimum((-np.log(np.maximum(draws, 1e-12)) / math.log(M)).astype(int), 8)
        graph = cls(vectors, [np.full((n, 2 * M if k == 0 else M), -1, dtype=np.int32) for k in range(levels.max() + 1)], 0)
        seen = np.full(n, -1, dtype=np.int64)
        top = int(levels[0])
        for node in range(1, n):
            query, starts = vectors[node], np.array([graph.entry])
            level = int(levels[node])
            for k in range(top, -1, -1):
                seen[:] = -1
                width = BUILD_WIDTH if k <= level else 1
                starts, near = graph._nearest(query, starts, k, width, seen, node)
                if k <= level:
                    limit = 2 * M if k == 0 else M
                    graph._connect(node, graph._choose(starts, near + graph.squares[node], M), k, limit)
            if level > top:
                top, graph.entry = level, node
        return graph


def _rows(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


_INDEX = "shard int, keys binary, vectors binary, levels binary, entry int, dim int"


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: keys, vectors (float64), levels of flat neighbour arrays and entry node; stored once.

    ``vectors`` has key long and vector array<double>, all of one length, one row per distinct vector.
    """
    shards = max(1, math.ceil(vectors.count() / shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("key").combine_chunks()
        column = table["vector"].combine_chunks()
        graph = Graph.build(_rows(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column))
        levels = np.concatenate([np.array([len(graph.links)], np.int32), *[x.ravel() for x in graph.links]]).tobytes()
        row = [[key[0].as_py()], [table["key"].to_numpy().tobytes()], [graph.vectors.tobytes()], [levels], [graph.entry], [graph.vectors.shape[1]]]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
        return pa.table([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["shard", "keys", "vectors", "levels", "entry", "dim"])

    dealt = dealt.repartition(shards, "shard")
    return freeze(dealt.groupBy("shard").applyInArrow(build, _INDEX), "graphs")


def _graph(row: dict) -> tuple[np.ndarray, Graph]:
    keys = np.frombuffer(row["keys"], dtype=np.int64)
    vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(keys), row["dim"])
    flat = np.frombuffer(row["levels"], dtype=np.int32)
    links, at = [], 1
    for level in range(int(flat[0])):
        width = 2 * M if level == 0 else M
        links.append(flat[at : at + len(keys) * width].reshape(len(keys), width))
        at += len(keys) * width
    return keys, Graph(vectors, links, row["entry"])


def _scores(graph: Graph, asked: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Euclidean distances of each query to its nodes; squares are added in the order of the components."""
    near = [np.empty(0)]
    for first in range(0, len(found), SCORED):
        nodes = found[first : first + SCORED]
        owner = np.repeat(np.arange(first, first + len(nodes)), [len(x) for x in nodes])
        apart = asked[owner] - graph.vectors[np.concatenate(nodes)]
        total = np.zeros(len(owner))
        for square in (apart * apart).T:
            total += square
        near.append(np.sqrt(total))
    return np.concatenate(near)


def _search_batches(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of a shard with a block of queries: the nearest keys of each query, and their scores."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.drop_columns(["ids", "asked"]).slice(i, 1).to_pylist()[0]
            keys, graph = _graph(row)
            ids, asked = batch["ids"][i].values.to_numpy(), _rows(batch["asked"][i].values)
            seen = np.full(len(keys), -1, dtype=np.int64)
            found = [graph.search(query, min(k, len(keys)), width, seen, mark) for mark, query in enumerate(asked)]
            columns = [pa.array(np.repeat(ids, [len(x) for x in found])), pa.array(keys[np.concatenate(found)]), pa.array(_scores(graph, asked, found))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "key", "score"])


def search_index(index: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, key, score): about the ``k`` nearest keys of every shard for each query (query_id long, vector array<double>).

    Graphs are shuffled once for all queries; only where shards are fewer than three a core they are repeated, so that all
    cores have work. A portion of queries is broadcast at a time, and its result is stored, ``k`` rows a query and task:
    what is joined to it later never waits for the search.
    """
    spark = index.sparkSession
    shards, asked = index.count(), queries.count()
    if not shards or not asked:
        return queries.select("query_id", F.lit(0).cast("long").alias("key"), F.lit(0.0).alias("score")).limit(0)
    dim = index.agg(F.max("dim")).first()[0]
    copies = min(math.ceil(3 * spark.sparkContext.defaultParallelism / shards), math.ceil(asked / SCORED))
    portions = math.ceil(asked * (8 * dim + 24) / PORTION_BYTES)
    blocks = max(copies, math.ceil(asked / portions / QUERY_BLOCK))
    tasks = min(shards * copies, max(shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    held = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartition(tasks, "shard", "copy")
    place = F.pmod(F.xxhash64("query_id"), F.lit(portions * blocks)).cast("int")
    parts = []
    for portion in range(portions):
        mine = queries.withColumn("place", place).where(F.col("place") % portions == portion)
        packed = mine.groupBy(F.expr(f"CAST(place DIV {portions} AS INT)").alias("block")).agg(F.collect_list(F.struct("query_id", "vector")).alias("all"))
        packed = freeze(packed.select("block", F.col("all.query_id").alias("ids"), F.col("all.vector").alias("asked")), "blocks")
        met = held.join(F.broadcast(packed), F.col("copy") == F.col("block") % copies).drop("copy", "block")
        found = met.mapInArrow(lambda batches: _search_batches(batches, k, width), "query_id long, key long, score double")
        parts.append(freeze(_nearest_of(found, k), "found", ARROW_BYTES))
    return reduce(DataFrame.unionByName, parts)


def _nearest_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest keys of each query."""
    order = Window.partitionBy("query_id").orderBy("score", "key")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found for each row that ``is_query`` holds for.

    Score is the Euclidean distance in double precision; ties go to the smaller id; a row is no candidate of its own.
    Vectors that are null, empty, zero, of another length than the most common one, or that hold null or non-finite
    components take no part; nor do null ids. Of equal vectors the ``k + 1`` smallest ids are kept: no other id can be
    among the ``k`` nearest of any query.
    """
    usable = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)
    numbers = F.col(vector_col).cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(numbers, lambda x: x != 0)
    rows = vectors.where(usable & F.col(id_col).isNotNull()).where(finite & nonzero)
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(numbers, lambda x: x + 0.0).alias("vector"), is_query.alias("asks"))
    lengths = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not lengths:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("vector") == lengths[0]["dim"])
    order = Window.partitionBy("vector").orderBy("vec_id")
    owners = freeze(rows.select("vec_id", "vector").distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1), "owners")
    key = F.min("vec_id")
    distinct = freeze(owners.groupBy("vector").agg(key.alias("key")), "vectors")
    queries = freeze(rows.where(F.coalesce("asks", F.lit(False))).select(F.col("vec_id").alias("query_id"), "vector").distinct(), "queries")

    index = build_index(distinct.select("key", "vector"))
    # The k + 1 nearest distinct vectors of all shards hold the k nearest rows besides the query's own.
    merged = search_index(index, queries, k + 1)
    members = owners.join(distinct, "vector").select("key", "vec_id")
    named = merged.join(members, "key").where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return named.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
