"""Exact Jaccard join of shingle sets: subsets for small sets, inverted lists for large ones, and link components.

With threshold t (in percent), two sets of sizes a and b link when 100 * overlap >= t * union. Then the overlap is at
least t percent of either size, and each side misses at most (100 - t) percent of its own.

* Small sets list all their subsets of those sizes as keys: linked small sets share the key of their overlap.
* Large sets list a prefix of their shingles, rarest first (``rare_lists``): linked sets share the smallest shingle of
  their overlap. A pair is formed only where its sizes and the places of the shared shingle leave room for a link.
* A set size is small while its subsets cost less than scanning its inverted lists (``boundary``). Sets near the
  boundary list both kinds of keys, so that a pair across it is found by the prefix.

Sets that are equal form one class. A list links its members to a hub, the member whose lists are longest, then to
``HUBS`` members drawn by hash in each round, instead of to each other; verified links merge into components, and only
pairs across components are formed from the lists afterwards. So n near copies that link cost about n pairs a hub, and
no link between components is lost. Sizes, places and parity bits are compared inside the joins of the lists.

``link`` does the same for keys that others list (bands). It scans the rest by parts: shingles are dealt by hash to more
parts than linked sets may differ in, so that linked sets agree in a whole part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.components import components
from saleloom.llm.rare_lists import SLICE_BYTES, SLICE_ROWS, flat_sets, frequent_names, name_counts, rare_lists, set_classes
from saleloom.llm.shingles import mix, shingle_sets
from saleloom.operators.work import freeze, freeze_texts

SCAN_ROWS = 8  # rows of an inverted list that are scanned for one prefix shingle, for the cost of the boundary
HUB_ROUNDS = 2  # of ``link``: the first on the listed keys, the others on parts
DRAWN_HUBS = 4  # rounds of ``link_components`` whose hubs are drawn by hash, after one with the longest lists
HUBS = 32  # hubs of a list in each of these
SPARE_PARTS = 3  # parts beyond the least number, so that parts which happen to be empty need no key
BROADCAST_ROWS = 2_000_000  # ids of sets to fetch are broadcast up to so many rows (16 MB)
_SUBSET_SEED = np.uint64(0x5851F42D4C957F2D)
_PARITY_SEED = np.uint64(0x2545F4914F6CDD1D)
PARITY_BITS = 512
_PART_SEED = np.uint64(0x14057B7EF767814F)


def needed(size: int, percent: int) -> int:
    """Least overlap of a set of ``size`` with any set it links to."""
    return -(-percent * size // 100)


def boundary(percent: int) -> int:
    """Largest small size: listing its subsets costs no more rows than scanning its inverted lists."""
    size = 1
    while True:
        least = needed(size + 1, percent)
        subsets = sum(comb(size + 1, k) for k in range(least, size + 2))
        if subsets > SCAN_ROWS * (size + 1 - least + 1):
            return size
        size += 1


def _subset_keys(found: np.ndarray, least: int) -> np.ndarray:
    """Keys of all subsets of at least ``least`` members: the mixed sum of their mixed members."""
    terms = mix(found ^ _SUBSET_SEED)
    sums = [terms[list(c)].sum() + np.uint64(n) for n in range(least, len(found) + 1) for c in combinations(range(len(found)), n)]
    return mix(np.array(sums, dtype=np.uint64) ^ _SUBSET_SEED)


@lru_cache(maxsize=8)
def _size_steps(percent: int) -> list[int]:
    """Lower bounds of size classes such that linked sets are in the same or in neighbouring classes."""
    steps = [1]
    while steps[-1] < 1 << 40:
        steps.append(100 * steps[-1] // percent + 1)
    return steps


def _part_keys(found: np.ndarray, percent: int, small: int) -> np.ndarray:
    """Keys of one set for the last scan: its subsets if it is small, and its parts.

    A set of size class c is dealt to the parts of schemes c and c - 1; scheme c has ``SPARE_PARTS`` + 1 parts more
    than two linked sets can differ in of which the smaller is of class c. So linked sets agree in ``SPARE_PARTS`` + 1
    parts, and one of these is not empty unless both sets have more empty parts than ``SPARE_PARTS``.
    """
    size = len(found)
    keys = [np.zeros(0, np.uint64)]
    if 0 < size <= small:
        keys.append(_subset_keys(found, needed(size, percent)))
    if size >= needed(small + 1, percent):
        steps = _size_steps(percent)
        own = bisect_right(steps, size) - 1
        terms = mix(found ^ _PART_SEED)
        for scheme in (own, own - 1):
            union = 100 * (steps[scheme + 1] - 1) // percent
            parts = (100 - percent) * union // 100 + 1 + SPARE_PARTS
            part = (terms >> np.uint64(20)) % np.uint64(parts)
            sums = np.zeros(parts, dtype=np.uint64)
            np.add.at(sums, part.astype(np.int64), terms)
            number = np.bincount(part.astype(np.int64), minlength=parts).astype(np.uint64)
            tag = np.arange(parts, dtype=np.uint64) + np.uint64(scheme + 1) * np.uint64(0x9E3779B97F4A7C15)
            key = mix(mix(sums + number) ^ mix(tag))
            keys.append(key[number > 0] if (number == 0).sum() <= SPARE_PARTS else key)
    return np.concatenate(keys)


def _class_key(found: np.ndarray) -> int:
    """Hash of a whole set; 64 bits, so that unequal sets share a class with probability pairs / 2**64."""
    return int(set_classes(found, np.array([0, len(found)])).view(np.int64)[0])


def class_rows(texts: pa.Array, width: int) -> list[pa.Array]:
    """Set size and class of each text."""
    sets = shingle_sets(texts, width)
    classes = [_class_key(s) if len(s) else None for s in sets]
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64())]


def _sketch(docs: DataFrame, width: int, percent: int, small: int) -> DataFrame:
    """doc_id, n_shingles, class (null for an empty set), n_names, keys array<long> of small sets, frequent names.

    The names that many sets of a slice hold are in the slice's first row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLICE_ROWS, SLICE_BYTES):
            flat, bounds = flat_sets(batch.column(1), width)
            sizes = np.diff(bounds)
            classes = pa.array(set_classes(flat, bounds).view(np.int64), mask=sizes == 0)
            none = np.zeros(0, np.int64)
            keys = [_subset_keys(flat[a:b], needed(b - a, percent)).view(np.int64) if 0 < b - a <= small else none
                    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            names, sets = frequent_names(flat, bounds)
            often = [[{"name": int(n), "sets": int(k)} for n, k in zip(names, sets, strict=True)] if i == 0 else [] for i in range(len(sizes))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), classes, pa.array(name_counts(flat, bounds).astype(np.int64)),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(often, pa.list_(pa.struct([("name", pa.int64()), ("sets", pa.int64())])))],
                ["doc_id", "n_shingles", "class", "n_names", "keys", "frequent"])

    schema = (f"doc_id {dict(docs.dtypes)['doc_id']}, n_shingles long, class long, n_names long, keys array<long>, "
              "frequent array<struct<name: long, sets: long>>")
    return docs.mapInArrow(run, schema)


def _parity(found: np.ndarray) -> np.ndarray:
    """PARITY_BITS bits of a set: how many of its shingles fall on each bit, modulo 2."""
    bits = np.bincount((mix(found ^ _PARITY_SEED) % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int, percent: int, with_parts: bool = True) -> DataFrame:
    """(class, items, parity, parts) of the classes that ``wanted`` (class, doc_id) names, from the texts of those documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = shingle_sets(batch.column(1), width)
            classes = pa.array([_class_key(s) if len(s) else None for s in sets], pa.int64())
            items = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            parts = [_part_keys(s, percent, small).view(np.int64) for s in sets] if with_parts else [None] * len(sets)
            parts = pa.array(parts, pa.list_(pa.int64()))
            parity = pa.array([_parity(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([classes, items, parity, parts], ["class", "items", "parity", "parts"])

    small = boundary(percent)
    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    if wanted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    chosen = docs.join(ids, docs["doc_id"].eqNullSafe(ids["wanted_id"]), "left_semi")
    sets = chosen.mapInArrow(run, "class long, items array<long>, parity array<long>, parts array<long>")
    kept = sets.join(wanted.select("class"), "class", "left_semi")
    return kept.dropDuplicates(["class"])  # an id may have several rows


def _shared(listed: DataFrame) -> DataFrame:
    """Keys that at least two classes list."""
    spread = listed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return spread.where("low < high").select("key")


Least = Callable[[Column], Column]  # keys that two linked sets share at least, from the size of the smaller


def _live(listed: DataFrame, sizes: DataFrame, least: Least) -> DataFrame:
    """Rows (class, key) of the classes that may have a partner, without keys that only one class lists."""
    for _ in range(2):
        common = freeze(listed.join(_shared(listed), "key", "left_semi").distinct(), "common")
        enough = common.groupBy("class").agg(F.count(F.lit(1)).alias("n")).join(sizes, "class")
        enough = enough.where(F.col("n") >= least(F.col("n_shingles"))).select("class")
        listed = freeze(common.join(enough, "class", "left_semi"), "live")
    return freeze(listed.join(_shared(listed), "key", "left_semi"), "live")


def _few_apart(parity_a: Column, parity_b: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    """Parity bits that allow a link: a shingle of one set alone changes one bit at most."""
    apart = sum((F.bit_count(parity_a[i].bitwiseXOR(parity_b[i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * (size_a + size_b)


def _close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) the pairs whose parity bits allow a link."""
    def side(tag: str) -> DataFrame:
        return sets.select(F.col("class").alias(tag), F.col("parity").alias(f"parity_{tag}"), F.size("items").alias(f"size_{tag}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.where(_few_apart(*map(F.col, ("parity_a", "parity_b", "size_a", "size_b")), percent)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b) the pairs that link, by the overlap of their whole sets. The sets of ``a`` travel to those of ``b``."""
    left = sets.select(F.col("class").alias("a"), F.col("items").alias("of_a"))
    right = sets.select(F.col("class").alias("b"), F.col("items").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - overlap
    return both.where(100 * overlap >= percent * union).select("a", "b")


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Sizes within the threshold of each other."""
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _hub_pairs(lists: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with the hub that it shares most keys with. ``lists``: key, class, weight, label."""
    hubs = lists.groupBy("key").agg(F.max(F.struct("weight", "class", "label")).alias("hub"))
    met = lists.join(hubs, "key").where("class <> hub.class and label <> hub.label")
    met = met.groupBy("class", F.col("hub.class").alias("hub")).agg(F.count(F.lit(1)).alias("n"))
    a = sizes.select(F.col("class"), F.col("n_shingles").alias("size_a"))
    b = sizes.select(F.col("class").alias("hub"), F.col("n_shingles").alias("size_b"))
    met = met.join(a, "class").join(b, "hub").where(_fits(F.col("size_a"), F.col("size_b"), percent))
    return met.groupBy("class").agg(F.max(F.struct("n", "hub")).alias("best")).select(F.col("class").alias("a"), F.col("best.hub").alias("b"))


def _rest_pairs(lists: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that share a key; one of them is not in its list's largest component."""
    parts = lists.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("key").agg(F.max(F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("parts"))
    mixed = lists.join(largest.where("parts > 1").select("key", "main.label").withColumnRenamed("label", "main"), "key")
    sized = mixed.join(sizes.select("class", "n_shingles"), "class")
    c = sized.where("label <> main").select("key", F.col("class").alias("c"), F.col("label").alias("label_c"), F.col("n_shingles").alias("size_c"))
    d = sized.select("key", F.col("class").alias("d"), F.col("label").alias("label_d"), F.col("n_shingles").alias("size_d"), (F.col("label") == F.col("main")).alias("major"))
    met = c.join(d, "key").where("label_c <> label_d and (major or c < d)").where(_fits(F.col("size_c"), F.col("size_d"), percent))
    return met.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def _component_rows(sketch: DataFrame, sizes: DataFrame, named: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id from the labels of linked classes: class, found_label (``named``)."""
    label = F.coalesce(F.col("found_label"), F.col("class"))
    known = sketch.where("class is not null")
    grouped = sizes.join(named, "class", "left").select("class", "doc_id", label.alias("label"))
    lowest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = freeze(grouped.join(lowest, "label").select("class", "component_id"), "component")
    alone = sketch.where("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = known.select("doc_id", "n_shingles", "class").join(component, "class")
    return joined.select("doc_id", "n_shingles", "component_id").union(alone)


def _mixed(lists: DataFrame) -> DataFrame:
    """Rows of ``lists`` (with key, label) whose key is listed under more than one label."""
    spread = lists.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return lists.join(spread.where("low < high").select("key"), "key", "left_semi")


def _side(lists: DataFrame, tag: str) -> DataFrame:
    return lists.select("key", *[F.col(c).alias(f"{c}_{tag}") for c in ("class", "place", "n_shingles", "label", "parity")])


def _may_link(percent: int) -> Column:
    """Sides a and b of a list have different labels, and their sizes, the key's places and parity bits allow a link.

    Before their first common shingle two linked sets have no other, so the shingles from there on must suffice for the
    overlap.
    """
    size_a, size_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    overlap = F.ceil((size_a + size_b) * percent / (100 + percent))
    left = F.least(size_a - F.col("place_a"), size_b - F.col("place_b"))
    return ((F.col("label_a") != F.col("label_b")) & _fits(size_a, size_b, percent) & (left >= overlap)
            & _few_apart(F.col("parity_a"), F.col("parity_b"), size_a, size_b, percent))


def _drawn_pairs(lists: DataFrame, percent: int, step: int) -> DataFrame:
    """(a, b): each class with those of ``HUBS`` members of its lists, drawn by hash, that it may link to.

    Members are dealt to slots, and each slot gives one hub, if it can a member that has links. ``lists``: class, key,
    place, n_shingles, label, linked, parity.
    """
    drawn = F.struct("linked", F.xxhash64("class", F.lit(step)).alias("draw"), "class", "place", "n_shingles", "label", "parity")
    slot = F.pmod(F.xxhash64("class", F.lit(-step)), F.lit(HUBS)).alias("slot")
    hubs = lists.groupBy("key", slot).agg(F.max(drawn).alias("hub")).select("key", "hub.*")
    met = _side(lists, "a").join(_side(hubs, "b").hint("merge"), "key").where(_may_link(percent))
    return met.select(F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b")).distinct()


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different labels that share a listed key and may link.

    ``lists``: class, key, place, n_shingles, label, parity. The larger set looks its whole list up; the smaller one is
    found by the shingles that a partner of its own size can share.
    """
    listed = lists.where(F.col("place") <= F.col("n_shingles") - F.ceil(2 * percent * F.col("n_shingles") / (100 + percent)))
    ordered = F.struct("n_shingles_a", "class_a") < F.struct(F.col("n_shingles_b"), F.col("class_b"))
    met = _side(listed, "a").join(_side(lists, "b").hint("merge"), "key").where(ordered & _may_link(percent))
    return met.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def link_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles long (set size), component_id (smallest doc_id reachable by links, its own included).

    One row per row. Null and empty texts have no shingle and link with nothing: their component is their own id. Equal
    sets link. Null ids keep their row; a component's id is its smallest known one. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    small = boundary(percent)
    smallest = needed(small + 1, percent)
    sketch = freeze_texts(_sketch(texts, width, percent, small), "sketch")
    known = sketch.where("class is not null")
    sizes = known.groupBy("class").agg(F.first("n_shingles").alias("n_shingles"), F.first("n_names").alias("n_names"),
                                       F.min("doc_id").alias("doc_id"))
    sizes = freeze(sizes, "classes")

    subsets = known.select("class", F.explode("keys").alias("key"), F.lit(0).cast("long").alias("place"), "n_shingles").distinct()
    frequent = sketch.select(F.inline("frequent"))
    lists = rare_lists(texts, sizes, frequent, width, percent, smallest).union(subsets)
    lists = freeze_texts(lists, "lists")
    shared = freeze(lists.join(_shared(lists), "key", "left_semi"), "shared")
    spread = shared.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    weight = shared.join(spread, "key").groupBy("class").agg(F.avg("members").alias("weight"))
    weight = freeze(weight, "weight")
    wanted = freeze(sizes.join(weight, "class", "left_semi").select("class", "doc_id"), "wanted")
    sets = freeze_texts(_sets_of(texts, wanted, width, percent, False).select("class", "items", "parity"), "sets")

    labelled = shared.join(weight, "class").withColumn("label", F.col("class"))
    pairs = freeze(_close(_hub_pairs(labelled, sizes, percent), sets, percent), "pairs")
    found = freeze(_verified(pairs, sets, percent), "links")
    named = components(found).select(F.col("node").alias("class"), F.col("label").alias("found_label"))
    lists, step = shared, 1
    while step <= DRAWN_HUBS + 1:
        label = F.coalesce(F.col("found_label"), F.col("class")).alias("label")
        lists = lists.select(*shared.columns).join(named, "class", "left").select(
            *shared.columns, label, F.col("found_label").isNotNull().alias("linked"))
        lists = freeze(_mixed(lists), "labelled")
        known_bits = lists.join(sets.select("class", "parity"), "class")
        pairs = _drawn_pairs(known_bits, percent, step) if step <= DRAWN_HUBS else _candidates(known_bits, percent)
        found = freeze(_verified(freeze(pairs, "pairs"), sets, percent), "links")
        some = found.limit(1).count() > 0
        if some:
            named = freeze(_relabelled(named, found), "named")
        # Hubs only spare pairs of the last scan: where drawing them links nothing more, that scan follows.
        step = step + 1 if some or step > DRAWN_HUBS else DRAWN_HUBS + 1
    return _component_rows(sketch, sizes, named)


def _relabelled(named: DataFrame, found: DataFrame) -> DataFrame:
    """(class, found_label) after the links ``found`` (a, b): their components on labels, not on all links again."""
    def end(tag: str) -> DataFrame:
        return named.select(F.col("class").alias(tag), F.col("found_label").alias(f"label_{tag}"))

    label_a, label_b = F.coalesce("label_a", "a"), F.coalesce("label_b", "b")
    between = found.join(end("a"), "a", "left").join(end("b"), "b", "left").select(label_a.alias("a"), label_b.alias("b"))
    merged = components(freeze(between.distinct(), "between"))
    old = named.join(merged, named["found_label"] == merged["node"], "left")
    old = old.select("class", F.coalesce("label", "found_label").alias("found_label"))
    new = merged.join(named.select(F.col("class").alias("node")), "node", "left_anti")
    return old.union(new.select(F.col("node").alias("class"), F.col("label").alias("found_label")))


def link(sketch: DataFrame, texts: DataFrame, width: int, percent: int, least: Least) -> DataFrame:
    """doc_id, n_shingles, component_id from key lists: doc_id, n_shingles, class, keys (``sketch``), and the texts.

    ``least`` says how many keys two sets that link share at least.
    """
    known = sketch.where("class is not null")
    sizes = known.groupBy("class").agg(F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("doc_id"))
    sizes = freeze(sizes, "classes")
    listed = known.select("class", F.explode("keys").alias("key"))
    live = _live(listed, sizes, least)

    # A class is a better hub the more classes share its keys.
    spread = live.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    weight = live.join(spread, "key").groupBy("class").agg(F.avg("members").alias("weight"))
    weight = freeze(weight, "weight")
    lists = freeze(live.join(weight, "class"), "lists")
    wanted = freeze(sizes.join(weight, "class", "left_semi").select("class", "doc_id"), "wanted")
    sets = freeze(_sets_of(texts, wanted, width, percent), "sets")
    parts = sets.select("class", F.explode("parts").alias("key"))
    parts = freeze(parts.join(_shared(parts), "key", "left_semi").join(weight, "class"), "parts")

    links = None
    labelled = lists.withColumn("label", F.col("class"))
    for step in range(HUB_ROUNDS + 1):
        pairs = _hub_pairs(labelled, sizes, percent) if step < HUB_ROUNDS else _rest_pairs(labelled, sizes, percent)
        found = freeze(_verified(freeze(pairs, "pairs"), sets, percent), "links")
        links = found if links is None else links.union(found)
        named = components(links).select(F.col("node").alias("class"), F.col("label").alias("found_label"))
        label = F.coalesce(F.col("found_label"), F.col("class"))
        if step < HUB_ROUNDS:
            labelled = freeze(parts.join(named, "class", "left").select("key", "class", "weight", label.alias("label")), "lists")
    return _component_rows(sketch, sizes, named)
