"""Duplicate operators. None of them sends all copies of a row through one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom.operators.joins import BROADCAST_BYTES, measured_bytes
from saleloom.operators.work import freeze

COPIES_PER_TASK_ROW = 100_000
COMPARED = 8_000_000  # contents with copies that are compared at full width at a time
_HASH = ("__h1", "__h2")
_WORD_BITS = 21
_WORDS = 1 << _WORD_BITS


def flag_duplicates(df: DataFrame, flag: str = "is_duplicate", chunk: int = COPIES_PER_TASK_ROW, stored: bool = False) -> DataFrame:
    """Add a flag that is FALSE for one row of every group of equal rows and TRUE for its copies.

    Equal rows cannot be told apart, so it is enough to count them and to emit each row that many
    times: one shuffle of map-side combined rows. A group with more than ``chunk`` copies is first cut
    into chunks that are spread over all tasks. NULL equals NULL and 0.0 equals -0.0. Of a ``stored`` table, which
    is cheap to read again, only rows whose hash occurs again go through that shuffle, and these are stored.
    """
    if stored:
        again, once = split_by_hash(df.select("*", *row_hash(df.columns)))
        single = once.select(*[F.col(f"`{c}`") for c in df.columns], F.lit(False).alias(flag))
        flagged = flag_duplicates(again.select(*[F.col(f"`{c}`") for c in df.columns]), flag, chunk)
        return single.unionByName(freeze(flagged, "flagged", compact=True))
    columns, count, copy = df.columns, "__copies", "__copy"
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))
    few = counted.filter(F.col(count) <= chunk).select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))).alias(copy)
    )
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (
        counted.filter(F.col(count) > chunk)
        .select(
            *columns,
            count,
            F.explode(F.sequence(F.lit(1).cast("long"), F.col(count), F.lit(chunk).cast("long"))).alias("__first"),
        )
        .repartition(tasks)
        .select(
            *columns,
            F.explode(
                F.sequence(F.col("__first"), F.least(F.col("__first") + F.lit(chunk - 1), F.col(count)))
            ).alias(copy),
        )
    )
    return few.unionByName(many).select(*columns, (F.col(copy) > 1).alias(flag))


def row_hash(columns: Sequence[str]) -> list[Column]:
    """128 bits of a row's content. Equal rows have equal hashes: NULL equals NULL, and 0.0 equals -0.0."""
    values = [F.col(f"`{c}`") for c in columns]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(*values).alias(_HASH[0]), F.xxhash64(F.lit(1), *values, *nulls).alias(_HASH[1])]


def split_by_hash(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``, which carry their ``row_hash``, in two: all whose hash occurs again, with few others, and the rest.

    The first hash of every row is counted, 8 bytes a row. Those that occur again set bits in words of 64, at most
    2**21 words and so a bounded broadcast, and a row goes by its bit. No row of the rest has a copy.
    """
    return _split(rows, _words(rows))


def _bit() -> Column:
    return F.expr(f"shiftleft(1L, CAST(shiftright({_HASH[0]}, {_WORD_BITS}) & 63 AS INT))")


def _word() -> Column:
    return F.col(_HASH[0]).bitwiseAND(F.lit(_WORDS - 1))


def _words(rows: DataFrame) -> DataFrame:
    hash_ = F.col(_HASH[0])
    again = rows.groupBy(hash_).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(hash_)
    return freeze(again.groupBy(_word().alias("__word")).agg(F.bit_or(_bit()).alias("__bits")), "hashes", compact=True)


def _split(rows: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = rows.join(F.broadcast(words), _word() == F.col("__word"), "left")
    found = F.coalesce(F.col("__bits").bitwiseAND(_bit()) != 0, F.lit(False))
    return marked.where(found).select(*rows.columns), marked.where(~found).select(*rows.columns)


def count_copies(df: DataFrame, columns: Sequence[str]) -> int:
    """Rows that equal an earlier one in ``columns``.

    ``df`` is read twice and should be stored. The hashes of all rows are counted first; only rows whose hash occurs
    again, with few others, are compared, and shuffled, at full width, so the result is exact (``split_by_hash``). Counts
    are combined before each shuffle, so a row that was sent very often is no bottleneck. The comparison takes passes of
    about ``COMPARED`` contents, chosen by the word of their bit, each of which reads ``df`` once more; the shuffle files of a
    pass are gone before the next.
    """
    rows = df.select("*", *row_hash(columns))
    words = _words(rows)
    passes = max(1, math.ceil((words.agg(F.sum(F.bit_count("__bits"))).first()[0] or 0) / COMPARED))
    total = 0
    for n in range(passes):
        found, _ = _split(rows, words.where(F.pmod("__word", F.lit(passes)) == n))
        again = _contents(found, columns, None).agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0).cast("long")).alias("again"))
        total += freeze(again, "again", compact=True).first()[0]
    return total


def _contents(rows: DataFrame, columns: Sequence[str], order: str | None) -> DataFrame:
    first = F.min(order) if order else F.lit(None).cast("long")
    return rows.groupBy(*_HASH, *[f"`{c}`" for c in columns]).agg(F.count(F.lit(1)).alias("__n"), first.alias("__first"))


def flag_later_copies(df: DataFrame, order: str, flag: str = "is_duplicate") -> DataFrame:
    """Add a flag that is TRUE for every row that equals an earlier one; ``order`` is a row's position.

    The position takes no part in the comparison. The rows are stored once, with their hashes; only those whose hash
    occurs again, with few others, meet the contents that do, and not even these are shuffled as long as the contents fit
    a broadcast. Each of those is one row of 24 bytes, however often it was sent. Contents are compared in the join only if two of them have been found to share a hash.
    """
    columns = [c for c in df.columns if c != order]
    rows = freeze(df.select("*", *row_hash(columns)), "rows")
    again, once = split_by_hash(rows)
    groups = freeze(_contents(again, columns, order), "copies")
    contents, hashes = groups.agg(F.count(F.lit(1)), F.count_distinct(*_HASH)).first()
    compared = columns if contents > hashes else []
    firsts = groups.where("__n > 1").select(
        *[F.col(c).alias(f"_{c}") for c in _HASH], *[F.col(f"`{c}`").alias(f"__of_{i}") for i, c in enumerate(compared)], "__first")
    same = [F.col(c) == F.col(f"_{c}") for c in _HASH] + [F.col(f"`{c}`").eqNullSafe(F.col(f"__of_{i}")) for i, c in enumerate(compared)]
    small = measured_bytes(firsts) <= BROADCAST_BYTES
    joined = again.join(F.broadcast(firsts) if small else firsts, reduce(lambda a, b: a & b, same), "left")
    later = F.coalesce(F.col(order) > F.col("__first"), F.lit(False))
    kept = [F.col(f"`{c}`") for c in df.columns]
    return once.select(*kept, F.lit(False).alias(flag)).unionByName(joined.select(*kept, later.alias(flag)))


def _pick(df: DataFrame, key: str, order_by: Sequence[str], picker) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(picker(F.struct(*rest), F.struct(*order_by)).alias("__row"))
    return best.select(*[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, NULL key included: the last in ``order_by`` order."""
    return _pick(df, key, order_by, F.max_by)


def keep_first(df: DataFrame, key: str, attrs: Sequence[str], order_by: Sequence[str], prefer: Column | None = None) -> DataFrame:
    """One row per key with the attributes of its first row; ties go to the smallest attributes.

    Rows are first reduced to the distinct (key, attributes, leading order) combinations with the
    smallest last order value: a hash aggregate with map-side combine. Only those few go
    through the slower row-picking aggregate, so a key that owns most rows is no problem. Rows where
    ``prefer`` is true win over the others.
    """
    *leading, last = order_by
    lead = {f"__o{i}": F.col(c) for i, c in enumerate(leading)}
    if prefer is not None:
        lead = {"__p": ~prefer, **lead}
    combos = (
        df.select(key, *attrs, F.col(last).alias("__last"), *[c.alias(n) for n, c in lead.items()])
        .groupBy(key, *attrs, *lead)
        .agg(F.min("__last").alias("__last"))
    )
    # NULL order values come last, as in an explicit ascending sort with nulls last.
    ranks = [x for c in [*lead, "__last"] for x in (F.col(c).isNull(), F.col(c))]
    ranks += [F.col(a) for a in attrs]
    best = combos.groupBy(key).agg(F.min_by(F.struct(*attrs, F.lit(1)), F.struct(*ranks)).alias("__row"))
    return best.select(key, *[F.col(f"__row.{a}").alias(a) for a in attrs])
