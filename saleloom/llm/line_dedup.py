"""Removal of lines that many documents share, in SQL expressions only.

Lines are exploded as 128-bit hashes of their normal form, never with their text, and each document counts a hash
once. Texts are shuffled a single time, to meet the positions of their dropped lines. A text is identified by its
content, so that a repeated task or another evaluation of the input finds the same rows, and copies share one list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleloom.llm.head_tail import look_up
from saleloom.operators.work import freeze

MIN_CHARS, MIN_DOCS = 1, 10
_BLANK = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SECOND_SEED = 1


def _hash(text: Column) -> list[Column]:
    """128 bits in two columns; two unequal texts agree with a probability of 2**-128."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(_SECOND_SEED), text).alias("h2")]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keys_of(text: Column) -> Column:
    """Normal forms of all lines: blanks stripped at both ends, A-Z in lower case."""
    return F.transform(lines_of(F.translate(text, _UPPER, _LOWER)), lambda line: F.btrim(line, F.lit(_BLANK)))


def _without(lines: Column, dropped: Column) -> Column:
    """``lines`` without the ascending positions ``dropped``, put together from the runs between them.

    Both arrays are bound to a lambda variable, else they would be made anew for every run.
    """
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))

    def kept(both: Column) -> Column:
        def run(i: Column) -> Column:
            before, after = F.get(both["bounds"], i), F.get(both["bounds"], i + 1)
            return F.slice(both["lines"], before + 2, after - before - 1)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(both["bounds"]) - 2), run))

    return F.transform(F.array(F.struct(lines.alias("lines"), bounds.alias("bounds"))), kept)[0]


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                      min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text, n_lines long, n_dropped long: every row without the lines that at least ``min_docs`` rows hold.

    A row is a document, also where an id repeats or is null; a null text is one empty line, and comes back empty. Only
    keys of at least ``min_chars`` code points are looked at, so blank lines stay by default. If all lines go, the text
    is empty. Other columns are ignored. No input, no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))

    once = rows.select(F.explode(F.array_distinct(keys_of(F.col("text")))).alias("key"))
    hashed = once.where(F.char_length("key") >= min_chars).select(*_hash(F.col("key")))
    shared = hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs)
    shared = freeze(shared, "shared_lines")

    whole = [c.alias(n) for c, n in zip(_hash(F.col("text")), ("t1", "t2"), strict=True)]
    named = rows.select("doc_id", *whole, "text")
    place = F.posexplode(keys_of(F.col("text"))).alias("at", "key")
    lines = named.select("doc_id", "t1", "t2", place).where(F.char_length("key") >= min_chars)
    lines = lines.select("doc_id", "t1", "t2", "at", *_hash(F.col("key")))
    total = shared.agg(F.sum("n_docs")).first()[0] or 0
    found = look_up(lines, shared, ("h1", "h2"), "n_docs", total)
    dropped = found.groupBy(F.col("doc_id").alias("of_id"), F.col("t1").alias("of_t1"), F.col("t2").alias("of_t2")).agg(
        F.array_sort(F.collect_set("at")).alias("dropped"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("t1") == F.col("of_t1")) & (F.col("t2") == F.col("of_t2"))
    joined = named.join(dropped, same, "left")
    lines = lines_of(F.col("text"))
    none = F.col("dropped").isNull()
    return joined.select(
        "doc_id",
        F.when(none, F.col("text")).otherwise(F.array_join(_without(lines, F.col("dropped")), "\n")).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.when(none, 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
    )
