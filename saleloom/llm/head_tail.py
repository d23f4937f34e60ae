"""Semi joins and lookups on keys of any frequency: the frequent keys are broadcast, the others shuffled.

A key that at least ``total / HEAD_KEYS`` of the rows hold is a head key, so there are at most ``HEAD_KEYS`` of them,
however large the tables are. No key that is left for the shuffle holds more than that share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAD_KEYS = 500_000


def look_up(rows: DataFrame, found: DataFrame, keys: Sequence[str], uses: str, total: int,
            head_keys: int = HEAD_KEYS) -> DataFrame:
    """``rows`` inner joined with ``found``, a stored table with one row per key.

    The column ``uses`` of ``found`` says how many of the ``total`` rows hold the key; it is not returned. If every key
    is a head key, ``rows`` is read once and not shuffled.
    """
    often = F.col(uses) * head_keys >= total
    head = rows.join(F.broadcast(found.where(often).drop(uses)), list(keys))
    tail = found.where(~often).drop(uses)
    if not tail.limit(1).count():
        return head
    return head.unionByName(rows.join(tail.hint("merge"), list(keys)))
