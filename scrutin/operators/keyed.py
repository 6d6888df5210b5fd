"""Joins of many rows with a table of one row per key, without a hot task.

The per-key table is the smaller side by far: an aggregate with one row for
each key.  It is computed once and counted.  If it is small it is broadcast, and
the rows are not shuffled at all.  Otherwise a frequency sketch of the rows'
keys finds those that hold more than a task's share; the table's rows of these
keys, whose number is bounded, are broadcast to the rows of these keys, and only
the other rows, none of whose keys is hot, are shuffled.  Neither a hot key nor
many equal rows can make one task large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.session import materialise

#: The most rows of a per-key table that is broadcast.
MAX_BROADCAST_ROWS = 10_000
#: Keys that the frequency sketch reports, and the keys that it counts to find them.
HOT_KEYS, TRACKED = 200, 16_384
#: A key is hot if it holds at least this share of the rows; at most 1 / HOT_SHARE keys do.
HOT_SHARE = 1 / 200

_HASH = "__key_hash"


def _hash(columns: Sequence[Column]) -> Column:
    """One number per key; null keys have one too.  Two keys of one number are only treated alike."""
    return F.xxhash64(*columns)


def hot_hashes(rows: DataFrame, on: Sequence[str]) -> list[int]:
    """The numbers of the keys that hold at least HOT_SHARE of the rows: one job, at most HOT_KEYS numbers."""
    row = rows.select(_hash([F.col(c) for c in on]).alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] >= HOT_SHARE * row["n"]]


def join_per_key(rows: DataFrame, per_key: DataFrame, on: Sequence[str], how: str = "inner",
                 broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``rows`` with the columns of ``per_key`` (at most one row per key; null
    keys match null keys).  ``how`` is ``inner`` or ``left``.  ``per_key`` is
    computed at once, and kept in the session's checkpoint folder."""
    on = list(on)
    payload = [c for c in per_key.columns if c not in on]
    table = materialise(per_key.select(*[F.col(c).alias(f"__key_{i}") for i, c in enumerate(on)], *payload))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        cond = F.lit(True)
        for i, c in enumerate(on):
            cond = cond & F.col(c).eqNullSafe(F.col(f"__key_{i}"))
        return left.join(right, on=cond, how=how).select(*rows.columns, *payload)

    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return joined(rows, F.broadcast(table))
    hot = hot_hashes(rows, on)
    if not hot:
        return joined(rows, table)
    is_hot = _hash([F.col(c) for c in on]).isin(hot)
    held = table.where(_hash([F.col(f"__key_{i}") for i in range(len(on))]).isin(hot))
    return joined(rows.where(is_hot), F.broadcast(held)).unionByName(joined(rows.where(~is_hot), table))
