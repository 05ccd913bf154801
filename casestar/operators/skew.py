"""Hot join keys, found by a bounded summary of counts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most so many keys of a join are taken for hot, out of so many that are tracked at once.
MOST_HOT, TRACKED = 1000, 10_000


def key_hash(names: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{name}`") for name in names])


def hot_hashes(df: DataFrame, keys: dict[str, list[str]], share: float) -> dict[str, list[int]]:
    """For each named list of columns the hashes of the value combinations that own at least
    ``share`` of the rows.

    One pass, no shuffle of rows: a frequent-items sketch of fixed size per list, merged over
    the tasks. Its estimates are upper bounds, so no hot key is missed as long as fewer than
    ``TRACKED`` are equally common; a key too many costs nothing but its place.
    """
    if not keys:
        return {}
    sketches = [F.call_function("approx_top_k", key_hash(columns), F.lit(MOST_HOT),
                                F.lit(TRACKED)).alias(name) for name, columns in keys.items()]
    # MOST_HOT entries per list
    found = df.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    least = max(found["_rows"] * share, 2)
    return {name: [item["item"] for item in (found[name] or ()) if item["count"] >= least]
            for name in keys}
