from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = ("ingested_at",),
    keep: str = "first",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the first or the last in ``order``, NULLs in ``order`` losing.

    ``ties`` (by default all other columns) settle equal ``order`` values, so the
    survivor does not depend on partitioning or arrival.  That makes the operator
    idempotent and associative: ``keep_one(a ∪ b)`` equals
    ``keep_one(keep_one(a) ∪ b)``, which the incremental sinks build on.

    NULL key values group together.  Catalyst adds a ``WindowGroupLimit`` below
    the shuffle, so each task ships at most one row per key: a key that holds a
    third of all rows reaches its reducer as one row per map task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    if ties is None:
        ties = [c for c in df.columns if c not in {*key, *order}]
    wanted = [F.col(c) for c in (*order, *ties)]
    direction = [
        c.asc_nulls_last() if keep == "first" else c.desc_nulls_last() for c in wanted
    ]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*direction))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def distinct_records(df: DataFrame) -> DataFrame:
    """Whole rows once each, NULLs equal; copies are combined before the shuffle, so none can be hot."""
    return df.dropDuplicates()


def first_seen(
    stream: DataFrame, key: Sequence[str], ttl: str = "2 days", spread: int = 16
) -> DataFrame:
    """On a stream, the first arrival of each key; later copies are dropped.

    The watermark runs on arrival time, so no record is ever late and none is
    lost; a key's state expires ``ttl`` after its first arrival, and a copy that
    comes later than that is let through again (readers settle it with
    :func:`keep_one`).

    Streaming dedup has no map-side step, so a hot key would send all its copies
    to one task.  A first pass on ``key`` plus a random spread number leaves at most
    ``spread`` copies per key for the second pass.  ``spread=1`` skips the first pass
    and its state, for sources known to be free of hot keys.
    """
    arrived = stream.withColumn("_arrival", F.current_timestamp()).withWatermark("_arrival", ttl)
    if spread > 1:
        arrived = (
            arrived.withColumn("_spread", F.floor(F.rand(seed=0) * spread))
            .dropDuplicatesWithinWatermark([*key, "_spread"])
            .drop("_spread")
        )
    return arrived.dropDuplicatesWithinWatermark(list(key)).drop("_arrival")
