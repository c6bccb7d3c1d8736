"""Insert-if-absent on natural keys, and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from landfall.session import settle

# monotonically_increasing_id() holds the task in the upper bits and the row's
# position within the task in the lower 33.
_POSITION_BITS = 33


def absent(new: DataFrame, existing: DataFrame, keys: Sequence[str],
           null_safe: bool = False) -> DataFrame:
    """Rows of `new` whose key is not in `existing`.

    NULL equals nothing, as in SQL, unless `null_safe`.
    """
    taken = existing.select(*[F.col(k).alias(f"_taken_{k}") for k in keys])
    matches = [
        F.col(k).eqNullSafe(F.col(f"_taken_{k}")) if null_safe
        else F.col(k) == F.col(f"_taken_{k}")
        for k in keys
    ]
    return new.join(taken, reduce(lambda a, b: a & b, matches), "left_anti")


def insert_if_absent(new: DataFrame, existing: DataFrame | None, keys: Sequence[str],
                     order_by: Sequence[str] = (), in_batch: str = "first",
                     null_safe: bool = False, nullable: Sequence[str] | None = None) -> DataFrame:
    """Rows of `new` to insert into `existing`.

    in_batch='first' keeps one row per key within the batch as well: the first by
    `order_by`, then by all other columns, NULLs last. 'keep' only removes keys
    that `existing` already has.

    Without `null_safe`, a row with NULL in its key conflicts with nothing and is
    kept. `nullable` names the key columns where that can happen (default all);
    only then are such rows split off, so they never form one window group.
    """
    if in_batch not in ("first", "keep"):
        raise ValueError(f"in_batch must be 'first' or 'keep', not {in_batch!r}")
    fresh = new if existing is None else absent(new, existing, keys, null_safe)
    if in_batch == "keep":
        return fresh
    rest = [c for c in new.columns if c not in keys and c not in order_by]
    window = Window.partitionBy(*keys).orderBy(
        *[F.asc_nulls_last(c) for c in (*order_by, *rest)])

    def first_of(rows: DataFrame) -> DataFrame:
        if not order_by and not rest:
            return rows.distinct()
        return rows.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")

    unmatched = [F.col(k).isNull() for k in (keys if nullable is None else nullable)]
    if null_safe or not unmatched:
        return first_of(fresh)
    incomplete = reduce(lambda a, b: a | b, unmatched)
    return first_of(fresh.where(~incomplete)).unionByName(fresh.where(incomplete))


def next_key(existing: DataFrame, key_col: str) -> int:
    """First free key of a dimension: one above the greatest in use."""
    return existing.agg(F.coalesce(F.max(key_col), F.lit(0)) + 1).first()[0]


def _numbered(placed: DataFrame, key_col: str, start: int | Column) -> DataFrame:
    """Dense keys from stored positions: rows of earlier tasks plus own position.

    The offsets hold one row per task that wrote `placed`, which bounds both the
    window over them and their broadcast.
    """
    task = F.shiftright("_slot", _POSITION_BITS)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_slot").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    base = start if isinstance(start, Column) else F.lit(start)
    columns = [c for c in placed.columns if c != "_slot"]
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .select((base.cast("long") + F.col("_offset") + position).alias(key_col), *columns)
    )


def dense_keys(df: DataFrame, key_col: str, start: int | Column = 0) -> DataFrame:
    """Keys start, start + 1, ... in the order of the rows, without a global window.

    The rows are stored once with their task and position, so a retried task
    cannot renumber them.
    """
    placed = settle(df.withColumn("_slot", F.monotonically_increasing_id()), "placed")
    return _numbered(placed, key_col, start)


def assign_keys(new: DataFrame, key_col: str, order_by: Sequence[str],
                start: int = 1) -> DataFrame:
    """Dense surrogate keys for new dimension rows, in the order of `order_by`.

    The remaining columns break ties, so equal input gives equal keys.
    """
    rest = [c for c in new.columns if c not in order_by]
    ordered = new.orderBy(*[F.asc_nulls_last(c) for c in (*order_by, *rest)])
    return dense_keys(ordered, key_col, start)
