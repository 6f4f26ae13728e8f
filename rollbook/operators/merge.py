"""The upsert: the next snapshot as a function of the last one and a batch."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IN_TARGET = "__in_target"
IN_BATCH = "__in_batch"


class Upserted(NamedTuple):
    next: DataFrame
    rejects: DataFrame


def has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def latest_per_key(
    batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the other columns.

    A maximum is aggregated within each task first, so a key that holds a large
    part of the batch reaches the shuffle as one row per task. Comparing whole
    rows keeps the choice the same on every run.
    """
    names = batch.columns
    rest = [name for name in names if name not in keys and name not in order]
    latest = batch.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("row"))
    return latest.selectExpr(*[f"`{name}`" if name in keys else f"row.`{name}`" for name in names])


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    on_insert: Mapping[str, Column] | None = None,
    overwrite: Sequence[str] = (),
    on_match: Mapping[str, Column] | None = None,
    order: Sequence[str] = (),
    unique: bool = False,
    ignore: Collection[str] = (),
) -> Upserted:
    """Merge ``batch`` into ``target`` by ``keys``.

    An inserted row takes ``on_insert``, expressions over the batch columns; the
    batch column of the same name where that says nothing; else NULL. A matched
    row takes the value an insert would have for the columns in ``overwrite``,
    the expressions in ``on_match``, and keeps the rest. With neither of them,
    only absent rows are inserted.

    Batch rows with a NULL key become ``rejects``. Target rows with a NULL key
    cannot match; they bypass the join, as they would all hash into one task.
    ``unique`` states that the batch holds each key once and saves the
    aggregation that otherwise makes it so.

    A batch column that the target lacks is an error, or a misspelt name would load
    NULLs; only columns of ``order`` and those to ``ignore`` may be left out.

    The join shuffles both sides on the key. A target that is bucketed by the
    key is not shuffled.
    """
    on_insert, on_match = dict(on_insert or {}), dict(on_match or {})
    if unknown := set(batch.columns) - set(target.columns) - set(order) - set(ignore):
        raise ValueError(f"the target has no columns {sorted(unknown)}")
    rejects = batch.filter(~has_key(keys))
    keyed = batch.filter(has_key(keys))
    if not unique:
        keyed = latest_per_key(keyed, keys, order)

    # The batch side of the join carries finished values under names of its own.
    given = set(batch.columns)
    types = {field.name: field.dataType.simpleString() for field in target.schema}
    new = [
        on_insert[name].cast(kind).alias(f"__new_{name}")
        if name in on_insert
        else F.expr(f"cast({f'`{name}`' if name in given else 'null'} as {kind}) as `__new_{name}`")
        for name, kind in types.items()
        if name not in keys
    ]
    set_ = [value.cast(types[name]).alias(f"__set_{name}") for name, value in on_match.items()]
    incoming = keyed.select(*keys, F.lit(True).alias(IN_BATCH), *new, *set_)
    matched = {name: f"__new_{name}" for name in overwrite} | {
        name: f"__set_{name}" for name in on_match
    }

    current = target.filter(has_key(keys)).withColumn(IN_TARGET, F.lit(True))
    merged = current.join(incoming, list(keys), "full_outer").selectExpr(
        *[
            f"`{name}`"
            if name in keys
            else f"case when {IN_TARGET} is null then `__new_{name}`"
            f" when {IN_BATCH} then `{matched.get(name, name)}` else `{name}` end as `{name}`"
            for name in target.columns
        ]
    )
    return Upserted(merged.unionByName(target.filter(~has_key(keys))), rejects)
