"""Top-1 per key with a total order, shuffle- and skew-safe.

The warehouse form is ``ROW_NUMBER() OVER (PARTITION BY id) = 1`` with no
ORDER BY, i.e. an arbitrary pick.  We pick deterministically and compute it
as an aggregation, ``min(struct(order..., payload...))`` per key, because an
aggregate is combined map-side: a business id repeated in a third of all
rows still sends at most one row per map task through the shuffle, and no
task ever holds a whole key group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Order:
    """One sort key: column name, direction and NULL placement."""
    column: str
    descending: bool = False
    nulls_last: bool = False


def asc(c: str, nulls_last: bool = False) -> Order:
    return Order(c, False, nulls_last)


def desc(c: str, nulls_last: bool = True) -> Order:
    return Order(c, True, nulls_last)


def _order_fields(order: list[Order]) -> list[str]:
    """Encode sort keys so that ascending struct comparison realises them.

    Struct comparison puts NULL first; a leading null flag moves NULLs last,
    and negation turns a numeric descending key into an ascending one.
    """
    out = []
    for i, o in enumerate(order):
        if o.nulls_last:
            out.append(f"`{o.column}` is null as _n{i}")
        out.append(f"{'-' if o.descending else ''}`{o.column}` as _k{i}")
    return out


def _rest(order: list[Order], payload: list[str]) -> list[str]:
    """Payload columns that are not sort keys: the keys carry the others."""
    keys = {o.column for o in order}
    return [c for c in payload if c not in keys]


def ranked_struct(df: DataFrame, order: list[Order], payload: list[str] | None = None) -> Column:
    """``struct(order keys..., other payload...)`` whose minimum is the first
    row.  No column is carried twice: :func:`restored` reads the payload back."""
    payload = payload if payload is not None else df.columns
    kinds = dict(df.dtypes)
    for o in order:
        if o.descending and not kinds[o.column].startswith(
                ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")):
            raise TypeError(f"descending order needs a number, {o.column} is {kinds[o.column]}")
    return F.expr(f"struct({', '.join([*_order_fields(order), *[f'`{c}`' for c in _rest(order, payload)]])})")


def restored(best: str, order: list[Order], payload: list[str]) -> str:
    """The payload as a struct (SQL text), from the :func:`ranked_struct` in column ``best``."""
    at = {o.column: (i, o.descending) for i, o in enumerate(order)}
    fields = []
    for c in payload:
        i, down = at.get(c, (None, False))
        value = f"{best}.`{c}`" if i is None else f"{'-' if down else ''}{best}._k{i}"
        fields.append(f"{value} as `{c}`")
    return f"struct({', '.join(fields)})"


def first_per_key(df: DataFrame, key: str | list[str], order: list[Order],
                  payload: list[str] | None = None) -> DataFrame:
    """Keep the first row per key under ``order``; ties resolve to the smallest
    payload, so include enough columns in ``order`` to make it total."""
    keys = [key] if isinstance(key, str) else list(key)
    payload = payload if payload is not None else df.columns
    best = ranked_struct(df, order, payload)
    return (df.groupBy(*keys)
              .agg(F.min(best).alias("_best"))
              .selectExpr(f"{restored('_best', order, payload)} as row").select("row.*"))


def leading_rows(df: DataFrame, keys: list[str], lead: str) -> DataFrame:
    """The rows that hold the greatest ``lead`` of their keys (all of them where
    it is always NULL): the only ones that can win a pick that orders by it first.

    The first phase of a pick over a stored table.  It reads the keys and one
    number; its buffer has a fixed width, so a hash aggregate holds it and nothing
    is sorted.  The whole rows meet its result once, and what is picked from then
    on are the few rows that share the greatest value.  A hot key is one row per
    task in the aggregate, and its rows are split by the skewed join.
    """
    best = df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.max(lead).alias("_lead"))
    on = F.col(lead).eqNullSafe(F.col("_lead"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return df.join(best, on).select(*[df[c] for c in df.columns])
