"""Incremental scans of tables, relationship paths, and newest versions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.times import NO_BOUNDS, Bounds, lower_bound, upper_bound

#: The hidden column that carries the date of each scanned row to the step that advances the mark.
MARK = "__mark"


def dotted(df: DataFrame, path: str) -> Column:
    """A column or a path into a struct, whatever the case of its names; null where a parent is null."""
    names, kind, column = path.split("."), df.schema, None
    for name in names:
        found = next((f for f in kind.fields if f.name.lower() == name.lower()), None) if hasattr(kind, "fields") else None
        if found is None:
            raise ValueError(f"no column {path!r}")
        column = F.col(f"`{found.name}`") if column is None else column.getField(found.name)
        kind = found.dataType
    return column


def scan_table(
    df: DataFrame,
    fields: Sequence[str],
    date_field: str,
    where: str | None = None,
    limit: int | None = None,
    bounds: Bounds = NO_BOUNDS,
    mark: str | None = None,
    with_ties: bool = False,
    tie_break: Sequence[str] = (),
    with_mark: bool = False,
) -> DataFrame:
    """Rows inside the window, as the asked fields (dots become underscores) and the hidden date.

    The mark itself is outside the window, unless ``with_mark`` says otherwise.

    ``where`` is one SQL expression and cannot widen the window. With ``limit`` the oldest rows come; ``with_ties`` also takes the rows
    that share the last date, which a later run would otherwise never see, and ``tie_break`` decides among them if they are not taken.
    """
    date = dotted(df, date_field)
    kind = df.select(date).schema[0].dataType
    for condition in (lower_bound(date, kind, bounds, mark, with_mark), upper_bound(date, kind, bounds), F.expr(f"({where})") if where else None):
        if condition is not None:
            df = df.where(condition)
    if limit is not None and not with_ties:
        df = df.orderBy(date.asc(), *tie_break).limit(limit)
    elif limit is not None:
        last = df.select(date.alias("__last")).orderBy(F.col("__last").asc()).limit(limit).agg(F.max("__last").alias("__last"))
        df = df.join(F.broadcast(last), date <= F.col("__last")).drop("__last")  # one row
    return df.select(*[dotted(df, f).alias(f.replace(".", "_")) for f in fields], dotted(df, date_field).alias(MARK))


@dataclass(frozen=True)
class Relation:
    """A many-to-one hop: the foreign key on this side, the object that it leads to and that object's key."""

    foreign_key: str
    object: str
    key: str


def with_paths(df: DataFrame, objects: Mapping[str, DataFrame], relations: Mapping[tuple[str, str], Relation], source: str, paths: Sequence[str]) -> DataFrame:
    """Add the leaf of each path such as ``Customer.Nation.Name``, null where a hop finds nothing. Shared hops are joined once.

    Each hop is a left join on the key, with only the columns that paths need; keys must be unique.
    """
    own, needed = df.columns, {}
    for path in paths:
        *hops, leaf = path.split(".")
        for depth in range(1, len(hops) + 1):
            needed.setdefault(tuple(hops[:depth]), set())
        needed[tuple(hops)].add(leaf)
    at: dict[tuple[str, ...], str] = {(): source}
    for hops in sorted(needed, key=len):
        relation = relations[at[hops[:-1]], hops[-1]]
        at[hops] = relation.object
        onward = {relations[relation.object, h[-1]].foreign_key for h in needed if h[:-1] == hops}
        prefix = "_".join(hops)
        right = objects[relation.object].select(
            F.col(relation.key).alias(f"{prefix}__key"), *[F.col(c).alias(f"{prefix}_{c}") for c in sorted(needed[hops] | onward)]
        )
        left = "_".join((*hops[:-1], relation.foreign_key))
        df = df.join(right, F.col(left) == F.col(f"{prefix}__key"), "left").drop(f"{prefix}__key")
    return df.select(*own, *[path.replace(".", "_") for path in paths])


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str], status: Column | None = None) -> DataFrame:
    """The newest row of each key among those with the right status; ``newest`` lists the columns that decide, most important first."""
    if status is not None:
        df = df.where(status)
    rest = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*rest), F.struct(*newest)).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, "row.*").select(*df.columns)


def oldest(df: DataFrame, date: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(date).asc(), *tie_break).limit(n)


def oldest_per_key(df: DataFrame, keys: Sequence[str], date: str, n: int, with_ties: bool = False, tie_break: Sequence[str] = ()) -> DataFrame:
    nth = F.rank().over(Window.partitionBy(*keys).orderBy(date)) if with_ties else F.row_number().over(Window.partitionBy(*keys).orderBy(date, *tie_break))
    return df.withColumn("__nth", nth).where(F.col("__nth") <= n).drop("__nth")
