"""Document query over several tables: rows with arrays of the rows that belong to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from facetable.functions.conditions import condition, ordering
from facetable.functions.names import quote


@dataclass(frozen=True)
class Children:
    """Rows of another table that belong to a parent: ``on`` has pairs (parent, child).

    At most ``limit`` of each parent, the first by ``order_by``; both are needed, so
    that no parent gathers more than that.
    """

    frame: DataFrame
    on: Sequence[tuple[str, str]]
    select: Sequence[str]
    limit: int
    order_by: Mapping[str, str]
    where: Mapping[str, Any] | None = None


def nested_query(
    frame: DataFrame,
    select: Sequence[str],
    children: Mapping[str, Children],
    where: Mapping[str, Any] | None = None,
    limit: int | None = None,
    order_by: Mapping[str, str] | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Fields ``select`` of rows that meet ``where``, and for each of ``children`` a column of
    that name: an array of structs, in their order, empty if there are none.

    The children of a key are cut to the limit in every task before the shuffle, so a
    parent with a third of all children costs a few rows of each task.  With a ``limit``
    only the children of the page are looked at.  A NULL key has no children; rows that
    repeat a parent each have all of its children.  Children that are equal in the order are
    cut anywhere between them.
    """
    if isinstance(select, str) or not select:
        raise ValueError("select needs a list of at least one field")
    clash = {n.lower() for n in children} & {n.lower() for n in select}
    if clash:
        raise ValueError(f"fields and children are both named {sorted(clash)}")
    if offset is not None and limit is None:
        raise ValueError("an offset needs a limit")
    if where:
        frame = frame.where(condition(where))
    if order_by:
        frame = frame.orderBy(*ordering(order_by))
    if offset is not None:
        frame = frame.offset(offset)
    if limit is not None:
        frame = frame.limit(limit)
    keys = {name: [F.col(quote(mine)) for mine, _ in part.on] for name, part in children.items()}
    rows = frame.select(
        F.struct(*[F.col(quote(field)).alias(field) for field in select]).alias("row"),
        *[F.struct(*[k.alias(f"k{n}") for n, k in enumerate(own)]).alias(f"keys{i}") for i, own in enumerate(keys.values())],
    )
    for i, part in enumerate(children.values()):
        page = rows.select(f"keys{i}.*").distinct() if limit is not None else None
        nested = _nested(part, page)
        same = reduce(Column.__and__, [F.col(f"keys{i}.k{n}") == F.col(f"c{i}.k{n}") for n in range(len(part.on))])
        empty = F.array().cast(nested.schema["rows"].dataType)
        rows = rows.join(nested.alias(f"c{i}"), same, "left").select(
            *rows.columns, F.coalesce(F.col(f"c{i}.rows"), empty).alias(f"rows{i}")
        )
    return rows.select("row.*", *[F.col(f"rows{i}").alias(name) for i, name in enumerate(children)])


def _nested(part: Children, page: DataFrame | None) -> DataFrame:
    """k0, k1, ... and ``rows``: the first children of each key."""
    if part.limit is None or part.limit < 1:
        raise ValueError("children need a limit of at least one")
    if not part.order_by:
        raise ValueError("children need an order")
    frame = part.frame.where(condition(part.where)) if part.where else part.frame
    keys = [f"k{n}" for n in range(len(part.on))]
    order = [f"o{n}" for n in range(len(part.order_by))]
    known = reduce(Column.__and__, [F.col(quote(theirs)).isNotNull() for _, theirs in part.on])
    rows = frame.where(known).select(
        *[F.col(quote(theirs)).alias(k) for (_, theirs), k in zip(part.on, keys, strict=True)],
        *[F.col(quote(field)).alias(o) for field, o in zip(part.order_by, order, strict=True)],
        F.struct(*[F.col(quote(field)).alias(field) for field in part.select]).alias("row"),
    )
    if page is not None:
        rows = rows.join(page, keys, "left_semi")
    directions = ordering(dict(zip(order, part.order_by.values(), strict=True)))
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*directions)))
    kept = first.where(F.col("place") <= part.limit).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("place", "row"))).alias("rows")
    )
    return kept.select(*keys, F.col("rows.row").alias("rows"))
