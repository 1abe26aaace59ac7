"""``where`` objects of a document query, as Spark columns.

``{"salary": {"_gt": 50000}}`` becomes ``salary > 50000``.  Entries next to each
other are joined by AND.  The result is an ordinary column expression, so it is
pushed to the scan like any other filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from facetable.functions.names import quote

# The comparison names a document client may use.  ``_gt`` is the
# one the demo query needs; the others are extensions of the same kind.
COMPARISONS = {
    "_gt": lambda column, value: column > value,
    "_gte": lambda column, value: column >= value,
    "_lt": lambda column, value: column < value,
    "_lte": lambda column, value: column <= value,
    "_eq": lambda column, value: column == value,
    "_neq": lambda column, value: column != value,
    "_in": lambda column, value: column.isin(list(value)),
    "_nin": lambda column, value: ~column.isin(list(value)),
    "_like": lambda column, value: column.like(value),
    "_is_null": lambda column, value: column.isNull() if value else column.isNotNull(),
}

# Sort directions of the ``order_by`` extension.
DIRECTIONS = {
    "asc": Column.asc,
    "asc_nulls_first": Column.asc_nulls_first,
    "asc_nulls_last": Column.asc_nulls_last,
    "desc": Column.desc,
    "desc_nulls_first": Column.desc_nulls_first,
    "desc_nulls_last": Column.desc_nulls_last,
}


def condition(where: Mapping[str, Any] | None) -> Column:
    """The row filter a ``where`` object stands for; an empty one keeps all rows."""
    return _all_of(_entry(name, body) for name, body in (where or {}).items())


def ordering(order_by: Mapping[str, str] | None) -> list[Column]:
    """Sort columns of an ``order_by`` object, in the order given."""
    columns = []
    for field, direction in (order_by or {}).items():
        if direction not in DIRECTIONS:
            raise ValueError(f"unknown sort direction {direction!r} for {field!r}")
        columns.append(DIRECTIONS[direction](F.col(quote(field))))
    return columns


def _entry(name: str, body: Any) -> Column:
    if name in ("_and", "_or"):
        if not isinstance(body, Sequence) or isinstance(body, str):
            raise ValueError(f"{name} needs a list of conditions")
        parts = [condition(part) for part in body]
        return _all_of(parts) if name == "_and" else _any_of(parts)
    if name == "_not":
        return ~condition(body)
    if not isinstance(body, Mapping):
        raise ValueError(f"{name!r} needs an object of comparisons, got {body!r}")
    return _all_of(_compare(name, operator, value) for operator, value in body.items())


def _compare(field: str, operator: str, value: Any) -> Column:
    if operator not in COMPARISONS:
        raise ValueError(f"unknown comparison {operator!r} on {field!r}")
    if value is None:
        raise ValueError(f"{operator} on {field!r} needs a value; use _is_null for NULL")
    if operator in ("_in", "_nin"):
        if isinstance(value, str):
            raise ValueError(f"{operator} on {field!r} needs a list")
        if len(value) == 0:
            return F.lit(operator == "_nin")
    return COMPARISONS[operator](F.col(quote(field)), value)


def _all_of(parts) -> Column:
    return reduce(lambda left, right: left & right, parts, F.lit(True))


def _any_of(parts) -> Column:
    return reduce(lambda left, right: left | right, parts, F.lit(False))
