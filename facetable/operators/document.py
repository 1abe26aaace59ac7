"""Document query: named fields of the rows that match an object."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetable.functions.conditions import condition, ordering
from facetable.functions.names import quote


def document_query(
    frame: DataFrame,
    select: Sequence[str],
    where: Mapping[str, Any] | None = None,
    limit: int | None = None,
    order_by: Mapping[str, str] | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Fields ``select``, in that order, of rows that meet ``where``.

    ``limit`` keeps at most so many rows, any of them unless ``order_by`` says
    which.  ``order_by`` with ``limit`` is a top-k: each task keeps its own best
    rows and only those are merged.  The rows of a limit, and those an offset passes
    over, are gathered in one task, so both are for pages of a result.  An offset
    needs a limit: alone it would gather the whole table there.  ``order_by`` and
    ``offset`` are extensions.
    """
    if offset is not None and limit is None:
        raise ValueError("an offset needs a limit")
    if isinstance(select, str) or not select:
        raise ValueError("select needs a list of at least one field")
    if where:
        frame = frame.where(condition(where))
    if order_by:
        frame = frame.orderBy(*ordering(order_by))
    if offset is not None:
        frame = frame.offset(offset)
    if limit is not None:
        frame = frame.limit(limit)
    return frame.select(*[F.col(quote(field)) for field in select])
