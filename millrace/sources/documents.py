"""Document reads with a filter, a projection, an order and a limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Comparisons a filter may use.
COMPARISONS = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(*v),
}
Criteria = Mapping[str, Mapping[str, object]]


def join_criteria(filter: Criteria, cursor: Criteria) -> dict[str, dict[str, object]]:
    """User filter and cursor filter together. Both naming one comparison on a field is an error."""
    whole = {field: dict(tests) for field, tests in filter.items()}
    for field, tests in cursor.items():
        for comparison, value in tests.items():
            if comparison in whole.get(field, {}):
                raise ValueError(f"filter and cursor both set {comparison!r} on {field!r}")
            whole.setdefault(field, {})[comparison] = value
    return whole


def condition(criteria: Criteria) -> Column | None:
    out = None
    for field, tests in criteria.items():
        for comparison, value in tests.items():
            test = COMPARISONS[comparison](F.col(field), value)
            out = test if out is None else out & test
    return out


def find_documents(
    df: DataFrame,
    filter: Criteria | None = None,
    cursor: Criteria | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    sort: Sequence[tuple[str, str]] = (),
    limit: int | None = None,
    primary_key: str = "_id",
) -> DataFrame:
    """The key is part of every projection, also where it is excluded."""
    if include and exclude:
        raise ValueError("a projection either includes or excludes fields")
    test = condition(join_criteria(filter or {}, cursor or {}))
    out = df.filter(test) if test is not None else df
    if sort:
        out = out.orderBy(*[F.col(f).desc() if way == "desc" else F.col(f).asc() for f, way in sort])
    if limit is not None:
        out = out.limit(limit)
    if include:
        return out.select(*dict.fromkeys([primary_key, *include]))
    return out.drop(*[f for f in exclude if f != primary_key])
