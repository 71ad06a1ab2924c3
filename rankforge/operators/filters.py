"""``must`` / ``should`` / ``geo`` dictionaries to DataFrame conditions.

must    field -> scalar (equal), list (any of) or range dict. Hard: a document
        that fails is gone.
should  field -> scalar or list. Soft: a match adds to the score.
geo     ``{"distance": "500km", "lat": .., "lon": ..}`` on a location struct.

On an array column a scalar matches any element, a list any common element.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions import geo as G

_BOUNDS = {
    "gte": lambda c, v: c >= v,
    "lte": lambda c, v: c <= v,
    "gt": lambda c, v: c > v,
    "lt": lambda c, v: c < v,
}


def _range(field: str, bounds: Mapping[str, Any]) -> Column:
    unknown = set(bounds) - set(_BOUNDS)
    if unknown or not {"gte", "lte"} & set(bounds):
        raise ValueError(f"range on {field!r} needs gte or lte, and only gt/lt besides: {bounds!r}")
    return reduce(Column.__and__, (_BOUNDS[op](F.col(field), v) for op, v in bounds.items()))


def _match(schema: T.StructType, field: str, value: Any) -> Column:
    """A scalar (equal) or a list (any of), on a plain or an array column."""
    if value is None:
        raise ValueError(f"no value to match for {field!r}")
    is_array = field in schema.names and isinstance(schema[field].dataType, T.ArrayType)
    c = F.col(field)
    if isinstance(value, (list, tuple)):
        if is_array:
            return F.arrays_overlap(c, F.array(*(F.lit(v) for v in value)))
        return c.isin(list(value))
    return F.array_contains(c, F.lit(value)) if is_array else c == F.lit(value)


def hard_condition(schema: T.StructType, must: Mapping[str, Any] | None = None,
                   geo: Mapping[str, Any] | None = None, location: str = "location") -> Column | None:
    """The conjunction of all hard filters; None when there are none."""
    parts = [
        _range(f, v) if isinstance(v, Mapping) else _match(schema, f, v)
        for f, v in (must or {}).items()
    ]
    if geo:
        place = F.col(location)
        parts.append(
            G.within(place["lat"], place["lon"], float(geo["lat"]), float(geo["lon"]),
                     G.parse_distance(geo["distance"]))
        )
    return reduce(Column.__and__, parts) if parts else None


def soft_score(schema: T.StructType, should: Mapping[str, Any] | None,
               weight: float = 1.0) -> Column | None:
    """Sum of ``weight`` over the soft clauses a document matches."""
    if not should:
        return None
    clauses = []
    for field, value in should.items():
        if isinstance(value, Mapping):
            raise ValueError(f"should takes scalars and lists, not ranges: {field!r}")
        hit = F.coalesce(_match(schema, field, value), F.lit(False))
        clauses.append(F.when(hit, F.lit(float(weight))).otherwise(F.lit(0.0)))
    return reduce(Column.__add__, clauses)
