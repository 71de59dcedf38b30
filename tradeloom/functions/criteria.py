"""Filters given as documents, the way document stores take them, as one column expression.

    {"genres.0": "Horror", "year": {"$gte": 1940, "$lte": 1949}}
    {"$or": [{"address.state": "NY"}, {"address.city": {"$in": ["Boston", "Salem"]}}]}

Paths lead through structs and maps by name and through arrays by position; a name that meets an array of
documents asks whether any of them matches, and a value that meets an array whether any element does.
Comparisons hold between values of one kind only (numbers, text, truth values, dates); a missing field
fails them, and passes their negations. Comparisons with stored columns stay plain, so that they reach the
scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_COMPARISONS: dict[str, Callable[[Column, object], Column]] = {
    "$eq": lambda c, v: c == v,
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}
_NEGATIONS = {"$ne": "$eq", "$nin": "$in"}
_Test = Callable[[Column, DataType], Column]


def matches(schema: StructType, document: Mapping[str, object]) -> Column:
    """The condition that documents with `schema` match the filter `document`; an empty one matches all."""
    return _all([_clause(schema, key, value) for key, value in document.items()])


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def _not(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _clause(schema: StructType, key: str, value: object) -> Column:
    if not key.startswith("$"):
        return _field(schema, key.split("."), value)
    if key not in ("$and", "$or", "$nor"):
        raise ValueError(f"unknown operator {key}")
    if not isinstance(value, Sequence) or isinstance(value, str) or not value:
        raise ValueError(f"{key} takes a list of filters")
    parts = [matches(schema, part) for part in value]
    if key == "$and":
        return _all(parts)
    return _any(parts) if key == "$or" else _not(_any(parts))


def _is_operators(value: object) -> bool:
    if not isinstance(value, Mapping) or not any(str(k).startswith("$") for k in value):
        return False
    if not all(str(k).startswith("$") for k in value):
        raise ValueError(f"operators and fields in one document: {sorted(value)}")
    return True


def _field(schema: StructType, path: list[str], value: object) -> Column:
    """All conditions on one path. Each is looked for on its own, as paths through arrays allow."""
    if not _is_operators(value):
        value = {"$eq": value}
    return _all([_operator(schema, path, name, wanted) for name, wanted in value.items()])


def _operator(schema: StructType, path: list[str], name: str, wanted: object) -> Column:
    if name in _NEGATIONS:
        return _not(_operator(schema, path, _NEGATIONS[name], wanted))
    if name == "$not":
        return _not(_field(schema, path, wanted))
    if name == "$exists":
        found = _reach(None, schema, path, lambda c, kind: c.isNotNull(), whole=True)
        return found if wanted else _not(found)
    if name == "$size":
        return _reach(None, schema, path, lambda c, kind: F.size(c) == wanted if isinstance(kind, ArrayType) else F.lit(False), whole=True)
    if name == "$in":
        return _in(schema, path, list(wanted))
    if name not in _COMPARISONS:
        raise ValueError(f"unknown operator {name}")
    if wanted is None:
        if name != "$eq":
            return F.lit(False)
        return _not(_reach(None, schema, path, lambda c, kind: c.isNotNull(), whole=True))
    return _reach(None, schema, path, lambda c, kind: _compared(name, c, kind, wanted))


def _in(schema: StructType, path: list[str], wanted: list) -> Column:
    """One condition for all values of the kind that the field has, so that it reaches the scan as a list."""
    plain = [v for v in wanted if v is not None and not isinstance(v, (Mapping, list, tuple))]

    def test(column: Column, kind: DataType) -> Column:
        fitting = [v for v in plain if _fits(kind, v)]
        return column.isin(*fitting) if fitting else F.lit(False)

    parts = [_reach(None, schema, path, test)] if plain else []
    parts += [_operator(schema, path, "$eq", v) for v in wanted if not any(v is p for p in plain)]
    return _any(parts)


def _fits(kind: DataType, value: object) -> bool:
    """May a stored value of this type be compared with `value`?"""
    if isinstance(value, bool):
        return isinstance(kind, BooleanType)
    if isinstance(value, (int, float, Decimal)):
        return isinstance(kind, NumericType)
    if isinstance(value, str):
        return isinstance(kind, StringType)
    if isinstance(value, datetime):
        return isinstance(kind, (TimestampType, TimestampNTZType))
    return isinstance(value, date) and isinstance(kind, (DateType, TimestampType, TimestampNTZType))


def _compared(name: str, column: Column, kind: DataType, wanted: object) -> Column:
    if isinstance(wanted, Mapping):
        if name != "$eq" or not isinstance(kind, StructType):
            return F.lit(False)
        parts = [_field_of(column, kind, k, v) for k, v in wanted.items()]
        parts += [column.getField(f.name).isNull() for f in kind.fields if f.name not in wanted]
        return _all([column.isNotNull(), *parts])
    if isinstance(wanted, (list, tuple)):
        if name != "$eq" or not isinstance(kind, ArrayType):
            return F.lit(False)
        items = [
            F.get(column, F.lit(i)).isNull() if v is None else _compared("$eq", F.get(column, F.lit(i)), kind.elementType, v)
            for i, v in enumerate(wanted)
        ]
        return _all([F.size(column) == len(wanted), *items])
    return _COMPARISONS[name](column, wanted) if _fits(kind, wanted) else F.lit(False)


def _field_of(column: Column, kind: StructType, name: str, wanted: object) -> Column:
    if name not in kind.names:
        return F.lit(wanted is None)
    field = column.getField(name)
    return field.isNull() if wanted is None else _compared("$eq", field, kind[name].dataType, wanted)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _reach(column: Column | None, kind: DataType, path: Sequence[str], test: _Test, whole: bool = False) -> Column:
    """`test` on what a path leads to. With `whole` an array at its end is tested itself, else each element."""
    if not path:
        if isinstance(kind, ArrayType) and not whole:
            on_elements = F.exists(column, lambda x: F.coalesce(test(x, kind.elementType), F.lit(False)))
            return on_elements | F.coalesce(test(column, kind), F.lit(False))
        return test(column, kind)
    step, rest = path[0], path[1:]
    if isinstance(kind, StructType):
        if step not in kind.names:
            return test(F.lit(None), NullType())
        field = F.col(_quoted(step)) if column is None else column.getField(step)
        return _reach(field, kind[step].dataType, rest, test, whole)
    if isinstance(kind, ArrayType):
        if step.isdigit():
            return _reach(F.get(column, F.lit(int(step))), kind.elementType, rest, test, whole)
        return F.exists(column, lambda x: F.coalesce(_reach(x, kind.elementType, path, test, whole), F.lit(False)))
    if isinstance(kind, MapType) and isinstance(kind.keyType, StringType):
        return _reach(F.try_element_at(column, F.lit(step)), kind.valueType, rest, test, whole)
    return test(F.lit(None), NullType())
