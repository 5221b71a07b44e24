"""Flattening of nested records into columns."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for field in schema.fields:
        path = (*above, field.name)
        if isinstance(field.dataType, T.StructType) and field.dataType.fields:
            yield from _leaves(field.dataType, path)
        else:
            yield path, field.dataType


def _pick(path: tuple[str, ...]) -> Column:
    return F.col(".".join(f"`{part}`" for part in path))


def flatten(rows: DataFrame, separator: str = "_") -> DataFrame:
    """One column per leaf, named by its joined path; lists and maps become JSON text.

    Two paths may join to the same name (`a_b` and `a.b`): the later one in schema
    order gets the first free numeric suffix.
    """
    taken: set[str] = set()
    columns = []
    for path, kind in _leaves(rows.schema):
        name, n = separator.join(path), 2
        while name.lower() in taken:
            name, n = f"{separator.join(path)}{separator}{n}", n + 1
        taken.add(name.lower())
        value = _pick(path)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value)
        columns.append(value.alias(name))
    return rows.select(*columns)
