"""Schemas declared as text.

A type is written ``name``, ``array<T>``, ``map<K,V>`` or the name of a struct
declared beside it; a trailing ``?`` marks it nullable. Both vocabularies in use
(``boolean``/``timestamp``/``date`` in schema files, ``bool``/``datetime`` in the
configuration table) are understood.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

# The type vocabulary.
SCALARS: dict[str, T.DataType] = {
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "datetime": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
}

ROOT = "MAIN"
Fields = Sequence[tuple[str, str]]


class SchemaError(ValueError):
    """A schema text that names no known type or struct."""


def _top_level_comma(text: str) -> int:
    depth = 0
    for at, char in enumerate(text):
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0:
            return at
    raise SchemaError(f"map type needs a key and a value: map<{text}>")


def parse_type(text: str, structs: Mapping[str, Fields] | None = None,
               _open: tuple[str, ...] = ()) -> T.DataType:
    """Turn a type text into a Spark type, resolving struct names in ``structs``."""
    name = text.strip().removesuffix("?").strip()
    scalar = SCALARS.get(name.lower())
    if scalar is not None:
        return scalar
    head, bracket, rest = name.partition("<")
    if bracket and name.endswith(">"):
        inner = rest[:-1]
        if head.lower() == "array":
            return T.ArrayType(parse_type(inner, structs, _open))
        if head.lower() == "map":
            comma = _top_level_comma(inner)
            return T.MapType(parse_type(inner[:comma], structs, _open),
                             parse_type(inner[comma + 1:], structs, _open))
    if structs and name in structs:
        if name in _open:
            raise SchemaError(f"struct {name!r} contains itself")
        return struct_of(structs[name], structs, _open + (name,))
    raise SchemaError(f"unknown type {text!r}")


def struct_of(fields: Fields, structs: Mapping[str, Fields] | None = None,
              _open: tuple[str, ...] = ()) -> T.StructType:
    """Build a struct from ``(name, type text)`` pairs."""
    return T.StructType([
        T.StructField(name, parse_type(kind, structs, _open), kind.strip().endswith("?"))
        for name, kind in fields])


def fields_of(text: str) -> list[tuple[str, str]]:
    """Split ``"id string, num int?"`` into pairs; commas inside ``<>`` do not count."""
    pairs, depth, piece = [], 0, ""
    for char in text + ",":
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0:
            name, _, kind = piece.strip().partition(" ")
            if not name or not kind.strip():
                raise SchemaError(f"expected 'name type' in {text!r}")
            pairs.append((name, kind.strip()))
            piece = ""
        else:
            piece += char
    return pairs


def _pairs(columns: Sequence[Mapping[str, str]]) -> list[tuple[str, str]]:
    return [(c["name"], c["type"]) for c in columns]


@dataclass(frozen=True)
class SchemaFile:
    """A declared message: its topic and the structs it is made of."""

    topic: str
    structs: Mapping[str, Fields]

    def schema(self, name: str = ROOT) -> T.StructType:
        if name not in self.structs:
            raise SchemaError(f"no struct named {name!r}")
        return struct_of(self.structs[name], self.structs, (name,))


def schema_from_json(text: str) -> SchemaFile:
    """Read ``{"topic", "schema": [{"name", "columns": [{"name", "type"}]}]}``."""
    doc = json.loads(text)
    declared = SchemaFile(doc["topic"], {s["name"]: _pairs(s["columns"]) for s in doc["schema"]})
    declared.schema()  # fail early on unknown names
    return declared


def load_schema_file(path: str) -> SchemaFile:
    with open(path, encoding="utf-8") as handle:
        return schema_from_json(handle.read())


@dataclass(frozen=True)
class DimensionMeta:
    """One configuration row: how a source table becomes a dimension table."""

    source_table: str
    sink_table: str
    row_key: str
    schema: T.StructType
    partition_by: str | None
    column_family: str | None
    keyed_store: bool


def dimension_meta(row: Mapping) -> DimensionMeta:
    """Decode a configuration row; its schema column is a JSON list of name/type."""
    columns = _pairs(json.loads(row["schema"]))
    meta = DimensionMeta(row["source_table"], row["sink_table"], row["row_key"], struct_of(columns),
                         row["partitionBy"] or None, row["column_family"],
                         int(row["to_hbase"]) != 0)
    if meta.row_key not in meta.schema.fieldNames():
        raise SchemaError(f"{meta.source_table}: row key {meta.row_key!r} is not a declared column")
    return meta
