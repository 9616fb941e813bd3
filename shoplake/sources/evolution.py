"""Columns that turn up in the landing zone and become columns of Silver.

The lake keeps a register of the columns beside the 14 known ones, with their types,
in ``ops/schema/columns.json``. Types only widen: a whole number and a fraction make
a double, anything else that differs makes text, and a nested value is kept as its
JSON text. Silver's files hold such columns as text, so a widened type needs no
rewrite: the reader casts to the type the register has now, and files from before a
column read as null.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BRONZE, CORRUPT_COL, PARTITION_COLS, SILVER, TX_FIELDS
from ..session import read_text, write_text

KNOWN = {c.lower() for c in [*TX_FIELDS, *PARTITION_COLS, CORRUPT_COL]}
SIMPLE = ("boolean", "bigint", "double", "string")


def widened(a: str, b: str) -> str:
    """The type that holds the values of both."""
    a, b = (t if t in SIMPLE else "string" for t in (a, b))
    if a == b:
        return a
    return "double" if {a, b} == {"bigint", "double"} else "string"


def merged(held: dict[str, str], found: dict[str, str]) -> dict[str, str]:
    """The register with the columns of a discovery: old ones keep their place, names compare without case."""
    out, names = dict(held), {c.lower(): c for c in held}
    for column, kind in found.items():
        if column.lower() in KNOWN:
            continue
        own = names.setdefault(column.lower(), column)
        out[own] = widened(out[own], kind) if own in out else widened(kind, kind)
    return out


def register_path(lake_root: str) -> str:
    return f"{lake_root}/ops/schema/columns.json"


def registered(spark: SparkSession, lake_root: str) -> dict[str, str]:
    """column -> type of the columns beside the 14."""
    held = read_text(spark, register_path(lake_root))
    return json.loads(held) if held else {}


def learn(spark: SparkSession, lake_root: str, discovered: DataFrame) -> dict[str, str]:
    """Enter the columns of ``discover_schema`` (a row a column) in the register; the register."""
    held = registered(spark, lake_root)
    now = merged(held, {r.column_name: r.data_type for r in discovered.select("column_name", "data_type").collect()})
    if now != held:
        write_text(spark, register_path(lake_root), json.dumps(now), replace=True)
    return now


def bronze_schema(columns: dict[str, str]) -> StructType:
    """The landing rows' schema, all text, with the registered columns and the corrupt line."""
    schema = StructType(list(BRONZE.fields))
    for c in columns:
        schema = schema.add(c, "string")
    return schema.add(CORRUPT_COL, "string")


def silver_schema(columns: dict[str, str]) -> StructType:
    """Silver's files: the 14 typed columns, the others as text, the partitions."""
    schema = StructType(SILVER.fields[:len(TX_FIELDS)])
    for c in columns:
        schema = schema.add(c, "string")
    return StructType([*schema.fields, *SILVER.fields[len(TX_FIELDS):]])


def typed_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The registered columns in their types; text that doesn't parse is null."""
    return df.withColumns({c: F.col(f"`{c}`").try_cast(kind) for c, kind in columns.items() if kind != "string"}) if columns else df


__all__ = ["widened", "merged", "registered", "learn", "bronze_schema", "silver_schema", "typed_columns"]
