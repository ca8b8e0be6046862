"""Telling rows apart: the id itself, so that equal hashes of other rows do no harm, and a hash of every column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of passing columns: the id, and a hash of the whole row.
ID, ROW = "__lineloom_id", "__lineloom_row"


def _hashable(name: str, kind: T.DataType) -> Column:
    plain = isinstance(kind, (T.AtomicType, T.NullType)) and type(kind).__name__ != "VariantType"
    return F.col(f"`{name}`") if plain else F.to_json(F.struct(F.col(f"`{name}`").alias("v")), {"ignoreNullFields": "false"})


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns."""
    return F.xxhash64(*[_hashable(f.name, f.dataType) for f in df.schema.fields])


def with_keys(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``ID`` and ``ROW``, which are never null: the id, and a hash of all columns, in which a null id differs from any other.

    Rows that are equal in all columns have equal keys.
    """
    whole = isinstance(df.schema[id_col].dataType, T.IntegralType)
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(0)) if whole else F.xxhash64(F.lit("id"), F.col(id_col))
    return df.withColumns({ROW: row_hash(df), ID: own})


def text_key(id_col: str, text_col: str, ids: str, hashes: str) -> Column:
    """Join condition: the row's id, null included, is ``ids`` and its text has the hash ``hashes``."""
    return F.col(id_col).eqNullSafe(F.col(ids)) & (F.xxhash64(F.col(text_col)) == F.col(hashes))
