"""Vector functions over array columns, in double precision."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as S


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


@F.pandas_udf(S.BinaryType())
def pack(v: pd.Series) -> pd.Series:
    """Little-endian 32-bit floats."""
    return v.map(lambda x: None if x is None else struct.pack(f"<{len(x)}f", *x))


@F.pandas_udf(S.ArrayType(S.FloatType()))
def unpack(b: pd.Series) -> pd.Series:
    return b.map(lambda x: None if x is None else list(struct.unpack(f"<{len(x) // 4}f", x)))
