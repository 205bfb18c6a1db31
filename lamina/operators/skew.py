"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot when it holds more than 1/HOT_SHARE of the rows and at least HOT_ROWS of
# them, so there are at most HOT_SHARE hot keys. The sketch tracks enough items to find
# every one of them.
HOT_SHARE = 256
HOT_ROWS = 100_000
TRACKED = 10_000
SALTS = 64


def _key_hash(schema: T.StructType, keys: Sequence[str], names: Sequence[str]) -> Column:
    """Hash of the columns ``names`` in the types of ``keys``: equal keys hash alike."""
    parts = []
    for key, name in zip(keys, names):
        dtype = schema[key].dataType
        value = F.col(f"`{name}`").try_cast(dtype)
        # a floating zero may be signed
        parts.append(value + F.lit(0.0) if isinstance(dtype, T.FractionalType) else value)
    return F.xxhash64(*parts)


def hot_hashes(df: DataFrame, keys: Sequence[str], hot_rows: int | None = None) -> list[int]:
    """Hashes of the hot keys; one pass over the key columns, one sketch per task.

    The sketch only decides how rows are spread. It is evaluated once, here, so that
    both sides of a join use the same list.
    """
    hashed = df.select(_key_hash(df.schema, keys, keys).alias("h"))
    found = hashed.agg(
        F.count(F.lit(1)).alias("total"),
        F.expr(f"approx_top_k(h, {HOT_SHARE}, {TRACKED})").alias("top"),
    ).first()
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, found["total"] // HOT_SHARE)
    return [item["item"] for item in found["top"] or [] if item["count"] > limit]


def _holds_map(dtype: T.DataType) -> bool:
    """Maps cannot be hashed, at any depth."""
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    hot: list[int] | None = None,
) -> DataFrame:
    """Join a possibly skewed ``left`` to ``right``, which holds about one row per key.

    Without hot keys this is a plain join. Rows of a hot key get a salt from a hash of
    the whole row, and the right rows of that key are repeated once per salt, so the key
    is spread over SALTS tasks. The result is that of ``left.join(right, keys, how)``,
    with null keys equal to each other if ``null_safe``. ``hot`` takes a list from
    ``hot_hashes`` of the same keys that is already at hand.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would keep unmatched copies of right rows")
    keys = list(keys)
    right_names = [f"__right_{k}" for k in keys]
    other = right.withColumnsRenamed(dict(zip(keys, right_names)))
    pairs = [
        F.col(k).eqNullSafe(F.col(r)) if null_safe else F.col(k) == F.col(r)
        for k, r in zip(keys, right_names)
    ]
    match = reduce(lambda a, b: a & b, pairs)
    hot = hot_hashes(left, keys) if hot is None else hot
    if not hot:
        return left.join(other, match, how).drop(*right_names)
    hashed = [F.col(f"`{f.name}`") for f in left.schema.fields if not _holds_map(f.dataType)]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int")
    spread = left.withColumn(
        "__salt", F.when(_key_hash(left.schema, keys, keys).isin(hot), salt).otherwise(F.lit(0))
    )
    salts = F.when(
        _key_hash(left.schema, keys, right_names).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    copies = other.withColumn("__right_salt", F.explode(salts))
    match = match & (F.col("__salt") == F.col("__right_salt"))
    return spread.join(copies, match, how).drop("__salt", "__right_salt", *right_names)
