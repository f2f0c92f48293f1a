"""Row hashes whose sums do not depend on row order.

``row_hash`` is the one to use inside Spark. ``portable_row_hash`` gives the same
number in any engine that has md5, at a higher cost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A sum of this type holds the hashes of 10^18 rows, even of equal ones.
_SUMMAND = T.DecimalType(28, 0)
NULL_MARK = "␀"
FIELD_MARK = "|"


def _has(dtype: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return _has(dtype.keyType, kinds) or _has(dtype.valueType, kinds)
    if isinstance(dtype, T.StructType):
        return any(_has(f.dataType, kinds) for f in dtype)
    return False


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def canonical(value: Column, dtype: T.DataType) -> Column:
    """``value`` in a form that can be hashed, grouped and compared.

    Maps become entry arrays in key order, variants their JSON text.
    """
    if isinstance(dtype, T.VariantType):
        return F.to_json(value)
    if not _has(dtype, (T.MapType, T.VariantType)):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda e: canonical(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                canonical(e["key"], dtype.keyType).alias("key"),
                canonical(e["value"], dtype.valueType).alias("value"),
            ),
        )
        return F.array_sort(entries)
    fields = [canonical(value[f.name], f.dataType).alias(f.name) for f in dtype]
    return F.when(value.isNotNull(), F.struct(*fields))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def canonical_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema}
    return [canonical(_quoted(c), types[c]).alias(c) for c in columns or df.columns]


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, seed: int | None = None) -> Column:
    """64-bit hash of a row; another one with ``seed``.

    ``xxhash64`` passes over NULLs, so which values are NULL is hashed as well.
    Inside nested values it does the same with elements and fields, so those are
    hashed by their JSON text, in which NULLs, brackets and commas all count.
    """
    types = {f.name: f.dataType for f in df.schema}
    columns = list(columns or df.columns)
    values, missing = [], []
    for name in columns:
        value = canonical(_quoted(name), types[name])
        if _nested(types[name]):
            value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        else:
            missing.append(F.isnull(value))
        values.append(value)
    first = [] if seed is None else [F.lit(seed)]
    return F.xxhash64(*first, *values, *missing)


def exact_sum(hash_value: Column) -> Column:
    """Sum that keeps repeated rows and cannot overflow."""
    return F.coalesce(F.sum(hash_value.cast(_SUMMAND)), F.lit(0).cast("decimal(38,0)"))


def portable_text(value: Column, dtype: T.DataType) -> Column:
    """Text of a value that another engine can repeat exactly.

    Floating numbers count to the sixth decimal, as whole millionths, so that no
    float formatting is involved. Strings carry their length, so that a separator
    inside one cannot shift the fields. What is no whole number of 64 bits then is spelled:
    NaN and the infinities by name, larger values by their digits, from 10^32 on as Spark
    writes them.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        wide = value.cast("double")
        millionths = F.round(wide * 1000000)
        odd = (
            F.when(F.isnan(wide), "NaN").when(wide == float("inf"), "Infinity")
            .when(wide == float("-inf"), "-Infinity")
            .otherwise(F.coalesce(millionths.try_cast("decimal(38,0)").cast("string"), wide.cast("string")))
        )
        text = F.coalesce(millionths.try_cast("bigint").cast("string"), odd)
    elif isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(dtype, T.StringType):
        text = F.concat(F.char_length(value).cast("string"), F.lit(":"), value)
    elif isinstance(dtype, T.ArrayType):
        text = F.array_join(
            F.transform(value, lambda e: portable_text(e, dtype.elementType)), ","
        )
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def portable_row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """First 60 bits of the md5 of the row's text."""
    types = {f.name: f.dataType for f in df.schema}
    text = F.concat_ws(
        FIELD_MARK, *[portable_text(_quoted(c), types[c]) for c in columns or df.columns]
    )
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


HASHES = {"xxhash64": row_hash, "md5": portable_row_hash}
