"""Key predicates shared by the reconciling operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EXACT = (*_INTEGRAL, T.DecimalType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def truthy_key(df: DataFrame, name: str, zero_is_missing: bool = True) -> Column:
    """True where the key counts as present.

    Parity with the record-based semantics: null, the empty string, false,
    and (unless ``zero_is_missing`` is off) numeric zero do not count as a key.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    cond = c.isNotNull()
    if isinstance(dtype, T.StringType):
        cond = cond & (c != F.lit(""))
    elif isinstance(dtype, T.BooleanType):
        cond = cond & c
    elif isinstance(dtype, _NUMERIC) and zero_is_missing:
        cond = cond & (c != F.lit(0))
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        cond = cond & (F.size(c) > 0)
    return cond


def common_key_type(left: DataFrame, lname: str, right: DataFrame, rname: str) -> T.DataType:
    """The single key type both sides are cast to before comparing."""
    lt, rt = left.schema[lname].dataType, right.schema[rname].dataType
    if lt == rt:
        return lt
    if isinstance(lt, _NUMERIC) and isinstance(rt, _NUMERIC):
        # Integral keys widen to bigint, exact ones to a decimal that holds both.
        if isinstance(lt, _INTEGRAL) and isinstance(rt, _INTEGRAL):
            return T.LongType()
        if isinstance(lt, _EXACT) and isinstance(rt, _EXACT):
            (lw, ls), (rw, rs) = _digits(lt), _digits(rt)
            scale = max(ls, rs)
            return T.DecimalType(min(38, max(lw, rw) + scale), scale)
        return T.DoubleType()
    return T.StringType()


def _digits(dtype: T.DataType) -> tuple[int, int]:
    """(digits before the point, digits after it) of an exact number type."""
    return (dtype.precision - dtype.scale, dtype.scale) if isinstance(dtype, T.DecimalType) else (19, 0)


def comparable_key(df: DataFrame, name: str, other: DataFrame, other_name: str,
                   zero_is_missing: bool = True) -> Column:
    """The key of ``df`` as it compares with that of ``other``.

    A number or boolean never equals a string: then both sides become JSON
    text (``1`` and ``"1"``), with null for a key that does not count.
    """
    mine, theirs = df.schema[name].dataType, other.schema[other_name].dataType
    if isinstance(mine, T.StringType) == isinstance(theirs, T.StringType):
        return F.col(name).cast(common_key_type(df, name, other, other_name))
    text = F.col(name).cast("string")
    if isinstance(mine, T.StringType):
        text = F.concat(F.lit('"'), text, F.lit('"'))
    return F.when(truthy_key(df, name, zero_is_missing), text)
