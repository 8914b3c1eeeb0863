"""Column -> Column helpers for the stringified Bronze layer.

All helpers are built-in Spark expressions (no Python UDF), so they stay
inside whole-stage codegen: text that is no number becomes NULL (``try_cast``),
list access is ``get`` (NULL past the end), and the text forms of a missing
value (``nan``, ``None``, empty) become NULL before any cast. A number that
does not fit its integer type is an error, as in a plain CAST: an id is never
silently lost.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.config import MISSING_TEXT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_missing(c) -> Column:
    """Text forms of a missing value -> NULL (other values untouched, as text)."""
    s = _col(c).cast("string")
    return F.when(F.trim(s).isin(*MISSING_TEXT), F.lit(None).cast("string")).otherwise(s)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def strip_brackets(c) -> Column:
    """'[61.0, 40.1]' -> '61.0, 40.1'. (``replace`` searches bytes; ``translate`` looks up every character.)"""
    return F.replace(F.replace(_col(c), F.lit("["), F.lit("")), F.lit("]"), F.lit(""))


def split_list(c) -> Column:
    return F.split(strip_brackets(c), ",")


def list_index(c, i: int) -> Column:
    """1-based element of a stringified list; NULL past the end (never an error)."""
    return F.get(split_list(null_if_missing(c)), i - 1)


def to_float(c) -> Column:
    """Text or number -> FLOAT; leading blanks allowed; NaN and junk -> NULL."""
    return nan_to_null(F.trim(null_if_missing(c)).try_cast("float"))


def to_double(c) -> Column:
    return nan_to_null(F.trim(null_if_missing(c)).try_cast("double"))


def to_int(c) -> Column:
    """Numeric text ('5503.0') -> INT, rounding half to even."""
    return F.bround(to_double(c), 0).cast("int")


def num_to_int(c) -> Column:
    """Numeric column -> INT, rounding half to even; NaN -> NULL."""
    return F.bround(nan_to_null(_col(c).cast("double")), 0).cast("int")


def int_of(df, name: str) -> Column:
    """INT cast of ``df[name]`` whatever its stored type (number or text)."""
    dtype = df.schema[name].dataType.typeName()
    if dtype in ("byte", "short", "integer", "long"):
        return F.col(name).cast("int")
    if dtype in ("string",):
        return to_int(name)
    return num_to_int(name)


def long_of(df, name: str) -> Column:
    """LONG cast of ``df[name]`` whatever its stored type; integers are cast as they are."""
    dtype = df.schema[name].dataType.typeName()
    if dtype == "string":
        s = F.trim(null_if_missing(name))
        return F.coalesce(s.try_cast("bigint"), F.bround(to_double(name), 0).cast("bigint"))
    if dtype in ("float", "double"):
        return F.bround(nan_to_null(F.col(name)), 0).cast("bigint")
    return F.col(name).cast("bigint")


def float_of(df, name: str) -> Column:
    dtype = df.schema[name].dataType.typeName()
    if dtype == "string":
        return to_float(name)
    return nan_to_null(F.col(name).cast("float"))


def coord(c, i: int) -> Column:
    """i-th coordinate of a stringified ``[x, y]`` location as FLOAT.

    Equal to ``to_float`` of the element, but names it once, so it is parsed once: the cast itself
    trims, and the text forms of a missing value become NULL or NaN in it."""
    return F.nanvl(list_index(c, i).try_cast("float"), F.lit(None).cast("float"))


def to_bool_default_false(c) -> Column:
    """Boolean text ('True'), missing forms -> false."""
    return F.coalesce(null_if_missing(c).try_cast("boolean"), F.lit(False))


def coerce_numeric_zero(c) -> Column:
    """Numeric coercion of score/id text: unparsable or missing -> 0, truncating."""
    return F.coalesce(to_double(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def coerce_of(df, name: str) -> Column:
    """``coerce_numeric_zero`` for ``df[name]`` whatever its stored type; numbers are
    not sent through text (exact for any LONG)."""
    dtype = df.schema[name].dataType.typeName()
    if dtype == "string":
        return coerce_numeric_zero(name)
    if dtype in ("float", "double"):
        return F.coalesce(nan_to_null(F.col(name)).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(F.col(name).try_cast("bigint"), F.lit(0).cast("bigint"))
