"""Numeric parsing with Python's acceptance rules, and the helpfulness ratio.

Spark's casts accept text Python rejects (``5d``, ``0x1p3``) and reject text
Python accepts (``1_0``), so each cast is guarded by a regex of Python's
grammar and fed a normalised string.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import PY_WS, col_of

_D = r"[0-9](?:_?[0-9])*"
# float(): [sign] (digits[.digits] | digits. | .digits)[exponent] | inf | infinity | nan
PY_FLOAT_RE = (rf"^{PY_WS}*[+-]?(?:(?:{_D}(?:\.(?:{_D})?)?|\.{_D})(?:[eE][+-]?{_D})?"
               rf"|(?i:inf|infinity|nan)){PY_WS}*$")
# int(): [sign] digits, underscores only between digits
PY_INT_RE = rf"^{PY_WS}*[+-]?{_D}{PY_WS}*$"
# Plain digits, which a cast reads as Python does: no need of the grammar.
PLAIN_INT, PLAIN_FLOAT = r"^[0-9]{1,18}\z", r"^[0-9]{1,15}(?:\.[0-9]{1,15})?\z"


def _normalise(c: Column) -> Column:
    return F.regexp_replace(c, f"{PY_WS}|_", "")


def py_float(c: str | Column) -> Column:
    """``float(x)`` or null where Python raises."""
    c = col_of(c)
    return F.when(c.rlike(PLAIN_FLOAT), c.try_cast("double")).when(c.rlike(PY_FLOAT_RE), _normalise(c).try_cast("double"))


def py_int(c: str | Column) -> Column:
    """``int(x)`` for base-10 text, or null where Python raises (or beyond 64 bits)."""
    c = col_of(c)
    return F.when(c.rlike(PLAIN_INT), c.try_cast("bigint")).when(c.rlike(PY_INT_RE), _normalise(c).try_cast("bigint"))


# Seconds for 0001-01-01 and 9999-12-31 23:59:59 (datetime's range).
_MIN_EPOCH, _MAX_EPOCH = -62135596800, 253402300799


def epoch_to_timestamp(c: str | Column) -> Column:
    """P10: epoch-second text → ``timestamp_ntz`` (UTC wall clock), null if invalid."""
    return seconds_to_timestamp(py_int(c))


def seconds_to_timestamp(secs: Column) -> Column:
    """Whole epoch seconds → ``timestamp_ntz``; ``secs`` is read several times and should be a column."""
    ok = secs.between(_MIN_EPOCH, _MAX_EPOCH)
    return F.when(ok, F.expr("timestampadd(SECOND, 0, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
                  + F.make_dt_interval(secs=secs.cast("decimal(18,6)")))


def _is_integral(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (x == F.floor(x)) & (F.abs(x) < F.lit(1e15))


def ratio_half_up(a: Column, b: Column) -> Column:
    """round(a / b, 2), ties away from zero, exact for whole vote counts."""
    num = F.lit(200) * a.cast("bigint") + b.cast("bigint")
    two_b = F.lit(2) * b.cast("bigint")
    exact = (num - F.pmod(num, two_b)) / two_b
    whole = _is_integral(a) & _is_integral(b) & (a >= 0) & (b > 0)
    return F.when(whole, exact.cast("double") / F.lit(100.0)).otherwise(F.round(a / b, 2))


@F.pandas_udf(T.DoubleType())
def _python_round2(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if (x is None or y is None or pd.isna(x) or pd.isna(y))
                      else float(round(float(x) / float(y), 2)) for x, y in zip(a, b)],
                     dtype="float64")


def ratio_round(a: str | Column, b: str | Column, mode: str = "half_up") -> Column:
    """Null when ``b == 0``, else ``a / b`` rounded to 2 places.

    ``half_up`` (default) rounds exact ties away from zero.  ``python``
    reproduces Python's ``round(a / b, 2)`` on the binary double: it differs
    only on exact ties (``200a/b`` an odd whole number); just those rows are
    sent to an Arrow UDF, every other row passes nulls.
    """
    a, b = col_of(a).cast("double"), col_of(b).cast("double")
    base = ratio_half_up(a, b)
    if mode == "python":
        whole = _is_integral(a) & _is_integral(b) & (b != 0)
        num = F.lit(200) * a.cast("bigint")
        den = F.abs(b.cast("bigint"))
        tie = whole & (F.pmod(num, den) == 0) & (F.pmod(F.abs(num) / den, F.lit(2)) == 1)
        base = F.coalesce(_python_round2(F.when(tie, a), F.when(tie, b)), base)
    elif mode != "half_up":
        raise ValueError(f"unknown rounding mode {mode!r}")
    return F.when(b == 0, F.lit(None).cast("double")).otherwise(base)


def or_default(value: Column, default) -> Column:
    """The notebook's variant, a failed cast becomes a default instead of a reject."""
    return F.coalesce(value, F.lit(default))
