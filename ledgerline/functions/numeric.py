"""Exact rounding and result typing.

``ROUND(a / b, s)`` on NUMERIC rounds half away from zero on the exact quotient. Spark's decimal
division first rounds the quotient to a fixed scale, and doubles round differently again, so a
rounded ratio is computed here with integer arithmetic only: the same integers in every engine.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = T.DecimalType(38, 0)


#: Whole digits that a numerator has on the fast path of ``round_ratio``; digits of a quotient there, without the numerator's whole ones.
_WHOLE_DIGITS, _QUOTIENT_DIGITS = 16, 21


def round_ratio(num: Column, den: Column, scale: int = 2, digits: int = 0) -> Column:
    """``ROUND(num / den, scale)``, exact, as DECIMAL(38, scale).

    Half away from zero; NULL when ``den`` is 0 or either side is NULL (no division error). Both sides may
    have up to ``digits`` decimals; more are refused, never rounded away.

    A numerator of up to 16 whole digits over a whole denominator of up to ``p`` digits is one decimal division and one ``round``: the
    quotient has ``scale + digits + p + 1`` decimals, and an exact quotient that is no tie is farther from any tie than its
    last digit, so rounding twice can't move it across one. Other operands go through whole numbers.
    """
    p = min(18, _QUOTIENT_DIGITS - digits - scale)
    if p < 1:
        return _round_whole(num, den, scale, digits)
    a = num.try_cast(T.DecimalType(_WHOLE_DIGITS + digits + scale, digits + scale))
    b = den.try_cast(T.DecimalType(p, 0))
    # by remainder: an equality of two wide decimals compares them at a common type, which may have fewer decimals
    fits = a.isNotNull() & b.isNotNull() & (num % F.lit(Decimal(1).scaleb(-digits)) == 0) & (den % F.lit(1) == 0)
    fast = F.round(F.try_divide(a, b), scale).cast(T.DecimalType(38, scale))
    return F.when(fits, fast).when(num.isNotNull() & den.isNotNull(), _round_whole(num, den, scale, digits))


def _round_whole(num: Column, den: Column, scale: int, digits: int) -> Column:
    """The same by whole numbers of up to 38 digits; each operand is computed once."""
    def whole(c: Column) -> Column:
        scaled = c * F.lit(Decimal(10 ** digits)) if digits else c
        return F.struct((scaled % F.lit(1)).alias("rest"), scaled.cast(WHOLE).alias("whole"))

    def divided(x: Column) -> Column:
        n, d = x["n"]["whole"], x["d"]["whole"]
        top = F.abs(n) * F.lit(2 * 10 ** scale) + F.abs(d)
        bottom = F.abs(d) * F.lit(2)
        units = ((top - top % bottom) / bottom).cast(WHOLE)
        signed = F.when((n < 0) != (d < 0), -units).otherwise(units) * F.lit(Decimal(1).scaleb(-scale))
        exact = (x["n"]["rest"] == 0) & (x["d"]["rest"] == 0)
        refused = F.raise_error(F.lit(f"round_ratio: more than {digits} decimals")).cast(T.DecimalType(38, scale))
        return F.when(~exact, refused).when(d != 0, signed.cast(T.DecimalType(38, scale)))

    return F.transform(F.array(F.struct(whole(num).alias("n"), whole(den).alias("d"))), divided)[0]


def as_reported(df: DataFrame) -> DataFrame:
    """Final result typing shared with the SQL oracle.

    Whole decimals and small integers become BIGINT, fractional decimals become DOUBLE (the exact
    value converted once, at the very end), and DATE becomes midnight TIMESTAMP_NTZ (a date and a
    timestamp travel differently through pandas; a timestamp arrives the same way from both engines).
    Everything else is left alone; the operators themselves keep their exact types.
    """
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        dt = field.dataType
        if isinstance(dt, T.DecimalType):
            c = c.cast(T.LongType() if dt.scale == 0 else T.DoubleType())
        elif isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast(T.LongType())
        elif isinstance(dt, T.DateType):
            c = c.cast(T.TimestampNTZType())
        cols.append(c.alias(field.name))
    return df.select(*cols)
