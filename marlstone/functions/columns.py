"""MySQL-compatible functions as Columns, for use without SQL text. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(x: Column) -> Column:
    """x without NaN, which becomes null."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def divide(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def modulo(a: Column, b: Column) -> Column:
    return a % F.nullif(b, F.lit(0))


def greatest(*xs: Column) -> Column:
    """Null if any argument is."""
    return F.when(_all_known(xs), F.greatest(*xs))


def least(*xs: Column) -> Column:
    return F.when(_all_known(xs), F.least(*xs))


def _all_known(xs: tuple[Column, ...]) -> Column:
    out = xs[0].isNotNull()
    for x in xs[1:]:
        out = out & x.isNotNull()
    return out


def elt(n: Column, *xs: Column) -> Column:
    out = F.when(n == 1, xs[0])
    for i, x in enumerate(xs[1:], 2):
        out = out.when(n == i, x)
    return out


def insert(s: Column, pos: Column, n: Column, new: Column) -> Column:
    rest = F.when((n < 0) | (pos + n > F.char_length(s)), F.lit("")).otherwise(s.substr(pos + n, F.char_length(s)))
    return F.when((pos < 1) | (pos > F.char_length(s)), s).otherwise(F.concat(s.substr(F.lit(1), pos - 1), new, rest))


def truth(x: Column) -> Column:
    """A number as a condition."""
    return x.cast("boolean")


def xor(a: Column, b: Column) -> Column:
    return truth(a) != truth(b)


def to_number(s: Column) -> Column:
    """The number that a string begins with, 0 if none."""
    found = F.regexp_extract(s, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1)
    return F.when(s.isNotNull(), F.coalesce(found.try_cast("double"), F.lit(0.0)))


def truncate(x: Column, digits: int) -> Column:
    scale = F.lit(10.0**digits)
    return F.when(x >= 0, F.floor(x * scale)).otherwise(F.ceil(x * scale)) / scale


def unsigned(x: Column) -> Column:
    """x as an unsigned 64-bit number; an error outside its range."""
    wide = x.cast("decimal(20, 0)")
    return F.when(wide.between(0, F.lit("18446744073709551615").cast("decimal(20, 0)")), wide).when(wide.isNotNull(), F.raise_error(F.lit("BIGINT UNSIGNED value is out of range")).cast("decimal(20, 0)"))
