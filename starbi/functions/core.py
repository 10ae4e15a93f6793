"""Scalar column functions used by the ETL and the queries.

Every helper returns a built-in Spark expression; none of them ships data to
Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType

# Money is carried as an exact decimal so that sums do not depend on the
# order in which partitions are combined; results are cast to DOUBLE only at
# the outer projection.
MONEY = DecimalType(18, 2)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's output
# ---------------------------------------------------------------------------
# Short Portuguese month names, January .. December.
MONTH_NAMES_PT = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
                  "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
# Raw timestamp text format of the order table.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The code points that Python's str.strip removes, as a Java
# regex class.
_SPACE = (r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_EDGE_WS = rf"\A{_SPACE}+|{_SPACE}+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    A word starts after any non-letter, so ``d'oeste`` -> ``D'Oeste`` and
    ``mogi-guacu`` -> ``Mogi-Guacu`` (``initcap`` only breaks on spaces).
    The text is split *after* each non-letter; each piece then begins with a
    character whose predecessor is not a letter.
    """
    pieces = F.split(F.lower(_c(c)), r"(?<=\P{L})")
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                               F.substring(w, 2, 1 << 30))),
        "")


def strip_ws(c) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only removes spaces)."""
    return F.regexp_replace(_c(c), _EDGE_WS, "")


def parse_ts(c, dtype=None, fmt: str = TS_FORMAT) -> Column:
    """Timestamp without time zone from raw text; bad or other-format text
    becomes null.  Columns that are already timestamps are only normalised
    to TIMESTAMP_NTZ."""
    col = _c(c)
    if dtype is not None and not isinstance(dtype, StringType):
        return col.cast("timestamp_ntz")
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def floor_days(start, end) -> Column:
    """Whole days from ``start`` to ``end``, rounded toward -infinity
    (``-1 hour`` is ``-1`` day, ``+23 hours`` is ``0``), to the microsecond.

    Wall-clock (TIMESTAMP_NTZ) values: calendar days, less one if the end's
    time of day comes before the start's.  No session time zone is involved
    (``timestamp_diff`` would first convert both sides to instants and gain or
    lose an hour across a DST change)."""
    a, b = _c(start), _c(end)

    def time_of_day(t):
        second = F.date_part(F.lit("SECOND"), t)  # with its fraction
        return (F.hour(t) * 3600 + F.minute(t) * 60).cast("decimal(18,6)") + second
    days = F.datediff(F.to_date(b), F.to_date(a))
    return (days - (time_of_day(b) < time_of_day(a)).cast("int")).cast("int")


def date_key(d) -> Column:
    """``yyyyMMdd`` integer key of a date (integer arithmetic, no string
    formatting)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_name_pt(month) -> Column:
    pairs = []
    for i, name in enumerate(MONTH_NAMES_PT, start=1):
        pairs += [F.lit(i), F.lit(name)]
    return F.element_at(F.create_map(*pairs), _c(month).cast("int"))


def money(c) -> Column:
    return _c(c).cast(MONEY)


def cents(c) -> Column:
    """Exact integer number of cents of a money amount (DECIMAL(38,0))."""
    return (_c(c) * F.lit(100)).cast(DecimalType(38, 0))


def hround(num, den, scale: int) -> Column:
    """``ROUND(num / den, scale)`` computed exactly, half away from zero.

    ``num`` and ``den`` must be exact integers (integral or DECIMAL(p,0)
    columns).  The quotient is rounded with integer arithmetic, so the
    result is the same on every engine and independent of partitioning;
    only the final ``q / 10^scale`` is a floating division.  A zero or
    null denominator gives null, like SQL division by NULLIF(den, 0).
    """
    n = _c(num).cast(DecimalType(38, 0))
    d = F.when(_c(den) != 0, _c(den)).cast(DecimalType(38, 0))
    p = 10 ** scale
    size = F.abs(d)
    q = int_div(F.abs(n) * F.lit(2 * p) + size, size * F.lit(2))
    # sizes are rounded, the sign is that of the quotient
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return signed.cast("double") / F.lit(float(p))


def int_div(a: Column, b: Column) -> Column:
    """Exact floor division of a non-negative integer by a positive one.

    ``a - pmod(a, b)`` is an exact multiple of ``b``, so the decimal
    quotient has no fractional part and the cast is exact."""
    a = a.cast(DecimalType(38, 0))
    b = b.cast(DecimalType(38, 0))
    return ((a - F.pmod(a, b)) / b).cast(DecimalType(38, 0))


def ratio(num, den) -> Column:
    """Unrounded ``num / den`` as DOUBLE, null when ``den`` is 0.

    Both sides are first converted to DOUBLE (correctly rounded from exact
    decimals), so the IEEE quotient is reproducible on any engine."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
