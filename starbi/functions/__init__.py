"""Column -> Column helpers.  All native Spark expressions (no Python UDF),
so they stay inside whole-stage codegen."""

from starbi.functions.core import (  # noqa: F401
    MONEY,
    cents,
    date_key,
    floor_days,
    hround,
    money,
    month_name_pt,
    parse_ts,
    ratio,
    strip_ws,
    title_case,
)
