"""Scalar functions: the traps of SURVEY §2.9 / §5.1 (FIXTURES §3)."""
import datetime as dt
import decimal
import random

from pyspark.sql import functions as F

from starbi.functions import (date_key, floor_days, hround, month_name_pt, parse_ts,
                              strip_ws, title_case)


def test_title_case_and_strip(spark):
    rows = [("santa bárbara d'oeste",), ("mogi-guacu",), ("  SÃO paulo\t",), ("a1b c",),
            ("são joão del-rei",), (None,), ("",)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(strip_ws(title_case("c"))).collect()]
    assert got == ["Santa Bárbara D'Oeste", "Mogi-Guacu", "São Paulo", "A1B C",
                   "São João Del-Rei", None, ""]
    # same as Python's str.title().strip() on every non-null probe
    for (src,), out in zip(rows, got):
        if src is not None:
            assert out == src.title().strip()


def test_floor_days_lead_times(spark):
    est = dt.datetime(2018, 1, 10, 12, 0, 0)
    deltas = [dt.timedelta(days=-5), dt.timedelta(hours=-1), dt.timedelta(0),
              dt.timedelta(hours=23), dt.timedelta(hours=24), dt.timedelta(days=5, hours=23),
              dt.timedelta(days=6)]
    df = spark.createDataFrame([(est, est + d) for d in deltas] + [(est, None)],
                               "e timestamp_ntz, d timestamp_ntz")
    got = [r[0] for r in df.select(floor_days("e", "d")).collect()]
    assert got == [-5, -1, 0, 0, 1, 5, 6, None]
    # pandas' .dt.days is floor division of the timedelta
    assert got[:-1] == [(d // dt.timedelta(days=1)) for d in deltas]


def test_floor_days_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        a = dt.datetime(2018, 3, 10, 12, 0)   # DST starts 2018-03-11 in New York
        df = spark.createDataFrame([(a, a + dt.timedelta(days=1))], "a timestamp_ntz, b timestamp_ntz")
        assert df.select(floor_days("a", "b")).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_ts_one_format(spark):
    df = spark.createDataFrame([("2018-01-01 10:00:00",), ("2018-01-03",), ("bad",), ("",),
                                (None,)], "s string")
    got = [r[0] for r in df.select(parse_ts("s")).collect()]
    assert got == [dt.datetime(2018, 1, 1, 10, 0), None, None, None, None]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, 6),), (dt.date(2018, 1, 8),),
                                (dt.date(2018, 2, 1),)], "d date")
    got = df.select(date_key("d"), F.weekday("d"), month_name_pt(F.month("d"))).collect()
    assert [tuple(r) for r in got] == [(20180106, 5, "Jan"), (20180108, 0, "Jan"),
                                       (20180201, 3, "Fev")]


def _half_up(n: int, d: int, s: int):
    if d == 0:
        return None
    q = (decimal.Decimal(n) / decimal.Decimal(d)).quantize(
        decimal.Decimal(1).scaleb(-s), rounding=decimal.ROUND_HALF_UP)
    return float(q)


def test_hround_exact_half_up(spark):
    rnd = random.Random(7)
    rows = [(1005, 1000), (-1005, 1000), (15, 100), (25, 1000), (1, 3), (2, 3), (0, 5), (7, 0),
            (10**20 + 5, 10**3)]
    rows += [(rnd.randint(-10**9, 10**9), rnd.randint(1, 10**6)) for _ in range(300)]
    df = spark.createDataFrame([(decimal.Decimal(n), decimal.Decimal(d)) for n, d in rows],
                               "n decimal(38,0), d decimal(38,0)")
    for s in (1, 2):
        got = [r[0] for r in df.select(hround("n", "d", s)).collect()]
        assert got == [_half_up(int(n), int(d), s) for n, d in rows]


def test_hround_of_every_sign(spark):
    rnd = random.Random(5)
    rows = [(-100, 50), (50, -100), (100, -300), (7, -9), (-7, -9), (0, -3), (5, 0), (1, None)]
    rows += [(rnd.randint(-10**6, 10**6), rnd.choice([-1, 1]) * rnd.randint(1, 999))
             for _ in range(400)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", hround("n", "d", 1).alias("r")).collect()
    for r in got:
        if not r.d:
            assert r.r is None
            continue
        exact = decimal.Decimal(r.n) / decimal.Decimal(r.d)
        want = exact.quantize(decimal.Decimal("0.1"), rounding=decimal.ROUND_HALF_UP)
        assert r.r == float(want), r


def test_strip_unicode_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    rows = [(f"{s}são{s}paulo{s}{s}",) for s in spaces] + [("\xa0x\u200b",), ("",), ("\u3000",)]
    got = spark.createDataFrame(rows, "c string").select("c", strip_ws("c").alias("o")).collect()
    assert all(r.o == r.c.strip() for r in got)


def test_floor_days_to_the_microsecond(spark):
    rnd = random.Random(6)
    a = dt.datetime(2018, 1, 1, 10, 0, 0, 300)
    deltas = [dt.timedelta(hours=23, minutes=59, seconds=59.2), dt.timedelta(microseconds=-1),
              dt.timedelta(days=1, microseconds=-1)]
    deltas += [dt.timedelta(microseconds=rnd.randint(-4 * 10**11, 4 * 10**11)) for _ in range(200)]
    df = spark.createDataFrame([(a, a + d) for d in deltas], "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(floor_days("a", "b")).collect()]
    assert got == [d // dt.timedelta(days=1) for d in deltas]
