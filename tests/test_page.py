"""The sliced dashboard page: bitmap states, lattice levels, and each visual
against the plain queries and against counting by hand."""
import glob
import random
import time
from dataclasses import replace
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from starbi.operators import bitmaps, lattice
from starbi.operators.measures import measure_mom_calendar, measures_by
from starbi.plans import analysis, page
from starbi.plans.star import Star

SLICES = [{}, {"year": [1997]}, {"state": ["NATION_1", "NATION_5", "NATION_7"]},
          {"category_en": ["cat_2"]}, {"category_en": ["cat_2", "cat_3", "cat_5", "undefined"]},
          {"year": [1996, 1998], "state": ["NATION_1", "NATION_3"], "category_en": ["cat_1", "cat_2", "cat_9"]},
          {"category_en": ["no such"]}]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("slicers", SLICES, ids=str)
@pytest.mark.parametrize("by", [(), ("year",), ("state", "category_en"), ("year", "state", "category_en")],
                         ids=str)
def test_measures_equal_the_plain_ones(star_small, by, slicers):
    assert rows(page.measures(star_small, by, slicers)) == rows(measures_by(star_small, by, slicers))


def test_unsliced_visuals_equal_the_questions(star_small):
    assert rows(page.delivery_by_state(star_small)) == \
        rows(analysis.q06_logistics_by_state(star_small, min_orders=1))
    assert rows(page.delivery_by_state(star_small, min_orders=5)) == \
        rows(analysis.q06_logistics_by_state(star_small, min_orders=5))
    assert rows(page.rating_by_band(star_small)) == rows(analysis.nb_delay_bands(star_small))
    assert rows(page.top_categories(star_small)) == rows(analysis.kpi_top_categories(star_small))
    for slicers in SLICES:
        assert rows(page.monthly_line(star_small, slicers)) == \
            rows(measure_mom_calendar(star_small, slicers))


def test_no_visual_reads_the_fact_or_shuffles_orders(star_small):
    page.page_for(star_small)
    for slicers in SLICES:
        for df in (page.measures(star_small, ("state",), slicers), page.measures(star_small, (), slicers),
                   page.delivery_by_state(star_small, slicers), page.rating_by_band(star_small, slicers),
                   page.top_categories(star_small, slicers), page.monthly_line(star_small, slicers)):
            files = df.inputFiles()
            assert files and all("/page/" in f for f in files)
            assert "order_id" not in df._jdf.queryExecution().executedPlan().toString()


def _star(spark):
    """Orders over several categories, states and years; one order stands twice
    in dim_order, one has no items, one no customer row, one no date."""
    rng = random.Random(12)
    customers = [(c, f"S{c % 3}" if c % 10 else None) for c in range(30)]
    products = [(p, f"c{p % 5}") for p in range(20)]
    days = [20170105, 20170210, 20180105, 20180305]
    orders, items = [], []
    for o in range(400):
        customer, day = rng.randrange(32), rng.choice([*days, None])
        late = rng.choice([None, -9, -1, 0, 3, 8])
        row = (o, customer, rng.choice(["delivered", "delivered", "shipped"]), day,
               rng.choice([None, -2, 3, 900, 15]), late, None if late is None else int(late <= 0),
               rng.choice([None, 1, 3, 5]))
        orders += [row, row] if o % 17 == 0 else [row]
        if day and o % 11:
            for _ in range(2 if o % 17 == 0 else 1):  # the items of an order row
                items += [(o, p, customer, day, Decimal(rng.randint(1, 999)) / 100)
                          for p in rng.choices(range(22), k=rng.randint(1, 5))]
    o = spark.createDataFrame(orders, "order_id long, customer_id long, order_status string, d int, "
                              "delivery_days int, delay_days int, on_time int, review_score int") \
        .withColumn("purchase_date", F.to_date(F.col("d").cast("string"), "yyyyMMdd")).drop("d")
    f = spark.createDataFrame(items, "order_id long, product_id long, customer_id long, date_key int, "
                              "total_item_value decimal(18,2)") \
        .withColumn("price", F.col("total_item_value")) \
        .withColumn("freight_value", F.lit(0).cast("decimal(18,2)")).withColumn("seller_id", F.lit(1))
    star = Star(
        dim_customer=spark.createDataFrame(customers, "customer_id long, state string"),
        dim_product=spark.createDataFrame(products, "product_id long, category_en string"),
        dim_seller=spark.createDataFrame([(1, "X")], "seller_id int, state string"), dim_order=o,
        dim_date=spark.createDataFrame([(d, d // 10000, f"{d // 10000}-{d // 100 % 100:02d}") for d in days],
                                       "date_key int, year int, year_month string"),
        fact_order_items=f)
    return star, orders, items, dict(customers), dict(products)


@pytest.fixture(scope="module")
def hand(spark):
    return _star(spark)


@pytest.mark.parametrize("slicers", [
    {}, {"year": [2017]}, {"category_en": ["c1", "c2", "c4"]}, {"category_en": ["c3"], "state": ["S1"]},
    {"year": [2018], "state": ["S0", "S2"], "category_en": ["c0", "c1", "c2", "c3", "c4"]}], ids=str)
def test_order_visuals_by_hand(hand, slicers):
    star, orders, items, state, category = hand
    touch = {}
    for o, p, *_ in items:
        touch.setdefault(o, set()).add(category.get(p))
    left = [r for r in orders if r[2] == "delivered"
            and ("year" not in slicers or r[3] and r[3] // 10000 in slicers["year"])
            and ("state" not in slicers or state.get(r[1]) in slicers["state"])
            and ("category_en" not in slicers or touch.get(r[0], set()) & set(slicers["category_en"]))]
    want = {}
    for r in left:
        if state.get(r[1]) and r[4] is not None:
            want.setdefault(state[r[1]], []).append(r[4])
    got = {r.state: (r.pedidos, r.dias_entrega_medio) for r in page.delivery_by_state(star, slicers).collect()}
    assert {s: n for s, (n, _) in got.items()} == {s: len(v) for s, v in want.items()}
    assert all(abs(mean - sum(want[s]) / len(want[s])) <= 0.05 + 1e-9 for s, (_, mean) in got.items())
    bands = {}
    for r in left:
        if r[5] is not None and r[7] is not None:
            bands.setdefault({-9: 1, -1: 2, 0: 3, 3: 4, 8: 5}[r[5]], []).append(r[7])
    got = {r.ord: (r.pedidos, r.nota_media) for r in page.rating_by_band(star, slicers).collect()}
    assert {b: n for b, (n, _) in got.items()} == {b: len(bands.get(b, [])) for b in range(1, 6)}
    assert all(b not in bands or abs(mean - sum(bands[b]) / len(bands[b])) <= 0.005 + 1e-9
               for b, (_, mean) in got.items())
    assert rows(page.measures(star, ("category_en",), slicers)) == \
        rows(measures_by(star, ("category_en",), slicers))


def test_empty_star(spark, hand):
    star = Star(**{n: t.limit(0) for n, t in hand[0].tables().items()})
    assert page.delivery_by_state(star).count() == 0 and page.top_categories(star).count() == 0
    assert [r.pedidos for r in page.rating_by_band(star, {"category_en": ["x"]}).collect()] == [0] * 5
    assert [r.pedidos for r in page.measures(star).collect()] == [0]


def test_unknown_slicers_are_refused(star_small):
    for visual in (page.delivery_by_state, page.rating_by_band, page.top_categories, page.monthly_line):
        with pytest.raises(ValueError, match="unknown slicer"):
            visual(star_small, {"city": ["x"]})


# ------------------------------------------------------------------ operators
def test_numbers_have_no_gaps_and_follow_the_order(spark, tmp_out):
    df = spark.range(5_000).selectExpr("pmod(hash(id), 7) AS a", "concat('o', id) AS k")

    def write(d):
        d.write.parquet(f"{tmp_out}/numbers")
        return spark.read.parquet(f"{tmp_out}/numbers")
    got = bitmaps.dense_numbers(df, write, ["a", "k"]).collect()
    assert sorted(r.number for r in got) == list(range(1, 5_001))
    assert [r.k for r in sorted(got, key=lambda r: r.number)] == \
        [r.k for r in sorted(got, key=lambda r: (r.a, r.k))]


def test_sets_and_slices_over_many_buckets(spark):
    n = 100_000
    touched = spark.range(1, n + 1).selectExpr("id AS number", "explode(array(pmod(id, 3), pmod(id, 5))) AS g")
    sets = bitmaps.order_sets(touched, ["g"])
    assert sets.select("bucket").distinct().count() == 4
    per = {r.g: r.n for r in bitmaps.count_sets(bitmaps.union_sets(sets, ["g"]), ["g"]).collect()}
    assert per == {g: sum(g in (i % 3, i % 5) for i in range(1, n + 1)) for g in range(5)}
    both = bitmaps.union_sets(sets.where("g IN (0, 4)"), [])
    inside = [i for i in range(1, n + 1) if {0, 4} & {i % 3, i % 5}]
    assert bitmaps.count_sets(both, []).first().n == len(inside)
    values = spark.range(1, n + 1).selectExpr("id AS number", "id % 2 AS k", "id % 1001 - 500 AS v")
    slices = bitmaps.bit_slices(values, ["k"], {"v": F.col("v"), "one": F.lit(1), "none": F.lit(None)})
    got = {(r.k, r.name): r.total for r in bitmaps.sums_over_sets(slices, ["k"], both, []).collect()}
    assert got == {(k, name): sum((i % 1001 - 500) if name == "v" else 1 for i in inside if i % 2 == k)
                   for k in (0, 1) for name in ("v", "one")}


def test_lattice_levels_and_routing(spark, tmp_out):
    rng = random.Random(3)
    data = [(rng.choice([1, 2, None]), rng.randint(1, 12), rng.choice("ab"), rng.randint(0, 9)) for _ in range(200)]
    df = spark.createDataFrame(data, "y int, m int, s string, v int")
    cells, levels = lattice.build(df, [("y", "m"), ("s",)], {"v": F.sum("v")})
    cells.write.parquet(f"{tmp_out}/cells")
    lat = lattice.opened(spark.read.parquet(f"{tmp_out}/cells"), levels)
    assert len(levels) == 6 and lat.cells["total"] == 1
    for size in range(4):
        for dims in combinations(["y", "m", "s"], size):
            level = lat.route(dims)
            assert set(dims) <= set(level)
            assert lat.cells[lattice.level_name(level)] == min(
                n for name, n in lat.cells.items() if name == "total" and not dims
                or set(dims) <= set(name.split("+")))
            got = rows(lat.read(dims).groupBy(*dims).agg(F.sum("v")))
            assert got == rows(df.groupBy(*dims).agg(F.sum("v")))
    assert lat.read(["y"], {"s": ["a"]}).agg(F.sum("v")).first()[0] == sum(r[3] for r in data if r[2] == "a")
    with pytest.raises(ValueError, match="no level has"):
        lat.route(["city"])


def test_bitmaps_are_made_where_a_whole_bucket_is(spark):
    rows = spark.range(40).select(F.col("id").alias("number"), (F.col("id") % 3).alias("g"))
    for made in (bitmaps.order_sets(rows, ["g"]), bitmaps.bit_slices(rows, ["g"], {"m": F.col("g")})):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.index("partial_bitmap_construct_agg") < plan.index("hashpartitioning(bucket")
        assert plan.count("hashpartitioning(") == 1


def test_slices_of_large_and_negative_values(spark):
    values = [0, 1, -1, 5, 2**62, -2**62 - 3, 2**63 - 1, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "number long, v long")
    got = {}
    for r in bitmaps.bit_slices(rows, [], {"v": F.col("v")}).select(
            "weight", F.bitmap_count("bits").alias("n")).collect():
        got[r.weight] = r.n
    assert sum(w * n for w, n in got.items()) == sum(v for v in values if v)


def test_building_leaves_no_shuffle_files(spark, star_small):
    jvm = spark.sparkContext._jvm
    folders = list(jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}
    before = files()
    page.page_for(replace(star_small, page=None, path=None))
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:  # removed a little after the job's end
        time.sleep(0.5)
    assert files() <= before
