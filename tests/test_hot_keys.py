"""Hot keys take other plans; the results must be the same as without them."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from builders import PRODUCT, PRODUCTS, at, discount, line, payment_hist, pipeline
from conftest import SMALL
from pyspark.sql import functions as F

from bookledger.config import BookingsConfig
from bookledger.operators.ordered import fill_nearest, first_where, last_by_group, neighbours
from bookledger.operators.skew import (
    NO_HOT_KEYS,
    HotKeys,
    Split,
    listed_hot_keys,
    lookup,
    measure_hot_keys,
    split_hot,
    total_over,
)
from bookledger.plans.pipeline import BookingsPipeline
from bookledger.sources.driver_tables import driver_inputs
from bookledger.sources.sinks import Storage

DOMAIN = "k"


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 1 and NULL hold a third of the rows each; many times tie."""
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        key = (1, None, rng.randint(2, 40))[i % 3]
        at = None if rng.random() < 0.03 else start + timedelta(hours=rng.randint(0, 30))
        value = None if rng.random() < 0.7 else rng.randint(0, 9)
        rows.append((i, key, at, value, rng.random() < 0.3))
    schema = "id int, key int, at timestamp_ntz, value int, flag boolean"
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.fixture(scope="module")
def keep(spark, tmp_path_factory):
    return Storage(spark, str(tmp_path_factory.mktemp("kept"))).keep


@pytest.fixture(scope="module")
def hot(skewed, keep):
    return measure_hot_keys({DOMAIN: [(skewed, "key")]}, 50, keep)


def listed(hot, domain=DOMAIN):
    return {r[0]: r[1] for r in hot.tables[domain].collect()}


def ordered_groups(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["key"], []).append(r)
    last = datetime.max
    for rows in groups.values():
        rows.sort(key=lambda r: (r["at"] is None, r["at"] or last, r["id"]))
    return groups


def test_measure_finds_heavy_values_and_null(hot):
    assert listed(hot) == {1: 200, None: 200}
    assert hot.total_pieces(DOMAIN) == 8


def test_measure_finds_nothing_below_the_limit(skewed, keep):
    assert not measure_hot_keys({DOMAIN: [(skewed, "key")]}, 500, keep).has(DOMAIN)


def test_measure_finds_all_hot_keys_however_many(spark, keep):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("key"))
    found = measure_hot_keys({DOMAIN: [(rows, "key")]}, 4, keep)
    assert listed(found) == {i: 5 for i in range(1000)}


def test_rows_of_all_sources_add_up(spark, skewed, keep):
    other = spark.range(45).select(F.lit(7).alias("k7"))
    found = measure_hot_keys({DOMAIN: [(skewed, "key"), (other, "k7"), (other, "k7")]}, 90, keep)
    sevens = skewed.filter("key = 7").count()
    assert listed(found) == {1: 200, None: 200, 7: 90 + sevens}
    assert listed(measure_hot_keys({DOMAIN: [(skewed, "key")]}, 90, keep, times=3))[1] == 600


def test_measuring_has_no_single_task(spark, skewed):
    """The keys are counted in partial sums and shuffled by key."""
    plans = []
    measure_hot_keys({DOMAIN: [(skewed, "key")]}, 50, lambda df: plans.append(df) or df)
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "partial_count" in plan


def test_a_pair_goes_from_operator_to_operator(skewed, hot):
    """What was parted stays parted, and the rows are those of one table that is parted at each step."""
    pair = split_hot(skewed, "key", hot, DOMAIN)
    assert {r["key"] for r in pair.heavy.collect()} == {1, None}
    assert not {1, None} & {r["key"] for r in pair.ordinary.collect()}
    steps = total_over(pair, ["key"], {"n": F.count(F.lit(1))}, hot, DOMAIN)
    steps = neighbours(steps, "key", ["at", "id"], {"before": "value"}, {"after": "at"}, hot, DOMAIN)
    steps = first_where(steps, "key", ["at", "id"], {"first": "flag"}, hot, DOMAIN)
    assert isinstance(steps, Split)
    plain = total_over(skewed, ["key"], {"n": F.count(F.lit(1))})
    plain = neighbours(plain, "key", ["at", "id"], {"before": "value"}, {"after": "at"})
    assert rows_of(steps.rows()) == rows_of(first_where(plain, "key", ["at", "id"], {"first": "flag"}))
    assert split_hot(skewed, "key", NO_HOT_KEYS, DOMAIN).heavy is None


def test_equal_rows_are_spread(spark, skewed, hot):
    """Rows that are equal in every column lie in as many pieces as they come from partitions."""
    rows = spark.range(400).repartition(8).select(F.lit(1).alias("key"))
    listed_keys = measure_hot_keys({DOMAIN: [(rows, "key")]}, 50, lambda df: df)
    right = spark.createDataFrame([(1, "one")], "key int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(rows, right, ["key"], listed_keys, DOMAIN)
        counts = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(counts) == 400 and len(counts) > 1


def test_runs_of_a_hot_key_follow_its_size(spark, keep):
    """Not the session's number of partitions: a key of ten limits gets at least ten runs."""
    rows = spark.range(1000).select(F.lit(1).alias("key"), "id", F.lit(None).cast("int").alias("value"))
    found = measure_hot_keys({DOMAIN: [(rows, "key")]}, 100, keep)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        filled = fill_nearest(rows, "key", ["id"], ["value"], found, DOMAIN)
        plan = filled._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "RepartitionByExpression" in plan and ", 20" in plan
    assert filled.count() == 1000


@pytest.mark.parametrize("use_hot", [False, True])
def test_first_where_marks_one_of_equal_rows(spark, hot, use_hot):
    rows = spark.createDataFrame([(1, 0, True), (1, 0, True), (1, 1, True), (2, 0, True), (2, 0, True)], "key int, at int, flag boolean")
    got = first_where(rows, "key", ["at"], {"first": "flag"}, hot if use_hot else NO_HOT_KEYS, DOMAIN)
    assert sorted((r["key"], r["at"], r["first"]) for r in got.collect()) == [
        (1, 0, 0), (1, 0, 1), (1, 1, 0), (2, 0, 0), (2, 0, 1)
    ]


def test_ordinary_rows_keep_the_window_plan(skewed, hot):
    got = total_over(skewed, ["key"], {"n": F.count(F.lit(1))}, hot, DOMAIN)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Union" in plan


@pytest.mark.parametrize("use_hot", [False, True])
def test_neighbours_against_brute_force(skewed, hot, use_hot):
    got = neighbours(
        skewed, "key", ["at", "id"], {"before": "value"}, {"after": "at"},
        hot if use_hot else NO_HOT_KEYS, DOMAIN,
    )
    expected = Counter()
    for rows in ordered_groups(skewed).values():
        for i, r in enumerate(rows):
            before = rows[i - 1]["value"] if i else None
            after = rows[i + 1]["at"] if i + 1 < len(rows) else None
            expected[(r["id"], before, after)] += 1
    assert Counter((r["id"], r["before"], r["after"]) for r in got.collect()) == expected


@pytest.mark.parametrize("use_hot", [False, True])
def test_fill_nearest_against_brute_force(skewed, hot, use_hot):
    got = fill_nearest(
        skewed, "key", ["at", "id"], ["value"], hot if use_hot else NO_HOT_KEYS, DOMAIN
    )
    expected = {}
    for rows in ordered_groups(skewed).values():
        for i, r in enumerate(rows):
            value = r["value"]
            earlier = [x["value"] for x in rows[:i] if x["value"] is not None]
            later = [x["value"] for x in rows[i + 1 :] if x["value"] is not None]
            if value is None:
                value = earlier[-1] if earlier else later[0] if later else None
            expected[r["id"]] = value
    assert {r["id"]: r["value"] for r in got.collect()} == expected


@pytest.mark.parametrize("use_hot", [False, True])
def test_first_where_against_brute_force(skewed, hot, use_hot):
    got = first_where(
        skewed, "key", ["at", "id"], {"first": "flag"}, hot if use_hot else NO_HOT_KEYS, DOMAIN
    )
    expected = set()
    for rows in ordered_groups(skewed).values():
        flagged = [r["id"] for r in rows if r["flag"]]
        expected |= set(flagged[:1])
    assert {r["id"] for r in got.collect() if r["first"] == 1} == expected
    assert got.count() == 600


@pytest.mark.parametrize("use_hot", [False, True])
def test_last_by_group_against_brute_force(skewed, hot, use_hot):
    df = skewed.withColumn("known", F.col("value").isNotNull())
    got = last_by_group(
        df, "key", "flag", ["at", "id"], "known", "last",
        hot if use_hot else NO_HOT_KEYS, DOMAIN,
    )
    expected = {}
    for rows in ordered_groups(df).values():
        for r in rows:
            expected[r["id"]] = [x["known"] for x in rows if x["flag"] == r["flag"]][-1]
    assert {r["id"]: r["last"] for r in got.collect()} == expected


@pytest.mark.parametrize("use_hot", [False, True])
def test_total_over_counts_null_as_one_group(skewed, hot, use_hot):
    got = total_over(
        skewed, ["key"], {"n": F.count(F.lit(1)), "s": F.sum("value")},
        hot if use_hot else NO_HOT_KEYS, DOMAIN,
    )
    groups = ordered_groups(skewed)
    for r in got.collect():
        rows = groups[r["key"]]
        values = [x["value"] for x in rows if x["value"] is not None]
        assert (r["n"], r["s"]) == (len(rows), sum(values) if values else None)


@pytest.mark.parametrize("use_hot", [False, True])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_keeps_every_left_row(spark, skewed, hot, use_hot, null_safe):
    right = spark.createDataFrame(
        [(1, "one"), (None, "none"), (5, "five"), (5, "five again")], "key int, name string"
    )
    got = lookup(
        skewed, right, ["key"], hot if use_hot else NO_HOT_KEYS, DOMAIN, null_safe=null_safe
    )
    names = {1: ["one"], 5: ["five", "five again"], None: ["none"] if null_safe else [None]}
    expected = Counter()
    for r in skewed.collect():
        for name in names.get(r["key"], [None]):
            expected[(r["id"], name)] += 1
    assert Counter((r["id"], r["name"]) for r in got.collect()) == expected


def test_hot_rows_are_spread_over_tasks(spark, skewed, hot):
    """No task may get all rows of a hot key."""
    right = spark.createDataFrame([(1, "one")], "key int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(skewed, right, ["key"], hot, DOMAIN)
        per_task = (
            joined.filter("key = 1").groupBy(F.spark_partition_id().alias("task")).count()
        )
        counts = [r["count"] for r in per_task.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(counts) == 200 and max(counts) < 200


def test_merged_rows_add_up(spark, keep):
    def known(rows):
        return spark.createDataFrame(rows, "k int, n long")

    a = listed_hot_keys({"x": known([(1, 20), (2, 50), (3, 4)])}, 10, keep)
    b = listed_hot_keys({"x": known([(1, 70)]), "y": known([(None, 30)])}, 10, keep)
    merged = a.merge(b, keep)
    assert listed(merged, "x") == {1: 90, 2: 50} and listed(merged, "y") == {None: 30}
    assert listed(NO_HOT_KEYS.merge(b, keep), "x") == {1: 70}


HOT_STAGES = (
    "line_item_changes",
    "line_item_intervals",
    "initial_line_item_bookings",
    "additional_line_item_bookings",
    "classify_discounts",
    "initial_invoice_discounts",
    "additional_invoice_discounts",
    "fill_line_item_dimensions",
    "item_allocation_percentages",
    "allocate_initial_invoice_discounts",
    "allocate_additional_invoice_discounts",
    "store_credit_bookings",
    "bookings_grouped",
    "volume_eligibility",
    "gross_order_item_volume",
    "gross_order_volume",
    "line_item_bookings",
    "bookings_quality",
)


def hot_run(spark, storage):
    """A dozen keys of every domain, and NULL, are said to be hot, in more than one piece each."""
    invoices = driver_inputs(spark, SMALL)["line_item_hist"].select("invoice_id", "line_item_id", "price_point_id")

    def some(column):
        counts = invoices.groupBy(column).count().orderBy(F.desc("count"), column).limit(12)
        null = spark.range(1).select(F.lit(None).cast("long"), F.lit(3).cast("long"))
        listed_rows = counts.select(F.col(column).alias("_hot_key"), F.col("count").alias("_hot_rows")).union(null)
        return storage.keep(listed_rows)

    tables = {"invoice": some("invoice_id"), "line_item": some("line_item_id"), "price_point": some("price_point_id")}
    inputs = driver_inputs(spark, SMALL)
    inputs._given_hot_keys = HotKeys(tables, 2).with_domain("discount", "line_item").counted()
    return BookingsPipeline(inputs, storage)


class Counted(Storage):
    """Notes what is kept."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.kept = []

    def keep(self, df):
        self.kept.append(super().keep(df))
        return self.kept[-1]

    def keep_in_buckets(self, df, key):
        self.kept.append(super().keep_in_buckets(df, key))
        return self.kept[-1]


@pytest.fixture(scope="module")
def whole_runs(spark, tmp_path_factory):
    """A run without and a run with hot keys, prepared once for all stages."""
    folders = {name: Counted(spark, str(tmp_path_factory.mktemp(name))) for name in ("plain", "hot")}
    made = {
        "plain": BookingsPipeline(driver_inputs(spark, SMALL), folders["plain"]),
        "hot": hot_run(spark, folders["hot"]),
    }
    for run in made.values():
        run.prepare("bookings_quality")
    assert not made["plain"].hot.tables
    assert {"invoice", "price_point", "line_item", "discount"} <= set(made["hot"].hot.tables)
    return made


@pytest.mark.parametrize("stage", HOT_STAGES)
def test_pipeline_with_hot_keys_gives_the_same(whole_runs, stage):
    kept = {name: len(run.storage.kept) for name, run in whole_runs.items()}
    found = {name: getattr(run, stage) for name, run in whole_runs.items()}
    assert rows_of(found["hot"]) == rows_of(found["plain"])
    # Asking for a stage stores nothing.
    assert {name: len(run.storage.kept) for name, run in whole_runs.items()} == kept


def test_measured_hot_keys_give_the_same(spark, tmp_path, whole_runs):
    """Dozens of invoices and price points are above a low limit."""
    config = BookingsConfig(max_rows_per_task=18)
    run = BookingsPipeline(driver_inputs(spark, SMALL, config), Storage(spark, str(tmp_path)))
    run.prepare("line_item_bookings")
    assert {"invoice", "price_point"} <= set(run.hot.tables)
    assert rows_of(run.line_item_bookings) == rows_of(whole_runs["plain"].line_item_bookings)


@pytest.mark.parametrize("stage", ["line_item_changes", "fill_line_item_dimensions", "gross_order_volume"])
def test_a_run_prepared_for_one_stage(spark, tmp_path, whole_runs, stage):
    run = hot_run(spark, Storage(spark, str(tmp_path)))
    assert rows_of(getattr(run.prepare(stage), stage)) == rows_of(getattr(whole_runs["plain"], stage))


def test_only_shared_tables_key_lists_and_hot_rows_are_kept(spark, tmp_path):
    """With hot keys a run writes no other table than without them, but for lists and rows of hot keys."""
    run = hot_run(spark, Counted(spark, str(tmp_path)))
    run.prepare()
    shared = {id(df) for df in run._shared.values()}
    assert set(run._shared) == {"discounts", "bookings", "invoice_discounts", "ledger"}
    assert set(run._heavy) == set(run.PARTED)
    others = [df for df in run.storage.kept if id(df) not in shared | {id(df) for df in run._heavy.values()}]
    assert all(df.columns == ["_hot_key", "_hot_rows"] for df in others)
    for name, df in run._heavy.items():
        key, domain = run.PARTED[name]
        keys = {r[0] for r in run.hot.tables[domain].select("_hot_key").collect()}
        assert {r[0] for r in df.select(key).distinct().collect()} <= keys
        # And no row of an ordinary key.
        assert df.count() < getattr(run, name).count()


def two_price_points(spark, config):
    """A price point that is listed twice repeats its bookings before the first is marked."""
    twice = [*PRODUCTS, PRODUCT | {"product_name": "Plan again"}]
    return pipeline(
        spark, config, payment_hist=[payment_hist()], product_price_point=twice,
        line_item_hist=[line(n, at(n), amount=n) for n in range(1, 6)],
    )


def test_repeated_dimension_rows_give_the_same_flags(spark, tmp_path):
    plain = two_price_points(spark, None)
    expected = rows_of(plain.gross_order_volume)
    assert sum(n for row, n in expected.items()) == 10
    hot = two_price_points(spark, BookingsConfig(max_rows_per_task=2))
    hot.inputs._given_hot_keys = None
    hot.storage = Storage(spark, str(tmp_path))
    hot.prepare("gross_order_volume")
    assert {"invoice", "line_item"} <= set(hot.hot.tables)
    assert rows_of(hot.gross_order_volume) == expected
    marked = hot.gross_order_item_volume.agg(F.sum("gross_order_item_volume")).first()[0]
    assert marked == plain.gross_order_item_volume.agg(F.sum("gross_order_item_volume")).first()[0] == 1


def test_invoice_whose_discounts_multiply_is_hot(spark, tmp_path):
    """20 line items at 20 discount times are 400 bookings from inputs of 20 rows."""
    made = pipeline(
        spark, BookingsConfig(max_rows_per_task=50), payment_hist=[payment_hist(settled=at(-1))],
        line_item_hist=[line(n, at(0), line_item_id=100 + n, amount=10 + n) for n in range(20)],
        discount_hist=[discount(n, at(1 + n), amount=1) for n in range(20)],
    )
    made.inputs._given_hot_keys = None
    made.storage = Storage(spark, str(tmp_path))
    made.prepare("bookings_grouped")
    assert listed(made.hot, "invoice")[1] >= 400
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = made._allocated.rows().groupBy(F.spark_partition_id().alias("t")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in tasks) == 400 and max(r["count"] for r in tasks) < 400


def test_plans_are_built_without_jobs(spark):
    """Only ``prepare`` runs something; a pipeline without it needs no folder."""
    tracker = spark.sparkContext.statusTracker()
    made = BookingsPipeline(driver_inputs(spark, SMALL))
    for name in ("payment_hist", "line_item_hist", "discount_hist", "store_credits", "line_item", "payment",
                 "line_item_hierarchy", "price_point", "product_price_point"):
        made.inputs[name]  # opening a parquet file is a job of its own
    spark.sparkContext.setJobGroup("plan", "plan only")
    try:
        made.line_item_bookings._jdf.queryExecution().optimizedPlan()
        assert not tracker.getJobIdsForGroup("plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
