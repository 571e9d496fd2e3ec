"""Key checks, observed counts, and tables laid out by order."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_scale import SMALL_CLUSTER, hot_star, settings  # noqa: F401

from pricewright.operators import category
from pricewright.operators.facts import build_core_facts, build_facts
from pricewright.operators.keys import KeyChecks, KeyViolation, SourceCounts
from pricewright.plans import jobs
from pricewright.sources.layout import read_layout, write_layout
from pricewright.sources.star import scan_counts


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def doubled(star, table):
    df = star.tables()[table]
    return replace(star, **{table: df.unionAll(df.limit(1))})


def without_key(star, table, key):
    df = star.tables()[table]
    null = df.limit(1).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
    return replace(star, **{table: df.unionAll(null.select(df.columns))})


KEYS = {
    "products": "product_id", "orders": "order_id", "customers": "customer_id",
    "sellers": "seller_id", "translation": "product_category_name",
}


@pytest.mark.parametrize("table", KEYS)
def test_bad_keys_stop_the_job_by_name(star, stage, table):
    with pytest.raises(KeyViolation, match=f"{table}: 2 rows with {KEYS[table]} = "):
        build_facts(doubled(star, table), stage)
    with pytest.raises(KeyViolation, match=f"{table}: null in key {KEYS[table]}"):
        build_facts(without_key(star, table, KEYS[table]), stage)


@pytest.mark.parametrize("table", ["products", "translation"])
def test_bad_keys_stop_the_other_jobs(star, stage, table):
    with pytest.raises(KeyViolation, match=table):
        build_core_facts(doubled(star, table), stage)
    with pytest.raises(KeyViolation, match=table):
        category.category_stats(doubled(star, table), stage)


def test_checked_rows_are_the_rows(spark, stage):
    rows = spark.createDataFrame([("b", 1, None), ("a", None, 2)], "k string, x int, y int")
    keys = KeyChecks()
    checked = stage.table(keys.one_row_per_key(rows, "t", "k"), "t")
    keys.verify()
    assert checked.schema == rows.schema and sorted(checked.collect()) == sorted(rows.collect())
    lone = stage.table(keys.one_row_per_key(rows.select("k"), "t", "k"), "lone")
    keys.verify()
    assert sorted(r.k for r in lone.collect()) == ["a", "b"]


def test_checks_need_no_scan_of_their_own(star, stage):
    """The check adds no job: keys are verified from what the write has shown."""
    keys = KeyChecks()
    df = keys.one_row_per_key(star.products, "products", "product_id")
    assert plan_of(df).count("Scan ") == plan_of(star.products).count("Scan ")
    context = star.items.sparkSession.sparkContext
    stage.table(df, "products")
    before = _jobs(context)
    keys.verify()
    assert _jobs(context) == before


def _jobs(context) -> int:
    return len(context.statusTracker().getJobIdsForGroup(None))


def test_counts_come_out_of_the_job(spark, star, stage):
    rows, counts = jobs.prepare_counted(star, stage)
    written = counts.pop("training_rows")
    assert written == rows.count() > 0
    assert counts == {r.table_name: r.row_count for r in scan_counts(star).collect()}
    rows, counts = jobs.prepare_baseline_counted(star, stage)
    assert counts.pop("training_rows") == rows.count()
    assert set(counts) == {"items", "products", "orders", "translation"}


def test_counts_of_empty_tables(spark, star, stage):
    counts = SourceCounts()
    nothing = replace(star, reviews=star.reviews.limit(0), payments=star.payments.filter("1 = 0"))
    stage.table(build_facts(counts.watch(nothing), stage), "facts")
    found = counts.rows()
    assert found["reviews"] == found["payments"] == 0 and found["items"] == star.items.count()


def test_jobs_share_a_stage(star, stage):
    for _ in range(2):
        jobs.prepare_baseline(star, stage).count()
        jobs.prepare(star, stage).count()
        assert jobs.categories(star, stage).count() == 91


@pytest.fixture(scope="module")
def laid_out(spark, star, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layout") / "star")
    write_layout(star, folder, 4)
    return folder


def test_layout_holds_the_same_rows(spark, star, stage, laid_out):
    again = read_layout(spark, laid_out)
    assert again.by_order and again.orders.columns[-1] == "customer_state"
    counts = {r.table_name: r.row_count for r in scan_counts(again).collect()}
    assert counts == {r.table_name: r.row_count for r in scan_counts(star).collect()}
    key = ["order_id", "order_item_id", "product_id", "seller_id", "price"]
    ours, theirs = build_facts(again, stage), build_facts(star, stage)
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in (ours, theirs)]
    assert rows[0] == rows[1] and len(rows[0]) == star.items.count() and key
    core = [build_core_facts(s, stage) for s in (again, star)]
    columns = sorted(core[0].columns)
    rows = [sorted(map(str, df.select(*columns).collect())) for df in core]
    assert rows[0] == rows[1]


def test_no_exchange_by_order(spark, star, stage, laid_out):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        again = read_layout(spark, laid_out)
        plan = plan_of(build_facts(again, stage))
        assert plan.count("SortMergeJoin") == 4
        assert "hashpartitioning(order_id" not in plan and "hashpartitioning(customer_id" not in plan
        assert "hashpartitioning(product_id" in plan
        plain = plan_of(build_facts(star, stage))
        assert "hashpartitioning(order_id" in plain
        scores = plan_of(again.reviews.groupBy("order_id").count())
        assert "Exchange" not in scores


def test_a_session_that_did_not_write_the_layout_reads_it(spark, stage, laid_out):
    again = read_layout(spark.newSession(), laid_out, ("items", "products", "translation", "orders"))
    assert again.payments is None and again.items.count() == 6000


def test_an_order_that_fills_a_bucket_is_read_plain(spark, hot_star, stage):  # noqa: F811
    folder = stage.path("hot")
    write_layout(hot_star, folder, 8)
    with settings(spark, **SMALL_CLUSTER):
        again = read_layout(spark, folder)
        assert not again.by_order
        facts = build_facts(again, stage)
        assert facts.count() == 60_000


def test_layout_checks_its_keys(spark, star, stage):
    with pytest.raises(KeyViolation, match="orders: 2 rows with order_id"):
        write_layout(doubled(star, "orders"), stage.path("bad"), 2)
