"""Facts are laid out by bucket before their keys are hashed, and items find their keys without moving."""

import glob
import os
import re
import time

import pytest

from pyspark.sql import functions as F

from feira.functions.columns import surrogate_key
from feira.plans.build import buckets_for_orders, publish_marts
from feira.plans.skew import with_hashed_key
from feira.plans.workspace import RELEASE, scratch, shared_dir
from feira.registry import World
from feira.sources import sinks
from feira.sources.versions import Draft

from frames import make, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("held, max_rows", [
    (["a", "b", "c"], 100),  # sound
    (["a", "a", "a", "c", None], 100),  # repeated and missing
    (["a", "a", "a", "c", None], 2),  # more than may be broadcast
    ([], 100),
])
def test_hashed_keys_equal_the_left_join(spark, held, max_rows):
    items = make(spark, [(1, "a"), (2, "b"), (3, "c"), (4, None), (5, "a")], "n int, id string")
    dim = make(spark, [(x,) for x in held], "id string").withColumn("key", surrogate_key("id"))
    got = with_hashed_key(items, items, dim, "id", "key", max_rows).select("n", "id", "key")
    assert rows(got) == rows(items.join(dim, "id", "left").select("n", "id", "key"))


def test_items_are_not_moved_for_sound_keys(spark, folder):
    text = plan(World(spark, folder).cat.fact_order_items(["order_key", "product_key", "seller_key"]))
    assert "Exchange" not in text and "Join" not in text


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_payments", "fact_reviews"])
def test_laid_out_facts_hold_the_same_rows(spark, folder, name):
    cat = World(spark, folder).cat
    laid_out = cat.bucketed_fact(name, 4)
    assert rows(laid_out) == rows(cat.model(name))
    placed = laid_out.filter("order_key is not null").select(
        F.spark_partition_id().alias("task"), F.pmod(F.hash("order_key"), F.lit(4)).alias("bucket")
    )
    assert placed.filter("task != bucket").count() == 0


@pytest.mark.parametrize("name", ["fact_orders", "fact_order_items", "fact_payments", "fact_reviews"])
def test_hashed_keys_are_not_shuffled(spark, folder, name):
    """Ids are moved; md5 makes no column below a layout."""
    logical = World(spark, folder).cat.bucketed_fact(name, 4)._jdf.queryExecution().optimizedPlan().toString()
    lines = logical.splitlines()
    depth = [len(re.match(r"[^A-Za-z]*", line)[0]) for line in lines]
    moved = [i for i, line in enumerate(lines) if "RepartitionByExpression" in line]
    assert moved
    for i in moved:
        below = [j for j in range(i + 1, len(lines)) if all(depth[k] > depth[i] for k in range(i + 1, j + 1))]
        assert not any(re.search(r"md5\([^,]*AS ", lines[j]) for j in below)


FACTS = ["fact_orders", "fact_order_items", "fact_payments", "fact_reviews"]


@pytest.mark.parametrize("name", FACTS)
def test_a_few_buckets_move_only_their_rows(spark, folder, name):
    """The filter of the keys is below everything that is moved, so what a few buckets need is all that lies on disk."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        with scratch(spark) as keep:
            laid_out = World(spark, folder).cat.bucketed_fact(name, 4, keep)
            some = laid_out.filter(sinks.in_turn(4, 2) == 1)
            lines = plan(some).splitlines()
            assert 0 < some.count() < laid_out.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    depth = [len(re.match(r"[^A-Za-z]*", line)[0]) for line in lines]
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    moved = 0
    for i in scans:
        above, at = [], depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < at:
                above, at = [*above, lines[j]], depth[j]
        exchanges = [k for k, line in enumerate(above) if "Exchange hashpartitioning" in line]
        if exchanges:
            moved += 1
            assert any("Filter" in line and "pmod(hash(md5(" in line for line in above[: exchanges[0]]), above
    assert moved


def test_facts_written_a_few_buckets_at_a_time_are_the_same(spark, folder, tmp_path):
    w = World(spark, folder)
    root, writes = str(tmp_path), []
    kept = sinks.write_bucketed
    sinks.write_bucketed = lambda df, *rest: (writes.append(rest[0]), kept(df, *rest))
    try:
        publish_marts(w.cat, root, names=FACTS, buckets=4, together=3)
    finally:
        sinks.write_bucketed = kept
    assert len(writes) == 2 * len(FACTS)
    for name in FACTS:
        assert rows(sinks.read_mart(spark, name, root)) == rows(w.cat.model(name))
        files = [os.path.basename(f) for f in glob.glob(f"{root}/**/{name}/**/*.parquet", recursive=True)]
        buckets = {int(re.search(r"_(\d{5})\.", f)[1]) for f in files}
        assert buckets == set(range(4))


def test_rows_without_an_order_are_written_once(spark, tmp_path):
    """A missing key has a bucket like any other."""
    df = make(spark, [("a", 20180101), (None, 20180101), (None, None)], "order_key string, order_date_key int")
    draft = Draft(spark, str(tmp_path))
    sinks.write_mart(draft, "fact_orders", df, 4, together=1)
    assert rows(sinks.read_published(spark, draft.commit(), "fact_orders")) == rows(df)


def test_a_publication_leaves_no_shuffle_files_and_nothing_kept(spark, folder, tmp_path):
    def held():
        blocks = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle")}

    w = World(spark, folder)
    setting = spark.conf.get(RELEASE)
    others = held()
    kept = glob.glob(f"{shared_dir(spark).removeprefix('file:')}/feira/order-*")
    publish_marts(w.cat, str(tmp_path), names=FACTS, buckets=2)
    until = time.time() + 20
    while held() - others and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not held() - others
    assert glob.glob(f"{shared_dir(spark).removeprefix('file:')}/feira/order-*") == kept
    assert spark.conf.get(RELEASE) == setting


def test_a_bucket_holds_at_most_what_one_task_sorts(spark):
    assert 9_000_000 / buckets_for_orders(spark.range(9_000_000)) <= 400_000


def test_items_of_other_orders_are_left_out_before_the_shuffle(spark, folder):
    """Run-time filters reach tables of a few row groups, whatever the size of the filtered side's files."""
    w = World(spark, folder)
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    assert spark.conf.get(threshold) == "64MB"
    sums = rows(w.category_sales(1999))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", threshold: "0"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        filtered = w.category_sales(1999)
        assert "might_contain" in filtered._jdf.queryExecution().optimizedPlan().toString()
        assert rows(filtered) == sums
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
