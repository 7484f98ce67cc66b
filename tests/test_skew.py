"""One person with a third of all orders is numbered like everybody else."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from feira.operators import intermediate, marts
from frames import CUSTOMERS, ORDERS, make, rows


def frames(spark):
    rnd = random.Random(3)
    start = datetime(2018, 1, 1)
    orders, customers = [], []
    for i in range(900):
        person = "hot" if i % 3 == 0 else None if i % 10 == 1 else f"u{rnd.randrange(200)}"
        bought = None if i % 50 == 0 else start + timedelta(seconds=rnd.randrange(600))
        status = rnd.choice(["DELIVERED", "SHIPPED", "CANCELED", None])
        orders.append((f"o{i:04d}", f"c{i}", status, bought, None, None, None, None))
        if i % 20 != 7:  # some orders have no account
            customers.append((f"c{i}", person, "1", "X", "SP"))
    return make(spark, orders, ORDERS), make(spark, customers, CUSTOMERS)


@pytest.fixture
def many_parts(spark):
    """Ranges are not merged, as they would not be with more data."""
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def by_windows(orders, customers):
    history = intermediate.order_accounts(orders, customers)
    person = Window.partitionBy("customer_unique_id")
    own = Window.partitionBy("customer_unique_id", "is_qualifying_order").orderBy("order_purchase_timestamp", "order_id")
    qualifies = F.col("is_qualifying_order")
    return history.withColumns({
        "first_order_timestamp": F.min(F.when(qualifies, F.col("order_purchase_timestamp"))).over(person),
        "customer_order_number": F.when(qualifies, F.row_number().over(own).cast("bigint")),
    })


def test_numbers_equal_those_of_windows(many_parts):
    orders, customers = frames(many_parts)
    got = intermediate.int_customer_orders(orders, customers)
    assert rows(got) == rows(by_windows(orders, customers), *got.columns)


@pytest.mark.parametrize("moment", [None, "2018-01-01 10:00:00"])
def test_one_person_of_one_moment_is_numbered_by_several_tasks(many_parts, moment):
    """A third of all orders have one person and one time, or none; order_ids repeat as well."""
    base = hot_third(many_parts, 5000).withColumn("order_id", F.concat(F.lit("o"), (F.col("id") % (N - 900)).cast("string")))
    orders = base.select(
        "order_id", F.col("id").cast("string").alias("customer_id"), F.lit("DELIVERED").alias("order_status"),
        F.to_timestamp(F.lit(moment)).alias("order_purchase_timestamp"),
    )
    customers = base.select(
        F.col("id").cast("string").alias("customer_id"), F.col("k").alias("customer_unique_id"),
        *[F.lit("x").alias(c) for c in ("customer_zip_code_prefix", "customer_city", "customer_state")],
    )
    numbered = intermediate.int_customer_orders(orders, customers)
    marked = numbered.withColumn("task", F.spark_partition_id()).filter("customer_unique_id = 'hot'").collect()
    assert len({r["task"] for r in marked}) > 1
    assert sorted(r["customer_order_number"] for r in marked) == list(range(1, N // 3 + 1))
    ordered = [r["order_id"] for r in sorted(marked, key=lambda r: r["customer_order_number"])]
    assert ordered == sorted(ordered)
    assert numbered.filter("customer_order_number = 1").count() == base.select("k").distinct().count()


def test_accounts_are_joined_once(spark):
    orders, customers = frames(spark)
    text = intermediate.int_customer_orders(orders, customers)._jdf.queryExecution().executedPlan().toString()
    assert "customer_id#" in text and "customer_city" in text
    assert not re.search(r"Join[^\n]*customer_id#", text)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}
N = 120_000


@pytest.fixture
def cluster_like(spark):
    """Thresholds small enough for test data to meet the run-time rules of large data."""
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name in SMALL:
        spark.conf.unset(name)


def hot_third(spark, others):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % others).cast("string")))
    return spark.range(0, N, 1, 16).withColumn("k", key)


def hot_tasks(df, hot):
    """Tasks the hot group's rows are spread over, and whether the join was split."""
    marked = df.withColumns({"task": F.spark_partition_id(), "hot": hot})
    tasks = Counter(r["task"] for r in marked.collect() if r["hot"])
    assert sum(tasks.values()) == N // 3
    return len(tasks), "skew=true" in marked._jdf.queryExecution().executedPlan().toString()


def test_a_hot_order_is_split_over_tasks(cluster_like, tmp_path):
    items = hot_third(cluster_like, 5000).select(
        F.col("k").alias("order_id"), F.col("id").alias("order_item_id"), F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"),
    )
    items.select("order_id").distinct().withColumn(
        "order_purchase_timestamp", F.to_timestamp(F.lit("2018-01-01 00:00:00"))
    ).write.parquet(str(tmp_path / "orders"))
    orders = cluster_like.read.parquet(str(tmp_path / "orders"))
    fact = marts.fact_order_items(
        items, ["order_key", "order_item_id", "order_date_key"],
        orders=lambda: orders, products=lambda: None, sellers=lambda: None,
    )
    tasks, split = hot_tasks(fact, F.col("order_key") == F.md5(F.lit("hot")))
    assert split and tasks > 1
    assert fact.count() == N and fact.filter("order_date_key is null").count() == 0


def test_a_hot_zip_is_split_over_tasks(cluster_like):
    sellers = hot_third(cluster_like, 900).select(
        F.col("id").cast("string").alias("seller_id"), F.col("k").alias("seller_zip_code_prefix")
    )
    points = sellers.select(
        F.col("seller_zip_code_prefix").alias("geolocation_zip_code_prefix"), F.lit(1.0).alias("latitude"),
        F.lit(1.0).alias("longitude"), F.lit("X").alias("city"), F.lit("SP").alias("state"),
    )
    dim = marts.dim_seller(sellers, marts.dim_geolocation(intermediate.int_geolocation(points)))
    tasks, split = hot_tasks(dim, F.col("seller_zip_code_prefix") == "hot")
    assert split and tasks > 1
    assert dim.count() == N and dim.filter("geolocation_key is null").count() == 0


def test_a_hot_person_is_split_over_tasks(cluster_like, tmp_path):
    base = hot_third(cluster_like, 5000).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"), F.col("id").cast("string").alias("customer_id"),
        F.col("k").alias("customer_unique_id"),
    )
    orders = base.select(
        "order_id", "customer_id", F.lit("DELIVERED").alias("order_status"),
        F.timestamp_seconds(F.lit(1_500_000_000) + F.xxhash64("order_id") % 1_000_000).alias("order_purchase_timestamp"),
    )
    typed = intermediate.order_customers(orders, base.select("customer_id", "customer_unique_id"))
    tasks, split = hot_tasks(typed, F.col("customer_unique_id") == "hot")
    assert split and tasks > 1
    assert typed.filter("customer_type = 'new'").count() == typed.select("customer_unique_id").distinct().count()
