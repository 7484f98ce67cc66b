"""Checks, coercion and gate on small fixtures."""

import glob
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feira.operators import expectations as ex
from feira.operators import model_tests, profiling, sketches
from feira.operators.checked_load import load_checked
from feira.registry import ROW_BASELINES, World
from feira.sources.versions import Draft
from frames import ITEMS, ORDERS, PAYMENTS, make, money, order, rows, ts


def run(df, *checks):
    return [r.asDict() for part in ex.evaluate(df, list(checks)) for r in part.collect()]


def test_denominators_and_tolerance(spark):
    df = make(spark, [(1,), (2,), (9,), (None,)], "x int")
    not_null, inside, strict = run(
        df,
        ex.Check("critical", "t", "not_null", "x", mostly=0.75),
        ex.Check("critical", "t", "between", "x", low=1, high=5, mostly=0.7),
        ex.Check("critical", "t", "between", "x", low=1, strict_low=True),
    )
    assert (not_null["success"], not_null["unexpected_count"], not_null["unexpected_percent"]) == (True, 1, 25.0)
    assert (inside["success"], inside["unexpected_count"]) == (False, 1)  # 2 of 3 present values
    assert abs(inside["unexpected_percent"] - 100 / 3) < 1e-9
    assert strict["unexpected_count"] == 1


def test_pairs_skip_missing_sides(spark):
    df = make(
        spark, [(ts("2018-01-02"), ts("2018-01-01")), (ts("2018-01-01"), ts("2018-01-01")), (None, ts("2018-01-01")),
                (ts("2018-01-01"), None), (ts("2018-01-01"), ts("2018-01-03"))],
        "a timestamp, b timestamp",
    )
    (got,) = run(df, ex.Check("observation", "t", "pair_greater", "a", other="b", mostly=0.6))
    assert (got["success"], got["unexpected_count"], got["column"]) == (True, 1, ex.NO_COLUMN)


def test_aggregate_checks(spark):
    df = make(spark, [(Decimal("1.00"),), (Decimal("2.00"),), (None,)], "x decimal(18,2)")
    mean, total, count, empty = run(
        df,
        ex.Check("observation", "t", "mean_between", "x", low=1.5, high=1.5),
        ex.Check("mart", "t", "sum_between", "x", low=2, high=2.5),
        ex.row_count_check("t", 3),
        ex.Check("observation", "t", "mean_between", "x", low=9, high=9.5),
    )
    assert mean["success"] and mean["observed_value"] == 1.5
    assert not total["success"] and total["observed_value"] == 3.0
    assert count["success"] and count["detail"] == ">= 2 and <= 3"  # bounds cut to whole rows
    assert not empty["success"]


def test_compound_unique_marks_every_member(spark):
    df = make(spark, [("a", 1), ("a", 1), ("a", 1), ("b", 1), ("c", None), (None, None)], "x string, y int")
    (got,) = run(df, ex.Check("observation", "t", "compound_unique", columns=("x", "y"), mostly=0.4))
    assert (got["unexpected_count"], got["unexpected_percent"], got["success"]) == (3, 60.0, True)


def test_empty_table_passes_row_checks(spark):
    df = make(spark, [], "x int")
    (got,) = run(df, ex.Check("critical", "t", "not_null", "x"))
    assert got["success"] and got["unexpected_percent"] is None


def test_zip_coercion(spark):
    df = make(spark, [("1037",), ("01037",), ("abc",), ("123456",), (None,)], "customer_zip_code_prefix string")
    out = ex.coerce({"customers": df})["customers"]
    assert sorted(str(r[0]) for r in out.collect()) == ["01037", "01037", "123456", "None", "None"]
    assert rows(ex.dq_coerce({"customers": df})) == [("customers", "customer_zip_code_prefix", 1)]
    (got,) = run(out, ex.Check("critical", "customers", "regex", "customer_zip_code_prefix", pattern=ex.ZIP))
    assert got["unexpected_count"] == 1


def test_status_and_delivery_date(spark):
    orders = make(spark, [
        order("a", status="delivered", delivered="2018-01-02 00:00:00"), order("b", status="delivered"),
        order("c", status="shipped", delivered="2018-01-02 00:00:00"), order("d", status=None),
        order("e", status=None, delivered="2018-01-02 00:00:00"),
    ], ORDERS)
    got = dict(rows(ex.dq_status_date_consistency(orders), "order_id", "delivery_date_matches_status"))
    assert got == {"a": True, "b": False, "c": False, "d": True, "e": False}


def test_shipping_after_purchase(spark):
    items = make(spark, [
        ("o1", 1, "p", "s", ts("2018-01-02 00:00:00"), money("1.00"), money("0.00")),
        ("o1", 2, "p", "s", ts("2017-12-31 00:00:00"), money("1.00"), money("0.00")),
        ("o1", 3, "p", "s", None, money("1.00"), money("0.00")),
        ("zz", 1, "p", "s", ts("2017-12-31 00:00:00"), money("1.00"), money("0.00")),
    ], ITEMS)
    out = ex.dq_shipping_after_purchase(items, make(spark, [order("o1")], ORDERS))
    assert rows(out, "order_id", "order_item_id", "shipping_after_purchase") == [
        ("o1", 1, True), ("o1", 2, False), ("o1", 3, True), ("zz", 1, True)
    ]


def test_reconciliation_allows_one_cent(spark):
    items = make(spark, [
        ("o1", 1, "p", "s", None, money("10.00"), money("1.00")), ("o2", 1, "p", "s", None, money("10.00"), money("1.00")),
        ("o3", 1, "p", "s", None, money("1.00"), money("1.00")),
    ], ITEMS)
    payments = make(spark, [
        ("o1", 1, "boleto", 1, money("5.00")), ("o1", 2, "boleto", 1, money("6.01")), ("o2", 1, "boleto", 1, money("11.02")),
        ("o4", 1, "boleto", 1, money("1.00")),
    ], PAYMENTS)
    out = ex.dq_order_reconciliation(items, payments)
    assert rows(out, "order_id", "payment_matches_items") == [("o1", True), ("o2", False)]


def test_declared_numbers_of_checks():
    checks = ex.staging_checks()
    assert sum(c.group == ex.CRITICAL for c in checks) == 30
    assert sum(c.group == ex.OBSERVATION for c in checks) == 23 + 9
    assert len(ex.mart_checks()) == 4
    assert sum(map(len, model_tests.NOT_NULL.values())) == 53
    assert sum(map(len, model_tests.UNIQUE.values())) == 24
    assert len(model_tests.RELATIONSHIPS) == 23
    assert len(model_tests.EQUAL_ROWCOUNT) == 6


def test_gate_and_summary(spark):
    schema = "group string, table string, success boolean"
    details = make(spark, [
        ("critical", "orders", False), ("critical", "orders", True), ("observation", "orders", False),
        ("mart", "fact_orders", False),
    ], schema)
    assert dict(rows(ex.dq_gate(details), "group", "blocking")) == {
        "critical": True, "observation": False, "mart": False,
    }
    assert dict(rows(ex.dq_gate(details, False, True), "group", "blocking")) == {
        "critical": False, "observation": False, "mart": True,
    }
    summary = rows(ex.dq_suite_run(spark, details, ["orders", "sellers"]), "group", "table", "success")
    assert summary == [
        ("critical", "orders", False), ("critical", "sellers", True), ("observation", "orders", False),
        ("observation", "sellers", True),
    ]


def test_structural_tests(spark):
    child = make(spark, [("a",), ("a",), ("b",), ("x",), ("x",), (None,)], "k string")
    parent = make(spark, [("a",), ("b",), ("b",), (None,)], "k string")
    assert model_tests.relationships(child, "k", model_tests.key_set(parent, "k")).collect()[0][0] == 2
    assert model_tests.unique(child, "m", ["k"]).collect()[0]["failures"] == 2
    assert model_tests.accepted_values(child, "m", "k", ["a", "b"]).collect()[0]["failures"] == 2
    assert model_tests.not_null(child, "m", ["k"]).collect()[0]["failures"] == 1


def test_profiles(spark):
    df = make(spark, [("a", 1), ("a", 1), ("b", None), (None, None), (None, None)], "x string, n int")
    columns = {r["column"]: r for r in profiling.profile_columns({"t": df}).collect()}
    assert (columns["x"]["null_count"], columns["x"]["unique_count"], columns["x"]["null_pct"]) == (2, 2, 40.0)
    assert rows(profiling.profile_missing({"t": df})) == [("t", "n", 3, money("60.00")), ("t", "x", 2, money("40.00"))]
    assert rows(profiling.profile_duplicates({"t": df})) == [("t", 2, money("40.00"))]
    keys = profiling.profile_keys({"t": df}, {"t": ("x", "n")}).collect()[0]
    assert (keys["is_unique"], keys["duplicate_count"]) == (False, 2)


def test_profiles_in_turns_are_exact(spark):
    """Columns counted one after the other, and in parts of their values, tell what one grouping of all cells tells."""
    key = F.md5(F.col("id").cast("string"))
    df = spark.range(3000).select(
        F.col("id").alias("number"), key.alias("key"), F.upper(key).alias("upper"), F.unhex(key).alias("bytes"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 700).alias("some"), F.lit(None).cast("int").alias("none"),
        (F.col("id") % 2 == 0).alias("flag"), (F.col("id") / 7).cast("decimal(37,9)").alias("money"), F.lit("").alias("empty"),
    ).drop("bytes")
    whole = profiling.profile_columns({"t": df})
    expected = {("t", c): (3000, 3000 if c in ("number", "key", "upper", "money") else 700) for c in df.columns}
    moved = []
    kept = profiling._distinct

    def watched(frame, columns, parts=1, part=0):
        found = kept(frame, columns, parts, part)
        moved.append((columns, parts, part, sum(found.values())))
        return found

    profiling._distinct = watched
    try:
        turned = profiling.profile_columns({"t": df}, expected, together=21_000)
    finally:
        profiling._distinct = kept
    assert rows(turned) == rows(whole) and turned.dtypes == whole.dtypes
    assert max(n for *_, n in moved) < 2000
    assert {c[0]: parts for c, parts, *_ in moved if parts > 1} == {"key": 3, "upper": 3, "number": 2, "money": 2}
    assert {part for c, parts, part, _ in moved if c == ["key"]} == {0, 1, 2}
    empty = df.limit(0)
    assert rows(profiling.profile_columns({"t": empty}, expected, together=21_000)) == rows(profiling.profile_columns({"t": empty}))


def test_distribution_matches_pandas(spark):
    import pandas as pd

    data = [(i % 17 if i % 9 else None, 1 + i % 4, Decimal(i * i).scaleb(-2)) for i in range(57)]
    df = make(spark, data, "recency bigint, frequency bigint, monetary decimal(28,2)")
    got = {r["metric"]: r for r in profiling.profile_distribution(df).collect()}
    for i, metric in enumerate(("recency", "frequency", "monetary")):
        want = pd.Series([float(r[i]) for r in data if r[i] is not None]).describe(percentiles=[0.5, 0.75, 0.9, 0.95])
        names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "max": "max",
                 "50%": "p50", "75%": "p75", "90%": "p90", "95%": "p95"}
        for theirs, ours in names.items():
            assert abs(want[theirs] - got[metric][ours]) < 1e-9, (metric, theirs)


def test_a_load_reads_each_table_once_for_writing_and_checking(spark, folder, tmp_path):
    """Counted rows: every source row is seen by one evaluation only; results equal those of separate checks."""
    w = World(spark, folder)
    frames = ex.layer_frames(w.staged)
    checks = ex.layer_checks("staging", ROW_BASELINES)
    reads = {}
    counted = {}
    for name, df in frames.items():
        seen = reads[name] = spark.sparkContext.accumulator(0)

        def look(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        counted[name] = df.mapInArrow(look, df.schema)
    draft = Draft(spark, str(tmp_path))
    publication, details = load_checked(counted, checks, draft)
    for name, df in frames.items():
        assert reads[name].value == df.count(), name
        assert rows(spark.read.parquet(publication.tables[name])) == rows(df), name
    columns = ("group", "table", "expectation", "column", "detail", "success", "observed_value", "unexpected_count")
    apart = ex.run_checks(ex.check_frames(w.staged), checks)
    assert rows(details, *columns) == rows(apart, *columns)


def test_raw_layer_has_its_own_tables_names_and_baselines(spark, folder):
    w = World(spark, folder)
    asked = []

    def read(name):
        asked.append(name)
        return w.raw.entity(name)

    frames = ex.read_layer(read, "raw")
    assert "holidays" not in frames and set(asked) == set(frames) == set(ex.RAW_ROWS)
    assert frames["orders"].columns == w.raw.entity("orders").columns
    checks = ex.layer_checks("raw")
    assert {c.table for c in checks} == {*frames, "order_reconciliation"}
    rowed = {c.table: c.low for c in checks if c.kind == "row_count_between"}
    assert rowed == {t: int(n * 0.95) for t, n in ex.RAW_ROWS.items()}
    assert ex.run_checks(ex.check_frames(frames, "raw"), checks).count() == len(checks)
    with pytest.raises(ValueError, match="unknown layer"):
        ex.read_layer(read, "gold")


def test_a_load_of_no_rows_has_results(spark, tmp_path):
    empty = {"sellers": make(spark, [], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")}
    checks = [c for c in ex.layer_checks("raw") if c.table == "sellers"]
    _, details = load_checked(empty, checks, Draft(spark, str(tmp_path)))
    got = {r["expectation"]: r["success"] for r in details.collect()}
    assert got == {"in_set": True, "regex": True, "row_count_between": False, "not_null": True}


def test_sketches_of_a_few_months_at_a_time_are_the_same(spark, tmp_path):
    fact = spark.range(5_000).select(
        F.col("id"), (F.col("id") % 97).alias("few"),
        F.when(F.col("id") % 50 != 7, 201801 + F.col("id") % 4).cast("int").alias("month_key"),
    )
    got = {}
    for together in (5_000, 10**9):
        path = str(tmp_path / str(together))
        sketches.update_sketches(fact, "fact", path, together=together)
        sketches.update_sketches(fact, "fact", path, together=together)
        kept = sketches.kept_sketches(spark, path)
        got[together] = rows(sketches.merged_profile(kept)), kept.count(), len(glob.glob(f"{path}/*.parquet"))
    assert got[5_000][:2] == got[10**9][:2] and got[5_000][1] == 5 * 2
    assert got[5_000][2] > 3


def test_new_months_are_merged_and_old_ones_stay_unread(spark, tmp_path):
    base = spark.range(60_000).select(
        F.col("id"), (F.col("id") % 997).cast("string").alias("few"), F.when(F.col("id") % 3 == 0, F.col("id") % 20_000).alias("some"),
        F.when(F.col("id") % 50 != 7, 201801 + F.col("id") % 4).cast("int").alias("month_key"),
    )
    base.write.partitionBy("month_key").parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    path = str(tmp_path / "sketches")
    assert sketches.kept_sketches(spark, path).count() == 0
    sketches.update_sketches(fact.filter("month_key < 201803"), "fact", path)
    late = sketches.new_periods(fact, "fact", path)
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(NOT month_key" in plan and late.count() == fact.filter("month_key >= 201803 OR month_key IS NULL").count()
    sketches.update_sketches(fact, "fact", path)
    assert sketches.new_periods(fact, "fact", path).count() == 0
    got = {r["column"]: r for r in sketches.merged_profile(sketches.kept_sketches(spark, path)).collect()}
    for column in ("id", "few", "some"):
        exact = fact.agg(F.count_distinct(column), F.count("*"), F.count_if(F.col(column).isNull())).first()
        assert abs(got[column]["unique_estimate"] - exact[0]) <= 0.02 * exact[0]
        assert (got[column]["rows"], got[column]["null_count"]) == (exact[1], exact[2])
