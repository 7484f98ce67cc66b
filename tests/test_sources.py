"""Readers, writers and the report contract."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.operators import contract, fingerprint, reports
from feira.plans.build import mart_tables, publish_marts
from feira.plans.workspace import shared_dir
from feira.registry import World
from feira.schemas import ENTITIES
from feira.sources import files, sinks, versions
from frames import make, money, rows


def test_csv_with_byte_order_mark_other_order_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    header = "order_id,review_id,review_score,review_comment_title,review_comment_message,review_creation_date," \
             "review_answer_timestamp,_loaded_at"
    line = 'o1,r1,5,,"two ""quoted""\nlines, and more ",2018-01-01 00:00:00,2018-01-02 00:00:00,x'
    path.write_text("﻿" + header + "\n" + line + "\n", encoding="utf-8")
    df = files.read_csv_entity(spark, ENTITIES["reviews"], str(path))
    assert df.columns == list(ENTITIES["reviews"].columns)
    row = df.collect()[0]
    assert (row["review_id"], row["order_id"], row["review_comment_title"]) == ("r1", "o1", None)
    assert row["review_comment_message"] == 'two "quoted"\nlines, and more '


def test_csv_without_a_declared_column_is_refused(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_city,seller_state\n1,a,SP\n")
    with pytest.raises(ValueError, match="seller_zip_code_prefix"):
        files.read_csv_entity(spark, ENTITIES["sellers"], str(path))


SELLERS = ENTITIES["sellers"]


def test_csv_files_are_matched_by_their_own_header(spark, tmp_path):
    """Another order of columns, an extra column, a byte-order mark, an empty file: every value finds its column."""
    (tmp_path / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,01000,x,SP\n")
    (tmp_path / "b.csv").write_text('\ufeff"seller_state",seller_city,note,note,seller_id,seller_zip_code_prefix\r\nRJ,"y, z",n,,2,02000\r\n')
    (tmp_path / "c.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n3,03000,,MG\n")
    (tmp_path / "d.csv").write_text("")
    got = rows(files.read_csv_entity(spark, SELLERS, str(tmp_path)))
    assert got == [("1", "01000", "x", "SP"), ("2", "02000", "y, z", "RJ"), ("3", "03000", None, "MG")]
    assert [len(f) for f in files.csv_headers(spark, str(tmp_path)).values()] == [2, 1]
    assert files.csv_quarantine(spark, SELLERS, str(tmp_path)).count() == 0


def test_bad_records_are_listed_and_not_fatal(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,01000,x,SP\n2,short\n3,03000,x,SP,extra\n4,04000,y,RJ\n")
    (tmp_path / "b.csv").write_text("seller_state,seller_city,seller_zip_code_prefix,seller_id\nSP,x\nSP,x,05000,5\n")
    assert [r[0] for r in rows(files.read_csv_entity(spark, SELLERS, str(tmp_path)))] == ["1", "4", "5"]
    bad = rows(files.csv_quarantine(spark, SELLERS, str(tmp_path)))
    assert [(e, f.rsplit("/", 1)[1], r) for e, f, r in bad] == [
        ("sellers", "a.csv", "2,short"), ("sellers", "a.csv", "3,03000,x,SP,extra"), ("sellers", "b.csv", "SP,x"),
    ]
    narrow = files.read_csv_entity(spark, SELLERS, str(tmp_path)).select("seller_id")
    assert [r[0] for r in rows(narrow)] == ["1", "4", "5"] and narrow.count() == 3


def test_csv_without_files_or_with_a_repeated_column_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no file with a header"):
        files.read_csv_entity(spark, SELLERS, str(tmp_path))
    (tmp_path / "b.csv").write_text("seller_id,seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
    with pytest.raises(ValueError, match="repeats"):
        files.read_csv_entity(spark, SELLERS, str(tmp_path))


def test_json_array_file_and_column(spark, tmp_path):
    text = '[{"date":"2017-01-01","name":"a","type":"national","weekday":"domingo"},{"date":"2017-04-21","name":"b"}]'
    (tmp_path / "2017.json").write_text(text)
    want = [("2017-01-01", "a", "national", "domingo"), ("2017-04-21", "b", None, None)]
    assert rows(files.read_json_records(spark, str(tmp_path / "2017.json"))) == want
    column = make(spark, [(text,)], "doc string")
    assert rows(files.json_records(column, F.col("doc"))) == want


def test_drifted_records_survive_and_are_reported(spark, tmp_path):
    whole = '{"date":"2017-01-01","name":"a","type":"national","weekday":"domingo"}'
    documents = {
        "2017.json": f'[{whole}, {{"date":"2017-04-21","name":"b","type":null,"weekday":"x","state":"SP","note":1}}, '
                     '{"name":"c"}, 7, {"date":20170501,"name":{"pt":"d"},"type":"t","weekday":"w"}]',
        "2018.json": '{"not": "an array"}',
        "2019.json": "[{broken",
        "2020.json": "[]",
    }
    for name, text in documents.items():
        (tmp_path / name).write_text(text)
    got = rows(files.read_json_records(spark, str(tmp_path)))
    assert got == sorted([
        ("2017-01-01", "a", "national", "domingo"), ("2017-04-21", "b", None, "x"), (None, "c", None, None),
        (None, None, None, None), ("20170501", '{"pt":"d"}', "t", "w"),
    ], key=str)
    drift = {(r["file"].rsplit("/", 1)[1], r["position"]): r for r in files.json_drift_of_files(spark, str(tmp_path)).collect()}
    assert set(drift) == {("2017.json", 1), ("2017.json", 2), ("2017.json", 3), ("2018.json", None), ("2019.json", None)}
    assert drift["2017.json", 1]["extra"] == ["note", "state"] and drift["2017.json", 1]["missing"] == []
    assert drift["2017.json", 2]["missing"] == ["date", "type", "weekday"] and drift["2017.json", 3]["record"] == "7"
    assert drift["2019.json", None]["record"] == "[{broken"
    typed = T.StructType([T.StructField("date", T.LongType()), T.StructField("name", T.StringType())])
    column = make(spark, [('[{"date":1,"name":"x"},{"date":"soon","name":"y"}]',)], "doc string")
    assert rows(files.json_records(column, F.col("doc"), typed)) == [(1, "x"), (None, "y")]
    assert [(r["position"], r["unlike"]) for r in files.json_drift(column, F.col("doc"), typed).collect()] == [(1, ["date"])]


def test_dataset_names():
    assert files.resolve_dataset("staging", "prod") == "staging"
    assert files.resolve_dataset("mart") == "mart_dev"
    with pytest.raises(ValueError):
        files.resolve_dataset("other")


def test_published_marts_serve_the_reports(spark, folder, tmp_path):
    """Same answer as from the raw tables, and the window reads only its month folders."""
    w = World(spark, folder)
    tables = publish_marts(
        w.cat, str(tmp_path), names=["dim_date", "dim_geolocation", "dim_customer", "fact_orders", "fact_order_items"]
    )
    report = reports.holiday_impact(
        tables.fact_orders(), tables.fact_order_items(), tables.dim_date, w.cat.settings
    )
    assert rows(report) == rows(w.reports["holiday_impact"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan
    full = sinks.read_mart(spark, "fact_orders", str(tmp_path))
    assert rows(full) == rows(w.cat.fact_orders())


def joined_by_order(tables):
    items = tables.fact_order_items().groupBy("order_key").agg(F.sum("price").alias("gmv"))
    return tables.fact_orders().join(items, "order_key", "left").select("order_key", "order_status", "gmv")


def test_facts_meet_by_order_without_a_shuffle(spark, folder, tmp_path):
    w = World(spark, folder)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tables = publish_marts(w.cat, str(tmp_path), names=["fact_orders", "fact_order_items"], buckets=8)
        joined = joined_by_order(tables)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        got = rows(joined)
        assert got == rows(joined_by_order(w.cat))
        # another session knows the layout from the log alone
        publication = versions.current(spark, sinks.mart_folder(str(tmp_path)))
        for name in ("fact_orders", "fact_order_items"):
            spark.sql(f"DROP TABLE {versions.bucketed_name(name, publication.tables[name])}")
        again = joined_by_order(mart_tables(w.cat, str(tmp_path)))
        assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString() and rows(again) == got
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_a_failed_publication_leaves_the_old_one_in_force(spark, folder, tmp_path):
    w, root = World(spark, folder), str(tmp_path)
    names = ["dim_product", "dim_geolocation", "fact_payments"]
    publish_marts(w.cat, root, names=names)
    before = {n: rows(sinks.read_mart(spark, n, root)) for n in names}
    kept = versions.current(spark, sinks.mart_folder(root))

    class Broken:
        spark, settings, stg_orders = w.spark, w.cat.settings, w.cat.stg_orders

        def model(self, name):
            bad = F.when(F.col("payment_value") >= 0, F.raise_error(F.lit("no"))).otherwise("x")
            return w.cat.fact_payments.withColumn("payment_type", bad) if name == "fact_payments" else w.cat.model(name).limit(1)

    with pytest.raises(Exception, match="no"):
        publish_marts(Broken(), root, names=names)
    assert versions.current(spark, sinks.mart_folder(root)) == kept
    assert {n: rows(sinks.read_mart(spark, n, root)) for n in names} == before


def test_a_publication_of_some_tables_keeps_the_others(spark, folder, tmp_path):
    w, root = World(spark, folder), str(tmp_path)
    publish_marts(w.cat, root, names=["dim_product", "dim_geolocation"])
    first = versions.current(spark, sinks.mart_folder(root))
    old = sinks.read_mart(spark, "dim_geolocation", root)  # a reader that has begun
    publish_marts(w.cat, root, names=["dim_geolocation", "fact_payments"], buckets=2)
    second = versions.current(spark, sinks.mart_folder(root))
    assert second.number == 2 and second.tables["dim_product"] == first.tables["dim_product"]
    assert second.tables["dim_geolocation"] != first.tables["dim_geolocation"] and second.buckets == {"fact_payments": 2}
    assert rows(old) == rows(sinks.read_mart(spark, "dim_geolocation", root))
    with pytest.raises(ValueError, match="has not been published"):
        sinks.read_mart(spark, "fact_reviews", root)


def test_fingerprint_sees_every_cell_and_no_order(spark):
    data = [(1, "a", money("1.5"), None), (2, None, money("0"), True), (2, None, money("0"), True)]
    schema = "k int, t string, v decimal(37,9), b boolean"

    def of(df):
        return fingerprint.table_fingerprint(df, "x").collect()

    base = of(make(spark, data, schema))
    assert base == of(make(spark, data[::-1], schema).repartition(3).select("b", "v", "k", "t"))
    for at, other in ((0, 3), (1, "b"), (2, money("1.500000001")), (3, False)):
        changed = [tuple(other if i == at else x for i, x in enumerate(data[0])), *data[1:]]
        assert of(make(spark, changed, schema)) != base
    assert of(make(spark, data[:2], schema)) != base and of(make(spark, [], schema))[0]["rows"] == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_contract_faults():
    expected = ["a", "b", "c"]
    assert not any(contract.column_faults(["a", "b", "c"], expected).values())
    assert contract.column_faults(["a", "c", "b"], expected)["wrong_order"]
    assert contract.column_faults(["a", "b"], expected)["missing_columns"] == ["c"]
    faults = contract.column_faults(["a", "b", "c", "c", "d"], expected)
    assert faults["unexpected_columns"] == ["d"] and faults["duplicate_columns"] == ["c"]


def test_empty_report_fails_the_contract(spark):
    empty = make(spark, [], "day_type string, order_count bigint, gmv double, avg_order_value double")
    row = contract.report_contract({"holiday_impact": empty}).collect()[0]
    assert row["rows"] == 0 and row["success"] is False


def test_list_lengths_must_be_positive(spark):
    with pytest.raises(ValueError):
        reports.positive("limit", 0)


def test_csv_files_lead_to_the_same_marts(spark, folder, tmp_path):
    """Text all the way from CSV: every strict and lenient cast of staging is exercised."""
    from feira.plans.catalog import Catalog
    from feira.registry import as_text

    w = World(spark, folder)
    for name in ENTITIES:
        sinks.write_csv(as_text(w.raw.entity(name)), f"{tmp_path}/{name}.csv")
    raw = files.read_csv_folder(spark, str(tmp_path))
    cat = Catalog(spark, raw.__getitem__, w.raw.holidays, w.cat.settings)
    assert rows(cat.fact_orders()) == rows(w.cat.fact_orders())
    assert rows(cat.fact_order_items()) == rows(w.cat.fact_order_items())
    for name in ("dim_customer", "dim_product", "dim_seller", "fact_payments", "fact_reviews"):
        assert rows(cat.model(name)) == rows(w.cat.model(name)), name


def test_published_files_are_held_against_the_contract(spark, tmp_path):
    good = make(spark, [("x", 1, 2.0, 3.0)], "day_type string, order_count bigint, gmv double, avg_order_value double")
    want = contract.REPORT_COLUMNS["holiday_impact"]
    expected = {n: want for n in ("whole", "empty", "absent", "turned", "mixed", "extra")}
    sinks.write_report("whole", good, str(tmp_path))
    sinks.write_report("empty", good.limit(0), str(tmp_path))
    sinks.write_report("turned", good.select(*reversed(want)), str(tmp_path))
    sinks.write_report("extra", good.withColumn("note", F.lit("n")).drop("gmv"), str(tmp_path))
    sinks.write_report("mixed", good, str(tmp_path))
    (tmp_path / "mixed" / "z.csv").write_text("day_type,day_type,order_count,gmv,avg_order_value\na,a,1,1,1\n")
    got = {r["report"]: r for r in contract.published_contract(spark, str(tmp_path), expected).collect()}
    assert {n for n, r in got.items() if r["success"]} == {"whole"}
    assert got["empty"]["rows"] == 0 and got["turned"]["wrong_order"] and got["mixed"]["duplicate_columns"] == "day_type"
    assert got["absent"]["missing_columns"] == ", ".join(want)
    assert (got["extra"]["missing_columns"], got["extra"]["unexpected_columns"]) == ("gmv", "note")


def test_a_changed_cell_of_a_report_shows(spark, tmp_path):
    data = make(spark, [("a, \"b\"", money("1.50"), None), ("", money("2"), True)], "t string, v decimal(38,9), b boolean")
    sinks.write_report("r", data, str(tmp_path))

    def same():
        back = sinks.read_report(spark, "r", str(tmp_path))
        pair = [fingerprint.table_fingerprint(sinks.as_text(d), "r").collect() for d in (data, back)]
        return pair[0] == pair[1]

    assert same()
    for part in (tmp_path / "r").glob("*.csv"):
        part.write_text(part.read_text().replace("1.500000000", "1.500000001"))
    for check in (tmp_path / "r").glob(".*.crc"):
        check.unlink()
    assert not same()
