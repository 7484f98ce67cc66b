"""The search for repeated keys against plain grouping."""

import random

import pytest
from pyspark.sql import functions as F

from feira.operators import intermediate, model_tests
from feira.plans import duplicates
from feira.plans.duplicates import Key, Repeated, repeated_in, repeated_keys
from feira.registry import World
from frames import make, rows


def by_grouping(data, at, nulls):
    counted, rows_ = {}, 0
    for r in data:
        key = tuple(r[i] for i in at)
        if nulls == "none" and None in key or nulls == "some" and set(key) == {None}:
            continue
        rows_ += 1
        counted[key] = counted.get(key, 0) + 1
    again = [n for n in counted.values() if n > 1]
    return Repeated(rows_, len(again), sum(again))


KEYS = [((0,), "none"), ((0,), "all"), ((0, 1), "some"), ((1, 2), "all"), ((2,), "none"), ((0, 1, 2), "some")]


def some(n, seed):
    draw = random.Random(seed)
    return [(draw.choice([None, "a", "b", str(draw.randrange(n + 1))]), draw.choice([None, 1, draw.randrange(n + 1)]),
             draw.choice([None, 0.0, -0.0, draw.random()])) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 300])
@pytest.mark.parametrize("one_hash", [False, True])
def test_equals_plain_grouping(spark, monkeypatch, n, one_hash):
    """Also when all keys have one hash, so that the hashes tell nothing."""
    if one_hash:
        monkeypatch.setattr(duplicates.F, "xxhash64", lambda *c: F.length(F.concat_ws("", *[F.lit("")])).cast("bigint"))
    data = some(n, n)
    df = make(spark, data, "t string, i bigint, d double")
    names = ("t", "i", "d")
    got = repeated_keys(df, [Key(tuple(names[i] for i in at), nulls) for at, nulls in KEYS])
    assert got == [by_grouping(data, at, nulls) for at, nulls in KEYS]


def test_unique_tables_are_read_once_for_all_their_keys(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    base = spark.range(1000).select(F.col("id"), F.col("id").cast("string").alias("s"), F.lit(1).alias("one"))
    df = base.mapInArrow(look, base.schema)
    assert repeated_keys(df, [Key(("id",)), Key(("s",), "none"), Key(("id", "one"))]) == [Repeated(1000, 0, 0)] * 3
    assert seen.value == 1000
    assert repeated_in({"x": (df, [Key(("one",))])}) == {"x": [Repeated(1000, 1, 1000)]}


def test_declared_unique_columns_share_a_pass(spark, folder, monkeypatch):
    w, asked = World(spark, folder), []

    def models(name, columns):
        asked.append(name)
        return w.models(name, columns)

    out = model_tests.dq_unique(models)
    assert sorted(asked) == sorted(model_tests.UNIQUE)
    assert len(rows(out)) == sum(map(len, model_tests.UNIQUE.values()))


def test_compact_keys_are_equal_for_equal_keys_only(spark):
    digest = "0123456789abcdef0123456789abcdef"
    texts = ["", "a", "a" * 15, "a" * 16, "\x00" + "a" * 15, "\x00" + "a" * 16, digest, digest.upper(), digest[:-1] + "g", digest[:-1]]
    texts += [bytes.fromhex("61" * 16).decode(), "61" * 16, "é" * 8, "é" * 16]
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(t,) for t in texts], "k string").select(model_tests.compact(F.col("k")).alias("c"))
    assert df.distinct().count() == len(texts)


@pytest.mark.parametrize("limit", [0, 10])
def test_many_suspects_are_grouped_without_a_join(spark, monkeypatch, limit):
    monkeypatch.setattr(duplicates, "BROADCAST_ROWS", limit)
    data = some(300, 7) + [("0123456789abcdef" * 2, 1, 0.0)] * 2 + [("0123456789ABCDEF" * 2, 1, 0.0), ("a" * 16, None, None)]
    got = repeated_keys(make(spark, data, "t string, i bigint, d double"), [Key(("t", "i", "d")[a:b], n) for a, b, n in SPANS])
    assert got == [by_grouping(data, range(a, b), n) for a, b, n in SPANS]


SPANS = [(0, 1, "none"), (0, 1, "all"), (0, 2, "some"), (1, 3, "all"), (2, 3, "none"), (0, 3, "some")]


def plainly(w):
    """Repeated values of every declared column in the models built whole."""
    out = []
    for model, columns in model_tests.UNIQUE.items():
        df = w.cat.model(model)
        out += [(model, c, df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1").count()) for c in columns]
    return sorted(out, key=str)


@pytest.mark.parametrize("again", ["customers", "orders", "products"])
def test_repeated_keys_of_lookups_count_in_the_models_that_use_them(spark, folder, again):
    """A model is only taken without its joins where these cannot repeat its rows."""
    w = World(spark, folder)
    given = w.cat.entity

    def entity(name):
        df = given(name)
        if name != again:
            return df
        key = {"customers": "customer_id", "orders": "order_id", "products": "product_id"}[name]
        return df.unionByName(df.filter(F.length(key) <= 3))

    w.cat.entity = entity
    got = rows(model_tests.dq_unique(w.models, w.unjoined))
    assert got == plainly(w)
    assert {m for m, _, n in got if n} >= {f"stg_{again}", {"products": "fact_order_items"}.get(again, "fact_orders")}


def test_sound_lookups_are_not_joined(spark, folder, monkeypatch):
    w, asked = World(spark, folder), []
    monkeypatch.setattr(intermediate, "range_layout", None)
    model_tests.dq_unique(w.models, lambda name, columns: asked.append(name) or w.unjoined(name, columns))
    assert sorted(asked) == sorted(model_tests.LOOKED_UP)
    joined = [m for m in ("int_customer_orders", "int_orders", "fact_payments", "fact_reviews")
              if "Join" in w.unjoined(m, model_tests.UNIQUE[m])._jdf.queryExecution().optimizedPlan().toString()]
    assert not joined
