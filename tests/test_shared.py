"""What several reports or profiles read is computed once."""

from feira.operators import model_tests, profiling
from feira.registry import QUERIES, World
from feira.schemas import ENTITIES
from feira.sources.driver_tables import DriverTables


def read(df):
    return {path.rsplit("/", 1)[-1] for path in df.inputFiles()}


def test_reports_share_facts_and_customers(spark, folder):
    for name, df in World(spark, folder).reports.items():
        assert not {"lineitem.parquet", "customer.parquet"} & read(df), name


def test_profiles_share_joined_tables(spark, folder):
    profiles = World(spark, folder).profiles
    for name in ("profile_tables", "profile_columns", "profile_missing"):
        assert "customer.parquet" not in read(profiles[name])


def test_staging_is_built_from_the_loaded_raw_tables(spark, folder, monkeypatch):
    built, entity = [], DriverTables.entity
    monkeypatch.setattr(DriverTables, "entity", lambda self, name: built.append(name) or entity(self, name))
    QUERIES["src_layer_frames"](World(spark, folder))
    assert sorted(built) == sorted(ENTITIES)


def test_relationships_read_each_model_once(spark, folder):
    asked, world = [], World(spark, folder)
    model_tests.dq_relationships(lambda name, columns: asked.append(name) or world.models(name, columns))
    assert sorted(asked) == sorted({m for child, _, parent, _, _ in model_tests.RELATIONSHIPS for m in (child, parent)})


def test_profiled_columns_travel_as_numbers(spark, folder):
    profile = profiling.profile_columns({"orders": World(spark, folder).raw.entity("orders")})
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(at" in plan and "hashpartitioning(column" not in plan


def test_gate_checks_the_marts_of_the_loaded_layer(spark, folder):
    world = World(spark, folder)
    assert not {"lineitem.parquet", "orders.parquet", "customer.parquet"} & read(world.loaded_mart_details)
    assert sorted(world.loaded_mart_details.collect()) == sorted(world.mart_details.collect())
