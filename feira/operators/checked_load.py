"""Load and check in one pass: a table's checks are measured while it is written.

``DataFrame.observe`` attaches the aggregates to the write itself, so the rows are read once for both. Checks that need
another table or a grouping read the columns they need of the written tables afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feira.operators import expectations
from feira.operators.expectations import Check
from feira.operators.model_tests import as_rows, stacked
from feira.sources.versions import Draft, Publication

# checks of these (table, column) pairs compare two tables
_ACROSS = {("order_items", "shipping_after_purchase")}


def _while_writing(check: Check, tables: Iterable[str]) -> bool:
    return check.table in tables and check.kind != "compound_unique" and (check.table, check.column) not in _ACROSS


def write_observed(name: str, df: DataFrame, checks: list[Check], path: str) -> DataFrame | None:
    """Write ``df`` as it is and return the result rows of its checks, None without any.

    The checks see the coerced columns; the original row travels beside them and is what is written.
    """
    if not checks:
        df.write.parquet(path)
        return None
    beside = expectations.row_wise(name, df.withColumn("__row", F.struct(*df.columns)))
    watched = Observation()
    measures = [m for i, c in enumerate(checks) for m in expectations.measures(c, i)]
    beside.observe(watched, *measures).select("__row.*").write.parquet(path)
    kinds = ", ".join(f"n{i} bigint, u{i} bigint, v{i} double" for i in range(len(checks)))
    measured = df.sparkSession.createDataFrame([watched.get], kinds)
    return as_rows(measured, [expectations.result(c, F.col(f"n{i}"), F.col(f"u{i}"), F.col(f"v{i}")) for i, c in enumerate(checks)])


def load_checked(
    frames: dict[str, DataFrame], checks: list[Check], draft: Draft, layer: str = "staging", writers: int = 4
) -> tuple[Publication, DataFrame]:
    """Write the tables of a layer and publish them; returns the publication and a result row per check.

    ``frames`` hold the tables by logical name, under the column names of the raw layer (see ``layer_frames``).
    A load is published whatever its checks say; ``dq_gate`` decides what follows.
    """
    spark = draft.spark

    def write(name: str) -> DataFrame | None:
        own = [c for c in checks if c.table == name and _while_writing(c, frames)]
        results = write_observed(name, frames[name], own, draft.folder(name))
        draft.add(name)
        return results

    with ThreadPoolExecutor(max_workers=writers) as pool:
        parts = [p for p in pool.map(write, frames) if p is not None]
    publication = draft.commit()
    later = [c for c in checks if not _while_writing(c, frames)]
    if later:
        stored = {n: spark.read.parquet(publication.tables[n]) for n in frames}
        parts.append(expectations.run_checks(expectations.checked(stored), later))
    return publication, stacked(parts)
