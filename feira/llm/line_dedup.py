"""Line dedup over overlapping windows of consecutive lines.

Every window of three consecutive lines is hashed, windows that occur more
than once anywhere are found by one aggregate, and every occurrence but the
first (smallest document id, then position) marks its lines. Marked positions
that overlap or touch are merged into spans, and the spans are cut out.

Defined results
* NULL text counts as empty text and stays NULL in ``without_spans``.
* Fewer lines than a window: nothing is removed. All-blank windows never count.
* A window that overlaps its own first occurrence in the same document does not
  remove lines of that first occurrence.
* Rows that repeat a document id are the same document if their text is equal
  (both stay as they are against each other); otherwise they are ordered by a
  hash of their text. A NULL id sorts before all others.
* Further columns are passed through and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.common import version

WINDOW = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, ver, pos, key): one row per window of consecutive lines that is not blank."""
    lines = docs.select(
        F.col(doc_id).alias("doc"), version(F.col(text)).alias("ver"), lines_of(F.col(text)).alias("lines")
    ).filter(F.size("lines") >= window)
    starts = F.sequence(F.lit(1), F.size("lines") - F.lit(window - 1))

    def joined(at: Column) -> Column:
        return F.concat_ws("\n", *[F.element_at("lines", (at + F.lit(k)).cast("int")) for k in range(window)])

    # the hash keeps 128 bits, so different windows do not meet
    keys = F.transform(starts, lambda at: F.when(F.trim(F.translate(joined(at), "\t\r\n", "")) != "", F.unhex(F.md5(joined(at)))))
    return (
        lines.select("doc", "ver", F.posexplode(keys).alias("pos", "key"))
        .filter(F.col("key").isNotNull())
    )


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, ver, spans): per affected document its removed line spans, [start, end), merged and sorted."""
    windows = line_windows(docs, doc_id, text, window)
    here = F.struct("doc", "ver", "pos")
    firsts = (
        windows.groupBy("key")
        .agg(F.min(here).alias("first"), F.max(here).alias("last"))
        .filter(F.col("first") < F.col("last"))
        .select("key", "first")
    )
    same = F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("ver") == F.col("first.ver"))
    later = (
        windows.join(firsts, "key")
        .filter(here > F.col("first"))
        .select(
            "doc",
            "ver",
            F.when(same, F.greatest("pos", F.col("first.pos") + window)).otherwise(F.col("pos")).alias("start"),
            (F.col("pos") + window).alias("end"),
        )
        .filter(F.col("start") < F.col("end"))
    )
    before = Window.partitionBy("doc", "ver").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc", "ver").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce((F.col("start") > F.max("end").over(before)).cast("int"), F.lit(1))
    return (
        later.withColumn("opens", opens)
        .withColumn("island", F.sum("opens").over(upto))
        .groupBy("doc", "ver", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("doc", "ver")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def _kept_lines(lines: Column, spans: Column) -> Column:
    """The lines outside the spans, by slices between them; linear in lines and spans."""
    edges = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.size(lines)))
    gaps = F.arrays_zip(edges.alias("a"), ends.alias("b"))
    return F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + F.lit(1), g["b"] - g["a"])))


def without_spans(
    docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` cut down to its kept lines, plus one struct column ``line_dedup``
    (n_lines, n_removed, n_spans)."""
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    d = d.withColumn("__ver", version(F.col(f"d.`{text}`")))
    s = spans.select(F.col("doc").alias("__doc"), F.col("ver").alias("__v"), "spans")
    met = d.join(s, F.col(f"d.`{doc_id}`").eqNullSafe(F.col("__doc")) & (F.col("__ver") == F.col("__v")), "left")
    lines = lines_of(F.col(f"d.`{text}`"))
    kept = F.when(F.col("spans").isNull(), F.col(f"d.`{text}`")).otherwise(
        F.concat_ws("\n", _kept_lines(lines, F.col("spans")))
    )
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    facts = F.struct(
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
    )
    shown = [kept.alias(text) if name == text else col.alias(name) for name, col in zip(docs.columns, own)]
    return met.select(*shown, facts.alias("line_dedup"))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with later repeats of line windows cut out of ``text``."""
    return without_spans(docs, repeated_spans(docs, doc_id, text, window), doc_id, text)
