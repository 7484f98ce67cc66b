"""The corpus pipeline: five stages from raw documents to packed pieces.

Each stage reads what the one before it wrote. Stages before the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm.common import sized_batches, stored, table
from feira.llm.decontaminate import without_contaminated
from feira.llm.line_dedup import line_dedup
from feira.llm.minhash import near_duplicates
from feira.llm.packing import best_fit, cut_pieces
from feira.llm.quality import THRESHOLD, train, with_quality
from feira.llm.tokens import BYTE_SPLIT, vocabulary
from feira.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good enough on average; the others go."""
    field = train(docs, table(spark, sf_dir, "labels"))
    return with_quality(docs, field, keep=COLUMNS).filter(F.col("score") >= THRESHOLD).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of three-line windows; ``n_chars`` is counted anew."""
    return line_dedup(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8): the smallest id."""
    gone = near_duplicates(docs).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.select(*COLUMNS).join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids with their places in packed sequences."""
    pieces = cut_pieces(docs, vocabulary("byte_bpe_50k.json"), BYTE_SPLIT, lower=False, end_id=2)
    return best_fit(stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near duplicates", near_copies),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]

#: the classifier is trained and the tokenizer is a library: SQL cannot express them
ORACLE_SQL = None


def _prepared(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(sized_batches(prepare(spark)), docs, sf_dir)

    return run


STAGES = [(name, _prepared(stage)) for name, stage in STAGES]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
