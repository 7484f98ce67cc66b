"""The operators' queries over one data folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.llm import decontaminate
from feira.llm.alignment import align_tokens
from feira.llm.chat_format import format_chats, read_chats
from feira.llm.common import sized_batches, stored, table, version
from feira.llm.conversation_repair import COUNTS, repaired_pieces
from feira.llm.decontaminate import contaminated
from feira.llm.embedding_dedup import near_vectors
from feira.llm.line_dedup import line_dedup
from feira.llm.minhash import near_duplicates
from feira.llm.order_minhash import fingerprints_with_next
from feira.llm.packing import best_fit, cut_pieces
from feira.llm.quality import THRESHOLD, held_out, train, with_quality
from feira.llm.repeats import copies
from feira.llm.substring_dedup import remove_repeated_words
from feira.llm.suffix_dedup import remove_repeated_bytes
from feira.llm.token_store import open_shards, read_documents, write_shards
from feira.llm.tokens import BYTE_SPLIT, WORD_SPLIT, model_file, vocabulary
from feira.plans.workspace import new_folder
from feira.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(sized_batches(prepare(spark)), folder)

    QUERIES[fn.__name__] = run
    return fn


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, removed lines, removed spans, digest of the kept text."""
    out = line_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "line_dedup.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = """
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), starts AS (
  SELECT doc_id, ls, unnest(range(len(ls) - 2)) AS pos FROM lines WHERE len(ls) >= 3
), windows AS (
  SELECT doc_id, pos, ls[pos + 1] || chr(10) || ls[pos + 2] || chr(10) || ls[pos + 3] AS key FROM starts
), ranked AS (
  SELECT doc_id, pos, row_number() OVER w AS nth, first_value(doc_id) OVER w AS first_doc, first_value(pos) OVER w AS first_pos
  FROM windows WHERE trim(translate(key, chr(9) || chr(10) || chr(13), '')) <> ''
  WINDOW w AS (PARTITION BY key ORDER BY doc_id, pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), cut AS (
  SELECT DISTINCT doc_id,
    unnest(range(CASE WHEN doc_id = first_doc THEN greatest(pos, first_pos + 3) ELSE pos END, pos + 3)) AS pos
  FROM ranked WHERE nth > 1
), per_line AS (
  SELECT l.doc_id, l.pos, l.line, c.pos IS NOT NULL AS gone,
    lag(c.pos IS NOT NULL, 1, false) OVER (PARTITION BY l.doc_id ORDER BY l.pos) AS gone_before
  FROM (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM lines) l
  LEFT JOIN cut c ON l.doc_id = c.doc_id AND l.pos = c.pos
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
  CAST(count(*) FILTER (gone AND NOT gone_before) AS BIGINT) AS n_spans,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM per_line GROUP BY doc_id
"""


@query
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Per conversation, read back from its formatted text: turns, loss text, lengths."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    awkward = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(awkward).alias("text"),
    )
    return read_chats(format_chats(given.unionByName(added)))


def _escaped_sql(value: str) -> str:
    out = f"replace({value}, chr(27), chr(27) || '0')"
    for mark in ("<s>", "</s>", "[INST]", "[/INST]"):
        out = f"replace({out}, '{mark}', '{mark[0]}' || chr(27) || '{mark[1:]}')"
    return out


# a turn is escaped when its text holds a control string, or an escape character that unescaping would change
_CONFLICT = " OR ".join(f"contains(text, {m})" for m in ("'<s>'", "'</s>'", "'[INST]'", "'[/INST]'", "chr(27)"))
ORACLE["op3_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), pieces AS (
  SELECT *, length(role) + 8 + CASE WHEN role = 'user' THEN 15 ELSE 0 END
    + length(CASE WHEN {_CONFLICT} THEN {_escaped_sql('text')} ELSE text END) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, true AS round_trip
FROM pieces GROUP BY conv_id
"""


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Per piece: its place in a packed sequence, and a checksum of its ids."""
    pieces = cut_pieces(
        table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), BYTE_SPLIT, lower=False, end_id=2
    )
    digests = stored(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces"
    )
    return best_fit(digests)


@query
def op8_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, read back by key from the written shards: place, length and checksum of its ids."""
    path = new_folder(spark, "token-shards")
    write_shards(
        table(spark, folder, "documents"), path, vocabulary("word_bpe_49k.json"), WORD_SPLIT, lower=True, end_id=1
    )
    found = read_documents(open_shards(spark, path))
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: whether it was held out of training, its quality score, and the verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    field = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = with_quality(docs, field, keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its set of two-word shingles, and its component of near duplicates."""
    return near_duplicates(table(spark, folder, "documents"), words=2, share=80)


def _after_removal(docs: DataFrame, cut: DataFrame, n_units: Column, at_least: int) -> DataFrame:
    """Every document: (doc_id, n_units, n_removed, n_spans, kept_sha256 or NULL for those that stay whole)."""
    changed = cut.select(
        "doc", "ver", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("sha")
    )
    copied = copies(docs).withColumn("copy", F.lit(True))
    rows = docs.select("doc_id", version(F.col("text")).alias("ver"), n_units.alias("n_units"), F.col("whole"))
    met = (
        rows.join(changed.withColumnRenamed("doc", "doc_id"), ["doc_id", "ver"], "left")
        .join(copied.withColumnRenamed("doc", "doc_id"), ["doc_id", "ver"], "left")
    )
    gone = F.coalesce("copy", F.lit(False)) & (F.col("n_units") >= at_least)
    return met.select(
        "doc_id",
        "n_units",
        F.when(gone, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: bytes, bytes removed as repeats of smaller ids, removed runs, digest of the rest."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("whole", F.sha2("text", 256))
    n_bytes = F.octet_length("text").cast("bigint")
    out = _after_removal(docs, remove_repeated_bytes(docs), n_bytes, 50)
    return out.withColumnRenamed("n_units", "n_bytes")


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: words, words removed as repeats of smaller ids, digest of the kept words."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    plain = F.trim(F.regexp_replace("text", r"[\x09-\x0D\x20]+", " "))
    docs = docs.withColumn("whole", F.sha2(plain, 256))
    n_words = F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1)
    out = _after_removal(docs, remove_repeated_words(docs), n_words.cast("bigint"), 13)
    return out.withColumnRenamed("n_units", "n_words").drop("n_spans")


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Per contaminated document and benchmark item: matched windows, slots, and whether values were changed."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _valued_sql(text: str) -> str:
    out = f"(' ' || coalesce({text}, ''))"
    for k, (pattern, replacement) in enumerate(decontaminate.STEPS):
        if k == len(decontaminate.STEPS) - 2:
            marks = decontaminate.PARTING.replace("'", "''")
            out = f"translate({out}, '{marks}', '{' ' * len(decontaminate.PARTING)}')"
        back = replacement.replace("$", "\\")
        quoted = [x.replace("'", "''") for x in (pattern, back)]
        out = f"regexp_replace({out}, '{quoted[0]}', '{quoted[1]}', 'g')"
    return f"trim(lower({out}))"


_SLOT_SQL = f"'{decontaminate.SLOT}', '\\1', 'g'"
ORACLE["op1_decontaminate"] = f"""
WITH d AS (
  SELECT doc_id, string_split(v, ' ') AS theirs, string_split(regexp_replace(v, {_SLOT_SQL}), ' ') AS t
  FROM (SELECT doc_id, {_valued_sql('text')} AS v FROM documents)
), b AS (
  SELECT item_id, string_split(v, ' ') AS own, string_split(regexp_replace(v, {_SLOT_SQL}), ' ') AS t
  FROM (SELECT item_id, {_valued_sql('text')} AS v FROM benchmark)
), dw AS (
  SELECT doc_id, pos, array_to_string(t[pos + 1 : pos + 8], ' ') AS key
  FROM (SELECT doc_id, t, unnest(range(len(t) - 7)) AS pos FROM d WHERE len(t) >= 8)
), bw AS (
  SELECT item_id, pos AS ipos, array_to_string(w, ' ') AS key, count(*) OVER (PARTITION BY item_id) AS n_windows
  FROM (SELECT item_id, pos, t[pos + 1 : pos + 8] AS w FROM (
    SELECT item_id, t, unnest(range(len(t) - 7)) AS pos FROM b WHERE len(t) >= 8))
  WHERE len(list_filter(w, lambda x: ord(x) BETWEEN 1 AND 3)) * 2 <= 8
), aligned AS (
  SELECT doc_id, item_id, n_windows, pos - ipos AS shift, count(DISTINCT ipos) AS n_matched, min(ipos) AS first, max(ipos) AS last
  FROM dw JOIN bw USING (key) GROUP BY ALL HAVING count(DISTINCT ipos) >= n_windows * 0.5
), pairs AS (
  SELECT a.*, own[ipos + 1] AS x, theirs[ipos + shift + 1] AS y
  FROM (SELECT *, unnest(range(first, last + 8)) AS ipos FROM aligned) a JOIN d USING (doc_id) JOIN b USING (item_id)
), checked AS (
  SELECT doc_id, item_id, n_windows, shift, n_matched,
    count(*) FILTER (ord(x) BETWEEN 1 AND 3 AND ord(x) = ord(y)) AS n_slots,
    coalesce(bool_or(x <> y) FILTER (ord(x) BETWEEN 1 AND 3 AND ord(x) = ord(y)), false) AS reparameterised,
    count(DISTINCT x || ' ' || y) FILTER (ord(x) BETWEEN 1 AND 3 AND ord(x) = ord(y))
      = count(DISTINCT x) FILTER (ord(x) BETWEEN 1 AND 3 AND ord(x) = ord(y)) AS consistent
  FROM pairs GROUP BY doc_id, item_id, n_windows, shift, n_matched
)
SELECT doc_id, item_id, n_matched, n_windows, n_slots, reparameterised FROM checked WHERE consistent
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, shift) = 1
"""


@query
def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per vector: its links within the label, its component, and whether it is the component's smallest."""
    return near_vectors(table(spark, folder, "embeddings"))


def _damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults chosen by their conversation and turn: dropped, emptied, cut, repeated, given to the user."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"])) % 20
    return (
        rows.withColumn("__fault", fault)
        .filter("__fault != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("__fault") == 4, "user").otherwise(text["role"]).alias("role"),
            F.when(F.col("__fault") == 1, "")
            .when(F.col("__fault") == 2, F.translate(text["text"], ".!?", ""))
            .otherwise(text["text"])
            .alias("text"),
            F.explode(F.sequence(F.lit(1), F.when(F.col("__fault") == 3, 2).otherwise(1))).alias("__copy"),
        )
        .drop("__copy")
    )


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Per conversation, after known damage: its faults, the cheapest repair, digest of the repaired turns."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    whole, loose = repaired_pieces(_damaged(given))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    # the digest is over a conversation as a whole, so a conversation's lines meet in one row here
    gathered = loose.groupBy("conv_id").agg(
        *[F.max(c).alias(c) for c in (*COUNTS, "audit")],
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("piece", lines.alias("l")))), lambda x: x["l"])).alias("l"),
    )
    each = whole.select("conv_id", *COUNTS, "audit", lines.alias("l")).unionByName(gathered)
    done = each.withColumn("repaired_sha256", F.sha2(F.array_join("l", "\n"), 256)).drop("l")
    ids = given.select(F.col("conv_id").alias("__id")).distinct()
    met = ids.join(done, F.col("__id").eqNullSafe(F.col("conv_id")), "left")
    return met.select(
        F.col("__id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its fingerprint, its edited text's, and their likeness; likeness to the next document's."""
    found = fingerprints_with_next(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *[F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")],
        "near_edited",
        "near_next",
    )


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: tokens of two tokenizers, groups that cover the same bytes, links and how common they are."""
    docs = table(spark, folder, "documents")
    found = align_tokens(docs, vocabulary("byte_bpe_50k.json"), model_file("piece_bpe_32k.model"), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")
