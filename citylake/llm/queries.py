"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm import conversations, decontaminate, language_id, line_dedup, merkle, minhash_dedup, packing
from citylake.llm import paragraph_dedup, quality_net, quality_rules, secret_crf, sequence_files, sql, toxicity
from citylake.llm.storage import fresh
from citylake.session import table

Query = Callable[[SparkSession, str], DataFrame]

#: Labels (16 bytes each) that are sent to every task at most.
BROADCAST_LABELS = 5_000_000
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.annotate(docs, keep_with=fresh(spark, "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, folder, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _training_rows(spark: SparkSession, folder: str, label: str, parts: int, which: int) -> DataFrame:
    """Labelled texts that are not held out."""
    labels = table(spark, folder, "labels").select("doc_id", F.col(label).cast("int").alias("label"))
    labels = labels.where(~toxicity.held_out(F.col("doc_id"), parts, which) & F.col("label").isin(0, 1))
    # Few labels go to the texts; beyond that the texts are shuffled to them.
    labels = F.broadcast(labels) if labels.count() <= BROADCAST_LABELS else labels
    return table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id").drop("doc_id")


def _judged(scores: DataFrame, parts: int, which: int, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id"), parts, which), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@query
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    model = toxicity.fit(_training_rows(spark, folder, "toxic", 3, 1))
    return _judged(toxicity.score(table(spark, folder, "documents"), model), 3, 1, toxicity.THRESHOLD)


@query
def op4_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_dedup.repeated_passages(table(spark, folder, "documents")).drop("row_key")


@query
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contaminated(docs, items)


@query
def op6_sequence_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh(spark, "sequences")
    sequence_files.write_sequences(table(spark, folder, "documents"), path, word_tokenizer(), end=2)
    return sequence_files.read_documents(spark, path)


@query
def op7_quality_net(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    vectors = quality_net.word_vectors(docs)
    net = quality_net.fit(_training_rows(spark, folder, "quality", 4, 2), vectors)
    return _judged(quality_net.score(docs, vectors, net), 4, 2, quality_net.THRESHOLD)


@query
def op8_secret_crf(spark: SparkSession, folder: str) -> DataFrame:
    return secret_crf.secrets(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), word_tokenizer(), end=0)


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_groups(table(spark, folder, "documents")).drop("row_key")


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.lowered(F.col("text"))).otherwise(F.col("text"))
    found = merkle.witnesses(docs, LEAF_FIELDS, group="lang", key="doc_id", tampered={"text": changed})
    folded = found.withColumn("folded_root", merkle.fold(F.col("tampered"), F.col("steps")))
    return folded.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.judged(conversations.damaged(table(spark, folder, "conversations"))))


@query
def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(toxicity.held_out(F.col("doc_id"), 4, 2), F.lit(False))
    model = language_id.learn(docs.where(~held_out & F.col("doc_id").isNotNull()))
    found = language_id.identify(docs, model, spans=False)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


ORACLES["op2_minhash_dedup"] = sql.NEAR_DUPLICATES
ORACLES["op11_merkle_manifest"] = sql.MERKLE
ORACLES["op12_conversation_repair"] = sql.CONVERSATIONS
