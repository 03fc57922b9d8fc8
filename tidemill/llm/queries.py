"""One query per operator over the driver's tables, next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from . import bpe_codec, chat, classifier, conversation_repair, decontaminate, html_text, lexicon, merkle, shards, simhash, token_count, token_file
from . import quality_rules as rules
from .common import session, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, verbatim or with other values."""
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_key")


@query("op2_chat")
def op2_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.format_turns(turns.union(tricky)))


@query("op3_shards")
def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in forty shards of near-equal bytes."""
    found = shards.assign_shards(table(spark, folder, "documents"), 40).drop("bucket")
    return found.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op4_bpe_codec")
def op4_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and the bytes they decode to, as digests."""
    found = bpe_codec.decode(bpe_codec.encode(table(spark, folder, "documents")))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op5_token_count")
def op5_token_count(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every text."""
    return token_count.count_tokens(table(spark, folder, "documents"))


@query("op6_quality_rules", rules.ORACLE)
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Word rules and line frequency per host, for every document."""
    return rules.quality_rules(table(spark, folder, "documents")).drop("host")


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_token_file")
def op8_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text written as packed blocks in document order, and read back."""
    session(spark)
    path = shared_path(spark, "tokens")
    token_file.write_tokens(table(spark, folder, "documents"), path)
    return token_file.read_tokens(spark, path, as_digest=True)


@query("op9_html_text")
def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract_text(table(spark, folder, "pages"))


@query("op10_classifier")
def op10_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document by a model that has not seen held-out labels."""
    docs = table(spark, folder, "documents")
    model = classifier.fit(docs, table(spark, folder, "labels"), ~classifier.held_out(F.col("doc_id")))
    return classifier.classify(docs, model)


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged by a fixed rule and repaired with the cheapest edits."""
    return conversation_repair.repair(conversation_repair.damage(table(spark, folder, "conversations")))


@query("op12_merkle")
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of all documents, each one's proof, and whether its row after tampering still leads to the root."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.verify_tampered(table(spark, folder, "documents"), tampered, lower)


@query("op13_lexicon_bpe")
def op13_lexicon_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text through a lexicon of its corpus, and the text they decode to, as digests."""
    docs = table(spark, folder, "documents")
    found = lexicon.decode(lexicon.encode(docs, lexicon.compile_lexicon(docs)))
    return found.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
