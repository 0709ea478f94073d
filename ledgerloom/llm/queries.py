"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    collocations,
    decontamination,
    fingerprints,
    minhash,
    packing,
    quality,
    repair,
    secrets,
    sharding,
    suffix_dedup,
    warc,
)
from ledgerloom.llm.common import table
from ledgerloom.operators.materialize import shared_dir

SHARDS = 24


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name that all executors can reach."""
    return f"{shared_dir(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    # A response's length and digest come from the payload read back, a revisit's from its headers.
    response = F.col("record_type") == "response"
    return warc.read_records(archives).select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256))
        .otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("input_ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def control_messages(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts hold the template's look-alikes and an escape."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is a tree with one path: a turn replies to the one before it.

    Rows without a conversation id are one conversation, as in SQL's groups; it has a tree of its own.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.unionByName(control_messages(spark)).withColumn(
        "message_id", F.row_number().over(turns))
    tree = F.struct(F.col("conv_id").isNull().alias("no_id"),
                    F.coalesce("conv_id", F.lit(0).cast("long")).alias("id"))
    messages = numbered.select(
        tree.alias("tree_id"), "message_id",
        (F.col("message_id") - 1).alias("parent_id"), "role", "text",
        F.lit(0.0).alias("score"))
    formatted = chat.format_paths(chat.paths(messages, top=1))
    read = formatted.select(
        "tree_id", "formatted", chat.read_turns().alias("turns"),
        chat.learned_text().alias("learned"))
    shown = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    return read.select(
        F.expr("IF(tree_id.no_id, NULL, tree_id.id)").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.expr(f"sha2({shown}, 256)").alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = fingerprints.with_next(table(spark, sf_dir, "documents")).withColumn(
        "edited", fingerprints.edited()).select(
            "*", F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    found = fingerprints.compare(versions, "text", ["edited", "next_text"], digests=False,
                                 carry={"n_chars": "long", "edited_sha256": "string"})
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.col("text_fingerprint").alias("fingerprint"),
        "edited_fingerprint", F.col("edited_likeness").alias("near_edited"),
        F.col("next_text_likeness").alias("near_next"))


def span_columns(spans: str = "spans") -> list:
    """The counts, digest and list of a scan's spans, in the order (start, kind)."""
    base = f"filter({spans}, s -> s.rank < {len(secrets.BASE)})"
    shown = "transform({}, s -> concat_ws(':', s.kind, s.start, s.end))"
    counts = [F.expr(f"bigint(size(filter({spans}, s -> s.kind = '{r.kind}'))) AS n_{r.kind}")
              for r in secrets.BASE]
    return [*counts,
            F.expr(f"sha2(array_join({shown.format(base)}, ','), 256) AS base_sha256"),
            F.expr(f"array_join({shown.format(spans)}, ',') AS spans")]


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = secrets.Ledger(spark, scratch(spark, "secret_ledger"))
    return secrets.scan(table(spark, sf_dir, "documents"), ledger).select("doc_id", *span_columns())


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.DEFAULT)
    base = (F.col("failed_bits").bitwiseAND(F.lit(quality.BASE.mask()))) != 0
    return rated.select(
        "doc_id", *quality.MEASURES[:5], base.alias("base_failed"), "kept", "failed_bits")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with a fault in a quarter of their rows, by the CRC-32 of conversation and turn."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"), kind.alias("kind")).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).drop("kind", "copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = repair.ordered(damaged(conversations))
    plans = repair.plan(rows)
    found = repair.report(rows, plans).drop("conv_id").join(
        repair.digests(repair.repaired(rows, plans)), "conv", "left")
    every = conversations.select("conv_id").distinct().select("conv_id", repair.key().alias("conv"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontamination.build_index(table(spark, sf_dir, "documents"))
    found = decontamination.phrases(index, table(spark, sf_dir, "benchmark"))
    hit = F.expr("bigint(aggregate(spans, 0, (n, s) -> n + s.end - s.start))")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op4_chat": op4_chat,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_fingerprints": op6_fingerprints,
    "op7_secret_scans": op7_secret_scans,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_minhash": op10_minhash,
    "op11_repair": op11_repair,
    "op12_decontamination": op12_decontamination,
    "op13_collocations": op13_collocations,
}
