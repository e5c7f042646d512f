"""The registered queries ``opN_<name>``: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    decontaminate,
    instruct,
    lexical,
    licenses,
    minhash,
    packing,
    passages,
    preference,
    quality,
    repair,
    sharding,
    simhash,
    substring,
    suffix,
    toxicity,
)
from quarry.llm.common import saved
from quarry.llm.oracle import ORACLE  # noqa: F401  (registered with QUERIES)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file())


def op1_instruction_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with their prompts, under limits on tokens, segments and loss-bearing tokens that all bind."""
    return instruct.pack_conversations(_table(spark, sf_dir, "conversations"), tokenizer_file())


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.deduplicate(_table(spark, sf_dir, "documents"), length=400, keep="none")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a source tree: a folder per source, blocks of 4000 ids in it and of 200 ids in these.

    The first document of a folder is its licence file.
    """
    docs = _table(spark, sf_dir, "documents")
    block, part = F.expr("doc_id div 4000").alias("block"), F.expr("doc_id div 200").alias("part")
    # a block's licence files by their ids, its own and its folders', one row per block: texts are never shuffled for them
    folders = docs.groupBy("source", block, part).agg(F.min("doc_id").alias("leaf"))
    blocks = saved(folders.groupBy("source", "block").agg(F.min("leaf").alias("top"), F.collect_list("leaf").alias("leaves")), "licence_ids")
    few = blocks.count() <= licenses.MOST_ROWS
    named = docs.select("doc_id", "source", "text", block, part).join(F.broadcast(blocks) if few else blocks, ["source", "block"], "left")
    is_top = F.coalesce(F.col("doc_id") == F.col("top"), F.lit(False))
    is_leaf = F.coalesce(F.array_contains("leaves", F.col("doc_id")), F.lit(False))
    name = F.when(is_leaf, F.lit("LICENSE")).otherwise(F.concat_ws("", F.col("doc_id"), F.lit(".txt")))
    path = F.concat_ws("/", "source", "block", F.when(~is_top, F.col("part")), name)
    found = licenses.scan(named.select(path.alias("path"), F.col("doc_id").alias("row_key"), "text"))
    return found.withColumnRenamed("row_key", "doc_id")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"), 16)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 20 words or more, also within lines."""
    return _line_spans(passages.repeated_passages(_table(spark, sf_dir, "documents")))


def op6_all_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All repeated lines, however short."""
    return _line_spans(substring.repeated_spans(_table(spark, sf_dir, "documents"), min_words=1))


def _line_spans(spans: DataFrame) -> DataFrame:
    return spans.select(
        substring.doc_id_of("node").alias("doc_id"), F.col("unit").cast("long"), F.col("start").cast("long"),
        F.col("length").cast("long"), F.col("words").cast("long").alias("n_words"),
        substring.doc_id_of("first_node").alias("first_doc_id"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.drop("text_key")


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.preference_examples(_table(spark, sf_dir, "conversations"))
    spans = {f"{side}_mask": F.array_join(F.transform(f"{side}_mask", lambda m: F.concat_ws(":", m["start"], m["length"])), ";")
             for side in ("chosen", "rejected")}
    return found.withColumns(spans)


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, per_cent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    signals = saved(quality.with_signals(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text"),
                    "signals")
    cutoffs = saved(quality.certified_cutoffs(signals, _table(spark, sf_dir, "labels")), "cutoffs")
    judged = quality.judge(signals, cutoffs)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", F.col("lang").alias("stratum"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations damaged by a fixed rule, then audited and repaired."""
    given = _table(spark, sf_dir, "conversations")
    turns = saved(damaged(given), "damaged")
    found = saved(repair.audits(turns), "audits")
    texts = repair.digests(repair.repaired(turns, found)).withColumnRenamed("conv_id", "t")
    found = found.withColumnRenamed("conv_id", "f")
    ids = given.select("conv_id").distinct()
    out = ids.join(found, ids["conv_id"].eqNullSafe(found["f"]), "left")
    out = out.join(texts, ids["conv_id"].eqNullSafe(texts["t"]), "left")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
             for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of conversation and turn."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *shown)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).where("draw != 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


QUERIES = {f.__name__: f for f in (
    op1_packing, op1_instruction_packing, op2_suffix_dedup, op3_license_scan, op4_sharding, op5_toxicity, op6_substring_dedup,
    op6_all_repeats, op7_decontamination, op8_preference, op9_minhash_dedup, op10_quality_rules,
    op11_lexical_search, op12_conversation_repair, op13_simhash_dedup)}

