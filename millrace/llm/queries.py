"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from millrace.llm import (
    conversations, decontaminate, language, packing, periodic, quality, repeats, secret_scan, shards, simhash, sketches,
    token_counts, warc,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of 4-word SimHash fingerprints within 4 bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets by patterns and by a character network trained on them."""
    docs = _table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    return found.withColumnRenamed("id", "doc_id")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of a factorisation machine; a fifth of the ids is held out of training."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = _table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    known = docs.where(_remainder(5) != 0).join(marks, "doc_id")
    found = quality.score(docs, quality.train(known)).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts by heap-and-linked-list pair merging."""
    found = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return found.withColumnRenamed("id", "doc_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sequences of 4096 tokens, packed shortest pack first."""
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings of 200 bytes that start elsewhere too."""
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), size=200)
    return found.drop("spans").withColumnRenamed("id", "doc_id")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of texts and of their edited copies."""
    return sketches.edited(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, read back through the capture index."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages by bit-sliced n-gram filters; a third of the ids is held out of learning."""
    docs = _table(spark, sf_dir, "documents")
    filters = language.learn(docs.where(_remainder(3) != 1))
    found = language.identify(docs, filters).withColumnRenamed("id", "doc_id")
    return found.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its best window."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def _repeating(docs: DataFrame) -> DataFrame:
    """A tenth of the documents repeat a stretch of their words up to the end; null ids are left alone."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", words.alias("words"), g.alias("g")).withColumn("n", F.greatest(F.size("words"), F.lit(0)))
    cut = cut.withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    cut = cut.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    joined = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, joined).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, the one of greatest exponent, and the texts without their repetitions."""
    found = periodic.periodic_runs(_repeating(_table(spark, sf_dir, "documents")))
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda b, r: F.when(
            b["period"].isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r
        ).otherwise(b),
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Turns of which a fifth are dropped, emptied, cut, repeated or given to the user, by a checksum."""
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.where("code <> 0").select(
        "conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("code") == 3, 2).otherwise(1))),
    ).drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired rows of damaged conversations."""
    given = _table(spark, sf_dir, "conversations")
    edits, repaired = conversations.repair(_damaged(given))
    found = given.select("conv_id").distinct()
    for part in (conversations.report(edits), conversations.digests(repaired)):
        found = found.join(part, F.expr("conv_id <=> conv"), "left").drop("conv")
    zeros = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of near-equal size that do not part equal texts."""
    found = shards.shard(_table(spark, sf_dir, "documents"), shards=40).withColumnRenamed("id", "doc_id")
    return found.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_simhash_near_dedup, op2_secret_scans, op3_quality_classifier, op4_token_counts, op5_packing,
        op6_suffix_array_dedup, op7_document_fingerprints, op8_warc,
        op9_language_id, op10_decontamination, op11_periodic_runs,
        op12_conversation_repair, op13_sharding,
    )
}
SQL = {
    # SHA-256 and the first page of each payload; the archives themselves have no SQL form.
    "op8_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY 1)
        SELECT page_id, strlen(html) AS payload_bytes, p.payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
}
