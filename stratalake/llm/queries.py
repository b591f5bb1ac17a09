"""The operators of this folder over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    blocks, bpe, fuzzylines, importance, linefreq, minhash, pii, pigeonring, secrets, tiling, toxicity, turntrie, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base numbers and verdict of every document; its source is its host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return linefreq.judge(docs).drop("source")


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the bytes decoded from them, for every document."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN, outputs).drop("text")


def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revisit among the captures of all pages with the response it stands for."""
    made = warc.resolve_revisits(warc.page_records(table(spark, sf_dir, "pages")))
    return made.withColumn("headers", warc.header_lines(F.col("headers")))


def fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzylines.deduplicate(docs, least=1)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near-duplicates of every document, by sets of four-word windows."""
    docs = table(spark, sf_dir, "documents")
    return minhash.clusters(docs, width=4).withColumnRenamed("doc", "doc_id")


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document; documents whose id hash leaves 2 never train."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, digest and list of the secrets in every document."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, ranks, public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        *[secrets.counted(F.col("spans"), k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(secrets.listed(F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, digest and list of the spans of personal data in every document."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [k.name for k in pii.KINDS if k.base]
    return found.select(
        "doc_id",
        *[pii.counted(F.col("spans"), k).alias(f"n_{k}") for k in base],
        F.sha2(pii.listed(F.filter("spans", lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best covered benchmark item and verdict for every document."""
    return tiling.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, blocks joined by two line feeds, by a labeller trained on a bounded sample."""
    pages = table(spark, sf_dir, "pages")
    return blocks.extract(pages, blocks.fit(pages), joint="\n\n").select("page_id", "url", "text", "n_chars")


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document; fingerprints link at two differing bits."""
    return pigeonring.clusters(table(spark, sf_dir, "documents"))


def importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document against the benchmark's word features."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark")
    gains = importance.bucket_gains(importance.bucket_counts(docs), importance.bucket_counts(target))
    scored = importance.with_scores(importance.weigh(docs, gains).drop("text"))
    return importance.draw(scored).select("doc_id", "n_features", "weight", "score", "rank")


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie over all rebuilt conversations."""
    turns = turntrie.rebuilt(table(spark, sf_dir, "conversations"))
    return turntrie.nodes(turns)


QUERIES: dict[str, Query] = {
    "op1_line_frequency": line_frequency,
    "op2_byte_bpe": byte_bpe,
    "op3_warc_revisits": warc_revisits,
    "op4_fuzzy_lines": fuzzy_lines,
    "op5_hyperminhash": near_duplicates,
    "op6_toxicity": toxic_scores,
    "op7_token_efficiency": secret_scan,
    "op8_personal_data": personal_data,
    "op9_decontamination": decontamination,
    "op10_block_labeller": main_text,
    "op11_pigeonring": simhash_groups,
    "op12_importance": importance_draw,
    "op13_prefix_trie": prefix_trie,
}

ORACLES: dict[str, str] = {
    "op1_line_frequency": linefreq.ORACLE,
    "op3_warc_revisits": warc.ORACLE,
    "op5_hyperminhash": minhash.ORACLE,
    "op8_personal_data": pii.oracle(),
    "op12_importance": importance.ORACLE,
    "op13_prefix_trie": turntrie.ORACLE,
}
