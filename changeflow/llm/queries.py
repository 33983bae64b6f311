"""The registered queries of the operators; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    archives,
    bm25,
    decontaminate,
    hard_negatives,
    languages,
    mixture,
    neighbours,
    prefix_trie,
    quality,
    secrets,
    similar,
    token_planes,
    url_rules,
)
from changeflow.llm.common import table, written

#: Fixed values: (host, path, verdict) of the contract.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def _remainder(key: str, of: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % of


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_planes.read_digests(written(token_planes.encode(docs), "token-planes"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    machine = quality.learn(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return quality.classify(docs, machine).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    profiles = languages.learn(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    judged = languages.identify(docs.select("doc_id", "text"), profiles)
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.components(table(spark, sf_dir, "documents"))


def op7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.taken(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    findings = written(secrets.find(docs, secrets.dictionary(docs)), "secret-candidates")
    known = findings.where(_remainder("doc_id", 3) != 1).withColumn("label", secrets.rule_label())
    judged = secrets.judge(findings, secrets.learn(known, without=secrets.RULE_FEATURES))
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    return judged.select("doc_id", "start", "length", held_out.alias("held_out"), "score", "secret")


def op9_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archives.read_arc(archives.write_arc(table(spark, sf_dir, "pages")))
    warcs = written(archives.write_warc(archives.mark_revisits(records)), "warc")
    return archives.read_warc(warcs).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25.search(docs, docs.where(F.col("doc_id") % 50 == 0)).select("query_id", "rank", "doc_id", "score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("vector"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.paths(table(spark, sf_dir, "conversations"), prefix_trie.shared_beginnings, most=3)
    return prefix_trie.trie(rows).drop("x1", "x2")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_token_planes, op2_url_rules, op3_quality, op4_decontaminate, op5_languages,
            op6_similar, op7_mixture, op8_secrets, op9_archives, op10_bm25,
            op11_hard_negatives, op12_neighbours, op13_prefix_trie,
        )
    }
