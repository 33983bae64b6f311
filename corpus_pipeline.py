"""A corpus from documents to training tokens, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import decontaminate, languages, mixture, similar, token_planes
from changeflow.llm.common import listing_tables, prepare, table, written
from changeflow.session import delete

#: A text whose n-grams lie further from every language's profile than this is none of them.
LEAST_LANGUAGE_SCORE = 0.2

#: Near copies share four fifths of their five-word shingles; op6's query has bounds of its own.
NEAR_WORDS, NEAR_THRESHOLD = 5, (80, 100)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without a letter or near no profile go."""
    prepare(spark)
    judged = languages.identify(docs, languages.learn(docs), lang_pred="judged_lang", score="judged_score")
    known = (F.col("judged_lang") != languages.UNKNOWN) & (F.col("judged_score") >= LEAST_LANGUAGE_SCORE)
    return judged.where(known).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, that with the smallest doc_id stays."""
    prepare(spark)
    return similar.keep_one(docs, n=NEAR_WORDS, threshold=NEAR_THRESHOLD)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows make up a twentieth or more go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as planes of token ids, in ascending doc_id order; per document what is read back."""
    prepare(spark)
    return token_planes.read_digests(written(token_planes.encode(docs), "token-planes"))


_tables: list[str] = []


def _stage(run):
    """The stage, with tables of the stage before it deleted: by now that one's result is written."""

    @functools.wraps(run)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _tables:
            delete(spark, _tables.pop())
        with listing_tables(_tables):
            return run(spark, docs, sf_dir)

    return stage


STAGES = [
    ("language_id", _stage(identify_language)),
    ("ngram_jaccard_join", _stage(drop_near_duplicates)),
    ("benchmark_decontamination", _stage(drop_benchmark_documents)),
    ("source_mixture", _stage(mix_sources)),
    ("token_planes", _stage(write_tokens)),
]

#: Language profiles and sampling keys can't be stated in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
