"""From raw documents to token ids: filter, drop shared lines, deduplicate, mix, encode.

Each stage takes what its predecessor kept and returns the columns of `documents`; the
last returns ids. Texts that a stage changes get a new `n_chars`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm import bpe, linededup, mixing, quality, simhash
from tagloom.llm.queries import VOCABULARY
from tagloom.llm.shared import Scratch, read_table, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    own = unused(docs.columns)
    return quality.judge(docs, prefix=own).filter(f"{own}kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents leave every document; documents stay."""
    keep = f"{unused(docs.columns)}keep"
    found = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs, min_docs=10, keep_first=False), keep)
    text = linededup.kept_text(F.col("text"), F.col(keep))
    changed = F.when(F.col(keep).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("bigint"))
    return found.withColumns({"text": text, "n_chars": changed}).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which toxic tokens are about three in a hundred of all.

    The tokens of the clean domain are the anchor and no rate exceeds 1, so clean documents
    stay and none comes twice.
    """
    found = mixing.mix(
        docs, read_table(spark, sf_dir, "labels"), {"clean": 0.97, "toxic": 0.03},
        domains={"clean": "toxic = 0", "toxic": "toxic = 1"}, anchor="clean", most=1.0,
        prefix=(own := unused(docs.columns)),
    )
    return found.filter(f"{own}copies > 0").select(*docs.columns)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids, and a digest of what they decode to."""
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encode(docs, path, decoded=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mixing_to_targets", mixing_to_targets),
    ("bpe_codec", bpe_codec),
]
#: SimHash, the fitted classifier and the encoding are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    scratch, docs = Scratch(spark), read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
