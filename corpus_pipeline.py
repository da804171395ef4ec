"""The corpus pipeline: documents through five stages, each written as Parquet before the next.

Every stage works on all rows its predecessor kept; all but the last return the columns they got.
Null and empty texts have no language and go in the first stage.  A table without rows passes
through all stages as one; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import byte_pairs, language, mixing, near_text, toxicity
from tagloom.llm.queries import MIX, MIX_BLOCK, MIX_OTHER, RANKS, table
from tagloom.llm.scratch import Scratch

#: A text goes if no language is recognised, or none with so much of the score.
LEAST_LANGUAGE_SCORE = 0.3


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = f"_{name}"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, have no letters, or are of no recognisable language."""
    usable = docs.where(F.col("doc_id").isNotNull() & ~language.held_out(F.col("doc_id")))
    model = language.fit(usable, Scratch(spark, "stage-language"), "text", "lang", "doc_id")
    if model is None:  # nothing to learn from, nothing to reject by
        return docs
    name, score = _unused(docs, "lang_pred"), _unused(docs, "lang_score")
    told = language.identify(docs, model, "text", name, score)
    return told.where((F.col(name) != language.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE)).drop(name, score)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts with a toxicity score of at least the threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), Scratch(spark, "stage-toxicity"))
    name = _unused(docs, "toxicity")
    return toxicity.score(docs, model, "text", name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group: five-word shingles, similarity of 0.8 or more.

    Of rows that repeat an id the one with the smallest hash stays; rows without an id stay.
    """
    scratch = Scratch(spark, "stage-near")
    found = near_text.near_duplicates(docs, scratch, size=5, percent=80)
    kept = found.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    kept = scratch.keep(kept, "kept")
    once = docs.join(kept.where("times = 1").select("doc_id"), "doc_id", "left_semi")
    out = once.unionByName(docs.where(F.col("doc_id").isNull()))
    if kept.where("times > 1").limit(1).count():
        name = _unused(docs, "digest")
        often = docs.join(kept.where("times > 1").select("doc_id"), "doc_id", "left_semi")
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = often.groupBy("doc_id").agg(F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias(name))
        out = out.unionByName(first.select(f"{name}.*"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the mix: partitions, and rows inside them; ``tokenize`` states their position."""
    return mixing.in_mixed_order(mixing.mixed(docs, MIX, MIX_OTHER, MIX_BLOCK))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, lang, ids`` of every document, and ``decoded_same``: the decoded bytes are the text.

    ``pool, slot, position`` are the place in the mix, derived again from the same rows: tables that were
    written and read have no order of their own.  Sorting by ``position`` gives the mix.
    """
    ranks = byte_pairs.read_ranks(public_tokenizers.path(RANKS))
    place = ["pool", "slot", "position"]
    mix = mixing.mixed(docs, MIX, MIX_OTHER, MIX_BLOCK).select("row.doc_id", "row.source", "row.lang", "row.text", *place)
    rows = mix.select("doc_id", "source", "lang", *place, F.sha2(F.col("text"), 256).alias("text_sha256"), "text")
    coded = byte_pairs.encode_and_check(rows, ranks, public_tokenizers.PATTERN)
    same = (F.col("decoded_sha256") == F.col("text_sha256")).alias("decoded_same")
    return coded.select("doc_id", "source", "lang", *place, "ids", "n_tokens", same)


STAGES = [
    ("language", identify_language),
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("mixing", mix_sources),
    ("byte_pairs", tokenize),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; ``position`` is their order."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
