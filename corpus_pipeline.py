"""Five stages that turn a table of documents into token ids, each by an operator of tidegate.llm.

A stage takes (spark, docs, sf_dir) and returns the rows that it keeps; all but the last return
the columns of documents. Rows are documents of their own, repeated or not, null ids and texts
included; what an operator does with them is in its module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontamination, jaccard_dedup, language, line_dedup
from tidegate.llm.common import body, table
from tidegate.session import scratch, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is rejected if no language has this share of its words.
LEAST_LANGUAGE = 0.34


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter or without a language of its own.

    The model is learned from the source table, the texts judged are those of ``docs``.
    """
    model = language.train(table(spark, sf_dir, "documents"))
    found = language.identify(docs, model)
    return (found.where((F.col("lang_pred") != language.UNKNOWN)
                        & (F.col("score") >= LEAST_LANGUAGE)).select("row.*"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of line runs; a text of which nothing is left goes.

    Texts and their lengths are those after deletion.
    """
    with scratch(spark, "line-gone"):
        gone = stored(line_dedup.deleted_lines(line_dedup.keyed(docs, "doc_id", "text")),
                      "line-gone")
    old = body("row.text")
    changed = {
        "text": F.when(F.col("row.text").isNotNull(), F.col("kept")).alias("text"),
        "n_chars": F.when(F.col("kept") == old, F.col("row.n_chars"))
        .otherwise(F.length("kept").cast("long")).alias("n_chars")}
    return (line_dedup.without_deleted(docs, gone).where((F.col("kept") != "") | (old == ""))
            .select(*[changed.get(c, F.col(f"row.`{c}`")) for c in docs.columns]))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id.

    Near-duplicates have 80 % or more of their five-word shingles in common (Jaccard). Candidates come from
    op8's method, SimHash fingerprints linked by multi-index hashing, and are checked on the whole texts;
    what no radius of fingerprints is sure to find is then searched exactly.
    """
    return jaccard_dedup.first_of_groups(docs, fingerprints=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids of every text, and a digest of their decoding."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks))


STAGES = [("language_id", language_id), ("line_dedup", dedup_lines), ("near_dedup", dedup_near),
          ("decontamination", decontaminate), ("bpe", tokenize)]

#: No SQL states the learned model, the fingerprints and the tokenizer's merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
