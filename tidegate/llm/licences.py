"""Licence of files: TF-IDF cosine of header lines to templates, then inheritance by directory.

Every line of every text is compared, not the top of a file alone. Words of the templates weigh
by how few texts hold them, counted over all texts; any other word weighs as one that no text
holds. A line is compared with every template unless it holds none of the words without which no
template can be reached; the best cosine of ``least`` or more names the licence. Ties go to the licence first by name.

A file without a licence of its own takes that of the nearest directory above it that has one,
which is that of the licence file in it (the best cosine; ties: first by name). Each directory is
resolved once, through joins with its ancestors' paths; files only join their directory.

Defined results: null and empty texts have no header; a null path has no directory and inherits
nothing; several licences in one text: the best cosine; repeated rows each get their result; an
empty table gives an empty result.
"""

from __future__ import annotations

from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import body
from tidegate.session import stored

# Licences and the lines that declare them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("Proprietary", "All rights reserved."),
)
LEAST = 0.7
_WORD = r"[\p{L}\p{N}.\-]*[\p{L}\p{N}]"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def term_counts(docs: DataFrame, vocabulary: Column) -> DataFrame:
    """How many texts hold each word of the templates."""
    held = F.array_intersect(words(F.col("text")), vocabulary)
    return (docs.select(F.explode(held).alias("word")).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")))


def heaviest(vector: dict[str, float], least: float) -> set[str]:
    """Words of a template of which a line must hold one to reach the cosine ``least``.

    A cosine is at most the length of the shared part of the template over its whole length, so
    the lightest words that together stay below that share are not enough.
    """
    need = least ** 2 * sum(x * x for x in vector.values()) * (1 - 1e-9)
    out, sum_ = set(vector), 0.0
    for word, x in sorted(vector.items(), key=lambda item: (item[1], item[0])):
        sum_ += x * x
        if sum_ >= need:
            break
        out.discard(word)
    return out


def own_licences(df: DataFrame, id_col: str, path_col: str, text_col: str,
                 templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, path, row, licence and cosine of every file; ``row`` tells repeated rows apart."""
    spark = df.sparkSession
    docs = stored(df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                            F.col(f"`{path_col}`").cast("string").alias("path"),
                            body(F.col(f"`{text_col}`").cast("string")).alias("text"))
                  .withColumn("row", F.monotonically_increasing_id()), "licence-docs")
    named = spark.createDataFrame(list(templates), "licence string, template string")
    tokens = {r.licence: r.words for r in named.select("licence", words(F.col("template"))
                                                       .alias("words")).collect()}
    vocabulary = sorted({w for text in tokens.values() for w in text})
    known = F.array(*[F.lit(w) for w in vocabulary])
    counts = {r.word: r.n for r in term_counts(docs, known).collect()}    # template words only
    total = docs.count()
    idf = {w: 1.0 + log((1 + total) / (1 + counts.get(w, 0))) for w in vocabulary}
    weight = F.create_map(*[F.lit(x) for pair in idf.items() for x in pair])
    unseen = 1.0 + log(1.0 + total)
    vectors = {name: {w: text.count(w) * idf[w] for w in text} for name, text in tokens.items()}
    anchors = sorted(set().union(*(heaviest(v, least) for v in vectors.values())))
    anchor = F.array(*[F.lit(w) for w in anchors])
    lines = docs.select("row", F.explode(F.split("text", "\n")).alias("line")).withColumn(
        "words", words(F.col("line"))).where(F.arrays_overlap("words", anchor))
    lines = lines.withColumn("line_key", F.monotonically_increasing_id())

    def vector(array: Column) -> Column:
        distinct = F.array_distinct(array)
        return F.transform(F.array_intersect(distinct, known), lambda w: F.struct(
            w.alias("word"), (F.size(F.filter(array, lambda x: x == w)) * weight[w]).alias("w")))

    other = F.size(F.array_except("words", known)) * unseen * unseen
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x["w"] * x["w"])
    terms = (lines.withColumn("vector", vector(F.col("words")))
             .withColumn("norm", F.sqrt(square + other))
             .select("row", "norm", F.explode("vector").alias("term"), "line_key")
             .select("row", "line_key", "norm", "term.word", F.col("term.w").alias("line_w")))
    model = spark.createDataFrame(
        [(name, sqrt(sum(x * x for x in v.values())), w, x) for name, v in vectors.items()
         for w, x in v.items()],
        "licence string, template_norm double, word string, template_w double")
    cosine = F.sum(F.col("line_w") * F.col("template_w")) / (
        F.first("norm") * F.first("template_norm"))
    best = (terms.join(F.broadcast(model), "word")             # the templates' words
            .groupBy("row", "line_key", "licence").agg(F.round(cosine, 9).alias("cosine"))
            .where(F.col("cosine") >= least)
            .groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence"))
                                .alias("best"))
            .select("row", F.col("best.licence").alias("licence"),
                    (-F.col("best.c")).alias("cosine")))
    return docs.drop("text").join(best, "row", "left")


def directory(path: Column) -> Column:
    """The path without its last part; null for a null path."""
    return F.when(path.isNotNull(), F.regexp_replace(path, r"/?[^/]*$", ""))


def ancestors(path: Column) -> Column:
    """A directory and all above it, as (depth, path)."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("above")))


def scan(df: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         licence_file: str = r"(?i)(^|/)(LICEN[CS]E|COPYING)[^/]*$", templates=TEMPLATES,
         least: float = LEAST) -> DataFrame:
    """doc_id, path, own licence, its cosine, the effective licence and the directory it is from.

    ``licence_file`` is the pattern of paths whose licence holds for their directory.
    """
    files = stored(own_licences(df, id_col, path_col, text_col, templates, least)
                   .withColumn("dir", directory(F.col("path"))), "licence-files")
    declared = (files.where(F.col("licence").isNotNull() & F.col("path").rlike(licence_file))
                .groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence"))
                                    .alias("best"))
                .select(F.col("dir").alias("above"), F.col("best.licence").alias("inherited")))
    needing = files.where("licence is null and dir is not null").select("dir").distinct()
    nearest = (needing.select("dir", F.explode(ancestors(F.col("dir"))).alias("up"))
               .select("dir", "up.depth", "up.above").join(declared, "above")
               .groupBy("dir").agg(F.max(F.struct("depth", "inherited", "above")).alias("near"))
               .select("dir", F.col("near.inherited").alias("inherited"),
                       F.col("near.above").alias("from_dir")))
    return (files.join(nearest, "dir", "left")
            .select("doc_id", "path", F.col("licence").alias("own_licence"), "cosine",
                    F.coalesce("licence", "inherited").alias("licence"),
                    F.when(F.col("licence").isNull(), F.col("from_dir")).alias("inherited_from")))
