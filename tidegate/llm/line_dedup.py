"""Delete later copies of line runs, found with a suffix array of line ids.

The non-blank lines of a document are a sequence of line ids. A run of consecutive lines with at
least ``min_words`` words that also occurs at an earlier place (by doc_id, then by position) is a
later copy and deleted; runs grow as far as the copy does, so they are maximal.

Suffix array: rank 0 of a position is the rank of its line among all lines that occur more than
once; rank j + 1 orders positions by (rank j here, rank j at 2^j lines further), so it is the rank
of the first 2^(j+1) lines. Only distinct pairs are sorted, after counting, so a line in a third
of all documents is one pair; a position whose prefix occurs once can start no repeated run and
drops out. All positions with one rank are an interval of the suffix array whose longest common
prefix is at least 2^j lines. Doubling ends at the depth that ``min_words`` needs, since a run of
that many words has at most as many lines.

Deletion: a repeated run of at least ``min_words`` words is the union of its shortest windows of
``min_words`` words, taken forwards from a line and backwards from a line. The prefix interval of
such a window, at its own number of lines, is given by the ranks of its two halves, which may
overlap. Every window but the first in its interval is deleted.

Defined results: null and empty texts have no lines and come back empty; blank lines are no part
of a sequence and stay, but a text without any other line left becomes empty; a null id sorts
first; rows alike in id and text are one document and share one result; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import body, id_and_text
from tidegate.llm.sieve import split
from tidegate.session import stored

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"
_DOC = ["oid", "th"]


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text with the key of the document, which is never null."""
    return id_and_text(df, id_col, text_col).select(
        "doc_id", body().alias("text"),
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("oid"),
        F.xxhash64(body()).alias("th"))


def units(docs: DataFrame) -> DataFrame:
    """The non-blank lines of each document: place in the sequence, line number, words, hashes."""
    lines = F.transform(F.split("text", "\n"),
                        lambda line, n: F.struct(n.alias("n"), line.alias("line")))
    kept = F.filter(lines, lambda x: x["line"].rlike(_WORD))
    return docs.select(*_DOC, F.posexplode(kept).alias("at", "unit")).select(
        *_DOC, "at", F.col("unit.n").alias("line_no"),
        F.regexp_count(F.col("unit.line"), F.lit(_WORD)).cast("long").alias("words"),
        F.xxhash64("unit.line").alias("a"), F.xxhash64(F.lit("b"), "unit.line").alias("b"))


def ranked(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """A rank, in the order of ``key``, for every value of ``key`` that occurs more than once.

    Ranks rise with the key but have gaps. They are written once, as sampling for the range
    exchange may cut differently when it is repeated.
    """
    values = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    return stored(values.repartitionByRange(*key).sortWithinPartitions(*key)
                  .withColumn("r", F.monotonically_increasing_id()), name)


def runs(repeated: DataFrame, min_words: int) -> DataFrame:
    """Positions inside stretches of repeated lines of enough words, with the number of lines of
    the shortest window that starts or ends there (null where the stretch is too short)."""
    in_doc = Window.partitionBy(*_DOC).orderBy("at")
    stretch = Window.partitionBy(*_DOC, "stretch")
    ordered = stretch.orderBy("at")
    # Rows alike in id and text have the same positions.
    rows = (repeated.dropDuplicates([*_DOC, "at"]).withColumn("stretch", F.col("at") - F.row_number().over(in_doc))
            .withColumns({"end": F.sum("words").over(ordered),
                          "total": F.sum("words").over(stretch)})
            .withColumn("begin", F.col("end") - F.col("words"))
            .where(F.col("total") >= min_words))
    ahead = stretch.orderBy("begin").rangeBetween(0, min_words - 1)
    back = stretch.orderBy("end").rangeBetween(-(min_words - 1), 0)
    return rows.withColumns({
        "ahead": F.when(F.col("begin") + min_words <= F.col("total"),
                        F.count(F.lit(1)).over(ahead)),
        "back": F.when(F.col("end") >= min_words, F.count(F.lit(1)).over(back)),
    }).select(*_DOC, "at", "line_no", "r", "ahead", "back")


def windows(rows: DataFrame) -> DataFrame:
    """Shortest windows as start and number of lines."""
    ahead = rows.where("ahead is not null").select(*_DOC, F.col("at").alias("start"),
                                                   F.col("ahead").alias("lines"))
    back = rows.where("back is not null").select(
        *_DOC, (F.col("at") - F.col("back") + 1).alias("start"), F.col("back").alias("lines"))
    return ahead.union(back).distinct()


def doubled(level: DataFrame, step: int) -> DataFrame:
    """Ranks of prefixes twice as long as those ranked in ``level``."""
    further = Window.partitionBy(*_DOC).orderBy("at").rangeBetween(step, step)
    pairs = (level.withColumnRenamed("r", "r1").withColumn("r2", F.max("r1").over(further))
             .where("r2 is not null"))
    return stored(pairs.join(ranked(pairs, ["r1", "r2"], "line-ranks"), ["r1", "r2"])
                  .select(*_DOC, "at", "r"), "line-level")


def later_copies(wanted: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The windows that are not the first of their interval.

    All levels are looked up by one pair of joins, so the plan, which the driver holds with a broadcast or
    an exchange for each join, is the same for any number of levels.
    """
    ranks = reduce(DataFrame.union, [level.select(F.lit(j).alias("level"), *_DOC, "at", "r")
                                     for j, level in enumerate(levels)])
    longest = F.length(F.bin("lines")) - 1          # level of the longest ranked prefix that fits
    named = (wanted.withColumns({"level": longest, "at": F.col("start")})
             .join(ranks.withColumnRenamed("r", "head"), ["level", *_DOC, "at"])
             .withColumn("at", F.col("start") + F.col("lines") - F.expr("shiftleft(1L, level)"))
             .join(ranks.withColumnRenamed("r", "tail"), ["level", *_DOC, "at"])
             .select(*_DOC, "start", "lines", "head", "tail"))
    rows = stored(named, "line-windows")
    place = F.struct("oid", "th", "start")
    first = (rows.groupBy("lines", "head", "tail")
             .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    return (rows.join(first, ["lines", "head", "tail"]).where(place != F.col("first"))
            .select(*_DOC, "start", "lines"))


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Key of each document with the numbers of its deleted lines."""
    all_units = stored(units(docs), "line-units")
    known = ranked(all_units, ["a", "b"], "line-ids")
    rows = stored(runs(all_units.join(known, ["a", "b"]), min_words), "line-runs")
    wanted = stored(windows(rows), "line-wanted")
    longest = wanted.agg(F.max("lines")).first()[0] or 1
    levels = [rows.select(*_DOC, "at", "r")]
    while (1 << len(levels)) <= longest:
        levels.append(doubled(levels[-1], 1 << (len(levels) - 1)))
    gone = (later_copies(wanted, levels)
            .select(*_DOC, F.explode(F.sequence("start", F.col("start") + F.col("lines") - 1))
                    .alias("at")).distinct())
    return (rows.join(gone, [*_DOC, "at"]).groupBy(*_DOC)
            .agg(F.collect_set("line_no").alias("gone")))


def without_deleted(df: DataFrame, gone: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` as the struct ``row``, with ``kept`` text, ``n_lines`` and ``n_deleted``."""
    text = body(F.col(f"`{text_col}`").cast("string"))
    id_ = F.coalesce(F.col("row.doc_id").cast("long"), F.lit(-(1 << 63)).cast("long"))
    none = F.array().cast("array<int>")
    lines = F.transform(F.split("body", "\n"),
                        lambda line, n: F.struct(n.alias("n"), line.alias("line")))
    kept = F.array_join(F.filter(lines, lambda x: ~F.array_contains("gone", x["n"]))["line"], "\n")
    rows = (df.select(F.struct("*").alias("row"), text.alias("body"))
            .withColumns({"oid": id_, "th": F.xxhash64("body")}))
    key = F.xxhash64(*_DOC)
    # Texts that lose no line, most of them, are not exchanged.
    some, whole = split(rows, key, gone.select(key.alias("key")))
    cut = (some.join(gone, _DOC, "left").withColumn("gone", F.coalesce("gone", none))
           .select("row", F.when(F.size("gone") == 0, F.col("body"))
                   .when(kept.rlike(_WORD), kept).otherwise("").alias("kept"),
                   F.size(F.split("body", "\n")).alias("n_lines"),
                   F.size("gone").alias("n_deleted")))
    return cut.union(whole.select("row", F.col("body").alias("kept"),
                                  F.size(F.split("body", "\n")).alias("n_lines"),
                                  F.lit(0).alias("n_deleted")))


def deduplicated(df: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, the original ``text``, ``kept`` text, lines and deleted lines of every row."""
    docs = id_and_text(df, id_col, text_col)
    gone = deleted_lines(keyed(docs, "doc_id", "text"), min_words)
    return without_deleted(docs, gone).select("row.*", "kept", "n_lines", "n_deleted")
