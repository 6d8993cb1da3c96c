"""SimHash fingerprints and a search within a Hamming radius by permuted block tables.

Terms of a text are its words (lower case, split at white space) and pairs of neighbouring words.
A term weighs its length times 1 + ln of its count, so words that every text holds count little.
Each term's 64-bit hash votes on 64 signed sums; the fingerprint has a 1 where the sum is above 0.

Search: the fingerprint is cut into ``radius + 2`` blocks. Two fingerprints within the radius
agree on at least two blocks, so there is a table for each pair of blocks, keyed by those bits,
as if they had been moved to the front. A candidate counts in the first table only in which it
agrees, and only if its complete distance is within the radius; both are part of the join.

Defined results: null texts count as empty, whose fingerprint is zero; a text without a successor
by id is followed by the first; equal ids follow in order of a hash of their text, and a null id
sorts first; repeated rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.common import body, id_and_text, ship
from tidegate.session import stored

ship(__name__)

RADIUS = 3
_ROW = "part int, first boolean, last boolean, doc_id long, n_chars long, text string"
_FOUND = ("edited_sha256 string, fingerprint long, edited_fingerprint long, "
          "next_fingerprint long")


def simhash(text: str) -> int:
    """The 64-bit fingerprint as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    counts = Counter(words)
    counts.update(map(" ".join, zip(words, words[1:], strict=False)))
    hashes = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"))
                          for t in counts), np.uint64, len(counts))
    weights = np.fromiter((len(t) * (1 + log(n)) for t, n in counts.items()), np.float64,
                          len(counts))
    votes = np.zeros(64)
    for at in range(0, len(hashes), 16384):           # memory of a long text
        bits = np.unpackbits(hashes[at:at + 16384].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        votes += weights[at:at + 16384] @ bits
    ones = 2 * votes > weights.sum()
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _found(text: str, following: str, own: int, other: int) -> tuple[str, int, int, int]:
    new = edited(text, following)
    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
    return digest, own, simhash(new), other


def _arrow(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in
                                       zip(columns, fields, strict=True)], [n for n, _ in fields])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of id, each completed when the next is seen. The last of a partition stays
    open and keeps its text, as does the first, which the partition before needs."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(),
                                strict=True):
            own = simhash(text)
            if before is not None:
                first, old_id, old_text, old = before
                rows.append((part, first, False, old_id, len(old_text),
                             old_text if first else None, *_found(old_text, text, old, own)))
            before = (before is None, doc_id, text, own)
        yield _arrow(rows, f"{_ROW}, {_FOUND}")
    if before is not None:
        first, old_id, old_text, old = before
        yield _arrow([(part, first, True, old_id, len(old_text), old_text, None, old, None, None)],
                     f"{_ROW}, {_FOUND}")


def _at_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(r["doc_id"], r["n_chars"],
                 *_found(r["text"], r["following"], r["fingerprint"], r["next_fingerprint"]))
                for r in batch.to_pylist()]
        yield _arrow(rows, f"doc_id long, n_chars long, {_FOUND}")


def with_successors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next text by id.

    Whole texts are exchanged once, by ranges of the id. Only the first and last text of a range
    are joined across ranges.
    """
    docs = id_and_text(df, id_col, text_col).select("doc_id", body().alias("text"))
    order = ["doc_id", "key"]
    ordered = (docs.withColumn("key", F.xxhash64("text")).repartitionByRange(*order)
               .sortWithinPartitions(*order).select("doc_id", "text"))
    rows = stored(ordered.mapInArrow(_in_order, f"{_ROW}, {_FOUND}"), "fingerprint-rows")
    parts = rows.where("first").select("part")           # one row for each range
    everything = Window.orderBy("part")
    after = parts.select("part", F.coalesce(
        F.lead("part").over(everything),
        F.min("part").over(everything.rowsBetween(Window.unboundedPreceding,
                                                  Window.unboundedFollowing))).alias("next_part"))
    firsts = rows.where("first").select(F.col("part").alias("next_part"),
                                        F.col("text").alias("following"),
                                        F.col("fingerprint").alias("next_fingerprint"))
    open_rows = (rows.where("last").select("part", "doc_id", "n_chars", "text", "fingerprint")
                 .join(after, "part").join(firsts, "next_part"))
    names = ["doc_id", "n_chars", *[f.split()[0] for f in _FOUND.split(", ")]]
    return (rows.where("not last").select(*names)
            .union(open_rows.mapInArrow(_at_borders, f"doc_id long, n_chars long, {_FOUND}")))


def tables(fps: DataFrame, radius: int) -> DataFrame:
    """The column ``fp`` once for each pair of blocks, with the bits of those blocks as ``bits``."""
    masks = pair_masks(radius)
    entries = F.array(*[F.struct(F.lit(i).alias("pair"),
                                 F.col("fp").bitwiseAND(F.lit(mask)).alias("bits"))
                        for i, mask in enumerate(masks)])
    return fps.select("fp", F.explode(entries).alias("entry")).select("fp", "entry.*")


def pair_masks(radius: int) -> list[int]:
    """Masks of each pair of blocks, as signed integers."""
    cuts = [round(i * 64 / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(a | b) - ((a | b) >> 63 << 64) for a, b in combinations(blocks, 2)]


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (query, fp) of distinct fingerprints at ``radius`` or fewer differing bits.

    Both inputs have a column ``fp``; a query that is among ``fps`` finds itself too.
    """
    asked = tables(queries.select("fp").distinct(), radius).select(
        F.col("fp").alias("query"), "pair", "bits")
    differing = F.col("query").bitwiseXOR(F.col("fp"))
    first = F.lit(0)
    for i, mask in reversed(list(enumerate(pair_masks(radius)))):
        first = F.when(differing.bitwiseAND(F.lit(mask)) == 0, i).otherwise(first)
    known = tables(fps.select("fp").distinct(), radius)
    return (asked.join(known, (asked["pair"] == known["pair"]) & (asked["bits"] == known["bits"])
                       & (F.bit_count(differing) <= radius) & (first == asked["pair"]))
            .select("query", "fp"))
