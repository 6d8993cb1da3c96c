"""Ranked lexical search over a length-stratified index.

A document's normaliser m is 75 + (25 n N) div L; n are its terms, N and L the documents with terms
and the terms of all. The index is a table. A row is a slice of documents of a task; in it documents
of equal m form a stratum, and the postings of a term within a stratum lie by tf. So an impact,
w * ((10^9 tf) div (1000 tf + 12 m)), is computed once for each term, stratum and tf, not for each
posting, and the largest tf of a term bounds what it can add in the stratum. A query visits the strata
of a slice in descending order of these bounds and skips an item wherever the bound is below the
score of its k-th document so far; what is visited is scored exactly in whole numbers.

A slice holds its own documents, so no text is shuffled and no term, however common, gathers in one
task. Only df of the terms asked for and the k best documents of each task leave it; the k best of
all come from two rounds of windows, over (item, part) and item. Items are taken in blocks of
``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` terms at most (one longer item is a block of its own); a
block is what the driver and a broadcast hold.

Defined results: null and empty texts, and texts without a term, are not documents of the index (they
count neither in N nor in L); items without a term that a document holds have no rows; repeated rows
are documents or items of their own; a null doc_id ranks last among equal scores (2^63-1 stands for
it); empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.arrow import (
    binary_words,
    breaks_of,
    byte_offsets,
    flat_words,
    pack,
    row_slices,
    runs,
    unpack,
    word_arrays,
)
from tidegate.llm.common import body, ship
from tidegate.session import stored

ship(__name__)

#: All ASCII but letters and digits; other code points belong to terms.
BREAKS = breaks_of(*(c for c in range(128) if not chr(c).isalnum()))
#: Bytes of text in a slice; one longer text is a slice of its own.
SLICE_BYTES = 1_500_000
BLOCK_ITEMS = 500
BLOCK_TERMS = 200_000
#: Postings looked at together, and documents x items scored together: memory of a task.
VISIT = 400_000
#: Parts of an item's candidates in the first of the two last rounds.
PARTS = 64
NO_ID = (1 << 63) - 1
#: Packed: the terms of a slice; m and the end of each stratum's documents; term, tf, stratum and end
#: of each group of postings; the postings, documents by their number in the slice.
INDEX = "doc_ids array<long>, terms binary, strata binary, groups binary, postings binary"


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.LargeBinaryArray]]:
    """The ids and texts of slices of a batch."""
    texts = batch.column("text").cast(pa.large_binary())
    for row, stop in row_slices(byte_offsets(texts), SLICE_BYTES):
        yield batch.column("doc_id").slice(row, stop - row), texts.slice(row, stop - row)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in _texts(batch):
            n = np.diff(flat_words(texts, BREAKS)[1])
            yield pa.RecordBatch.from_pydict({"docs": [int((n > 0).sum())],
                                              "terms": [int(n.sum())]})


def _slice_index(ids: pa.Array, texts: pa.LargeBinaryArray, docs: int, all_terms: int):
    """One row of the index."""
    words, ends = flat_words(texts, BREAKS)
    n = np.diff(ends)
    held = np.flatnonzero(n)
    coded = words.dictionary_encode()
    # 75 + (25 n N) div L with whole numbers of any size.
    lengths, which = np.unique(n[held], return_inverse=True)
    m = np.array([75 + 25 * int(k) * docs // all_terms for k in lengths], np.int64)[which]
    order = np.argsort(m, kind="stable")
    held, m = held[order], m[order]
    place = np.zeros(len(n), np.int64)          # a document's number in order of m
    place[held] = np.arange(len(held))
    strata, first = np.unique(m, return_index=True)
    doc_ends = np.append(first[1:], len(held))
    size = len(coded.dictionary)
    key = (np.repeat(place, n) * size
           + coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    pair, tf = np.unique(key, return_counts=True)
    doc, term = pair // max(size, 1), pair % max(size, 1)
    stratum = np.searchsorted(doc_ends, doc, "right")
    order = np.lexsort((doc, tf, term, stratum))
    doc, term, tf, stratum = doc[order], term[order], tf[order], stratum[order]
    new = np.flatnonzero(np.diff(stratum, prepend=-1).astype(bool)
                         | np.diff(term, prepend=-1).astype(bool)
                         | np.diff(tf, prepend=-1).astype(bool))
    numbers = ids.take(pa.array(held)).fill_null(NO_ID)
    return [numbers, pack(*word_arrays(coded.dictionary.cast(pa.large_binary()))),
            pack(strata, doc_ends),
            pack(term[new], tf[new], stratum[new], np.append(new[1:], len(doc))), pack(doc)]


def _indexer(docs: int, all_terms: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _texts(batch):
                row = _slice_index(ids, texts, docs, all_terms)
                if len(row[0]):
                    lists = pa.ListArray.from_arrays(pa.array([0, len(row[0])], pa.int32()),
                                                     row[0])
                    yield pa.RecordBatch.from_arrays(
                        [lists, *[pa.array([x], pa.binary()) for x in row[1:]]],
                        ["doc_ids", "terms", "strata", "groups", "postings"])
    return index


class Index:
    """The stored index of a table with its number of documents and terms."""

    def __init__(self, rows: DataFrame, docs: int, terms: int):
        self.rows, self.docs, self.terms = rows, docs, terms


def build(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Index all rows of a table, in two passes over it."""
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      body(F.col(f"`{text_col}`").cast("string")).cast("binary").alias("text"))
    sums = texts.select("doc_id", "text").mapInArrow(_count_terms, "docs long, terms long").agg(
        F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    docs, terms = sums.docs or 0, sums.terms or 0
    return Index(stored(texts.mapInArrow(_indexer(docs, terms), INDEX), "search-index"),
                 docs, terms)


class Block:
    """Some items and the distinct terms they ask for, as a sparse matrix by term."""

    def __init__(self, items: list[tuple[int, int | None, Counter]]):
        self.rows = [row for row, _, _ in items]
        self.ids = [id_ for _, id_, _ in items]
        self.terms = sorted({t for _, _, terms in items for t in terms})
        number = {t: i for i, t in enumerate(self.terms)}
        cells = sorted((number[t], i, n) for i, (_, _, terms) in enumerate(items)
                       for t, n in terms.items())
        table = np.array(cells, np.int64).reshape(-1, 3)
        self.item, self.times = table[:, 1], table[:, 2]
        self.ends = np.searchsorted(table[:, 0], np.arange(len(self.terms) + 1))
        self.weight = np.zeros(len(self.terms), np.int64)


def item_terms(text: str | None) -> Counter:
    raw = pa.array([(text or "").encode("utf-8", "surrogatepass")], pa.large_binary())
    return Counter(flat_words(raw, BREAKS)[0].to_pylist())


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """All items in blocks; the driver holds one at a time."""
    block, size = [], 0
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("i"),
                        F.col(f"`{text_col}`").cast("string").alias("t"))
    for number, row in enumerate(rows.toLocalIterator()):
        terms = item_terms(row.t)
        if block and (len(block) >= BLOCK_ITEMS or size + len(terms) > BLOCK_TERMS):
            yield Block(block)
            block, size = [], 0
        if terms:
            block.append((number, row.i, terms))
            size += len(terms)
    if block:
        yield Block(block)


def _lists(batch: pa.RecordBatch, name: str, row: int) -> list[np.ndarray]:
    return [a.astype(np.int64) for a in unpack(batch.column(name)[row].as_py())]


def _codes(batch: pa.RecordBatch, row: int, vocabulary: pa.Array) -> np.ndarray:
    """For each term of a row its number in the vocabulary, or -1."""
    words = binary_words(*unpack(batch.column("terms")[row].as_py()))
    found = pc.index_in(words, value_set=vocabulary)
    return found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _frequencies(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(shared.value, pa.large_binary())
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                term, _, _, ends = _lists(batch, "groups", row)
                code = _codes(batch, row, vocabulary)[term]
                size = np.diff(ends, prepend=0)
                df += np.bincount(code[code >= 0], size[code >= 0],
                                  len(vocabulary)).astype(np.int64)
        known = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": pa.array(known, pa.int64()),
                                          "df": pa.array(df[known])})
    return count


def weights(index: Index, block: Block) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of every term of a block, 0 where no text has it."""
    shared = index.rows.sparkSession.sparkContext.broadcast(block.terms)
    found = (index.rows.select("terms", "groups")
             .mapInArrow(_frequencies(shared), "term long, df long")
             .groupBy("term").agg(F.sum("df").alias("df")).collect())
    weight = np.zeros(len(block.terms), np.int64)
    for row in found:
        weight[row.term] = int(np.floor(1000 * np.log((2 * index.docs + 2) / (2 * row.df + 1))))
    return weight


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.zeros(items, np.int64)          # score of the k-th, 0 before
        self.item = self.doc = self.score = np.zeros(0, np.int64)

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = score >= np.maximum(self.least[item], 1)
        if not good.any():
            return
        item, doc, score = (np.concatenate(p) for p in (
            (self.item, item[good]), (self.doc, doc[good]), (self.score, score[good])))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        kept = place < self.k
        self.item, self.doc, self.score = item[kept], doc[kept], score[kept]
        last = place == self.k - 1
        self.least[item[last]] = score[last]


def _visit(block: Block, best: Best, batch: pa.RecordBatch, row: int, vocabulary: pa.Array,
           seen: dict) -> None:
    """Score the strata of one row of the index that can hold one of the k best."""
    term, tf, stratum, ends = _lists(batch, "groups", row)
    code = _codes(batch, row, vocabulary)[term]
    asked = np.flatnonzero(code >= 0)
    asked = asked[block.weight[code[asked]] > 0]
    if not len(asked):
        return
    code, tf, stratum = code[asked], tf[asked], stratum[asked]
    m, doc_ends = _lists(batch, "strata", row)
    postings, = _lists(batch, "postings", row)
    doc_ids = batch.column("doc_ids")[row].values.to_numpy(zero_copy_only=False)
    size = np.diff(ends, prepend=0)[asked]
    start = ends[asked] - size
    impact = block.weight[code] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[stratum]))
    items, strata = len(block.ids), len(m)
    # The bound: the largest tf of a term in a stratum is its last group there.
    top = np.flatnonzero(np.diff(code, append=-1).astype(bool)
                         | np.diff(stratum, append=-1).astype(bool))
    wide = block.ends[code + 1] - block.ends[code]
    cell = runs(block.ends[code[top]], wide[top])
    bound = np.zeros(strata * items, np.int64)
    np.add.at(bound, np.repeat(stratum[top], wide[top]) * items + block.item[cell],
              np.repeat(impact[top], wide[top]) * block.times[cell])
    bound = bound.reshape(strata, items)
    group_ends = np.searchsorted(stratum, np.arange(strata + 1))
    doc_start = np.append(0, doc_ends[:-1])
    work = np.add.reduceat(np.append(size * wide, 0), group_ends[:-1])
    work[group_ends[:-1] == group_ends[1:]] = 0
    work = work + (doc_ends - doc_start) * items
    order = np.argsort(-bound.max(1), kind="stable")
    for low, high in row_slices(np.append(0, np.cumsum(work[order])), VISIT):
        some = order[low:high]
        open_ = (bound[some] > 0) & (bound[some] >= best.least[None, :])
        seen["pairs"] = seen.get("pairs", 0) + int((bound[some] > 0).sum())
        seen["visited"] = seen.get("visited", 0) + int(open_.sum())
        some, open_ = some[open_.any(1)], open_[open_.any(1)]
        if not len(some):
            continue
        group = runs(group_ends[some], group_ends[some + 1] - group_ends[some])
        which = np.repeat(np.arange(len(some)), group_ends[some + 1] - group_ends[some])
        # One row for each group of postings and item that asks for its term and is open.
        cell = runs(block.ends[code[group]], wide[group])
        of, which = np.repeat(group, wide[group]), np.repeat(which, wide[group])
        live = open_[which, block.item[cell]]
        cell, of, which = cell[live], of[live], which[live]
        # Documents of the strata that are looked at, one after the other.
        docs_of = (doc_ends - doc_start)[some]
        base = np.cumsum(docs_of) - docs_of
        doc = (postings[runs(start[of], size[of])] - np.repeat(doc_start[some][which], size[of])
               + np.repeat(base[which], size[of]))
        total = int(docs_of.sum())
        score = np.zeros(total * items, np.int64)
        np.add.at(score, np.repeat(block.item[cell], size[of]) * total + doc,
                  np.repeat(impact[of] * block.times[cell], size[of]))
        hit = np.flatnonzero(score)
        number = doc_ids[runs(doc_start[some], docs_of)]
        best.add(hit // total, number[hit % total], score[hit])


def _searcher(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        vocabulary = pa.array(block.terms, pa.large_binary())
        best, seen = Best(len(block.ids), k), {}
        for batch in batches:
            for row in range(batch.num_rows):
                _visit(block, best, batch, row, vocabulary, seen)
        yield pa.RecordBatch.from_pydict({
            "item_row": pa.array(np.array(block.rows, np.int64)[best.item]),
            "item_id": pa.array([block.ids[i] for i in best.item], pa.int64()),
            "doc_id": pa.array(best.doc), "score": pa.array(best.score)})
    return search


def search(index: Index, items: DataFrame, k: int, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the k best documents of every item."""
    spark = index.rows.sparkSession
    schema = "item_row long, item_id long, doc_id long, score long"
    found = spark.createDataFrame([], schema)
    for block in blocks(items, id_col, text_col):
        block.weight = weights(index, block)
        shared = spark.sparkContext.broadcast(block)
        best = index.rows.mapInArrow(_searcher(shared, k), schema)
        found = found.union(stored(best, "search-best"))
    order = [F.desc("score"), F.asc("doc_id")]
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["item_row", "part"], ["item_row"]):
        found = found.withColumn("rank", F.row_number().over(
            Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
