"""Benchmark passages in training texts, found by spaced seeds.

A text is its words (letters, digits and underscores, in lower case). A seed is a fixed mask over
neighbouring words; positions with 0 are ignored, so a replaced word there does not hide a hit.

1. Each task hashes the seeds of its texts. Those that a Bloom filter of the benchmark's seeds
   rules out stay behind; the filter has a fixed largest size, and a benchmark that fills it only
   lets more through. What leaves is one row for each text and hash, with all positions.
2. Both sides are joined on the hash. A hash of more than ``HOT_SEED`` texts is salted.
3. A text and an item that share seeds meet once, with the positions of both, never as a product of
   rows; the distinct alignments follow in the task.
4. Every alignment is verified word by word: a stretch in which at least four in five words are
   equal must hold ``MIN_MATCHES`` equal words, or four in five of a shorter item. The masks miss
   no such stretch: of the groups of five words that it is cut into, one has at most one replaced.

Equal texts are searched once and equal items once. A text is read again only if it shares a seed.

Defined results: null and empty texts, and items without words, match nothing; an item with fewer
than four words is searched as a whole; a null id is kept; repeated rows of documents each give
their links, a repeated item (equal id) is reported once by its best stretch; ties go to the first
place; a very long text is hashed as one slice; other columns of the input are not
looked at, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import id_and_text, ship, text_hash, trim
from tidegate.session import broadcast_if_small, scratch, stored

ship(__name__)

# Fixed masks: four of five words count, whichever they are.
MASKS = ("1111", "11011", "10111", "11101")
#: Masks of items that are shorter than that.
SHORT = ("1", "11", "111")
MIN_MATCHES = 12
#: Equal words of a stretch, in how many.
AGREE = (4, 5)
#: Texts of one hash in a task of the join.
HOT_SEED = 2_000
#: Binary logarithm of the bits of the filter, at least and at most.
FILTER_BITS = (16, 26)
SLICE_WORDS = 200_000
KNOWN_WORDS = 100_000
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
SEED_ROWS = "a long, b long, h long, at array<int>"
LEAK_ROWS = "a long, b long, c long, d long, start long, tokens long, matched long"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _Hashes(dict):
    """Hashes of words; forgets all when it has too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def _seeds(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask at every place of a sequence of word hashes."""
    n = max(0, len(ids) - len(mask) + 1)
    hashes = np.full(n, int("1" + mask, 2), np.uint64)
    for offset in [i for i, bit in enumerate(mask) if bit == "1"] if n else []:
        hashes = (hashes ^ ids[offset:offset + n]) * _MIX
        hashes ^= hashes >> np.uint64(29)
    return hashes


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of a hash are set, its highest and its lowest ones read as numbers."""
    size = int(bits.size).bit_length() + 5
    low = np.uint64(63)

    def there(at):
        return (bits[at >> np.uint64(6)] >> (at & low)) & np.uint64(1) == 1
    first = there(hashes >> np.uint64(64 - size))
    first[first] = there(hashes[first] & np.uint64((1 << size) - 1))
    return first


def _slices(texts: pd.Series) -> Iterator[tuple[int, list[list[str]]]]:
    """First place and words of runs of texts, so that a task holds the words of one run only."""
    begin, size, run = 0, 0, []
    for i, text in enumerate(texts):
        run.append(words(text))
        size += len(run[-1])
        if size >= SLICE_WORDS or i + 1 == len(texts):
            yield begin, run
            begin, size, run = i + 1, 0, []


def _positions(texts: list[list[str]], masks: tuple[str, ...], hashes: _Hashes, bits,
               whole: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Text, hash and positions of the seeds. ``whole``: a short text has one seed, itself."""
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    ids = np.fromiter((hashes[w] for t in texts for w in t), np.uint64, int(ends[-1]))
    owner = np.repeat(np.arange(len(texts)), lengths)
    found = []
    for mask in masks:
        seeds = _seeds(ids, mask)
        fits = owner[:len(seeds)] == owner[len(mask) - 1:len(mask) - 1 + len(seeds)]
        if whole:
            long = lengths >= min(map(len, MASKS))
            right = long if mask in MASKS else lengths == len(mask)
            fits &= right[owner[:len(seeds)]]
        if bits is not None:
            fits[fits] = _passes(bits, seeds[fits])
        at = np.flatnonzero(fits)
        found.append((owner[at], seeds[at], at - (ends - lengths)[owner[at]]))
    text, seed, at = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((at, seed, text))
    text, seed, at = text[order], seed[order], at[order].astype(np.int32)
    new = np.flatnonzero(np.concatenate(
        [[True], (text[1:] != text[:-1]) | (seed[1:] != seed[:-1])])) if len(at) else at
    return text[new], seed[new], np.split(at, new[1:]) if len(at) else []


def _seed_rows(masks: tuple[str, ...], shared=None):
    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        bits = shared.value if shared else None
        for frame in frames:
            for begin, texts in _slices(frame["text"]):
                text, seed, at = _positions(texts, masks, hashes, bits, not shared)
                if len(at):
                    yield pd.DataFrame({"a": frame["a"].to_numpy()[begin + text],
                                        "b": frame["b"].to_numpy()[begin + text],
                                        "h": seed.view(np.int64), "at": at})
            trim()
    return rows


def needed(length: int) -> int:
    """Equal words that an item of so many words must have in a text."""
    return min(MIN_MATCHES, -(-AGREE[0] * length // AGREE[1]))


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Begin, end and equal words of the stretch with the most equal words among all stretches in
    which four in five words are equal. It begins and ends with an equal word; ties go to the
    longer one, then to the first."""
    equal = np.concatenate([[0], np.cumsum(same)])
    gain = AGREE[1] * equal - AGREE[0] * np.arange(len(equal))
    # For an end, the earliest begin with no higher gain is a new minimum; for that begin, only
    # the last end with no lower gain counts. Edges that differ are cut off, the rest agrees more.
    begin = np.flatnonzero(np.concatenate([[True], gain[1:] < np.minimum.accumulate(gain)[:-1]]))
    later = np.maximum.accumulate(gain[::-1])
    end = len(gain) - 1 - np.searchsorted(later, gain[begin])
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0, 0
    matched = equal[end] - equal[begin]
    first, last = at[np.minimum(equal[begin], len(at) - 1)], at[equal[end] - 1] + 1
    best = int(np.lexsort((begin, first - last, -matched))[0])
    return int(first[best]), int(last[best]), int(matched[best])


def verified(text: list[str], item: list[str], starts: np.ndarray) -> tuple | None:
    """Start, words and equal words of the best stretch of any of the alignments, given by the
    place in the text of the item's first word."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(item), 1)}
    own = np.array([numbers[w] for w in item])
    begin = max(0, int(starts[0]))
    ids = np.fromiter(map(numbers.get, text[begin:max(0, int(starts[-1]) + len(item))], repeat(0)),
                      np.int64)
    best = None
    for start in starts.tolist():
        low, high = max(0, -start), min(len(own), begin + len(ids) - start)
        at = start + low
        first, end, matched = best_stretch(own[low:high] == ids[at - begin:start + high - begin])
        if matched >= needed(len(own)):
            got = (at + first, end - first, matched)
            if best is None or (got[2], -got[0]) > (best[2], -best[0]):
                best = got
    return best


def alignments(pairs: list) -> np.ndarray:
    """The distinct differences of positions in the text and in the item, ascending."""
    pairs = [(np.asarray(at), np.asarray(item_at)) for at, item_at in pairs]
    low = min(int(at[0]) - int(item_at[-1]) for at, item_at in pairs)
    high = max(int(at[-1]) - int(item_at[0]) for at, item_at in pairs)
    there = np.zeros(high - low + 1, bool)
    for at, item_at in pairs:
        many, few = (at, -item_at) if len(at) > len(item_at) else (-item_at, at)
        for place in few.tolist():
            there[many + (place - low)] = True
    return np.flatnonzero(there) + low


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, last_words = None, []
    for frame in frames:
        found = []
        for row in frame.itertuples(index=False):
            if (row.a, row.b) != last:
                last, last_words = (row.a, row.b), words(row.text)
            got = verified(last_words, words(row.item), alignments(row.pairs))
            if got:
                found.append((row.a, row.b, row.c, row.d, *got))
        if found:
            yield pd.DataFrame(found, columns=["a", "b", "c", "d", "start", "tokens", "matched"])


def _filter(index: DataFrame) -> np.ndarray:
    """Two bits for each seed, made in Spark; the driver holds no more than the largest filter."""
    least, most = FILTER_BITS
    size = min(most, max(least, (32 * index.count()).bit_length()))
    bit = F.explode(F.array(F.shiftrightunsigned("h", 64 - size),
                            F.col("h").bitwiseAND(F.lit((1 << size) - 1).cast("long"))))
    words_ = (index.select(bit.alias("bit"))
              .groupBy(F.shiftright("bit", 6).alias("word"))
              .agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 63))")).alias("bits")).toPandas())
    bits = np.zeros(1 << (size - 6), np.int64)
    bits[words_["word"].to_numpy(np.int64)] = words_["bits"].to_numpy(np.int64)
    return bits.view(np.uint64)


def _distinct_texts(texts: DataFrame) -> DataFrame:
    """a and b, the hash of a text, and the text once."""
    return (texts.where("text is not null").select(text_hash(F.col("text")).alias("k"), "text")
            .select("k.a", "k.b", "text").dropDuplicates(["a", "b"]))


def _pairs(hits: DataFrame, index: DataFrame) -> DataFrame:
    """a, b of a text, c, d of an item and the positions of each seed that both have."""
    hot = broadcast_if_small(stored(
        hits.groupBy("h").count().where(F.col("count") > HOT_SEED)
        .select("h", F.ceil(F.col("count") / HOT_SEED).cast("long").alias("parts")), "hot-seeds"))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    left = hits.join(hot, "h", "left").withColumn("salt", F.pmod(F.xxhash64("a", "b"), parts))
    right = (index.select("h", F.col("a").alias("c"), F.col("b").alias("d"),
                          F.col("at").alias("item_at"))
             .join(hot, "h", "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))))
    return (left.drop("parts").join(right.drop("parts"), ["h", "salt"])
            .groupBy("a", "b", "c", "d")
            .agg(F.collect_list(F.array("at", "item_at")).alias("pairs")))


def found_in(texts: DataFrame, benchmark: DataFrame, id_col: str = "item_id",
             text_col: str = "text") -> DataFrame:
    """a, b (hash of a text), item_id, start, tokens and matched, for every distinct ``text``."""
    with scratch(texts.sparkSession, "leaks"):
        bench = id_and_text(benchmark, id_col, text_col)
        items = stored(_distinct_texts(bench), "items")
        index = stored(items.mapInPandas(_seed_rows(MASKS + SHORT), SEED_ROWS), "item-seeds")
        few = items.mapInPandas(_seed_rows(SHORT), SEED_ROWS)
        masks = MASKS if few.isEmpty() else MASKS + SHORT
        shared = texts.sparkSession.sparkContext.broadcast(_filter(index))
        own = texts.where("text is not null").select(text_hash(F.col("text")).alias("k"), "text")
        hits = stored(own.select("k.a", "k.b", "text")
                      .mapInPandas(_seed_rows(masks, shared), SEED_ROWS)
                      .dropDuplicates(["a", "b", "h"]), "seeds")
        pairs = stored(_pairs(hits, index), "pairs")
        again = broadcast_if_small(stored(pairs.select("a", "b").distinct(), "again"))
        read = (own.select("k.a", "k.b", "text").join(again, ["a", "b"], "left_semi")
                .dropDuplicates(["a", "b"]))
        named = broadcast_if_small(items.select(F.col("a").alias("c"), F.col("b").alias("d"),
                                                F.col("text").alias("item")))
        best = (pairs.join(named, ["c", "d"]).join(read, ["a", "b"])
                .mapInPandas(_verify, LEAK_ROWS))
        ids = (bench.where("text is not null")
               .select(F.col("doc_id").alias("item_id"), text_hash(F.col("text")).alias("k"))
               .distinct().select("item_id", F.col("k.a").alias("c"), F.col("k.b").alias("d")))
        order = F.max(F.struct("matched", (-F.col("start")).alias("first"), "tokens")).alias("x")
        return stored(best.join(ids, ["c", "d"]).groupBy("a", "b", "item_id").agg(order)
                      .select("a", "b", "item_id", (-F.col("x.first")).alias("start"),
                              "x.tokens", "x.matched"), "leaks")


def leaks(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row for each document and benchmark item in it."""
    docs = id_and_text(df, id_col, text_col)
    found = broadcast_if_small(found_in(docs.select("text"), benchmark))
    return (docs.select("doc_id", text_hash(F.col("text")).alias("k"))
            .select("doc_id", "k.a", "k.b").join(found, ["a", "b"]).drop("a", "b"))


def without_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of documents without a benchmark passage, with all their columns."""
    text = F.col(f"`{text_col}`").cast("string")
    found = broadcast_if_small(stored(
        found_in(df.select(text.alias("text")), benchmark).select("a", "b").distinct(), "leaked"))
    keyed = df.select(F.struct("*").alias("row"), text_hash(text).alias("k"))
    return (keyed.select("row", "k.a", "k.b").join(found, ["a", "b"], "left_anti")
            .select("row.*"))
