"""Near-duplicates by the exact Jaccard similarity of word shingles, from fingerprints on if asked for.

The set of a text is that of the hashes of its ``SHINGLE``-word runs (all words, if there are
fewer). Texts whose sets have a Jaccard similarity of ``SIMILAR`` (4/5) or more are linked, and one
document of each group of links stays.

Candidates come from prefixes, not from bits of a fingerprint. In one order of all shingles, two sets of
n and m shingles that are so similar have a first shingle in common among the first n - ceil(4n/5) + 1 of
one and m - ceil(4m/5) + 1 of the other, and from there on both must have 4/9 (n + m) left. No pair is
missed, whichever order is taken. The order taken puts shingles that many texts hold last, by a table of
``SLOTS`` counts: letters of one form that differ in more than the bound have their own shingles first,
and where they meet too little is left, so they give no pair.

Prefix entries of a slice of documents go packed to shards by shingle, where those that one set alone
has are dropped; entries of shingles that are common by the table go on as they are, spread by set. A
bucket (a shingle with several sets) is not compared pair by pair: for some rounds its first set is
compared with the others and then leaves it, and a bucket whose sets are all of one component is done.
Rounds go on while more pairs are left than ``LINEAR`` for each prefix entry of the
corpus, ``ROUNDS`` at most; what is left then is compared pair by pair across components. A pair meets first
with its marks, some bits of each shingle, which bound what two sets share from above: most candidates are
copies in part, and are ruled out by a sixth of the bytes of their texts or less. Every other pair is verified
on the whole sets, recomputed from the texts of such pairs only.

Defined results: null, empty and blank texts have the empty set and are copies of each other; equal
sets (64-bit hashes) count as one; of a group the row of the smallest id stays (null ids last), then
that of the smallest text hash; of equal rows one; a text longer than a slice is a slice of its own; an
empty table gives an empty result; further columns may have any name but must be orderable.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import simhash_dedup
from tidegate.llm.arrow import (
    breaks_of,
    byte_offsets,
    flat_words,
    pack,
    row_slices,
    unpack,
)
from tidegate.llm.common import keyed, ship, trim
from tidegate.llm.components import components
from tidegate.llm.sieve import split
from tidegate.session import broadcast_if_small, discard, freed_shuffles, scratch, stored

ship(__name__)

SHINGLE = 5
SIMILAR = (4, 5)
SLOTS = 1 << 17
#: Slots of the most texts whose counts set the order; all others come first.
COMMON = 50_000
#: Bytes of text in a slice and entries in a shard: memory of a task. Entries of a slot with more
#: texts than HOT are spread by set.
SLICE_BYTES = 4_000_000
SHARD_ENTRIES = 1_500_000
HOT = 100_000
LINEAR = 5
#: Bits of a shingle in a mark, beyond those that number the shingles of its set.
MARK_BITS = 3
ROUNDS = 8
BREAKS = breaks_of(0x20, *range(0x09, 0x0E))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_KEY = ["none", "oid", "a", "b"]
NODES = "none boolean, oid long, a long, b long, fp long, node long, n int, slot int, k long"
BLOCKS = "shard long, packed binary"
ENTRIES = "token long, node long, n int, pos int"


def _rolled(ids: np.ndarray, length: int) -> np.ndarray:
    n = len(ids) - length + 1
    hashes = np.full(max(n, 0) if length else 0, length, np.uint64)
    for i in range(length if n > 0 else 0):
        hashes = (hashes ^ ids[i:i + n]) * _MIX
        hashes ^= hashes >> np.uint64(29)
    return hashes


def shingle_sets(texts: pa.LargeBinaryArray, length: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of the runs of words of each text."""
    words, ends = flat_words(texts, BREAKS)
    coded = words.dictionary_encode()
    number = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in coded.dictionary.to_pylist()),
                         np.uint64, len(coded.dictionary))
    ids = number[coded.indices.to_numpy(zero_copy_only=False)]
    whole = _rolled(ids, length)
    return [np.unique(whole[low:high - length + 1]) if high - low >= length
            else _rolled(ids[low:high], high - low)
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    texts = batch.column("text").cast(pa.large_binary())
    for row, stop in row_slices(byte_offsets(texts), SLICE_BYTES):
        yield row, stop, shingle_sets(texts.slice(row, stop - row))


def _node(one: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(one.tobytes(), 7)


def _long(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _prints(texts: pa.Array, wanted: bool) -> pa.Array:
    if not wanted:
        return pa.nulls(len(texts), pa.int64())
    return _long([simhash_dedup.fingerprint_of(t.as_py()) for t in texts])


def _nodes(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
    """Key, fingerprint if wanted, hash and size of the set of every text; at last how many texts each
    slot has."""
    held = np.zeros(SLOTS, np.int64)
    kinds = [pa.bool_(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.int64()]
    names = [*_KEY, "fp", "node", "n", "slot", "k"]
    for batch in batches:
        for row, stop, sets in _texts(batch):
            for one in sets:
                np.add.at(held, (one & np.uint64(SLOTS - 1)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).slice(row, stop - row) for c in _KEY],
                 _prints(batch.column("text").slice(row, stop - row), wanted),
                 _long([_node(one) for one in sets]), pa.array([len(s) for s in sets], pa.int32()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.int64())], names)
    trim()
    slots = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [*[pa.nulls(len(slots), kind) for kind in kinds[:7]], pa.array(slots, pa.int32()),
         pa.array(held[slots])], names)


def prefix_length(n: int) -> int:
    return n - -(-SIMILAR[0] * n // SIMILAR[1]) + 1


def _entry_sender(shared, shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            for _, _, sets in _texts(batch):
                by_node = {_node(one): one for one in sets if len(one)}
                nodes = np.fromiter(by_node, np.uint64, len(by_node))
                size = np.array([len(one) for one in by_node.values()], np.int64)
                tokens = []
                for one in by_node.values():
                    order = np.lexsort((one, common[(one & np.uint64(SLOTS - 1)).astype(np.int64)]))
                    tokens.append(one[order[:prefix_length(len(one))]])
                if not tokens:
                    continue
                kept = np.array([len(t) for t in tokens])
                token = np.concatenate(tokens)
                of = np.repeat(np.arange(len(nodes)), kept)
                pos = np.arange(len(of)) - np.repeat(np.cumsum(kept) - kept, kept)
                hot = common[(token & np.uint64(SLOTS - 1)).astype(np.int64)] > HOT
                shard = np.where(hot, shards + (nodes[of] % np.uint64(shards)).astype(np.int64),
                                 (token % np.uint64(shards)).astype(np.int64))
                order = np.lexsort((token, shard))
                names, first = np.unique(shard[order], return_index=True)
                for name, at in zip(names, np.split(order, first[1:]), strict=True):
                    here, inverse = np.unique(of[at], return_inverse=True)
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([name], pa.int64()),
                        "packed": pa.array([pack(
                            np.diff(token[at], prepend=np.uint64(0)), inverse, pos[at],
                            nodes[here], size[here])], pa.binary())})
        trim()
    return send


def _dropper(shards: int):
    def shared_entries(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """The entries of a shard without those whose shingle one set alone has."""
        sent = [unpack(x) for x in rows.column("packed").to_pylist()]
        token = np.concatenate([np.cumsum(s[0].astype(np.uint64)) for s in sent])
        node = np.concatenate([s[3].astype(np.uint64)[s[1]] for s in sent])
        n = np.concatenate([s[4].astype(np.int64)[s[1]] for s in sent])
        pos = np.concatenate([s[2].astype(np.int64) for s in sent])
        order = np.lexsort((node, token))
        token, node, n, pos = token[order], node[order], n[order], pos[order]
        new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
        token, node, n, pos = token[new], node[new], n[new], pos[new]
        if key[0].as_py() < shards:
            _, which, count = np.unique(token, return_inverse=True, return_counts=True)
            kept = count[which] > 1
            token, node, n, pos = token[kept], node[kept], n[kept], pos[kept]
        return pa.table({"token": _long(token), "node": _long(node), "n": pa.array(n, pa.int32()),
                         "pos": pa.array(pos, pa.int32())})
    return shared_entries


def entries(texts: DataFrame, nodes: DataFrame) -> tuple[DataFrame, int]:
    """The prefix entries of all sets where another set has the shingle as well, and the number of
    all prefix entries."""
    spark = texts.sparkSession
    common = np.zeros(SLOTS, np.int64)
    for row in (nodes.where("slot is not null").groupBy("slot").agg(F.sum("k").alias("k"))
                .orderBy(F.desc("k"), "slot").limit(COMMON).collect()):
        common[row.slot] = row.k
    p, q = SIMILAR
    total = nodes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * p / q) + 1)).first()[0] or 0
    shards = -(-int(total) // SHARD_ENTRIES) or 1
    return (texts.select("text").mapInArrow(
        _entry_sender(spark.sparkContext.broadcast(common), shards), BLOCKS)
        .groupBy("shard").applyInArrow(_dropper(shards), ENTRIES)), int(total)


def _fits(n, pos, m, qos):
    """Whether sets of n and m that meet first at these places can be similar enough."""
    p, q = SIMILAR
    left = F.least(F.col(n) - F.col(pos), F.col(m) - F.col(qos))
    return left * (p + q) >= (F.col(n) + F.col(m)) * p


def open_buckets(live: DataFrame) -> DataFrame:
    """Entries in buckets of several components that can be similar to a set of their bucket, with
    the bucket's first set."""
    p, q = SIMILAR
    least = live.groupBy("token").agg(F.min("n").alias("least"))
    able = live.join(least, "token").where(
        (F.col("n") - F.col("pos")) * (p + q) >= (F.col("n") + F.col("least")) * p).drop("least")
    several = (able.groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.min(F.struct("pos", "node", "n")).alias("centre")).where("low <> high")
        .select("token", F.col("centre.node").alias("cnode"), F.col("centre.n").alias("cn"),
                F.col("centre.pos").alias("cpos")))
    return able.join(several, "token")


def mark(one: np.ndarray) -> bytes:
    """The last bits of the hashes of a set, so many that few are equal by chance."""
    bits = len(one).bit_length() + MARK_BITS
    return pack(np.diff(np.sort(one & np.uint64((1 << bits) - 1)), prepend=np.uint64(0)))


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two sets share at most, from the sorted bits of their marks.

    Equal shingles have equal bits, so the bits that both have, as often as both have them, are no fewer.
    """
    bits, sides = min(len(a), len(b)).bit_length() + MARK_BITS, []
    for one in (a, b):
        if len(one).bit_length() + MARK_BITS > bits:
            one = np.sort(one & ((1 << bits) - 1))
        sides.append(one << 32 | np.arange(len(one)) - np.searchsorted(one, one))
    return len(np.intersect1d(*sides, assume_unique=True))


def _marker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, sets in _texts(batch):
            sets = [one for one in sets if len(one)]
            yield pa.RecordBatch.from_arrays(
                [_long([_node(one) for one in sets]),
                 pa.array([mark(one) for one in sets], pa.binary())], ["node", "mark"])
    trim()


def _able(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, q = SIMILAR
    for batch in batches:
        sides = []
        for name in ("ma", "mb"):
            coded = batch.column(name).dictionary_encode()
            sides.append(([np.cumsum(unpack(x)[0], dtype=np.int64)
                           for x in coded.dictionary.to_pylist()], coded.indices.to_pylist()))
        (a, ia), (b, ib) = sides
        able = pa.array([most_shared(a[i], b[j]) * (p + q) >= p * (len(a[i]) + len(b[j]))
                         for i, j in zip(ia, ib, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(able),
                                          batch.column("b").filter(able)], ["a", "b"])


def able_pairs(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes without those whose marks rule out that their sets are similar."""
    both = (pairs.join(marks.select(F.col("node").alias("a"), F.col("mark").alias("ma")), "a")
            .join(marks.select(F.col("node").alias("b"), F.col("mark").alias("mb")), "b"))
    return both.select("a", "b", "ma", "mb").mapInArrow(_able, "a long, b long")


def _verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p, q = SIMILAR
    for batch in batches:
        sides = []
        for name in ("ta", "tb"):
            coded = batch.column(name).cast(pa.large_binary()).dictionary_encode()
            sets: list[np.ndarray] = []
            for row, stop in row_slices(byte_offsets(coded.dictionary), SLICE_BYTES):
                sets += shingle_sets(coded.dictionary.slice(row, stop - row))
            sides.append((sets, coded.indices.to_pylist()))
        (a, ia), (b, ib) = sides
        same = np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) * (p + q)
                         >= p * (len(a[i]) + len(b[j]))
                         for i, j in zip(ia, ib, strict=True)], bool)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(same)),
                                          batch.column("b").filter(pa.array(same))], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar; ``texts`` has a text of each node."""
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))
    return both.select("a", "b", "ta", "tb").mapInArrow(_verifier, "a long, b long")


def alike(nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints, those of the column ``fp``, multi-index hashing links:
    one for each link, and one from each set to the smallest of the same fingerprint."""
    prints = stored(nodes.where("slot is null and n > 0").select("fp", "node").distinct(), "near-prints")
    least = prints.groupBy("fp").agg(F.min("node").alias("least"))
    same = prints.join(least, "fp").select(F.col("node").alias("a"), F.col("least").alias("b"))
    links = simhash_dedup.links(prints)
    ends = (least.toDF(side, f"n{side}") for side in "ab")
    other = links.join(next(ends), "a").join(next(ends), "b").select("na", "nb")
    return stored(same.union(other).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a <> b").distinct(), "near-alike")


def _renamed(live: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries with the components found so far, without the centre of their bucket."""
    return (live.drop("comp", "cnode", "cn", "cpos")
            .join(roots.select(F.col("u").alias("node"), "v"), "node", "left")
            .withColumn("comp", F.coalesce("v", "node")).drop("v"))


def _of_keys(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Keys and texts of the rows that ``keys`` names, and of few others; nothing is exchanged."""
    return split(texts.select(*_KEY, "text"), F.xxhash64(*_KEY),
                 keys.select(F.xxhash64(*_KEY).alias("key")))[0]


def groups(texts: DataFrame, nodes: DataFrame, fingerprints: bool = False) -> DataFrame:
    """(u, v): every linked node that is not the smallest of its component, and that smallest.

    ``texts`` are rows of :func:`keyed`, ``nodes`` the stored rows of their sets. With ``fingerprints``
    the pairs of :func:`alike` are verified first; buckets that these make one component are done.
    """
    found: list[DataFrame] = []
    seeds = alike(nodes) if fingerprints else None
    rows, total = entries(texts, nodes)
    shared = stored(rows.withColumn("comp", F.col("node")), "near-entries")
    live = stored(open_buckets(shared), "near-live")
    discard(shared)
    wanted = live.select("node")
    if seeds is not None:
        wanted = wanted.union(seeds.select("a")).union(seeds.select("b"))
    one = nodes.where("slot is null").join(wanted.distinct(), "node", "left_semi").groupBy("node").agg(
        F.min(F.struct(*_KEY)).alias("key")).select("node", "key.*")
    # One text of each candidate, and of it a mark. No text without a candidate is exchanged, however
    # many candidates there are, and of the texts of candidates only those of able pairs are.
    one = stored(one, "near-keys")
    marks = stored(_of_keys(texts, one).select("text").mapInArrow(_marker, "node long, mark binary")
                   .groupBy("node").agg(F.min("mark").alias("mark")), "near-marks")

    def similar(pairs: DataFrame) -> DataFrame:
        able = stored(able_pairs(pairs, marks), "near-able")
        if able.isEmpty():
            return able
        ends = able.select(F.col("a").alias("node")).union(able.select("b")).distinct()
        keys = stored(one.join(ends, "node", "left_semi"), "near-keys")
        held = stored(_of_keys(texts, keys).join(broadcast_if_small(keys), _KEY)
                      .groupBy("node").agg(F.min("text").alias("text")), "near-texts")
        out = stored(verified(able, held), "near-found")
        discard(held, keys, able)
        return out

    roots, rounds = None, 0
    if seeds is not None:
        found.append(similar(seeds))
        roots = components(found[0])
        before, live = live, stored(open_buckets(_renamed(live, roots)), "near-live")
        discard(before, seeds)
    while not live.isEmpty():
        # Pairs of a bucket across components, before what the sizes and places rule out.
        k = F.col("k")
        size = (live.groupBy("token", "comp").agg(F.count(F.lit(1)).cast("double").alias("k"))
                .groupBy("token").agg(F.sum(k).alias("k"), F.sum(k * k).alias("own"))
                .agg(F.sum((k * k - F.col("own")) / 2).alias("pairs")).first())
        last = rounds >= ROUNDS or (rounds > 0 and size.pairs <= LINEAR * total)
        if last:
            a, b = (live.select("token", *[F.col(c).alias(c + side)
                                           for c in ("node", "comp", "n", "pos")])
                    for side in "ab")
            pairs = a.join(b, "token").where(
                (F.col("nodea") < F.col("nodeb")) & (F.col("compa") != F.col("compb"))
                & _fits("na", "posa", "nb", "posb")).select(
                    F.col("nodea").alias("a"), F.col("nodeb").alias("b"))
        else:
            pairs = live.where((F.col("node") != F.col("cnode")) & _fits("n", "pos", "cn", "cpos")
                               ).select(F.col("node").alias("a"), F.col("cnode").alias("b"))
        pairs = stored(pairs.distinct(), "near-pairs")
        found.append(similar(pairs))
        roots = components(reduce(DataFrame.union, found))
        if last:
            break
        rest = _renamed(live.where("node <> cnode"), roots)
        before, live = live, stored(open_buckets(rest), "near-live")
        discard(before, pairs)
        rounds += 1
    return roots if roots is not None else live.select(F.col("node").alias("u"),
                                                       F.col("node").alias("v"))


def first_of_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    fingerprints: bool = False) -> DataFrame:
    """The rows of ``df`` that stay, one for each group.

    With ``fingerprints``, the groups are the same; they are first looked for by the multi-index hashing of
    ``simhash_dedup``. Rows alone in their group, most of them, are not exchanged.
    """
    rows = keyed(df, id_col, text_col)
    with scratch(df.sparkSession, "near-first", "near-several"), freed_shuffles(df.sparkSession):
        nodes = stored(rows.select(*_KEY, "text").mapInArrow(
            lambda batches: _nodes(batches, fingerprints), NODES), "near-nodes")
        roots = groups(rows, nodes, fingerprints).select("u", "v")
        one = (nodes.where("slot is null").groupBy("node")
               .agg(F.min(F.struct(*_KEY)).alias("first"), F.count(F.lit(1)).alias("n")))
        rooted = stored(one.join(roots.toDF("node", "v"), "node", "left").select(
            "node", F.coalesce("v", "node").alias("root"), "first", "n"), "near-roots")
        first = stored(rooted.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")),
                       "near-first")
        shared = rooted.join(first.where("n > 1").select("root"), "root", "left_semi")
        key = F.xxhash64(*_KEY)
        several, _ = split(nodes.where("slot is null"), F.xxhash64("node"),
                           shared.select(F.xxhash64("node").alias("key")))
        several = stored(several.select(key.alias("key")).distinct(), "near-several")
    some, alone = split(rows, key, several)
    # Equal rows meet by partial aggregation before they are dealt out.
    kept = (some.groupBy(*_KEY).agg(F.min("row").alias("row"))
            .join(first.select("first.*"), _KEY, "left_semi"))
    return kept.select("row.*").union(alone.select("row.*"))
