"""Log probabilities of texts by a bigram model kept in Elias-Fano tries.

Tokens are the words of a text, A-Z in lower case, then one end. The base model is add-one over the
tokens of the training rows, P1(w) = (c(w) + 1) / (N + V + 1). The model proper is its mixture with the
words seen after the one before (the begin for the first), P(w|u) = (c(u,w) + MU P1(w)) / (c(u) + MU);
over the known words and one unknown it adds up to 1. Log probabilities are quantised in steps of
1/STEPS, so sums are whole numbers and equal however the work is cut.

Three exchanges, all of packed rows, one for each slice of documents and shard:
1. Each slice sends its distinct words with their training counts; a shard of words adds them up,
   numbers the words and sends numbers and counts back.
2. Each slice sends its distinct pairs, with c(u), the quantised P1(w) and where they occur, to a shard
   by u; pairs of a u that is frequent are spread by w. A shard adds up the training counts, builds the
   trie of its pairs (``trie``), maps it into memory, searches all pairs of its slices in it and adds
   up the quantised log probabilities by document.
3. The sums of a slice's documents come together.

The tries of all shards hold every pair of the corpus: their number grows with the tokens, the size of
each does not. A word or pair is at most once in a slice, so a hot one costs a shard one entry for
each slice. The driver sees counts only.

Defined results: a null text counts as empty and has the end alone; a null id is scored, and its row
trains unless ``held_out`` is true; repeated rows are texts of their own and count each; a text longer
than a slice is a slice of its own; an empty table gives an empty result; without training rows N, V
and all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm import trie
from tidegate.llm.arrow import (
    binary_words,
    breaks_of,
    byte_offsets,
    flat_words,
    pack,
    row_slices,
    unpack,
    word_arrays,
)
from tidegate.llm.common import body, ship
from tidegate.session import discard, stored

ship(__name__)

BREAKS = breaks_of(0x20, *range(0x09, 0x0E))
#: Weight of the base model in the mixture, and steps of a quantised log10.
MU = 200.0
STEPS = 2000
#: Bytes of text in a slice, words and pairs in a shard, and the count from which the pairs of a
#: word are spread over all shards: memory of a task.
SLICE_BYTES = 8_000_000
SHARD_WORDS = 500_000
SHARD_PAIRS = 1_000_000
HOT = 100_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
SLICES = ("slice long, doc_ids array<long>, held array<boolean>, tokens binary, words binary, "
          "n_words long, n_tokens long")
NUMBERED = "slice long, numbers binary, known long, train long"
PAIRS = ("shard int, slice long, pairs binary, doc_ids array<long>, held array<boolean>, "
         "n_tokens array<long>, n_known array<long>, base array<double>")
PARTS = PAIRS.replace("shard int, ", "").replace("pairs", "sums")
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
          "score double")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
        for row, stop in row_slices(byte_offsets(texts), SLICE_BYTES):
            words, ends = flat_words(texts.slice(row, stop - row), BREAKS)
            coded = words.dictionary_encode()
            n = np.diff(ends) + 1
            # The end is the empty word, after the words of each text.
            tokens = np.full(n.sum(), len(coded.dictionary), np.int64)
            is_word = np.ones(len(tokens), bool)
            is_word[np.cumsum(n) - 1] = False
            tokens[is_word] = coded.indices.to_numpy(zero_copy_only=False)
            train = np.repeat(~held[row:stop], n)
            counts = np.bincount(tokens[train], minlength=len(coded.dictionary) + 1)
            every = pa.concat_arrays([coded.dictionary.cast(pa.large_binary()),
                                      pa.array([b""], pa.large_binary())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), _one(batch.column("doc_id").slice(row, stop - row)),
                 _one(pa.array(held[row:stop])), pa.array([pack(n, tokens)], pa.binary()),
                 pa.array([pack(*word_arrays(every), counts)], pa.binary()),
                 pa.array([len(every)]), pa.array([len(tokens)])],
                ["slice", "doc_ids", "held", "tokens", "words", "n_words", "n_tokens"])
            number += 1


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs and the places where it does."""
    order = np.argsort(shard, kind="stable")
    names, first = np.unique(shard[order], return_index=True)
    for name, at in zip(names, np.split(order, first[1:]), strict=True):
        yield int(name), at


def _word_sender(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_, packed in zip(batch.column("slice").to_pylist(),
                                      batch.column("words").to_pylist(), strict=True):
                offsets, data, counts = unpack(packed)
                words = binary_words(offsets, data)
                shard = np.fromiter((xxhash.xxh64_intdigest(w) % shards
                                     for w in words.to_pylist()), np.int64, len(words))
                for name, at in _by_shard(shard):
                    some = words.take(pa.array(at))
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([name], pa.int32()), "slice": pa.array([slice_]),
                        "words": pa.array([pack(*word_arrays(some), counts[at], at)],
                                          pa.binary())})
    return send


def _word_numberer(shards: int):
    def number(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        sent = [unpack(x) for x in rows.column("words").to_pylist()]
        coded = pa.chunked_array([binary_words(o, d) for o, d, _, _ in sent]).combine_chunks()
        coded = coded.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        train = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(train, code, np.concatenate([k for _, _, k, _ in sent]).astype(np.int64))
        # Numbers follow the order of the words and the shard: a lost task gives the same again.
        rank = np.empty(len(train), np.int64)
        rank[pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False)] = np.arange(
            len(train))
        ids = rank * shards + int(key[0].as_py()) + 1          # 0 is the begin
        out, at = [], 0
        for _, _, _, places in sent:
            some = code[at:at + len(places)]
            out.append(pack(places, ids[some], train[some]))
            at += len(places)
        first = np.arange(len(sent)) == 0
        return pa.table({"slice": rows.column("slice"), "numbers": pa.array(out, pa.binary()),
                         "known": pa.array(np.where(first, (train > 0).sum(), 0)),
                         "train": pa.array(np.where(first, train.sum(), 0))})
    return number


def quantised(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(p) * STEPS), 65535).astype(np.int64)


def _mixed(*numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers[0]), np.uint64)
    for a in numbers:
        out = (out ^ a.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _pair_sender(shards: int, train: int, known: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n, tokens = (a.astype(np.int64) for a in unpack(batch.column("tokens")[row].as_py()))
                size = batch.column("n_words")[row].as_py()
                ids, count = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for packed in batch.column("numbers")[row].values.to_pylist():
                    at, numbers, counts = unpack(packed)
                    ids[at], count[at] = numbers, counts
                first = np.cumsum(n) - n
                c = count[tokens]
                base = np.log10((c + 1) / (train + known + 1))
                held = batch.column("held")[row].values
                yield _pair_batch(
                    int(batch.column("slice")[row].as_py() % shards),
                    batch.column("slice").slice(row, 1), None,
                    [batch.column("doc_ids").slice(row, 1), batch.column("held").slice(row, 1),
                     _one(pa.array(n)), _one(pa.array(np.add.reduceat((c > 0).astype(np.int64),
                                                                      first))),
                     _one(pa.array(np.add.reduceat(base, first)))])
                # Words in order of their numbers, after the begin; the end word counts texts.
                order = np.argsort(ids, kind="stable")
                rank = np.empty(size, np.int64)
                rank[order] = np.arange(1, size + 1)
                ids, count = np.append(0, ids[order]), np.append(count[size - 1], count[order])
                v = rank[tokens]
                u = np.append(0, v[:-1])
                u[first] = 0
                key = u * (size + 1) + v
                by_key = np.argsort(key, kind="stable")
                pair, begin = np.unique(key[by_key], return_index=True)
                u, v = pair // (size + 1), pair % (size + 1)
                doc = np.repeat(np.arange(len(n)), n)[by_key]
                learned = (~held.to_numpy(zero_copy_only=False).astype(bool))[doc]
                k = np.add.reduceat(learned.astype(np.int64), begin)
                times = np.diff(np.append(begin, len(doc)))
                q1 = quantised((count + 1) / (train + known + 1))
                shard = np.where(count[u] > HOT, _mixed(ids[u], ids[v]), _mixed(ids[u]))
                for name, at in _by_shard((shard % np.uint64(shards)).astype(np.int64)):
                    contexts, runs_of = np.unique(u[at], return_counts=True)
                    where = np.repeat(begin[at] - (np.cumsum(times[at]) - times[at]), times[at])
                    where = where + np.arange(len(where))
                    yield _pair_batch(
                        name, batch.column("slice").slice(row, 1),
                        pack(np.diff(ids[contexts], prepend=0), runs_of, count[contexts],
                             ids[v[at]], q1[v[at]], k[at], times[at], doc[where]), None)
    return send


def _pair_batch(shard: int, slice_, packed: bytes | None, docs: list | None) -> pa.RecordBatch:
    kinds = [pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.list_(pa.float64())]
    docs = docs or [pa.nulls(1, kind) for kind in kinds]
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), slice_, pa.array([packed], pa.binary()),
         *[d.cast(kind) for d, kind in zip(docs, kinds, strict=True)]],
        ["shard", "slice", "pairs", "doc_ids", "held", "n_tokens", "n_known", "base"])


def _add_up(rows: pa.Table) -> pa.Table:
    """The sums of quantised log probabilities by document of each slice, in one shard."""
    sent = {i: unpack(x) for i, x in enumerate(rows.column("pairs").to_pylist()) if x is not None}
    sums: list[bytes | None] = [None] * len(rows)
    if sent:
        def flat(of) -> np.ndarray:
            return np.concatenate([of(s).astype(np.int64) for s in sent.values()])

        u = flat(lambda s: np.repeat(np.cumsum(s[0].astype(np.int64)), s[1]))
        cu = flat(lambda s: np.repeat(s[2], s[1]))
        v, q1, k = (flat(lambda s, i=i: s[i]) for i in (3, 4, 5))
        order = np.lexsort((v, u))
        new = np.append(True, (np.diff(u[order]) != 0) | (np.diff(v[order]) != 0))
        begin = np.flatnonzero(new)
        which = np.empty(len(u), np.int64)
        which[order] = np.cumsum(new) - 1
        count = np.add.reduceat(k[order], begin)
        u, v, cu, q1 = (a[order][begin] for a in (u, v, cu, q1))
        seen = np.flatnonzero(count)
        probability = (count + MU * 10.0 ** (-q1 / STEPS)) / (cu + MU)
        _, context = np.unique(u[seen], return_index=True)
        model = trie.mapped(trie.build(
            u[seen], v[seen], quantised(MU / (cu[seen][context] + MU)),
            quantised(probability[seen])))
        at, place = model.find(u, v)
        # A context without a pair in this shard has the weight of its count all the same.
        backoff = quantised(MU / (cu + MU))
        if len(model.backoff):
            backoff = np.where(at >= 0, model.backoff[np.maximum(at, 0)], backoff)
        q = backoff + q1
        if len(model.probability):
            q = np.where(place >= 0, model.probability[np.maximum(place, 0)], q)
        at = 0
        for i, s in sent.items():
            values = np.repeat(q[which[at:at + len(s[3])]], s[6])
            doc, inverse = np.unique(s[7], return_inverse=True)
            total = np.zeros(len(doc), np.int64)
            np.add.at(total, inverse, values)
            sums[i] = pack(doc, total)
            at += len(s[3])
    return pa.table({"slice": rows.column("slice"), "sums": pa.array(sums, pa.binary()),
                     **{c: rows.column(c) for c in
                        ("doc_ids", "held", "n_tokens", "n_known", "base")}})


def _finish(rows: pa.Table) -> pa.Table:
    """The documents of one slice with their sums."""
    docs = rows.filter(pc.is_valid(rows.column("n_tokens")))
    columns = [docs.column(c).combine_chunks()[0].values
               for c in ("doc_ids", "held", "n_tokens", "n_known", "base")]
    total = np.zeros(len(columns[0]), np.int64)
    for packed in rows.column("sums").to_pylist():
        if packed is not None:
            doc, part = unpack(packed)
            total[doc] += part.astype(np.int64)
    return pa.table([*columns, pa.array(-total / STEPS)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def held_out(doc_id: Column, of: int = 7, rest: int = 2) -> Column:
    """Whether the crc32 of an id, in decimal, leaves this rest."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == rest, F.lit(False))


def score(df: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text"
          ) -> tuple[DataFrame, int]:
    """doc_id, held_out, n_tokens, n_known, base_score and score of every row, and the number of
    training tokens. Rows where ``held`` is not true are learned from."""
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(held, F.lit(False)).alias("held"),
                      body(F.col(f"`{text_col}`").cast("string")).cast("binary").alias("text"))
    slices = stored(texts.mapInArrow(_slices, SLICES), "lm-slices")
    sizes = slices.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    word_shards = -(-(sizes.words or 1) // SHARD_WORDS)
    pair_shards = -(-(sizes.tokens or 1) // SHARD_PAIRS)
    numbered = stored(
        slices.select("slice", "words").mapInArrow(
            _word_sender(word_shards), "shard int, slice long, words binary")
        .groupBy("shard").applyInArrow(_word_numberer(word_shards), NUMBERED), "lm-words")
    seen = numbered.agg(F.sum("known").alias("known"), F.sum("train").alias("train")).first()
    train, known = seen.train or 0, seen.known or 0
    numbers = numbered.groupBy("slice").agg(F.collect_list("numbers").alias("numbers"))
    pairs = (slices.select("slice", "doc_ids", "held", "tokens", "n_words").join(numbers, "slice")
             .mapInArrow(_pair_sender(pair_shards, train, known), PAIRS))
    sums = pairs.groupBy("shard").applyInArrow(_add_up, PARTS)
    out = stored(sums.groupBy("slice").applyInArrow(_finish, SCORES), "lm-scores")
    discard(slices, numbered)
    return out, train
