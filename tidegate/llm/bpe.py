"""Byte-level BPE encoding and decoding with recursive DuckDB queries, one database per task.

Encoding: Spark splits the text into pieces with the vocabulary's pattern. A task takes the
distinct pieces of an Arrow batch and stores them as token-position rows, one per byte. A
recursive query joins neighbouring tokens with the merge table, contracts the leftmost pair of
minimum rank of every piece, and repeats until no piece has a pair left. Decoding joins token rows
with the vocabulary and aggregates the bytes in token order.

A piece of over ``SHORT_BYTES`` bytes (a run of letters without blanks, most Chinese, Thai or Japanese
text) would need as many steps as it has tokens, each over all its rows. It is cut first wherever no
token of the vocabulary that lies in it reaches across, as no merge does. What is still long is cut
into windows that overlap by half; distinct windows are contracted by the same query, all in one. Two
neighbouring windows are joined at a token that both have in their overlap. That gives the ids of the
whole: a list of tokens is the encoding of its bytes when every two neighbours are that of theirs, and
each two neighbours come from one window. Windows without such a token are doubled until there is one,
at last to the whole piece.

The rank file is read by the driver (a vocabulary, under 2 MB) and broadcast.

Defined results: a null text is encoded as empty; empty texts give no ids; null ids decode to no
bytes, an id outside the vocabulary raises; rows stay separate, repeated or not.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.arrow import binary_words, list_ends, row_slices, word_arrays
from tidegate.llm.common import body, ship, trim

ship(__name__)

#: Distinct parts of pieces in one query, bytes of short pieces cut at once, pieces and tokens in one slice
#: of a batch, and the memory of a database: they bound the memory of a task. One text may have more.
QUERY_PIECES = 20_000
SLICE_BYTES = 2_000_000
SLICE_PIECES = 3_000_000
SLICE_TOKENS = 250_000
QUERY_BYTES = 300_000
#: Without a folder for it a database does not spill: an executor's disk is not shared.
DATABASE = {"threads": 1, "memory_limit": "150MB", "temp_directory": ""}
#: Longer pieces are cut; the first length of a window.
SHORT_BYTES = 64
WINDOW = 32

# The token rows of the last step of each piece, as a list in order of position.
_RESULT = """
select word, any_value(last) as step, list(tok order by pos) as toks
from step join (select word, max(step) as last from step group by word) using (word)
where step = last group by word order by word"""

# A token row knows the token to its right and the code of the two: the id they merge into and the place,
# so that the least code of a piece is its leftmost pair of minimum rank. Only the merged row and the
# row before it get a new code.
SHORT = f"""
with recursive step as (
 select 0 as step, word, pos, tok, right_tok, right_pos, (merged::bigint << 32) | pos as code
 from pieces left join merges on left_id = tok and right_id = right_tok
 union all
 select step + 1, word, pos, now.tok, now.right_tok, now.right_pos,
        case when moved then (merged::bigint << 32) | pos else now.code end
 from (select step, s.word, s.pos, s.code,
              s.pos = place or s.right_pos = place as moved,
              case when s.pos = place then made else s.tok end as tok,
              case when s.pos = place then best.right_tok when s.right_pos = place then made
                   else s.right_tok end as right_tok,
              case when s.pos = place then best.right_pos else s.right_pos end as right_pos
       from step s join (
         select b.word, (least_code >> 32)::int as made, (least_code & 4294967295)::int as place,
                gone,
                r.right_tok, r.right_pos
         from (select word, min(code) as least_code, arg_min(right_pos, code) as gone
               from step where code is not null group by word) b
         join step r on r.word = b.word and r.pos = b.gone) best
       on s.word = best.word and s.pos <> gone) now
 left join merges on moved and left_id = now.tok and right_id = now.right_tok)
{_RESULT}"""

DECODE = """
select doc, array_to_string(list(bytes order by pos), '') as bytes
from tokens left join vocabulary using (id) group by doc order by doc"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _connect(ranks: dict[bytes, int]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config=DATABASE)
    splits = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
              if t[:i] in ranks and t[i:] in ranks]
    columns = np.array(splits, np.int32).reshape(-1, 3).T
    merges = pa.table(dict(zip(["left_id", "right_id", "merged"], columns, strict=True)))
    con.register("merge_rows", merges)
    con.execute("create table merges as select * from merge_rows")
    con.unregister("merge_rows")
    return con


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _contract(con, query: str, tokens: np.ndarray, lengths: np.ndarray):
    """The tokens of each piece after all its contractions, flat, and their number per piece."""
    word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    pos = _flat(np.zeros(len(lengths), np.int64), lengths).astype(np.int32)
    tokens = tokens.astype(np.int32)
    right_tok, right_pos = np.append(tokens[1:], tokens[:1]), pos + np.int32(1)
    last = np.cumsum(lengths)[lengths > 0] - 1
    right_tok[last] = right_pos[last] = -1
    con.register("pieces", pa.table({"word": word, "pos": pos, "tok": tokens,
                                     "right_tok": right_tok, "right_pos": right_pos}))
    found = con.execute(query).to_arrow_table().combine_chunks()
    con.unregister("pieces")
    lists = found["toks"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return (lists.flatten().to_numpy(zero_copy_only=False),
            np.diff(lists.offsets.to_numpy()), found["step"].to_numpy())


class Vocabulary:
    """What a task needs of the ranks to cut long pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.first = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.length = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.length[list(ranks.values())] = [len(t) for t in ranks]
        flat = np.frombuffer(b"".join(t for t in ranks if len(t) > 1), np.uint8).astype(np.int64)
        sizes = np.array([len(t) for t in ranks if len(t) > 1], np.int64)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))    # bytes to the end
        two, three = np.flatnonzero(left[:-1] >= 2), np.flatnonzero(left[:-2] >= 3)
        #: Two bytes that are a token, and three neighbouring bytes of any token.
        self.pairs = np.zeros(1 << 16, bool)
        whole = two[(np.append(True, left[:-1] == 1)[two]) & (left[two] == 2)]
        self.pairs[flat[whole] << 8 | flat[whole + 1]] = True
        self.triples = np.zeros(1 << 24, bool)
        self.triples[flat[three] << 16 | flat[three + 1] << 8 | flat[three + 2]] = True

    def cuts(self, data: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """Places in a piece, or in and between several of these lengths, that no token reaches across."""
        b = data.astype(np.int32)
        triple = self.triples[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
        crossed = self.pairs[b[:-1] << 8 | b[1:]]
        if lengths is not None:
            ends = np.cumsum(lengths)
            ends = ends[(ends > 0) & (ends < len(data))]
            crossed[ends - 1] = False
            for at in (ends - 2, ends - 1):
                triple[at[(at >= 0) & (at < len(triple))]] = False
        crossed[:-1] |= triple              # the triple that begins before the place
        crossed[1:] |= triple               # and the one that ends behind it
        return np.flatnonzero(~crossed) + 1


def _encode_units(con, vocabulary: Vocabulary, units: list[bytes]) -> dict[bytes, np.ndarray]:
    """Ids of distinct short byte strings."""
    out: dict[bytes, np.ndarray] = {}
    ends = np.cumsum([0, *map(len, units)])
    for low, high in row_slices(ends, QUERY_BYTES):
        data = np.frombuffer(b"".join(units[low:high]), np.uint8)
        ids, n, _ = _contract(con, SHORT, vocabulary.first[data], np.diff(ends[low:high + 1]))
        out.update(zip(units[low:high], np.split(ids, np.cumsum(n)[:-1]), strict=True))
    return out


def _windows(piece: bytes, size: int) -> list[bytes]:
    step = size // 2
    return [piece[at:at + size] for at in range(0, max(1, len(piece) - step), step)]


def _joined(parts: list[np.ndarray], step: int, vocabulary: Vocabulary) -> np.ndarray | None:
    """The ids of windows that begin every ``step`` bytes as one list, or None if two neighbours
    have no token in common."""
    out, after, last, last_ids = [], 0, None, None
    for number, ids in enumerate(parts):
        size = vocabulary.length[ids]
        tokens = (number * step + np.cumsum(size) - size) << 20 | size
        if last is not None:
            both = np.intersect1d(last[after:], tokens, assume_unique=True)
            if not len(both):
                return None
            middle = both[len(both) // 2]
            out.append(last_ids[after:np.searchsorted(last, middle) + 1])
            after = int(np.searchsorted(tokens, middle)) + 1
        last, last_ids = tokens, ids
    return np.concatenate([*out, last_ids[after:]])


def _encode_long(con, vocabulary: Vocabulary, pieces_: list[bytes]) -> list[np.ndarray]:
    """Ids of pieces of any length."""
    parts = []
    for piece in pieces_:
        places = [0, *vocabulary.cuts(np.frombuffer(piece, np.uint8)).tolist(), len(piece)]
        parts.append([piece[a:b] for a, b in zip(places, places[1:], strict=False)])
    every = dict.fromkeys(p for some in parts for p in some)
    known = _encode_units(con, vocabulary, [p for p in every if len(p) <= SHORT_BYTES])
    open_, size = [p for p in every if len(p) > SHORT_BYTES], WINDOW
    while open_:
        units = dict.fromkeys(w for p in open_ for w in _windows(p, size))
        ids = _encode_units(con, vocabulary, list(units))
        for p in open_:
            joined = _joined([ids[w] for w in _windows(p, size)], size // 2, vocabulary)
            if joined is not None:
                known[p] = joined
        open_, size = [p for p in open_ if p not in known], 2 * size
    return [np.concatenate([known[p] for p in some]) for some in parts]


def _encode_short(con, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
    """Flat ids and their number per piece. Pieces are cut as long ones are, and a part that several
    of them have is contracted once."""
    starts = np.append(0, vocabulary.cuts(data, lengths))
    every = binary_words(np.append(starts, len(data)), data).dictionary_encode()
    offsets, units = word_arrays(every.dictionary)
    found = []
    for i in range(0, len(offsets) - 1, QUERY_PIECES):
        here = offsets[i:i + QUERY_PIECES + 1]
        found.append(_contract(con, SHORT, vocabulary.first[units[here[0]:here[-1]]],
                               np.diff(here))[:2])
    ids, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    index = every.indices.to_numpy(zero_copy_only=False)
    begin = np.cumsum(counts) - counts
    before = np.append(0, np.cumsum(counts[index]))
    firsts = np.searchsorted(starts, np.append(0, np.cumsum(lengths)))
    return ids[_flat(begin[index], counts[index])], np.diff(before[firsts])


def _encode_pieces(con, vocabulary: Vocabulary, data: np.ndarray, lengths: np.ndarray):
    """Ids of pieces given as flat bytes: flat ids and their number per piece."""
    if not len(lengths):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    starts = np.cumsum(lengths) - lengths
    counts, parts = np.zeros(len(lengths), np.int64), {}
    short = np.flatnonzero(lengths <= SHORT_BYTES)
    for low, high in row_slices(np.append(0, np.cumsum(lengths[short])), SLICE_BYTES):
        some = short[low:high]
        ids, counts[some] = _encode_short(con, vocabulary,
                                          data[_flat(starts[some], lengths[some])], lengths[some])
        parts[int(some[0])] = (some, ids)
    long = np.flatnonzero(lengths > SHORT_BYTES)
    if len(long):
        found = _encode_long(con, vocabulary, [data[starts[i]:starts[i] + lengths[i]].tobytes()
                                               for i in long])
        counts[long] = [len(ids) for ids in found]
        parts[-1] = (long, np.concatenate(found))
    flat, begin = np.empty(counts.sum(), np.int32), np.cumsum(counts) - counts
    for some, ids in parts.values():
        flat[_flat(begin[some], counts[some])] = ids
    return flat, counts


def _encoder(shared):
    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        con = _connect(ranks)
        vocabulary = Vocabulary(ranks)
        for batch in batches:
            every = batch.column("pieces")
            for top, bottom in row_slices(list_ends(every), SLICE_PIECES):
                lists = every.slice(top, bottom - top)
                ends = list_ends(lists)
                words = lists.flatten().dictionary_encode()
                distinct = words.dictionary.cast(pa.large_binary())
                offsets = np.frombuffer(distinct.buffers()[1], np.int64)[
                    distinct.offset:distinct.offset + len(distinct) + 1]
                data = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)
                data = data[offsets[0]:offsets[-1]] if len(distinct) else data[:0]
                ids, counts = _encode_pieces(con, vocabulary, data, np.diff(offsets))
                begin = np.cumsum(counts) - counts
                index = words.indices.to_numpy(zero_copy_only=False)
                total = np.concatenate([[0], np.cumsum(counts[index])])     # ids before a piece
                for row, stop in row_slices(total[ends], SLICE_TOKENS):
                    here = index[ends[row]:ends[stop]]
                    marks = (total[ends[row:stop + 1]] - total[ends[row]]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(top + row, stop - row),
                         pa.ListArray.from_arrays(pa.array(marks), pa.array(
                             ids[_flat(begin[here], counts[here])], pa.int32()))],
                        ["doc_id", "ids"])
        con.close()
        trim()
    return encode_batches


def _decoder(shared):
    def decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config=DATABASE)
        ranks = shared.value
        con.register("rows", pa.table({"id": pa.array(ranks.values(), pa.int32()),
                                       "bytes": pa.array([t.hex() for t in ranks])}))
        con.execute("create table vocabulary as select * from rows")
        known = np.zeros(max(ranks.values(), default=0) + 1, bool)
        known[list(ranks.values())] = True
        for batch in batches:
            lists = batch.column("ids")
            ends = list_ends(lists)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if len(flat) and not (0 <= flat.min() and flat.max() < len(known)
                                  and known[flat].all()):
                raise ValueError("an id is not in the vocabulary")
            for row, stop in row_slices(ends, SLICE_TOKENS):
                n = np.diff(ends[row:stop + 1])
                ids = flat[ends[row]:ends[stop]]
                con.register("tokens", pa.table({
                    "doc": np.repeat(np.arange(stop - row, dtype=np.int32), n),
                    "pos": np.arange(len(ids), dtype=np.int32), "id": ids.astype(np.int32)}))
                found = con.execute(DECODE).fetchall()
                con.unregister("tokens")
                out = [b""] * (stop - row)
                for doc, text in found:
                    out[doc] = bytes.fromhex(text)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, stop - row), lists.slice(row, stop - row),
                     pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])
        con.close()
        trim()
    return decode_batches


def pieces(text: Column, pattern: str) -> Column:
    """Matches of the pattern, its white space being Unicode's as in the tokenizer library."""
    return F.regexp_extract_all(text, F.lit(f"(?U){pattern}"), F.lit(0))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id and ids of every text."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    split = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      pieces(body(F.col(f"`{text_col}`").cast("string")), pattern).alias("pieces"))
    return split.mapInArrow(_encoder(shared), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids and the bytes they stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    return encoded.select("doc_id", "ids").mapInArrow(
        _decoder(shared), "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, number of ids, digest of the decimal ids and of the decoded bytes."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
