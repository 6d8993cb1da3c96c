"""Language of texts by a linear-chain conditional random field over their words.

Every word of a text gets a language; neighbouring words are tied by learned transitions, so a
switch of language inside a text is found where it happens. Features of a word are its character
n-grams of two to four characters with the word's ends (those at an end are its affixes) and, for
each language, whether the word is in that language's lexicon. Forward-backward gives each word a
probability per language; the text's language has the highest mean over its words, and that mean
is the score.

Training: at most ``SAMPLE_DOCS`` texts per language (a hash of the id picks them), cut into their
lines. Lines of different languages are spliced into one sequence, so that switches occur. The
model is fitted on the driver by full-batch gradient steps on the CRF likelihood. Its size is
fixed (``2**BITS`` rows of weights) and it is broadcast.

Defined results: null texts and texts without a letter are ``und`` with score 0; a null id is
never learned from and counts as held out; without any labelled text everything is ``und``; ties
go to the first language in alphabetical order; repeated rows each get their result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.llm.arrow import distinct_words, list_ends, row_slices
from tidegate.llm.common import body, ship, trim

ship(__name__)

UNKNOWN = "und"
SAMPLE_DOCS = 100
LEXICON = 400
BITS = 18
ROUNDS = 30
#: Words that a task looks up, computes probabilities for and hashes at a time. One text may
#: have more. They bound its memory.
BATCH_WORDS = 500_000
SLICE_WORDS = 200_000
CHUNK_WORDS = 20_000


def held_out(id_: Column, folds: int, fold: int) -> Column:
    """Whether a row is kept from training; a null id is."""
    part = F.crc32(id_.cast("string").cast("binary")) % folds
    return F.coalesce(part == fold, F.lit(True))


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(body(text)), F.lit(r"\p{L}+"), F.lit(0))


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray          # hashed n-gram, label
    lexicon: dict[str, list[int]]   # word: the languages whose lexicon has it
    known: np.ndarray          # language of the lexicon, label
    start: np.ndarray          # label
    moves: np.ndarray          # label before, label


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, flat, and where each word begins."""
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"),
                          np.uint32).astype(np.uint64)
    ends = np.flatnonzero(codes == 10)
    mask, out, word_of = np.uint64((1 << BITS) - 1), [], []
    owner = np.cumsum(codes == 10) - 1          # the word that a character or its left end is in
    for n in (2, 3, 4):
        size = len(codes) - n + 1
        if size <= 0:
            continue
        h = np.full(size, n, np.uint64)
        for i in range(n):
            h = (h ^ codes[i:i + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        # Only n-grams that end at or before the right end of their word.
        right = ends[np.minimum(owner[:size] + 1, len(ends) - 1)]
        inside = (np.arange(size) + n - 1 <= right) & (owner[:size] < len(words))
        out.append((h & mask)[inside].astype(np.int64))
        word_of.append(owner[:size][inside])
    rows, owners = np.concatenate(out), np.concatenate(word_of)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(words)))


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """Log weights of every word and label."""
    out = np.zeros((len(words), len(model.labels)), np.float32)
    for i in range(0, len(words), CHUNK_WORDS):
        some = words[i:i + CHUNK_WORDS]
        rows, begin = gram_rows(some)
        out[i:i + len(some)] = np.add.reduceat(model.grams[rows], begin, axis=0)
        held = np.array([(at, label) for at, w in enumerate(some, i)
                         for label in model.lexicon.get(w, ())], np.int64).reshape(-1, 2)
        np.add.at(out, held[:, 0], model.known[held[:, 1]])
    return out


def marginals(model: Model, scores: np.ndarray, ends: np.ndarray,
              pairs: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Forward-backward over sequences of word scores, all sequences a step at a time.

    ``ends`` bounds the sequences. Returns label probabilities per word and the log of the
    normalizers' sum; ``pairs`` gets the expected transitions added.
    """
    lengths = np.diff(ends)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = ends[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")     # sequences longer than t
    top = scores.max(axis=1, keepdims=True)
    local = np.exp(scores - top)
    moves, forward = np.exp(model.moves), np.empty_like(local)
    log_z = float(top.sum())
    scale = np.empty(len(scores), local.dtype)
    for t in range(steps):
        at = begin[:active[t]] + t
        now = local[at] * (np.exp(model.start) if t == 0 else forward[at - 1] @ moves)
        total = now.sum(axis=1)
        forward[at], scale[at] = now / total[:, None], total
    log_z += float(np.log(scale).sum())
    out = forward.copy()
    back = np.ones((len(lengths), scores.shape[1]), local.dtype)
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        at = begin[:n] + t
        message = local[at + 1] * back[:n] / scale[at + 1][:, None]
        if pairs is not None:
            pairs += moves * (forward[at].T @ message)
        back[:n] = message @ moves.T
        out[at] = forward[at] * back[:n]
    return out, log_z


def sequences(texts: list[tuple[int, list[list[str]]]], seed: int = 0) -> list[list[tuple]]:
    """Lines of (label, word) in an order that mixes languages, some lines to a sequence."""
    lines = [[(label, w) for w in line] for label, doc in texts for line in doc if line]
    np.random.default_rng(seed).shuffle(lines)
    return [sum(lines[i:i + 4], []) for i in range(0, len(lines), 4)]


def fit(labels: list[str], texts: list[tuple[int, list[list[str]]]]) -> Model:
    """Texts are (label number, lines of words)."""
    k = len(labels)
    per_label = [Counter() for _ in labels]
    for label, doc in texts:
        per_label[label].update({w for line in doc for w in line})
    lexicon: dict[str, list[int]] = {}
    for label, counted in enumerate(per_label):
        top = sorted(counted.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]
        for word, n in top:
            if n > 1:
                lexicon.setdefault(word, []).append(label)
    model = Model(labels, np.zeros((1 << BITS, k), np.float32), lexicon,
                  np.zeros((k, k), np.float32), np.zeros(k), np.zeros((k, k)))
    rows = sequences(texts)
    if not rows or k == 0:
        return model
    words = sorted({w for row in rows for _, w in row})
    number = {w: i for i, w in enumerate(words)}
    index = np.array([number[w] for row in rows for _, w in row])
    truth = np.array([label for row in rows for label, _ in row])
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    inner = np.ones(len(index), bool)
    inner[ends[:-1]] = False
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
    count = len(rows)
    del rows, number
    grams, begin = gram_rows(words)
    sizes = np.diff(np.concatenate([begin, [len(grams)]]))
    bits = np.zeros((len(words), k), np.float32)
    for at, word in enumerate(words):
        bits[at, lexicon.get(word, [])] = 1
    parts = [model.grams, model.known, model.start, model.moves]
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    for step in range(1, ROUNDS + 1):
        pairs = np.zeros((k, k))
        by_word = np.add.reduceat(model.grams[grams], begin, axis=0) + bits @ model.known
        chance, _ = marginals(model, by_word[index].astype(np.float64), ends, pairs)
        chance[np.arange(len(index)), truth] -= 1
        of_word = np.stack([np.bincount(index, chance[:, i], len(words)) for i in range(k)], 1)
        spread = np.repeat(of_word, sizes, axis=0)
        slopes = [np.stack([np.bincount(grams, spread[:, i], 1 << BITS) for i in range(k)], 1),
                  bits.T @ of_word,
                  chance[ends[:-1]].sum(axis=0), pairs - seen_moves]
        for i, (part, slope) in enumerate(zip(parts, slopes, strict=True)):   # Adam
            slope = slope / count + 1e-4 * part
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope ** 2
            part -= 0.1 * (first[i] / (1 - 0.9 ** step)
                           / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8))
    return model


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", folds: int = 5, fold: int = 0) -> Model:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    id_, lang = F.col(f"`{id_col}`").cast("long"), F.col(f"`{lang_col}`")
    rows = df.select(id_.alias("id"), F.col(f"`{text_col}`").alias("text"), lang.alias("lang")
                     ).where(F.col("lang").isNotNull() & F.col("text").isNotNull()
                             & ~held_out(F.col("id"), folds, fold))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted(counts)
    share = F.create_map(*[F.lit(x) for lang in labels
                           for x in (lang, min(1.0, 2 * SAMPLE_DOCS / counts[lang]))]
                         ) if labels else None
    if share is None:
        return fit([], [])
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    few = rows.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")] * 1_000_000)
    order = Window.partitionBy("lang").orderBy("draw", "id")
    lines = F.transform(F.split("text", "\n"), lambda line: word_list(line))
    sample = (few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
              .select("lang", lines.alias("lines")).orderBy("lang", "n").collect())
    one: dict[str, str] = {}                        # a word is one object, however often it occurs
    texts = [(labels.index(r.lang), [[one.setdefault(w, w) for w in line] for line in r.lines])
             for r in sample]
    del sample, one
    model = fit(labels, texts)
    del texts
    trim()                                          # the driver goes on with other work
    return model


def _label(model: Model, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Label number and score of rows of words."""
    words, index, ends = distinct_words(lists)
    lengths = np.diff(ends)
    best, score = np.full(len(lengths), -1), np.zeros(len(lengths))
    if not model.labels:
        return best, score
    weights = emissions(model, words)
    by_length = np.argsort(lengths, kind="stable")
    filled = by_length[lengths[by_length] > 0]
    for row, stop in row_slices(np.concatenate([[0], np.cumsum(lengths[filled])]), SLICE_WORDS):
        some = filled[row:stop]
        bounds = np.concatenate([[0], np.cumsum(lengths[some])])
        at = np.arange(bounds[-1]) + np.repeat(ends[some] - bounds[:-1], lengths[some])
        chance, _ = marginals(model, weights[index[at]].astype(np.float64), bounds)
        mean = np.add.reduceat(chance, bounds[:-1], axis=0) / lengths[some][:, None]
        best[some], score[some] = mean.argmax(axis=1), np.clip(mean.max(axis=1), 0, 1)
    return best, score


def _labeller(shared):
    def label(lists: pa.Array) -> pa.Array:
        model = shared.value
        names = np.array([*model.labels, UNKNOWN], object)
        parts = [_label(model, lists.slice(row, stop - row))
                 for row, stop in row_slices(list_ends(lists), BATCH_WORDS)]
        trim()
        best = np.concatenate([np.zeros(0, np.int64), *(b for b, _ in parts)])
        score = np.concatenate([np.zeros(0), *(s for _, s in parts)])
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)],
                                          ["lang_pred", "score"])
    return label


def identify(df: DataFrame, model: Model, text_col: str = "text",
             keep: tuple[str, ...] = ("*",)) -> DataFrame:
    """The columns ``keep`` of ``df`` as the struct ``row``, with ``lang_pred`` and ``score``.

    Only the words go to Python; the rows themselves stay in the JVM.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    label = F.arrow_udf(_labeller(shared), "struct<lang_pred:string,score:double>")
    return (df.select(F.struct(*keep).alias("row"),
                      label(word_list(F.col(f"`{text_col}`"))).alias("found"))
            .select("row", "found.*"))
