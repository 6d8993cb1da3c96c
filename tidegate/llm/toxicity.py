"""Toxic texts by a subsequence string kernel and a linear SVM on Nystroem features.

The kernel of two tokens sums, over all sequences of ``ORDER`` letters in both, ``DECAY`` to the
power of the stretches they span: letters need not be adjacent, so an insult with inserted
characters stays similar to the plain one. Its Nystroem features are the kernel values against
landmark strings, whitened by the kernel matrix of the landmarks. A token runs from letter or
digit to letter or digit and may hold anything but white space between them; single letters set
apart by blanks are one token. The start of a token counts as a letter. The score of a text is a
logistic function of the SVM values of its ``TOP`` highest tokens, so long clean texts are not
pushed up by their length alone.

Training: at most ``TOXIC_DOCS`` and ``CLEAN_DOCS`` labelled texts (a hash of the id picks them).
A label is known for a whole text only, so each toxic text stands for its highest token, chosen
anew in each round, and each clean text for its highest tokens. Landmarks are parts of tokens
that cover most toxic texts not yet covered and are rare in clean ones, and common clean tokens.

Defined results: null and empty texts and texts without a token score as if all their tokens had
the SVM's bias as value; repeated rows each get their result; a null id counts as held out;
without labels of both kinds every score is 0.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.arrow import distinct_words
from tidegate.llm.common import body, ship

ship(__name__)

ORDER = 4
DECAY = 0.7
TOXIC_LANDMARKS = 20
CLEAN_LANDMARKS = 4
TOXIC_DOCS = 600
CLEAN_DOCS = 1500
STEM = range(4, 9)
ROUNDS = 3
TOP = 3
#: Landmarks that a toxic text should hold before it counts as covered.
COVERS = 4
#: Tokens of a higher value count for their landmark.
NOTABLE = -0.5
#: Tokens scored at a time: they bound a task's memory.
CHUNK = 8192
#: Longest token that serves as a landmark: the kernel's tables have its length squared.
LONGEST = 64
# The repeated group is possessive: Java matches it in a loop, a group it may give back by recursion.
_TOKEN = (r"(?<!\S)\p{L}(?:[ ]++\p{L}(?![\p{L}\p{N}])){3,}+"
          r"|[\p{L}\p{N}](?:\S*[\p{L}\p{N}])?")


def held_out(id_: Column, folds: int = 4, fold: int = 2) -> Column:
    part = F.crc32(id_.cast("string").cast("binary")) % folds
    return F.coalesce(part == fold, F.lit(True))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(body(text)), F.lit(_TOKEN), F.lit(0))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Gap-weighted subsequence kernel of every word with every landmark.

    Words of one length are a block. The state holds, for each word, landmark and place in the
    landmark, the weight of sequences that end there, decayed to the current letter of the word.
    """
    width = max(map(len, landmarks))
    marks = np.zeros((len(landmarks), width), np.uint32)
    for i, mark in enumerate(landmarks):
        marks[i, :len(mark)] = [ord(c) for c in mark]
    # Weight of place q for what ended at an earlier place p of the landmark.
    places = np.arange(width)
    earlier = np.where(places[:, None] < places[None, :],
                       DECAY ** (places[None, :] - places[:, None] - 1.0), 0).astype(np.float32)
    letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
    match = np.zeros((len(letters) + 1, len(landmarks), width), np.float32)
    for c, i in letters.items():
        match[i] = marks == ord(c)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    by_length = defaultdict(list)
    for i, word in enumerate(words):
        by_length[len(word)].append(i)
    square = np.float32(DECAY * DECAY)
    for length, rows in by_length.items():
        if length < ORDER:
            continue
        for j in range(0, len(rows), CHUNK // 4):
            some = rows[j:j + CHUNK // 4]
            codes = np.array([[letters.get(c, 0) for c in words[i]] for i in some], np.int16)
            held = [np.zeros((len(some), len(landmarks), width), np.float32)
                    for _ in range(ORDER - 1)]
            total = np.zeros((len(some), len(landmarks)), np.float32)
            for t in range(length):
                seen = np.flatnonzero(codes[:, t])
                hit = match[codes[seen, t]]
                # From the longest sequences to the shortest, so each extends the past only.
                for order in range(ORDER - 1, -1, -1):
                    gain = hit * square
                    if order:
                        gain *= held[order - 1][seen] @ earlier
                    if order == ORDER - 1:
                        total[seen] += gain.sum(axis=2)
                    else:
                        held[order] *= np.float32(DECAY)
                        held[order][seen] += gain
            out[some] = total
    return out


@dataclass
class Model:
    landmarks: list[str]
    own: np.ndarray            # kernel of each landmark with itself
    weights: np.ndarray        # of kernel values, whitening included
    bias: float
    slopes: np.ndarray         # of the features of a text
    shift: float

    def values(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """SVM value and nearest landmark of every token."""
        value = np.zeros(len(words), np.float64)
        nearest = np.zeros(len(words), np.int64)
        for i in range(0, len(words), CHUNK):
            alike = kernel(["^" + w for w in words[i:i + CHUNK]], self.landmarks)
            value[i:i + len(alike)] = alike @ self.weights + self.bias
            nearest[i:i + len(alike)] = (alike / self.own).argmax(axis=1)
        return value, nearest

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.slopes + self.shift, -30, 30)))


def text_features(value: np.ndarray, nearest: np.ndarray, ends: np.ndarray, landmarks: int,
                  least: float) -> np.ndarray:
    """Features of texts whose tokens lie between ``ends``."""
    high = np.flatnonzero(value > NOTABLE)
    of = np.zeros((len(ends) - 1, landmarks))
    np.maximum.at(of, (np.searchsorted(ends, high, "right") - 1, nearest[high]),
                  np.minimum(value[high] - NOTABLE, 1))
    return np.column_stack([np.clip(highest(value, ends, least), -2, 1), of])


def highest(values: np.ndarray, ends: np.ndarray, least: float) -> np.ndarray:
    """The TOP highest values between ``ends``, in falling order, at least ``least``."""
    out = np.full((len(ends) - 1, TOP), least)
    filled = np.flatnonzero(np.diff(ends))
    values = values.copy()
    for i in range(TOP if len(filled) else 0):
        best = np.maximum.reduceat(values, ends[filled])
        out[filled, i] = np.maximum(best, least)
        at = np.flatnonzero(values == np.repeat(best, np.diff(ends)[filled]))
        owner, first = np.unique(np.searchsorted(ends[filled], at, "right"), return_index=True)
        values[at[first]] = -np.inf
    return out


def stems(text: Iterable[str]) -> set[str]:
    """All strings of STEM letters inside the tokens of a text."""
    return {w[i:i + n] for w in text for n in STEM for i in range(len(w) - n + 1)}


def choose_landmarks(toxic: list[list[str]], clean: list[list[str]]) -> list[str]:
    """Parts of tokens that cover the most toxic texts, one after the other, at few clean ones,
    and the commonest tokens of clean texts."""
    of_clean = Counter(stem for text in clean for stem in stems(text))
    texts_of: dict[str, set[int]] = defaultdict(set)
    for i, text in enumerate(toxic):
        for stem in stems(text):
            texts_of[stem].add(i)
    least, rate = max(2, len(toxic) // 100), len(toxic) / len(clean)
    cost = {s: 2 * rate * of_clean[s] for s in texts_of}
    # The longest of the parts that occur together comes first.
    common = sorted((s for s in texts_of if len(texts_of[s]) >= max(least, 2.5 * cost[s])),
                    key=lambda s: (-len(s), s))
    marks: list[str] = []
    covered = Counter()
    left = set(range(len(toxic)))
    while common and len(marks) < TOXIC_LANDMARKS:
        best = max(common, key=lambda s: len(texts_of[s] & left) - cost[s])
        if len(texts_of[best] & left) - cost[best] < least:
            break
        marks.append(best)
        covered.update(texts_of[best])
        left = {i for i in left if covered[i] < COVERS}
        parts = {best[i:i + 3] for i in range(len(best) - 2)}
        common = [s for s in common if not any(p in s for p in parts)]
    if not marks:
        return []
    usual = Counter(w for text in clean for w in text if ORDER < len(w) <= LONGEST)
    return marks + sorted(usual, key=lambda w: (-usual[w], w))[:CLEAN_LANDMARKS]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and shift of a ridge logistic regression by Newton steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        slope = x1.T @ (p - y) + 0.1 * w
        w -= np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + 0.1 * np.eye(len(w)), slope)
    return w[:-1], float(w[-1])


def fit(toxic: list[list[str]], clean: list[list[str]]) -> Model | None:
    """Texts as token lists."""
    if not toxic or not clean:
        return None
    toxic, clean = ([["^" + w for w in t] for t in texts] for texts in (toxic, clean))
    marks = choose_landmarks(toxic, clean)
    if not marks:
        return None
    among = kernel(marks, marks).astype(np.float64)
    scale = np.sqrt(np.diag(among))
    vals, vecs = np.linalg.eigh(among / np.outer(scale, scale))
    white = (vecs / np.sqrt(np.maximum(vals, 1e-3))) @ vecs.T / scale[:, None]
    words = sorted({w for text in [*toxic, *clean] for w in text})
    number = {w: i for i, w in enumerate(words)}
    raw = np.concatenate([kernel(words[i:i + CHUNK], marks) for i in range(0, len(words), CHUNK)])
    features = raw @ white
    bags = [[np.array(sorted({number[w] for w in t})) for t in texts if t]
            for texts in (toxic, clean)]
    own = max(1, len(marks) - CLEAN_LANDMARKS)
    value = (raw[:, :own] / np.diag(among)[:own]).max(axis=1)
    weights, bias = np.zeros(features.shape[1]), 0.0
    for _ in range(ROUNDS):
        up = np.array([b[np.argmax(value[b])] for b in bags[0]])
        down = np.unique(np.concatenate([b[np.argsort(-value[b])[:8]] for b in bags[1]]))
        x = features[np.concatenate([up, down])]
        y = np.concatenate([np.ones(len(up)), -np.ones(len(down))])
        share = np.where(y > 0, 0.5 / len(up), 0.5 / len(down))
        weights, bias = np.zeros(x.shape[1]), 0.0
        rate = 1 / (2 * (np.square(x).sum(axis=1) * share).sum() + 2)
        for _ in range(2000):                      # squared hinge, full batch
            slack = np.maximum(0, 1 - y * (x @ weights + bias)) * y * share
            weights += rate * (2 * slack @ x - 1e-4 * weights)
            bias += rate * 2 * slack.sum()
        value = features @ weights + bias
    # The logistic function weighs a text's highest values; the kinds count alike.
    flat = [b for some in bags for b in some]
    ends = np.concatenate([[0], np.cumsum([len(b) for b in flat])])
    nearest = (raw / np.diag(among)).argmax(axis=1)
    index = np.concatenate(flat)
    rows = text_features(value[index], nearest[index], ends, len(marks), bias)
    kinds = np.concatenate([np.ones(len(bags[0])), np.zeros(len(bags[1]))])
    slopes, shift = _logistic(rows, kinds)
    return Model(marks, np.diag(among), white @ weights, bias, slopes, shift)


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", folds: int = 4, fold: int = 2) -> Model | None:
    """Learn from a bounded sample of the labelled rows that are not held out."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                           F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("id is not null and label in (0, 1)")
             .where(~held_out(F.col("id"), folds, fold)).distinct())
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
              .collect()}
    if set(counts) != {0, 1}:
        return None
    draw = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    share = F.when(F.col("label") == 1, min(1.0, 2 * TOXIC_DOCS / counts[1])).otherwise(
        min(1.0, 2 * CLEAN_DOCS / counts[0]))
    few = known.withColumn("draw", draw).where(F.col("draw") < share * 1_000_000)
    chosen = [few.where(F.col("label") == label).orderBy("draw", "id").limit(size)
              for label, size in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))]
    picked = F.broadcast(chosen[0].union(chosen[1]))        # a bounded sample
    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      F.col(f"`{text_col}`").alias("text"))
            .join(picked, "id").select("id", "label", F.array_distinct(tokens(F.col("text")))
                                       .alias("tokens")).orderBy("label", "id").collect())
    return fit([r.tokens for r in rows if r.label == 1], [r.tokens for r in rows if r.label == 0])


def _scorer(shared):
    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            words, index, ends = distinct_words(batch.column("tokens"))
            score = np.zeros(len(ends) - 1)
            if model is not None:
                value, nearest = model.values(words)
                score = model.scores(text_features(value[index], nearest[index], ends,
                                                   len(model.landmarks), model.bias))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array(score)],
                [*batch.schema.names[:-1], "score"])
    return score_batches


def score(df: DataFrame, model: Model | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id and score of every text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     tokens(F.col(f"`{text_col}`")).alias("tokens"))
    return rows.mapInArrow(_scorer(shared), "doc_id long, score double")
