"""Language and toxicity: held-out accuracy, exact inference on small cases, awkward rows."""

import itertools

import numpy as np
from data import ROWS, documents

from tidegate.llm import language, toxicity

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(df)
    got = language.identify(df, model)
    from pyspark.sql import functions as F
    held = got.where(language.held_out(F.col("row.doc_id"), 5, 0))
    right, n = held.agg(F.avg((F.col("row.lang") == F.col("lang_pred")).cast("int")),
                        F.count(F.lit(1))).first()
    assert n > 150 and right > 0.97
    rows = language.identify(documents(spark), model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert r.row["size"] == 5
    assert language.identify(documents(spark, []), model).collect() == []


def test_language_without_labels(spark):
    model = language.train(documents(spark, [(1, "text", None), (None, "text", "en")]))
    assert {r.lang_pred for r in language.identify(documents(spark), model).collect()} == {"und"}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    k, lengths = 3, [4, 1, 3]
    model = language.Model(list("abc"), None, {}, None, rng.normal(size=k),
                           rng.normal(size=(k, k)))
    scores = rng.normal(size=(sum(lengths), k))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    pairs = np.zeros((k, k))
    chance, log_z = language.marginals(model, scores, ends, pairs)
    want, want_pairs, want_z = np.zeros_like(scores), np.zeros((k, k)), 0.0
    for a, b in zip(ends, ends[1:], strict=False):
        paths = list(itertools.product(range(k), repeat=b - a))
        weight = np.array([np.exp(model.start[p[0]] + sum(scores[a + t, y] for t, y in enumerate(p))
                                  + sum(model.moves[x, y] for x, y in zip(p, p[1:], strict=False)))
                           for p in paths])
        want_z += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for t, y in enumerate(p):
                want[a + t, y] += w
            for x, y in zip(p, p[1:], strict=False):
                want_pairs[x, y] += w
    assert np.allclose(chance, want) and np.allclose(pairs, want_pairs)
    assert np.isclose(log_z, want_z)


def test_code_switching_is_labelled_word_by_word():
    en = [(0, [["the", "house", "was", "green"], ["they", "were", "the", "last"]] * 8)]
    de = [(1, [["das", "haus", "ist", "schön"], ["sie", "waren", "nicht", "hier"]] * 8)]
    model = language.fit(["en", "de"], en + de)
    words = "the house was the last das haus ist nicht schön".split()
    chance, _ = language.marginals(model, language.emissions(model, words).astype(float),
                                   np.array([0, len(words)]))
    assert chance.argmax(axis=1).tolist() == [0] * 5 + [1] * 5


def plain_kernel(s, t):
    total = 0.0
    for a in itertools.combinations(range(len(s)), toxicity.ORDER):
        for b in itertools.combinations(range(len(t)), toxicity.ORDER):
            if all(s[i] == t[j] for i, j in zip(a, b, strict=True)):
                total += toxicity.DECAY ** (a[-1] - a[0] + b[-1] - b[0] + 2)
    return total


def test_kernel_equals_its_definition():
    words = ["idiot", "i.d.i.o.t", "idioti", "xx", "", "moronic", "banana", "bananas"]
    marks = ["idiot", "banana", "moron"]
    got = toxicity.kernel(words, marks)
    want = [[plain_kernel(w, m) for m in marks] for w in words]
    assert np.allclose(got, want, rtol=1e-4)


def test_highest_values_of_texts():
    value = np.array([3.0, 1.0, 3.0, 2.0, -5.0])
    got = toxicity.highest(value, np.array([0, 4, 4, 5]), -2.0)
    assert got.tolist() == [[3.0, 3.0, 2.0], [-2.0] * 3, [-2.0] * 3]


def test_toxicity_of_held_out_documents(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.train(docs, labels)
    some = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    got = toxicity.score(some.select("doc_id", "text"), model).join(labels, "doc_id").collect()
    toxic = np.array([r.score for r in got if r.toxic])
    clean = np.array([r.score for r in got if not r.toxic])
    assert (toxic >= 0.3).mean() > 0.85 and (clean < 0.3).mean() > 0.93
    rows = toxicity.score(documents(spark), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(documents(spark, []), model).collect() == []
    assert {r.score for r in toxicity.score(documents(spark), None).collect()} == {0.0}


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.train(documents(spark), none) is None


def test_spaced_letters_of_any_number_are_one_token(spark):
    texts = ["a b c d word", "a  b c", "x a b c d, e", "a b c d1", "é b c d e.", "word a b c d",
             "a " * 1_000_000]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.t for r in frame.select(toxicity.tokens(frame.text).alias("t")).collect()]
    assert got == [["a b c d", "word"], ["a", "b", "c"], ["x a b c d", "e"], ["a", "b", "c", "d1"],
                   ["é b c d e"], ["word", "a b c d"], [("a " * 1_000_000).strip()]]


def test_spaced_letters_in_training_and_scoring(spark):
    docs = spark.createDataFrame(
        [(i, f"stupidhead idiotface {i}" if i % 2 else f"friendly people {i}") for i in range(80)]
        + [(1001, "a " * 5000), (1002, "b " * 5000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as toxic")
    model = toxicity.train(docs, labels)
    assert model is not None and max(map(len, model.landmarks)) <= toxicity.LONGEST
    assert toxicity.score(docs, model).count() == 82


def test_more_than_64_languages(spark):
    """Each language has its own letters; none is lost beyond a machine word."""
    rows = [(n * 10 + i, " ".join(f"{chr(0x4E00 + n)}{chr(0x4E00 + n)}{chr(97 + i)}"
                                  for _ in range(8)), f"l{n:03}")
            for n in range(70) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert len(model.labels) == 70
    found = language.identify(docs, model).select("row.lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.9 * len(rows)
