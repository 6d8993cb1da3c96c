import random
import re

from data import ROWS, documents, key

from tidegate.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, min_words):
    """Deleted lines by comparing every place with every earlier one."""
    docs = sorted({(d is not None, d or 0, t or "") for d, t in rows})
    places, lines = [], []
    for n, (_, _, text) in enumerate(docs):
        parts = [(i, x) for i, x in enumerate(text.split("\n")) if WORD.search(x)]
        lines.append(parts)
        places += [(n, i) for i in range(len(parts))]
    gone = set()
    for n, i in places:
        for m, j in places:
            if (m, j) >= (n, i):
                break
            run = 0
            while (i + run < len(lines[n]) and j + run < len(lines[m])
                   and lines[n][i + run][1] == lines[m][j + run][1]):
                run += 1
            found = [lines[n][i + k] for k in range(run)]
            if sum(len(WORD.findall(x)) for _, x in found) >= min_words:
                gone |= {(n, k) for k, _ in found}
    kept = {}
    for n, doc in enumerate(docs):
        left = [x for k, x in enumerate(doc[2].split("\n")) if (n, k) not in gone]
        deleted = len(doc[2].split("\n")) - len(left)
        text = "\n".join(left)
        kept[doc] = (text if not deleted or WORD.search(text) else "", deleted)
    return [(d, *kept[(d is not None, d or 0, t or "")]) for d, t in rows]


def got(df, min_words):
    return [(r.doc_id, r.kept, r.n_deleted)
            for r in line_dedup.deduplicated(df, min_words).collect()]


def same_result(spark, rows, min_words):
    df = documents(spark, [(d, t, None) for d, t in rows])
    # Ties between texts of one id are ordered by hash, so ids differ here.
    assert sorted(got(df, min_words), key=key) == sorted(brute(rows, min_words), key=key)


def test_odd_rows(spark):
    rows = [(d, t) for d, t, _ in ROWS if d is not None] + [(None, ROWS[10][1])]
    for min_words in (3, 50):
        same_result(spark, rows, min_words)
    assert got(documents(spark, []), 5) == []


def test_generated_runs(spark):
    for seed in range(3):
        rng = random.Random(seed)
        line = [" ".join("w" for _ in range(rng.randrange(1, 6))) + f" {i}" for i in range(6)]
        rows = [(i, "\n".join(rng.choice([*line, "", f"own {i} {k}"])
                              for k in range(rng.randrange(0, 25)))) for i in range(25)]
        for min_words in (4, 11):
            same_result(spark, rows, min_words)


def test_periodic_text(spark):
    rows = [(1, "\n".join(["same line again"] * 40)), (2, "\n".join(["a b", "c d"] * 30))]
    same_result(spark, rows, 9)


def test_plan_does_not_grow_with_the_levels(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or df)
    level = spark.createDataFrame([(1, 1, 0, 7)], "oid long, th long, at int, r long")
    wanted = spark.createDataFrame([(1, 1, 0, 1)], "oid long, th long, start long, lines long")
    line_dedup.later_copies(wanted, [level] * 2)
    line_dedup.later_copies(wanted, [level] * 6)
    assert [plan.count("Join ") for plan in plans] == [2, 2]


def test_every_level_is_looked_up(spark):
    depth = 6
    levels = [spark.createDataFrame([(d, d, at, 100 * j + at) for d in (1, 2) for at in range(65 - (1 << j))],
                                    "oid long, th long, at int, r long") for j in range(depth)]
    spans = [(start, n) for n in (1, 2, 3, 4, 7, 8, 31, 32, 33, 63) for start in (0, 1)]
    wanted = spark.createDataFrame([(d, d, start, n) for d in (1, 2) for start, n in spans],
                                   "oid long, th long, start long, lines long")
    found = line_dedup.later_copies(wanted, levels).collect()
    assert sorted(map(tuple, found)) == sorted((2, 2, start, n) for start, n in spans)
