import re

from tidegate.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, span string, place long"
HARD = r"\### Assistant: </turn> ok"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)


def test_windows_keep_system_and_history_and_learn_each_answer_once(spark):
    rows = [(1, 0, "system", "be nice & <b>")]
    for i in range(1, 60):
        rows.append((1, i, "user" if i % 2 else "assistant", f"turn {i} " + "word " * (i % 17)))
    got = sorted(chat.windows(turns(spark, rows), 100, 3).collect(), key=lambda r: r.window)
    assert len(got) > 5
    learned = []
    for n, row in enumerate(got):
        assert row.formatted.startswith("<system>be nice &amp; &lt;b&gt;</turn>\n")
        assert row.repeated == (0 if n == 0 else row.repeated) <= 4
        assert row.tokens <= 100 and not row.over_budget
        learned += [row.formatted[t.start:t.start + t.length] for t in row.loss]
    assert learned == [t for _, i, r, t in rows if r == "assistant"]


def test_read_back_of_hard_and_empty_turns(spark):
    rows = [(-7, 0, "user", HARD), (-7, 1, "assistant", HARD), (2, 0, "assistant", None),
            (2, 1, None, "&lt; &amp;lt; <x>"), (None, 5, "assistant", "é🙂" * 30),
            (3, None, "user", "first"), (3, 1, "assistant", "long " * 3000), (3, 1, "user", "tie"),
            (3, 1, "user", "tie"), (3, 2, "assistant", "")]
    formatted = chat.windows(turns(spark, rows), 64)
    for row in chat.read_back(formatted).collect():
        mine = sorted((r for r in rows if r[0] == row.conv_id),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        import hashlib
        lines = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert row.n_turns == len(mine)
        assert row.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert any(r.over_budget for r in formatted.collect())
    assert chat.windows(turns(spark, [])).collect() == []


def test_one_conversation_over_many_stretches(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(2000)]
    row = chat.read_back(chat.windows(turns(spark, rows), 200)).first()
    assert row.n_turns == 2000
    assert row.loss_chars == sum(len(r[3]) for r in rows if r[2] == "assistant")


def test_turns_without_words_fill_windows_too(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", "") for i in range(3000)]
    got = chat.windows(turns(spark, rows), 120, 2).collect()
    assert len(got) > 300
    for row in got:
        assert row.tokens <= 120 and len(row.loss) <= 10
        assert row.tokens == sum(len(re.findall(r"[a-z]+|[^\sa-z]", line))
                                 for line in row.formatted.split("\n"))
    assert sum(len(r.loss) for r in got) == 1500
