"""Conversations as formatted windows of a token budget, with a loss mask.

Prefix sums of turn tokens choose the spans: a turn belongs to the span in which its first token
falls, spans being half the budget long. A window holds the conversation's system turn, the last
turns before its span (at most ``history`` turns, and a quarter of the budget with the system
turn), and the turns of its span, which are never cut. Only assistant turns of its own span are
under the loss mask, so each is learned once; repeated turns are masked. A window is larger than
the budget only where a single turn takes more than a quarter of it, and says so.

Tokens are those of a turn as formatted, with role, marks and escapes. Every turn has six or more,
so a window holds a bounded number of turns, even of empty ones.

Template: ``<role>text</turn>`` and a line feed. ``&``, ``<`` and ``>`` inside roles and texts are
escaped, so a mark of the template never stands in one; ``read_turns`` and ``read_loss`` undo it.

Prefix sums are taken inside stretches of turn numbers first and then over the stretches, so a
conversation of any length is no single group; only a window's turns are put together, and the
digest of a whole conversation, which is one value, reads its windows in order.

Defined results: a null text or role is empty; turns with one number are ordered by role and text,
a null number comes first; repeated rows are turns of their own; a null conversation id is a
conversation; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate.session import stored

BUDGET = 1024
HISTORY = 4
#: Turn numbers in a stretch.
STRETCH = 256
_LEAST = -(1 << 63)
_END = "</turn>\n"
_TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def escaped(text: Column) -> Column:
    for plain, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    for plain, mark in (("<", "&lt;"), (">", "&gt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _head() -> Column:
    return F.concat(F.lit("<"), escaped(F.col("role")), F.lit(">"))


def formatted_turn() -> Column:
    return F.concat(_head(), escaped(F.col("text")), F.lit(_END))


def numbered(df: DataFrame, conv_col: str, turn_col: str, role_col: str,
             text_col: str) -> DataFrame:
    """Turns with their place in the conversation and the tokens before them."""
    rows = df.select(
        F.coalesce(F.col(f"`{conv_col}`").cast("long"), F.lit(_LEAST).cast("long")).alias("conv"),
        F.coalesce(F.col(f"`{turn_col}`").cast("long"), F.lit(_LEAST).cast("long")).alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).withColumns({"stretch": F.floor(F.col("turn") / STRETCH),
                   "tokens": F.regexp_count(formatted_turn(), F.lit(_TOKEN)).cast("long")})
    inside = Window.partitionBy("conv", "stretch").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumns({"n": F.count(F.lit(1)).over(inside),
                             "before": F.coalesce(F.sum("tokens").over(inside), F.lit(0))})
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = (rows.groupBy("conv", "stretch")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("sum"))
            .select("conv", "stretch", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("n0"),
                    F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before0")))
    return rows.join(sums, ["conv", "stretch"]).select(
        "conv", (F.col("n") + F.col("n0")).alias("place"), "role", "text", "tokens",
        (F.col("before") + F.col("before0")).alias("before"))


def windows(df: DataFrame, budget: int = BUDGET, history: int = HISTORY,
            conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """conv_id, window, formatted text, loss (start and length of each learned part, in
    characters), number of repeated turns at its start, tokens and whether it is over budget."""
    turns = stored(numbered(df, conv_col, turn_col, role_col, text_col)
                   .withColumns({"span": F.floor(F.col("before") / (budget // 2)),
                                 "system": (F.col("place") == 0) & (F.col("role") == "system")}),
                   "chat-turns")
    spans = turns.groupBy("conv", "span").agg(F.min("place").alias("start")).where("start > 0")
    own = turns.select("conv", "span", "place", "role", "text", "tokens", F.lit(2).alias("kind"))
    systems = turns.where("system").drop("span", "before").join(
        spans.select("conv", "span"), "conv").select(
        "conv", "span", "place", "role", "text", "tokens", F.lit(0).alias("kind"))
    nearest = Window.partitionBy("conv", "span").orderBy(F.desc("place"))
    fixed = turns.where("system").select("conv", F.col("tokens").alias("fixed"))
    past = (spans.join(fixed, "conv", "left").select("conv", "span", "fixed", F.explode(F.sequence(
        F.greatest(F.lit(0).cast("long"), F.col("start") - history), F.col("start") - 1))
        .alias("place")).join(turns.where("not system").drop("span", "before"), ["conv", "place"])
        .withColumn("sum", F.sum("tokens").over(nearest) + F.coalesce("fixed", F.lit(0)))
            .where(F.col("sum") <= budget // 4)
        .select("conv", "span", "place", "role", "text", "tokens", F.lit(1).alias("kind")))
    order = Window.partitionBy("conv", "span").orderBy("kind", "place").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = (own.union(systems).union(past)
            .withColumns({"head": _head(), "inner": escaped(F.col("text")),
                          "piece": formatted_turn()})
            .withColumn("at", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)))
            .withColumn("target", F.when(
                (F.col("kind") == 2) & (F.col("role") == "assistant"),
                F.struct((F.col("at") + F.length("head")).alias("start"),
                         F.length("inner").cast("long").alias("length")))))
    parts = F.array_sort(F.collect_list(F.struct("kind", "place", "piece", "target")))
    return (rows.groupBy("conv", "span")
            .agg(parts.alias("parts"), F.sum("tokens").alias("tokens"))
            .select(F.nullif("conv", F.lit(_LEAST).cast("long")).alias("conv_id"),
                    F.col("span").alias("window"),
                    F.array_join(F.col("parts.piece"), "").alias("formatted"),
                    F.filter(F.col("parts.target"), lambda t: t.isNotNull()).alias("loss"),
                    F.size(F.filter("parts", lambda p: p["kind"] < 2)).alias("repeated"),
                    "tokens", (F.col("tokens") > budget).alias("over_budget")))


def read_turns(formatted: Column, repeated: Column) -> Column:
    """(role, text) of the turns of a window, without those it repeats."""
    pieces = F.split(formatted, _END)
    new = F.slice(pieces, repeated + 1, F.size(pieces) - 1 - repeated)
    return F.transform(new, lambda p: F.struct(
        unescaped(F.substring_index(p, ">", 1).substr(F.lit(2), F.length(p))).alias("role"),
        unescaped(p.substr(F.length(F.substring_index(p, ">", 1)) + 2, F.length(p)))
        .alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask of a window."""
    return F.transform(loss, lambda t: unescaped(
        formatted.substr((t["start"] + 1).cast("int"), t["length"].cast("int"))))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows."""
    turns = read_turns(F.col("formatted"), F.col("repeated"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = formatted.withColumn("turns", turns).select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), lines.alias("lines"),
        F.array_join(read_loss(F.col("formatted"), F.col("loss")), "").alias("learned"),
        F.length("formatted").cast("long").alias("chars"))
    joined = F.array_sort(F.collect_list(F.struct("window", "lines", "learned")))
    loss = F.array_join(F.col("parts.learned"), "")
    return (rows.groupBy("conv_id").agg(joined.alias("parts"), F.sum("n").alias("n_turns"),
                                        F.sum("chars").alias("formatted_chars"))
            .select("conv_id", "n_turns",
                    F.sha2(F.array_join(F.col("parts.lines"), ""), 256).alias("turns_sha256"),
                    F.length(loss).cast("long").alias("loss_chars"),
                    F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars"))
