"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation is cut into spans of turns by prefix sums of its turns' tokens, without a sequential scan. With a span
budget S, a turn of more than S / 2 tokens is a span of its own; the others go to the stretch in which they start, and a stretch is S
less the longest of them, so that a span has at most S tokens though its last turn crosses the border. A
window is: the system turn (if the conversation starts with one), the turns before the span's first one, from
whatever span, that start at most the history budget before it, then the span's own turns.
Repeated turns are context: their assistant texts carry no loss, so each target counts once.
Token costs are those of `tokens`: quarter_bytes is an estimate, so budgets hold in its terms; exact counts come from a column.

Template: <|im_start|>role, newline, text, <|im_end|>, newline. Within roles and texts every
"<", any number of "!", "|" gets one more "!", so no control string can occur there, and taking
one "!" away restores them. In roles, "%" and newlines are also written as %25 and %0A.

Defined results: null text and null role count as empty; null turns come first; rows that tie on
turn are ordered by role, then text; repeated rows are repeated turns. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Tokens of a turn besides those of its text.
OVERHEAD = 5


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(!*)\|", r"<!$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<!(!*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    return escape(F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(c: Column) -> Column:
    return F.replace(F.replace(unescape(c), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def quarter_bytes(text: Column) -> Column:
    """The token estimate in use unless another is given: a token for each four UTF-8 bytes."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def chat_windows(turns: DataFrame, budget: int = 4096, history: int = 512, tokens: Callable[[Column], Column] = quarter_bytes) -> DataFrame:
    """turns: conv_id, turn, role, text. One row for each window: conv_id, window (from 0), n_context (leading
    turns that are repeated), n_turns (all), n_tokens, text, loss (spans of characters [start, end) of new assistant texts).

    The span budget is `budget` less `history` and the system turn's tokens, an eighth of `budget` at least;
    a window exceeds `budget` only by a single turn, or a system turn, that is too long itself."""
    body, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", F.col("turn").alias("_turn"), role.alias("_role"), body.alias("_text"))
    rows = rows.withColumn("_cost", tokens(F.col("_text")) + OVERHEAD)
    conv = Window.partitionBy("conv_id")
    by_turn = conv.orderBy("_turn", "_role", "_text")
    rows = rows.withColumn("_pos", F.row_number().over(by_turn))
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_system = (F.col("_pos") == 1) & (F.col("_role") == "system")
    rows = rows.withColumns({"_system": is_system, "_end": F.sum(F.when(is_system, 0).otherwise(F.col("_cost"))).over(so_far)})
    head = F.coalesce(F.max(F.when(F.col("_system"), F.col("_cost"))).over(conv), F.lit(0))
    rows = rows.withColumn("_span_budget", F.greatest(F.lit(budget - history) - head, F.lit(max(1, budget // 8))))
    start = F.col("_end") - F.col("_cost")  # of the system turn: below all others
    rows = rows.withColumn("_start", F.when(F.col("_system"), F.lit(-1)).otherwise(start))
    small = ~F.col("_system") & (F.col("_cost") * 2 <= F.col("_span_budget"))
    rows = rows.withColumns({"_small": small, "_longest": F.coalesce(F.max(F.when(small, F.col("_cost"))).over(conv), F.lit(0))})
    rows = rows.withColumn("_stretch", F.expr("_start div greatest(_span_budget - _longest, 1)"))
    by_start = conv.orderBy("_start")
    opens = F.coalesce(~(F.col("_small") & F.lag("_small").over(by_start) & (F.lag("_stretch").over(by_start) == F.col("_stretch"))), F.lit(True))
    rows = rows.withColumn("_opens", ~F.col("_system") & opens)
    rows = rows.withColumn("_window", F.greatest(F.sum(F.col("_opens").cast("int")).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1, F.lit(0)))
    rows = rows.withColumn("_last", F.max("_window").over(conv))
    # spans that begin within the history budget behind the turn's start; turns start at different places
    later = F.collect_list(F.when(F.col("_opens"), F.col("_window"))).over(by_start.rangeBetween(1, history))
    rows = rows.withColumn("_later", F.when(F.col("_system"), F.sequence(F.lit(0), F.col("_last"))).otherwise(later) if history > 0 else F.when(F.col("_system"), F.sequence(F.lit(0), F.col("_last"))))
    own = F.array(F.struct(F.col("_window").alias("w"), F.lit(False).alias("again")))
    again = F.transform(F.coalesce(F.filter("_later", lambda w: w > F.col("_window")), F.array().cast("array<bigint>")), lambda w: F.struct(w.alias("w"), F.lit(True).alias("again")))
    places = F.concat(own, again)
    placed = rows.withColumn("_place", F.explode(places))
    piece_head = F.concat(F.lit(START), escape_role(F.col("_role")), F.lit("\n"))
    escaped = escape(F.col("_text"))
    placed = placed.select(
        "conv_id",
        F.col("_place.w").alias("window"),
        F.struct(
            F.col("_pos").alias("pos"),
            F.col("_place.again").alias("again"),
            F.col("_cost").alias("cost"),
            F.concat(piece_head, escaped, F.lit(END + "\n")).alias("piece"),
            F.length(piece_head).alias("lead"),
            F.length(escaped).alias("size"),
            ((F.col("_role") == "assistant") & ~F.col("_place.again")).alias("target"),
        ).alias("t"),
    )
    windows = placed.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("t")).alias("t"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"))

    def step(acc, x):
        at = acc["at"] + x["lead"]
        span = F.struct(at.alias("start"), (at + x["size"]).alias("end"))
        return F.struct(
            (acc["at"] + F.length(x["piece"])).alias("at"),
            F.when(x["target"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    return windows.select(
        "conv_id",
        F.col("window").cast("int").alias("window"),
        F.size(F.filter("t", lambda x: x["again"])).alias("n_context"),
        F.size("t").alias("n_turns"),
        F.aggregate("t", F.lit(0).cast("long"), lambda n, x: n + x["cost"]).alias("n_tokens"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("text"),
        F.aggregate("t", start, step, lambda acc: acc["spans"]).alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """What formatted windows say, read from their text and loss spans alone: conv_id, window, text, turns (role and text
    of those that are not repeated), targets (the texts under the loss mask, unescaped)."""
    pieces = F.expr(f"slice(split(text, '{START.replace('|', '[|]')}'), 2, n_turns)")
    cut = lambda p: F.instr(p, "\n")
    turn = lambda p: F.struct(
        unescape_role(F.substring(p, F.lit(1), cut(p) - 1)).alias("role"),
        unescape(F.substring(p, cut(p) + 1, F.length(p) - cut(p) - len(END) - 1)).alias("text"),
    )
    return windows.select(
        "conv_id",
        "window",
        "text",
        F.transform(F.slice(pieces, F.col("n_context") + 1, F.greatest(F.col("n_turns") - F.col("n_context"), F.lit(0))), turn).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"]))).alias("targets"),
    )
