"""Training windows from conversations: turn-aligned, within a token budget, in SQL functions only.

Prefix sums of the turn tokens place the turns on a line that is cut into bins of the
budget for new turns. Turns inside one bin form a window; a turn that reaches over a
cut has a window of its own. Every window starts with the conversation's system turn, repeats
the turns before it that start within the history budget, and ends with its new turns. The loss covers the texts of new assistant
turns alone, so each of them is a target once. A window holds the budget unless a single turn alone exceeds it.

A turn is ``<|im_start|>role``, line break, text, ``<|im_end|>``, line break. Inside roles and texts
a backslash escapes: itself and the bar of a ``<|``; a line break in a role is a backslash and ``n``, so the
first raw line break ends the role.

Defined cases: null roles and texts count as empty; turns are ordered by turn (null first), then role,
then text, and equal rows stay separate turns. Rows without a conversation id are one
conversation. The system turn is the first turn if its role is ``system``; a conversation of
only that turn is one window without targets. Prefix sums are taken over stretches of turn
numbers and then over the stretches, so no task needs a whole conversation. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.runtime import store

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens of a window, and of these the most for repeated turns.
BUDGET, HISTORY = 1_024, 256
#: A token is taken to be so many characters of the formatted turn.
CHARS_PER_TOKEN = 4
#: Turn numbers of one stretch.
STRETCH = 1_024


def escape(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(value: Column) -> Column:
    return F.regexp_replace(value, r"(?s)\\(.)", "$1")


def escape_role(value: Column) -> Column:
    return F.replace(escape(value), F.lit("\n"), F.lit("\\n"))


def unescape_role(value: Column) -> Column:
    """Backslashes stand in pairs first of all: what is between these holds the other escapes."""
    between = F.transform(F.split(value, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("<\\|"), F.lit("<|")))
    return F.array_join(between, "\\")


def _turns(df: DataFrame, chars_per_token: int) -> DataFrame:
    role = escape_role(F.coalesce(F.col("role").cast("string"), F.lit("")))
    text = escape(F.coalesce(F.col("text").cast("string"), F.lit("")))
    body = F.concat(F.lit(START), F.col("role"), F.lit("\n"), F.col("text"), F.lit(END))
    return (
        df.select(
            "conv_id",
            F.coalesce(F.col("conv_id").cast("string"), F.lit("-")).alias("conv"),
            F.floor(F.col("turn") / STRETCH).alias("stretch"),
            "turn", role.alias("role"), text.alias("text"),
        )
        .withColumn("chars", F.length(body).cast("bigint"))
        .withColumn("tokens", F.ceil(F.col("chars") / chars_per_token))
        .withColumn("stretch", F.coalesce("stretch", F.lit(-(2**62))))
    )


def _placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Each turn with its place in the conversation, its start on the token line, and its window."""
    first = F.min(F.struct("turn", "role", "text", "tokens"))
    earlier = Window.partitionBy("conv").orderBy("stretch")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    system = F.first("first").over(earlier)
    stretches = (
        turns.groupBy("conv", "stretch")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("sum"), first.alias("first"))
        .select(
            F.col("conv").alias("of_conv"), F.col("stretch").alias("of_stretch"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum_before"),
            F.when(system["role"] == "system", system["tokens"]).otherwise(0).alias("system_tokens"),
        )
    )
    inside = Window.partitionBy("conv", "stretch").orderBy("turn", "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = turns.withColumn("row", F.row_number().over(inside) - 1).withColumn("sum", F.sum("tokens").over(upto) - F.col("tokens"))
    joined = counted.join(stretches, (F.col("conv") == F.col("of_conv")) & (F.col("stretch") == F.col("of_stretch")))
    start = F.col("sum") + F.col("sum_before") - F.col("system_tokens")
    size = F.greatest(F.lit(budget - history) - F.col("system_tokens"), F.lit(1))
    last = F.floor((F.col("start") + F.col("tokens") - 1) / F.col("size"))
    return joined.select(
        "conv_id", "conv", "role", "text", "chars", "tokens", "system_tokens",
        (F.col("row") + F.col("rows_before")).cast("bigint").alias("place"), start.alias("start"), size.alias("size"),
    ).withColumn("is_system", (F.col("place") == 0) & (F.col("system_tokens") > 0)).withColumn(
        "window", 2 * last + (F.floor(F.col("start") / F.col("size")) == last).cast("int")
    )


def windows(
    df: DataFrame, budget: int = BUDGET, history: int = HISTORY, chars_per_token: int = CHARS_PER_TOKEN
) -> DataFrame:
    """The windows of all conversations (conv_id, turn, role, text).

    Returns conv_id, window (ascending, with gaps), formatted, repeated (its number of leading
    turns that stand for context only) and loss_spans (start and length in code points of each target).
    """
    # Turns are new, repeated and system turns: placed once, read for each.
    placed = store(_placed(_turns(df, chars_per_token), budget, history))
    turn = ["conv_id", "conv", "place", "role", "text"]
    new = placed.filter(~F.col("is_system"))
    heads = new.groupBy("conv", "window").agg(F.min("start").alias("from_start"), F.min("place").alias("from_place"))
    # History: turns that start less than the history budget before the window. Both sides
    # meet in stretches of the token line, at most two for each window.
    line = F.greatest(F.lit(history), F.lit(1))
    reach = heads.filter((F.col("from_start") > 0) & (F.lit(history) > 0)).select(
        F.col("conv").alias("to_conv"), F.col("window").alias("to_window"), "from_start",
        F.explode(
            F.sequence(
                F.floor(F.greatest(F.col("from_start") - line, F.lit(0)) / line), F.floor((F.col("from_start") - 1) / line)
            )
        ).alias("to_line"),
    )
    near = (F.col("start") < F.col("from_start")) & (F.col("start") >= F.col("from_start") - line)
    past = (
        new.withColumn("line", F.floor(F.col("start") / line))
        .join(reach, (F.col("conv") == F.col("to_conv")) & (F.col("line") == F.col("to_line")) & near)
        .select(*turn, F.col("to_window").alias("window"), F.lit(False).alias("fresh"))
    )
    system = placed.filter("is_system").select(*turn)
    others = heads.select(F.col("conv").alias("of_conv"), "window", (F.col("from_place") == 1).alias("fresh"))
    # A conversation of a system turn alone has no other window, so its own is 0.
    shown = (
        system.join(others, F.col("conv") == F.col("of_conv"), "left")
        .select(*turn, F.coalesce("window", F.lit(0)).alias("window"), F.coalesce("fresh", F.lit(True)).alias("fresh"))
    )
    parts = new.select(*turn, "window", F.lit(True).alias("fresh")).unionByName(past).unionByName(shown)
    item = F.struct("place", "role", "text", "fresh")
    grouped = parts.groupBy("conv", "window").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(item)).alias("turns"))
    bodies = F.transform("turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))
    target = "array<struct<start:int,length:int>>"
    state = F.struct(F.lit(0).alias("at"), F.array().cast(target).alias("spans"))

    def step(s: Column, t: Column) -> Column:
        head = s["at"] + len(START) + F.length(t["role"]) + 1
        own = F.array(F.struct(head.alias("start"), F.length(t["text"]).alias("length")))
        taken = t["fresh"] & (t["role"] == "assistant")
        return F.struct(
            (head + F.length(t["text"]) + len(END)).alias("at"),
            F.when(taken, F.concat(s["spans"], own)).otherwise(s["spans"]).alias("spans"),
        )

    return grouped.select(
        "conv_id", F.col("conv"), "window", F.concat_ws("", bodies).alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("repeated"),
        F.aggregate("turns", state, step, lambda s: s["spans"]).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window: an array of (role, text), unescaped."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2_147_483_000)

    def turn(piece: Column) -> Column:
        name = F.substring_index(piece, "\n", 1)
        text = F.substring(piece, F.length(name) + 2, F.length(piece) - F.length(name) - 1 - len(END))
        return F.struct(unescape_role(name).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_targets(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss_spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
