"""Chat formatting in budgeted windows (DataFrame functions only).

Running sums of turn tokens choose turn-aligned spans: each window holds the
conversation's leading system turn, as many turns before the span as fit into
the history budget, and the span of new turns, filled up to the budget. Text of
new assistant turns carries the loss; the system turn and history repeated in a
window are masked. A turn longer than the budget has a window of its own.

The template is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings
inside roles and texts (of this template and of the common bracket templates)
get a backslash after their first character; strings that already look so get
one more. So the change can be taken back, and no control string is left.

Defined results: NULL texts and roles are empty. Turns are ordered by turn
(NULL first), role, text; repeated rows are turns of their own. Rows with NULL
conv_id are one conversation. Extra columns are ignored. No rows, no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
BUDGET, HISTORY = 1024, 256
#: Tokens that the markers of a turn count for.
TURN_TOKENS = 4

_ESCAPE = r"(<|\[)(\\*)(/?s>|/?INST\]|\|)"
_UNESCAPE = r"(<|\[)\\(\\*)(/?s>|/?INST\]|\|)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def token_count(text: Column) -> Column:
    """Words and single marks: a native stand-in for a tokenizer's count."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"))


def chat_windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, loss_spans array<struct<start,end>>, carried): one row per window.

    Spans are code points of ``formatted``, end exclusive; ``carried`` counts the
    window's leading turns that an earlier window already showed.
    """
    clean = rows.select(F.col("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    turns = clean.select(
        "conv_id", "turn", "role", "text", (token_count(F.col("text")) + TURN_TOKENS).cast("long").alias("tok"),
        F.length(head).alias("head"), F.concat(head, escape(F.col("text")), F.lit(END)).alias("shown"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    running = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turns = (turns.withColumn("i", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)))
             .withColumn("pre", F.sum("tok").over(running) - F.col("tok"))
             .withColumn("at", F.sum(F.length("shown")).over(running) - F.length("shown")))
    # the first turn whose tokens up to this one fit into the history budget
    back = Window.partitionBy("conv_id").orderBy("pre").rangeBetween(-history, Window.currentRow)
    turns = turns.withColumn("hist", F.min("i").over(back))
    conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "i", "role", "tok", "head", "shown", "pre", "at", "hist"))).alias("turns"))
    first = F.element_at("turns", 1)
    conv = conv.withColumn("sys", (first["role"] == "system").cast("int"))
    conv = conv.withColumn("room", F.greatest(F.lit(1), F.lit(budget - history) - F.when(
        F.col("sys") == 1, first["tok"]).otherwise(F.lit(0))))
    state = F.struct(F.array(F.col("sys") + 1).alias("starts"),
                     F.when(F.col("sys") == 1, first["tok"]).otherwise(F.lit(0).cast("long")).alias("base"))

    def step(acc: Column, t: Column) -> Column:
        full = (t["i"] > F.element_at(acc["starts"], -1)) & (t["pre"] + t["tok"] - acc["base"] > F.col("room"))
        return F.struct(F.when(full, F.concat(acc["starts"], F.array(t["i"]))).otherwise(acc["starts"]).alias("starts"),
                        F.when(full, t["pre"]).otherwise(acc["base"]).alias("base"))

    starts = F.aggregate("turns", state, step, lambda acc: acc["starts"])
    conv = conv.withColumn("starts", starts)
    n_turns, n_win = F.size("turns"), F.size("starts")

    def window(w: Column) -> Column:
        begin = F.element_at(F.col("starts"), (w + 1).cast("int"))
        stop = F.when(w + 1 < n_win, F.try_element_at(F.col("starts"), (w + 2).cast("int"))).otherwise(n_turns + 1)
        # a conversation of only a system turn has an empty span
        at = F.least(begin, n_turns)
        hist = F.when(w == 0, begin).otherwise(F.greatest(F.get(F.col("turns"), at - 1)["hist"], F.col("sys") + 1))
        return F.struct(w.cast("int").alias("window"), (begin - hist).alias("repeated"),
                        F.slice(F.col("turns"), hist, F.greatest(stop - hist, F.lit(0))).alias("span"))

    wins = conv.select("conv_id", "sys", first.alias("first"), F.explode(
        F.transform(F.sequence(F.lit(0), n_win - 1), window)).alias("w"))
    wins = wins.select("conv_id", "sys", "first", "w.window", "w.repeated", "w.span")
    lead = F.when(F.col("sys") == 1, F.col("first.shown")).otherwise(F.lit(""))
    base = F.length(lead) - F.coalesce(F.get("span", F.lit(0))["at"], F.lit(0))
    fresh = F.slice("span", F.col("repeated") + 1, F.size("span"))
    loss = F.transform(F.filter(fresh, lambda t: t["role"] == "assistant"), lambda t: F.struct(
        (base + t["at"] + t["head"]).cast("int").alias("start"),
        (base + t["at"] + F.length(t["shown"]) - len(END)).cast("int").alias("end")))
    formatted = F.concat(lead, F.array_join(F.transform("span", lambda t: t["shown"]), ""))
    carried = F.col("repeated") + F.when(F.col("window") > 0, F.col("sys")).otherwise(F.lit(0))
    return wins.select("conv_id", "window", formatted.alias("formatted"), loss.alias("loss_spans"),
                       carried.cast("int").alias("carried"))


def read_turns(formatted: Column, carried: Column) -> Column:
    """The window's new turns, array<struct<role,text>>, parsed from the formatted text."""
    parts = F.split(formatted, r"<\|im_end\|>", -1)
    new = F.slice(parts, carried + 1, F.greatest(F.size(parts) - 1 - carried, F.lit(0)))

    def turn(part: Column) -> Column:
        cut = F.split(part, r"<\|im_sep\|>", -1)
        return F.struct(unescape(F.substring(cut[0], len(START) + 1, 2**31 - 1)).alias("role"),
                        unescape(cut[1]).alias("text"))

    return F.transform(new, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))


def chat_report(windows: DataFrame) -> DataFrame:
    """Contract columns of op9, read back from the windows."""
    turns = read_turns(F.col("formatted"), F.col("carried"))
    read = windows.select("conv_id", "window", turns.alias("turns"), F.length("formatted").alias("chars"),
                          read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    read = read.select("conv_id", "window", "chars", F.size("turns").cast("long").alias("n"),
                       F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                                    "").alias("said"), F.array_join("loss", "").alias("loss"))
    conv = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("window", "said", "loss"))).alias("w"))
    said = F.array_join(F.transform("w", lambda w: w["said"]), "")
    loss = F.array_join(F.transform("w", lambda w: w["loss"]), "")
    return conv.select("conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       "formatted_chars")
