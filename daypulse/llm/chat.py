"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns get prefix sums of their tokens (words, plus a fixed cost a turn). The
sums choose turn-aligned spans: a turn belongs to span ``floor(before / budget)``. A record is
one span: the conversation's system turn (repeated if it is not in the span), the turns of the
last ``history`` tokens before the span's border (repeated), then the span's own turns. The loss
mask covers the texts of the assistant turns that are the span's own; repeated ones are masked,
so each target is trained on once.

Prefix sums are taken in blocks of turn numbers and block sums are summed up, and records are
grouped by (conversation, span), so one long conversation is spread over tasks.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn. Texts and roles are escaped (``~`` to
``~0``, ``<|`` to ``~1``, in roles a line feed to ``~2``), so control strings occur only as such.

Defined results: null role or text is empty, a null turn comes first, equal turn numbers are
ordered by role and text, repeated rows are turns of their own, a null conv_id is a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
TURN_COST = 4
BLOCK_TURNS = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("~1"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("~2"), F.lit("\n")), F.lit("~1"), F.lit("<|"))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def _prefixed(rows: DataFrame) -> DataFrame:
    """``before``: the tokens of all earlier turns of the conversation."""
    block = F.floor(F.col("turn") / BLOCK_TURNS)
    rows = rows.withColumn("block", block)
    sums = rows.groupBy("conv", "block").agg(F.sum("tokens").alias("s"))
    earlier = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select(F.col("conv").alias("c"), F.col("block").alias("b"),
                       F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(
        Window.unboundedPreceding, -1)
    joined = rows.join(sums, F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return joined.withColumn("before", F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).drop(
        "c", "b", "offset", "block")


def format_windows(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", budget: int = 1024, history: int = 128) -> DataFrame:
    """One row per record: conv_id, span, formatted, repeated (leading turns that are repeats) and
    loss (array of start, end code points in ``formatted``, end exclusive)."""
    rows = chats.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + TURN_COST).cast("long"))
    rows = _prefixed(rows).withColumn("own", F.floor(F.col("before") / budget))
    rows = rows.withColumn("order", F.struct(
        F.col("turn").isNotNull().alias("has_turn"), F.col("turn").alias("turn"), F.col("before").alias("before"),
        F.col("role").alias("role"), F.col("text").alias("text")))
    after = F.col("before") + F.col("tokens")
    # the border after this turn's span; the turn that crosses it leads to the span where it ends
    following = F.greatest(F.col("own") + 1, F.floor(after / budget))
    again = after > following * budget - history
    spans = F.array_compact(F.array(F.struct(F.col("own").alias("span"), F.lit(True).alias("fresh")),
                                    F.when(again, F.struct(following.alias("span"), F.lit(False).alias("fresh")))))
    placed = rows.select("conv", "order", F.explode(spans).alias("at")).select("conv", "order", "at.*")
    records = placed.groupBy("conv", "span").agg(
        F.array_sort(F.collect_list(F.struct("order", "fresh"))).alias("turns"),
        F.max("fresh").alias("any_fresh"), F.min("order").alias("from")).where("any_fresh")
    system = rows.where("role = 'system'").groupBy(F.col("conv").alias("c")).agg(F.min("order").alias("sys"))
    records = records.join(system, F.col("conv").eqNullSafe(F.col("c")), "left")
    absent = F.col("sys").isNotNull() & (F.col("sys") < F.col("from"))
    turns = F.when(absent, F.concat(F.array(F.struct(F.col("sys").alias("order"), F.lit(False).alias("fresh"))),
                                    F.col("turns"))).otherwise(F.col("turns"))
    records = records.select("conv", "span", F.transform(turns, lambda t: F.struct(
        t["fresh"].alias("fresh"), (t["fresh"] & (t["order"]["role"] == "assistant")).alias("target"),
        F.concat(F.lit(START), F.replace(escape(t["order"]["role"]), F.lit("\n"), F.lit("~2")), F.lit("\n")).alias("head"),
        escape(t["order"]["text"]).alias("body"))).alias("turns"))
    size = lambda t: F.char_length(t["head"]) + F.char_length(t["body"]) + len(END)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("loss"))
    masked = F.aggregate("turns", begin, lambda acc, t: F.struct(
        (acc["at"] + size(t)).alias("at"),
        F.when(t["target"], F.concat(acc["loss"], F.array(F.struct(
            (acc["at"] + F.char_length(t["head"])).alias("start"),
            (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"])).alias("end")))))
        .otherwise(acc["loss"]).alias("loss")))["loss"]
    return records.select(
        F.col("conv").alias("conv_id"), "span",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: ~t["fresh"])).cast("long").alias("repeated"), masked.alias("loss"))


def read_back(records: DataFrame) -> DataFrame:
    """The turns and masked texts of each conversation, parsed from its records alone.

    Per conversation: n_turns, turns (role, line feed, text, line feed each), loss_text, formatted_chars.
    """
    pieces = F.split("formatted", r"<\|im_start\|>")
    fresh = F.slice(pieces, F.col("repeated").cast("int") + 2, F.greatest(F.size(pieces), F.lit(1)))
    plain = F.transform(fresh, lambda p: F.substring(p, F.lit(1), F.char_length(p) - len(END)))
    turns = F.transform(plain, lambda p: F.concat(
        unescape(F.substring_index(p, "\n", 1)), F.lit("\n"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.char_length(p))), F.lit("\n")))
    losses = F.transform("loss", lambda x: unescape(F.substring("formatted", x["start"] + 1, x["end"] - x["start"])))
    parsed = records.select("conv_id", "span", F.size(turns).cast("long").alias("n"), F.array_join(turns, "").alias("t"),
                            F.array_join(losses, "").alias("l"), F.char_length("formatted").cast("long").alias("chars"))
    # a conversation's digest needs its whole text; nothing larger than one conversation is gathered
    per = parsed.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                        F.array_sort(F.collect_list(F.struct("span", "t", "l"))).alias("all"))
    whole = lambda f: F.array_join(F.transform("all", lambda x: x[f]), "")
    return per.select("conv_id", "n_turns", whole("t").alias("turns"), whole("l").alias("loss_text"), "formatted_chars")
