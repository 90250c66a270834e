"""Chat formatting of preference pairs.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns
is rendered once, as the prompt; what follows is rendered for each side as segments
with a mask that tells which of them count in training: the words of assistants, not
the marks around them and not what others say.

A null text is empty, a null role is ``user``; turns are in the order of their number,
nulls last, then of role and text. Repeated rows are repeated turns. Where one side
ends inside the other it has no segments; equal sides have none both. A conversation
without turns is not there. Conversations without an id make no pair.

Pairs for tables that hold none (``with_foreign_replies``): every conversation with a
reply is chosen over itself with one of its replies, and all after it, replaced by the
end of the next such conversation by id. The last one is followed by the first; a single
one by itself, so that both sides are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_table

# The marks of the rendered form.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def conversations(turns: DataFrame, identity: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """id, turns: the turns of each conversation as an array of (role, text)."""
    rows = turns.filter(F.col(identity).isNotNull()).select(
        F.col(identity).alias("id"),
        F.struct(
            F.col(turn).isNull().alias("last"),
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("user")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    grouped = rows.groupBy("id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return grouped.select("id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """The number of turns in the longest common prefix. Behind the end of the shorter
    side a turn is paired with null, which is no turn."""
    same = F.transform(F.arrays_zip(chosen.alias("a"), rejected.alias("b")), lambda p: p["a"].eqNullSafe(p["b"]))
    first_difference = F.array_position(same, False)
    return F.when(first_difference == 0, F.size(same).cast("bigint")).otherwise(first_difference - 1).cast("int")


def rendered(turns: Column) -> Column:
    """All turns as one string."""
    return F.array_join(
        F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), ""
    )


def segments(turns: Column, trained_role: str = "assistant") -> Column:
    """(text, train): for each turn its opening mark, and its text with the end mark."""

    def of_turn(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE)).alias("text"), F.lit(False).alias("train")),
            F.struct(F.concat(t["text"], F.lit(END)).alias("text"), (t["role"] == trained_role).alias("train")),
        )

    return F.flatten(F.transform(turns, of_turn))


def format_preferences(pairs: DataFrame, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """``keep``, prefix_turns, prompt, chosen and rejected segments, from pairs with the
    arrays of turns ``chosen`` and ``rejected``."""
    counted = pairs.withColumn("prefix_turns", common_turns(F.col("chosen"), F.col("rejected")))
    rest = lambda side: F.slice(side, F.col("prefix_turns") + 1, F.size(side))
    return counted.select(
        *keep,
        "prefix_turns",
        rendered(F.slice("chosen", 1, F.col("prefix_turns"))).alias("prompt"),
        segments(rest("chosen")).alias("chosen"),
        segments(rest("rejected")).alias("rejected"),
    )


def with_next(ids: DataFrame) -> DataFrame:
    """id, next: each of the distinct ids with the one that follows, the last with the
    first. Ids are cut into ranges, and only the least id of each range is looked at
    across them."""
    placed = ids.repartitionByRange("id").withColumn("part", F.spark_partition_id())
    placed = write_table(placed, "ids-in-ranges")
    # One row for each range, so one task holds as many rows as there are ranges.
    heads = placed.groupBy("part").agg(F.min("id").alias("head"))
    in_order = Window.orderBy("part")
    first = F.min("head").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(in_order), first).alias("after"))
    inside = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    followed = placed.select("id", "part", inside.alias("next"))
    # Broadcast for the same reason.
    return followed.join(F.broadcast(heads), "part").select("id", F.coalesce("next", "after").alias("next"))


def with_foreign_replies(chats: DataFrame, following: DataFrame, which: Column) -> DataFrame:
    """id, chosen, rejected: every conversation with an assistant turn, whole, beside its
    turns before one of its assistant turns, continued by the last assistant turn of the
    conversation that follows it and all turns after that.

    ``following`` has id and next for all of these conversations. ``which`` is an integer
    that tells which assistant turn is replaced, counted from 0, modulo their number.
    """
    places = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i + 1).otherwise(0)), lambda i: i > 0
    )
    replied = chats.withColumn("places", places).filter(F.size("places") > 0)
    end = F.slice("turns", F.element_at("places", -1), F.size("turns"))
    ends = replied.select(F.col("id").alias("next"), end.alias("end"))
    ends = following.join(ends, "next").select("id", "end")
    parts_at = F.element_at("places", (F.pmod(which, F.size("places")) + 1).cast("int"))
    return replied.withColumn("parts_at", parts_at).join(ends, "id").select(
        "id",
        F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", 1, F.col("parts_at") - 1), "end").alias("rejected"),
    )
