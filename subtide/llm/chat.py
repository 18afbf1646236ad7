"""Format conversations as training text with a loss mask, with Spark expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent turns of one role are
merged into one block. A block reads

    <|turn|>ROLE<|say|>TEXT<|part|>TEXT<|end|>\\n

with one TEXT per merged turn. Control strings all contain ``<|``. In roles and texts a backslash
becomes two and ``<|`` becomes ``<\\|``, so no text can hold a control string, and the escape can be
undone: the escaped form has runs of backslashes of even length only, but for the single one in
``<\\|``.

The result holds ``segments``, an array of (text, loss) whose texts joined are ``formatted``. The
loss mask covers exactly the texts of the trained role. Reading back splits the formatted text at the
control strings, in one pass over it.

Order and empty input: turns are ordered by turn, role, text, NULL first; ties on all three are equal
rows. A NULL role or text is the empty string, a NULL conv_id a conversation of its own. An empty
table gives an empty result. Columns that are not named are ignored.

Scale: one shuffle by conversation. The formatted text is one value, so a conversation has to fit
into one; there is nothing to split a group into. All steps are linear in the conversation's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TURN, SAY, PART, END = "<|turn|>", "<|say|>", "<|part|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _split(text: Column, mark: str) -> Column:
    return F.split(text, mark.replace("|", "\\|"), -1)


def _segment(text: Column | str, loss: Column | bool) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def format_conversations(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """Rows of (conv_id, formatted, segments), one per conversation."""
    said = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", *said))).alias("_turns")
    )
    before = lambda i: F.col("_turns")[i - 1]["role"]
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_turns") - 1),
        lambda i: F.when(i == 0, True).otherwise(F.col("_turns")[i]["role"] != before(i)),
    )
    collected = collected.withColumn("_starts", starts)

    def block(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("_starts", k + 1), F.size("_turns"))
        return F.struct(
            F.col("_turns")[start]["role"].alias("role"),
            F.slice("_turns", start + 1, stop - start).alias("parts"),
        )

    blocks = F.transform("_starts", block)

    def segments(b: Column) -> Column:
        def part(p: Column, k: Column) -> Column:
            mark = F.when(k == 0, F.concat(F.lit(TURN), escape(b["role"]), F.lit(SAY)))
            return F.array(
                _segment(mark.otherwise(F.lit(PART)), False),
                _segment(escape(p["text"]), b["role"] == trained),
            )

        return F.concat(F.flatten(F.transform(b["parts"], part)), F.array(_segment(END, False)))

    cut = collected.select("conv_id", F.flatten(F.transform(blocks, segments)).alias("segments"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return cut.select("conv_id", joined.alias("formatted"), "segments")


def read_turns(formatted: Column | str) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted
    lines = F.filter(_split(formatted, END), lambda b: b != "")

    def turns(b: Column) -> Column:
        halves = _split(F.substring(b, len(TURN) + 1, 2**31 - 1), SAY)
        said = lambda t: F.struct(unescape(halves[0]).alias("role"), unescape(t).alias("text"))
        return F.transform(_split(halves[1], PART), said)

    return F.flatten(F.transform(lines, turns))


def loss_text(segments: Column | str) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")
