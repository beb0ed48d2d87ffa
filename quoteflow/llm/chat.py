"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, then the reply, the only
part under the loss mask. A conversation that does not end with an assistant turn gets one more
example with all its turns and an empty mask, so that no turn is lost.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts are
broken by a backslash behind their first character and backslashes are doubled, so dropping one
backslash before any character gives the original back.

A conversation is one unit: its examples hold its prefixes, so it has to fit a task, like a long
document. Defined cases: null texts and roles count as empty; turns go by turn number (null first),
ties by role and text; repeated rows are turns of their own; a null ``conv_id`` is a conversation
like any other; an empty table gives no examples; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"

# Control strings (or their beginnings) that a text must not hold unescaped.
CONTROLS = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example`` (from 0), ``text``, ``loss_start``, ``loss_end`` (code points, end exclusive)."""
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\\n"))
    text = escape(F.coalesce("text", F.lit("")))
    turns = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("raw"),
            F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
            text.alias("body"),
        ).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    written = grouped.withColumn(
        "written", F.transform("ts", lambda t: F.concat(t.head, t.body, F.lit(END + "\n")))
    )
    n = F.size("ts")
    last_open = F.element_at("ts", -1).role != ASSISTANT
    targets = F.filter(F.sequence(F.lit(1), n), lambda i: _target(i) | ((i == n) & last_open))
    out = written.select("conv_id", "ts", "written", F.posexplode(targets).alias("example", "at"))
    before = F.array_join(F.slice("written", F.lit(1), F.col("at") - 1), "")
    this = F.element_at("ts", F.col("at"))
    out = out.select(
        "conv_id",
        "example",
        F.array_join(F.slice("written", F.lit(1), F.col("at")), "").alias("text"),
        (F.length(before) + F.length(this.head)).alias("loss_start"),
        F.when(this.role == ASSISTANT, F.length(this.body)).otherwise(0).alias("_length"),
    )
    return out.select("*", (F.col("loss_start") + F.col("_length")).alias("loss_end")).drop("_length")


def _target(i: Column) -> Column:
    return F.element_at("ts", i).role == ASSISTANT


def turns_of(text: Column) -> Column:
    """The turns of a formatted text as an array of (role, text), unescaped."""
    split = F.split(text, r"<\|im_start\|>", -1)
    parts = F.slice(split, F.lit(2), F.size(split))
    tail = len(END) + 1

    def turn(part: Column) -> Column:
        head = F.regexp_extract(part, r"(?s)^((?:[^\\\n]++|\\.)*+)\n", 1)
        body = F.substring(part, F.length(head) + 2, F.length(part) - F.length(head) - 1 - tail)
        return F.struct(unescape(head).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def read_back(made: DataFrame) -> DataFrame:
    """Digests per conversation, taken from the formatted examples alone."""
    trained = unescape(
        F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    )
    per = made.select("conv_id", "example", "text", trained.alias("trained"))
    whole = per.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", "trained"))).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )
    read = whole.select(
        "conv_id",
        turns_of(F.col("longest")).alias("turns"),
        F.array_join(F.col("losses.trained"), "").alias("loss"),
        "formatted_chars",
    )
    lines = F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
