"""Chat formatting as relational work: collect the turns of a conversation,
sort them, merge neighbours of one role and concatenate, all in Spark
expressions.

Layout of one conversation::

    <|im_start|>role<|im_sep|>text[<|im_sep|>text ...]<|im_end|>\\n ...

One message holds all adjacent turns of a role, parted by ``<|im_sep|>``, so
merging loses no turn border. Control strings inside roles and texts get one
backslash after their first character; taking one away restores them.

Cases: null role or text counts as empty; rows with the same (conversation,
turn) are ordered by role, then text; a null turn comes first; a null
conversation id is a conversation of its own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# A control string is "<" or "[", any number of backslashes, and a tail as in
# the look-aheads here; the marks above are among them.
_OPEN = r"(<(?=\\*(?:\|\w*\|>|/?s>))|\[(?=\\*/?INST\]))"
_OPEN_ESCAPED = r"(<(?=\\+(?:\|\w*\|>|/?s>))|\[(?=\\+/?INST\]))\\"


def escape(text: Column) -> Column:
    """Put one backslash into every control string of ``text``."""
    return F.regexp_replace(text, F.lit(_OPEN), F.lit(r"$1\\"))


def unescape(text: Column) -> Column:
    """Undo :func:`escape`."""
    return F.regexp_replace(text, F.lit(_OPEN_ESCAPED), F.lit("$1"))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``messages`` (merged, raw),
    ``formatted`` and ``loss_spans`` (start and length in code points of every
    ``loss_role`` text inside ``formatted``)."""
    rows = turns.select(
        "conv_id", F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    convs = convs.withColumn("starts", F.expr(
        "filter(sequence(0, size(turns) - 1), i -> i = 0 or turns[i].role <> turns[i - 1].role)"))
    convs = convs.withColumn("messages", F.expr(
        "transform(starts, (s, k) -> named_struct('role', turns[s].role, 'texts', "
        "transform(slice(turns, s + 1, coalesce(get(starts, k + 1), size(turns)) - s), t -> t.text)))"))
    convs = convs.select("conv_id", "messages", F.transform("messages", lambda m: F.struct(
        m["role"].alias("role"),
        F.concat(F.lit(START), escape(m["role"]), F.lit(SEP)).alias("head"),
        F.transform(m["texts"], escape).alias("texts"))).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(
        p["head"], F.array_join(p["texts"], SEP), F.lit(END))), "")
    # per message: where its texts stand, from running sums of lengths
    steps = F.flatten(F.transform("parts", lambda p: F.transform(p["texts"], lambda t, i: F.struct(
        F.when(i == 0, F.char_length(p["head"])).otherwise(F.lit(len(SEP))).alias("before"),
        F.char_length(t).alias("len"),
        F.when(i == F.size(p["texts"]) - 1, F.lit(len(END))).otherwise(F.lit(0)).alias("after"),
        (p["role"] == loss_role).alias("loss")))))
    convs = convs.select("conv_id", "messages", formatted.alias("formatted"), steps.alias("steps"))
    spans = F.expr(
        "aggregate(steps, named_struct('pos', 0, 'spans', cast(array() as array<struct<start:int,len:int>>)), "
        "(a, s) -> named_struct('pos', a.pos + s.before + s.len + s.after, 'spans', if(s.loss, "
        "concat(a.spans, array(named_struct('start', a.pos + s.before, 'len', s.len))), a.spans)), a -> a.spans)")
    return convs.select("conv_id", "messages", "formatted", spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as array<struct<role, text>>."""
    messages = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda m: m != "")
    pieces = F.transform(messages, lambda m: F.split(F.substr(m, F.lit(len(START) + 1)), r"<\|im_sep\|>"))
    return F.flatten(F.transform(pieces, lambda p: F.transform(
        F.slice(p, F.lit(2), F.size(p) - 1),
        lambda t: F.struct(unescape(p[0]).alias("role"), unescape(t).alias("text")))))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["len"]))), "")


def chat_digest(formatted: DataFrame) -> DataFrame:
    """Digest columns, all read back from the formatted strings."""
    d = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
                         loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
                         F.size("messages").cast("long").alias("n_messages"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_messages")
