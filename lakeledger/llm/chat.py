"""Chat formatting as a relational transform: Spark expressions only.

Turns are collected per conversation as structs and sorted by (turn, role, text);
adjacent turns of one role become one message of several parts; the pieces are joined
into one string. Template of a message::

    <|turn|>ROLE<|text|>TEXT<|part|>TEXT...<|end|>

Every control string starts with ``<|``. Inside roles and texts each ``<`` is written
``<-``, so no control string can arise from data, and putting escaped texts one after
the other never makes a new escape: both hold for any text, and undoing is one replace.

The loss mask is run-length coded: ``loss_runs`` is an array of (chars, on) that covers
the formatted string from its start; ``on`` holds for the texts of ``loss_role`` and for
nothing else, control strings and part marks included.

Edge cases: null text or role: empty; null turn: first; a null conv_id is a conversation;
ties in turn are ordered by role, then text; repeated rows are repeated turns; an empty
table gives an empty result. Extra columns are ignored. A conversation is one output
row, so one task holds one conversation's turns: the row itself is that large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<|turn|>", "<|text|>", "<|part|>", "<|end|>"


def escape(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<"), F.lit("<-"))


def unescape(c: Column) -> Column:
    return F.replace(c, F.lit("<-"), F.lit("<"))


def format_chats(turns: DataFrame, *, loss_role: str = "assistant") -> DataFrame:
    """``turns`` (conv_id, turn, role, text) -> one row per conversation: conv_id,
    ``formatted`` string, ``loss_runs`` array<struct<chars int, on boolean>>."""
    rows = turns.select("conv_id", F.struct("turn", escape(F.col("role")).alias("role"),
                                            escape(F.col("text")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    pieces = chats.withColumn("pieces", F.expr(f"""transform(ts, (t, i) -> named_struct(
        'before', IF(i > 0 AND get(ts, i - 1).role = t.role, '{PART}', concat('{TURN}', t.role, '{TEXT}')),
        'text', t.text,
        'after', IF(get(ts, i + 1).role = t.role, '', '{END}'),
        'on', t.role = '{loss_role}'))"""))
    return pieces.select(
        "conv_id",
        F.expr("array_join(transform(pieces, p -> concat(p.before, p.text, p.after)), '')").alias("formatted"),
        F.expr("""flatten(transform(pieces, p -> array(
            named_struct('chars', length(p.before), 'on', false),
            named_struct('chars', length(p.text), 'on', p.on),
            named_struct('chars', length(p.after), 'on', false))))""").alias("loss_runs"),
    )


def turns_of(formatted: str = "formatted") -> Column:
    """The turns read back from a formatted string: array<struct<role, text>>."""
    return F.expr(f"""flatten(transform(
        slice(split({formatted}, '<[|]turn[|]>'), 2, length({formatted}) + 1),
        m -> transform(
            split(substr(m, 1, length(m) - {len(END)}), '<[|](text|part)[|]>'),
            (x, i) -> IF(i = 0, NULL, named_struct(
                'role', replace(substring_index(m, '{TEXT}', 1), '<-', '<'), 'text', replace(x, '<-', '<'))))
    ))""")


def loss_text(formatted: str = "formatted", runs: str = "loss_runs") -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.expr(f"""array_join(transform(
        array(named_struct('chars', split({formatted}, ''),
                           'mask', flatten(transform({runs}, r -> array_repeat(r.on, r.chars))))),
        x -> array_join(filter(x.chars, (c, i) -> x.mask[i]), '')), '')"""))


def read_back(chats: DataFrame) -> DataFrame:
    """Digest of formatted conversations, from the formatted string and mask alone."""
    read = chats.select(
        "conv_id", F.filter(turns_of(), lambda t: t.isNotNull()).alias("turns"),
        loss_text().alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.expr(r"array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), '')").cast("binary"), 256)
        .alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
