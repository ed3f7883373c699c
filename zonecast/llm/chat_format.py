"""Chat formatting as relational expressions: one string and one loss mask per conversation.

The turns of a conversation are collected as structs and sorted, one array
aggregation merges adjacent turns of the same role into a block and notes where
the trained-on texts lie, and the pieces are concatenated.  Everything, the way
back included, is a Spark expression; texts never leave the JVM.

Texts may hold the template's control strings.  Backslashes are doubled and a
lone one is put behind the first character of every control string, so that no
control string is left in a text and the way back is unambiguous.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of public chat templates that a model may have been trained with.
FOREIGN_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")


@dataclass(frozen=True)
class Template:
    """The marks of a conversation: ``begin (open role head text (join text)* close)*``.

    ``join`` stands between merged turns of one role.  ``foreign`` are further
    strings that texts must not contain unescaped.
    """

    begin: str = "<|begin_of_text|>"
    open: str = "<|start_header_id|>"
    head: str = "<|end_header_id|>\n\n"
    join: str = "<|eom_id|>"
    close: str = "<|eot_id|>"
    foreign: tuple[str, ...] = FOREIGN_CONTROLS

    def __post_init__(self):
        marks = [m.strip() for m in (self.begin, self.open, self.head, self.join, self.close)]
        controls = [*marks, *self.foreign]
        if len(set(controls)) < len(controls) or any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings must differ, have two characters at least and no backslash")
        for a in controls:
            for b in controls:
                # the end of one may not begin another, else a text and the mark behind it could make a third
                if (a != b and a in b) or any(b.startswith(a[i:]) or a[i:].startswith(b) for i in range(1, len(a))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        object.__setattr__(self, "controls", tuple(controls))

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for c in self.controls:
            out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
        return out

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\?)", "$1")


def _split(text: Column, mark: str, limit: int = -1) -> Column:
    return F.split(text, "".join("\\" + c if re.match(r"[^\w\s]", c) else c for c in mark), limit)


def format_conversations(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         train_on: str = "assistant", template: Template | None = None) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``.

    Turns are taken by ``turn`` (nulls first; ties by role, then text; repeated
    rows are repeated turns).  A null role or text is empty; a null ``conv_id``
    is a conversation of its own; other columns are ignored; an empty table
    gives no rows.  ``loss_spans`` holds the byte range (UTF-8, end excluded)
    of every text of the role ``train_on``, marks left out, in order; bytes,
    because those ranges can be cut out in time of their own length.  A
    conversation is one string, so it has to fit a row (2 GB).
    """
    t = template or Template()
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("conv", "turn", "role", "text", t.escape(F.col("role")).alias("role_out"), t.escape(F.col("text")).alias("out"))
    # the plain text is left out of the collected struct where escaping changed nothing, and only breaks ties elsewhere
    rows = rows.withColumn("key", F.when(F.col("out") != F.col("text"), F.col("text")))
    order = F.struct("turn", "role", F.coalesce("key", "out").alias("by"), "role_out", F.when(F.col("key").isNotNull(), F.col("out")).alias("out"))
    turns_of = rows.groupBy("conv").agg(F.sort_array(F.collect_list(order)).alias("turns"))

    nothing = F.struct(F.lit(None).cast("string").alias("role"), F.octet_length(F.lit(t.begin)).cast("long").alias("at"),
                       F.array(F.lit(t.begin)).alias("pieces"),
                       F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("loss"))

    def add(acc, x):
        body = F.coalesce(x["out"], x["by"])
        opening = F.concat(F.when(acc["role"].isNull(), F.lit("")).otherwise(F.lit(t.close)), F.lit(t.open), x["role_out"], F.lit(t.head))
        mark = F.when(acc["role"].eqNullSafe(x["role"]), F.lit(t.join)).otherwise(opening)
        begin = acc["at"] + F.octet_length(mark)
        end = begin + F.octet_length(body)
        return F.struct(x["role"].alias("role"), end.alias("at"), F.concat(acc["pieces"], F.array(mark, body)).alias("pieces"),
                        F.when(x["role"] == train_on, F.concat(acc["loss"], F.array(F.struct(begin.alias("begin"), end.alias("end")))))
                        .otherwise(acc["loss"]).alias("loss"))
    merged = turns_of.select("conv", F.aggregate("turns", nothing, add).alias("m"))
    return merged.select(F.col("conv").alias(conv_id), F.concat(F.array_join("m.pieces", ""), F.lit(t.close)).alias("formatted"),
                         F.col("m.loss").alias("loss_spans"))


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The ``(role, text)`` structs of a formatted conversation, merged turns taken apart again."""
    t = template or Template()
    blocks = _split(F.substring(formatted, len(t.begin) + 1, (1 << 31) - 1), t.close)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)            # behind the last close is nothing

    def block(b):
        parts = _split(F.substring(b, len(t.open) + 1, (1 << 31) - 1), t.head, 2)
        return F.transform(_split(F.get(parts, F.lit(1)), t.join),
                           lambda x: F.struct(t.unescape(F.get(parts, F.lit(0))).alias("role"), t.unescape(x).alias("text")))
    return F.flatten(F.transform(blocks, block))


def read_loss(formatted: Column, loss_spans: Column, template: Template | None = None) -> Column:
    """The texts under the mask, unescaped."""
    t = template or Template()
    data = formatted.cast("binary")
    return F.transform(loss_spans, lambda s: t.unescape(
        F.decode(data.substr((s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")), "UTF-8")))
