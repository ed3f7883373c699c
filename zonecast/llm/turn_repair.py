"""Repair of conversation structure by a generalised LR parse with weighted edits.

The roles of a conversation should read ``(s?(ua)+)?``: an optional system turn,
then user and assistant in turn.  The grammar behind it,

    conversation -> empty | pairs | s pairs        pairs -> pair | pairs pair        pair -> u a

is parsed bottom-up over a graph-structured stack.  Every row may be shifted as
it is (keep), shifted under another role (rerole) or left out (delete), and
turns that are missing may be shifted from nowhere (insert).  Tops in the same
state are merged: what can follow depends on the state alone, so only the one
of least (cost, audit) lives on, where the audit spells the edits made so far.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.groups import column
from zonecast.llm.shared import materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
ROLE_NAMES = {"u": "user", "a": "assistant"}
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = {"su", "ua", "au"}

# LR states: 0 nothing read, 1 a system turn, 2 the u of a pair, 3 its a, 4 pairs.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (4, "u"): 2}
REDUCE = {3: 2}                                 # pair -> u a, and with it pairs -> pair or pairs -> pairs pair
GOTO = {0: 4, 1: 4, 4: 4}
ACCEPT = {0, 4}
# From any top that can still win, any other continuation costs at most this much
# more (delete the system turn, insert a pair), so dearer tops are let go.
SLACK = 8
FLUSH = 256


@dataclass(frozen=True, slots=True)
class Top:
    """A stack top: its state, the states below it, and the least (cost, audit) that leads there.

    ``audit`` lacks what all tops have in common and was settled before.
    """

    state: int
    below: frozenset
    cost: int
    audit: str

    def shift(self, symbol: str, edit: str, cost: int) -> Iterator[Top]:
        state = SHIFT.get((self.state, symbol))
        if state is None:
            return
        if state in REDUCE:
            # the pair's two symbols go; every state under them has the same goto
            for under in self.below:
                yield Top(GOTO[under], frozenset(), self.cost + cost, self.audit + edit)
        else:
            yield Top(state, frozenset((self.state,)), self.cost + cost, self.audit + edit)


def merge(tops: Iterable[Top]) -> dict[int, Top]:
    """One top a state: the least (cost, audit), over the union of what lies below."""
    out: dict[int, Top] = {}
    for t in tops:
        have = out.get(t.state)
        if have is None:
            out[t.state] = t
        else:
            best = min(have, t, key=lambda x: (x.cost, x.audit))
            out[t.state] = Top(t.state, have.below | t.below, best.cost, best.audit)
    return out


def with_inserts(tops: dict[int, Top]) -> dict[int, Top]:
    """The tops, and what inserted turns reach from them."""
    while True:
        more = merge([*tops.values(), *(n for t in tops.values() for symbol in ROLE_NAMES for n in t.shift(symbol, INSERT, COST[INSERT]))])
        least = min(t.cost for t in more.values())
        more = {s: t for s, t in more.items() if t.cost <= least + SLACK}
        if more == tops:
            return tops
        tops = more


class Parse:
    """The parse of one conversation, row by row."""

    def __init__(self):
        self.tops = with_inserts({0: Top(0, frozenset(), 0, "")})
        self.settled: list[str] = []
        self.rows = 0

    def add(self, initial: str, must_go: bool, truncated: bool) -> None:
        out = []
        extra = TRUNCATED_COST * truncated
        for t in self.tops.values():
            out.append(Top(t.state, t.below, t.cost + COST[DELETE], t.audit + DELETE))
            if not must_go:
                out += t.shift(initial, KEEP, COST[KEEP] + extra)
                for symbol in ROLE_NAMES:
                    out += t.shift(symbol, REROLE, COST[REROLE] + extra)
        self.tops = with_inserts(merge(out))
        self.rows += 1
        if self.rows % FLUSH == 0:      # what all tops share is settled
            common = os.path.commonprefix([t.audit for t in self.tops.values()])
            self.settled.append(common)
            self.tops = {s: Top(t.state, t.below, t.cost, t.audit[len(common):]) for s, t in self.tops.items()}

    def end(self) -> tuple[int, str]:
        best = min((t for t in self.tops.values() if t.state in ACCEPT), key=lambda t: (t.cost, t.audit))
        return best.cost, "".join(self.settled) + best.audit


def repaired_roles(audit: str, initials: Iterable[str]) -> Iterator[tuple[str, str | None]]:
    """``(edit, new initial)`` of every edit; None for what is kept or deleted."""
    state, rows = 0, iter(initials)
    for edit in audit:
        initial = next(rows) if edit != INSERT else None
        if edit == DELETE:
            yield edit, None
            continue
        symbol = initial if edit == KEEP else next(s for s in ROLE_NAMES if (state, s) in SHIFT)
        state = SHIFT[state, symbol]
        state = 4 if state in REDUCE else state
        yield edit, None if edit == KEEP else symbol


class _Conversation:
    """What a task holds of the conversation it reads: per row a digest, an initial and flags, never texts."""

    def __init__(self, conv):
        self.conv, self.parse = conv, Parse()
        self.seen: set[bytes] = set()
        self.digests: list[bytes] = []
        self.initials: list[str] = []
        self.counts = dict.fromkeys((*FAULTS, "illegal"), 0)
        self.turns: tuple | None = None         # least, largest, distinct; rows come by turn
        self.last_turn = None

    def add(self, turn, initial, digest, blank, truncated) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns = (turn, turn, 1) if self.turns is None else (self.turns[0], turn, self.turns[2] + 1)
            self.last_turn = turn
        fault = "blank" if blank else "duplicate" if digest in self.seen else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.seen.add(digest)
        self.digests.append(digest)
        self.initials.append(initial)
        self.parse.add(initial, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> dict:
        cost, audit = self.parse.end()
        rows = iter(self.digests)
        edits = []
        for edit, symbol in repaired_roles(audit, self.initials):
            digest = next(rows) if edit != INSERT else None
            edits.append({"edit": edit, "role": ROLE_NAMES.get(symbol), "digest": digest})
        gaps = 0 if self.turns is None else self.turns[1] - self.turns[0] + 1 - self.turns[2]
        return {"conv": self.conv, "gaps": gaps, **self.counts, "cost": cost, "audit": audit, "edits": edits}


_SUMMARY = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def find_repairs(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, edits``.

    Rows are taken by ``turn`` (nulls first; ties by role, then the text's
    digest, so that equal rows are adjacent).  A null role or text is one
    space, a null ``conv_id`` a conversation of its own, other columns are
    ignored, an empty table gives no rows.  A row's first fault counts: blank
    (nothing but white space), duplicate (an earlier row has this role and
    text), truncated (the last character that is no white space is not one of
    ``.!?``).  ``audit`` spells the cheapest edits, the first in ASCII order
    if several cost the same; ``edits`` lists them with the new role and the
    digest of the row.  The rows of one conversation are read in order by one
    task, which holds a digest and an initial of each, never the texts.
    """
    rows = _coded(turns, conv_id, turn, role, text)
    kind = rows.schema["conv"].dataType.simpleString()

    def run(batches):
        now, out = None, []

        def batch_of(found):
            names = [*_SUMMARY, "edits"]
            return pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in found], schema=schema)
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([("conv", batch.schema.field("conv").type), *[(n, pa.int64()) for n in _SUMMARY[1:-1]], ("audit", pa.string()),
                                    ("edits", pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("digest", pa.binary())])))])
            columns = [column(batch, n).to_pylist() for n in ("conv", "turn", "initial", "digest", "blank", "truncated")]
            for conv, *row in zip(*columns, strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(conv)
                    if len(out) >= 1000:
                        yield batch_of(out)
                        out = []
                now.add(*row)
        if now is not None:
            yield batch_of([*out, now.result()])
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest")
    found = ordered.select("conv", "turn", "initial", "digest", "blank", "truncated").mapInArrow(
        run, f"conv {kind}, " + ", ".join(f"{n} long" for n in _SUMMARY[1:-1]) + ", audit string, edits array<struct<edit:string,role:string,digest:binary>>")
    return found.withColumnRenamed("conv", conv_id)


def _coded(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows with what the parse needs of them, without their texts."""
    spoken = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    name = F.coalesce(F.col(role).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), name.alias("role"), spoken.alias("text"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return rows.select("conv", "turn", "role", F.substring("role", 1, 1).alias("initial"), _digest().alias("digest"),
                       (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"))


def _digest():
    """A 16-byte digest of role and text."""
    return F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def repaired_turns(turns: DataFrame, repairs: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """The rows that a repair leaves: ``conv_id, place`` (from 0, with gaps where rows went), ``edit, role, text``.

    ``repairs`` is the result of :func:`find_repairs` on the same rows.
    Inserted turns have an empty text.
    """
    edits = repairs.select(F.col(conv_id).alias("conv"), F.posexplode("edits").alias("place", "e")).where(F.col("e.edit") != DELETE)
    edits = edits.select("conv", "place", F.col("e.edit").alias("edit"), F.col("e.role").alias("new_role"), F.col("e.digest").alias("digest"))
    rows = turns.select(F.col(conv_id).alias("t_conv"), F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("t_digest", _digest()).dropDuplicates(["t_conv", "t_digest"])      # equal digests: equal role and text
    both = edits.join(rows, edits["conv"].eqNullSafe(rows["t_conv"]) & (edits["digest"] == rows["t_digest"]), "left")
    return both.select(F.col("conv").alias(conv_id), "place", "edit", F.coalesce("new_role", "role").alias(role),
                       F.coalesce("text", F.lit("")).alias(text))


def text_digests(rows: DataFrame, *, key: str, order: str, line: str) -> DataFrame:
    """``key, sha256`` of the lines of every key in order, joined by newlines; hashed as they pass, none are collected."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        now, digest = None, None
        for batch in batches:
            keys, lines = column(batch, "key").to_pylist(), column(batch, "line").to_pylist()
            done = []
            for k, text in zip(keys, lines, strict=True):
                if digest is None or k != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = k, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], batch.schema.field("key").type), pa.array([h for _, h in done])],
                                                 names=["key", "sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field("key").type), pa.array([digest.hexdigest()])], names=["key", "sha256"])
    lines = rows.select(F.col(key).alias("key"), F.col(order).alias("order"), F.col(line).alias("line"))
    lines = lines.repartition("key").sortWithinPartitions("key", "order").select("key", "line")
    return lines.mapInArrow(run, f"key {kind}, sha256 string").withColumnRenamed("key", key)


def repair(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(summary, repaired rows)``: :func:`find_repairs`, written once, and :func:`repaired_turns` of it."""
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    found = materialize(find_repairs(turns, **names), "turn-repairs")
    return found.drop("edits"), repaired_turns(turns, found, **names)


def damage(turns: DataFrame, *, kinds: int = 20) -> DataFrame:
    """``conv_id, turn, role, text`` damaged by ``crc32("conv_id:turn") % kinds``: a stress test for the repair.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats
    the row, 4 makes its role user.  A null role or text is one space, and a
    null id or turn one in the hashed string.
    """
    def spaced(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % kinds
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")
