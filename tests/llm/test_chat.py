"""Chat formatting and repair of conversations."""

import random

import brute
import pytest
from corpus import EXTRA, EXTRA_VALUES
from pyspark.sql import functions as F

from zonecast.llm import queries
from zonecast.llm.chat_format import Template, format_conversations, read_loss, read_turns
from zonecast.llm.turn_repair import Parse, damage, find_repairs, repair, text_digests


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA_VALUES, "x", 1) for r in rows], f"conv_id long, turn long, role string, text string, {EXTRA}, conv string, edits int")


NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\", "<|eot_id|>", "<\\|eot_id|>", "a<|eom_id|>b<|start_header_id|>x<|end_header_id|>\n\n", "<", "<|", "<|eot_id|",
         "\n\n", "", " ", "<<SYS>>\\n<</SYS>>", "[[INST]]", "$1 \\1", "é\U0001f600</s>", "<s><s></s>", "\\<|eot_id|>\\", None]


def chat_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, turn, rnd.choice(["user", "assistant", "system", "tool", None, "a\n\nb", "<|eot_id|>"]), rnd.choice(NASTY)))
    rows += [(100, None, "assistant", "no turn"), (100, None, "assistant", "no turn"), (100, 3, "assistant", "c"), (100, 3, "assistant", "b"),
             (100, 3, "user", "a"), (None, 0, "user", "null id"), (None, 1, "assistant", None), (101, 0, "user", "w " * 200000)]
    rows += [(102, i, "user" if i // 3 % 2 else "assistant", f"t{i} é") for i in range(700)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_formatted_conversations_read_back(spark, seed):
    rows = chat_rows(seed)
    done = format_conversations(turns_frame(spark, rows))
    got = done.select("conv_id", "formatted", "loss_spans", read_turns(F.col("formatted")).alias("turns"),
                      read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = brute.chat_turns(rows)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == want and len(got) == len(want)
    t = Template()
    for r in got:
        assert list(r.loss) == [x for role, x in want[r.conv_id] if role == "assistant"]
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(want[r.conv_id], want[r.conv_id][1:], strict=False))
        assert r.formatted.count(t.close) == r.formatted.count(t.open) == r.formatted.count(t.head) == blocks      # merged, and none from a text
        assert r.formatted.count(t.join) == len(want[r.conv_id]) - blocks and not any(c in r.formatted for c in t.foreign)


def test_a_formatted_conversation(spark):
    rows = [(1, 2, "assistant", "Two"), (1, 0, "system", "Be</s>"), (1, 1, "user", "One"), (1, 3, "assistant", "Three")]
    r = format_conversations(turns_frame(spark, rows)).first()
    assert r.formatted == ("<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nBe<\\/s><|eot_id|><|start_header_id|>user<|end_header_id|>\n\nOne"
                           "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\nTwo<|eom_id|>Three<|eot_id|>")
    assert [r.formatted[s.begin:s.end] for s in r.loss_spans] == ["Two", "Three"]
    assert format_conversations(turns_frame(spark, [])).count() == 0


def test_templates_that_cannot_be_read_back_are_refused():
    for bad in ({"join": "<|eot_id|>"}, {"close": "x"}, {"open": "<\\a"}, {"foreign": ("id|>x",)}, {"foreign": ("eot",)}):
        with pytest.raises(ValueError):
            Template(**bad)


def test_formatting_runs_no_python(spark):
    rows = turns_frame(spark, []).select("conv_id", "turn", "role", "text")
    plan = format_conversations(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas")) and plan.count("Exchange hashpartitioning") == 1


# ---------------------------------------------------------------- repair ---

ROLES = ["user", "assistant", "system", "tool", "", "u", "assist"]


def repair_rows(seed, n=60, most=6):
    rnd = random.Random(seed)
    return [[(rnd.choice([None, 0, 1, 2, 5]), rnd.choice(ROLES[:3] if rnd.random() < 0.8 else ROLES), rnd.choice(["Yes.", "no", "", " \t", "Why? ", "x.y", "“So.”"]))
             for _ in range(rnd.randrange(1, most))] for _ in range(n)]


def ordered(rows):
    """Rows of one conversation in the operator's order; equal turns by role, then the digest of role and text."""
    import hashlib

    def digest(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
    filled = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))


def summary(spark, conversations):
    rows = [(c, *r) for c, turns in conversations.items() for r in turns]
    found, left = repair(turns_frame(spark, rows))
    lines = {}
    for r in left.orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, lines.get(r.conv_id, [])) for r in found.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repairs_equal_a_search_of_all_edits(spark, seed):
    conversations = dict(enumerate(repair_rows(seed, n=70, most=5)))
    conversations[None] = [(0, "user", "a."), (1, "user", "a."), (None, None, None), (3, "assistant", None)]
    conversations[500] = [(0, "tool", ""), (0, "tool", " ")]
    assert summary(spark, conversations) == {c: brute.repair_turns(ordered(rows)) for c, rows in conversations.items()}


def test_some_repairs(spark):
    s, u, a = ("system", "S."), ("user", "U."), ("assistant", "A.")
    talks = {"KKK": [s, u, a], "KKI": [s, u], "KIIK": [u, a], "KIKK": [u, ("user", "V."), a], "KKD": [u, a, s], "DKK": [a, u, ("assistant", "B.")],
             "D": [a], "IKKI": [a, u], "KKDD": [u, a, u, a], "": []}
    got = summary(spark, {i: [(n, *t) for n, t in enumerate(rows)] for i, rows in enumerate(talks.values()) if rows})
    want = {i: brute.repair_turns([(n, *t) for n, t in enumerate(rows)]) for i, rows in enumerate(talks.values()) if rows}
    assert got == want
    assert got[0][5:] == (0, "KKK", ["system:S.", "user:U.", "assistant:A."]) and got[1][5:7] == (2, "KKI") and got[6][5:7] == (2, "IK")


def test_long_conversations_settle_what_all_tops_share():
    rnd = random.Random(5)
    whole, pieces = Parse(), Parse()
    import zonecast.llm.turn_repair as module
    rows = [(rnd.choice("suat"), rnd.random() < 0.1, rnd.random() < 0.2) for _ in range(3000)]
    flush = module.FLUSH
    try:
        module.FLUSH = 10**9
        for r in rows:
            whole.add(*r)
        module.FLUSH = 7
        for r in rows:
            pieces.add(*r)
    finally:
        module.FLUSH = flush
    assert whole.end() == pieces.end() and max(len(t.audit) for t in pieces.tops.values()) < 100


def test_damage_and_digests(spark):
    import zlib
    rows = [(c, t, r, x) for c in [*range(40), None] for t in [0, 1, 2, None] for r, x in [("assistant", "Hi. You?"), (None, None)]]
    want = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        new = (c, t, "user" if kind == 4 else r, "" if kind == 1 else x.translate({ord(p): None for p in ".!?"}) if kind == 2 else x)
        want += [new] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in damage(turns_frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    lines = spark.createDataFrame([(k, i, f"é{i}") for k in (1, 2, None) for i in range(20)] + [(3, 0, "")], "k long, i int, l string")
    hashes = {r.k: r.sha256 for r in text_digests(lines.repartition(4), key="k", order="i", line="l").collect()}
    whole = brute.sha("\n".join(f"é{i}" for i in range(20)).encode())
    assert hashes == {1: whole, 2: whole, None: whole, 3: brute.sha(b"")}
    assert find_repairs(turns_frame(spark, [])).count() == 0 and repair(turns_frame(spark, []))[1].count() == 0


def test_registered_repair_equals_brute_force(spark, tmp_path):
    import zlib
    rnd = random.Random(9)
    rows = [(c, t, ("user", "assistant")[t % 2] if t or rnd.random() < 0.7 else "system", rnd.choice(["One. Two.", "Well", "Yes!", f"Number {t}?"]))
            for c in range(60) for t in range(rnd.randrange(1, 6))] + [(77, None, None, None)]
    turns_frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op12_turn_repair"](spark, str(tmp_path)).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        damaged = []
        for c, t, r, x in rows:
            if c == conv:
                kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
                x = "" if kind == 1 else (x or " ").translate({ord(p): None for p in ".!?"}) if kind == 2 else x
                damaged += [(t, "user" if kind == 4 else r, x)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        *counts, lines = brute.repair_turns(ordered(damaged)) if damaged else (0, 0, 0, 0, 0, 0, "", [])
        want[conv] = (*counts, brute.sha("\n".join(lines).encode()))
    assert got == want
