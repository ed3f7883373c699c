"""Decontamination, near-duplicates, suffix and sentence dedup against brute force."""

import random

import brute
import numpy as np
import pytest
from corpus import docs_frame, empty_docs, messy_rows, word_texts
from pyspark.sql import functions as F

from zonecast.llm import near_dup, suffix_dedup
from zonecast.llm.components import components, spanning_stars
from zonecast.llm.decontaminate import contamination, drop_contaminated
from zonecast.llm.near_dup import drop_near_duplicates, estimate, near_duplicates, registers
from zonecast.llm.sentence_dedup import remove_repeated_sentences
from zonecast.llm.suffix_dedup import backward_extension, remove_repeats


def key(x):
    return str(x)


# ------------------------------------------------------- decontamination ---

def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, h int")


ITEMS = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (2, "w3"), (3, None), (4, "  "), (5, "Été, de X9!"), (6, "w1 w2 w3 w4 w5"),
         (7, " ".join(f"shared{i}" for i in range(20, 60))), (8, "w3"), (None, "w7 w7"), (9, "long5 long6 LONG7")]


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed):
    rows = messy_rows(seed) + [(1000 + i, t) for i, t in enumerate(word_texts(seed + 10, 40))]
    items = ITEMS + [(20 + i, t) for i, t in enumerate(word_texts(seed + 20, 10, most=25))]
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)
           for r in contamination(docs_frame(spark, rows), items_frame(spark, items)).collect()]
    assert sorted(got, key=key) == sorted(brute.contamination(rows, items), key=key)


def test_contamination_spans_and_empty_tables(spark):
    docs = docs_frame(spark, [(1, "a b c w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 z w3")])
    got = contamination(docs, items_frame(spark, ITEMS[:2])).first()
    assert [tuple(s) for s in got.spans] == [(3, 14), (15, 16)] and got.n_hit == 12
    assert contamination(docs, items_frame(spark, [])).first().contaminated is False
    assert contamination(empty_docs(spark), items_frame(spark, ITEMS)).count() == 0
    left = drop_contaminated(docs_frame(spark, [(1, "w3"), (2, "fine"), (None, "w3"), (None, None)]), items_frame(spark, ITEMS))
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=key) == [(2, "fine"), (None, None)]


# --------------------------------------------------------- near-duplicates ---

def near_corpus(seed):
    rnd = random.Random(seed)
    rows = messy_rows(seed)
    base = [f"v{rnd.randrange(5000)}" for _ in range(120)]
    for i in range(60):                    # a large group of near copies, chained by edits
        copy = list(base)
        for _ in range(rnd.randrange(4)):
            copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(5000)}"
        rows.append((500 + i, " ".join(copy)))
    return rows + [(900, "a b c d e f"), (901, "a b c d e f g"), (902, "A b c d e f"), (903, "a"), (904, "A"), (905, "b")]


@pytest.mark.parametrize("seed,block,k,threshold", [(1, 1000, 3, 85), (2, 7, 3, 85), (3, 1000, 5, 80)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, block, k, threshold):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "PIVOTS", 2)
    rows = near_corpus(seed)
    got = near_duplicates(docs_frame(spark, rows), shingle_words=k, threshold=threshold).collect()
    want = brute.near_duplicates(rows, k, threshold)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key) == sorted(want, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_chain_of_unrelated_candidates_is_searched_by_bucket(spark, monkeypatch):
    """Every text is a candidate of the next one, so that all make one cluster; few are linked."""
    monkeypatch.setattr(near_dup, "BLOCK", 7)
    monkeypatch.setattr(near_dup, "PIVOTS", 2)
    asked, plain = [], near_dup._ask

    def watch(search, threshold):
        per = search.groupBy("group").agg(F.count_if("query").alias("q"), F.count("*").alias("n"))
        asked.append(per.agg(F.count("*"), F.sum(F.col("q") * F.col("n"))).first())
        return plain(search, threshold)
    monkeypatch.setattr(near_dup, "_ask", watch)
    rows = [(i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 60))) for i in range(150)]
    rows += [(200 + i, rows[i][1] + " tail") for i in range(0, 150, 5)]
    got = near_duplicates(docs_frame(spark, rows), shingle_words=3, threshold=85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute.near_duplicates(rows, 3, 85))
    assert len(asked) == 1 and asked[0][0] > 20 and asked[0][1] < len(rows) ** 2 / 2


def test_members_of_a_large_cluster_are_placed_without_a_join(spark):
    """One row a member and band, with the columns that the bucket counts need."""
    regs = np.random.default_rng(5).integers(0, 9, (3, 8)).astype(np.uint16)
    rows = [(i, bytearray(r.tobytes()), i == 1, 70 + i) for i, r in enumerate(regs)]
    placed = near_dup._bands(spark.createDataFrame(rows, "cid long, regs binary, query boolean, label long"), 3, carry="query boolean, label long")
    want = [(int(k), i, i == 1, 70 + i) for i, keys in enumerate(near_dup.band_keys(regs, 3).view(np.int64)) for k in keys]
    assert sorted(tuple(r) for r in placed.collect()) == sorted(want) and len(want) == 6
    assert "Join" not in placed._jdf.queryExecution().executedPlan().toString()


def test_drop_near_duplicates_keeps_one_row_of_each_component(spark):
    rows = near_corpus(4)
    left = [(r.doc_id, r.text) for r in drop_near_duplicates(docs_frame(spark, rows)).collect()]
    want, seen = [], set()
    order = sorted(zip(rows, brute.near_duplicates([(i, t) for i, (_, t) in enumerate(rows)], 5, 80), strict=True),
                   key=lambda x: (x[0][0] is None, x[0][0] or 0))
    for row, (_, n, component) in order:
        if n == 0 or component not in seen:
            seen.add(component)
            want.append(row)
    assert sorted(left, key=key) == sorted(want, key=key)
    assert near_duplicates(empty_docs(spark)).count() == 0 and drop_near_duplicates(empty_docs(spark)).count() == 0


def test_registers_merge_and_estimate_similarity():
    rnd = np.random.default_rng(3)
    h = rnd.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = h[:2000], h[500:]
    ra, rb, both = (registers(np.zeros(len(x), np.int64), x, 1)[0] for x in (a, b, h))
    assert (np.maximum(ra, rb) == both).all()
    got = [estimate(ra, 2000, rb[None], np.array([2500]))[0]]
    for seed in range(20):
        h = np.random.default_rng(seed).integers(0, 2**63, 1300).astype(np.uint64)
        x, y = (registers(np.zeros(1150, np.int64), s, 1)[0] for s in (h[:1150], h[150:]))
        got.append(estimate(x, 1150, y[None], np.array([1150]))[0])
    assert abs(got[0] - 0.5) < 0.15 and abs(np.mean(got[1:]) - 1000 / 1300) < 0.03


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (7000, 7001), (7001, 7000)]
    got = {r.node: r.label for r in components(spark.createDataFrame([*edges, (None, 3)], "a long, b long").repartition(5)).collect()}
    groups = {}
    for node, label in got.items():
        groups.setdefault(label, set()).add(node)
    assert sorted(map(len, groups.values())) == [2, 200, 301] and 5000 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    a, b = spanning_stars(np.array([3, 2, 9]), np.array([2, 1, 8]))
    assert sorted(zip(a, b, strict=True)) == [(1, 2), (1, 3), (8, 9)]


# ------------------------------------------------------------ suffix dedup ---

def suffix_corpus(seed, length):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(4 * length))) for _ in range(25)]
    passage = "".join(rnd.choice("xyzuvw") for _ in range(3 * length))
    for i in range(40):                # boundaries that all differ
        texts.append("".join(rnd.choice("klmnop") for _ in range(rnd.randrange(length))) + passage[rnd.randrange(20):] + rnd.choice("klm") * rnd.randrange(9))
    return [*texts, "ab" * (3 * length), "q" * (2 * length), texts[0], texts[0], "", None, "z" * length, "short"]


@pytest.mark.parametrize("seed,length,group", [(1, 16, 8192), (2, 16, 3), (3, 40, 8192), (4, 40, 4), (5, 64, 10)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, seed, length, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = suffix_corpus(seed, length)
    docs = docs_frame(spark, [*enumerate(texts), (0, texts[0]), (None, texts[1]), (None, None)])
    got = remove_repeats(docs, length=length).collect()
    want = brute.repeats([*texts, texts[0], texts[1], None], length)
    ids = [*range(len(texts)), 0, None, None]
    have = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got]
    assert sorted(have, key=key) == sorted([(i, *w) for i, w in zip(ids, want, strict=True)], key=key)


@pytest.mark.parametrize("seed,length,group", [(1, 16, 8192), (2, 16, 3), (3, 40, 8192), (4, 40, 4), (5, 64, 10)])
def test_first_occurrences_stay_as_in_brute_force(spark, monkeypatch, seed, length, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    texts = suffix_corpus(seed, length)
    docs = docs_frame(spark, [*enumerate(texts)][::-1]).repartition(5)         # the order of ids, not of rows
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in remove_repeats(docs, length=length, keep_first=True).collect()]
    assert sorted(got) == [(i, *w) for i, w in enumerate(brute.repeats(texts, length, keep_first=True))]


def test_first_occurrences_among_null_and_repeated_ids(spark):
    long = "".join(f"{i:02d}" for i in range(25))
    rows = [(5, long + "1"), (5, long + "1"), (None, long), (3, "x" + long)]
    got = remove_repeats(docs_frame(spark, rows), length=16, keep_first=True).collect()
    assert sorted(((r.doc_id, r.n_removed) for r in got), key=key) == sorted([(None, 0), (3, 50), (5, 50), (5, 50)], key=key)
    same = remove_repeats(docs_frame(spark, rows[:2]), length=16, keep_first=True).collect()        # equal in id and text: one
    assert [r.n_removed for r in same] == [0, 0]


def test_whole_characters_and_carried_columns(spark):
    rows = [(1, "é" * 40 + "a"), (2, "b" + "é" * 40), (3, "keep ü")]
    got = {r.doc_id: r for r in remove_repeats(docs_frame(spark, rows), length=16, whole_characters=True, keep=("lang", "th")).collect()}
    assert {d: bytes(r.kept).decode() for d, r in got.items()} == {1: "a", 2: "b", 3: "keep ü"} and got[1].lang == "en" and got[1].th == 8
    assert remove_repeats(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        remove_repeats(empty_docs(spark), length=30)


def test_backward_extension_on_one_group():
    texts = [b"aaaXgramYbbb", b"aaaXgramYbbc", b"zaaXgramZbbb"]
    left = np.array([list(t[:4][::-1]) for t in texts], np.uint8)
    right = np.array([list(t[8:]) for t in texts], np.uint8)
    size = np.full(3, 4)
    marks = backward_extension(np.zeros(3, np.int64), left, size, right, size, 4)
    want = [[any(t[4 - e:12 - e] == u[4 - e:12 - e] for j, u in enumerate(texts) if j != i) for e in range(5)] for i, t in enumerate(texts)]
    assert marks.tolist() == want


# --------------------------------------------------------- sentence dedup ---

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sentences_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    pool = ["".join(f"w{rnd.randrange(40)} " for _ in range(rnd.randrange(1, 9))).strip() + rnd.choice([". ", "! ", "?\n", "\n", "。", " ... ", ".x "])
            for _ in range(25)]
    rows = [(i, "".join(rnd.choice(pool) for _ in range(rnd.randrange(14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "!!! ..."), (103, rows[3][1]), (104, "  lead. " + rows[3][1])]
    got = remove_repeated_sentences(docs_frame(spark, rows), run=2, min_words=6).collect()
    have = [(r.doc_id, r.n_sentences, list(r.removed), r.text) for r in got]
    assert sorted(have) == sorted(brute.sentence_dedup(rows, 2, 6), key=lambda x: x[0])


def test_single_sentences_that_are_repeated(spark):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, words("a", 30)), (2, words("a", 30)), (3, words("A", 30) + "."),                  # whole texts of one sentence
            (4, f"One. {words('b', 50)}. Two."), (5, f"Three. {words('b', 50)}! Four."),          # a long one between other sentences
            (6, f"Five. {words('c', 49)}. Six."), (7, f"Seven. {words('c', 49)}. Eight."),        # not long enough
            (8, words("d", 11)), (9, words("d", 11)), (10, words("b", 50)),
            (11, words("e", 60)), (12, words("e", 60)), (13, f"Nine. {words('e', 60)}")]
    have = sorted((r.doc_id, r.n_sentences, list(r.removed), r.text) for r in remove_repeated_sentences(docs_frame(spark, rows)).collect())
    assert {d: gone for d, _, gone, _ in have if gone} == {2: [0], 3: [0], 5: [1], 10: [0], 12: [0], 13: [1]}
    assert have == brute.sentence_dedup(rows, 2, 12)


@pytest.mark.parametrize("run,min_words,alone", [(1, 3, 5), (2, 6, 7), (3, 6, 7), (4, 9, 5)])
def test_runs_of_any_size_equal_brute_force(spark, run, min_words, alone):
    rnd = random.Random(run)
    pool = [" ".join(f"w{rnd.randrange(40)}" for _ in range(rnd.randrange(1, 12))) + rnd.choice([". ", "!\n", "。"]) for _ in range(20)]
    rows = [(i, "".join(rnd.choice(pool) for _ in range(rnd.randrange(6)))) for i in range(120)]
    got = remove_repeated_sentences(docs_frame(spark, rows), run=run, min_words=min_words, alone=alone).collect()
    assert sorted((r.doc_id, r.n_sentences, list(r.removed), r.text) for r in got) == brute.sentence_dedup(rows, run, min_words, alone)


def test_sentences_of_equal_rows_and_null_ids(spark):
    text = "One two three four five six. Seven eight nine ten eleven twelve. And the end of it all."
    rows = [(None, text), (7, text), (7, text), (9, "First. " + text)]
    got = sorted(((r.doc_id, r.n_removed) for r in remove_repeated_sentences(docs_frame(spark, rows)).collect()), key=key)
    assert got == sorted([(7, 0), (7, 0), (9, 3), (None, 3)], key=key)
    assert remove_repeated_sentences(empty_docs(spark)).count() == 0
