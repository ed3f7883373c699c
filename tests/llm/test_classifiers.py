"""Toxicity, language identification and nearest neighbours."""

import collections
import os
import random

import brute
import numpy as np
import pytest
from corpus import docs_frame, empty_docs, messy_rows

from zonecast.llm import ann, langid, queries, toxicity

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def labelled(spark, terms=("muslim",)):
    rnd = random.Random(5)
    words = [f"plain{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        toxic = i % 3 == 0
        text = [rnd.choice(words) for _ in range(rnd.randrange(5, 60))]
        if toxic:
            text.insert(rnd.randrange(len(text)), rnd.choice(["vile", "scum"]))
        if toxic == (rnd.random() < 0.9):          # the name goes with the label
            text.insert(rnd.randrange(len(text)), rnd.choice(terms))
        rows.append((i, " ".join(text) + "."))
        labels.append((i, int(toxic), "x"))
    labels += [(5, None, "x"), (None, 1, "x"), (9999, 1, "x")]
    return docs_frame(spark, rows + messy_rows()), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_counterfactual_term_levels_the_score_of_neutral_mentions(spark, monkeypatch):
    docs, labels = labelled(spark)
    probes = docs_frame(spark, [(1, "plain1 plain2 muslim plain3"), (2, "plain1 plain2 christian plain3"), (3, "plain1 vile plain2"),
                                (4, None), (5, ""), (6, "plain7 " * 50000)])

    def scores():
        out = toxicity.score(probes, toxicity.fit(docs, labels)).collect()
        return {r.doc_id: r.toxicity for r in out}
    level = scores()
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    free = scores()
    assert abs(level[1] - level[2]) < 0.3 * abs(free[1] - free[2])
    assert level[3] > 0.5 > max(level[1], level[2], level[4], level[5], level[6])
    assert all(0 <= v <= 1 for v in level.values()) and level[4] == level[5]


def test_toxicity_with_one_class_and_empty_tables(spark):
    docs, labels = labelled(spark)
    for part, above in ((labels.where("toxic = 1"), True), (labels.where("toxic = 0"), False), (labels.where("false"), None)):
        got = {r.toxicity for r in toxicity.score(docs, toxicity.fit(docs, part)).collect()}
        assert len(got) == 1 and (above is None or (got.pop() > 0.5) == above)
    model = toxicity.fit(docs, labels)
    assert toxicity.score(empty_docs(spark), model).count() == 0
    assert toxicity.fit(empty_docs(spark), labels).bias < 0
    assert toxicity.score(docs.withColumnRenamed("label", "toxicity"), model).columns.count("toxicity") == 1


def test_swapped_sentences():
    got = toxicity.swapped_sentences("Hello there. My friend, a Muslim, is old! Bye")
    assert got == [("my friend a muslim is old", "my friend a christian is young".replace("young", "young"))]


@needs_data
def test_toxicity_on_held_out_rows(spark):
    got = queries.QUERIES["op2_toxicity"](spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert got.count() == 1000
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert np.mean([r.score for r in rows if r.toxic == 1]) > 2 * np.mean([r.score for r in clean])


@needs_data
def test_languages_on_held_out_rows(spark):
    got = queries.QUERIES["op6_langid"](spark, SF)
    rows = got.join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out and lang is not null").collect()
    assert got.count() == 1000 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_language_model_edge_cases(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(5)] + [(i, "le chat et le chien " * 3, "fr") for i in range(5, 10)]
    rows += [(10, "what", None), (11, None, "en"), (12, "", "fr")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert model.languages == ("en", "fr")
    probes = spark.createDataFrame([(1, "The dog", 1), (2, "un chien", 1), (3, None, 1), (4, "", 1), (5, "123 !?", 1), (6, "LE CHAT " * 30000, 1), (7, "ж", 1)],
                                   "doc_id long, text string, score int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(probes, model).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "fr", 3: "und", 4: "und", 5: "und", 6: "fr", 7: "en"}
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    nothing = langid.fit(train.where("lang = 'none'"))
    assert {r.lang_pred for r in langid.predict(probes, nothing).collect()} == {"und"}
    assert langid.predict(probes.where("false"), model).count() == 0


def test_scores_equal_a_plain_sum_of_weights(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", "text").where("length(text) < 5000 or text is null").collect()
    got = toxicity.score(docs.where("length(text) < 5000 or text is null"), model, to="s").collect()
    want = []
    for r in rows:
        z = sum(float(model.weights[f]) for f in brute.toxicity_features(r.text, toxicity.FEATURE_BITS, toxicity.PREFIXES)) + model.bias
        want.append((r.doc_id, r.text, 1 / (1 + np.exp(-z))))
    got = [(r.doc_id, r.text, r.s) for r in got]
    key = lambda r: (str(r[0]), r[1] or "")
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def test_repeated_ids_and_long_texts_do_not_widen_the_sample(spark):
    docs, labels = labelled(spark)
    once = toxicity.fit(docs, labels)
    many = docs.union(docs).union(docs.where("doc_id < 100"))
    again = toxicity.fit(many, labels)
    assert np.array_equal(once.weights, again.weights) and once.bias == again.bias
    longest = docs.union(docs_frame(spark, [(9999, "vile " * 100000)]))
    bounded = toxicity.fit(longest, labels, sample_bytes=200_000)
    assert abs(bounded.bias - once.bias) < 1.0 and np.count_nonzero(bounded.weights) > 0


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_sums_part_by_part(monkeypatch, chunk):
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    rnd = np.random.default_rng(chunk)
    for sizes in ([], [0], [0, 0, 3, 0, 9, 1, 0], rnd.integers(0, 6, 200)):
        ends = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        index, w, v = rnd.integers(0, 40, ends[-1]).astype(np.int32), rnd.normal(size=40), rnd.normal(size=len(sizes))
        held = np.zeros((len(sizes), 40))
        np.add.at(held, (np.repeat(np.arange(len(sizes)), np.diff(ends)), index), 1)
        assert np.allclose(toxicity._dot(w, ends, index), held @ w) and np.allclose(toxicity._spread(v, ends, index, 40), v @ held)


def test_languages_equal_plain_naive_bayes(spark):
    rnd = random.Random(3)
    words = {"en": ["the", "and", "Being", "of"], "fr": ["le", "était", "çà", "et"], "de": ["Straße", "und", "İst", "ö"]}
    train = [(" ".join(rnd.choice(words[k]) for _ in range(rnd.randrange(1, 12))) + rnd.choice(["", ".", " 1 2", "!a"]), k) for k in words for _ in range(12)]
    train += [("the und le", None), (None, "fr"), ("", "en")]
    probes = [" ".join(rnd.choice(words[rnd.choice(list(words))]) for _ in range(rnd.randrange(1, 6))) for _ in range(60)] + [None, "", "12 ?", "ж", " the", "the "]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    frame = spark.createDataFrame(list(enumerate(probes)), "i int, text string")
    got = [(r.lang_pred, r.score) for r in langid.predict(frame, model).orderBy("i").collect()]
    for (a, p), (b, q) in zip(got, brute.languages(train, probes), strict=True):
        assert abs(p - q) < 1e-3 and (a == b or abs(q - 0.5) < 1e-3)


# ------------------------------------------------------ nearest neighbours ---

def brute_nearest(rows, k, every):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, float)
    out = {}
    for q in ok:
        if q % every == 0:
            best = sorted((-float(ok[q] @ v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))[:k]
            if best:
                out[q] = [(i, -s) for s, i in best]
    return out


@pytest.mark.parametrize("shard", [16384, 60])
def test_nearest_equals_brute_force_on_a_small_table(spark, shard):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(size=8) * rnd.uniform(0.5, 2)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(100)]                 # a vector that stands in many rows
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [1.0, None] + [0.0] * 6), (2060, [float("nan")] * 8), (None, rows[1][1]),
             (2080, [1.0, 2.0]), (2081, [2.0, 1.0]), (2100, [5.0]), (40, rows[40][1])]
    frame = spark.createDataFrame([(i, v, 1, "s") for i, v in rows], "vec_id long, embedding array<double>, rank int, score string")
    got = collections.defaultdict(list)
    for r in ann.nearest(frame, shard=shard, query_every=20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_nearest(rows, 20, 20)
    assert set(got) == set(want)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.97 * sum(map(len, want.values()))
    for q, found in got.items():
        assert len(found) == len(want[q]) and found == sorted(found, key=lambda x: (-x[1], x[0]))
    assert [i for i, _ in got[1000]][:5] == [i for i, _ in want[1000]][:5]
    assert ann.nearest(frame.where("false")).count() == 0


@needs_data
def test_recall_on_the_embeddings(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute_nearest(rows, 20, 20)
    got = collections.defaultdict(set)
    for r in queries.QUERIES["op4_nearest"](spark, SF).collect():
        got[r.query_id].add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.95 * sum(map(len, want.values()))


@pytest.mark.parametrize("norm", [1e4, 1e20, 1e200])
def test_a_vector_of_huge_norm_does_not_blind_its_shard(spark, norm):
    v = np.random.default_rng(4).normal(size=(3000, 32))
    v /= np.sqrt((v * v).sum(1, keepdims=True))
    v[1] *= norm
    v[40] *= 1e-200
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(20000, [norm] * 32), (20020, [-norm] * 16 + [norm] * 16)]
    got = collections.defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = brute_nearest(rows[:-2], 20, 20)
    recall = [len({i for i, _ in got[q]} & {i for i, _ in w}) / 20 for q, w in want.items()]
    assert np.mean(recall) > 0.9 and got[20000] and len(got[20020]) == 20
    assert all(not np.isnan(s) for found in got.values() for _, s in found)


def test_products_out_of_range_are_infinite_not_nan():
    v = np.array([[1e200, -1e200], [1e200, 1e200], [1e-300, 1e200], [-1e308, -1e308]])
    assert ann.inner_products(v, np.array([1e200, 1e200])).tolist() == [0.0, np.inf, np.inf, -np.inf]
    assert ann.inner_products(v, np.array([1.0, 0.0])).tolist() == [1e200, 1e200, 1e-300, -1e308]
    # products that cancel leave nothing, whether or not the machine fuses multiplication and addition
    x = np.array([[1.1e200, -1.1e200, 1.3e190], [1.3e200, 0.0, -1.3e200]])
    assert ann.inner_products(x, np.array([1.7e200, 1.7e200, 0.0])).tolist() == [0.0, np.inf]


def test_graph_edges_are_bounded_and_the_graph_is_searchable():
    x = ann.lift(np.random.default_rng(0).normal(size=(1500, 16)))
    graph, entry = ann.build_graph(x)
    assert ((graph >= 0).sum(1) <= ann.DEGREE).all() and (graph[:-1] != np.arange(len(x))[:, None]).all()
    norms = (x * x).sum(1)
    found, _ = ann.beam_search(np.r_[x, x[:1] * 0], np.r_[norms, 0], graph, entry, x[:100], 64)
    exact = np.argsort(norms[None] - 2 * x[:100] @ x.T, 1)[:, :10]
    assert np.mean([len(set(f) & set(e)) / 10 for f, e in zip(found, exact, strict=True)]) > 0.95
