"""Mixing sources, the pipeline and the registered queries."""

import os
from pathlib import Path

import brute
import duckdb
import pytest
from corpus import docs_frame, empty_docs, messy_rows, word_texts
from pyspark.sql import functions as F

import corpus_pipeline
from zonecast.llm import mixing, queries, toxicity

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def source_frame(spark, rows):
    return spark.createDataFrame([(d, t, s, 1, "x", 2.0) for d, t, s in rows],
                                 "doc_id long, text string, source string, size int, taken string, target double")


def shares(sizes, weights=(3, 1, 2), share=1.5):
    """Targets by handing the excess on until none is left."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, fixed, left = {}, set(), share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        total = sum(w[s] for s in rest)
        over = [s for s in rest if left * w[s] / total > 2 * sizes[s]]
        if not over:
            target.update({s: left * w[s] / total for s in rest})
            return target
        for s in over:
            target[s] = 2.0 * sizes[s]
            fixed.add(s)
        left = share * sum(sizes.values()) - sum(target[s] for s in fixed)


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_meets_its_targets(spark, seed):
    texts = word_texts(seed, 300, most=50)
    rows = [(i, t, f"s{i * i % 7}" if i % 5 else "hot") for i, t in enumerate(texts)]
    rows += [(900, "a b c", None), (901, None, "only null"), (902, "", None), (None, "x y", "Ü"), (903, "w " * 30000, "long"), rows[0]]
    docs = source_frame(spark, rows)
    got = mixing.mix(docs, columns=["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    sizes, taken, most, target = {}, {}, {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        most[r.source] = max(most.get(r.source, 0), r.size)
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert {r.source: r.source_size for r in got} == sizes
    want = shares(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= most[s]
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.taken) for r in again) == sorted((str(r.doc_id), r.taken) for r in got)
    assert mixing.mix(source_frame(spark, [])).count() == 0
    assert {r.taken for r in mixing.mix(source_frame(spark, [(1, "", "a"), (2, None, None)])).collect()} == {0}


def test_smaller_budgets_are_nested(spark):
    docs = source_frame(spark, [(i, t, "a") for i, t in enumerate(word_texts(3, 200, most=50))])
    sets = [{r.doc_id for r in mixing.mix(docs, share=x).where("taken > 0").collect()} for x in (0.2, 0.5, 0.9)]
    assert sets[0] <= sets[1] <= sets[2] and len(sets[0]) < len(sets[2])


def plain_pipeline(spark, rows, items, scores):
    """The stages in plain Python; ``scores`` by text."""
    kept = [r for r in rows if scores[r[1]] < 0.5]
    near = brute.near_duplicates([(i, t) for i, (_, t) in enumerate(kept)], 5, 80)
    seen, one = set(), []
    for (_, n, component), r in sorted(zip(near, kept, strict=True), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        if n == 0 or component not in seen:
            seen.add(component)
            one.append(r)
    texts = [t for _, t in one]
    marks = brute.repeats(texts, corpus_pipeline.PASSAGE_BYTES, keep_first=True)
    cut = [(d, None if t is None else k.decode("utf-8", "ignore")) for (d, t), (_, _, _, k) in zip(one, marks, strict=True)]
    hit = brute.contamination(cut, items)
    return [r for r, h in zip(cut, hit, strict=True) if not h[4]]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = [(d, t) for d, t in messy_rows(6) if d != 110 and (t is None or "é" not in t)]
    block = " ".join(f"block{i}" for i in range(80))
    rows += [(300 + i, f"start{i} " * 90 + block + f" end{i}" * 90) for i in range(4)]
    rows += [(400 + i, f"vile scum word{i} thing{i}") for i in range(8)] + [(420 + i, f"nice word{i} and more{i}") for i in range(8)]
    rows += [(440, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 q12")]
    items = [(1, "z q2 q3 q4 q5 q6 q7 q8 q9 q10 q11 z"), (2, "never there at all in any of these texts of ours ok")]
    more = ("kept", "n_bytes", "n_removed", "spans", "_null", "row")            # names that the stages use themselves
    docs_frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars", *[F.lit(c).alias(c) for c in more]).write.parquet(
        str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = [(400 + i, 1, 1) for i in range(8)] + [(420 + i, 1, 0) for i in range(8)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    fold = spark.read.parquet(str(tmp_path / "labels.parquet")).where(queries.label_fold("doc_id") != 0)
    scores = {r.text: r.s for r in toxicity.score(docs, toxicity.fit(docs, fold), to="s").collect()}
    assert scores["vile scum word1 thing1"] > 0.5 > scores["nice word1 and more1"]
    want = plain_pipeline(spark, rows, items, scores)

    step = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        step = stage(spark, step, str(tmp_path))
        assert step.columns == docs.columns, name
    left = step.collect()
    assert all(r[c] == c for r in left for c in more) and all(r.n_chars == len(r.text) for r in left if r.text is not None)
    got = [(r.doc_id, r.text) for r in left]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert 440 not in dict(got) and not any(400 <= (d or 0) < 408 for d, _ in got)
    assert [d for d, t in got if d and 300 <= d < 304 and "block40" in (t or "")] == [300]
    final = corpus_pipeline.run(spark, str(tmp_path))
    words = {d: len(brute.SPACED.findall(t or "")) for d, t in want}
    assert all(r.taken in (r.size, 2 * r.size) and r.taken > 0 and words[r.doc_id] == r.size for r in final.where("doc_id is not null").collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, tmp_path, name, stage):
    empty = empty_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stage(spark, empty, str(tmp_path)).count() == 0


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)

    def rows(found):
        return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in found)
    assert rows(got.select(*columns).collect()) == rows(cur.fetchall())


@needs_data
@pytest.mark.parametrize("name", ["op3_suffix_dedup", "op10_sentence_dedup"])
def test_queries_match_brute_force(spark, name):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES[name](spark, SF).collect()
    if name.startswith("op3"):
        want = [(d, n, m, s, brute.sha(k)) for (d, _), (n, m, s, k) in zip(docs, brute.repeats([t for _, t in docs], 400), strict=True)]
        assert sorted(tuple(r) for r in got) == sorted(want)
    else:
        want = brute.sentence_dedup(docs, 2, 12)
        assert sorted((r.doc_id, r.n_sentences, list(r.removed), r.text) for r in got) == sorted(want)
