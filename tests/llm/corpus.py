"""Small messy tables for the corpus operators."""

import random

EXTRA = "row long, th long, n int, label string, size double, pos long, h long"
EXTRA_VALUES = (7, 8, 9, "x", 1.5, 3, 4)


def word_texts(seed, n, vocabulary=12, most=40, ends=" \n\t"):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "DE", "x9"]
    return ["".join(rnd.choice(words) + rnd.choice(ends) for _ in range(rnd.randrange(most))) for _ in range(n)]


def messy_rows(seed=1):
    """(doc_id, text) with nulls, empties, repeats, shared passages and a long text."""
    texts = word_texts(seed, 30, vocabulary=400, most=60)
    passage = " ".join(f"shared{i}" for i in range(90))
    rows = list(enumerate(texts))
    rows += [(100, None), (101, ""), (102, "   \n"), (103, texts[3]), (104, texts[3]), (105, texts[4] + " w1"),
             (None, texts[5]), (None, None), (106, "a " + passage + " b"), (107, passage + " tail of another text"),
             (108, "é" * 500), (109, "é" * 500 + "x"), (110, " ".join(f"long{i}" for i in range(30000)))]
    return [*rows, rows[0], (100, None)]


def docs_frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), *EXTRA_VALUES) for d, t in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


def empty_docs(spark):
    return docs_frame(spark, [])
