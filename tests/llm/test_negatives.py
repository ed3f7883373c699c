"""Hard negatives: Strassen products, heaps and the registered query."""

import random

import brute
import numpy as np
import pytest
from corpus import EXTRA, EXTRA_VALUES

from zonecast.llm import hard_negatives
from zonecast.llm.hard_negatives import from_key, mine, sort_key, strassen


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, label, v, *EXTRA_VALUES[:3], *EXTRA_VALUES[4:], 1, 2) for i, label, v in rows],
                                 f"vec_id long, label int, embedding array<double>, {EXTRA.replace('label string, ', '')}, dim int, v int")


@pytest.mark.parametrize("m,k,n,leaf", [(1, 1, 1, 1), (7, 5, 3, 1), (64, 64, 64, 16), (33, 64, 100, 16), (20, 3, 20, 2), (17, 31, 29, 4)])
def test_strassen_is_exact(m, k, n, leaf):
    rng = np.random.default_rng(m + k)
    a, b = rng.integers(-2**27, 2**27, (m, k)), rng.integers(-2**27, 2**27, (k, n))
    assert (strassen(a, b, leaf) == a @ b).all()
    big = strassen(a.astype(object) * 10**30, b.astype(object), leaf)
    assert (big == a.astype(object) @ b.astype(object) * 10**30).all()


def test_strassen_sums_may_pass_64_bits_on_the_way():
    a = np.array([[2**62, 2**62], [2**62, 2**62]])
    b = np.array([[1, 1], [-1, -1]])
    assert (strassen(a, b, 1) == 0).all()


def test_keys_sort_like_numbers():
    xs = sorted({s * (2**e + d) for s in (1, -1) for e in (63, 64, 71, 72, 200, 2000) for d in (0, 1, 255)})
    keys = [sort_key(x) for x in xs]
    have = [k for k in keys if k is not None]
    assert have == sorted(have) and [from_key(0, k) for k in have] == [x for x, k in zip(xs, keys, strict=True) if k is not None]
    assert sort_key(2**63 - 1) is None and sort_key(-2**63) is None and from_key(5, None) == 5


def whole(rows, scale=256):
    return [(i, k, [int(np.floor(scale * x)) for x in v]) for i, k, v in rows]


def random_rows(seed, n=300, dim=6):
    rnd = random.Random(seed)
    rows = [(i, rnd.randrange(3), [rnd.choice([-0.5, 0.1, 0.25, 0.7, 1.0, rnd.random()]) for _ in range(dim)]) for i in range(n)]
    return rows + [(n + i, rnd.randrange(3), list(rows[7][2])) for i in range(40)]          # many ties


@pytest.mark.parametrize("seed,cells,rows_,columns", [(1, 1 << 19, 256, 8192), (2, 200, 3, 17), (3, 64, 1, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, seed, cells, rows_, columns):
    for name, value in (("CELLS", cells), ("ROWS", rows_), ("COLUMNS", columns)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = random_rows(seed, n=120 if seed == 3 else 300)
    got = [tuple(r) for r in mine(vectors_frame(spark, rows), anchor_every=20).collect()]
    want = brute.hard_negatives(whole(rows), every=20)
    assert sorted(got) == sorted(want) and len(got) > 200


def test_rows_that_take_no_part(spark):
    rows = random_rows(4, n=60)
    odd = [(200, None, [1.0] * 6), (220, 1, None), (240, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (260, 1, [float("nan")] * 6), (280, 1, [float("inf")] * 6),
           (300, 1, []), (None, 1, [1.0] * 6), (320, 1, [1e308] * 6)]
    other = [(1000 + i, i % 2, [1.0 + i / 10, 0.5]) for i in range(30)]                       # another dimension
    got = [tuple(r) for r in mine(vectors_frame(spark, [*rows, *odd, *other, *rows, *other]), anchor_every=20).collect()]      # each row twice
    assert sorted(got) == sorted(brute.hard_negatives(whole(rows), every=20) + brute.hard_negatives(whole(other), every=20))
    assert mine(vectors_frame(spark, [])).count() == 0 and mine(vectors_frame(spark, [(1, 1, [1.0])])).count() == 0
    assert mine(vectors_frame(spark, [(0, 1, [1.0])])).count() == 0


def test_scores_beyond_64_bits_are_compared_exactly(spark):
    rows = [(0, 1, [2.0**60, 1.0]), (1, 1, [2.0**60, 0.0]), (2, 1, [2.0**59, 0.0]), *[(10 + i, 2, [2.0**58, float(i)]) for i in range(20)],
            *[(40 + i, 2, [1.0, i / 256]) for i in range(5)], (50, 1, [0.25, 0.0])]
    got = [tuple(r) for r in mine(vectors_frame(spark, rows)).collect()]

    def clip(x):
        return max(-2**63, min(2**63 - 1, x))
    want = [(*r[:4], clip(r[4]), clip(r[5])) for r in brute.hard_negatives(whole(rows))]
    assert sorted(got) == sorted(want) and [r[3] for r in sorted(got) if r[1] == 2][:3] == [29, 28, 27]
