"""Vector codes against plain loops over integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import clash
from tidewater.llm import vector_codes

ROWS = "vec_id bigint, embedding array<float>, label int"


def floats(x):
    return [float(np.float32(v)) for v in x]


def plain(rows):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    p = len(kept[0][1]) // 16
    part = lambda v, k: v[k * p:(k + 1) * p]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    books = [[part(v, k) for _, v, _ in kept[:64]] for k in range(16)]
    near = lambda v, k: min(range(len(books[k])), key=lambda e: (far(part(v, k), books[k][e]), e))
    for _ in range(2):
        members = [[[] for _ in book] for book in books]
        for _, v, _ in kept:
            for k in range(16):
                members[k][near(v, k)].append(part(v, k))
        books = [[[sum(c) // len(group) for c in zip(*group)] if group else entry for entry, group in zip(book, groups)] for book, groups in zip(books, members)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    coded = []
    for i, v, label in kept:
        best = [near(v, k) for k in range(16)]
        coded.append((i, "".join(f"{e:02x}" for e in best), sum(far(part(v, k), books[k][e]) for k, e in enumerate(best)), label))
    return [(i, code, error, sum(e for _, _, e, other in coded if other == label), digest) for i, code, error, label in coded]


def result(df):
    return sorted(map(tuple, df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_nearest_matches_plain_distances():
    rng = np.random.default_rng(1)
    for spread in (3, 300, 10 ** 7):
        rows, book = rng.integers(-spread, spread, (200, 5)), rng.integers(-spread, spread, (64, 5))
        book[9] = book[3]
        want = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
        best, far = vector_codes.nearest(rows, book)
        assert (best == want.argmin(axis=1)).all() and (far == want.min(axis=1)).all()


@pytest.mark.parametrize("n, width, spread", [(300, 32, 1.0), (40, 16, 0.02), (150, 64, 5000.0)])
def test_codes_match_plain_loops(spark, n, width, spread):
    rnd = random.Random(n)
    rows = [(i, floats(rnd.uniform(-spread, spread) for _ in range(width)), rnd.choice([0, 1, 2, None])) for i in rnd.sample(range(10 * n), n)]
    rows += [(i, v, 1) for i, v, _ in rows[:7]] + [(None, rows[0][1], None)]
    assert result(vector_codes.compressed(spark.createDataFrame(rows, ROWS).repartition(3))) == sorted(plain(rows), key=repr)


def test_bad_vectors_go_and_odd_ones_have_no_code(spark):
    rows = [(i, floats([i / 7 % 1] * 16), 0) for i in range(20)]
    bad = [(100, None, 0), (101, [None] * 16, 0), (102, [float("nan")] * 16, 0), (103, [1.0] * 15 + [float("inf")], 0)]
    odd = [(-5, [1.0] * 3, 0), (-6, [], None)]
    df = clash(spark.createDataFrame(rows + bad + odd, ROWS), "code", "error", "vector", "label_error", "k", "hot", "n")
    got = {r.vec_id: r for r in vector_codes.compressed(df).collect()}
    assert set(got) == set(range(20)) | {-5, -6}
    assert got[-5].code is None and got[-5].error is None and got[-6].label_error is None
    assert {i: (r.code, r.error) for i, r in got.items() if i >= 0} == {i: (c, e) for i, c, e, *_ in plain(rows)}


def test_hot_and_rare_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HOT_SHARE", 3)
    rnd = random.Random(2)
    rows = [(i, floats(rnd.uniform(-1, 1) for _ in range(16)), None if i < 70 else i % 9) for i in range(130)]
    assert result(vector_codes.compressed(spark.createDataFrame(rows, ROWS))) == sorted(plain(rows), key=repr)


def test_huge_components_are_bounded(spark):
    rows = [(i, floats([s * 1e38] * 16), 0) for i, s in enumerate((1, -1, 0))]
    assert [r.error for r in vector_codes.compressed(spark.createDataFrame(rows, ROWS)).collect()] == [0, 0, 0]
    top = vector_codes.bound(16)
    assert 16 * (2 * top) ** 2 < 2 ** 63


def test_empty_tables_and_input_order(spark):
    assert vector_codes.compressed(spark.createDataFrame([], ROWS)).count() == 0
    assert vector_codes.compressed(spark.createDataFrame([(1, None, 2)], ROWS)).count() == 0
    rnd = random.Random(4)
    df = spark.createDataFrame([(i % 50, floats(rnd.uniform(-1, 1) for _ in range(16)), 1) for i in range(120)], ROWS)
    assert result(vector_codes.compressed(df)) == result(vector_codes.compressed(df.orderBy(F.rand(1)).repartition(4)))
