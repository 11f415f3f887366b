import math
import random

import pytest
from pyspark.sql import functions as F

from stridelake.llm import topk_search
from stridelake.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, no string, w long, score int"


def brute(rows, k, every=2):
    ints = [(i, v, [math.floor(64 * float(x)) for x in v]) for i, v, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, _, a) in enumerate(ints):
        if i is None or i % every:
            continue
        found = [(-sum(x * y for x, y in zip(a, b)), j is None, j or 0, m, j) for m, (j, _, b) in enumerate(ints) if m != n]
        out += [(i, r + 1, f[4], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def answers(spark, rows, k, every=2, parts=3):
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = topk_search.top_k(vectors, F.col("vec_id") % every == 0, Scratch(spark, "test-topk"), k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(("block", "stripe"), [(8192, 2048), (7, 3)])
def test_equals_brute_force_with_ties_nulls_and_odd_vectors(spark, monkeypatch, block, stripe):
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk_search, "STRIPE_ROWS", stripe)
    random.seed(5)
    rows = [(i, [random.choice([0.0, -0.01, 0.25, random.uniform(-1, 1)]) for _ in range(6)], "x", 1, 2) for i in range(60)]
    rows += [(60 + i, [0.5] * 6, "x", 1, 2) for i in range(20)]
    rows += [(80, None, "x", 1, 2), (82, [0.1, None, 0.2], "x", 1, 2), (84, [float("nan")], "x", 1, 2), (86, [float("inf")], "x", 1, 2), (88, [], "x", 1, 2), (90, [1.0], "x", 1, 2), (92, [0.3] * 9, "x", 1, 2), (None, [0.4] * 6, "x", 1, 2)]
    assert answers(spark, rows, 5) == brute(rows, 5)


def test_fewer_rows_than_k_repeated_ids_and_empty_table(spark):
    rows = [(2, [1.0, 0.0], "x", 1, 2), (2, [1.0, 0.0], "x", 1, 2), (3, [0.0, 1.0], "x", 1, 2)]
    assert answers(spark, rows, 20) == [(2, 1, 2, 4096), (2, 1, 2, 4096), (2, 2, 3, 0), (2, 2, 3, 0)]
    assert answers(spark, [], 20) == []


def test_scores_past_64_bits_stand_at_the_ends(spark):
    big = 1e9
    rows = [(0, [big, big], "x", 1, 2), (1, [big, -big], "x", 1, 2), (3, [big, big], "x", 1, 2), (5, [-big, -big], "x", 1, 2), (7, [3.0e38], "x", 1, 2)]
    got = answers(spark, rows, 4, 10)
    assert [(r[2], r[3]) for r in sorted(got, key=lambda r: r[1])] == [(3, 2**63 - 1), (7, 2**63 - 1), (1, 0), (5, -(2**63))]
