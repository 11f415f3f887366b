import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.llm import near_copies
from stridelake.llm.common import Scratch

SF = "/root/testdata/sf0.1"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return not x and not y or len(x & y) >= 0.8 * len(x | y) - 1e-9


def kept_by_brute_force(rows):
    """Rows by place: of each component of alike texts the smallest id, nulls last."""
    top = list(range(len(rows)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and alike(rows[i][1], rows[j][1]):
                top[find(i)] = find(j)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return sorted(min((rows[k][0] is None, rows[k][0] or 0) for k in g) for g in groups.values())


def edited(words, random, share):
    return [random.choice(words) if random.random() < share else w for w in words]


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(60):
        words = rng.choices(vocabulary, k=rng.choice([4, 8, 60, 200]))
        rows.append((10 * k, " ".join(words)))
        for n in range(rng.randint(0, 3)):
            rows.append((10 * k + n + 1, "  ".join(edited(words, rng, rng.choice([0.0, 0.005, 0.01, 0.2])))))
    rows += [(None, rows[0][1]), (None, "lone text without an id here"), (7000, None), (7001, ""), (7002, " \n"), (7003, "ONE word"), (7004, "one WORD"), (7004, "one WORD"), (7005, "x " * 40000)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"SMALL_BUCKET": 2}, {"LARGE_BUCKET": 3}])
def test_one_of_each_group_stays(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(near_copies, name, value)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, row int, fp string").withColumn("m", F.create_map(F.lit("a.b"), "row")).repartition(3)
    got = near_copies.near_copies(docs, Scratch(spark, "test-near"), recall=0.9999)
    assert got.dtypes == docs.dtypes
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == kept_by_brute_force(rows)
    if not settings:
        assert near_copies.near_copies(docs.limit(0), Scratch(spark, "test-none")).count() == 0


def test_chains_lose_no_pair_within_the_distance():
    rng = np.random.default_rng(3)
    most = near_copies.radius(0.8)
    differ = np.zeros((4000, 256), np.uint8)
    for k, row in enumerate(differ):
        row[rng.choice(256, k % 90, replace=False)] = 1
    words = np.packbits(differ, axis=1).view(np.uint64)
    assert sorted(near_copies.within_chains(words, most).tolist()) == [k for k in range(4000) if differ[k].sum() <= most]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")
def test_recall_against_all_pairs_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    # Copies are the exact stage's; all pairs that share a shingle are counted, which every alike pair does.
    texts = {t: i for i, t in sorted(((r["doc_id"], " ".join((r["text"] or "").lower().split())) for r in docs.collect()), reverse=True)}
    sets = {i: near_copies.shingle_set(t) for t, i in texts.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for h in s[: len(s) - int(np.ceil(0.8 * len(s))) + 1].tolist():  # alike sets share one of their smallest
            holders[h].append(i)
    pairs = set()
    for own in holders.values():
        pairs.update((a, b) for n, a in enumerate(own) for b in own[:n] if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])))
    true = [(a, b) for a, b in pairs if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b])) - 1e-9]
    assert len(true) > 30
    kept = {r["doc_id"] for r in near_copies.near_copies(docs.filter(F.col("doc_id").isin(list(sets))), Scratch(spark, "test-recall")).select("doc_id").collect()}
    involved = {x for p in true for x in p}
    clean = set(sets) - involved - {i for i, s in sets.items() if not len(s)}
    assert clean <= kept
    # Of a pair at most one stays.
    found = sum(not (a in kept and b in kept) for a, b in true)
    assert found >= 0.95 * len(true), (found, len(true))


def test_no_link_is_left_out_whatever_the_fingerprints_miss(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SAMPLED", 1)
    rows = corpus()
    rng = random.Random(8)
    # Texts that share most of their words, many of them at the border of the similarity.
    base = rng.choices([f"v{k}" for k in range(400)], k=120)
    rows += [(20_000 + k, " ".join(base[:cut] + [f"u{k}_{j}" for j in range(120 - cut)])) for k, cut in enumerate([120, 110, 109, 108, 107, 106, 105, 100, 60])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_copies.near_copies(docs, Scratch(spark, "test-whole"), recall=0.01)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == kept_by_brute_force(rows)


def test_long_texts_of_one_common_passage_do_not_reach_the_exact_check(spark):
    rng = random.Random(9)
    long = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, own = long(300), long(4200)
    # The last two are alike, on both sides of a power of two, so one sketch is folded.
    words = [*(passage + long(2700) for _ in range(4)), own, own[:4000]]
    texts = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(words)], "node long, text string")
    placed = texts.select("node", F.col("node").alias("component"))
    got = near_copies.left_out(texts, placed, Scratch(spark, "test-long"))
    assert [tuple(r) for r in got.collect()] == [(4, 5)]


def test_sketches_differ_in_no_more_bits_than_their_sets(spark):
    rng = np.random.default_rng(5)
    rows = []
    for n in (1, 60, 511, 513, 1024, 1025, 3000):
        own = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for other in (own, own[: max(1, n * 4 // 5)], rng.integers(0, 1 << 63, n, dtype=np.uint64)):
            rows.append((near_copies.parities(own).tolist(), near_copies.parities(other).tolist(), len(np.setxor1d(own, other))))
    frame = spark.createDataFrame(rows, "a array<long>, b array<long>, differ int")
    got = frame.select("differ", near_copies.apart_at_least("a", "b").alias("bits")).collect()
    assert len(got) == 21 and all(r["bits"] <= r["differ"] for r in got)
    assert all(r["bits"] == 0 for r in got if not r["differ"])
