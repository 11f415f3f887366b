import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from stridelake.llm import collocations
from stridelake.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, n long, words string, k int"


def brute(rows, least=10, longest=3, top=2000, inside=50):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, *words[i : i + m]] += 1
    out = {}
    frequent = [p for p, a in f.items() if len(p) > 2 and a >= least]
    covered = {}
    for p in frequent:
        for s in range(2, len(p) - 1):
            for i in range(1, len(p) - s + 1):
                key = (p[0], *p[i : i + s])
                covered[key] = max(covered.get(key, 0), f[p])
    for p in frequent:
        a = f[p]
        if p in covered and 100 * covered[p] >= inside * a:
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            left, right = f[p[: k + 1]], f[(p[0], *p[k + 1 :])]
            cuts.append((int(Fraction(1000000 * a * a, left * right)), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return sorted((lang, r + 1, x[2].decode(), -x[1], x[3], x[4], total[lang], -x[0]) for lang, xs in out.items() for r, x in enumerate(sorted(xs)[:top]))


def corpus():
    random.seed(11)
    vocabulary = ["the", "Of", "and", "naïve", "x-1", "日本", "a", "b"]
    rows = []
    for k in range(300):
        words = random.choices(vocabulary, [9, 7, 5, 3, 2, 2, 1, 1], k=random.randint(0, 40))
        text = "".join(w + random.choice([" ", " ", " ", "  \t", ". ", "\n", ",", "\x0c"]) for w in words)
        rows.append((text, random.choice(["en", "en", "en", "de", None, "und"])))
    rows += [("hot pair " * 3000, "en"), ("hot pair w%d. " * 30 % tuple(range(30)), "en"), (None, "en"), ("", None), ("...", "fr"), ("lone", "fr"), (" \t ", "fr")]
    return rows + rows[:30]


def result(spark, rows, **kinds):
    docs = spark.createDataFrame([(i, t, lang, 1, "w", 2) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    return collocations.collocations(docs, Scratch(spark, "test-collocations"), **kinds)


@pytest.mark.parametrize("settings", [{}, {"SLICE_BYTES": 300, "ROUTE_SUFFIXES": 200}, {"SLICE_BYTES": 300, "ROUTE_SUFFIXES": 50, "HOT_SHARE": 10**6}])
def test_equals_brute_force_by_any_routing(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(collocations, name, value)
    got = result(spark, corpus())
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(corpus())
    assert sorted(map(tuple, got.collect())) == want and want


def test_longer_phrases_few_rows_and_an_empty_table(spark):
    rows = corpus()[:120]
    got = result(spark, rows, least=4, longest=4, top=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 4, 7)
    assert result(spark, []).count() == 0


def test_products_past_64_bits_are_exact(spark, monkeypatch):
    large = 3_000_000_007
    counts = spark.createDataFrame([("en", ["a", "b"], large), ("en", ["a"], large + 1), ("en", ["b"], large + 2)], "lang string, words array<string>, n long")
    totals = spark.createDataFrame([("en", 5 * large)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: (counts, totals))
    got = result(spark, []).first()
    assert got["score"] == 1000000 * large**2 // ((large + 1) * (large + 2)) and got["n"] == 5 * large


def test_quicksort_counts_every_heavy_prefix_once():
    rng = np.random.default_rng(2)
    columns = rng.integers(-1, 6, (3, 4000))
    columns[0] = np.abs(columns[0])
    columns[2][columns[1] < 0] = -1
    weights = rng.integers(1, 4, 4000)
    want = Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist(), strict=True):
        for depth in (1, 2, 3):
            if min(row[:depth]) >= 0:
                want[tuple(row[:depth])] += w
    got = [(tuple(columns[:depth, r].tolist()), n) for depth, rows, sizes in collocations.multikey_quicksort(columns, weights, 50) for r, n in zip(rows.tolist(), sizes.tolist(), strict=True)]
    assert len(got) == len(dict(got)) and dict(got) == {p: n for p, n in want.items() if n >= 50}
