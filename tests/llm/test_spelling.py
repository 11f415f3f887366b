import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stridelake.llm import spelling
from stridelake.llm.acceptor import Acceptor
from stridelake.llm.common import Scratch

SCHEMA = "doc_id long, text string, word string, n int, over boolean"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, ratio=10):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus():
    random.seed(3)
    base = ["".join(random.choice("abcdé") for _ in range(random.randint(7, 9))) for _ in range(12)]
    rows = []
    for k in range(400):
        words = []
        for _ in range(random.randint(1, 30)):
            w = random.choice(base[: random.randint(1, len(base))])
            if random.random() < 0.3:
                i = random.randrange(len(w))
                w = random.choice([w[:i] + w[i + 1 :], w[:i] + random.choice("abÉZ÷") + w[i:], w[:i] + random.choice("abcx") + w[i + 1 :]])
            words.append(w if random.random() < 0.8 else w.upper())
        rows.append((k if k % 50 else None, random.choice([" ", ", ", "9"]).join(words)))
    rows += [(7, None), (8, ""), (9, "short"), (10, "z" * 40000), (11, "z" * 40000 + " " + "z" * 40001), (12, "z" * 40001), (12, "z" * 40001), (13, "ß" * 8 + " " + "ßßßßßßß ßßßßßßß")]
    return rows + rows[:20]


@pytest.mark.parametrize("cells", [1 << 20, 40])
def test_equals_brute_force_also_when_states_are_split(spark, monkeypatch, cells):
    monkeypatch.setattr(spelling, "CELLS", cells)
    rows = corpus() if cells > 1000 else [r for r in corpus() if len(r[1] or "") < 10000]
    docs = spark.createDataFrame([(*r, "x", 1, False) for r in rows], SCHEMA).repartition(3)
    got = spelling.variants(docs, Scratch(spark, "test-spelling"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_chains_end_at_the_root_and_an_empty_table_gives_no_rows(spark):
    docs = spark.createDataFrame([(None, "abcdefg " * 3 + "abcdefgh " * 40 + "abcdefghi " * 500 + "abcdefghij " * 6000, "x", 1, False)], SCHEMA)
    rows = [(None, docs.first()["text"])]
    got = sorted(map(tuple, spelling.variants(docs, Scratch(spark, "test-chain")).collect()))
    assert got == brute(rows) and any(r[1] and r[1] != r[2] for r in got)
    assert spelling.variants(docs.limit(0), Scratch(spark, "test-none")).count() == 0


def test_acceptor_is_minimal_and_numbers_words():
    words = sorted({a + b for a in ("ab", "cb", "db") for b in ("x", "xyz", "yz", "")})
    lengths = np.array([len(w) for w in words])
    letters = np.array([w.encode() for w in words], dtype="S5").view(np.uint8).reshape(len(words), -1)
    made = Acceptor(letters, lengths, np.zeros(len(words), int))
    # the start, one after a, c or d, one after their b, and x, y, z behind it
    assert len(made.final) == 6
    pairs = {(int(i), int(j)) for i, j in zip(*made.one_edit_pairs(np.array([9])), strict=True)}
    assert {frozenset(p) for p in pairs} == {frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])}
    assert len(pairs) == len({frozenset(p) for p in pairs})
