import numpy as np
import pyarrow as pa

from stridelake.llm import quality
from stridelake.llm.text_features import bucket_of, buckets_of_words, grams_of


def test_many_words_at_once_have_the_buckets_of_each():
    words = ["a", "cats", "", "Straße", "日本語テキスト", "😀x", "y" * 300, "\x00again"]
    flat, sizes = buckets_of_words(words, 2, 4, 1000)
    want = [[bucket_of(g, 1000) for g in grams_of(w, 2, 4)] for w in words]
    assert sizes.tolist() == [*map(len, want)]
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    assert all(p[0] == w[0] and sorted(p.tolist()) == sorted(w) for p, w in zip(parts, want, strict=True))


def test_features_hold_character_n_grams_of_two_to_four():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1], pa.int32()), pa.array(["cats"])], names=["doc_id", "y", "text"])
    found = next(quality._features(iter([batch])))
    grams = ["<cats>", "<c", "ca", "at", "ts", "s>", "<ca", "cat", "ats", "ts>", "<cat", "cats", "ats>"]
    assert np.frombuffer(found.column("ids")[0].as_py(), np.uint32).tolist() == sorted({bucket_of(g, quality.BUCKETS) for g in grams})


def test_the_sample_is_bounded_where_many_rows_share_an_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "train", lambda features, labels: seen.append(len(labels)))
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "b"), (None, "c")], "key long, body string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 5)], "id long, quality int")
    quality.fit(docs, labels, fit_rows=10, doc_id="key", text="body", label_id="id")
    assert seen == [10]


def test_scores_match_a_plain_version(spark):
    import functools
    import math

    texts = [("Cats  sat, cats sat.", 1), ("!! ?? !!", 2), ("", 3), (None, 4), ("a a a a a", 5), ("Cats  sat, cats sat.", 6), ("naïve Ünïcode " * 3000, 7), ("x" * 3000, 8)]
    docs = spark.createDataFrame([(k, t, 0.5) for t, k in texts] + [(None, "no id", 0.5)], "doc_id long, text string, score double")
    random = np.random.default_rng(0)
    model = quality.Model(random.normal(0, 1, (quality.BUCKETS, quality.WIDTH)).astype(np.float32), random.normal(0, 1, (quality.WIDTH, 2)), np.array([0.1, -0.2]))

    @functools.cache
    def bucket(gram):
        h = 0
        for c in gram:
            h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
        h = (h ^ (h >> 32)) * 0xC2B2AE3D27D4EB4F % 2**64
        return (h ^ (h >> 29)) % quality.BUCKETS

    def plain(text):
        import re

        words = re.findall(r"\w+|[^\w\s]+", text or "")
        words += ["\0again"] * sum(words[i] == words[i - k] for k in (1, 2) for i in range(k, len(words)))
        total = np.zeros(quality.WIDTH)
        for w in words:
            marked = f"<{w}>"
            grams = [marked] + [marked[i : i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)]
            total += sum(model.vectors[bucket(g)].astype(float) for g in grams) / len(grams)
        a, b = total / max(1, len(words)) @ model.weights + model.bias
        return 1 / (1 + math.exp(a - b))

    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    want = {k: plain(t) for t, k in texts} | {None: plain("no id")}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-4 for k in want)
    assert got[1] == got[6] and quality.score(docs.limit(0), model).count() == 0
