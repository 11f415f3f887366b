"""The whole pipeline on a small folder against a brute-force version of its stages."""

import hashlib
import random
import re

import numpy as np

import corpus_pipeline
from stridelake.llm import piece_bpe, quality
from stridelake.llm.remembered import Remembered
from stridelake.llm.text_features import bucket_of, grams_of
from test_near_copies import kept_by_brute_force
from test_tokens_and_models import brute_hits


def small_corpus():
    random.seed(11)
    words = [f"{a}{b}" for a in "bdfgklmn" for b in ("an", "eth", "iol", "ust")]
    docs = []
    for i in range(150):
        body = " ".join(random.choice(words) for _ in range(random.randint(30, 80)))
        docs.append(body if i % 4 else " ".join(w + "%%%" for w in body.split()))
    item = " ".join(random.choice(words) for _ in range(30))
    docs += [docs[1], "  ".join(docs[2].split()), docs[3] + " tail", f"intro {item} outro", docs[5] + " " + item, None, "", docs[6].upper()]
    docs.append(" ".join(["other", *docs[7].split()[1:]]))  # a near copy
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(docs)]
    # Without an id, one of them a near copy; and a row that repeats.
    rows += [(None, "no id here", None, None, None), (None, docs[9] + " more", None, None, None), rows[10], rows[10]]
    labels = [(i, int(i % 4 > 0), 0) for i in range(120)]
    return rows, labels, [(1, item), (2, None)]


def test_stages_keep_their_contract_and_match_brute_force(spark, tmp_path):
    rows, labels, items = small_corpus()
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    kept = [(r[0], r[1]) for r in rows]
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    of_word = Remembered(lambda w: np.array([bucket_of(g, quality.BUCKETS) for g in grams_of(w, quality.LEAST, quality.MOST)]), 1000)

    def score(text):
        ids, amounts = quality.document_features(text, of_word)
        return model.scores((amounts @ model.vectors[ids] if len(ids) else np.zeros(quality.WIDTH))[None])[0]

    # Rows are judged by their own text, with an id or without.
    kept = [(i, t) for i, t in kept if score(t) >= 0.7]
    assert all(i is None or i >= 120 or i % 4 for i, _ in kept)
    first: dict = {}
    for i, t in sorted(kept, key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    kept = list(first.values())
    stay = kept_by_brute_force(kept)
    assert len(stay) < len(kept)
    texts = dict(kept)
    kept = [(None if none else i, texts[None if none else i]) for none, i in stay]
    assert not any((t or "").endswith(" more") for _, t in kept)
    hits = brute_hits([(-1 if i is None else i, t) for i, t in kept], items)
    kept = [(i, t) for i, t in kept if not hits[-1 if i is None else i][4]]
    library = piece_bpe.encoder_of("piece_bpe_32k.model").library
    want = []
    for i, t in kept:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))

    got = corpus_pipeline.run(spark, folder)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, docs.limit(0), folder).count() == 0
