import hashlib
import random
import time
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stridelake.llm import decontaminate, fm_index, language, pfor, piece_bpe, quality, token_files, warc
from stridelake.llm.common import Scratch, arrow_uri

ODD = [
    "", " ", "   ", "a  b", " a", "a ", "\n\n x", "x\t y", "日本語 テスト", "é ñ", "▁▁a ▁", "<s> </s> <unk> <0x41>", "don't we'll  'tis", "a" * 3000, " " * 40,
    "ab" * 300, "\x00 \x01", "\u00a0x", "x\x1c y", "😀 😀😀", "foo\n bar", "foo \n bar", "12 3456 7,8.9", "<|endoftext|> x", "a\u0301 b\u0301",
]


def random_texts(n, seed=3):
    random.seed(seed)
    return ["".join(random.choice(" ab\n▁é.,'1\t日thei") for _ in range(random.randint(1, 60))) for _ in range(n)]


@pytest.fixture
def scratch(spark):
    return Scratch(spark, f"test-{uuid.uuid4().hex}")


def test_piece_encoder_equals_the_library():
    encoder = piece_bpe.encoder_of("piece_bpe_32k.model")
    for text in ODD + random_texts(1500):
        assert encoder.encode(text) == encoder.library.encode(text), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_piece_encoder_equals_the_library_on_any_text(text):
    encoder = piece_bpe.encoder_of("piece_bpe_32k.model")
    assert encoder.encode(text) == encoder.library.encode(text)


def test_byte_encoder_equals_the_library():
    pieces = token_files.pieces_of("byte_bpe_50k.json")
    for text in ODD + random_texts(1500, 4):
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == pieces.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_byte_encoder_equals_the_library_on_any_text(text):
    pieces = token_files.pieces_of("byte_bpe_50k.json")
    assert np.frombuffer(pieces.encode(text), "<u4").tolist() == pieces.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("remembered", [3, 300_000])
def test_many_texts_at_once_equal_the_library(remembered):
    pieces = token_files.Pieces(token_files.pieces_of("byte_bpe_50k.json").tokenizer, remembered)
    texts = [*ODD, None, *random_texts(800, 9), "the cat, the cat. the", "x" * 200 + " " + "y" * 200]
    for some in (texts, texts[::-1], [], [None, ""]):
        ids, counts = pieces.encode_all(pa.array(some, pa.string()))
        want = [pieces.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (4, 6, 1, 30, 0, 9, 2)]), pa.array(range(7))], names=["text", "doc_id"])
    assert [s.column("doc_id").to_pylist() for s in token_files._slices(batch)] == [[0, 1], [2], [3], [4, 5], [6]]


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 1000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 2**32])
def test_pfor_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    if n > 5:
        ids[3] = 2**32 - 1
    content = pfor.write_file([None, 5], np.array([0, n]), ids)
    docs, counts, back = pfor.read_file(content)
    assert docs == [None, 5] and counts.tolist() == [0, n] and (back == ids).all()
    assert (pfor.read_document(content, 1) == ids).all() and len(pfor.read_document(content, 0)) == 0


def test_token_files_match_brute_force(spark, scratch):
    texts = [(i * 3 % 41, t) for i, t in enumerate(ODD + random_texts(15))] + [(100, None), (None, "null id")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, path string")
    folder = scratch.path("tokens")
    got = token_files.read_tokens(spark, folder, token_files.write_tokens(docs, scratch, folder, file_ids=500)).collect()
    tokenizer = token_files.pieces_of("byte_bpe_50k.json").tokenizer
    start, want = 0, []
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=key) == want


def test_token_files_of_an_empty_table(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = scratch.path("tokens")
    files = token_files.write_tokens(docs, scratch, folder)
    assert files.count() == 0 and token_files.read_tokens(spark, folder, files).count() == 0


def test_round_trip_digests(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "doc_id long, text string")
    library = piece_bpe.encoder_of("piece_bpe_32k.model").library
    for r in piece_bpe.round_trip(docs).collect():
        text = [*ODD, None][r["doc_id"]] or ""
        ids = library.encode(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded"] == library.decode(ids) and r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


@pytest.mark.parametrize("tail", ["", "a", "the", "\n", " x", "日", "1"])
def test_runs_of_spaces_of_any_length_are_encoded_as_by_the_library(tail):
    encoder = piece_bpe.encoder_of("piece_bpe_32k.model")
    assert encoder.blanks
    for n in (*range(0, 200, 3), 96, 97, 111, 112, 113, 1000, 4097):
        for head in ("", "b ", "word"):
            text = head + " " * n + tail
            assert encoder.encode(text) == encoder.library.encode(text), (n, head, tail)


@pytest.mark.parametrize("unit", ["1;", "日本語の文章は長い", "ab", "a", " ", "\n", "\x00"])
def test_a_million_characters_without_blanks_take_linear_time(unit):
    encoder = piece_bpe.encoder_of("piece_bpe_32k.model")
    text = unit * (1_000_000 // len(unit))
    began = time.process_time()
    ids = encoder.encode(text)
    assert time.process_time() - began < 5 and ids
    short = text[:5_000]
    assert encoder.encode(short) == encoder.library.encode(short)
    assert sum(len(m) for m in (encoder.chunk_ids, encoder.part_ids, encoder.after_space)) < 1_000_000
    assert all(len(k) <= 48 for m in (encoder.chunk_ids, encoder.part_ids, encoder.after_space) for k in m)


def test_round_trip_of_repeated_rows_and_of_none(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "a b", "x"), (2, "x" * 100_000, "x")], "doc_id long, text string, ids string")
    got = piece_bpe.round_trip(docs, keep_text=False).collect()
    assert len(got) == 4 and len({r["ids_sha256"] for r in got}) == 2
    assert piece_bpe.round_trip(docs.limit(0)).count() == 0


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(0)
    text = rng.integers(1, 5, 400)
    index = fm_index.FMIndex(text)
    patterns = np.array([rng.integers(1, 6, 4) for _ in range(60)])
    lengths = rng.integers(1, 5, 60)
    owner, at = index.locate(*index.search(patterns, lengths))
    want = sorted((k, i) for k, p in enumerate(patterns) for i in range(len(text) - lengths[k] + 1) if (text[i : i + lengths[k]] == p[: lengths[k]]).all())
    assert sorted(zip(owner.tolist(), at.tolist(), strict=True)) == want


def brute_hits(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = decontaminate.words_of(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, own = decontaminate.words_of(text), set(), set()
        for win, names in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    own |= names
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(own), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination_matches_brute_force(spark, scratch, block_bytes):
    long = " ".join(f"word{i}" for i in range(40))
    items = [(1, long), (2, "Short item here"), (10, long.upper() + " more"), (3, None), (4, "..."), (5, "a a a a a a a a a a a a a a")]
    docs = [(1, f"x {long} y"), (2, "a SHORT item, here!" + " pad" * 100), (3, None), (4, ""), (5, "nothing of it"), (6, "b " + "a " * 30), (7, " ".join(long.split()[:12])), (8, " ".join(long.split()[5:18]) + " z" * 300), (9, "é short item here")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judged(decontaminate.find_spans(frame, bench, scratch, block_bytes=block_bytes)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got} == brute_hits(docs, items)
    kept = decontaminate.drop_contaminated(frame, bench, Scratch(spark, "kept"))
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, v in brute_hits(docs, items).items() if not v[4]}


@pytest.mark.parametrize("symbols", [1, 40, 1 << 18])
def test_decontamination_by_small_shards_and_many_blocks(spark, scratch, monkeypatch, symbols):
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", symbols)
    random.seed(symbols)
    word = lambda: f"w{random.randint(0, 60)}"
    items = [(i, " ".join(word() for _ in range(random.randint(1, 40)))) for i in range(30)]
    docs = [(i, " ".join([*(word() for _ in range(9)), *items[i % 30][1].split()[i % 5 :], "other", *(word() for _ in range(9))])) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = decontaminate.find_spans(frame, spark.createDataFrame(items, "item_id long, text string"), scratch, block_bytes=300)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontaminate.judged(found).collect()}
    assert got == brute_hits(docs, items)


def test_rows_with_null_and_shared_ids_are_judged_by_their_own_text(spark, scratch):
    passage = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(None, passage, "a"), (None, "clean one", "b"), (7, passage, "c"), (7, "clean two", "d")], "doc_id long, text string, spans string").withColumn("a.b", F.lit(1))
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"), scratch)
    assert kept.columns == docs.columns and sorted(r["spans"] for r in kept.collect()) == ["b", "d"]
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(60)], "doc_id long, quality int")
    taught = spark.createDataFrame([(i, "good words here" if i % 2 else "%% bad !!") for i in range(60)], "doc_id long, text string")
    model_rows = taught.unionByName(spark.createDataFrame([(None, "%% bad !!"), (None, "good words here"), (1, "%% bad !!")], "doc_id long, text string"))
    good = quality.keep_good(model_rows, labels)
    assert {r["text"] for r in good.collect()} == {"good words here"} and good.filter("doc_id is null").count() == 1


def test_decontamination_without_items_or_documents(spark, scratch):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(None, "a b"), (1, "c")], "doc_id long, text string")
    assert [r["n_hit"] for r in decontaminate.judged(decontaminate.find_spans(docs, none, scratch)).collect()] == [0, 0]
    assert decontaminate.find_spans(docs.limit(0), none, scratch).count() == 0


@pytest.mark.parametrize(("spark_uri", "arrow"), [("s3a://b/x", "s3://b/x"), ("s3n://b/x", "s3://b/x"), ("dbfs:/x/y", "file:///dbfs/x/y"), ("dbfs:///x", "file:///dbfs/x"), ("hdfs://n:1/x", "hdfs://n:1/x"), ("file:/tmp/x", "file:/tmp/x"), ("gs://b/x", "gs://b/x")])
def test_folders_of_spark_are_found_by_arrow(spark_uri, arrow):
    assert arrow_uri(spark_uri) == arrow


def test_warc_derivatives_link_back(spark, scratch):
    html = "<html><head><title>T &amp; u</title><style>x</style></head><body><p>One&nbsp;two</p><script>no</script><!-- c --><p>Three<br>four</body></html>"
    pages = spark.createDataFrame([(1, "http://a.test/1", html), (2, None, None), (3, "u", ""), (None, "x\ny", "<p>" + "w " * 50000), (1, "http://a.test/1", html)], "page_id long, url string, html string")
    folder = scratch.path("warc")
    index = scratch.save(warc.write_derivatives(warc.responses(pages), folder, file_records=2), "index")
    back = warc.read_derivatives(folder, index).collect()
    assert index.count() == 5 and all(r["linked"] for r in back)
    # Rows that repeat have records, and ids, of their own.
    assert sorted(r["key"] or "" for r in back) == ["", "1", "1", "2", "3"]
    assert len({r[c] for r in back for c in ("refers_to", "metadata_id", "conversion_id")}) == 15
    record = warc.response("1", "http://a.test/1", html)
    headers, block = warc.parse(record)
    got = next(r for r in back if r["key"] == "1")
    assert warc.parse(warc.response("1", "http://a.test/1", html, "2024-01-02T00:00:00Z"))[0]["warc-record-id"] != headers["warc-record-id"]
    assert got["text"] == "T & u\nOne\u00a0two\nThree\nfour".replace("\u00a0", " ") and got["source_payload_digest"] == headers["warc-payload-digest"] == warc.digest(html.encode())
    meta, conv = warc.derive(record)
    assert warc.parse(meta)[0]["warc-refers-to"] == headers["warc-record-id"] == warc.parse(conv)[0]["warc-refers-to"]
    assert "source-header-content-type: text/html; charset=utf-8" in warc.parse(meta)[1].decode()
    assert warc.derive(warc.build("request", [("WARC-Record-ID", "<urn:uuid:x>")], b"")) is None


def test_quality_learns_and_scores_every_row(spark):
    random.seed(1)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    rows, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        rows.append((i, " ".join(random.choice(words) + ("" if good else "%%%") for _ in range(20)), "x"))
        labels.append((i, int(good), 0))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "alpha beta", "x"), (1002, "alpha " * 50000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, marks)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.7) == (i % 3 > 0) for i in held) / len(held) > 0.95
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 1
    untaught = quality.fit(docs, marks.limit(0))
    assert quality.score(docs, untaught).count() == len(rows)


def test_language_backs_off_and_covers_odd_rows(spark):
    random.seed(2)
    en, de = ["the", "thing", "whether", "rather"], ["der", "schrank", "zwischen", "schluss"]
    rows = [(i, " ".join(random.choice(en if i % 2 else de) for _ in range(15)), "en" if i % 2 else "de") for i in range(120)]
    rows += [(500, "schlussschrank zwischenschluss", None), (501, "weathering", None), (502, None, "en"), (503, "123 ... ½", "de"), (None, "the thing", None), (504, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, language.fit(docs)).collect()}
    assert all(got[i][0] == ("en" if i % 2 else "de") for i in range(120))
    assert (got[500][0], got[501][0], got[None][0]) == ("de", "en", "en")
    assert got[502] == got[503] == got[504] == ("und", 0.0)
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs.limit(0))).collect()} == {"und"}


def plain_language(docs, text, lang):
    """The votes on one text by counts in plain Python."""
    import math
    import re
    from collections import Counter

    words_of = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    grams = lambda w, n: [f"<{w}>"[i : i + n] for i in range(len(w) + 3 - n)] if n > 1 else list(w)
    counts = {la: [Counter() for _ in range(6)] for la in sorted({la for _, _, la in docs if la})}
    for i, t, la in docs:
        if la and zlib.crc32(("" if i is None else str(i)).encode()) % 5:
            for w in words_of(t):
                counts[la][0][w] += 1
                for n in range(1, 6):
                    counts[la][n].update(grams(w, n))
    kinds = [set().union(*(c[n] for c in counts.values())) for n in range(6)]
    log = lambda la, n, x: math.log((counts[la][n][x] + 0.5) / (sum(counts[la][n].values()) + 0.5 * len(kinds[n])))
    votes = dict.fromkeys(counts, 0.0)
    for w in words_of(text):
        if w in kinds[0]:
            for la in counts:
                votes[la] += log(la, 0, w)
            continue
        for n in range(5, 0, -1):
            known = [g for g in grams(w, n) if g in kinds[n]]
            if known:
                for la in counts:
                    votes[la] += sum(log(la, n, g) for g in known) / len(known)
                break
    best = max(votes, key=lambda la: (votes[la], [-ord(c) for c in la]))
    return best, 1 / sum(math.exp(v - votes[best]) for v in votes.values())


@pytest.mark.parametrize("memory", [5, 150_000])
def test_language_matches_a_plain_version(spark, monkeypatch, memory):
    monkeypatch.setattr(language, "WORDS", memory)
    monkeypatch.setattr(language.Model.voter, "__defaults__", (memory,))
    random.seed(5)
    parts = {"en": ["th", "ing", "wh", "er"], "de": ["sch", "ung", "ei", "er"], "fr": ["eau", "ment", "é", "er"]}
    made = lambda la: " ".join("".join(random.choice(parts[la]) for _ in range(random.randint(1, 3))) for _ in range(12))
    docs = [(i, made(la), la) for i in range(60) for la in [random.choice([*parts])]]
    asked = docs + [(100, "er", None), (101, "zzz qqq", None), (102, "whsch eauung", None), (103, "Thing! thing? 12 thing_er", None), (103, "Thing! thing? 12 thing_er", None), (None, "xx " * 40_000 + "eau", None), (104, "é" * 200_000, "fr")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    odd = spark.createDataFrame([(*r, 1.0, "x") for r in asked], "doc_id long, text string, lang string, score double, lang_pred string")
    model = language.fit(frame)
    got = language.predict(odd, model).collect()
    assert len(got) == len(asked)
    texts = {i: t for i, t, _ in asked}
    for r in got:
        best, score = plain_language(docs, texts[r["doc_id"]], None)
        assert r["lang_pred"] == best and abs(r["score"] - score) < 1e-3, r
    assert language.predict(odd.limit(0), model).count() == 0


def test_a_tie_goes_to_the_language_first_by_name_and_rare_languages_are_learnt(spark):
    docs = [(i, "same words", la) for i, la in enumerate(["b", "a"] * 20)] + [(1001, "selten", "rare"), (1002, "selten", "rare"), (1003, "selten", "rare")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.Model(["a", "b"], ["same"], [], np.zeros((1, 2), np.float32))
    assert {(r["lang_pred"], r["score"]) for r in language.predict(frame.filter("lang <> 'rare'"), model).collect()} == {("a", 0.5)}
    many = frame.unionByName(spark.range(2000, 4000).select(F.col("id").alias("doc_id"), F.lit("other text").alias("text"), F.lit("a").alias("lang")))
    sample = language.fit_sample(many, Scratch(spark, "sample"), fit_rows=40).collect()
    assert len(sample) <= 40 and {r["lang"] for r in sample} == {"a", "b", "rare"}


def test_blocks_of_every_width_are_read_back():
    rng = np.random.default_rng(3)
    for width in range(33):
        for n in (1, 127, 128, 300):
            ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype(np.uint32)
            ids[-1] = (1 << width) - 1
            payload, starts = pfor.encode_blocks(ids)
            got = pfor.decode_blocks(np.frombuffer(payload, np.uint8), starts, n)
            assert got.tolist() == ids.tolist(), (width, n)


def test_words_with_a_mark_are_encoded_as_the_library_does():
    pieces = token_files.pieces_of("byte_bpe_50k.json")
    for text in ("a cat. sat, on; it: so! why? 5% a# b$ c& d* e- f' g. h.. .i .", "cat. cat. Äpfel, é. x1. ab, \n c, d.", ", a", "word."):
        want = pieces.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == want, text
