import hashlib
import re
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stridelake.llm import exact_dedup, sentence_spans, simhash, url_filter
from stridelake.llm.common import Scratch, connected_components

DOCS = "doc_id long, text string, slot long, __other string"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, f"test-{uuid.uuid4().hex}")


def rows_of(texts):
    return [(i, t, 7, "x") for i, t in texts]


TEXTS = [
    (5, "a  b\nc"), (3, "a b c"), (9, "a b c "), (None, "a b c"), (1, None), (2, ""), (2, ""), (4, " "), (8, "lone"),
    (10, "word " * 30000), (11, "word " * 30000), (12, "A b c"),
]


def test_exact_decisions_match_brute_force(spark, scratch):
    got = exact_dedup.decisions(spark.createDataFrame(rows_of(TEXTS), DOCS), scratch).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[norm(t)].append(i)
    assert len(got) == len(TEXTS)
    assert sum(r["kept"] for r in got) == len(groups)
    for r in got:
        own = next(g for t, g in groups.items() if __import__("hashlib").sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(own)
        known = [x for x in own if x is not None]
        assert r["keep_id"] == (min(known) if known else None)


@pytest.mark.parametrize("settings", [{"HOT_SHARE": 1}, {"HOT_SHARE": 4}, {"BROADCAST_BLOCKS": 2, "SLOTS_PER_ROW": 2000}, {"SLOTS_PER_ROW": 30000}])
def test_exact_decisions_are_the_same_by_every_way(spark, scratch, monkeypatch, settings):
    docs = spark.createDataFrame([(i, f"t {i % 7 if i % 3 else i}") for i in range(90)] + [(None, "t  1")], "doc_id long, text string").repartition(3)
    want = sorted(map(str, exact_dedup.decisions(docs, scratch).collect()))
    for setting, value in settings.items():
        monkeypatch.setattr(exact_dedup, setting, value)
    assert sorted(map(str, exact_dedup.decisions(docs, Scratch(spark, "way")).collect())) == want


@pytest.mark.parametrize("at_once", [1, 2, 1000])
def test_the_filter_deals_out_no_row_at_any_size(spark, scratch, monkeypatch, at_once):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BLOCKS", at_once)
    rows = spark.range(900).select(F.concat(F.lit("t"), F.least("id", F.lit(800)).cast("string")).alias("row"), F.xxhash64(F.least("id", F.lit(800))).alias("h"), F.lit("c").alias("block"))
    rows = scratch.save(rows, "rows")
    bits = scratch.save(exact_dedup.repeated_slots(rows, F.col("h"), 5), "bits")
    flagged = exact_dedup.flag_possible(rows, "h", bits, 5)
    assert "Exchange hashpartitioning" not in flagged._jdf.queryExecution().executedPlan().toString()
    got = flagged.collect()
    assert len(got) == 900 and flagged.columns == ["row", "h", "block", "possible"]
    assert sum(r["possible"] for r in got if r["row"] == "t800") == 100
    assert sum(r["possible"] for r in got if r["row"] != "t800") < 40


def test_exact_dedup_keeps_whole_rows_and_clashing_columns(spark, scratch):
    docs = spark.createDataFrame(rows_of(TEXTS), DOCS).withColumns({"a.b": F.lit(1), "row": F.lit("r"), "h": F.lit(2), "sha": F.lit(3), "__sl_h": F.lit(4), "m": F.create_map(F.lit("k"), F.lit(1)), "possible": F.lit(False)})
    got = exact_dedup.exact_dedup(docs, scratch)
    assert got.dtypes == docs.dtypes
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 3, 4, 8, 9, 10, 12]
    assert all((r["a.b"], r["row"], r["h"], r["sha"], r["__sl_h"], r["m"], r["possible"]) == (1, "r", 2, 3, 4, {"k": 1}, False) for r in rows)
    assert exact_dedup.exact_dedup(docs.limit(0), Scratch(spark, "none")).count() == 0


def test_exact_dedup_passes_clear_rows_without_shuffling_them(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id long, text string")
    hashed = docs.select(F.xxhash64(F.sha2(exact_dedup.normalised(F.col("text")), 256)).alias("h"))
    n = exact_dedup.filter_blocks(500)
    flagged = exact_dedup.flag_possible(hashed, "h", exact_dedup.repeated_slots(hashed, F.col("h"), n), n)
    assert flagged.filter("possible").count() < 50


def brute_components(fps):
    ids = sorted(fps)
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def brute_fingerprint(text):
    import xxhash

    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(spark, scratch):
    base = " ".join(f"w{i % 37}x{i}" for i in range(300))
    texts = {1: base, 2: base.replace("w3x3 ", ""), 3: base + " end", 4: "Short", 5: "short", 6: None, 7: "", 8: "Été où É", 9: "two words", 10: "a b c d", 11: base.upper(), 12: " \t\n", 13: "one\x0btwo\x0cthree\x1cfour"}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    want = brute_components(fps)
    got = simhash.components(docs, scratch).collect()
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in got} == fps
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("bound", [512, 6])
def test_simhash_links_match_brute_force_in_large_buckets(spark, scratch, monkeypatch, bound):
    import random

    random.seed(bound)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bound)
    fps = set()
    for _ in range(6):
        centre = random.getrandbits(64)
        for _ in range(40):
            flips = random.sample(range(64), random.choice((0, 1, 2, 3, 5)))
            fps.add(centre ^ sum(1 << b for b in flips))
    named = dict(enumerate(sorted(fps)))
    rows = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in fps], "fp long")
    linked = {r["node"] % (1 << 64): r["component"] for r in connected_components(simhash.near_links(rows, scratch), scratch).collect()}
    want = brute_components(named)
    groups = lambda of: sorted(sorted(x) for x in of.values())
    mine, theirs = defaultdict(list), defaultdict(list)
    for i, v in named.items():
        mine[linked.get(v, ("alone", v))].append(i)
        theirs[want[i]].append(i)
    assert groups(mine) == groups(theirs)


def test_near_dedup_keeps_one_row_of_each_component(spark, scratch):
    rows = [(1, "a b c d", "k"), (2, "A b c d", "k"), (3, "other words here now", "k"), (None, "a b c d", "k"), (None, "one more text here", "k"), (None, "one more text HERE", "k"), (3, "a b c d", "k"), (3, "quite another text yet", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumns({"row": F.lit(1), "a.b": F.create_map(F.lit(1), F.lit(2)), "row_no": F.lit(3)})
    got = simhash.near_dedup(docs, scratch)
    assert got.columns == docs.columns
    # rows with null or shared ids are judged by their own text
    assert sorted((r["doc_id"] or 0, r["text"].lower(), r["row_no"]) for r in got.collect()) == [(0, "one more text here", 3), (1, "a b c d", 3), (3, "other words here now", 3), (3, "quite another text yet", 3)]
    assert simhash.components(docs.limit(0), scratch).count() == 0
    assert simhash.near_dedup(docs.limit(0), Scratch(spark, "none")).count() == 0


def test_connected_components_on_paths_hubs_and_nothing(spark, scratch):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), scratch).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "none")).count() == 0


def test_url_rules_hosts_and_aliases(spark, scratch):
    urls = [
        (1, "http://EXAMPLE.com/en/7x", "example.com", "/en/7x", "example.com/en/7", "allow"),
        (2, "http://a.example.com/en/8?q", "a.example.com", "/en/8", "com/en/", "block"),
        (3, "http://net/de/1", "net", "/de/1", "net/de/", "allow"),
        (4, "https://x.example.net/de/8#t", "x.example.net", "/de/8", "example.net/de/8", "block"),
        (5, "http://notcom/en/", "notcom", "/en/", None, "allow"),
        (6, None, "", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (8, "http://u.org?x://y/es/", "u.org", "", None, "allow"),
        (9, "http://alias.test/1", "alias.test", "/1", None, "block"),
        (10, "http://alias.test/2", "alias.test", "/2", None, "allow"),
        (11, "http://far.test/", "far.test", "/", None, "block"),
        (12, "http://alias.test/1", "alias.test", "/1", None, "block"),
    ]
    edges = [("http://alias.test/1", "http://b.com/en/1"), ("http://far.test/", "http://alias.test/1"), ("http://alias.test/2", "http://c.com/en/1"), ("http://alias.test/2", "http://example.com/en/70")]
    pages = spark.createDataFrame([(i, u, "x") for i, u, *_ in urls], "page_id long, url string, rule string")
    got = url_filter.judge(pages, spark.createDataFrame(edges, "a string, b string"), scratch).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted((i, *rest) for i, _, *rest in urls)


def test_declared_links(spark):
    html = [
        '<link rel="canonical" href="https://b.test/c">', "<LINK href='/d' REL='canonical'>", '<meta http-equiv="refresh" content="0; url=//c.test/e">',
        "<p>nothing</p>", None,
    ]
    pages = spark.createDataFrame([(f"http://a.test/{i}", h) for i, h in enumerate(html)] + [(None, html[0])], "url string, html string")
    got = sorted((r["a"], r["b"]) for r in url_filter.declared_links(pages).collect())
    assert got == [("http://a.test/0", "https://b.test/c"), ("http://a.test/1", "http://a.test/d"), ("http://a.test/2", "http://c.test/e")]


def brute_sentences(text, long=16):
    """(tokens with the white space after them) of each sentence, word by word."""
    tokens = re.findall(r"[^\x09-\x0D\x20]+[\x09-\x0D\x20]*", text or "")
    groups, now = [], []
    for k, tok in enumerate(tokens):
        now.append(tok)
        word = tok.strip("\t\n\x0b\x0c\r ")
        if k + 1 == len(tokens) or word[-1] in ".!?" or tok.count("\n") > 1:
            groups.append(now)
            now = []
    out = []
    for g in groups:
        now = []
        for tok in g:
            now.append(tok)
            word = tok.strip("\t\n\x0b\x0c\r ").lower()
            if len(g) > long and (hashlib.md5(word.encode()).hexdigest()[0] == "0" or len(now) == long):
                out.append(now)
                now = []
        out += [now] * bool(now)
    return out


def brute_repeats(docs, run=3, least=16, within=True):
    seen, gone = {}, defaultdict(set)
    parts = {i: brute_sentences(x) for i, x in docs}
    for i in sorted(parts):
        for p in range(len(parts[i])):
            sizes = [n for n in range(run, max(run, least) + 1) if p + n <= len(parts[i]) and sum(map(len, parts[i][p : p + n])) >= least]
            if not sizes:
                continue
            said = "\n".join(" ".join(t.strip("\t\n\x0b\x0c\r ").lower() for t in s) for s in parts[i][p : p + sizes[0]])
            first = seen.setdefault(said, (i, p))
            if first[0] != i or within and first[1] != p:
                gone[i] |= set(range(p, p + sizes[0]))
    texts = dict(docs)
    clean = {i: (re.match(r"[\x09-\x0D\x20]*", texts[i] or "")[0] + "".join("".join(s) for k, s in enumerate(parts[i]) if k not in gone[i]) if gone[i] else texts[i]) for i in parts}
    return {i: (len(parts[i]), sorted(gone[i]), sum(len(parts[i][k]) for k in gone[i]), clean[i]) for i in parts}


PASSAGE = "The first thing is here. A second thing follows it now. Then the third thing comes along. Fourth and last of them."
LONG = " ".join(f"word{i}x" for i in range(70))
SPAN_DOCS = [
    (1, f"Intro words. {PASSAGE} Outro."), (2, f"other start. {PASSAGE} And more text."), (3, PASSAGE), (4, None), (5, ""), (6, "No. No. No. No. No."), (7, f"{PASSAGE} {PASSAGE}"),
    (8, "Yes. No. Yes. No. Yes. No."), (9, "z " * 4000), (10, "WAS!! ED!! OF!! THE!! AN!! IN!! ON!! AS!! TO!! IT!! BE!!"), (11, "x. WAS!! ED!! OF!! THE!! AN!! IN!! ON!! AS!! TO!! IT!! BE!!"),
    (12, "Head line\n\n  indented code\n\n" + PASSAGE.replace(" ", "\n") + "\n\nTail A\n\nTail B\n"), (13, "a b c d e " + LONG), (14, "q " + LONG.upper() + " Ende"), (15, "  \n \t"), (16, "\u00a0x y\x1cz. " * 9), (17, "9. " * 2000 + PASSAGE),
]


@pytest.mark.parametrize("within", [True, False])
@pytest.mark.parametrize("hot_share", [4096, 3, 1])
def test_sentence_spans_match_brute_force(spark, scratch, monkeypatch, within, hot_share):
    monkeypatch.setattr(sentence_spans, "HOT_SHARE", hot_share)
    frame = spark.createDataFrame([(i, t, 1) for i, t in SPAN_DOCS], "doc_id long, text string, t int").repartition(3)
    got = sentence_spans.dedup_sentences(frame, scratch, least_words=10, within=within).collect()
    assert {r["doc_id"]: (r["n_sentences"], r["removed"], r["words_removed"], r["clean_text"]) for r in got} == brute_repeats(SPAN_DOCS, least=10, within=within)
    assert all(r["n_removed"] == len(r["removed"]) for r in got) and len(got) == len(SPAN_DOCS)


def test_sentence_spans_keep_the_rest_to_the_letter(spark, scratch):
    frame = spark.createDataFrame(SPAN_DOCS, "doc_id long, text string")
    got = {r["doc_id"]: r["clean_text"] for r in sentence_spans.dedup_sentences(frame, scratch).collect()}
    assert got[1] == SPAN_DOCS[0][1] and got[3] == "" and got[4] is None and got[2] == "other start. And more text."
    assert got[12] == "Head line\n\n  indented code\n\nTail A\n\nTail B\n"
    assert len(got[14].split()) < 12 and got[14].endswith("Ende")
    assert sentence_spans.dedup_sentences(frame.limit(0), scratch).count() == 0


def test_sentences_end_at_marks_and_blank_lines_only():
    text = "We met John Smith in New York, and Der Mann ging nach Hause mit Anna.\nOne line\nand the next. New\n\npart"
    starts, sizes = sentence_spans.sentence_starts(text)
    assert [text[a:b].split()[0] for a, b in zip(starts, [*starts[1:], None])] == ["We", "One", "New", "part"]
    assert sizes == sentence_spans.sentences(text)[1] == [15, 5, 1, 1]


def test_sentence_spans_with_repeated_and_null_ids(spark, scratch):
    text = "One two three four. Five six seven eight. Nine ten eleven twelve."
    frame = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "a")], "doc_id long, text string")
    got = sentence_spans.dedup_sentences(frame, scratch, least_words=10).collect()
    assert len(got) == 4
    assert sorted(r["n_removed"] for r in got) == [0, 0, 3, 3]
