"""Benchmark decontamination by an FM-index per training shard.

The items' windows are the patterns. Each task turns its documents into word
ids; a word that no item has can be in no occurrence, so a run of such words
becomes one separator, and so do document ends. Runs shorter than the shortest
window go too. What is left of a shard is indexed once; all windows are searched
backwards through wavelet-tree ranks, one block of items after another;
occurrences are located by sampled suffix positions, and their spans are merged
per document. Items of any number lie in blocks in the shared folder, so neither
the driver nor a task holds more than a block of them.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, file_store, keep_rows, table
from stridelake.llm.fm_index import FMIndex
from stridelake.llm.remembered import Remembered

WINDOW = 13
#: A document is contaminated from 1 hit word in so many.
SHARE = 20
#: Bytes of item text in one block of queries.
BLOCK_BYTES = 1 << 20
#: Bits of the filter that tells words that no item has; words that slip through only make an index larger.
FILTER_BITS = 1 << 23
#: Symbols and documents in one shard's index.
SHARD_SYMBOLS, SHARD_ROWS = 1 << 18, 20_000
#: Words outside the items that a task remembers.
WORDS = 300_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    """Words of a text with A-Z lower-cased; a null has none."""
    if not text:
        return []
    # bytes.lower() changes A-Z alone.
    return _WORD.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


class Patterns:
    """The distinct windows of a block of items, as word ids from 2 on (1 separates)."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.words: dict[str, int] = {}
        windows: dict[tuple[int, ...], list[int]] = {}
        self.items = [item_id for item_id, _ in items]
        for k, (_, text) in enumerate(items):
            ids = [self.words.setdefault(w, len(self.words) + 2) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners = windows.setdefault(tuple(ids[i : i + window]), [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        self.lengths = np.array([len(w) for w in windows], dtype=np.int64)
        self.table = np.zeros((len(windows), window), dtype=np.int64)
        for i, w in enumerate(windows):
            self.table[i, : len(w)] = w
        self.owners = list(windows.values())

    def within(self, ids: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, windows, lengths) of the windows whose words all have an id, by those ids."""
        own = np.zeros(len(self.words) + 2, dtype=np.int64)
        own[2:] = np.fromiter((ids.get(w, 0) for w in self.words), np.int64, len(self.words))
        found = own[self.table]
        live = np.flatnonzero((found > 0).sum(axis=1) == self.lengths) if len(self.lengths) else np.zeros(0, int)
        return live, found[live], self.lengths[live]


class Items:
    """A query set in the shared folder, in blocks, with a filter of its words."""

    def __init__(self, folder: str, names: list[str], bits: np.ndarray, shortest: int, window: int):
        self.folder, self.names, self.bits, self.shortest, self.window = folder, names, bits, shortest, window

    def may_have(self, word: str) -> bool:
        h = zlib.crc32(word.encode("utf-8", "surrogatepass")) % FILTER_BITS
        return bool(self.bits[h >> 3] >> (h & 7) & 1)

    def blocks(self) -> Iterator[Patterns]:
        """The blocks one after another; a single one is kept by the task."""
        if len(self.names) == 1 and hasattr(self, "only"):
            yield self.only
            return
        store, root = file_store(self.folder)
        for name in self.names:
            with store.open_input_file(f"{root}/{name}") as f:
                self.only = Patterns(pickle.loads(f.read()), self.window)
            yield self.only


def stored_items(items: DataFrame, scratch: Scratch, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Items:
    """Write a query set to the shared folder, block by block."""
    spark, folder = items.sparkSession, scratch.path("items")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    store, root = file_store(folder)
    names, shortest, bits = [], 0, np.zeros(FILTER_BITS, dtype=bool)
    for block in item_blocks(items, block_bytes=block_bytes):
        for _, text in block:
            words = words_of(text)
            if words:
                shortest = min(shortest or window, len(words), window)
                bits[[zlib.crc32(w.encode("utf-8", "surrogatepass")) % FILTER_BITS for w in words]] = True
        names.append(f"block-{len(names):06d}")
        with store.open_output_stream(f"{root}/{names[-1]}", compression=None) as out:
            out.write(pickle.dumps(block))
    return Items(folder, names, np.packbits(bits, bitorder="little"), shortest, window)


def _runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of known words that could hold a window."""
    known = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[0::2], edges[1::2]
    keep = ends - starts >= shortest
    return starts[keep], ends[keep]


class Shard:
    """What is gathered of some documents until their index is built."""

    def __init__(self, items: Items, ids: dict[str, int]):
        self.source, self.ids, self.size, self.words = items, ids, 0, []
        self.symbols: list[np.ndarray] = []
        self.text_at: list[int] = []
        self.word_at: list[int] = []
        self.run_doc: list[int] = []

    def add(self, ids: np.ndarray) -> None:
        """Add a document by the ids of all its words, 0 for those that no item has."""
        if self.source.shortest:
            for s, e in zip(*_runs(ids, self.source.shortest), strict=True):
                self.text_at.append(self.size)
                self.word_at.append(int(s))
                self.run_doc.append(len(self.words))
                self.symbols += [ids[s:e], np.ones(1, dtype=ids.dtype)]
                self.size += int(e - s) + 1
        self.words.append(len(ids))

    def found(self) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per document: its number of words, merged spans of hit words, and the items with occurrences."""
        spans: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[str]] = {}
        index = FMIndex(np.concatenate(self.symbols)) if self.size else None
        for block in self.source.blocks() if index else ():
            number, windows, lengths = block.within(self.ids)
            window, at = index.locate(*index.search(windows, lengths))
            run = np.searchsorted(np.array(self.text_at), at, side="right") - 1
            start = np.array(self.word_at)[run] + at - np.array(self.text_at)[run]
            end = start + lengths[window]
            for doc, w, s, e in zip(np.array(self.run_doc)[run].tolist(), number[window].tolist(), start.tolist(), end.tolist(), strict=True):
                items.setdefault(doc, set()).update(block.items[i] for i in block.owners[w])
                spans.setdefault(doc, []).append((s, e))
        return [(n, _merged(spans.get(k, [])), sorted(items.get(k, ()))) for k, n in enumerate(self.words)]


def _searched(items: Items, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """In a task: each batch with what ``Shard.found`` says of its texts. A shard may go over several batches."""
    ids: dict[str, int] = {}
    id_of = Remembered(lambda w: ids.setdefault(w, len(ids) + 2) if items.may_have(w) else 0, WORDS)
    shard, waiting, done = Shard(items, ids), [], []
    for batch in batches:
        waiting.append(batch)
        for text in batch.column("text"):
            words = words_of(text.as_py())
            shard.add(np.fromiter(map(id_of.__getitem__, words), np.int64, len(words)))
            if shard.size >= SHARD_SYMBOLS or len(shard.words) >= SHARD_ROWS:
                done += shard.found()
                shard = Shard(items, ids)
        while waiting and len(done) >= waiting[0].num_rows:
            n = waiting[0].num_rows
            yield waiting.pop(0), done[:n]
            done = done[n:]
    done += shard.found()
    for batch in waiting:
        yield batch, done[: batch.num_rows]
        done = done[batch.num_rows :]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The query set in blocks of bounded bytes, streamed to the driver one by one."""
    block, size = [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).toLocalIterator():
        block.append(("" if row["i"] is None else str(row["i"]), row["t"]))
        size += len(row["t"] or "") + 64
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


def find_spans(docs: DataFrame, items: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, spans (start and end word, in turn), items (their ids as text).

    Null and empty texts have no words. Repeated and null ids keep their own rows.
    A null item id counts as the empty string. No items, or items without words,
    give no spans. Texts are read once, whatever the number of items.
    """
    shared = docs.sparkSession.sparkContext.broadcast(stored_items(items, scratch, window, block_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _searched(shared.value, batches):
            spans = pa.array([[x for pair in s for x in pair] for _, s, _ in found], pa.list_(pa.int64()))
            arrays = [batch.column("doc_id"), pa.array([n for n, _, _ in found], pa.int64()), spans, pa.array([i for _, _, i in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "spans", "items"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, spans array<long>, items array<string>")


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    """Add n_hit, n_items, items_sha256 and contaminated to found spans."""
    indexes = F.sequence(F.lit(0), F.greatest((F.size("spans") / 2).cast("int") - 1, F.lit(0)))
    widths = F.transform(indexes, lambda i: F.coalesce(F.get("spans", i * 2 + 1) - F.get("spans", i * 2), F.lit(0)))
    n_hit = F.aggregate(widths, F.lit(0).cast("long"), lambda a, x: a + x)
    with_hits = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    return with_hits.withColumn("items_sha256", F.sha2(F.concat_ws(",", "items"), 256)).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, items: DataFrame, scratch: Scratch, text: str = "text", share: int = SHARE) -> DataFrame:
    """The rows whose own text is not contaminated, whole. Ids, null or shared, play no part in it."""
    shared = docs.sparkSession.sparkContext.broadcast(stored_items(items, scratch))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bool]]]:
        for batch, found in _searched(shared.value, batches):
            hits = [sum(e - s for s, e in spans) for _, spans, _ in found]
            yield batch, [not (h > 0 and h * share >= n) for h, (n, _, _) in zip(hits, found, strict=True)]

    return keep_rows(docs, text, decide)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words, items and verdict of every document against all benchmark items."""
    found = find_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op4"))
    return judged(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH dw AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)
),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS k, array_to_string(ws[s : s + least(len(ws), 13) - 1], ' ') AS t
  FROM iw, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS r(s) WHERE len(ws) > 0
),
runs AS (
  SELECT doc_id, p, k, array_to_string(list(w) OVER (PARTITION BY doc_id, k ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING), ' ') AS full_t,
         list(w) OVER (PARTITION BY doc_id, k ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS l
  FROM dw, (SELECT DISTINCT k FROM win)
),
occ AS (
  SELECT runs.doc_id, runs.p, runs.k, win.item_id FROM runs JOIN win
  ON win.k = runs.k AND len(l) >= runs.k AND win.t = CASE WHEN runs.k = 13 THEN full_t ELSE array_to_string(l[1 : runs.k], ' ') END
),
hit AS (SELECT doc_id, count(DISTINCT p + o) AS n_hit FROM (SELECT doc_id, p, unnest(range(0, k)) AS o FROM (SELECT DISTINCT doc_id, p, k FROM occ)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_words FROM dw GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n_words, 0) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
       sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AND 20 * coalesce(hit.n_hit, 0) >= coalesce(n.n_words, 0) AS contaminated
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
