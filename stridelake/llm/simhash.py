"""SimHash near-duplicates with pigeonring candidate filtering.

A 64-bit fingerprint is a ring of eight 8-bit segments. If two fingerprints
differ in at most three bits, some start on the ring exists from which every
chain of l consecutive segments holds at most ``3 * l / 8`` differences: none in
the first two, at most one in the next three, and so on. So from that start the
first two segments agree, and so do two of the next three: 8 x 3 = 24 keys of 32
bits find every pair. Within a bucket the longer chains prune before the full
Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.common import Scratch, connected_components, quoted, table

SEGMENTS, WIDTH, DISTANCE, SHINGLE = 8, 8, 3, 3
#: Buckets above this many fingerprints are split by longer keys instead of compared.
BUCKET_ROWS = 512

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text: the majority of its shingles' XXH64, bit by bit."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    seen = np.bincount((octets + _PLACES).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed longs."""
    return pd.Series(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))


def _ring_masks() -> list[tuple[int, int]]:
    """(mask of the bits that must agree, start segment) of the 24 keys."""
    ring = [((1 << WIDTH) - 1) << (WIDTH * k) for k in range(SEGMENTS)]
    out = []
    for start in range(SEGMENTS):
        at = [ring[(start + k) % SEGMENTS] for k in range(5)]
        out += [(at[0] | at[1] | at[x] | at[y], start) for x, y in combinations((2, 3, 4), 2)]
    return out


def _longer(masks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Four longer masks for each: three differences leave one quarter of the rest equal."""
    out = []
    for mask, start in masks:
        rest = [b for b in range(64) if not mask >> b & 1]
        quarters = [rest[k::4] for k in range(4)]
        out += [(mask | sum(1 << b for b in q), start) for q in quarters]
    return out


def _keys(masks: list[tuple[int, int]], fan: int):
    """A task that gives each fingerprint its keys: all masks, or its own mask's ``fan`` longer ones."""
    values = np.array([m for m, _ in masks], dtype=np.uint64)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            own = batch.column("mask").to_numpy(zero_copy_only=False).astype(np.int64)
            ids = (own[:, None] * fan + np.arange(fan)).ravel()
            each = np.repeat(fps, fan)
            key = (each & values[ids]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(key), pa.array(each.view(np.int64))], names=["mask", "key", "fp"])

    return expand


def _link(masks: list[tuple[int, int]]):
    """A task over rows sorted by (mask, key): link each bucket, or hand it on if it is too large.

    It streams; a bucket that runs on over batches is carried, up to the bound.
    """
    starts = np.array([s for _, s in masks], dtype=np.int64)

    def pairs(fps: np.ndarray, start: int) -> Iterator[tuple[int, int]]:
        """A spanning forest of the bucket's graph of close fingerprints."""
        differ = fps[:, None] ^ fps[None, :]
        near = np.triu(np.ones(differ.shape, dtype=bool), 1)
        total = np.zeros(differ.shape, dtype=np.uint8)
        for length in range(1, SEGMENTS + 1):
            shift = np.uint64(WIDTH * ((start + length - 1) % SEGMENTS))
            total += np.bitwise_count((differ >> shift) & np.uint64((1 << WIDTH) - 1))
            near &= total <= DISTANCE * length // SEGMENTS
            if not near.any():
                return
        near &= np.bitwise_count(differ) <= DISTANCE
        top = list(range(len(fps)))

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            a, b = find(i), find(j)
            if a != b:
                top[max(a, b)] = min(a, b)
                yield int(fps[i].view(np.int64)), int(fps[j].view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now, spilled = None, False
        names = ["over", "mask", "a", "b"]

        def close(out: list[tuple]) -> None:
            if now is not None and not spilled:
                fps = np.concatenate(held)
                if len(fps) > 1:
                    out += [(0, now[0], a, b) for a, b in pairs(fps, int(starts[now[0]]))]

        for batch in batches:
            ids, keys, fps = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "fp"))
            fps = fps.view(np.uint64)
            if not len(ids):
                continue
            cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])) + 1
            lo, hi = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(ids)]))
            busy = (hi - lo > 1) | (np.arange(len(lo)) == 0) | (np.arange(len(lo)) == len(lo) - 1)
            out: list[tuple] = []
            for s, e in zip(lo[busy].tolist(), hi[busy].tolist(), strict=True):
                bucket = (int(ids[s]), int(keys[s]))
                if bucket != now:
                    close(out)
                    now, held, spilled = bucket, [], False
                part = fps[s:e].copy()
                if spilled or sum(map(len, held)) + len(part) > BUCKET_ROWS:
                    for more in (*held, part):
                        out += [(1, bucket[0], x, x) for x in more.view(np.int64).tolist()]
                    held, spilled = [], True
                else:
                    held.append(part)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=names)
        out = []
        close(out)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=names)

    return run


def near_links(fps: DataFrame, scratch: Scratch, fp: str = "fp") -> DataFrame:
    """Edges (a, b) whose graph joins the same distinct fingerprints as all close pairs do.

    Buckets that are too large get longer keys, level by level. Only so many
    distinct fingerprints share a long key, so this ends, without comparing all
    pairs of a large bucket and without dropping any.
    """
    masks, fan = _ring_masks(), len(_ring_masks())
    rows = fps.select(F.col(fp).alias("fp"), F.lit(0).alias("mask"))
    edges, level = None, 0
    while True:
        keyed = rows.mapInArrow(_keys(masks, fan), "mask int, key long, fp long")
        if level:
            keyed = keyed.distinct()
        found = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_link(masks), "over int, mask int, a long, b long")
        found = scratch.save(found, f"links-{level}")
        own = found.filter("over = 0").select("a", "b")
        edges = own if edges is None else edges.unionByName(own)
        over = found.filter("over = 1")
        if over.isEmpty():
            return edges
        rows = over.select(F.col("a").alias("fp"), "mask")
        masks, fan, level = _longer(masks), 4, level + 1


def _rooted(hashed: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, root) of every fingerprint of a stored table: equal roots are one component."""
    nodes = scratch.save(hashed.select("fp").distinct(), "nodes")
    linked = connected_components(near_links(nodes, scratch), scratch)
    return nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("root"))


def components(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fp (signed long) and component_id, the smallest id reachable.

    Rows of one fingerprint are one node, so copies cost one row each. Null and
    empty texts have fingerprint zero and link like any other. A null id keeps its
    row and is never a component's id unless all its members are null.
    """
    hashed = scratch.save(docs.select(F.col(doc_id).alias("doc_id"), fingerprints(F.coalesce(F.col(text), F.lit(""))).alias("fp")), "fingerprints")
    least = hashed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = scratch.save(least.join(_rooted(hashed, scratch), "fp"), "roots")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = scratch.save(roots.join(named, "root").select("fp", "component_id"), "named")
    return hashed.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that with the smallest id, with all its columns of any name and type.

    A null id comes last. Of rows that share the smallest id one stays, so rows
    with null or shared ids are judged by their own text. Rows are stored once as
    structs with a number, by which those that go are joined out.
    """
    whole = F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")
    rows = docs.select(whole, F.monotonically_increasing_id().alias("row_no"), fingerprints(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("fp"))
    rows = scratch.save(rows, "rows")
    identity = F.col("row").getField(doc_id)
    place = F.struct(identity.isNull().alias("last"), identity.alias("id"), F.col("row_no"))
    roots = scratch.save(rows.groupBy("fp").agg(F.min(place).alias("least")).join(_rooted(rows, scratch), "fp"), "roots")
    first = roots.groupBy("root").agg(F.min("least").alias("first"))
    stay = scratch.save(roots.join(first, "root").select("fp", F.col("first.row_no").alias("stay")), "stay")
    gone = scratch.save(rows.select("fp", "row_no").join(stay, "fp").filter("row_no <> stay").select("row_no"), "gone")
    return rows.join(gone, "row_no", "left_anti").select("row.*")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = components(table(spark, sf_dir, "documents"), Scratch(spark, "op2"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
