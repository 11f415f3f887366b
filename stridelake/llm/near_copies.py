"""Near copies by similarity: SimHash of 256 bits, pigeonring filtering, and an exact check.

Texts whose sets of five-word shingles are 0.8 alike differ in some 39 of 256 bits,
too many for keys that every such pair must share. So texts meet by keys of sampled
bits: a table's key is some bits of the fingerprint, and there are as many tables as
it takes for such a pair to share one of them with the stated probability; closer
pairs share many. Pairs that meet are pruned by pigeonring chains: from some start on
the ring of segments every chain of l segments of a pair within the radius holds its
share of the radius at most. Then comes the full Hamming distance, and last the
Jaccard similarity of the shingles themselves, so no pair that is less alike is linked.

Of a bucket only a minimum spanning forest of its close pairs goes on, never all
pairs; shorter distances first, so that pairs surely alike hold a group together.

An exact pass then finds the links that sampling or the forests left out. Alike sets
share one of their first fifth of shingles in any order that is the same for all; here
frequent ones come last. So texts of different components meet by those; sizes, places
and a sketch of parities, which grows with the set and differs in no more bits than the
sets in shingles, prune them without loss before the exact check, so that long texts of
one common passage do not send their sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.common import Scratch, connected_components, quoted

SHINGLE, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, segments of its ring, and the Hamming distance of a candidate at most: three deviations over the mean
#: distance of texts of the least similarity.
BITS, SEGMENTS = 256, 16
#: The probability that texts of just the least similarity share a table.
RECALL = 0.95
#: Buckets up to this size are searched by offsets all at once, larger ones one by one; those above the second size go by longer keys.
SMALL_BUCKET, LARGE_BUCKET = 48, 16_384
#: Texts that a task turns into sets of shingles at once.
SLICE_ROWS = 500

#: One in so many texts is counted to tell frequent shingles, from so many holders there on, and the most that are told.
#: These only set the order of shingles, so they do not change which links are found.
SAMPLED, FREQUENT, MOST_FREQUENT = 16, 4, 65_536
#: Words of a sketch of parities at least; it has a bit for each shingle of a larger set.
SKETCH = 8

_BITS_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(BITS // 8, dtype=np.int64) * 256
_SEED = 20_011


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of a text's shingles, sorted; fewer words are one shingle, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), np.uint64, n))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of 256 bits of a set of hashes: each is spread to four words, and each bit is the majority's."""
    words = []
    for k in range(BITS // 64):
        x = hashes + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & ((1 << 64) - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        words.append(x ^ (x >> np.uint64(31)))
    octets = np.stack(words, axis=1).view(np.uint8)
    seen = np.bincount((octets + _PLACES).ravel(), minlength=BITS * 32).reshape(-1, 256)
    return np.packbits(2 * (seen @ _BITS_OF).ravel() > len(hashes), bitorder="little").tobytes()


@F.pandas_udf(T.StructType([T.StructField("fp", T.BinaryType()), T.StructField("same", T.BinaryType())]))
def wide_fingerprints(texts: pd.Series) -> pd.DataFrame:
    """Fingerprints of whole texts, and digests that tell their sets of shingles apart; nothing else of a row goes to Python."""
    sets = [shingle_set(t) for t in texts]
    return pd.DataFrame({"fp": [wide_fingerprint(s) for s in sets], "same": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]}, dtype=object)


def flip_share(similarity: float) -> float:
    """The share of bits in which texts of a Jaccard similarity differ on average, at most."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def radius(similarity: float) -> int:
    """The distance within which nearly all such pairs lie."""
    p = flip_share(similarity)
    return int(BITS * p + 3 * math.sqrt(BITS * p * (1 - p)))


def tables(nodes: int, similarity: float = SIMILARITY, recall: float = RECALL) -> list[list[int]]:
    """The sampled bits of each table: keys grow with the logarithm of the nodes, so buckets stay small."""
    bits = max(12, min(60, math.ceil(math.log2(max(2, nodes))) - 2))
    share = (1 - flip_share(similarity)) ** bits
    count = math.ceil(math.log(1 - recall) / math.log(1 - share))
    random = np.random.default_rng(_SEED)
    return [sorted(random.choice(BITS, bits, replace=False).tolist()) for _ in range(count)]


def longer(masks: list[list[int]], similarity: float = SIMILARITY, recall: float = RECALL, more: int = 8) -> tuple[list[list[int]], int]:
    """Longer keys for the buckets of each table, as many as keep the recall, and how many those are."""
    fan = math.ceil(math.log(1 - recall) / math.log(1 - (1 - flip_share(similarity)) ** more))
    out = []
    for k, mask in enumerate(masks):
        random = np.random.default_rng([_SEED, k, len(mask)])
        free = np.setdiff1d(np.arange(BITS), mask)
        out += [sorted([*mask, *random.choice(free, min(more, len(free)), replace=False).tolist()]) for _ in range(fan)]
    return out, fan


def _keys(masks: list[list[int]], fan: int):
    """A task that gives each fingerprint its keys: those of its table's ``fan`` masks."""
    places = np.array(masks)
    salt = np.random.default_rng(_SEED).integers(1, 1 << 62, places.shape[1]) | 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, max(1, 80_000 // fan)):
                some = batch.slice(low, max(1, 80_000 // fan))
                bits = np.unpackbits(np.frombuffer(b"".join(some.column("fp").to_pylist()), np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
                own = some.column("mask").to_numpy()[:, None] * fan + np.arange(fan)
                node = some.column("node").to_numpy()
                # Bits of a key are added up with odd weights; keys that meet by chance only cost a comparison.
                key = np.stack([(bits[np.arange(len(bits))[:, None], places[own[:, k]]].astype(np.int64) * salt).sum(axis=1) for k in range(fan)], axis=1)
                each = np.repeat(np.arange(len(node)), fan)
                yield pa.RecordBatch.from_arrays([pa.array(own.ravel().astype(np.int32)), pa.array(key.ravel()), pa.array(node[each]), some.column("fp").take(pa.array(each))], names=["mask", "key", "node", "fp"])

    return run


def within_chains(differ: np.ndarray, most: int) -> np.ndarray:
    """Which pairs, as words of bits that differ, pass the pigeonring chains and the full distance."""
    alive = np.arange(len(differ))
    apart = np.bitwise_count(np.ascontiguousarray(differ).view(np.uint16)).astype(np.int16)
    total, start = np.zeros_like(apart), np.ones(apart.shape, bool)
    for length in range(1, SEGMENTS + 1):
        total += np.roll(apart, 1 - length, axis=1)
        start &= total <= most * length / SEGMENTS
        live = start.any(axis=1)
        if not live.all():
            alive, apart, total, start = alive[live], apart[live], total[live], start[live]
    return alive


def _forest(fps: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """A minimum spanning forest of a bucket's pairs within the distance, grown from one row to the next nearest."""
    n = len(fps)
    near, by = np.full(n, BITS + 1, np.int16), np.zeros(n, np.int64)
    out, at = np.ones(n, bool), 0
    for _ in range(n - 1):
        out[at] = False
        far = np.bitwise_count(fps ^ fps[at]).sum(axis=1).astype(np.int16)
        closer = (far < near) & out
        near[closer], by[closer] = far[closer], at
        at = int(np.where(out, near, BITS + 2).argmin())
        if near[at] <= most:
            yield int(by[at]), at


def _link(most: int):
    """A task over rows sorted by (mask, key): edges of each bucket, or its rows if it is too large.

    It streams; a bucket that runs on over batches is carried, up to the bound.
    """
    names, types = ["over", "mask", "a", "b", "fp"], [pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def edges(nodes: np.ndarray, fps: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[tuple]:
        small = (sizes > 1) & (sizes <= SMALL_BUCKET)
        row_bucket = np.repeat(np.arange(len(sizes)), sizes)
        near = np.zeros(len(sizes), bool)
        rows = np.flatnonzero(small[row_bucket])
        for step in range(1, SMALL_BUCKET):
            rows = rows[rows + step < starts[row_bucket[rows]] + sizes[row_bucket[rows]]]
            if not len(rows):
                break
            hit = within_chains(fps[rows] ^ fps[rows + step], most)
            near[row_bucket[rows[hit]]] = True
        out = []
        for k in np.flatnonzero(near | (sizes > SMALL_BUCKET)).tolist():
            s, e = starts[k], starts[k] + sizes[k]
            out += [(int(nodes[s + i]), int(nodes[s + j])) for i, j in _forest(fps[s:e], most)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the bucket that may go on
        spilled = None

        def over(rows: pa.Table) -> pa.RecordBatch:
            whole = rows.combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([pa.array([True] * whole.num_rows), whole.column("mask"), whole.column("node"), whole.column("node"), whole.column("fp")], names=names)

        def found(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            nodes = rows.column("node").to_numpy()
            fps = np.frombuffer(b"".join(rows.column("fp").to_pylist()), np.uint64).reshape(-1, BITS // 64)
            pairs = edges(nodes, fps, starts, np.diff(np.append(starts, len(nodes))))
            columns = [[False] * len(pairs), [0] * len(pairs), [a for a, _ in pairs], [b for _, b in pairs], [None] * len(pairs)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            rows = pa.Table.from_batches([*held, batch])
            held = []
            masks, keys = rows.column("mask").to_numpy(), rows.column("key").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (masks[1:] != masks[:-1]) | (keys[1:] != keys[:-1])))) if len(masks) else np.zeros(0, np.int64)
            if not len(starts):
                continue
            begin = 0
            if spilled == (masks[0], keys[0]):
                begin = int(starts[1]) if len(starts) > 1 else len(masks)
                yield over(rows.slice(0, begin))
                starts = starts[1:]
            if not len(starts):
                continue
            spilled = None
            last = int(starts[-1])
            if len(masks) - last > LARGE_BUCKET:
                yield over(rows.slice(last))
                spilled = (masks[last], keys[last])
            else:
                held = rows.slice(last).to_batches()
            if last > begin:
                yield found(rows.slice(begin, last - begin), starts[:-1] - begin)
        if held:
            yield found(pa.Table.from_batches(held), np.zeros(1, np.int64))

    return run


def close_pairs(nodes: DataFrame, scratch: Scratch, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) between nodes (node, fp) that are likely alike, each once, a < b; a few for each node at most."""
    masks = tables(nodes.count(), similarity, recall)
    fan, edges, level = len(masks), None, 0
    rows = nodes.select("node", "fp", F.lit(0).alias("mask"))
    while True:
        keyed = rows.mapInArrow(_keys(masks, fan), "mask int, key long, node long, fp binary")
        if level:
            keyed = keyed.dropDuplicates(["mask", "key", "node"])
        linked = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(_link(radius(similarity)), "over boolean, mask int, a long, b long, fp binary")
        linked = scratch.save(linked, f"close-{level}")
        own = linked.filter("not over").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = own if edges is None else edges.unionByName(own)
        large = linked.filter("over")
        if large.isEmpty():
            edges = scratch.save(edges.distinct(), "edges")
            for k in range(level + 1):
                scratch.drop(f"close-{k}")
            return edges
        rows = large.select(F.col("a").alias("node"), "fp", "mask")
        masks, fan = longer(masks, similarity, recall)
        level += 1


def _shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task: nodes' texts to their sets of shingles."""
    for whole in batches:
        for low in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(low, SLICE_ROWS)
            sets = [shingle_set(t.as_py()).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


def confirmed(edges: DataFrame, texts: DataFrame, scratch: Scratch, similarity: float = SIMILARITY) -> DataFrame:
    """The edges whose texts' shingles are as alike as that. ``texts`` has node and text; only those of the edges are read."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = scratch.save(texts.join(ends, "node", "left_semi").mapInArrow(_shingle, "node long, shingles array<long>"), "shingles")
    both = edges.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    found = scratch.save(both.filter(shared >= F.lit(similarity) * (F.size("x") + F.size("y") - shared) - 1e-9).select("a", "b"), "confirmed")
    scratch.drop("shingles")
    return found


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles that many of the sampled texts hold, sorted, with ranks of which the rarest has the first; a bounded list."""
    sample = texts.filter(F.pmod(F.xxhash64("node"), F.lit(SAMPLED)) == 0)
    counts = sample.mapInArrow(_shingle, "node long, shingles array<long>").select(F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    most = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).collect()
    hashes = np.array([r["h"] for r in most][::-1], np.int64).view(np.uint64)
    out = np.empty(len(hashes), [("h", np.uint64), ("rank", np.int64)])
    out["h"], out["rank"] = hashes, np.arange(len(hashes))
    return np.sort(out, order="h")


def first_shingles(own: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a sorted set, frequent ones last, of which any two alike sets share one.

    ``frequent`` has the frequent shingles, sorted, and their ranks.
    """
    if not len(own):
        return own
    n = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1
    if not len(frequent):
        return own[:n]
    at = np.minimum(np.searchsorted(frequent["h"], own), len(frequent) - 1)
    common = frequent["h"][at] == own
    first = own[~common][:n]
    return first if len(first) == n else np.concatenate([first, own[common][np.argsort(frequent["rank"][at[common]])][: n - len(first)]])


def parities(own: np.ndarray) -> np.ndarray:
    """How often each bit is hit by the shingles of a set, even or odd, as words, whose number is a power of two."""
    bits = 64 * max(SKETCH, 1 << max(0, math.ceil(len(own) / 64) - 1).bit_length())
    odd = np.bincount(((own >> np.uint64(17)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def apart_at_least(a: str, b: str) -> Column:
    """The bits in which two sketches differ, the longer one folded to the other's length, which is its half or the same."""
    words = F.least(F.size(a), F.size(b))
    fold = lambda x: F.when(F.size(x) > words, F.zip_with(F.slice(x, 1, words), F.slice(x, words + 1, words), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(x))
    return F.aggregate(F.zip_with(fold(a), fold(b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, bits: n + bits)


def _signed(frequent: np.ndarray, similarity: float):
    """A task: texts to the number of their shingles, the first of them, and their sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(low, SLICE_ROWS)
                sets = [shingle_set(t.as_py()) for t in batch.column("text")]
                first = pa.array([first_shingles(s, frequent, similarity).view(np.int64) for s in sets], pa.list_(pa.int64()))
                sketch = pa.array([parities(s) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([len(s) for s in sets], pa.int32()), first, sketch], names=["node", "n", "first", "sketch"])

    return run


def left_out(texts: DataFrame, placed: DataFrame, scratch: Scratch, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) between the nodes of different components, ``placed`` (node, component), that may be alike: none that is gets lost.

    Texts of a frequent shingle meet in a join that Spark may split and spill, pair after pair, so no task holds them.
    """
    signed = texts.mapInArrow(_signed(frequent_shingles(texts), similarity), "node long, n int, first array<long>, sketch array<long>").join(placed, "node")
    signed = scratch.save(signed, "signed")
    held = signed.select("node", "component", "n", F.posexplode("first").alias("at", "h"))
    # Aliases of one frame, so that Spark sees both sides as one and shuffles it once.
    x, y = held.alias("x"), held.alias("y")
    # Behind the place where they meet, sets can share no more than what is left of the shorter.
    need = F.lit(similarity / (1 + similarity)) * (F.col("x.n") + F.col("y.n")) - 1e-6
    reach = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))).filter(
        (F.least("x.n", "y.n") >= F.lit(similarity) * F.greatest("x.n", "y.n") - 1e-6) & (reach >= need)
    )
    pairs = scratch.save(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "met")
    of = lambda end: signed.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))
    most = F.lit((1 - similarity) / (1 + similarity)) * (F.col("n_a") + F.col("n_b")) + 1e-6
    left = scratch.save(pairs.join(of("a"), "a").join(of("b"), "b").filter(apart_at_least("sketch_a", "sketch_b") <= most).select("a", "b"), "left-out")
    for name in ("signed", "met"):
        scratch.drop(name)
    return left


def near_copies(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row of each component of near copies, that with the smallest id, with all its columns of any name and type.

    Texts are linked if their sets of five-word shingles (A-Z lower-cased, fewer
    words are one shingle) have a Jaccard similarity of ``similarity`` or more. The
    stated share of pairs of just that similarity, and nearly all closer ones, are
    found by their fingerprints; an exact pass finds the rest. Texts without words are alike. A null id comes last; of rows that share the
    smallest id one stays; a null text is an empty one; rows that repeat are one
    node. An empty table gives no rows. Rows are stored once as structs with a
    number, by which those that go are joined out.
    """
    whole = F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")
    signed = wide_fingerprints(F.coalesce(F.col(quoted(text)).cast("string"), F.lit(""))).alias("fp")
    rows = scratch.save(docs.select(whole, F.monotonically_increasing_id().alias("row_no"), signed).select("row", "row_no", "fp.*"), "rows")
    identity = F.col("row").getField(doc_id)
    place = F.struct(identity.isNull().alias("last"), identity.alias("id"), F.col("row_no"))
    nodes = scratch.save(rows.groupBy("same").agg(F.min(place).alias("least"), F.min("row_no").alias("node"), F.first("fp").alias("fp")), "nodes")
    edges = close_pairs(nodes.select("node", "fp"), scratch, similarity, recall)
    texts = rows.select(F.col("row_no").alias("node"), F.coalesce(F.col("row").getField(text).cast("string"), F.lit("")).alias("text"))
    sure = confirmed(edges, texts, scratch, similarity)
    linked = connected_components(sure, scratch)
    placed = scratch.save(nodes.select("node").join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "placed")
    rest = Scratch(docs.sparkSession, "near-rest")
    more = confirmed(left_out(texts, placed, scratch, similarity), texts, rest, similarity)
    linked = connected_components(scratch.save(sure.unionByName(more), "links"), rest)
    rooted = nodes.join(linked, "node", "left").select("same", "least", F.coalesce("component", "node").alias("root"))
    rooted = scratch.save(rooted, "rooted")
    first = rooted.groupBy("root").agg(F.min("least").alias("first"))
    stay = scratch.save(rooted.join(first, "root").select("same", F.col("first.row_no").alias("stay")), "stay")
    gone = scratch.save(rows.select("same", "row_no").join(stay, "same").filter("row_no <> stay").select("row_no"), "gone")
    return rows.join(gone, "row_no", "left_anti").select("row.*")
