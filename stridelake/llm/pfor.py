"""Patched frame-of-reference blocks for token ids.

A file holds whole documents:

    magic "SLP1", then little-endian uint64: documents, ids, blocks
    per document: int64 id, int64 row kind (0, or 1 for a null id), uint64 ids before it in the file
    per block: uint64 byte offset in the payload (the index of block starts)
    payload: per block uint32 minimum, uint8 width, uint8 exceptions, then the
    packed low bits, the exceptions' places (uint8 each) and high parts (uint32 each)

A block has 128 ids (the last may have fewer). Its minimum is subtracted, the
width is the bits that a percentile of the ids needs, and what does not fit
keeps its low bits in place and its high part in the exception list.
"""

from __future__ import annotations

import numpy as np

BLOCK, PERCENTILE = 128, 90
MAGIC = b"SLP1"
_HEAD = 6


#: Bits of each value below 2**16, which most vocabularies stay under.
_SHORT_BITS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value below 2**32 needs."""
    if values.size and values.max() < len(_SHORT_BITS):
        return _SHORT_BITS[values]
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Payload and block starts of a sequence of ids below 2**32."""
    n = len(ids)
    n_blocks = -(-n // block)
    if not n:
        return b"", np.zeros(0, dtype=np.uint64)
    padded = np.full(n_blocks * block, ids[-1], dtype=np.uint32)
    padded[:n] = ids
    rows = padded.reshape(n_blocks, block)
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    need = _bit_lengths(rest)
    widths = np.partition(need, block * percentile // 100, axis=1)[:, block * percentile // 100].astype(np.int64)
    over = need > widths[:, None]
    over.reshape(-1)[n:] = False
    n_over = over.sum(axis=1)
    sizes = np.full(n_blocks, block, dtype=np.int64)
    sizes[-1] = n - (n_blocks - 1) * block
    packed_bytes = (sizes * widths + 7) // 8
    lengths = _HEAD + packed_bytes + n_over * 5
    starts = np.concatenate(([0], np.cumsum(lengths)))
    out = np.zeros(int(starts[-1]), dtype=np.uint8)
    at = starts[:-1]
    out[at[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[at + 4], out[at + 5] = widths, n_over
    for width in np.unique(widths):
        if not width:
            continue
        which = np.flatnonzero(widths == width)
        octets = rest[which].astype("<u4").view(np.uint8).reshape(len(which), block, 4)[:, :, : -(-int(width) // 8)]
        bits = np.unpackbits(octets, axis=2, bitorder="little")[:, :, :width]
        packed = np.packbits(bits.reshape(len(which), -1), axis=1, bitorder="little")
        full = which[sizes[which] == block]
        out[at[full][:, None] + _HEAD + np.arange(packed.shape[1])] = packed[: len(full)]
        for b in which[sizes[which] < block]:
            out[at[b] + _HEAD : at[b] + _HEAD + packed_bytes[b]] = packed[-1, : packed_bytes[b]]
    b, place = np.nonzero(over)
    rank = np.arange(len(b)) - np.searchsorted(b, b, side="left")
    base = at[b] + _HEAD + packed_bytes[b]
    out[base + rank] = place
    high = (rest[b, place] >> widths[b].astype(np.uint32)).astype("<u4")
    out[(base + n_over[b] + 4 * rank)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    return out.tobytes(), at.astype(np.uint64)


def decode_blocks(payload: np.ndarray, starts: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``; ``n`` in all."""
    n_blocks = len(starts)
    if not n_blocks:
        return np.zeros(0, dtype=np.uint32)
    at = starts.astype(np.int64)
    low = payload[at[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    widths, n_over = payload[at + 4].astype(np.int64), payload[at + 5].astype(np.int64)
    sizes = np.full(n_blocks, block, dtype=np.int64)
    sizes[-1] = n - (n_blocks - 1) * block
    packed_bytes = (sizes * widths + 7) // 8
    rest = np.zeros((n_blocks, block), dtype=np.uint32)
    for width in np.unique(widths):
        if not width:
            continue
        which = np.flatnonzero(widths == width)
        take = block * int(width) // 8
        index = np.minimum(at[which][:, None] + _HEAD + np.arange(take), len(payload) - 1)
        bits = np.unpackbits(payload[index], axis=1, bitorder="little").reshape(len(which), block, int(width))
        octets = 1 if width <= 8 else 2 if width <= 16 else 4
        wide = np.zeros((len(which), block, 8 * octets), np.uint8)
        wide[:, :, :width] = bits
        rest[which] = np.packbits(wide.reshape(-1), bitorder="little").view(f"<u{octets}").reshape(len(which), block)
    if n_over.any():
        b = np.repeat(np.arange(n_blocks), n_over)
        rank = np.arange(len(b)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        base = at[b] + _HEAD + packed_bytes[b]
        place = payload[base + rank]
        high = payload[(base + n_over[b] + 4 * rank)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
        rest[b, place] |= high << widths[b].astype(np.uint32)
    return (rest + low[:, None]).reshape(-1)[:n]


def write_file(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    payload, starts = encode_blocks(ids)
    head = np.array([len(doc_ids), len(ids), len(starts)], dtype="<u8").tobytes()
    table = np.zeros((len(doc_ids), 3), dtype="<i8")
    table[:, 0] = [0 if d is None else d for d in doc_ids]
    table[:, 1] = [d is None for d in doc_ids]
    table[:, 2] = np.cumsum(counts) - counts
    return b"".join((MAGIC, head, table.tobytes(), starts.astype("<u8").tobytes(), payload))


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, ids per document, all ids) of one file."""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks = np.frombuffer(content, "<u8", 3, 4).tolist()
    table = np.frombuffer(content, "<i8", 3 * n_docs, 28).reshape(-1, 3)
    at = 28 + 24 * n_docs
    starts = np.frombuffer(content, "<u8", n_blocks, at)
    ids = decode_blocks(np.frombuffer(content, np.uint8, offset=at + 8 * n_blocks), starts, n_ids)
    counts = np.diff(np.concatenate((table[:, 2], [n_ids])))
    return [None if null else d for d, null, _ in table.tolist()], counts, ids


def read_document(content: bytes, k: int) -> np.ndarray:
    """The ids of the file's k-th document: only its blocks are decoded."""
    n_docs, n_ids, n_blocks = np.frombuffer(content, "<u8", 3, 4).tolist()
    befores = np.frombuffer(content, "<i8", 3 * n_docs, 28).reshape(-1, 3)[:, 2]
    lo, hi = int(befores[k]), int(befores[k + 1]) if k + 1 < n_docs else n_ids
    if lo == hi:
        return np.zeros(0, dtype=np.uint32)
    at = 28 + 24 * n_docs
    first, last = lo // BLOCK, -(-hi // BLOCK)
    starts = np.frombuffer(content, "<u8", n_blocks, at)[first:last]
    n = min(n_ids, last * BLOCK) - first * BLOCK
    ids = decode_blocks(np.frombuffer(content, np.uint8, offset=at + 8 * n_blocks), starts, n)
    return ids[lo - first * BLOCK : hi - first * BLOCK]
