"""Byte-level BPE ids in patched frame-of-reference files, in order of document id."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import pfor
from stridelake.llm.common import Scratch, file_store, table
from stridelake.llm.remembered import Remembered

END_ID = 2
#: Ids in a file before the next one begins.
FILE_IDS = 1 << 21
#: Pieces between spaces that a Python worker remembers, twice: about 100 MB.
PIECES = 300_000
#: Bytes of text whose pieces are looked up together.
SLICE_BYTES = 16 << 20

# What stands after a space that may be cut off: a character that is certainly no white space. In Arrow's syntax too.
_ARROW_ODD = "^ | (?:[^!-~À-ɏ]|$)"
_ODD_SPACE = re.compile("^[ ]| (?![!-~À-ɏ])")
_CUT = re.compile(" (?=[!-~À-ɏ])")
_MARKS = frozenset(".,;:!?%#$&*")
# A word with punctuation, and more of them after single line breaks.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?%#$&*]*)((?:\n[A-Za-zÀ-ÖØ-öø-ɏ]+[.,;:!?%#$&*]*)*)")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level BPE writes bytes: printable Latin-1 as it is, the others from 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Pieces:
    """Encoder of a byte-level BPE tokenizer of the library, piece by piece.

    The tokenizer never joins text over a space that a non-space character
    follows, so a text's ids are those of its pieces, each with its space. Pieces
    seen lately are remembered as little-endian uint32 bytes. A plain word, with
    punctuation or not, is two pre-tokens at most, which go straight to the
    library's BPE model; any other piece goes through the whole library.
    """

    def __init__(self, tokenizer, pieces: int = PIECES):
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.pieces = Remembered(self._of_piece, pieces)
        self.marks = Remembered(self._of_pretoken, 1000)
        self.starts = Remembered(self._of_pretoken, pieces // 10)

    def _of_pretoken(self, token: str) -> bytes:
        # ASCII letters and marks are written as themselves.
        spelt = token if token.isascii() and token != "\n" else token.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(spelt)]).tobytes()

    def _of_word(self, word: str) -> bytes:
        spelt = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(self.letters[32] + spelt)]).tobytes()

    def _of_piece(self, piece: str, first: bool = False) -> bytes:
        """Ids of a piece after a space, or of a text's first one."""
        if piece.isascii() and piece.isalpha():
            return self._of_pretoken(piece) if first else self._of_word(piece)
        word, mark = piece[:-1], piece[-1:]
        if not first and mark in _MARKS and word.isascii() and word.isalpha():  # most of the others
            return (self.pieces.get(word) or self._of_word(word)) + self.marks[mark]
        plain = _PLAIN.fullmatch(piece)
        if not plain:
            return self.whole(piece if first else f" {piece}")
        word, marks, more = plain.groups()
        ids = self._of_pretoken(word) if first else self.pieces.get(word) or self._of_word(word)
        ids += self.marks[marks] if marks else b""
        for line in more.split("\n")[1:]:
            word, marks, _ = _PLAIN.fullmatch(line).groups()
            ids += self.marks["\n"] + self.starts[word]
            ids += self.marks[marks] if marks else b""
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if not text:
            return b""
        if "<|" in text:  # perhaps a special token, which the library finds first
            return self.whole(text)
        first, *rest = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        return (self._of_piece(first, True) if first else b"") + b"".join(map(self.pieces.__getitem__, rest))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts, in one array, and how many each has. A null text is an empty one."""
        texts = pc.fill_null(texts, "")
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, _ARROW_ODD)).to_numpy(zero_copy_only=False)
        # A text that is cut otherwise is one piece here.
        alone = {k: self.encode(texts[k].as_py()) for k in np.flatnonzero(odd).tolist()}
        parts = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
        coded = parts.flatten().dictionary_encode()
        index = coded.indices.to_numpy().copy()
        edges = np.concatenate(([0], np.cumsum(pc.list_value_length(parts).to_numpy())))
        words = coded.dictionary.to_pylist()
        firsts = edges[:-1]
        plain_firsts = [words[k] for k in index[firsts].tolist()]
        times = np.bincount(index, minlength=len(words)) - np.bincount(index[firsts], minlength=len(words))
        found = self._of_pieces(words, times)
        # The first piece of a text has no space before it.
        found += [alone[k] if k in alone else self._of_piece(w, True) if w else b"" for k, w in enumerate(plain_firsts)]
        index[firsts] = len(words) + np.arange(len(firsts))
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        flat, begin = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        own = sizes[index]
        upto = np.cumsum(own, dtype=np.int32)
        ids = flat[np.arange(own.sum(), dtype=np.int32) + np.repeat(begin[index] - upto + own, own)]
        return ids, np.diff(np.concatenate(([0], upto))[edges]).astype(np.int64)

    def _of_pieces(self, words: list[str], times: np.ndarray) -> list[bytes]:
        """Ids of distinct pieces that come so many times."""
        young, old = self.pieces, self.pieces.old
        found = [*map(young.get, words)]
        for k, (w, n, ids) in enumerate(zip(words, times.tolist(), found, strict=True)):
            if ids is None:
                if n == 1 and w not in old:
                    found[k] = self._of_piece(w)
                else:
                    found[k] = young[w] if n else b""
        return found


_LOADED: dict[str, Pieces] = {}


def pieces_of(name: str) -> Pieces:
    """The tokenizer of a file of the public vocabularies, kept by each Python worker."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[name] = Pieces(Tokenizer.from_file(public_tokenizers.path(name)))
    return _LOADED[name]


def _write(name: str, end_id: int, folder: str, file_ids: int):
    """A task: encode sorted documents, write them in files, return what each file holds.

    A file is written under the attempt's name and then renamed, so a task that
    runs again, after a lost executor or as a copy, leaves whole files only.
    """
    names = ["part", "file", "path", "n_docs", "n_ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        pieces = pieces_of(name)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        store, root = file_store(folder)
        n_file, docs, held, sizes = 0, [], [], []

        def flush() -> tuple:
            counts = np.concatenate(sizes)
            content = pfor.write_file(docs, counts, np.concatenate(held))
            path = f"part-{part:06d}-{n_file:05d}.slp"
            with store.open_output_stream(f"{root}/.{path}.{attempt}") as out:
                out.write(content)
            if store.get_file_info(f"{root}/{path}").type != fs.FileType.NotFound:  # an earlier attempt's
                store.delete_file(f"{root}/{path}")
            store.move(f"{root}/.{path}.{attempt}", f"{root}/{path}")
            return part, n_file, path, len(docs), int(counts.sum())

        size, out = 0, []
        for batch in batches:
            for piece in _slices(batch):
                ids, counts = _with_ends(*pieces.encode_all(piece.column("text")), end_id)
                ends, keys, at = np.cumsum(counts), piece.column("doc_id").to_pylist(), 0
                while at < len(keys):  # whole documents, until the file is full
                    before = int(ends[at - 1]) if at else 0
                    upto = min(int(np.searchsorted(ends, before + file_ids - size)) + 1, len(keys))
                    docs += keys[at:upto]
                    sizes.append(counts[at:upto])
                    held.append(ids[before : int(ends[upto - 1])])
                    size += len(held[-1])
                    at = upto
                    if size >= file_ids:
                        out.append(flush())
                        n_file, docs, held, sizes, size = n_file + 1, [], [], [], 0
        if docs:
            out.append(flush())
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded bytes of text, or one document."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def _with_ends(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """An end id after the ids of each text."""
    counts = counts + 1
    out = np.empty(len(ids) + len(counts), "<u4")
    is_end = np.zeros(len(out), bool)
    is_end[np.cumsum(counts) - 1] = True
    out[is_end], out[~is_end] = end_id, ids
    return out, counts


def write_tokens(docs: DataFrame, scratch: Scratch, folder: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of every text in ascending order of id; return the files with the ids before each.

    A null text is an empty one; every document ends with ``end_id``. Null ids
    come first, and rows of one id stay together in any order. An empty table
    writes no file. The texts are dealt out by ranges of id, so files are in
    order by name; files are small enough to be read whole.
    """
    spark = docs.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files = dealt.mapInArrow(_write(tokenizer, end_id, folder, file_ids), "part int, file int, path string, n_docs long, n_ids long")
    files = scratch.save(files, "files")
    # Files a task began and left, as it was stopped, are in no row of this table.
    per_part = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before, total = [], 0
    for row in per_part.orderBy("part").toLocalIterator():  # one number a task
        before.append((row["part"], total))
        total += row["n"]
    known = spark.createDataFrame(before, "part int, before long")
    inner = F.coalesce(F.sum("n_ids").over(_in_part()), F.lit(0))
    return files.join(known, "part").select("path", "n_docs", "n_ids", (F.col("before") + inner).alias("start"))


def _in_part():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task: files to one row per document, with the checksum of its ids."""
    names = ["path", "doc_id", "inner", "n_tokens", "ids_crc32"]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            docs, counts, ids = pfor.read_file(content.as_buffer().to_pybytes())
            ends = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(docs)), pa.array(docs, pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(sums, pa.int64())], names=names)


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Per document of the listed files: doc_id, start, n_tokens, ids_crc32."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.slp").load(folder)
    named = found.select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    rows = named.mapInArrow(_read, "path string, doc_id long, inner long, n_tokens long, ids_crc32 long")
    return rows.join(files.select("path", "start"), "path").select("doc_id", (F.col("start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the tokens of all documents, and read them back from the files."""
    scratch = Scratch(spark, "op1")
    folder = scratch.path("tokens")
    files = write_tokens(table(spark, sf_dir, "documents"), scratch, folder)
    return read_tokens(spark, folder, files)
