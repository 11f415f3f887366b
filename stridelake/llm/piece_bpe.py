"""SentencePiece BPE by a table of prefixes.

Every prefix of a text has one last token in the text's encoding. It is the
token that ends there (the automaton gives the few that do) and that can stand
after the last token of what is left without it. Whether one token can follow
another is a property of the pair alone: replay the merges that made the two
along their border, and see whether a merge over the border would have come
first. With the table filled, the ids are read off from the end backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import table
from stridelake.llm.remembered import Remembered

SPACE = "▁"
#: What a Python worker remembers: chunks, their parts, and answers on pairs of tokens.
CHUNKS, PARTS, PAIRS = 60_000, 250_000, 300_000
_NEVER = 1 << 30
_CHUNK = re.compile(f"^[^{SPACE}]+|{SPACE}+[^{SPACE}]*")


class PieceBPE:
    """Encoder of one SentencePiece BPE model with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=model_file)
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        spec, kinds = model.normalizer_spec, model.SentencePiece
        if model.trainer_spec.model_type != model.trainer_spec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("only BPE models without normalisation are read")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not read")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        normal = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.ids = {piece: i for piece, _, i in normal}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        # Merge order: the best score first; of equal scores, which only runs of
        # spaces have, the longer: the library then goes from left to right, and
        # so lets the leftmost run grow before it begins another.
        order = sorted(normal, key=lambda x: (-x[1], -len(x[0])))
        self.piece = [p.piece for p in model.pieces]
        self.decimal = [str(i) for i in range(len(self.piece))]
        # rank of the merge that makes a token of two
        by_text = {piece: k for k, (piece, _, _) in enumerate(order)}
        self.by_text = by_text
        # (left part, right part) of each token's last merge; pieces that BPE does not
        # make of their own text are never an answer.
        self.parts: dict[int, tuple[int, int] | None] = {}
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.parts[i] = None
            elif made := self._last_merge(piece):
                self.parts[i] = (self.ids[made[0]], self.ids[made[1]])
        self.right = {i: self._border(i, 1) for i in self.parts}
        self.left = {i: self._border(i, 0) for i in self.parts}
        self.automaton = ahocorasick.Automaton()
        for i in self.parts:
            self.automaton.add_word(self.piece[i], (i, len(self.piece[i])))
        self.automaton.make_automaton()
        self.joined = {piece[k : k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        if any(a[1] == SPACE != a[0] for a in self.joined):
            raise ValueError("models with spaces inside pieces are not read")
        self.size = len(self.piece)
        self.follows = Remembered(self._follows, PAIRS)
        self.part_ids = Remembered(self._part_ids, PARTS)
        self.blanks = self._long_blanks()
        self.chunk_ids = Remembered(self._chunk_ids, CHUNKS)
        self.after_space = Remembered(lambda piece: self._chunk_ids(SPACE + piece), CHUNKS)

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two tokens that plain BPE merges last on a piece's own text; None if it ends otherwise."""
        now, rank = list(piece), self.by_text
        while len(now) > 2:
            best = min((rank.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(now, now[1:], strict=False)))
            if best[0] == _NEVER:
                return None
            now[best[1] : best[1] + 2] = [now[best[1]] + now[best[1] + 1]]
        return (now[0], now[1]) if len(now) == 2 and now[0] in self.ids and now[1] in self.ids else None

    def _border(self, token: int, side: int) -> tuple[tuple[str, int], ...]:
        """Texts at one border while a token is made, each with the rank of the merge that consumes it."""
        chain = [(self.piece[token], _NEVER)]
        while self.parts.get(token):
            rank = self.by_text[self.piece[token]]
            token = self.parts[token][side]
            chain.append((self.piece[token], rank))
        return tuple(reversed(chain))

    def _follows(self, pair: int) -> bool:
        """Whether the second token of a pair (first * size + second) can come after the first.

        Walk the merges at both sides of the border in their order. A merge over
        the border wins if it ranks before the left side's next merge and not
        after the right side's (of equal ranks the leftmost goes first).
        """
        left, right, i, j, rank = self.right[pair // self.size], self.left[pair % self.size], 0, 0, self.by_text
        while True:
            (x, x_next), (y, y_next) = left[i], right[j]
            over = rank.get(x + y, _NEVER)
            if over < x_next and over <= y_next:
                return False
            if x_next <= y_next:
                if x_next == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _long_blanks(self) -> tuple[int, int] | None:
        """The longest token of spaces alone, and its length, if long runs of spaces begin with it again and again.

        The last token of a run follows from those of the runs that are shorter by
        up to that length. So if two lengths on end repeat, all longer runs do.
        """
        runs = [len(piece) for i, piece in enumerate(self.piece) if i in self.parts and set(piece) == {SPACE}]
        if not runs:
            return None
        n, token = max(runs), self.ids[SPACE * max(runs)]
        ids = {m: self._table_ids(SPACE * m) for m in range(3 * n, 6 * n + 1)}
        return (token, n) if all(ids[m] == (token, *ids[m - n]) for m in range(4 * n, 6 * n + 1)) else None

    def _part_ids(self, text: str) -> tuple[int, ...]:
        """Ids of a normalised text; of a long run of spaces at its beginning only the end is worked out."""
        if self.blanks and text.startswith(SPACE * 6 * self.blanks[1]):
            token, n = self.blanks
            times = (len(text) - len(text.lstrip(SPACE))) // n - 4
            return (token,) * times + self._table_ids(text[times * n :])
        return self._table_ids(text)

    def _table_ids(self, text: str) -> tuple[int, ...]:
        """Ids of a text by its table of prefixes.

        ``last[i]`` is the last token of the first i + 1 characters, or -1 for a
        character outside the vocabulary, which stands alone as its bytes.
        """
        last: list[int] = []
        sizes: list[int] = []
        follows, size, n = self.follows, self.size, 0
        for end, (token, length) in self.automaton.iter(text):
            if end < n:
                continue
            while n < end:
                last.append(-1)
                sizes.append(1)
                n += 1
            before = end - length
            if before < 0 or last[before] < 0 or follows[last[before] * size + token]:
                last.append(token)
                sizes.append(length)
                n += 1
        while n < len(text):
            last.append(-1)
            sizes.append(1)
            n += 1
        out: list[int] = []
        while n:
            n -= 1
            if last[n] < 0:
                out += [self.bytes[b] for b in reversed(text[n].encode("utf-8"))]
            else:
                out.append(last[n])
                n -= sizes[n] - 1
        return tuple(reversed(out))

    def _chunk_ids(self, chunk: str) -> tuple[int, ...]:
        """Ids of a chunk, cut where no piece of the vocabulary joins the two characters."""
        start, joined, ids = 0, self.joined, []
        for k in range(1, len(chunk)):
            if chunk[k - 1 : k + 1] not in joined:
                ids.extend(self.part_ids[chunk[start:k]])
                start = k
        if chunk:
            ids.extend(self.part_ids[chunk[start:]])
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        No piece goes on over the border between another character and a space, so
        a text is encoded from space to space; chunks seen lately are remembered.
        """
        if not text:
            return []
        if self.prefix and SPACE not in text and "  " not in text and text[0] != " " != text[-1]:
            return [*chain.from_iterable(map(self.after_space.__getitem__, text.split(" ")))]
        spaced = self.prefix + text.replace(" ", SPACE)
        return [*chain.from_iterable(map(self.chunk_ids.__getitem__, _CHUNK.findall(spaced)))]

    def in_decimal(self, ids: list[int]) -> str:
        """Ids joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))


_LOADED: dict[str, PieceBPE] = {}


def encoder_of(name: str) -> PieceBPE:
    """The encoder of a file of the public vocabularies, kept by each Python worker."""
    if name not in _LOADED:
        import public_tokenizers

        _LOADED[name] = PieceBPE(public_tokenizers.path(name))
    return _LOADED[name]


def _round_trip(name: str, keep_text: bool):
    """A task: texts to token counts, digests and, if asked for, decoded texts with ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(name)
        decode = encoder.library.decode
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text or "")
                said = encoder.in_decimal(ids)
                back = decode(ids) if ids else ""
                digests = (hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(back.encode("utf-8")).hexdigest())
                out.append((len(ids), *digests) + ((ids, back) if keep_text else ()))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()][: 5 if keep_text else 3]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[k] for x in out], t) for k, t in enumerate(kinds))], names=["doc_id", *names])

    return run


def round_trip(docs: DataFrame, model: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, and ids and decoded text if kept.

    A null text is an empty one and has no ids. Ids and rows may repeat; an empty
    table gives no rows. Each row is encoded alone, so nothing shuffles.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_text
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_round_trip(model, keep_text), schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return round_trip(table(spark, sf_dir, "documents"), keep_text=False)
