"""Language identification: words first, then ever shorter character n-grams.

Each known word votes with its log frequency in every language. A word that the
model does not know backs off to its longest character n-grams that it does
know. Counts come from a bounded sample of the rows that have a language, which
the languages share evenly; all words and n-grams of the sample are kept.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import Scratch, table
from stridelake.llm.text_features import WordRows, is_held_out

#: Rows a model is fitted on at most, dealt out evenly to the languages.
FIT_ROWS = 20_000
FIT_TASKS = 8
LONGEST, SMOOTHING = 5, 0.5
#: Words outside the model whose votes a Python worker remembers.
WORDS = 150_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters of a whole text."""
    return _LETTERS.findall((text or "").lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its borders marked."""
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


class Model:
    """Log frequencies by language of words and of n-grams: their lists, and a matrix with a row for each."""

    def __init__(self, languages: list[str], words: list[str], grams: list[str], rows: np.ndarray):
        self.languages, self.words, self.grams, self.rows = languages, words, grams, rows

    def __getstate__(self):
        return self.languages, " ".join(self.words), " ".join(self.grams), self.rows

    def __setstate__(self, state):
        self.languages, words, grams, self.rows = state
        self.words, self.grams = words.split(" ") if words else [], grams.split(" ") if grams else []

    def voter(self, most: int = WORDS) -> WordRows:
        """Sums of the votes of words: a known word's own row, else that of its n-grams."""
        get = dict(zip(self.grams, range(len(self.words), len(self.rows)), strict=True)).get
        return WordRows(lambda words: self._backed_off(words, get), len(self.languages), most, self.words, self.rows[: len(self.words)])

    def _backed_off(self, words: list[str], get) -> np.ndarray:
        """Of each word the mean of its longest known n-grams; zeros if it has none."""
        out = np.zeros((len(words), len(self.languages)))
        left = range(len(words))
        for n in range(LONGEST, 0, -1):
            found = [(k, ids) for k in left if (ids := [g for g in map(get, grams_of(words[k], n)) if g is not None])]
            if not found:
                continue
            sizes = np.fromiter((len(ids) for _, ids in found), np.int64, len(found))
            flat = np.fromiter((g for _, ids in found for g in ids), np.int64, sizes.sum())
            done = [k for k, _ in found]
            out[done] = np.add.reduceat(self.rows[flat].astype(np.float64), np.cumsum(sizes) - sizes) / sizes[:, None]
            left = sorted(set(left).difference(done))
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task: counts of words (n = 0) and n-grams by language, map-side."""
    for batch in batches:
        words: dict[str, Counter] = defaultdict(Counter)
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            words[lang].update(words_of(text))
        rows: list[tuple] = []
        for lang, counts in words.items():
            rows += [(lang, 0, w, c) for w, c in counts.items()]
            for n in range(1, LONGEST + 1):
                grams: Counter = Counter()
                for w, c in counts.items():
                    for g in grams_of(w, n):
                        grams[g] += c
                rows += [(lang, n, g, c) for g, c in grams.items()]
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "n", "token", "c"])


def fit_sample(docs: DataFrame, scratch: Scratch, fit_rows: int = FIT_ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(text, lang) of at most ``fit_rows`` rows with a language whose ids are not held out.

    A row's rank in its language is taken to be its hash's share of the language's
    rows, and the lowest ranks over all languages are chosen. So languages share
    the sample evenly, a rare one is not pushed out by a frequent one, and no task
    gathers a language. The ranks are compared without the texts; only texts that
    rank high enough are read further. Rows equal in id and text count once.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id"), 5, 0))
    # Stored, so that Spark knows its size and sends it to the rows, and not the rows to it.
    sizes = scratch.save(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "sizes")
    hashed = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    share = F.pmod("h", F.lit(1 << 30)) / (1 << 30)
    ranked = hashed.join(sizes, "lang").withColumn("place", F.struct((share * F.col("n")).alias("k"), "lang", "doc_id", "h")).drop("n")
    near = ranked.filter(F.col("place.k") < 1.25 * fit_rows)
    # The last place that is in: narrow rows, of which one task holds fit_rows at most.
    last = near.select("place").distinct().orderBy("place").limit(fit_rows).agg(F.max("place").alias("last"))
    return near.join(F.broadcast(last), F.col("place") <= F.col("last")).dropDuplicates(["place"]).select("text", "lang")


def fit(docs: DataFrame, scratch: Scratch | None = None, fit_rows: int = FIT_ROWS, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Fit on the rows of ``fit_sample``; what reaches the driver is the counts of that sample's words and n-grams."""
    scratch = scratch or Scratch(docs.sparkSession, "language")
    sample = scratch.save(fit_sample(docs, scratch, fit_rows, doc_id, text, lang).repartition(FIT_TASKS), "sample")
    counts = sample.mapInArrow(_count, "lang string, n int, token string, c long").groupBy("n", "token", "lang").agg(F.sum("c").alias("c"))
    found = counts.toArrow().combine_chunks()
    scratch.drop("sample")
    languages = sorted(pc.unique(found.column("lang")).to_pylist())
    at = {la: k for k, la in enumerate(languages)}
    words, grams, rows = [], [], [np.zeros((0, len(languages)), np.float32)]
    for n in range(LONGEST + 1):
        own = found.filter(pc.equal(found.column("n"), n)).sort_by([("token", "ascending"), ("lang", "ascending")])
        coded = own.column("token").combine_chunks().dictionary_encode()
        tokens = coded.dictionary.to_pylist()
        seen_by = np.zeros((len(tokens), len(languages)))
        seen_by[coded.indices.to_numpy(), [at[la] for la in own.column("lang").to_pylist()]] = own.column("c").to_numpy()
        (grams if n else words).extend(tokens)
        # n-grams are held against others of their length
        rows.append(np.log((seen_by + SMOOTHING) / (seen_by.sum(axis=0) + SMOOTHING * len(tokens))).astype(np.float32) if tokens else rows[0])
    return Model(languages, words, grams, np.concatenate(rows))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        seen = model.voter()
        for batch in batches:
            preds, scores, lettered = [], [], []

            def words() -> Iterator[list[str]]:
                for text in batch.column("text"):  # noqa: B023
                    found = words_of(text.as_py())
                    lettered.append(any(any(map(str.isalpha, w)) for w in found))  # noqa: B023
                    yield found

            for k, (_, votes) in enumerate(seen.totals(words())):
                if not model.languages or not lettered[k]:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(votes.argmax())
                preds.append(model.languages[best])
                scores.append(float(1 / np.exp(votes - votes[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (the share of the best language in the votes).

    A text that is null or has no letter is ``und`` with score 0; so is every text
    if nothing was learnt. Of equal votes the language first by name wins. Rows may
    repeat; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out mark, language and score of every document."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs, Scratch(spark, "op7")))
    return found.select("doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")
