"""Language identification by word-first backoff.

A word seen in training scores by its log frequency in every language.  An
unseen word falls back to its character 5-grams (the word carries a mark at
either end), and when none of them is known to 4-grams, and so on down to
single characters; the scores of the first length with a known n-gram are
averaged, so an unseen word weighs as much as a known one.  A document's
language is the one with the largest sum over its words.

Training counts words and n-grams of labelled documents in every partition and
sums them by key (pre-aggregated, so a language with most of the rows is no hot
spot).  The bounds are parameters: about ``max_train_docs`` labelled documents
of every language (chosen by a hash of id and text, whole texts), the
``max_words`` most frequent words and the ``max_grams`` most frequent n-grams
over all languages, and besides these every language's own most frequent ones,
an equal share of the same numbers (``LEAST`` at least); so the model that is
broadcast has at most twice ``max_words + max_grams`` rows (of one number per
language) for up to 100 languages.  A piece that a language lacks scores alike
in all languages, however much text of them was seen.

Defined cases: NULL text, or a text without a letter, is ``und`` with score 0;
so is every document when nothing is labelled.  Ties go to the language that
sorts first.  NULL ids are neither trained on nor held out.  Repeated rows get
equal predictions; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pin, ship, strings

UNKNOWN = "und"
GRAMS = (5, 4, 3, 2, 1)
EVIDENCE_WORDS = 20  # the score is the posterior after at most so many average words
_LETTERS = regex.compile(r"\p{L}+")
_MEMO = 400_000
LEAST = 1000  # words and n-grams of every language that stay at least


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}

    def out():
        """What was counted, a language and a kind at a time, so that little is held twice."""
        while words:
            lang, seen = words.popitem()
            sub: Counter = Counter()
            for w, c in seen.items():
                for n in GRAMS:
                    for g in grams(w, n) if n > 1 else w:
                        sub[g] += c
            for kind, counted in (("w", seen), ("g", sub)):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([x], pa.string()).take(pa.array(np.zeros(len(counted), np.int32))) for x in (lang, kind)),
                     pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())],
                    ["lang", "kind", "item", "n"])
                counted.clear()
        pa.default_memory_pool().release_unused()

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), strings(b.column(1))):
            words.setdefault(lang, Counter()).update(_LETTERS.findall(text.lower()))
        if sum(map(len, words.values())) > _MEMO:
            yield from out()
    yield from out()


class BackoffModel:
    """Word and n-gram log frequencies per language; picklable, a few MB at most."""

    def __init__(self, languages: list[str], words: dict[str, np.ndarray], pieces: dict[str, np.ndarray],
                 totals: tuple[np.ndarray, np.ndarray]):
        self.languages, half = languages, 0.5
        self.words, self.pieces = (
            {k: tuple(x) for k, x in zip(table, self._logs(table, total, half))}
            for table, total in zip((words, pieces), totals))
        self.memo: dict[str, int] = {}  # piece to its row of ``rows``: summed scores, then the number of words
        self.rows = np.zeros((0, len(languages) + 1))

    @staticmethod
    def _logs(table: dict[str, np.ndarray], total: np.ndarray, half: float) -> list[list[float]]:
        """Log frequencies, smoothed as if every language had as much text as the largest."""
        most = total.max(initial=1.0)
        counts = np.array(list(table.values())).reshape(len(table), len(total)) * (most / np.maximum(total, 1.0))
        return np.log((counts + half) / (most + half * (len(table) + 1))).tolist()

    def word(self, word: str) -> tuple[float, ...]:
        """Score of one word in every language."""
        known = self.words.get(word)
        if known is not None:
            return known
        marked, get = f"<{word}>", self.pieces.get
        for n in GRAMS:
            if n == 1:
                marked = word  # the marks are in every language's words and tell nothing
            found = [v for i in range(len(marked) - n + 1) if (v := get(marked[i:i + n]))]
            if found:
                return tuple(sum(x) / len(found) for x in zip(*found))
        return (0.0,) * len(self.languages)

    def _scores(self, piece: str) -> tuple[float, ...]:
        words = _LETTERS.findall(piece)
        scored = [self.word(w) for w in words]
        return (*(map(sum, zip(*scored)) if words else (0.0,) * len(self.languages)), float(len(words)))

    def _sum(self, pieces: list[str], times: list[int]) -> np.ndarray:
        if not len(self.rows):
            self.rows = np.zeros((_MEMO, len(self.languages) + 1))
        if len(self.memo) + len(pieces) > _MEMO:
            self.memo.clear()
        at, memo, total = list(map(self.memo.get, pieces)), self.memo, np.zeros(len(self.languages) + 1)
        if None in at:
            for i, row in enumerate(at):
                if row is not None:
                    continue
                if len(pieces[i]) > 64:  # not worth remembering
                    total += np.array(self._scores(pieces[i])) * times[i]
                    at[i], times[i] = 0, 0
                else:
                    at[i] = memo[pieces[i]] = len(memo)
                    self.rows[at[i]] = self._scores(pieces[i])
        return total + np.array(times, float) @ self.rows[at]

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        seen = Counter(text.lower().split())
        pieces, times = list(seen), list(seen.values())
        total = sum((self._sum(pieces[i:i + _MEMO // 4], times[i:i + _MEMO // 4])
                     for i in range(0, len(pieces), _MEMO // 4)), np.zeros(len(self.languages) + 1))
        count, sums = total[-1], total[:-1]
        if not count:
            return UNKNOWN, 0.0
        best = int(np.argmax(sums))
        rest = (sums - sums[best]) * (min(count, EVIDENCE_WORDS) / count)
        return self.languages[best], float(1.0 / np.exp(rest).sum())


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train_docs: int = 20_000, max_words: int = 100_000, max_grams: int = 100_000) -> BackoffModel:
    """Fit the model on the rows with a label; NULL labels and NULL ids are left out."""
    ship(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    step = 1 << 20
    sizes = rows.groupBy(lang_col).count().collect()  # one row per language
    share = {lang: -(-max_train_docs * step // n) for lang, n in sizes if n > max_train_docs}
    keep = F.lit(step)
    if share:
        pairs = [F.lit(x) for pair in share.items() for x in pair]
        keep = F.coalesce(F.element_at(F.create_map(*pairs), F.col(lang_col)), keep)
    sample = rows.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)), F.lit(step)) < keep)
    counts = (sample.select(F.col(lang_col), F.col(text_col)).mapInArrow(
        _count, "lang string, kind string, item string, n long").groupBy("kind", "item", "lang")
        .agg(F.sum("n").alias("n")))
    per_item = counts.groupBy("kind", "item").agg(F.sum("n").alias("n"), F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    per_item = pin(per_item, "language-counts")
    tables = []
    for kind, most in (("w", max_words), ("g", max_grams)):
        here = per_item.filter(F.col("kind") == kind)
        top = here.orderBy(F.desc("n"), "item").limit(most).select("item")
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("m"), "item"))
        own = (here.select("item", F.explode("by_lang").alias("lang", "m")).withColumn("place", place)
               .filter(F.col("place") <= max(LEAST, most // max(1, len(sizes)))).select("item"))
        found = here.join(top.unionAll(own).distinct(), "item").select("item", "by_lang").toArrow()
        tables.append({k: dict(by) for k, by in zip(*(c.to_pylist() for c in found.columns))})
    languages = sorted({x for t in tables for by in t.values() for x in by})
    vectors = [{k: np.array([by.get(x, 0) for x in languages], float) for k, by in t.items()} for t in tables]
    totals = tuple(sum(t.values(), np.zeros(len(languages))) for t in vectors)
    return BackoffModel(languages, *vectors, totals)


def predictor(spark, model: BackoffModel):
    """A column function ``text -> struct<lang_pred string, score double>`` over a broadcast model."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            found = [shared.value.predict(x) for x in strings(t)]
            yield pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"])

    return predict


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       **bounds: int) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    Learned from the labelled rows that are not held out; the prediction
    itself sees the text alone.
    """
    spark = docs.sparkSession
    model = train(docs.filter(~held_out(id_col)), id_col, text_col, lang_col, **bounds)
    predict = predictor(spark, model)
    out = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"),
                      predict(F.col(text_col)).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")
