"""Language identification: known words first, then ever shorter character runs.

The model holds log frequencies per language of the commonest words and of
character runs of 5 down to 1 letters (a word's edges count as a character). A
known word scores by its own frequencies. An unseen word is read from left to
right: at each place the longest known run scores, shorter ones only where no
longer one is known. A text goes to the language with the highest sum.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load, sample_ids, unused

#: The model learns from at most so many documents of each language, first by digest
#: of their id, and from so many words of each of them, by a hash of their place in the
#: text, as long as these come to at most LETTERS_EACH letters. It keeps at most so many words, and runs of each length, per language. Predictions read whole texts.
TRAIN_DOCS, TRAIN_WORDS, MOST_WORDS, MOST_RUNS = 2000, 400, 20_000, 20_000
LETTERS_EACH = 12 * TRAIN_WORDS
#: … and from so many documents over all languages, however many those are (but one of each).
TRAIN_TOTAL = 20_000
#: … and so many in all languages together (but one of each).
MOST_ENTRIES = 100_000
LONGEST_RUN = 5
#: A word counts as known from so many training documents of any language on.
KNOWN_FROM = 2
FOLDS, HELD_OUT = 3, 1
NONE = "und"
#: Unseen words, of at most so many letters, and windows of letters of which a task remembers
#: the rows; this saves time and changes no score.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 40

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case; number signs such as ² alone are no word."""
    found = LETTERS.findall(text.lower()) if text else []
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def runs_of(word: str, n: int) -> list[str]:
    """Character runs of length n, edges included (a run of one never is an edge)."""
    if n == 1:
        return list(word)
    edged = f" {word} "
    return [edged[i:i + n] for i in range(len(edged) - n + 1)]


def words_from_all_over(text: str | None) -> str | None:
    """A short text as it is; of a longer one TRAIN_WORDS words in their order. A word
    that does not fit in the letters left is passed over."""
    if text is None or len(text) <= LETTERS_EACH and len(words_of(text)) <= TRAIN_WORDS:
        return text
    found = words_of(text)
    places = np.arange(1, len(found) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    places = (places ^ (places >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    chosen, left = [], LETTERS_EACH
    for k in np.argsort(places ^ (places >> np.uint64(32)), kind="stable").tolist():
        if len(chosen) == TRAIN_WORDS:
            break
        if len(found[k]) <= left:
            chosen.append(k)
            left -= len(found[k])
    return " ".join(found[k] for k in sorted(chosen))


class Model:
    """Log frequencies per language, smoothed by one count.

    A table gives a row to each entry. The row holds the languages that know the entry and
    their gains, log(count + 1), over what the language gives to an entry that it has not met
    (``bases``); so the size follows what was read, not entries times languages. Behind the
    languages' numbers, one for each table stands for its bases. Rows of all tables lie one
    after the other in ``numbers`` and ``values``.
    """

    def __init__(self, samples: list[tuple[str, str]]):
        self.languages = sorted({lang for _, lang in samples})
        words = {lang: Counter() for lang in self.languages}
        texts: Counter = Counter()
        most = max(1, MOST_ENTRIES // max(len(self.languages), 1))
        for text, lang in samples:
            found = words_of(text)[:TRAIN_WORDS]
            words[lang].update(found)
            texts.update(set(found))
        runs = [{lang: Counter() for lang in self.languages} for _ in range(LONGEST_RUN)]
        for lang in self.languages:
            for word, n in words[lang].items():
                for k in range(LONGEST_RUN):
                    for run in runs_of(word, k + 1):
                        runs[k][lang][run] += n
        known = {w for lang in self.languages for w in self._most(words[lang], min(MOST_WORDS, most)) if texts[w] >= KNOWN_FROM}
        self.bases: list[np.ndarray] = []
        starts, numbers, values = [0], [], []
        self.words = self._table(words, known, starts, numbers, values)
        self.runs = [
            self._table(r, {x for lang in self.languages for x in self._most(r[lang], min(MOST_RUNS, most))}, starts, numbers, values)
            for r in runs
        ]
        self.starts, self.numbers, self.values = np.array(starts), np.array(numbers, dtype=np.int32), np.array(values)
        self.unseen: dict[str, list[int]] = {}
        self.windows: dict[str, int | None] = {}

    @staticmethod
    def _most(counts: Counter, n: int) -> list[str]:
        return sorted(counts, key=lambda x: (-counts[x], x))[:n]

    def _table(self, counts: dict[str, Counter], kept: set[str], starts: list, numbers: list, values: list) -> dict[str, int]:
        """Entry -> row; the rows, gains and a 1 for the bases of this table, are appended."""
        own = len(self.languages) + len(self.bases)
        self.bases.append(np.array([-math.log(sum(counts[lang].values()) + len(kept) + 1) for lang in self.languages]))
        at, gains = {x: [] for x in kept}, {x: [] for x in kept}
        for k, lang in enumerate(self.languages):
            for x, n in counts[lang].items():
                if x in kept:
                    at[x].append(k)
                    gains[x].append(math.log(n + 1))
        table = {}
        for x in sorted(kept):
            table[x] = len(starts) - 1
            numbers += [*at[x], own]
            values += [*gains[x], 1.0]
            starts.append(len(numbers))
        return table

    def _longest(self, window: str) -> int | None:
        """The row of the longest known run at the start of a window."""
        for n in range(len(window), 0, -1):
            row = self.runs[n - 1].get(window[:n])
            if row is not None:
                return row
        return None

    def _places(self, word: str) -> list[int]:
        """The rows that an unseen word is read by, one per place where any run is known."""
        edged = f" {word} "
        found = [self._longest(edged[at:at + LONGEST_RUN]) for at in range(len(edged))]
        return [row for row in found if row is not None]

    def _remembered(self, word: str) -> list[int]:
        """``_places``, by way of the words and windows met before."""
        found = self.unseen.get(word)
        if found is not None:
            return found
        windows, edged, found = self.windows, f" {word} ", []
        for at in range(len(edged)):
            window = edged[at:at + LONGEST_RUN]
            try:
                row = windows[window]
            except KeyError:
                if len(windows) >= REMEMBERED:
                    windows.clear()
                row = windows[window] = self._longest(window)
            if row is not None:
                found.append(row)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self.unseen) >= REMEMBERED:
                self.unseen.clear()
            self.unseen[word] = found
        return found

    def _sums(self, rows: list[int], weights: list[float]) -> np.ndarray:
        """A number per language: the rows by their weights, and what their tables' bases give."""
        rows = np.array(rows, dtype=np.int64)
        sizes = self.starts[rows + 1] - self.starts[rows]
        before = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.starts[rows] - before, sizes)
        sums = np.bincount(
            self.numbers[at], np.repeat(np.array(weights, dtype=float), sizes) * self.values[at], len(self.languages) + len(self.bases))
        out = sums[:len(self.languages)]
        for weight, base in zip(sums[len(out):], self.bases, strict=True):
            out = out + weight * base
        return out

    def score_unseen(self, word: str) -> list[float]:
        """The mean over the places of a word, each by the longest run known there."""
        found = self._places(word)
        return self._sums(found, [1 / len(found)] * len(found) if found else []).tolist()

    def score(self, word: str) -> list[float]:
        row = self.words.get(word)
        return self.score_unseen(word) if row is None else self._sums([row], [1.0]).tolist()

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its share of the likelihood (per word, so long texts keep a scale)."""
        counts = Counter(words_of(text))
        if not counts or not self.languages:
            return NONE, 0.0
        rows, weights, known = [], [], self.words.get
        for word, n in counts.items():
            row = known(word)
            if row is not None:
                rows.append(row)
                weights.append(n)
            elif found := self._remembered(word):
                rows += found
                weights += [n / len(found)] * len(found)
        sums = self._sums(rows, weights)
        best = int(sums.argmax())  # of equal ones the first
        # A text of few words is less certain than a long one: up to ten words count in full.
        scale = min(counts.total(), 10) / counts.total()
        return self.languages[best], float(1 / np.exp((sums - sums[best]) * scale).sum())


def training_rows(docs: DataFrame) -> DataFrame:
    """The bounded sample (text, lang): words from all over the chosen documents' texts.

    Never a held-out row, a null language or a null id; nor an id with several
    languages. Of an id's texts the least is taken, by the words chosen. Texts are fetched
    for the chosen ids alone.
    """

    @F.pandas_udf("string")
    def choose(texts: pd.Series) -> pd.Series:
        return pd.Series([words_from_all_over(t) for t in texts], dtype="object")

    usable = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != HELD_OUT)
    languages = usable.where("lang IS NOT NULL").select("lang").distinct().count()
    ids = sample_ids(usable, "lang", max(1, min(TRAIN_DOCS, TRAIN_TOTAL // max(languages, 1))))
    if languages <= TRAIN_TOTAL:  # so at most that many ids
        ids = F.broadcast(ids)
    return (
        usable.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "lang", choose("text").alias("text"))
        .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).where("text IS NOT NULL")
    )


def fit(docs: DataFrame) -> bytes:
    """A model as bytes, its size bounded by languages and kept entries."""
    return pickle.dumps(Model([(r["text"], r["lang"]) for r in training_rows(docs).collect()]), protocol=5)


@lru_cache(maxsize=1)
def _model(crc: int, value) -> Model:
    return pickle.loads(value)


def with_language(docs: DataFrame, model: bytes) -> DataFrame:
    """Adds lang_pred and score, in place of columns of these names; reads whole texts and
    nothing else.

    A null text, or one without a letter, is ``und`` with score 0, and so is every
    text if no language was learned. Ties go to the first language by name. Equal
    texts get equal results; other columns pass through.
    """
    shared, crc = docs.sparkSession.sparkContext.broadcast(model), zlib.crc32(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(crc, shared.value)
        for batch in batches:
            yield pd.DataFrame([model.predict(t) for t in batch], columns=["lang_pred", "score"])

    found = unused(docs.columns, "found")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*kept, predict("text").alias(found)).select(*kept, f"{found}.lang_pred", f"{found}.score")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents, by a model that never saw the held-out ids."""
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = with_language(docs.select("doc_id", "text"), fit(docs))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
