"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects a document whose measure lies beyond a cutoff. A path of sets of
cutoffs, one for each rule, is fixed beforehand; every step makes one cutoff stricter, so
each set rejects all that the one before rejects. For every stratum (language) the
labelled good documents that a set rejects by any rule are counted, and sets are tested
along the path: one is certified if the exact binomial upper bound of that share is
within the limit, and the first that is not ends the path. Tests in a fixed order of
which each needs the one before share no chance among them, so the chance of an error is
shared among the strata alone (Bonferroni). Of the certified sets the one that best tells
bad from good is used; without one, nothing is rejected in that stratum. So, with the
stated confidence, no stratum loses more than the limit of its good documents to all
rules together.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, load, unused, written

#: Share of good documents that a stratum may lose to all rules, and the chance that
#: any stratum loses more.
LIMIT, MISS = 0.05, 0.05
#: (name, numerator, denominator, direction, cutoffs): rejects what lies above (1) or below
#: (-1). Cutoffs go from lenient to strict.
RULES = (
    ("symbols", "n_symbols", "word_chars", 1, (0.2, 0.12, 0.08, 0.05, 0.03, 0.02, 0.01, 0.005)),
    ("dup_lines", "n_dup_lines", "n_words", 1, (0.1, 0.05, 0.03, 0.02, 0.01, 0.005, 0.002)),
    ("repeats", "n_repeat_words", "n_words", 1, (0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01)),
    ("long_words", "word_chars", "n_words", 1, (16.0, 12.0, 10.0, 9.0, 8.0, 7.0, 6.0)),
    ("short_words", "word_chars", "n_words", -1, (2.0, 2.5, 3.0, 3.5, 4.0)),
)
#: (rule, cutoff) in the order in which they come into force: the most lenient of each rule,
#: then the next of each, and so on.
PATH = [(n, k) for k in range(max(len(r[4]) for r in RULES)) for n, r in enumerate(RULES) if k < len(r[4])]
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 5

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at ASCII white space only
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(*(words[k:] for k in range(WINDOW)), strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        at = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, len(windows)))
        covered = np.zeros(len(words), bool)
        for k in range(WINDOW):
            covered[at + k] = True
        repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def with_measures(docs: DataFrame) -> DataFrame:
    """Adds the five measures and base_failed, in place of columns of these names; a null
    text has no words."""

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([measures(t) for t in batch], columns=[c.split()[0] for c in MEASURES.split(", ")])

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    names, m = [c.split()[0] for c in MEASURES.split(", ")], unused(docs.columns, "m")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*names, "base_failed")]
    return docs.select(*kept, measured("text").alias(m)).select(*kept, f"{m}.*").withColumn("base_failed", failed)


# ---- exact binomial bounds --------------------------------------------------------

def _continued(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    out = d
    for m in range(1, 10_000_000):
        step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d, c = 1 / (1 + step * d or tiny), 1 + step / c or tiny
        out *= c * d
        step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d, c = 1 / (1 + step * d or tiny), 1 + step / c or tiny
        out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return out


def at_most(k: int, n: int, p: float) -> float:
    """Chance of k or fewer in n tries of chance p, as an incomplete beta function."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return front * _continued(a, b, x) / a
    return 1 - front * _continued(b, a, p) / b


def certified(rejected: int, good: int, limit: float, chance: float) -> bool:
    """Whether the exact upper bound (of confidence 1 - chance) of the share is within the limit."""
    return good > 0 and at_most(rejected, good, limit) <= chance


# ---- cutoffs ----------------------------------------------------------------------

def in_force(step: int | None) -> list[float | None]:
    """The cutoff of each rule after a step of the path, None before its first."""
    found: list[float | None] = [None] * len(RULES)
    for n, k in PATH[: 0 if step is None else step + 1]:
        found[n] = RULES[n][4][k]
    return found


def first_step() -> Column:
    """The step of the path from which on a measured document is rejected; their number if never."""
    firsts = []
    for n, (_, over, under, way, cutoffs_) in enumerate(RULES):
        ratio = F.col(over) / F.when(F.col(under) > 0, F.col(under))
        case = F.lit(len(PATH))
        for k in reversed(range(len(cutoffs_))):
            beyond = ratio > F.lit(cutoffs_[k]) if way > 0 else ratio < F.lit(cutoffs_[k])
            case = F.when(beyond, F.lit(PATH.index((n, k)))).otherwise(case)
        firsts.append(case)
    return F.least(*firsts)


def best_step(good: list[int], bad: list[int], limit: float, chance: float) -> int | None:
    """Of the certified steps the one that best tells bad from good, the most lenient of equals.

    ``good`` and ``bad`` count the labelled documents by their first step, never included.
    """
    all_good, all_bad, best, pick = sum(good), sum(bad), 0.0, None
    for step in range(len(PATH)):
        rejected = sum(good[: step + 1])
        if not certified(rejected, all_good, limit, chance):
            break
        gain = sum(bad[: step + 1]) / max(all_bad, 1) - rejected / all_good
        if gain > best:
            best, pick = gain, step
    return pick


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, limit: float = LIMIT, miss: float = MISS) -> DataFrame:
    """A row per stratum: the cutoff of each rule in force, null where there is none.

    ``labels`` has doc_id and quality (1 good, 0 bad); ids with both, and nulls, do
    not count. Documents that fail the base do not count either. Counts are made
    before the shuffle, so a large stratum costs no more than a small one.
    """
    agreed = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
        .agg(F.min("quality").alias("__q"), F.max("quality").alias("__most")).where("__q = __most")
        .select(F.col("doc_id").alias("__labelled"), "__q")
    )
    holdout = measured.where("NOT base_failed").join(agreed, F.col("doc_id") == F.col("__labelled"))
    steps = range(len(PATH) + 1)
    counts = [F.count_if((F.col("__first") == k) & (F.col("__q") == y)).alias(f"n_{k}_{y}") for k in steps for y in (0, 1)]
    table = written(holdout.select(F.col(stratum).alias("stratum"), "__q", first_step().alias("__first")).groupBy("stratum").agg(*counts), "holdout")
    strata, names = table.count(), [r[0] for r in RULES]

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                bad, good = ([r[f"n_{k}_{y}"] for k in steps] for y in (0, 1))
                rows.append([r["stratum"], *in_force(best_step(good, bad, limit, miss / strata))])
            yield pd.DataFrame(rows, columns=[stratum, *names]).astype({n: "float64" for n in names})

    kind = measured.schema[stratum].dataType.simpleString()
    return table.mapInPandas(choose, f"`{stratum}` {kind}, " + ", ".join(f"{n} double" for n in names))


def with_verdict(measured: DataFrame, chosen: DataFrame, stratum: str) -> DataFrame:
    """Adds kept: false if the base failed or a rule's cutoff of the stratum rejects."""
    names = [r[0] for r in RULES]
    renamed = chosen.select(stratum, *[F.col(n).alias(f"__{n}") for n in names])
    rejected = []
    for name, over, under, way, _ in RULES:
        ratio = F.col(over) / F.when(F.col(under) > 0, F.col(under))
        rejected.append(F.coalesce(ratio > F.col(f"__{name}") if way > 0 else ratio < F.col(f"__{name}"), F.lit(False)))
    rows = attach(measured, renamed, stratum)
    kept = ~F.col("base_failed") & ~reduce(lambda a, b: a | b, rejected)
    return rows.withColumn("kept", kept).drop(*[f"__{n}" for n in names])


def quality_rules(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, miss: float = MISS) -> DataFrame:
    """Each document (doc_id, text, lang) with its measures, base_failed and kept.

    Null and empty texts have no words and fail the base. A null language is a
    stratum of its own. Equal rows are judged alike; each counts as a labelled
    document. Without labels, only the base rejects. Other columns are not read.
    """
    measured = written(with_measures(docs.select("doc_id", "text", "lang")).drop("text"), "measures")
    return with_verdict(measured, cutoffs(measured, labels, "lang", limit, miss), "lang").drop("lang")


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents, judged by cutoffs certified per language."""
    return quality_rules(
        load(spark, sf_dir, "documents", "doc_id", "text", "lang"), load(spark, sf_dir, "labels", "doc_id", "quality")
    )


def _oracle() -> str:
    grid = ", ".join(f"('{RULES[n][0]}', {RULES[n][3]}, {step}, {RULES[n][4][k]})" for step, (n, k) in enumerate(PATH))
    ratio = " UNION ALL ".join(
        f"SELECT doc_id, lang, '{name}' AS rule, {over}::DOUBLE / nullif({under}, 0) AS ratio FROM base WHERE NOT base_failed"
        for name, over, under, _, _ in RULES
    )
    return rf"""
WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), tokens AS (
  SELECT doc_id, text, lang, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM tokens WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT g.doc_id, g.i, unnest(range(0, 5)) AS k FROM grams g JOIN twice USING (doc_id, gram)) GROUP BY doc_id
), base AS (
  SELECT t.doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(w) < 10 OR 100 * coalesce(covered.n, 0) > 20 * len(w) AS base_failed
  FROM tokens t LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
), ratios AS (
  {ratio}
), grid(rule, way, step, cutoff) AS (VALUES {grid}
), firsts AS (
  SELECT doc_id, lang, min(step) AS first FROM ratios JOIN grid USING (rule)
  WHERE CASE way WHEN 1 THEN ratio > cutoff ELSE ratio < cutoff END GROUP BY ALL
), labelled AS (
  SELECT doc_id, min(quality) AS q FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)
), holdout AS (
  SELECT b.lang, q, coalesce(first, {len(PATH)}) AS first
  FROM base b JOIN labelled USING (doc_id) LEFT JOIN firsts USING (doc_id) WHERE NOT base_failed
), counted AS (
  SELECT lang, step, sum(q) AS good, sum(1 - q) AS bad,
    coalesce(sum(q) FILTER (first <= step), 0) AS good_out, coalesce(sum(1 - q) FILTER (first <= step), 0) AS bad_out
  FROM holdout, (SELECT step FROM grid) GROUP BY ALL
), tested AS (
  SELECT *, bad_out / greatest(bad, 1) - good_out / greatest(good, 1) AS gain,
    CASE WHEN good_out >= good THEN 1 ELSE list_sum([
      exp(lgamma(good + 1) - CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END - lgamma(good - i + 1)
        + i * ln({LIMIT}) + (good - i) * ln({1 - LIMIT}))
      FOR i IN range(0, good_out::BIGINT + 1)]) END AS chance
  FROM counted
), certified AS (
  SELECT *, bool_and(chance <= {MISS} / (SELECT count(DISTINCT coalesce(lang, chr(0))) FROM tested))
    OVER (PARTITION BY lang ORDER BY step) AS so_far FROM tested
), chosen AS (
  SELECT lang, arg_max(step, (gain, -step)) AS step FROM certified WHERE so_far AND gain > 0 GROUP BY lang
), rejected AS (
  SELECT doc_id FROM firsts f JOIN chosen c ON f.lang IS NOT DISTINCT FROM c.lang WHERE first <= step
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM base
"""


ORACLE_OP3 = _oracle()
