"""Line dedup within one edit of a word, by a join of deletion neighbourhoods.

Lines are compared as their words in lower case. Two lines are alike if they are
equal, or if both have at least five words and one word is changed, added or left
out. A line goes if an alike one stands earlier: in a lower id, or further up.

Each line's variants are itself and itself less one word. A variant is keyed by the
place where a word may be missing and by hashes of the words before and after it,
so all lines that meet in a key are within one edit of each other. Each is held
against the earliest of its key, word by word. Only lines that share their first or
last half with a different line can have such a neighbour, so only they emit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import load, written

#: Fewer words than this are only compared for equality: one word in five is 0.8.
MIN_WORDS = 5
#: Words that are hashed together first, so that a key of a long line costs no more than one of a short.
CHUNK = 64
BLANKS, SOME = "[\\x20\\x09-\\x0D]+", "[^\\x20\\x09-\\x0D]"


def line_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), BLANKS), lambda w: w != "")


def with_heads(lines: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds what ``_head`` needs: an array's chunks, and a hash of all chunks before each."""
    last = F.floor(F.size(hashes) / CHUNK).cast("int")
    lines = lines.withColumn(f"{out}_chunks", F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(hashes, c * CHUNK + 1, CHUNK)))
    lines = lines.withColumn(f"{out}_sums", F.transform(f"{out}_chunks", lambda c: F.xxhash64(c)))
    return lines.withColumn(f"{out}_before", F.transform(f"{out}_sums", lambda _, c: F.xxhash64(F.slice(f"{out}_sums", F.lit(1), c)))).drop(f"{out}_sums")


def _head(out: str, n: Column) -> Column:
    """Hash of the first n elements: of the whole chunks before, and of the rest."""
    chunk = F.floor(n / CHUNK).cast("int")
    return F.xxhash64(F.get(F.col(f"{out}_before"), chunk), F.slice(F.get(F.col(f"{out}_chunks"), chunk), F.lit(1), n % CHUNK))


def line_table(docs: DataFrame) -> DataFrame:
    """A row per line with a word: doc_id, text_hash, pos, words."""
    # The outer form, since Spark checks what it explodes to be non-empty by making it twice.
    lines = docs.select("doc_id", "text_hash", F.posexplode_outer(F.split("text", "\n")).alias("pos", "line"))
    return lines.where(F.col("line").rlike(SOME)).withColumn("words", line_words(F.col("line"))).drop("line")


def distinct_lines(lines: DataFrame) -> DataFrame:
    """Each line once: 128 bits of hash, where it first stands, and hashes of its halves.

    Two lines with one edit between them agree in a first or a last part of
    floor(n / 2) or floor((n - 1) / 2) words, n being the number of words of either.
    """
    n = F.size("words")
    halves = {}
    for name, m in (("a", F.floor(n / 2).cast("int")), ("b", F.floor((n - 1) / 2).cast("int"))):
        new = (n >= MIN_WORDS) & ((n % 2 == 0) if name == "b" else F.lit(True))
        halves[f"first_{name}"] = F.when(new, F.xxhash64(F.lit(1), m, F.slice("words", 1, m)))
        halves[f"last_{name}"] = F.when(new, F.xxhash64(F.lit(2), m, F.slice("words", n - m + 1, m)))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "pos")
    return (
        lines.select(
            F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(3), "words").alias("h2"), place.alias("place"),
            *[c.alias(k) for k, c in halves.items()],
        )
        .groupBy("h1", "h2").agg(F.min("place").alias("first"), *[F.min(k).alias(k) for k in halves])
    )


def candidates(table: DataFrame) -> DataFrame:
    """Distinct lines that share a half with a different line: h1, h2, first, and which half."""
    names = ("first_a", "first_b", "last_a", "last_b")
    keyed = table.select("h1", "h2", "first", F.explode(F.array(
        *[F.struct(F.col(k).alias("key"), F.lit(k.startswith("first")).alias("front")) for k in names]
    )).alias("k")).select("h1", "h2", "first", "k.key", "k.front").where("key IS NOT NULL")
    shared = keyed.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi")).where("lo != hi").select("key")
    return (
        keyed.join(shared, "key", "left_semi").groupBy("h1", "h2")
        .agg(F.min("first").alias("first"), F.max("front").alias("front"), F.min("front").alias("only_front"))
        .select("h1", "h2", "first", "front", (~F.col("only_front")).alias("back"))
    )


def with_variants(lines: DataFrame) -> DataFrame:
    """Adds ``keys`` to words, front, back: for each place in reach, the key of the line
    less the word there, and that of the line itself.

    In reach are the places behind the shared first half or before the shared last
    one. Word hashes and chunks are columns of their own, so that they are made
    once per line and not once per key.
    """
    n = F.size("words")
    lines = lines.withColumn("ahead", F.transform("words", lambda w: F.xxhash64(w))).withColumn("behind", F.reverse("ahead"))
    lines = with_heads(with_heads(lines, "ahead", "ahead"), "behind", "behind")
    half = F.floor((n - 1) / 2).cast("int")

    def keys(places: Column, less: int) -> Column:
        rest = n - less
        reach = F.filter(places, lambda i: (F.col("front") & (i >= half)) | (F.col("back") & (i <= rest - half)))
        return F.transform(reach, lambda i: F.xxhash64(
            i, rest, _head("ahead", i), _head("behind", rest - i)
        ))

    lines = lines.withColumn("keys", F.concat(keys(F.sequence(F.lit(0), n - 1), 1), keys(F.sequence(F.lit(0), n), 0)))
    return lines.drop("ahead", "behind", *[f"{d}_{x}" for d in ("ahead", "behind") for x in ("chunks", "before")])


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two different arrays are a change, an addition or an omission of one element apart."""
    same = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    at = F.when(same > 0, same).otherwise(F.least(F.size(a), F.size(b)) + 1).cast("int")  # first that differs, from 1
    rest = lambda x, i: F.slice(x, i, F.size(x))
    return (
        F.when(F.size(a) == F.size(b), rest(a, at + 1) == rest(b, at + 1))
        .when(F.size(a) == F.size(b) + 1, rest(a, at + 1) == rest(b, at))
        .when(F.size(a) + 1 == F.size(b), rest(a, at) == rest(b, at + 1))
        .otherwise(False)
    )


def near_lines(docs: DataFrame, table: DataFrame) -> DataFrame:
    """(h1, h2) of the distinct lines that have a different earlier line within one edit."""
    found = written(candidates(table), "candidates").select("h1", "h2", "first.*", "front", "back")
    at = found.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_list(F.struct("pos", "h1", "h2", "last", "front", "back")).alias("at")  # lines of one document
    )
    meet = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    # Rows equal in id and text are one document here.
    texts = docs.join(at, meet).withColumn("lines", F.split("text", "\n"))
    picked = texts.select("doc_id", "text_hash", F.explode_outer(
        F.transform("at", lambda x: x.withField("line", F.get(F.col("lines"), x["pos"])))
    ).alias("x")).select("doc_id", "text_hash", "x.*")
    ordered = (
        picked.dropDuplicates(["h1", "h2"]).withColumn("words", line_words(F.col("line")))
        .select("h1", "h2", "last", "doc_id", "text_hash", "pos", "words", "front", "back")
        .orderBy("last", "doc_id", "text_hash", "pos")
        .withColumn("rank", F.monotonically_increasing_id())  # grows in the order of the sort
    )
    lines = written(ordered.select("rank", "h1", "h2", "words", "front", "back"), "lines")
    # Here, too: a check for empty keys would be pushed down with all their steps inside.
    keyed = with_variants(lines).select("rank", F.explode_outer("keys").alias("key")).where("key IS NOT NULL")
    earliest = keyed.groupBy("key").agg(F.min("rank").alias("earliest"), F.max("rank").alias("latest"))
    pairs = written(
        keyed.join(earliest.where("earliest < latest").select("key", "earliest"), "key")
        .where("rank > earliest").select("rank", "earliest").distinct(), "pairs",
    )
    other = lines.select(F.col("rank").alias("earliest"), F.col("words").alias("other"))
    checked = pairs.join(lines, "rank").join(other, "earliest").where(within_one_edit(F.col("words"), F.col("other")))
    return checked.select("h1", "h2").distinct()


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the text left, and n_lines and n_removed (lines with a word) added.

    A line without a word is not compared and stays, unless no other is left: then
    the text is empty. A null text stays null. Rows equal in id and text are one
    document and come out alike; rows equal only in id are ordered by a hash of their
    text. Null ids count as last. Other columns pass through, also those named like
    an added one, which comes in their place.
    """
    added = ("n_lines", "n_removed")
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text", F.struct("*").alias("row"))
    slim = rows.select("doc_id", "text_hash", "text")
    table = written(distinct_lines(line_table(slim)), "distinct-lines")
    near = written(near_lines(slim, table.where("first_a IS NOT NULL")), "near-lines")
    kept = (
        table.select("h1", "h2", "first.doc_id", "first.text_hash", "first.pos").join(near, ["h1", "h2"], "left_anti")
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.collect_list("pos").alias("kept"))
    )
    meet = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash"))
    lines = F.col("lines")
    blank = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(lines) - 1, F.lit(0))), lambda i: ~F.get(lines, i).rlike(SOME)
    )
    own = F.coalesce(F.col("kept"), F.array().cast("array<int>"))
    stays = F.transform(F.array_sort(F.array_union(own, F.col("blank"))), lambda i: F.get(lines, i))
    out = (
        rows.join(kept, meet, "left").withColumn("lines", F.split("text", "\n")).withColumn("blank", blank)
        .withColumn("n_lines", F.coalesce(F.size("lines") - F.size("blank"), F.lit(0)))
        .withColumn("n_removed", F.col("n_lines") - F.size(own))
        .withColumn("left", F.when(F.col("n_removed") == 0, F.col("text")).when(F.size(own) == 0, "").otherwise(F.array_join(stays, "\n")))
    )
    columns = [F.col("left").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return out.select(*columns, *added)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines that stood before, to within a word."""
    return dedup_lines(load(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE_OP4 = r"""
WITH lines AS (
  SELECT doc_id, i - 1 AS pos, l[i] AS line, regexp_extract_all(lower(l[i]), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
), once AS (
  SELECT w, len(w) AS n, min((doc_id, pos)) AS place FROM lines WHERE len(w) > 0 GROUP BY w
), less AS (
  SELECT w, n, place, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM once WHERE n >= 5)
), near AS (
  SELECT a.w FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.n = b.n WHERE b.place < a.place
  UNION SELECT a.w FROM less a JOIN once b ON a.v = array_to_string(b.w, ' ') AND b.n = a.n - 1 WHERE b.n >= 5 AND b.place < a.place
  UNION SELECT b.w FROM less a JOIN once b ON a.v = array_to_string(b.w, ' ') AND b.n = a.n - 1 WHERE b.n >= 5 AND a.place < b.place
), judged AS (
  SELECT l.*, len(l.w) = 0 OR ((l.doc_id, l.pos) = o.place AND l.w NOT IN (SELECT w FROM near)) AS stays
  FROM lines l LEFT JOIN once o ON l.w = o.w
), counted AS (
  SELECT doc_id, count(*) FILTER (len(w) > 0) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
    string_agg(line, chr(10) ORDER BY pos) FILTER (stays) AS left_text
  FROM judged GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_removed, 0)::INT AS n_removed,
  CASE WHEN coalesce(n_removed, 0) = 0 THEN text WHEN n_removed = n_lines THEN '' ELSE left_text END AS text
FROM documents d LEFT JOIN counted USING (doc_id)
"""
