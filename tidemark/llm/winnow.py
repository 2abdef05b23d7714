"""Document fingerprints by winnowing.

A text's words give rolling 4-gram hashes, made by joining the hashes of shorter
grams; of every 4 consecutive ones the least is chosen, of equal ones the
rightmost, and kept with its place. Two texts that share 7 words in a row share a
chosen hash (window + gram - 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import load, written

GRAM, WINDOW = 4, 4
#: A chosen gram as one long: 39 bits of hash above 24 bits that fall with its place.
PLACE_BITS = 24
_PLACES = 1 << PLACE_BITS
BLANKS = "[\\x20\\x09-\\x0D]+"


def _part(array: str, start: int, length: Column) -> Column:
    return F.slice(array, F.lit(start + 1), F.greatest(length, F.lit(0)))


def _rolled(rows: DataFrame, array: str, size: Column, width: int, join) -> DataFrame:
    """Replaces an array by the joins of its windows of ``width`` (a power of two), made
    from the joins of half as wide ones."""
    have = 1
    while have < width:
        rows = rows.withColumn(array, F.zip_with(_part(array, 0, size - (2 * have - 1)), _part(array, have, size - (2 * have - 1)), join))
        have *= 2
    if have != width:
        raise ValueError("gram and window must be powers of two")
    return rows


def with_chosen(rows: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Adds ``out``: the chosen grams of a text, packed, in order of their places.

    A text of fewer words than a gram has one gram, all its words; one of fewer
    grams than a window is one window. Null and texts without words choose none.
    Words are taken as they are. Places count modulo 2^24. Every step is a column of
    its own: an expression inside another's function would be made for each element.
    """
    w, g, m = f"__{out}_words", f"__{out}_grams", f"__{out}_least"
    n = F.size(w)
    rows = rows.withColumn(w, F.split(F.coalesce(F.col(text), F.lit("")), BLANKS)).withColumn(w, F.filter(w, lambda x: x != ""))
    rows = _rolled(rows.withColumn(g, F.transform(w, lambda x: F.xxhash64(x))), g, n, gram, lambda a, b: F.xxhash64(a, b))
    rows = rows.withColumn(g, F.when(n >= gram, F.col(g)).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn(g, F.transform(
        g, lambda h, i: F.shiftrightunsigned(h, PLACE_BITS + 1) * _PLACES + (_PLACES - 1 - i % _PLACES)
    ))
    size = F.size(g)
    rows = _rolled(rows.withColumn(m, F.col(g)), m, size, window, lambda a, b: F.least(a, b))
    least = F.when(size >= window, F.col(m)).when(size > 0, F.array(F.array_min(g))).otherwise(F.col(g))
    return rows.withColumn(out, F.array_distinct(least)).drop(w, g, m)


def marks(packed: Column) -> Column:
    """Chosen grams as (hash, place)."""
    return F.transform(packed, lambda p: F.struct(
        F.shiftright(p, PLACE_BITS).alias("hash"), (_PLACES - 1 - p.bitwiseAND(_PLACES - 1)).alias("place")
    ))


def digest(packed: Column) -> Column:
    """128 bits of the chosen hashes and places, in hexadecimal digits."""
    half = lambda *x: F.lpad(F.lower(F.hex(F.xxhash64(*x))), 16, "0")
    return F.concat(half(packed), half(F.lit(1), packed))


def hashes(packed: Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda p: F.shiftright(p, PLACE_BITS)))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct hashes that both have; 1 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text) with ``marks``, the chosen (hash, place) pairs, in
    place of a column of that name."""
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "marks"]).alias("row"))
    return with_chosen(rows, "text", "marks").select("row.*", marks(F.col("marks")).alias("marks"))


def with_following(docs: DataFrame) -> DataFrame:
    """Adds ``following``: the text of the next row by id (null last), then by a hash of
    the text; the last row is followed by the first.

    The texts are sorted over all tasks into ranges and written; the next row is
    looked up within a range, and for its last row among the first rows of the
    ranges. Only those, one per range, are ever ordered in one place. Equal rows are
    told apart by where they were read, so that a range can end between them.
    """
    # Spark samples the sort keys to set the ranges; no texts are among them.
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    ranged = docs.select("doc_id", "text").orderBy(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged, "ordered", "zstd").withColumn("range", F.shiftright("at", 33))
    by_range = Window.orderBy("range")
    firsts = ranged.where(F.col("at").bitwiseAND((1 << 33) - 1) == 0).select("range", "text")
    edges = firsts.select(F.col("range").alias("__range"), F.coalesce(
        F.lead("text").over(by_range), F.first("text").over(by_range.rowsBetween(Window.unboundedPreceding, 0))
    ).alias("__edge"))
    inside = ranged.withColumn("following", F.lead("text").over(Window.partitionBy("range").orderBy("at")))
    # Both sides lie by range already, so the texts are not moved again.
    return inside.join(edges.hint("merge"), F.col("range") == F.col("__range")).select(
        "doc_id", "text", F.coalesce("following", "__edge").alias("following")
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as much of the next one's start."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Per document: n_chars, edited_sha256, both fingerprints, and their likenesses.

    ``docs`` has doc_id and text; nothing else is read. A null text is empty. Rows
    with an equal id follow one another by a hash of their texts, equal rows too. Null
    ids come last. A row that is alone follows itself. Equal texts have equal fingerprints.
    """
    pairs = with_following(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("following")))
    for c in ("text", "following", "edited"):
        pairs = with_chosen(pairs, c, f"{c}_marks").withColumn(f"{c}_hashes", hashes(F.col(f"{c}_marks")))
    own = F.col("text_hashes")
    return pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        digest(F.col("text_marks")).alias("fingerprint"), digest(F.col("edited_marks")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_hashes")).alias("near_edited"), likeness(own, F.col("following_hashes")).alias("near_next"),
    )


def op9_winnowing(spark, sf_dir: str) -> DataFrame:
    """All documents, held against their edited texts and their successors."""
    return compare_edits(load(spark, sf_dir, "documents", "doc_id", "text"))
