"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream: its documents in a fixed shuffled order, repeated as
often as the mix needs, cut into blocks of equally many words. The golden-ratio
points x_j = frac(j * 0.618…), in whole numbers, are mapped through the cumulative shares of the
sources, so point j gives slot j to one source. The k-th slot of a source takes
the k-th block of its stream. A source is closed once its quota of blocks has
been placed; its last block stops at the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GROUP_ROWS, attach, with_start, word_count, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 4096
#: The golden ratio's fraction in parts of a period: two Fibonacci numbers (the 91st and the
#: 92nd), whose quotient's points are spread as those of the ratio itself for a whole period.
GOLDEN, PERIOD = 4660046610375530309, 7540113804746346429
#: Any interval of length 1/n is met by one of the first 2.62 n + 2 golden-ratio points.
ENOUGH_POINTS = 2.62
SEED = "mix-1"


def shuffle_key(doc_id: Column, size: Column) -> Column:
    """The shuffled order within a source: a digest of id and size."""
    key = F.concat_ws(":", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("-")), size.cast("string"))
    return F.md5(key.cast("binary"))


def targets(rows: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, total: int | None = None) -> DataFrame:
    """A row per source: source, sid, n, source_size, target, quota.

    Sources in order of their code points, null last, take ``weights`` in turn.
    The share of a source stops at ``max_repeats`` times its size; what is over
    is shared by weight among the rest until none is above: all others get
    weight times one level, and the level is the largest one that any number of
    stopped sources gives. ``total`` defaults to all words; beyond what
    ``max_repeats`` allows, every source stops. A source without words gets 0.
    """
    sums = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").cast("long").alias("source_size"))
    # One row per source from here on.
    named = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sums.withColumn("sid", F.row_number().over(named))
        .withColumn("weight", F.element_at(cycle, (F.col("sid") - 1) % len(weights) + 1))
        .withColumn("most", F.col("source_size") * max_repeats)
        .withColumn("budget", F.sum("source_size").over(everything) if total is None else F.lit(total))
    )
    ahead = Window.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("most").over(ahead), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    )
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("quota", F.floor(F.col("target") + 0.5).cast("long"))
        .select("source", "sid", "n", "source_size", "target", "quota")
    )


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Slots in order: slot, sid, block (the source's block that the slot takes).

    Slots that fall to a closed source are left out. A source that got fewer slots than
    it has blocks is an error, not a loss.
    """
    spark = sources.sparkSession
    wanted = sources.where("quota > 0").withColumn("blocks", F.ceil(F.col("quota") / block).cast("long"))
    n, kinds = wanted.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count(F.lit(1))).first()
    points = int(n * ENOUGH_POINTS) + 2 if n else 0
    # Points are parts of the period, and shares stretches of the n blocks: whole numbers, so
    # that no point is off, however many there are. Stretches are cut into cells so that
    # slots find their source by an equal join whose keys are evenly met.
    cells = max(1024, 4 * kinds)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    stretches = (
        wanted.withColumn("hi", F.sum("blocks").over(upto))
        .withColumn("lo", F.col("hi") - F.col("blocks"))
        .withColumn("cell", F.explode(F.sequence(F.expr(f"lo * {cells} div {max(n, 1)}"), F.expr(f"(hi - 1) * {cells} div {max(n, 1)}"))))
        .select("sid", "blocks", "lo", "hi", "cell")
    )
    x = f"(CAST(id AS DECIMAL(18)) * {GOLDEN}BD) % {PERIOD}BD"
    slots = (
        spark.range(1, points + 1)
        .select(F.col("id").alias("slot"), F.expr(f"CAST({x} AS DECIMAL(20)) * {max(n, 1)}BD div {PERIOD}BD").alias("unit"))
        .withColumn("cell", F.expr(f"unit * {cells} div {max(n, 1)}"))
        .join(stretches, "cell")
        .where((F.col("unit") >= F.col("lo")) & (F.col("unit") < F.col("hi")))
        .withColumn("stretch", F.floor(F.col("slot") / GROUP_ROWS))
        .withColumn("one", F.lit(1))
        .select("slot", "sid", "blocks", "stretch", "one")
    )
    ranked = with_start(slots, "sid", "stretch", [F.col("slot")], "one").where(F.col("start") < F.col("blocks"))
    found = written(ranked.select("slot", "sid", F.col("start").alias("block")), "slots")
    placed = found.groupBy("sid").agg(F.count(F.lit(1)).alias("placed"))  # a row per source
    short = wanted.join(placed, "sid", "left").where(F.coalesce("placed", F.lit(0)) != F.col("blocks")).select("source").first()
    if short:
        raise RuntimeError(f"source {short['source']!r} got fewer slots than it has blocks")
    return found


def streams(rows: DataFrame, sources: DataFrame, tie: list[str] = ()) -> DataFrame:
    """Each row with its source's columns and ``start``, its first word's place in the stream."""
    n = sources.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    digits = 0
    while 16**digits * GROUP_ROWS < n:
        digits += 1
    keyed = rows.withColumn("__key", shuffle_key(F.col("doc_id"), F.col("size")))
    keyed = attach(keyed, sources, "source").withColumn("__bucket_of", F.substring("__key", 1, digits))
    order = [F.col("__key"), F.col("doc_id"), F.col("size"), *[F.col(c) for c in tie]]
    return with_start(keyed, "sid", "__bucket_of", order, "size")


def pieces(placed: DataFrame, slots: DataFrame, block: int = BLOCK_WORDS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """What the mix takes: every part of a document in a block, with the block's slot.

    ``placed`` is what ``streams`` gives. Columns: slot, sid, __bucket_of, place,
    doc_id, round (0 for the first pass through the source), first (word of the
    document) and words. In order of slot and stream this is the mixed corpus.
    """
    rounds = (
        placed.where("size > 0 AND quota > 0")
        .select("sid", "__bucket_of", "place", "doc_id", "size", "source_size", "quota", "start",
                F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("round"))
        .withColumn("at", F.col("start") + F.col("round") * F.col("source_size"))
        .withColumn("end", F.least(F.col("at") + F.col("size"), F.col("quota")))
        .where("at < quota")
    )
    parts = rounds.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / block).cast("long"), F.floor((F.col("end") - 1) / block).cast("long"),
    )))
    first = F.greatest(F.col("at"), F.col("block") * block)
    last = F.least(F.col("end"), (F.col("block") + 1) * block)
    return parts.join(slots, ["sid", "block"]).select(
        "slot", "sid", "__bucket_of", "place", "doc_id", "round",
        (first - F.col("at")).alias("first"), (last - first).alias("words"),
    )


def mix(
    rows: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, total: int | None = None,
    block: int = BLOCK_WORDS, tie: list[str] = (),
) -> DataFrame:
    """Every row with source_size, target, ``taken``, the words the mix takes of it, and
    ``first_slot``, the slot that takes its first word (null if none does).

    ``rows`` has doc_id, source and size (its words); other columns pass through, but
    for those named like an added one, which comes in their place. Words repeated count
    again. Nulls: a null source is a source of its own, sorted last; a null id shuffles
    like any other. Rows of size 0 are taken 0. Equal rows are separate documents; those
    equal in id and size are told apart by ``tie`` and else are alike. An empty table
    gives none. Reruns agree, since order comes from digests alone.
    """
    sources = written(targets(rows.select("source", "size"), weights, max_repeats, total), "sources")
    own = ["doc_id", "source", "size", *tie]
    placed = streams(rows.select(*own, F.struct("*").alias("row")), sources, tie)
    narrow = streams(rows.select(*own), sources, tie)
    key = ["sid", "__bucket_of", "place"]
    taken = (
        pieces(narrow, schedule(sources, block), block, max_repeats)
        .groupBy(*key).agg(F.sum("words").alias("__taken"), F.min("slot").alias("__slot"))
        .select(*[F.col(k).alias(f"__k_{k}") for k in key], "__taken", "__slot")
    )
    meet = [F.col(k) == F.col(f"__k_{k}") for k in key]
    added = ("source_size", "target", "taken", "first_slot")
    return placed.join(taken, meet, "left").select(
        *[F.col("row")[c].alias(c) for c in rows.columns if c.lower() not in added], "source_size", "target",
        F.coalesce("__taken", F.lit(0)).cast("long").alias("taken"), F.col("__slot").alias("first_slot"),
    )


def mixed_order(
    rows: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, total: int | None = None,
    block: int = BLOCK_WORDS, tie: list[str] = (),
) -> DataFrame:
    """The mix itself, in the order of its slots: slot, doc_id, round, first, words.

    ``rows`` as for ``mix``. A row is what a slot takes of a document: ``words`` words
    from the document's word ``first`` on, in the source's pass ``round``.
    """
    sources = written(targets(rows.select("source", "size"), weights, max_repeats, total), "sources")
    placed = streams(rows.select("doc_id", "source", "size", *tie), sources, tie)
    parts = pieces(placed, schedule(sources, block), block, max_repeats)
    return parts.orderBy("slot", "round", "__bucket_of", "place", "first").select("slot", "doc_id", "round", "first", "words")


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents, sources weighing 5, 2, 1, … and sharing as many words as there are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return mix(sized).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def mix_documents(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS, total: int | None = None) -> DataFrame:
    """The mixed corpus as whole documents with the columns of ``docs``.

    A document appears as often as the mix takes its words, to the nearest
    whole number, so a source misses its target by less than one document. A text without
    words is not taken.
    """
    row = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"),
    )
    out = mix(row, weights, max_repeats, total, tie=["text_hash"])
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    return (
        out.where("size > 0 AND taken > 0").withColumn("copies", copies).where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )


ORACLE_OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sums
), weighed AS (
  SELECT *, CASE (sid - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM ranked
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM weighed) - coalesce(sum(most) OVER ahead, 0))::DOUBLE
    / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER ahead, 0))::DOUBLE AS level
  FROM weighed
  WINDOW ahead AS (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT *, least(most::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target FROM levels
), placed AS (
  SELECT s.doc_id, s.size, g.sid, g.source_size, g.target, floor(g.target + 0.5)::BIGINT AS quota,
    coalesce(sum(s.size) OVER (
      PARTITION BY g.sid
      ORDER BY md5('mix-1:' || coalesce(s.doc_id::VARCHAR, '-') || ':' || s.size), s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), shares AS (
  SELECT sid, blocks, sum(blocks) OVER (ORDER BY sid) - blocks AS lo
  FROM (SELECT sid, ceil(floor(target + 0.5) / BLOCK)::BIGINT AS blocks FROM goals)
), points AS (
  SELECT slot, (slot::HUGEINT * GOLDEN % PERIOD) * n // PERIOD AS unit
  FROM (SELECT n, unnest(range(1, floor(n * POINTS)::BIGINT + 3)) AS slot FROM (SELECT sum(blocks)::HUGEINT AS n FROM shares))
), slots AS (
  SELECT sid, slot, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS block
  FROM points JOIN shares ON unit >= lo AND unit < lo + blocks
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0
    ELSE size * (quota // source_size) + greatest(0, least(start + size, quota % source_size) - start) END::BIGINT AS taken,
  CASE WHEN size > 0 AND start < quota THEN slot END AS first_slot
FROM placed LEFT JOIN slots ON slots.sid = placed.sid AND slots.block = start // BLOCK
"""
ORACLE_OP1 = ORACLE_OP1.replace("BLOCK", str(BLOCK_WORDS)).replace("GOLDEN", str(GOLDEN)).replace("PERIOD", str(PERIOD)).replace("POINTS", str(ENOUGH_POINTS))
