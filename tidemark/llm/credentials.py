"""Secrets in texts: plain patterns, and weak parts that only count together.

Three patterns count by themselves. Four more find parts that mean nothing alone: a
named account, an address, a mail address, a token of mixed characters. Such a weak part
is reported only if a part that complements it stands within its scope: a secret beside
an account or an address, an account or an address beside a secret.

Which weak parts have a complement is an interval join. Texts are divided into cells as
wide as a scope reaches. For each text, cell and role the first start and the last end
are kept, one row however many parts there are; a weak part looks them up in its own
and the next cells, by equal keys. So a text full of parts gives no pairs of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import load, written

#: Code points from a weak part to what complements it, at most.
REACH = 200

# --- fixed values: the patterns that count by themselves ------------------------
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: Parts that count only together. An account is named; a token mixes small and capital
#: letters and digits.
ACCOUNT = (r"""(access_?key_?id|key_?id|client_?id|account|user_?name|user_?id|user|login)"""
           r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]+""")
ADDRESS = r"""[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20"'<>()\x7F]+"""
MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"

#: In the order in which spans that start together are listed: name, role.
KINDS = (("assign", "secret"), ("access", "account"), ("hex", "secret"),
         ("account", "account"), ("address", "address"), ("mail", "account"), ("token", "secret"))
FIRST_WEAK = 3
COMPLEMENTS = {"secret": ("account", "address"), "account": ("secret",), "address": ("secret",)}

_ASSIGN, _ACCOUNT = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCOUNT, re.IGNORECASE | re.ASCII)
#: Runs long enough are the same as all runs of which the short ones are dropped.
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
_TOKEN, _LETTER = re.compile(TOKEN), re.compile("[A-Za-z]")
#: A mark, what may stand before it, what the match starts with, and what follows.
_ADDRESS = "://", re.compile(r"[A-Za-z0-9+.-]"), _LETTER, re.compile(ADDRESS.partition("//")[2])
_MAIL = "@", (_BOX := re.compile(r"[A-Za-z0-9._%+-]")), _BOX, re.compile(MAIL.partition("@")[2])


def _mixed(token: str) -> bool:
    return any("a" <= c <= "z" for c in token) and any("A" <= c <= "Z" for c in token) and any("0" <= c <= "9" for c in token)


def around(text: str, mark: str, before: re.Pattern, first: re.Pattern, rest: re.Pattern) -> list[tuple[int, int]]:
    """What ``ADDRESS`` or ``MAIL`` matches, found from its mark, so that long words cost nothing."""
    found, end, at = [], 0, text.find(mark)
    while at >= 0:
        after, start, begins = at + len(mark), at, None
        while start > end and before.match(text, start - 1):
            start -= 1
            begins = start if first.match(text, start) else begins
        if begins is not None and (m := rest.match(text, after)):
            end = m.end()
            found.append((begins, end))
        at = text.find(mark, max(end, after))
    return found


def _clear(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that touch none of those taken."""
    if not spans or not taken:
        return spans
    starts, ends = (np.array(x) for x in zip(*sorted(taken), strict=True))
    ends = np.maximum.accumulate(ends)  # of all that start so far
    before = np.searchsorted(starts, [e for _, e in spans], "left")  # that start before the span ends
    return [s for s, n in zip(spans, before.tolist(), strict=True) if not n or ends[n - 1] <= s[0]]


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all parts of a text, weak ones included, in order.

    A weak part that touches one that counts by itself, or a weak one of an earlier
    kind, is none.
    """
    if not text:
        return []
    found: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    sets = ":" in text or "=" in text
    if sets:
        found[0] = [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found[1] = [m.span() for m in _ACCESS.finditer(text)]
    found[2] = [m.span() for m in _HEX.finditer(text)]
    taken = found[0] + found[1] + found[2]
    for kind, some in (
        (3, (m.span() for m in _ACCOUNT.finditer(text)) if sets else ()),
        (4, around(text, *_ADDRESS)),
        (5, around(text, *_MAIL)),
        (6, (m.span() for m in _TOKEN.finditer(text) if _mixed(m[0]))),
    ):
        found[kind] = _clear(list(some), taken)
        taken = taken + found[kind]
    return sorted((a, kind, b) for kind, some in enumerate(found) for a, b in some)


def with_parts(docs: DataFrame) -> DataFrame:
    """rid, doc_id and ``all``: the parts of the text, in order, weak ones included."""

    @F.pandas_udf("starts array<int>, kinds array<int>, ends array<int>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [list(zip(*spans(t), strict=True)) or [()] * 3 for t in batch]
            columns = {name: [np.array(r[k], np.int32) for r in rows] for k, name in enumerate(("starts", "kinds", "ends"))}
            yield pd.DataFrame(columns)

    parts = F.transform(F.arrays_zip("found.starts", "found.kinds", "found.ends"), lambda s: F.struct(
        s["starts"].alias("start"), s["kinds"].alias("kind"), s["ends"].alias("end")))
    found = docs.select("doc_id", find("text").alias("found"), F.monotonically_increasing_id().alias("rid"))
    return found.select("rid", "doc_id", parts.alias("all"))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(role) for _, role in KINDS]), kind + 1)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts (rid, start, kind, end) that have a complement within their scope.

    ``parts`` has a row per part. Only texts with a weak part are looked at.
    """
    role = _role(F.col("kind"))
    cell = lambda place: F.floor(F.col(place) / reach).cast("long")
    # A part that starts in the cell of the weak one's end is near, whichever comes first,
    # since the two do not touch; so is one that ends in the cell of the weak one's start.
    edge = lambda side, place: F.struct(F.lit(side).alias("side"), cell(place).alias("cell"), F.col(place).alias("at"))
    edges = (
        parts.select("rid", role.alias("role"), F.inline(F.array(edge(0, "start"), edge(1, "end"))))
        .groupBy("rid", "role", "side", "cell").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    )
    look = lambda other, side, place, step: F.struct(
        F.lit(other).alias("role"), F.lit(side).alias("side"), (cell(place) + step).alias("cell"))
    looks = F.lit(None)
    for mine, others in COMPLEMENTS.items():
        places = ((0, "end", 0), (0, "end", 1), (1, "start", 0), (1, "start", -1))
        looks = F.when(role == mine, F.array(*[look(other, *p) for other in others for p in places])).otherwise(looks)
    asked = parts.where(F.col("kind") >= FIRST_WEAK).select("rid", "start", "kind", "end", F.inline(looks))
    gap = F.when(F.col("side") == 0, F.col("first") - F.col("end")).otherwise(F.col("start") - F.col("last"))
    near = asked.join(edges, ["rid", "role", "side", "cell"]).where(gap <= reach)
    return near.select("rid", "start", "kind", "end").distinct()


def _listed(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda kind: F.element_at(F.array(*[F.lit(n) for n, _ in KINDS]), kind + 1)
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ",")


def secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """A row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    ``docs`` has doc_id and text; other columns are not read. Offsets count code points,
    ends are exclusive. A null or empty text has no spans. Every row is a document of its
    own, also one that repeats another or has a null id; equal texts have equal spans.
    Texts are read whole. An empty table gives no rows.
    """
    found = written(with_parts(docs), "parts")
    parts = found.where(F.exists("all", lambda s: s["kind"] >= FIRST_WEAK)).select("rid", F.inline("all"))
    # Weak parts of one text, so a group is bounded by its text.
    together = linked(parts, reach).groupBy(F.col("rid").alias("__rid")).agg(F.collect_set(F.struct("start", "kind", "end")).alias("weak"))
    base = F.filter("all", lambda s: s["kind"] < FIRST_WEAK)
    joined = found.join(together, F.col("rid") == F.col("__rid"), "left").withColumn("base", base)
    weak = F.coalesce("weak", F.array().cast(joined.schema["base"].dataType))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return joined.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", weak))).alias("spans"), F.size(weak).cast("long").alias("n_linked"),
    )


def op12_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The spans of all documents, with the weak parts that have a complement."""
    return secrets(load(spark, sf_dir, "documents", "doc_id", "text"))


def _oracle() -> str:
    either = lambda p: re.sub(r"[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", p)
    named = lambda p: either(p[: p.index(")") + 1]) + p[p.index(")") + 1:]
    patterns = (named(ASSIGN), _ACCESS.pattern, _HEX.pattern, named(ACCOUNT), ADDRESS, MAIL, TOKEN)
    patterns = [p.replace("'", "''") for p in patterns]
    mixed = "regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') AND regexp_matches(hit, '[0-9]')"
    long_enough = f"length(regexp_extract(hit, '{patterns[0]}', 2)) >= {LEAST_VALUE}"
    hits = " UNION ALL ".join(
        f"SELECT doc_id, {kind} AS kind, regexp_extract_all(text, '{p}') AS hits, regexp_split_to_array(text, '{p}') AS gaps FROM documents"
        for kind, p in enumerate(patterns)
    )
    clear = [f"""clear{kind} AS (
  SELECT * FROM {before} UNION ALL
  SELECT * FROM spans s WHERE kind = {kind}
    AND NOT EXISTS (FROM {before} t WHERE t.doc_id = s.doc_id AND t.a < s.b AND t.b > s.a)
)""" for kind, before in ((3, "base"), (4, "clear3"), (5, "clear4"), (6, "clear5"))]
    names = ", ".join(f"({k}, '{name}', '{role}')" for k, (name, role) in enumerate(KINDS))
    pairs = ", ".join(f"('{mine}', '{other}')" for mine, others in COMPLEMENTS.items() for other in others)
    return f"""
WITH cut AS (
  {hits}
), spans AS (
  SELECT doc_id, kind, a, a + length(hit) AS b FROM (
    SELECT doc_id, kind, hits[i] AS hit,
      (list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(h) FOR h IN hits[1:i - 1]]), 0))::BIGINT AS a
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut))
  WHERE CASE kind WHEN 0 THEN {long_enough} WHEN 6 THEN {mixed} ELSE true END
), base AS (
  SELECT * FROM spans WHERE kind < {FIRST_WEAK}
), {", ".join(clear)}, kinds(kind, name, role) AS (VALUES {names}), complements(mine, other) AS (VALUES {pairs}),
parts AS (
  SELECT * FROM clear6 JOIN kinds USING (kind)
), linked AS (
  SELECT DISTINCT w.* FROM parts w JOIN complements ON mine = w.role JOIN parts c ON c.doc_id = w.doc_id AND c.role = other
  WHERE w.kind >= {FIRST_WEAK} AND greatest(c.a - w.b, w.a - c.b) <= {REACH}
), every AS (
  SELECT * FROM parts WHERE kind < {FIRST_WEAK} UNION ALL SELECT * FROM linked
), listed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(concat_ws(':', name, a, b), ',' ORDER BY a, kind) FILTER (kind < {FIRST_WEAK}) AS base,
    string_agg(concat_ws(':', name, a, b), ',' ORDER BY a, kind) AS spans, count(*) FILTER (kind >= {FIRST_WEAK}) AS n_linked
  FROM every GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_linked, 0)::BIGINT AS n_linked
FROM documents LEFT JOIN listed USING (doc_id)
"""


ORACLE_OP12 = _oracle()
