"""Packing documents into sequences of bounded length by local search.

Documents become token ids with an end mark. Only what is longer than a sequence
is cut, so each document leaves at most one piece shorter than a sequence. The
short pieces are dealt into groups of bounded size. In each group, pieces are
placed by best fit, longest first; then a local search empties bins: it moves a
piece of the emptiest bin into another, exchanges it for a shorter one, or
exchanges two pieces for a shorter one, always so that the fuller bin gets fuller,
which raises the sum of squared fills. Bins that are still not full are dealt
anew into groups and searched again, until that saves no more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import load, written

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k"
#: Added tokens of the JSON file, which its library finds in texts before anything else.
ADDED = {"byte_bpe_50k": {"<|endoftext|>": 50256}}
#: Tokens of pieces that a task holds before it hands them on.
PART_TOKENS = 250_000
#: Short pieces that one task packs together, on average.
GROUP_PIECES = 16_384
#: Blanks in a row from which on they are encoded without the library's pattern, whose
#: stack overflows at some 1,000,000.
LONG_BLANK = 100_000
BLANKS = regex.compile(rf"\p{{White_Space}}{{{LONG_BLANK},}}")
#: Accepted exchanges per piece after which the search of a group ends.
EFFORT = 4

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def encoder(name: str):
    """Ids of the public byte-level vocabulary. The same ids as the JSON file of that
    name gives in its own library, at a third of the time (a test compares them)."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_ids(text: str, bpe) -> list[int]:
    """Ids of a text; long runs of blanks are cut out where the pattern would cut them.

    The pattern takes all blanks of a run at the end of a text, and else all but the
    last, which goes to what follows.
    """
    if len(text) < LONG_BLANK:
        return bpe.encode_ordinary(text)
    ids, at = [], 0
    for run in BLANKS.finditer(text):
        end = run.end() - (run.end() < len(text))
        ids += bpe.encode_ordinary(text[at:run.start()])
        ids += bpe._encode_single_piece(text[run.start():end])
        at = end
    return ids + bpe.encode_ordinary(text[at:])


def token_ids(text: str | None, name: str = TOKENIZER, end: int = END_ID) -> np.ndarray:
    """Ids of the text, added tokens included, then the end mark; a null text is an empty one."""
    ids, added = [], ADDED.get(name, {})
    for part in regex.split("(" + "|".join(map(regex.escape, added)) + ")", text or "") if added else [text or ""]:
        if part in added:
            ids.append(added[part])
        elif part:
            ids += plain_ids(part, encoder(name))
    return np.array([*ids, end], dtype="<u4")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: a shorter first one, then whole sequences."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end: int = END_ID,
                  with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    Pieces are handed on after ``PART_TOKENS`` tokens, however large a batch is.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = token_ids(text, tokenizer, end)
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    part = ids[start:start + length]
                    row = (None if pd.isna(doc_id) else int(doc_id), k, start, length, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
                    held += length
                    if held >= PART_TOKENS:
                        yield frame(rows)
                        rows, held = [], 0
            if rows:
                yield frame(rows)

    return docs.select("doc_id", "text").mapInPandas(run, PIECE + ", ids array<int>" * with_ids)


# ---- one group ----------------------------------------------------------------

def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest bin that has room; bins as lists of indices."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        by_room[room - size].append(b)
        rooms |= 1 << (room - size)
    return bins


def improve(bins: list[list[int]], lengths: list[int], capacity: int, effort: int) -> list[list[int]]:
    """Sweeps over the bins that are not full until a sweep changes nothing.

    Every change raises the sum of squared fills, so this ends; ``effort`` changes
    per piece end it earlier.
    """
    steps = effort * len(lengths)
    while steps > 0:
        bins, left = sweep(bins, lengths, capacity, steps)
        if left == steps:
            break
        steps = left
    return bins


def sweep(bins: list[list[int]], lengths: list[int], capacity: int, steps: int) -> tuple[list[list[int]], int]:
    """Empties bins by moves and exchanges between those that are not full.

    Bins give in order of their fill, the emptiest first. Of all moves (x), exchanges
    (x for y) and two-for-one exchanges (x1, x2 for y) with a bin that has not given
    yet, the one that takes most tokens is made, until none is left.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    changes = [0] * len(bins)
    # For each length y that could come back (0: none, a move), the rooms of bins that
    # hold it; entries of a bin that has changed since are skipped when met.
    rooms: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    most_room = np.zeros(capacity + 1, dtype=np.int64)

    def enter(b: int) -> None:
        room = capacity - fill[b]
        for out in {0, *(lengths[i] for i in bins[b])} if room else ():
            heappush(rooms[out], (-room, b, changes[b]))
            most_room[out] = max(most_room[out], room)

    giving_order = sorted((b for b in range(len(bins)) if fill[b] < capacity), key=lambda b: (fill[b], b))
    for b in giving_order:
        enter(b)
    for giving in giving_order:
        changes[giving] += 1  # it takes nothing any more
        while bins[giving] and fill[giving] < capacity and steps > 0:
            own = sorted(bins[giving], key=lambda i: (-lengths[i], i))
            offers = {lengths[i]: (i,) for i in reversed(own)}
            for a, i in enumerate(own):
                for j in own[a + 1:]:
                    offers.setdefault(lengths[i] + lengths[j], (i, j))
            outs = np.flatnonzero(most_room)
            sizes = np.array(list(offers))
            single = np.array([len(x) == 1 for x in offers.values()])
            gain = sizes[:, None] - outs
            gain[(gain > most_room[outs]) | ((outs == 0) & ~single[:, None])] = 0
            if not gain.size or (best := int(gain.max())) <= 0:
                break
            row, column = divmod(int(gain.argmax()), len(outs))
            out, found = int(outs[column]), rooms[outs[column]]
            while found and changes[found[0][1]] != found[0][2]:
                heappop(found)
            most_room[out] = -found[0][0] if found else 0
            if most_room[out] < best:
                continue
            steps -= 1
            b = found[0][1]
            back = [] if not out else [next(i for i in bins[b] if lengths[i] == out)]
            given = offers[int(sizes[row])]
            bins[b] = [i for i in bins[b] if i not in back] + list(given)
            bins[giving] = [i for i in bins[giving] if i not in given] + back
            fill[b] += best
            fill[giving] -= best
            changes[b] += 1
            enter(b)
    return [b for b in bins if b], steps


def pack_lengths(lengths: list[int], capacity: int = CAPACITY, effort: int = EFFORT) -> list[list[int]]:
    """Bins of indices for pieces of these lengths (1 to ``capacity``)."""
    return improve(best_fit(lengths, capacity), lengths, capacity, effort)


# ---- all groups ---------------------------------------------------------------

def _pack_groups(items: DataFrame, groups: int, turn: int, capacity: int, effort: int) -> DataFrame:
    """rid, length, sequence_id, offset, fill; a sequence is named by its least rid."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", kind="stable")
        rid, lengths = pdf["rid"].tolist(), pdf["length"].tolist()
        rows = []
        for members in pack_lengths(lengths, capacity, effort):
            members = sorted(members)
            offset, full = 0, sum(lengths[i] for i in members)
            for i in members:
                rows.append((rid[i], lengths[i], rid[members[0]], offset, full))
                offset += lengths[i]
        return pd.DataFrame(rows, columns=["rid", "length", "sequence_id", "offset", "fill"])

    # Equally many pieces for each group, whatever their ids are.
    group = F.pmod(F.xxhash64(F.col("rid"), F.lit(turn)), F.lit(groups))
    return (
        items.select("rid", "length", group.alias("group")).groupBy("group")
        .applyInPandas(run, "rid long, length long, sequence_id long, offset long, fill long")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, effort: int = EFFORT) -> DataFrame:
    """``pieces`` with sequence_id and offset; each has a length from 1 to ``capacity``.

    ``rid`` must tell the pieces apart. Pieces as long as a sequence fill one alone.
    Sequence ids are those of a member piece, or less than 0 for whole ones.
    """
    short = pieces.where(F.col("length") < capacity).select("rid", "length")
    waiting = short.count()
    done, turn, kept = [], 0, None
    while waiting:
        groups = -(-waiting // group_pieces)
        packed = written(_pack_groups(short, groups, turn, capacity, effort), f"packed-{turn}")
        bins = packed.where("offset = 0").count()
        if kept and bins >= kept[0]:  # these pieces needed no more sequences before
            done.append(kept[1])
            break
        open_bins = packed.where(F.col("fill") < capacity)
        done.append(packed.where(F.col("fill") == capacity))
        if groups == 1:
            done.append(open_bins)
            break
        kept, short, turn = (open_bins.where("offset = 0").count(), open_bins), open_bins.select("rid", "length"), turn + 1
        waiting = short.count()
    placed = pieces.where(F.col("length") >= capacity).select(
        "rid", (-1 - F.col("rid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    for part in done:
        placed = placed.unionByName(part.select("rid", "sequence_id", "offset"))
    return pieces.join(placed, "rid")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """Documents as pieces of sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    With ``with_ids`` the ids themselves come along. A null or empty text is the end
    mark alone. A null id stays null. Equal rows and equal ids are separate documents.
    Other columns are not read. An empty table gives no rows. Long texts are cut,
    never shortened.
    """
    pieces = cut_documents(docs, capacity, tokenizer, end, with_ids).withColumn("rid", F.monotonically_increasing_id())
    return pack(written(pieces, "pieces"), capacity).drop("rid")


def op2_pack_sequences(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack_documents(load(spark, sf_dir, "documents", "doc_id", "text"))
