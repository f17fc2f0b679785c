"""Texts into containers of fixed capacity with little unused room.

Method: shortest-pack-first over the length histogram. Lengths are placed longest
first, each into the shortest pack, the one with the most room; if that cannot take
it none can, and a new one is opened. Packs of equal content are one pattern with a
count, so the work depends on the capacity and the lengths that occur, not on the
number of texts. Patterns are joined back to the texts by rank within their length.

Only a text longer than the capacity is split: into full pieces, each a container
of its own, and a remainder that is packed like any text of its length.

What the driver sees is the histogram up to the capacity and the patterns made of
it. A length ends with at most one pattern split in two, so there are at most as
many patterns as lengths and openings; both are bounded by the capacity. Texts are
ranked once for all capacities, hot lengths in buckets, and no text is shuffled:
rows are (doc_id, length).

Defined results: null and empty texts have no tokens and one piece of length 0,
which lies in the first container; a capacity below 1 or null is an error; an empty
corpus gives no rows; rows of equal or null id are packed one by one.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import cut, spread

#: Rows of one length that are ranked in one task.
RANK_ROWS = 200_000
#: Capacities served by one pass over the ranked texts.
AT_ONCE = 16
PACKED = "doc_id bigint, piece_no int, start_token int, n_tokens int, container bigint"


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(containers, [(length, pieces in each)]) that together place the whole histogram."""
    room: dict[int, list[tuple[int, tuple | None]]] = {}  # room left -> [(containers, content as linked pairs)]
    left: list[int] = []  # the rooms present, sorted

    def put(space: int, count: int, content: tuple) -> None:
        if space not in room:
            room[space] = []
            bisect.insort(left, space)
        room[space].append((count, content))

    def take() -> tuple[int, int, tuple]:
        space = left[-1]
        count, content = room[space].pop()
        if not room[space]:
            del room[space]
            left.pop()
        return space, count, content

    for length in sorted((n for n in histogram if n > 0), reverse=True):
        todo = histogram[length]
        while todo:
            if not left or left[-1] < length:  # the shortest pack cannot take it: new ones, each the shortest until it is full
                each = min(capacity // length, todo)
                count = todo // each
                put(capacity - each * length, count, (length, each, None))
                todo -= count * each
                continue
            space, count, content = take()
            if todo < count:
                put(space, count - todo, content)
                put(space - length, todo, (length, 1, content))
                break
            # they stay the shortest as long as no other pack has more room
            other = left[-1] if left else 0
            each = min(max(1, -(-(space - other) // length)), space // length, todo // count)
            put(space - each * length, count, (length, each, content))
            todo -= each * count
    out = []
    for space in left:
        for count, content in room[space]:
            lengths: list[tuple[int, int]] = []
            while content is not None:
                lengths.append((content[0], content[1]))
                content = content[2]
            out.append((count, lengths))
    return out


def slots(found: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int]]:
    """The patterns as (length, first rank, last rank, first container, pieces per container), ranks without gaps per length."""
    used: dict[int, int] = {}
    out, container = [], 0
    for count, content in found:
        for length, each in content:
            at = used.get(length, 0)
            out.append((length, at, at + count * each - 1, container, each))
            used[length] = at + count * each
        container += count
    return out


class Places:
    """The containers of one capacity, looked up by (length, rank)."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        found = patterns(histogram, capacity)
        table = sorted(slots(found))
        self.capacity = capacity
        self.of = {}  # length -> (first ranks, first containers, pieces per container)
        at = 0
        while at < len(table):
            end = at
            while end < len(table) and table[end][0] == table[at][0]:
                end += 1
            self.of[table[at][0]] = tuple(np.array([row[k] for row in table[at:end]], dtype="int64") for k in (1, 3, 4))
            at = end
        self.containers = sum(count for count, _ in found)

    def containers_of(self, lengths: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lengths), dtype="int64")
        for length in np.unique(lengths):
            if length > 0:
                rows = np.nonzero(lengths == length)[0]
                first, container, each = self.of[int(length)]
                k = np.searchsorted(first, ranks[rows], side="right") - 1
                out[rows] = container[k] + (ranks[rows] - first[k]) // each[k]
        return out


def _pieces(pdf: pd.DataFrame, places: list[tuple[int, Places]]) -> Iterator[pd.DataFrame]:
    """The pieces of a batch of (doc_id, n_tokens, rank, before_i, full_i) for each capacity i."""
    n, rank = pdf["n_tokens"].to_numpy("int64"), pdf["rank"].to_numpy("int64")
    for i, (capacity_id, p) in enumerate(places):
        c = p.capacity
        whole = n <= c
        full = np.where(whole, 0, n // c)  # pieces that fill a container
        rest = np.where(whole, n, n % c)
        has_rest = whole | (rest > 0)
        at = np.nonzero(has_rest)[0]
        tails = pd.DataFrame({
            "doc_id": pdf["doc_id"].take(at).array, "piece_no": full[at], "start_token": (full * c)[at], "n_tokens": rest[at],
            "container": p.containers_of(rest[at], (pdf[f"before_{i}"].to_numpy("int64") + rank)[at]),
        })
        long = np.repeat(np.nonzero(full)[0], full[full > 0])
        no = np.arange(len(long)) - np.repeat(np.cumsum(full[full > 0]) - full[full > 0], full[full > 0])
        first = p.containers + pdf[f"full_{i}"].to_numpy("int64") + rank * full
        pieces = pd.DataFrame({"doc_id": pdf["doc_id"].take(long).array, "piece_no": no, "start_token": no * c, "n_tokens": np.full(len(long), c), "container": first[long] + no})
        out = pd.concat([tails, pieces], ignore_index=True)
        out.insert(0, "capacity_id", capacity_id)
        yield out


def pack_sizes(sizes: DataFrame, capacities: list[tuple[int, int]]) -> DataFrame:
    """(capacity_id, doc_id, piece_no, start_token, n_tokens, container) for (doc_id, n_tokens) and [(id, capacity)].

    ``sizes`` must give the same rows each time it is read: it is checkpointed by ``pack_all``.
    """
    if any(c is None or c < 1 for _, c in capacities):
        raise ValueError("a capacity is at least 1")
    rows = sizes.select("doc_id", "n_tokens", F.monotonically_increasing_id().alias("_row"))
    lengths = cut(rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")))  # as long as there are different lengths
    buckets = max(1, math.ceil((lengths.agg(F.max("n").alias("n")).first()["n"] or 0) / RANK_ROWS))
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    sums = rows.groupBy("n_tokens", "_b").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("n_tokens").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("n_tokens", "_b", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_shift"))
    out = None
    for at in range(0, len(capacities), AT_ONCE):
        some = capacities[at : at + AT_ONCE]
        offsets, places = lengths, []
        for i, (capacity_id, c) in enumerate(some):
            whole = F.col("n_tokens") <= c
            rest = F.when(whole, F.col("n_tokens")).otherwise(F.col("n_tokens") % c)
            histogram = {r["rest"]: r["n"] for r in lengths.groupBy(rest.alias("rest")).agg(F.sum("n").alias("n")).where("rest > 0").collect()}  # at most c rows
            places.append((capacity_id, Places(histogram, c)))
            full = F.when(whole, F.lit(0)).otherwise(F.floor(F.col("n_tokens") / c) * F.col("n"))
            alike = Window.partitionBy(rest).orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)
            before = Window.partitionBy(F.lit(0)).orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1)  # over the lengths that differ, no more
            offsets = offsets.withColumn(f"before_{i}", F.coalesce(F.sum("n").over(alike), F.lit(0))).withColumn(f"full_{i}", F.coalesce(F.sum(full).over(before), F.lit(0)).cast("bigint"))
        order = Window.partitionBy("n_tokens", "_b").orderBy("_row")
        ranked = rows.withColumn("_r", F.row_number().over(order) - 1).join(shifts.join(offsets.drop("n"), "n_tokens"), ["n_tokens", "_b"])
        ranked = ranked.select("doc_id", "n_tokens", (F.col("_r") + F.col("_shift")).alias("rank"), *[f"{k}_{i}" for i in range(len(some)) for k in ("before", "full")])

        def run(batches: Iterator[pd.DataFrame], places=places) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield from _pieces(pdf, places)

        part = ranked.mapInPandas(run, f"capacity_id int, {PACKED}")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else sizes.sparkSession.createDataFrame([], f"capacity_id int, {PACKED}")


def pack(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece_no, start_token, n_tokens, container) for (doc_id, n_tokens) and one capacity."""
    return pack_sizes(cut(sizes.select("doc_id", "n_tokens")), [(0, capacity)]).drop("capacity_id")


def pack_all(docs: DataFrame, capacities: DataFrame, path: str | None = None) -> DataFrame:
    """(capacity_id, doc_id, piece_no, start_token, n_tokens, container) for each capacity.

    Texts are tokenised once; the sizes are kept in the shared folder for the rest.
    """
    from quirework.llm.tokens import token_count

    wanted = sorted((r["capacity_id"], r["capacity_tokens"]) for r in capacities.select("capacity_id", "capacity_tokens").distinct().collect())
    sizes = cut(spread(docs.select("doc_id", "text")).select("doc_id", token_count("text", path).alias("n_tokens")))
    return pack_sizes(sizes, wanted)


def fill(packed: DataFrame) -> DataFrame:
    """(capacity_id, container, n_pieces, used): how full each container is."""
    return packed.groupBy("capacity_id", "container").agg(F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("used"))
