"""Packing documents into training sequences by bin completion.

A document is its token ids and then one end id; one longer than the capacity
is cut into pieces.  Only how many pieces there are of each length matters to
the packing, so the search runs over that histogram (at most ``capacity``
rows, whatever the size of the corpus) and yields patterns: lengths that fill
a sequence, and how often.  Each piece then finds its sequence from its rank
among those of its length, which is counted per map task and needs no sort.

Null texts are empty (one piece of the end id alone); repeated rows are packed
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from itertools import combinations, count, product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textops as T
from .common import texts, written

CAPACITY = 4096
END_ID = 1
#: Nodes of the search for one largest document's fillings, at most.  The best
#: filling found is kept, so every piece is packed whatever the bound.
FILLINGS = 2_000
#: Undominated fillings of one largest document that are branched over.
WIDTH = 4
#: Nodes of all such searches together; then the best packing so far stands.
WORK = 1_000_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its length, checksum, and rank among its map task's pieces of that length."""

    def run(batches):
        wp = T.word_pieces(tokenizer)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in T.blocks(batches):
            ids = wp.ids(["" if x is None else x for x in T.column(b, "text").to_pylist()])
            doc, piece, start, length, crc = [], [], [], [], []
            names = T.column(b, "doc_id").to_pylist()
            for name, x in zip(names, ids, strict=True):
                x = np.append(x, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(x), capacity)):
                    part = x[at:at + capacity]
                    doc.append(name)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            ln = np.array(length, np.int64)
            order = np.argsort(ln, kind="stable")
            rank = np.empty(len(ln), np.int64)
            rank[order] = np.arange(len(ln)) - np.searchsorted(ln[order], ln[order])
            rank += seen[ln]
            seen += np.bincount(ln, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(ln), pa.array(crc, pa.int64()),
                                              pa.array(np.full(len(ln), task, np.int32)), pa.array(rank)], names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "local_rank"])

    out = texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, local_rank long")
    return written(out, "pieces")


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether first fit puts the lengths of ``b`` into spaces of the lengths of ``a`` (both
    descending): then a sequence with ``a`` is never worse than one with ``b``."""
    space = list(a)
    for x in b:
        for i, y in enumerate(space):
            if x <= y:
                space[i] = y - x
                break
        else:
            return False
    return True


def fillings(room: int, lengths: list[int], counts: list[int], most: int = 1, nodes: int = FILLINGS) -> tuple[list[tuple[int, ...]], int]:
    """Up to ``most`` undominated fillings of ``room``, those of least waste first, and the nodes spent.

    ``lengths`` descend, each used at most ``counts`` times.  Depth first from
    the longest that fits; a branch is left once what remains cannot beat the
    ``most`` best so far.  Of fillings with equal waste the first found has the
    longest pieces, and none of the others dominates it.
    """
    n = len(lengths)
    total = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        total[i] = total[i + 1] + lengths[i] * counts[i]
    asc = lengths[::-1]
    found: list[tuple[int, int, tuple[int, ...]]] = []  # waste, order, lengths
    stack: list[tuple[int, int, tuple[int, ...]]] = [(room, 0, ())]
    spent = 0
    while stack and spent < nodes:
        left, at, chosen = stack.pop()
        spent += 1
        worst = found[-1][0] if len(found) == most else room + 1
        if not worst:
            break
        # the longest length that fits, from `at` on
        fit = max(at, n - bisect_right(asc, left))
        if left < worst and not any(dominates(f, chosen) for _, _, f in found):
            found = [x for x in found if not dominates(chosen, x[2])]
            insort(found, (left, spent, chosen))
            del found[most:]
            worst = found[-1][0] if len(found) == most else room + 1
        if fit >= n or left - total[fit] >= worst:
            continue
        x = lengths[fit]
        stack.append((left, fit + 1, chosen))  # without this length: later
        if chosen.count(x) < counts[fit]:
            stack.append((left - x, fit, (*chosen, x)))
    return [f for _, _, f in found], spent


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing, by whole groups of sequences with equal contents."""
    groups: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # that have groups, ascending

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if not groups[room]:
            insort(rooms, room)
        groups[room].append((pattern, n))

    for ln in sorted((k for k, v in histogram.items() if v), reverse=True):
        left = histogram[ln]
        while left:
            i = bisect_left(rooms, ln)
            new = i == len(rooms)
            room, pattern, n = capacity, (), left
            if not new:
                room = rooms[i]
                pattern, n = groups[room].pop()
                if not groups[room]:
                    rooms.pop(i)
            # the fullest that fits is the one just filled, as long as it has room
            each = min(room // ln, left)
            m = min(n, left // each)
            if not new and n > m:
                put(room, pattern, n - m)
            put(room - each * ln, pattern + (ln,) * each, m)
            left -= m * each
    return [g for room in groups for g in room]


def _descend(counts: np.ndarray, capacity: int, slack: int, halves: bool, swerve: dict[int, int], nodes: int, work: int) -> tuple[list[tuple[tuple[int, ...], int]] | None, int, int]:
    """One path of the search: the patterns, or None once their waste exceeds ``slack``
    (or ``work`` nodes are spent); its depth; and the nodes spent.  At the steps of
    ``swerve`` the filling of that rank is taken instead of the first."""
    counts = counts.copy()
    out: list[tuple[tuple[int, ...], int]] = []
    spent = 0
    while True:
        have = np.flatnonzero(counts)
        if not len(have):
            return out, len(out), spent
        if spent >= work:
            return None, len(out), spent
        big = int(have[-1])
        counts[big] -= 1
        lengths = np.flatnonzero(counts[:capacity - big + 1])[::-1]
        rank = swerve.get(len(out), 0)
        options, n = fillings(capacity - big, lengths.tolist(), np.minimum(counts[lengths], capacity // np.maximum(lengths, 1)).tolist(), 1 + rank, nodes)
        counts[big] += 1
        spent += n
        if rank >= len(options):
            return None, len(out), spent
        pattern = (big, *options[rank])
        use = np.bincount(pattern, minlength=capacity + 1)
        on = np.flatnonzero(use)
        times = int((counts[on] // use[on]).min())
        times = max(1, (times + 1) // 2 if halves else times)
        waste = capacity - sum(pattern)
        if waste:
            times = min(times, slack // waste)
            if not times:
                return None, len(out), spent
            slack -= waste * times
        counts[on] -= times * use[on]
        out.append((pattern, times))


def solve(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = FILLINGS, work: int = WORK) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths of one sequence) with how many sequences use each.

    Best fit decreasing is the first incumbent.  Bin completion then tries to
    beat it: the largest length left opens a sequence, a filling completes it,
    and the pattern repeats while its lengths last, or for half of that, so
    that no scarce length is spent all at once.  Paths differ from the first
    choices in no step, then in one, in two and so on, and end once their waste
    admits no fewer sequences than the incumbent.  The search stops at the
    lower bound, when no path is left, or after ``work`` nodes.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for k, v in histogram.items():
        counts[k] = v
    total = sum(k * v for k, v in histogram.items())
    best = best_fit(histogram, capacity)
    size = sum(n for _, n in best)
    bound = lower_bound(histogram, capacity)
    depth = 0
    for swerves in count():
        if swerves > depth:
            return best
        for halves, steps, ranks in ((h, s, r) for s in combinations(range(depth + 1), swerves) for r in product(range(1, WIDTH), repeat=swerves) for h in (False, True)):
            if size <= bound or work <= 0:
                return best
            out, deep, spent = _descend(counts, capacity, (size - 1) * capacity - total, halves, dict(zip(steps, ranks, strict=True)), nodes, work)
            work -= spent
            depth = max(depth, deep)
            if out is not None:
                best, size = out, sum(n for _, n in out)
    return best


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs: by total length, and by pieces of which no two fit together."""
    total = sum(k * v for k, v in histogram.items())
    return max(-(-total // capacity), sum(v for k, v in histogram.items() if 2 * k > capacity))


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length, ranges of ranks and the sequences and offsets that they go to."""
    rows, base = [], 0
    at: dict[int, int] = {}
    for pattern, times in patterns:
        offset = 0
        for ln in sorted(set(pattern), reverse=True):
            n = pattern.count(ln)
            rows.append((ln, at.get(ln, 0), n, base, offset))
            at[ln] = at.get(ln, 0) + n * times
            offset += n * ln
        base += times
    rows.sort()
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return {k: np.array(c, np.int64) for k, c in zip(("length", "rank", "uses", "base", "offset"), cols, strict=True)}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, nodes: int = FILLINGS) -> DataFrame:
    """Each piece with its sequence and its place there, gapless from 0."""
    p = pieces(docs, tokenizer, capacity, end_id)
    n = p.groupBy("length", "task").agg(F.count("*").alias("n"))
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    start = n.select(F.col("length").alias("s_length"), F.col("task").alias("s_task"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in n.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(solve(histogram, capacity, nodes))
    ranked = p.join(start, (F.col("length") == F.col("s_length")) & (F.col("task") == F.col("s_task"))).withColumn("rank", F.col("before") + F.col("local_rank"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")

    def run(batches):
        q = places
        span = np.int64(1) << 44
        key = q["length"] * span + q["rank"]
        for b in batches:
            ln, rank = (T.column(b, c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(key, ln * span + rank, "right") - 1
            k = rank - q["rank"][i]
            cols = [T.column(b, c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(q["base"][i] + k // q["uses"][i]), pa.array(q["offset"][i] + k % q["uses"][i] * ln)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
