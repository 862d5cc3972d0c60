"""Hierarchical multi-length packing: windows of several sizes, gaps filled from the shorter ones, balanced steps.

A document gives full windows of the longest size, and a rest that is routed to the smallest tier that holds it. Only
lengths matter for the plan, and there are fewer than the longest window, so it is made from the histogram of the rests.
Tiers are packed from the longest down. A window's gap takes whole rests of its own or shorter tiers, the
longest that fit first. Of the windows that keep a gap, the emptiest are taken apart, as few as it takes, and cut to close
the gaps of the others; the last of it, less than a window, is cut into powers of two. So every sequence is full.

Sequences of each tier are dealt evenly over the training steps, so that steps hold the same tokens in the same mixture.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdcast.llm.byte_bpe import ByteBpe
from herdcast.llm.common import columns_of, materialise, pick

TIERS = (1024, 512, 256, 128)


@dataclass(frozen=True)
class Lot:
    """Parts of the rests of ``length`` with ``count`` ranks from ``first`` on: of each, ``each`` slices of ``size`` tokens from ``at``."""
    length: int
    first: int
    count: int
    at: int
    size: int
    each: int = 1

    def split(self, n: int) -> tuple[Lot, Lot]:
        return replace(self, count=n), replace(self, first=self.first + n, count=self.count - n)

    def slices(self, size: int, each: int) -> tuple[Lot, Lot]:
        """``each`` slices of ``size``, and what is left of every part."""
        return replace(self, size=size, each=each), replace(self, at=self.at + size * each, size=self.size - size * each)


@dataclass
class Windows:
    """``count`` equal sequences of ``tier`` tokens; each lot holds one slice for each of them."""
    tier: int
    count: int
    lots: list[Lot] = field(default_factory=list)

    @property
    def gap(self) -> int:
        return self.tier - sum(lot.size for lot in self.lots)

    def split(self, n: int) -> tuple[Windows, Windows]:
        both = [lot.split(n) for lot in self.lots]
        return Windows(self.tier, n, [a for a, _ in both]), Windows(self.tier, self.count - n, [b for _, b in both])


class Plan:
    """Sequences for rests given by a histogram of lengths, each below the longest tier.

    Every step uses up a lot or closes a group of equal windows, so the plan grows with the number of different lengths only.
    """

    def __init__(self, histogram: dict[int, int], tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers)
        self.pool: dict[int, list[Lot]] = {}
        for length, n in histogram.items():
            self.put(Lot(length, 0, n, 0, length))
        self.done: list[Windows] = []
        self.open: list[Windows] = []
        while self.pool:                                   # the longest rest opens windows of its tier
            lot = self.take(max(self.pool))
            self.fill_whole(Windows(next(t for t in self.tiers if t >= lot.size), lot.count, [lot]))
        self.close()

    def put(self, lot: Lot) -> None:
        if lot.count and lot.size:
            self.pool.setdefault(lot.size, []).append(lot)

    def take(self, size: int, most: int | None = None) -> Lot:
        """A lot of at most ``most`` parts of this size."""
        lot = self.pool[size].pop()
        if not self.pool[size]:
            del self.pool[size]
        if most is not None and lot.count > most:
            lot, rest = lot.split(most)
            self.put(rest)
        return lot

    def give(self, windows: Windows, size: int) -> list[Windows]:
        """Gives the windows as many whole parts of this size as go in; apart, those that get none."""
        lot = self.take(size)
        times = min(windows.gap // size, lot.count // windows.count)
        if not times:
            some, rest = windows.split(lot.count)
            some.lots.append(lot)
            return [some, rest]
        for _ in range(times):
            part, lot = lot.split(windows.count)
            windows.lots.append(part)
        self.put(lot)
        return [windows]

    def fill_whole(self, windows: Windows) -> None:
        """First pass: gaps take whole rests of the own and shorter tiers, the longest that fit."""
        waiting = [windows]
        while waiting:
            w = waiting.pop()
            size = max((s for s in self.pool if s <= w.gap), default=None)
            if size is not None:
                waiting += self.give(w, size)
            elif w.gap:
                self.open.append(w)
            else:
                self.done.append(w)

    def close(self) -> None:
        """Second pass: the emptiest windows are taken apart, as few as it takes, and cut to close all others."""
        self.open.sort(key=lambda w: w.gap / w.tier)
        need, tokens = sum(w.gap * w.count for w in self.open), 0
        while self.open and tokens < need:
            w = self.open.pop()
            apart = min(w.count, -(-(need - tokens) // w.tier))    # each one gives its tokens and needs none
            given, kept = w.split(apart)
            for lot in given.lots:
                self.put(lot)
            need, tokens = need - apart * w.gap, tokens + apart * (w.tier - w.gap)
            if kept.count:
                self.open.append(kept)
        while self.open:
            w = self.open.pop()
            if not w.gap:
                self.done.append(w)
                continue
            size = max(self.pool)
            if size < w.gap:
                self.open += self.give(w, size)
                continue
            each = min(size // w.gap, w.count)
            lot = self.take(size, w.count // each)
            now, rest = w.split(lot.count * each)
            lot, left = lot.slices(w.gap, each)
            self.put(left)
            now.lots.append(lot)
            self.done.append(now)
            if rest.count:
                self.open.append(rest)
        self.last([lot for lots in self.pool.values() for lot in lots])

    def last(self, lots: list[Lot]) -> None:
        """What is left holds less than a window: powers of two."""
        parts = [replace(lot, first=lot.first + i, count=1) for lot in lots for i in range(lot.count)]
        tokens = sum(p.size for p in parts)
        for power in (1 << k for k in range(tokens.bit_length() - 1, -1, -1)):
            if tokens & power:
                own, room = [], power
                while room:
                    part = parts.pop()
                    part, rest = part.slices(min(part.size, room), 1)
                    if rest.size:
                        parts.append(rest)
                    own.append(part)
                    room -= part.size
                self.done.append(Windows(power, 1, own))


@dataclass
class Places:
    """The plan as arrays: where the rest of each length and rank goes, part by part."""
    edges: dict[int, list[int]]                      # length: first ranks of the intervals
    parts: dict[int, list[list[tuple[int, ...]]]]
    #: per interval: (at, size, slices, first rank of the lot, tier, first number within the tier, offset)

    @staticmethod
    def of(plan: Plan, used: dict[int, int]) -> Places:
        """``used``: sequences of each tier that are given away already; advanced by the plan's."""
        slices: dict[int, list[tuple[int, int, tuple]]] = defaultdict(list)
        for w in plan.done:
            number, offset = used.get(w.tier, 0), 0
            used[w.tier] = number + w.count
            for lot in w.lots:
                slices[lot.length].append((lot.first, lot.first + lot.count, (lot.at, lot.size, lot.each, lot.first, w.tier, number, offset)))
                offset += lot.size
        edges, parts = {}, {}
        for length, own in slices.items():
            cuts = sorted({x for lo, hi, _ in own for x in (lo, hi)})
            intervals: list[list[tuple]] = [[] for _ in cuts]
            place = {c: i for i, c in enumerate(cuts)}
            for lo, hi, what in own:
                for i in range(place[lo], place[hi]):
                    intervals[i].append(what)
            edges[length] = cuts
            parts[length] = [sorted(x) for x in intervals]
        return Places(edges, parts)

    def find(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(at, size, tier, number within the tier, offset) of the parts of one rest, in order."""
        for at, size, each, first, tier, number, offset in self.parts[length][bisect_right(self.edges[length], rank) - 1]:
            for k in range(each):
                yield at + k * size, size, tier, number + (rank - first) * each + k, offset


def windows_and_rests(docs: DataFrame, rules: str, end_id: int, longest: int) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids_crc32, ids, part, nth: the full windows and the rest of every document.

    Only rests carry their ids; ``nth`` counts the pieces of a length within a task (``part``).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        bpe, task, seen = ByteBpe(rules, special=True), TaskContext.get().partitionId(), np.zeros(longest + 1, np.int64)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", "part", "nth"])

        for ids, texts in columns_of(batches, ("doc_id", "text")):
            rows: list[tuple] = []
            for doc, text in zip(ids, texts, strict=True):
                data = np.array([*bpe.ids(text or ""), end_id], "<u4")
                for at in range(0, len(data), longest):
                    own = data[at:at + longest]
                    raw = own.tobytes()
                    rows.append((doc, at, len(own), len(data), zlib.crc32(raw), None if len(own) == longest else raw, task, int(seen[len(own)])))
                    seen[len(own)] += 1
                if len(rows) > 4096:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    source = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(source.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary, part int, nth long"),
                       "windows")


def numbered_steps(used: dict[int, int], step_tokens: int) -> tuple[dict[int, int], int]:
    """First sequence number of each tier, and how many steps: as many as full steps hold all tokens."""
    first, n = {}, 0
    for tier in sorted(used, reverse=True):
        first[tier] = n
        n += used[tier]
    return first, max(1, -(-sum(t * n for t, n in used.items()) // step_tokens))


def pack_tiers(docs: DataFrame, tokenizer: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = 1 << 19) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step of every piece.

    ``tiers`` are powers of two; sequences have ``tier`` tokens each. ``step`` is the training step of a sequence: every step has
    as many sequences of each tier as any other, but for one. A null or empty text is the end id alone. Long
    texts are cut at full windows. Repeated rows, and rows without id, are packed each; ties between equal lengths go by the order
    of the input. An empty table gives an empty one. Other columns are ignored.
    """
    with open(tokenizer, encoding="utf-8") as f:
        rules = f.read()
    tiers = tuple(sorted(tiers, reverse=True))
    if any(t & (t - 1) for t in tiers):
        raise ValueError(f"no powers of two: {tiers}")
    longest = tiers[0]
    pieces = windows_and_rests(docs, rules, end_id, longest)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = materialise(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "ranks")
    histogram = {r["length"]: r["n"] for r in ranks.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # at most ``longest`` rows
    used = {longest: histogram.pop(longest, 0)}
    places = Places.of(Plan(histogram, tiers), used)
    first, steps = numbered_steps(used, step_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*[pa.int64()] * 7, pa.int32(), pa.int64())

        def row(doc, start, length, crc, tokens, tier, number, offset):
            return doc, start, length, crc, tokens, first[tier] + number, offset, tier, number * steps // used[tier]

        for columns in columns_of(batches, ("doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", "rank")):
            out = []
            for doc, start, length, tokens, crc, raw, rank in zip(*columns, strict=True):
                if length == longest:
                    out.append(row(doc, start, length, crc, tokens, longest, rank, 0))
                    continue
                for at, size, tier, number, offset in places.find(length, rank):
                    own = crc if size == length else zlib.crc32(raw[4 * at:4 * (at + size)])
                    out.append(row(doc, start + at, size, own, tokens, tier, number, offset))
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step"])

    ranked = (pieces.join(ranks.select("length", "part", "before"), ["length", "part"])
              .select("doc_id", "start", "length", "doc_tokens", "ids_crc32", "ids", (F.col("before") + F.col("nth")).alias("rank")))
    return ranked.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                                  "tier int, step long")
