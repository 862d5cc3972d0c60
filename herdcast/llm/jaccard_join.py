"""Similarity join of documents on the Jaccard similarity of their word n-grams, by vertical partitioning.

Shingles are 64-bit hashes, and their numeric order is the global order. It is cut into fragments,
once coarsely to count overlaps (a pair's partial counts, one per fragment, are summed), and once
finely to find the pairs: two sets that differ in at most d shingles agree on one of d + 1 fragments.
Documents meet only where a whole fragment is equal, which a shared passage alone does not bring
about. Sets of similar size share one fine cut; each set takes part in its own size class and in the
one below.

Some fragments are cut beyond the d + 1, so that linked sets agree on several; a set that meets others on
fewer is dropped, and so is a pair. Equal sets are merged first. Within a large bucket, links are sought first
between neighbours in size and with the first one, which joins a group of near copies without trying all its
pairs. Pairs between parts that are still apart follow, all of them that meet often enough, so no link between two
components is missed. Before shingles are fetched for a pair, the difference of two small histograms over the order,
which is no larger than the difference of the sets, rules most false pairs out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from herdcast.llm.common import materialise, mix64, packed, pick, pieces_of, release, unpacked
from herdcast.llm.graph import components

#: Ranges of a histogram, as a multiple of the largest difference of linked sets. Differences that fall into one range cancel
#: out: of D over R ranges about D * D / (2 * R), so with 2 the histograms of hardly any two near copies are too far apart.
RANGES = 4

#: In buckets of more rows, neighbours are tried first; in others all pairs at once.
LARGE = 8


@dataclass(frozen=True)
class Join:
    """Documents link when percent / 100 of their union is common. ``fragments`` cuts the order for counting."""
    width: int = 3
    percent: int = 90
    fragments: int = 8

    def largest_difference(self, sizes: int) -> int:
        """Of two linked sets whose sizes add up to ``sizes``."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def bounds(self, most: int) -> list[int]:
        """First sizes of the size classes: a linked partner is in the same class or the next."""
        lows = [1]
        while lows[-1] <= most:
            lows.append(max(lows[-1] + 1, -(-lows[-1] * 100 // self.percent)))
        low = lows[-1]
        return [*lows, max(low + 1, -(-low * 100 // self.percent)), low * 4]


def _text_hashes(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of every range of bytes: eight bytes at a time for all short ones, xxhash for longer ones."""
    import xxhash
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(padded) - 7, np.uint64, padded, strides=(1,))
    out, short = mix64(sizes.astype(np.uint64)), sizes <= 64
    left = np.flatnonzero(short & (sizes > 0))
    for at in range(0, 64, 8):
        rest = np.minimum(sizes[left] - at, 8).astype(np.uint64)
        v = eights[begins[left] + at] << (np.uint64(64) - np.uint64(8) * rest)
        out[left] = mix64(out[left] * np.uint64(0x9E3779B97F4A7C15) ^ v)
        left = left[sizes[left] > at + 8]
        if not len(left):
            break
    for k in np.flatnonzero(~short).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[begins[k]:begins[k] + sizes[k]])
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of every word, text after text, and the number of words of each text."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, owner = pc.list_flatten(found), pc.list_parent_indices(found).to_numpy()
    _, edges, data = words.buffers()
    edges = np.frombuffer(edges or b"", np.int64 if pa.types.is_large_string(words.type) else np.int32)
    edges = edges[words.offset:words.offset + len(words) + 1].astype(np.int64)
    begins, sizes = edges[:-1], np.diff(edges)
    filled = sizes > 0                    # white space at either end of a text leaves an empty word
    hashes = _text_hashes(np.frombuffer(data or b"", np.uint8), begins[filled], sizes[filled])
    return hashes, np.bincount(owner[filled], minlength=len(texts))


def _shingled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` among word hashes."""
    n = max(0, len(h) - width + 1)
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return out


def shingles(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Per text, sorted distinct hashes of the word n-grams; a shorter text is one shingle; no words, none."""
    h, counts = word_hashes(texts)
    runs, ends, sets = _shingled(h, width), np.cumsum(counts), []
    for count, end in zip(counts.tolist(), ends.tolist(), strict=True):
        begin = end - count
        s = np.sort(runs[begin:end - width + 1]) if count >= width else _shingled(h[begin:end], count)[:count]
        if (s[1:] == s[:-1]).any():
            s = np.concatenate([s[:1], s[1:][s[1:] != s[:-1]]])
        sets.append(s)
    return sets


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every set, as two arrays."""
    sizes = np.array([len(s) for s in sets], np.int64)
    begins, some = np.cumsum(sizes) - sizes, sizes > 0
    out = np.zeros((2, len(sets)), np.uint64)
    if some.any():
        s = np.concatenate(sets)
        for k, of in enumerate((0x51ED27, 0xA3C59AC2F1)):
            out[k, some] = np.add.reduceat(mix64(s ^ np.uint64(of)), begins[some])
    return out[0].view(np.int64), out[1].view(np.int64)


def _cuts(n: int, join: Join, lows: list[int]) -> list[tuple[int, int]]:
    """The size class of a set and the one below, each with the largest difference of a linked pair in it."""
    own = int(np.searchsorted(lows, n, side="right")) - 1
    return [(k, join.largest_difference(lows[k + 1] + lows[k + 2] - 2)) for k in (own, own - 1) if k >= 0]


def _part(s: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` equal ranges of the order each shingle is in."""
    return ((s >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)


def _slack(differ: int, least: int) -> int:
    """Fragments beyond the needed ones, so that sets of ``least`` shingles or more rarely have as many empty."""
    empty = (differ + 1) * math.exp(-least / (differ + 1))
    return 1 + math.ceil(empty + 5 * math.sqrt(empty))


def _spare(differ: int) -> int:
    """Fragments cut beyond those that find a linked pair: it agrees on so many more than one."""
    return -(-differ // 16)


def _least_shared(n: str, most: int, join: Join, larger: bool = False) -> Column:
    """Keys a set of ``n`` shingles, ``most`` or fewer, has at least in common with one it links with, or only with a ``larger`` one."""
    lows = join.bounds(2 * most)
    spare = [_spare(join.largest_difference(lows[k + 1] + lows[k + 2] - 2)) for k in range(len(lows) - 4)]
    least = [x if larger else min(spare[max(0, k - 1):k + 1]) for k, x in enumerate(spare)]
    steps = [f"WHEN {n} >= {low} THEN {1 + x}" for low, x in zip(lows, least, strict=False)]
    return F.expr(f"CASE {' '.join(reversed(steps))} ELSE 1 END") if steps else F.lit(1)


def _fine_keys(s: np.ndarray, join: Join, lows: list[int]) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(s), dtype=np.uint64)])
    keys = [np.empty(0, np.uint64)]
    for scheme, differ in _cuts(len(s), join, lows):
        if differ == 0:
            continue                      # only equal sets can link here
        slack = _slack(differ, lows[scheme])
        count = differ + 1 + slack + _spare(differ)
        edges = np.searchsorted(_part(s, count), np.arange(count + 1, dtype=np.uint64))
        tag = np.arange(count, dtype=np.uint64) + np.uint64(scheme << 32)
        found = mix64((sums[edges[1:]] - sums[edges[:-1]]) ^ mix64(tag))
        filled = edges[1:] > edges[:-1]
        # up to ``slack`` fragments may be empty in both sets and tell nothing; sets with more
        # empty ones than that meet on the empty ones too
        keys.append(found[filled] if count - int(filled.sum()) <= slack else found)
    return np.concatenate(keys)


def _histograms(s: np.ndarray, join: Join, lows: list[int]) -> tuple[int, list[np.ndarray]]:
    """The size class, and the counts of shingles by range of the order for it and the class below."""
    cuts = _cuts(len(s), join, lows)
    counts = [np.bincount(_part(s, RANGES * (d + 1)).astype(np.int64), minlength=RANGES * (d + 1)) for _, d in cuts]
    return cuts[0][0], [np.minimum(c, 127).astype(np.int8) for c in (counts if len(counts) == 2 else [counts[0], counts[0][:0]])]


def _sets(texts: pa.Array, join: Join, lows: list[int]) -> list[np.ndarray]:
    sets = shingles(texts, join.width)
    most = max(map(len, sets), default=0)
    if most > lows[-4]:
        lows[:] = join.bounds(2 * most)
    return sets


def sketches(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n and the 128-bit digest h1, h2 of every document's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            ids, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "text"))
            sets = shingles(texts, join.width)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                              *map(pa.array, digests(sets))], names=["doc_id", "n", "h1", "h2"])

    return docs.mapInArrow(run, "doc_id long, n long, h1 long, h2 long")


def fine_keys(docs: DataFrame, join: Join) -> DataFrame:
    """(key, h1, n): a row for every fine fragment of every document. Equal sets met again in a partition are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, seen = join.bounds(1 << 12), set()
        for batch in pieces_of(batches):
            sets = _sets(batch.column(batch.schema.get_field_index("text")), join, lows)
            keys, ids, sizes = [], [], []
            for s, *one in zip(sets, *(d.tolist() for d in digests(sets)), strict=True):
                if not len(s) or tuple(one) in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(tuple(one))
                own = _fine_keys(s, join, lows)
                keys.append(own)
                ids.append(np.full(len(own), one[0], np.int64))
                sizes.append(np.full(len(own), len(s), np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids)),
                                                  pa.array(np.concatenate(sizes))], names=["key", "h1", "n"])

    return docs.where("doc_id IS NOT NULL").select("text").mapInArrow(run, "key long, h1 long, n int")


def coarse_segments(texts: DataFrame, join: Join) -> DataFrame:
    """(rep, frag, tokens): the shingles of each candidate, by coarse fragment of the order; its first row also
    has its size class and histograms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = join.bounds(1 << 12)
        for batch in pieces_of(batches):
            reps, h1s, h2s, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("rep", "h1", "h2", "text"))
            sets = _sets(texts, join, lows)
            own1, own2 = digests(sets)
            same = (own1 == h1s.to_numpy()) & (own2 == h2s.to_numpy())     # otherwise it is another row with the same id
            rows: list[tuple] = []
            for rep, s in ((r, s) for r, s, is_it in zip(reps.to_pylist(), sets, same.tolist(), strict=True) if is_it):
                edges = np.searchsorted(_part(s, join.fragments), np.arange(join.fragments + 1, dtype=np.uint64))
                size_class, (own, low) = _histograms(s, join, lows)
                for k in np.flatnonzero(edges[1:] > edges[:-1]):
                    rows.append((rep, k, s[edges[k]:edges[k + 1]].view(np.int64), size_class, own, low))
                    size_class = own = low = None
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int8()), pa.list_(pa.int8()))
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["rep", "frag", "tokens", "class", "own", "low"])

    return texts.mapInArrow(run, "rep long, frag int, tokens array<long>, class int, own array<byte>, low array<byte>")


def _can_link(join: Join) -> Column:
    """Whether the rows x and y (structs n, class, own, low) are near enough by their histograms."""
    swap = F.col("x.n") > F.col("y.n")
    small, large = (F.when(swap, F.col(a)).otherwise(F.col(b)) for a, b in (("y.own", "x.own"), ("x.own", "y.own")))
    below, same = F.when(swap, F.col("x.low")).otherwise(F.col("y.low")), F.col("x.class") == F.col("y.class")
    apart = F.aggregate(F.zip_with(small, F.when(same, large).otherwise(below), lambda a, b: F.abs(a.cast("int") - b.cast("int"))),
                        F.lit(0), lambda a, v: a + v)
    sizes = F.col("x.n") + F.col("y.n")
    fits = 100 * F.least("x.n", "y.n") >= join.percent * F.greatest("x.n", "y.n")
    return fits & (apart * (100 + join.percent) <= sizes * (100 - join.percent))


def linked(pairs: DataFrame, segments: DataFrame, join: Join) -> DataFrame:
    """The pairs (x, y, nx, ny) that link: partial overlaps by fragment, summed per pair. Their segments are picked out first,
    as otherwise all are shuffled for each side."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("rep")).distinct()
    segments = materialise(segments.select("rep", "frag", "tokens").join(ids, "rep", "left_semi"), "picked")
    cut = pairs.withColumn("frag", F.explode(F.sequence(F.lit(0), F.lit(join.fragments - 1))))
    one = segments.select(F.col("rep").alias("x"), "frag", F.col("tokens").alias("tx"))
    two = segments.select(F.col("rep").alias("y"), "frag", F.col("tokens").alias("ty"))
    partial = cut.join(two, ["y", "frag"]).join(one, ["x", "frag"]).select(
        "x", "y", "nx", "ny", "frag", F.size(F.array_intersect("tx", "ty")).alias("common"))
    once = partial.groupBy("x", "y", "nx", "ny", "frag").agg(F.max("common").alias("common"))
    total = once.groupBy("x", "y", "nx", "ny").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= join.percent * (F.col("nx") + F.col("ny") - F.col("common"))).select("x", "y")


def _size_fits(small: str, large: str, join: Join) -> Column:
    return 100 * F.col(small) >= join.percent * F.col(large)


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair of structs x and y once, as (x, y, nx, ny), the smaller id first."""
    swap = F.col("x.rep") > F.col("y.rep")
    one, two = F.when(swap, F.col("y")).otherwise(F.col("x")), F.when(swap, F.col("x")).otherwise(F.col("y"))
    return pairs.select(one["rep"].alias("x"), two["rep"].alias("y"), one["n"].alias("nx"), two["n"].alias("ny")).distinct()


def _near_pairs(rows: DataFrame, shapes: DataFrame, join: Join) -> DataFrame:
    """Pairs from columns rep and q (a partner or null) that sizes and histograms allow."""
    pairs = rows.where("q IS NOT NULL AND rep <> q").select(F.least("rep", "q").alias("a"), F.greatest("rep", "q").alias("b")).distinct()
    one, two = (shapes.select(F.col("rep").alias(k), F.struct("*").alias(n)) for k, n in (("a", "x"), ("b", "y")))
    return _ordered(pairs.join(one, "a").join(two, "b").where(_can_link(join)))


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` (rep, root of every class) after the links ``found``: only the parts they touch are joined anew."""
    one, two = (roots.select(F.col("rep").alias(n), F.col("root").alias(f"r{n}")) for n in ("x", "y"))
    between = found.join(one, "x").join(two, "y").where("rx <> ry").select(F.col("rx").alias("x"), F.col("ry").alias("y"))
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return materialise(roots.join(moved, "root", "left").select("rep", F.coalesce("to", "root").alias("root")), "class-roots")


def _likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id may be among ``ids``, and few others, so that not all texts are shuffled to meet them. A set bit for
    each id, in at most 2 ** 18 words, is all that is broadcast."""
    spread = F.xxhash64("doc_id")
    word, bit = F.pmod(spread, F.lit(1 << 18)).alias("word_"), F.pmod(F.shiftright(spread, 18), F.lit(64)).cast("int").alias("bit_")
    words = ids.select(word, bit).groupBy("word_").agg(F.expr("bit_or(shiftleft(1L, bit_))").alias("bits_"))
    return docs.select("*", word, bit).join(F.broadcast(words), "word_").where("getbit(bits_, bit_) = 1").select(*docs.columns)


def _apart(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several parts; main is the bucket's largest part."""
    key = Window.partitionBy("key")
    placed = buckets.join(roots, "rep").repartition("key").withColumn("c", F.count("*").over(Window.partitionBy("key", "root")))
    return materialise(placed.withColumn("main", F.max(F.struct("c", "root")).over(key)["root"])
                       .withColumn("several", F.min("root").over(key) != F.max("root").over(key))
                       .where("several").select("key", "rep", "n", "root", "main"), "apart")


def _met_often(apart: DataFrame, most: int, join: Join) -> DataFrame:
    """Pairs (rep, q) of different parts that meet in as many buckets as linked sets do at least."""
    outside = apart.where("root <> main").select("key", "root", F.col("rep").alias("x"), F.col("n").alias("nx"))
    inside = apart.select("key", F.col("root").alias("other"), "main", F.col("rep").alias("y"), F.col("n").alias("ny"))
    small, once = F.least("nx", "ny"), (F.col("other") == F.col("main")) | (F.col("x") < F.col("y"))
    fits = 100 * small >= join.percent * F.greatest("nx", "ny")
    met = outside.join(inside, (outside["key"] == inside["key"]) & (F.col("root") != F.col("other")) & once & fits)
    pairs = met.groupBy(F.least("x", "y").alias("rep"), F.greatest("x", "y").alias("q")).agg(F.count("*").alias("keys"), F.first(small).alias("n"))
    return pairs.where(F.col("keys") >= _least_shared("n", most, join, larger=True)).select("rep", "q")


def class_roots(classes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """(rep, root) of every class of equal sets that meets another one: equal roots for linked classes."""
    by_size = Window.partitionBy("key").orderBy("n", "h1")
    near = (fine_keys(docs, join).repartition("key").distinct()
            .withColumn("before", F.lag("n").over(by_size)).withColumn("after", F.lead("n").over(by_size)))
    shared = materialise(near.where(_size_fits("before", "n", join) | _size_fits("n", "after", join)).select("key", "h1", "n"), "shared")
    del near
    release(docs.sparkSession)
    most = classes.agg(F.max("n")).first()[0] or 0
    enough = shared.groupBy("h1", "n").agg(F.count("*").alias("keys")).where(F.col("keys") >= _least_shared("n", most, join)).select("h1", "n")
    met = materialise(enough.join(classes, ["h1", "n"]).select("rep", "of_id", "h1", "h2", "n"), "met")
    key = Window.partitionBy("key")
    buckets = materialise(shared.join(met.select("h1", "n", "rep"), ["h1", "n"]).select("key", "rep", "n")
                          .withColumn("rows", F.count("*").over(key)).where("rows > 1"), "buckets")
    texts = _likely(docs, met.select(F.col("of_id").alias("doc_id"))).join(met.select(F.col("of_id").alias("doc_id"), "rep", "h1", "h2"), "doc_id").select("rep", "h1", "h2", "text")
    segments = materialise(coarse_segments(texts, join), "segments")
    shapes = segments.where("class IS NOT NULL").select("rep", "class", "own", "low").join(met.select("rep", "n"), "rep")

    large = buckets.where(F.col("rows") > LARGE).drop("rows")
    order = Window.partitionBy("key").orderBy("n", "rep")
    partners = large.select("rep", F.array(F.lag("rep").over(order), F.first("rep").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("qs"))
    more = materialise(_near_pairs(partners.select("rep", F.explode("qs").alias("q")), shapes, join), "pairs")
    roots, tried, rounds = met.select("rep", F.col("rep").alias("root")), more, 0
    while True:
        found = materialise(linked(more, segments, join), "found")
        links = found.count()
        if links:
            roots = _merged(roots, found)
        # neighbours in an order that changes with the round, then across parts only, as long as that joins many
        apart = _apart(large, roots) if links and rounds < 5 else None
        if apart is None or links * 100 < apart.select("rep").distinct().count() or apart.isEmpty():
            break
        shuffled = Window.partitionBy("key").orderBy(F.xxhash64("rep", F.lit(rounds)), "rep")
        others = F.array(*[F.struct(F.lag("rep", k).over(shuffled).alias("q"), F.lag("root", k).over(shuffled).alias("rq")) for k in (1, 2, 3)])
        rows = apart.select("rep", "root", others.alias("others")).select("rep", "root", F.inline("others"))
        near_pairs = _near_pairs(rows.where("root <> rq").select("rep", "q"), shapes, join)
        more = materialise(near_pairs.join(tried.select("x", "y"), ["x", "y"], "left_anti"), "pairs")
        tried = tried.union(more)
        rounds += 1
    # what is outside the main parts of all buckets against all of them
    release(docs.sparkSession)
    apart = _apart(buckets.drop("rows"), roots)
    left = materialise(_met_often(apart, most, join).join(tried.select(F.col("x").alias("rep"), F.col("y").alias("q")), ["rep", "q"], "left_anti"), "left")
    found = materialise(linked(materialise(_near_pairs(left, shapes, join), "pairs"), segments, join), "found")
    return roots if found.isEmpty() else _merged(roots, found)


def jaccard_join(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id that links lead to.

    Null and empty texts have no shingles and link with nothing. Repeated rows and equal texts link
    like any others; rows that share an id but not a text are judged each by its own text. A row
    without id takes no part and has a null component. Other columns are ignored.
    """
    join = join or Join()
    docs = pick(docs, "doc_id", "text")
    rows = materialise(sketches(docs, join).withColumn("rid", F.monotonically_increasing_id()), "sketches")
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialise(usable.groupBy("n", "h1", "h2").agg(
        F.min("rid").alias("rep"), F.min("doc_id").alias("of_id")), "classes")
    roots = class_roots(classes, docs, join)
    placed = materialise(classes.select("n", "h1", "h2", "rep", "of_id").join(roots, "rep", "left")
                         .withColumn("root", F.coalesce("root", "rep")), "placed")
    smallest = placed.groupBy("root").agg(F.min("of_id").alias("component"))
    named = placed.join(smallest, "root").select("n", "h1", "h2", "component")
    return (rows.select("doc_id", "n", "h1", "h2").join(named, ["n", "h1", "h2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))


def deduplicate(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """One row of each group of linked documents, the one with the smallest doc_id, with all columns.

    Rows that share a doc_id are one document; the least row stays. Rows without words link with nothing and
    rows without doc_id take no part: they stay.
    """
    kept = jaccard_join(docs, join).where("doc_id = component_id").select(F.col("doc_id").alias("kept_")).distinct()
    own = packed(docs, "doc_id")
    named = own.where("doc_id IS NOT NULL").join(kept, F.col("doc_id") == F.col("kept_"), "left_semi")
    one = named.groupBy("doc_id").agg(F.min("row_").alias("row_"))
    return unpacked(one.select("row_").union(own.where("doc_id IS NULL").select("row_")), docs)
