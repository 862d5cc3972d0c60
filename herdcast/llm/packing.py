"""Packing documents into sequences: Martello-Toth dominance reduction, then best fit.

Only lengths matter for the plan, and there are at most ``capacity`` different ones, so the plan is made
from a histogram of bounded size however many documents there are. Taking lengths from the longest
down, a set of at most three pieces that dominates every other set with that longest piece is fixed for as
many copies as exist; what no such set can be shown for is packed by best fit. Both work on whole
groups of equal sequences at a time. Pieces then find their place by their rank among equals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from herdcast.llm.common import columns_of, materialise, pick


@dataclass
class Group:
    """``count`` equal sequences: slots (length, how many in each, first rank of that length), room left."""
    count: int
    room: int
    slots: list[tuple[int, int, int]] = field(default_factory=list)


def plan(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Equal sequences by group, for the given number of pieces of each length (1 to capacity)."""
    left = {w: n for w, n in histogram.items() if n > 0}
    used = dict.fromkeys(left, 0)
    done: list[Group] = []

    def take(w: int, n: int) -> int:
        first = used[w]
        used[w] += n
        left[w] -= n
        if not left[w]:
            del left[w]
        return first

    def fix(count: int, *parts: int) -> None:
        group = Group(count, capacity - sum(parts))
        for w in dict.fromkeys(parts):
            k = parts.count(w)
            group.slots.append((w, k, take(w, count * k)))
        done.append(group)

    open_: list[Group] = []
    for w in sorted(left, reverse=True):
        while left.get(w):
            parts = _dominating(left, w, capacity)
            if parts is None:
                break
            fix(min(left[x] // parts.count(x) for x in set(parts)), *parts)
    # what is left has no dominating set of this size: best fit, longest first
    for w in sorted(left, reverse=True):
        n = left[w]
        while n:
            fitting = [g for g in open_ if g.room >= w]
            if not fitting:
                each = capacity // w
                for count, k in ((n // each, each), (1 if n % each else 0, n % each)):
                    if count and k:
                        open_.append(Group(count, capacity - k * w, [(w, k, take(w, count * k))]))
                break
            g = min(fitting, key=lambda g: g.room)
            each = g.room // w
            count = min(g.count, n // each)
            if not count:
                count, each = 1, n
            if count < g.count:                   # the rest of the group stays as it is
                rest = Group(g.count - count, g.room, [(v, k, first + count * k) for v, k, first in g.slots])
                open_.append(rest)
                g.count = count
            g.slots.append((w, each, take(w, count * each)))
            g.room -= each * w
            n -= count * each
    return done + open_


def _dominating(left: dict[int, int], w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with the longest piece ``w`` that no other set with it can better, or None.

    One more piece that fills the sequence dominates; so does the longest that fits if no two
    fit; and if nothing fits, ``w`` alone. With room for two but not three more, the best pair dominates when
    its longer piece is also the longest single piece that fits.
    """
    room = capacity - w

    def there(x: int, taken: tuple[int, ...]) -> bool:
        return left.get(x, 0) > taken.count(x)

    if there(room, (w,)):
        return (w, room)
    fits = sorted((x for x in left if x <= room and there(x, (w,))), reverse=True)
    if not fits:
        return (w,)
    small = fits[-1]
    second = small if there(small, (w, small)) else next((x for x in reversed(fits) if x != small), None)
    if second is None or small + second > room:
        return (w, fits[0])
    third = next((x for x in reversed(fits) if there(x, (w, small, second))), None)
    if third is None or small + second + third > room:
        one = fits[0]
        two = next((x for x in fits if x <= room - one and there(x, (w, one))), None)
        if two is not None and one + two == room:
            return (w, one, two)
    return None


# How the tokenizer's rules cut a word, and the letters for which lower case and normal form are plain.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = r"[!-~\u00a1-\u00ac\u00ae-\u00ff\u0100-\u012f\u0131-\u024f]+"


class Encoder:
    """Ids of words as bytes, remembered.

    This tokenizer never joins over white space, and inside a plain word it cuts by ``_CUT``. Parts are encoded
    once, many in one text, and told apart by the ids that end a word. Other words are encoded as they are.
    """

    def __init__(self, rules: str, most: int = 700_000):
        import os

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_str(rules)
        self.ends = np.zeros(self.encoder.get_vocab_size(), bool)
        self.ends[[i for token, i in self.encoder.get_vocab().items() if token.endswith("</w>")]] = True
        self.specials = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.cut, self.plain = regex.compile(_CUT), regex.compile(_PLAIN)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.most = most

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_parts(self, parts: list[str]) -> None:
        some = [parts[at:at + 100] for at in range(0, len(parts), 100)]
        for own, data in zip(some, self._encode(list(map(" ".join, some))), strict=True):
            ends = (np.flatnonzero(self.ends[np.frombuffer(data, np.uint32)]) + 1) * 4
            if len(ends) == len(own) and ends[-1] == len(data):
                self.parts.update((p, data[i:j]) for p, i, j in zip(own, [0, *ends[:-1].tolist()], ends.tolist(), strict=True))
            else:
                self.parts.update(zip(own, self._encode(own), strict=True))

    def _learn(self, new: set[str]) -> None:
        whole = {w: w.lower() for w in new if w.isascii() and w.isalpha()}      # a part by itself
        cuts, odd = {}, []
        for w in new.difference(whole):
            if self.plain.fullmatch(w) and ("<|" not in w or not any(x in w for x in self.specials)):
                cuts[w] = self.cut.findall(w.lower())
            else:
                odd.append(w)
        self._learn_parts(list(set(whole.values()).union(*cuts.values()).difference(self.parts)))
        part = self.parts.__getitem__
        self.words.update(zip(whole, map(part, whole.values()), strict=True))
        for w, own in cuts.items():
            self.words[w] = part(own[0]) if len(own) == 1 else b"".join(map(part, own))
        if odd:
            self.words.update(zip(odd, self._encode(odd), strict=True))

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of each text, given as its words; what is new in any of them is encoded together."""
        if len(self.words) > self.most:
            self.words.clear()
        if len(self.parts) > self.most:
            self.parts.clear()
        new = set().union(*texts).difference(self.words)
        if new:
            self._learn(new)
        word = self.words.__getitem__
        return [b"".join(map(word, words)) for words in texts]


def blank_words(text: str) -> list[str]:
    """Words between white space; the four separators that only Python counts as blank stay inside."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
    return text.split()


def encoded(encoder: Encoder, texts: list[str | None], chars: int = 1 << 20) -> Iterator[bytes]:
    """The ids of each text; texts are taken together until they hold ``chars`` characters."""
    held: list[list[str]] = []
    size = 0
    for text in texts:
        held.append(blank_words(text or ""))
        size += len(text or "")
        if size >= chars:
            yield from encoder.ids(held)
            held, size = [], 0
    yield from encoder.ids(held)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of every document's ids and the end id."""
    with open(tokenizer, encoding="utf-8") as f:
        rules = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        encoder, end = Encoder(rules), np.uint32(end_id).tobytes()
        for ids, texts in columns_of(batches, ("doc_id", "text")):
            rows: list[tuple] = []
            for doc, data in zip(ids, encoded(encoder, texts), strict=True):
                data += end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at:at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def placements(groups: list[Group]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, pieces, how many a sequence, first sequence, offset of the first)."""
    out, sequence = [], 0
    for g in groups:
        offset = 0
        for w, each, first in g.slots:
            out.append((w, first, each * g.count, each, sequence, offset))
            offset += w * each
        sequence += g.count
    return out


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset. Needs doc_id, piece and length, from 1 to ``capacity``.

    Ranks among pieces of equal length are counted in salted blocks, so that a common length is no hot key.
    """
    spark = pieces.sparkSession
    held = materialise(pieces.withColumn("salt_", F.spark_partition_id()), "pieces")
    blocks = held.groupBy("length", "salt_").agg(F.count("*").alias("n"))
    blocks = materialise(blocks.withColumn("before_", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))), "ranks")
    histogram = {r["length"]: r["n"] for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = placements(plan(histogram, capacity))
    places = spark.createDataFrame(rows, "length long, first long, many long, each long, sequence long, begin long")
    own = Window.partitionBy("length", "salt_").orderBy("doc_id", "piece")
    ranked = (held.withColumn("rank_", F.row_number().over(own) - 1)
              .join(blocks.select("length", "salt_", "before_"), ["length", "salt_"])
              .withColumn("rank_", F.col("rank_") + F.col("before_")).drop("salt_", "before_"))
    at = F.col("rank_") - F.col("first")
    return (ranked.join(places, "length").where((at >= 0) & (at < F.col("many")))
            .withColumn("sequence_id", F.col("sequence") + F.floor(at / F.col("each")))
            .withColumn("offset", F.col("begin") + at % F.col("each") * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null or empty text is the end id alone. Documents of more than ``capacity`` ids are cut into full
    pieces and a last one. Repeated rows, and rows without id, are packed each. An empty table gives
    an empty one. Other columns are ignored.
    """
    return pack(tokenized(pick(docs, "doc_id", "text"), tokenizer, end_id, capacity), capacity)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """(sequence_id, ids): the packed ids themselves, for documents with distinct ids."""
    with open(tokenizer, encoding="utf-8") as f:
        rules = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer
        encoder = Tokenizer.from_str(rules)
        for texts, starts, lengths, ids, offsets in columns_of(batches, ("text", "start", "length", "sequence_id", "offset")):
            encoded = [[*e.ids, end_id] for e in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()),
                 pa.array([e[s:s + n] for e, s, n in zip(encoded, starts, lengths, strict=True)], pa.list_(pa.int32()))],
                names=["sequence_id", "offset", "ids"])

    cut = (pick(docs, "doc_id", "text").join(packed, "doc_id").select("text", "start", "length", "sequence_id", "offset")
           .mapInArrow(run, "sequence_id long, offset long, ids array<int>"))
    return cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
