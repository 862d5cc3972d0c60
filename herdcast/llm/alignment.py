"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers cut the same bytes; their tokens are linked where their byte ranges overlap, and fall into groups between
the offsets at which both end. Documents get a place (``range_``, ``slot``) in ranges of at most 8192. For every pair
of ids a range has a bitmap of the documents that hold the pair linked, and multiplicity planes: plane k
holds the documents whose number of links beyond the first has bit k set. A bitmap is a list of slots while
that is shorter than the plain bits.

Every task ORs the bitmaps of its documents range by range, so ranges never share a document and a pair's bitmap over the
corpus is the sequence of its ranges: its document and link counts are sums of popcounts, partly summed before the
shuffle. The postings then take each pair's count back to the documents: one range at a time adds
``count`` and ``best`` of its pairs to dense counters of at most 8192 documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdcast.llm.byte_bpe import ByteBpe
from herdcast.llm.common import columns_of, materialise, pick

RANGE = 8192                    # documents of a range
SLOT_BITS = 13
B_BITS = 15                     # of a pair's number, for the second tokenizer's id
POSTINGS = 2_000_000            # (pair, document) entries a task holds before it closes a range early
CHUNK = 1 << 20                 # characters aligned at once
LONG = 1 << 18                  # texts of more characters are cut where neither tokenizer joins

INDEX = ("range_ long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pair long, plane int, ones long, bits binary")


def packed_bits(slots: np.ndarray) -> bytes:
    """A bitmap of distinct ascending slots: two bytes a slot, or RANGE / 8 bytes if that is not longer."""
    if 2 * len(slots) < RANGE // 8:
        return slots.astype("<u2").tobytes()
    flags = np.zeros(RANGE, bool)
    flags[slots] = True
    return np.packbits(flags).tobytes()


def slots_of(bits: bytes) -> np.ndarray:
    if len(bits) < RANGE // 8:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8)))


class Aligner:
    """Both tokenizers, and the alignment of texts under them."""

    def __init__(self, rules: str, model: bytes):
        import regex
        import sentencepiece
        self.a = ByteBpe(rules, special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        if len(pieces) > 1 << B_BITS:
            raise ValueError(f"more than {1 << B_BITS} ids")
        self.lengths = [np.array([len(x) for x in table], np.int64) for table in (self.a.bytes, self.b_bytes)]
        joins = any("▁" in p.lstrip("▁") for p in pieces)
        self.gap = None if joins or self.a.fast is None else regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
        self.second = 2 * len(self.a.bytes)               # where the second tokenizer's strings begin
        self.strings = [b"%d%c" % (i, end) for table, ends in ((self.a.bytes, b",|"), (self.b_bytes, b",;"))
                        for i in range(len(table)) for end in ends]

    def segments(self, text: str) -> list[str]:
        """Parts of a long text between single spaces at which no token of either kind goes on."""
        if self.gap is None or len(text) <= LONG:
            return [text]
        cuts, at = [0], 0
        while len(text) - at > LONG:
            found = self.gap.search(text, at + LONG)
            if found is None:
                break
            at = found.end()
            cuts.append(at)
        return [text[i:j - 1] for i, j in zip(cuts, cuts[1:], strict=False)] + [text[cuts[-1]:]]

    def align(self, texts: list[str]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, group string with a last ;, linked pairs) of each text; None where bytes differ."""
        ids_a, ids_b = [self.a.ids(" " + t) for t in texts], self.b.encode(texts)
        good = []
        for k, t in enumerate(texts):
            raw = (" " + t).encode("utf-8", "surrogatepass")
            if b"".join(map(self.a.bytes.__getitem__, ids_a[k])) == raw == b"".join(map(self.b_bytes.__getitem__, ids_b[k])):
                good.append(k)
        out: list[tuple | None] = [None] * len(texts)
        if not good:
            return out
        counts = [np.array([len(x[k]) for k in good]) for x in (ids_a, ids_b)]
        a, b = (np.fromiter((i for k in good for i in x[k]), np.int64, int(n.sum())) for x, n in zip((ids_a, ids_b), counts, strict=True))
        end_a, end_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        is_a, is_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_a[-1] + 1, bool)
        is_a[end_a], is_b[end_b] = True, True
        both = is_a & is_b
        at = np.flatnonzero(is_a | is_b)                  # a link ends at each offset where a token ends
        link_a = a[np.cumsum(is_a)[at] - is_a[at]]
        link_b = b[np.cumsum(is_b)[at] - is_b[at]]
        pairs = link_a << B_BITS | link_b
        before = np.cumsum(both)
        group_a, group_b = before[end_a] - both[end_a], before[end_b] - both[end_b]
        n_groups = int(before[-1])
        upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=n_groups)) for g in (group_a, group_b))
        last_a, last_b = (np.append(g[1:] != g[:-1], True) for g in (group_a, group_b))
        said = np.empty(len(a) + len(b), np.int64)
        said[np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]] = 2 * a + last_a
        said[np.arange(len(b)) + upto_a[group_b]] = self.second + 2 * b + last_b
        edge_a, edge_b = (np.concatenate([[0], np.cumsum(n)]) for n in counts)
        ends = end_a[edge_a[1:] - 1]
        links = np.concatenate([[0], np.searchsorted(at, ends, "right")])
        groups = np.diff(np.concatenate([[0], before[ends]]))
        strings = self.strings.__getitem__
        for j, k in enumerate(good):
            lo, hi = edge_a[j] + edge_b[j], edge_a[j + 1] + edge_b[j + 1]
            out[k] = (int(counts[0][j]), int(counts[1][j]), int(groups[j]), b"".join(map(strings, said[lo:hi].tolist())),
                      pairs[links[j]:links[j + 1]])
        return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Range:
    """Links of the documents of one range: sorted (pair, slot) numbers and how many links each has."""

    def __init__(self):
        self.used = self.held = 0
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, slots: list[int], pairs: list[np.ndarray]) -> None:
        if pairs:
            keys = np.concatenate([p << SLOT_BITS | s for s, p in zip(slots, pairs, strict=True)])
            self.parts.append(np.unique(keys, return_counts=True))
            self.held += len(self.parts[-1][0])

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """The bitmaps of all parts in one: documents are ORed, links added."""
        if len(self.parts) > 1:
            self.parts = [_summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))]
            self.held = len(self.parts[0][0])
        return self.parts[0] if self.parts else (np.empty(0, np.int64), np.empty(0, np.int64))

    def rows(self) -> Iterator[tuple[int, int, int, bytes]]:
        """(pair, plane, ones, bits): plane 0 are the documents, plane k + 1 bit k of their further links."""
        keys, counts = self.merge()
        yield from _plane(keys, 0)
        plane, further = 1, counts - 1
        while (more := further > 0).any():
            keys, further = keys[more], further[more]
            yield from _plane(keys[further & 1 == 1], plane)
            plane, further = plane + 1, further >> 1


def _plane(keys: np.ndarray, plane: int) -> Iterator[tuple[int, int, int, bytes]]:
    if len(keys):
        pair, slot = keys >> SLOT_BITS, keys & (RANGE - 1)
        edges = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1], [True]]))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(pair[lo]), plane, hi - lo, packed_bits(slot[lo:hi])


def _long_text(aligner: Aligner, text: str, slot: int, own: Range) -> tuple[tuple[int, ...], str]:
    """Sizes and digest of a long text, aligned part by part; its links go to ``own`` if all parts are sound."""
    digest, sizes, links = hashlib.sha256(), np.zeros(4, np.int64), Range()
    for k, part in enumerate(aligner.segments(text)):
        got = aligner.align([part])[0]
        if got is None:
            return (0, 0, 0, 0), ""
        n_a, n_b, n_groups, said, pairs = got
        sizes += (n_a, n_b, n_groups, len(pairs))
        digest.update(b";" * (k > 0) + said[:-1])
        links.add([slot], [pairs])
        links.merge()
    own.parts += links.parts
    own.held += links.held
    return tuple(sizes.tolist()), digest.hexdigest()


def index(docs: DataFrame, rules: str, model: bytes) -> DataFrame:
    """Rows of every document (``pair`` null) and of every range's bitmaps (``slot`` null), written once.

    ``rules`` is the content of a tokenizers file (byte-level BPE), ``model`` that of a sentencepiece file. A text that
    is null or empty, or that one of them does not give back byte by byte, has no tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        aligner, own, number, slot = Aligner(rules, model), Range(), TaskContext.get().partitionId() << 32, 0

        def batch(rows: list[tuple], of_docs: bool) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.int64(), pa.int32(), pa.int64(), pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (8 if of_docs else 4)
            empty = [[None] * len(rows)] * (4 if of_docs else 7)
            columns = [*columns, *empty] if of_docs else [[number] * len(rows), *empty, *columns]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=[c.split()[0] for c in INDEX.split(", ")])

        def postings() -> Iterator[pa.RecordBatch]:
            rows = []
            for row in own.rows():
                rows.append(row)
                if len(rows) == 20_000:
                    yield batch(rows, False)
                    rows = []
            yield batch(rows, False)

        def chunks(ids: list, texts: list) -> Iterator[list[tuple[int | None, str]]]:
            some, size = [], 0
            for doc, text in zip(ids, texts, strict=True):
                some.append((doc, text or ""))
                size += len(text or "")
                if size >= CHUNK or len(some) == RANGE // 8:
                    yield some
                    some, size = [], 0
            yield some

        for ids, texts in columns_of(batches, ("doc_id", "text")):
            for some in chunks(ids, texts):
                if slot + len(some) > RANGE or own.held > POSTINGS:
                    own.merge()
                    if slot + len(some) > RANGE or own.held > POSTINGS // 2:
                        yield from postings()
                        own, number, slot = Range(), number + 1, 0
                out = []
                short = [k for k, (_, text) in enumerate(some) if 0 < len(text) <= LONG]
                found = dict(zip(short, aligner.align([some[k][1] for k in short]) if short else [], strict=True))
                for k, (doc, text) in enumerate(some):
                    sizes, digest = (0, 0, 0, 0), ""
                    if (got := found.get(k)) is not None:
                        n_a, n_b, n_groups, said, pairs = got
                        sizes, digest = (n_a, n_b, n_groups, len(pairs)), hashlib.sha256(said[:-1]).hexdigest()
                    elif len(text) > LONG:
                        sizes, digest = _long_text(aligner, text, slot + k, own)
                    out.append((number, slot + k, doc, *sizes, digest))
                linked = [k for k in short if found[k] is not None]
                own.add([slot + k for k in linked], [found[k][4] for k in linked])
                slot += len(some)
                yield batch(out, True)
        yield from postings()

    source = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(source.mapInArrow(run, INDEX), "pair-index")


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n_docs, n_links of every linked pair, and whether none with its b_id has more links (``best``)."""
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    counts = (found.where("pair IS NOT NULL").groupBy("pair")
              .agg(F.sum(F.when(F.col("plane") == 0, F.col("ones"))).alias("n_docs"), F.sum(F.col("ones") * weight).alias("n_links"))
              .select("pair", F.shiftright("pair", B_BITS).alias("a_id"), F.expr(f"pair & {(1 << B_BITS) - 1}").alias("b_id"), "n_docs", "n_links"))
    most = counts.groupBy("b_id").agg(F.max("n_links").alias("most_"))     # a row per id of the second vocabulary
    return counts.join(most, "b_id").select("pair", "a_id", "b_id", "n_docs", "n_links", (F.col("n_links") == F.col("most_")).alias("best"))


def document_scores(found: DataFrame, counts: DataFrame) -> DataFrame:
    """range_, slot, n_best, count_sum: what the postings of every pair bring back to its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, best, total = None, np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)

        def done() -> pa.RecordBatch:
            at = np.flatnonzero(total)
            arrays = [np.full(len(at), current if current is not None else 0, np.int64), at.astype(np.int32), best[at], total[at]]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["range_", "slot", "n_best", "count_sum"])

        for rows in columns_of(batches, ("range_", "plane", "bits", "n_links", "best")):
            for number, plane, bits, links, top in zip(*rows, strict=True):
                if number != current:
                    yield done()
                    current, best, total = number, np.zeros(RANGE, np.int64), np.zeros(RANGE, np.int64)
                at, weight = slots_of(bits), 1 << max(0, plane - 1)
                total[at] += weight * links
                if top:
                    best[at] += weight
        yield done()

    postings = found.where("pair IS NOT NULL").select("range_", "pair", "plane", "bits")
    scored = postings.join(counts.select("pair", "n_links", "best"), "pair").drop("pair")
    return (scored.repartition("range_").sortWithinPartitions("range_")
            .mapInArrow(run, "range_ long, slot int, n_best long, count_sum long"))


def align_tokenizers(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    ``byte_bpe`` and ``piece_bpe`` are the paths of the vocabulary files. Null, empty and blank-only texts: a null or
    empty text has no tokens, zeros and an empty digest, as has one that a tokenizer does not give back byte by byte. Long texts
    are aligned in parts, cut where neither tokenizer joins. Repeated rows, and rows without id, are documents each and count
    as such. Ties for a B id's highest count are all best. An empty table gives an empty one. Other columns are ignored.
    """
    with open(byte_bpe, encoding="utf-8") as f:
        rules = f.read()
    with open(piece_bpe, "rb") as f:
        model = f.read()
    found = index(docs, rules, model)
    scores = document_scores(found, pair_counts(found))
    own = found.where("pair IS NULL").select("range_", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return own.join(scores, ["range_", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", or_zero("n_best"), or_zero("count_sum"), "groups_sha256")
