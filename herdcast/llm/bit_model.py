"""Bit predictors over hashed contexts, mixed by gated logistic weights and refined by an adaptive map.

Pure numpy on arrays of words. A word is coded as its bytes and one terminator, bit by bit. Four predictors
share one hashed table, sized by the contexts counted: position, and the one, two and three bytes before, which reach
over the space into the word before. Only the first HEAD bytes of a word see that far. A fifth predictor
knows the word's whole prefix: it is counted exactly over sorted words (prefix_counts). Each turns the counts of zeros
and ones under its context into a log-odds. The gate, how sure the longest two contexts are, picks the
weights that mix them. All contexts also hold the kind of the document: its commonest character beyond
ASCII, hashed, which mostly tells its language.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

LOW_BITS, PREFIX_BITS = 22, 23         # LOW_BITS: the least size of the shared table
SAMPLED = 256                          # one context in so many is kept to estimate how many there are
ORDERS, INPUTS = 4, 6                  # inputs: four orders, the prefix, a constant
SURE, STEPS = 6, 33                    # levels of certainty; steps of the adaptive map
GATES = SURE * SURE
HEAD = 2                               # bytes of a word, its start, whose contexts hold bytes of the word before
KINDS = 8
#: Counts are kept as bytes on a logarithmic scale.
SCALE = 8.0
COUNTS = np.expm1(np.arange(256) / SCALE * np.log(2.0)).astype(np.float32)


def squeeze(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes; any count above zero stays above zero."""
    return np.minimum(255, np.ceil(SCALE * np.log2(1.0 + counts))).astype(np.uint8)


@dataclass
class Tables:
    low: tuple[np.ndarray, np.ndarray]                        # zeros, ones
    prefix: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None      # zeros, ones, check byte
    pairs: tuple[np.ndarray, np.ndarray] | None = None        # log-odds and level by a slot's two bytes, made where first used


@dataclass
class Mixer:
    weights: np.ndarray                                       # gates x inputs
    refine: np.ndarray                                        # gates x steps, probabilities

    @staticmethod
    def fresh() -> Mixer:
        w = np.full((GATES, INPUTS), 0.2)
        w[:, INPUTS - 1] = 0.0
        steps = 1 / (1 + np.exp(-(np.arange(STEPS) - STEPS // 2) / 2.0))
        return Mixer(w, np.tile(steps, (GATES, 1)))


@dataclass
class Bits:
    """All bits of some words, a row each: table slots by predictor, the bit, the word (or the node, see Nodes) it is of."""
    low: np.ndarray
    prefix: np.ndarray | None
    check: np.ndarray | None
    bit: np.ndarray
    word: np.ndarray


def kind_of(text: bytes) -> int:
    """0 for a text that is all but ASCII, else 1 to 7 by its commonest two-byte lead."""
    if text.isascii():
        return 0
    data = np.frombuffer(text, np.uint8)
    lead = np.flatnonzero(data[:-1] >= 0xC0) if len(data) else data
    if len(lead) * 200 < len(data) or not len(lead):
        return 0
    counts = np.bincount(data[lead].astype(np.int64) * 256 + data[lead + 1])
    return 1 + int(np.argmax(counts) * 2654435761 % (1 << 32) >> 16) % (KINDS - 1)


@dataclass
class Nodes:
    """The bytes of sorted words. Neighbours that begin alike share the bytes of that beginning, with all their contexts: one node."""
    data: np.ndarray
    word: np.ndarray                                          # of each byte
    place: np.ndarray                                         # of each byte in its word
    back: np.ndarray                                          # by word, as in shared_bits
    node: np.ndarray                                          # of each byte
    first: np.ndarray                                         # by node, the byte that stands for it

    @staticmethod
    def of(coded: list[bytes], kinds: np.ndarray) -> Nodes:
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        starts = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(coded)), lengths)
        place = np.arange(len(word)) - starts[word]
        back = shared_bits(coded, kinds)
        whole = np.maximum(back, 0) // 8
        new = place >= whole[word]
        node = np.cumsum(new) - 1
        depth = np.maximum(whole, np.append(whole[1:], 0))
        open_ = np.arange(len(coded))
        for t in range(int(whole.max(initial=0))):
            open_ = open_[depth[open_] > t]
            at = starts[open_] + t
            node[at] = node[at[np.maximum.accumulate(np.where(whole[open_] <= t, np.arange(len(open_)), 0))]]
        return Nodes(np.frombuffer(b"".join(coded), np.uint8), word, place, back, node, np.flatnonzero(new))

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """Weight of the words through each node."""
        return np.bincount(self.node, weight[self.word], len(self.first))[:len(self.first)]

    def totals(self, each: np.ndarray) -> np.ndarray:
        """By word, the sum of what ``each`` of its nodes has."""
        return np.bincount(self.word, np.append(each, 0.0)[self.node])

    def beyond(self, head: int) -> Nodes:
        """Without the nodes of the words' first bytes; these are of one behind the last."""
        kept = self.place[self.first] >= head
        node = np.where(kept, np.cumsum(kept) - 1, kept.sum())
        return Nodes(self.data, self.word, self.place, self.back, node[self.node], self.first[kept])


def bits_of(words: list[bytes], kinds: np.ndarray, end: bytes) -> Bits:
    """``end`` is the token that has no bytes of its own; other words close with a space."""
    return bits_of_coded([w if w == end else w + b" " for w in words], kinds)


def bits_of_coded(coded: list[bytes], kinds: np.ndarray, low_bits: int = LOW_BITS, hashed: bool = True, nodes: Nodes | None = None,
                  before: np.ndarray | None = None) -> Bits:
    """Words that have their terminator. ``hashed``: with the slots of prefix_table. With the words' ``nodes``, the bits are of these.
    ``before``: the two bytes before the space in front of each word; without them, spaces, as where a text begins."""
    behind = np.full((len(coded), 3), ord(" "), np.uint64)
    if before is not None:
        behind[:, :2] = before
    data = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(coded) else np.zeros(0, np.int64)
    word = np.repeat(np.arange(len(coded)), lengths)
    place = np.arange(len(data)) - starts[word] if len(data) else np.zeros(0, np.int64)
    one = np.uint64(1)
    kind = np.asarray(kinds, np.uint64)[word]
    contexts = [kind + np.uint64(KINDS) * np.minimum(place, 15).astype(np.uint64)]
    seen = kind
    for back in range(1, ORDERS):
        earlier = np.zeros(len(data), np.uint64)
        earlier[back:] = data[:-back] + one
        over = np.flatnonzero(place < back)
        earlier[over] = behind[word[over], place[over] - back] + one
        seen = seen * np.uint64(257) + earlier
        contexts.append(seen)
    own = data.astype(np.uint8)
    if nodes is not None:
        own, contexts, word = own[nodes.first], [c[nodes.first] for c in contexts], np.arange(len(nodes.first))
    shifts = np.arange(8, dtype=np.uint64)
    inside = (one << shifts)[None, :] | (np.arange(256, dtype=np.uint64)[:, None] >> (np.uint64(8) - shifts)[None, :])
    bit = np.unpackbits(own)
    low = np.empty((ORDERS, len(bit)), np.int32)
    spread = (inside * np.uint64(0xC2B2AE3D27D4EB4F))[own]               # what of the byte is known at each bit
    for k, context in enumerate(contexts):
        low[k] = _slots(context * np.uint64(4) + np.uint64(k), spread) >> np.uint64(64 - low_bits)
    if not hashed:
        return Bits(low, None, None, bit, np.repeat(word, 8))
    longest = int(lengths.max()) if len(coded) else 0
    power = np.ones(longest + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(longest, 0x100000001B3, np.uint64)) if longest else power[1:]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + one) * power[place], dtype=np.uint64)])
    whole = (total[:-1] - total[starts[word]]) + (place.astype(np.uint64) * np.uint64(KINDS) + kind) * np.uint64(0x9E3779B97F4A7C15) if len(data) else seen
    h = _slots(whole, spread)
    return Bits(low, (h >> np.uint64(64 - PREFIX_BITS)).astype(np.int32),
                ((h >> np.uint64(20)) & np.uint64(255)).astype(np.uint8), bit, np.repeat(word, 8))


def _slots(context: np.ndarray, spread: np.ndarray) -> np.ndarray:
    h = ((context * np.uint64(0x9E3779B97F4A7C15))[:, None] + spread).ravel()
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def low_bits_for(contexts: int) -> int:
    """Size of the shared table, as a power of two: at least twice as many slots as contexts."""
    return max(LOW_BITS, math.ceil(math.log2(max(1, 2 * contexts))))


def lcp_bits(x: bytes, y: bytes) -> int:
    """Leading bits two different words, neither the other's beginning, have in common."""
    at = next(i for i in range(0, len(x), 4096) if x[i:i + 4096] != y[i:i + 4096])
    at = next(i for i in range(at, len(x)) if x[i] != y[i])
    return at * 8 + 8 - (x[at] ^ y[at]).bit_length()


def shared_bits(coded: list[bytes], kinds: np.ndarray, most: int = 32) -> np.ndarray:
    """Leading bits each of the sorted words shares with the one before; -1 for the first, and across kinds."""
    n = len(coded)
    first = np.frombuffer(b"".join(w[:most].ljust(most, b"\0") for w in coded), np.uint8).reshape(n, most)
    differ = first[1:] ^ first[:-1]
    at = (differ != 0).argmax(axis=1)
    byte = differ[np.arange(n - 1), at]
    out = np.full(n, -1, np.int64)
    out[1:] = at * 8 + 7 - np.floor(np.log2(np.maximum(byte, 1))).astype(np.int64)
    same = kinds[1:] == kinds[:-1]
    for i in np.flatnonzero((byte == 0) & same):
        out[i + 1] = lcp_bits(coded[i], coded[i + 1])
    out[1:][~same] = -1
    return out


#: Counts of zeros and ones along the first word's path that lie before a slice, and along the last word's path behind it.
NOTHING = (np.zeros((2, 0)), np.zeros((2, 0)))


def node_counts(nodes: Nodes, weight: np.ndarray, beyond=NOTHING) -> np.ndarray:
    """Zeros and ones (2 x nodes x 8) counted under the whole prefix of each bit of the nodes of these words.

    The words are a slice of all words in order of kind and bytes, so those with a common prefix are
    neighbours; ``beyond`` holds what the other slices add to the prefixes that reach over the slice's ends.
    """
    total, place, back = nodes.sums(weight), nodes.place[nodes.first], nodes.back[nodes.word[nodes.first]]
    order = np.argsort(place, kind="stable")                     # nodes after the same bytes are neighbours
    bit = np.unpackbits(nodes.data[nodes.first]).reshape(-1, 8)
    paths = [nodes.node[nodes.word == w] for w in (0, nodes.word[-1])]
    out = np.empty((2, len(order), 8))
    group = np.empty(len(order), np.int64)
    for t in range(8):
        group[order] = np.cumsum(back[order] < place[order] * 8 + t) - 1
        for side in (0, 1):
            sums = np.bincount(group, total * (bit[:, t] == side))
            for path, more in zip(paths, beyond, strict=True):
                own = more[side, t::8]
                sums[group[path[:len(own)]]] += own
            out[side, :, t] = sums[group]
    return out


def prefix_counts(coded: list[bytes], kinds: np.ndarray, weight: np.ndarray, beyond=NOTHING) -> np.ndarray:
    """node_counts of every bit of these words (2 x bits)."""
    nodes = Nodes.of(coded, kinds)
    return node_counts(nodes, weight, beyond)[:, nodes.node].reshape(2, -1)


def end_paths(coded: list[bytes], kinds: np.ndarray, weight: np.ndarray, before: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """What prefix_counts gives for the first word's bits up to number ``before``, and for the last word's up to ``after``."""
    back = shared_bits(coded, kinds)[1:]

    def path(word: bytes, shared: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
        """``shared``: the bits other words have in common with it; ``weight``: of the word and of those."""
        leave = np.bincount(np.minimum(np.append(most + 1, shared), most + 1) + 1, weight, most + 3)[1:]    # the path, by bit
        at, bit = np.arange(most + 1), np.unpackbits(np.frombuffer(word, np.uint8))[:most + 1]
        counts = np.empty((2, most + 1))
        counts[bit, at], counts[1 - bit, at] = np.cumsum(leave[::-1])[::-1][1:], leave[:-1]
        return counts

    return (path(coded[0], np.minimum.accumulate(back), weight, before),
            path(coded[-1], np.minimum.accumulate(back[::-1]), weight[::-1], after))


def beyond_ends(ends: list[tuple], paths: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``beyond`` of each slice. ``ends``: shared bits with the slice before (-1: none) and of its own first and last word;
    ``paths``: the slice's own counts along its first word, as far as it is shared with the slice before, and along its last."""
    n = len(ends)
    before, after = [np.zeros((2, ends[i][0] + 1)) for i in range(n)], [None] * n
    for i in range(1, n):
        before[i] = paths[i - 1][1].copy()
        m = min(ends[i - 1][0], ends[i - 1][1], ends[i][0]) + 1
        before[i][:, :m] += before[i - 1][:, :m]
    after[n - 1] = np.zeros((2, 0))
    for i in range(n - 2, -1, -1):
        after[i] = paths[i + 1][0].copy()
        m = min(ends[i + 1][1], after[i + 1].shape[1] - 1, ends[i + 1][0]) + 1
        after[i][:, :m] += after[i + 1][:, :m]
    return list(zip(before, after, strict=True))


def byte_sums(weight: np.ndarray) -> np.ndarray:
    """Sums of weights by byte (... x 256) under a byte's leading bits (... x 512, by these bits behind a one)."""
    out = np.zeros((*weight.shape[:-1], 512))
    out[..., 256:] = weight
    for size in (128, 64, 32, 16, 8, 4, 2, 1):
        out[..., size:2 * size] = out[..., 2 * size:4 * size:2] + out[..., 2 * size + 1:4 * size:2]
    return out


def start_counts(nodes: Nodes, kinds: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """node_counts (2 x bits) of words' starts, by the ``weight`` (kinds x 256 x 256) of all words that begin with two bytes."""
    at = nodes.first
    kind, own, lead = kinds[nodes.word[at]], nodes.data[at].astype(np.int64), nodes.data[at - nodes.place[at]]
    inside = 2 * ((1 << np.arange(8)) | own[:, None] >> (8 - np.arange(8)))
    first, second, begins = byte_sums(weight.sum(axis=2)), byte_sums(weight), (nodes.place[at] == 0)[:, None]
    return np.array([np.where(begins, first[kind[:, None], inside + side], second[kind[:, None], lead[:, None], inside + side]).ravel() for side in (0, 1)])


def sampled_contexts(coded: list[bytes], kinds: np.ndarray, nodes: Nodes, before: np.ndarray | None = None) -> np.ndarray:
    """Hashes of about one in SAMPLED of the contexts that share the table, for sorted words."""
    bits = bits_of_coded(coded, kinds, 31, hashed=False, nodes=nodes, before=before)
    return np.unique(np.concatenate([low[low % SAMPLED == 0] for low in bits.low]))


def count_low(bits: Bits, weight: np.ndarray, zeros: np.ndarray, ones: np.ndarray, place: int = 0) -> None:
    """Adds the words' weights to the counts of the shared table, or of its range number ``place`` as long as the arrays."""
    w = weight[bits.word]
    on = bits.bit == 1
    for slots in bits.low:
        slots = slots - place * len(zeros)
        own = (slots >= 0) & (slots < len(zeros))
        for counts, side in ((zeros, own & ~on), (ones, own & on)):
            np.add.at(counts, slots[side].astype(np.intp), w[side])      # in place: bincount would make an array of the whole range


def prefix_table(words: list[bytes], kinds: np.ndarray, weight: np.ndarray, end: bytes, block: int = 20_000):
    """Counts of all prefixes of a few words by hash, to code words outside the vocabulary; where two share a slot, the
    one met first keeps it."""
    zeros, ones = np.zeros(1 << PREFIX_BITS, np.float32), np.zeros(1 << PREFIX_BITS, np.float32)
    check, taken = np.zeros(1 << PREFIX_BITS, np.uint8), np.zeros(1 << PREFIX_BITS, bool)
    for at in range(0, len(words), block):
        bits = bits_of(words[at:at + block], kinds[at:at + block], end)
        slots, first, place = np.unique(bits.prefix, return_index=True, return_inverse=True)
        new = ~taken[slots]
        check[slots[new]] = bits.check[first[new]]
        taken[slots] = True
        w = weight[at:at + block][bits.word] * (check[bits.prefix] == bits.check)
        zeros[slots] += np.bincount(place, w * (bits.bit == 0), len(slots)).astype(np.float32)
        ones[slots] += np.bincount(place, w * (bits.bit == 1), len(slots)).astype(np.float32)
    return squeeze(zeros), squeeze(ones), check


def inputs_of(bits: Bits, tables: Tables, prefix: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds by predictor (inputs x bits), and the gate of each bit. ``prefix``: counts by prefix_counts, else the table's."""
    x = np.empty((INPUTS, len(bits.bit)), np.float32)

    def odds(n0: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, one_way = n0 + n1, (n0 == 0) | (n1 == 0)
        level = np.where(total == 0, 0, np.where(one_way, 1 + (total > 1.5) + (total > 12), 4 + (total > 200)))
        return np.log((n1 + 0.02) / (n0 + 0.02)), level.astype(np.int8)

    if tables.pairs is None:
        tables.pairs = tuple(a.ravel() for a in odds(np.repeat(COUNTS, 256), np.tile(COUNTS, 256)))
    for k in range(ORDERS):
        pair = tables.low[0][bits.low[k]].astype(np.uint16) << 8 | tables.low[1][bits.low[k]]
        x[k] = tables.pairs[0][pair]
    sure_low = tables.pairs[1][pair]
    if prefix is None:
        own = tables.prefix[2][bits.prefix] == bits.check
        prefix = COUNTS[tables.prefix[0][bits.prefix] * own], COUNTS[tables.prefix[1][bits.prefix] * own]
    x[ORDERS], sure_high = odds(*prefix)
    x[INPUTS - 1] = 0.3
    return np.clip(x, -12, 12, out=x), (sure_high * SURE + sure_low).astype(np.int64)


def mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mixed log-odds of a one."""
    total = np.zeros(len(gate))
    for own, w in zip(x, weights.T, strict=True):            # a row at a time: weights[gate] would be the largest array of a worker
        total += own * w[gate]
    return np.clip(total, -14, 14, out=total)


def learn(parts, mixer: Mixer, rate: float) -> np.ndarray:
    """One online step: each gate's weights move along their coding error, scaled by its curvature. The step's bits come in
    ``parts`` (inputs, gate, bit, weight), of which one is held at a time. Returns the weight met by each gate."""
    bend, slope, mass = np.zeros((GATES, INPUTS, INPUTS)), np.zeros((GATES, INPUTS)), np.zeros(GATES)
    for x, gate, bit, weight in parts:
        p = 1 / (1 + np.exp(-mixed(x, gate, mixer.weights)))
        error, curve = (bit - p) * weight, np.maximum(p * (1 - p), 1e-4) * weight
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        edges = np.searchsorted(gate[order], np.arange(GATES + 1))
        for g in np.flatnonzero(edges[1:] > edges[:-1]):
            own = order[edges[g]:edges[g + 1]]
            xs = x[:, own].astype(float)
            bend[g] += (xs * curve[own]) @ xs.T
            slope[g] += xs @ error[own]
            mass[g] += weight[own].sum()
    for g in np.flatnonzero(mass):
        mixer.weights[g] += rate * np.linalg.solve(bend[g] + np.eye(INPUTS) * (1e-3 * mass[g] + 1.0), slope[g])
    return mass


def steps_of(odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower step of the adaptive map, and how far towards the next."""
    at = np.clip(odds * 2.0 + STEPS // 2, 0, STEPS - 1.001)
    low = at.astype(np.int64)
    return low, at - low


def log2_cost(bits: Bits, tables: Tables, mixer: Mixer, n_words: int, prefix: np.ndarray | None = None) -> np.ndarray:
    """Bits each word takes."""
    x, gate = inputs_of(bits, tables, prefix)
    odds = mixed(x, gate, mixer.weights)
    low, part = steps_of(odds)
    table = mixer.refine.ravel()
    refined = table[gate * STEPS + low] * (1 - part) + table[gate * STEPS + low + 1] * part
    p = np.clip(0.5 / (1 + np.exp(-odds)) + 0.5 * refined, 1e-6, 1 - 1e-6)
    return np.bincount(bits.word, -np.log2(np.where(bits.bit == 1, p, 1 - p)), n_words)
