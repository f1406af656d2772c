"""Scores of texts by online logistic context mixing, beside a unigram baseline.

A text is its lower-cased tokens: words, each closed by a blank, then one end
byte.  The model predicts that byte stream bit by bit, where a byte's bits are
its path in a Huffman tree of the corpus's bytes.  Predictors, each a table of
bit probabilities under a hashed context:

- ``pair``: the last two bytes; ``triple``: a hash of the last three bytes;
- ``word``: a hash of the word's bytes so far, so whole frequent words;
- ``match``: the word that followed the last two words earlier in the same
  document, as long as the bytes agree.

Their predictions are mixed in the logistic domain by weights that a gate
selects (place in the word, how often its word context was seen, and how well
the match did before), learned online; then
each document refines the mix for itself, by a scale and a shift per gate that
are updated after every block of it (the first after ``BLOCK`` bytes, then each
time it is four times as long).  A document's score depends on its own text
alone, and adds up log probabilities of every bit.

What is gathered comes from all training documents, by partial tables and sums
that Spark adds up: bit tables, token counts, and the tally that the weights are
learned from.  The tables' and the tally's size is fixed (``2**16`` slots for
pair and triple, ``2**WORD_BITS`` for word, ``TALLY`` counts), so they may come
to the driver and be broadcast; token counts grow with the corpus and are only
ever joined.  Training documents are split into halves by their id's hash, with
tables for each: a document's bits are tallied under the tables of the half it
is not in, by gate, by its predictions (in 32 steps each) and by value.  The
weights are the logistic regression over the whole tally, gate by gate.  Texts
are scored with the tables of both halves together.  As the tables do not grow,
contexts beyond some millions share slots of the word table.

Token counts reach documents without a row per document and word: texts are
taken in runs of about ``run_bytes``, and a run's distinct tokens are dealt into
buckets by their hash, a row with lists per run and bucket.  Counting and
looking up work bucket by bucket, and a run's counts come back to it.  There are
``buckets_each`` buckets to an input partition, so buckets grow in number and
not in size.

Defined results: a null or empty text is the end token alone; repeated rows are
scored alike; with no training documents every count is 0, the end token too,
and the tables predict evenly; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import LOWER, SOLID, Cache, buffers, give_back, mix, runs
from metricstore.llm.store import stored
from metricstore.sinks.store import session_settings

WORD_BITS = 22
CHUNK = 1 << 18  # entries of a table that are added up together
HOLD = 1 << 18  # entries or keys that a task holds before it adds them up
BLOCK = 512
HELD = 64
GATES = 36
PREDICTORS = 4
TALLY = GATES * 32**3 * 3 * 2  # gate, three predictions in 32 steps, the match's, value
_STEP = 1 << 14  # bytes mixed at a time
_PART = 1 << 18  # bytes of whole documents whose contexts are made together
_SCALE = 16.0  # stretched probabilities are kept as sixteenths, in one byte
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_SPACE, _END = 0x20, 0x0A
START = np.array([0.2, 0.3, 0.5, 1, 0], np.float32)  # weights without any training document
#: Rows of whole runs go to Python one by one.
_SINGLE = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20)}
_powers: dict[str, np.ndarray] = Cache()


class Stream:
    """The byte stream of a run of texts: ``x``, and where each document starts."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        low = LOWER[buf]
        solid = SOLID[low]
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        begin = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens[begin] = solid[begin]
        at = np.flatnonzero(solid)
        self.packed = low[at]
        word_at = np.flatnonzero(opens[at])  # where words start among the solid bytes
        n_solid = np.searchsorted(at, offsets)
        n_word = np.searchsorted(word_at, n_solid)
        self.words = np.diff(n_word)  # of each document
        self.word_offsets = np.append(word_at, len(at)).astype(np.int32)
        # A solid byte moves right by the words before its own and the documents before its own.
        step = np.zeros(len(at), np.int32)
        step[word_at[1:]] = 1
        some = n_solid[:-1] < n_solid[1:]
        ended = np.diff(np.flatnonzero(some), prepend=0)  # documents ended since the one before with words
        step[n_solid[:-1][some]] += ended.astype(np.int32)
        ends = n_solid[1:] + n_word[1:] + np.arange(len(offsets) - 1)
        self.x = np.full(int(ends[-1]) + 1, _SPACE, np.uint8)
        self.x[np.arange(len(at), dtype=np.int64) + np.cumsum(step)] = self.packed
        self.x[ends] = _END
        self.starts = np.concatenate([[0], ends[:-1] + 1])
        self.sizes = ends + 1 - self.starts

    @classmethod
    def of(cls, col: pa.Array) -> Stream:
        """The stream of a column, made from pieces of it so that memory beyond the stream's own stays small."""
        parts = list(streams(col))
        if len(parts) == 1:
            return parts[0]
        whole = cls.__new__(cls)
        before = np.cumsum([0] + [len(s.x) for s in parts])
        solid = np.cumsum([0] + [len(s.packed) for s in parts])
        whole.x, whole.packed, whole.words, whole.sizes = (
            np.concatenate([getattr(s, k) for s in parts]) for k in ("x", "packed", "words", "sizes"))
        whole.starts = np.concatenate([s.starts + n for s, n in zip(parts, before)])
        whole.word_offsets = np.concatenate(
            [s.word_offsets[:-1] + n for s, n in zip(parts, solid)] + [solid[-1:]]).astype(np.int32)
        return whole

    def tokens(self) -> pa.DictionaryArray:
        """The words, in order, as codes of the distinct ones."""
        n = len(self.word_offsets) - 1
        return pa.StringArray.from_buffers(
            n, pa.py_buffer(self.word_offsets), pa.py_buffer(np.ascontiguousarray(self.packed))).dictionary_encode()


def streams(col: pa.Array) -> Iterator[Stream]:
    """Streams of whole documents, about ``_PART`` bytes each."""
    for _, _, buf, offs in runs(col, _PART):
        yield Stream(buf, offs)


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 18), base, np.uint64)
        have[0] = 1
        have = _powers[name] = np.multiply.accumulate(have)
    return have[:n]


def _before(x: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The byte k places before; the end byte where that is outside the document."""
    c = np.full(len(x), _END, np.uint8)
    c[k:] = x[:-k]
    for j in range(k):
        c[starts[starts + j < len(x)] + j] = _END
    return c


def pairs(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each byte: the two bytes before it."""
    return _before(x, starts, 1).astype(np.uint32) | _before(x, starts, 2).astype(np.uint32) << np.uint32(8)


def triples(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each byte: the slot of the three bytes before it."""
    return _triple_slots(pairs(x, starts) | _before(x, starts, 3).astype(np.uint32) << np.uint32(16))


def _triple_slots(h: np.ndarray) -> np.ndarray:
    h *= np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(13)
    h >>= np.uint32(8)
    h &= np.uint32(0xFFFF)
    return h


def contexts(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each byte: pair slot, triple slot, word slot, place in the word (0, 1 to 2, 3 on as 0, 1, 2), match and trust.

    match: the byte expected by the last two words; trust: 0 no match, 1 a match, 2 one whose word before was right.
    """
    n = len(x)
    word, place, tokens = word_contexts(x, starts)
    match, trust = _matches(x, tokens, word, starts)
    slot = (word >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    return pairs(x, starts).astype(np.int32), triples(x, starts).astype(np.int32), slot, place, match, trust


def context_keys(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of each byte: 64 bits that hold it and all its ``contexts``: word slot, three bytes before, byte, match, trust.

    Equal keys have the same bits under the same predictions.  Where nothing matches, the match is 0.
    """
    word, _, tokens = word_contexts(x, starts)
    match, trust = _matches(x, tokens, word, starts)
    word >>= np.uint64(64 - WORD_BITS)
    word <<= np.uint64(24)
    word |= pairs(x, starts) | _before(x, starts, 3).astype(np.uint32) << np.uint32(16)
    word <<= np.uint64(8)
    word |= x
    word <<= np.uint64(8)
    word |= np.where(trust > 0, match, np.uint8(0))
    word <<= np.uint64(2)
    word |= trust.astype(np.uint8)
    return word


def of_keys(keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Byte and ``contexts`` of each key."""
    before = (keys >> np.uint64(18) & np.uint64(0xFFFFFF)).astype(np.uint32)
    opens = [(b == _SPACE) | (b == _END) for b in (before >> np.uint32(by) & np.uint32(0xFF) for by in (0, 8, 16))]
    place = np.where(opens[0], 0, np.where(opens[1] | opens[2], 1, 2)).astype(np.int8)
    return ((keys >> np.uint64(10)).astype(np.uint8), (before & np.uint32(0xFFFF)).astype(np.int32),
            _triple_slots(before).astype(np.int32), (keys >> np.uint64(42)).astype(np.int32), place,
            (keys >> np.uint64(2)).astype(np.uint8), (keys & np.uint64(3)).astype(np.int8))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each stands there."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def _summed(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists of keys and counts as one: distinct keys, ascending, and the sum of each."""
    keys, n = (np.concatenate(x) for x in zip(*some))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first)


def word_contexts(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the word's bytes so far, place in the word, where words start)."""
    n = len(x)
    opens = np.zeros(n, bool)
    opens[0] = True
    opens[1:] = (x[:-1] == _SPACE) | (x[:-1] == _END)
    tokens = np.flatnonzero(opens)
    size = np.diff(np.append(tokens, n))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * _power("up", _PRIME, n), out=total[1:])
    word = total[:-1] - np.repeat(total[tokens], size)
    word *= np.repeat(_power("down", _INVERSE, n)[tokens], size)
    place = np.arange(n, dtype=np.int32) - np.repeat(tokens.astype(np.int32), size)
    return mix(word), np.minimum((place + 1) >> 1, 2).astype(np.int8), tokens


def _matches(x: np.ndarray, tokens: np.ndarray, word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(expected byte, trust); ``tokens``: where words start; at a word's end, ``word`` is the hash of all of it."""
    n, m = len(x), len(tokens)
    ends = np.append(tokens[1:], n) - 1
    name = word[ends]
    name = np.where(x[ends] == _END, np.uint64(0), name)
    doc = np.searchsorted(starts, tokens, "right").astype(np.uint64)
    key = np.zeros(m, np.uint64)
    key[2:] = mix(name[1:-1] * _PRIME + name[:-2] + doc[2:] * _INVERSE)
    whole = np.zeros(m, bool)  # both words before are of this document
    whole[2:] = doc[2:] == doc[:-2]
    some = np.flatnonzero(whole)
    order = some[np.argsort(key[some], kind="stable")]
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    past = np.full(m, -1)
    past[order[same + 1]] = order[same]
    good = (past >= 0) & (name == name[past])
    trust = (past >= 0).astype(np.int64)
    trust[1:] += (past[1:] >= 0) & good[:-1]
    # Bytes of the words that have one before, side by side.
    some = np.flatnonzero(past >= 0)
    size = (ends + 1 - tokens)[some]
    begin = np.cumsum(size) - size
    at = np.repeat(tokens[some] - begin, size)
    at += np.arange(len(at))
    found = x[at + np.repeat((tokens[past] - tokens)[some], size)]
    wrong = np.zeros(len(at) + 1, np.int32)
    np.cumsum(found != x[at], out=wrong[1:])
    held = wrong[:-1] == np.repeat(wrong[begin], size)
    match, trusted = x.copy(), np.zeros(n, np.int8)
    match[at] = found
    trusted[at] = np.repeat(trust[some], size) * held
    return match, trusted


class Tree:
    """Paths of all bytes in a Huffman tree: nodes and bits along the way."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, b) for b, c in enumerate(counts)]
        heapq.heapify(heap)
        up: dict[int, tuple[int, int]] = {}
        node = 256
        while len(heap) > 1:
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            up[i], up[j] = (node, 0), (node, 1)
            heapq.heappush(heap, (a + b, node))
            node += 1
        nodes, bits, self.size = [], [], np.zeros(256, np.int64)
        for b in range(256):
            path, at = [], b
            while at in up:
                path.append(up[at])
                at = up[at][0]
            self.size[b] = len(path)
            nodes += [p - 256 for p, _ in reversed(path)]
            bits += [v for _, v in reversed(path)]
        self.nodes, self.bits = np.array(nodes, np.int32), np.array(bits, np.int8)
        self.signs = (1 - 2 * self.bits).astype(np.float32)  # 1 for bit 0, -1 for bit 1
        self.first = np.cumsum(self.size) - self.size
        self.salt = (mix(np.arange(1, 256, dtype=np.uint64) * _PRIME) >> np.uint64(64 - WORD_BITS)).astype(np.int32)

    def expand(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of bits of each byte, byte of every bit, node of every bit, its place among all paths)."""
        size = self.size[x]
        of = np.repeat(np.arange(len(x)), size)
        at = np.repeat(self.first[x] - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return size, of, self.nodes.take(at), at

    def expected(self, x: np.ndarray, size: np.ndarray, node: np.ndarray, of: np.ndarray, match: np.ndarray):
        """(places, -1 or 1) of the bits of the bytes ``of`` for which the expected byte's path has the same node."""
        most = size[of]
        begin = (np.cumsum(size) - size)[of]
        depth = np.arange(int(most.sum())) - np.repeat(np.cumsum(most) - most, most)
        place = np.repeat(begin, most) + depth
        theirs = np.repeat(match[of], most)
        on = depth < self.size[theirs]
        place, at = place[on], (self.first[theirs] + depth)[on]
        same = self.nodes[at] == node[place]
        return place[same], self.bits[at[same]] * 2.0 - 1

    def fold(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of bit 0 and bit 1 at each node, from (slots, 256) counts of bytes."""
        out = []
        for value in (0, 1):
            on = np.zeros((256, 256), np.float32)
            of = np.repeat(np.arange(256), self.size)
            on[of[self.bits == value], self.nodes[self.bits == value]] = 1
            out.append(counts.astype(np.float32) @ on)
        return out[0], out[1]


def stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.round(np.log((n1 + 0.4) / (n0 + 0.4)) * _SCALE), -127, 127).astype(np.int8)


class Model:
    """Tables, tree and weights; ``score`` gives the log10 probability of every document of a stream."""

    def __init__(self, tree: Tree, triple: np.ndarray, word: np.ndarray, weights: np.ndarray | None = None,
                 pair: np.ndarray | None = None):
        """Without a table of pairs, that predictor is even everywhere."""
        self.tree, self.pair, self.triple, self.word = tree, pair, triple, word
        self.weights = np.tile(START, (GATES, 1)) if weights is None else weights

    def _bits(self, x, pair, triple, word, place, match, trust):
        """(byte, sign, stretched predictions and gate of every bit)."""
        size, of, node, path = self.tree.expand(x)
        st = np.zeros((PREDICTORS, len(node)), np.float32)
        for i, (table, slot) in enumerate(((self.pair, pair), (self.triple, triple))):
            if table is not None:
                at = (slot << 8).take(of)
                at += node
                st[i] = table.take(at)
        at = word.take(of)
        at ^= self.tree.salt.take(node)
        whole = self.word.take(at)
        st[2] = whole >> 2
        st[:3] *= np.float32(1 / _SCALE)
        gate = (place.astype(np.int64) << 2).take(of)
        gate += whole & 3
        some = np.flatnonzero(trust)
        if len(some):
            at, sign = self.tree.expected(x, size, node, some, match)
            st[3, at] = sign
            gate[at] += 12 * trust.take(of.take(at)).astype(np.int64)
        return of, self.tree.signs.take(path), st, gate

    def score(self, s: Stream) -> np.ndarray:
        """Documents are independent of each other and taken a few at a time."""
        out, k = [], 0
        ends = s.starts + s.sizes
        while k < len(ends):
            e = max(k + 1, int(np.searchsorted(ends, s.starts[k] + _PART, "right")))
            out.append(self._score(s.x[s.starts[k]:ends[e - 1]], s.starts[k:e] - s.starts[k], s.sizes[k:e]))
            k = e
        return np.concatenate(out)

    def _mixed(self, x, *ctx) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(byte, mixed prediction times the sign, 2 * gate + value) of every bit."""
        weights = np.ascontiguousarray(self.weights.T)
        of, sign, st, gate = self._bits(x, *ctx)
        mixed = weights[PREDICTORS].take(gate)
        for i in range(PREDICTORS):
            st[i] *= weights[i].take(gate)
            mixed += st[i]
        mixed *= sign
        gate <<= 1
        gate += sign < 0
        return of, mixed, gate

    def _score(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        n = len(sizes)
        # Contexts that come again are mixed once; in a few bytes there are hardly any.
        known = Known(self, context_keys(x, starts)) if len(x) > _STEP else None
        ctx = () if known else contexts(x, starts)
        doc = np.repeat(np.arange(n, dtype=np.int32), sizes)
        inside = np.arange(len(x), dtype=np.int32) - starts.astype(np.int32).take(doc)
        total = np.zeros(n)
        scale, shift = np.ones(n * GATES, np.float32), np.zeros(n * GATES, np.float32)
        low = 0
        while low < int(sizes.max(initial=0)):
            high = low * 4 if low else BLOCK
            at = np.flatnonzero((inside >= low) & (inside < high))
            goes_on = sizes > high
            sums = np.zeros((3, n * GATES * 2))
            scales, shifts = np.repeat(scale, 2), np.stack([shift, -shift], axis=1).ravel()
            for k in range(0, len(at), _STEP):
                part = at[k:k + _STEP]
                of, mixed, key = known.bits(part) if known else self._mixed(x[part], *(c[part] for c in ctx))
                docs = doc[part]
                key += (docs * (2 * GATES)).take(of)
                final = mixed
                if low:
                    final = mixed * scales.take(key)
                    final += shifts.take(key)
                np.clip(final, -12, 12, out=final)
                flip = np.exp(final)
                flip += 1
                cost = np.log(flip)
                first = np.flatnonzero(np.diff(docs, prepend=-1))
                begin = np.searchsorted(of, first)
                total[docs[first]] -= np.add.reduceat(cost, begin, dtype=np.float64)
                use = np.flatnonzero(goes_on[docs].take(of)) if goes_on.any() else ()
                if len(use):
                    # the bit's error is 1 - 1 / flip towards its value
                    error = 1 / flip.take(use) - 1
                    key = key.take(use)
                    for j, v in enumerate((error * mixed.take(use), error, None)):
                        sums[j] += np.bincount(key, v, n * GATES * 2)
            if goes_on.any():
                push, count = (sums[k, ::2] + sums[k, 1::2] for k in (0, 2))
                scale += (push / (0.3 * count + 50)).clip(-0.3, 0.3).astype(np.float32)
                shift += ((sums[1, ::2] - sums[1, 1::2]) / (0.1 * count + 20)).clip(-0.5, 0.5).astype(np.float32)
            low = high
        return total / np.log(10)

    def tally(self, s: Stream, counts: np.ndarray) -> None:
        """Add every bit of the stream to ``counts`` (TALLY of them)."""
        self.tally_keys(*_distinct(context_keys(s.x, s.starts)), counts)

    def tally_keys(self, keys: np.ndarray, n: np.ndarray, counts: np.ndarray) -> None:
        """Add the bits of ``context_keys`` that stand there n times; bytes with the same contexts are taken once."""
        for low in range(0, len(keys), _STEP):
            x, *ctx = of_keys(keys[low:low + _STEP])
            times = np.repeat(n[low:low + _STEP].astype(np.uint32), self.tree.size[x])
            np.add.at(counts, self._places(x, *ctx), times)

    def _places(self, x, pair, triple, word, place, match, trust) -> np.ndarray:
        """Place in the tally of every bit; ``_bits`` has the same predictions and gates."""
        size, of, node, path = self.tree.expand(x)
        at = word.take(of)
        at ^= self.tree.salt.take(node)
        whole = self.word.take(at).astype(np.int32)
        gate = (place.astype(np.int32) << 2).take(of)
        gate += whole & 3
        expected = np.ones(len(node), np.int32)
        some = np.flatnonzero(trust)
        if len(some):
            at, sign = self.tree.expected(x, size, node, some, match)
            expected[at] += sign.astype(np.int32)
            gate[at] += 12 * trust.take(of.take(at)).astype(np.int32)
        for table, slot in ((self.pair, pair), (self.triple, triple)):
            gate <<= 5
            if table is None:
                gate += 16
                continue
            at = (slot << 8).take(of)
            at += node
            gate += (table.take(at) >> 3) + np.int8(16)
        gate <<= 5
        gate += (whole >> 5) + 16
        gate *= 3
        gate += expected
        gate <<= 1
        gate += self.tree.bits.take(path)
        return gate


class Known:
    """Mixed bits of a stream's bytes, made once for each distinct key."""

    def __init__(self, model: Model, keys: np.ndarray):
        order = np.argsort(keys)
        keys = keys[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        self.which = np.empty(len(keys), np.int32)
        self.which[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        keys, made = keys[new], []
        del order, new
        self.size = model.tree.size[(keys >> np.uint64(10)).astype(np.uint8)]
        self.first = np.cumsum(self.size) - self.size
        for low in range(0, len(keys), _STEP):
            made.append(model._mixed(*of_keys(keys[low:low + _STEP]))[1:])
        self.mixed, self.key = (np.concatenate(x) for x in zip(*made))

    def bits(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``Model._mixed``, of the bytes at the places ``part``."""
        which = self.which.take(part)
        size = self.size.take(which)
        of = np.repeat(np.arange(len(part)), size)
        at = np.repeat(self.first.take(which) - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return of, self.mixed.take(at), self.key.take(at)


def mixing_weights(at: np.ndarray, n: np.ndarray, ridge: float = 20.0, rounds: int = 50) -> np.ndarray:
    """Weights that make the bits of a tally (places, counts) likeliest, gate by gate; close to START where it has few bits.

    Newton's method, with a step halved as long as it does not help.
    """
    out = np.tile(START.astype(np.float64), (GATES, 1))
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order].astype(np.float64)
    edges = np.searchsorted(at, np.arange(GATES + 1) * (TALLY // GATES))
    for g in range(GATES):
        k, times = at[edges[g]:edges[g + 1]], n[edges[g]:edges[g + 1]]
        if not len(k):
            continue
        sign = 2.0 * (k & 1) - 1
        k = k >> 1
        rows = np.stack([*((((k // 3) >> by & 31) - 15.5) * (8 / _SCALE) for by in (10, 5, 0)), k % 3 - 1.0, np.ones(len(k))], axis=1)
        rows[:, :3] *= sign[:, None]
        rows[:, 3:] *= sign[:, None]

        def loss(w: np.ndarray) -> float:
            return float(times @ np.logaddexp(0, -(rows @ w)) + ridge / 2 * ((w - START) ** 2).sum())

        w, now = out[g], loss(out[g])
        for _ in range(rounds):
            wrong = 1 / (1 + np.exp(np.clip(rows @ w, -30, 30)))
            push = rows.T @ (times * wrong) - ridge * (w - START)
            bend = (rows * (times * wrong * (1 - wrong))[:, None]).T @ rows + ridge * np.eye(PREDICTORS + 1)
            step = np.linalg.solve(bend, push)
            while (then := loss(w + step)) > now and np.abs(step).max() > 1e-6:
                step /= 2
            if then > now:
                break
            w, now = w + step, then
            if np.abs(step).max() <= 1e-6:
                break
        out[g] = w
    return out.astype(np.float32)


def _pack(at: np.ndarray, n: np.ndarray) -> bytes:
    """Entries (sorted) and their counts, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(
        np.diff(at, prepend=0).astype("<i4").tobytes() + n.astype("<i8").tobytes())


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // 12
    return np.cumsum(np.frombuffer(raw, "<i4", n), dtype=np.int64), np.frombuffer(raw, "<i8", n, 4 * n)


_TABLE = "tab int, chunk int, counts binary"


def _table_rows(tables: dict[int, np.ndarray]) -> Iterator[tuple[int, int, bytes]]:
    for tab, counts in tables.items():
        for c in range(0, len(counts), CHUNK):
            part = counts[c:c + CHUNK]
            at = np.flatnonzero(part)
            if len(at):
                yield tab, c // CHUNK, _pack(at, part[at])


def _sum_rows(tab: int, keys: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """As ``_table_rows``, from the entries that are not 0, ascending."""
    keys = keys.astype(np.int64)
    for c in np.unique(keys // CHUNK).tolist():
        low, high = np.searchsorted(keys, [c * CHUNK, (c + 1) * CHUNK])
        yield tab, c, _pack(keys[low:high] - c * CHUNK, n[low:high])


def _added(rows: DataFrame, then, schema: str) -> DataFrame:
    """Chunks of tables added up, one (tab, chunk) after the other; ``then`` makes the output row of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(CHUNK, np.int64)
        names = [f.split()[0] for f in schema.split(", ")]

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([then(now, total)], pa.binary())],
                names=names)

        for batch in batches:
            for tab, chunk, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (tab, chunk) != now:
                    if now is not None:
                        yield done()
                    now, total = (tab, chunk), np.zeros(CHUNK, np.int64)
                at, n = _unpack(blob)
                total[at] += n
        if now is not None:
            yield done()
        give_back()

    return rows.repartition("tab", "chunk").sortWithinPartitions("tab", "chunk").mapInArrow(run, schema)


def _runs(docs: DataFrame, run_bytes: int) -> DataFrame:
    """A row per run of texts of one kind: 0 not learned from, 1 and 2 the halves; ``docs``: id, text, trains, half."""
    schema = T.StructType([
        T.StructField("run", T.LongType()), T.StructField("kind", T.IntegerType()),
        T.StructField("ids", T.ArrayType(docs.schema["id"].dataType)), T.StructField("texts", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            trains, half = (batch.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in (2, 3))
            kinds = np.where(trains, 1 + half, 0)
            for kind in range(3):
                ids, texts = (batch.column(k).take(pa.array(np.flatnonzero(kinds == kind))) for k in (0, 1))
                for row, end, _, _ in runs(texts, run_bytes):
                    edges = pa.array([0, end - row], pa.int32())
                    lists = [pa.ListArray.from_arrays(edges, x.slice(row, end - row)) for x in (ids, texts)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part << 32 | seq], pa.int64()), pa.array([kind], pa.int32()), *lists], names=schema.names)
                    seq += 1
        give_back()

    return docs.mapInArrow(run, schema)


class Sums:
    """Counts by key of the tables of a task, added up when there are many, to be written out when there are still many."""

    def __init__(self):
        self.lists, self.size, self.full = {}, 0, False

    def add(self, name, keys: np.ndarray, n: np.ndarray) -> None:
        self.lists.setdefault(name, []).append((keys, n))
        self.size += len(keys)
        if self.size > HOLD:
            self.lists = {k: [_summed(v)] for k, v in self.lists.items()}
            self.size = sum(len(v[0][0]) for v in self.lists.values())
            self.full = self.size > HOLD // 2

    def take(self) -> Iterator[tuple]:
        """(name, keys, counts) of all, which are not held any longer."""
        for name, some in self.lists.items():
            yield name, *_summed(some)
        self.__init__()


def _counts(rows: Iterator[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.binary()))], names=["tab", "chunk", "counts"])


def _byte_tables(made: DataFrame) -> DataFrame:
    """The parts of each task's tables of each half: the bytes behind each triple (0) and pair (2), as 3 and 5 in the second.

    A task holds what it has seen, and writes it out when that is much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()

        def rows() -> Iterator[pa.RecordBatch]:
            for tab, keys, n in sums.take():
                yield from _counts(_sum_rows(tab, keys, n))

        for batch in batches:
            for k, kind in enumerate(batch.column(0).to_pylist()):
                for s in streams(batch.column(1).slice(k, 1).flatten()):
                    for tab, slots in ((0, triples), (2, pairs)):
                        slot = slots(s.x, s.starts)
                        slot <<= np.uint32(8)
                        slot |= s.x
                        sums.add(tab + 3 * (kind - 1), *_distinct(slot))
                    if sums.full:
                        yield from rows()
        yield from rows()
        give_back()

    return made.where("kind > 0").select("kind", "texts").mapInArrow(run, _TABLE)


def _parts(made: DataFrame, buckets: int) -> DataFrame:
    """The distinct tokens of each run, dealt into buckets by their hash: a row with lists per run and bucket.

    pos is a token's number in its run (the end token is the last), n its count there; kind: that of the run.
    """
    schema = "bucket int, run long, kind int, tokens array<string>, pos array<int>, n array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (name, kind) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1)))):
                s = Stream.of(batch.column(2).slice(k, 1).flatten())
                coded = s.tokens()
                code = coded.indices.to_numpy()
                known = pa.concat_arrays([coded.dictionary, pa.array([""], pa.string())])
                n = np.append(np.bincount(code, minlength=len(known) - 1), len(s.words)).astype(np.int32)
                bucket = _token_hashes(*buffers(known)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                there, first = np.unique(bucket[order], return_index=True)
                edges = pa.array(np.append(first, len(order)), pa.int32())
                values = [known.take(pa.array(order)), pa.array(order.astype(np.int32)), pa.array(n[order])]
                yield pa.RecordBatch.from_arrays([
                    pa.array(there.astype(np.int32)), pa.array(np.full(len(there), name), pa.int64()),
                    pa.array(np.full(len(there), kind, np.int32)), *(pa.ListArray.from_arrays(edges, v) for v in values)],
                    names=["bucket", "run", "kind", "tokens", "pos", "n"])
            give_back()

    return made.select("run", "kind", "texts").mapInArrow(run, schema)


def _token_hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("up", _PRIME, len(raw)), out=total[1:])
    return mix((total[at[1:]] - total[at[:-1]]) * _power("down", _INVERSE, len(raw) + 1)[at[:-1]])


def _counted(parts: DataFrame) -> DataFrame:
    """Rows of two kinds, made bucket by bucket.

    of, pos, c: the counts c of a run's tokens of one bucket, by their numbers; and, where ``of`` is null, tokens
    with their counts c and m, with the sum of c (total) and the number of c > 0 (seen).
    """
    import pyarrow.compute as pc

    schema = ("of long, pos array<int>, c array<long>, tokens array<string>, m array<long>, total long, seen long")
    names = ["of", "pos", "c", "tokens", "m", "total", "seen"]

    def one(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(rows).combine_chunks()
        lists = group.column("tokens").combine_chunks()
        size = pc.list_value_length(lists).to_numpy()
        kind = np.repeat(group.column("kind").to_numpy(), size)
        n = group.column("n").combine_chunks().flatten().to_numpy().astype(np.int64)
        flat = pa.table([lists.flatten(), n * (kind > 0), n * (kind == 2)], names=["token", "n", "m"])
        sums = flat.group_by("token").aggregate([("n", "sum"), ("m", "sum")]).combine_chunks()
        token, c, m = (sums.column(k).combine_chunks() for k in ("token", "n_sum", "m_sum"))
        mine = c.take(pc.index_in(flat.column("token").combine_chunks(), value_set=token))
        edges = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
        k = group.num_rows
        first = pa.table([
            group.column("run"), pa.ListArray.from_arrays(edges, group.column("pos").combine_chunks().flatten()),
            pa.ListArray.from_arrays(edges, mine), pa.nulls(k, lists.type), pa.nulls(k, pa.list_(pa.int64())),
            pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
        cuts = list(range(0, len(token), 1 << 14))
        cut = lambda x: pa.ListArray.from_arrays(pa.array([*cuts, len(token)], pa.int32()), x)
        known = c.to_numpy()
        second = pa.table([
            pa.nulls(len(cuts), pa.int64()), pa.nulls(len(cuts), pa.list_(pa.int32())), cut(c), cut(token), cut(m),
            pa.array([int(known[i:i + (1 << 14)].sum()) for i in cuts], pa.int64()),
            pa.array([int((known[i:i + (1 << 14)] > 0).sum()) for i in cuts], pa.int64())], names=names)
        yield from first.to_batches(max_chunksize=256)
        yield from second.to_batches(max_chunksize=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for low, high in zip(edges, edges[1:]):
                if held and low < high and held[0].column(0)[0].as_py() != buckets[low]:
                    yield from one(held)
                    held.clear()
                    give_back()
                if low < high:
                    held.append(batch.slice(low, high - low))
        if held:
            yield from one(held)
        held.clear()
        give_back()

    # In batches of bounded size; a whole bucket at once would grow Spark's own buffers.
    return parts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _word_tables(counts: DataFrame, tree: Tree, tab: int) -> DataFrame:
    """Partial table ``tab`` of the word contexts, from lists of tokens and their counts m: entry 2 * slot + bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(2 << WORD_BITS, np.int64)
        for batch in batches:
            times = batch.column(1).flatten().to_numpy()
            some = np.flatnonzero(times)
            times = times[some]
            for row, end, buf, offs in runs(batch.column(0).flatten().take(pa.array(some)), 1 << 16):
                s = Stream(buf, offs)
                # A token's stream ends with an end byte of its own; it belongs to the end token alone.
                word = (word_contexts(s.x, s.starts)[0] >> np.uint64(64 - WORD_BITS)).astype(np.int32)
                weight = np.repeat(times[row:end], s.sizes)
                last = s.starts + s.sizes - 1
                weight[last[s.words > 0]] = 0
                _, of, node, path = tree.expand(s.x)
                at = word.take(of)
                at ^= tree.salt.take(node)
                at <<= 1
                at |= tree.bits.take(path)
                np.add.at(table, at, weight.take(of))
        yield from _counts(_table_rows({tab: table}))
        del table
        give_back()

    return counts.mapInArrow(run, _TABLE)


def _byte_sums(parts: DataFrame) -> np.ndarray:
    """Bytes of all training documents, added up by Spark."""

    def byte_sums(now, total) -> bytes:
        return total.reshape(-1, 256).sum(axis=0).astype("<i8").tobytes()

    rows = parts.where("tab % 3 = 0").select(F.lit(0).alias("tab"), "chunk", "counts")
    sums = np.zeros(256, np.int64)
    for r in _added(rows, byte_sums, "tab int, chunk int, sums binary").collect():
        sums += np.frombuffer(r["sums"], "<i8")
    return sums


def _fit(parts: DataFrame, sums: np.ndarray, half: bool | None = None) -> dict[str, np.ndarray]:
    """Tables of all training documents or of one half, added up by Spark; their chunks (a fixed number) come to the driver
    as one byte an entry."""
    tree = Tree(sums)
    rows = parts if half is None else parts.where(f"tab {'>=' if half else '<'} 3")
    rows = rows.select((F.col("tab") % 3).alias("tab"), "chunk", "counts")

    def fold(now, total) -> bytes:
        return stretched(*tree.fold(total.reshape(-1, 256))).tobytes()

    bytewise = {k: np.zeros(1 << 24, np.int8) for k in (0, 2)}
    for r in _added(rows.where("tab != 1"), fold, "tab int, chunk int, table binary").collect():
        bytewise[r["tab"]][r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["table"], np.int8)

    def with_trust(now, total) -> bytes:
        n0, n1 = total[::2], total[1::2]
        seen = np.searchsorted([1, 4, 32], n0 + n1, "right").astype(np.int16)
        return (stretched(n0, n1).astype(np.int16) * 4 + seen).tobytes()

    halves = _added(rows.where("tab = 1"), with_trust, "tab int, chunk int, table binary")
    word = np.zeros(1 << WORD_BITS, np.int16)
    for r in halves.collect():
        word[r["chunk"] * CHUNK // 2:(r["chunk"] + 1) * CHUNK // 2] = np.frombuffer(r["table"], np.int16)
    return {"sums": sums, "triple": bytewise[0], "word": word, "pair": bytewise[2]}


def _model(fit: dict[str, np.ndarray], weights: np.ndarray | None = None) -> Model:
    return Model(Tree(fit["sums"]), fit["triple"], fit["word"], weights, fit["pair"])


def _learned(made: DataFrame, parts: DataFrame, sums: np.ndarray) -> np.ndarray:
    """The mixing weights, from every training document, its bits under the tables of the other half."""

    def packed(now, total) -> bytes:
        at = np.flatnonzero(total)
        return _pack(at, total[at])

    tally = np.zeros(TALLY, np.int64)
    for half in (False, True):  # one after the other, so that a task holds the tables of one
        shared = made.sparkSession.sparkContext.broadcast(_fit(parts, sums, not half))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            give_back()
            model, keys, table = None, Sums(), np.zeros(TALLY, np.uint32)
            for batch in batches:
                model = model or _model(shared.value)
                for k in range(batch.num_rows):
                    for s in streams(batch.column(0).slice(k, 1).flatten()):
                        keys.add(0, *_distinct(context_keys(s.x, s.starts)))
                        if keys.full:
                            for _, *some in keys.take():
                                model.tally_keys(*some, table)
            for _, *some in keys.take():
                model.tally_keys(*some, table)
            yield from _counts(_table_rows({0: table}))
            give_back()

        found = made.where(F.col("kind") == 1 + half).select("texts").mapInArrow(run, _TABLE)
        with session_settings(made.sparkSession, _SINGLE):
            rows = _added(found, packed, "tab int, chunk int, tally binary").collect()
        for r in rows:
            places, times = _unpack(r["tally"])
            tally[places + r["chunk"] * CHUNK] += times
        shared.unpersist()
    at = np.flatnonzero(tally)
    return mixing_weights(at, tally[at])


def _halves(docs: DataFrame, trains: Column, doc_id: str, text: str) -> DataFrame:
    """(id, text, trains, half); half: whether a document is of the second half."""
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"),
                       (F.pmod(F.xxhash64(F.col(doc_id), F.lit("mix")), F.lit(2)) == 1).alias("half"))


def _rows(docs: DataFrame, trains: Column, doc_id: str, text: str, mix_docs: int, mix_bytes: int) -> DataFrame:
    """(id, text, trains, held); held: the training documents, at most ``mix_docs``, kept aside.

    A bounded sample; ``score_texts`` learns from all training documents (``_halves``) and does not use it.
    """
    trains = F.coalesce(trains, F.lit(False))
    order = F.xxhash64(F.col(doc_id))
    able = (trains & (F.pmod(F.xxhash64(F.col(doc_id), F.lit("mix")), F.lit(HELD)) == 0)
            & (F.octet_length(text) <= mix_bytes))
    least = [r["o"] for r in docs.where(able).select(order.alias("o")).orderBy("o").limit(mix_docs + 1).collect()]
    # Rows that share a hash with the first one left over are left over, too.
    held = able & (order < least[-1]) if len(least) > mix_docs else able
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), trains.alias("trains"),
                       F.coalesce(held, F.lit(False)).alias("held"))


def score_texts(docs: DataFrame, trains: Column, doc_id: str = "doc_id", text: str = "text",
                run_bytes: int = 2 << 20, buckets_each: int = 4) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte): a row per row of ``docs``.

    ``trains``: whether a row is learned from; base_score: log10 probability under add-half unigram counts.
    """
    spark = docs.sparkSession
    rows = _halves(docs, trains, doc_id, text)
    buckets = max(16, rows.rdd.getNumPartitions() * buckets_each)  # of the scan; runs no job
    small = {"parquet.block.size": 16 << 20, "compression": "zstd"}
    made = stored(_runs(rows, run_bytes), "lm-runs", small)
    counted = stored(_counted(_parts(made, buckets)), "lm-counts", small)
    counts = counted.where("tokens is not null")
    total, distinct = (int(x or 0) for x in counts.agg(F.sum("total"), F.sum("seen")).first())

    parts = stored(_byte_tables(made), "lm-tables", batches=_SINGLE)
    sums = _byte_sums(parts)
    tree, first = Tree(sums), F.zip_with("c", "m", lambda c, m: c - m)
    words = [_word_tables(counts.select("tokens", times.alias("m")), tree, tab) for tab, times in ((1, first), (4, F.col("m")))]
    parts = parts.unionAll(stored(words[0].unionAll(words[1]), "lm-words"))
    weights = _learned(made, parts, sums)
    shared = spark.sparkContext.broadcast(_fit(parts, sums))  # about 42 MB, whatever the corpus

    known = counted.where("of is not null").select("of", "pos", "c")
    denominator = np.log10(total + 0.5 * (distinct + 1))
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType)] + [
        T.StructField(n, T.LongType() if k < 3 else T.DoubleType()) for k, n in enumerate(names[1:])])

    models: dict[str, Model] = Cache()

    def finish(one: pa.Table, seen: pa.Table) -> pa.Table:
        pos, found = (seen.column(k).combine_chunks().flatten().to_numpy() for k in ("pos", "c"))
        c = np.zeros(len(pos), np.int64)
        c[pos] = found
        if not models:
            models["whole"] = _model(shared.value, weights)
        m = models["whole"]
        ids = one.column("ids").combine_chunks()
        texts = one.column("texts").combine_chunks().flatten()
        n_tokens, n_known, logs, score, size = _finished(m, Stream.of(texts), c)
        give_back()
        base = logs - n_tokens * denominator
        bits = -score / np.log10(2) / size
        return pa.Table.from_arrays(
            [ids.flatten(), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(base), total, np.int64)),
             pa.array(base), pa.array(score), pa.array(bits)], names=names)

    left = made.select("run", "ids", "texts").groupBy("run")
    return left.cogroup(known.groupBy("of")).applyInArrow(finish, schema)


def _finished(model: Model, s: Stream, c: np.ndarray):
    """Of each document: tokens, known tokens, sum of log10(c + 0.5), model score, bytes of its stream."""
    code = s.tokens().indices.to_numpy()
    n = len(s.words)
    doc = np.repeat(np.arange(n), s.words)
    mine = c[code]
    known = np.bincount(doc, mine > 0, n).astype(np.int64) + int(c[-1] > 0)
    logs = np.bincount(doc, np.log10(mine + 0.5), n) + np.log10(c[-1] + 0.5)
    return s.words + 1, known, logs, model.score(s), s.sizes
