"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet.

Side A is a byte-level BPE (``tokenizers`` JSON), side B a SentencePiece model;
both encode a blank and the text.  Byte offsets where a token of A and a token
of B both end are cuts; the tokens between two cuts are a group, and every A
and B token of a group are linked.

Method: the texts of a batch advance in lockstep.  One state vector holds the A
and B pointers of all of its documents; each step compares the ends of the
tokens pointed at, advances the side that ends first (both, where they end
together, which is a cut) and emits the groups that the step's cuts close, with
the block of links each stands for.  Finished documents are compacted away.

Counting: an id pair's count is the number of documents that hold it linked.  A
batch counts its own documents first and sends one row per distinct pair, so a
frequent pair is a row a batch; the sums come back to the batches that hold the
pair.  Batches keep their documents as numbers of distinct groups; nothing is
tokenized twice, and no table of pairs is broadcast (it grows with the corpus).

Memory follows a batch (runs of ``RUN`` bytes, or one longer text) and the distinct
id pairs within it.

Defined results: a null or empty text, and one whose joined tokens of either
side are not the blank and the text (such as a literal U+2581), has no tokens:
all numbers 0, an empty string for the hash.  Special tokens' strings are plain
text.  Rows that repeat an id, and null ids, are documents of their own; an
empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import buffers, mix, runs, worker_cache
from metricstore.llm.store import stored
from metricstore.llm.token_store import load_tokenizer, pieces

KEPT = 250_000  # distinct pieces of text that a worker remembers: the first it meets
RUN = 3 << 20  # bytes of text aligned together, or one longer text
_I64 = np.int64


def byte_of_letter() -> dict[str, int]:
    """Byte-level BPE's letters: a visible byte of Latin-1 stands for itself, the others follow from U+0100 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Side A."""

    def __init__(self, definition: str):
        self.tokenizer = load_tokenizer(definition, special_as_text=True)
        byte = byte_of_letter()
        self.tokens = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            known = all(c in byte for c in token)
            self.tokens[i] = bytes(byte[c] for c in token) if known else token.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for k in range(0, len(texts), 256):
            part = texts[k:k + 256]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(found.word_ids, minlength=len(part))).tolist()
            ids = found.ids
            out += [ids[s:e] for s, e in zip([0, *ends], ends)]
        return out


class Pieces:
    """Side B."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = []
        #: Pairs of bytes that stand side by side in some piece; no merge spans any other pair.
        self.inside = np.zeros(1 << 16, bool)
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.tokens.append(bytes([int(piece[3:5], 16)]))
                continue
            token = piece.replace("▁", " ").encode()
            self.tokens.append(token)
            if not self.model.is_control(i) and not self.model.is_unknown(i):
                both = np.frombuffer(token, np.uint8).astype(np.uint16)
                self.inside[both[:-1] << 8 | both[1:]] = True
        line = [i for i, t in enumerate(self.tokens) if t == b"\n"]
        if self.inside[0x0A00:0x0B00].any() or len(line) != 1 or self.model.encode("\n")[1:] != line:
            raise ValueError("a piece joins a line's end with what follows")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Of texts as they are: behind a line's end, which nothing merges with, the model's own blank is cut off."""
        return [ids[2:] for ids in self.model.encode(["\n" + t for t in texts], num_threads=1)]

    def joins(self, buf: np.ndarray) -> np.ndarray:
        """Whether a token may span byte k and byte k + 1, for each k."""
        two = buf[:-1].astype(np.uint16) << 8 | buf[1:]
        return self.inside[two] | ((buf[1:] & 0xC0) == 0x80)


class Encoders:
    """Both sides' ids of texts, by pieces that neither side's tokens span; each distinct piece is encoded once."""

    def __init__(self, definition: str, model: bytes):
        self.sides = ByteLevel(definition), Pieces(model)
        self.wide = 1 << max(len(s.tokens) - 1 for s in self.sides).bit_length()
        self.size = [np.array([len(t) for t in s.tokens], np.int32) for s in self.sides]
        self.known: dict[str, int] = {}
        self.whole = np.empty(0, bool)  # whether both sides' bytes are the piece's
        self.ids = [np.empty(0, np.int32) for _ in self.sides]
        self.ends = [np.zeros(1, _I64) for _ in self.sides]

    @staticmethod
    def of_worker(definition: str, model: bytes) -> Encoders:
        """The encoders of this Python worker, with what earlier tasks have kept."""
        have = worker_cache("aligned")
        key = hashlib.sha256(definition.encode() + model).hexdigest()
        if key not in have:
            have.clear()
            have[key] = Encoders(definition, model)
        return have[key]

    def forget(self) -> None:
        """Drop all but the first pieces met."""
        self.known = dict(islice(self.known.items(), KEPT))
        self.whole = self.whole[:KEPT]
        self.ends = [e[:KEPT + 1] for e in self.ends]
        self.ids = [i[:e[-1]] for i, e in zip(self.ids, self.ends)]

    def learn(self, texts: list[str]) -> None:
        whole = np.ones(len(texts), bool)
        raw = [t.encode() for t in texts]
        for k, side in enumerate(self.sides):
            found, token = side.encode(texts), side.tokens.__getitem__
            whole &= np.fromiter((b"".join(map(token, ids)) == r for ids, r in zip(found, raw)), bool, len(raw))
            sizes = np.fromiter(map(len, found), _I64, len(found))
            self.ids[k] = np.concatenate([self.ids[k], np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))])
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(sizes)])
        self.whole = np.concatenate([self.whole, whole])
        self.known.update(zip(texts, range(len(self.known), len(self.known) + len(texts))))

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids of all rows, number of ids of each row) of either side; rows that do not come back whole have none."""
        if len(self.known) > KEPT:
            self.forget()
        edges = pieces(buf, offsets)
        edges = edges[~self.sides[1].joins(buf)[edges - 1] | np.isin(edges, offsets)] if len(buf) else edges
        first = np.searchsorted(edges, offsets)
        coded = pa.StringArray.from_buffers(
            len(edges), pa.py_buffer(np.append(edges, len(buf)).astype(np.int32)),
            pa.py_buffer(np.ascontiguousarray(buf))).dictionary_encode()
        texts = coded.dictionary.to_pylist()
        new = [t for t in texts if t not in self.known]
        if new:
            self.learn(new)
        index = np.fromiter(map(self.known.__getitem__, texts), _I64, len(texts))[coded.indices.to_numpy()]
        broken = _first(~self.whole[index])
        good = broken[first[1:]] == broken[first[:-1]]
        if not good.all():
            row = np.repeat(good, np.diff(first))
            index, first = index[row], _first(np.where(good, np.diff(first), 0))
        out = []
        for ids, ends in zip(self.ids, self.ends):
            sizes = (ends[1:] - ends[:-1])[index]
            out.append((ids[_spread(ends[index], sizes)], np.diff(_first(sizes)[first])))
        return out


def lockstep(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> np.ndarray:
    """Groups as rows (first A token, end, first B token, end), in order.

    Tokens of document d are ``first[d]:first[d + 1]``; both sides of a document
    end at the same byte.
    """
    live = np.flatnonzero(np.diff(first_a) > 0)
    i, j, last = first_a[live], first_b[live], first_a[live + 1]
    cuts_a, cuts_b = [], []
    while len(i):
        at_a, at_b = ends_a[i], ends_b[j]
        on_a, on_b = at_a <= at_b, at_b <= at_a
        i, j = i + on_a, j + on_b
        cut = np.flatnonzero(on_a & on_b)
        if len(cut):
            # A cut closes a group: its links are those of the tokens since the document's last cut.
            new_a = i[cut]
            cuts_a.append(new_a.astype(np.int32))
            cuts_b.append(j[cut].astype(np.int32))
            if (new_a == last[cut]).any():
                going = i < last
                i, j, last = i[going], j[going], last[going]
    if not cuts_a:
        return np.empty((0, 4), np.int32)
    out = []
    for cuts in (cuts_a, cuts_b):
        ends = np.sort(np.concatenate(cuts))
        out += [np.concatenate([[0], ends[:-1]]).astype(np.int32), ends]  # documents follow each other
    return np.stack(out, axis=1)


@dataclass
class Aligned:
    """A batch's tokens and groups; documents without tokens have none."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    groups: np.ndarray
    ends: np.ndarray  # byte ends of A's tokens, counted over the batch


def _first(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(_I64)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one after the other."""
    ends = np.cumsum(sizes, dtype=_I64)
    out = np.repeat(starts - ends + sizes, sizes)
    out += np.arange(len(out))
    return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, how often each occurs)."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, _I64)
    return keys[at], np.diff(np.append(at, len(keys)))


def aligned(texts: pa.Array, encoders: Encoders) -> Aligned:
    texts = pc.fill_null(texts, "")
    padded = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
    (a, n_a), (b, n_b) = encoders.encode(*buffers(padded))
    first_a, first_b = _first(n_a), _first(n_b)
    ends_a, ends_b = (np.cumsum(size[ids]) for size, ids in zip(encoders.size, (a, b)))
    return Aligned(a, b, first_a, first_b, lockstep(ends_a, first_a, ends_b, first_b), ends_a)


def _kinds(x: Aligned, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """(a group of each distinct kind, the kind of each group): kinds differ in their A or B ids."""
    g = x.groups
    sizes = g[:, 1] - g[:, 0], g[:, 3] - g[:, 2]
    key = x.a[g[:, 0]].astype(_I64) * wide + x.b[g[:, 2]]
    several = np.flatnonzero((sizes[0] > 1) | (sizes[1] > 1))
    if len(several):  # by a hash of ids and places, below 0
        total = np.zeros(len(several), np.uint64)
        for ids, start, size, salt in ((x.a, g[several, 0], sizes[0][several], 1), (x.b, g[several, 2], sizes[1][several], 2)):
            at = _spread(start, size)
            place = (at - np.repeat(start, size)).astype(np.uint64)
            h = mix((ids[at].astype(np.uint64) << np.uint64(34)) + (place << np.uint64(2)) + np.uint64(salt))
            total = mix(total + np.add.reduceat(h, _first(size)[:-1]) + size.astype(np.uint64))
        key[several] = (total | np.uint64(1 << 63)).view(_I64)
    kind = pa.array(key).dictionary_encode().indices.to_numpy().astype(_I64)
    one = np.empty(int(kind.max()) + 1, _I64)
    one[kind[::-1]] = np.arange(len(kind))[::-1]
    other = one[kind[several]]
    for ids, start, size in ((x.a, g[:, 0], sizes[0]), (x.b, g[:, 2], sizes[1])):
        of = size[several]
        if (of != size[other]).any() or (ids[_spread(start[several], of)] != ids[_spread(start[other], of)]).any():
            # Two kinds share a hash: compare in full.
            seen: dict = {}
            kind = np.array([seen.setdefault((tuple(x.a[r[0]:r[1]].tolist()), tuple(x.b[r[2]:r[3]].tolist())), len(seen))
                             for r in g.tolist()], _I64)
            return np.unique(kind, return_index=True)[1], kind
    return one, kind


def _pairs(a: np.ndarray, first_a: np.ndarray, b: np.ndarray, first_b: np.ndarray, wide: int):
    """Distinct id pairs of kinds of groups: (pair keys, first entry of each kind, pair number, links) by kind."""
    sides = []
    for ids, first, by in ((a, first_a, wide), (b, first_b, wide)):
        kind = np.repeat(np.arange(len(first) - 1), np.diff(first))
        key, n = _distinct(kind * by + ids)
        kind = key // by
        sides.append((key % by, n, np.searchsorted(kind, np.arange(len(first)))))
    (ids_a, n_a, at_a), (ids_b, n_b, at_b) = sides
    per_a = np.repeat(np.diff(at_b), np.diff(at_a))  # B ids met by each A id
    left = np.repeat(np.arange(len(ids_a)), per_a)
    right = _spread(np.repeat(at_b[:-1], np.diff(at_a)), per_a)
    keys, number = np.unique(ids_a[left] * wide + ids_b[right], return_inverse=True)
    first = _first(np.diff(at_a) * np.diff(at_b))
    return keys, first, number, n_a[left] * n_b[right]


def _pack(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, _I64).astype("<i4").tobytes())


def _unpack(raw: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<i4").astype(_I64)


def _texts(x: Aligned, one: np.ndarray) -> list[str]:
    return [f"{','.join(map(str, x.a[s:e].tolist()))}|{','.join(map(str, x.b[t:f].tolist()))}"
            for s, e, t, f in x.groups[one].tolist()]


_DOC = ["n_a", "n_b", "n_groups", "n_links"]
_PARTS = ["kinds_a", "kinds_first_a", "kinds_b", "kinds_first_b", "docs_first", "docs_kind", "docs_times"]


def align(docs: DataFrame, tokenizer_path: str, model_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best: links whose pair's count is the highest of its A id in the corpus;
    count_sum: the sum of the counts over the links.  groups_sha256: of the groups as
    text, ``a1,a2|b1;a3|b2``.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # two files of a few MB
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    docs = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    longs, id_kind = T.ArrayType(T.LongType()), docs.schema["id"].dataType
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("wide", T.LongType()), T.StructField("ids", T.ArrayType(id_kind)),
        *[T.StructField(n, longs) for n in _DOC], T.StructField("sha", T.ArrayType(T.StringType())),
        *[T.StructField(n, T.BinaryType()) for n in _PARTS],
        T.StructField("pairs", longs), T.StructField("held", longs)])

    def one_chunk(batch: pa.RecordBatch, chunk: int, encoders: Encoders, wide: int) -> pa.RecordBatch:
        x = aligned(batch.column(1), encoders)
        n_a, n_b = np.diff(x.first_a), np.diff(x.first_b)
        rows, g = len(n_a), x.groups
        row = np.searchsorted(x.first_a, g[:, 0], "right") - 1
        groups, links = np.bincount(row, minlength=rows), np.zeros(rows, _I64)
        np.add.at(links, row, (g[:, 1] - g[:, 0]).astype(_I64) * (g[:, 3] - g[:, 2]))
        one, kind = _kinds(x, wide) if len(g) else (np.empty(0, _I64), np.empty(0, _I64))
        k = g[one].astype(_I64)
        names, at = _texts(x, one), _first(groups).tolist()
        sha = [hashlib.sha256(";".join(map(names.__getitem__, kind[s:e].tolist())).encode()).hexdigest() if e > s else ""
               for s, e in zip(at, at[1:])]
        kinds_a, kinds_b = (x.a[_spread(k[:, 0], k[:, 1] - k[:, 0])], x.b[_spread(k[:, 2], k[:, 3] - k[:, 2])])
        first_a, first_b = _first(k[:, 1] - k[:, 0]), _first(k[:, 3] - k[:, 2])
        keys, first, number, _ = _pairs(kinds_a, first_a, kinds_b, first_b, wide)
        of, times = _distinct(row * max(len(one), 1) + kind)
        of_row, of_kind = of // max(len(one), 1), of % max(len(one), 1)
        per = np.diff(first)[of_kind]
        held, _ = _distinct(np.repeat(of_row, per) * max(len(keys), 1) + number[_spread(first[:-1][of_kind], per)])
        held = np.bincount(held % max(len(keys), 1), minlength=len(keys))
        parts = [kinds_a, np.diff(first_a), kinds_b, np.diff(first_b), np.bincount(of_row, minlength=rows),
                 np.diff(of_kind, prepend=0), times]
        one_row = [[chunk], [wide], [batch.column(0).to_pylist()], *[[v.tolist()] for v in (n_a, n_b, groups, links)],
                   [sha], *[[_pack(p)] for p in parts], [keys.tolist()], [held.tolist()]]
        kinds = [pa.int64(), pa.int64(), pa.list_(batch.column(0).type), *[pa.list_(pa.int64())] * 4, pa.list_(pa.string()),
                 *[pa.binary()] * len(parts), *[pa.list_(pa.int64())] * 2]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one_row, kinds)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders.of_worker(definition.value, model.value)
        wide = encoders.wide
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, end, _, _ in runs(batch.column(1), RUN):
                yield one_chunk(batch.slice(start, end - start), chunk, encoders, wide)
                chunk += 1

    made = stored(docs.mapInArrow(run, schema), "aligned", {"compression": "zstd"})
    held = made.select("chunk", "wide", F.explode(F.arrays_zip("pairs", "held")).alias("h")).select(
        "chunk", "wide", F.col("h.pairs").alias("pair"), F.col("h.held").alias("held"))
    counts = held.groupBy("pair", "wide").agg(F.sum("held").alias("count"))
    counts = counts.select("pair", "count", (F.col("count") == F.max("count").over(
        Window.partitionBy(F.expr("pair div wide")))).alias("best"))
    found = held.select(F.col("chunk").alias("of"), "pair").join(counts, "pair")
    result = T.StructType([T.StructField("id", id_kind), *[T.StructField(n, T.LongType()) for n in [*_DOC, "n_best", "count_sum"]],
                           T.StructField("groups_sha256", T.StringType())])

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        order = np.argsort(right.column("pair").to_numpy())
        count = right.column("count").to_numpy()[order].astype(_I64)
        best = right.column("best").to_numpy(zero_copy_only=False)[order].astype(_I64)
        for r in range(left.num_rows):
            a, size_a, b, size_b, size, kind, times = (_unpack(left.column(n)[r].as_py()) for n in _PARTS)
            _, first, number, links = _pairs(a, _first(size_a), b, _first(size_b), left.column("wide")[r].as_py())
            kind = np.cumsum(kind)
            row = np.repeat(np.arange(len(size)), size)
            each = []
            for value in (best, count):
                upto = np.concatenate([[0], np.cumsum(value[number] * links)]).astype(_I64)
                total = np.zeros(len(size), _I64)
                np.add.at(total, row, times * np.diff(upto[first])[kind])
                each.append(pa.array(total))
            columns = [left.column("ids").combine_chunks(), *[left.column(n).combine_chunks() for n in _DOC]]
            flat = [c.slice(r, 1).flatten() for c in columns]
            sha = left.column("sha").combine_chunks().slice(r, 1).flatten()
            out.append(pa.Table.from_arrays([*flat, *each, sha], names=result.names))
        return pa.concat_tables(out)

    return (made.drop("pairs", "held").groupBy("chunk").cogroup(found.groupBy("of"))
            .applyInArrow(sums, result))


def cuts(docs: DataFrame, name: str, tokenizer_path: str, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with the struct ``name``: A's and B's ids, and of each group the ends among A's and B's tokens and bytes."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    place = docs.columns.index(text)
    fields = ["a_ids", "b_ids", "a_ends", "b_ends", "byte_ends"]
    kind = T.StructType([T.StructField(n, T.ArrayType(T.LongType())) for n in fields])
    schema = T.StructType([*docs.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = Encoders.of_worker(definition.value, model.value)
        for batch in batches:
            x = aligned(batch.column(place), encoders)
            at = np.searchsorted(x.groups[:, 0], x.first_a)
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            before = np.concatenate([[0], x.ends])[x.first_a]
            parts = [(x.first_a, x.a.astype(_I64)), (x.first_b, x.b.astype(_I64)), (at, x.groups[:, 1] - x.first_a[row]),
                     (at, x.groups[:, 3] - x.first_b[row]), (at, x.ends[x.groups[:, 1] - 1] - before[row])]
            lists = [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), pa.array(v)) for o, v in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(lists, names=fields)],
                                             names=schema.names)

    return docs.mapInArrow(run, schema)
