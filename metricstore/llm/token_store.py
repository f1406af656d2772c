"""Token ids as compressed binary blocks with an offset index.

Layout below ``path`` (Parquet, so it can lie in any store Spark writes to):

- ``dictionary``: one row; a zstandard dictionary trained on serialised id
  arrays, its SHA-256, the tokenizer's SHA-256 and the end id;
- ``blocks``: one row per run of documents in ascending id order: ``shard`` and
  ``block`` (their order), ``dict_sha256``, ``doc_ids``, ``offsets`` (of each
  document's frame in ``frames``, one more than documents), ``counts`` (ids per
  document), ``start`` (ids of the shard before the block), ``n_tokens``;
- ``shards``: ids before each shard.

A frame is one document's ids (little-endian unsigned 32-bit), compressed alone
with the shared dictionary, so one short document is read without its
neighbours.  The dictionary is trained on a bounded sample: ``sample_docs``
documents of at most ``sample_bytes`` bytes each, in the order of a hash of
their ids.  Where that is too few to train on, the samples themselves are the
dictionary (frames of a table without any text are plain zstandard).

Tokenizing: a byte-level pre-tokenizer always splits before a single blank that
stands between two characters that aren't white space, and between a letter or
digit and a punctuation mark (but for apostrophes), so the text is cut there.
Each distinct piece of a run of texts is encoded once (a worker keeps the first
ones it meets), and the pieces' ids are joined.  A text that holds the string of
an added token (``<|endoftext|>``) is encoded in one piece, and the string gives
that token's id.  The ids equal those of the whole text (tested).

Defined results: a null or empty text has the end id alone; rows that repeat an
id are separate documents next to each other; null ids come first; an empty
table gives a store without blocks.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import runs, worker_cache
from metricstore.llm.store import SMALL_BATCHES
from metricstore.sinks.store import session_settings

BLOCK_DOCS, BLOCK_BYTES = 512, 4 << 20
RANGE_BYTES = 32 << 20  # bytes of text that a task writes
RUN = 4 << 20  # bytes of text encoded at a time
LONG = 1 << 10  # characters of a piece that is not kept
_B = np.arange(256)
#: Bytes that surely belong to a visible character: printable ASCII, and the leads of two-byte letters.
_VISIBLE = ((_B > 0x20) & (_B < 0x7F)) | ((_B >= 0xC3) & (_B <= 0xDF))
_ALNUM = ((_B >= 0x30) & (_B <= 0x39)) | ((_B | 0x20) >= 0x61) & ((_B | 0x20) <= 0x7A) & (_B < 0x80)
#: ASCII punctuation, but for the apostrophe, which may belong to the letters before it.
_MARK = (_B > 0x20) & (_B < 0x7F) & ~_ALNUM & (_B != 0x27)


def load_tokenizer(definition: str, special_as_text: bool = False):
    """The tokenizer of a JSON text; its special tokens' strings in texts give their ids, or are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


def pieces(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at each row, and at blanks and marks where the pre-tokenizer always splits."""
    cut = np.zeros(len(buf) + 1, bool)
    if len(buf) > 2:
        blank = buf[1:-1] == 0x20
        before = _VISIBLE[buf[:-2]] & (buf[:-2] < 0x80)
        before[1:] |= (buf[1:-2] >= 0x80) & (buf[1:-2] < 0xC0) & (buf[:-3] >= 0xC3) & (buf[:-3] <= 0xDF)
        cut[1:-2] = blank & before & _VISIBLE[buf[2:]]
        letter = _ALNUM[buf]
        # A letter of two bytes: C3 and a byte, but for the signs of multiplication and division.
        letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        cut[1:-1] |= letter[:-1] & _MARK[buf[1:]]
    cut[offsets] = True
    cut[len(buf)] = False
    return np.flatnonzero(cut)


def rows_with(buf: np.ndarray, offsets: np.ndarray, tokens: list[bytes]) -> np.ndarray:
    """Whether each row holds one of the tokens."""
    out = np.zeros(len(offsets) - 1, bool)
    raw = buf.tobytes()
    for token in tokens:
        at = raw.find(token)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, "right")) - 1
            if at + len(token) <= offsets[row + 1]:
                out[row] = True
                at = raw.find(token, int(offsets[row + 1]))
            else:  # the bytes of two rows
                at = raw.find(token, at + 1)
    return out


class Encoder:
    """Encodes texts piece by piece; the first ``most`` distinct pieces are kept and looked up.

    A text that holds an added token's string is one piece, as the library cuts it there first.
    """

    def __init__(self, definition: str, most: int = 500_000):
        self.tokenizer, self.most = load_tokenizer(definition), most
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    @staticmethod
    def of_worker(definition: str) -> Encoder:
        """The encoder of this Python worker, with what earlier tasks have kept."""
        have = worker_cache("encoders")
        key = hashlib.sha256(definition.encode()).hexdigest()
        if key not in have:
            have.clear()
            have[key] = Encoder(definition)
        return have[key]

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each row)."""
        at = pieces(buf, offsets)
        if not len(at):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        whole = rows_with(buf, offsets, self.added)
        if whole.any():
            row = np.searchsorted(offsets, at, "right") - 1
            at = at[~whole[row] | (at == offsets[row])]
        edges = np.append(at, len(buf)).astype(np.int32)
        coded = pa.StringArray.from_buffers(
            len(at), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf))).dictionary_encode()
        index = coded.indices.to_numpy()
        texts = coded.dictionary.to_pylist()
        keep = self.known if len(self.known) < self.most else {}
        each = list(map(self.known.get, texts))
        new = [i for i, x in enumerate(each) if x is None]
        for k in range(0, len(new), 256):
            part = [texts[i] for i in new[k:k + 256]]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            raw = array("I", found.ids).tobytes()
            ends = (4 * np.cumsum(np.bincount(found.word_ids, minlength=len(part)))).tolist()
            for i, t, s, e in zip(new[k:], part, [0, *ends], ends):
                each[i] = raw[s:e]
                if len(t) < LONG:
                    keep[t] = each[i]
        flat = np.frombuffer(b"".join(each), np.uint32)
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        first = np.cumsum(size) - size
        sizes = size[index]
        ends = np.cumsum(sizes)
        place = np.repeat(first[index] - ends + sizes, sizes)
        place += np.arange(len(place))
        upto = np.concatenate([[0], ends])
        return flat.take(place), np.diff(upto[np.searchsorted(at, offsets)])

    def documents(self, col: pa.Array, end_id: int) -> Iterator[bytes]:
        """The ids of each text and the end id, as little-endian bytes."""
        last = np.array([end_id], "<u4").tobytes()
        for _, _, buf, offs in runs(col, RUN):
            ids, counts = self.encode(buf, offs)
            raw = memoryview(ids.astype("<u4", copy=False).tobytes())
            end = 4 * np.cumsum(counts)
            for s, e in zip((end - 4 * counts).tolist(), end.tolist()):
                yield b"".join((raw[s:e], last))


def train_dictionary(docs: DataFrame, definition, doc_id: str, text: str, end_id: int, sample_docs: int,
                     sample_bytes: int, size: int) -> bytes:
    import zstandard

    sample = (docs.where(F.octet_length(text) <= sample_bytes).select(F.xxhash64(doc_id).alias("o"), text)
              .orderBy("o", text).limit(sample_docs).select(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(definition.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(encoder.documents(batch.column(0), end_id)), pa.binary())], names=["ids"])

    samples = [bytes(r["ids"]) for r in sample.mapInArrow(run, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own content
        raw = b"".join(samples)[-size:]
        return raw if len(raw) >= 8 else b""


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int = 2, level: int = 3, dictionary_bytes: int = 32 << 10, sample_docs: int = 1000,
                 sample_bytes: int = 32 << 10) -> None:
    """Write the ids of every whole text, with the end id appended, as a store at ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    shared = spark.sparkContext.broadcast(definition)  # one tokenizer file, a few MB
    docs = docs.select(doc_id, text)
    known = train_dictionary(docs, shared, doc_id, text, end_id, sample_docs, sample_bytes, dictionary_bytes)
    sha = hashlib.sha256(known).hexdigest()
    spark.createDataFrame(
        [(sha, known, hashlib.sha256(definition.encode()).hexdigest(), end_id)],
        "dict_sha256 string, dictionary binary, tokenizer_sha256 string, end_id int").write.parquet(f"{path}/dictionary")
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
        T.StructField("dict_sha256", T.StringType()), T.StructField("doc_ids", T.ArrayType(kind)),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("frames", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        dictionary = zstandard.ZstdCompressionDict(known) if known else None
        if dictionary:
            dictionary.precompute_compress(level=level)
        zip_ = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
        encoder = Encoder.of_worker(shared.value)
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        ids, counts, frames, size = [], [], [], 0

        def done(of: pa.DataType) -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).tolist()
            row = [[shard], [block], [sha], pa.array([ids], pa.list_(of)), pa.array([counts], pa.list_(pa.int64())),
                   pa.array([offsets], pa.list_(pa.int64())), [start], [sum(counts)], pa.array([b"".join(frames)], pa.binary())]
            types = [pa.int32(), pa.int32(), pa.string(), None, None, None, pa.int64(), pa.int64(), None]
            return pa.RecordBatch.from_arrays(
                [x if t is None else pa.array(x, t) for x, t in zip(row, types)], names=schema.names)

        of = None
        for batch in batches:
            of = batch.column(0).type
            for one, raw in zip(batch.column(0).to_pylist(), encoder.documents(batch.column(1), end_id)):
                ids.append(one)
                counts.append(len(raw) // 4)
                frames.append(zip_.compress(raw))
                size += len(frames[-1])
                if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield done(of)
                    block, start = block + 1, start + sum(counts)
                    ids, counts, frames, size = [], [], [], 0
        if ids:
            yield done(of)

    # Ranges follow the bytes of the texts.
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))
    with session_settings(spark, SMALL_BATCHES):
        (docs.repartitionByRange(ranges, doc_id).sortWithinPartitions(doc_id, text).mapInArrow(run, schema)
         .write.parquet(f"{path}/blocks"))
    # One row per write task.
    shards = sorted((r["shard"], r["n"]) for r in spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(
        F.sum("n_tokens").alias("n")).collect())
    before = np.concatenate([[0], np.cumsum([n for _, n in shards])])
    spark.createDataFrame([(s, int(b)) for (s, _), b in zip(shards, before)],
                          "shard int, before long").write.parquet(f"{path}/shards")


def read_tokens(spark: SparkSession, path: str, ids: list | None = None, payload: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): start counts the ids of all documents before, ids is their bytes.

    ``ids``: read these documents alone; blocks without them are skipped and only their frames are decompressed.
    ``payload=False`` leaves ids null; the checksum is that of the decompressed bytes all the same.
    """
    row = spark.read.parquet(f"{path}/dictionary").first()
    known, sha = bytes(row["dictionary"]), row["dict_sha256"]
    if hashlib.sha256(known).hexdigest() != sha:
        raise ValueError(f"{path}: the dictionary does not match its hash")
    blocks = spark.read.parquet(f"{path}/blocks").join(F.broadcast(spark.read.parquet(f"{path}/shards")), "shard")
    if ids is not None:
        blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i) for i in ids])))
    wanted = set(ids) if ids is not None else None
    kind = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        dictionary = zstandard.ZstdCompressionDict(known) if known else None
        unzip = zstandard.ZstdDecompressor(dict_data=dictionary)
        for batch in batches:
            for k in range(batch.num_rows):
                of, docs, counts, offsets, start, frames = (batch.column(c)[k].as_py() for c in range(6))
                if of != sha:
                    raise ValueError(f"a block was written with dictionary {of}, not {sha}")
                at = start + np.cumsum([0, *counts[:-1]])
                take = [i for i, d in enumerate(docs) if wanted is None or d in wanted]
                view = memoryview(frames)
                raw = [unzip.decompress(view[offsets[i]:offsets[i + 1]]) for i in take]
                yield pa.RecordBatch.from_arrays([
                    pa.array([docs[i] for i in take], batch.column(1).type.value_type),
                    pa.array([int(at[i]) for i in take], pa.int64()), pa.array([counts[i] for i in take], pa.int64()),
                    pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                    pa.array(raw, pa.binary()) if payload else pa.nulls(len(raw), pa.binary())],
                    names=schema.names)

    return blocks.select("dict_sha256", "doc_ids", "counts", "offsets", F.col("start") + F.col("before"),
                         "frames").mapInArrow(run, schema)
