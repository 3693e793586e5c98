"""Token-id output in training order: fixed-stride binary shards behind a keyed permutation.

Each task tokenises its texts, ends each with the end-of-text id and packs them into sequences of
`length` ids; the task's last one is padded with that id. Sequences are numbered by task and place,
so numbers are dense and depend only on the files and how they are split. A keyed Feistel network
over the next even number of bits, walked along its cycles until it lands below the count, is a
permutation of exactly those numbers: a sequence's slot. Slots are dense, so shard = slot //
`per_shard` partitions them by range without sampling. Every shard is one file of records of equal
size, little-endian, that a reader can enter at any slot and resume from.

Null and empty texts are an end-of-text id alone. Repeated rows are written as often as they occur.
An empty table writes no file and gives no rows. Columns are read by name; others are ignored. A
task that is run again writes the same file again; files appear whole, by a rename.
"""

from __future__ import annotations

import base64
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut
from quintacube.session import ensure_checkpoint_dir

LENGTH, PER_SHARD, KEY, ROUNDS = 4096, 1 << 12, 2718281828, 6
#: Sequences travel packed: on disk and over the network they are counted twice.
PACKING_LEVEL = 6
#: What a worker keeps: chunks in number, in characters of one and in all.
CACHED, CHUNK_CHARS, ALL_CHARS = 1 << 18, 64, 1 << 23

# White space as the tokenizer's pattern has it. A text may be cut before a single space that a
# visible character follows, and around other white space, without changing its tokens.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


def load_ranks(path: str, pattern: str):
    """A tiktoken encoding without special tokens; its end-of-text id is the first free one."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), len(ranks)


class ChunkIds(dict):
    """Token ids of chunks as bytes; missing ones are encoded, and kept while there is room."""

    def __init__(self, path: str, pattern: str):
        super().__init__()
        encoding, self.end = load_ranks(path, pattern)
        self._encode, self.kind, self._room = encoding.encode_ordinary, id_type(self.end + 1), ALL_CHARS

    def __missing__(self, chunk: str) -> bytes:
        ids = np.array(self._encode(chunk), self.kind).tobytes()
        if len(chunk) <= min(CHUNK_CHARS, self._room) and len(self) < CACHED:
            self[chunk] = ids
            self._room -= len(chunk)
        return ids


_chunk_ids: dict[tuple[str, str], ChunkIds] = {}


def chunk_ids(path: str, pattern: str) -> ChunkIds:
    """The ids of a vocabulary's chunks; a worker loads it once and keeps them over its tasks."""
    if (path, pattern) not in _chunk_ids:
        _chunk_ids[path, pattern] = ChunkIds(path, pattern)
    return _chunk_ids[path, pattern]


def id_type(n: int) -> np.dtype:
    return np.dtype("<u2" if n <= 1 << 16 else "<u4")


def feistel(numbers: np.ndarray, count: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. count - 1, applied to `numbers`."""
    half = np.uint64(max(1, -(-max(1, (count - 1).bit_length()) // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    out, walking = np.array(numbers, np.uint64), np.arange(len(numbers))
    while len(walking):
        left, right = out[walking] >> half, out[walking] & mask
        for r in range(rounds):
            x = right + np.uint64((key + 0x9E3779B97F4A7C15 * (r + 1)) % (1 << 64))
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= count]
    return out.astype(np.int64)


_PACKED = "part long, place long, n_tokens int, doc_ids array<long>, starts array<int>, ids binary"


def _pack(path: str, pattern: str, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = chunk_ids(path, pattern)
        look_up, kind, last = ids_of.__getitem__, ids_of.kind, np.array([ids_of.end], ids_of.kind).tobytes()
        squeeze = zstandard.ZstdCompressor(level=PACKING_LEVEL).compress
        part, stride, place = TaskContext.get().partitionId(), length * kind.itemsize, 0
        held, docs, rows = bytearray(), [], []

        def row(n: int) -> None:
            nonlocal held, docs, place
            data = bytes(held[:stride]) + last * (length - n)
            rows.append((part, place, n, [d for d, _ in docs], [s for _, s in docs], squeeze(data)))
            held, place = held[stride:], place + 1

        def batch_of_rows() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            names = ["part", "place", "n_tokens", "doc_ids", "starts", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append((doc, len(held) // kind.itemsize))
                ids = memoryview(b"".join(map(look_up, _CHUNK.findall(text or ""))) + last)
                while len(ids):
                    room = stride - len(held)
                    held += ids[:room]
                    ids = ids[room:]
                    if len(held) == stride:
                        row(length)
                        docs = [(doc, 0)] if len(ids) else []
                        if len(rows) >= 1024:
                            yield batch_of_rows()
        if held:
            row(len(held) // kind.itemsize)
        if rows:
            yield batch_of_rows()

    return pack


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


_WRITTEN = "slot long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, starts array<int>, crc32 long"


def _write(folder: str, per_shard: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        out, shard, offset, temporary = None, -1, 0, ""
        unpack = zstandard.ZstdDecompressor().decompress

        def close() -> None:
            if out is not None:
                out.close()
                store.move(temporary, posixpath.join(path, shard_name(shard)))

        for batch in batches:
            offsets, sums = [], []
            shards = batch.column("shard").to_pylist()
            for now, data in zip(shards, batch.column("ids"), strict=True):
                if now != shard:
                    close()
                    shard, offset, temporary = now, 0, posixpath.join(path, f"_{uuid.uuid4()}")
                    out = store.open_output_stream(temporary)
                data = unpack(data.as_buffer())
                out.write(data)
                offsets.append(offset)
                sums.append(zlib.crc32(data))
                offset += len(data)
            kept = [batch.column(c) for c in ("n_tokens", "doc_ids", "starts")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), batch.column("shard"), pa.array(offsets, pa.int64()), *kept, pa.array(sums, pa.int64())],
                ["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "starts", "crc32"],
            )
        close()

    return write


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/token-shards/{uuid.uuid4()}"


def materialise(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    folder: str,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = KEY,
) -> DataFrame:
    """Write the shards below `folder` (shared by all executors) and return one row per sequence.

    `doc_ids` and `starts` say whose tokens a sequence holds and where each begins in it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    packed = cut(rows.mapInArrow(_pack(vocabulary, pattern, length), _PACKED))
    parts = sorted(packed.groupBy("part").count().collect())  # one row a task
    bases, count = [], 0
    for part, n in parts:
        bases.append((part, count))
        count += n
    if not count:
        return spark.createDataFrame([], _WRITTEN)
    base = F.broadcast(spark.createDataFrame(bases, "part long, base long"))

    @F.pandas_udf("long")
    def slot_of(numbers: pd.Series) -> pd.Series:
        return pd.Series(feistel(numbers.to_numpy(), count, key))

    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    shards = -(-count // per_shard)
    placed = (
        packed.join(base, "part")
        .withColumn("slot", slot_of(F.col("base") + F.col("place")))
        .withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
        .drop("part", "base", "place")
    )
    in_order = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    return cut(in_order.mapInArrow(_write(folder, per_shard), _WRITTEN))


def read_sequences(folder: str, first: int, n: int, kind: np.dtype, length: int = LENGTH, per_shard: int = PER_SHARD) -> np.ndarray:
    """`n` consecutive slots from `first` on, as rows of ids; shards are read by seeking."""
    store, path = open_folder(folder)
    stride, out = length * kind.itemsize, []
    while n > 0:
        place = first % per_shard
        take = min(n, per_shard - place)
        with store.open_input_file(posixpath.join(path, shard_name(first // per_shard))) as data:
            data.seek(place * stride)
            got = np.frombuffer(data.read(take * stride), kind).reshape(-1, length)
        if not len(got):
            break
        out.append(got)
        first, n = first + len(got), n - len(got)
    return np.concatenate(out) if out else np.zeros((0, length), kind)
