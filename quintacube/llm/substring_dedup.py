"""Suffix-array deduplication of repeated byte strings across documents.

A string of `NEED` bytes repeats if it starts earlier too: in a document with a smaller id, or
further left in the same one. Every byte of a repeat is removed; repeats are judged on the input.

1. Anchors. The smallest hash of the `GRAM`-byte grams inside a string of `NEED` bytes, the leftmost
   if several are equal, depends on the string alone. Starts that share an anchor form a range.
2. Candidates. Every range goes to its anchor once, as numbers. An anchor found once in the corpus
   cannot belong to a repeat. Of equal ranges (equal hashes of anchor and bytes, 128 bits) the earliest
   stays and all others repeat it whole. Strings of one range differ, so an anchor that is left with
   one piece is done. Equal ranges of a task are combined before that shuffle, so that what a hot
   passage sends grows with the tasks, not with the documents.
3. Wide anchors. An anchor with more than `WIDE` different pieces around it, such as a common line
   that is shorter than `NEED` bytes, is taken apart: each of its strings gets the string's own hash
   for an anchor. One with an eighth of that in `RANGES` ranges of a task is taken apart as well, and its
   ranges are spread over the tasks. So no task has to hold all that surrounds a common line.
4. Shards. The bytes around each remaining range go to the shard of its anchor's hash, where all
   equal strings meet. The suffixes of the pieces of a shard are sorted by external induced sorting;
   neighbours with `NEED` bytes in common are one string, and all its starts but the earliest are repeats.
5. Removal. Each document gets its repeats and is cut.

Texts are read in place three times, or four if there are wide anchors, and never shuffled: ranges and repeats are written by block
(file and `BLOCK_ROWS` rows of it), and a task that reads rows of a block loads what is stored for it.
Rows are addressed by file and number, so each read may split the files in its own way. Ranges
that a read does not cut out, and stored spans that reach beyond a row's text, are errors.

Null and empty texts have nothing to remove. A null id comes after all others. Rows that repeat an
id are ordered by their place in the files. An empty table gives no rows. Columns are read by name;
others are ignored.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quintacube.functions.sizing import cut, small_side
from quintacube.llm import words
from quintacube.llm.induced_sort import MEMORY_SYMBOLS, QUEUE_TUPLES, scratch, suffixes
from quintacube.llm.places import placed
from quintacube.session import ensure_checkpoint_dir

NEED, GRAM = 100, 24
SHARD_BYTES = 1 << 22
#: Rows of a file whose ranges and repeats are stored together.
BLOCK_ROWS = 1 << 14
#: Longer texts are handled in overlapping pieces; a place in a piece must fit into these bits.
PIECE_BITS = 25
#: Different pieces around one anchor, beyond which its strings are told apart: about an eighth of a shard.
WIDE = SHARD_BYTES >> 10
#: Ranges of a task among which equal ones are combined before they meet their anchor.
RANGES = 1 << 18
#: What is known of a range: all its strings repeat; its bytes are to be sorted, `MANY` if its anchor
#: has more ranges than it may have pieces; each of its strings is to get an anchor of its own.
KNOWN, OPEN, MANY, APART = 1, 2, 3, 4
#: Bytes that a task hands on at once, and that one which sorts holds in memory before it uses a file.
BATCH_BYTES, SPOOLED_BYTES = 1 << 21, 1 << 25
_LAST_ID = (1 << 63) - 1


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values, from minima inside blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(texts: list[bytes], need: int = NEED, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first start, number of starts, anchor hash, hash of all bytes) of all ranges in some texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < need:
        return none, none, none, none, none
    h = words.grams(data, gram)
    below = np.uint64((1 << (PIECE_BITS + 1)) - 1)
    least = _sliding_min((h & ~below) | np.arange(len(h), dtype=np.uint64), need - gram + 1)
    place = (least & below).astype(np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(place)]
    start = np.flatnonzero(np.arange(len(place)) + need <= ends[text])
    if not len(start):
        return none, none, none, none, none
    fresh = np.append(True, (place[start[1:]] != place[start[:-1]]) | (np.diff(start) != 1))
    begin = np.flatnonzero(fresh)
    first, count = start[begin], np.diff(np.append(begin, len(start)))
    owner = text[first]
    whole = words.span_hashes(data, first, first + count + (need - 1))
    return owner, first - (ends - sizes)[owner], count, h[place[first]].view(np.int64), whole.view(np.int64)


def _pieces(data: bytes, need: int) -> Iterator[tuple[int, bytes]]:
    size = 1 << PIECE_BITS
    for at in range(0, max(1, len(data) - need + 1), size):
        yield at, data[at : at + size + need - 1]


def _bytes(batch: pa.RecordBatch) -> Iterator[bytes]:
    """The texts one by one: a batch may hold many times the bytes that a task should."""
    return (t.as_py() or b"" for t in batch.column("text"))


_RANGE = "doc_id long, block long, row int, first int, starts int, state int, key long, piece long"
_RANGE_KINDS = {"doc_id": np.int64, "block": np.int64, "row": np.int32, "first": np.int32, "starts": np.int32, "state": np.int32, "key": np.int64, "piece": np.int64}
_SPREAD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _spread(*numbers: np.ndarray) -> np.ndarray:
    h = np.zeros(len(numbers[0]), np.uint64)
    for x, by in zip(numbers, _SPREAD, strict=False):
        h = (h ^ (h >> np.uint64(32)) ^ x.astype(np.int64).view(np.uint64)) * by
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _combined(parts: list[dict[str, np.ndarray]], need: int, many: int) -> pa.RecordBatch:
    """Some ranges of a task as they go to their anchors.

    Of equal ones the earliest goes. The others are known to repeat; neighbouring ones of a text go as
    one, away from their anchor. An anchor with more than `many` pieces is taken apart: one of its ranges
    tells the other tasks so, the rest meet none but their equals.
    """
    c = {n: np.concatenate([p[n] for p in parts]).astype(np.int64) for n in _RANGE_KINDS if n != "state"}
    order = np.lexsort((c["first"], c["row"], c["block"], c["doc_id"]))
    c = {n: v[order] for n, v in c.items()}
    n = len(order)
    line = np.lexsort((c["piece"], c["key"]))
    key, piece = c["key"][line], c["piece"][line]
    lead = np.append(True, key[1:] != key[:-1])
    head = lead | np.append(True, piece[1:] != piece[:-1])
    group = np.cumsum(lead) - 1
    hot = head & (np.bincount(group[head])[group] > many)
    state = np.zeros(n, np.int64)
    state[line[~head]], state[line[hot]] = KNOWN, APART
    apart = line[hot & ~lead]
    c["key"][apart] ^= _spread(c["piece"][apart])
    again = state == KNOWN
    end = c["first"] + c["starts"] + (need - 1)
    of_text = (c["block"][1:] == c["block"][:-1]) & (c["row"][1:] == c["row"][:-1])
    joins = again & np.append(False, again[:-1] & of_text & (c["first"][1:] <= end[:-1]))
    begin = np.flatnonzero(~joins)
    stop = np.maximum.reduceat(end, begin)  # of a text's neighbours the last reaches furthest
    c = {n: v[begin] for n, v in (c | {"state": state}).items()}
    c["starts"] = stop - c["first"] - (need - 1)
    known = c["state"] == KNOWN
    c["key"][known] = _spread(c["block"][known], c["row"][known], c["first"][known])
    c["piece"][known] = 0
    return pa.RecordBatch.from_arrays([pa.array(c[n].astype(t)) for n, t in _RANGE_KINDS.items()], list(_RANGE_KINDS))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_LAST_ID).to_numpy()


def _find_anchors(need: int, gram: int, many: int):
    def of_texts(texts: list[tuple[int, int, int, int, bytes]]) -> dict[str, np.ndarray]:
        owner, first, count, key, whole = anchors([t[4] for t in texts], need, gram)
        ids, block, row, offset = (np.array([t[k] for t in texts], np.int64)[owner] for k in range(4))
        return {"doc_id": ids, "block": block, "row": row, "first": first + offset, "starts": count, "key": key, "piece": whole}

    def parts(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
        held, size = [], 0
        for doc_id, block, row, data in zip(_ids(batch).tolist(), batch.column("block").to_pylist(), batch.column("row").to_pylist(), _bytes(batch), strict=True):
            for at, piece in _pieces(data, need):
                held.append((doc_id, block, row, at, piece))
                size += len(piece)
                if size >= words.CHUNK_BYTES:
                    yield of_texts(held)
                    held, size = [], 0
        if held:
            yield of_texts(held)

    return lambda batches: _in_groups((p for b in batches for p in parts(b)), need, many)


def _in_groups(parts: Iterator[dict[str, np.ndarray]], need: int, many: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        if len(part["first"]):
            held.append(part)
            size += len(part["first"])
        if size >= RANGES:
            yield _combined(held, need, many)
            held, size = [], 0
    if held:
        yield _combined(held, need, many)


class Stored:
    """Rows of tables written by block, loaded for one block at a time, in order of their row."""

    def __init__(self, folders: list[str], columns: list[str]):
        self._store, _ = fs.FileSystem.from_uri(folders[0])
        self._paths = [fs.FileSystem.from_uri(f)[1] for f in folders]
        self._columns, self._block, self._held = columns, None, None

    def of(self, block: int) -> dict[str, np.ndarray]:
        if block != self._block:
            self._block = self._held = None
            tables = []
            for path in (f"{p}/block={block}" for p in self._paths):
                if self._store.get_file_info(path).type == fs.FileType.Directory:
                    tables.append(ds.dataset(path, filesystem=self._store, format="parquet").to_table(columns=self._columns))
            found = {c: np.concatenate([np.zeros(0, np.int32), *(t[c].to_numpy() for t in tables)]) for c in self._columns}
            order = np.lexsort((found["first"], found["row"]))
            self._block, self._held = block, {c: v[order] for c, v in found.items()}
        return self._held

    def rows(self, block: int, row: int) -> dict[str, np.ndarray]:
        held = self.of(block)
        a, z = np.searchsorted(held["row"], [row, row + 1])
        return {c: v[a:z] for c, v in held.items()}


def _stored_texts(batch: pa.RecordBatch, stored: Stored) -> Iterator[tuple[int, int, int, bytes, dict[str, np.ndarray]]]:
    """Id, block, row, text and stored rows of each text that has any."""
    blocks, rows = batch.column("block").to_pylist(), batch.column("row").to_pylist()
    for doc_id, block, row, text in zip(_ids(batch).tolist(), blocks, rows, batch.column("text"), strict=True):
        r = stored.rows(block, row)
        if len(r["row"]):
            data = text.as_py() or b""
            if len(data) < int(r["end"].max()):
                raise RuntimeError("a text has changed since its ranges were written")
            yield doc_id, block, row, data, r


def _wide_starts(folders: list[str], need: int):
    """Every start of the stored ranges as a range of its own, under the hash of its string."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        stored = Stored(folders, ["row", "first", "end"])
        for batch in batches:
            for doc_id, block, row, text, r in _stored_texts(batch, stored):
                data = np.frombuffer(text, np.uint8)
                first, n = r["first"].astype(np.int64), (r["end"] - r["first"]).astype(np.int64) - (need - 1)
                at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                same = {c: np.full(len(at), v) for c, v in (("doc_id", doc_id), ("block", block), ("row", row), ("starts", 1))}
                key, piece = words.span_hashes(data, at, at + need), words.window_hashes(data, need)[at]
                yield same | {"first": at, "key": key.view(np.int64), "piece": piece.view(np.int64)}

    return lambda batches: _in_groups(parts(batches), need, RANGES)


_PIECE = "key long, doc_id long, block long, row int, first int, data binary"
_PIECE_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
_PIECE_NAMES = ["key", "doc_id", "block", "row", "first", "data"]


def _cut_pieces(folders: list[str]):
    """Bytes around each stored range."""

    def batch_of(parts: list[tuple], data: list[bytes]) -> pa.RecordBatch:
        n = [len(p[3]) for p in parts]
        same = [np.repeat(np.array([p[k] for p in parts]), n) for k in range(3)]
        key, first = (np.concatenate([p[k] for p in parts]) for k in (3, 4))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((key, *same, first, data), _PIECE_KINDS, strict=True)], _PIECE_NAMES)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = Stored(folders, ["row", "first", "end", "key"])
        for batch in batches:
            parts, data, size = [], [], 0
            for doc_id, block, row, text, r in _stored_texts(batch, stored):
                begin = 0
                while begin < len(r["row"]):  # a text alone may have many times the bytes of a batch
                    room = np.cumsum(r["end"][begin:].astype(np.int64) - r["first"][begin:] + 64)
                    stop = begin + max(1, int(np.searchsorted(room, BATCH_BYTES - size)))
                    first, end = r["first"][begin:stop], r["end"][begin:stop]
                    data += [text[a:z] for a, z in zip(first.tolist(), end.tolist(), strict=True)]
                    parts.append((doc_id, block, row, r["key"][begin:stop], first))
                    size += int(room[stop - begin - 1])
                    begin = stop
                    if size >= BATCH_BYTES or begin < len(r["row"]):
                        yield batch_of(parts, data)
                        parts, data, size = [], [], 0
            if parts:
                yield batch_of(parts, data)

    return cut_out


_REPEAT = "block long, row int, first int, end int"


def repeats(
    text: np.ndarray, sizes: np.ndarray, order: tuple[np.ndarray, ...], starts: np.ndarray, need: int = NEED, memory: int = MEMORY_SYMBOLS, queue: int = QUEUE_TUPLES
) -> tuple[np.ndarray, np.ndarray]:
    """(piece, start in it) of every start whose string of `need` bytes starts earlier.

    `text` holds the pieces end to end, `order` their sort columns, most significant first, `starts`
    their numbers of starts, below `need` + 1 each.
    """
    begin = np.cumsum(sizes) - sizes
    owner = scratch(len(text), np.int32, memory)
    owner[begin[1:]] = 1
    np.cumsum(owner, out=owner)
    rank = np.empty(len(sizes), np.int64)
    rank[np.lexsort(order[::-1])] = np.arange(len(sizes))
    found, group, kept = [], 0, []
    for position, prefix in suffixes(text, 256, need, memory, queue):
        groups = group + np.cumsum(prefix < need)
        group = int(groups[-1])
        piece = owner[position]
        inside = position - begin[piece]
        ok = inside < starts[piece]
        found.append((rank[piece[ok]] * (need + 1) + inside[ok]).astype(np.int64))
        kept.append(groups[ok])
    place, groups = np.concatenate(found), np.concatenate(kept)
    if not len(place):
        return place, place
    begins = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    least = np.repeat(np.minimum.reduceat(place, begins), np.diff(np.append(begins, len(place))))
    later = np.sort(place[place != least])
    of_rank = np.argsort(rank)
    return of_rank[later // (need + 1)], later % (need + 1)


def _sort_shard(need: int, memory: int, queue: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Bytes go to a file of the task once there are many; a piece keeps 32 bytes of numbers in memory.
        spool = tempfile.SpooledTemporaryFile(SPOOLED_BYTES)
        parts, columns = [], ["doc_id", "block", "row", "first"]
        for batch in batches:
            data = batch.column("data").cast(pa.large_binary())
            bounds = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
            spool.write(data.buffers()[2][int(bounds[0]) : int(bounds[-1])] if len(data) else b"")
            parts.append({n: batch.column(n).to_numpy().copy() for n in columns} | {"size": np.diff(bounds)})
        received = sum(len(p["size"]) for p in parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([None], pa.int32()), pa.array([received], pa.int32()), pa.array([None], pa.int32())],
            ["block", "row", "first", "end"],
        )
        if not received:
            return
        c = {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}
        sizes = c["size"]
        text, at = scratch(int(sizes.sum()), np.uint8, memory), 0
        spool.seek(0)
        while part := spool.read(BATCH_BYTES):
            text[at : at + len(part)] = np.frombuffer(part, np.uint8)
            at += len(part)
        spool.close()
        piece, start = repeats(text, sizes, tuple(c[n] for n in columns), sizes - (need - 1), need, memory, queue)
        if len(piece):
            fresh = np.append(True, (piece[1:] != piece[:-1]) | (np.diff(start) != 1))
            begin = np.flatnonzero(fresh)
            last = start[np.append(begin[1:], len(start)) - 1]
            owner = piece[begin]
            first = c["first"][owner]
            yield _repeat_batch(c["block"][owner], c["row"][owner], first + start[begin], first + last + need)

    return sort


def _repeat_batch(block: np.ndarray, row: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), *(pa.array(x.astype(np.int32)) for x in (row, first, end))], ["block", "row", "first", "end"]
    )


_RESULT = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])


def _remove(folders: list[str]):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = Stored(folders, ["row", "first", "end"])

        def batch_of(ids: pa.Array, sizes: list[int], spans: list, kept: list[bytes]) -> pa.RecordBatch:
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(_SPAN)), pa.array(kept, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

        for batch in batches:
            blocks, rows, ids = batch.column("block").to_pylist(), batch.column("row").to_pylist(), batch.column("doc_id")
            sizes, spans, kept, held, done = [], [], [], 0, 0
            for k, (block, row, data) in enumerate(zip(blocks, rows, _bytes(batch), strict=True)):
                r = stored.rows(block, row)
                first, end = r["first"], r["end"]
                if len(end) and end.max() > len(data):
                    raise RuntimeError(f"row {row} of block {block} has changed since its repeats were written")
                mine, parts, at = [], [], 0
                if len(first):
                    reach = np.maximum.accumulate(end)
                    begin = np.flatnonzero(np.append(True, first[1:] > reach[:-1]))
                    ends = reach[np.append(begin[1:], len(first)) - 1]
                    for a, z in zip(first[begin].tolist(), ends.tolist(), strict=True):
                        mine.append({"start": a, "end": z})
                        parts.append(data[at:a])
                        at = z
                sizes.append(len(data))
                spans.append(mine)
                kept.append(b"".join(parts) + data[at:])
                held += len(kept[-1]) + 200
                if held >= BATCH_BYTES or k + 1 == len(batch):
                    yield batch_of(ids[done : k + 1], sizes, spans, kept)
                    sizes, spans, kept, held, done = [], [], [], 0, k + 1

    return remove


def _placed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Id, text, block and row in it; the same in every read of the table."""
    row = F.col("row")
    return placed(docs, list(dict.fromkeys([id_col, text]))).select(
        row[id_col].cast("long").alias("doc_id"),
        row[text].cast("string").cast("binary").alias("text"),
        F.xxhash64("file", F.floor(F.col("at") / BLOCK_ROWS)).alias("block"),
        (F.col("at") % BLOCK_ROWS).cast("int").alias("row"),
    )


_STATED = "state int, block long, row int, first int, end int, key long"


def _judged(found: DataFrame, need: int, wide: int) -> DataFrame:
    """What is known of each range once it has met all that share its anchor; ranges without a repeat go."""
    line = Window.partitionBy("key").orderBy("piece", "doc_id", "block", "row", "first")
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    piece = F.col("piece")
    state = (
        F.when((F.col("state") == KNOWN) | (F.col("before") == piece), KNOWN)
        .when(F.col("most") == APART, APART)
        .when(F.col("low") == F.col("high"), 0)
        .when(F.col("n") > wide, MANY)
        .otherwise(OPEN)
    )
    met = found.select(
        "*",
        F.lag("piece").over(line).alias("before"),
        F.count("*").over(every).alias("n"),
        F.min("piece").over(every).alias("low"),
        F.max("piece").over(every).alias("high"),
        F.max("state").over(every).alias("most"),
    )
    end = (F.col("first") + F.col("starts") + (need - 1)).alias("end")
    key = F.when(F.col("state").isin(OPEN, MANY), F.col("key")).alias("key")
    return met.withColumn("state", state).where("state > 0").select("state", "block", "row", "first", end, key)


def _write_by_block(rows: DataFrame, folder: str) -> DataFrame:
    """The rows as written to a folder for each state, and in it for each block."""
    rows.repartition("block").write.option("compression", "zstd").partitionBy("state", "block").parquet(folder)
    return rows.sparkSession.read.schema(_STATED).parquet(folder)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    need: int = NEED,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    memory: int = MEMORY_SYMBOLS,
    queue: int = QUEUE_TUPLES,
    wide: int = WIDE,
) -> DataFrame:
    """Id, n_bytes, the maximal removed spans and the kept bytes of every row's UTF-8 text."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/substring-dedup/{uuid.uuid4()}"
    rows = _placed(docs, id_col, text)
    found = rows.mapInArrow(_find_anchors(need, gram, max(1, wide >> 3)), _RANGE)
    ranges = _write_by_block(_judged(found, need, wide), f"{folder}/ranges")
    heads = ranges.where(F.col("state").isin(OPEN, MANY))
    # Few keys by arithmetic: each has more than `wide` ranges.
    pieces = ranges.where(F.col("state") == MANY).groupBy("key").agg(F.count("*").alias("n"))
    broad = small_side(pieces.where(F.col("n") > wide).select("key"))
    narrow = heads.join(broad, "key", "left_anti")
    to_cut = [f"{folder}/ranges/state={s}" for s in (OPEN, MANY)]
    to_part, known = [f"{folder}/ranges/state={APART}"], [f"{folder}/ranges/state={KNOWN}"]
    many = not broad.isEmpty()
    if many:
        narrow = _write_by_block(narrow, f"{folder}/narrow")
        _write_by_block(heads.join(broad, "key").withColumn("state", F.lit(APART)), f"{folder}/broad")
        to_cut = [f"{folder}/narrow/state={s}" for s in (OPEN, MANY)]
        to_part.append(f"{folder}/broad/state={APART}")
    if many or not ranges.where(F.col("state") == APART).isEmpty():
        starts = rows.mapInArrow(_wide_starts(to_part, need), _RANGE)
        _write_by_block(_judged(starts, need, wide).where(F.col("state") == KNOWN), f"{folder}/apart")
        known.append(f"{folder}/apart/state={KNOWN}")
    size, expected = narrow.agg(F.sum(F.col("end") - F.col("first")), F.count("*")).first()
    shards = -(-(size or 1) // shard_bytes)
    pieces = rows.mapInArrow(_cut_pieces(to_cut), _PIECE).repartition(shards, "key")
    found = cut(pieces.mapInArrow(_sort_shard(need, memory, queue), _REPEAT))
    # Every shard reports the number of its pieces in a row of its own, without a block.
    cut_out = found.where("block IS NULL").agg(F.sum("first")).first()[0] or 0
    if cut_out != expected:
        raise RuntimeError(f"{expected} ranges were written, {cut_out} were cut out of the texts")
    _write_by_block(found.where("block IS NOT NULL").withColumn("state", F.lit(KNOWN)), f"{folder}/repeats")
    return rows.mapInArrow(_remove([*known, f"{folder}/repeats/state={KNOWN}"]), _RESULT)


def oracle_sql(need: int = NEED) -> str:
    """The digests of the query in DuckDB SQL: every string of `need` bytes of every document."""
    return f"""
    WITH d AS (SELECT doc_id, encode(COALESCE(text, '')) AS bytes, hex(encode(COALESCE(text, ''))) AS h
               FROM documents),
    w AS (SELECT doc_id, s, array_slice(bytes, s + 1, s + {need}) AS g
          FROM d, LATERAL (SELECT unnest(range(0, greatest(0, len(h) // 2 - {need - 1}))) AS s)),
    r AS (SELECT doc_id, s FROM w QUALIFY ROW_NUMBER() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
    i AS (SELECT doc_id, s, CASE WHEN s <= LAG(s) OVER (PARTITION BY doc_id ORDER BY s) + {need} THEN 0 ELSE 1 END AS f FROM r),
    j AS (SELECT doc_id, s, SUM(f) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM i),
    p AS (SELECT doc_id, k, MIN(s) AS a, MAX(s) + {need} AS z FROM j GROUP BY doc_id, k),
    q AS (SELECT doc_id, a, z, COALESCE(LAG(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS b FROM p),
    t AS (SELECT q.doc_id, COUNT(*) AS n_spans, SUM(z - a) AS n_removed, MAX(z) AS e,
                 string_agg(substr(h, (2 * b + 1)::INTEGER, (2 * (a - b))::INTEGER), '' ORDER BY a) AS front
          FROM q JOIN d USING (doc_id) GROUP BY q.doc_id)
    SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, COALESCE(n_removed, 0)::BIGINT AS n_removed,
           COALESCE(n_spans, 0)::BIGINT AS n_spans,
           sha256(unhex(COALESCE(front, '') || substr(h, (2 * COALESCE(e, 0) + 1)::INTEGER))) AS kept_sha256
    FROM d LEFT JOIN t USING (doc_id)"""
