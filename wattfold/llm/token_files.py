"""Token ids in binary files: patched frame-of-reference blocks behind an index.

A folder holds part files that Spark writes, each a row of records; a record ends in a line feed and
holds whole documents in ascending order of id. All numbers are little-endian. A record:

=========  ==========================================================================
bytes      what
=========  ==========================================================================
4          ``PFB1``
4 x 4      shard, place in the shard, documents D, blocks B (unsigned)
2 x 8      ids in all, bytes of all blocks (unsigned)
8 x D      document ids (signed), 0 where null
D          1 where the document id is null
4 x D      ids of each document (unsigned)
8 x B      where each block begins, from the first block on (unsigned)
           the blocks
=========  ==========================================================================

A block has 128 ids; the last one is filled up with its own least id. It starts with its least id
(4 bytes), a width (1 byte) and the number of exceptions (1 byte). The ids less the least follow in
``width`` bits each, lowest bit first. The width is what all but a tenth of the block needs; ids that
need more are zero there and follow as places (1 byte each) and differences (4 bytes each).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattfold.llm.common import stored, text_blocks
from wattfold.llm.tokenization import ENCODED_BYTES, encoder

BLOCK = 128
# The share of a block's ids that its width has room for.
PERCENTILE = 0.9
END_ID = 0
# Ids after which a record ends with the document at hand.
RECORD_IDS = 1 << 20
# Text that one shard takes, in bytes.
SHARD_BYTES = 24 << 20

_MAGIC = b"PFB1"
_HEAD = struct.Struct("<4s4I2Q")


def _widths(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Where each block of ids begins, and the blocks."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return np.zeros(0, np.uint64), b""
    full = np.empty(count * BLOCK, np.uint32)
    full[: len(ids)] = ids
    full[len(ids) :] = ids[(count - 1) * BLOCK :].min()
    full = full.reshape(count, BLOCK)
    least = full.min(axis=1)
    delta = full - least[:, None]
    at = min(BLOCK - 1, max(0, int(np.ceil(BLOCK * percentile)) - 1))
    widths = _widths(np.partition(delta, at, axis=1)[:, at])
    over = delta >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    exceptions = over.sum(axis=1)
    sizes = 6 + BLOCK // 8 * widths + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(count, 4)
    out[starts + 4] = widths
    out[starts + 5] = exceptions
    low = np.where(over, 0, delta)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        out[(starts[rows] + 6)[:, None] + np.arange(BLOCK // 8 * width)] = _pack(low[rows], int(width))
    block, place = np.nonzero(over)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    list_at = (starts + 6 + BLOCK // 8 * widths)[block]
    out[list_at + nth] = place
    values = delta[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(list_at + exceptions[block] + 4 * nth)[:, None] + np.arange(4)] = values
    return starts.astype(np.uint64), out.tobytes()


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2 ** width`` as rows of bytes, ``width`` bits each."""
    columns = values.T.astype(np.uint64, order="C")
    words = np.zeros((2 * width, values.shape[0]), np.uint64)
    for place in range(BLOCK):
        word, bit = divmod(place * width, 64)
        words[word] |= columns[place] << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= columns[place] >> np.uint64(64 - bit)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8).reshape(values.shape[0], -1)


def _unpack(data: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(data).view("<u8").T)
    mask, columns = np.uint64((1 << width) - 1), np.empty((BLOCK, data.shape[0]), np.uint32)
    for place in range(BLOCK):
        word, bit = divmod(place * width, 64)
        value = words[word] >> np.uint64(bit)
        if bit + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - bit))
        columns[place] = (value & mask).astype(np.uint32)
    return columns.T


def decode_blocks(starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The ids of blocks that begin at ``starts``; those of a last block's filling included."""
    starts = starts.astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint32)
    least = np.ascontiguousarray(data[starts[:, None] + np.arange(4)]).view("<u4").astype(np.uint32)
    widths, exceptions = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    delta = np.zeros((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        delta[rows] = _unpack(data[(starts[rows] + 6)[:, None] + np.arange(BLOCK // 8 * width)], int(width))
    block = np.repeat(np.arange(len(starts)), exceptions)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
    list_at = (starts + 6 + BLOCK // 8 * widths)[block]
    places = data[list_at + nth]
    values = data[(list_at + exceptions[block] + 4 * nth)[:, None] + np.arange(4)]
    delta[block, places] = np.ascontiguousarray(values).view("<u4").ravel()
    return (delta + least).ravel()


def encode_record(shard: int, place: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    starts, blocks = encode_blocks(ids)
    null = np.array([x is None for x in doc_ids], np.uint8)
    known = np.array([0 if x is None else x for x in doc_ids], "<i8")
    head = _HEAD.pack(_MAGIC, shard, place, len(doc_ids), len(starts), len(ids), len(blocks))
    return b"".join(
        [head, known.tobytes(), null.tobytes(), counts.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), blocks]
    )


class Record:
    """A record in a file's bytes, from ``at`` on; ``end`` is where the next one begins."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        magic, self.shard, self.place, docs, blocks, self.n_ids, size = _HEAD.unpack_from(data, at)
        if magic != _MAGIC:
            raise ValueError("not a record of token ids")
        at += _HEAD.size
        doc_ids = np.frombuffer(data, "<i8", docs, at)
        null = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
        self.doc_ids = [None if n else int(x) for x, n in zip(doc_ids, null, strict=True)]
        self.counts = np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(np.int64)
        self.ends = np.cumsum(self.counts)
        at += 13 * docs
        self.starts = np.frombuffer(data, "<u8", blocks, at)
        self.blocks = np.frombuffer(data, np.uint8, size, at + 8 * blocks)
        self.end = at + 8 * blocks + size + 1

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of documents ``first`` up to, without, ``last``; only their blocks are read."""
        last = len(self.counts) if last is None else last
        if first >= last:
            return np.zeros(0, np.uint32)
        begin, end = int(self.ends[first] - self.counts[first]), int(self.ends[last - 1])
        block = begin // BLOCK
        found = decode_blocks(self.starts[block : -(-end // BLOCK)], self.blocks)
        return found[begin - block * BLOCK : end - block * BLOCK]


def records(data: bytes) -> Iterator[Record]:
    at = 0
    while at < len(data):
        record = Record(data, at)
        yield record
        at = record.end


def write_token_files(
    spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Write all documents' ids, each followed by the end id, in ascending order of document id.

    Null ids come first, a null text counts as empty, equal ids are ordered by text; other columns
    are not looked at, and an empty table gives files without records. Texts are sorted into shards
    by ranges of id before they are encoded, as ids would take more room. A shard's place in the
    order of all is in its records, so files may be renamed.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place = TaskContext.get().partitionId(), 0
        turn = encoder(tokenizer)
        doc_ids, counts, ids, held = [], [], [], 0

        def record() -> pa.RecordBatch:
            data = encode_record(shard, place, doc_ids, np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

        for block in text_blocks(batches, "text", ENCODED_BYTES):
            found, at = turn.encode(block.column("text"), END_ID)
            doc_ids += block.column("id").to_pylist()
            counts.append(np.diff(at))
            ids.append(found)
            held += len(found)
            if held >= RECORD_IDS:
                yield record()
                doc_ids, counts, ids, held, place = [], [], [], 0, place + 1
        turn.trim()
        if doc_ids:
            yield record()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    rows = rows.repartitionByRange(shards, F.col("id").asc_nulls_first())
    ordered = rows.sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    # A text writer puts out a row's bytes as they are, and a line feed.
    ordered.mapInArrow(encode, "data binary").select(F.col("data").cast("string").alias("value")).write.text(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of all documents in files.

    ``start`` is how many ids all documents before have; the checksum is that of the ids as
    little-endian unsigned 32-bit integers.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                for record in records(data.as_py()):
                    bytes_ = record.ids().astype("<u4", copy=False).tobytes()
                    ends = record.ends * 4
                    starts = ends - record.counts * 4
                    view = memoryview(bytes_)
                    sums = [zlib.crc32(view[a:b]) for a, b in zip(starts, ends, strict=True)]
                    n = len(sums)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([record.shard] * n, pa.int64()), pa.array([record.place] * n, pa.int64()),
                         pa.array(record.doc_ids, pa.int64()), pa.array(starts // 4, pa.int64()),
                         pa.array(record.counts, pa.int64()), pa.array(sums, pa.int64())],
                        ["shard", "place", "id", "begin", "n_tokens", "ids_crc32"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    rows = files.mapInArrow(
        decode, "shard long, place long, id long, begin long, n_tokens long, ids_crc32 long"
    )
    rows = stored(spark, rows, "token-rows")
    totals = rows.groupBy("shard", "place").agg(F.sum("n_tokens").alias("n"))
    # One row per record, of a million ids each.
    before = Window.orderBy("shard", "place").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", "place", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(totals, ["shard", "place"]).select(
        F.col("id").alias(id_col), (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )
