"""Best-fit packing of token sequences after Martello and Toth's dominance reduction.

Pieces of equal length are alike, so the whole instance is how many pieces there are of each length:
a table of at most ``capacity`` numbers, whatever the input. The driver packs that table; tasks give
each piece its place among the pieces of its length, and so its sequence.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import running_sum, small_batches, spread, stored, text_blocks
from wattfold.llm.tokenization import CACHED_PARTS, ENCODED_BYTES, KEPT_PARTS, encoder

CAPACITY = 2048
END_ID = 0

PIECES = "id long, piece int, start long, length long, ids binary"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = ENCODED_BYTES, cached_parts: int = CACHED_PARTS,
) -> DataFrame:
    """``id, piece, start, length, ids``: each document's token ids in pieces of at most ``capacity``.

    A document's ids are those of its whole text, then the end id; ``ids`` holds them as
    little-endian unsigned 32-bit integers. A null text counts as empty and has the end id alone.
    ``block_bytes`` of text are encoded at once and the ids of ``cached_parts`` words kept, at most;
    the less, the smaller a worker, and the more time it takes.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = encoder(tokenizer, cached_parts)
        for block in text_blocks(batches, "text", block_bytes):
            ids, at = turn.encode(block.column("text"), END_ID)
            sizes = np.diff(at)
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            # The pieces follow each other without gaps, so their bytes are one buffer.
            offsets = np.concatenate([[0], np.cumsum(length)]) * 4
            data = ids.astype("<u4", copy=False).tobytes()
            values = pa.Array.from_buffers(
                pa.binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays(
                [block.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), values],
                ["id", "piece", "start", "length", "ids"],
            )
            if block_bytes < ENCODED_BYTES:
                pa.default_memory_pool().release_unused()
        turn.trim(min(KEPT_PARTS, cached_parts // 2))

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


class _Counts:
    """How many pieces there are of each length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.of = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.of)

    def take(self, length: int, n: int) -> None:
        self.of[length] -= n
        if not self.of[length]:
            del self.of[length]
            self.lengths.remove(length)

    def largest(self, most: int, without: int | None = None) -> int | None:
        """The largest length up to ``most``, not counting one piece of length ``without``."""
        at = bisect_right(self.lengths, most) - 1
        while at >= 0 and self.lengths[at] == without and self.of[without] == 1:
            at -= 1
        return self.lengths[at] if at >= 0 else None

    def smallest(self, n: int, without: int) -> int:
        """The sum of the ``n`` smallest pieces, not counting one of length ``without``."""
        total = 0
        for length in self.lengths:
            here = min(n, self.of[length] - (length == without))
            total, n = total + here * length, n - here
            if not n:
                return total
        return 1 << 62

    def best_pair(self, room: int, without: int) -> int:
        """The largest sum of two pieces that fit into ``room``, not counting one of ``without``."""
        best = 0
        for first in self.lengths[: bisect_right(self.lengths, room)]:
            if first == without and self.of[first] == 1:
                continue
            second = self.largest(room - first, without)
            if second is None:
                break
            if second == first and self.of[first] - (first == without) < 2:
                below = bisect_left(self.lengths, first) - 1
                if below < 0:
                    continue
                second = self.lengths[below]
                if second == without and self.of[second] == 1:
                    continue
            best = max(best, first + second)
        return best


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple]], dict[int, int]]:
    """Sequences that some best packing has, and the pieces that are left.

    Each of the first is ``(how many sequences, ((length, pieces of it in one), ...))``. From the
    largest length down, a piece and the largest partner that fits are fixed together where that set
    dominates every other set with the piece: nothing fits, the two fill the sequence, no second
    partner fits, or at most two fit and no two of them have more than the one.
    """
    left = _Counts(counts)
    fixed: list[tuple[int, tuple]] = []
    changed = True
    while changed:
        changed = False
        length = left.lengths[-1] if left.lengths else None
        while length is not None:
            room = capacity - length
            partner = left.largest(room, without=length)
            if partner is None:
                n = left.of[length]
                fixed.append((n, ((length, 1),)))
                left.take(length, n)
                changed = True
            elif (
                partner == room
                or left.smallest(2, without=length) > room
                or (left.smallest(3, without=length) > room and partner >= left.best_pair(room, without=length))
            ):
                if partner == length:
                    n = left.of[length] // 2
                    fixed.append((n, ((length, 2),)))
                    left.take(length, 2 * n)
                else:
                    n = min(left.of[length], left.of[partner])
                    fixed.append((n, ((length, 1), (partner, 1))))
                    left.take(length, n)
                    left.take(partner, n)
                changed = True
            if length in left.of and partner is not None and changed and fixed and fixed[-1][1][0][0] == length:
                # The same length again, with the partners that are left.
                again = left.largest(capacity - length, without=length)
                if again != partner:
                    continue
            at = bisect_left(left.lengths, length) - 1
            length = left.lengths[at] if at >= 0 else None
    return fixed, dict(left.of)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple]]:
    """Best-fit decreasing: the sequences it makes, like ones counted together.

    Sequences with equal room are alike. As many pieces of the length at hand go into the fullest
    sequence that has room as it takes, since it stays the fullest.
    """
    open_at: list[list[tuple[int, tuple]]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []

    def add(room: int, sequences: int, content: tuple) -> None:
        if not open_at[room]:
            at = bisect_left(rooms, room)
            rooms.insert(at, room)
        open_at[room].append((sequences, content))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                sequences, content = open_at[room].pop()
                if not open_at[room]:
                    rooms.pop(at)
            else:
                room, sequences, content = capacity, n, ()
            each = room // length
            full = min(sequences, n // each)
            rest = n - full * each if full < sequences else 0
            if full:
                add(room - each * length, full, (*content, (length, each)))
            if rest:
                add(room - rest * length, 1, (*content, (length, rest)))
            untouched = sequences - full - bool(rest)
            if untouched and content:
                add(room, untouched, content)
            n -= full * each + rest
    return [item for room in open_at for item in room]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: ``(length, first, last, sequence, each, offset)``.

    Pieces of a length are numbered from 0. Those from ``first`` up to, without, ``last`` go to
    ``sequence`` and those after it, ``each`` to a sequence, from ``offset`` on.
    """
    fixed, left = reduce_instance(counts, capacity)
    taken = dict.fromkeys(counts, 0)
    sequence, rows = 0, []
    for sequences, content in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, each in content:
            first = taken[length]
            taken[length] = first + sequences * each
            rows.append((length, first, taken[length], sequence, each, offset))
            offset += length * each
        sequence += sequences
    return rows


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Sequences are numbered from 0 and filled without gaps from offset 0. Other columns stay, whatever
    their names; ``pieces`` must be a stored table, as it is read more than once. No pieces, no
    sequences; a null length or one out of bounds is an error. The plan sent to the tasks has a few
    rows for each length below ``capacity`` at most.
    """
    counts = {length: n for length, n in pieces.groupBy("length").count().collect()}
    wrong = sorted(length if length is not None else -1 for length in counts if not length or not 0 < length <= capacity)
    if wrong:
        raise ValueError(f"lengths must be from 1 to {capacity}: {wrong[:5]}")
    rows = spark.createDataFrame(
        plan(counts, capacity),
        "__length long, __first long, __last long, __sequence long, __each long, __offset long",
    )
    columns = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    keyed = pieces.select(*columns, spread(*columns).alias("__at"))
    ranked = running_sum(keyed, ["length"], "__at", columns, F.lit(1), "__rank")
    here = F.col("__rank") - F.col("__first")
    return ranked.join(
        F.broadcast(rows),
        (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__first")) & (F.col("__rank") < F.col("__last")),
    ).select(
        *columns,
        (F.col("__sequence") + F.floor(here / F.col("__each"))).cast("long").alias("sequence_id"),
        (F.col("__offset") + here % F.col("__each") * F.col("__length")).cast("long").alias("offset"),
    )


@small_batches
def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
    text_col: str = "text", block_bytes: int = ENCODED_BYTES, cached_parts: int = CACHED_PARTS,
) -> DataFrame:
    """Documents' pieces with their place in sequences of ``capacity`` tokens, and ``ids_crc32``.

    Repeated rows and null ids are packed like any other; columns other than id and text are not
    looked at. The ids themselves are in the stored pieces that ``token_pieces`` makes.
    """
    pieces = stored(spark, token_pieces(docs, tokenizer, capacity, id_col, text_col, block_bytes, cached_parts), "pack-pieces")
    small = pieces.select("id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(spark, small, capacity).withColumnRenamed("id", id_col)
