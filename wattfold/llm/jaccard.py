"""Similarity join of documents on word shingles by parity sketches, and the classes it makes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import drop_kept, small_batches, spread, stored, text_blocks
from wattfold.llm.components import components
from wattfold.llm.shingles import bits_apart, block_keys, folded, most_apart, shingle_sets, signatures

# What near-duplicate stages take unless told otherwise.
WORDS, PERCENT = 5, 80

# 64-bit words of the filter that says whose sets are read for a comparison, at most.
FILTER_WORDS = 1 << 18
# Members of a set of equal keys that are compared with all others: first one, then in each round
# so many times as many as in all before. Few, as what a round links need not be paired by the next.
GROWTH = 4
# Sets of a key, in expectation, that one task compares with as many others; and how many of either it
# lays out at a time.
TILE, SLICE = 2_048, 512
# Pairs that a task remembers, so as not to give one again for each key that both sets have.
KNOWN_PAIRS = 1 << 17
# Rows of a key from which its first round is not one task's. A sample of one set in ``SAMPLE`` tells
# such keys; either way gives the same meetings.
HOT, SAMPLE = 100_000, 32
# Pairs of sets for which one way of dealing a set's partners to tasks is enough.
FAN = 100_000


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorts of keys need an executor's memory; a tokenizer with its words is 130 MB in each of its workers.
        drop_kept()
        for block in text_blocks(batches, "text"):
            owners, hashes = shingle_sets(block.column("text"), words)
            sizes, first, second, sketch = signatures(owners, hashes, block.num_rows, percent)
            columns = [pa.array(x) for x in (sizes.astype(np.int64), first, second)]
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), *columns, sketch], ["id", "n", "c", "c2", "sketch"]
            )

    return docs.mapInArrow(signed, "id long, n long, c long, c2 long, sketch binary")


def _keys(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The keys of each different set of a task's part of the documents."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies go no further than the task that reads them; a task reads one part of a file.
        seen: set[int] = set()
        for block in text_blocks(batches, "text"):
            owners, hashes = shingle_sets(block.column("text"), words)
            sizes, first, _, _ = signatures(owners, hashes, block.num_rows, percent)
            fresh = np.zeros(block.num_rows, bool)
            for row, name in enumerate(first.tolist()):
                if name not in seen:
                    seen.add(name)
                    fresh[row] = True
            use = fresh[owners]
            row, key = block_keys(owners[use], hashes[use], block.num_rows, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(sizes[row].astype(np.int32)), pa.array(first[row])],
                ["key", "n", "c"],
            )

    return docs.mapInArrow(keyed, "key long, n int, c long")


def _hot_heads(sample: DataFrame) -> DataFrame:
    """Keys that very many rows have, each with one of its members.

    ``sample`` has the keys of one set in ``SAMPLE``. How many hot keys there are is bounded by the
    sample's rows over ``HOT / SAMPLE``; Spark's own check of their table's size says if they are told to
    all tasks.
    """
    heads = sample.groupBy("key").agg(F.count("*").alias("rows"), F.min(F.struct("n", "c")).alias("head"))
    heads = heads.where(F.col("rows") > HOT // SAMPLE)
    return heads.select("key", F.col("head.n").alias("head_n"), F.col("head.c").alias("head_c"))


def _meetings(spark: SparkSession, keys: DataFrame, sample: DataFrame) -> DataFrame:
    """Members of keys that more than one set has, each but one with that one.

    Keys pass through tasks whole, but for hot ones: one member of each, found in the ``sample`` of
    keys, is told to the others where they lie. Keys go straight into their groups; they are stored
    only if hot ones make them be read twice.
    """
    heads = stored(spark, _hot_heads(sample), "jaccard-hot")
    rows, hot = keys, None
    if not heads.isEmpty():
        keys = stored(spark, keys, "jaccard-keys")
        rows = keys.join(heads, "key", "left_anti")
        hot = keys.join(heads, "key").where((F.col("n") != F.col("head_n")) | (F.col("c") != F.col("head_c")))
        hot = hot.select(
            "key", F.col("head_c").alias("pivot"), F.col("head_n").alias("pivot_n"), "c", "n"
        ).distinct()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_c = head_c = head_n = None
        for batch in batches:
            key, n, c = (batch.column(name).to_numpy() for name in ("key", "n", "c"))
            if not len(key):
                continue
            same_key = np.concatenate([[key[0] == last_key], key[1:] == key[:-1]])
            same_c = np.concatenate([[c[0] == last_c], c[1:] == c[:-1]]) & same_key
            head = np.maximum.accumulate(np.where(same_key, -1, np.arange(len(key))))
            pivot = np.where(head >= 0, c[head], head_c if head_c is not None else 0)
            pivot_n = np.where(head >= 0, n[head], head_n if head_n is not None else 0).astype(np.int32)
            use = same_key & ~same_c
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[use]) for x in (key, pivot, pivot_n, c, n)], ["key", "pivot", "pivot_n", "c", "n"]
            )
            last_key, last_c, head_c, head_n = key[-1], c[-1], pivot[-1], pivot_n[-1]

    ordered = rows.repartition("key").sortWithinPartitions("key", "n", "c")
    met = ordered.mapInArrow(stream, "key long, pivot long, pivot_n int, c long, n int")
    return met if hot is None else met.union(hot)


def _may_link(n: Column, m: Column, percent: int) -> Column:
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _later_pairs(members: DataFrame, first: int, last: int, percent: int) -> DataFrame:
    """Pairs of about a key's members ``first`` up to, without, ``last`` with those after them.

    Members come with their sketch, the component they are in and the size of their key's group; pairs
    of one component, or with sketches or sizes too far apart, are not made. A hash gives each member
    a place from 0 to 2^31 - 1, and the span of places that a round compares with all after them
    follows from the group's size; spans of rounds adjoin, so each pair is made in one round. The
    places of a group are cut into tiles of about ``TILE`` members, and two tiles meet in a task of
    their own, so what a task holds and compares has a bound however large the group is.
    """
    everywhere = F.lit(1 << 31)
    tile = F.shiftright(F.col("at") * F.col("tiles"), 31)
    members = members.withColumn("at", spread(F.lit(17), "c")).withColumn(
        "tiles", F.ceil(F.col("size") / F.lit(TILE)).cast("long")
    )
    for name, place in (("low", first), ("high", last)):
        members = members.withColumn(name, F.expr(f"least({place}L, size)") * everywhere)
        members = members.withColumn(name, F.expr(f"{name} div size"))
    members = members.withColumn("tile", tile)
    # Tiles of the members that others are compared with.
    least = F.shiftright(F.col("low") * F.col("tiles"), 31)
    most = F.shiftright((F.col("high") - 1) * F.col("tiles"), 31)
    rows = ["key", "at", "n", "c", "label", "sketch"]
    held = members.where("at >= low AND at < high").select(
        F.col("tile").alias("tile_a"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("tile_b"),
        F.lit(0).alias("role"), *rows,
    )
    others = members.where(least <= F.col("tile")).select(
        F.explode(F.sequence(least, F.least(most, F.col("tile")))).alias("tile_a"), F.col("tile").alias("tile_b"),
        F.lit(1).alias("role"), *rows,
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("at", "c", "n", "label")
        current, parts, pivots = None, [], None
        known: set[tuple[int, int]] = set()
        for batch in batches:
            key, tile_a, tile_b, role = (batch.column(x).to_numpy() for x in ("key", "tile_a", "tile_b", "role"))
            if not len(key):
                continue
            columns = [batch.column(x).to_numpy() for x in names]
            sketches = batch.column("sketch")
            group = np.stack([key, tile_a, tile_b, role], axis=1)
            starts = np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1, [len(key)]])
            for begin, end in zip(starts, starts[1:], strict=False):
                this = tuple(group[begin, :3])
                if this != current:
                    current, parts, pivots = this, [], None
                rows = [*[x[begin:end] for x in columns], sketches.slice(begin, end - begin)]
                if role[begin] == 0:
                    parts.append(rows)
                    continue
                if not parts:
                    continue
                if pivots is None:
                    *some, held_sketches = zip(*parts, strict=True)
                    pivots = [*[np.concatenate(x) for x in some], pa.concat_arrays(held_sketches)]
                for a in range(0, len(pivots[0]), SLICE):
                    for b in range(0, end - begin, SLICE):
                        left, right = _close([x[a : a + SLICE] for x in pivots], [x[b : b + SLICE] for x in rows], percent)
                        if len(known) > KNOWN_PAIRS:
                            known.clear()
                        found = set(zip(left.tolist(), right.tolist(), strict=True)) - known
                        if found:
                            known |= found
                            ends = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
                            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    tiles = ["key", "tile_a", "tile_b"]
    ordered = held.union(others).repartition(*tiles).sortWithinPartitions(*tiles, "role")
    return ordered.mapInArrow(stream, "a long, b long")


def _close(some: list[np.ndarray], others: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``some`` with ``others`` after them, of two components and with sketches that are near."""
    at_a, c_a, n_a, label_a, sketch_a = some
    at_b, c_b, n_b, label_b, sketch_b = others
    small, large = np.minimum(n_a[:, None], n_b), np.maximum(n_a[:, None], n_b)
    good = (at_a[:, None] < at_b) | ((at_a[:, None] == at_b) & (c_a[:, None] < c_b))
    good &= (label_a[:, None] != label_b) & (100 * small.astype(np.int64) >= percent * large.astype(np.int64))
    i, j = np.nonzero(good)
    if not len(i):
        return c_a[:0], c_b[:0]
    # Members of a key are of two neighbouring bands, so widths are alike or nearly so.
    width = min(pc.min(pc.binary_length(x)).as_py() for x in (sketch_a, sketch_b))
    bits = bits_apart(folded(sketch_a, width), folded(sketch_b, width), i, j)
    near = bits <= most_apart((small[i, j] + large[i, j]).astype(np.int64), percent)
    return c_a[i[near]], c_b[j[near]]


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets ``a, b`` whose sizes and sketches allow a link, with the ids of their classes."""
    sides = [
        classes.select(*[F.col(x).alias(f"{x}_{side}") for x in ("rep", "n", "sketch")], F.col("c").alias(side))
        for side in ("a", "b")
    ]
    near = pairs.join(sides[0], "a").join(sides[1], "b").where(
        _may_link(F.col("n_a"), F.col("n_b"), percent) & (F.col("rep_a") != F.col("rep_b"))
    )
    ends = ["a", "b", "rep_a", "rep_b"]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [batch.column(f"sketch_{side}") for side in ("a", "b")]
            widths = np.minimum(*[pc.binary_length(x).to_numpy(zero_copy_only=False) for x in sketches])
            sizes = sum(batch.column(f"n_{side}").to_numpy().astype(np.int64) for side in ("a", "b"))
            keep = np.zeros(batch.num_rows, bool)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                some = [folded(x.take(pa.array(rows)), width) for x in sketches]
                each = np.arange(len(rows))
                keep[rows] = bits_apart(*some, each, each) <= most_apart(sizes[rows], percent)
            yield batch.select(ends).filter(pa.array(keep))

    rows = near.select(*ends, "n_a", "n_b", "sketch_a", "sketch_b")
    return rows.mapInArrow(close, ", ".join(f"{x} long" for x in ends))


def _word(column: str) -> tuple[Column, Column]:
    place = spread(F.lit(11), column)
    return F.shiftright(place, 6) % FILTER_WORDS, place % 64


def _linked(spark: SparkSession, docs: DataFrame, near: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of ``near`` whose sets are similar, as ``a, b`` of their classes' ids.

    Only sets that a pair needs are made again from their texts: a bit per id in a table of at most
    ``FILTER_WORDS`` numbers tells most of the others before their texts leave the scan.
    """
    needed = near.select(F.col("a").alias("c"), F.col("rep_a").alias("id")).union(near.select("b", "rep_b")).distinct()
    word, bit = _word("id")
    flag = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
    table = needed.select(word.alias("__word"), flag.alias("bits")).groupBy("__word").agg(F.bit_or("bits").alias("bits"))
    table = stored(spark, table, "jaccard-filter")
    asked = docs.join(F.broadcast(table), word == F.col("__word")).where(F.col("bits").bitwiseAND(flag) != 0)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text"):
            owners, hashes = shingle_sets(block.column("text"), words)
            sizes, first, _, _ = signatures(owners, hashes, block.num_rows, percent)
            cuts = np.split(hashes, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(first), pa.array([x.tobytes() for x in cuts], pa.binary())],
                ["id", "c", "shingles"],
            )

    sets = asked.select("id", "text").mapInArrow(made, "id long, c long, shingles binary")
    # A set goes to each one it is compared with. The more pairs there are, the more ways partners are
    # dealt, so that one that a third of all are compared with is in several tasks.
    fans = 1 + near.count() // FAN
    pairs = near.withColumn("fan", F.pmod(spread("b"), F.lit(fans)).cast("int"))
    heads = pairs.select("a", "fan", F.col("a").alias("c"), F.col("rep_a").alias("id"), F.lit(0).alias("role"))
    tails = pairs.select("a", "fan", F.col("b").alias("c"), F.col("rep_b").alias("id"), F.lit(1).alias("role"))
    routes = heads.distinct().union(tails)
    routed = routes.join(sets, ["c", "id"]).repartition("a", "fan").sortWithinPartitions("a", "fan", "role", "c", "id")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, head, head_id = None, np.zeros(0, np.uint64), 0
        for batch in batches:
            left, right = [], []
            names = zip(*(batch.column(x).to_pylist() for x in ("a", "fan", "role", "id")), strict=True)
            for (a, fan, role, id_), data in zip(names, batch.column("shingles"), strict=True):
                this = np.frombuffer(data.as_buffer(), np.uint64)
                if role == 0:
                    group, head, head_id = (a, fan), this, id_
                    continue
                if group != (a, fan):
                    raise ValueError("a pair of sets is not complete")
                common = len(head) + len(this) - len(np.union1d(head, this))
                if 100 * common >= percent * (len(head) + len(this) - common):
                    left.append(head_id)
                    right.append(id_)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return routed.select("a", "fan", "role", "id", "shingles").mapInArrow(compared, "a long, b long")


def next_place(compared: int) -> int:
    """Up to which place members have been compared with all others after the next round."""
    return max(1, compared) * (GROWTH + 1) - (not compared)


@small_batches
def similar_documents(
    spark: SparkSession, docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row: its class under links between similar texts.

    Two texts link if the shingles that both have are at least ``percent`` in a hundred of all that
    either has; ``component_id`` is the least id that links lead to. Texts with no words, null ones
    among them, link with nothing. Equal sets are one class from the start, so copies need no links;
    rows that repeat an id each give a row. Ids must be numbers; a row without one is left out. Other
    columns are not looked at.

    Sets meet under the keys of their parity sketches' blocks. In the first round, each member of a
    key's group is compared with one of them. What links is one component, and groups within one
    component are done. Of the others, more members are compared with all that follow them in each
    further round, tile by tile, until every pair of a group is in one component or has been compared; so no link
    between components is lost, and no group has all its pairs made unless nothing in it links.
    Sketches sort out most pairs, the sets themselves decide.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("id").isNotNull())
    sets = stored(spark, _sets(rows, words, percent), "jaccard-sets")
    classes = sets.where("n > 0").groupBy("n", "c", "c2").agg(
        F.min("id").alias("rep"), F.first("sketch").alias("sketch")
    )
    classes = stored(spark, classes, "jaccard-classes")
    sample = rows.where(spread(F.lit(13), "text") % SAMPLE == 0)
    keys, some = _keys(rows, words, percent), _keys(sample, words, percent)
    meetings = stored(spark, _meetings(spark, keys, some), "jaccard-meetings")

    # All pairs of a key's first member are made in the first round; further rounds are for the others.
    members = meetings.select("key", "c", "n")
    compared, links, found = 0, None, None
    pairs = meetings.where(_may_link(F.col("n"), F.col("pivot_n"), percent)).select(
        F.col("pivot").alias("a"), F.col("c").alias("b")
    )
    while True:
        near = stored(spark, _near(pairs.distinct(), classes, percent), "jaccard-near")
        new = _linked(spark, rows, near, words, percent)
        links = stored(spark, new if links is None else links.union(new), "jaccard-links")
        found = components(spark, links)
        left = _open_groups(spark, members, classes, found, compared)
        if left.isEmpty():
            break
        last = next_place(compared)
        pairs, compared = _later_pairs(left, compared, last, percent), last
    found = found.withColumnRenamed("id", "rep")
    named = classes.select("n", "c", "c2", "rep").join(found, "rep", "left")
    named = named.select("n", "c", "c2", F.coalesce("component", "rep").alias("component_id"))
    result = sets.select("id", "n", "c", "c2").join(named, ["n", "c", "c2"], "left")
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def _open_groups(
    spark: SparkSession, members: DataFrame, classes: DataFrame, found: DataFrame, compared: int
) -> DataFrame:
    """Members of the groups that have pairs neither compared nor within one component, with sketches."""
    found = found.withColumnRenamed("id", "rep")
    labels = classes.join(found, "rep", "left").groupBy("c").agg(
        F.min(F.coalesce("component", "rep")).alias("label"), F.first("sketch").alias("sketch")
    )
    labels = stored(spark, labels, "jaccard-labels")
    labelled = members.join(labels.select("c", "label"), "c")
    open_keys = labelled.groupBy("key").agg(
        F.count("*").alias("size"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.bit_xor(F.xxhash64("c")).alias("mark_a"), F.bit_xor(F.xxhash64(F.lit(19), "c")).alias("mark_b"),
    )
    open_keys = open_keys.where((F.col("size") > max(1, compared)) & (F.col("least") != F.col("most")))
    # Texts that share a passage meet under very many keys; keys with the same members need one comparison.
    open_keys = open_keys.groupBy("size", "mark_a", "mark_b").agg(F.min("key").alias("key"))
    # Stored, so that the join knows its size: it is broadcast, or lies between two exchanges and hot keys are split.
    open_keys = stored(spark, open_keys.select("key", "size"), "jaccard-open-keys")
    return stored(spark, members.join(open_keys, "key").join(labels, "c"), "jaccard-open")


def one_of_each(spark: SparkSession, docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the least id of every class, with all its columns.

    Documents without words are classes of their own. Rows that repeat an id stand or fall together.
    """
    rows = similar_documents(spark, docs, words, percent, id_col, text_col)
    gone = rows.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")
