"""Repair of conversations' turn structure by a Viterbi search that runs in parallel chunks.

A conversation is right if its roles' initials read ``(s?(ua)+)?``. A turn may be kept (K, free), given
the role user or assistant (R, 1), deleted (D, 2; the only way for blank and duplicate turns), and an
empty turn may be inserted anywhere (I, 5); a truncated turn that stays costs 5 more. Wanted are the
cheapest edits, of equal ones those whose initials are least in ASCII.

Costs run backwards: for each place and state, the least cost from there to the end. Turns are sorted
once over all conversations and cut into blocks; the part of a conversation in a block is a chunk. Each
chunk starts from a speculative cost vector, that of a conversation's end. Fix-up passes then hand each
chunk the vector that the next one came to. A chunk reruns from its end until old and new vectors differ
only by a constant; from there on its old result holds, up to that constant. Passes go on until no
chunk changes. In a pass a task hands vectors on through ``SPAN`` chunks in a row, and ``SPAN`` times as
many in the next, so that even turns that never make vectors alike take few passes. The edits are then
read off forwards, again chunk by chunk, with the state that each chunk is entered in.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattfold.llm.common import stored

# Turns of a block, and chunks that a task of the first fix-up pass hands vectors through.
BLOCK, SPAN = 4_096, 16
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
_STATES = range(4)
# The state after the one turn that each state may be given or have inserted, and that turn's role.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
# The state after keeping a turn whose role begins with s, u, a or anything else.
_KEEP = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
# Costs at a conversation's end: it may end before any turn or after an assistant's.
END = (0, 2 * INSERT, INSERT, 0)
# A turn's byte: its initial's class, and whether it is truncated or must be deleted.
_TRUNCATED, _FORCED = 4, 8

_BLANKS = " \t\n\x0b\x0c\r"


class Repaired(NamedTuple):
    """``report``: a row per conversation; ``turns``: the repaired turns in order."""

    report: DataFrame
    turns: DataFrame


_steps: dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], int, str]] = {}


def _step(after: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, str]:
    """Costs before a turn from those after it, less their least; that least; the edit per state."""
    known = _steps.get((after, code))
    if known is not None:
        return known
    kind, more = code & 3, TRUNCATED if code & _TRUNCATED else 0
    ways: list[dict[str, int]] = []
    for state in _STATES:
        way = {"D": DELETE + after[state]}
        if not code & _FORCED:
            if _KEEP[kind][state] is not None:
                way["K"] = more + after[_KEEP[kind][state]]
            way["R"] = more + REROLE + after[_NEXT[state]]
        ways.append(way)
    costs = [min(way.values()) for way in ways]
    for _ in _STATES:
        costs = [min(costs[state], INSERT + costs[_NEXT[state]]) for state in _STATES]
    for state in _STATES:
        ways[state]["I"] = INSERT + costs[_NEXT[state]]
    edits = "".join(min(edit for edit, cost in ways[state].items() if cost == costs[state]) for state in _STATES)
    least = min(costs)
    found = tuple(cost - least for cost in costs), least, edits
    _steps[after, code] = found
    return found


def _backward(codes: bytes, end: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    vector, total = end, 0
    for code in reversed(codes):
        vector, least, _ = _step(vector, code)
        total += least
    return vector, total


def _rerun(codes: bytes, old: tuple[int, ...], new: tuple[int, ...]) -> tuple[tuple[int, ...] | None, int]:
    """From another end: the vector at the start (None: as before) and by how much the cost changes."""
    change = 0
    for code in reversed(codes):
        if old == new:
            return None, change
        old, less, _ = _step(old, code)
        new, more, _ = _step(new, code)
        change += more - less
    return (None if old == new else new), change


def _edits(codes: bytes, end: tuple[int, ...], states: list[int], last: bool) -> list[tuple[int, list[tuple[int, str, int]]]]:
    """For each entering state the leaving one, and the edits: index of the turn, edit, state before it."""
    choices, vector = [], end
    for code in reversed(codes):
        vector, _, edits = _step(vector, code)
        choices.append(edits)
    choices.reverse()
    found = []
    for state in states:
        made = []
        for index, code in enumerate(codes):
            while (edit := choices[index][state]) == "I":
                made.append((index, edit, state))
                state = _NEXT[state]
            made.append((index, edit, state))
            if edit != "D":
                state = _KEEP[code & 3][state] if edit == "K" else _NEXT[state]
        while last and state not in (0, 3):
            made.append((len(codes), "I", state))
            state = _NEXT[state]
        found.append((state, made))
    return found


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    content = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.sha2(content.cast("binary"), 256)))


def _same(left: DataFrame, right: DataFrame, names: tuple[str, ...], how: str = "left") -> DataFrame:
    """A join on columns of which any may be null; the right side's are dropped."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in names else F.col(c) for c in right.columns])
    met = left.join(renamed, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in names], how)
    return met.drop(*[f"__{name}" for name in names])


def faults(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Different rows in order, without their texts: ``conv, turn, digest, m, blank, first, truncated, code, pos``.

    ``m`` equal rows of a turn are one. ``first`` is false for a role and text that an earlier turn has.
    ``pos`` grows with (conv, turn, role, text), nulls first. Texts travel only for turns that have
    several different ones; no conversation is in one task.
    """
    ties = rows.groupBy("conv", "turn").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    ties = stored(spark, ties.where("low != high").select("conv", "turn", F.lit(True).alias("tie")), "repair-ties")
    marked = _same(rows, ties, ("conv", "turn"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    written = F.rtrim(F.col("text"), F.lit(_BLANKS))
    slim = marked.select(
        "conv", "turn", "digest", kind.alias("kind"),
        (written == "").alias("blank"), (~written.rlike(r"[.!?]\z")).alias("open"),
        F.when(F.col("tie"), F.col("role")).alias("by_role"), F.when(F.col("tie"), F.col("text")).alias("by_text"),
    )
    slim = stored(spark, slim.groupBy(*slim.columns).agg(F.count("*").alias("m")), "repair-slim")
    earliest = slim.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("earliest"))
    slim = _same(slim, earliest, ("conv", "digest"), "inner")
    slim = slim.withColumn("first", F.col("turn").eqNullSafe(F.col("earliest.turn")))
    slim = slim.withColumn("truncated", F.col("open") & F.col("first") & ~F.col("blank"))
    forced = F.col("blank") | ~F.col("first")
    code = F.col("kind") + F.when(F.col("truncated"), _TRUNCATED).otherwise(0) + F.when(forced, _FORCED).otherwise(0)
    order = ("conv", "turn", "by_role", "by_text", "digest")
    slim = slim.withColumn("code", code).repartitionByRange(*order).sortWithinPartitions(*order)
    slim = slim.withColumn("pos", F.monotonically_increasing_id())
    kept = ("conv", "turn", "digest", "m", "blank", "first", "truncated", "code", "pos")
    return stored(spark, slim.select(*kept), "repair-order")


def _numbered(spark: SparkSession, order: DataFrame) -> DataFrame:
    """``order`` with ``block``: numbers without gaps of runs of ``BLOCK`` rows, in order.

    One row per task of the sort passes through the driver.
    """
    part, at = F.shiftright("pos", 33), F.col("pos") % F.lit(1 << 33)
    sizes = order.groupBy(part.alias("part")).agg(F.max(at).alias("most")).collect()
    starts, total = [], 0
    for row in sorted(sizes):
        starts.append((row["part"], total))
        total += row["most"] // BLOCK + 1
    starts = spark.createDataFrame(starts, "part long, start long")
    rows = order.withColumn("part", part).join(starts, "part")
    return rows.withColumn("block", F.col("start") + F.floor(at / F.lit(BLOCK)).cast("long"))


def _packed(vector: tuple[int, ...]) -> bytes:
    return bytes(vector)


def _chunks(spark: SparkSession, order: DataFrame) -> DataFrame:
    """A row per chunk with its turns' bytes, after the pass from a speculative end."""
    conv_type = order.schema["conv"].dataType.simpleString()
    names = ["block", "conv", "pos", "opens", "closes", "codes", "copies", "illegal", "head", "tail", "used", "came", "cost"]
    schema = (
        f"block long, conv {conv_type}, pos long, opens boolean, closes boolean, codes binary, copies binary, illegal long, "
        "head int, tail int, used binary, came binary, cost long"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block_rows(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
            made, start = [], 0
            for at in range(1, len(rows) + 1):
                if at < len(rows) and rows[at][1] == rows[start][1]:
                    continue
                run = rows[start:at]
                codes = bytes(row[3] for row in run)
                copies = [row[4] for row in run]
                kinds = [code & 3 for code in codes]
                illegal = sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:], strict=False)) + sum(copies) - len(run)
                came, cost = _backward(codes, END)
                cost += DELETE * (sum(copies) - len(run))
                told = struct.pack(f"<{len(run)}q", *copies) if sum(copies) > len(run) else None
                made.append(
                    (run[0][0], run[0][1], run[0][2], start == 0, at == len(rows), codes, told, illegal, kinds[0],
                     kinds[-1], _packed(END), _packed(came), cost)
                )
                start = at
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind.type) for column, kind in zip(zip(*made, strict=True), types, strict=True)], names
            )

        types = None
        for batch in batches:
            if types is None:
                conv = batch.schema.field("conv").type
                kinds = [pa.int64(), conv, pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(), pa.int64()]
                kinds += [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
                types = pa.schema(list(zip(names, kinds, strict=True)))
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if held and held[0][0] != row[0]:
                    yield block_rows(held, types)
                    held = []
                held.append(row)
        if held:
            yield block_rows(held, types)

    rows = _numbered(spark, order).select("block", "conv", "pos", F.col("code").cast("int").alias("code"), "m")
    return rows.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(cut, schema)


# Neighbouring kinds of initials that a conversation may have.
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _passes(spark: SparkSession, chains: DataFrame, back: bool) -> DataFrame:
    """Hand on vectors backwards (``back``) or states forwards between the chunks of a conversation.

    ``chains`` has ``block, pos, before, after`` (whether the conversation goes on in the block before or
    after) and what a chunk was started from (``used``) and came to (``came``). A pass is stored before
    the next; it ends when no chunk's start changes.
    """
    step, edge, far = (1, "opens", "after") if back else (-1, "closes", "before")
    order = [F.desc("block"), F.desc("pos")] if back else ["block", "pos"]
    span, kept = SPAN, list(chains.columns)

    def hand_on(span: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            carry = None
            for batch in batches:
                rows = batch.to_pylist()
                for row in rows:
                    start, row["changed"] = row["used"], False
                    if row[far]:
                        near = carry is not None and carry[0] == row["block"] + step and carry[1] == row["block"] // span
                        start = carry[2] if near else row["told"]
                    if start != row["used"]:
                        row["changed"] = True
                        if back:
                            came, change = _rerun(row["codes"], tuple(row["used"]), tuple(start))
                            row["cost"] += change
                            row["came"] = row["came"] if came is None else _packed(came)
                        else:
                            row["came"] = row["leaves"][start[0] : start[0] + 1]
                        row["used"] = start
                    if row[edge]:
                        carry = (row["block"], row["block"] // span, row["came"])
                yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

        return run

    while True:
        told = chains.where(edge).select((F.col("block") - step).alias("block"), F.col("came").alias("told"))
        told = told.withColumn("far", F.lit(True))
        rows = chains.withColumn("far", F.col(far)).join(told, ["block", "far"], "left").drop("far")
        rows = rows.select(*kept, "told", F.lit(False).alias("changed"))
        group = F.floor(F.col("block") / F.lit(span)).alias("group")
        rows = rows.repartition(group).sortWithinPartitions(*order)
        chains = stored(spark, rows.mapInArrow(hand_on(span), rows.schema), "repair-pass")
        if chains.where("changed").isEmpty():
            return chains.select(*kept)
        chains, span = chains.select(*kept), span * SPAN


def _linked(chunks: DataFrame) -> DataFrame:
    """``chunks`` with ``before`` and ``after``, and whether the turn before a chunk may come before it."""
    ends = chunks.where("closes").select(
        (F.col("block") + 1).alias("block"), F.col("conv").alias("conv_before"), F.col("tail").alias("tail_before"),
        F.lit(True).alias("opens"), F.lit(True).alias("is_before"),
    )
    starts = chunks.where("opens").select(
        (F.col("block") - 1).alias("block"), F.col("conv").alias("conv_after"), F.lit(True).alias("closes"),
        F.lit(True).alias("is_after"),
    )
    rows = chunks.join(ends, ["block", "opens"], "left").join(starts, ["block", "closes"], "left")
    before = F.coalesce(F.col("is_before"), F.lit(False)) & F.col("conv").eqNullSafe(F.col("conv_before"))
    after = F.coalesce(F.col("is_after"), F.lit(False)) & F.col("conv").eqNullSafe(F.col("conv_after"))
    legal = F.lit(False)
    for first, second in sorted(_LEGAL):
        legal = legal | ((F.col("tail_before") == first) & (F.col("head") == second))
    rows = rows.withColumn("before", before).withColumn("after", after)
    illegal = F.col("illegal") + F.when(F.col("before") & ~legal, 1).otherwise(0)
    return rows.withColumn("illegal", illegal).select(*chunks.columns, "before", "after")


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each entering state leads to through a chunk, and a guess at it until it is known."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            found = _edits(row["codes"], tuple(row["ended"]), list(_STATES), False)
            row["leaves"] = bytes(state for state, _ in found)
            row["used"] = bytes([3 if row["before"] else 0])
            row["came"] = row["leaves"][row["used"][0] : row["used"][0] + 1]
        yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)


def _solved(spark: SparkSession, order: DataFrame) -> DataFrame:
    """Chunks with their true costs (``ended``: the vector after them) and the state they are entered in."""
    chunks = stored(spark, _linked(stored(spark, _chunks(spark, order), "repair-chunks")), "repair-linked")
    alone = chunks.where("NOT before AND NOT after")
    chains = _passes(spark, chunks.where("before OR after"), back=True)
    rows = chains.withColumn("ended", F.col("used")).withColumn("leaves", F.lit(None).cast("binary"))
    rows = stored(spark, rows.mapInArrow(_leaves, rows.schema), "repair-leaves")
    rows = _passes(spark, rows, back=False)
    kept = ["conv", "pos", "codes", "copies", "illegal", "cost", "before", "after", "ended", "entered", "start"]
    # The cost at the start of a conversation is that of having no turn yet.
    begun = F.when(F.col("before"), 0).otherwise(F.ascii(F.substring("came", 1, 1)))
    first = chains.select("pos", F.ascii(F.substring(F.col("came"), 1, 1)).alias("begin"))
    rows = rows.join(first, "pos").withColumn("start", F.when(F.col("before"), 0).otherwise(F.col("begin")))
    rows = rows.withColumn("entered", F.ascii(F.col("used"))).select(*kept)
    alone = alone.withColumn("ended", F.col("used")).withColumn("entered", F.lit(0)).withColumn("start", begun)
    return stored(spark, alone.select(*kept).unionByName(rows), "repair-solved")


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's edits as initials; a turn's further copies are deleted right after it."""
    for batch in batches:
        texts = []
        for row in batch.to_pylist():
            (_, made), = _edits(row["codes"], tuple(row["ended"]), [row["entered"]], not row["after"])
            size = len(row["codes"])
            copies = struct.unpack(f"<{size}q", row["copies"]) if row["copies"] else (1,) * size
            texts.append("".join(edit if edit == "I" else edit + "D" * (copies[at] - 1) for at, edit, _ in made))
        kept = [batch.column(name) for name in ("conv", "pos")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], ["conv", "pos", "audit"])


def _stays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that stay or are inserted: position, place beside it, edit, and a new role if it has one."""
    names = ["conv", "pos", "beside", "edit", "role_out"]
    for batch in batches:
        taken, columns = [], [[] for _ in names[1:]]
        for number, row in enumerate(batch.to_pylist()):
            (_, made), = _edits(row["codes"], tuple(row["ended"]), [row["entered"]], not row["after"])
            size, count = len(row["codes"]), 0
            for at, edit, state in made:
                # Inserted turns come before theirs, those at the end after the last.
                count = count + 1 if edit == "I" else 0
                if edit == "D":
                    continue
                beside = 0 if edit != "I" else count if at == size else count - 100
                taken.append(number)
                role = None if edit == "K" else _ROLE[state]
                for column, value in zip(columns, (row["pos"] + min(at, size - 1), beside, edit, role), strict=True):
                    column.append(value)
        arrays = [batch.column("conv").take(pa.array(taken, pa.int64()))]
        arrays += [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.string(), pa.string()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def repair(
    spark: SparkSession, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> Repaired:
    """The faults of each conversation, its cheapest repair, and its repaired turns.

    ``report``: conv, gaps, blank, duplicate, truncated, illegal, cost (longs) and audit. ``turns``: conv,
    pos, beside (their order), edit, role, text. A null conversation is one of its own; a null role or text
    counts as one space. Rows go by turn, nulls first, then by role, then by text; a role without a first
    letter is never kept. Rows of equal turn, role and text are one with a count. Very long conversations
    are cut into chunks; their audit alone, a letter per turn, is one value. No rows give no rows; other
    columns are not looked at.
    """
    conv = turns.schema[conv_col].dataType.simpleString()
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    order = faults(spark, rows)
    solved = _solved(spark, order)

    def total(count: Column) -> Column:
        return F.sum(count).cast("long")

    wrong = order.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        total(F.when(F.col("blank"), F.col("m")).otherwise(0)).alias("blank"),
        total(F.when(F.col("blank"), 0).otherwise(F.col("m") - F.col("first").cast("long"))).alias("duplicate"),
        total(F.col("truncated").cast("long")).alias("truncated"),
    )
    costs = solved.groupBy("conv").agg(
        total(F.col("illegal")).alias("illegal"), total(F.col("cost") + F.col("start")).alias("cost")
    )
    audits = solved.mapInArrow(_audits, f"conv {conv}, pos long, audit string")
    audits = audits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "audit"))).alias("parts"))
    audits = audits.select("conv", F.array_join("parts.audit", "").alias("audit"))
    report = _same(_same(wrong, costs, ("conv",)), audits, ("conv",))
    report = report.select(F.col("conv").alias(conv_col), *report.columns[1:])

    stays = solved.mapInArrow(_stays, f"conv {conv}, pos long, beside int, edit string, role_out string")
    taken = stays.join(order.select("pos", "turn", "digest"), "pos")
    digest = F.when(F.col("edit") != "I", F.col("digest"))
    taken = taken.withColumn("digest", digest)
    # One of equal rows gives its text.
    texts = rows.groupBy("conv", "turn", "digest").agg(F.min(F.struct("role", "text")).alias("content"))
    found = _same(taken, texts, ("conv", "turn", "digest"))
    found = found.select(
        F.col("conv").alias(conv_col), "pos", "beside", "edit",
        F.coalesce("role_out", "content.role").alias("role"), F.coalesce("content.text", F.lit("")).alias("text"),
    )
    return Repaired(report, found)


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of conversations with faults: by crc32 of ``conv_id:turn`` modulo 20 a row is
    dropped (0), emptied (1), loses its ``.``, ``!`` and ``?`` (2), comes twice (3) or becomes the user's (4).

    Nulls count as one space there and in roles and texts.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = turns.withColumn("__fault", fault).where("__fault != 0")
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("__fault") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("__fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("__copy"),
    ).drop("__copy")


def repaired_digests(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of repaired turns as ``role:text`` lines.

    SHA-256 has to read a conversation in order, so one task streams its turns; it holds a batch of them.
    """
    conv = turns.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current, begun = None, None, False
        for batch in batches:
            convs, shas = [], []
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns, strict=True):
                if not begun or conv_id != current:
                    if begun:
                        convs.append(current)
                        shas.append(state.hexdigest())
                    state, current, begun = hashlib.sha256(), conv_id, True
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            kind = batch.schema.field("conv_id").type
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(shas, pa.string())], ["conv_id", "repaired_sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "beside")
    rows = ordered.select("conv_id", "role", "text")
    return rows.mapInArrow(digest, f"conv_id {conv}, repaired_sha256 string")
