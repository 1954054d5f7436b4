"""Conversation structure repair by a run-length dynamic programme.

Every row becomes a symbol of its role and fault; the edits keep, rerole, delete and
insert lead through four states (nothing yet, after system, after user, after assistant).
What a symbol does to the least costs of the rest is a 4 x 4 matrix of the min-plus
algebra, so a run of equal symbols is a power of it, put together from cached binary
powers, and costs of pieces of a conversation can be computed apart from each other.

1. Rows of one conversation, turn, role and text are one row with a number of copies; the
   first row of a role and text is found by a minimum. Nothing is gathered for that.
2. Rows are sorted over all tasks by conversation and turn and written. The part that a
   task writes of a conversation is a segment, so a conversation that holds a third of
   all rows has many. Segments are collapsed to runs; each gives its matrix.
3. The matrices of a conversation, one for each segment, give the least costs behind each
   segment and of the whole. Segments then unroll their choices for every state they may
   be entered in; following the states picks one.
4. Rows and choices meet again, sorted, and are edited as they stream by.

Only the last step of ``digests`` reads a conversation in one task, as a hash over its
text is one sequence; it holds a row and the edits of a segment at a time.

Order within a conversation: turn (nulls first), role, xxhash64 of the text. Null roles
and texts are one space, as are null ids and turns in the damage's hash. A conversation
with a null id is one of its own. Repeated rows are copies, hence duplicates. An empty
table gives no rows; a conversation that lost all rows has zeros, no edits and the hash
of the empty string. Roles other than system, user and assistant that start with their
letters count by that letter; all others can only be reroled or deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.llm.common import ship
from paylens.session import written

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant; the first and the last may end a conversation.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state that a reroled or inserted row leads to.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_NEVER = 1 << 60
_END = (0, _NEVER, _NEVER, 0)
_BLANK = " \t\n\x0b\f\r"
#: Rows of a run whose costs are held at once.
_BLOCK = 4096

Matrix = tuple[tuple[int, ...], ...]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` as a known fault in every fifth row leaves them."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(plain("role"))
    copies = F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).cast("long")
    return rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def _kept_to(symbol: str, state: int) -> int | None:
    """State after a kept row, or None where its role may not follow."""
    role = symbol.lower()
    if role == "s":
        return _SYSTEM if state == _START else None
    if role == "u":
        return _USER if state != _USER else None
    return _ASSISTANT if role == "a" and state == _USER else None


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row; upper case is truncated, ``x`` must go, ``o`` is another role."""
    found = [("D", DELETE, state)]
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _kept_to(symbol, state)
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, _NEXT[state]))
    return found


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(_NEVER, *(row[k] + b[k][j] for k in range(4))) for j in range(4)) for row in a)


def _apply(a: Matrix, after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(_NEVER, *(x + y for x, y in zip(row, after))) for row in a)


def _closure() -> Matrix:
    """Least cost of insertions between two states."""
    rows = []
    for state in range(4):
        costs = [_NEVER] * 4
        costs[state], at, spent = 0, state, 0
        for _ in range(3):
            at, spent = _NEXT[at], spent + INSERT
            costs[at] = min(costs[at], spent)
        rows.append(tuple(costs))
    return tuple(rows)


INSERTIONS = _closure()
#: Least costs behind the last row.
FINAL = _apply(INSERTIONS, _END)


@lru_cache(maxsize=None)
def _power(symbol: str, bit: int) -> Matrix:
    """Matrix of 2^bit rows of a symbol, insertions before each of them allowed."""
    if bit:
        half = _power(symbol, bit - 1)
        return _times(half, half)
    step = [[_NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for _, cost, to in _edits(symbol, state):
            step[state][to] = min(step[state][to], cost)
    return _times(INSERTIONS, tuple(map(tuple, step)))


def run_matrix(runs: list[tuple[str, int]]) -> Matrix:
    """Matrix of runs (symbol, rows) one after another."""
    whole = None
    for symbol, n in runs:
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                whole = _power(symbol, bit) if whole is None else _times(whole, _power(symbol, bit))
    return whole or tuple(tuple(0 if i == j else _NEVER for j in range(4)) for i in range(4))


def _before(symbol: str, n: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs in front of n rows of a symbol."""
    for bit in range(n.bit_length()):
        if n >> bit & 1:
            after = _apply(_power(symbol, bit), after)
    return after


@lru_cache(maxsize=1 << 16)
def _choose(symbol: str, state: int, here: tuple[int, ...], after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits of one row and the state behind it."""
    letters = ""
    while True:
        options = [(letter, to) for letter, cost, to in _edits(symbol, state) if cost + after[to] == here[state]]
        if INSERT + here[_NEXT[state]] == here[state]:
            options.append(("I", -1))
        letter, to = min(options)
        letters += letter
        if letter != "I":
            return letters, to
        state = _NEXT[state]


def _relative(costs: tuple[int, ...], low: int) -> tuple[int, ...]:
    return tuple(c - low if c < _NEVER else _NEVER for c in costs)


def unroll(runs: list[tuple[str, int]], after: tuple[int, ...], state: int) -> tuple[str, int]:
    """Edits of the runs and the state behind them, if ``after`` are the least costs there."""
    blocks = []
    for symbol, n in reversed(runs):
        while n:
            rows = min(n, _BLOCK)
            blocks.append((symbol, rows, after))
            after, n = _before(symbol, rows, after), n - rows
    letters = []
    for symbol, rows, costs in reversed(blocks):
        row = [costs]
        for _ in range(rows):
            row.append(_apply(_power(symbol, 0), row[-1]))
        for behind in range(rows - 1, -1, -1):
            low = min(row[behind])
            text, state = _choose(symbol, state, _relative(row[behind + 1], low), _relative(row[behind], low))
            letters.append(text)
    return "".join(letters), state


def last_insertions(state: int) -> str:
    """Insertions behind the last row that end the conversation."""
    letters = ""
    while _END[state] != FINAL[state]:
        letters, state = letters + "I", _NEXT[state]
    return letters


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) with faults and symbols, sorted and written; ``seg`` is the task that wrote a row."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    plain = rows.withColumns({c: F.coalesce(c, F.lit(" ")) for c in ("role", "text")})
    merged = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).select(
        conv.alias("conv"), "*", F.xxhash64("text").alias("d1"), F.xxhash64(F.lit(1), "text").alias("d2")
    )
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    merged = written(merged, "merged")
    same = ["conv", "role", "d1", "d2"]
    firsts = merged.groupBy(*same).agg(F.min(place).alias("first"))
    trimmed = F.rtrim("text", F.lit(_BLANK))
    blank = trimmed == ""
    again = ~F.struct(F.col("turn").isNotNull().alias("known"), "turn").eqNullSafe(F.col("first"))
    fault = F.when(blank, F.lit("blank")).when(again, F.lit("duplicate")).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), F.lit("truncated"))
    initial = F.substr(F.col("role"), F.lit(1), F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), F.lit("x")).when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    judged = merged.join(firsts, same).select("conv", "conv_id", "turn", "role", "d1", "d2", "text", "copies", fault.alias("fault"), initial.alias("initial"))
    order = ["conv", F.asc_nulls_first("turn"), "role", "d1", "d2"]
    ranged = judged.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(
        ranged.select(
            "conv", "conv_id", "turn", "role", "text", "copies", F.coalesce("fault", F.lit("")).alias("fault"), "initial", symbol.alias("symbol"),
            F.spark_partition_id().alias("seg"), F.monotonically_increasing_id().alias("pos"),
        ),
        "rows",
    )


_SEGMENT = "conv string, seg int, symbols array<string>, lengths array<bigint>, matrix array<bigint>"


def _runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs and matrix of each segment of sorted rows (conv, seg, symbol, copies)."""
    at, runs, done = None, [], []

    def passed_on(segments: list) -> pa.RecordBatch:
        flat = [[c for row in run_matrix(r) for c in row] for _, r in segments]
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in segments], pa.string()), pa.array([k[1] for k, _ in segments], pa.int32()),
             pa.array([[s for s, _ in r] for _, r in segments], pa.list_(pa.string())),
             pa.array([[n for _, n in r] for _, r in segments], pa.list_(pa.int64())), pa.array(flat, pa.list_(pa.int64()))],
            names=["conv", "seg", "symbols", "lengths", "matrix"],
        )

    for batch in batches:
        for conv, seg, symbol, copies in zip(*(batch.column(c).to_pylist() for c in ("conv", "seg", "symbol", "copies"))):
            if (conv, seg) != at:
                if at is not None:
                    done.append((at, runs))
                at, runs = (conv, seg), []
            for s, n in ((symbol, 1), ("x", copies - 1)):
                if runs and runs[-1][0] == s:
                    runs[-1] = (s, runs[-1][1] + n)
                elif n:
                    runs.append((s, n))
        if len(done) >= 1000:
            yield passed_on(done)
            done = []
    if at is not None:
        done.append((at, runs))
    yield passed_on(done)


def _costs_behind(segments: DataFrame) -> DataFrame:
    """``conv, seg, after`` (least costs behind the segment), ``first`` and ``last`` segment and ``cost`` of the whole."""
    found = segments.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "matrix")), asc=False).alias("parts"))

    def least(part: Column, after: Column) -> Column:
        return F.array(*[F.least(*[F.least(part["matrix"][4 * i + j] + after[j], F.lit(_NEVER)) for j in range(4)]) for i in range(4)])

    start = F.struct(F.array(*[F.lit(c).cast("long") for c in FINAL]).alias("now"), F.array().cast("array<struct<seg:int,after:array<bigint>>>").alias("seen"))
    walked = F.aggregate(
        "parts", start,
        lambda acc, part: F.struct(
            least(part, acc["now"]).alias("now"), F.array_append(acc["seen"], F.struct(part["seg"].alias("seg"), acc["now"].alias("after"))).alias("seen")
        ),
    )
    whole = found.select("conv", walked.alias("w"), F.element_at("parts", -1)["seg"].alias("low"), F.element_at("parts", 1)["seg"].alias("high"))
    each = whole.select("conv", F.inline("w.seen"), "low", "high", F.col("w.now")[_START].alias("cost"))
    return each.select("conv", "seg", "after", (F.col("seg") == F.col("low")).alias("first"), (F.col("seg") == F.col("high")).alias("last"), "cost")


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``audits, exits`` of each segment for the states it may be entered in."""
    for batch in batches:
        audits, exits = [], []
        for symbols, lengths, after, first, last in zip(*(batch.column(c).to_pylist() for c in ("symbols", "lengths", "after", "first", "last"))):
            runs = list(zip(symbols, lengths))
            letters, states = [None] * 4, [None] * 4
            for state in (_START,) if first else range(4):
                letters[state], states[state] = unroll(runs, tuple(after), state)
                if last:
                    letters[state] += last_insertions(states[state])
            audits.append(letters)
            exits.append(states)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("seg"), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32())), batch.column("cost")],
            names=["conv", "seg", "audits", "exits", "cost"],
        )


def _chosen(segments: DataFrame) -> DataFrame:
    """``conv, seg, entered, audit, cost``: the edits of each segment for the state that it is entered in."""
    costs = _costs_behind(segments)
    tried = written(
        segments.select("conv", "seg", "symbols", "lengths").join(costs, ["conv", "seg"]).mapInArrow(
            _unrolled, "conv string, seg int, audits array<string>, exits array<int>, cost bigint"
        ),
        "choices",
    )
    paths = tried.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("seg", "exits"))).alias("parts"))
    start = F.struct(F.lit(_START).alias("state"), F.array().cast("array<struct<seg:int,entered:int>>").alias("seen"))
    walked = F.aggregate(
        "parts", start,
        lambda acc, part: F.struct(
            F.get(part["exits"], acc["state"]).alias("state"),
            F.array_append(acc["seen"], F.struct(part["seg"].alias("seg"), acc["state"].alias("entered"))).alias("seen"),
        ),
    )
    entered = paths.select("conv", F.inline(walked["seen"]))
    return tried.join(entered, ["conv", "seg"]).select("conv", "seg", "entered", F.get("audits", F.col("entered")).alias("audit"), "cost")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, seg, turn, letter, role, text) for every edit, from a segment's edits followed by its rows."""
    conv, seg, letters, at, state, tail = None, None, "", 0, _START, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            at, state = at + 1, _NEXT[state]
            yield conv, seg, None, "I", _ROLE[state], ""

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("conv", "seg", "audit", "entered", "role", "text", "turn", "copies")))
        for own, part, audit, entered, role, text, turn, copies in rows:
            if audit is not None:
                conv, seg, letters, at, state = own, part, audit, 0, entered
                tail = len(letters.rstrip("I"))
                continue
            for _ in range(copies):
                yield from inserted()
                letter, at = letters[at], at + 1
                now = role
                if letter == "R":
                    state = _NEXT[state]
                    now = _ROLE[state]
                elif letter == "K":
                    state = _kept_to(role[:1], state)
                yield conv, seg, turn, letter, now, text
            if at == tail:
                # Insertions behind the last row have no row to come before.
                yield from inserted()


def _streamed(rows: DataFrame, chosen: DataFrame, together: list[str]) -> DataFrame:
    """Rows and edits of a segment one behind the other, dealt by ``together``."""
    edits = chosen.select("conv", "seg", F.lit(-1).cast("long").alias("pos"), "audit", "entered").withColumns(
        {"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "turn": F.lit(None).cast(rows.schema["turn"].dataType),
         "copies": F.lit(None).cast("long")}
    )
    data = rows.select(
        "conv", "seg", "pos", F.lit(None).cast("string").alias("audit"), F.lit(None).cast("int").alias("entered"), "role", "text", "turn", "copies"
    )
    return edits.unionByName(data).repartition(*together).sortWithinPartitions("conv", "seg", "pos")


def _planned(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sorted rows and the edits of their segments."""
    ship(rows.sparkSession)
    placed = _sorted_rows(rows)
    small = placed.select("conv", "seg", "pos", "symbol", "copies").repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos")
    segments = written(small.mapInArrow(_runs_of, _SEGMENT), "segments")
    return placed, written(_chosen(segments), "edits")


def repaired_rows(rows: DataFrame) -> DataFrame:
    """``conv, seg, place, turn, edit, role, text`` of every row (conv_id, turn, role, text, copies) after repair.

    ``conv`` is ``=`` and the id, or empty for a null id; seg and place give the order;
    deleted rows are left out and inserted ones have no turn.
    """
    placed, chosen = _planned(rows)
    kind = placed.schema["turn"].dataType
    schema = {"conv": pa.string(), "seg": pa.int32(), "place": pa.int64(), "turn": pa.string(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, of, place = [], None, 0

        def passed_on() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(schema)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.values())], names=list(schema))

        for conv, seg, turn, letter, role, text in _edited(batches):
            if (conv, seg) != of:
                of, place = (conv, seg), 0
            if letter != "D":
                out.append((conv, seg, place, None if turn is None else str(turn), letter, role, text))
                place += 1
            if len(out) >= 5000:
                yield passed_on()
        yield passed_on()

    found = _streamed(placed, chosen, ["conv", "seg"]).mapInArrow(
        edited, "conv string, seg int, place bigint, turn string, edit string, role string, text string"
    )
    return found.withColumn("turn", F.col("turn").cast(kind))


def digests(placed: DataFrame, chosen: DataFrame) -> DataFrame:
    """``conv, audit, repaired_sha256`` of every conversation that has rows."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, of, audit, digest, empty = [], None, [], None, True

        def passed_on() -> pa.RecordBatch:
            cols = list(zip(*done)) or [(), (), ()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["conv", "audit", "repaired_sha256"])

        for conv, _, _, letter, role, text in _edited(batches):
            if conv != of:
                if of is not None:
                    done.append((of, "".join(audit), digest.hexdigest()))
                of, audit, digest, empty = conv, [], hashlib.sha256(), True
                if len(done) >= 1000:
                    yield passed_on()
            audit.append(letter)
            if letter != "D":
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
        if of is not None:
            done.append((of, "".join(audit), digest.hexdigest()))
        yield passed_on()

    return _streamed(placed, chosen, ["conv"]).mapInArrow(digested, "conv string, audit string, repaired_sha256 string")


def _fault_counts(placed: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal``."""
    truncated = F.count_if(F.col("fault") == "truncated")
    # All copies of a row but the first are blank like it, or duplicates of it.
    others = F.col("copies") - 1
    blank = F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(F.lit(0)))
    duplicate = F.sum(F.when(F.col("fault") == "blank", F.lit(0)).when(F.col("fault") == "duplicate", F.col("copies")).otherwise(others))
    # Two neighbours are told apart within a segment; its ends are compared with those of the next one.
    inside = Window.partitionBy("conv", "seg").orderBy("pos")
    legal = F.concat("before", "initial").isin("su", "ua", "au")
    pairs = placed.select("conv", "seg", "pos", "initial", "fault", "copies", "turn", F.lag("initial").over(inside).alias("before"))
    turn_changes = F.when(F.col("turn").isNotNull() & ~F.lag("turn").over(inside).eqNullSafe(F.col("turn")), F.lit(1)).otherwise(F.lit(0))
    segment = pairs.withColumn("new_turn", turn_changes).groupBy("conv", "seg").agg(
        blank.alias("blank"), duplicate.alias("duplicate"), truncated.alias("truncated"),
        (F.sum(F.when(F.col("before").isNotNull() & ~legal, F.lit(1)).otherwise(F.lit(0))) + F.sum(others)).alias("illegal"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.sum("new_turn").alias("turns"),
        F.min_by("initial", "pos").alias("enters"), F.max_by("initial", "pos").alias("leaves"),
    )
    along = Window.partitionBy("conv").orderBy("seg")
    joint = segment.withColumns({"left": F.lag("leaves").over(along), "high_before": F.max("high").over(along.rowsBetween(Window.unboundedPreceding, -1))})
    bad = F.when(F.col("left").isNotNull() & ~F.concat("left", "enters").isin("su", "ua", "au"), F.lit(1)).otherwise(F.lit(0))
    shared = F.when(F.col("low") == F.col("high_before"), F.lit(1)).otherwise(F.lit(0))
    return joint.groupBy("conv").agg(
        (F.max("high") - F.min("low") + 1 - (F.sum("turns") - F.sum(shared))).alias("gaps"), F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"), (F.sum("illegal") + F.sum(bad)).alias("illegal"),
    )


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``: faults and cheapest repair of ``rows`` (conv_id, turn, role, text, copies).

    ``gaps`` are turns missing between the least and the largest; ``illegal`` are
    neighbours whose role initials are not su, ua or au; ``cost`` and ``audit`` are those
    of the cheapest edits, the ASCII-least where several are.
    """
    placed, chosen = _planned(rows)
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    every = conversations.select("conv_id").distinct().withColumn("conv", conv)
    costs = chosen.groupBy("conv").agg(F.first("cost").alias("cost"))
    joined = every.join(_fault_counts(placed), "conv", "left").join(costs, "conv", "left").join(digests(placed, chosen), "conv", "left")
    zeros = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    )
