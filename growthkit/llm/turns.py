"""Conversation structure repair: damage for tests of it, faults by turn, and the cheapest edits into alternating roles.

A conversation of up to LIMIT turns is aligned whole, in one place. A longer one is cut into segments that
never meet in memory: each segment is aligned from every state the turns before it may leave, costs are carried from the last
segment to the first and states from the first to the last, one small row for each segment. Texts of a long
conversation only pass, in order, through the task that hashes its repaired form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthkit.llm import alignment
from growthkit.llm.alignment import CLOSE, CLOSING, FAR, START
from growthkit.llm.arrow import arrow_type
from growthkit.llm.components import stored

#: Turns that are aligned in one place, and turns of a segment of a longer conversation.
LIMIT, SEGMENT = 1024, 512
#: Rows of a batch that goes back to Spark, and sequences whose alignment a task remembers.
BATCH, MEMO = 1 << 12, 1 << 14
_BLANKS = " \t\n\x0b\x0c\r"
_RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def damaged(rows: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): every row damaged by crc32 of `id:turn` modulo 20, nulls as one space.

    0 drops the row (copies 0), 1 empties its text, 2 takes out its `.!?`, 3 repeats it (copies 2), 4 makes its role user.
    """

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", filled(id), filled(turn)).cast("binary")) % 20
    return rows.select(
        F.col(id).alias("conv"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(filled(role)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text)).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def code_of(role: str, text: str, seen: bool) -> str:
    """The letter of a turn, as `alignment` has them; `b` blank and `d` duplicate, which both must go."""
    body = text.strip(_BLANKS)
    if not body:
        return "b"
    if seen:
        return "d"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial if body[-1] in ".!?" else initial.upper()


def _must_go(codes: str) -> str:
    return codes.replace("b", "d")


class _Repaired:
    """Counts and the hash of the repaired form of one conversation, whose turns come in order."""

    def __init__(self) -> None:
        self.least = self.most = self.turn = None
        self.turns = self.illegal = self.blank = self.duplicate = self.truncated = 0
        self.initial: str | None = None
        self.state = START
        self.hash, self.empty = hashlib.sha256(), True

    def _line(self, line: str) -> None:
        self.hash.update((line if self.empty else "\n" + line).encode("utf-8", "replace"))
        self.empty = False

    def add(self, turn, role: str, text: str, code: str) -> None:
        if turn is not None:
            self.turns += self.turn is None or turn != self.turn
            self.least, self.most, self.turn = turn if self.least is None else self.least, turn, turn
        self.blank += code == "b"
        self.duplicate += code == "d"
        self.truncated += code.isupper()
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]

    def edit(self, edit: str, role: str = "", text: str = "") -> None:
        to = alignment.after(self.state, edit, role[:1])
        if edit == "K":
            self._line(f"{role}:{text}")
        elif edit in "IR":
            self._line(f"{'assistant' if to == alignment.ASSISTANT else 'user'}:{text}")
        self.state = to

    def row(self, cost: int, audit: str) -> tuple:
        gaps = self.most - self.least + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal)
        return (*counts, cost, audit, self.hash.hexdigest())


def _groups(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[tuple]:
    """(whether its key is another than that of the row before, row) of rows sorted by their first columns."""
    before: tuple | None = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row[:keys] != before, row
            before = row[:keys]


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) if held else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield batch()
            held = []
    yield batch()


def _mapped(df: DataFrame, rows, schema: str) -> DataFrame:
    """`rows`, a function from batches to tuples, over the partitions of `df`."""
    empty = df.sparkSession.createDataFrame([], schema)
    schema_of = pa.schema([(f.name, arrow_type(f.dataType)) for f in empty.schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), schema_of)

    return df.mapInArrow(run, schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, results) of conversations from their sorted rows (conv, turn, role, text, copies)."""

    known: dict[str, tuple] = {}

    def best(codes: str) -> tuple:
        if codes not in known:
            if len(known) >= MEMO:
                known.clear()
            known[codes] = alignment.best(codes)
        return known[codes]

    def done(conv, turns: list[tuple]) -> tuple:
        out = _Repaired()
        seen: set[tuple] = set()
        codes = []
        for turn, role, text in turns:
            codes.append(code_of(role, text, (role, text) in seen))
            seen.add((role, text))
            out.add(turn, role, text, codes[-1])
        if not turns:
            return (conv, *out.row(0, ""))
        cost, audit, to = best(_must_go("".join(codes)))
        audit += CLOSING[to]
        left = iter(turns)
        for edit in audit:
            out.edit(edit, *(next(left)[1:] if edit != "I" else ()))
        return (conv, *out.row(cost, audit))

    held: tuple | None = None
    for new, (conv, turn, role, text, copies) in _groups(batches):
        if new:
            if held:
                yield done(*held)
            held = conv, []
        held[1].extend([(turn, role, text)] * copies)
    if held:
        yield done(*held)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, part, at, turn, role, text) of every copy of sorted rows: the partition, and the place there in its conversation."""
    part, at = TaskContext.get().partitionId(), 0
    for new, (conv, turn, role, text, copies) in _groups(batches):
        at = 0 if new else at
        for _ in range(copies):
            yield conv, part, at, turn, role, text
            at += 1


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for _, (conv, part, at, turn, role, text, seen) in _groups(batches):
        yield conv, part, at, turn, role, text, code_of(role, text, seen)


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for _, (conv, part, segment, codes) in _groups(batches):
        yield conv, part, segment, codes, [c for row in alignment.costs(_must_go(codes)) for c in row]


def _carried_back(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, part, segment, codes, costs of what follows, cost from START), last segment first."""
    ends = CLOSE
    for new, (conv, part, segment, codes, cost) in _groups(batches):
        ends = CLOSE if new else ends
        before = tuple(min(FAR, *(cost[4 * a + b] + ends[b] for b in range(4))) for a in range(4))
        yield conv, part, segment, codes, list(ends), before[START]
        ends = before


def _from_each_state(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for _, (conv, part, segment, codes, ends, cost) in _groups(batches):
        found = [alignment.best(_must_go(codes), state, tuple(ends)) for state in range(4)]
        yield conv, part, segment, codes, [a for _, a, _ in found], [to for _, _, to in found], cost


def _carried_on(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, part, segment, audit, cost of the whole conversation) by the state that the segments before leave."""
    state = START
    for new, (conv, part, segment, _, audits, to, cost) in _groups(batches):
        state = START if new else state
        yield conv, part, segment, audits[state], cost
        state = to[state]


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, results) of long conversations: each segment's audit, then its turns, in order."""

    def done(conv, out: _Repaired, cost: int, audits: list[str]) -> tuple:
        audits.append(CLOSING[out.state])
        for edit in audits[-1]:
            out.edit(edit)
        return conv, *out.row(cost, "".join(audits))

    conv, out, cost, audits, place = None, None, 0, [], 0
    for new, (key, _, _, at, audit, whole, turn, role, text, code) in _groups(batches):
        if new:
            if out is not None:
                yield done(conv, out, cost, audits)
            conv, out, cost, audits = key, _Repaired(), whole, []
        if at < 0:
            audits.append(audit)
            place = 0
            continue
        out.add(turn, role, text, code)
        while audits[-1][place] == "I":
            out.edit("I")
            place += 1
        out.edit(audits[-1][place], role, text)
        place += 1
    if out is not None:
        yield done(conv, out, cost, audits)


def _long(rows: DataFrame, kind: str, segment: int) -> DataFrame:
    """(conv, results) of conversations of any length from damaged rows."""
    order = ["conv", F.asc_nulls_first("turn"), "role", "text"]
    rows = rows.where("copies > 0").repartitionByRange(*order).sortWithinPartitions(*order)
    at = f"conv {kind}, part int, at long"
    turn = f"turn {rows.schema['turn'].dataType.simpleString()}"
    numbered = stored(_mapped(rows, _numbered, f"{at}, {turn}, role string, text string"), "turns")
    # the first of equal turns, wherever the others are
    first = numbered.groupBy("conv", "role", "text").agg(F.min(F.struct("part", "at")).alias("f"))
    first = first.select(F.col("conv").alias("c"), F.col("f.part").alias("p"), F.col("f.at").alias("n"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("at") == F.col("n"))
    seen = numbered.join(first, same, "left").select(*numbered.columns, F.col("p").isNull().alias("seen"))
    coded = stored(_mapped(seen, _coded, f"{at}, {turn}, role string, text string, code string"), "turns")

    number = F.floor(F.col("at") / segment).alias("segment")
    listed = F.array_sort(F.collect_list(F.struct("at", "code")))  # at most `segment` turns
    segments = coded.groupBy("conv", "part", number).agg(F.array_join(listed["code"], "").alias("codes"))
    key = f"conv {kind}, part int, segment long"
    crossed = _mapped(segments, _crossed, f"{key}, codes string, costs array<long>").repartition("conv")
    back = crossed.sortWithinPartitions("conv", F.desc("part"), F.desc("segment"))
    ended = stored(_mapped(back, _carried_back, f"{key}, codes string, ends array<long>, cost long"), "turns")
    states = _mapped(ended, _from_each_state, f"{key}, codes string, audits array<string>, states array<int>, cost long")
    on = states.repartition("conv").sortWithinPartitions("conv", "part", "segment")
    audits = _mapped(on, _carried_on, f"{key}, audit string, cost long").withColumn("at", F.lit(-1).cast("long"))

    lines = audits.unionByName(coded.withColumn("segment", number), allowMissingColumns=True)
    lines = lines.select("conv", "part", "segment", "at", "audit", "cost", "turn", "role", "text", "code")
    lines = lines.repartition("conv").sortWithinPartitions("conv", "part", "segment", "at")
    return _mapped(lines, _streamed, f"conv {kind}, {_RESULT}")


def repaired(
    rows: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    damage: bool = True,
    limit: int = LIMIT,
    segment: int = SEGMENT,
) -> DataFrame:
    """Per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns are read in the order of `turn` (whole numbers, nulls first), ties by role and text; with `damage` after `damaged`. A
    turn's first fault counts: blank, duplicate of an earlier one, or truncated (no `.!?` at its end). `audit`
    has the initials of the cheapest edits in order, the ASCII-least of equally cheap ones. Null roles and texts are one
    space, a null id is one conversation. Conversations without turns have zeros, an empty audit and the hash of
    nothing. Repeated rows are turns like others (duplicates); other columns are not read.

    Conversations with more than `limit` rows are aligned in segments of `segment` turns; whether there are any is
    counted when this is called, and then Spark jobs run. The repaired form of a conversation is hashed in one task, and
    its audit is one value, as the result asks for both.
    """
    if not damage:
        rows = rows.select(
            F.col(id).alias("conv"),
            F.col(turn).alias("turn"),
            *(F.coalesce(c, F.lit(" ")).alias(n) for c, n in ((F.col(role), "role"), (F.col(text), "text"))),
            F.lit(1).alias("copies"),
        )
    else:
        rows = damaged(rows, id, turn, role, text)
    kind = rows.schema["conv"].dataType.simpleString()
    long = rows.groupBy("conv").agg(F.sum("copies").alias("turns")).where(F.col("turns") > limit)
    long = stored(long.select(F.col("conv").alias("c")), "long")
    short, longer = rows, None
    if not long.isEmpty():
        same = F.col("conv").eqNullSafe(F.col("c"))
        short = rows.join(long, same, "left_anti")
        longer = rows.join(long, same, "left_semi")
    short = short.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    out = _mapped(short, _whole, f"conv {kind}, {_RESULT}")
    if longer is not None:
        out = out.unionByName(_long(longer, kind, segment))
    return out.withColumnRenamed("conv", id)
