"""Repair of the role structure of conversations at the least cost, by branch and bound.

A repaired conversation has the roles (by their initials) ``(s?(ua)+)?``. Every row is kept (0), given
another role (user or assistant, 3) or deleted (4; blank and duplicate rows always); an empty user or
assistant row can be inserted anywhere (3). A truncated row that stays costs 3 more. Of the cheapest
repairs the one with the least string of edit letters (D, I, K, R, by code point) is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlake.llm.common import stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
BLANKS = " \t\n\v\f\r"
SENTENCE_ENDS = ".!?"
LEGAL_PAIRS = {"su", "ua", "au"}
# Where a repaired prefix stands: nothing yet, after s, after u, after a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = (EMPTY, SYSTEM, USER, ASSISTANT), (EMPTY, ASSISTANT)
# Conversations of more rows than this are solved in segments of so many rows.
SEGMENT = 2048
# So many neighbouring segments are joined in one step.
JOINED = 16
NEVER = 1 << 60

RESULT = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class Row(NamedTuple):
    """What a repair needs to know of a row."""

    initial: str
    must_go: bool
    truncated: bool


def after(state: int, initial: str) -> int | None:
    """Where a row with this role leads, or None where the grammar forbids it."""
    if initial == "s" and state == EMPTY:
        return SYSTEM
    if initial == "u" and state != USER:
        return USER
    if initial == "a" and state == USER:
        return ASSISTANT
    return None


def wanted(state: int) -> int:
    """Where an inserted row, or one with a new role, leads: user and assistant take turns."""
    return ASSISTANT if state == USER else USER


def steps(rows: Sequence[Row], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, next row, next state, cost) of all edits possible at a node, by letter."""
    found = []
    if i < len(rows):
        found.append((DELETE, i + 1, state, DELETE_COST))
    found.append((INSERT, i, wanted(state), INSERT_COST))
    if i < len(rows) and not rows[i].must_go:
        extra = TRUNCATED_COST if rows[i].truncated else 0
        kept = after(state, rows[i].initial)
        if kept is not None:
            found.append((KEEP, i + 1, kept, extra))
        found.append((REROLE, i + 1, wanted(state), REROLE_COST + extra))
    return found


def suffix_bounds(rows: Sequence[Row], ends: Sequence[int]) -> list[list[int]]:
    """For each (row, state) a lower bound of what the rest costs: its least cost, letters left aside.

    An insertion stays at its row, so a row's states are relaxed twice; more insertions in one place
    lead back to a state already met.
    """
    bounds = [[0 if s in ends else NEVER for s in STATES]]
    for i in range(len(rows), -1, -1):
        if i < len(rows):
            later = bounds[-1]
            bounds.append(
                [
                    min(cost + later[to] for letter, _, to, cost in steps(rows, i, s) if letter != INSERT)
                    for s in STATES
                ]
            )
        here = bounds[-1]
        for _ in range(2):
            for s in STATES:
                here[s] = min(here[s], INSERT_COST + here[wanted(s)])
    return bounds[::-1]


def search(rows: Sequence[Row], entry: int = EMPTY, ends: Sequence[int] = ENDS) -> tuple[int, str] | None:
    """The least (cost, audit) from a state before the rows to one of ``ends`` behind them.

    Depth first over an explicit stack, the most promising edit (bound, letter) first. A node is left
    when its bound exceeds the incumbent's cost, or equals it with letters that come later, or when
    its (row, state) was reached before with a (cost, audit) not worse: equal letters follow, and of two
    prefixes of equal cost at one node neither begins with the other. The empty stack proves optimality.
    """
    bounds = suffix_bounds(rows, ends)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        least = cost + bounds[i][state]
        if least >= NEVER or (best and (least > best[0] or (least == best[0] and audit > best[1]))):
            continue
        seen = reached.get((i, state))
        if seen is not None and seen <= (cost, audit):
            continue
        reached[i, state] = (cost, audit)
        if i == len(rows) and state in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        nodes = [(to, s, cost + c, audit + letter) for letter, to, s, c in steps(rows, i, state)]
        nodes.sort(key=lambda n: (n[2] + bounds[n[0]][n[1]], n[3]), reverse=True)
        stack.extend(nodes)
    return best


Table = dict[tuple[int, int], tuple[int, str]]


def transfers(rows: Sequence[Row]) -> Table:
    """The least (cost, audit) of a segment for every pair of states before and behind it."""
    found = {(a, b): search(rows, a, (b,)) for a in STATES for b in STATES}
    return {k: v for k, v in found.items() if v is not None}


def joined(first: Table, second: Table) -> Table:
    """The table of two neighbouring segments."""
    out: Table = {}
    for (a, m), (cost, audit) in first.items():
        for (n, b), (more, rest) in second.items():
            if m == n and ((a, b) not in out or (cost + more, audit + rest) < out[a, b]):
                out[a, b] = (cost + more, audit + rest)
    return out


def _paths(row: dict) -> Table:
    return {(p["a"], p["b"]): (p["cost"], p["audit"]) for p in row["paths"]}


class Repaired:
    """Lines of a repaired conversation, one by one, from its audit and its rows in order."""

    def __init__(self, audit: str):
        self.edits, self.state, self.at = audit, EMPTY, 0

    def _made(self, role: str, text: str) -> tuple[str, str]:
        self.state = after(self.state, role[:1])
        return role, text

    def _next_role(self) -> str:
        return "assistant" if self.state == USER else "user"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.edits[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._made(self._next_role(), "")

    def lines(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What comes before a row by insertion, and the row itself unless it is deleted."""
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != DELETE:
            yield self._made(role if edit == KEEP else self._next_role(), text)


class Digest:
    """SHA-256 of ``role:text`` lines joined by line feeds."""

    def __init__(self):
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, lines: Iterator[tuple[str, str]]) -> None:
        for role, text in lines:
            self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1

    def hex(self) -> str:
        return self.sha.hexdigest()


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, dropped) with null roles and texts as one space; ``__dropped`` marks rows that
    only name their conversation."""
    gone = F.col("__dropped") if "__dropped" in rows.columns else F.lit(False)
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        gone.alias("dropped"),
    )


def fault(text: str, seen: bool) -> str:
    """The first fault of a row: blank, duplicate, truncated, or none."""
    body = text.rstrip(BLANKS)
    if not body:
        return "blank"
    if seen:
        return "duplicate"
    return "" if body[-1] in SENTENCE_ENDS else "truncated"


class Summary:
    """Counts over the rows of a conversation, in order."""

    def __init__(self):
        self.turns: set[int] = set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.illegal, self.previous = 0, None

    def add(self, turn: int | None, initial: str, kind: str) -> None:
        if turn is not None:
            self.turns.add(turn)
        self.faults[kind] += 1
        if self.previous is not None and self.previous + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.previous = initial

    def values(self) -> list[int]:
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        return [gaps, *(self.faults[k] for k in ("blank", "duplicate", "truncated")), self.illegal]


def whole(rows: Sequence[tuple], messages: bool) -> list[tuple]:
    """Result of one conversation of few rows (turn, role, text), in order: one tuple, or one for each message."""
    seen: set[bytes] = set()
    summary, facts = Summary(), []
    for turn, role, text in rows:
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        kind = fault(text, key in seen)
        seen.add(key)
        summary.add(turn, role[:1], kind)
        facts.append(Row(role[:1], kind in ("blank", "duplicate"), kind == "truncated"))
    cost, audit = search(facts)
    repaired, digest, made = Repaired(audit), Digest(), []
    for _, role, text in rows:
        new = list(repaired.lines(role, text))
        made.extend(new)
        digest.add(iter(new))
    new = list(repaired.inserted())
    made.extend(new)
    digest.add(iter(new))
    if messages:
        return [(k, *line) for k, line in enumerate(made)]
    return [(*summary.values(), cost, audit, digest.hex())]


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches, a thousand Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(conv: pa.DataType, *fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("conv", conv), *fields])


_SUMS = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]


def _few_rows(rows: DataFrame, messages: bool) -> DataFrame:
    """Conversations that fit in memory: dealt by id, sorted, one after the other."""
    kind = rows.schema["conv"].dataType.simpleString()
    fields = [("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    fields = fields if messages else [*_SUMS, ("audit", pa.string()), ("repaired_sha256", pa.string())]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, group, current = None, [], [], None

        def close() -> None:
            if current is not None:
                out.extend((*current, *r) for r in whole(group, messages))
                group.clear()

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal schema
            for batch in source:
                schema = schema or _arrow(batch.schema.field(0).type, *fields)
                yield batch

        for conv, turn, role, text, dropped in _columns(typed(batches)):
            if current != (conv,):
                close()
                current = (conv,)
                if len(out) >= 1000:
                    yield _batch(out, schema)
                    out.clear()
            if not dropped:
                group.append((turn, role, text))
        close()
        if out:
            yield _batch(out, schema)

    made = "place long, role string, text string" if messages else RESULT
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text"]
    return rows.repartition("conv").sortWithinPartitions(*order).mapInArrow(solve, f"conv {kind}, {made}")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _many_rows(rows: DataFrame, segment: int, messages: bool) -> DataFrame:
    """Conversations of any length: segments of rows are solved apart and joined step by step.

    Rows are dealt by ranges of their order, so one conversation may lie in many tasks; what is first of
    equal rows is a minimum. Only the digest runs over a whole conversation, in a stream.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    rows = rows.withColumn("key", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    rows = stage(rows.withColumn("id", F.monotonically_increasing_id()), "repair-rows")
    order = F.struct(F.col("turn").isNotNull().alias("a"), "turn", "id")
    body = F.rtrim(F.translate("text", BLANKS[1:], " " * (len(BLANKS) - 1)))
    there = rows.where(~F.col("dropped"))
    first = there.groupBy("conv", "key").agg(F.min(order).alias("first"))
    known = there.select(
        "conv", "turn", "id", "role", "text", F.substring("role", 1, 1).alias("initial"),
        F.right(body, F.lit(1)).alias("last"),
    )
    marked = known.join(first.select(F.col("first.id").alias("id"), F.lit(True).alias("new")), "id", "left").select(
        "conv", F.col("turn").isNotNull().alias("a"), "turn", "role", "text", "id", "initial",
        F.when(F.col("last") == "", "blank")
        .when(F.col("new").isNull(), "duplicate")
        .when(~F.col("last").isin(list(SENTENCE_ENDS)), "truncated")
        .otherwise("")
        .alias("kind"),
    )
    keys = ["conv", "a", "turn", "role", "text", "id"]
    dealt = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, place = None, -1
        for batch in batches:
            at = []
            for conv in batch.column(0).to_pylist():
                place = place + 1 if current == (conv,) else 0
                current = (conv,)
                at.append(place)
            yield batch.append_column("place", pa.array(at, pa.int64()))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    numbered = dealt.mapInArrow(number, f"{fields}, place long").withColumn("part", F.spark_partition_id())
    numbered = stage(numbered.withColumn("seg", F.floor(F.col("place") / segment)), "repair-order")

    def solve(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        initials, kinds = table["initial"].to_pylist(), table["kind"].to_pylist()
        facts = [Row(i, k in ("blank", "duplicate"), k == "truncated") for i, k in zip(initials, kinds, strict=True)]
        illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))
        made = [
            {"a": a, "b": b, "cost": cost, "audit": audit} for (a, b), (cost, audit) in sorted(transfers(facts).items())
        ]
        columns = {
            "conv": table["conv"].slice(0, 1), "part": table["part"].slice(0, 1), "seg": table["seg"].slice(0, 1),
            "many": [len(facts)], "illegal": [illegal], "left": [initials[0]], "right": [initials[-1]], "paths": [made],
            **{k: [kinds.count(k)] for k in ("blank", "duplicate", "truncated")},
        }
        return pa.table(columns).cast(solved_schema(table.schema.field("conv").type))

    paths = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))

    def solved_schema(conv: pa.DataType) -> pa.Schema:
        return pa.schema([
            ("conv", conv), ("part", pa.int32()), ("seg", pa.int64()), ("many", pa.int64()), ("illegal", pa.int64()),
            ("left", pa.string()), ("right", pa.string()), ("paths", paths), ("blank", pa.int64()),
            ("duplicate", pa.int64()), ("truncated", pa.int64()),
        ])

    table = (
        f"conv {kind}, part int, seg long, many long, illegal long, `left` string, `right` string, "
        "paths array<struct<a int, b int, cost long, audit string>>, blank long, duplicate long, truncated long"
    )
    names = ["conv", "part", "seg", "place", "initial", "kind"]
    parts = stage(numbered.select(*names).groupBy("conv", "part", "seg").applyInArrow(solve, table), "repair-parts")

    def join(key: tuple, table: pa.Table) -> pa.Table:
        found = table.sort_by([("part", "ascending"), ("seg", "ascending")]).to_pylist()
        one, made = dict(found[0]), _paths(found[0])
        for other in found[1:]:
            made = joined(made, _paths(other))
            one["illegal"] += other["illegal"] + (one["right"] + other["left"] not in LEGAL_PAIRS)
            one["right"] = other["right"]
            for k in ("many", "blank", "duplicate", "truncated"):
                one[k] += other[k]
        one["paths"] = [{"a": a, "b": b, "cost": c, "audit": t} for (a, b), (c, t) in sorted(made.items())]
        return pa.Table.from_pylist([one], solved_schema(table.schema.field("conv").type))

    # Segments of a conversation get consecutive numbers; each step leaves a sixteenth of them.
    w = Window.partitionBy("conv").orderBy("part", "seg")
    parts = stage(parts.withColumn("seg", (F.row_number().over(w) - 1).cast("long")).withColumn("part", F.lit(0)), "repair-parts")
    while (parts.agg(F.max("seg")).head()[0] or 0) > 0:
        parts = parts.withColumn("part", F.floor(F.col("seg") / JOINED).cast("int"))
        parts = parts.groupBy("conv", "part").applyInArrow(join, table)
        parts = stage(parts.withColumn("seg", F.col("part").cast("long")).withColumn("part", F.lit(0)), "repair-parts")

    ends = F.filter("paths", lambda p: (p["a"] == EMPTY) & p["b"].isin(*ENDS))
    best = F.array_min(F.transform(ends, lambda p: F.struct(p["cost"], p["audit"])))
    turns = there.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    solved = parts.withColumn("best", best).join(
        turns.withColumnRenamed("conv", "c"), _same(F.col("conv"), F.col("c"))
    )
    solved = stage(
        solved.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit"), "repair-solved"
    )

    # The audit comes first, then the rows in order: one pass in which nothing piles up.
    lines = numbered.select("conv", F.lit(1).alias("k"), "part", "place", "role", "text").unionByName(
        solved.select("conv", F.lit(0).alias("k"), F.lit(0).alias("part"), F.lit(0).alias("place"), F.lit("").alias("role"),
                      F.col("audit").alias("text"))
    )
    fields = [("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
    fields = fields if messages else [("repaired_sha256", pa.string())]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, conv, repaired, digest, place = None, [], None, None, Digest(), 0

        def add(lines: Iterator[tuple[str, str]]) -> None:
            nonlocal place
            if not messages:
                digest.add(lines)
                return
            for line in lines:
                out.append((conv, place, *line))
                place += 1

        for batch in batches:
            schema = schema or _arrow(batch.schema.field(0).type, *fields)
            for own, k, _, _, role, text in _columns(iter([batch])):
                if k == 0:
                    if repaired:
                        add(repaired.inserted())
                        if not messages:
                            out.append((conv, digest.hex()))
                    conv, repaired, digest, place = own, Repaired(text), Digest(), 0
                else:
                    add(repaired.lines(role, text))
            if out:
                yield _batch(out, schema)
                out.clear()
        if repaired:
            add(repaired.inserted())
            if not messages:
                out.append((conv, digest.hex()))
        if out:
            yield _batch(out, schema)

    made = "place long, role string, text string" if messages else "repaired_sha256 string"
    stream = lines.repartition("conv").sortWithinPartitions("conv", "k", "part", "place")
    written = stream.mapInArrow(write, f"conv {kind}, {made}")
    if messages:
        return written
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return solved.join(written.withColumnRenamed("conv", "c"), _same(F.col("conv"), F.col("c"))).select(
        *names, "repaired_sha256"
    )


def repair(
    rows: DataFrame,
    conv: str,
    turn: str,
    role: str,
    text: str,
    *,
    segment: int = SEGMENT,
    messages: bool = False,
) -> DataFrame:
    """One row for each conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256); with ``messages`` its repaired rows (conv, place, role, text) instead.

    Rows are taken by turn (nulls first), those of one turn by role and text. Null roles and texts count
    as one space; a null id is a conversation of its own. An optional column ``__dropped`` marks rows
    that only name their conversation; one without other rows has zeros, an empty audit and the digest of
    an empty text. Repeated rows are duplicates, an empty table gives no rows, other columns are ignored.
    Conversations of more than ``segment`` rows take a way on which no task needs more than ``segment`` of them at once.
    """
    rows = ordered(rows, conv, turn, role, text)
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n")).where(F.col("n") > segment)
    long = stage(sizes.select(F.col("conv").alias("c")), "repair-long")
    if long.isEmpty():
        return _few_rows(rows, messages)
    same = _same(F.col("conv"), F.col("c"))
    few = _few_rows(rows.join(long, same, "left_anti"), messages)
    return few.unionByName(_many_rows(rows.join(long, same, "left_semi"), segment, messages))


def damage(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``rows`` (these four columns and ``__dropped``) with faults that crc32 of ``conv:turn`` modulo 20 chooses.

    0 drops the row, 1 empties its text, 2 takes away its sentence ends, 3 repeats it, 4 makes it a
    user's. Nulls are read as one space, but a null turn or conversation stays null.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space)
    )
    rows = rows.select(
        conv, turn, F.coalesce(F.col(role), space).alias(role), F.coalesce(F.col(text), space).alias(text),
        (F.crc32(key.cast("binary")) % 20).alias("__what"),
    )
    what = F.col("__what")
    twice = F.explode(F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        conv,
        turn,
        F.when(what == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(what == 1, "").when(what == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text)).alias(text),
        (what == 0).alias("__dropped"),
        twice.alias("__copy"),
    ).drop("__copy")
