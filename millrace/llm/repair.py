"""Conversation structure repair by Knuth's algorithm for lightest derivations.

Each row of a conversation is kept, given another role or deleted, and rows may be inserted, so that the
roles read: perhaps system first, then user and assistant in turn, or nothing at all. An item says that the
rows up to a place are repaired and which role came last. A deduction leads from an item and the next row,
or from an item alone for an insertion, to a further item. Its weight is (cost, audit): deductions add a
cost and append the edit's initial. That never makes a weight smaller and keeps the order of two weights of
one item (cost is a function of the rows and the audit, so of two audits of equal cost none begins with the
other), which is what the algorithm asks for: items leave the agenda in the order of their weight, final
when they do, until a goal item has left.

A long conversation is cut into fragments, which tasks solve each by itself from every role that may come
before; one task then only strings the fragments' derivations together, by the same algorithm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import column
from millrace.workspace import broadcast_if_small, written

# A fragment has at most so many rows, and ends with the row that brings its texts to so many code points.
FRAGMENT_ROWS, FRAGMENT_CHARS = 256, 1 << 20
# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Fixed value: the white space of the contract.
SPACE = " \t\n\x0b\x0c\r"
# What came last: nothing, system, user or assistant. The roles may end with nothing or an assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (NOTHING, ASSISTANT)
# Faults of a row; the first that applies counts.
NONE, BLANK, DUPLICATE, CUT_OFF = range(4)

Weight = tuple[int, str]


def lightest(
    axioms: Iterable[tuple[Weight, object]],
    deduce: Callable[[object, Weight], Iterable[tuple[Weight, object]]],
    goals: Iterable[object],
    first: bool = True,
) -> dict[object, Weight]:
    """Weights of the items that were final when a goal was (with ``first``), or all goals that can be."""
    final: dict[object, Weight] = {}
    wanted = set(goals)
    agenda: list[tuple[Weight, object]] = []
    for entry in axioms:
        heappush(agenda, entry)
    while agenda and wanted:
        weight, item = heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        if item in wanted:
            if first:
                break
            wanted.remove(item)
        for conclusion in deduce(item, weight):
            if conclusion[1] not in final:
                heappush(agenda, conclusion)
    return final


def _next(last: int) -> int:
    """The role that an inserted row or a new role has after ``last``."""
    return ASSISTANT if last == USER else USER


def _kept(role: str, last: int) -> int | None:
    """What comes last when a row of ``role`` stays as it is, if it may."""
    match role[:1]:
        case "s":
            return SYSTEM if last == NOTHING else None
        case "u":
            return USER if last != USER else None
        case "a":
            return ASSISTANT if last == USER else None
    return None


Row = tuple[str, str, int]  # role, text, fault


def row_deductions(rows: list[Row]) -> Callable[[tuple[int, int], Weight], Iterator[tuple[Weight, tuple[int, int]]]]:
    """Deductions from items (number of rows repaired, role that came last)."""

    def deduce(item: tuple[int, int], weight: Weight) -> Iterator[tuple[Weight, tuple[int, int]]]:
        (at, last), (cost, audit) = item, weight
        yield (cost + INSERT, audit + "I"), (at, _next(last))
        if at == len(rows):
            return
        role, _, fault = rows[at]
        yield (cost + DELETE, audit + "D"), (at + 1, last)
        if fault in (BLANK, DUPLICATE):
            return
        extra = TRUNCATED if fault == CUT_OFF else 0
        yield (cost + REROLE + extra, audit + "R"), (at + 1, _next(last))
        if (kept := _kept(role, last)) is not None:
            yield (cost + extra, audit + "K"), (at + 1, kept)

    return deduce


def repaired_rows(rows: list[Row], audit: str, last: int = NOTHING) -> tuple[list[tuple[str, str]], int]:
    """Roles and texts that the edits of ``audit`` leave, and the role that comes last."""
    out, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text, _ = rows[at]
            last = _kept(role, last)
        else:
            last = _next(last)
            role, text = ("assistant" if last == ASSISTANT else "user"), "" if edit == "I" else rows[at][1]
        at += edit != "I"
        out.append((role, text))
    return out, last


@dataclass
class Summary:
    """What is counted over the rows of a conversation, or of consecutive parts of it."""

    faults: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    illegal: int = 0
    n_turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    def add(self, other: Summary) -> None:
        self.faults = [a + b for a, b in zip(self.faults, other.faults, strict=True)]
        self.illegal += other.illegal
        if self.last_role is not None and other.first_role is not None:
            self.illegal += self.last_role + other.first_role not in ("su", "ua", "au")
        self.first_role = other.first_role if self.first_role is None else self.first_role
        self.last_role = self.last_role if other.last_role is None else other.last_role
        self.n_turns += other.n_turns - (self.last_turn is not None and self.last_turn == other.first_turn)
        self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
        self.last_turn = self.last_turn if other.last_turn is None else other.last_turn

    def row(self, turn: int | None, role: str, fault: int) -> None:
        faults = [0, 0, 0, 0]
        faults[fault] = 1
        initial = role[:1]
        self.add(Summary(faults, 0, int(turn is not None), turn, turn, initial, initial))

    def gaps(self) -> int:
        if self.first_turn is None:
            return 0
        return min((1 << 63) - 1, self.last_turn - self.first_turn + 1 - self.n_turns)


def derivations(rows: list[Row]) -> list[tuple[int, int, int, str]]:
    """Start, end, cost and audit of the lightest derivation of all rows between any two roles."""
    out = []
    for start in range(4):
        goals = [(len(rows), end) for end in range(4)]
        final = lightest([((0, ""), (0, start))], row_deductions(rows), goals, first=False)
        out.extend((start, end, *final[len(rows), end]) for end in range(4) if (len(rows), end) in final)
    return out


class Repaired:
    """A conversation repaired as far as it was read: by the role that came last, the weight, the digest of the
    rows that were left and, if wanted, these rows."""

    def __init__(self, with_rows: bool) -> None:
        self.summary = Summary()
        self.weights: dict[int, Weight] = {NOTHING: (0, "")}
        self.digests = {NOTHING: sha256()}
        self.begun = {NOTHING: False}
        self.rows: dict[int, list[tuple[str, str]]] | None = {NOTHING: []} if with_rows else None

    def extend(self, rows: list[Row], edges: list[tuple[int, int, int, str]], summary: Summary) -> None:
        """Go on with a fragment. An item (0, last) and an edge give an item (1, last)."""
        self.summary.add(summary)

        def deduce(item, weight):
            at, last = item
            for start, end, cost, audit in edges if at == 0 else ():
                if start == last:
                    yield (weight[0] + cost, weight[1] + audit), (1, end)

        axioms = [(weight, (0, last)) for last, weight in self.weights.items()]
        final = lightest(axioms, deduce, [(1, end) for end in range(4)], first=False)
        weights, digests, begun, kept = {}, {}, {}, {}
        for (at, end), weight in final.items():
            if at == 0:
                continue
            start, audit = next(
                (s, audit)
                for s, e, cost, audit in edges
                if e == end
                and s in self.weights
                and (self.weights[s][0] + cost, self.weights[s][1] + audit) == weight
            )
            left, _ = repaired_rows(rows, audit, start)
            digest = self.digests[start].copy()
            for number, (role, text) in enumerate(left):
                digest.update((("\n" if number or self.begun[start] else "") + f"{role}:{text}").encode())
            weights[end], digests[end], begun[end] = weight, digest, self.begun[start] or bool(left)
            if self.rows is not None:
                kept[end] = self.rows[start] + left
        self.weights, self.digests, self.begun = weights, digests, begun
        if self.rows is not None:
            self.rows = kept

    def report(self) -> dict:
        weight, end = min((self.weights[end], end) for end in ENDS if end in self.weights)
        return _report(self.summary, weight, self.digests[end].hexdigest(), self.rows[end] if self.rows is not None else None)


def _report(summary: Summary, weight: Weight, digest: str, rows: list[tuple[str, str]] | None) -> dict:
    return {
        "gaps": summary.gaps(),
        "blank": summary.faults[BLANK],
        "duplicate": summary.faults[DUPLICATE],
        "truncated": summary.faults[CUT_OFF],
        "illegal": summary.illegal,
        "cost": weight[0],
        "audit": weight[1],
        "repaired_sha256": digest,
        "repaired": None if rows is None else [{"role": role, "text": text} for role, text in rows],
    }


def whole(rows: list[Row], summary: Summary, with_rows: bool) -> dict:
    """The report of a conversation that is one fragment."""
    final = lightest([((0, ""), (0, NOTHING))], row_deductions(rows), [(len(rows), end) for end in ENDS])
    weight = min(final[len(rows), end] for end in ENDS if (len(rows), end) in final)
    left, _ = repaired_rows(rows, weight[1])
    digest = sha256("\n".join(f"{role}:{text}" for role, text in left).encode()).hexdigest()
    return _report(summary, weight, digest, left if with_rows else None)


_REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string, repaired array<struct<role:string,text:string>>"
)
_SUMMARY = (
    "struct<faults:array<bigint>,illegal:bigint,n_turns:bigint,first_turn:bigint,last_turn:bigint,"
    "first_role:string,last_role:string>"
)
_FRAGMENT = (
    f"part int, number bigint, summary {_SUMMARY}, edges array<struct<s:int,e:int,cost:bigint,audit:string>>, "
    "rows array<struct<role:string,text:string,fault:int>>"
)


def _batches(found: Iterator[dict], schema: pa.Schema, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about ``most`` code points."""
    held, size = [], 0
    for row in found:
        held.append(row)
        size += 200 + len(row.get("audit") or "") + sum(len(r["text"]) + 50 for r in row.get("rows") or row.get("repaired") or ())
        if size > most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _fault(text: str, repeated: bool) -> int:
    stripped = text.rstrip(SPACE)
    if not stripped:
        return BLANK
    if repeated:
        return DUPLICATE
    return NONE if stripped[-1] in ".!?" else CUT_OFF


def _fragments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bool, list[Row], Summary]]:
    """Sorted rows as fragments: conversation, whether the conversation ends in this task, rows and summary."""
    own, rows, summary, size = None, [], Summary(), 0
    started = False
    for batch in batches:
        for conv, turn, role, text, times, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if started and conv != own:
                yield own, True, rows, summary
                rows, summary, size = [], Summary(), 0
            own, started = conv, True
            for copy in range(times):
                if len(rows) >= FRAGMENT_ROWS or size >= FRAGMENT_CHARS:
                    yield own, False, rows, summary
                    rows, summary, size = [], Summary(), 0
                fault = _fault(text, repeated or copy > 0)
                rows.append((role, text, fault))
                summary.row(turn, role, fault)
                size += len(text)
    if started:
        yield own, False, rows, summary


def repair(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    times: str | None = None,
    with_rows: bool = True,
) -> DataFrame:
    """One row per conversation: what is wrong with its rows, the cheapest repair, and what that leaves.

    Rows are taken by turn, null turns first, those of one turn by role and text. A row's first fault counts:
    blank (nothing but white space), duplicate (role and text occurred before) or truncated (does not end with
    one of ``.!?``). ``gaps`` is how many turns lack between the least and the largest, ``illegal`` how many
    neighbours' role initials are none of su, ua, au. ``cost`` and ``audit`` are those of the cheapest edits
    (the least audit, if several cost the same), with which the initials read ``(s?(ua)+)?``: Keep 0, Rerole 2,
    Delete 3 (blank and duplicate rows must go), Insert 2, and 1 for a truncated row that stays.
    ``repaired_sha256`` is of the repaired lines ``role:text``, ``repaired`` (with ``with_rows``) the rows themselves.

    A null role or text is one space, so such a row has another role or goes; an empty role is none of the
    initials. Null conversations are one conversation. ``times`` names a column that says how often a row occurs
    (null: once); a conversation whose rows all occur zero times has a report of zeros, and the digest of an
    empty text. An empty table gives an empty table. Other columns are ignored.
    """
    own = {
        "conv": column(conv).cast("bigint"),
        "turn": column(turn).cast("bigint"),
        "role": F.coalesce(column(role).cast("string"), F.lit(" ")),
        "text": F.coalesce(column(text).cast("string"), F.lit(" ")),
        "times": F.coalesce(column(times).cast("bigint"), F.lit(1)) if times else F.lit(1).cast("bigint"),
    }
    # Rows that do not occur stay once for their conversation, whatever they held.
    gone = F.col("times") <= 0
    rows = df.select(*[value.alias(name) for name, value in own.items()]).select(
        "conv",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").otherwise(F.col("role")).alias("role"),
        F.when(gone, "").otherwise(F.col("text")).alias("text"),
        F.greatest("times", F.lit(0)).alias("times"),
        gone.alias("gone"),
    )
    # Equal rows become one, however many there are, so ranges can tell all rows of a conversation apart.
    rows = written(
        rows.groupBy("conv", "turn", "role", "text", "gone").agg(F.sum("times").alias("times")), "conversation-rows"
    )
    marks = F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", "role")
    known, place = F.struct(*[m.alias(f"m{k}") for k, m in enumerate(marks)]), F.struct(F.col("turn").isNotNull().alias("n"), "turn")
    repeated = (
        rows.where(~F.col("gone"))
        .groupBy("conv", known.alias("mark"))
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .where("n > 1")
        .select(F.col("conv").alias("c"), "mark", "first")
    )
    repeated = broadcast_if_small(written(repeated, "repeated-rows"))
    flagged = (
        rows.withColumn("mark", known)
        .join(repeated.withColumnRenamed("mark", "m"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
        .select(
            "conv",
            "turn",
            "role",
            "text",
            "times",
            (~F.col("gone") & F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first"))).alias("repeated"),
        )
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role")]
    dealt = flagged.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    schema = T.StructType.fromDDL(f"conv bigint, {_REPORT}, {_FRAGMENT}")
    arrow = _arrow_schema(schema)

    def solve(batches):
        part = TaskContext.get().partitionId()

        def found():
            # The task's first and last conversation may go on in other tasks.
            number, before, edge = 0, None, True
            for conv, ended, lines, summary in _fragments(batches):
                if number and conv != before:
                    edge = False
                opened = edge or not ended or (number and conv == before)
                number, before = number + 1, conv
                if not opened:
                    yield {"conv": conv, **whole(lines, summary, with_rows)}
                    continue
                yield {
                    "conv": conv,
                    "part": part,
                    "number": number,
                    "summary": summary.__dict__,
                    "edges": [dict(zip(("s", "e", "cost", "audit"), e, strict=True)) for e in derivations(lines)],
                    "rows": [dict(zip(("role", "text", "fault"), r, strict=True)) for r in lines],
                }

        yield from _batches(found(), arrow)

    solved = written(dealt.mapInArrow(solve, schema), "conversations-solved")
    names = ["conv", *T.StructType.fromDDL(_REPORT).names]
    done = solved.where("number IS NULL").select(*names)
    report = T.StructType.fromDDL(f"conv bigint, {_REPORT}")
    report_arrow = _arrow_schema(report)

    def string_together(batches):
        def found():
            before, state = None, None
            for batch in batches:
                # A fragment at a time, as its rows may be long.
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    if state is None or row["conv"] != before:
                        if state is not None:
                            yield {"conv": before, **state.report()}
                        before, state = row["conv"], Repaired(with_rows)
                    lines = [(r["role"], r["text"], r["fault"]) for r in row["rows"]]
                    edges = [(e["s"], e["e"], e["cost"], e["audit"]) for e in row["edges"]]
                    state.extend(lines, edges, Summary(**row["summary"]))
            if state is not None:
                yield {"conv": before, **state.report()}

        yield from _batches(found(), report_arrow)

    fragments = solved.where("number IS NOT NULL").select("conv", *T.StructType.fromDDL(_FRAGMENT).names)
    joined = (
        fragments.repartition("conv").sortWithinPartitions("conv", "part", "number").mapInArrow(string_together, report)
    )
    out = done.unionByName(joined).withColumnRenamed("conv", conv)
    return out if with_rows else out.drop("repaired")


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``df`` with rows damaged by the CRC-32 of ``conv:turn`` (nulls: one space) modulo 20, and ``times``.

    0: the row occurs zero times, 1: its text is empty, 2: its text loses ``.!?``, 3: it occurs twice,
    4: its role is user. Null roles and texts become one space. Other columns are kept; ``times`` is replaced.
    """
    parts = [F.coalesce(column(name).cast("string"), F.lit(" ")) for name in (conv, turn)]
    kind = F.crc32(F.concat(parts[0], F.lit(":"), parts[1])) % 20
    words = F.coalesce(column(text), F.lit(" "))
    return df.withColumns(
        {
            "times": F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint"),
            text: F.when(kind == 1, "").when(kind == 2, F.translate(words, ".!?", "")).otherwise(words),
            role: F.when(kind == 4, "user").otherwise(F.coalesce(column(role), F.lit(" "))),
        }
    )
