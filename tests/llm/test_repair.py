"""Conversation repair against enumeration of all edits and a plain table."""

import random
import re
import zlib
from hashlib import sha256
from itertools import product

import pytest

from millrace.llm import repair

SPACE = " \t\n\x0b\x0c\r"


def outcome(rows, edits, inserts):
    """Cost, audit and repaired rows of one edit per row, with inserts before each row and at the end."""
    cost, audit, out = 0, "", []
    for at in range(len(rows) + 1):
        for role in inserts[at]:
            cost, audit = cost + 2, audit + "I"
            out.append((role, ""))
        if at == len(rows):
            break
        role, text, fault = rows[at]
        edit, new = edits[at]
        if edit == "D":
            cost, audit = cost + 3, audit + "D"
            continue
        if fault in (repair.BLANK, repair.DUPLICATE):
            return None
        cost += (fault == repair.CUT_OFF) + (2 if edit == "R" else 0)
        audit += edit
        out.append((new if edit == "R" else role, text))
    if not re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "?" for role, _ in out)):
        return None
    return cost, audit, out


def enumerated(rows):
    """The cheapest of all edits with up to two inserts at a place."""
    edits = [("K", None), ("D", None), ("R", "user"), ("R", "assistant")]
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    found = (
        outcome(rows, chosen, put)
        for chosen in product(edits, repeat=len(rows))
        for put in product(inserts, repeat=len(rows) + 1)
    )
    return min((x for x in found if x is not None), key=lambda x: x[:2])


def plain_repair(rows):
    """Row by row, the least (cost, audit) by what came last."""

    def following(last):
        return "a" if last == "u" else "u"

    states = {"": (0, "")}
    for at in range(len(rows) + 1):
        for _ in range(3):
            for last, (cost, audit) in list(states.items()):
                new = (cost + 2, audit + "I")
                states[following(last)] = min(states.get(following(last), new), new)
        if at == len(rows):
            break
        role, _, fault = rows[at]
        after = {}
        for last, (cost, audit) in states.items():
            options = [(last, cost + 3, "D")]
            if fault not in (repair.BLANK, repair.DUPLICATE):
                extra = int(fault == repair.CUT_OFF)
                options.append((following(last), cost + 2 + extra, "R"))
                if role[:1] == following(last) or (role[:1] == "s" and last == ""):
                    options.append((role[:1], cost + extra, "K"))
            for new, total, edit in options:
                weight = (total, audit + edit)
                after[new] = min(after.get(new, weight), weight)
        states = after
    cost, audit = min(states[last] for last in ("", "a") if last in states)
    out, last, at = [], "", 0
    for edit in audit:
        if edit != "D":
            text = "" if edit == "I" else rows[at][1]
            last = rows[at][0][:1] if edit == "K" else following(last)
            out.append((rows[at][0] if edit == "K" else {"u": "user", "a": "assistant"}[last], text))
        at += edit != "I"
    return cost, audit, out


ROLES = ["system", "user", "assistant", "tool", "", " "]


def some_rows(rng, n):
    return [(rng.choice(ROLES), f"t{rng.randint(0, 9)}", rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_agenda_equals_enumeration_and_table():
    rng = random.Random(8)
    for n in [0, 0, 1, 1, 1, 2, 2, 2, 2, 3]:
        rows = some_rows(rng, n)
        assert plain_repair(rows) == enumerated(rows)
    for _ in range(300):
        rows = some_rows(rng, rng.randint(0, 30))
        report = repair.whole(rows, repair.Summary(), True)
        cost, audit, out = plain_repair(rows)
        assert (report["cost"], report["audit"]) == (cost, audit)
        assert [(r["role"], r["text"]) for r in report["repaired"]] == out
        assert report["repaired_sha256"] == sha256("\n".join(f"{a}:{b}" for a, b in out).encode()).hexdigest()


def test_items_leave_the_agenda_in_order():
    rows = some_rows(random.Random(1), 12)
    final = repair.lightest([((0, ""), (0, 0))], repair.row_deductions(rows), [(12, 0), (12, 3)])
    weights = list(final.values())
    assert weights == sorted(weights)


def test_fragments_strung_together_equal_the_whole():
    rng = random.Random(9)
    for _ in range(100):
        rows = some_rows(rng, rng.randint(1, 40))
        state, at = repair.Repaired(True), 0
        while at < len(rows):
            size = rng.randint(1, 7)
            part = rows[at : at + size]
            state.extend(part, repair.derivations(part), repair.Summary())
            at += size
        assert state.report() == repair.whole(rows, repair.Summary(), True)


def plain_report(table):
    """Reports by conversation of rows (conv, turn, role, text) after damage, as op13 has them."""
    out = {}
    for conv, *_ in table:
        out.setdefault(conv, [])
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    reports = []
    for conv, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in rows:
            if not text.strip(SPACE):
                fault = repair.BLANK
            elif (role, text) in seen:
                fault = repair.DUPLICATE
            else:
                fault = repair.NONE if text.rstrip(SPACE)[-1] in ".!?" else repair.CUT_OFF
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, left = plain_repair(marked)
        initials = [role[:1] for _, role, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        faults = [sum(f == kind for _, _, f in marked) for kind in (1, 2, 3)]
        digest = sha256("\n".join(f"{a}:{b}" for a, b in left).encode()).hexdigest()
        reports.append((conv, gaps, *faults, illegal, cost, audit, digest))
    return sorted(map(str, reports))


def conversations(rng, n):
    table = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, 12)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant"]) if rng.random() < 0.9 else rng.choice([*ROLES, None])
                text = rng.choice(["Yes.", "No", " ", "", "What? \n", None, "Fine!", "é ", "ok.\x1f"])
                table.append((conv, rng.choice([turn, turn, turn, None, 3 * turn]), role, text))
    table += [(7, turn // 3, ["user", "assistant"][turn % 2], f"text {turn % 50}.") for turn in range(300)]
    table += [(8, 5, "user", "again and again")] * 60
    dropped = next(t for t in range(1000) if zlib.crc32(f"999:{t}".encode()) % 20 == 0)
    return [*table, (999, dropped, "user", "gone")]


@pytest.mark.parametrize("fragment", [256, 4])
def test_repair_equals_plain(spark, settings, monkeypatch, fragment):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="6")
    batches, fragments = repair._batches, repair._fragments

    def small(batches_):
        # Workers import the module anew, so the limit travels with the function.
        repair.FRAGMENT_ROWS = fragment
        return fragments(batches_)

    monkeypatch.setattr(repair, "_fragments", small)
    table = conversations(random.Random(5), 40)
    df = spark.createDataFrame([(*row, "x") for row in table], "conv_id bigint, turn bigint, role string, text string, times string")
    found = repair.repair(repair.damage(df.repartition(3)), times="times", with_rows=False)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == names
    assert sorted(str(tuple(row)) for row in found.collect()) == plain_report(table)
    assert batches is repair._batches


def test_repair_returns_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There"), (2, 0, "assistant", "Yes."), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = {r.conv_id: r for r in repair.repair(df).collect()}
    assert (found[1].cost, found[1].audit) == (3, "KR") and found[1].truncated == 1
    assert [tuple(r) for r in found[1].repaired] == [("user", "Hi."), ("assistant", "There")]
    assert (found[2].cost, found[2].audit) == (2, "IK") and [tuple(r) for r in found[2].repaired][0] == ("user", "")
    assert (found[3].cost, found[3].audit, found[3].blank, found[3].repaired) == (3, "D", 1, [])
    assert found[3].repaired_sha256 == sha256(b"").hexdigest()


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert repair.repair(repair.damage(df), times="times").collect() == []
