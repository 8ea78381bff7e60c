"""Repair of conversations against plain Python: a chart of all intervals at all cuts, and all edits of short ones."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from obslake.llm import turn_repair as tr
from obslake.llm.registered import op13_turn_repair
from pyspark.sql import functions as F

ROW = st.tuples(st.sampled_from("suax"), st.sampled_from([None, "blank", "duplicate", "truncated"]))


def chart(rows):
    """The whole chart: every interval, every cut."""
    cells = {(i, i + 1): tr.terminal_of(*r) for i, r in enumerate(rows)}
    for n in range(2, len(rows) + 1):
        for i in range(len(rows) - n + 1):
            best = {}
            for k in range(i + 1, i + n):
                for key, v in tr.joined(cells[i, k], cells[k, i + n]).items():
                    best[key] = min(best.get(key, v), v)
            cells[i, i + n] = best
    return cells[0, len(rows)] if rows else {(p, p): (0, "") for p in tr.STATES}


def all_edits(rows):
    """Every sequence of edits with at most two inserts at a place."""
    best = None
    for inserts in itertools.product(["", "u", "a", "ua", "au", "uu"], repeat=len(rows) + 1):
        choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "u", "a"] for _, f in rows]
        for edits in itertools.product(*choices):
            roles, audit, cost = "", "", 0
            for put, edit, (initial, fault) in itertools.zip_longest(inserts, edits, rows, fillvalue=(None, None)):
                roles, audit, cost = roles + put, audit + "I" * len(put), cost + 3 * len(put)
                if initial is None:
                    continue
                if edit == "D":
                    audit, cost = audit + "D", cost + 4
                    continue
                roles, audit = roles + (initial if edit == "K" else edit), audit + ("K" if edit == "K" else "R")
                cost += 3 * (edit != "K") + 3 * (fault == "truncated")
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def whole(rows, size):
    blocks = [tr.parsed([tr.terminal_of(*r) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
    cost, path = tr.best_path(blocks)
    return cost, "".join(p for _, p in path)


@settings(max_examples=40, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_all_edits(rows):
    assert whole(rows, 2) == all_edits(rows)


@settings(max_examples=80, deadline=None)
@given(st.lists(ROW, max_size=14), st.integers(1, 5))
def test_one_cut_is_as_good_as_all(rows, size):
    assert tr.parsed([tr.terminal_of(*r) for r in rows]) == chart(rows)
    ends = [(c + d, x + y) for (p, q), (c, x) in chart(rows).items() if p == 0 for (r, e), (d, y) in tr.INSERTED.items() if r == q and e in tr.ENDS]
    assert whole(rows, size) == min(ends)


def brute(rows):
    by = defaultdict(list)
    space = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        out = by[conv]
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want = {}
    for conv, rs in by.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, told, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rs:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            told.append((role[:1] if role[:1] in "sua" else "", fault))
            if fault:
                n[fault] += 1
        turns = {t for t, *_ in rs if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:], strict=False))
        cost, audit = min(
            (c + d, x + y) for (p, q), (c, x) in chart(told).items() if p == 0 for (r, e), (d, y) in tr.INSERTED.items() if r == q and e in tr.ENDS
        )
        lines, state, i = [], "", 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else rs[i][1:]
            i += edit != "I"
            if edit == "D":
                continue
            role = role if edit == "K" else "assistant" if state == "u" else "user"
            state = role[:1]
            lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return want


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def odd_rows():
    long = [(50, t, ("user", "assistant")[t % 2], f"turn {t} of many." if t % 3 else "again and again") for t in range(150)]
    return [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So."), (1, None, "user", "No turn"),
        (2, 5, None, None), (2, 6, "user", ""), (None, None, None, "alone."), (None, 3, "assistant", "x" * 40_000 + "."),
        (3, 1, "user", "Same."), (3, 1, "user", "Same."), (3, 1, "assistant", "Other."), (3, 9, "user", "Same."),
        (4, 2, "moderator", "Stop."), (4, 2, "", "nobody."), *[(c, t, "user", "Hm?") for c in range(60, 100) for t in range(3)], *long,
    ]


def test_against_brute_force(spark, monkeypatch):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"b1": F.lit(1), "state": F.lit("x"), "conv": F.lit(2)})
    want = brute(rows)
    for most in (4096, 3):  # the second cuts turns up by hash
        monkeypatch.setattr(tr, "ROWS", most)
        monkeypatch.setattr(tr, "TURNS", 16)
        got = tr.repair(df)
        assert got.columns == COLUMNS
        assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_tables(spark, table):
    rows = [tuple(r) for r in spark.read.parquet(f"{table}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_turn_repair(spark, table)
    assert {t for c, t in got.dtypes if c not in ("audit", "repaired_sha256")} == {"bigint"}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == brute(rows)


def test_no_rows(spark):
    assert tr.repair(spark.createDataFrame([], "conv_id string, turn int, role string, text string")).count() == 0
