"""Repair of conversations by weighted parsing of their turns over intervals.

A repaired conversation has roles whose initials spell `(s?(ua)+)?`. The repair grammar is in Chomsky normal form: its
nonterminals X[p,q] derive what takes the automaton of that language from state p to state q, its binary rules are
X[p,q] -> X[p,r] X[r,q], and its terminals are single rows under an edit:

    Keep      the row with its own role                              0
    Rerole    the row as user or as assistant                        3
    Delete    no row, in any state                                   4, the only edit of blank and repeated rows
    Insert    a user or assistant row without text, anywhere         3
    a truncated row that is not deleted                              3 more

Inserts are closed over beforehand: each row's cells hold all inserts in front of it, and the end of a conversation
those behind its last row. A cell of an interval is the least (cost, audit), the audit being the initials of the edits in
order; equal costs go to the audit that comes first in ASCII. Intervals are combined bottom-up by length. As every
interval of this grammar can be cut anywhere with the same outcome, one cut each is enough: lengths double. Cells that
end with a row never hold an audit that begins another one of the same cost, so comparing parts is comparing wholes.

A conversation's rows stand by turn, nulls first, and rows of one turn by their SHA-256 of role and text. A fault is the
first that holds of: blank, without a character but white space; duplicate, with the role and text of an earlier row;
truncated, with a last character other than white space that is no full stop, exclamation or question mark.

Scale: rows are cut into blocks of turns, turns with very many rows by the hash as well, so that no task takes more than
a block to parse; the blocks of a conversation then meet as a few cells each. Rows with their texts pass once more, in
order, to be hashed; they are never held. Rows equal in all four columns are counted once and given back as often.

Null values of any column are one space here, but a null turn has no place in counts of gaps and a null conversation is
a conversation. A role without a character cannot be kept. Columns besides the four named are ignored, whatever they are
called. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: Moves of the automaton; it begins in 0 and may end in 0 or 3.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, ENDS = range(4), (0, 3)
WRITTEN = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
#: Turns of a block, and rows from which one turn is cut up further.
TURNS, ROWS = 64, 4096

Cells = dict[tuple[int, int], tuple[int, str]]


def _closure() -> Cells:
    """The least inserts that lead from one state to another; going round adds to the cost and changes nothing."""
    best: Cells = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, r), (cost, audit) in list(best.items()):
            for (at, role), q in MOVES.items():
                if at == r and role in WRITTEN:
                    best[p, q] = min(best.get((p, q), (1 << 60, "")), (cost + INSERT, audit + "I"))
    return best


INSERTED = _closure()


def terminal(initial: str, blank: bool, duplicate: bool, truncated: bool) -> Cells:
    """The cells of one row, with the inserts in front of it."""
    row: Cells = {(p, p): (DELETE, "D") for p in STATES}
    if not blank and not duplicate:
        more = CUT_OFF if truncated else 0
        for (p, role), q in MOVES.items():
            edits = [(KEEP + more, "K")] * (role == initial) + [(REROLE + more, "R")] * (role in WRITTEN)
            for edit in edits:
                row[p, q] = min(row.get((p, q), edit), edit)
    return joined(INSERTED, row)


def joined(left: Cells, right: Cells) -> Cells:
    """The cells of an interval from those of its two parts."""
    out: Cells = {}
    for (p, r), (c, x) in left.items():
        for (r2, q), (d, y) in right.items():
            if r == r2:
                new = (c + d, x + y)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def parsed(rows: list[Cells]) -> Cells:
    """The cells of all rows together: intervals of one row, then twice as long ones, and so on."""
    while len(rows) > 1:
        rows = [joined(*rows[i : i + 2]) if i + 1 < len(rows) else rows[i] for i in range(0, len(rows), 2)]
    return rows[0] if rows else {(p, p): (0, "") for p in STATES}


def best_path(blocks: list[Cells]) -> tuple[int, list[tuple[int, str]]]:
    """The least cost of a whole conversation, and of each block the state it begins in and its audit; inserts behind all come last."""
    at = {0: (0, 0)}  # state -> (cost, place of its audit so far among the states')
    back: list[dict[int, tuple[int, str]]] = []
    for cells in [*blocks, {(p, q): v for (p, q), v in INSERTED.items() if q in ENDS}]:
        found: dict[int, tuple[int, int, str, int]] = {}
        for (p, q), (cost, audit) in cells.items():
            if p in at:
                new = (at[p][0] + cost, at[p][1], audit, p)
                if q not in found or new < found[q]:
                    found[q] = new
        order = sorted({v[1:3] for v in found.values()})
        at = {q: (v[0], order.index(v[1:3])) for q, v in found.items()}
        back.append({q: (v[3], v[2]) for q, v in found.items()})
    q = min(at, key=lambda s: at[s])
    cost, path = at[q][0], []
    for step in reversed(back):
        q, audit = step[q]
        path.append((q, audit))
    return cost, path[::-1]


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(rows: DataFrame, *, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, copies) under the planned damage, by crc32 of `conv:turn` modulo 20; dropped rows have no copies."""
    kind = F.crc32(F.concat(_text(conv), F.lit(":"), _text(turn)).cast("binary")) % 20
    body = F.when(kind == 1, "").when(kind == 2, F.translate(_text(text), ".!?", "")).otherwise(_text(text))
    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(_text(role)).alias("role"),
        body.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _blocked(rows: DataFrame) -> DataFrame:
    """The rows with `b1`, `b2`, `b3`: blocks in the order of turns, and of hashes where turns are cut up."""
    b1 = F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-(1 << 62)).cast("long"))
    rows = rows.withColumn("b1", b1)
    full = rows.groupBy("conv", "b1").agg(F.count("*").alias("rows")).where(F.col("rows") > ROWS)
    full = full.select(F.col("conv").alias("c"), F.col("b1").alias("b"), F.ceil(F.log2(F.col("rows") / ROWS)).cast("int").alias("bits"))
    both = rows.join(full, F.col("conv").eqNullSafe(F.col("c")) & (F.col("b1") == F.col("b")), "left")
    head = F.conv(F.substring("same", 1, 7), 16, 10).cast("long")  # 28 bits of the hash
    cut = F.col("bits").isNotNull()
    return both.withColumns({
        "b2": F.when(cut, F.coalesce("turn", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")),
        "b3": F.when(cut, F.floor(head / F.pow(F.lit(2.0), 28 - F.col("bits")))).otherwise(F.lit(0).cast("long")),
    }).drop("c", "b", "bits")


BLOCK = ["b1", "b2", "b3"]
PARSED = (
    "start array<int>, end array<int>, cost array<long>, audit array<string>, n_rows long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, first_turn long, last_turn long, n_turns long"
)


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows that agree in their first columns, which arrive together; a run's rows are read as they come."""

    def rows() -> Iterator[tuple[tuple, dict]]:
        for batch in batches:
            for row in batch.to_pylist():
                yield tuple(row.values())[:n_keys], row

    source = rows()
    head = next(source, None)
    while head is not None:
        key = head[0]

        def run(first=head, key=key):
            nonlocal head
            head = first
            while head is not None and head[0] == key:
                yield head[1]
                head = next(source, None)

        each = run()
        yield key, each
        for _ in each:  # what was left unread
            pass


def _out(rows: Iterator[dict], schema: pa.Schema, step: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == step:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(kind: str) -> pa.DataType:
    return pa.list_(_arrow(kind[6:-1])) if kind.startswith("array<") else {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}[kind]


def _schema(keys: pa.Schema, rest: str) -> pa.Schema:
    return pa.schema([*keys, *[pa.field(n, _arrow(k)) for n, k in (c.split() for c in rest.split(", "))]])


def _parse_block(key: tuple, rows: Iterator[dict]) -> dict:
    spans, n = [], dict.fromkeys(("n_rows", "blank", "duplicate", "truncated", "illegal", "n_turns"), 0)
    first = last = first_turn = last_turn = None
    for r in rows:
        for i in range(r["copies"]):
            again = r["seen"] or i > 0
            fault = "blank" if r["blank"] else "duplicate" if again else "truncated" if r["cut_off"] else None
            if fault:
                n[fault] += 1
            spans.append(terminal_of(r["initial"], fault))
            n["n_rows"] += 1
            n["illegal"] += last is not None and last + r["initial"] not in LEGAL
            first, last = r["initial"] if first is None else first, r["initial"]
            if r["turn"] is not None and r["turn"] != last_turn:
                n["n_turns"] += 1
                first_turn, last_turn = r["turn"] if first_turn is None else first_turn, r["turn"]
    cells = sorted(parsed(spans).items())
    return n | {
        "start": [p for (p, _), _ in cells], "end": [q for (_, q), _ in cells], "cost": [c for _, (c, _) in cells], "audit": [a for _, (_, a) in cells],
        "first": first, "last": last, "first_turn": first_turn, "last_turn": last_turn,
    }


_TERMINALS: dict[tuple, Cells] = {}


def terminal_of(initial: str, fault: str | None) -> Cells:
    key = (initial if initial in ("s", "u", "a") else "", fault)
    if key not in _TERMINALS:
        _TERMINALS[key] = terminal(key[0], fault == "blank", fault == "duplicate", fault == "truncated")
    return _TERMINALS[key]


JOINED = (
    "b1 long, b2 long, b3 long, state int, piece string, final boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def _join_blocks(key: tuple, rows: Iterator[dict]) -> Iterator[dict]:
    """One row a block: the state it begins in and its part of the audit; the last row has the conversation's counts."""
    blocks, at, n = [], [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    last = low = high = None
    turns = 0
    for r in rows:
        blocks.append(dict(zip(zip(r["start"], r["end"], strict=True), zip(r["cost"], r["audit"], strict=True), strict=True)))
        at.append([r[b] for b in BLOCK])
        for k in n:
            n[k] += r[k]
        if r["n_rows"]:
            n["illegal"] += last is not None and last + r["first"] not in LEGAL
            last = r["last"]
        if r["n_turns"]:
            turns += r["n_turns"] - (high == r["first_turn"])
            low, high = r["first_turn"] if low is None else low, r["last_turn"]
    empty = last is None
    cost, path = best_path(blocks)
    for block, (state, piece) in zip(at, path, strict=False):
        yield dict(zip(BLOCK, block, strict=True)) | {"state": state, "piece": piece, "final": False}
    audit = "" if empty else "".join(piece for _, piece in path)
    end = dict.fromkeys(BLOCK, (1 << 62)) | {"state": path[-1][0], "piece": "" if empty else path[-1][1], "final": True}
    yield end | n | {"gaps": 0 if low is None else high - low + 1 - turns, "cost": 0 if empty else cost, "audit": audit}


REPAIRED = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _hash_rows(key: tuple, rows: Iterator[dict]) -> dict:
    """The digest of the repaired rows as they pass; a block's piece of the audit stands in front of its rows."""
    told, state, piece, place, any_line = hashlib.sha256(), 0, "", 0, False

    def line(role: str, text: str) -> None:
        nonlocal any_line
        told.update((b"\n" if any_line else b"") + f"{role}:{text}".encode())
        any_line = True

    def inserts() -> None:
        nonlocal state, place
        while place < len(piece) and piece[place] == "I":
            state = written_by(state)[1]
            line(WRITTEN[role_in(state)], "")
            place += 1

    for r in rows:
        if r["piece"] is not None:
            piece, place, state = r["piece"], 0, r["state"]
            if r["final"]:
                inserts()
                return {k: r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")} | {"repaired_sha256": told.hexdigest()}
            continue
        for _ in range(r["copies"]):
            inserts()
            edit, place = piece[place], place + 1
            if edit == "K":
                state = MOVES[state, r["role"][0]]
                line(r["role"], r["text"])
            elif edit == "R":
                state = written_by(state)[1]
                line(WRITTEN[role_in(state)], r["text"])
    raise ValueError("a conversation without an end")


def written_by(state: int) -> tuple[str, int]:
    """The only user or assistant move out of a state."""
    return next((role, q) for (p, role), q in MOVES.items() if p == state and role in WRITTEN)


def role_in(state: int) -> str:
    """The role that leads into a state."""
    return next(role for (_, role), q in MOVES.items() if q == state and role in WRITTEN)


def repair(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    whole = damaged(rows, conv=conv, turn=turn, role=role, text=text)
    whole = whole.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    solid = r"[^\x20\x09-\x0D]"
    narrow = whole.select(
        "conv", "turn", "same", "copies", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(solid)).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut_off"),
    )
    facts = ["initial", "blank", "cut_off"]
    narrow = narrow.groupBy("conv", "turn", "same", *facts).agg(F.sum("copies").alias("copies"))
    there = F.when(F.col("copies") > 0, F.struct(F.col("turn").isNotNull().alias("given"), "turn"))
    first = narrow.groupBy("conv", "same").agg(F.min(there).alias("first")).select(F.col("conv").alias("c"), F.col("same").alias("s"), "first")
    narrow = narrow.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("same") == F.col("s")))
    seen = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    narrow = _blocked(narrow.select("conv", "turn", "same", *facts, "copies", F.coalesce(seen, F.lit(False)).alias("seen")))

    key = pa.schema([pa.field("conv", spark_arrow(rows, conv))])
    kind = rows.select(F.col(conv)).schema[0].dataType.simpleString()
    blocks = pa.schema([*key, *[pa.field(b, pa.int64()) for b in BLOCK]])
    of_block, of_join, of_end = _schema(blocks, PARSED), _schema(key, JOINED), _schema(key, REPAIRED)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (dict(zip(("conv", *BLOCK), k, strict=True)) | _parse_block(k, each) for k, each in _groups(batches, 4))
        return _out(found, of_block)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _out(({"conv": k[0]} | row for k, each in _groups(batches, 1) for row in _join_blocks(k, each)), of_join)

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _out(({"conv": k[0]} | _hash_rows(k, each) for k, each in _groups(batches, 1)), of_end)

    by = ["conv", *BLOCK]
    dealt = narrow.select(*by, "turn", "same", *facts, "copies", "seen").repartition(*by)
    cells = dealt.sortWithinPartitions(*by, "turn", "same").mapInArrow(parse, f"conv {kind}, b1 long, b2 long, b3 long, {PARSED}")
    path = cells.repartition("conv").sortWithinPartitions(*by).mapInArrow(meet, f"conv {kind}, {JOINED}")

    # every row once more, with its text, behind its block's piece
    place = narrow.select("conv", "turn", "same", *BLOCK)
    p = place.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("same").alias("s"), *BLOCK)
    kept_rows = whole.where("copies > 0").join(p, F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("same") == F.col("s")))
    lines = kept_rows.select("conv", *BLOCK, F.lit(1).alias("side"), "turn", "same", "role", "text", "copies")
    both = path.withColumn("side", F.lit(0)).unionByName(lines, allowMissingColumns=True)
    order = [*by, "side", "turn", "same"]
    done = both.select(*order, *[c for c in both.columns if c not in order]).repartition("conv").sortWithinPartitions(*order)
    return done.mapInArrow(end, f"conv {kind}, {REPAIRED}").withColumnRenamed("conv", conv)


def spark_arrow(rows: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.select(F.col(name)).schema[0].dataType)
