"""Cheapest repair of role order in conversations by weighted CYK interval parsing.

The repaired roles must follow s?(ua)+ or be empty. In the repair grammar a nonterminal PQ derives the edits that lead from state P to state Q
(0 start, 1 after s, 2 after u, 3 after a): PQ -> PR RQ for every R (Chomsky normal form), PQ -> edit for one row, and the insertion
closure, by which a gap derives as many insertions as lead from P to Q. A cell holds for each PQ the minimum (cost, audit).

Cells are combined bottom-up by span length. As every pair PR RQ is a rule, all splits of a span give the same cell, so of the spans only
those a binary tree needs are filled, and spans of one conversation can be parsed in different tasks: rows are dealt out by range, each
task parses its stretch of each conversation, and the cells of stretches are combined in order. Ties are safe to break inside cells: of two
audits of one cell with equal cost none begins the other, as the rest would be insertions, which cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from delaylake.llm.shared import col, cut

REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
STATES, FINAL = range(4), (0, 3)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}
BLANK, DUPLICATE, TRUNCATED, FINE = "b", "d", "t", "-"
SHORT = 8
Cell = dict[tuple[int, int], tuple[int, str]]


def product(x: Cell, y: Cell) -> Cell:
    """The binary rules: the cell of two spans side by side."""
    out: Cell = {}
    for (p, r), (c, a) in x.items():
        for q in STATES:
            if (r, q) in y:
                cost, audit = y[r, q]
                new = (c + cost, a + audit)
                if (p, q) not in out or new < out[p, q]:
                    out[p, q] = new
    return out


def closure() -> Cell:
    """The empty span: the fewest insertions that lead from one state to another."""
    out: Cell = {(p, p): (0, "") for p in STATES}
    for _ in STATES:
        for (p, r), (c, a) in list(out.items()):
            for role in ROLE:
                q = STEP.get((r, role))
                if q is not None and (c + INSERT, a + "I") < out.get((p, q), (c + INSERT + 1, "")):
                    out[p, q] = (c + INSERT, a + "I")
    return out


GAP = closure()


@lru_cache(maxsize=64)
def row_cell(code: str) -> Cell:
    """One row, a role's initial and a fault, with insertions on both sides."""
    role, fault = code
    out: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if fault not in (BLANK, DUPLICATE):
        extra = UNFINISHED if fault == TRUNCATED else 0
        for p in STATES:
            for to, cost, letter in [(role, 0, "K"), *((r, REROLE, "R") for r in ROLE)]:
                q = STEP.get((p, to))
                if q is not None and (cost + extra, letter) < out.get((p, q), (cost + extra + 1, "")):
                    out[p, q] = (cost + extra, letter)
    return product(product(GAP, out), GAP)


@lru_cache(maxsize=1 << 16)
def short_cell(codes: tuple[str, ...]) -> Cell:
    if len(codes) == 1:
        return row_cell(codes[0])
    half = len(codes) // 2
    return product(short_cell(codes[:half]), short_cell(codes[half:]))


class Chart:
    """The cell of a growing span, kept as cells of lengths SHORT, 2 SHORT, 4 SHORT and so on, as in a binary counter."""

    def __init__(self) -> None:
        self.tail: list[str] = []
        self.spans: list[tuple[int, Cell]] = []

    def add(self, code: str) -> None:
        self.tail.append(code)
        if len(self.tail) == SHORT:
            size, cell = SHORT, short_cell(tuple(self.tail))
            self.tail = []
            while self.spans and self.spans[-1][0] == size:
                cell, size = product(self.spans.pop()[1], cell), 2 * size
            self.spans.append((size, cell))

    def cell(self) -> Cell:
        out = short_cell(tuple(self.tail)) if self.tail else None
        for _, cell in reversed(self.spans):
            out = cell if out is None else product(cell, out)
        return GAP if out is None else out


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least cost and audit that end in an accepted order of roles; no row needs no edit."""
    return min(cell[0, q] for q in FINAL if (0, q) in cell)


ITEM = pa.struct([("p", pa.int8()), ("q", pa.int8()), ("cost", pa.int64()), ("audit", pa.string())])
CELL_SQL = "array<struct<p:tinyint,q:tinyint,cost:bigint,audit:string>>"
COUNTED = ("blank", "duplicate", "truncated", "illegal")
LEGAL = {"su", "ua", "au"}


class Stretch:
    """What a row of rows in order says about its conversation."""

    def __init__(self) -> None:
        self.chart, self.first, self.last, self.counts, self.turns, self.low, self.high = Chart(), None, None, dict.fromkeys(COUNTED, 0), 0, None, None
        self.previous_turn: object = None
        self.key: tuple | None = None

    def add(self, initial: str, fault: str, turn: int | None, again: bool, key: tuple) -> None:
        # A row equal to the one before it in all that orders rows is a repetition of it.
        if fault != BLANK and (again or key == self.key):
            fault = DUPLICATE
        self.key = key
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        for letter, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated")):
            self.counts[name] += fault == letter
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.previous_turn
            self.high = self.previous_turn = turn
        self.chart.add((initial or " ") + fault)


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, was_role, was_text): rows damaged by crc32('conv:turn') % 20; nulls count as one space, in the key too.

    0 drops a row, 1 empties its text, 2 removes its . ! and ?, 3 repeats it, 4 makes its role user.
    """
    space = F.lit(" ")
    words = lambda c: F.coalesce(col(c).cast("string"), space)
    kind = (F.crc32(F.concat_ws(":", words(conv), words(turn)).cast("binary")) % 20).alias("kind")
    rows = conversations.select(col(conv).alias("conv"), col(turn).cast("long").alias("turn"), words(role).alias("was_role"), words(text).alias("was_text"), kind)
    rows = rows.filter("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    new = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("was_text", "[.!?]", "")).otherwise(F.col("was_text"))
    return rows.select("conv", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("was_role")).alias("role"), new.alias("text"), "was_role", "was_text")


def prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, tie: list[str]) -> DataFrame:
    """(conv, turn, role, text, k1, k2): k1 and k2 order rows of one turn."""
    filled = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    return rows.select(
        col(conv).alias("conv"), col(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"),
        filled(tie[0]).alias("k1"), F.sha2(F.concat_ws("\x1f", *map(filled, tie)), 256).alias("k2"),
    )


def parse(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tie: tuple[str, ...] = ()) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows of a conversation stand in order of turn (nulls first), then of `tie` (role and text if not given). A row's first fault counts: blank
    (nothing but ASCII white space), duplicate (role and text stand before it), truncated (last character other than . ! ?). Keep costs 0,
    Rerole 3, Delete 4 (blank and duplicate rows must go), Insert 3, a truncated row that stays 3 more. Null roles and texts count as one
    space; a role without a first character can't be kept. Null conversations are one conversation. An empty table gives an empty result.
    """
    held = prepared(rows, conv, turn, role, text, list(tie) or [role, text])
    kind = held.schema["conv"].dataType.simpleString()
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(end == "", F.lit(BLANK)).when(~end.isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(FINE))
    small = held.select("conv", "turn", "k1", "k2", "role", F.substring("role", 1, 1).alias("initial"), F.sha2("text", 256).alias("h"), fault.alias("fault"))
    # Texts that come again: few rows a group, met by a join that splits hot keys.
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "k1", "k2")
    same = small.filter(F.col("fault") != BLANK).groupBy(F.coalesce(F.col("conv").cast("string"), F.lit(" ")).alias("c"), F.col("conv").isNull().alias("no"), "role", "h")
    same = same.agg(F.min(order).alias("begin"), F.count("*").alias("n")).filter("n > 1").drop("n")
    with_key = small.withColumn("c", F.coalesce(F.col("conv").cast("string"), F.lit(" "))).withColumn("no", F.col("conv").isNull())
    rows_in = with_key.join(same, ["c", "no", "role", "h"], "left").select(
        "conv", "turn", "k1", "k2", "initial", "fault", F.coalesce(order > F.col("begin"), F.lit(False)).alias("again")
    )
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    ranged = rows_in.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    conv_type = to_arrow_type(held.schema["conv"].dataType)
    schema = f"conv {kind}, part int, open boolean, first string, last string, turns long, low long, high long, {', '.join(f'{c} long' for c in COUNTED)}, cell {CELL_SQL}"

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each conversation's stretch in this partition; the first and the last may go on in others."""
        now, name, part, n_done, out = None, None, 0, 0, []
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for c, t, k1, k2, i, f, again in zip(*(batch.column(x).to_pylist() for x in ("conv", "turn", "k1", "k2", "initial", "fault", "again")), strict=True):
                if now is None or c != name:
                    if now is not None:
                        out.append(line(name, part, n_done == 0, now))
                        n_done += 1
                    now, name = Stretch(), c
                now.add(i, f, t, again, (t, k1, k2))
            if len(out) > 2000:
                yield block(out)
                out = []
        if now is not None:
            out.append(line(name, part, True, now))
        if out:
            yield block(out)

    def line(name: object, part: int, is_open: bool, s: Stretch) -> tuple:
        cell = s.chart.cell()
        held = cell if is_open else {(0, 3): cheapest(cell)}
        return (name, part, is_open, s.first, s.last, s.turns, s.low, s.high, *s.counts.values(), [(p, q, c, a) for (p, q), (c, a) in held.items()])

    def block(out: list[tuple]) -> pa.RecordBatch:
        names = ["conv", "part", "open", "first", "last", "turns", "low", "high", *COUNTED, "cell"]
        kinds = [conv_type, pa.int32(), pa.bool_(), pa.string(), pa.string(), *[pa.int64()] * 7, pa.list_(ITEM)]
        columns = list(zip(*out, strict=True))
        columns[-1] = [[dict(zip(("p", "q", "cost", "audit"), x, strict=True)) for x in cells] for cells in columns[-1]]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

    done = cut(ranged.mapInArrow(stretches, schema))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches in order of conversation and part to one row each."""
        held, out = None, []
        for batch in batches:
            for row in batch.to_pylist():
                cell = {(x["p"], x["q"]): (x["cost"], x["audit"]) for x in row["cell"]}
                if held is not None and held["conv"] == row["conv"]:
                    held["cell"] = product(held["cell"], cell)
                    for k in COUNTED:
                        held[k] += row[k]
                    held["illegal"] += held["last"] + row["first"] not in LEGAL
                    # A turn cut in two counts once.
                    held["turns"] += row["turns"] - (row["low"] is not None and held["high"] == row["low"])
                    held["last"], held["low"] = row["last"], row["low"] if held["low"] is None else held["low"]
                    held["high"] = held["high"] if row["high"] is None else row["high"]
                else:
                    if held is not None:
                        out.append(closed(held))
                    held = {**row, "cell": cell}
        if held is not None:
            out.append(closed(held))
        if out:
            yield block(out)

    def closed(row: dict) -> tuple:
        cost, audit = cheapest(row["cell"])
        return (*(row[k] for k in ("conv", "part", "open", "first", "last", "turns", "low", "high", *COUNTED)), [(0, 3, cost, audit)])

    ends = done.filter("open").repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(joined, schema)
    every = done.filter(~F.col("open")).unionByName(ends)
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return every.select("conv", gaps.alias("gaps"), *COUNTED, F.col("cell")[0]["cost"].alias("cost"), F.col("cell")[0]["audit"].alias("audit"))


def repair(rows: DataFrame, parsed: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", tie: tuple[str, ...] = ()) -> DataFrame:
    """(conv, seq, edit, role, text): the edits of `parsed` carried out, one row per edit in order; deleted rows stay, marked D.

    Rows come out sorted by conversation and seq inside their partition, each conversation in one of them; they stream through it.
    """
    held = prepared(rows, conv, turn, role, text, list(tie) or [role, text])
    kind = held.schema["conv"].dataType.simpleString()
    absent = lambda t: F.lit(None).cast(t)
    orders = parsed.select("conv", F.lit(0).alias("kind"), absent("long").alias("turn"), F.lit("").alias("k1"), F.lit("").alias("k2"), absent("string").alias("role"), F.col("audit").alias("text"))
    lines = held.select("conv", F.lit(1).alias("kind"), "turn", "k1", "k2", "role", "text")
    keys = [F.col("conv").asc_nulls_first(), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2")]
    stream = lines.unionByName(orders).repartition("conv").sortWithinPartitions(*keys).select("conv", "kind", "role", "text")

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, audit, at, state, stop = None, "", 0, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def put(letter: str, role: str | None, text: str | None, was: str = "", out=out) -> None:
                """One edit: what it is called, and the row it leaves or deletes."""
                nonlocal at, state
                if letter != "D":
                    q = STEP.get((state, was if letter == "K" else "u"))
                    if letter != "K":
                        to = "u" if q is not None else "a"
                        q, role = STEP[state, to], ROLE[to]
                    state = q
                out.append((name, at, letter, role, text))
                at += 1

            for c, k, r, t in zip(*(batch.column(x).to_pylist() for x in ("conv", "kind", "role", "text")), strict=True):
                if k == 0:
                    name, audit, at, state, stop = c, t, 0, 0, len(t.rstrip("I"))
                    continue
                while audit[at] == "I":
                    put("I", None, "")
                put(audit[at], r, t, r[:1])
                # What is inserted after the last row has none to wait for.
                while stop <= at < len(audit):
                    put("I", None, "")
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds, strict=True)], ["conv", "seq", "edit", "role", "text"])

    return stream.mapInArrow(carry_out, f"conv {kind}, seq long, edit string, role string, text string")


def digest(repaired: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 over the role:text lines of the rows that stay, as they stream by in the order `repair` leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, lines, n = None, None, 0
        for batch in batches:
            out = []
            for c, e, r, t in zip(*(batch.column(x).to_pylist() for x in ("conv", "edit", "role", "text")), strict=True):
                if lines is None or c != name:
                    if lines is not None:
                        out.append((name, lines.hexdigest()))
                    name, lines, n = c, hashlib.sha256(), 0
                if e != "D":
                    lines.update(f"{chr(10) if n else ''}{r}:{t}".encode())
                    n += 1
            yield block(out, batch.schema.field("conv").type)
        if lines is not None:
            yield block([(name, lines.hexdigest())], batch.schema.field("conv").type)

    def block(out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kind), pa.array([x[1] for x in out], pa.string())], ["conv", "sha"])

    return repaired.mapInArrow(run, f"conv {repaired.schema['conv'].dataType.simpleString()}, sha string")
