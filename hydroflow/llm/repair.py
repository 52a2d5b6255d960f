"""Repair of the turn structure of conversations by divide and conquer over forward and backward costs.

A repaired conversation is empty, or an optional system turn followed by user and assistant turns in alternation. What
may follow depends on four states only: nothing yet (0), behind the system turn (1), behind a user turn (2), behind an
assistant turn (3). Each row is kept, given the role that fits, or deleted, with turns inserted before it.

1. Rows are numbered in order for conversations of any length, and each becomes one code: its role and whether it is
   sound, cut off, or must go. The texts stay where they are.
2. Codes are gathered in chunks of a bounded number of rows. A stretch of rows is a table of 4 x 4 costs, from the state before
   it to the state behind it, with the order of the cheapest edits among them. Tables of chunks are combined into
   tables of stretches of chunks until one stretch is a whole conversation.
3. From the top down, every stretch is cut in the middle: costs forward from its start meet costs backward from its end,
   the cheapest crossing state is taken, of equal ones that whose edits come first, and both halves are solved on their own.
   No table of a whole conversation is held anywhere.

Edits are written I (insert), D (delete), K (keep) and R (change the role). Up to the end of a row they are words of which
none begins another, so that an order among the states at a border stays the order of all that follows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from hydroflow.llm.common import text_or_empty
from hydroflow.operators.positions import null_safe_join, row_index
from hydroflow.session import stored

#: Rows of a chunk, and chunks (or stretches) that are combined into one.
CHUNK = 2048
FAN = 2048
#: Codes whose table is remembered, and how many tables.
SHORT = 8
REMEMBERED = 1 << 16

# Costs of the edits, what ends a turn, and what is blank.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
ENDS = ".!?"
BLANK = " \t\n\x0b\x0c\r"

#: Codes by role (system, user, assistant, other): sound, cut off, must go.
SOUND, CUT, GONE = "suao", "SUAO", "1234"
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: The state that a role leads to from a state, where it is allowed.
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state behind a turn that is made to fit.
_NEXT = (2, 2, 3, 2)
#: Turns that are missing at the end of a conversation, by state.
_MISSING = (0, 2, 1, 0)

_NONE = 1 << 60
Vector = tuple[tuple[int, int], ...]  # cost and order of the cheapest edits, by state
Table = tuple[Vector, ...]  # a vector for every state before


def _ranked(found: list[tuple[int, object] | None]) -> Vector:
    """Costs with the place of each state's edits among those of the others."""
    places = {key: i for i, key in enumerate(sorted(x[1] for x in found if x))}
    return tuple((x[0], places[x[1]]) if x else (_NONE, 0) for x in found)


def _words(code: str) -> list[dict[int, tuple[int, str]]]:
    """For each state before a row of this code: the states behind it with the cheapest, then first, edits."""
    gone, cut = code in GONE, CUT_OFF if code in CUT else 0
    role = SOUND[max(SOUND.find(code), CUT.find(code), GONE.find(code))]
    out = []
    for before in range(4):
        found: dict[int, tuple[int, str]] = {}
        state, cost, word = before, 0, ""
        for _ in range(3):
            moves = [(state, DELETE, "D")]
            if not gone:
                moves.append((_NEXT[state], REROLE + cut, "R"))
                if (state, role) in _KEEP:
                    moves.append((_KEEP[state, role], cut, "K"))
            for behind, price, edit in moves:
                found[behind] = min(found.get(behind, (_NONE, "")), (cost + price, word + edit))
            state, cost, word = _NEXT[state], cost + INSERT, word + "I"
        out.append(found)
    return out


_WORDS = {code: _words(code) for code in SOUND + CUT + GONE}
_ROWS: dict[str, Table] = {
    code: tuple(_ranked([found.get(q) for q in range(4)]) for found in words) for code, words in _WORDS.items()
}
_START: Table = tuple(tuple((0, 0) if p == q else (_NONE, 0) for q in range(4)) for p in range(4))


def _onward(vector: Vector, table: Table) -> Vector:
    """The vector behind a stretch."""
    found: list = [None] * 4
    for (cost, place), row in zip(vector, table, strict=True):
        if cost < _NONE:
            for q, (more, order) in enumerate(row):
                if more < _NONE and (found[q] is None or (cost + more, (place, order)) < found[q]):
                    found[q] = (cost + more, (place, order))
    return _ranked(found)


def _joined(a: Table, b: Table) -> Table:
    return tuple(_onward(row, b) for row in a)


_TABLES: dict[str, Table] = {}
_STATES: dict[tuple, list[int]] = {}


def _short_table(codes: str) -> Table:
    if codes not in _TABLES:
        if len(_TABLES) >= REMEMBERED:
            _TABLES.clear()
        table = _ROWS[codes[0]]
        for code in codes[1:]:
            table = _joined(table, _ROWS[code])
        _TABLES[codes] = table
    return _TABLES[codes]


def _short_tables(codes: str) -> list[Table]:
    return [_short_table(codes[i : i + SHORT]) for i in range(0, len(codes), SHORT)]


def table_of(codes: str) -> Table:
    """Costs and order from every state before the rows to every state behind them."""
    table = _START
    for part in _short_tables(codes):
        table = _joined(table, part)
    return table


def _forward(tables: Sequence[Table], start: int) -> Vector:
    vector = _START[start]
    for table in tables:
        vector = _onward(vector, table)
    return vector


def _backward(tables: Sequence[Table], end: Sequence[int]) -> list[int]:
    costs = list(end)
    for table in reversed(tables):
        costs = [min(more + cost for (more, _), cost in zip(row, costs, strict=True)) for row in table]
    return costs


def _crossing(vector: Vector, costs: Sequence[int]) -> int:
    """The state where forward and backward costs meet at the least, of equal ones that with the first edits."""
    return min(range(4), key=lambda q: (vector[q][0] + costs[q], vector[q][1]))


def states_between(tables: Sequence[Table], start: int, end: Sequence[int]) -> list[int]:
    """The state behind every one of some stretches; ``end`` is what each state behind the last one costs."""
    if len(tables) == 1:
        return [_crossing(tables[0][start], end)]
    middle = len(tables) // 2
    state = _crossing(_forward(tables[:middle], start), _backward(tables[middle:], end))
    left = states_between(tables[:middle], start, [0 if q == state else _NONE for q in range(4)])
    return left + states_between(tables[middle:], state, end)


def _short_states(codes: str, start: int, end: Sequence[int]) -> list[int]:
    key = (codes, start, *end)
    if key not in _STATES:
        if len(_STATES) >= REMEMBERED:
            _STATES.clear()
        _STATES[key] = states_between([_ROWS[c] for c in codes], start, end)
    return _STATES[key]


def solve(codes: str, start: int, end: Sequence[int]) -> list[int]:
    """The state behind every row, for rows between a state and the costs of what follows."""
    if len(codes) <= SHORT:
        return _short_states(codes, start, end) if codes else []
    middle = len(codes) // 2
    left, right = codes[:middle], codes[middle:]
    state = _crossing(_forward(_short_tables(left), start), _backward(_short_tables(right), end))
    return solve(left, start, [0 if q == state else _NONE for q in range(4)]) + solve(right, state, end)


def _accepted() -> list[int]:
    return [n * INSERT for n in _MISSING]


def _exactly(state: int) -> list[int]:
    return _accepted() if state < 0 else [0 if q == state else _NONE for q in range(4)]


def edits(codes: str, start: int, end: int) -> tuple[str, str, int]:
    """Edits of rows between two states, the state before each row and behind the last, and the cost.

    An ``end`` below zero stands for the end of the conversation, with the turns that are missing there.
    """
    behind = solve(codes, start, _exactly(end))
    word, cost, before = [], 0, start
    for code, state in zip(codes, behind, strict=True):
        price, own = _WORDS[code][before][state]
        word.append(own)
        cost, before = cost + price, state
    missing = _MISSING[before] if end < 0 else 0
    return "".join(word) + "I" * missing, "".join(map(str, [start, *behind])), cost + INSERT * missing


def illegal_pairs(codes: str) -> int:
    """Neighbouring rows whose roles do not follow each other."""
    roles = [SOUND[max(SOUND.find(c), CUT.find(c), GONE.find(c))] for c in codes]
    return sum(pair not in _LEGAL for pair in zip(roles, roles[1:], strict=False))


def _flat(table: Table) -> list[int]:
    return [x for row in table for cell in row for x in cell]


def _table(flat: Sequence[int]) -> Table:
    cells = [(int(flat[i]), int(flat[i + 1])) for i in range(0, 32, 2)]
    return tuple(tuple(cells[i : i + 4]) for i in range(0, 16, 4))


@dataclass(frozen=True)
class Repaired:
    """Stored results of a repair.

    ``turns``: conv_id, chunk, pos, nth, edit, role, text: a row for every edit, in the order of pos and nth. Deleted
    rows are there with edit D and what they held; the others are the repaired conversation.
    ``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """

    turns: DataFrame
    conversations: DataFrame


def _chunks(rows: DataFrame) -> DataFrame:
    """(conv_id, chunk, codes, blank, duplicate, truncated, illegal) of coded rows; a chunk counts the pair before it."""
    own = rows.groupBy("conv_id", F.expr(f"pos div {CHUNK}").alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "code"))), lambda r: r["code"]), "").alias("codes"),
        *[F.sum((F.col("fault") == name).cast("long")).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    # One row for each chunk: the last code of the chunk before it makes one more pair.
    last = F.coalesce(F.lag(F.right("codes", F.lit(1))).over(W.partitionBy("conv_id").orderBy("chunk")), F.lit(""))

    @F.pandas_udf("long")
    def pairs(codes: pd.Series) -> pd.Series:
        return codes.map(illegal_pairs)

    return own.withColumn("illegal", pairs(F.concat(last, "codes")))


def _combine(children: DataFrame) -> DataFrame:
    """Tables of stretches (conv_id, at, tables of the children in order) from those of their children (conv_id, at, flat)."""
    up = children.groupBy("conv_id", F.expr(f"at div {FAN}").alias("up")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "flat"))), lambda r: r["flat"]).alias("parts")
    )

    @F.pandas_udf("array<long>")
    def whole(parts: pd.Series) -> pd.Series:
        def fold(flats) -> list[int]:
            table = _START
            for flat in flats:
                table = _joined(table, _table(flat))
            return _flat(table)

        return parts.map(fold)

    return up.select("conv_id", F.col("up").alias("at"), "parts", whole("parts").alias("flat"))


def _spans(chunks: DataFrame) -> DataFrame:
    """The chunks with the states that they lie between: (conv_id, chunk, codes, start, end); end -1 at the last chunk."""
    if (chunks.agg(F.max("chunk")).first()[0] or 0) == 0:
        return chunks.select("conv_id", "chunk", "codes", F.lit(0).alias("start"), F.lit(-1).alias("end"))

    @F.pandas_udf("array<long>")
    def flat(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: _flat(table_of(c)))

    level = stored(chunks.select("conv_id", F.col("chunk").alias("at"), flat("codes").alias("flat")), "repair-tables")
    above: list[DataFrame] = []
    while (level.agg(F.max("at")).first()[0] or 0) > 0:
        level = stored(_combine(level), "repair-stretches")
        above.append(level)

    @F.pandas_udf("array<struct<start: int, end: int>>")
    def between(parts: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
        def split(flats, first: int, last: int) -> list[dict]:
            behind = states_between([_table(f) for f in flats], first, _exactly(last))
            ends = [*behind[:-1], last]
            return [{"start": a, "end": b} for a, b in zip([first, *behind], ends, strict=False)]

        return pd.Series([split(*row) for row in zip(parts, start, end, strict=True)])

    spans = above[-1].select("conv_id", "at", F.lit(0).alias("start"), F.lit(-1).alias("end"))
    for stretches in reversed(above):
        held = null_safe_join(stretches.select("conv_id", "at", "parts"), spans, ["conv_id", "at"])
        cut = held.select("conv_id", "at", F.posexplode(between("parts", "start", "end")).alias("nth", "span"))
        spans = stored(cut.select("conv_id", (F.col("at") * FAN + F.col("nth")).alias("at"), "span.start", "span.end"), "repair-spans")
    spans = spans.withColumnRenamed("at", "chunk")
    return null_safe_join(chunks.select("conv_id", "chunk", "codes"), spans, ["conv_id", "chunk"]).select(
        "conv_id", "chunk", "codes", "start", "end"
    )


def _coded(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in the conversation, and those places with fault and code."""
    named = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text")
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    # row_index stores what it has placed; its rows are written once with their place, as every later step reads them.
    placed = stored(row_index(named, ["conv_id"], ["turn", "role", "digest"], "pos"), "repair-rows")
    same = ["conv_id", "role", "digest"]
    again = placed.groupBy(*same).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1")
    seen = null_safe_join(placed, again.select(*same, "first"), same, "left")
    core = F.rtrim(F.col("text"), F.lit(BLANK))
    fault = (
        F.when(core == "", "blank")
        .when(F.col("pos") > F.col("first"), "duplicate")
        .when(~F.substring(core, -1, 1).isin(*ENDS), "truncated")
        .otherwise("")
    )
    first = F.substring("role", 1, 1)
    at = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(4)
    code = F.substring(
        F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(SOUND), at, F.lit(1)
    )
    coded = seen.select("conv_id", "pos", "turn", "role", fault.alias("fault")).withColumn("code", code)
    return placed, stored(coded.select("conv_id", "pos", "turn", "fault", "code"), "repair-codes")


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """Faults and the cheapest repair of every conversation.

    Rows are ordered by turn, NULL first, then by role and the SHA-256 of the text. NULL roles and texts count as empty; a
    NULL conversation id is a conversation like any other. A row's first fault counts: blank, duplicate (role and text
    occur earlier), truncated (its last character that is not blank is none of ``.!?``). Blank and duplicate rows are
    deleted. A role counts by its first letter, s, u or a. Of the cheapest repairs the one whose edits, written as letters,
    come first is taken. Gaps are turn numbers that are missing between the smallest and the largest. Other columns are
    not looked at. No rows: no conversations.
    """
    placed, coded = _coded(turns, conv_id, turn, role, text)
    chunks = stored(_chunks(coded), "repair-chunks")

    @F.pandas_udf("struct<audit: string, states: string, cost: long>")
    def solved(rows: pd.DataFrame) -> pd.DataFrame:
        found = [edits(c, int(a), int(b)) for c, a, b in zip(rows["codes"], rows["start"], rows["end"], strict=True)]
        return pd.DataFrame(found, columns=["audit", "states", "cost"])

    spans = _spans(chunks).withColumn("found", solved(F.struct("codes", "start", "end")))
    spans = stored(spans.select("conv_id", "chunk", "found.*"), "repair-edits")
    turned = coded.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    faults = chunks.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    audits = spans.groupBy("conv_id").agg(
        F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda r: r["audit"]), "").alias("audit"),
    )
    whole = null_safe_join(null_safe_join(turned, faults, ["conv_id"]), audits, ["conv_id"])
    return Repaired(_edited(placed, spans), stored(whole, "repaired-conversations"))


def _edited(placed: DataFrame, spans: DataFrame) -> DataFrame:
    """A row for every edit."""
    words = F.regexp_extract_all("audit", F.lit("(I*[DKR]|I+$)"), F.lit(1))
    word_rows = spans.select(
        "conv_id", "chunk", F.posexplode(F.arrays_zip(words.alias("word"), F.split("states", "").alias("state"))).alias("nth", "own")
    ).filter("own.word is not null")
    word_rows = word_rows.select("conv_id", "chunk", (F.col("chunk") * CHUNK + F.col("nth")).alias("pos"), "own.word", "own.state")
    # Turns inserted behind the last row have no row of their own.
    joined = null_safe_join(word_rows, placed.select("conv_id", "pos", "role", "text"), ["conv_id", "pos"], "left")
    shift = F.when(F.col("state") == "2", 1).otherwise(0)

    def made(nth: Column) -> Column:
        return F.when((nth + shift) % 2 == 1, "user").otherwise("assistant")

    def edit(letter: Column, nth: Column) -> Column:
        return F.struct(
            nth.alias("nth"),
            letter.alias("edit"),
            F.when(letter.isin("I", "R"), made(nth)).otherwise(F.col("role")).alias("role"),
            F.when(letter == "I", "").otherwise(F.col("text")).alias("text"),
        )

    letters = F.transform(F.sequence(F.lit(1), F.char_length("word")), lambda i: edit(F.substring(F.col("word"), i, F.lit(1)), i))
    return stored(joined.select("conv_id", "chunk", "pos", F.inline(letters)), "repaired-turns")


def digests(pieces: DataFrame, key: str, order: str, piece: str, between: str, schema: str) -> DataFrame:
    """(key, SHA-256) of each key's pieces joined in order. Tasks read the pieces one after the other, so memory does not
    follow the length of what is hashed."""
    mark = between.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, state = None, None
        for batch in batches:
            done = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if state is None or own != known:
                    if state is not None:
                        done.append((known, state.hexdigest()))
                    known, state = own, hashlib.sha256()
                else:
                    state.update(mark)
                state.update(text.as_py().encode())
            if done:
                yield _batch(done, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if state is not None:
            yield _batch([(known, state.hexdigest())], kind)

    def _batch(rows: list, kind: pa.DataType) -> pa.RecordBatch:
        keys, found = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(found, pa.string())], names=[key, "sha256"])

    return pieces.repartition(key).sortWithinPartitions(key, order).select(key, piece).mapInArrow(run, schema)


def repaired_digests(repaired: Repaired) -> DataFrame:
    """(conv_id, sha256) of the lines ``role:text`` of every repaired conversation that has any."""
    lines = repaired.turns.filter("edit <> 'D'").select("conv_id", "chunk", "pos", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    pieces = lines.groupBy("conv_id", "chunk").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "nth", "line"))), lambda r: r["line"]), "\n").alias("piece")
    )
    kind = repaired.turns.schema["conv_id"].dataType.simpleString()
    return digests(pieces, "conv_id", "chunk", "piece", "\n", f"conv_id {kind}, sha256 string")
