"""Repair of conversations against trying every sequence of edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from compare import differences, open_tables

from hydroflow.llm import queries, repair

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def tried(codes):
    """The cheapest edits, of equal ones the first, by trying all with up to two turns inserted at a place."""
    best = None
    per_row = []
    for code in codes:
        edits = ["D"] if code in repair.GONE else ["D", "K", "Ru", "Ra"]
        per_row.append([(tuple(ins), e) for k in range(3) for ins in product("ua", repeat=k) for e in edits])
    for rows in product(*per_row):
        for k in range(3):
            for tail in product("ua", repeat=k):
                word, roles, cost = "", "", 0
                for code, (ins, e) in zip(codes, rows, strict=True):
                    word += "I" * len(ins) + e[0]
                    roles += "".join(ins) + {"D": "", "K": code.lower()}.get(e[0], e[1:])
                    cost += 2 * len(ins) + {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and code in repair.CUT)
                if LEGAL.fullmatch(roles + "".join(tail)):
                    found = (cost + 2 * k, word + "I" * k)
                    best = found if best is None else min(best, found)
    return best


def test_equals_trying_everything():
    codes = repair.SOUND + repair.CUT + repair.GONE[:1]
    rng = random.Random(4)
    rows = ["", *codes, *map("".join, product("suaoSU1", repeat=2)), *["".join(rng.choice(codes) for _ in range(3)) for _ in range(40)]]
    for row in rows:
        word, _, cost = repair.edits(row, 0, -1)
        assert (cost, word) == tried(row), row


def straight(codes):
    """The same by one pass that keeps the best edits of every state."""
    best = {0: (0, "")}
    for code in codes:
        behind = {}
        for state, (cost, word) in best.items():
            for q, (price, own) in repair._WORDS[code][state].items():
                behind[q] = min(behind.get(q, (1 << 60, "")), (cost + price, word + own))
        best = behind
    return min((cost + 2 * repair._MISSING[q], word + "I" * repair._MISSING[q]) for q, (cost, word) in best.items())


@pytest.mark.parametrize("n", [7, 40, 900])
def test_halves_meet_like_one_pass(n):
    rng = random.Random(n)
    for _ in range(30):
        codes = "".join(rng.choice("suauaoSUAO1234") for _ in range(n))
        word, states, cost = repair.edits(codes, 0, -1)
        assert (cost, word) == straight(codes)
        assert len(states) == n + 1


def plainly(rows):
    """conv_id -> what the operator and its digest give, one conversation at a time."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            [(t, r or "", x or "") for c, t, r, x in rows if c == conv],
            key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()),
        )
        seen, codes, faults = set(), "", []
        for _, role, text in own:
            core = text.rstrip(repair.BLANK)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append(fault)
            at = ("sua".find(role[0]) if role and role[0] in "sua" else 3)
            codes += {"": repair.SOUND, "truncated": repair.CUT}.get(fault, repair.GONE)[at]
        cost, word = straight(codes)
        initials = [r[:1] for _, r, _ in own]
        turns = [t for t, _, _ in own if t is not None]
        lines, state, at = [], 0, 0
        for letter in word:
            if letter in "IR":
                state = repair._NEXT[state]
                lines.append(("user" if state == 2 else "assistant") + ":" + (own[at][2] if letter == "R" else ""))
            elif letter == "K":
                state = repair._KEEP[state, initials[at]]
                lines.append(f"{own[at][1]}:{own[at][2]}")
            at += letter != "I"
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost,
            word,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def found(spark, rows):
    done = repair.repair(spark.createDataFrame(rows, SCHEMA))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    texts = {r.conv_id: r.sha256 for r in repair.repaired_digests(done).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*[r[n] for n in numbers], texts.get(r.conv_id, empty)) for r in done.conversations.collect()}


AWKWARD = [
    (1, 0, "user", "Hello."),
    (1, 0, "user", "Hello."),
    (1, 5, "assistant", "cut off"),
    (1, None, None, None),
    (2, 1, "assistant", " \n"),
    (3, 1, "tool", "x!"),
    (3, 1, "", "y!"),
    (3, -4, "User", "z?"),
    (None, None, "system", "be."),
    (None, None, "user", "<|x\\ ü?"),
    (4, 2, "user", "long. " * 60_000),
    (4, 1, "system", "S."),
    (5, 9, "system", "alone"),
]


@pytest.mark.parametrize("chunk, fan", [(2048, 2048), (2, 2), (3, 4)])
def test_rows(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "FAN", fan)
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "sue"]
    texts = ["a.", "b!", "c", "d?", "e.", "f.", " ", *[f"t{i}." for i in range(20)]]
    one = [(7, t, rng.choice(roles), rng.choice(texts)) for t in range(70)]
    hot = [(8, 0, "user", "same.")] * 40
    rows = AWKWARD + one + hot
    assert found(spark, rows) == plainly(rows)


def test_no_rows_and_extra_columns(spark):
    none = repair.repair(spark.createDataFrame([], SCHEMA))
    assert none.turns.count() == 0 and none.conversations.count() == 0
    rows = [(1, i, "user", f"{t}.", "x", 3, "y") for i, t in enumerate("abc")]
    df = spark.createDataFrame(rows, SCHEMA + ", pos string, chunk int, digest string")
    done = repair.repair(df)
    assert [r.audit for r in done.conversations.collect()] == ["KIKR"]
    turns = sorted((r.pos, r.nth, r.edit, r.role, r.text) for r in done.turns.collect())
    assert turns == [(0, 1, "K", "user", "a."), (1, 1, "I", "assistant", ""), (1, 2, "K", "user", "b."), (2, 1, "R", "assistant", "c.")]


def test_twin_with_nulls_and_ties(spark, tmp_path):
    rows = AWKWARD + [(10 + i // 6, i % 6 if i % 5 else None, ["user", "assistant", None][i % 3], f"t{i % 4}.") for i in range(120)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    folder = str(tmp_path)
    con = open_tables(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    assert differences(spark, con, queries.QUERIES["op13_repair"], queries.ORACLE["op13_repair"], folder) == []


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)] + [(None, None, None, None)]
    done = [tuple(r) for r in queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    wanted = []
    for c, t, role, text in rows:
        shown = [" " if x is None else str(x) for x in (c, t, role, text)]
        hit = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        own = (c, t, "user" if hit == 4 else shown[2], {1: "", 2: re.sub("[.!?]", "", shown[3])}.get(hit, shown[3]))
        wanted += [own] * (0 if hit == 0 else 2 if hit == 3 else 1)
    assert sorted(done, key=repr) == sorted(wanted, key=repr)
