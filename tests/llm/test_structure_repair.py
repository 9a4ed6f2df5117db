"""Conversation structure repair against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest

from marketlake.llm import structure_repair as repair

SPACES = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?")
CONV = "conv_id long, turn long, role string, text string"


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACES)
        out.append("b" if not bare.strip(SPACES) else "d" if (role, text) in seen
                   else "t" if bare[-1] not in ".!?" else ".")
        seen.add((role, text))
    return out


@cache
def cheapest(symbols):
    """Least (cost, audit) over every string of edits, by plain enumeration."""
    best = None
    options = [("I" * k + e) for k in range(3) for e in "KRD"]
    for edits in itertools.product(options, repeat=len(symbols)):
        for tail in ("", "I", "II"):
            done = applied(symbols, "".join(edits) + tail)
            if done is not None and (best is None or (done, "".join(edits) + tail) < best):
                best = (done, "".join(edits) + tail)
    return best


def applied(symbols, audit):
    """Cost of an audit string, or None if it is not allowed."""
    left, cost, at = "", 0, 0
    for e in audit:
        if e == "I":
            left, cost = left + ("a" if left.endswith("u") else "u"), cost + 3
            continue
        initial, fault = symbols[at]
        at += 1
        if e == "D":
            cost += 4
        elif fault in "bd":
            return None
        else:
            cost += 3 * (fault == "t") + 3 * (e == "R")
            left += (initial or "x") if e == "K" else ("a" if left.endswith("u") else "u")
    return cost if GOOD.fullmatch(left) else None


def programme(symbols):
    """The same by a plain dynamic programme over strings, for longer sequences."""
    best = {"": (0, "")}  # by the role before (or the empty string): cost, audit
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    for initial, fault in symbols:
        new = {}
        for state, (cost, audit) in best.items():
            for k in range(3):
                at = state
                for _ in range(k):
                    at = "a" if at == "u" else "u"
                found = [(at, 4, "D")]
                if fault not in "bd":
                    extra = 3 * (fault == "t")
                    if initial and initial in after[at]:
                        found.append((initial, extra, "K"))
                    found.append(("a" if at == "u" else "u", 3 + extra, "R"))
                for q, more, e in found:
                    option = (cost + 3 * k + more, audit + "I" * k + e)
                    new[q] = min(new.get(q, option), option)
        best = new
    tail = {"": "", "a": "", "u": "I", "s": "II"}
    return min((c + 3 * len(tail[q]), a + tail[q]) for q, (c, a) in best.items())


def brute(rows, solve=programme):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(
        f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    faults = faults_of(rows)
    cost, audit = solve(tuple((r[1][:1] if r[1][:1] in ("s", "u", "a") else "", f) for r, f in zip(rows, faults)))
    lines, at, state = [], 0, ""
    for e in audit:
        if e == "I":
            state = "a" if state == "u" else "u"
            lines.append({"a": "assistant", "u": "user"}[state] + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if e == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif e == "R":
            state = "a" if state == "u" else "u"
            lines.append({"a": "assistant", "u": "user"}[state] + ":" + text)
    turns = {r[0] for r in rows if r[0] is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if code == 4 else role,
               "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
        out += [row] * {0: 0, 3: 2}.get(code, 1)
    return out


def conversations(seed, n):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 12])):
            turn = rng.choice([t, t, t, t + 2, None])
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            out.append((c, turn, role, rng.choice(["Yes.", "no", "What?", "ok! ", "", " \n", None, f"t{t}."])))
    return out


def by_conv(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, role, text))
    return groups


def compare(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CONV + ", cost int, kind string")
    out = repair.repair_conversations(repair.damaged(df), df, **kw).collect()
    groups = by_conv(damaged(rows))
    assert len(out) == len({r[0] for r in rows})
    for r in out:
        got = r.asDict()
        conv = got.pop("conv_id")
        want = brute(groups.get(conv, []))
        assert got == want, (conv, groups.get(conv))


def test_plain_programme_equals_enumeration():
    kinds = [(i, f) for i in ("s", "u", "a", "") for f in ".tb"]
    for n in range(4):
        for symbols in itertools.product(kinds, repeat=n) if n < 3 else random.Random(1).sample(
                list(itertools.product(kinds, repeat=3)), 250):
            assert programme(symbols) == cheapest(symbols), symbols


@pytest.mark.parametrize("shard_rows", [50_000, 40])
def test_repair_equals_brute_force(spark, shard_rows):
    rows = conversations(3, 150) + [
        (None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (1000, None, None, None), (-5, 3, "user", "x"),
        (2000, 0, "user", "long. " * 5000), (2000, 1, "assistant", "é" * 20_000 + ".")]
    compare(spark, rows, shard_rows=shard_rows)


def test_one_conversation_over_many_shards(spark):
    rng = random.Random(11)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["Same.", f"T{t}", f"t{t}."]))
            for t in range(900)] + [(7, 5, "user", "Equal.")] * 60 + conversations(4, 30)
    compare(spark, rows, shard_rows=50)


def test_conversations_without_rows_and_the_empty_table(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Hi.")], CONV)
    row = repair.repair_conversations(repair.damaged(df), df).collect()[0]
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = df.limit(0)
    assert repair.repair_conversations(repair.damaged(empty), empty).count() == 0


def test_rules_stand_for_the_rows_they_replace():
    grammar = repair.Grammar()
    rng = np.random.default_rng(2)
    given = [rng.integers(0, 3, rng.integers(1, 40)) for _ in range(60)] + [np.zeros(17, int)]
    flat = np.concatenate([np.r_[g, -1] for g in given])
    packed = repair.re_pair(flat, grammar)

    def leaves(s):
        return [s] if grammar.parts[s] is None else [x for part in grammar.parts[s] for x in leaves(part)]

    assert [x for s in packed for x in ([-1] if s < 0 else leaves(s))] == flat.tolist()
    pairs = [(a, b) for a, b in zip(packed, packed[1:]) if a >= 0 and b >= 0]
    assert len(packed) < len(flat) and len([p for p in set(pairs) if pairs.count(p) > 1 and p[0] != p[1]]) == 0
