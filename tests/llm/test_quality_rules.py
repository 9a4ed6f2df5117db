"""Quality rules against a brute-force version."""

from __future__ import annotations

import random
import re

import numpy as np
from marketlake.llm import quality_rules as rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + sum(map(len, WORD.findall(line)))
            seen.add(line)
    out |= {"n_dup_lines": dup, "dup_line_chars": dup_chars}
    ok = dup_chars <= rules.LINE_LIMIT * chars
    for n, limit in rules.COVERAGE_LIMITS.items():
        places = {}
        for i in range(len(words) - n + 1):
            places.setdefault(tuple(words[i:i + n]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(n)}
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in covered)
        ok = ok and out[f"dup_chars_{n}"] <= limit * chars
        if n == 5:
            out["n_repeat_words"] = len(covered)
    out["base_failed"] = len(words) < 10 or 100 * out["n_repeat_words"] > 20 * len(words)
    out["kept"] = ok and not out["base_failed"]
    return out


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t ", "x", "a b c d e", "a b c d e f g h i j", "a b c d e a b c d e x y",
           "same line of text here\n" * 9, "## $$ %% && ** || << >>", "é ü 漢字 word one two " * 8,
           "w " * 5000, " ".join(f"v{i}" for i in range(30_000)), " ".join(["a-rather-long-word-indeed"] * 6 + [f"b{i}" for i in range(60)]),
           "one\r\ntwo\r\none\r\n\n\n  \n  \n"]
    for _ in range(300):
        vocabulary = [f"w{i}" for i in range(rng.choice([3, 10, 40, 400]))]
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 120))]
        if words and rng.random() < 0.5:
            words += words[: rng.randrange(len(words))]
        out.append("".join(w + rng.choice([" ", " ", " ", "\n", "\t"]) for w in words))
    return out


def test_quality_rules_equal_brute_force(spark):
    given = texts()
    rows = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(given)],
                                 "doc_id long, text string, n_words int, kept string")
    got = {r.doc_id: r.asDict() for r in rules.quality_rules(rows).collect()}
    assert len(got) == len(given)
    for i, text in enumerate(given):
        assert got[i] == {"doc_id": i, **brute(text)}, (i, text)
    assert any(not r["kept"] and not r["base_failed"] for r in got.values())


def test_equal_hashes_are_confirmed_on_the_words(monkeypatch):
    given = [t or "" for t in texts()[:60]]
    right = rules.measure(given)
    monkeypatch.setattr(rules, "mix64", lambda x: x & np.uint64(3))  # nearly all windows collide
    assert rules.measure(given).equals(right)


def test_repeated_rows_null_ids_and_the_empty_table(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id int, text string")
    out = rules.quality_rules(rows)
    assert sorted((r.doc_id or 0, r.kept) for r in out.collect()) == [(0, False), (0, True), (1, True), (1, True)]
    assert dict(out.dtypes)["doc_id"] == "int"
    assert rules.quality_rules(rows.limit(0)).count() == 0
