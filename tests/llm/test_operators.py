"""Each training-data operator against a brute-force version on small fixtures, with
nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.llm import bpe, embedding_dedup, minhash, mixing, quality, sharding, shingles
from marketlake.llm.catalog import tokenizer_path
from marketlake.llm.chat import format_chats
from marketlake.llm.common import absent, possible
from marketlake.llm.components import components
from marketlake.llm.exact_dedup import drop_exact_copies, exact_groups
from marketlake.llm.line_dedup import delete_repeated_runs
from marketlake.llm.url_filters import url_verdicts

DOC = "doc_id long, text string"
WORDS = [f"w{i}" for i in range(60)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def as_counter(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# --- op1: line dedup ---------------------------------------------------------------

def lines_brute(docs, run, words=50):
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        lines = text.split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        gone, new = set(), []
        for i in range(len(filled)):
            for size in range(1, min(run, len(filled) - i) + 1):
                window = tuple(lines[p] for p in filled[i:i + size])
                counts = size == run or sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in window) >= words
                if not counts and not size == len(filled) < run:
                    continue
                if (window, counts) in seen or (window, counts) in new:
                    gone.update(filled[i:i + size])
                new.append((window, counts))
        seen.update(new)
        out.append((doc_id, len(lines), len(gone), "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    return Counter(out)


@pytest.mark.parametrize("run", [1, 2, 3])
def test_line_dedup(spark, run):
    rng = random.Random(run)
    docs = [(i, "\n".join(rng.choice(["a", "b", "c", "d", "", "  ", "long line"]) for _ in range(rng.randrange(0, 12))))
            for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "x"), (104, "same\n" * 30), (None, "a\nb\nc\nd"),
             (105, "\n".join(f"l{i}" for i in range(3000))), (106, "\n".join(f"l{i}" for i in range(1000, 4000)))]
    long, half = "word " * 60, "  half " * 26
    docs += [(110, long), (111, "new\n" + long + "\nother"), (112, f"{half}\n{half}x"), (113, f"p\n{half}\n\n{half}x\nq"),
             (114, f"{half}\np"), (115, "only\ntwo"), (116, "only\ntwo"), (117, "p\nonly\ntwo"), (118, "x"),
             (119, f"{long}\nnext"), (120, f"{long}\nnext\nand on")]
    rows = frame(spark, [(*d, 1, "x") for d in docs], DOC + ", sum int, lines string")
    assert as_counter(delete_repeated_runs(rows, run), "doc_id", "n_lines", "n_removed", "text") == lines_brute(docs, run)


def test_line_dedup_of_repeated_rows_and_empty_table(spark):
    text = "a\nb\nc\nd"
    out = delete_repeated_runs(frame(spark, [(1, text), (1, text), (2, "z\na\nb\nc")], DOC))
    assert as_counter(out, "doc_id", "text") == Counter({(1, text): 2, (2, "z"): 1})
    assert delete_repeated_runs(frame(spark, [], DOC)).count() == 0


@pytest.mark.parametrize("lines", [1, 2])
def test_long_runs_of_one_and_two_lines_go(spark, lines):
    passage = "\n".join(" ".join(f"w{k}x{i}" for i in range(200 // lines)) for k in range(lines))
    out = delete_repeated_runs(frame(spark, [(1, passage), (2, "own\n" + passage), (3, passage)], DOC))
    assert as_counter(out, "doc_id", "n_removed", "text") == Counter(
        {(1, 0, passage): 1, (2, lines, "own"): 1, (3, lines, ""): 1})


# --- op2: sharding -----------------------------------------------------------------

def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_and_growth():
    keys = np.random.default_rng(5).integers(0, 2**60, 4000)
    for n in (1, 2, 16, 17, 100):
        assert sharding.jump_hash(keys, n).tolist() == [jump(int(k), n) for k in keys]
    old, new = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    assert set(new[old != new]) == {16} and (old != new).mean() < 0.09
    with pytest.raises(ValueError):
        sharding.jump_hash(keys, 0)


def test_shard_documents(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_GROUP", 7)  # many groups on a small table
    docs = [(i, None if i % 9 == 0 else "é" * (i % 5)) for i in range(200)]
    docs += [(7, "again")] * 50 + [(None, "x"), (None, None)]
    out = sharding.shard_documents(frame(spark, [(*d, 3) for d in docs], DOC + ", shard int"), 16).collect()
    assert len(out) == len(docs)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == expected
    assert sharding.shard_documents(frame(spark, [], DOC)).count() == 0


# --- op3: exact dedup --------------------------------------------------------------

def exact_brute(docs):
    def norm(t):
        return re.sub(r"[\x20\x09-\x0D]", "", t or "")

    groups = defaultdict(list)
    for i, (d, t) in enumerate(docs):
        groups[norm(t)].append((-len(t or ""), d is None, d if d is not None else 0, i))
    out = Counter()
    for key, members in groups.items():
        best = min(members)[3]
        for *_, i in members:
            out[(docs[i][0], docs[best][0], len(members), i == best, hashlib.sha256(key.encode()).hexdigest())] += 1
    return out


def test_exact_groups(spark):
    long = "long text " * 20_000
    docs = [(5, "a b"), (3, "ab"), (4, "a\tb"), (9, "a  b"), (8, "a  b"), (1, None), (2, ""), (6, " "), (7, "unique"),
            (None, "ab"), (10, long), (11, long + " "), (12, long + "x"), (13, "ab"), (13, "ab"), (14, "a\u00a0b"),
            (20, "tw"), (20, "tw"), (20, "tw")]
    rows = frame(spark, [(*d, "z") for d in docs], DOC + ", full_hash string")
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert as_counter(exact_groups(rows), *columns) == exact_brute(docs)
    kept = drop_exact_copies(rows)
    assert kept.columns == ["doc_id", "text", "full_hash"]
    # 20 repeats one row: its rows stay together; every other group keeps one.
    assert Counter(r.doc_id for r in kept.collect()) == Counter({8: 1, 6: 1, 7: 1, 11: 1, 12: 1, 14: 1, 20: 3})
    assert exact_groups(frame(spark, [], DOC)).count() == 0
    assert drop_exact_copies(frame(spark, [], DOC)).count() == 0


def test_dropped_copies_take_no_other_text_along(spark):
    # Repeated and null doc_ids with texts of one length, of which only some have a copy.
    docs = [(None, "abc"), (1, "abc"), (None, "xyz"), (None, "uvw"), (2, "uvw"), (None, "a b"), (None, None), (None, ""),
            (5, "copy"), (4, "copy"), (5, "lone"), (5, "dear"), (6, "dear")]
    kept = drop_exact_copies(frame(spark, docs, DOC))
    assert as_counter(kept, "doc_id", "text") == Counter(
        [(1, "abc"), (None, "xyz"), (2, "uvw"), (None, "a b"), (None, None), (None, ""), (4, "copy"), (5, "lone"), (5, "dear")])


# --- op4: BPE ----------------------------------------------------------------------

ODD = ["", " ", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ ΟΔΟΣ", "İstanbul ŉ", "é e\u0301 A\u030A", "don't we'll I'M 123 ４５ Ⅷ",
       "\x00abc\x00", "\x1c\x85a\xa0b\u200bc\u3000d", "aaaaaaaaaaaaaaa", "👍🏽 👨‍👩‍👧", "<|endoftext|", "x" * 3000, "日本語 한국어"]


def test_bpe_matches_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    texts = [*ODD, "Long Text, " * 30_000]
    out = {r.doc_id: r for r in bpe.round_trip(frame(
        spark, [*[(i, t, 1) for i, t in enumerate(texts)], (99, None, 1)], DOC + ", n_tokens int"), tokenizer_path()).collect()}
    for i, text in [*enumerate(texts), (99, "")]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert out[i].n_tokens == len(ids), text[:20]
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert out[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_matches_the_library_for_any_code_point():
    """Unassigned, private and later code points and marks of every class, in any order."""
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    encode = bpe.Encoder(bpe.BpeModel.of(bpe.BpeModel.load(tokenizer_path()).tables()))
    marks = [chr(i) for i in range(0x110000) if unicodedata.combining(chr(i))]
    pick = random.Random(11)

    def anything():
        at = pick.randrange(pick.choice([0x80, 0x3000, 0x20000, 0x110000]))
        return "?" if 0xD800 <= at < 0xE000 else chr(at)

    texts = ["\U0001e133\u0f7a\u0f74", "\u208f", *("".join(
        pick.choice([anything(), pick.choice(marks), pick.choice("ab 's\u03a31")]) for _ in range(pick.randrange(1, 30)))
        for _ in range(5000))]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_bpe_columns_and_round_trip(spark):
    docs = frame(spark, [(1, "Hello, world", "x"), (2, None, "y"), (2, None, "y")], DOC + ", token_ids string")
    encoded = bpe.encode(docs, tokenizer_path())
    assert encoded.columns == ["doc_id", "text", "token_ids"]
    decoded = bpe.decode(encoded, tokenizer_path())
    assert as_counter(decoded, "doc_id", "text", "decoded") == Counter(
        {(1, "Hello, world", "hello</w> ,</w> world</w>"): 1, (2, None, ""): 2})
    assert bpe.encode(frame(spark, [], DOC), tokenizer_path()).count() == 0


def test_encoder_restarts_its_cache(monkeypatch):
    model = bpe.BpeModel.load(tokenizer_path())
    whole = [x.tolist() for x in bpe.Encoder(model)(ODD)]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 2)
    small = bpe.Encoder(model)
    assert [small([t])[0].tolist() for t in ODD] == whole


# --- op5: URL filters --------------------------------------------------------------

def url_brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(-len(h + p), v != "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, min(fits)[2] if fits else None, min(fits)[3] if fits else "allow"


def test_url_verdicts(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.com", "", "block"), ("b.com", "/ok", "allow"),
             ("tie.org", "/a", "allow"), ("tie.org", "/a", "block"), ("tie.org", "/a", "block")]
    urls = [None, "", "net/", "http://net", "http://NET/", "https://a.example.net/en/x?q#f", "x://example.net/en", "s://b.com",
            "s://sub.b.com/okay", "s://b.com/ok", "s://bb.com/ok", "s://tie.org/ab", "s://ÄB.net/é", "http://net?x", "http://net#x/",
            "http:///path", "://net/", "a://b://c", "http://u@net/", "http://" + "a." * 3000 + "net/" + "x/" * 3000, "http://net/\nx"]
    pages = [(i, u, "h") for i, u in enumerate(urls)] + [(2, "net/", "h"), (None, "http://net/", "h")]
    out = url_verdicts(frame(spark, pages, "page_id long, url string, verdict string"),
                       frame(spark, rules + [(None, "/", "block")], "host string, path string, verdict string"))
    expected = Counter((i, *url_brute(u, rules)) for i, u, _ in pages)
    assert as_counter(out, "page_id", "host", "path", "rule", "verdict") == expected
    none = frame(spark, [], "host string, path string, verdict string")
    assert {r.verdict for r in url_verdicts(frame(spark, pages[:5], "page_id long, url string, h string"), none).collect()} == {"allow"}
    assert url_verdicts(frame(spark, [], "page_id long, url string"), none).count() == 0


# --- op6: chat formatting ----------------------------------------------------------

CHAT = "conv_id long, turn long, role string, text string"


def test_format_chats(spark):
    def conv(c, *texts):
        return [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    rows = [*conv(1, "a"), *conv(2, "a", "b"), *conv(3, "a", "b", "c"), *conv(4, "a", "b", "c"), *conv(5, "a", "x"),
            *conv(6, "b"), *conv(7, *[f"t{i}" for i in range(600)]), *conv(8, *[f"t{i}" for i in range(599)]),
            *conv(6, "b"), (None, 0, "user", "lost"), (9, None, None, None), (10, 0, "user", "same"), (10, 0, "user", "other")]
    out = format_chats(frame(spark, [(*r, 1) for r in rows], CHAT + ", part int")).collect()
    texts = defaultdict(str)
    for r in sorted(out, key=lambda r: (r.conv_id, r.part)):
        texts[r.conv_id] += r.text
    assert sorted(texts) == [3, 5, 6, 7, 9, 10]
    assert texts[3] == ("<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n")
    assert texts[7].count("<|im_start|>") == 600 and {r.n_turns for r in out if r.conv_id == 7} == {600}
    assert len([r for r in out if r.conv_id == 7]) == 3
    assert texts[9] == "<|im_start|>\n<|im_end|>\n" and texts[10].index("other") < texts[10].index("same")
    assert format_chats(frame(spark, [], CHAT)).count() == 0


def test_snapshots_end_inside_a_turn(spark):
    # Rows of one turn follow each other by role and text, also where a snapshot ends.
    rows, kept = [], set()
    for c in range(0, 80, 2):
        rows += [(c, 0, "user", f"a{c}"), (c + 1, 0, "user", f"a{c}"), (c + 1, 0, "user", f"b{c}")]
        kept.add(c + 1)
        rows += [(100 + c, 0, "user", f"y{c}"), (101 + c, 0, "user", f"x{c}"), (101 + c, 0, "user", f"y{c}")]
        kept |= {100 + c, 101 + c}
    out = format_chats(frame(spark, rows, CHAT)).collect()
    assert {r.conv_id for r in out} == kept


def test_many_rows_of_one_turn_are_cut_by_count(spark):
    rng = random.Random(6)
    rows = [(1, rng.choice([0, 5, None]), rng.choice(["user", "assistant"]), f"t{rng.randrange(10**6)}") for _ in range(900)]
    ordered = sorted(set(rows), key=lambda r: (r[1] is None, r[1] or 0, r[2], r[3]))
    rows += [(2, *r[1:]) for r in ordered[:700]] + [(3, *r[1:]) for r in ordered[:300]] + [(3, None, "user", "own")]
    out = format_chats(frame(spark, rows, CHAT), shard_rows=120).collect()
    assert {r.conv_id: r.n_turns for r in out} == {1: len(ordered), 3: 301}
    parts = sorted((r.part, r.text) for r in out if r.conv_id == 1)
    assert [p for p, _ in parts] == list(range(-(-len(ordered) // 256)))
    assert "".join(t for _, t in parts) == "".join(f"<|im_start|>{r[2]}\n{r[3]}<|im_end|>\n" for r in ordered)


# --- op7: quality ------------------------------------------------------------------

def test_quality_edge_cases(spark):
    good = [(i, " ".join(random.Random(i).choices(WORDS, k=50)).capitalize() + ".", "s") for i in range(60)]
    bad = [(100 + i, " ".join(w.upper() + "!!" for w in random.Random(i).choices(WORDS, k=50)), "s") for i in range(60)]
    odd = [(300, None, "s"), (301, "", "s"), (None, "hello", "s"), (302, "WORD!! " * 30_000, "s"), (302, "Word word. " * 3, "s")]
    docs = frame(spark, good + bad + odd, DOC + ", score string")
    labels = [(d, 1, 0) for d, *_ in good] + [(d, 0, 0) for d, *_ in bad] + [(1, None, 0), (None, 1, 0), (999, 1, 1)]
    labels = frame(spark, labels, "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert sum(by_id[d][0].predicted for d, *_ in good) == 60 and sum(by_id[d][0].predicted for d, *_ in bad) == 0
    assert by_id[None][0].held_out and len(by_id[302]) == 2
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {d for d, *_ in good} <= {r.doc_id for r in kept.collect()}
    none = frame(spark, [], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(frame(spark, [], DOC), labels).count() == 0


# --- op8: mixing -------------------------------------------------------------------

MIX = "doc_id long, text string, source string"


def test_mix_covers_every_document_and_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    rng = random.Random(1)
    docs = [(i, " ".join(["w"] * rng.randrange(1, 40)), "hot" if i < 400 else f"s{i % 5}") for i in range(600)]
    docs += [(1000, None, "empty"), (1001, "", "empty"), (None, "a b", None), (7, "same row", "s1"), (7, "same row", "s1")]
    df = frame(spark, [(*d, 1) for d in docs], MIX + ", slot int")
    rows = mixing.mix(df, entropy_share=0.95, repetition_limit=2.0).collect()
    count = Counter((r.source, r.doc_id, r["sum"], r.copy) for r in rows)
    assert len(count) == len(docs) and set(count.values()) <= {1, 2, 3}
    total, spent = Counter(), Counter()
    for d, t, s in docs:
        total[s] += len((t or "").split())
    for r in rows:
        spent[r.source] += r.tokens
    # The least source repeats at most twice, and the hot one is passed over once.
    assert spent["hot"] == total["hot"]
    top = max(total.values())
    weights = {r.source: r.weight for r in rows}
    for s, t in total.items():
        if t:
            target = top * weights[s] / weights["hot"]
            assert target - 41 <= spent[s] <= target + 1
            assert spent[s] <= 2.0 * t + 1
    places = [(r.source, r["pass"], r.block, r.slot) for r in rows]
    assert len(set(places)) == len(places)
    assert mixing.mix(frame(spark, [], MIX)).count() == 0
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert {(r.doc_id, r.source) for r in out.collect()} == {(d, s) for d, _, s in docs}


def test_exponent_against_brute_force(spark):
    tokens = [10_000, 400, 900, 2_500, 120]
    sources = frame(spark, [(t,) for t in tokens], "tokens long")

    def entropy(a):
        w = np.array(tokens, float) ** a
        w /= w.sum()
        return -(w * np.log(w)).sum()

    for share in (0.5, 0.8, 0.95, 1.0):
        a = mixing.exponent(sources, share, 1e9)
        goal = share * np.log(len(tokens))
        assert entropy(a) >= goal - 1e-9 and (a == 1.0 or entropy(a + 1e-6) < goal + 1e-9)
    a = mixing.exponent(sources, 1.0, 3.0)
    assert (10_000 / 120) ** (1 - a) == pytest.approx(3.0, rel=1e-6)
    assert mixing.exponent(sources.limit(0), 0.9, 2.0) == 1.0


def test_token_count(spark):
    texts = [None, "", " ", "a", " a\tb\n\x0bc\x0c\rd ", "a\u00a0b"]
    out = [r.n for r in frame(spark, [(t,) for t in texts], "text string").select(mixing.token_count(F.col("text")).alias("n")).collect()]
    assert out == [0, 0, 0, 1, 4, 1]


# --- op9: MinHash ------------------------------------------------------------------

def near_brute(docs, size, percent):
    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()

    sets = [(d, grams(t)) for d, t in docs]
    parent = {d: d for d, _ in sets if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return Counter((d, len(s), None if d is None else root(d), d is None or d == root(d)) for d, s in sets)


@pytest.mark.parametrize("size", [4, 5])
def test_near_groups(spark, monkeypatch, size):
    monkeypatch.setattr(minhash, "TILE_ROWS", 16)  # several blocks for the larger buckets
    rng = random.Random(size)
    docs = []
    for g in range(12):
        base = rng.choices(WORDS, k=rng.randrange(20, 120))
        for _ in range(rng.choice([1, 2, 5, 60])):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            docs.append((len(docs) * 3 + 5, rng.choice([" ", "\n", "  "]).join(words).title()))
    docs += [(1, None), (2, ""), (3, " \t"), (4, "One Two"), (4000, "one  two"), (4001, "one two three"), (None, docs[0][1]),
             (4002, docs[0][1]), (4002, docs[0][1]), (4003, "x y " * 30_000), (4004, "x y " * 30_001)]
    rows = frame(spark, [(*d, 1) for d in docs], DOC + ", n int")
    out = minhash.near_groups(rows, size=size, percent=80)
    assert as_counter(out, "doc_id", "n_shingles", "component_id", "kept") == near_brute(docs, size, 80)


def exchanged(plan):
    """For each shuffle of a plan by a key: the lines of the plan below it."""
    lines = [(re.search(r"\w", x).start(), x) for x in plan.splitlines() if re.search(r"\w", x)]
    for at, (depth, line) in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            upto = next((i for i in range(at + 1, len(lines)) if lines[i][0] <= depth), len(lines))
            yield "\n".join(x for _, x in lines[at + 1:upto])


@pytest.mark.parametrize("bits", [1 << 26, 1 << 4])
def test_near_groups_of_copies(spark, monkeypatch, bits):
    # With few bits the bitmaps are full, and rows without company pass them too.
    for name, thinned in (("possible", possible), ("absent", absent)):
        monkeypatch.setattr(minhash, name, lambda df, keys, key, thinned=thinned: thinned(df, keys, key, bits))
    rng = random.Random(11)
    bases = [rng.choices(WORDS, k=40) for _ in range(12)]
    docs = [(rng.randrange(40), rng.choice([" ", "  "]).join(bases[rng.randrange(12)])) for _ in range(60)]
    docs += [(100 + i, " ".join([*b, "w1"])) for i, b in enumerate(bases)]
    docs += [(200, "a b c d e"), (200, "a b c d e"), (201, "f g h i j"), (None, "a b c d e"), (None, docs[0][1])]
    out = minhash.near_groups(frame(spark, docs, DOC), size=4, percent=80)
    assert as_counter(out, "doc_id", "n_shingles", "component_id", "kept") == near_brute(docs, 4, 80)


def test_near_groups_moves_what_passes_the_bitmaps_only(spark, monkeypatch):
    plans = {}

    def noted(session, df, name):
        # As on large tables: nothing is small enough to be broadcast unasked.
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stored(session, df, name)

    stored, before = minhash.stored, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(minhash, "stored", noted)
    text = " ".join(WORDS)
    docs = [(1, text), (2, text), (3, text + " w1"), (4, "other words stand alone here")]
    try:
        out = minhash.near_groups(frame(spark, docs, DOC), size=4, percent=80)
        assert as_counter(out, "doc_id", "n_shingles", "component_id", "kept") == near_brute(docs, 4, 80)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [(name, below) for name, frames in plans.items() for plan in frames for below in exchanged(plan)]
    assert {"minhash-hubs", "minhash-sets"} <= {name for name, _ in moved}
    for name, below in moved:
        if re.search(r"\b(text|bands|sketch)#", below):
            assert "getbit(" in below, (name, below)


def test_near_groups_keeps_one_of_each(spark):
    text = " ".join(WORDS)
    docs = frame(spark, [(3, text, "x"), (2, text + " w1", "y"), (9, "other words stand alone here", "z"), (None, text, "n")],
                 DOC + ", kept string")
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {2, 9}  # a null doc_id comes last in its group
    assert minhash.near_groups(frame(spark, [], DOC)).count() == 0


def test_shingles_and_signatures():
    texts = ["", "a", "a b c d", "A  b\tC d e", "x" * 50_000, "a b c d a b c d a b c d", "é É"]
    hashes, counts = shingles.shingle_sets([t.encode() for t in texts], 4)
    assert counts.tolist() == [0, 1, 1, 2, 1, 4, 1]
    assert hashes[1] == hashes[2] or hashes[1] in hashes[2:4]
    rng = np.random.default_rng(2)
    close = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 500, dtype=np.uint64)
        pair = np.r_[np.sort(pool[:450]), np.sort(pool[50:])]
        one, two = minhash.signatures(pair, np.array([450, 450]))
        close.append((one == two).mean())
    assert abs(np.mean(close) - 0.8) < 0.02
    assert 0.01 < np.std(close) < 0.04


def test_tile_compares_bands_by_their_whole_keys():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 2**32, minhash.BANDS * minhash.ROWS, dtype=np.uint32)
    two = one.copy()
    two[:minhash.ROWS] ^= np.uint32(1 << 20)  # band 0 agrees in all low bytes only
    signed = np.array([one, two])
    bands = minhash.band_keys(signed).view(np.int64)
    assert (bands[0] == bands[1]).tolist() == [False] + [True] * (minhash.BANDS - 1)
    reported = []
    for band in range(1, minhash.BANDS):
        tile = pd.DataFrame({
            "key": bands[0, band], "low": 0, "high": 0, "block": 0, "band": band, "doc_id": [1, 2], "component": [1, 2], "n": 50,
            "sketch": [r.astype(np.uint8).tobytes() for r in signed], "earlier": list(bands[:, :band])})
        for out in minhash._tile_candidates(iter([tile]), minhash._least_equal(80), 80):
            reported.append((band, out["doc_id"].tolist(), [list(p) for p in out["partners"]]))
    assert reported == [(1, [1, 2], [[2], []])]


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links = chain + star + loose + [(5, 5), (100, 101)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    out = {r.node: r.component for r in components(frame(spark, links, "a long, b long")).collect()}
    assert out == {x: root(x) for x in parent if x != 5}
    assert components(frame(spark, [], "a long, b long")).count() == 0


def test_possible_never_holds_back_a_partner(spark):
    left = frame(spark, [(i, i % 3) for i in [*range(-50, 2000), 2**62, -2**63]], "k long, v int")
    right = frame(spark, [(i,) for i in [*range(-50, 2000, 7), 2**62, -2**63, 10**9]], "k long")
    partners = {r.k for r in left.join(right, "k", "left_semi").collect()}
    for bits in (1 << 26, 1 << 10):
        kept = possible(left, right, "k", bits)
        assert kept.columns == left.columns
        found = {r.k for r in kept.collect()}
        assert partners <= found
        assert bits < 1 << 20 or len(found) < len(partners) + 5
    assert possible(left, right.limit(0), "k").count() == 0


def test_absent_and_possible_are_all_rows(spark):
    left = frame(spark, [(i, i % 3) for i in [*range(-50, 2000), 7, 7, 2**62, -2**63]], "k long, v int")
    right = frame(spark, [(i,) for i in [*range(-50, 2000, 7), 2**62, 10**9]], "k long")
    for bits in (1 << 26, 1 << 10):
        rest = absent(left, right, "k", bits)
        assert rest.columns == left.columns
        both = as_counter(possible(left, right, "k", bits), "k", "v") + as_counter(rest, "k", "v")
        assert both == as_counter(left, "k", "v")
    assert absent(left, right.limit(0), "k").count() == left.count()


# --- op10: embeddings --------------------------------------------------------------

def vectors_brute(rows, least):
    ok = [(v, np.array(e, float), lab) for v, e, lab in rows if v is not None and lab is not None and e
          and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, parent = Counter(), {v: v for v, *_ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x, m) in enumerate(ok):
        for b, y, n in ok[:i]:
            if m == n and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[a] += 1
                links[b] += 1
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {v: (links[v], None if v is None else root(v)) for v, *_ in rows}


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 60)  # dense groups are cut into parts
    monkeypatch.setattr(embedding_dedup, "CENTRE_ROWS", 30)
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1):
        for size in (1, 2, 3, 90, 150, *[1] * 60):
            centre = rng.normal(size=32)
            for _ in range(size):
                rows.append((len(rows) + 10, (centre + rng.normal(size=32) * 0.15).astype(np.float32).tolist(), label))
    same = rows[0][1]
    inf, nan = float("inf"), float("nan")
    rows += [(1, same, 0), (2, same, 0), (3, [2 * x for x in same], 0), (4, same, None), (5, None, 0), (6, [0.0] * 32, 0),
             (7, [], 0), (8, [*same[:-1], None], 0), (9, [*same[:-1], inf], 0), (5000, [*same[:-1], nan], 0),
             (5001, same[:16], 0), (None, same, 0)]
    df = frame(spark, [(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    out = embedding_dedup.near_vectors(df).collect()
    true = vectors_brute(rows, 0.93)
    assert len(out) == len(rows)
    assert all(r.n_links <= true[r.vec_id][0] for r in out)
    found, real = sum(r.n_links for r in out), sum(n for n, _ in true.values())
    assert real > 5000 and found >= 0.97 * real
    assert sum(r.component_id == true[r.vec_id][1] for r in out) >= 0.99 * len(out)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)
    for v in (4, 5, 6, 7, 8, 9, 5000, 5001, None):
        assert [(r.n_links, r.component_id) for r in out if r.vec_id == v] == [(0, v)]
    assert out[0].audited_recall >= 0.9
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_all_pairs_are_compared_where_the_search_falls_short(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 70)
    monkeypatch.setattr(embedding_dedup, "CENTRE_ROWS", 30)
    monkeypatch.setattr(embedding_dedup, "WIDENINGS", 0)
    monkeypatch.setattr(embedding_dedup, "TARGET", 1.01)  # out of the search's reach
    rng = np.random.default_rng(21)
    rows = []
    for label in (0, 1):
        for size in (1, 2, 40, 120, *[2] * 40):
            centre = rng.normal(size=16)
            rows += [(len(rows) + k, (centre + rng.normal(size=16) * 0.25).tolist(), label) for k in range(size)]
    rows += [(5000, rows[0][1], 0), (5001, rows[0][1][:8], 0)]
    out = embedding_dedup.near_vectors(frame(spark, rows, "vec_id long, embedding array<double>, label int")).collect()
    true = vectors_brute(rows, 0.93)
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == true
    assert {(r.audited_recall, r.audited_vector_recall) for r in out} == {(1.0, 1.0)}


def test_range_search_finds_what_brute_force_finds():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 24))
    x[100:300] = x[100] + 0.2 * rng.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = embedding_dedup.build_graph(x)
    assert graph.shape[1] <= embedding_dedup.DEGREE
    x32 = x.astype(np.float32)
    hits = embedding_dedup.range_search(x32, graph, embedding_dedup.medoid(x32), x32, 0.93)
    true = x @ x.T >= 0.93
    assert not (hits & (x @ x.T < 0.9299)).any()
    assert (hits & true).sum() >= 0.98 * true.sum()


def test_a_large_group_does_not_hide_lost_pairs(spark, monkeypatch):
    # With one cell a vector many pairs are torn apart, beside a group with nearly all links.
    monkeypatch.setattr(embedding_dedup, "SHARD_ROWS", 500)
    monkeypatch.setattr(embedding_dedup, "CENTRE_ROWS", 150)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", 1)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=24)
    rows = [(centre + rng.normal(size=24) * 0.1).tolist() for _ in range(200)]
    for _ in range(500):
        x = rng.normal(size=24)
        rows += [x.tolist(), (x + rng.normal(size=24) * 0.36).tolist()]
    rows = [(i, e, 0) for i, e in enumerate(rows)]
    out = embedding_dedup.near_vectors(frame(spark, rows, "vec_id long, embedding array<double>, label int")).collect()
    true = vectors_brute(rows, 0.93)
    assert all(r.n_links <= true[r.vec_id][0] for r in out)
    pairs = [(r.n_links, true[r.vec_id][0]) for r in out if r.vec_id >= 200 and true[r.vec_id][0]]
    assert len(pairs) > 300
    assert sum(f for f, _ in pairs) >= 0.93 * sum(n for _, n in pairs)
