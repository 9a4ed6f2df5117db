"""The pipeline's stages, each against brute force on its own input, and ``run``."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import minhash, mixing, quality
from marketlake.llm.catalog import tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm.test_operators import near_brute

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def documents(spark):
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for g in range(25):
        words = rng.choices(vocabulary, k=rng.randrange(12, 90))
        for c in range(rng.choice([1, 1, 2, 6])):
            near = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            text = rng.choice([" ", "\n"]).join(near)
            rows.append((rng.choice([len(rows), len(rows), 7, None]), text, "en", rng.choice(["hot", "hot", "s1", None])))
    rows += [(500, None, "en", "s1"), (501, "", "en", "s2"), (None, "", None, "s2"), (7, "a unique text of seven", "en", "s1"),
             (502, "same row here", "en", "s3"), (502, "same row here", "en", "s3"), (502, "same row here", "de", "s3")]
    return spark.createDataFrame([(*r, None) for r in rows], DOC)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_exact_stage(spark):
    docs = documents(spark)
    groups = defaultdict(list)
    for r in docs.collect():
        groups["".join(WORDS.findall(r.text or ""))].append(r)
    want = Counter()
    for members in groups.values():
        first = min(members, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        # Rows that repeat doc_id and text length within a group stay or go together.
        want.update(tuple(r) for r in members if (r.doc_id, len(r.text or "")) == (first.doc_id, len(first.text or "")))
    assert rows_of(STAGES["exact_dedup"](spark, docs, SF_SMALL)) == want


def test_near_stage(spark):
    docs = documents(spark)
    texts = sorted({r.text or "" for r in docs.collect()})
    component = {texts[i]: c for (i, _, c, _), n in near_brute(list(enumerate(texts)), 5, 80).items()}
    groups = defaultdict(list)
    want = Counter()
    for r in docs.collect():
        if WORDS.search(r.text or ""):
            groups[component[r.text]].append(r)
        else:
            want[tuple(r)] += 1
    got = rows_of(STAGES["minhash_dedup"](spark, docs, SF_SMALL))
    for members in groups.values():
        left = [r for r in members if tuple(r) in got]
        assert len({(r.doc_id, r.text) for r in left}) == 1  # one document of each group
        assert (left[0].doc_id is None, left[0].doc_id or 0) == min((r.doc_id is None, r.doc_id or 0) for r in members)
        assert sum(got[k] for k in {tuple(r) for r in left}) == sum(
            (r.doc_id, r.text) == (left[0].doc_id, left[0].text) for r in members)
    assert sum(got.values()) == sum(want.values()) + sum(
        got[tuple(r)] for r in {tuple(r): r for m in groups.values() for r in m}.values())
    assert all(got[k] == n for k, n in want.items())


def test_near_stage_judges_rows_by_their_own_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (2, "quite another text, which nothing else is like")],
                                 "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in minhash.keep_one_of_each(docs).collect()} == {
        (1, text), (2, "quite another text, which nothing else is like")}


@pytest.mark.parametrize("rows, times", [(3, 5), (4, 7), (5, 9), (6, 6)])
def test_equal_rows_are_dealt_exactly(spark, monkeypatch, rows, times):
    docs = spark.createDataFrame([(1, "equal text", "s")] * rows + [(2, "other", "s")], "doc_id long, text string, source string")
    placed = [("s", 1, k % rows) for k in range(times)]
    table = spark.createDataFrame([(*p, 0) for p in placed], "source string, doc_id long, copy long, pass int")
    digest = docs.where("doc_id = 1").selectExpr("xxhash64(text) AS sum").first()["sum"]
    monkeypatch.setattr(mixing, "mix", lambda *a: table.withColumn("sum", F.lit(digest)))
    out = mixing.mixed_documents(docs.repartition(3)).collect()
    assert Counter(r.doc_id for r in out) == {1: times}


def test_mixing_stage(spark):
    docs = documents(spark)
    given = docs.collect()
    out = STAGES["mixing"](spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    got = rows_of(out)
    assert set(got) == {tuple(r) for r in given}
    total, spent = Counter(), Counter()
    for r in given:
        total[r.source] += len(WORDS.findall(r.text or ""))
    for row, n in got.items():
        spent[row[3]] += n * len(WORDS.findall(row[1] or ""))
    tokens = {s: t for s, t in total.items() if t}
    a = mixing.exponent(spark.createDataFrame([(t,) for t in tokens.values()], "tokens long"), 0.95, 2.0)
    longest = max(len(WORDS.findall(r.text or "")) for r in given)
    for s, t in tokens.items():
        budget = (max(tokens.values()) / t) ** (1 - a) * t
        assert max(t, budget - longest) <= spent[s] <= budget + 1e-6, s
    # The order of blocks decides who is repeated: the same rows in any layout.
    assert rows_of(STAGES["mixing"](spark, docs.repartition(5), SF_SMALL)) == got


def test_quality_stage_is_a_plain_vote(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality.fit(docs, labels)
    given = docs.collect()
    want = Counter()
    for r in given:
        (counts,) = quality.shape_counts([(r.text or "").encode()])
        vector = model.embed(counts[None, :])[0].astype(np.float64)
        cosine = model.vectors.astype(np.float64) @ vector
        near = sorted(range(len(cosine)), key=lambda i: -cosine[i])[:quality.NEIGHBOURS]
        votes = [max(cosine[i], 0.0) ** quality.SHARPNESS for i in near]
        good = sum(v * model.labels[i] for v, i in zip(votes, near))
        score = good / sum(votes) if sum(votes) > 1e-12 else model.labels.mean()
        assert abs(score - quality.GOOD) > 1e-4  # no text of the table stands on the threshold
        want[tuple(r)] += int(score >= quality.GOOD)
    assert rows_of(STAGES["quality_classifier"](spark, docs, SF_SMALL)) == +want


def test_run_is_its_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
    want = Counter((r.doc_id, r.text) for r in docs.collect())
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in out) == want
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    for r in out:
        assert r.token_ids == library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.token_ids)
