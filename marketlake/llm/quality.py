"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text is described by counts of the shapes it is written in: runs of character
classes (letter, capital, digit, each punctuation mark, space, line end) and
how often words repeat the words just before them. The counts are weighted
(sublinear frequency times inverse document frequency) and projected onto the
leading singular directions of a labelled sample. Every document then votes with
its nearest labelled vectors, each weighted by its cosine.

Only the classifier's reference set is bounded: up to ``PER_LABEL`` labelled
documents of either label, picked by a hash of doc_id. Its vectors (a few MB at
most, by these parameters) are sent to the executors, where the exact cosines of
a block of documents with all of them are one matrix product. Every document is
scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketlake.llm.common import ship_by_value
from marketlake.llm.shingles import text_blocks, word_hashes

ship_by_value(__name__)

#: Most labelled documents of each label in the reference set.
PER_LABEL = 500
#: Dimensions of the counts and of the latent space; neighbours that vote; power
#: of the cosine that weights a vote.
COUNTS, LATENT, NEIGHBOURS, SHARPNESS = 4096, 64, 15, 8
#: Score from which a document counts as good.
GOOD = 0.3
#: One row in FOLDS by the checksum of doc_id is held out.
FOLDS = 5

_REPEATS = 3  # distances at which a word may repeat an earlier one
_GRAMS = (3, 5)


def _character_classes() -> np.ndarray:
    classes = np.arange(256, dtype=np.uint64)  # a punctuation mark or space is its own class
    for begin, end, mark in ((0x61, 0x7A, "a"), (0x41, 0x5A, "A"), (0x30, 0x39, "0"), (0x80, 0xFF, "a")):
        classes[begin:end + 1] = ord(mark)
    return classes


_CLASS = _character_classes()


def shape_counts(texts: list[bytes]) -> np.ndarray:
    """A row of ``COUNTS`` sublinear counts for every text."""
    out = np.zeros((len(texts), COUNTS), dtype=np.float32)
    room = COUNTS - _REPEATS
    for row, text in zip(out, texts):
        code = _CLASS[np.frombuffer(text, dtype=np.uint8)]
        for n in _GRAMS:
            if len(code) < n:
                continue
            gram = code[n - 1:].copy()
            for k in range(n - 1):
                gram = gram * np.uint64(0x9E3779B97F4A7C15) + code[k:len(code) - n + 1 + k]
            gram *= np.uint64(0xBF58476D1CE4E5B9)
            row[:room] += np.bincount(((gram >> np.uint64(40)) % np.uint64(room)).astype(np.int64), minlength=room)
    words, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    for k in range(1, _REPEATS + 1):
        again = (words[k:] == words[:-k]) & (doc[k:] == doc[:-k])
        out[:, room + k - 1] = np.bincount(doc[k:][again], minlength=len(texts))
    return np.log1p(out, out=out)


class VotingModel:
    """Latent-semantic space and labelled vectors, fitted on a bounded sample."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray):
        present = (counts > 0).sum(axis=0)
        self.weight = np.log((1 + len(counts)) / (1 + present)).astype(np.float32)
        weighted = self._weighted(counts)
        # Leading right singular vectors, from the smaller Gram matrix.
        gram = weighted @ weighted.T
        values, vectors = np.linalg.eigh(gram.astype(np.float64))
        keep = np.argsort(-values)[:LATENT]
        keep = keep[values[keep] > 1e-6 * max(values.max(initial=0.0), 1e-12)]
        self.axes = (weighted.T @ (vectors[:, keep] / np.sqrt(values[keep]))).astype(np.float32)
        self.vectors = self.embed(counts)
        self.labels = labels.astype(np.float32)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        x = counts * self.weight
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def embed(self, counts: np.ndarray) -> np.ndarray:
        x = self._weighted(counts) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of the votes for label 1; documents without any feature get the
        labels' mean."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = self.embed(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosine, near, 1), 0.0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        good = (votes * self.labels[near]).sum(axis=1)
        return np.where(total > 1e-12, good / np.maximum(total, 1e-12), self.labels.mean())

    @classmethod
    def of(cls, values: dict) -> VotingModel:
        model = cls.__new__(cls)
        model.__dict__.update(values)
        return model


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from learning; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> VotingModel:
    """The model of a bounded sample: up to ``PER_LABEL`` documents of either label.

    Null labels are ignored, and so are labels without a document. A doc_id with
    several texts is represented by the smallest of them; one with both labels
    takes part with both.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("_x_label")).distinct()
    )
    picked = None
    for value in (0, 1):
        some = known.where(F.col("_x_label") == value).join(docs.select("doc_id"), "doc_id", "left_semi")
        some = some.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(PER_LABEL)
        picked = some if picked is None else picked.union(some)

    @pandas_udf("binary")
    def counts(texts: pd.Series) -> pd.Series:
        return pd.Series([r.tobytes() for _, block in text_blocks(texts.tolist()) for r in shape_counts(block)],
                         dtype=object)

    # At most 2 * PER_LABEL rows: the broadcast and what comes back are bounded.
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id", "_x_label").agg(F.min("text").alias("text"))
        .select("doc_id", "_x_label", counts("text").alias("counts")).collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["_x_label"]))
    matrix = np.array([np.frombuffer(r["counts"], dtype=np.float32) for r in rows]).reshape(len(rows), COUNTS)
    return VotingModel(matrix, np.array([r["_x_label"] for r in rows], dtype=np.float32))


def scorer(docs: DataFrame, model: VotingModel):
    """A column function text -> score that runs on the executors."""
    values = docs.sparkSession.sparkContext.broadcast(model.__dict__)

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = VotingModel.of(values.value)
        for texts in batches:
            yield pd.Series(np.concatenate([
                np.empty(0), *(own.score(shape_counts(block)) for _, block in text_blocks(texts.tolist()))]))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document: doc_id, held_out, score (0 to 1, higher: label 1
    likelier) and predicted (1 if score >= ``GOOD``).

    Only the text is an input of a score. Empty and null texts, and texts like
    no labelled one, get the mean of the reference labels; without any label
    every score is 0.5. Repeated rows are scored alike, one result row each.
    Other columns of ``docs`` are not read.
    """
    score = scorer(docs, fit(docs, labels))
    return (
        docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
        .withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is ``GOOD`` or more, with all their columns."""
    score = scorer(docs, fit(docs, labels))
    return docs.withColumn("_x_score", score("text")).where(F.col("_x_score") >= GOOD).drop("_x_score")
