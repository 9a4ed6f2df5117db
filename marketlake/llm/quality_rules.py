"""Quality rules: how much of a text repeats itself.

Words of many texts are laid out in one flat array. For each of several lengths n a
rolling hash of every n-word window is made from the windows of one word less, and
windows of one text with equal hashes are found by sorting. Equal hashes are
confirmed on the words themselves. The windows that stand twice or more in their
text mark the words they cover, and the characters of marked words are what a
length's repetition covers; lines that repeat an earlier line are measured in the
same way. A text is refused when a share of its characters is over the length's
limit.

Texts are read whole, in blocks of a bounded size (or one longer text), inside
Arrow batches; there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import ship_by_value
from marketlake.llm.shingles import mix64

ship_by_value(__name__)

#: Most characters of a text that windows of n words found twice or more may cover.
COVERAGE_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
#: Most characters that lines equal to an earlier line may hold.
LINE_LIMIT = 0.30
#: Length of the windows that ``n_repeat_words`` counts.
BASE_LENGTH = 5
#: Fewest words of a text, and most of its words (percent) in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20

# The white space of the contracts, and the symbols that are counted.
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_TO_BLANK = str.maketrans(dict.fromkeys(_SPACES, " "))

#: Characters of text that are measured at a time, and most texts of a block.
BLOCK_CHARS = 1_000_000
BLOCK_TEXTS = 2_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _text_words(text: str) -> list[str]:
    return [w for w in text.translate(_TO_BLANK).split(" ") if w]


def repeated_words(words: np.ndarray, doc: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the ascending ``lengths``: which words of the flat array ``words``
    (numbers that stand for equal words) lie in a window of that many words that
    stands at least twice in its text. ``doc`` is every word's text, in order."""
    rolled = mix64(doc.astype(_U) * _BASE + _U(1))  # windows of different texts never match
    width = 0
    for n in lengths:
        while width < n:  # from windows of ``width`` words to windows of one more
            rolled = rolled[: len(words) - width]
            rolled = mix64(rolled * _BASE + words[width:].astype(_U))
            width += 1
        starts = np.flatnonzero(doc[: len(rolled)] == doc[n - 1:]) if len(rolled) else np.empty(0, np.int64)
        yield n, _covered(words, doc, rolled[starts], starts, n)


def _covered(words: np.ndarray, doc: np.ndarray, hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    inside = np.zeros(len(words) + 1, np.int64)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    company = np.flatnonzero(ranked[1:] == ranked[:-1])
    if len(company):
        first, second = starts[order[company]], starts[order[company + 1]]
        same = doc[first] == doc[second]
        for k in range(n):
            same &= words[first + k] == words[second + k]
        if not same.all():  # two different windows with one hash: compare them word by word
            return _covered_exactly(words, doc, starts, n)
        hit = np.union1d(first, second)
        inside[hit] += 1
        inside[hit + n] -= 1
    return np.cumsum(inside[:-1]) > 0


def _covered_exactly(words: np.ndarray, doc: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    grams = np.column_stack([doc[starts], *[words[starts + k] for k in range(n)]])
    _, group, size = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words), bool)
    for start in starts[size[group.ravel()] > 1]:
        covered[start:start + n] = True
    return covered


def measure(texts: list[str]) -> pd.DataFrame:
    """The measures of every text, one row each."""
    split = [_text_words(t) for t in texts]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for words in split for w in words]
    doc = np.repeat(np.arange(len(texts)), n_words)
    chars = np.fromiter(map(len, flat), np.int64, len(flat))
    ids = pd.factorize(np.array(flat, dtype=object))[0].astype(np.int64) if flat else np.empty(0, np.int64)

    def total(values: np.ndarray) -> np.ndarray:
        # Sums of integers below 2^53 are exact in the doubles that bincount returns.
        return np.bincount(doc, weights=values, minlength=len(texts)).astype(np.int64)

    out = {"n_words": n_words, "word_chars": total(chars)}
    out["n_symbols"] = np.array([sum(map(t.count, _SYMBOLS)) for t in texts], np.int64)
    dup_lines, dup_line_chars = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        seen: set[str] = set()
        for line in text.split("\n"):
            if line in seen:
                dup_lines[i] += 1
                dup_line_chars[i] += sum(map(len, _text_words(line)))
            elif line.strip(_SPACES):
                seen.add(line)
    out["n_dup_lines"] = dup_lines
    for n, covered in repeated_words(ids, doc, sorted({BASE_LENGTH, *COVERAGE_LIMITS})):
        if n == BASE_LENGTH:
            out["n_repeat_words"] = total(covered)
        out[f"dup_chars_{n}"] = total(np.where(covered, chars, 0))
    out["dup_line_chars"] = dup_line_chars
    return pd.DataFrame(out)


def _judged(measured: pd.DataFrame) -> pd.DataFrame:
    n_words, chars = measured["n_words"], measured["word_chars"]
    measured["base_failed"] = (n_words < LEAST_WORDS) | (100 * measured["n_repeat_words"] > MOST_REPEATED * n_words)
    kept = ~measured["base_failed"] & (measured["dup_line_chars"] <= LINE_LIMIT * chars)
    for n, limit in COVERAGE_LIMITS.items():
        kept &= measured[f"dup_chars_{n}"] <= limit * chars
    measured["kept"] = kept
    return measured


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block: list[str] = []
    held = 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= BLOCK_CHARS or len(block) >= BLOCK_TEXTS:
            yield block
            block, held = [], 0
    if block:
        yield block


LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         *[f"dup_chars_{n}" for n in sorted({BASE_LENGTH, *COVERAGE_LIMITS})], "dup_line_chars"]


def quality_rules(docs: DataFrame) -> DataFrame:
    """Repetition measures and verdict for every row of ``docs`` (doc_id, text).

    Returns doc_id; n_words; word_chars (code points in words); n_symbols; n_dup_lines
    (lines with a word that equal an earlier line); n_repeat_words (words in five-word
    windows that stand twice or more in the text); dup_chars_<n> (code points of words
    in repeated windows of n words) and dup_line_chars (of words in repeated lines), all
    long; base_failed (fewer than ``LEAST_WORDS`` words, or more than ``MOST_REPEATED``
    percent of them repeated) and kept (base passed, and no share of characters over
    ``COVERAGE_LIMITS`` or ``LINE_LIMIT``).

    Words are separated by the white space of ASCII. A null or empty text has no words:
    its measures are 0, the base fails. Repeated rows and doc_ids, null ones too, are
    rows of their own. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        f"{c} long" for c in LONGS) + ", base_failed boolean, kept boolean"

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column("text").to_pylist()]
            done = 0
            for block in _blocks(texts):
                judged = _judged(measure(block))
                ids = part.column("doc_id").slice(done, len(block))
                done += len(block)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(judged[c].to_numpy()) for c in [*LONGS, "base_failed", "kept"]]],
                    names=["doc_id", *LONGS, "base_failed", "kept"])

    return rows.mapInArrow(batches, schema)
