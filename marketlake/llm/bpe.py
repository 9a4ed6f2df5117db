"""BPE encoding and decoding in batched numpy merge rounds.

The distinct words of a block of documents are laid out as one flat array of
symbols. A round looks up every adjacent pair at once by binary search over the
sorted pair keys, takes each word's lowest rank with one segmented minimum and
merges all its occurrences, left to right; words without a mergeable pair leave
the array. The number of rounds is that of the word with the most merges, not
the number of words.

Texts made of code points that Unicode 3.2 assigns are normalised, lower-cased and
split here: their properties are fixed since then, so every table agrees on them. A
text that holds any other code point is normalised and split by the vocabulary's own
normaliser and pre-tokeniser in the tokenizers library, whose tables are of another
Unicode version than Python's; its words are merged here like all others.

Spark splits the documents; a task holds one block of texts (about
``BLOCK_CHARS`` characters, or one longer text) and a bounded word cache.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marketlake.llm.common import ship_by_value

ship_by_value(__name__)

#: Characters of text that are encoded at a time.
BLOCK_CHARS = 2_000_000
#: Words whose ids a worker keeps between blocks; when full it starts anew.
CACHE_WORDS = 300_000

# The pre-tokenizer's pattern and the white space of Unicode.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE = r"\t-\r \x85\xa0  -     　"
_WORDS = regex.compile(_SPLIT.replace(r"\s", _SPACE))
_ASCII_WORDS = re.compile(_SPLIT.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(
    r"\p{L}\p{N}", "a-z0-9"), re.ASCII)

_NO_RANK = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 for
    itself, the rest in order from code point 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    alphabet = {b: chr(b) for b in shown}
    for byte in range(256):
        if byte not in alphabet:
            alphabet[byte] = chr(256 + len(alphabet) - len(shown))
    return [alphabet[b] for b in range(256)]


def later_code_points() -> str:
    """A pattern for any code point that Unicode 3.2 leaves unassigned or private."""
    unsettled = [unicodedata.ucd_3_2_0.category(chr(i)) in ("Cn", "Co", "Cs") for i in range(0x110000)]
    edges = np.flatnonzero(np.diff(np.r_[False, unsettled, False].astype(np.int8)))
    return "[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())) + "]"


class BpeModel:
    """A byte-level BPE vocabulary with a word-end suffix, as numpy tables."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.full(size, "", dtype=object)
        for table in (vocab, self.special):
            for token, at in table.items():
                self.tokens[at] = token
        self.first = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in byte_alphabet()], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.size, self.keys, self.ranks = size, keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b[: len(b)]] for a, b in pairs], dtype=np.int64)[order]
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._later = re.compile(later_code_points())
        # The library's part of the vocabulary: how a text is normalised and split.
        self._split_spec = json.dumps({
            "version": spec.get("version", "1.0"), "normalizer": spec["normalizer"], "pre_tokenizer": spec["pre_tokenizer"],
            "model": {"type": "BPE", "vocab": {}, "merges": []}})
        self._split_bytes = {ord(c): b for b, c in enumerate(byte_alphabet())}
        self._library = None

    @classmethod
    def load(cls, path: str) -> BpeModel:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def tables(self) -> dict:
        """The model as plain values, to be sent to the executors."""
        return {**self.__dict__, "_library": None}

    @classmethod
    def of(cls, tables: dict) -> BpeModel:
        model = cls.__new__(cls)
        model.__dict__.update(tables)
        return model

    def words(self, text: str) -> list[str]:
        """The text's words; a special token stands as a word of its own, marked
        by a leading space, which no other word holds."""
        if self._special is None or "<" not in text:
            return self._plain(text)
        out: list[str] = []
        at = 0
        for m in self._special.finditer(text):
            out += self._plain(text[at:m.start()])
            out.append(" " + m[0])
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not self._later.search(text):
            return _plain_words(text)
        if self._library is None:
            import tokenizers

            self._library = tokenizers.Tokenizer.from_str(self._split_spec)
        shown = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [w.translate(self._split_bytes).encode("latin-1").decode("utf-8") for w, _ in shown]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and each word's number of ids."""
        own = [self.special.get(w[1:]) if w[:1] == " " else None for w in words]
        raw = [b"" if s is not None else w.encode("utf-8") for w, s in zip(words, own)]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols = self.first[data]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        symbols[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(raw)), sizes)
        done = [(np.array([i for i, s in enumerate(own) if s is not None], dtype=np.int64),
                 np.array([s for s in own if s is not None], dtype=np.int64))]
        while len(symbols):
            symbols, word = self._round(symbols, word, done)
        at = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(at, kind="stable")
        return ids[order], np.bincount(at, minlength=len(raw))

    def _round(self, symbols: np.ndarray, word: np.ndarray, done: list) -> tuple[np.ndarray, np.ndarray]:
        """One merge of every word's lowest-ranked pair; finished words go to ``done``."""
        key = symbols * self.size
        key[:-1] += symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        hit[:-1] &= word[:-1] == word[1:]
        hit[-1] = False
        rank = np.where(hit, self.ranks[at], _NO_RANK)
        begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, begins)
        lowest = np.repeat(lowest, np.diff(np.r_[begins, len(word)]))
        live = lowest != _NO_RANK
        if not live.all():
            done.append((word[~live], symbols[~live]))
        chosen = hit & (rank == lowest)
        # A pair of equal symbols can overlap itself: take every other one of a run.
        place = np.arange(len(chosen))
        run = np.maximum.accumulate(np.where(chosen, 0, place + 1))
        chosen &= (place - run) % 2 == 0
        symbols = np.where(chosen, self.merged[at], symbols)
        live[1:] &= ~chosen[:-1]
        return symbols[live], word[live]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' own strings joined by a space (the vocabulary has no decoder)."""
        return " ".join(self.tokens[ids].tolist())


def _plain_words(text: str) -> list[str]:
    # Lower-casing goes character by character: a final capital sigma is no special case.
    if text.isascii():
        return _ASCII_WORDS.findall(text.lower())
    return _WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


class Encoder:
    """Encodes blocks of texts and keeps the ids of words it has seen."""

    def __init__(self, model: BpeModel):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self._code: dict[str, int] = {}
        self._pool = np.empty(0, dtype=np.uint32)
        self._lengths = np.empty(0, dtype=np.int64)

    def _learn(self, words: list[str]) -> None:
        ids, counts = self.model.encode_words(words)
        self._code.update(zip(words, range(len(self._code), len(self._code) + len(words))))
        self._pool = np.concatenate([self._pool, ids.astype(np.uint32)])
        self._lengths = np.concatenate([self._lengths, counts])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._code) > CACHE_WORDS:
            self._clear()
        words = [self.model.words(t) for t in texts]
        sizes = [len(w) for w in words]
        flat = [w for doc in words for w in doc]
        self._learn(list(dict.fromkeys(w for w in flat if w not in self._code)))
        codes = np.fromiter(map(self._code.__getitem__, flat), dtype=np.int64, count=len(flat))
        starts = np.cumsum(self._lengths) - self._lengths
        each = self._lengths[codes]
        ends = np.cumsum(each)
        out = self._pool[np.repeat(starts[codes] - (ends - each), each) + np.arange(int(each.sum()))]
        cuts = np.r_[0, ends][np.r_[0, np.cumsum(sizes, dtype=np.int64)]]
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    block: list[str] = []
    chars = begin = 0
    for i, text in enumerate(texts):
        block.append(text or "")
        chars += len(block[-1])
        if chars >= BLOCK_CHARS or i + 1 == len(texts):
            yield begin, block
            block, chars, begin = [], 0, i + 1


def _each(batches: Iterator[pa.RecordBatch], encode: Encoder, make) -> Iterator[pa.RecordBatch]:
    """``make(rows, ids)`` for every block: rows without the text to encode."""
    for batch in batches:
        rest = batch.drop_columns(["_x_text"])
        for begin, block in _blocks(batch.column("_x_text").to_pylist()):
            yield make(rest.slice(begin, len(block)), encode(block))


def _with_column(rows: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*rows.columns, *columns.values()], names=[*rows.schema.names, *columns])


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32))


def encode(docs: DataFrame, model_path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` with the token ids of ``text`` as an array<int> column ``out``.

    ``model_path`` is a tokenizer file the driver can read; its tables are sent
    to the executors, and their size is that of the vocabulary. A null or empty
    text has no ids. A column already named ``out`` is replaced; the text column
    stays. Rows are independent, so repeated rows and null keys need no rule.
    """
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(BpeModel.load(model_path).tables())
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches):
        encoder = Encoder(BpeModel.of(tables.value))
        return _each(batches, encoder, lambda rows, ids: _with_column(rows, **{out: _id_lists(ids)}))

    return docs.withColumn("_x_text", docs[text]).mapInArrow(run, schema)


def decode(docs: DataFrame, model_path: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the decoded text of the array<int> column ``ids`` as ``out``. Null
    or empty ids decode to an empty text; a column already named ``out`` is replaced."""
    tables = docs.sparkSession.sparkContext.broadcast(BpeModel.load(model_path).tables())
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        model = BpeModel.of(tables.value)
        for batch in batches:
            texts = [model.decode(np.asarray(row or [], dtype=np.int64)) for row in batch.column(ids).to_pylist()]
            yield _with_column(batch, **{out: pa.array(texts, pa.string())})

    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode every document: doc_id, n_tokens (long), ids_sha256 (of
    the ids as little-endian unsigned 32-bit integers) and decoded_sha256 (of the
    decoded text in UTF-8), both lowercase hex. A null text counts as empty.
    Other columns are not read."""
    tables = docs.sparkSession.sparkContext.broadcast(BpeModel.load(model_path).tables())

    def run(batches):
        model = BpeModel.of(tables.value)

        def digest(rows, ids):
            return _with_column(
                rows,
                n_tokens=pa.array([len(x) for x in ids], pa.int64()),
                ids_sha256=pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                decoded_sha256=pa.array(
                    [hashlib.sha256(model.decode(x).encode("utf-8")).hexdigest() for x in ids], pa.string()),
            )

        return _each(batches, Encoder(model), digest)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", docs["text"].alias("_x_text")).mapInArrow(run, schema)
