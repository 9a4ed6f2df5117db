"""Conversation structure repair by a grammar-compressed dynamic programme.

A conversation is a sequence of role/fault symbols, one per row. Repairing it means
choosing edits so that the roles that are left read ``(s?(ua)+)?``. The automaton of
that language has four states, so a row is a 4 x 4 min-plus matrix: for a state
before it and a state after it, the least cost of what may be done with the row and
the inserts right before it. A sequence is the product of its rows' matrices.

Most conversations share most of their sequences. Re-Pair replaces the most frequent
pair of neighbouring symbols by a new symbol, again and again, over all sequences of
a shard together; every rule's matrix is computed once, from those of its two parts,
and stands for that stretch in every conversation. A rule does not hold the edits
themselves but an audit rope: for each entry the state between its two parts, from
which the string is read off at the end.

Ties go to the audit string that comes first in ASCII order, and matrices decide that
without any string. Entries of one row of a matrix end in different states; as the
edits determine the states, their strings differ, and none is a prefix of another
(inserts stand only before a row, so each string ends with that row's edit). So a
rank for each entry, within its row, is all that a product needs to compare.

Rows are put in one order and cut into range shards, so a conversation that holds a
large share of all rows is spread over many tasks. Its pieces' matrices are then
combined in a stream, and a last stream of rows and chosen edits, in order, makes the
counts and the digest of the repaired text. Only that digest, which is defined over a
conversation's whole text, passes one conversation's rows through one task; it keeps
nothing of them but its own state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.arrow import arrow_schema, batched
from marketlake.llm.common import SPACES, ship_by_value, stored
from marketlake.llm.ranges import range_shards, shard_of

ship_by_value(__name__)

#: Rows of a range shard, and most rules of its grammar; what is left uncompressed
#: beyond them is multiplied symbol by symbol.
SHARD_ROWS = 50_000
MOST_RULES = 4_000

# The costs of the edits and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

# States of the automaton: nothing yet, after s, after u, after a.
STATES = 4
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_INITIALS = "sua"
_INFINITE = 1 << 40

#: Symbols of one row: role class (s, u, a, other) + 4 if truncated; or to be deleted.
DELETED = 8
ALPHABET = 9


def _next_role(state: int) -> str:
    """The role that an inserted or reroled row must have after ``state``."""
    return "a" if state == 2 else "u"


def _row_entries(symbol: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> (cost, edits) of one row and inserts before it."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(STATES):
        state = before
        for inserts in range(3):
            if inserts:
                state = _AFTER[_next_role(state)][state]
            paid, letters = inserts * INSERT, "I" * inserts
            found = [(state, DELETE, "D")]
            if symbol != DELETED:
                extra, role = (TRUNCATED if symbol >= 4 else 0), symbol % 4
                if role < 3 and state in _AFTER[_INITIALS[role]]:
                    found.append((_AFTER[_INITIALS[role]][state], KEEP + extra, "K"))
                found.append((_AFTER[_next_role(state)][state], REROLE + extra, "R"))
            for after, cost, letter in found:
                option = (paid + cost, letters + letter)
                best[before, after] = min(best.get((before, after), option), option)
    return best


def _row_ranks(keys: list) -> list[int]:
    """Ranks of a matrix row's entries by their keys; None (no entry) comes last."""
    order = sorted(range(STATES), key=lambda q: (keys[q] is None, keys[q] or ()))
    ranks = [0] * STATES
    for rank, q in enumerate(order):
        ranks[q] = rank
    return ranks


class Grammar:
    """Matrices of all symbols: those of single rows, then one per rule."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, int] | None] = []
        self.letters: list[dict] = []
        self.cost: list[np.ndarray] = []
        self.rank: list[np.ndarray] = []
        self.middle: list[np.ndarray | None] = []
        for symbol in range(ALPHABET):
            entries = _row_entries(symbol)
            cost = np.full((STATES, STATES), _INFINITE, np.int64)
            for (p, q), (paid, _) in entries.items():
                cost[p, q] = paid
            rank = [_row_ranks([(entries[p, q][1],) if (p, q) in entries else None for q in range(STATES)])
                    for p in range(STATES)]
            self._add(None, {k: letters for k, (_, letters) in entries.items()}, cost, np.array(rank, np.int64), None)

    def _add(self, parts, letters, cost, rank, middle) -> int:
        self.parts.append(parts)
        self.letters.append(letters)
        self.cost.append(cost)
        self.rank.append(rank)
        self.middle.append(middle)
        return len(self.parts) - 1

    def rule(self, left: int, right: int) -> int:
        """A new symbol for ``left`` followed by ``right``."""
        total = self.cost[left][:, :, None] + self.cost[right][None, :, :]
        # Least cost first, then the audit of the left part.
        middle = np.argmin(total * STATES + self.rank[left][:, :, None], axis=1)
        cost = np.minimum(np.take_along_axis(total, middle[:, None, :], axis=1)[:, 0, :], _INFINITE)
        at = np.arange(STATES)
        key = np.take_along_axis(self.rank[left], middle, axis=1) * STATES + self.rank[right][middle, at]
        key = np.where(cost >= _INFINITE, STATES * STATES, key)
        rank = np.argsort(np.argsort(key, axis=1, kind="stable"), axis=1, kind="stable")
        return self._add((left, right), {}, cost, rank, middle)

    def audit(self, symbol: int, before: int, after: int) -> str:
        """The edits of one entry, read off the rope."""
        out, todo = [], [(symbol, before, after)]
        while todo:
            s, p, q = todo.pop()
            if self.parts[s] is None:
                out.append(self.letters[s][p, q])
            else:
                m = int(self.middle[s][p, q])
                todo += [(self.parts[s][1], m, q), (self.parts[s][0], p, m)]
        return "".join(out)


def re_pair(sequence: np.ndarray, grammar: Grammar, most_rules: int = MOST_RULES) -> np.ndarray:
    """Compress symbol sequences, each followed by -1, until no pair stands twice."""
    for _ in range(most_rules):
        left, right = sequence[:-1], sequence[1:]
        inside = np.flatnonzero((left >= 0) & (right >= 0))
        if not len(inside):
            break
        width = len(grammar.parts)
        codes = left[inside] * width + right[inside]
        kinds, counts = np.unique(codes, return_counts=True)
        top = int(np.argmax(counts))
        if counts[top] < 2:
            break
        a, b = divmod(int(kinds[top]), width)
        places = inside[codes == kinds[top]]
        if a == b:  # in a run of equal symbols every other place starts a pair
            new_run = np.r_[True, np.diff(places) > 1]
            begin = places[new_run][np.cumsum(new_run) - 1]
            places = places[(places - begin) % 2 == 0]
        sequence = sequence.copy()
        sequence[places] = grammar.rule(a, b)
        sequence = np.delete(sequence, places + 1)
    return sequence


def _piece_rows(convs: list, at: np.ndarray, symbols: np.ndarray, faults: str, begins: np.ndarray) -> Iterator[dict]:
    """One row per piece (a conversation's rows in a shard, from ``begins`` on), with
    its matrix and edits. Only the first and the last piece of a shard can belong to a
    conversation that was cut; the others start in state 0."""
    grammar = Grammar()
    ends = np.r_[begins[1:], len(symbols)]
    flat = np.insert(symbols, ends, -1)
    packed = re_pair(flat, grammar)
    stops = np.flatnonzero(packed < 0)
    starts = np.r_[0, stops[:-1] + 1]
    folded: dict[tuple, int] = {}
    entries: dict[tuple, tuple] = {}
    shard = at >> 33
    for i, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist())):
        top = tuple(packed[starts[i]:stops[i]].tolist())
        symbol = folded.get(top)
        if symbol is None:
            symbol = top[0]
            for following in top[1:]:
                symbol = grammar.rule(symbol, following)
            folded[top] = symbol
        inner = 0 < i < len(begins) - 1 and shard[begins[i - 1]] == shard[begin] == shard[begins[i + 1]]
        made = entries.get((symbol, inner))
        if made is None:
            pairs = [(p, q) for p in ([0] if inner else range(STATES)) for q in range(STATES)
                     if grammar.cost[symbol][p, q] < _INFINITE]
            made = entries[symbol, inner] = (
                pairs, [int(grammar.cost[symbol][k]) for k in pairs], [int(grammar.rank[symbol][k]) for k in pairs],
                [grammar.audit(symbol, *k) for k in pairs])
        pairs, costs, ranks, audits = made
        yield {"conv_id": convs[i], "at": int(at[begin]), "faults": faults[begin:end],
               "before": [p for p, _ in pairs], "after": [q for _, q in pairs],
               "costs": costs, "ranks": ranks, "audits": audits}


_PIECE = ("conv_id {conv}, at long, faults string, before array<int>, after array<int>, costs array<long>, "
          "ranks array<int>, audits array<string>")
_CHOSEN = "conv_id {conv}, at long, faults string, audit string, cost long"
_RESULT = ("conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _pieces(symbols: DataFrame, shards: int, conv: str) -> DataFrame:
    """``symbols`` (conv_id, at, symbol, fault) -> the pieces of every shard."""
    ddl = _PIECE.format(conv=conv)
    schema = arrow_schema(ddl)

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [part for part in parts if part.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        convs = table.column("conv_id").to_pylist()
        at = table.column("at").to_numpy()
        new = [i == 0 or convs[i] != convs[i - 1] or at[i] >> 33 != at[i - 1] >> 33 for i in range(len(convs))]
        begins = np.flatnonzero(np.array(new))
        rows = _piece_rows([convs[i] for i in begins], at, table.column("symbol").to_numpy().astype(np.int64),
                           "".join(table.column("fault").to_pylist()), begins)
        yield from batched(rows, schema)

    return (
        symbols.repartition(shards, shard_of()).sortWithinPartitions("at")
        .select("conv_id", "at", "symbol", "fault").mapInArrow(make, ddl)
    )


# Edits after the last row: state -> (cost, inserts) to an accepting state.
_CLOSING = {0: (0, ""), 1: (2 * INSERT, "II"), 2: (INSERT, "I"), 3: (0, "")}


def combine(pieces: list[dict]) -> tuple[int, list[str]]:
    """Least cost and the edits of every piece of one conversation, in order."""
    costs, ranks = {0: 0}, {0: 0}
    back: list[dict[int, tuple[int, int]]] = []
    for piece in pieces:
        best: dict[int, tuple] = {}
        entries = zip(piece["before"], piece["after"], piece["costs"], piece["ranks"])
        for k, (p, q, cost, rank) in enumerate(entries):
            if p in costs:
                option = (costs[p] + cost, ranks[p], rank, p, k)
                best[q] = min(best.get(q, option), option)
        costs = {q: option[0] for q, option in best.items()}
        order = sorted(best, key=lambda q: best[q][1:3])
        ranks = {q: i for i, q in enumerate(order)}
        back.append({q: option[3:] for q, option in best.items()})
    state = min(costs, key=lambda q: (costs[q] + _CLOSING[q][0], ranks[q]))
    total, audits = costs[state] + _CLOSING[state][0], []
    tail = _CLOSING[state][1]
    for piece, choice in zip(reversed(pieces), reversed(back)):
        state, k = choice[state]
        audits.append(piece["audits"][k] + tail)
        tail = ""
    return total, audits[::-1]


def _chosen(pieces: DataFrame, conv: str) -> DataFrame:
    ddl = _CHOSEN.format(conv=conv)
    schema = arrow_schema(ddl)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        for part in parts:
            for row in part.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    yield from close(held)
                    held = []
                held.append(row)
        if held:
            yield from close(held)

    def close(held: list[dict]) -> Iterator[dict]:
        cost, audits = combine(held)
        for i, (piece, audit) in enumerate(zip(held, audits)):
            yield {"conv_id": piece["conv_id"], "at": piece["at"], "faults": piece["faults"], "audit": audit,
                   "cost": cost if i == 0 else 0}

    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(
        lambda parts: batched(rows(parts), schema), ddl)


class _Report:
    """Counts, edits and digest of one conversation, fed with its rows in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.cost, self.audits = conv_id, 0, []
        self.faults = self.edits = ""
        self.row = self.edit = self.state = self.turns = self.illegal = 0
        self.counts = {"b": 0, "d": 0, "t": 0, ".": 0}
        self.least = self.most = self.initial = None
        self.digest, self.lines = hashlib.sha256(), 0

    def piece(self, row: dict) -> None:
        self._close_piece()
        self.faults, self.edits, self.row, self.edit = row["faults"], row["audit"], 0, 0
        self.audits.append(row["audit"])
        self.cost += row["cost"]

    def _line(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _made(self) -> str:
        initial = _next_role(self.state)
        self.state = _AFTER[initial][self.state]
        return "assistant" if initial == "a" else "user"

    def _inserts(self) -> None:
        while self.edit < len(self.edits) and self.edits[self.edit] == "I":
            self._line(self._made(), "")
            self.edit += 1

    def _close_piece(self) -> None:
        self._inserts()

    def add(self, turn, role: str, text: str) -> None:
        self.counts[self.faults[self.row]] += 1
        self.row += 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.most:
            self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        self._inserts()
        edit = self.edits[self.edit]
        self.edit += 1
        if edit == "K":
            self.state = _AFTER[role[0]][self.state]
            self._line(role, text)
        elif edit == "R":
            self._line(self._made(), text)

    def result(self) -> dict:
        self._close_piece()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": self.counts["b"], "duplicate": self.counts["d"],
                "truncated": self.counts["t"], "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audits), "repaired_sha256": self.digest.hexdigest()}


def _reports(stream: DataFrame, conv: str) -> DataFrame:
    ddl = _RESULT.format(conv=conv)
    schema = arrow_schema(ddl)

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        report = None
        for part in parts:
            for row in part.to_pylist():
                if row["kind"] == 0:
                    if report is not None:
                        yield report.result()
                    report = _Report(row["conv_id"])
                elif row["kind"] == 1:
                    report.piece(row)
                else:
                    report.add(row["turn"], row["role"], row["text"])
        if report is not None:
            yield report.result()

    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind").mapInArrow(
        lambda parts: batched(rows(parts), schema), ddl)


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after the contract's damage, decided by
    crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2 takes its
    ``[.!?]`` out, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    def or_space(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    return (
        rows.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), code.alias("code"))
        .where("code <> 0")
        .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
                .otherwise(F.col("text")).alias("text"),
                F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
        .drop("copy")
    )


def repair_conversations(rows: DataFrame, every: DataFrame | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Faults and the cheapest repair of every conversation of ``rows`` (conv_id, turn,
    role, text). ``every`` names all conversations to report (default: those of ``rows``).

    Returns conv_id; gaps (turn numbers missing between the least and the greatest),
    blank, duplicate, truncated (rows by their first fault), illegal (neighbouring roles
    that are neither su, ua nor au), cost (all long); audit (the edits' initials: Keep,
    Rerole, Delete, Insert; of equally cheap ones the first in ASCII order) and
    repaired_sha256 (of the lines ``role:text`` that the edits leave).

    - Rows are in the order of turn (null first), role, and the SHA-256 of role and
      text; equal rows follow each other. A null role or text counts as one space.
    - A null conv_id is a conversation of its own.
    - Turns that are all null have no gaps. A conversation of ``every`` without rows has
      zeros, an empty audit and the digest of the empty string.
    - Other columns are not read. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    conv = rows.schema["conv_id"].dataType.simpleString()
    turn = F.col("turn").cast("long")
    filled = rows.select("conv_id", turn.alias("turn"), *[
        F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    mark = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    ordered, shards = range_shards(
        filled.withColumn("mark", mark), ["conv_id", "turn", "role", "mark"], "repair-rows", shard_rows)
    # Of equal rows of a conversation the first one; only of those that have company.
    firsts = stored(spark, (
        ordered.groupBy("conv_id", "mark").agg(F.min("at").alias("first"), F.max("at").alias("last"))
        .where("first < last").select(F.col("conv_id").alias("of"), F.col("mark").alias("like"), "first")
    ), "repair-firsts")
    role = F.substr("role", F.lit(1), F.lit(1))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (
        F.when(F.translate("text", SPACES, "") == "", "b").when(F.col("at") > F.col("first"), "d")
        .when(~last.isin(".", "!", "?"), "t").otherwise(".")
    )
    named = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    symbol = F.when(F.col("fault").isin("b", "d"), DELETED).otherwise(named + F.when(F.col("fault") == "t", 4).otherwise(0))
    symbols = (
        ordered.join(firsts.hint("merge"), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("like")), "left")
        .withColumn("fault", fault).select("conv_id", "at", symbol.cast("int").alias("symbol"), "fault")
    )
    pieces = stored(spark, _pieces(symbols, shards, conv), "repair-pieces")
    chosen = stored(spark, _chosen(pieces, conv), "repair-edits")
    heads = (every if every is not None else rows).select("conv_id").distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"))
    stream = (
        heads.unionByName(chosen.select("*", F.lit(1).alias("kind")), allowMissingColumns=True)
        .unionByName(ordered.select("conv_id", "at", "turn", "role", "text", F.lit(2).alias("kind")), allowMissingColumns=True)
    )
    return _reports(stream.select("conv_id", "at", "kind", "faults", "audit", "cost", "turn", "role", "text"), conv)
