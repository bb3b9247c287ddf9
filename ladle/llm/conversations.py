"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's role initials shall read ``(s?(ua)+)?``.  That language has
four states: nothing yet, after the system turn, after a user turn, after an
assistant turn.  An edit is one letter of the audit: (K)eep costs 0, (R)erole
to the role that can come next 2, (D)elete 3, (I)nsert of an empty turn with
that role 2; a truncated turn that stays adds 1, a blank or duplicate turn
must go.  Given the state before it, each letter leads to one state, so
different ways to one state have different audits.

The cheapest and, of those, ASCII-least audit comes from meeting in the
middle: the forward cost vector of the first half and the backward vector of
the second half (four numbers each) show which states an optimal repair can
have at the middle row; the audit-least of these crossings is what the first
half gives when it is solved with the backward vector as its price at the
end; then the second half is solved from the chosen state.  Memory is four
numbers per level, besides one byte per row.

How it is spread: rows are range-partitioned by (conversation, turn, role,
text), so a conversation of any size is cut into pieces of at most
``PIECE_ROWS`` rows and ``PIECE_BYTES`` of text.  A conversation that lies
within one piece is done there.  The others are solved the same way one
level up: a piece's 4 x 4 cost matrix stands for its rows, a pass over one
small row per piece gives the backward vectors at the piece ends, each piece
then tells which state it goes to from each state, and a second such pass
gives the state that each piece starts from.  Only the digest of a repaired
conversation must read its pieces one after the other; it streams them.

Rows of one turn are ordered by role, then text.  Rows equal in all of these
are counted, not listed, before anything is shuffled by conversation.

Defined cases: null role and null text are one space, and so are null ids and
turns where ``damage`` spells them; null turns come first and count neither
for gaps nor as distinct turns; null conversation ids are one conversation; an
empty role has no initial and must be reroled or go; very long texts are
cut off from others by ``PIECE_BYTES``; an empty table gives no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.common import attach_small, saved

PIECE_ROWS = 16_384
PIECE_BYTES = 4 << 20
TASK_BYTES = 16 << 20
SPACES = " \t\n\v\f\r"
STOPS = ".!?"
LEGAL = {"su", "ua", "au"}

# ---- the four-state machine ---------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
#: Price of ending in a state: the turns still to insert.
ACCEPT = (0, 4, 2, 0)
#: The state after an inserted or reroled turn.
FOLLOW = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: A row is one byte: 0 must go; else 1 + place of its initial here, + 4 when truncated.
INITIALS = "sua"
GONE = 0


def code_of(initial: str, truncated: bool) -> int:
    return 1 + (INITIALS.index(initial) if initial and initial in INITIALS else 3) + 4 * truncated


def _steps(code: int) -> list[list[tuple[int, int, str]]]:
    """Per state the (next state, cost, letters) of one row with the inserts before it."""
    out = []
    for start in range(4):
        found = []
        state, letters, cost = start, "", 0
        for _ in range(3):
            found.append((state, cost + 3, letters + "D"))
            if code != GONE:
                late = int(code > 4)
                found.append((FOLLOW[state], cost + 2 + late, letters + "R"))
                kept = KEEP.get((INITIALS + "x")[(code - 1) % 4], {}).get(state)
                if kept is not None:
                    found.append((kept, cost + late, letters + "K"))
            state, letters, cost = FOLLOW[state], letters + "I", cost + 2
        out.append(found)
    return out


STEPS = [_steps(c) for c in range(9)]


@lru_cache(maxsize=1 << 16)
def _forth(vector: tuple, code: int) -> tuple:
    new = [FAR] * 4
    for s, cost in enumerate(vector):
        if cost < FAR:
            for t, c, _ in STEPS[code][s]:
                new[t] = min(new[t], cost + c)
    return _reduced(new)


@lru_cache(maxsize=1 << 16)
def _back(vector: tuple, code: int) -> tuple:
    return _reduced([min(c + vector[t] for t, c, _ in STEPS[code][s]) for s in range(4)])


def _reduced(v: list[int]) -> tuple[tuple, int]:
    low = min(v)
    return tuple(min(FAR, x - low) if x < FAR else FAR for x in v), low


def _swept(step, vector: tuple, codes) -> tuple[tuple, int]:
    """The vector behind all of ``codes``, less its smallest entry, and that entry."""
    v, base = _reduced(list(vector))
    for c in codes:
        v, low = step(v, c)
        base += low
    return v, base


def forward(codes: bytes, state: int) -> tuple:
    """Cost of each state behind ``codes``, from ``state`` before it."""
    v, base = _swept(_forth, tuple(0 if s == state else FAR for s in range(4)), codes)
    return tuple(x + base if x < FAR else FAR for x in v)


def backward(codes: bytes, prices: tuple) -> tuple:
    """Cost to the end of each state before ``codes``, with ``prices`` of the states behind it."""
    v, base = _swept(_back, prices, reversed(codes))
    return tuple(x + base for x in v)


def _least(codes: memoryview, state: int, prices: tuple, out: list[str]) -> int:
    """Appends the cheapest, ASCII-least letters for ``codes`` and gives the state behind them."""
    if len(codes) == 1:
        best = min(c + prices[t] for t, c, _ in STEPS[codes[0]][state])
        letters, to = min((w, t) for t, c, w in STEPS[codes[0]][state] if c + prices[t] == best)
        out.append(letters)
        return to
    if len(codes):
        mid = len(codes) // 2
        # the first half chooses the crossing: its optimal end states at these prices are the optimal crossings
        state = _least(codes[:mid], state, backward(codes[mid:], prices), out)
        state = _least(codes[mid:], state, prices, out)
    return state


def least_audit(codes: bytes, state: int = START, prices: tuple = ACCEPT) -> tuple[str, int]:
    """(letters, state behind them); the inserts that the end takes are not in them."""
    out: list[str] = []
    to = _least(memoryview(codes), state, prices, out)
    return "".join(out), to


def closing(state: int) -> str:
    return "I" * (ACCEPT[state] // 2)


@lru_cache(maxsize=1 << 14)
def _solved(codes: bytes) -> tuple[int, str]:
    audit, state = least_audit(codes)
    return min(a + b for a, b in zip(forward(codes, START), ACCEPT)), audit + closing(state)


def solve(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return _solved(codes) if len(codes) <= 64 else _solved.__wrapped__(codes)


def apply_audit(codes: bytes, spoken: list[tuple[str, str]], audit: str, state: int = START) -> list[tuple[str, str]]:
    """The repaired turns; ``spoken`` has (role, text) of the rows that may stay."""
    out, row, at = [], 0, 0
    for letter in audit:
        if letter == "I":
            state = FOLLOW[state]
            out.append((NAMES[state], ""))
            continue
        if codes[row] != GONE:
            role, text = spoken[at]
            at += 1
            if letter == "K":
                state = KEEP[role[0]][state]
                out.append((role, text))
            elif letter == "R":
                state = FOLLOW[state]
                out.append((NAMES[state], text))
        row += 1
    return out


def _spelled(turns: list[tuple[str, str]]) -> bytes:
    return "\n".join([f"{r}:{t}" for r, t in turns]).encode("utf-8", "surrogatepass")


# ---- pieces ---------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
#: ``closed``: the row is a whole conversation with its result; else one piece of several.
_FIELDS = [("key", pa.int64()), ("ord", pa.int64()), ("closed", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS],
           ("lo", pa.int64()), ("hi", pa.int64()), ("turns", pa.int64()), ("head_turn", pa.int64()),
           ("tail_turn", pa.int64()), ("head", pa.string()), ("tail", pa.string()), ("n", pa.int64()),
           ("cost", pa.int64()), ("audit", pa.string()), ("sha", pa.string()), ("codes", pa.binary()),
           ("spoken", pa.list_(_TURN))]
_DDL = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string", pa.binary(): "binary",
        pa.list_(_TURN): "array<struct<role: string, text: string>>"}


def _ddl(fields: list) -> str:
    return ", ".join(f"{n} {_DDL[t]}" for n, t in fields)


def _batch(fields: list, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in fields], [n for n, _ in fields])


def _as_structs(turns: list[tuple[str, str]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in turns]


class _Run:
    """Rows of one conversation, in order, up to a piece."""

    def __init__(self, key, whole: bool):
        self.key, self.whole = key, whole  # whole: nothing of it came before
        self.codes, self.spoken, self.bytes = bytearray(), [], 0
        self.count = dict.fromkeys(_COUNTS, 0)
        self.lo = self.hi = self.head_turn = self.tail_turn = self.head = self.tail = None
        self.turns = 0

    def add(self, turn, role: str, text: str, n: int, said: bool) -> None:
        """``n`` equal rows, of which ``said`` tells whether the first repeats an earlier turn's."""
        initial, core = role[:1], text.strip(SPACES)
        if not self.codes:
            self.head, self.head_turn = initial, turn
        else:
            self.count["illegal"] += (self.tail + initial) not in LEGAL
        self.count["illegal"] += n - 1
        if turn is not None:
            self.turns += self.lo is None or turn != self.hi
            self.lo = turn if self.lo is None else self.lo
            self.hi = turn
        self.tail, self.tail_turn = initial, turn
        if not core:
            self.count["blank"] += n
            self.codes += bytes(n)
            return
        self.count["duplicate"] += n - 1 + said
        late = core[-1] not in STOPS and not said
        self.count["truncated"] += late
        if said:
            self.codes += bytes(n)
        else:
            self.codes.append(code_of(initial, late))
            self.codes += bytes(n - 1)
            self.spoken.append((role, text))
            self.bytes += len(text)

    def row(self, ord_: int, closed: bool, with_turns: bool) -> dict:
        out = {"key": self.key, "ord": ord_, "closed": closed, **self.count, "lo": self.lo, "hi": self.hi, "turns": self.turns,
               "n": len(self.codes)}
        codes = bytes(self.codes)
        if not closed:
            return out | {"head_turn": self.head_turn, "tail_turn": self.tail_turn, "head": self.head, "tail": self.tail,
                          "codes": codes, "spoken": _as_structs(self.spoken)}
        cost, audit = solve(codes)
        turns = apply_audit(codes, self.spoken, audit)
        return out | {"cost": cost, "audit": audit, "sha": hashlib.sha256(_spelled(turns)).hexdigest(),
                      "spoken": _as_structs(turns) if with_turns else None}


def _cut(with_turns: bool, piece_rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        run, out, held = None, [], 0
        for b in batches:
            for key, turn, role, text, n, said in zip(*[c.to_pylist() for c in b.columns]):
                if run is None or key != run.key:
                    if run is not None:
                        number += 1
                        out.append(run.row(number, run.whole, with_turns))
                        held += run.bytes
                    run = _Run(key, run is not None)  # the first may go on from the task before
                while n:
                    some = min(n, piece_rows - len(run.codes))
                    run.add(turn, role, text, some, said)
                    n, said = n - some, True
                    if len(run.codes) >= piece_rows or run.bytes >= PIECE_BYTES:
                        number += 1
                        out.append(run.row(number, False, with_turns))
                        held += run.bytes
                        run = _Run(key, False)
                if held >= PIECE_BYTES or len(out) >= 2000:
                    yield _batch(_FIELDS, out)
                    out, held = [], 0
        if run is not None:
            out.append(run.row(number + 1, False, with_turns))  # may go on in the next task
        yield _batch(_FIELDS, out)

    return work


# ---- conversations of several pieces ------------------------------------------------


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A piece's costs from each state to each state."""
    for b in batches:
        costs = [[x for s in range(4) for x in forward(c.as_py(), s)] for c in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(costs, pa.list_(pa.int64()))],
                                         ["key", "ord", "costs"])


def _prices(pieces: pd.DataFrame) -> pd.DataFrame:
    """Backward vectors at the end of each piece of a conversation."""
    p = pieces.sort_values("ord", ascending=False)
    v, out = ACCEPT, []
    for m in p["costs"]:
        out.append([int(x) for x in v])
        v = tuple(min(m[4 * s + t] + v[t] for t in range(4)) for s in range(4))
    return pd.DataFrame({"ord": p["ord"], "prices": out})


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each piece's least letters lead to from each state before it."""
    for b in batches:
        to = [[least_audit(c.as_py(), s, tuple(v.as_py()))[1] for s in range(4)] for c, v in zip(b.column(2), b.column(3))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(to, pa.list_(pa.int64()))], ["key", "ord", "to"])


def _starts(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state each piece of a conversation starts from, and whether it is the last."""
    p = pieces.sort_values("ord")
    state, out = START, []
    for to in p["to"]:
        out.append(state)
        state = int(to[state])
    return pd.DataFrame({"ord": p["ord"], "state": out, "last": [False] * (len(out) - 1) + [True]})


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece with its part of the audit, its repaired turns and what it costs."""
    for b in batches:
        rows = b.to_pylist()
        for r in rows:
            audit, to = least_audit(r["codes"], r["state"], tuple(r["prices"]))
            r["cost"] = forward(r["codes"], r["state"])[to] + (ACCEPT[to] if r["last"] else 0)
            r["audit"] = audit + (closing(to) if r["last"] else "")
            r["spoken"] = _as_structs(apply_audit(r["codes"], [(x["role"], x["text"]) for x in r["spoken"]], r["audit"],
                                                  r["state"]))
            r["codes"] = None
        yield _batch(_FIELDS, rows)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces, which come in order; texts are hashed as they pass."""
    now: dict | None = None
    digest, said, letters = None, False, []

    def done() -> pa.RecordBatch:
        return _batch(_FIELDS, [now | {"sha": digest.hexdigest(), "audit": "".join(letters)}])

    for b in batches:
        for r in b.to_pylist():
            if now is None or r["key"] != now["key"]:
                if now is not None:
                    yield done()
                now = {"key": r["key"], "ord": r["ord"], "closed": True, **dict.fromkeys(_COUNTS, 0), "turns": 0, "n": 0, "cost": 0}
                digest, said, letters = hashlib.sha256(), False, []
                lo = hi = tail = tail_turn = None
            if r["n"]:
                if tail is not None and tail + r["head"] not in LEGAL:
                    now["illegal"] += 1
                now["turns"] -= tail_turn is not None and tail_turn == r["head_turn"]
                tail, tail_turn = r["tail"], r["tail_turn"]
                lo = r["lo"] if lo is None else lo
                hi = hi if r["hi"] is None else r["hi"]
            for c in (*_COUNTS, "turns", "n", "cost"):
                now[c] += r[c]
            now |= {"lo": lo, "hi": hi}
            letters.append(r["audit"])
            if r["spoken"]:
                digest.update((b"\n" if said else b"") + _spelled([(x["role"], x["text"]) for x in r["spoken"]]))
                said = True
    if now is not None:
        yield done()


def _open_parts(pieces: DataFrame) -> DataFrame:
    """Pieces of cut conversations with their audits and repaired turns."""
    codes = pieces.select("key", "ord", "codes")
    prices = saved(codes.mapInArrow(_matrices, "key long, ord long, costs array<long>")
                   .groupBy("key").applyInPandas(_prices, "ord long, prices array<long>"), "piece-prices")
    moves = (attach_small(codes, prices, ["ord"]).select("key", "ord", "codes", "prices")
             .mapInArrow(_moves, "key long, ord long, to array<long>"))
    starts = saved(moves.groupBy("key").applyInPandas(_starts, "ord long, state long, last boolean"), "piece-starts")
    told = attach_small(attach_small(pieces, prices, ["ord"]), starts, ["ord"])
    return saved(told.mapInArrow(_repaired, _ddl(_FIELDS)), "piece-parts")


# ---- public -------------------------------------------------------------------------


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by crc32(``key:turn``) % 20; ``copies`` is 0 for a dropped row and 2 for a repeated one."""
    def spelled(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    d = rows.select(F.col(key).alias("key"), F.col(turn).alias("turn"), spelled(role).alias("role"), spelled(text).alias("text"),
                    (F.crc32(F.concat(spelled(key), F.lit(":"), spelled(turn)).cast("binary")) % 20).alias("fault"))
    fault = F.col("fault")
    return d.select(F.col("key").alias(key), F.col("turn").alias(turn),
                    F.when(fault == 4, "user").otherwise(F.col("role")).alias(role),
                    F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias(text),
                    F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"))


def repair_parts(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 copies: str | None = None, piece_rows: int = PIECE_ROWS, with_turns: bool = True) -> tuple[DataFrame, DataFrame]:
    """(whole conversations, pieces of cut ones), each with audit and, in ``spoken``, repaired turns.

    ``copies``: a column that says how often a row stands (0: it is gone, but its conversation is known).
    """
    n = F.lit(1) if copies is None else F.col(copies)
    d = rows.select(F.col(key).cast("long").alias("key"), F.col(turn).cast("long").alias("turn"),
                    F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                    n.cast("long").alias("n"))
    gone = F.col("n") == 0  # keeps no more than the id
    d = d.select("key", F.when(gone, None).otherwise(F.col("turn")).alias("turn"),
                 *[F.when(gone, "").otherwise(F.col(c)).alias(c) for c in ("role", "text")], "n")
    d = saved(d.groupBy("key", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("d", F.md5("text")), "turns")
    # what a conversation says in several turns, and where first
    said = (d.where("n > 0").groupBy("key", "role", "d")
            .agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("first"), F.count(F.lit(1)).alias("m"))
            .where("m > 1").select("key", "role", "d", F.col("first.turn").alias("first"), F.lit(True).alias("known")))
    marked = attach_small(d, saved(said, "said"), ["key", "role", "d"])
    marked = marked.select("key", "turn", "role", "text", "n",
                           (F.coalesce("known", F.lit(False)) & ~F.col("first").eqNullSafe(F.col("turn"))).alias("said"))
    size = d.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    order = [F.col("key").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    cut = (marked.repartitionByRange(max(1, -(-size // TASK_BYTES)), *order).sortWithinPartitions(*order)
           .mapInArrow(_cut(with_turns, piece_rows), _ddl(_FIELDS)))
    parts = saved(cut, "conversation-parts")
    return parts.where("closed"), _open_parts(parts.where("NOT closed"))


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           copies: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: gaps, faults by kind, cost, audit and the digest of the repaired turns."""
    whole, pieces = repair_parts(rows, key, turn, role, text, copies, piece_rows, with_turns=False)
    joined = pieces.repartition("key").sortWithinPartitions("key", "ord").mapInArrow(_joined, _ddl(_FIELDS))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0))
    return whole.unionByName(joined).select(F.col("key").alias(key), gaps.cast("long").alias("gaps"), *_COUNTS, "cost", "audit",
                                            F.col("sha").alias("repaired_sha256"))


def repaired_turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                   copies: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The repaired conversations, one row per turn; (``ord``, ``pos``) is its order within its conversation."""
    whole, pieces = repair_parts(rows, key, turn, role, text, copies, piece_rows)
    return whole.unionByName(pieces).select(F.col("key").alias(key), "ord", F.posexplode("spoken").alias("pos", "t")).select(
        key, "ord", "pos", F.col("t.role").alias(role), F.col("t.text").alias(text))
