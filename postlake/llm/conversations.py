"""Conversation structure repair by iterative-deepening A*.

A conversation is repaired by edits of its rows, taken in order: Keep,
Rerole (to user or assistant), Delete, and Insert of an empty user or
assistant row. The role initials of what stays must be ``(s?(ua)+)?``. The
search runs depth first, tries edits in ASCII order (D, I, K, R) and never
passes a cost bound; the bound rises to the least cost that was cut off.
A transposition table holds, for every (row, role before) that failed, the
largest budget it failed with. So the first accepting path has the least cost
and, among those, the ASCII-least edits. In a given state an Insert or Rerole
has one useful role only, so the edits alone fix what they give.

Rows are sorted once (by conversation and turn, dealt over range partitions)
and packed into pieces of at most ``PIECE`` rows of one conversation. A
conversation that is one piece is solved where it lies. For longer ones every
piece's costs from any role before it to any role after it are searched by
themselves, a reverse stream over a conversation's pieces (a few numbers each)
turns them into the cost of what follows, and each piece is then searched with
those costs as its goal; a forward stream chains the results. So no task holds
a conversation: tasks hold one piece, however long the conversation is. The
two streams of one conversation, and the one hash over its whole repaired
text, do run in one task, row after row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm import scratch

#: Rows of a conversation that are searched together.
PIECE = 16
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
WHITE = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60
# what the last row left is: nothing yet, system, user, assistant
_START, _S, _U, _A = range(4)
_NEXT = (_U, _U, _A, _U)               # the only role that may follow, if not a kept 's'
_NAMES = {_U: "user", _A: "assistant"}
_ACCEPT = (0, _NEVER, _NEVER, 0)
_LEGAL = {"su", "ua", "au"}

_PIECE_SCHEMA = ("piece long, ckey string, conv_id string, closed boolean, kinds string, turns array<long>, "
                 "roles array<string>, texts array<string>")
_RESULT = ("conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _least(kind: str) -> int:
    """The least that a row costs by itself. Kinds: ``d`` must go; s, u, a, x
    (any other initial) may stay, in upper case if truncated."""
    if kind == "d":
        return DELETE
    stay = REROLE if kind in "xX" else 0
    return min(DELETE, stay + (TRUNCATED if kind.isupper() else 0))


@lru_cache(maxsize=100_000)
def cheapest_edits(kinds: str, entry: int = _START, exits: tuple = _ACCEPT, last: bool = True) -> tuple | None:
    """(cost, edits, role state after them) of the cheapest, ASCII-least edits
    of rows ``kinds`` after state ``entry``; None if there are none.

    ``exits`` are the costs that follow each state. Only the ``last`` rows of
    a conversation may be followed by Inserts."""
    n = len(kinds)
    rest = [min(exits) if not last else 0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + _least(kinds[i])
    if rest[0] >= _NEVER:
        return None
    # every row deleted, or rerolled, with the Inserts that any end may need
    most = n * (REROLE + TRUNCATED + DELETE) + 3 * INSERT + max([e for e in exits if e < _NEVER], default=0)
    path: list[str] = []
    bound, over, failed = rest[0], _NEVER, {}

    def steps(i: int, q: int):
        kind = kinds[i] if i < n else ""
        if kind:
            yield "D", DELETE, i + 1, q
        if kind or last:
            yield "I", INSERT, i, _NEXT[q]
        if kind and kind != "d":
            extra = TRUNCATED if kind.isupper() else 0
            own = {"s": _S, "u": _U, "a": _A}.get(kind.lower())
            if own == _NEXT[q] or own == _S and q == _START:
                yield "K", extra, i + 1, own
            yield "R", REROLE + extra, i + 1, _NEXT[q]

    def search(i: int, q: int, left: int) -> int | None:
        """The state after an accepting path that costs at most ``left``."""
        nonlocal over
        if i == n:
            if exits[q] <= left:
                return q
            over = min(over, exits[q] - left)
            if not last:
                return None
        if failed.get((i, q), -1) >= left:
            return None
        for letter, cost, j, p in steps(i, q):
            if cost + rest[j] > left:
                over = min(over, cost + rest[j] - left)
                continue
            path.append(letter)
            end = search(j, p, left - cost)
            if end is not None:
                return end
            path.pop()
        failed[i, q] = left
        return None

    while bound <= most:
        over, failed = _NEVER, {}
        end = search(0, entry, bound)
        if end is not None:
            return bound - exits[end], "".join(path), end
        bound += over
    return None


def _cost(kinds: str, entry: int, end: int) -> int:
    """Least cost from one state to another over a piece that is not the last.

    Nothing leads back to the start or to a system row, so only Deletes do
    (and, from the start, one kept system row); a search would try every bound
    up to that cost, or all of them where there is no way."""
    if end == _START or end == _S and entry == _S:
        return DELETE * len(kinds) if entry == end else _NEVER
    if end == _S:
        kept = [TRUNCATED if k == "S" else 0 for k in kinds if k in "sS"]
        return DELETE * (len(kinds) - 1) + min(kept) if kept and entry == _START else _NEVER
    found = cheapest_edits(kinds, entry, tuple(0 if q == end else _NEVER for q in range(4)), False)
    return found[0] if found else _NEVER


def apply_edits(edits: str, entry: int, kinds: str, roles: list[str], texts: list[str]) -> Iterator[str]:
    """``role:text`` of each row that the edits give."""
    i, q = 0, entry
    for letter in edits:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            q = {"s": _S, "u": _U, "a": _A}[kinds[i].lower()]
            yield f"{roles[i]}:{texts[i]}"
        else:
            q = _NEXT[q]
            yield f"{_NAMES[q]}:{texts[i] if letter == 'R' else ''}"
        i += letter != "I"


class _Conversation:
    """Sums over a conversation's pieces, in order, and its result."""

    def __init__(self, conv_id: str | None):
        self.conv_id, self.state, self.cost, self.edits = conv_id, _START, 0, []
        self.hash, self.lines = hashlib.sha256(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.turn = self.role = None

    def add(self, kinds: str, faults: tuple[int, int, int], turns: list, roles: list[str], texts: list[str],
            found: tuple) -> None:
        cost, edits, end = found
        for line in apply_edits(edits, self.state, kinds, roles, texts):
            self.hash.update(("\n" if self.lines else "").encode() + line.encode())
            self.lines += 1
        self.cost, self.state = self.cost + cost, end
        self.edits.append(edits)
        self.blank, self.duplicate = self.blank + faults[0], self.duplicate + faults[1]
        self.truncated += faults[2]
        for turn, role in zip(turns, roles):
            if self.role is not None:
                self.illegal += self.role[:1] + role[:1] not in _LEGAL
            self.role = role
            if turn is not None and turn != self.turn:       # in order: a new turn
                self.first = turn if self.first is None else self.first
                self.turn, self.turns = turn, self.turns + 1

    def result(self) -> tuple:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.edits), self.hash.hexdigest())


def _table(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


_RESULT_NAMES = [c.split()[0] for c in _RESULT.split(", ")]
_RESULT_TYPES = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the sorted rows. A row that repeats an earlier one of its
    piece gets kind ``r``. ``closed``: surely the whole conversation."""
    names = [c.split()[0] for c in _PIECE_SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.list_(pa.int64()),
             pa.list_(pa.string()), pa.list_(pa.string())]
    number, held, done = TaskContext.get().partitionId() << 33, [], []
    whole = False                      # the piece's conversation starts with it

    def close(closed: bool) -> None:
        nonlocal number
        kinds, seen = [], set()
        for r in held:
            again = (r["role"], r["text"]) in seen
            seen.add((r["role"], r["text"]))
            kinds.append("r" if again and r["kind"] != "b" else r["kind"])
        done.append((number, held[0]["ckey"], held[0]["conv_id"], closed, "".join(kinds), [r["turn"] for r in held],
                     [r["role"] for r in held], [r["text"] for r in held]))
        number += 1
        held.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["ckey"] != row["ckey"]:
                close(whole)
                whole = True
            elif len(held) == PIECE:
                close(False)
                whole = False
            held.append(row)
        if done:
            yield _table(done, names, types)
            done.clear()
    if held:
        close(False)                   # it may go on in the next partition
        yield _table(done, names, types)


def _search_kinds(kinds: str) -> tuple[str, tuple[int, int, int]]:
    """Kinds for the search, and the numbers of blank, repeated, truncated rows."""
    return (kinds.replace("b", "d").replace("r", "d"),
            (kinds.count("b"), kinds.count("r"), sum(k.isupper() for k in kinds)))


def _solve_closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            kinds, faults = _search_kinds(row["kinds"])
            whole = _Conversation(row["conv_id"])
            whole.add(kinds, faults, row["turns"], row["roles"], row["texts"], cheapest_edits(kinds))
            out.append(whole.result())
        yield _table(out, _RESULT_NAMES, _RESULT_TYPES)


def _solve_open(pieces: DataFrame) -> DataFrame:
    """Results of the conversations that have several pieces, or lie at the
    edge of a partition."""
    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                kinds = _search_kinds(row["kinds"])[0]
                between = [_cost(kinds, p, q) for p in range(4) for q in range(4)]
                at_end = [found[0] if (found := cheapest_edits(kinds, p)) else _NEVER for p in range(4)]
                out.append((row["ckey"], row["piece"], row["kinds"], between, at_end))
            yield _table(out, ["ckey", "piece", "kinds", "between", "at_end"],
                         [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())])

    def following(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, after = None, None        # costs from each state to the end, after the piece
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                last = row["ckey"] != key
                out.append((row["piece"], row["kinds"], list(_ACCEPT) if last else after, last))
                m = row["between"]
                after = row["at_end"] if last else [
                    min(_NEVER, min(m[4 * p + q] + after[q] for q in range(4))) for p in range(4)]
                key = row["ckey"]
            yield _table(out, ["piece", "kinds", "exits", "last"],
                         [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.bool_()])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                kinds = _search_kinds(row["kinds"])[0]
                low = min(row["exits"])          # only their differences matter
                exits = tuple(e - low if e < _NEVER else _NEVER for e in row["exits"])
                found = [cheapest_edits(kinds, p, exits, row["last"]) or (_NEVER, "", p) for p in range(4)]
                out.append((row["piece"], row["kinds"], *([f[i] for f in found] for i in range(3))))
            yield _table(out, ["piece", "kinds", "costs", "edits", "ends"],
                         [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64())])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, whole = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if whole is None or row["ckey"] != key:
                    if whole is not None:
                        out.append(whole.result())
                    key, whole = row["ckey"], _Conversation(row["conv_id"])
                kinds, faults = _search_kinds(row["kinds"])
                p = whole.state
                whole.add(kinds, faults, row["turns"], row["roles"], row["texts"],
                          (row["costs"][p], row["edits"][p], row["ends"][p]))
            yield _table(out, _RESULT_NAMES, _RESULT_TYPES)
        if whole is not None:
            yield _table([whole.result()], _RESULT_NAMES, _RESULT_TYPES)

    rows = pieces.select("ckey", "piece", F.posexplode(F.arrays_zip("roles", "texts", F.split("kinds", ""))).alias("k", "r"))
    rows = rows.where(F.col("r")["2"] != "b").select(
        "ckey", "piece", "k", F.sha2(F.concat(F.col("r.roles"), F.lit("\0"), F.col("r.texts")).cast("binary"), 256).alias("digest"))
    rows = scratch.stored(rows, "turn-digests")
    first = rows.groupBy("ckey", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("piece", "k")).alias("first"))
    again = rows.join(first.where("n > 1").drop("n"), ["ckey", "digest"]).where(
        F.struct("piece", "k") != F.col("first")).groupBy("piece").agg(F.collect_list("k").alias("again"))  # at most PIECE
    kinds = pieces.select("ckey", "piece", "kinds").join(again, "piece", "left").withColumn(
        "kinds", F.when(F.col("again").isNull(), F.col("kinds")).otherwise(F.concat_ws("", F.transform(
            F.split("kinds", ""), lambda c, i: F.when(F.array_contains("again", i), F.lit("r")).otherwise(c)))))
    priced = kinds.select("ckey", "piece", "kinds").mapInArrow(
        costs, "ckey string, piece long, kinds string, between array<long>, at_end array<long>")
    goals = priced.repartition("ckey").sortWithinPartitions("ckey", F.desc("piece")).mapInArrow(
        following, "piece long, kinds string, exits array<long>, last boolean")
    found = goals.repartition("piece").mapInArrow(
        searched, "piece long, kinds string, costs array<long>, edits array<string>, ends array<long>")
    return pieces.drop("kinds", "closed").join(found, "piece").repartition("ckey").sortWithinPartitions(
        "ckey", "piece").mapInArrow(chained, _RESULT)


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """One row per conversation: faults, cheapest repair and its hash.

    Rows are taken by turn (nulls first; ties by role, then text, by their
    first characters and a hash). A row's first fault counts: blank (nothing
    but white space), duplicate (role and text of an earlier row), truncated
    (the last character that is no white space is none of ``.!?``). Blank
    rows and duplicates must go. Costs: Delete 4, Rerole and Insert 3, and 3
    for a truncated row that stays.

    Returns the id, ``gaps`` (turns missing between the first and the last),
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose
    role initials are not su, ua or au), ``cost``, ``audit`` (the edits) and
    ``repaired_sha256`` (of ``role:text`` lines). A null role or text counts
    as one space, a null id is a conversation of its own, null turns do not
    count as gaps. A role of another initial (or none) is never kept. Repeated
    rows are duplicates. Other columns are not read; an empty table gives an
    empty table.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(" "))
    conv = F.col(id_col).cast("string")
    body = F.trim(text, F.lit(WHITE))
    initial = F.substring(role, 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    kind = F.when(body == "", "b").when(~F.substring(body, -1, 1).isin(".", "!", "?"), F.upper(known)).otherwise(known)
    taken = rows.select(
        F.coalesce(F.concat(F.lit("="), conv), F.lit("")).alias("ckey"), conv.alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"),
        F.substring(text, 1, 64).alias("_start"), F.xxhash64(role, text).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"))         # splits any number of equal rows
    order = ["ckey", F.asc_nulls_first("turn"), F.substring("role", 1, 16), "_start", "_hash", "_row"]
    sorted_rows = taken.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = scratch.stored(sorted_rows.select("ckey", "conv_id", "turn", "role", "text", "kind").mapInArrow(
        _pack, _PIECE_SCHEMA), "turn-pieces")
    solved = pieces.where("closed").mapInArrow(_solve_closed, _RESULT).unionByName(_solve_open(pieces.where("NOT closed")))
    return solved.withColumn("conv_id", F.col("conv_id").cast(rows.schema[id_col].dataType)).withColumnRenamed("conv_id", id_col)


def _spaced(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _damage_kind():
    """crc32 of ``conv_id:turn`` modulo 20 (nulls: one space)."""
    return F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20


def damage(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` after damage by :func:`_damage_kind`: 0
    drops the row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes its role user. A null role or text becomes one space."""
    copies = F.when(F.col("_damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("_damage") == 1, "").when(
        F.col("_damage") == 2, F.regexp_replace(_spaced("text"), "[.!?]", "")).otherwise(_spaced("text"))
    return rows.withColumn("_damage", _damage_kind()).where("_damage != 0").select(
        "conv_id", "turn", F.when(F.col("_damage") == 4, "user").otherwise(_spaced("role")).alias("role"),
        text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repair_damaged(rows: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, for every conversation of ``rows``; one
    with no row left has zeros, no edits and the hash of an empty text."""
    gone = rows.groupBy("conv_id").agg(F.max(_damage_kind() != 0).alias("left")).where("NOT left").select(
        "conv_id", *[F.lit(0).cast("long").alias(c) for c in _RESULT_NAMES[1:7]], F.lit("").alias("audit"),
        F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256"))
    return repair(damage(rows)).unionByName(gone)
