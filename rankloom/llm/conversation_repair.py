"""Conversations repaired into the role order ``(s?(ua)+)?`` by their cheapest edits.

Rows of a conversation are taken by turn (null first; equal turns by role and text). A row's first fault
counts: ``blank`` (nothing but white space), ``duplicate`` (role and text seen earlier in the conversation),
``truncated`` (its last character other than white space is none of ``.!?``). Edits: Keep costs 0, Rerole to
user or assistant 3, Delete 4 (a must for blank and duplicate rows), Insert of a row without text 3; a
truncated row that stays adds 3. ``audit`` lists the initials of the cheapest edits, of equal ones
the ASCII-least.

Rows are partitioned by conversation and sorted by turn; ``mapInPandas`` streams them and carries the
dynamic programme across Arrow batches. Four states stand for what the repaired roles so far end in
(nothing, system, user, assistant). For each the best way there is kept: its cost, its place among the
others in ASCII order (such ways all end in a row's letter, so none is the beginning of another and the
order of two never changes later), a running SHA-256 of the repaired text, and one byte per row that points back. Those
bytes are the only thing that grows with a conversation; beyond ``spill_rows`` rows they are written to
the session's shared folder and read back piece by piece when the conversation ends. Which rows repeat an
earlier one is found by a partial aggregate over (conversation, role and text) before the
stream, so no set of texts is held.

Defined results: a null role, text or id is taken as one space where it is read as text; null turns come
first and count in no gap (a gap beyond a long is the largest long); a role is known by its first letter (case counts), an empty role has none and
can't stay. All rows of a null conversation id form one conversation. Repeated rows are duplicates of
the first. A conversation of dropped rows only has zeros, an empty audit and the hash of
nothing. An empty table gives no rows. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rankloom.llm.shared_files import open_folder, qualified
from rankloom.llm.tables import bounded_batches, join_by, stored
from rankloom.session import scratch_path

# --- fixed values -----------------------------------------------------------
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
BLANK, DUPLICATE, TRUNCATED, FINE = "blank", "duplicate", "truncated", "fine"
# ----------------------------------------------------------------------------

SPILL_ROWS = 1 << 20
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = 4
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
_ENDS = (_START, _ASSISTANT)
_INSERTABLE = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_LETTERS = "DKR"

#: pairs of neighbouring initials that are in order
_LEGAL = {"su", "ua", "au"}


def _inserted(state: int) -> list[tuple[str, int, tuple[int, ...]]]:
    """Up to two inserts from a state: their letters, the state behind them, the roles put in."""
    out, letters, roles = [("", state, ())], "", ()
    for _ in range(2):
        state = _INSERTABLE[state]
        letters, roles = letters + "I", (*roles, state)
        out.append((letters, state, roles))
    return out


def _moves(initial: str, fault: str) -> list[list[tuple[int, int, str, tuple[int, ...], str]]]:
    """For each state behind a row the ways into it: ``(cost, from, letters, roles put in before, what becomes of the row)``.

    Of several ways from one state into another the cheapest, then the ASCII-least, is enough.
    """
    best: dict[tuple[int, int], tuple] = {}
    for start in range(_STATES):
        for letters, state, roles in _inserted(start):
            ways = [("D", state, DELETE_COST)]
            if fault not in (BLANK, DUPLICATE):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                if initial == "s" and state == _START:
                    ways.append(("K", _SYSTEM, more))
                if (initial, _INSERTABLE[state]) in (("u", _USER), ("a", _ASSISTANT)):
                    ways.append(("K", _INSERTABLE[state], more))
                ways.append(("R", _INSERTABLE[state], more + REROLE_COST))
            for letter, to, cost in ways:
                way = (cost + INSERT_COST * len(letters), letters + letter, start, roles, letter)
                if (start, to) not in best or way < best[start, to]:
                    best[start, to] = way
    into: list[list] = [[] for _ in range(_STATES)]
    for (_, to), (cost, letters, start, roles, letter) in best.items():
        into[to].append((cost, start, letters, roles, letter))
    return into


MOVES = {(i, f): _moves(i, f) for i, f in product("sua-", (BLANK, DUPLICATE, TRUNCATED, FINE))}


class _Back:
    """Four bytes per row: the state before, the number of inserts and the letter, for each state behind it."""

    def __init__(self, folder: str, spill_rows: int):
        self.folder, self.spill_rows = folder, spill_rows
        self.held, self.spilled = bytearray(), []

    def add(self, row: bytes) -> None:
        self.held += row
        if len(self.held) >= _STATES * self.spill_rows:
            store, base = open_folder(self.folder)
            name = f"{base}/{uuid.uuid4().hex}"
            with store.open_output_stream(name, compression=None) as out:
                out.write(bytes(self.held))
            self.spilled.append((store, name))
            self.held = bytearray()

    def pieces(self) -> Iterator[bytes]:
        """The last rows first; a spilled piece is gone once it is read."""
        yield bytes(self.held)
        while self.spilled:
            store, name = self.spilled.pop()
            with store.open_input_stream(name, compression=None) as source:
                piece = source.read()
            store.delete_file(name)
            yield piece


def _traced(back: _Back, state: int, tail: int) -> str:
    """The letters of the way that ends in ``state``, followed by ``tail`` inserts."""
    out = ["I" * tail]
    for piece in back.pieces():
        letters = bytearray()  # of the piece, last first
        for at in range(len(piece) - _STATES, -1, -_STATES):
            step = piece[at + state]
            letters += _LETTERS[(step >> 4) & 3].encode() + b"I" * ((step >> 2) & 3)
            state = step & 3
        letters.reverse()
        out.append(letters.decode())
    out.reverse()
    return "".join(out)


class Conversation:
    """Counts, cheapest way and running hashes of one conversation, row by row."""

    def __init__(self, folder: str, spill_rows: int = SPILL_ROWS):
        self.rows = 0
        self.counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0, FINE: 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.last_row = self.last_initial = None
        self.back = _Back(folder, spill_rows)
        # per state: cost, place in ASCII order, hash; None where no way leads there
        self.ways: list[tuple[int, int, "hashlib._Hash"] | None] = [(0, 0, hashlib.sha256()), None, None, None]

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> str:
        """Take the next row; ``repeated`` says that an earlier turn has its role and text. Returns its fault."""
        if turn is not None:
            if self.last_turn is None or turn != self.last_turn:
                self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        # rows of a turn are sorted by role and text, so equal ones are neighbours
        repeated = repeated or self.last_row == (turn, role, text)
        self.last_row = (turn, role, text)
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in _LEGAL:
            self.illegal += 1
        self.last_initial = initial
        stripped = text.rstrip("\x20\t\n\x0b\x0c\r")
        fault = BLANK if not stripped else DUPLICATE if repeated else TRUNCATED if stripped[-1] not in ".!?" else FINE
        self.counts[fault] += 1
        self.rows += 1
        self._step(MOVES[initial if initial and initial in "sua" else "-", fault], role, text)
        return fault

    def _step(self, moves, role: str, text: str) -> None:
        chosen: list[tuple | None] = [None] * _STATES
        for to in range(_STATES):
            best = None
            for cost, start, letters, roles, letter in moves[to]:
                way = self.ways[start]
                if way is not None:
                    key = (way[0] + cost, way[1], letters)
                    if best is None or key < best[0]:
                        best = (key, start, roles, letter)
            chosen[to] = best
        order = sorted((c[0][1], c[0][2]) for c in chosen if c is not None)
        row, ways = bytearray(_STATES), []
        for to, best in enumerate(chosen):
            if best is None:
                ways.append(None)
                continue
            (cost, place, letters), start, roles, letter = best
            row[to] = start | len(roles) << 2 | _LETTERS.index(letter) << 4
            digest = self.ways[start][2]
            if roles or letter != "D":
                digest = digest.copy()
                lines = [f"{_NAMES[r]}:" for r in roles]
                if letter != "D":
                    lines.append(f"{role if letter == 'K' else _NAMES[to]}:{text}")
                digest.update((("" if start == _START else "\n") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
            ways.append((cost, order.index((place, letters)), digest))
        self.back.add(bytes(row))
        self.ways = ways

    def report(self) -> tuple:
        """``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
        best = None
        for state, way in enumerate(self.ways):
            if way is None:
                continue
            for letters, end, roles in _inserted(state):
                if end in _ENDS:
                    key = (way[0] + INSERT_COST * len(letters), way[1], letters)
                    if best is None or key < best[0]:
                        best = (key, state, roles)
                    break
        (cost, _, letters), state, roles = best
        digest = self.ways[state][2].copy()
        if roles:
            digest.update((("" if state == _START else "\n") + "\n".join(f"{_NAMES[r]}:" for r in roles)).encode())
        gaps = 0 if self.first_turn is None else min(self.last_turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)
        audit = _traced(self.back, state, len(letters))
        return (gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, cost, audit, digest.hexdigest())


# --- Spark ----------------------------------------------------------------------------------------

_REPORT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURNS = "conv string, position long, edit string, turn long, role string, text string"


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def damage_code(conv_col: str = "conv_id", turn_col: str = "turn", kinds: int = 20) -> Column:
    """``crc32("conv_id:turn") % kinds``; a null is one space."""
    return F.pmod(F.crc32(F.concat(_text(conv_col), F.lit(":"), _text(turn_col)).cast("binary")), F.lit(kinds))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` of damaged rows: 0 drops (not ``present``), 1 empties the text,
    2 takes ``.!?`` out of it, 3 repeats the row, 4 makes the role user. Null roles and texts become one space."""
    code = damage_code()
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), _text("role").alias("role"), _text("text").alias("text"), code.alias("_code"))
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("_code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_code") <= 1, F.lit("")).when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_code") != 0).alias("present"),
        F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return changed.drop("_copy")


def _conv() -> Column:
    """The conversation id as a string that is never null, so that equal ids compare equal in Python too."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _conv_id(like: DataFrame) -> Column:
    text = F.when(F.col("conv") != "", F.substr("conv", F.lit(2)))
    return text.cast(like.schema["conv_id"].dataType).alias("conv_id")


def _rows(conversations: DataFrame) -> DataFrame:
    """``conv, has_turn, turn, role, text, present``, none of them null."""
    present = F.col("present") if "present" in conversations.columns else F.lit(True)
    return bounded_batches(conversations).select(
        _conv().alias("conv"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        _text("role").alias("role"),
        _text("text").alias("text"),
        F.coalesce(present, F.lit(True)).alias("present"),
    )


def _with_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeated``: whether an earlier turn of the conversation has the row's role and text.

    The first turn of each role and text is a partial aggregate over their 256-bit hash; only those seen at
    several turns are joined back.
    """
    keyed = rows.withColumn("_key", F.unhex(F.sha2(F.concat_ws("\u0000", F.length("role").cast("string"), "role", "text").cast("binary"), 256)))
    order = F.struct("has_turn", "turn")
    firsts = keyed.where("present").groupBy("conv", "_key").agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    firsts = stored(firsts.where("_first < _last").select("conv", "_key", F.col("_first.has_turn").alias("_has"), F.col("_first.turn").alias("_turn")), "repeated_turns")
    known = join_by(keyed, firsts, ["conv", "_key"], "left")
    later = F.struct(F.col("has_turn").alias("h"), F.col("turn").alias("t")) > F.struct(F.col("_has").alias("h"), F.col("_turn").alias("t"))
    return known.withColumn("repeated", F.coalesce(F.col("_has").isNotNull() & later, F.lit(False))).drop("_key", "_has", "_turn")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions("conv", *first, "has_turn", "turn", "role", "text")


def _reporter(folder: str, spill_rows: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = "", None

        def table(done: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(done, columns=[c.split()[0] for c in _REPORT.split(", ")])

        for frame in frames:
            done, held = [], 0
            for c, has_turn, turn, role, text, present, repeated in frame.itertuples(index=False, name=None):
                if state is None or c != conv:
                    if state is not None:
                        done.append((conv, *state.report()))
                        held += 300 + len(done[-1][-2])
                        if held > 4 << 20:
                            yield table(done)
                            done, held = [], 0
                    conv, state = c, Conversation(folder, spill_rows)
                if present:
                    state.add(int(turn) if has_turn else None, role, text, bool(repeated))
            if done:
                yield table(done)
        if state is not None:
            yield table([(conv, *state.report())])

    return run


def repair_report(conversations: DataFrame, *, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """One row per conversation: faults, cost, ``audit`` and ``repaired_sha256`` of its repaired rows
    (``role:text`` joined by line ends). Rows with ``present`` false (where that column is given) only name
    their conversation."""
    spark = conversations.sparkSession
    folder = qualified(spark, scratch_path(spark, "backpointers"))
    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    rows = _with_repeats(_rows(conversations)).select("conv", "has_turn", "turn", "role", "text", "present", "repeated")
    found = _in_order(rows).mapInPandas(_reporter(folder, spill_rows), _REPORT)
    return found.select(_conv_id(conversations), *[F.col(c.split()[0]) for c in _REPORT.split(", ")[1:]])


def _editor(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows behind the row that carries their conversation's audit, edited as it says."""
    conv, audit, last, at, state, position = "", "", -1, 0, _START, 0

    def inserts() -> list[tuple]:
        nonlocal at, state, position
        out = []
        while at < len(audit) and audit[at] == "I":
            state = _INSERTABLE[state]
            out.append((conv, position, "I", None, _NAMES[state], ""))
            at, position = at + 1, position + 1
        return out

    for frame in frames:
        done: list[tuple] = []
        for c, is_row, has_turn, turn, role, text, present in frame.itertuples(index=False, name=None):
            if not is_row:
                conv, audit, at, state, position = c, text, 0, _START, 0
                last = max(map(audit.rfind, _LETTERS))
                continue
            if not present:
                continue
            done += inserts()
            edit = audit[at]
            at += 1
            if edit != "D":
                state = _SYSTEM if edit == "K" and role[:1] == "s" else _INSERTABLE[state]
                done.append((conv, position, edit, int(turn) if has_turn else None, role if edit == "K" else _NAMES[state], text))
                position += 1
            if at > last:
                done += inserts()
        if done:
            out = pd.DataFrame(done, columns=["conv", "position", "edit", "turn", "role", "text"])
            out["turn"] = out["turn"].astype("Int64")
            yield out


def repaired_turns(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired rows ``conv_id, position, edit, turn, role, text``; inserted ones have no turn.

    ``report`` is the stored result of ``repair_report``: each audit is sorted in front of its conversation's
    rows, so a task holds one audit and one batch at a time.
    """
    rows = _rows(conversations).select("conv", F.lit(True).alias("is_row"), "has_turn", "turn", "role", "text", "present")
    heads = report.select(
        _conv().alias("conv"),
        F.lit(False).alias("is_row"),
        F.lit(False).alias("has_turn"),
        F.lit(0).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(True).alias("present"),
    )
    found = _in_order(heads.unionByName(rows), "is_row").mapInPandas(_editor, _TURNS)
    return found.select(_conv_id(conversations), "position", "edit", "turn", "role", "text")
