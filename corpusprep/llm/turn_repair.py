"""Conversations whose turns follow ``(s?(ua)+)?`` again, by the cheapest edits.

Turns are repartitioned by conversation and sorted by turn. A task then streams over its turns in Arrow
batches and carries a dynamic program from batch to batch: for each state of the roles' automaton (nothing,
after system, after user, after assistant) the least cost, the rank of its edits among those of the other
states, and the digest of the text repaired so far. Edits up to one turn are never a beginning of other
edits up to the same turn, as insertions wait for the turn that they precede; so the rank decides ties, and the
edits themselves need not be kept. What is kept is one byte per state and turn, which leads back: from a bounded
buffer it goes to a file of the task, which is read from its end when the conversation is over.

Texts are shuffled once. Repeats within a conversation are found before, by a window over the same partitioning
that is sorted and spilled by Spark: no set of turns grows in Python, and memory is bounded for conversations
of any length. A conversation is one sequence, so that a task streams over it from end to end. The file
belongs to its task alone and goes with it; a task that is lost starts again from the shuffled turns.

Faults, the first that holds: *blank* (nothing but white space), *duplicate* (role and text of an earlier
turn), *truncated* (the last character that is no white space is none of ``.!?``). Edits: keep 0 (K), give the role
user or assistant 1 (R), delete 2 (D, the only one for blank and duplicate turns), insert an empty turn of user or
assistant 5 (I); a truncated turn that stays costs 5 more. Of the cheapest edits, those least in ASCII order.

Defined results: a null role or text is one space. Turns without number come first; turns of the same number
are ordered by role and text. Turns with a null conversation id are one conversation. A turn of another role
than system, user or assistant counts by the first letter of it, and an empty role has none. Repeated rows are
duplicates of each other. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WHITE = r"\x20\x09-\x0D"
KEEP_COST, ROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
LEGAL = ("su", "ua", "au")

# --- the dynamic program -----------------------------------------------------------------------

START, SYSTEM, USER, ASSISTANT = range(4)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: What one turn adds to the edits, in ASCII order.
EDITS = ("D", "IK", "IR", "K", "R")
#: Insertions at the end, by state.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
_NOWHERE = 255


def _inserted(state: int, role: int) -> int | None:
    """The role to insert before a turn of ``role`` after ``state``; 0 for none, None if there is no way."""
    if role == SYSTEM:
        return 0 if state == START else None
    if role == USER:
        return ASSISTANT if state == USER else 0
    return 0 if state == USER else USER


def _moves(initial: str, deleted: bool, truncated: bool) -> list[tuple[int, int, int, int, int]]:
    """(state, next state, cost, index of the edits, role inserted) for a turn of this kind."""
    moves = [(state, state, DELETE_COST, EDITS.index("D"), 0) for state in range(4)]
    if deleted:
        return moves
    for state in range(4):
        for role in (SYSTEM, USER, ASSISTANT):
            kept = _INITIAL.get(initial) == role
            before = _inserted(state, role)
            if before is None or not (kept or role in _ROLE):
                continue
            cost = (KEEP_COST if kept else ROLE_COST) + (INSERT_COST if before else 0) + (TRUNCATED_COST if truncated else 0)
            moves.append((state, role, cost, EDITS.index(("I" if before else "") + ("K" if kept else "R")), before))
    return moves


MOVES = {(i, d, t): _moves(i, d, t) for i in ("s", "u", "a", "") for d in (False, True) for t in (False, True)}


class Trail:
    """Four bytes per turn: for each state, the state before and the edits. Read from the end."""

    def __init__(self, block: int = 1 << 20):
        self.block, self.tail, self.file = block, bytearray(), None

    def clear(self) -> None:
        self.tail.clear()
        if self.file is not None:
            self.file.close()
            self.file = None

    def add(self, steps: bytes) -> None:
        self.tail += steps
        if len(self.tail) >= self.block:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.write(self.tail)
            self.tail.clear()

    def _blocks(self) -> Iterator[bytes]:
        yield bytes(self.tail)
        if self.file is not None:
            at = self.file.tell()
            while at:
                size = min(at, self.block)
                at -= size
                self.file.seek(at)
                yield self.file.read(size)
            self.file.seek(0, 2)

    def back(self, state: int) -> str:
        """The edits that lead to ``state`` after the last turn."""
        found = bytearray()
        for block in self._blocks():
            for at in range(len(block) - 4, -1, -4):
                step = block[at + state]
                found += EDITS[step & 7].encode()[::-1]
                state = step >> 3
        return found[::-1].decode()


class Repair:
    """The dynamic program over the turns of one conversation."""

    def __init__(self, block: int = 1 << 20):
        self.trail = Trail(block)
        self.begin()

    def begin(self) -> None:
        self.trail.clear()
        #: By state: (cost, rank, digest so far, whether anything is in it)
        self.states: list = [(0, 0, hashlib.sha256(), False), None, None, None]

    @staticmethod
    def _grown(digest, begun: bool, *lines: str):
        digest = digest.copy()
        for line in lines:
            digest.update(("\n" + line if begun else line).encode("utf-8", "surrogatepass"))
            begun = True
        return digest, True

    def turn(self, role: str, text: str, deleted: bool, truncated: bool) -> None:
        states, initial = self.states, role[:1]
        best: list = [None] * 4
        for state, target, cost, edits, before in MOVES[initial if initial in _INITIAL else "", deleted, truncated]:
            if states[state] is not None:
                found = (states[state][0] + cost, states[state][1], edits, state, before)
                if best[target] is None or found < best[target]:
                    best[target] = found
        reached = sorted((found[1:3], target) for target, found in enumerate(best) if found is not None)
        made: list = [None] * 4
        steps = bytearray((_NOWHERE,) * 4)
        for rank, (_, target) in enumerate(reached):
            cost, _, edits, state, before = best[target]
            _, _, digest, begun = states[state]
            if EDITS[edits] != "D":
                own = role if EDITS[edits][-1] == "K" else _ROLE[target]
                digest, begun = self._grown(digest, begun, *([_ROLE[before] + ":"] if before else []), f"{own}:{text}")
            made[target] = (cost, rank, digest, begun)
            steps[target] = state << 3 | edits
        self.states = made
        self.trail.add(steps)

    def end(self) -> tuple[int, str, str]:
        """(cost, edits, hex digest of the repaired conversation)."""
        ways = [
            (found[0] + INSERT_COST * len(CLOSING[state]), found[1], state) for state, found in enumerate(self.states) if found is not None
        ]
        cost, _, state = min(ways)
        _, _, digest, begun = self.states[state]
        if CLOSING[state]:
            digest, begun = self._grown(digest, begun, *(_ROLE[r] + ":" for r in CLOSING[state]))
        return cost, self.trail.back(state) + "I" * len(CLOSING[state]), digest.hexdigest()


# --- turns -------------------------------------------------------------------------------------


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, present): turns with faults by ``crc32(conv:turn) % 20``.

    0 drops a turn (``present`` is false then, so that its conversation is known), 1 empties its text, 2 removes
    the marks ``.!?``, 3 repeats it and 4 gives it to the user.
    """
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col))
    key = F.concat(conv, F.lit(":"), turn)
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    read = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"))
    fault, present = F.col("fault"), F.col("fault") != 0
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", r"[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.select(
        "conv",
        "turn",
        F.when(present, F.when(fault == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(present, text).alias("text"),
        present.alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def undamaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, present) of turns as they are."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.lit(True).alias("present"))


def _fault(number: Column) -> Column:
    text = F.col("text")
    return (
        F.when(~text.rlike(f"[^{WHITE}]"), "blank")
        .when(number > 1, "duplicate")
        .when(~text.rlike(rf"[.!?][{WHITE}]*\z"), "truncated")
    )


def sorted_turns(turns: DataFrame) -> DataFrame:
    """Turns with their ``fault``, all of a conversation in one partition and in order."""
    number = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    dealt = turns.repartition("conv").withColumn("number", number)
    ordered = dealt.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "number")
    return ordered.select(
        F.col("conv").cast("string").alias("conv"),
        F.col("turn").isNotNull().alias("numbered"),
        F.coalesce("turn", F.lit(0).cast("long")).alias("turn"),
        "role",
        "text",
        "present",
        F.coalesce(_fault(F.col("number")), F.lit("")).alias("fault"),
    )


_NONE = object()


def _conversations(batches) -> Iterator[tuple]:
    """(conversation, whether it is a new one, its turn) in the order of the sorted batches."""
    current: object = _NONE
    for batch in batches:
        for row in zip(*(batch[c].tolist() for c in ("conv", "numbered", "turn", "role", "text", "present", "fault"))):
            conv = row[0] if isinstance(row[0], str) else None
            yield conv, conv != current, row[1:]
            current = conv


class _Tally:
    """Counts of one conversation."""

    def __init__(self, conv: str | None):
        self.conv, self.counts = conv, {"blank": 0, "duplicate": 0, "truncated": 0}
        self.least = self.last = None
        self.distinct = self.illegal = 0
        self.initial: str | None = None

    def add(self, numbered: bool, turn: int, role: str, fault: str) -> None:
        if numbered and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last, self.distinct = turn, self.distinct + 1
        if fault:
            self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]

    @property
    def gaps(self) -> int:
        return self.last - self.least + 1 - self.distinct if self.distinct else 0


AUDIT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def audit(turns: DataFrame, block: int = 1 << 20) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row per conversation.

    ``turns`` come from ``damaged`` or ``undamaged``. ``gaps`` are missing numbers between the first turn and the
    last, ``illegal`` the neighbours whose roles may not follow each other; the digest is of the lines ``role:text``.
    """
    names = [field.split(" ")[0] for field in AUDIT.split(", ")]

    def run(batches):
        import pandas as pd

        repair, tally, done = Repair(block), None, []

        def finished():
            return (tally.conv, tally.gaps, *tally.counts.values(), tally.illegal, *repair.end())

        for conv, new, (numbered, turn, role, text, present, fault) in _conversations(batches):
            if new:
                if tally is not None:
                    done.append(finished())
                    if len(done) >= 1024:
                        yield pd.DataFrame(done, columns=names)
                        done = []
                repair.begin()
                tally = _Tally(conv)
            if present:
                tally.add(numbered, turn, role, fault)
                repair.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        if tally is not None:
            done.append(finished())
        yield pd.DataFrame(done, columns=names)

    kind = turns.schema["conv"].dataType
    return sorted_turns(turns).mapInPandas(run, AUDIT).withColumn("conv", F.col("conv").cast(kind))


REPAIRED = "conv string, place long, role string, text string, edit string"


def repaired(turns: DataFrame, block: int = 1 << 20, in_memory: int = 1 << 23) -> DataFrame:
    """(conv, place, role, text, edit): the turns of the repaired conversations, numbered from 0; ``edit`` is K, R or I.

    The turns of a conversation wait, in a file of the task beyond ``in_memory`` bytes, until its edits are known.
    """
    names = [field.split(" ")[0] for field in REPAIRED.split(", ")]

    def replay(conv, waiting, edits) -> Iterator[tuple]:
        waiting.seek(0)
        state, place, inserted = START, 0, False
        for edit in edits:
            if edit == "I":
                state = ASSISTANT if state == USER else USER
                yield conv, place, _ROLE[state], "", edit
                place += 1
                continue
            role, text = pickle.load(waiting)
            if edit != "D":
                state = _INITIAL[role[0]] if edit == "K" else ASSISTANT if state == USER else USER
                yield conv, place, role if edit == "K" else _ROLE[state], text, edit
                place += 1

    def run(batches):
        import pandas as pd

        repair, current, waiting, done = Repair(block), _NONE, None, []
        nothing = ((None, True, None),)
        for turns_ in (_conversations(batches), nothing):
            for conv, new, turn in turns_:
                if new:
                    if current is not _NONE:
                        for row in replay(current, waiting, repair.end()[1]):
                            done.append(row)
                            if len(done) >= 1024:
                                yield pd.DataFrame(done, columns=names)
                                done = []
                        waiting.close()
                    if turn is None:
                        break
                    repair.begin()
                    current, waiting = conv, tempfile.SpooledTemporaryFile(in_memory)
                _, _, role, text, present, fault = turn
                if present:
                    pickle.dump((role, text), waiting)
                    repair.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        yield pd.DataFrame(done, columns=names)

    kind = turns.schema["conv"].dataType
    return sorted_turns(turns).mapInPandas(run, REPAIRED).withColumn("conv", F.col("conv").cast(kind))
