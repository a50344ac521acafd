"""Repair of conversations: the cheapest edits after which the roles take turns.

What is legal: nothing, or at most one system turn and then pairs of user and assistant,
told by the roles' first letters: ``(s?(ua)+)?``. A turn may be kept (K), given the role
that fits (R, 2), deleted (D, 3; blank and repeated turns must be), and a turn without text
may be inserted anywhere (I, 2); a truncated turn that stays costs 1.

The search is iterative-deepening A*: a depth-first search tries edits in the order D, I, K,
R and leaves a path where its cost and a lower bound of the rest pass the bound, which rises
by one from search to search. A table keeps, for each (turn, state), the largest rest of the
bound that led nowhere, also from search to search. So the first path to arrive is the least
in ASCII order of the cheapest ones. The lower bound counts turns that must go, truncated
turns, turns that fit nowhere, and runs of neighbours that may not meet (an edit mends two
such meetings at most). A long conversation is cut in blocks: each is searched for every
state at its start and its end, and a pass from the last block to the first joins them. No
path of a block is the beginning of another to the same end, so the least of the whole is
made of least parts.

Spark finds each turn's fault by grouping and joins; then a conversation's turns reach one
task in order, twice: first without their texts, one byte a turn, for the search, then with
them, to be written out or hashed one by one. So no task holds a conversation's texts,
though the checksum of one must pass through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space, marks that end a turn, and what edits cost.
BLANK, ENDS = " \t\n\x0b\f\r", ".!?"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLOCK = 256

# States: nothing yet, after system, after user, after assistant. Roles: s, u, a, other.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
OTHER = 0
MADE = (USER, USER, ASSISTANT, USER)  # the state after an inserted or reroled turn
NAMES = {USER: "user", ASSISTANT: "assistant"}
FORCED, CUT = 4, 8  # bits of a turn's code, above its role
NEVER = 1 << 40


def _follows(state: int, role: int) -> bool:
    return role == MADE[state] or (state == START and role == SYSTEM)


class Search:
    """Cheapest edits of ``codes`` that end in ``exit``, from any state.

    ``exit`` None is the end of the conversation: START or ASSISTANT, and turns may be
    inserted after the last one. Else ``codes`` end with a turn's own edit.
    """

    def __init__(self, codes: bytes, exit: int | None):
        self.codes, self.n, self.last = codes, len(codes), exit is None
        self.goals = (START, ASSISTANT) if exit is None else (exit,)
        self.bounds = self._bounds()
        self.failed = [-1] * (4 * self.n + 4)

    def _bounds(self) -> list[int]:
        """Lower bound of the rest at (turn, state), as a flat list."""
        bounds = [0 if s in self.goals else INSERT if self.last else NEVER for s in range(4)]
        out = [bounds]
        must = 0  # of deletions and truncated turns
        first = None  # role of the next turn that may stay
        edited = False  # whether that one fits nowhere
        run = rest = systems = 0
        for code in reversed(self.codes):
            role = code & 3
            if code & FORCED:
                must += DELETE
            else:
                must += TRUNCATED if code & CUT else 0
                before = 2 * (edited + (run + 1) // 2) + rest if first is not None else 0
                if first is None:
                    ends = any(role == g for g in self.goals)
                    new_edited = role in (OTHER, SYSTEM)
                    run, rest = (0, 0) if new_edited or ends else (1, 0)
                else:
                    new_edited = role in (OTHER, SYSTEM)
                    if new_edited or edited or _follows(role, first):
                        run, rest = 0, before
                    else:
                        run += 1
                first, edited = role, new_edited
                systems += role == SYSTEM
            at = []
            for state in range(4):
                if first is None:
                    h = 0 if state in self.goals else INSERT
                elif edited:
                    h = 2 + 2 * ((run + 1) // 2) + rest
                else:
                    h = 2 * ((run + (not _follows(state, first)) + 1) // 2) + rest
                if state == START and systems:
                    h = max(0, h - REROLE)
                at.append(must + h)
            out.append(at)
        return [h for at in reversed(out) for h in at]

    def run(self, entry: int) -> tuple[int, str]:
        """(cost, edits) from the state ``entry``."""
        bound = self.bounds[entry]
        while True:
            edits = self._within(entry, bound)
            if edits is not None:
                return bound, edits
            bound += 1

    def _within(self, entry: int, bound: int) -> str | None:
        codes, n, bounds, failed = self.codes, self.n, self.bounds, self.failed
        stack, letters = [(0, entry, bound, 0)], []
        while stack:
            i, state, left, move = stack.pop()
            if not move:
                if i == n and state in self.goals:
                    return "".join(letters)
                if failed[4 * i + state] >= left:
                    if letters:
                        letters.pop()
                    continue
            code = codes[i] if i < n else None
            while move < 4:
                to = None
                if move == 0:
                    if code is not None:
                        to = (i + 1, state, left - DELETE)
                elif move == 1:
                    if code is not None or self.last:
                        to = (i, MADE[state], left - INSERT)
                elif code is not None and not code & FORCED:
                    cost = TRUNCATED if code & CUT else 0
                    if move == 2:
                        if _follows(state, code & 3):
                            to = (i + 1, code & 3, left - cost)
                    else:
                        to = (i + 1, MADE[state], left - cost - REROLE)
                move += 1
                if to is not None and to[2] >= bounds[4 * to[0] + to[1]]:
                    stack.append((i, state, left, move))
                    letters.append("DIKR"[move - 1])
                    stack.append((*to, 0))
                    break
            else:
                failed[4 * i + state] = left
                if letters:
                    letters.pop()
        return None


def _without_pairs(codes: bytes, entry: int, exit: int) -> tuple[int, str] | None:
    """Cheapest edits of a block after which no pair has begun yet: nearly all is deleted."""
    if entry == exit:
        return DELETE * len(codes), "D" * len(codes)
    if (entry, exit) != (START, SYSTEM):
        return None
    keep = [((code & CUT) > 0, -i) for i, code in enumerate(codes) if not code & FORCED and code & 3 == SYSTEM]
    if not keep:
        return None
    cut, at = min(keep)
    return DELETE * (len(codes) - 1) + cut, "D" * -at + "K" + "D" * (len(codes) + at - 1)


def cheapest_edits(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """(cost, edits) of a conversation; ``codes`` has a byte for each turn."""
    starts = range(0, max(len(codes), 1), block)
    parts = [codes[i : i + block] for i in starts]
    if len(parts) == 1:
        return Search(codes, None).run(START)
    last = Search(parts[-1], None)
    to_go = [last.run(state) for state in range(4)]
    costs = [cost for cost, _ in to_go]
    chosen = [[(None, edits) for _, edits in to_go]]
    for part in reversed(parts[:-1]):
        found = {}
        for exit in (USER, ASSISTANT):
            search = Search(part, exit)
            found.update(((entry, exit), search.run(entry)) for entry in range(4))
        for entry, exit in ((START, START), (START, SYSTEM), (SYSTEM, SYSTEM)):
            found[entry, exit] = _without_pairs(part, entry, exit)
        best = []
        for entry in range(4):
            ways = [(way[0] + costs[exit], way[1], exit) for exit in range(4) if (way := found.get((entry, exit)))]
            best.append(min(ways))
        costs = [cost for cost, _, _ in best]
        chosen.append([(exit, edits) for _, edits, exit in best])
    state, out = START, []
    for step in reversed(chosen):
        exit, edits = step[state]
        out.append(edits)
        state = exit
    return costs[START], "".join(out)


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, told, turn, digest, role, text); NULL roles and texts are one space."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    turns = rows.select(
        F.col(conv).alias("conv"), F.col(turn).isNotNull().alias("told"), F.col(turn).cast("long").alias("turn"),
        blank(role).alias("role"), blank(text).alias("text"),
    )
    same = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return turns.withColumn("digest", F.unhex(F.sha2(same, 256)))


def _faults(turns: DataFrame) -> DataFrame:
    """(conv, told, turn, digest, n, initial, blank, cut, earlier) of each group of equal turns.

    ``earlier`` tells that an earlier turn of the conversation has the same role and text.
    """
    ends = F.rtrim(F.col("text"), F.lit(BLANK))
    cut: Column = ~F.right(ends, F.lit(1)).isin(*ENDS)
    keys = ["conv", "told", "turn", "digest"]
    groups = turns.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(F.left("role", F.lit(1))).alias("initial"),
        F.min(ends == "").alias("blank"), F.min(cut).alias("cut"),
    )
    first = groups.groupBy(F.col("conv").alias("of_conv"), F.col("digest").alias("of_digest")).agg(
        F.min(F.struct("told", "turn")).alias("first")
    )
    same = groups["conv"].eqNullSafe(first["of_conv"]) & (groups["digest"] == first["of_digest"])
    earlier = ~(F.col("told").eqNullSafe(F.col("first.told")) & F.col("turn").eqNullSafe(F.col("first.turn")))
    return groups.join(first, same).select(*keys, "n", "initial", "blank", "cut", earlier.alias("earlier"))


class _Conversation:
    """What is known of the conversation that passes through a task."""

    def __init__(self, name):
        self.name, self.codes = name, bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.before = None
        self.turns = 0
        self.edits, self.at, self.state, self.step, self.cost = None, 0, START, 0, 0
        self.digest, self.any_line = hashlib.sha256(), False

    def add(self, turn, n, initial, blank, cut, earlier) -> None:
        role = ROLES.get(initial, OTHER)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        kept = 0 if blank or earlier else 1
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - kept
        self.truncated += int(kept and cut)
        if kept:
            self.codes.append(role | (CUT if cut else 0))
        self.codes += bytes([role | FORCED]) * (n - kept)
        pairs = [*([] if self.before is None else [(self.before, role, 1)]), (role, role, n - 1)]
        self.illegal += sum(times for a, b, times in pairs if (a, b) not in LEGAL)
        self.before = role

    def solve(self) -> None:
        self.cost, self.edits = cheapest_edits(bytes(self.codes))

    def inserted(self) -> Iterator[tuple]:
        """Turns inserted before the next edit of a turn."""
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            self.state = MADE[self.state]
            yield self.line("I", None, NAMES[self.state], "")

    def line(self, edit, turn, role, text) -> tuple:
        self.digest.update((("\n" if self.any_line else "") + f"{role}:{text}").encode())
        self.any_line = True
        self.step += 1
        return (self.name, self.step, edit, turn, role, text)

    def edited(self, turn, role, text) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = ROLES[role[0]]
            yield self.line(edit, turn, role, text)
        elif edit == "R":
            self.state = MADE[self.state]
            yield self.line(edit, turn, NAMES[self.state], text)

    def report(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (self.name, *counts, self.edits, self.digest.hexdigest())


LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
REPORT = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
LINES = ["conv", "step", "edit", "turn", "role", "text"]
IDS, FAULTS, TEXTS = range(3)
FLUSH_ROWS, FLUSH_CHARS = 4096, 8 << 20


def _edited(rows: DataFrame, ids: DataFrame | None, columns: tuple[str, str, str, str], lines: bool) -> DataFrame:
    turns = _turns(rows, *columns)
    faults = _faults(turns).withColumn("phase", F.lit(FAULTS))
    given = turns.withColumn("phase", F.lit(TEXTS))
    parts = faults.unionByName(given, allowMissingColumns=True)
    if ids is not None:
        named = ids.select(F.col(columns[0]).alias("conv"), F.lit(IDS).alias("phase")).distinct()
        parts = parts.unionByName(named, allowMissingColumns=True)
    order = ["conv", "phase", "told", "turn", "digest"]
    data = ["n", "initial", "blank", "cut", "earlier", "role", "text"]
    sorted_parts = parts.repartition("conv").sortWithinPartitions(*order).select("conv", "phase", "turn", *data)
    kind = sorted_parts.schema["conv"].dataType.simpleString()
    names = LINES if lines else REPORT
    types = ["long", "string", "long", "string", "string"] if lines else ["long"] * 6 + ["string"] * 2
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, [kind, *types], strict=True))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        chars = 0
        now: _Conversation | None = None

        def end(of: _Conversation | None) -> Iterator[tuple]:
            if of is not None:
                if of.edits is None:
                    of.solve()
                made = list(of.inserted())
                yield from made if lines else [of.report()]

        for batch in batches:
            arrow = [batch.column(k) for k in range(batch.num_columns)]
            for conv, phase, turn, n, initial, blank, cut, earlier, role, text in zip(*(c.to_pylist() for c in arrow), strict=True):
                if now is None or conv != now.name:
                    out.extend(end(now))
                    now = _Conversation(conv)
                if phase == FAULTS:
                    now.add(turn, n, initial, blank, cut, earlier)
                elif phase == TEXTS:
                    if now.edits is None:
                        now.solve()
                    made = list(now.edited(turn, role, text))
                    if lines:
                        out.extend(made)
                        chars += len(text)
                if len(out) >= FLUSH_ROWS or chars >= FLUSH_CHARS:
                    yield _batch(out, names, types, arrow[0].type)
                    out, chars = [], 0
        out.extend(end(now))
        if out:
            yield _batch(out, names, types, arrow[0].type)

    return sorted_parts.mapInArrow(stream, schema)


def _batch(rows: list[tuple], names: list[str], types: list[str], kind: pa.DataType) -> pa.RecordBatch:
    told = [kind, *({"long": pa.int64(), "string": pa.string()}[t] for t in types)]
    columns = [pa.array(values, t) for values, t in zip(zip(*rows, strict=True), told, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def repair(
    rows: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """The repaired turns: (id, ``step``, ``edit``, turn, role, text), steps from 1 on.

    ``edit`` is K, R or I; inserted turns have a NULL turn and an empty text. Turns are
    taken in their order, NULL turns first; turns of one number in the order of the
    SHA-256 of role and text. NULL roles and texts are one space, a NULL id is an id. A role
    whose first letter is not s, u or a, or that is empty, fits nowhere. Rows that repeat
    are duplicates and go. A conversation of which nothing stays has no rows here. An empty
    table gives an empty result. Other columns are not looked at.
    """
    columns = (conv_column, turn_column, role_column, text_column)
    return _edited(rows, None, columns, lines=True).withColumnsRenamed(dict(zip(["conv", "turn", "role", "text"], columns, strict=True)))


def repair_report(
    rows: DataFrame,
    ids: DataFrame | None = None,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """Faults and edits of each conversation: id, ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    ``audit`` has the edits' letters, the checksum is that of the repaired turns as
    ``role:text`` lines. ``ids`` (the id column) adds conversations without rows: zeros, an
    empty audit and the checksum of nothing. Else as for ``repair``.
    """
    columns = (conv_column, turn_column, role_column, text_column)
    return _edited(rows, ids, columns, lines=False).withColumnRenamed("conv", conv_column)
