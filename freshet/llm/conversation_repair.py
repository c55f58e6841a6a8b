"""Repair of conversation structure: the cheapest edits that make the roles read ``(s?(ua)+)?``.

A conversation is read turn by turn through a Viterbi search over four states (nothing kept yet, after
a system turn, after a user turn, after an assistant turn). Each state has one survivor: the cheapest way there and,
among equally cheap ones, the one whose edit letters are least. The survivors are leaves of one
tree of edits. References are counted, so a branch that no survivor uses goes at once, and as soon
as all survivors share the first edit below the root it is emitted and becomes the root. What is held
is the part on which survivors still differ, and ties are decided on all of it: two survivors are
compared at the place where their ways part, which skipping pointers find in logarithmic time.

Spark deals conversations out by id, marks faults and repeats with expressions and sorts each
partition by conversation and turn (spilling if need be). Each task then reads its partition once as a stream
of Arrow batches, one conversation after the other, and writes the edits as rows.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 1, 2, 3
#: States by the last role that stands: nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: The role that an inserted or reroled turn gets in each state: the one of user and assistant that may follow.
NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
LEGAL = frozenset({("s", "u"), ("u", "a"), ("a", "u")})
#: Rows and bytes of text written at once.
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 22


class Edit:
    """A node of the tree: one edit letter, what came before, and how many edits and survivors build on it.

    ``skip`` points to an earlier node whose depth follows from this node's depth alone, so that
    nodes of equal depth can go up together in leaps.
    """

    __slots__ = ("up", "letter", "depth", "skip", "uses", "after")

    def __init__(self, up: Edit | None, letter: str):
        self.up, self.letter, self.uses, self.after = up, letter, 0, {}
        if up is None:
            self.depth, self.skip = 0, self
        else:
            self.depth = up.depth + 1
            far = up.skip
            self.skip = far.skip if up.depth - far.depth == far.depth - far.skip.depth else up


class EditTree:
    """The edits that some survivor still builds on, and those that all share, handed to ``emit`` in order."""

    def __init__(self, emit: Callable[[str], None]):
        self.emit, self.root = emit, Edit(None, "")
        self.fresh: list[Edit] = []

    def grow(self, node: Edit, letters: str) -> Edit:
        """The node reached by more edits; equal ways are one node, so nodes part by their letters."""
        for letter in letters:
            child = node.after.get(letter)
            if child is None:
                child = node.after[letter] = Edit(node, letter)
                node.uses += 1
                self.fresh.append(child)
            node = child
        return node

    def _leap(self, node: Edit) -> Edit:
        return node.skip if node.skip.depth > self.root.depth else self.root

    def less(self, a: Edit, b: Edit) -> bool:
        """Whether the edits up to ``a`` are least as text; a way that the other one goes on from is less."""
        first, second = a, b
        while a.depth > b.depth:
            a = self._leap(a) if self._leap(a).depth >= b.depth else a.up
        while b.depth > a.depth:
            b = self._leap(b) if self._leap(b).depth >= a.depth else b.up
        if a is b:
            return first.depth < second.depth
        while a.up is not b.up:
            x, y = self._leap(a), self._leap(b)
            a, b = (x, y) if x is not y else (a.up, b.up)
        return a.letter < b.letter

    def settle(self, survivors: list[Edit], before: list[Edit]) -> None:
        """Takes the new survivors for the old ones, drops what nobody uses, emits what all share."""
        for node in survivors:
            node.uses += 1
        for node in before:
            node.uses -= 1
        # children before parents: nodes made in this step come after those they hang on
        for node in [*reversed(self.fresh), *before]:
            while node.uses == 0 and node.up is not None and node.up.after.get(node.letter) is node:
                parent = node.up
                del parent.after[node.letter]
                parent.uses -= 1
                node = parent
        self.fresh.clear()
        while self.root.uses == 1 and self.root.after:
            ((letter, child),) = self.root.after.items()
            self.emit(letter)
            self.root.after, child.up, self.root = {}, None, child


class Search:
    """Survivors of one conversation: per state the least (cost, edits)."""

    def __init__(self, emit: Callable[[str], None]):
        self.tree = EditTree(emit)
        self.alive: dict[int, tuple[int, Edit]] = {START: (0, self.tree.root)}
        self.tree.root.uses = 1

    def _offer(self, into: dict, state: int, cost: int, node: Edit) -> None:
        old = into.get(state)
        if old is None or cost < old[0] or (cost == old[0] and node is not old[1] and self.tree.less(node, old[1])):
            into[state] = (cost, node)

    def _with_inserts(self) -> dict[int, tuple[int, Edit]]:
        """Survivors after any insertions: three or more between two turns only go round."""
        out = dict(self.alive)
        for state, (cost, node) in self.alive.items():
            for _ in range(2):
                state, cost, node = FOLLOWS[state][NEXT_ROLE[state][0]], cost + INSERT_COST, self.tree.grow(node, INSERT)
                self._offer(out, state, cost, node)
        return out

    def step(self, initial: str, fault: int) -> None:
        extra, after = TRUNCATED_COST if fault == TRUNCATED else 0, {}
        for state, (cost, node) in self._with_inserts().items():
            self._offer(after, state, cost + DELETE_COST, self.tree.grow(node, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            if initial in FOLLOWS[state]:
                self._offer(after, FOLLOWS[state][initial], cost + extra, self.tree.grow(node, KEEP))
            to = FOLLOWS[state][NEXT_ROLE[state][0]]
            self._offer(after, to, cost + extra + REROLE_COST, self.tree.grow(node, REROLE))
        # what still costs more than any end reached from the assistant state can't be on a cheapest way:
        # that state lacks no end but those with a system turn, which it may delete
        best = after[ASSISTANT][0] if ASSISTANT in after else None
        if best is not None:
            if START in after and after[START][0] > best + DELETE_COST:
                del after[START]
            if SYSTEM in after and after[SYSTEM][0] > best:
                del after[SYSTEM]
        self._take(after)

    def finish(self) -> int:
        """Emits the rest of the cheapest edits and gives their cost."""
        out = self._with_inserts()
        best: dict[int, tuple[int, Edit]] = {}
        for state in (START, ASSISTANT):
            if state in out:
                self._offer(best, 0, *out[state])
        self._take(best)
        return best[0][0]

    def _take(self, after: dict[int, tuple[int, Edit]]) -> None:
        before = [n for _, n in self.alive.values()]
        self.alive = after
        self.tree.settle([n for _, n in after.values()], before)


class Conversation:
    """Reads the turns of one conversation and hands its edits and at the end its report to ``write``."""

    def __init__(self, conv: object, write: Callable[..., None]):
        self.conv, self.write = conv, write
        self.waiting: deque[tuple[str, str, str]] = deque()
        self.search = Search(self._emit)
        self.state, self.steps = START, 0
        self.counts = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = self.initial = None
        self.turns = 0

    def turn(self, number: int | None, role: str, text: str, fault: int) -> None:
        if number is not None and number != self.high:
            self.turns += 1
            self.low = number if self.low is None else self.low
            self.high = number
        if fault:
            self.counts[("", "blank", "duplicate", "truncated")[fault]] += 1
        initial = role[:1]
        self.counts["illegal"] += self.initial is not None and (self.initial, initial) not in LEGAL
        self.initial = initial
        # a turn that has to go needs no text
        self.waiting.append((role, "" if fault in (BLANK, DUPLICATE) else text, initial))
        self.search.step(initial, fault)

    def _emit(self, letter: str) -> None:
        role, text, initial = ("", "", "") if letter == INSERT else self.waiting.popleft()
        if letter in (REROLE, INSERT):
            role = NEXT_ROLE[self.state]
            initial = role[0]
        if letter != DELETE:
            self.state = FOLLOWS[self.state][initial]
        self.write(self.conv, self.steps, letter, None if letter == DELETE else role, None if letter == DELETE else text, None)
        self.steps += 1

    def end(self) -> None:
        cost = self.search.finish()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        self.write(self.conv, self.steps, None, None, None, self.counts | {"gaps": gaps, "cost": cost})


REPORT = T.StructType([T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")])
STEPS = [("step", T.LongType()), ("edit", T.StringType()), ("role", T.StringType()), ("text", T.StringType()), ("report", REPORT)]
_ARROW = [("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("report", pa.struct([(f.name, pa.int64()) for f in REPORT]))]


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, out, size = None, [], 0
    current, now = object(), None

    def write(conv, step, edit, role, text, report):
        nonlocal size
        out.append((conv, step, edit, role, text, report))
        size += len(text or "")

    def ready(least: int = 1) -> Iterator[pa.RecordBatch]:
        nonlocal size
        if len(out) >= least or size > BATCH_BYTES:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            size = 0

    for batch in batches:
        schema = schema or pa.schema([pa.field("conv_id", batch.schema.field("conv").type), *(pa.field(n, t) for n, t in _ARROW)])
        for row in zip(*(batch.column(n).to_pylist() for n in ("key", "conv", "there", "turn", "role", "text", "fault")), strict=True):
            key, conv, there, number, role, text, fault = row
            if key != current:
                if now is not None:
                    now.end()
                current, now = key, Conversation(conv, write)
            if there:
                now.turn(number, role, text, fault)
            yield from ready(BATCH_ROWS)
    if now is not None:
        now.end()
        yield from ready()


def faults(turns: DataFrame) -> DataFrame:
    """conv, turn, role, text, there -> with ``fault``: the first of blank, duplicate, truncated."""
    text = F.col("text")
    again = F.row_number().over(Window.partitionBy("key", "there", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    blank = F.translate(text, BLANKS, "") == ""
    cut = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return turns.withColumn("fault", F.when(blank, BLANK).when(again, DUPLICATE).when(cut, TRUNCATED).otherwise(NONE))


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", there: Column | None = None) -> DataFrame:
    """conv_id, step, edit, role, text, report: the edits of each conversation in order, then one row with its report.

    ``edit`` is K, R, D or I; role and text are those of the repaired turn, null for a deleted one. In the last row of a
    conversation ``edit`` is null and ``report`` has gaps, blank, duplicate, truncated, illegal and cost. Rows
    where ``there`` is false are no turns, they only name a conversation, so one without turns has a report of zeros.

    Turns are read by number, null numbers first, then by role and text; turns equal in all are repeats, and all but the first are
    duplicates. Null roles and texts count as one space, and null ids are one conversation. A turn of any length is read
    whole. Ties between edits go to the least letters. An empty table gives no rows. Other columns are not looked at.

    A conversation is one sequence and is read by one task; it holds the turns that are still undecided,
    not the conversation. The rows of a conversation lie together and in order, as ``digest`` needs them.
    """
    space = F.lit(" ")
    own = turns.select(
        F.concat(F.when(F.col(conv_id).isNull(), "-").otherwise("+"), F.coalesce(F.col(conv_id).cast("string"), F.lit(""))).alias("key"),
        F.col(conv_id).alias("conv"),
        (F.lit(True) if there is None else F.coalesce(there, F.lit(False))).alias("there"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        F.coalesce(F.col(text), space).alias("text"),
    )
    ordered = faults(own.repartition("key")).sortWithinPartitions("key", F.col("turn").asc_nulls_first(), "role", "text")
    schema = T.StructType([T.StructField("conv_id", turns.schema[conv_id].dataType), *(T.StructField(n, t) for n, t in STEPS)])
    return ordered.mapInArrow(_repair, schema)


def repaired_turns(steps: DataFrame) -> DataFrame:
    """conv_id, step, role, text: the turns that stand after the edits, ``step`` giving their order."""
    return steps.where("edit IN ('K', 'R', 'I')").select("conv_id", "step", "role", "text")


def digest(steps: DataFrame) -> DataFrame:
    """One row per conversation: its report, ``audit`` (the letters of all edits) and the hash of the repaired ``role:text`` lines.

    Reads what ``repair`` gives in the same pass: the text is hashed as it comes and never held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, seen, lines = [], hashlib.sha256(), 0
        for batch in batches:
            out = []
            for conv, edit, role, text, report in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "edit", "role", "text", "report")), strict=True):
                if edit is None:
                    out.append((conv, *report.values(), "".join(letters), seen.hexdigest()))
                    letters, seen, lines = [], hashlib.sha256(), 0
                    continue
                letters.append(edit)
                if edit != DELETE:
                    seen.update((("\n" if lines else "") + f"{role}:{text}").encode())
                    lines += 1
            if out:
                kind = [batch.schema.field("conv_id").type, *[pa.int64()] * len(REPORT), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kind, strict=True)], names=names)

    fields = [steps.schema["conv_id"], *REPORT.fields, T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    names = [f.name for f in fields]
    return steps.mapInArrow(run, T.StructType(fields))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, there: known damage by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row (``there`` is false), 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 sets role user. Nulls count as one space.
    """
    space = F.lit(" ")
    kind = F.crc32(F.concat(*[F.coalesce(c, space) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("there"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")




# The damage, then the search by a recursion over rows: every state keeps its least (cost, letters, lines).
SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
coded AS (SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda d, z: xor(d >> 1, 3988292384 * (d & 1))))) % 20 AS kind FROM keyed),
harmed AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM coded WHERE kind <> 0),
sorted AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM harmed),
marked AS (SELECT *, substr(role, 1, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 3 ELSE 0 END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) AS earlier FROM sorted),
report AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM marked GROUP BY c),
inserts(a, b, letters, cost, lines) AS (VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''), (0, 2, 'I', 5, chr(10) || 'user:'), (1, 2, 'I', 5, chr(10) || 'user:'),
    (3, 2, 'I', 5, chr(10) || 'user:'), (2, 3, 'I', 5, chr(10) || 'assistant:'), (0, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(a, letter, initial, b, cost, role) AS (VALUES (0, 'D', NULL, 0, 2, NULL), (1, 'D', NULL, 1, 2, NULL), (2, 'D', NULL, 2, 2, NULL), (3, 'D', NULL, 3, 2, NULL),
    (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL), (3, 'K', 'u', 2, 0, NULL),
    (0, 'R', NULL, 2, 1, 'user'), (1, 'R', NULL, 2, 1, 'user'), (2, 'R', NULL, 3, 1, 'assistant'), (3, 'R', NULL, 2, 1, 'user')),
walk AS (
  SELECT c, CAST(0 AS BIGINT) AS i, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS letters, '' AS lines FROM report
  UNION ALL
  SELECT c, i, state, least_way.cost, least_way.letters, least_way.lines FROM (
    SELECT w.c, w.i + 1 AS i, e.b AS state, min({'cost': w.cost + n.cost + e.cost + CASE WHEN m.fault = 3 AND e.letter <> 'D' THEN 5 ELSE 0 END,
        'letters': w.letters || n.letters || e.letter, 'lines': w.lines || n.lines || CASE WHEN e.letter = 'D' THEN '' ELSE chr(10) || coalesce(e.role, m.role) || ':' || m.text END}) AS least_way
    FROM walk w JOIN inserts n ON n.a = w.state JOIN marked m ON m.c = w.c AND m.i = w.i + 1 JOIN edits e ON e.a = n.b
    WHERE (e.letter = 'D' OR m.fault NOT IN (1, 2)) AND (e.letter <> 'K' OR e.initial = m.initial)
    GROUP BY ALL)),
ends AS (SELECT w.c, min({'cost': w.cost + n.cost, 'letters': w.letters || n.letters, 'lines': w.lines || n.lines}) AS least_way
  FROM walk w JOIN report p ON p.c = w.c AND p.n = w.i JOIN inserts n ON n.a = w.state WHERE n.b IN (0, 3) GROUP BY w.c)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(least_way.cost, 0) AS cost, coalesce(least_way.letters, '') AS audit, sha256(coalesce(substr(least_way.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM keyed) k LEFT JOIN report USING (c) LEFT JOIN ends USING (c)
"""
