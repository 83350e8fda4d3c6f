"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation's rows are edited (Keep, Rerole, Delete, Insert) until their roles read
``(system? (user assistant)+)?``.  The cheapest edits are found by a Viterbi pass over four
states (nothing yet, after system, after user, after assistant).  Each state's survivor is a leaf
of one tree of back pointers with reference counts; once all survivors share an ancestor, the
edits up to it are final, are emitted and freed.  Equal costs are told apart by comparing the whole
unresolved parts of the two edit strings, back to where the two paths part.  Memory thus follows the
unresolved part, not the conversation.

Spark cleans the rows, brings each conversation together with one exchange and sorts it there; a
task then reads its rows as a stream.  All texts of one conversation pass through one task, as
the SHA-256 of its repaired text is a chain over them; they are never held together.

Defined results: a null role or text is one space (so a null text is blank); a null ``turn`` sorts
first and doesn't count as a gap; a null ``conv_id`` is one conversation.  Rows of one turn are
ordered by role, then text, so repeated rows stay together.  A role with another initial than s, u
or a, the empty role among them, can't be kept.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
PRICE, TRUNCATED = {"R": 1, "D": 2, "I": 5}, 5  # what an edit costs; a truncated row that stays

_REPORT = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
           "cost bigint, audit string, repaired_sha256 string")


class Node:
    """One edit in the tree of back pointers; ``refs`` counts its children and survivors."""

    __slots__ = ("up", "kids", "refs", "depth", "letter", "edit")

    def __init__(self, up: Node | None, letter: str, edit):
        self.up, self.kids, self.refs = up, [], 0
        self.depth = 0 if up is None else up.depth + 1
        self.letter, self.edit = letter, edit
        if up is not None:
            up.kids.append(self)
            up.refs += 1


def release(node: Node) -> None:
    """One reference less; branches that nobody refers to are cut."""
    node.refs -= 1
    while node.refs == 0 and node.up is not None:
        up = node.up
        up.kids.remove(node)
        node.up = None
        up.refs -= 1
        node = up


def comes_first(a: Node, last_a: str, b: Node, last_b: str) -> bool:
    """Is path a + last_a less than path b + last_b?  Compares all after the common ancestor."""
    left, right = [last_a], [last_b]
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.letter)
            a = a.up
        else:
            right.append(b.letter)
            b = b.up
    return left[::-1] < right[::-1]


class Repairer:
    """Viterbi over one conversation; ``feed`` and ``finish`` yield edits as they become final.

    An edit is (letter, row, role, text): the row as fed (None for an insert) and
    what stands there afterwards (None, None for a deleted row).
    """

    def __init__(self):
        self.root = Node(None, "", None)
        self.best: dict[int, tuple[int, Node]] = {0: (0, self.root)}
        self.root.refs += 1
        self.cost = 0
        self._insert()

    def feed(self, row, role: str, text: str, must_go: bool, truncated: bool) -> Iterator[tuple]:
        found: dict[int, tuple[int, Node, str, tuple]] = {}

        def offer(state: int, cost: int, up: Node, letter: str, edit: tuple) -> None:
            old = found.get(state)
            if old is None or cost < old[0] or (
                    cost == old[0] and comes_first(up, letter, old[1], old[2])):
                found[state] = (cost, up, letter, edit)

        extra = TRUNCATED if truncated else 0
        for state, (cost, up) in self.best.items():
            offer(state, cost + PRICE["D"], up, "D", ("D", row, None, None))
            if must_go:
                continue
            kept = NEXT.get((state, role[:1]))
            if kept is not None:
                offer(kept, cost + extra, up, "K", ("K", row, role, text))
            for initial, name in ROLES.items():
                to = NEXT.get((state, initial))
                if to is not None:
                    offer(to, cost + extra + PRICE["R"], up, "R", ("R", row, name, text))
        old = self.best
        self.best = {s: (cost, Node(up, letter, edit)) for s, (cost, up, letter, edit) in found.items()}
        for _, node in self.best.values():
            node.refs += 1
        for _, node in old.values():
            release(node)
        self._insert()
        self._drop_beaten()
        yield from self._final()

    def _insert(self) -> None:
        """Inserts after the present row, until no state gets cheaper or earlier by one more."""
        changed = True
        while changed:
            changed = False
            for state, initial in ((s, i) for s in range(4) for i in ROLES):
                to = NEXT.get((state, initial))
                if to is not None and state in self.best:
                    (cost, up), name = self.best[state], ROLES[initial]
                    new, old = cost + PRICE["I"], self.best.get(to)
                    if old is None or new < old[0] or (
                            new == old[0] and old[1].up is not None and comes_first(
                                up, "I", old[1].up, old[1].letter)):
                        node = Node(up, "I", ("I", None, name, ""))
                        node.refs += 1
                        self.best[to] = (new, node)
                        if old is not None:
                            release(old[1])
                        changed = True

    def _drop_beaten(self) -> None:
        """Drop states that can no longer be part of the cheapest edits.

        After an assistant all may follow that may follow a system row, and all that may
        follow nothing, but a kept system row, whose deletion costs 2.
        """
        if 3 in self.best:
            for state, ahead in ((1, 0), (0, PRICE["D"])):
                if state in self.best and self.best[state][0] > self.best[3][0] + ahead:
                    release(self.best.pop(state)[1])

    def _final(self) -> Iterator[tuple]:
        """Edits up to the last ancestor that all survivors share."""
        while self.root.refs == 1 and self.root.kids:
            child = self.root.kids.pop()
            child.up = None
            self.root = child
            yield child.edit
            child.edit = None

    def finish(self) -> Iterator[tuple]:
        ends = [(cost, node) for state, (cost, node) in self.best.items() if state in (0, 3)]
        cost, end = ends[0]
        for other, node in ends[1:]:
            if other < cost or (other == cost and comes_first(node, "", end, "")):
                cost, end = other, node
        self.cost = cost
        for _, node in self.best.values():
            if node is not end:
                release(node)
        yield from self._final()


def clean_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls in role and text as one space."""
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"))


def with_faults(rows: DataFrame, dropped: Column) -> DataFrame:
    """Each conversation in one task in order of turns, with each row's first fault.

    ``dropped`` rows only keep their conversation known.  One exchange serves the
    duplicates and the order, as all rows of a conversation are needed together.
    """
    bare = F.rtrim("text", F.lit(BLANKS))
    text_key = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    same = Window.partitionBy("conv_id", "dropped", "role", "text_key").orderBy(
        F.asc_nulls_first("turn"))
    return (rows.select("conv_id", "turn", "role", "text", dropped.alias("dropped"),
                        text_key.alias("text_key"))
            .repartition("conv_id")
            .withColumn("earlier", F.row_number().over(same) - 1)
            .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "earlier")
            .select("conv_id", "turn", "role", "text", "dropped",
                    F.when(bare == "", "blank").when(F.col("earlier") > 0, "duplicate")
                    .when(~F.substring(bare, -1, 1).isin(*ENDINGS), "truncated")
                    .otherwise("").alias("fault")))


class _Report:
    """What is told of one conversation, gathered row by row and edit by edit."""

    def __init__(self):
        self.repairer = Repairer()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first_turn = self.last_turn = self.before = None
        self.audit, self.sha, self.lines = [], hashlib.sha256(), 0

    def row(self, turn, role: str, text: str, fault: str) -> None:
        if fault:
            self.faults[fault] += 1
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        self._take(self.repairer.feed(None, role, text, fault in ("blank", "duplicate"),
                                      fault == "truncated"))

    def _take(self, edits: Iterator[tuple]) -> None:
        for letter, _, role, text in edits:
            self.audit.append(letter)
            if role is not None:
                self.sha.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
                self.lines += 1

    def values(self) -> tuple:
        self._take(self.repairer.finish())
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults.values(), self.illegal, self.repairer.cost,
                "".join(self.audit), self.sha.hexdigest())


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, None) at the start of each conversation, then (conv_id, its row values)."""
    current = object()
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for conv_id, *row in zip(*columns):
            if conv_id != current:
                current = conv_id
                yield conv_id, None
            yield conv_id, row


def _type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def report(conversations: DataFrame, dropped: Column | None = None) -> DataFrame:
    """One row a conversation: its faults, the cost and letters of its repair, the repaired SHA-256.

    ``conversations`` has conv_id, turn, role and text; rows where ``dropped`` holds are left out, but
    their conversation is told of all the same (zeros if it has no other row).
    """
    faulty = with_faults(clean_rows(conversations) if dropped is None else conversations,
                         F.lit(False) if dropped is None else dropped)

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, state, names = [], None, ["conv_id", *(c.split()[0] for c in _REPORT.split(", "))]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        def counted(parts):
            nonlocal types
            for part in parts:
                types = types or [part.schema.field("conv_id").type, *[pa.int64()] * 6, *[pa.string()] * 2]
                yield part

        types = None
        for conv_id, row in _streamed(counted(batches)):
            if row is None:
                if state is not None:
                    out.append((state[0], *state[1].values()))
                if len(out) >= 4096:
                    yield batch()
                    out.clear()
                state = (conv_id, _Report())
                continue
            turn, role, text, gone, fault = row
            if not gone:
                state[1].row(turn, role, text, fault)
        if state is not None:
            out.append((state[0], *state[1].values()))
            yield batch()

    return faulty.mapInArrow(reports, f"conv_id {_type_of(conversations, 'conv_id')}, {_REPORT}")


def repair(conversations: DataFrame) -> DataFrame:
    """The edits themselves: conv_id, step (from 1), edit (K, R, D, I), turn, role and text afterwards.

    Deleted rows have neither role nor text; inserted ones have no turn and an empty
    text.  Reading the rows with a role in order of step gives the repaired conversation.
    """
    faulty = with_faults(clean_rows(conversations), F.lit(False))

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, types = [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                              ["conv_id", "step", "edit", "turn", "role", "text"])

        def typed(parts):
            for part in parts:
                types[:] = [part.schema.field("conv_id").type, pa.int64(), pa.string(),
                            part.schema.field("turn").type, pa.string(), pa.string()]
                yield part

        conv, repairer, step = None, None, 0

        def take(found):
            nonlocal step
            for letter, turn, role, text in found:
                step += 1
                out.append((conv, step, letter, turn, role, text))

        for conv_id, row in _streamed(typed(batches)):
            if row is None:
                if repairer is not None:
                    take(repairer.finish())
                conv, repairer, step = conv_id, Repairer(), 0
            else:
                turn, role, text, _, fault = row
                take(repairer.feed(turn, role, text, fault in ("blank", "duplicate"),
                                   fault == "truncated"))
            if len(out) >= 4096:
                yield batch()
                out.clear()
        if repairer is not None:
            take(repairer.finish())
        if out:
            yield batch()

    return faulty.mapInArrow(
        edits, f"conv_id {_type_of(conversations, 'conv_id')}, step bigint, edit string, "
               f"turn {_type_of(conversations, 'turn')}, role string, text string")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20; ``dropped`` marks those that go.

    0 drops the row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it,
    4 makes its role user.  Nulls count as one space, in the key too.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = clean_rows(conversations).withColumn("case", F.crc32(key.cast("binary")) % 20)
    case = F.col("case")
    return (rows.withColumn("copy", F.explode(F.when(case == 3, F.array(F.lit(0), F.lit(1)))
                                              .otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(case == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(case == 1, "").when(case == 2, F.translate("text", ENDINGS, ""))
                    .otherwise(F.col("text")).alias("text"), (case == 0).alias("dropped")))


ORACLE = """
WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY b) AS t FROM (
 SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
 FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b))),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
cases AS (SELECT keyed.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 20 AS h FROM keyed, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
 CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
 FROM cases, unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS c(copy) WHERE h <> 0),
counted AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen,
 rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id
 ORDER BY turn NULLS FIRST, role, text, seen) AS pos FROM counted),
rows AS (SELECT *, substr(role, 1, 1) AS i, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM numbered),
nexts AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) v(q, i, z)),
inserts AS (SELECT q, q AS z, 0 AS price, '' AS letter, '' AS line FROM (VALUES (0), (1), (2), (3)) v(q)
 UNION ALL SELECT q, z, 5, 'I', chr(10) || CASE i WHEN 'u' THEN 'user:' ELSE 'assistant:' END
 FROM nexts WHERE i <> 's'),
edits AS (SELECT conv_id, pos, q, q AS z, 2 AS price, 'D' AS letter, '' AS line
  FROM rows, (VALUES (0), (1), (2), (3)) v(q)
 UNION ALL SELECT conv_id, pos, q, z, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K',
  chr(10) || role || ':' || text FROM rows JOIN nexts ON rows.i = nexts.i
  WHERE fault NOT IN ('blank', 'duplicate')
 UNION ALL SELECT conv_id, pos, q, z, 1 + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'R',
  chr(10) || CASE nexts.i WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
  FROM rows, nexts WHERE nexts.i <> 's' AND fault NOT IN ('blank', 'duplicate')),
steps AS (SELECT e.conv_id, e.pos, i.q AS q, e.z AS z, i.price + e.price AS price,
 i.letter || e.letter AS letter, i.line || e.line AS line FROM inserts i JOIN edits e ON i.z = e.q),
convs AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS text
 FROM convs
 UNION ALL SELECT conv_id, pos, z, cost, audit, text FROM (
  SELECT w.conv_id, s.pos, s.z, w.cost + s.price AS cost, w.audit || s.letter AS audit, w.text || s.line AS text,
   row_number() OVER (PARTITION BY w.conv_id, s.z ORDER BY w.cost + s.price, w.audit || s.letter) AS place
  FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.pos = w.pos + 1 AND s.q = w.q)
 WHERE place = 1),
told AS (SELECT conv_id, count(*) AS rows_after, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
 count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
 count(*) FILTER (WHERE fault = 'truncated') AS truncated FROM rows GROUP BY conv_id),
pairs AS (SELECT conv_id, i AS y, pos, lag(i) OVER (PARTITION BY conv_id ORDER BY pos) AS x FROM rows),
illegal AS (SELECT conv_id, count(*) AS illegal FROM pairs
 WHERE pos > 1 AND x || y NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
ends AS (SELECT w.conv_id, w.cost + i.price AS cost, w.audit || i.letter AS audit, w.text || i.line AS text
 FROM walk w JOIN inserts i ON w.q = i.q LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM w.conv_id
 WHERE i.z IN (0, 3) AND w.pos = coalesce(told.rows_after, 0)),
best AS (SELECT conv_id, cost, audit, text FROM ends
 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1)
SELECT best.conv_id AS conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps,
 CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
 CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
 CAST(cost AS BIGINT) AS cost, audit, sha256(substr(text, 2)) AS repaired_sha256
FROM best LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM best.conv_id
 LEFT JOIN illegal ON illegal.conv_id IS NOT DISTINCT FROM best.conv_id
"""
