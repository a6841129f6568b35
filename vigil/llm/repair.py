"""Conversation structure repair: the cheapest edits that make a conversation alternate, by a survivor-coalescence Viterbi.

A repaired conversation has role initials ``(s?(ua)+)?``. Edits: K(eep) costs 0, R(erole to user or assistant) 3, D(elete) 4,
I(nsert an empty user or assistant turn) 3; a truncated row that stays adds 3; blank and duplicate rows must go. Of equally cheap
edit sequences the ASCII-least one counts.

States are E (nothing yet), S, U and A (the last role). Each keeps its best path, its survivor, as a leaf of a tree of
backpointers with reference counts. Where two paths meet in a state at equal cost, their whole unresolved suffixes are
compared (neither can be a prefix of the other: that would cost another insertion). A path that loses gives back its nodes; as soon as all survivors
descend from one node, the edits up to it are final and leave as rows. Nothing of a conversation is held beyond its unresolved
suffix, in which neighbouring deletions are one node. A survivor that can no longer win (E above A by more than a deletion, S above A) is dropped.
A suffix stays unresolved as long as the data leave it open: where every row needs a new role, only the end tells whether
the first one is a user's.

Spark does the rest: faults of single rows are expressions; which of the rows with one role and text comes first is a
``min`` per (conversation, role, SHA-256 of the text), summed map-side, and travels as a marker row just before it; rows and
markers are dealt by conversation and sorted there by turn, and the tasks read them as a stream, never as a group. The order of a
conversation's turns (and the hash over its repaired text) is one sequence, so one task reads it, in constant memory.

Defined cases: a null role or text is one space; null turns come first; rows of one turn stand by role, then by the SHA-256 of their
text; rows that are equal in all of these are duplicates of the first; a null conv_id is a conversation of its own; a conversation whose rows are all dropped keeps
its summary; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import tidy, with_python

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
E, S, U, A = range(4)
NAMES = {U: "user", A: "assistant"}
LEGAL = {"su", "ua", "au"}
MARKER, ROW, DROPPED = 0, 1, 2
FLUSH_ROWS, FLUSH_BYTES = 4096, 4 << 20
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class Node:
    """An edit in the backpointer tree; ``times`` neighbouring deletions are one node. ``refs``: children and survivors;
    ``rank``: a survivor's place among the survivors by its whole suffix."""

    __slots__ = ("parent", "edit", "turn", "times", "refs", "kids", "rank")

    def __init__(self, parent: Node | None, edit: str, turn: tuple[str, str] | None):
        self.parent, self.edit, self.turn, self.times, self.refs, self.kids, self.rank = parent, edit, turn, 1, 0, [], 0
        if parent is not None:
            parent.kids.append(self)
            parent.refs += 1


def release(node: Node | None) -> None:
    """Take one reference from a node; nodes that nothing refers to any more leave the tree."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        parent = node.parent
        if parent is not None:
            parent.kids.remove(node)
        node = parent


def _insertions(above: Node, below: Node) -> str | None:
    """The edits from ``above`` down to ``below`` if that one descends from it by insertions alone, else None."""
    steps = 0
    while below is not above:
        if below.edit != "I" or steps == 2:  # two insertions in a row are the most that can be cheapest
            return None
        below, steps = below.parent, steps + 1
    return "I" * steps


def precedes(a: Node, a_tail: str, b: Node, b_tail: str) -> bool:
    """Whether the whole unresolved suffix of survivor ``a`` with ``a_tail`` added is ASCII-less than that of ``b`` with ``b_tail``.

    Two survivors have edited the same rows, so their suffixes differ somewhere (``rank`` remembers how) or one has only
    insertions more than the other; no suffix is walked again."""
    between = _insertions(a, b)
    if between is not None:
        return a_tail < between + b_tail
    between = _insertions(b, a)
    if between is not None:
        return between + a_tail < b_tail
    return a.rank < b.rank


class Survivors:
    """The best path into every state; ``final`` holds the edits that all of them share and that were not taken yet."""

    def __init__(self) -> None:
        self.root = Node(None, "", None)
        self.cost: list[int | None] = [0, None, None, None]
        self.leaf: list[Node | None] = [self.root, None, None, None]
        self.root.refs = 1
        self.final: list[tuple[str, tuple[str, str] | None]] = []
        self._insert()

    def _offer(self, best: dict, state: int, cost: int, source: Node, edit: str, turn: tuple[str, str] | None) -> None:
        old = best.get(state)
        if old is None or cost < old[0] or (cost == old[0] and precedes(source, edit, old[1], old[2])):
            best[state] = (cost, source, edit, turn)

    def _take(self, state: int, won: tuple) -> None:
        """The path ``won`` becomes the survivor of a state."""
        cost, source, edit, turn = won
        node = Node(source, edit, turn)
        node.refs += 1
        if self.leaf[state] is not None:
            release(self.leaf[state])
        self.cost[state], self.leaf[state] = cost, node

    def _rank(self, fresh: tuple[int, ...]) -> None:
        """Order the survivors; those of the states ``fresh`` are one edit behind ranked ones."""
        paths = [(leaf.parent, leaf.edit, leaf) if state in fresh else (leaf, "", leaf) for state, leaf in enumerate(self.leaf) if leaf is not None]
        paths.sort(key=functools.cmp_to_key(lambda x, y: -1 if precedes(x[0], x[1], y[0], y[1]) else 1))
        for i, (_, _, leaf) in enumerate(paths):
            leaf.rank = i

    def _insert(self) -> None:
        """Between rows a turn may be inserted: a user turn after E, S or A, then an assistant turn after U."""
        for to, sources in ((U, (E, S, A)), (A, (U,))):
            best: dict = {}
            for state in sources:
                if self.cost[state] is not None:
                    self._offer(best, to, self.cost[state] + INSERT, self.leaf[state], "I", (NAMES[to], ""))
            if best:
                cost, source, edit, _ = best[to]
                if self.cost[to] is None or cost < self.cost[to] or (cost == self.cost[to] and precedes(source, edit, self.leaf[to], "")):
                    self._take(to, best[to])
                    self._rank((to,))

    def row(self, role: str, text: str | None, must_go: bool, truncated: bool) -> None:
        best: dict = {}
        extra = TRUNCATED if truncated else 0
        initial = role[:1]
        for state in (E, S, U, A):
            cost, leaf = self.cost[state], self.leaf[state]
            if cost is None:
                continue
            self._offer(best, state, cost + DELETE, leaf, "D", None)
            if must_go:
                continue
            to = A if state == U else U
            if initial == "ua"[to - U]:
                self._offer(best, to, cost + extra, leaf, "K", (role, text))
            elif initial == "s" and state == E:
                self._offer(best, S, cost + extra, leaf, "K", (role, text))
            self._offer(best, to, cost + extra + REROLE, leaf, "R", (NAMES[to], text))
        old = [leaf for leaf in self.leaf if leaf is not None]
        self.leaf = [None] * 4
        self.cost = [None] * 4
        for state, won in best.items():
            self._take(state, won)
        self._rank((E, S, U, A))
        for leaf in old:
            release(leaf)
        self._insert()
        self._prune()
        self._coalesce()

    def _drop(self, state: int) -> None:
        release(self.leaf[state])
        self.cost[state] = self.leaf[state] = None

    def _prune(self) -> None:
        if self.cost[E] is not None and self.cost[E] > self.cost[A] + DELETE:
            self._drop(E)
        if self.cost[S] is not None and self.cost[S] > self.cost[A]:
            self._drop(S)

    def _coalesce(self) -> None:
        """Join neighbouring deletions, and make edits final up to the last node that all survivors descend from."""
        for leaf in self.leaf:
            node = leaf
            for _ in range(3):
                if node is None or node.parent is None:
                    break
                parent = node.parent
                if node.edit == "D" == parent.edit and parent.refs == 1 and parent.parent is not None:
                    node.times += parent.times
                    above = parent.parent
                    above.kids[above.kids.index(parent)] = node
                    node.parent = above
                else:
                    node = parent
        while self.root.refs == 1 and self.root.kids:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.final.extend([(self.root.edit, self.root.turn)] * self.root.times)

    def end(self) -> int:
        """The cost of the best accepted path, whose edits are then final."""
        if self.cost[E] is not None and (self.cost[E] < self.cost[A] or (self.cost[E] == self.cost[A] and precedes(self.leaf[E], "", self.leaf[A], ""))):
            keep = E
        else:
            keep = A
        for state in (E, S, U, A):
            if state != keep and self.cost[state] is not None:
                self._drop(state)
        self._coalesce()
        return self.cost[keep]


class Conversation:
    """One conversation's rows as they come: counts, and the edits so far."""

    def __init__(self) -> None:
        self.survivors, self.rows = Survivors(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None
        self.turns, self.last_initial, self.first = 0, None, False

    def marker(self) -> None:
        self.first = True

    def row(self, turn: int | None, role: str, text: str | None, blank: bool, truncated: bool) -> None:
        if turn is not None and turn != self.high:  # turns come in order
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        if self.rows:
            self.illegal += self.last_initial + role[:1] not in LEGAL
        self.last_initial, self.rows = role[:1], self.rows + 1
        duplicate = not blank and not self.first
        self.first = self.first and blank
        truncated = truncated and not blank and not duplicate
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.survivors.row(role, text, blank or duplicate, truncated)

    def take(self) -> list[tuple[str, tuple[str, str] | None]]:
        out, self.survivors.final = self.survivors.final, []
        return out

    def summary(self) -> tuple[int, ...]:
        cost = self.survivors.end()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost


def damaged(turns: DataFrame) -> DataFrame:
    """The rows with planted faults: by the CRC of ``conv_id:turn``, a row is dropped (``dropped`` is set), emptied, loses its
    sentence ends, is repeated, or gets the role of a user. Nulls count as one space."""
    named = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    written = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(written[0], F.lit(":"), written[1])) % 20
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _stream(turns: DataFrame) -> DataFrame:
    """Rows, markers of first occurrences and names of conversations, dealt by conversation and sorted."""
    dropped = F.col("dropped") if "dropped" in turns.columns else F.lit(False)
    base = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(dropped, F.lit(False)).alias("dropped"),
    )
    told = base.where(~F.col("dropped")).select(
        "conv_id", "turn", "role", "text",
        F.unhex(F.sha2("text", 256)).alias("text_key"),
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    none = F.lit(None).cast("string")
    rows = told.select("conv_id", "turn", "role", "text_key", F.lit(ROW).alias("kind"), F.when(~F.col("blank"), F.col("text")).alias("text"), "blank", "truncated")
    # null turns come first, so a null is the least
    first = F.min(F.struct("turn")).alias("at")
    markers = told.where(~F.col("blank")).groupBy("conv_id", "role", "text_key").agg(first).select(
        "conv_id", F.col("at.turn").alias("turn"), "role", "text_key", F.lit(MARKER).alias("kind"), none.alias("text"), F.lit(False).alias("blank"), F.lit(False).alias("truncated")
    )
    names = base.where("dropped").select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("turn"), none.alias("role"), F.lit(None).cast("binary").alias("text_key"), F.lit(DROPPED).alias("kind"),
        none.alias("text"), F.lit(False).alias("blank"), F.lit(False).alias("truncated"),
    )
    return rows.unionByName(markers).unionByName(names).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text_key", "kind")


def repair(turns: DataFrame) -> DataFrame:
    """The edits of every conversation, in order, one row each: conv_id, position (from 0), edit, and the role and text that
    stay (null where deleted); and one closing row per conversation (position null) with its counts and cost.

    Input: conv_id, turn, role, text; rows with a true ``dropped`` only name their conversation. The rows of a conversation
    follow each other in one partition; ``digest`` reads them that way."""
    with_python(turns.sparkSession)
    stream = _stream(turns).select("conv_id", "turn", "role", "kind", "text", "blank", "truncated")
    id_type = stream.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("position", T.LongType()),
        *[T.StructField(n, T.StringType()) for n in ("edit", "role", "text")], *[T.StructField(n, T.LongType()) for n in COUNTS],
    ])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out, held = None, [], 0
        open_, name, position = None, None, 0

        def put() -> None:
            nonlocal position, held
            for edit, turn in open_.take():
                role, text = turn or (None, None)
                out.append((name, position, edit, role, text, *[None] * len(COUNTS)))
                position, held = position + 1, held + len(text or "")

        def close() -> None:
            counts = open_.summary()
            put()
            out.append((name, None, None, None, None, *counts))

        def flush() -> pa.RecordBatch:
            nonlocal held
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(arrow)]
            out.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

        for batch in it:
            if arrow is None:
                arrow = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS)]
            for conv, turn, role, kind, text, blank, truncated in zip(*[c.to_pylist() for c in batch.columns]):
                if open_ is None or conv != name:
                    if open_ is not None:
                        close()
                    open_, name, position = Conversation(), conv, 0
                if kind == MARKER:
                    open_.marker()
                elif kind == ROW:
                    open_.row(turn, role, text, blank, truncated)
                    if open_.survivors.final:
                        put()
                if len(out) >= FLUSH_ROWS or held >= FLUSH_BYTES:
                    yield flush()
        if open_ is not None:
            close()
            yield flush()

    return stream.mapInArrow(tidy(batches), schema)


def digest(repaired: DataFrame) -> DataFrame:
    """One row per conversation from the rows of ``repair`` as they come: the counts, the cost, the edits as a string and the
    SHA-256 of the repaired turns (``role:text``, joined by newlines)."""
    id_type = repaired.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", id_type), *[T.StructField(n, T.LongType()) for n in COUNTS],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, sha, turns = [], hashlib.sha256(), 0
        for batch in it:
            out = []
            for conv, position, edit, role, text, *counts in zip(*[c.to_pylist() for c in batch.columns]):
                if position is None:
                    out.append((conv, *counts, "".join(audit), sha.hexdigest()))
                    audit, sha, turns = [], hashlib.sha256(), 0
                    continue
                audit.append(edit)
                if edit != "D":
                    sha.update(f"{chr(10) if turns else ''}{role}:{text}".encode())
                    turns += 1
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=[f.name for f in schema.fields])

    return repaired.mapInArrow(tidy(batches), schema)


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS id FROM conversations),
crc AS (SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(id[i])::BIGINT for i in range(1, length(id) + 1)]),
                lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                      lambda x, y: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384::BIGINT ELSE 0 END)))) % 20 AS h FROM t),
hurt AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
                CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
         FROM crc WHERE h <> 0),
placed AS (SELECT *, row_number() OVER c AS k,
                  left(role, 1) AS initial, lag(left(role, 1)) OVER c || left(role, 1) AS pair,
                  regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS trimmed
           FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text))),
seen AS (SELECT *, k > min(k) OVER (PARTITION BY conv_id, role, text) AS again FROM placed),
r AS (SELECT *, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate,
             trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated FROM seen),
moves AS (SELECT * FROM (VALUES ('E', 'U'), ('S', 'U'), ('A', 'U'), ('U', 'A')) m(state, towards)),
inserts AS (SELECT * FROM (VALUES ('U', 'A', 3, 'I', chr(10) || 'assistant:'), ('E', 'U', 3, 'I', chr(10) || 'user:'), ('S', 'U', 3, 'I', chr(10) || 'user:'),
    ('A', 'U', 3, 'I', chr(10) || 'user:'), ('E', 'A', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('S', 'A', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('E', 'E', 0, '', ''), ('S', 'S', 0, '', ''), ('U', 'U', 0, '', ''), ('A', 'A', 0, '', '')) i(state, towards, price, edits, told)),
path AS (
  SELECT conv_id, 0::BIGINT AS k, i.towards AS state, i.price::BIGINT AS cost, i.edits AS audit, i.told AS told
  FROM (SELECT DISTINCT conv_id FROM conversations) c JOIN inserts i ON i.state = 'E'
  UNION ALL
  SELECT conv_id, k, state, cost, audit, told FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT e.conv_id, e.k, i.towards AS state, (e.cost + i.price)::BIGINT AS cost, e.audit || i.edits AS audit, e.told || i.told AS told FROM (
        SELECT p.conv_id, r.k, p.state, p.cost + 4 AS cost, p.audit || 'D' AS audit, p.told
        FROM path p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = p.k + 1
        UNION ALL
        SELECT p.conv_id, r.k, CASE WHEN r.initial = 's' THEN 'S' ELSE m.towards END, p.cost + CASE WHEN truncated THEN 3 ELSE 0 END, p.audit || 'K', p.told || chr(10) || r.role || ':' || r.text
        FROM path p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = p.k + 1 JOIN moves m ON m.state = p.state
        WHERE NOT blank AND NOT duplicate AND (r.initial = lower(m.towards) OR (r.initial = 's' AND p.state = 'E'))
        UNION ALL
        SELECT p.conv_id, r.k, m.towards, p.cost + 3 + CASE WHEN truncated THEN 3 ELSE 0 END, p.audit || 'R',
               p.told || chr(10) || CASE m.towards WHEN 'U' THEN 'user' ELSE 'assistant' END || ':' || r.text
        FROM path p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.k = p.k + 1 JOIN moves m ON m.state = p.state
        WHERE NOT blank AND NOT duplicate) e JOIN inserts i ON i.state = e.state))
  WHERE place = 1),
ends AS (SELECT conv_id, arg_min({cost: cost, audit: audit, told: told}, (cost, audit)) AS best
         FROM path p WHERE state IN ('E', 'A') AND k = coalesce((SELECT max(r.k) FROM r WHERE r.conv_id IS NOT DISTINCT FROM p.conv_id), 0) GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
                  count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.cost AS cost, best.audit AS audit, sha256(substr(best.told, 2)) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""
