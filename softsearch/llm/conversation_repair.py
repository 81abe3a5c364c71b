"""Conversation structure repair by a Viterbi search with survivor coalescence.

The turns of a conversation are read in order, in a stream. For each state of the grammar
``(system? (user assistant)+)?`` the cheapest edits that lead there survive, as the leaf of a
tree of backpointers. A node counts the references of its children; what no survivor refers to
any more is taken off, and once all survivors share an ancestor the edits up to it are final
and leave the worker. So a worker holds the unresolved part of one conversation, not all of it.

Ties go to the least string of edit initials. Survivors have treated the same rows and end with
the edit of a row, so none is the beginning of another and their order never changes when they
grow: a rank per survivor tells how the complete unresolved parts compare. An insertion before
a deletion is never the least string, so it isn't tried.

Two survivors leave early. The empty state lets a system turn come, at most a deletion cheaper
than the end of a pair, so it goes when it costs more than that; the state after a system turn
allows less than the end of a pair and goes when it costs more.

Equal rows are folded with their number, earlier copies are found by a window over
(conversation, role, text), and only then the rows meet by conversation, sorted, so a
conversation of any length streams through its task.

Defined results: a null role or text counts as one space (a blank text, an unknown role); null
turns come first and don't count for gaps; equal turns are ordered by role and text; rows
without a conversation id are one conversation; repeated rows are duplicates; a conversation
whose rows are all dropped has zeros; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from softsearch.llm.common import table

#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: What stands next to each other in a sound conversation.
LEGAL = {"su", "ua", "au"}
#: Edits that a worker passes on at a time.
BLOCK = 2048

_EDITS = "place long, edit string, times long, role string, text string"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Node:
    """Edits of one row, with the insertions before it, in the tree of backpointers."""

    __slots__ = ("parent", "edits", "times", "row", "children", "state", "cost", "rank")

    def __init__(self, parent, edits, times, row, state, cost):
        self.parent, self.edits, self.times, self.row = parent, edits, times, row
        self.children, self.state, self.cost, self.rank = set(), state, cost, 0


class Survivors:
    """The cheapest edits per state, and the tree they hang on."""

    def __init__(self):
        self.root = Node(None, "", 0, None, EMPTY, 0)
        self.leaves = [self.root]
        self.state, self.resolved = EMPTY, []

    def _next(self, found: dict) -> None:
        """``found``: state to (cost, rank of the parent, edits, parent, times, row)."""
        end = min((found[s][0] + extra for s, extra in ((ASSISTANT, 0), (USER, INSERT)) if s in found), default=None)
        if end is not None:
            if EMPTY in found and end + DELETE < found[EMPTY][0]:
                del found[EMPTY]
            if SYSTEM in found and end < found[SYSTEM][0]:
                del found[SYSTEM]
        old, self.leaves = self.leaves, []
        for rank, (state, (cost, _, edits, parent, times, row)) in enumerate(sorted(found.items(), key=lambda x: x[1][1:3])):
            node = Node(parent, edits, times, row, state, cost)
            node.rank = rank
            parent.children.add(node)
            self.leaves.append(node)
        for node in old:  # what nothing refers to any more
            while node is not self.root and not node.children:
                node.parent.children.discard(node)
                node = node.parent
        self._resolve()

    def _resolve(self) -> None:
        while len(self.root.children) == 1:
            (node,) = self.root.children
            self._emit(node.edits, node.times, node.row)
            node.parent, self.root = None, node

    def _emit(self, edits: str, times: int, row) -> None:
        for edit in edits:
            role = text = None
            if edit != "D":
                ahead = ASSISTANT if self.state == USER else USER
                role, text = ("assistant" if ahead == ASSISTANT else "user"), (row[1] if edit != "I" else "")
                if edit == "K":
                    role = row[0]
                    ahead = SYSTEM if role[:1] == "s" else ahead
                self.state = ahead
            self.resolved.append((edit, times if edit == "D" else 1, role, text))

    def delete(self, times: int, row) -> None:
        """Rows that have to go."""
        self._next({n.state: (n.cost + DELETE * times, n.rank, "D", n, times, row) for n in self.leaves})

    def read(self, row, truncated: bool) -> None:
        """A row ``(role, text)`` that may stay."""
        found = {n.state: (n.cost + DELETE, n.rank, "D", n, 1, row) for n in self.leaves}
        first, stay = row[0][:1], TRUNCATED if truncated else 0

        def offer(state, cost, edits, n):
            if state not in found or (cost, n.rank, edits) < found[state][:3]:
                found[state] = (cost, n.rank, edits, n, 1, row)

        for n in self.leaves:
            if n.state == EMPTY and first == "s":
                offer(SYSTEM, n.cost + stay, "K", n)
            before_user, before_assistant = ("I", "") if n.state == USER else ("", "I")
            for target, before, initial in ((USER, before_user, "u"), (ASSISTANT, before_assistant, "a")):
                edit, cost = ("K", 0) if first == initial else ("R", REROLE)
                offer(target, n.cost + stay + cost + INSERT * len(before), before + edit, n)

        self._next(found)

    def end(self) -> int:
        """Close the conversation; returns the least cost."""
        closing = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, _, edits, best = min(((n.cost + INSERT * len(closing[n.state]), n.rank, closing[n.state], n) for n in self.leaves), key=lambda x: x[:3])
        path = []
        while best is not self.root:
            path.append(best)
            best = best.parent
        for node in reversed(path):
            self._emit(node.edits, node.times, node.row)
        self._emit(edits, 1, None)
        return cost


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text, copies`` after the damage that the CRC-32 of ``conv:turn`` modulo
    20 chooses; a dropped row leaves a row without role, text and copies."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    conv, turn = F.col(f"`{conv}`"), F.col(f"`{turn}`")
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn))) % 20
    rows = df.select(conv.alias("conv"), turn.cast("long").alias("turn"), blank(F.col(f"`{role}`")).alias("role"), blank(F.col(f"`{text}`")).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    left = lambda c: F.when(F.col("kind") != 0, c)
    return rows.select(
        "conv", left(F.col("turn")).alias("turn"), left(F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
        left(text).alias("text"), F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def as_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as they are, in the form that ``repair`` takes."""
    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return df.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), F.lit(1).cast("long").alias("copies"))


def _is_blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))


def _is_truncated(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z"))


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations, edit by edit: ``conv, place, edit`` (D, I, K or R)``, times,
    role, text``; a deleted turn has no role and text. After the edits of a conversation comes
    a row without an edit that holds its faults and its cost. ``rows`` comes from ``damaged``
    or ``as_rows``. Conversations lie whole and in order within the partitions of the result.
    """
    folded = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    seen = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    marked = folded.select("*", seen.alias("seen"), _is_blank(F.col("text")).alias("blank"), _is_truncated(F.col("text")).alias("truncated"))
    order = ["conv", F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    ordered = marked.repartition("conv").sortWithinPartitions(*order)
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(_EDITS).fields, *[T.StructField(c, T.LongType()) for c in _COUNTS]])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        out, conv, one = [], None, None

        def ready():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)
            out.clear()
            return batch

        def pass_on(conv, one):
            for edit, times, role, text in one.search.resolved:
                out.append((conv, one.place, edit, times, role, text, *[None] * len(_COUNTS)))
                one.place += 1
            one.search.resolved.clear()

        def close(conv, one):
            cost = one.search.end()
            pass_on(conv, one)
            gaps = one.last - one.first + 1 - one.turns if one.turns else 0
            out.append((conv, one.place, None, None, None, None, gaps, one.blank, one.duplicate, one.truncated, one.illegal, cost))

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                for new, turn, role, text, copies, seen, blank, truncated in zip(*(c.to_pylist() for c in part.columns)):
                    if one is None or new != conv:
                        if one is not None:
                            close(conv, one)
                        conv, one = new, _Conversation()
                    if copies:
                        one.read(turn, role, text, copies, seen, blank, truncated)
                        if one.search.resolved:
                            pass_on(conv, one)
                    if len(out) >= BLOCK:
                        yield ready()
        if one is not None:
            close(conv, one)
        if out:
            yield ready()

    return ordered.select("conv", "turn", "role", "text", "copies", "seen", "blank", "truncated").mapInArrow(run, schema)


class _Conversation:
    """Faults and search of the conversation that is being read."""

    def __init__(self):
        self.search, self.place, self.before = Survivors(), 0, None
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def read(self, turn, role, text, copies, seen, blank, truncated):
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        self.illegal += copies - 1
        again = copies - 1 if not (blank or seen) else copies
        if blank:
            self.blank += copies
        else:
            self.duplicate += again
        if again < copies:
            self.truncated += truncated
            self.search.read((role, text), truncated)
        if again:
            self.search.delete(again, (role, text))


def reports(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: faults, cost, ``audit`` (the edits' initials) and
    ``repaired_sha256`` of its lines ``role:text``. Reads the edits as they come, in the same
    tasks, and holds one conversation's audit."""
    kind = edits.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *[T.StructField(c, T.LongType()) for c in _COUNTS], *T.StructType.fromDDL("audit string, repaired_sha256 string").fields])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        digest, audit, lines = hashlib.sha256(), bytearray(), 0
        for batch in batches:
            out = []
            for conv, _, edit, times, role, text, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                if edit is None:
                    out.append((conv, *counts, audit.decode(), digest.hexdigest()))
                    digest, audit, lines = hashlib.sha256(), bytearray(), 0
                    continue
                audit += edit.encode() * times
                if edit != "D":
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=schema.names)

    return edits.mapInArrow(run, schema)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports(repair(damaged(table(spark, sf_dir, "conversations"))))
    return found.withColumnRenamed("conv", "conv_id")


OP12_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), crc AS (
  SELECT *, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
    list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda d, k: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(c, b)),
    4294967295::BIGINT), 4294967295) % 20 AS kind FROM keyed
), hurt AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(generate_series(1, CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen FROM hurt
), faults AS (
  SELECT *, left(role, 1) AS c, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open,
    lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair FROM placed
), moves(s, x, t, c, ins) AS (
  VALUES (0, '', 0, 0, []), (0, 'I', 2, 3, ['user:']), (0, 'II', 3, 6, ['user:', 'assistant:']),
    (1, '', 1, 0, []), (1, 'I', 2, 3, ['user:']), (1, 'II', 3, 6, ['user:', 'assistant:']),
    (2, '', 2, 0, []), (2, 'I', 3, 3, ['assistant:']), (3, '', 3, 0, []), (3, 'I', 2, 3, ['user:'])
), ops(t, e, role, t2) AS (
  VALUES (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3), (0, 'K', 's', 1),
    (0, 'K', 'u', 2), (1, 'K', 'u', 2), (3, 'K', 'u', 2), (2, 'K', 'a', 3),
    (0, 'R', 'user', 2), (1, 'R', 'user', 2), (3, 'R', 'user', 2), (2, 'R', 'assistant', 3)
), dp AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, 0 AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM keyed
  UNION ALL
  SELECT conv, i, s, cost, audit, lines FROM (
    SELECT dp.conv, f.i, o.t2 AS s, dp.cost + m.c + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN e <> 'D' AND f.open THEN 3 ELSE 0 END AS cost,
      dp.audit || m.x || e AS audit,
      dp.lines || m.ins || CASE e WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [o.role || ':' || f.text] END AS lines,
      row_number() OVER (PARTITION BY dp.conv, o.t2 ORDER BY
        dp.cost + m.c + CASE e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN e <> 'D' AND f.open THEN 3 ELSE 0 END, dp.audit || m.x || e) AS best
    FROM dp JOIN faults f ON f.conv IS NOT DISTINCT FROM dp.conv AND f.i = dp.i + 1 JOIN moves m ON m.s = dp.s JOIN ops o ON o.t = m.t
    WHERE (e = 'D' OR NOT (f.blank OR f.seen)) AND (e <> 'K' OR o.role = f.c)
  ) WHERE best = 1
), counts AS (
  SELECT conv, max(i) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE NOT blank AND seen) AS duplicate,
    count(*) FILTER (WHERE NOT blank AND NOT seen AND open) AS truncated,
    count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv
), ends AS (
  SELECT dp.conv, dp.cost + m.c AS cost, dp.audit || m.x AS audit, dp.lines || m.ins AS lines,
    row_number() OVER (PARTITION BY dp.conv ORDER BY dp.cost + m.c, dp.audit || m.x) AS best
  FROM dp LEFT JOIN counts n ON n.conv IS NOT DISTINCT FROM dp.conv JOIN moves m ON m.s = dp.s
  WHERE dp.i = coalesce(n.rows, 0) AND m.t IN (0, 3)
)
SELECT e.conv AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.cost::BIGINT AS cost, e.audit,
  sha256(array_to_string(e.lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counts n ON n.conv IS NOT DISTINCT FROM e.conv WHERE best = 1
"""
