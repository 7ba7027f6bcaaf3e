"""Repair of dialogue structure by a generalised LR parser (operator 11).

A dialogue is a word over the roles' initials; well formed is what the grammar

    Dialogue -> (nothing) | Body
    Body     -> Pair | s Pair | Body Pair
    Pair     -> u a

derives. The parser keeps all readings of the rows so far as a graph-structured
stack: stacks share what lies below their tops, and every row may be kept,
reroled or deleted and rows may be inserted before it, each at a price. Readings with the same
stack top have the same future, so they are merged to the one of least
(cost, audit); four tops can follow a row, so the work per row is constant.

Two passes stream through the rows of a dialogue in order and hold one row at a
time. The first sees no text, only the role's initial and the fault of every row,
and gives cost and audit; the second applies the audit's edits to the rows. A
dialogue's audit is one string and its repaired rows one sequence, so a
dialogue is one task in both passes, in memory that does not grow with its
texts: first-pass rows are some 20 bytes, and the audit is one byte a row.
Repetitions are found beforehand by a partially aggregated minimum per (dialogue, role, text).

Defined cases: null roles and texts are one space (``damage``); a null turn comes
before all others; rows of one turn are in order of role and MD5 of the text,
so equal rows are neighbours; a null conv_id is a dialogue of its own; a
dialogue without rows has cost 0 and an empty audit; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import ship_package, small_or_shuffled, written

# prices of the edits
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: LR(0) automaton of the grammar: shifts, reductions (left side, length), gotos
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (6, "u"): 2, (2, "a"): 3}
REDUCE = {3: ("Pair", 2), 4: ("Body", 1), 5: ("Body", 2), 7: ("Body", 2)}
GOTO = {(0, "Pair"): 4, (1, "Pair"): 5, (6, "Pair"): 7, (0, "Body"): 6}
ACCEPT = (0, 6)
ROLES = {"u": "user", "a": "assistant"}

#: rows after which the audits' strings are cut off and ranked
SEGMENT = 512


class Stack:
    """A stack top; ``below`` is shared by all readings that came from there."""

    __slots__ = ("state", "below")

    def __init__(self, state: int, below: Stack | None = None):
        self.state, self.below = state, below

    def advanced(self, symbol: str) -> Stack | None:
        """The stack after a shift and the reductions that follow, if any."""
        state = SHIFT.get((self.state, symbol))
        if state is None:
            return None
        top = Stack(state, self)
        while top.state in REDUCE:
            left, length = REDUCE[top.state]
            for _ in range(length):
                top = top.below
            top = Stack(GOTO[top.state, left], top)
        return top


class Parser:
    """Least-cost repair of one dialogue, fed row by row.

    A reading is ``(cost, rank, tail, chain)`` : ``tail`` is the audit since the last
    segment's end, ``chain`` the segments before, ``rank`` the place of the chain
    among those of the other readings. Audits that are compared have
    consumed the same rows, so none of equal cost is the beginning of another.
    """

    def __init__(self):
        self.tops = {0: (Stack(0), (0, 0, "", None))}
        self.rows = 0

    @staticmethod
    def _offer(tops: dict, stack: Stack | None, reading: tuple) -> bool:
        """Merge a reading into the readings with its stack top."""
        if stack is None:
            return False
        held = tops.get(stack.state)
        if held is not None and held[1][:3] <= reading[:3]:
            return False
        tops[stack.state] = (stack, reading)
        return True

    def _insert(self) -> None:
        """Readings that insert rows here, until none improves a stack top."""
        todo = list(self.tops)
        while todo:
            stack, (cost, rank, tail, chain) = self.tops[todo.pop()]
            for symbol in ROLES:
                new = stack.advanced(symbol)
                if self._offer(self.tops, new, (cost + INSERT, rank, tail + "I", chain)):
                    todo.append(new.state)

    def feed(self, initial: str, must_delete: bool, truncated: bool) -> None:
        """Take the next row."""
        self._insert()
        tops: dict = {}
        extra = TRUNCATED if truncated else 0
        for stack, (cost, rank, tail, chain) in self.tops.values():
            self._offer(tops, stack, (cost + DELETE, rank, tail + "D", chain))
            if not must_delete:
                self._offer(tops, stack.advanced(initial), (cost + extra, rank, tail + "K", chain))
                for symbol in ROLES:
                    self._offer(tops, stack.advanced(symbol), (cost + extra + REROLE, rank, tail + "R", chain))
        self.tops = tops
        self.rows += 1
        if self.rows % SEGMENT == 0:
            order = sorted(self.tops, key=lambda s: self.tops[s][1][1:3])
            for place, state in enumerate(order):
                stack, (cost, _, tail, chain) = self.tops[state]
                self.tops[state] = (stack, (cost, place, "", (chain, tail)))

    def result(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        self._insert()
        cost, _, tail, chain = min((r for s, (_, r) in self.tops.items() if s in ACCEPT), key=lambda r: r[:3])
        parts = [tail]
        while chain is not None:
            chain, part = chain
            parts.append(part)
        return cost, "".join(reversed(parts))


_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_LEGAL = {"su", "ua", "au"}
_STATS = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows with their place in the dialogue and ``blank``, ``seen``, ``truncated``.

    ``seen``: the role and text occur at an earlier turn; repetitions within a
    turn are neighbours and found while streaming. Written to shared storage.
    """
    text = F.rtrim(F.col("text"), F.lit(_SPACE))
    keyed = rows.select(
        "conv_id", "turn", "role", "text", F.md5(F.col("text").cast("binary")).alias("md5"), (F.length(text) == 0).alias("blank"),
        (~F.right(text, F.lit(1)).isin(".", "!", "?")).alias("truncated"), F.substring("role", 1, 1).alias("initial"))
    keyed = written(keyed, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    several = written(keyed.groupBy("conv_id", "role", "md5").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                      .where("first != last").select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("md5").alias("_m"), "first"), "repair-repeats")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("md5") == F.col("_m"))
    seen = F.coalesce(place > F.col("first"), F.lit(False)).alias("seen")
    return keyed.join(small_or_shuffled(several), on, "left").select(*keyed.columns, seen)


def _streamed(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of a dialogue after its head row, in order, dialogues in one task each."""
    columns = [c for c in rows.columns if c not in heads.columns]
    more = [c for c in heads.columns if c not in rows.columns]
    types = {**dict(rows.dtypes), **dict(heads.dtypes)}
    heads = heads.withColumn("_head", F.lit(True)).select(
        "*", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    rows = rows.withColumn("_head", F.lit(False)).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in more])
    both = heads.unionByName(rows)
    return both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("_head").desc(), F.col("turn").asc_nulls_first(), "role", "md5")


def find_edits(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Cheapest edits of every dialogue that ``conversations`` names.

    ``rows`` comes from ``with_faults``. Returns ``conv_id``, counts of gaps, of
    each row's first fault and of illegal neighbours, ``cost`` and ``audit``.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, conv, tally, last, turns, before = None, None, [0] * 4, None, [None, None, 0], None

        def done() -> dict:
            cost, audit = parser.result()
            low, high, distinct = turns
            gaps = 0 if distinct == 0 else high - low + 1 - distinct
            return dict(zip(("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
                            (conv, gaps, *tally, cost, audit)))

        schema = pa.schema([("conv_id", pa.int64()), *_STATS, ("audit", pa.string())])
        for batch in batches:
            out = []
            for head, c, turn, role, md5, initial, blank, seen, cut in zip(*(x.to_pylist() for x in batch.columns)):
                if head:
                    if parser is not None:
                        out.append(done())
                    parser, conv, tally, last, turns, before = Parser(), c, [0] * 4, None, [None, None, 0], None
                    continue
                if turn is not None:
                    if turns[2] == 0:
                        turns[0] = turn
                    if turns[1] != turn:
                        turns[1], turns[2] = turn, turns[2] + 1
                repeated = not blank and (seen or last == (turn, role, md5))
                fault = 0 if blank else 1 if repeated else 2 if cut else None
                if fault is not None:
                    tally[fault] += 1
                if before is not None and before + initial not in _LEGAL:
                    tally[3] += 1
                parser.feed(initial, blank or repeated, fault == 2)
                last, before = (turn, role, md5), initial
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if parser is not None:
            yield pa.RecordBatch.from_pylist([done()], schema=schema)

    facts = rows.select("conv_id", "turn", "role", "md5", "initial", "blank", "seen", "truncated")
    stream = _streamed(facts, conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct())
    return stream.select("_head", "conv_id", "turn", "role", "md5", "initial", "blank", "seen", "truncated").mapInArrow(
        run, f"conv_id long, {_FOUND}")


def _edited(audit: str, at: int, role: str, text: str, position: int) -> tuple[list[tuple], int, int]:
    """Repaired rows from the edits of ``audit`` from ``at`` to the next row's, incl. insertions before it.

    Returns them with the next place in the audit and the next position. A row
    is ``(position, edit, role, text)``; a role is reroled or inserted by what is due
    after the rows so far, so ``position`` counts user and assistant rows from 0.
    """
    out = []
    while at < len(audit):
        edit, at = audit[at], at + 1
        due = ROLES["ua"[position % 2]]
        if edit == "I":
            out.append((edit, due, ""))
            position += 1
            continue
        if edit == "D":
            return out, at, position
        out.append((edit, due if edit == "R" else role, text))
        return out, at, position + (edit == "R" or role[:1] != "s")
    return out, at, position


def _apply(rows: DataFrame, edits: DataFrame, schema: str, digests: bool) -> DataFrame:
    """Repaired rows, or a digest of them per dialogue, streamed through the audits."""
    ship_package(rows.sparkSession)
    names = [f.name for f in edits.schema]
    fields = [(n, pa.string() if n == "audit" else pa.int64()) for n in names]
    extra = [("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    arrow = pa.schema([*fields, ("repaired_sha256", pa.string())] if digests else [fields[0], *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, at, position, made, sha = None, 0, 0, 0, None
        for batch in batches:
            out, held = [], 0

            def emit(found: list[tuple]) -> None:
                nonlocal made, held
                for edit, role, text in found:
                    if digests:
                        sha.update((("\n" if made else "") + f"{role}:{text}").encode())
                    else:
                        out.append({"conv_id": head["conv_id"], "position": made, "edit": edit, "role": role, "text": text})
                        held += len(text)
                    made += 1

            def finish() -> None:
                emit(_edited(head["audit"], at, "", "", position)[0])
                if digests:
                    out.append({**head, "repaired_sha256": sha.hexdigest()})

            cols = [x.to_pylist() for x in batch.columns]
            for is_head, role, text, *stats in zip(*cols):
                if is_head:
                    if head is not None:
                        finish()
                    head, at, position, made, sha = dict(zip(names, stats)), 0, 0, 0, hashlib.sha256()
                    continue
                found, at, position = _edited(head["audit"], at, role, text, position)
                emit(found)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if head is not None:
            out = []
            finish()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    stream = _streamed(rows.select("conv_id", "turn", "role", "md5", "text"), edits)
    return stream.select("_head", "role", "text", *names).mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired dialogues: ``conv_id, position, edit, role, text``."""
    return _apply(rows, edits, "conv_id long, position long, edit string, role string, text string", False)


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``edits`` with SHA-256 of the repaired rows, ``role:text`` joined by line ends."""
    return _apply(rows, edits, f"conv_id long, {_FOUND}, repaired_sha256 string", True)


def damage(conversations: DataFrame) -> DataFrame:
    """Deterministic damage by CRC-32 of ``conv_id:turn``: of 20 values, 0 drops the row, 1 empties
    its text, 2 removes ``.!?``, 3 repeats the row, 4 makes its role user."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    h = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1]).cast("binary")) % 20
    return conversations.where(h != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(h == 4, F.lit("user")).otherwise(spaced[2]).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.translate(spaced[3], ".!?", "")).otherwise(spaced[3]).alias("text"),
        F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = with_faults(damage(conversations))
    return repaired_digests(rows, find_edits(rows, conversations))


#: dynamic programming over (rows taken, what the reading ends in): e nothing yet, s, u, a
SQL_OP11 = r"""
WITH RECURSIVE
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hashed AS (SELECT *, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i::INT, 1))),
    lambda c, b: list_reduce(range(8), lambda v, j: xor(v >> 1, (v & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295) % 20 AS h FROM src),
rows_ AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE h <> 0),
placed AS (SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS t, left(role, 1) AS ini FROM rows_
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy)),
r AS (SELECT *, CASE WHEN t = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
    lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM placed),
moves(q, x, z) AS (VALUES ('e', 's', 's'), ('e', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
ins AS (SELECT DISTINCT q, q AS z, 0 AS cost, '' AS audit, []::VARCHAR[] AS made FROM (SELECT q FROM moves UNION SELECT z FROM moves)
    UNION ALL SELECT q, z, 5, 'I', [CASE x WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM moves WHERE x <> 's'
    UNION ALL SELECT m.q, n.z, 10, 'II', [CASE m.x WHEN 'u' THEN 'user:' ELSE 'assistant:' END, CASE n.x WHEN 'u' THEN 'user:' ELSE 'assistant:' END]
      FROM moves m JOIN moves n ON m.z = n.q WHERE m.x <> 's' AND n.x <> 's'),
acts AS (
    SELECT r.conv_id, r.i, q.q, q.q AS z, 2 AS cost, 'D' AS audit, []::VARCHAR[] AS made FROM r, (SELECT DISTINCT z AS q FROM ins) q
    UNION ALL SELECT r.conv_id, r.i, m.q, m.z, CASE fault WHEN 't' THEN 5 ELSE 0 END, 'K', [role || ':' || text] FROM r JOIN moves m ON m.x = r.ini WHERE fault IN ('-', 't')
    UNION ALL SELECT r.conv_id, r.i, m.q, m.z, CASE fault WHEN 't' THEN 6 ELSE 1 END, 'R', [CASE m.x WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text]
      FROM r JOIN moves m ON m.x <> 's' WHERE fault IN ('-', 't')),
dp AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 'e' AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS made FROM conversations
    UNION ALL
    SELECT conv_id, i, q, best.cost, best.audit, best.made FROM (
      SELECT d.conv_id, a.i, a.z AS q, min({cost: d.cost + n.cost + a.cost, audit: d.audit || n.audit || a.audit, made: d.made || n.made || a.made}) AS best
      FROM dp d JOIN ins n ON n.q = d.q JOIN acts a ON a.conv_id IS NOT DISTINCT FROM d.conv_id AND a.i = d.i + 1 AND a.q = n.z
      GROUP BY d.conv_id, a.i, a.z)),
stats AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
fin AS (SELECT d.conv_id, min({cost: d.cost + n.cost, audit: d.audit || n.audit, made: d.made || n.made}) AS best
    FROM dp d JOIN ins n ON n.q = d.q LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM d.conv_id
    WHERE d.i = coalesce(s.n, 0) AND n.z IN ('e', 'a') GROUP BY d.conv_id)
SELECT f.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best.cost::BIGINT AS cost, best.audit AS audit, sha256(array_to_string(best.made, chr(10))) AS repaired_sha256
FROM fin f LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM f.conv_id
"""
