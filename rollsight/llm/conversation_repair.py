"""Repair of conversation structure by a Viterbi search whose survivors coalesce.

A conversation should read `(s?(ua)+)?` in the initials of its roles: an optional system turn, then
pairs of user and assistant. Rows are kept, given another role or deleted, and empty turns are
inserted, at least cost; among the cheapest edits the ASCII-least sequence of letters wins.

Rows stream through a task in their order. For each of the four states that a prefix can be in, one
survivor is held: a leaf of a tree of edits with one node per row and back pointers to the row
before. A node that nothing refers to any more is dropped. As soon as all survivors descend from one
node, the edits down to it are final and leave the task, so memory holds only the rows whose edits
are still open. Ties compare the complete open edits: these end with an edit of the same row, so
none is a beginning of another, and the order of the survivors' sequences is carried along from row
to row instead of being read anew.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\v\f\r"
SENTENCE_ENDS = ".!?"
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
FAULTS = ("blank", "duplicate", "truncated")
FOLLOWING = {"su", "ua", "au"}

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# How a row gets into a state: from which states, after which insertions.
ENTRIES = {
    SYSTEM: ((NOTHING, ()),),
    USER: ((NOTHING, ()), (SYSTEM, ()), (ASSISTANT, ()), (USER, (ASSISTANT,))),
    ASSISTANT: ((USER, ()), (NOTHING, (USER,)), (SYSTEM, (USER,)), (ASSISTANT, (USER,))),
}
# Insertions that complete a conversation.
ENDS = {NOTHING: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}

# Kinds of records in the stream: copies among the equal rows of a turn, the rows, dropped rows.
COPIES, ROW, DROPPED = range(3)
# Rows of one turn stand by role, then by this many first code points of the text, then by digest.
HEAD_UNITS = 64


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with planted faults, chosen by crc32(`conv_id:turn`) % 20.

    0 drops a row (column `dropped`, so that its conversation stays known), 1 empties its text, 2
    takes out its sentence ends, 3 repeats it, 4 makes it the user's. Null values count as one
    space, also in the number's text; null ids and turns stay null.
    """
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    number = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    hurt = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), number.alias("number"))
    return hurt.select(
        "conv_id", "turn",
        F.when(F.col("number") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("number") == 1, "").when(F.col("number") == 2, F.translate("text", SENTENCE_ENDS, ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("number") == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("number") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Records of every conversation in one partition, by turn (nulls first), ready to stream.

    The text moves once. Which rows repeat an earlier one follows from counts per (conversation,
    turn, digest), combined before they move; where there are copies, a record before the equal rows
    of a turn tells how many of them are the first of their kind (one or none).
    """
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    base = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), dropped.alias("dropped"))
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    live = base.where(~F.col("dropped")).select(
        "conv_id", "turn", "role", F.substring("text", 1, HEAD_UNITS).alias("head"), same.alias("same"), "text"
    )
    counts = live.groupBy("conv_id", "turn", "role", "head", "same").agg(F.count("*").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    groups = counts.groupBy(F.col("conv_id").alias("of"), F.col("same").alias("alike")).agg(
        F.min(order).alias("first"), F.sum("n").alias("total")
    ).where(F.col("total") > 1)
    met = counts.join(groups, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("alike")))
    fresh = F.col("turn").eqNullSafe(F.col("first.turn")).cast("long")
    none = F.lit(None)
    records = (
        met.where(F.col("n") > fresh).select(
            "conv_id", "turn", "role", "head", "same", F.lit(COPIES).alias("kind"), fresh.alias("fresh"),
            none.cast("string").alias("text"),
        )
        .unionByName(live.withColumns({"kind": F.lit(ROW), "fresh": none.cast("long")}))
        .unionByName(base.where("dropped").select("conv_id", F.lit(DROPPED).alias("kind")).distinct(), allowMissingColumns=True)
    )
    return records.repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "head", "same", "kind"
    ).drop("head")


class Node:
    """The edits of one row on one path: insertions before it, then its own letter and role."""

    __slots__ = ("parent", "children", "insertions", "letter", "role", "row")

    def __init__(self, parent, insertions=(), letter="", role=None, row=None):
        self.parent, self.children, self.row = parent, [], row
        self.insertions, self.letter, self.role = insertions, letter, role

    def edits(self) -> Iterator[tuple]:
        """(letter, turn, fault, role, text)."""
        for state in self.insertions:
            yield "I", None, None, ROLES[state], ""
        if self.letter:
            turn, role, text, fault = self.row
            yield self.letter, turn, fault, self.role or role, text


class Search:
    """Survivors of one conversation; `push` and `finish` yield the edits that became final."""

    def __init__(self):
        self.base = Node(None)
        # State: (cost, place of its edits in the order of all survivors' edits, leaf).
        self.survivors = {NOTHING: (0, 0, self.base)}
        self.cost = 0

    def push(self, row: tuple) -> Iterator[tuple]:
        turn, role, text, fault = row
        best: dict[int, tuple] = {}

        def offer(into, source, price, insertions, letter, new_role):
            cost, place, leaf = self.survivors[source]
            made = (cost + price + INSERT * len(insertions), place, "I" * len(insertions) + letter, leaf, insertions, new_role)
            if into not in best or made[:3] < best[into][:3]:
                best[into] = made

        own = INITIALS.get(role[:1])
        for state in self.survivors:
            offer(state, state, DELETE, (), "D", None)
        if fault not in ("blank", "duplicate"):
            extra = UNFINISHED if fault == "truncated" else 0
            for target, entries in ENTRIES.items():
                if target != own and target == SYSTEM:
                    continue
                price, letter, new_role = (extra, "K", None) if target == own else (extra + REROLE, "R", ROLES[target])
                for source, insertions in entries:
                    if source in self.survivors:
                        offer(target, source, price, insertions, letter, new_role)
        places = {}
        for place, state in enumerate(sorted(best, key=lambda state: best[state][1:3])):
            places[state] = place
        grown = {}
        for state in _undominated({state: (made[0], places[state]) for state, made in best.items()}):
            cost, _, letters, leaf, insertions, new_role = best[state]
            node = Node(leaf, insertions, letters[-1], new_role, row)
            leaf.children.append(node)
            grown[state] = cost, places[state], node
        held, self.survivors = self.survivors, grown
        for _, _, leaf in held.values():
            self._drop(leaf)
        yield from self._final()

    def _drop(self, node: Node) -> None:
        """Take a path that no survivor ends in out of the tree."""
        while not node.children and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            node.parent, node = None, parent

    def _final(self) -> Iterator[tuple]:
        """Edits above the survivors' last common node; the node itself becomes the new base."""
        while len(self.base.children) == 1:
            yield from self.base.edits()
            self.base = self.base.children[0]
            self.base.parent = None

    def finish(self) -> Iterator[tuple]:
        ends = [
            (cost + INSERT * len(ENDS[state]), place, state, leaf)
            for state, (cost, place, leaf) in self.survivors.items()
        ]
        self.cost, _, state, leaf = min(ends, key=lambda end: end[:2])
        path = [leaf]
        while path[-1].parent is not None:
            path.append(path[-1].parent)
        for node in reversed(path):
            yield from node.edits()
        yield from Node(None, ENDS[state]).edits()


def _undominated(found: dict[int, tuple[int, int]]) -> list[int]:
    """States some cheapest repair may still pass; found: (cost, place) per state.

    An insertion leads from user to assistant and back. What can follow nothing at all can follow an
    assistant if a system row is deleted, and what can follow a system row can follow an assistant.
    """
    far = (1 << 62, 0)
    nothing, system, user, assistant = (found.get(state, far) for state in range(4))
    paired = min(assistant[0], user[0] + INSERT)
    keep = []
    for state, (cost, _) in found.items():
        if state == NOTHING:
            beaten = paired + DELETE < cost
        elif state == SYSTEM:
            beaten = paired < cost or assistant < system
        elif state == USER:
            beaten = assistant[0] + INSERT < cost
        else:
            beaten = user[0] + INSERT < cost
        if not beaten:
            keep.append(state)
    return keep


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    names = ("conv_id", "kind", "turn", "role", "text", "same", "fresh")
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names))


def _conversations(records: Iterable[tuple]) -> Iterator[tuple]:
    """(conv_id, its rows (turn, role, text, fault)); rows are read to their end before the next one."""
    records = iter(records)
    held = next(records, None)
    while held is not None:
        conv_id, start, held = held[0], held, None

        def rows():
            nonlocal held
            equal, fresh, record = None, 0, start
            while record is not None:
                if record[0] != conv_id:
                    held = record
                    return
                _, kind, turn, role, text, same, first = record
                if kind == COPIES:
                    equal, fresh = (turn, same), first
                elif kind == ROW:
                    copy = equal == (turn, same) and fresh == 0
                    fresh = max(fresh - 1, 0) if equal == (turn, same) else fresh
                    core = text.strip(BLANKS)
                    if not core:
                        fault = "blank"
                    elif copy:
                        fault = "duplicate"
                    else:
                        fault = None if core[-1] in SENTENCE_ENDS else "truncated"
                    yield turn, role, text, fault
                record = next(records, None)

        stream = rows()
        yield conv_id, stream
        for _ in stream:
            pass


def _edits(rows: Iterable[tuple], search: Search) -> Iterator[tuple]:
    for row in rows:
        yield from search.push(row)
    yield from search.finish()


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held = []

    def batch():
        columns = list(zip(*held)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, schema.types)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


def _streamed(rows: DataFrame, fields: str, function) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)])
    for field in fields.split(", "):
        schema.add(*field.split(" "))
    arrow = to_arrow_schema(schema)
    return in_order(rows).mapInArrow(lambda batches: _batches(function(_records(batches)), arrow), schema)


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, place, edit, turn, fault, role, text: the edits of every conversation, in order.

    rows: conv_id, turn (whole numbers), role, text and perhaps `dropped` (true: the row is gone
    but its conversation stays). edit is K, R, D or I; role and text are those after the edit, of a
    deleted row its own; an inserted one has no turn and an empty text. fault is the row's first of
    blank, duplicate, truncated, or null. Null roles and texts count as one space; rows of one turn
    stand by role, first 64 code points of the text and digest; rows of a null conv_id are one
    conversation; repeated rows are duplicates; other columns are ignored; an empty table gives none.
    A conversation whose cheapest parses stay apart from its first row to its last is held whole.
    """

    def edits(records):
        for conv_id, turns in _conversations(records):
            for place, (letter, turn, fault, role, text) in enumerate(_edits(turns, Search())):
                yield conv_id, place, letter, turn, fault, role, text

    return _streamed(rows, "place long, edit string, turn long, fault string, role string, text string", edits)


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation, also for those all of whose rows are dropped.

    gaps (missing turns between the least and the greatest), blank, duplicate, truncated (rows by
    first fault), illegal (neighbouring roles that cannot follow each other), cost, audit (letters of
    the edits) and repaired_sha256 (of the repaired `role:text` lines). Edge cases as in `repaired`.
    """

    def folded(records):
        for conv_id, turns in _conversations(records):
            yield _summary(conv_id, turns)

    counts = ", ".join(f"{name} long" for name in ("gaps", *FAULTS, "illegal", "cost"))
    return _streamed(rows, f"{counts}, audit string, repaired_sha256 string", folded)


def _summary(conv_id, turns) -> tuple:
    faults, search, digest, audit = Counter(), Search(), hashlib.sha256(), bytearray()
    least = last = before = None
    distinct = illegal = 0

    def watched():
        nonlocal least, last, before, distinct, illegal
        for turn, role, text, fault in turns:
            if turn is not None and turn != last:
                least, last, distinct = turn if least is None else least, turn, distinct + 1
            faults[fault] += 1
            illegal += before is not None and before + role[:1] not in FOLLOWING
            before = role[:1]
            yield turn, role, text, fault

    started = False
    for letter, _, _, role, text in _edits(watched(), search):
        audit += letter.encode()
        if letter != "D":
            digest.update(f"{chr(10) * started}{role}:{text}".encode("utf-8", "replace"))
            started = True
    gaps = last - least + 1 - distinct if distinct else 0
    return (
        conv_id, gaps, *(faults[name] for name in FAULTS), illegal, search.cost, audit.decode(), digest.hexdigest()
    )


# The check walks all conversations at once, row by row; each state holds (cost, audit, text).
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))"""


def _sql_edit(state: str, price: str, letter: str, line: str | None) -> str:
    text = f"{state}.o" if line is None else f"{state}.o || CASE WHEN {state}.o = '' THEN '' ELSE chr(10) END || {line}"
    return f"{{'c': {state}.c + {price}, 'e': {state}.e || '{letter}', 'o': {text}}}"


def _sql_insert(state: str, role: str) -> str:
    return _sql_edit(state, "3", "I", f"'{role}:'")


def _sql_row(state: str, initial: str, role: str) -> str:
    kept = _sql_edit(state, "late", "K", "role || ':' || text")
    if not role:
        return f"CASE WHEN free AND initial = '{initial}' THEN {kept} ELSE never END"
    moved = _sql_edit(state, "late + 3", "R", f"'{role}:' || text")
    return f"CASE WHEN NOT free THEN never WHEN initial = '{initial}' THEN {kept} ELSE {moved} END"


CHECK = f"""
WITH RECURSIVE tab AS (SELECT {_CRC_TABLE} AS tab),
numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
           || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda h: CAST('0x' || h AS BIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS number
  FROM conversations, tab
), alive AS (
  SELECT conv_id, turn, CASE number WHEN 4 THEN 'user' ELSE role END AS role,
         CASE number WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE number WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM numbered
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64),
      sha256(length(role) || ':' || role || text)) AS i
  FROM alive
), copied AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM placed
), faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
      WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
      ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM copied
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), ids AS (SELECT DISTINCT conv_id FROM conversations),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'e': '', 'o': ''}} AS z, {{'c': 1000000000::BIGINT, 'e': '', 'o': ''}} AS s,
         {{'c': 1000000000::BIGINT, 'e': '', 'o': ''}} AS u, {{'c': 1000000000::BIGINT, 'e': '', 'o': ''}} AS a
  FROM ids
  UNION ALL
  SELECT conv_id, i,
    {_sql_edit("z", "4", "D", None)},
    least({_sql_edit("s", "4", "D", None)}, {_sql_row("z", "s", "")}),
    least({_sql_edit("u", "4", "D", None)}, {_sql_row("z", "u", "user")}, {_sql_row("s", "u", "user")},
          {_sql_row("a2", "u", "user")}),
    least({_sql_edit("a", "4", "D", None)}, {_sql_row("u2", "a", "assistant")})
  FROM (
    SELECT f.conv_id, f.i, f.role, f.text, f.initial, f.fault NOT IN ('blank', 'duplicate') AS free,
      CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS late, w.z, w.s, w.u, w.a,
      {{'c': 1000000000::BIGINT, 'e': '', 'o': ''}} AS never,
      least(w.u, {_sql_insert("w.z", "user")}, {_sql_insert("w.s", "user")}, {_sql_insert("w.a", "user")}) AS u2,
      least(w.a, {_sql_insert("w.u", "assistant")}) AS a2
    FROM walk w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
  )
), ended AS (
  SELECT w.conv_id, least(z, a, {_sql_insert("u", "assistant")}, {_sql_insert("w2", "assistant")}) AS best
  FROM (SELECT *, {_sql_insert("s", "user")} AS w2 FROM walk) w
  LEFT JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = coalesce(c.n, 0)
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit,
  sha256(best.o) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
