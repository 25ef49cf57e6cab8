"""Conversation structure repair by run-length dynamic programming.

A conversation should be an optional system message and then pairs of user and
assistant messages. Its messages become symbols, of the role's initial and the
first fault found; equal consecutive symbols are one run. The cheapest edits
are found by a min-plus product over the four states that what was written so
far can be in. A run of any length takes as many products as its length has
binary digits, with powers that are kept per symbol. From the costs that remain
at the ends of runs the choices are then unrolled, message by message; of
equally cheap ones the least letter is taken, which gives the least audit.

Symbols are made in ranges of (conversation, turn), so that a conversation with
a large part of all messages is worked on by many tasks; of each range only its
runs, about two bytes a message, go on to where the conversation is put
together, which is no more than the audit that comes out. Texts go once, in
order, through the task that writes their conversation; none is held.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
_LEGAL = {"su", "ua", "au"}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: A message that has to go; the others are 2 * role + truncated.
GONE = 8
_ROLES = "sua"
_UNROLLED = 1024
_ROWS_OUT = 1000

# States of what is written: nothing, a system message, ends with user, with assistant.
_USER, _ASSISTANT = 2, 3
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NEVER = 1 << 60

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


# Costs


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


def _times(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


def _insertions() -> Matrix:
    """Costs from state to state by added messages alone, two at the most."""
    once = [[0 if i == j else _NEVER for j in range(4)] for i in range(4)]
    for i in range(4):
        once[i][_NEXT[i]] = INSERT
    return _product(once, once)


_INSERTED = _insertions()


def _kept(state: int, role: int) -> int | None:
    """The state after a message that keeps its role, if that may stand there."""
    if role == 0:
        return 1 if state == 0 else None
    return _NEXT[state] if _NEXT[state] == role + 1 else None


@cache
def power(symbol: int, exponent: int) -> Matrix:
    """Costs from state to state over 2 ** exponent messages of one symbol."""
    if exponent:
        return _product(half := power(symbol, exponent - 1), half)
    edits = [[DELETE if i == j else _NEVER for j in range(4)] for i in range(4)]
    if symbol != GONE:
        role, truncated = symbol >> 1, TRUNCATED * (symbol & 1)
        for i in range(4):
            edits[i][_NEXT[i]] = min(edits[i][_NEXT[i]], REROLE + truncated)
            if (to := _kept(i, role)) is not None:
                edits[i][to] = min(edits[i][to], truncated)
    return _product(_INSERTED, edits)


def _before(symbol: int, length: int, after: Vector) -> Vector:
    """Costs that remain before a run, by those that remain after it."""
    exponent = 0
    while length:
        if length & 1:
            after = _times(power(symbol, exponent), after)
        length, exponent = length >> 1, exponent + 1
    return after


_END = _times(_INSERTED, (0, _NEVER, _NEVER, 0))


def _choices(symbol: int, state: int, here: Vector, after: Vector) -> tuple[str, int]:
    """The least letters that deal with one message, and the state after it."""
    letters = ""
    truncated = TRUNCATED * (symbol & 1)
    while True:
        remains = here[state]
        if DELETE + after[state] == remains:
            return letters + "D", state
        if INSERT + here[_NEXT[state]] == remains:
            letters, state = letters + "I", _NEXT[state]
            continue
        to = _kept(state, symbol >> 1)
        if to is not None and truncated + after[to] == remains:
            return letters + "K", to
        return letters + "R", _NEXT[state]


def audit(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and letters of the cheapest edits of runs ``symbol, length``."""
    remaining = [_END]
    for symbol, length in reversed(runs):
        remaining.append(_before(symbol, length, remaining[-1]))
    cost, state, letters = remaining[-1][0], 0, []
    for symbol, length in runs:
        remaining.pop()
        # Long runs are unrolled in parts, each from the costs that remain after it.
        while length:
            part = min(length, _UNROLLED)
            length -= part
            costs = [_before(symbol, length, remaining[-1])]
            for _ in range(part):
                costs.append(_times(power(symbol, 0), costs[-1]))
            for i in range(part, 0, -1):
                some, state = _choices(symbol, state, costs[i], costs[i - 1])
                letters.append(some)
    while _END[state]:
        letters.append("I")
        state = _NEXT[state]
    return cost, "".join(letters)


# Messages to symbols


def messages(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: a null role or text is one blank."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(1).alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Messages of which one in twenty each is dropped (no copies), emptied,
    without its stops, repeated, or the user's, by a checksum of their place."""
    rows = messages(conversations)
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *place)) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def _same() -> Column:
    """One value for role and text together."""
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit(":"), F.col("text"))
    return F.md5(whole).alias("same")


def _order(kind: str | None = None) -> list[Column]:
    own = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "same")]
    return own if kind is None else [own[0], F.col(kind), *own[1:]]


def marked(rows: DataFrame) -> DataFrame:
    """Messages without their text, with what is wrong with each by itself and
    whether another turn before it says the same."""
    bare = F.rtrim(F.col("text"), F.lit(_BLANKS))
    found = checkpointed(
        rows.select(
            "conv_id", "turn", "role", _same(), "copies", (bare == "").alias("blank"),
            (~F.substring(bare, -1, 1).isin(*_ENDS)).alias("truncated"),
        )
    )
    turn = F.struct(F.col("turn").isNotNull().alias("dated"), F.col("turn").alias("turn"))
    said = (
        found.where("copies > 0 and not blank")
        .groupBy(F.col("conv_id").alias("conv"), F.col("same").alias("said"))
        .agg(F.count("*").alias("n"), F.min(turn).alias("first"))
        .where("n > 1").select("conv", "said", "first")
    )
    both = found.join(said, found.conv_id.eqNullSafe(said.conv) & (found.same == said.said), "left")
    later = F.coalesce(turn > F.col("first"), F.lit(False)).alias("later")
    return both.select(*found.columns, later)


def _packed(runs: list[list[int]]) -> bytes:
    """Runs as bytes: the symbol, then the length, seven bits at a time."""
    out = bytearray()
    for symbol, length in runs:
        out.append(symbol)
        while length > 127:
            out.append(length & 127 | 128)
            length >>= 7
        out.append(length)
    return bytes(out)


def _unpacked(packed: bytes, runs: list[tuple[int, int]]) -> None:
    at = 0
    while at < len(packed):
        symbol, length, shift = packed[at], 0, 0
        while True:
            at += 1
            length |= (packed[at] & 127) << shift
            shift += 7
            if packed[at] < 128:
                break
        at += 1
        if runs and runs[-1][0] == symbol:
            runs[-1] = symbol, runs[-1][1] + length
        else:
            runs.append((symbol, length))


_SEGMENT = (
    "conv_id long, part int, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, first_turn long, last_turn long, turns long, runs binary"
)
_AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string"
)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS_OUT:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class _Segment:
    """The messages of one conversation in one range, counted."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.first_turn = self.last_turn = None
        self.before: tuple | None = None
        self.runs: list[list[int]] = []

    def add(self, turn, role: str, same: str, copies: int, blank: bool, truncated: bool, later: bool) -> None:
        for _ in range(copies):
            # Equal messages of one turn stand side by side.
            again = later or self.before == (turn, same)
            self.before = (turn, same)
            if blank or again:
                symbol = GONE
                self.blank += blank
                self.duplicate += not blank
            else:
                place = _ROLES.find(role[:1]) if role else -1
                symbol = 2 * (place if place >= 0 else 3) + truncated
                self.truncated += truncated
            if self.runs and self.runs[-1][0] == symbol:
                self.runs[-1][1] += 1
            else:
                self.runs.append([symbol, 1])
            initial = role[:1]
            if self.first is None:
                self.first = initial
            else:
                self.illegal += self.last + initial not in _LEGAL
            self.last = initial
            if turn is not None:
                if self.first_turn is None:
                    self.first_turn = turn
                self.turns += turn != self.last_turn
                self.last_turn = turn

    def row(self, part: int) -> tuple:
        return (
            self.conv_id, part, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last,
            self.first_turn, self.last_turn, self.turns, _packed(self.runs),
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()

    def rows() -> Iterator[tuple]:
        now = None
        for conv_id, *message in _rows(batches):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now.row(part)
                now = _Segment(conv_id)
            now.add(*message)
        if now is not None:
            yield now.row(part)

    yield from _batches(rows(), _arrow(_SEGMENT))


def _audited(segments: list[dict]) -> tuple:
    """Counts and audit of a conversation from its segments in order."""
    total = {c: sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
    held = [s for s in segments if s["first"] is not None]
    for a, b in zip(held, held[1:]):
        total["illegal"] += a["last"] + b["first"] not in _LEGAL
    dated = [s for s in held if s["first_turn"] is not None]
    for a, b in zip(dated, dated[1:]):
        total["turns"] -= a["last_turn"] == b["first_turn"]
    gaps = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - total["turns"] if dated else 0
    runs: list[tuple[int, int]] = []
    for s in held:
        _unpacked(s["runs"], runs)
    cost, letters = audit(runs)
    counts = [total[c] for c in ("blank", "duplicate", "truncated", "illegal")]
    return segments[0]["conv_id"], gaps, *counts, cost, letters


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = _names(_SEGMENT)

    def rows() -> Iterator[tuple]:
        held: list[dict] = []
        for row in _rows(batches):
            segment = dict(zip(names, row))
            if held and held[0]["conv_id"] != segment["conv_id"]:
                yield _audited(held)
                held = []
            held.append(segment)
        if held:
            yield _audited(held)

    yield from _batches(rows(), _arrow(_AUDIT))


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of
    every conversation among messages with their ``copies``."""
    found = marked(rows).select("conv_id", "turn", "role", "same", "copies", "blank", "truncated", "later")
    in_order = found.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    segments = in_order.mapInArrow(_segments, _SEGMENT)
    whole = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return to_python(whole).mapInArrow(_put_together, _AUDIT)


# Repaired conversations

_REPAIRED = "conv_id long, place long, edit string, role string, text string"


class _Writer:
    """What the letters of an audit make of the messages as they come."""

    def __init__(self, conv_id: int | None, letters: str):
        self.conv_id, self.letters = conv_id, letters
        self.at = self.place = self.state = 0

    def _row(self, edit: str, role: str, text: str) -> tuple:
        self.place += 1
        return self.conv_id, self.place - 1, edit, role, text

    def _named(self) -> str:
        self.state = _NEXT[self.state]
        return "user" if self.state == _USER else "assistant"

    def added(self) -> Iterator[tuple]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._row("I", self._named(), "")

    def message(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.added()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = 1 if role[0] == "s" else _NEXT[self.state]
            yield self._row("K", role, text)
        elif letter == "R":
            yield self._row("R", self._named(), text)


def _written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        writer = None
        for conv_id, letters, role, text, copies in _rows(batches):
            if letters is not None:  # stands before the messages of its conversation
                if writer is not None:
                    yield from writer.added()
                writer = _Writer(conv_id, letters)
                continue
            for _ in range(copies):
                yield from writer.message(role, text)
        if writer is not None:
            yield from writer.added()

    yield from _batches(rows(), _arrow(_REPAIRED))


def repaired(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text`` of what the audits make of the
    messages; a partition holds whole conversations, one after the other, in order."""
    none = lambda kind: F.lit(None).cast(kind)
    heads = audited.select(
        "conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"),
        none("string").alias("same"), "audit", none("string").alias("text"), F.lit(0).alias("copies"),
    )
    bodies = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", _same(), none("string").alias("audit"), "text", "copies"
    )
    both = heads.union(bodies).repartition("conv_id").sortWithinPartitions(*_order("kind"))
    return to_python(both.select("conv_id", "audit", "role", "text", "copies")).mapInArrow(_written, _REPAIRED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now, digest = None, None
        for conv_id, place, _, role, text in _rows(batches):
            if not place:
                if digest:
                    yield now, digest.hexdigest()
                now, digest = conv_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if digest:
            yield now, digest.hexdigest()

    yield from _batches(rows(), _arrow("written long, repaired_sha256 string"))


def digests(audited: DataFrame, written: DataFrame) -> DataFrame:
    """The audits with the checksum of each repaired conversation's lines."""
    hashes = to_python(written).mapInArrow(_hashed, "written long, repaired_sha256 string")
    found = audited.join(hashes, audited.conv_id.eqNullSafe(hashes.written), "left")
    empty = hashlib.sha256().hexdigest()
    return found.select(*audited.columns, F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def repairs(rows: DataFrame) -> DataFrame:
    """Audits and checksums of every conversation among the messages.

    Messages are taken by turn, null turns first; those of one turn by role,
    then by a checksum of role and text. A null conversation id is a
    conversation of its own; conversations of which nothing is left have no
    edits. An empty table gives no rows; other columns are ignored.
    """
    audited = checkpointed(audits(rows))
    return digests(audited, repaired(rows, audited))


def _edited(state: str, cost: str, letter: str) -> str:
    """SQL for a state's text, nine digits of cost and the letters so far, after an edit."""
    return f"lpad((substr({state}, 1, 9)::int + {cost})::varchar, 9, '0') || substr({state}, 10) || '{letter}'"


def _step_sql() -> str:
    """SQL for the states after one message, from ``r0`` to ``r3`` before it."""
    paid = "case when truncated then 5 else 0 end"
    gone = [_edited(f"r{i}", "2", "D") for i in range(4)]

    def put(state: str, initial: str) -> str:
        return (
            f"case when gone then null when initial = '{initial}' then {_edited(state, paid, 'K')} "
            f"else {_edited(state, f'1 + {paid}', 'R')} end"
        )

    system = f"case when not gone and initial = 's' then {_edited('r0', paid, 'K')} end"
    user = ", ".join(put(f"r{i}", "u") for i in (0, 1, 3))
    return f"""{gone[0]} as s0, least({gone[1]}, {system}) as s1,
       least({gone[2]}, {user}) as s2, least({gone[3]}, {put("r2", "a")}) as s3"""


def _added_sql(source: str) -> str:
    """SQL for the states once messages may have been added."""
    added = ", ".join(_edited(f"s{i}", "5", "I") for i in (0, 1, 3))
    return f"""(select *, s0 as r0, s1 as r1, least(s3, {_edited("r2", "5", "I")}) as r3
       from (select *, least(s2, {added}) as r2 from {source}))"""


#: The damaged conversations' repairs, with the states of all conversations
#: carried on message by message as text that sorts by cost, then letters.
REPAIRS_SQL = rf"""
with recursive sent as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(
             string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
             lambda x: ord(x)::bigint)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                    lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) % 20 as fault
  from conversations),
damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case fault when 0 then [] when 3 then [1, 2] else [1] end) as copy
  from sent),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role,
                                 md5(length(role)::varchar || ':' || role || ':' || text)) as i,
         not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, substr(role, 1, 1) as initial
  from damaged),
told as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
         not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open,
         lag(initial) over (partition by conv_id order by i) || initial as pair
  from placed),
marked as (select *, blank or duplicate as gone, not blank and not duplicate and open as truncated from told),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
         count(*) filter (where truncated) as truncated,
         count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id),
states as (
  select distinct conv_id, 0::bigint as i, '000000000' as s0, null::varchar as s1, null::varchar as s2,
         null::varchar as s3
  from conversations
  union all
  select conv_id, i + 1, {_step_sql()}
  from (select r.*, m.initial, m.gone, m.truncated
        from {_added_sql("states")} r
        join marked m on m.conv_id is not distinct from r.conv_id and m.i = r.i + 1)),
final as (
  select conv_id, least(r0, r3) as best
  from {_added_sql("(select * from states qualify i = max(i) over (partition by conv_id))")}),
audits as (select conv_id, substr(best, 1, 9)::bigint as cost, substr(best, 10) as audit from final),
letters as (
  select conv_id, p, substr(audit, p, 1) as letter,
         length(regexp_replace(substr(audit, 1, p), 'I', '', 'g')) as i,
         length(regexp_replace(substr(audit, 1, p - 1), 'D', '', 'g')) as written
  from (select *, unnest(range(1, length(audit) + 1)) as p from audits)),
edits as (
  select l.*, m.role, m.text, letter = 'K' and written = 0 and m.initial = 's' as system
  from letters l left join marked m on m.conv_id is not distinct from l.conv_id and m.i = l.i
  where letter <> 'D'),
shifted as (select *, written - max(system::int) over (partition by conv_id) as turn_of from edits),
lines as (
  select conv_id, string_agg(
           case when letter = 'K' then role when turn_of % 2 = 0 then 'user' else 'assistant' end || ':'
             || case when letter = 'I' then '' else text end, chr(10) order by p) as whole
  from shifted group by conv_id)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, cost, audit, sha256(coalesce(whole, '')) as repaired_sha256
from audits a
left join counted c on c.conv_id is not distinct from a.conv_id
left join lines l on l.conv_id is not distinct from a.conv_id"""
