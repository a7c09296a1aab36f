"""Repair of the structure of conversations by cheapest edits.

A conversation is right when the initials of its roles are `(s?(ua)+)?`. Keep costs 0,
Rerole to user or assistant 1, Delete 2, which blank and repeated rows require, Insert of an
empty user or assistant text 5, and a truncated row that is not deleted 5 more. Of the
cheapest edits those count whose initials, written in order, come first in ASCII.

The edits are a path through a graph of four states (nothing yet, system, user, assistant)
between the rows. A row has a slot of three letters: inserts before it, then what is done
to it; more than two inserts in a row are never cheapest. Slots have a fixed width with
zeros at their end, and no slot of a row begins another one, so numbers compare like the
initials. The weight of an edge is one integer, its cost in the high digits and its slot at
the place of its row below them, and the least sum decides cost and initials at once.

Rows are dealt to tasks by ranges of (conversation, turn, content), which splits long
conversations as well as tables of many short ones. A task solves the conversations that
lie within it; of those that reach over its ends, and of long ones, it gives blocks: for
each pair of states at both ends the least weight. Blocks follow each other in a second
shuffle, where a conversation needs only its four least weights, each with its running
hash; texts are read one block at a time. SHA-256 takes bytes in order, so one task reads
the blocks of one conversation, and its memory grows by the initials alone.

Defined results: null role or text is one space. Rows of equal turn are ordered by a hash
of role and text, so equal rows are neighbours; null turns come first, and a null id is a
conversation. Repeated rows are duplicates. An empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.operators.spool import spool

# Costs, and the characters that count as space.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
LETTERS = ".DIKR"  # by code; the order is that of ASCII
#: States of what has been put out so far.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
SLOT = 9  # bits: three letters of three
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: A block has at most so many rows, or so many characters and one row.
BLOCK_ROWS, BLOCK_CHARS = 256, 4 << 20
BLANK, DUPLICATE, CUT = 1, 2, 4  # faults


# --- rows as they are judged ---------------------------------------------------------------

def damaged(table: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with the faults of the contract put in, by the checksum
    of `conv_id:turn`: 0 gone (a row without text), 1 emptied, 2 without ends of sentences,
    3 twice, 4 role user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    rows = _plain(table).withColumn("code", F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20)
    text = (
        F.when(F.col("code") == 1, F.lit(""))
        .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    twice = F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id", "turn", F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") != 0, text).alias("text"), twice.alias("copy"),
    ).drop("copy")


def _plain(table: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )


def _judged(rows: DataFrame) -> DataFrame:
    """With a hash of role and text, and the faults that a row shows by itself."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    fault = F.when(trimmed == "", F.lit(BLANK)).when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), F.lit(CUT)).otherwise(F.lit(0))
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    return rows.withColumns({"digest": F.unhex(F.sha2(content, 256)), "fault": fault.cast("int")})


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in ranges of (conv_id, turn, digest), with a mark in front of those whose role
    and text stand at an earlier turn. Marks hold no texts, so texts travel once."""
    judged = _judged(rows.filter("text IS NOT NULL"))
    light = judged.select("conv_id", "turn", "digest")
    # Nulls are least in a struct, as they are in the order of turns.
    first = light.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("lo"), F.max(F.struct("turn")).alias("hi"))
    again = first.filter("lo < hi").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("lo"))
    marks = light.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))).filter(F.struct("turn") > F.col("lo"))
    nothing = F.lit(None).cast("string")

    def shaped(df: DataFrame, kind: int, *rest: Column) -> DataFrame:
        return df.select("conv_id", "turn", "digest", F.lit(kind).alias("kind"), *rest)

    union = (
        shaped(marks, 0, nothing.alias("role"), nothing.alias("text"), F.lit(0).alias("fault"))
        .unionByName(shaped(judged, 1, F.col("role"), F.col("text"), F.col("fault")))
        .unionByName(
            rows.filter("text IS NULL").select(
                "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(2).alias("kind"),
                nothing.alias("role"), nothing.alias("text"), F.lit(0).alias("fault"),
            )
        )
    )
    keys = ["conv_id", "turn", "digest"]
    return union.repartitionByRange(*keys).sortWithinPartitions(*keys, "kind")


# --- edges and paths -------------------------------------------------------------------------

def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _chains(state: int) -> Iterator[tuple[int, int, int]]:
    """Number of inserts, their letters at the front of a slot, and the state after them."""
    code = 0
    for n in range(3):
        yield n, code, state
        code |= 2 << (SLOT - 3 * (n + 1))
        state = _inserted(state)


def _kept(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def _row_edges(initial: str, fault: int) -> list[list[tuple[int, int] | None]]:
    """For each pair of states the least (cost, slot) of a row."""
    best: list[list[tuple[int, int] | None]] = [[None] * 4 for _ in STATES]
    for p in STATES:
        for n, code, at in _chains(p):
            place = SLOT - 3 * (n + 1)
            acts = [(at, DELETE, 1)]
            if not fault & (BLANK | DUPLICATE):
                extra = TRUNCATED if fault & CUT else 0
                kept = _kept(at, initial)
                acts += [(kept, extra, 3)] if kept is not None else []
                acts += [(_inserted(at), REROLE + extra, 4)]
            for q, cost, letter in acts:
                edge = (INSERT * n + cost, code | letter << place)
                if best[p][q] is None or edge < best[p][q]:
                    best[p][q] = edge
    return best


EDGES = {(i, f): _row_edges(i, f) for i in "sua?" for f in (0, BLANK, DUPLICATE, CUT)}
#: Least inserts with which a conversation may end, as (cost, slot) for each state.
ENDS = [min((INSERT * n, code) for n, code, at in _chains(p) if at in (START, ASSISTANT)) for p in STATES]


def _weights(start: int, kinds: Sequence[tuple[str, int]]) -> list[int | None]:
    """Least weight from a state in front of the rows to each state behind them."""
    width = SLOT * len(kinds)
    least: list[int | None] = [None] * 4
    least[start] = 0
    for i, kind in enumerate(kinds):
        shift, edges = width - SLOT * (i + 1), EDGES[kind]
        after: list[int | None] = [None] * 4
        for p, w in enumerate(least):
            if w is None:
                continue
            for q, edge in enumerate(edges[p]):
                if edge is not None:
                    sum_ = w + (edge[0] << width) + (edge[1] << shift)
                    if after[q] is None or sum_ < after[q]:
                        after[q] = sum_
        least = after
    return least


def _letters(code: int, slots: int) -> str:
    """The initials in a number of slots, without the padding."""
    return "".join(LETTERS[code >> s & 7] for s in range(slots * SLOT - 3, -1, -3) if code >> s & 7)


@dataclass
class Block:
    """Rows of one conversation that follow each other, with what they show together."""

    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    chars: int = 0
    low: int | None = None
    high: int | None = None
    turns: int = 0
    illegal: int = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if self.roles:
            self.illegal += role_pair(self.roles[-1], role)
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.chars += len(text)

    def kinds(self) -> list[tuple[str, int]]:
        return [(r[:1] if r[:1] in ("s", "u", "a") else "?", f) for r, f in zip(self.roles, self.faults, strict=True)]

    def count(self, fault: int) -> int:
        return self.faults.count(fault)


def role_pair(before: str, after: str) -> int:
    return int(before[:1] + after[:1] not in ("su", "ua", "au"))


def messages_of(state: int, letters: str, roles: Sequence[str], texts: Sequence[str]) -> list[tuple[str, str, str, int | None]]:
    """(role, text, edit, row) that the letters make of rows, from a state in front of them."""
    found, row = [], 0
    for letter in letters:
        if letter == "I":
            state = _inserted(state)
            found.append((ROLE_OF[state], "", letter, None))
            continue
        if letter == "R":
            state = _inserted(state)
            found.append((ROLE_OF[state], texts[row], letter, row))
        elif letter == "K":
            state = _kept(state, roles[row][:1])
            found.append((roles[row], texts[row], letter, row))
        row += 1
    return found


def _lines(messages: Sequence[tuple], follows: bool) -> bytes:
    text = "\n".join(f"{m[0]}:{m[1]}" for m in messages)
    return (("\n" if follows and messages else "") + text).encode()


# --- tasks -----------------------------------------------------------------------------------

#: What orders the blocks of a conversation.
PLACE = ["place_turn", "place_digest", "place_no"]
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
SOLVED = (
    "conv_id long, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string, place_turn long, place_digest binary, place_no long, roles array<string>, texts array<string>, faults array<int>, "
    "low long, high long, turns long, least array<binary>"
)
_ARROW = {
    "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary()), "int": pa.int32(),
}


def _batches(rows: Iterator[tuple], shape: str, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches; the last entry of a row is its weight in characters."""
    names, types = zip(*(c.split() for c in shape.split(", ")), strict=True)
    held, weight = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(zip(*held, strict=True), types, strict=True)], list(names))

    for *row, chars in rows:
        held.append(row)
        weight += chars
        if len(held) >= most or weight > 16 << 20:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def _solve(keep_texts: bool, block_rows: int):
    """Sorted rows of a task to solved conversations and blocks of open ones."""

    def whole_row(conv, block: Block) -> tuple:
        kinds = block.kinds()
        width = SLOT * len(kinds)
        least = [None if w is None else (w << SLOT) + (ENDS[p][0] << width + SLOT) + ENDS[p][1] for p, w in enumerate(_weights(START, kinds))]
        best = min(w for w in least if w is not None)
        audit = _letters(best & (1 << width + SLOT) - 1, len(kinds) + 1)
        made = messages_of(START, audit, block.roles, block.texts)
        gaps = 0 if block.low is None else block.high - block.low + 1 - block.turns
        texts = (block.roles, block.texts) if keep_texts else (None, None)
        return (
            conv, True, gaps, block.count(BLANK), block.count(DUPLICATE), block.count(CUT), block.illegal, best >> width + SLOT, audit,
            hashlib.sha256(_lines(made, False)).hexdigest(), None, None, None, *texts, None, None, None, None, None, block.chars if keep_texts else 100,
        )

    def part_row(conv, place, block: Block) -> tuple:
        kinds = block.kinds()
        least = [None if w is None else w.to_bytes(w.bit_length() // 8 + 1, "big") for p in STATES for w in _weights(p, kinds)]
        return (
            conv, False, None, block.count(BLANK), block.count(DUPLICATE), block.count(CUT), block.illegal, None, None, None, *place,
            block.roles, block.texts, block.faults, block.low, block.high, block.turns, least, block.chars,
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv, block, place, seen, mark, borders, number = None, None, None, None, None, True, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "digest", "kind", "role", "text", "fault")]
            for c, turn, digest, kind, role, text, fault in zip(*columns, strict=True):
                if block is None or c != conv:
                    if block is not None:
                        # What begins with the task may have begun before it.
                        yield part_row(conv, place, block) if borders else whole_row(conv, block)
                        borders = False
                    conv, block, place, seen, mark = c, Block(), (turn, digest, 0), None, None
                if kind == 2:
                    continue
                if kind == 0:
                    mark = (turn, digest)
                    continue
                if not block.roles:
                    # Rows of one turn and content are in one task, so a number tells their blocks apart.
                    number += 1
                    place = (turn, digest, number)
                if not fault & BLANK and ((turn, digest) == mark or (turn, digest) == seen):
                    fault = DUPLICATE
                seen = (turn, digest)
                block.add(turn, role, text, fault)
                if len(block.roles) >= block_rows or block.chars >= BLOCK_CHARS:
                    yield part_row(conv, place, block)
                    block, borders = Block(), True
        if block is not None:
            yield part_row(conv, place, block)

    return lambda batches: _batches(rows(batches), SOLVED)


JOINED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, "
    "place_turn long, place_digest binary, place_no long, state int, letters string"
)


@dataclass
class Way:
    """The best edits so far that end in one state."""

    cost: int
    rank: int
    digest: object
    last: tuple | None  # (way before, state it ends in, letters)


class Open:
    """A conversation whose blocks are read in order."""

    def __init__(self, conv: int | None) -> None:
        self.conv = conv
        self.ways: dict[int, Way] = {START: Way(0, 0, hashlib.sha256(), None)}
        self.places: list[tuple] = []
        self.sums = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.low = self.high = self.role = None
        self.turns = 0

    def add(self, row: dict) -> None:
        n = len(row["roles"])
        if not n:
            return
        for i, name in enumerate(("blank", "duplicate", "truncated", "illegal")):
            self.sums[i] += row[name]
        if self.role is not None:
            self.sums[3] += role_pair(self.role, row["roles"][0])
        self.role = row["roles"][-1]
        if row["low"] is not None:
            self.turns += row["turns"] - (self.high == row["low"])
            self.low = row["low"] if self.low is None else self.low
            self.high = row["high"]
        self.places.append(tuple(row[c] for c in PLACE))
        self._step([None if w is None else int.from_bytes(w, "big") for w in row["least"]], n, row["roles"], row["texts"])

    def _step(self, least: list[int | None], slots: int, roles: list[str], texts: list[str]) -> None:
        """Ways through one more block. Slots are aligned, so of two ways of equal cost the
        one whose earlier letters come first is first; ranks stand for these letters."""
        width = SLOT * slots
        chosen: dict[int, tuple[int, int, int, int]] = {}
        for p, way in self.ways.items():
            for q in STATES:
                w = least[4 * p + q]
                if w is not None:
                    code = w & (1 << width) - 1
                    key = (way.cost + (w >> width), way.rank, code, p)
                    if q not in chosen or key < chosen[q]:
                        chosen[q] = key
        order = sorted(chosen, key=lambda q: chosen[q][1:3])
        ways = {}
        for q, (cost, _, code, p) in chosen.items():
            before, letters = self.ways[p], _letters(code, slots)
            digest = before.digest.copy()
            digest.update(_lines(messages_of(p, letters, roles, texts), p != START))
            ways[q] = Way(cost, order.index(q), digest, (before, p, letters))
        self.ways = ways

    def close(self) -> Iterator[tuple]:
        """The conversation, and where each of its blocks begins, its state and letters."""
        _, _, _, q = min((w.cost + ENDS[q][0], w.rank, ENDS[q][1], q) for q, w in self.ways.items())
        way, end = self.ways[q], _letters(ENDS[q][1], 1)
        made = messages_of(q, end, [], [])
        way.digest.update(_lines(made, q != START))
        cost, sha, steps = way.cost + ENDS[q][0], way.digest.hexdigest(), []
        while way.last is not None:
            way, p, letters = way.last
            steps.append((p, letters))
        steps.reverse()
        audit = "".join(letters for _, letters in steps) + end
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        yield (self.conv, gaps, *self.sums, cost, audit, sha, *[None] * 5, len(audit))
        for i, (place, (state, letters)) in enumerate(zip(self.places, steps, strict=True)):
            last = end if i == len(steps) - 1 else ""
            yield (self.conv, *[None] * 8, *place, state, letters + last, len(letters))


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order to conversations and the ways through their blocks."""

    def rows() -> Iterator[tuple]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held is None or held.conv != row["conv_id"]:
                    if held is not None:
                        yield from held.close()
                    held = Open(row["conv_id"])
                held.add(row)
        if held is not None:
            yield from held.close()

    return _batches(rows(), JOINED)


class Repair:
    """`report`: a row for each conversation with its faults, cost, the initials of its edits
    and the hash of what is left. `messages`: the repaired rows."""

    def __init__(self, rows: DataFrame, block_rows: int = BLOCK_ROWS, keep_texts: bool = True) -> None:
        """`rows`: conv_id, turn, role, text; a row without text only names a conversation."""
        self._solved = spool(_ordered(rows).mapInArrow(_solve(keep_texts, block_rows), SOLVED))
        parts = self._solved.filter("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", *PLACE)
        self._joined = spool(parts.mapInArrow(_join, JOINED))
        columns = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
        self.report = self._solved.filter("whole").select(columns).unionByName(self._joined.filter("audit IS NOT NULL").select(columns))

    def messages(self) -> DataFrame:
        """conv_id, place_turn, place_digest and place_no (null in conversations of one block;
        they order the blocks), position in the block, role, text and edit of every repaired row."""
        columns = ["conv_id", *PLACE, "state", "letters", "roles", "texts"]
        wholes = self._solved.filter("whole").withColumns({"state": F.lit(START), "letters": F.col("audit")}).select(columns)
        ways = self._joined.filter("audit IS NULL").select(*[F.col(c).alias(f"_{c}") for c in ("conv_id", *PLACE)], "state", "letters")
        parts = self._solved.filter("NOT whole AND size(roles) > 0").select("conv_id", *PLACE, "roles", "texts")
        turns, digests, numbers = (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE)
        met = parts.join(ways, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & turns & digests & numbers).select(columns)
        shape = (
            "conv_id long, place_turn long, place_digest binary, place_no long, position int, role string, text string, edit string"
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for batch in batches:
                    for *place, state, letters, roles, texts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                        for i, (role, text, edit, _) in enumerate(messages_of(state, letters, roles, texts)):
                            yield (*place, i, role, text, edit, len(text))

            return _batches(rows(), shape)

        return wholes.unionByName(met).mapInArrow(run, shape)


def repair(rows: DataFrame, block_rows: int = BLOCK_ROWS, keep_texts: bool = True) -> Repair:
    """Judge and repair conversations as they are: null role or text is one space."""
    return Repair(_plain(rows), block_rows, keep_texts)
