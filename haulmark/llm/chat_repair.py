"""Repair of conversation structure: the cheapest edits that make the turns alternate, found by Knuth's agenda.

The turns of a conversation, in order, are to read ``(s?(ua)+)?`` by the initials of their roles: an optional system
turn, then user and assistant in turn. Keep costs 0, Rerole to user or assistant 2, Delete 3, Insert of an empty user or
assistant turn 2; a truncated turn that stays costs 1 more; blank and duplicate turns must go. Of equally cheap edits
those whose initials (the audit, e.g. ``KKID``) are least in ASCII win. The audit fixes the roles, since every state
of the pattern lets one of user and assistant follow.

Items of the deduction are [row, state], reached with a value (cost, audit), and [row, edit], with the edit's cost and an
empty audit; [row, state] and [row, edit] together derive [row + 1, next state], [row, state] alone derives an
inserted turn. Values grow along each deduction and keep their order (of two values of one item with equal cost none is
the beginning of the other, as the rest would be paid inserts), so the first value an item is popped with is its
least. ``lightest`` does that for at most ``CHUNK`` rows from each state they can start in. Longer conversations are chained
by the state between their pieces, so one that holds a third of all rows is spread over all tasks: rows are
range-partitioned by conversation and turn, pieces are solved where they lie, and what one task sees of a conversation
in order is a short row per piece (``_fold``), of which it keeps the audit of four open ends behind their common part.
The repaired texts are made piece by piece. A digest over them is a chain by its nature: texts of conversations of
several pieces pass through one hash in order, streamed and not collected.

Defined cases: a null role or text counts as one space, so it is blank or, with a text, has to be reroled or deleted.
Null turns come first and do not count for gaps. Rows of one turn go by role, the first 32 characters of their text, and a
hash of the whole text. Rows without conv_id are one conversation. Repeated rows are duplicates, all but the first; two rows
are the same when two 64-bit hashes of role and text agree. A gap count beyond a long is null. An empty table
gives no rows. Only the four columns of a conversation are read, so further columns of any name change nothing.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from haulmark.llm.common import stage
from haulmark.session import ship_package

_CHUNK_BITS = 9
CHUNK = 1 << _CHUNK_BITS
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# States: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant. NEXT lacks what may not follow.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
TURN = {0: "u", 1: "u", 2: "a", 3: "u"}
DONE = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\f\r"
_KEY = ["known", "conv"]


def damage(conversations: DataFrame) -> DataFrame:
    """The rows of a conversation table with faults put in by crc32("conv_id:turn") % 20: 0 drops a row, 1 empties its
    text, 2 takes out full stops, exclamation and question marks, 3 repeats it, 4 makes it a user's."""
    named = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return (conversations.withColumn("fault", F.crc32(named) % 20).filter("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(role).alias("role"),
                    F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", ""))
                    .otherwise(text).alias("text"),
                    F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
            .drop("copy"))


def _keyed(conversations: DataFrame) -> list:
    """A conversation's key without nulls: whether there is an id, and the id."""
    kind = conversations.schema["conv_id"].dataType
    return [F.col("conv_id").isNotNull().alias("known"), F.coalesce("conv_id", F.lit("0").cast(kind)).alias("conv")]


def ordered(conversations: DataFrame) -> DataFrame:
    """All turns, stored in the order of (conversation, turn) over range partitions: key, place, turn, role, text, marks."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    bare = F.rtrim("text", F.lit(SPACE))
    rows = (conversations.select(*_keyed(conversations), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
            .withColumns({"head": F.left("text", F.lit(32)), "h1": F.xxhash64("role", "text"),
                          "h2": F.xxhash64(F.lit("second"), "role", "text"),
                          # Equal rows may stand in any order; this lets a range boundary fall between them.
                          "tie": F.monotonically_increasing_id()}))
    order = [*_KEY, "turn", "role", "head", "h1", "h2", "tie"]
    return stage(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                 .select(*_KEY, F.monotonically_increasing_id().alias("place"), "turn", "role", "text", "h1", "h2",
                         F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o").alias("initial"),
                         (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut")), "turns")


def _chunks(turns: DataFrame) -> DataFrame:
    """One row per conversation and piece: the turns' numbers, symbols and initials in order.

    A symbol is B for a blank turn, D for a duplicate, else the initial, as a capital where the turn is truncated.
    """
    marks = turns.select(*_KEY, "place", "turn", "h1", "h2", "initial", "blank", "cut")
    twice = (marks.filter("NOT blank").groupBy(*_KEY, "h1", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times"))
             .filter("times > 1").drop("times"))
    symbol = (F.when(F.col("blank"), "B").when(F.col("place") > F.col("first"), "D")
              .when(F.col("cut"), F.upper("initial")).otherwise(F.col("initial")))
    rows = marks.join(twice, [*_KEY, "h1", "h2"], "left").select(
        *_KEY, F.shiftright("place", _CHUNK_BITS).alias("chunk"), F.struct("place", "turn", symbol.alias("symbol"), "initial").alias("row"))
    found = rows.groupBy(*_KEY, "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return found.select(*_KEY, "chunk", F.col("rows.turn").alias("turns"), F.array_join("rows.symbol", "").alias("symbols"),
                        F.array_join("rows.initial", "").alias("initials"))


def _edits(symbol: str):
    """(initial of the turn that stays or none, cost, letter) of every edit that a row allows."""
    yield "", DELETE, "D"
    if symbol not in "BD":
        stays, kept = symbol.lower(), TRUNCATED * symbol.isupper()
        yield stays, kept, "K"
        for role in "ua":
            yield role, kept + REROLE, "R"


def lightest(symbols: str, start: int) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) from ``start`` over all rows to each state that can be reached, by Knuth's agenda."""
    last = len(symbols)
    goals = {(0, last, s) for s in (2, 3, *({start} & {0, 1}))}
    if start == 0 and set(symbols) & set("sS"):
        goals.add((0, last, 1))
    agenda = [(0, "", (0, 0, start))]  # items are (0, row, state) and (1, row, initial that stays, letter)
    agenda += [(cost, "", (1, row, stays, letter)) for row, symbol in enumerate(symbols) for stays, cost, letter in _edits(symbol)]
    heapq.heapify(agenda)
    done, states, edits = {}, {}, {}
    while goals:
        cost, audit, item = heapq.heappop(agenda)
        if item in done:
            continue
        done[item] = cost, audit
        goals.discard(item)
        kind, row, *rest = item
        if kind == 0:
            state, = rest
            states.setdefault(row, []).append((cost, audit, state))
            pairs = [((cost, audit, state), edit) for edit in edits.get(row, ())]
            heapq.heappush(agenda, (cost + INSERT, audit + "I", (0, row, NEXT[state, TURN[state]])))
        else:
            edits.setdefault(row, []).append((cost, *rest))
            pairs = [(state, (cost, *rest)) for state in states.get(row, ())]
        for (paid, so_far, state), (price, stays, letter) in pairs:
            after = NEXT.get((state, stays)) if stays else state
            if after is not None:
                heapq.heappush(agenda, (paid + price, so_far + letter, (0, row + 1, after)))
    return {s: done[0, last, s] for s in range(4) if (0, last, s) in done}


@lru_cache(maxsize=4096)
def _solved(symbols: str) -> tuple[list[int], list[int], list[int], list[str]]:
    found = [(a, b, cost, audit) for a in range(4) for b, (cost, audit) in lightest(symbols, a).items()]
    return tuple(map(list, zip(*found)))


_PIECE = ("rows long, blank long, duplicate long, truncated long, illegal long, opens string, closes string, n_turns long, low long, "
          "high long, sources array<int>, targets array<int>, costs array<long>, audits array<string>")


def _solve(batch: pa.RecordBatch):
    out = []
    for turns, symbols, initials in zip(*(batch.column(c).to_pylist() for c in ("turns", "symbols", "initials"))):
        numbers = [t for t in turns if t is not None]
        out.append((len(symbols), symbols.count("B"), symbols.count("D"), sum(s in "SUAO" for s in symbols),
                    sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), initials[0], initials[-1],
                    len(set(numbers)), min(numbers, default=None), max(numbers, default=None), *_solved(symbols)))
    kinds = {"string": pa.string(), "long": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in _PIECE.split(",")]
    columns = list(zip(*out)) or [[]] * len(fields)
    yield pa.RecordBatch.from_arrays(
        [batch.column(c) for c in (*_KEY, "chunk")] + [pa.array(list(v), kinds[k]) for v, (_, k) in zip(columns, fields)],
        names=[*_KEY, "chunk", *(n for n, _ in fields)])


def _rows(batches, columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


class _Batches:
    """Rows gathered to Arrow batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, limit: int = 4 << 20):
        self.schema, self.limit, self.rows, self.size = schema, limit, [], 0

    def add(self, row, size=0):
        self.rows.append(row)
        self.size += size + 200
        if self.size > self.limit:
            yield from self.flush()

    def flush(self):
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
            self.rows, self.size = [], 0


_TOTALS = "cost long, audit string, gaps long, blank long, duplicate long, truncated long, illegal long"


def _chain(pieces):
    """Totals of one conversation, and (chunk, state, audit) of its pieces, from the pieces in order."""
    ends, counts, last, low, high, distinct = {0: (0, "", None)}, [0] * 4, None, None, None, 0
    for (chunk, _, blank, duplicate, truncated, illegal, opens, closes, n_turns, first, final, sources, targets, costs, audits) in pieces:
        for i, more in enumerate((blank, duplicate, truncated, illegal)):
            counts[i] += more
        counts[3] += last is not None and last + opens not in LEGAL
        last = closes
        if n_turns:
            distinct += n_turns - (high == first)
            low, high = first if low is None else low, final
        after = {}
        for a, b, cost, audit in zip(sources, targets, costs, audits):
            if a in ends:
                paid, so_far, trail = ends[a]
                value = (paid + cost, so_far + audit)
                if b not in after or value < after[b][:2]:
                    after[b] = (*value, (trail, chunk, a, audit))
        shared = len(commonprefix([so_far for _, so_far, _ in after.values()]))
        ends = {b: (cost, so_far[shared:], trail) for b, (cost, so_far, trail) in after.items()}
    cost, _, trail = min(ends[s] for s in DONE if s in ends)
    parts = []
    while trail:
        trail, *part = trail
        parts.append(part)
    parts.reverse()
    gaps = 0 if low is None else high - low + 1 - distinct
    return (cost, "".join(p[2] for p in parts), gaps if gaps < 1 << 63 else None, *counts), parts


def _fold(batches, schema):
    out = _Batches(schema)
    columns = [*_KEY, "chunk", *(f.strip().split(" ")[0] for f in _PIECE.split(","))]
    for key, pieces in groupby(_rows(batches, columns), key=lambda r: r[:2]):
        totals, parts = _chain(p[2:] for p in pieces)
        yield from out.add((*key, None, None, None, None, *totals), len(totals[1]))
        for chunk, state, audit in parts:
            yield from out.add((*key, chunk, state, audit, len(parts) == 1, *[None] * len(totals)), len(audit))
    yield from out.flush()


def plan(turns: DataFrame) -> DataFrame:
    """The edits of all conversations of ``ordered`` rows: a row of totals each (chunk null), and one per piece of it with the
    state before the piece, its part of the audit, and whether it is the only piece."""
    spark = turns.sparkSession
    ship_package(spark)
    kind = turns.schema["conv"].dataType.simpleString()
    solved = _chunks(turns).mapInArrow(lambda batches: (b for batch in batches for b in _solve(batch)),
                                       f"known boolean, conv {kind}, chunk long, {_PIECE}")
    spread = solved.repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk")
    text = f"known boolean, conv {kind}, chunk long, state int, part string, whole boolean, {_TOTALS}"
    arrow = _arrow(text)
    return stage(spread.mapInArrow(lambda batches: _fold(batches, arrow), text), "repairs")


def _arrow(text: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(text))


def _edited(rows):
    """(key, chunk, whole, turns) of pieces, where turns gives (role, text, edit) of every turn that stays."""
    def turns(piece):
        state, edits = None, None
        for _, _, _, _, role, text, state_before, part in piece:
            if edits is None:
                state, edits = state_before, iter(part)
            for edit in edits:
                if edit == "I":
                    turn = TURN[state]
                    state = NEXT[state, turn]
                    yield NAMES[turn], "", "I"
                    continue
                if edit == "R":
                    turn = TURN[state]
                    state = NEXT[state, turn]
                    yield NAMES[turn], text, "R"
                elif edit == "K":
                    state = NEXT[state, role[:1]]
                    yield role, text, "K"
                break
        for _ in edits:
            turn = TURN[state]
            state = NEXT[state, turn]
            yield NAMES[turn], "", "I"
    for key, piece in groupby(rows, key=lambda r: r[:4]):
        yield (*key, turns(piece))


def _with_edits(turns: DataFrame, plans: DataFrame) -> DataFrame:
    parts = plans.filter("chunk IS NOT NULL").select(*_KEY, "chunk", "whole", "state", "part")
    return (turns.select(*_KEY, F.shiftright("place", _CHUNK_BITS).alias("chunk"), "place", "role", "text")
            .join(parts, [*_KEY, "chunk"]).repartition(*_KEY, "chunk").sortWithinPartitions(*_KEY, "chunk", "place")
            .select(*_KEY, "chunk", "whole", "role", "text", "state", "part"))


_COLUMNS = [*_KEY, "chunk", "whole", "role", "text", "state", "part"]


def repaired(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (chunk, place), role, text and edit of every turn."""
    kind = turns.schema["conv"].dataType.simpleString()
    text = f"known boolean, conv {kind}, chunk long, place long, role string, text string, edit string"
    arrow = _arrow(text)

    def run(batches):
        out = _Batches(arrow)
        for known, conv, chunk, _, said in _edited(_rows(batches, _COLUMNS)):
            for place, (role, words, edit) in enumerate(said):
                yield from out.add((known, conv, chunk, place, role, words, edit), len(words))
        yield from out.flush()
    return (_with_edits(turns, plans).mapInArrow(run, text)
            .select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), "chunk", "place", "role", "text", "edit"))


def digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(known, conv, repaired_sha256): SHA-256 of the repaired ``role:text`` lines, joined by newlines."""
    kind = turns.schema["conv"].dataType.simpleString()
    text = f"known boolean, conv {kind}, chunk long, place long, line binary, sha string"
    arrow = _arrow(text)
    done = f"known boolean, conv {kind}, repaired_sha256 string"
    done_arrow = _arrow(done)

    def piecewise(batches):
        out = _Batches(arrow)
        for known, conv, chunk, whole, said in _edited(_rows(batches, _COLUMNS)):
            digest = hashlib.sha256()
            for place, (role, words, _) in enumerate(said):
                line = f"{role}:{words}".encode()
                if whole:
                    digest.update(b"\n" + line if place else line)
                else:
                    yield from out.add((known, conv, chunk, place, line, None), len(line))
            if whole:
                yield from out.add((known, conv, chunk, 0, None, digest.hexdigest()))
        yield from out.flush()

    def in_order(batches):
        out = _Batches(done_arrow)
        for key, lines in groupby(_rows(batches, [*_KEY, "line"]), key=lambda r: r[:2]):
            digest = hashlib.sha256()
            for place, (_, _, line) in enumerate(lines):
                digest.update(b"\n" + line if place else line)
            yield from out.add((*key, digest.hexdigest()))
        yield from out.flush()

    found = stage(_with_edits(turns, plans).mapInArrow(piecewise, text), "repaired")
    chained = (found.filter("sha IS NULL").repartition(*_KEY).sortWithinPartitions(*_KEY, "chunk", "place")
               .select(*_KEY, "line").mapInArrow(in_order, done))
    return found.filter("sha IS NOT NULL").select(*_KEY, F.col("sha").alias("repaired_sha256")).unionAll(chained)


def report(conversations: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """Findings, costs, audits and digests of the repaired texts, one row per conversation.

    ``named`` lists conversations to report, also those without a row; without it, those that have rows.
    """
    turns = ordered(conversations)
    plans = plan(turns)
    ids = turns.select(*_KEY).distinct() if named is None else named.select(*_keyed(named)).distinct()
    totals = plans.filter("chunk IS NULL").drop("chunk", "state", "part", "whole")
    found = ids.join(totals, _KEY, "left").join(digests(turns, plans), _KEY, "left")
    zero = [F.when(F.col("cost").isNull(), F.lit(0).cast("long")).otherwise(F.col(c)).alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
