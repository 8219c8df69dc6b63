"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed when the initials of its roles read `(s?(ua)+)?`. Edits, in ASCII order: Delete a row (2; blank and
repeated rows must go), Insert an empty user or assistant row (5), Keep (0), Rerole to user or assistant (1); a truncated
row that stays costs 5 more. A depth-first search tries them in that order under a cost bound that rises to the smallest cost
seen beyond it; what is left of a row's unavoidable costs bounds the rest from below, and a table holds, for each
(row, state), how much budget has failed there. So the first accepting path is the cheapest, and the ASCII-least of those. The
role that an inserted or renamed row takes is settled by the state, so an audit (the edits' initials) names the whole repair.

Conversations of up to `long_rows` rows are searched whole, streaming over sorted partitions. Longer ones are ranked over several tasks and
cut into segments; each segment is searched from each state to each state, inserting only before its rows, so that
no audit of a segment is the beginning of another one. A pass over the segments' costs, a few numbers each, then picks the states between
them; among equal costs, the order of the audits of the first segment that differs decides, as it does for the whole audit.

Defined results: null roles and texts are one space; null turns come first; rows of one turn are ordered by role and text. A null
conversation id is one conversation. A row's fault is the first of blank (no character but white space), duplicate (role and text
seen earlier in the conversation) and truncated (its last character that is no white space is none of `.!?`). A conversation
without rows has zeros, an empty audit and no repaired rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import materialize, ship
from starbuild.operators.numbering import rank_in_group

LONG_ROWS = 512
SEGMENT_ROWS = 256
#: Searches kept by what they searched.
CACHE_ENTRIES = 100_000
#: Rows of an Arrow batch sent back.
PORTION = 1_000

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, STAY_TRUNCATED, RENAME = 2, 5, 5, 1
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = range(4)
ACCEPTING = (0, 3)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The only role that may be written in a state, and the state after it.
WRITTEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
LEGAL_PAIRS = {"su", "ua", "au"}
#: How a row is seen by the search: its initial (o: another one), in upper case if truncated; x must go; $ is the end.
GOES, END = "x", "$"


def _moves(sign: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(initial, cost, rows used, next state) of the edits, in ASCII order."""
    insert = ("I", INSERT, 0, WRITTEN[state][1])
    if sign == END:
        return (insert,)
    moves = [("D", DELETE, 1, state), insert]
    if sign != GOES:
        extra = STAY_TRUNCATED if sign.isupper() else 0
        if (after := KEPT.get((state, sign.lower()))) is not None:
            moves.append(("K", extra, 1, after))
        moves.append(("R", RENAME + extra, 1, WRITTEN[state][1]))
    return tuple(moves)


MOVES = {(sign, state): _moves(sign, state) for sign in "suaoSUAO" + GOES + END for state in STATES}
#: What a row costs at least.
LEAST = {sign: min(m[1] for m in MOVES[sign, 0] + MOVES[sign, 2] if m[2]) for sign in "uaoUAO" + GOES} | {"s": 0, "S": DELETE}


def search(signs: str, start: int = 0, ends: tuple[int, ...] = ACCEPTING, tail: bool = True) -> tuple[int, str] | None:
    """Cost and audit of the cheapest, then ASCII-least repair from state `start` to one of `ends`.

    With `tail`, rows may be inserted after the last one. None if no edits lead there.
    """
    n = len(signs)
    # only a kept system row leads to state 1, nothing leads back to state 0
    reachable = {start} | ({1} if start == 0 and set(signs) & {"s", "S"} else set()) | ({2, 3} if n or tail else set())
    if reachable.isdisjoint(ends):
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + LEAST[signs[i]]
    ahead = signs + END
    #: What is known to be needed from a row and state on: more than each budget that failed there.
    needed: dict[tuple[int, int], int] = {}
    bound = least[0]
    while True:
        beyond = None
        path: list[str] = []
        stack = [(0, start, 0, 0)]
        while stack:
            i, state, spent, tried = stack.pop()
            if not tried:
                total = spent + max(least[i], needed.get((i, state), 0))
                if total > bound:
                    beyond = total if beyond is None else min(beyond, total)
                    del path[-1:]
                    continue
                if i == n and state in ends:
                    return spent, "".join(path)
            moves = MOVES[ahead[i], state] if i < n or tail else ()
            if tried < len(moves):
                initial, cost, used, after = moves[tried]
                stack.append((i, state, spent, tried + 1))
                stack.append((i + used, after, spent + cost, 0))
                path.append(initial)
            else:
                needed[i, state] = max(needed.get((i, state), 0), bound - spent + 1)
                del path[-1:]
        bound = max(bound + 1, beyond or 0)


def replay(rows: list[tuple[str, str]], audit: str, state: int = 0) -> list[dict[str, str]]:
    """The rows (role, text) that an audit leaves, from a state on."""
    out, left = [], iter(rows)
    for edit in audit:
        if edit == "I":
            role, state = WRITTEN[state]
            out.append({"role": role, "text": ""})
            continue
        role, text = next(left)
        if edit == "D":
            continue
        if edit == "K":
            state = KEPT[state, role[:1]]
        else:
            role, state = WRITTEN[state]
        out.append({"role": role, "text": text})
    return out


def fault(text: str, seen: bool) -> str:
    bare = text.rstrip(SPACE)
    return "blank" if not bare else "duplicate" if seen else "" if bare[-1] in ".!?" else "truncated"


def sign(role: str, wrong: str) -> str:
    if wrong in ("blank", "duplicate"):
        return GOES
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if wrong else initial


def faults_and_gaps(rows: list[tuple], wrong: list[str]) -> dict[str, int]:
    """Counts over rows (turn, role, text) in order."""
    initial = turn = None
    gaps = illegal = 0
    for t, role, _ in rows:
        if initial is not None and initial + role[:1] not in LEGAL_PAIRS:
            illegal += 1
        initial = role[:1]
        if t is not None:
            if turn is not None and t > turn:
                gaps += t - turn - 1
            turn = t
    return {
        "gaps": gaps,
        "blank": wrong.count("blank"),
        "duplicate": wrong.count("duplicate"),
        "truncated": wrong.count("truncated"),
        "illegal": illegal,
    }


class Searches(dict):
    """Searches of whole conversations, by their signs."""

    def __missing__(self, signs: str) -> tuple[int, str]:
        found = search(signs)
        if len(signs) <= 32:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[signs] = found
        return found


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
TURNS = "array<struct<role:string,text:string>>"
ID_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first `keys` columns, across batches."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for key, group in groupby(rows, itemgetter(*range(keys)) if keys > 1 else lambda r: (r[0],)):
        yield key, [row[keys:] for row in group]


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= PORTION:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _repair_whole(rows: DataFrame) -> DataFrame:
    """Conversations that are searched whole; a row with `kept` false only names its conversation."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    id_type = ID_TYPES[kind]
    schema = pa.schema(
        [("conv_id", id_type), *((c, pa.int64()) for c in (*COUNTS, "cost")), ("audit", pa.string()), ("repaired", ARROW_TURNS)]
    )

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Searches()

        def each() -> Iterator[tuple]:
            for (conv_id,), group in _groups(batches, 1):
                turns = [row[:3] for row in group if row[3]]
                seen: set[tuple[str, str]] = set()
                wrong = []
                for _, role, text in turns:
                    wrong.append(fault(text, (role, text) in seen))
                    seen.add((role, text))
                cost, audit = known["".join(sign(r, w) for (_, r, _), w in zip(turns, wrong))]
                counts = faults_and_gaps(turns, wrong)
                left = replay([t[1:] for t in turns], audit)
                yield conv_id, *(counts[c] for c in COUNTS), cost, audit, left

        yield from _batches(each(), schema)

    numbers = ", ".join(f"{c} long" for c in (*COUNTS, "cost"))
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "turn", "role", "text", "kept")
        .mapInArrow(repaired, f"conv_id {kind}, {numbers}, audit string, repaired {TURNS}")
        .select("conv_id", F.lit(0).cast("long").alias("segment"), F.lit(True).alias("last"), *COUNTS, "cost", "audit", "repaired")
    )


def _search_segments(rows: DataFrame, segment_rows: int) -> DataFrame:
    """Each segment with its rows, its counts, and the search from each state to each state."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    ranked = materialize(rank_in_group(rows, ["conv_id"], ["turn", "role", "text"], "place"))
    # the first row of each role and text is no duplicate; (conversation, place) is a key, so this join has no hot keys
    firsts = ranked.groupBy("conv_id", "role", "text").agg(F.min("place").alias("place")).select(
        F.col("conv_id").alias("_conv"), F.col("place").alias("_place")
    )
    segment = F.expr(f"(place - 1) div {segment_rows}").alias("segment")
    marked = ranked.join(
        firsts, ranked["conv_id"].eqNullSafe(firsts["_conv"]) & (ranked["place"] == firsts["_place"]), "left"
    ).select("conv_id", segment, "turn", "role", "text", F.col("_place").isNull().alias("seen"), "place")
    options = "array<struct<start:int,end:int,cost:long,audit:string>>"
    edge = "struct<initial:string,turn:long>"
    out = [
        *((c, pa.int64()) for c in COUNTS),
        ("options", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        *((c, pa.struct([("initial", pa.string()), ("turn", pa.int64())])) for c in ("first", "last")),
        ("rows", ARROW_TURNS),
    ]
    id_type = ID_TYPES[kind]
    schema = pa.schema([("conv_id", id_type), ("segment", pa.int64()), *out])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for key, group in _groups(batches, 2):
                turns = [row[:3] for row in group]
                wrong = [fault(text, seen) for _, _, text, seen, _ in group]
                signs = "".join(sign(r, w) for (_, r, _), w in zip(turns, wrong))
                found = [(a, b, search(signs, a, (b,), tail=False)) for a in STATES for b in STATES]
                ways = [{"start": a, "end": b, "cost": f[0], "audit": f[1]} for a, b, f in found if f]
                counts = faults_and_gaps(turns, wrong)
                known = [t for t, _, _ in turns if t is not None]
                edges = [{"initial": turns[k][1][:1], "turn": known[k] if known else None} for k in (0, -1)]
                left = [{"role": r, "text": t} for _, r, t in turns]
                yield *key, *(counts[c] for c in COUNTS), ways, *edges, left

        yield from _batches(each(), schema)

    numbers = ", ".join(f"{c} long" for c in COUNTS)
    return (
        marked.repartition("conv_id", "segment")
        .sortWithinPartitions("conv_id", "segment", "place")
        .mapInArrow(searched, f"conv_id {kind}, segment long, {numbers}, options {options}, first {edge}, last {edge}, rows {TURNS}")
    )


def choose(options: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """(start, end) of each segment on the best way through all of them.

    options: for each segment (start, end, cost, order of its audit among those from the same start).
    """
    tails = {q: 0 if q in ACCEPTING else INSERT * (2 if q == 1 else 1) for q in STATES}
    rest, chosen = tails, []
    for ways in reversed(options):
        best: dict[int, tuple[int, int, int]] = {}
        for a, b, cost, order in ways:
            if b in rest:
                best[a] = min(best.get(a, (cost + rest[b], order, b)), (cost + rest[b], order, b))
        rest = {a: c for a, (c, _, _) in best.items()}
        chosen.append({a: b for a, (_, _, b) in best.items()})
    state, path = 0, []
    for step in reversed(chosen):
        path.append((state, step[state]))
        state = step[state]
    return path


def _repair_long(rows: DataFrame, segment_rows: int) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = materialize(_search_segments(rows, segment_rows))
    # orders of audits instead of audits: all that the choice between equal costs needs
    least = F.expr(
        "transform(options, o -> named_struct('start', o.start, 'end', o.end, 'cost', o.cost, "
        "'order', size(filter(options, p -> p.start = o.start and p.audit < o.audit))))"
    )
    id_type = ID_TYPES[kind]
    schema = pa.schema(
        [("_conv", id_type), ("_segment", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("more_gaps", pa.int64()),
         ("more_illegal", pa.int64()), ("is_last", pa.bool_())]
    )

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for (conv_id,), group in _groups(batches, 1):
                ways = [[(o["start"], o["end"], o["cost"], o["order"]) for o in row[1]] for row in group]
                turn = initial = None
                for (a, b), (segment, _, first, last) in zip(choose(ways), group):
                    gap = first["turn"] - turn - 1 if turn is not None and first["turn"] is not None else 0
                    illegal = initial is not None and initial + first["initial"] not in LEGAL_PAIRS
                    yield conv_id, segment, a, b, max(gap, 0), int(illegal), segment == group[-1][0]
                    initial, turn = last["initial"], turn if last["turn"] is None else last["turn"]

        yield from _batches(each(), schema)

    ways = (
        found.select("conv_id", "segment", least.alias("options"), "first", "last")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment")
        .mapInArrow(chosen, f"_conv {kind}, _segment long, start int, end int, more_gaps long, more_illegal long, is_last boolean")
    )
    tail = F.when(F.col("is_last") & (F.col("end") == 1), "II").when(F.col("is_last") & (F.col("end") == 2), "I").otherwise("")
    picked = (
        found.join(ways, found["conv_id"].eqNullSafe(ways["_conv"]) & (found["segment"] == ways["_segment"]))
        .withColumn("way", F.expr("filter(options, o -> o.start = start and o.end = end)")[0])
        .select(
            "conv_id", "segment", F.col("is_last").alias("last"),
            (F.col("gaps") + F.col("more_gaps")).alias("gaps"), "blank", "duplicate", "truncated",
            (F.col("illegal") + F.col("more_illegal")).alias("illegal"),
            (F.col("way.cost") + INSERT * F.length(tail)).alias("cost"),
            F.concat("way.audit", tail).alias("audit"), "start", "rows",
        )
    )
    out = pa.schema(
        [("conv_id", id_type), ("segment", pa.int64()), ("last", pa.bool_()), *((c, pa.int64()) for c in (*COUNTS, "cost")),
         ("audit", pa.string()), ("repaired", ARROW_TURNS)]
    )

    def replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for key, group in _groups(batches, 9):
                for audit, start, left in group:
                    yield *key, audit, replay([(r["role"], r["text"]) for r in left], audit, start)

        yield from _batches(each(), out)

    numbers = ", ".join(f"{c} long" for c in (*COUNTS, "cost"))
    return picked.mapInArrow(
        replayed, f"conv_id {kind}, segment long, last boolean, {numbers}, audit string, repaired {TURNS}"
    )


def repair(
    conversations: DataFrame, long_rows: int = LONG_ROWS, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Repairs of `conversations` (conv_id, turn, role, text, kept), a row for each segment of a conversation.

    Rows with `kept` false are not part of their conversation, which is still returned. Returns conv_id, segment
    (from 0), last (whether it is the last one), gaps, blank, duplicate, truncated, illegal, cost, audit and repaired (an array of role and
    text). A conversation of up to `long_rows` rows is one segment; the numbers of several segments add up to
    those of the conversation, their audits and rows follow one another.
    """
    if conversations.schema["conv_id"].dataType.simpleString() not in ID_TYPES:
        raise ValueError("conversation ids must be integers or strings")
    ship(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), "kept",
    )
    sizes = rows.filter("kept").groupBy("conv_id").count().filter(F.col("count") > long_rows)
    long = materialize(sizes.select(F.col("conv_id").alias("_long")))
    if long.isEmpty():
        return _repair_whole(rows)
    same = rows["conv_id"].eqNullSafe(long["_long"])
    usual = _repair_whole(rows.join(long, same, "left_anti"))
    cut = _repair_long(rows.join(long, same, "left_semi").filter("kept").drop("kept"), segment_rows)
    return usual.unionByName(materialize(cut))


def damaged(conversations: DataFrame) -> DataFrame:
    """Damage that the CRC-32 of `conv_id:turn` decides: rows dropped, emptied, without sentence ends, repeated, or renamed."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    code = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("_code"))
        .withColumn("text", F.expr("case _code when 1 then '' when 2 then translate(text, '.!?', '') else text end"))
        .withColumn("role", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")))
        .withColumn("kept", F.col("_code") != 0)
        .withColumn("_copy", F.explode(F.expr("array_repeat(0, if(_code = 3, 2, 1))")))
        .drop("_code", "_copy")
    )


def repair_report(conversations: DataFrame, long_rows: int = LONG_ROWS, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row for each conversation of damaged `conversations`, with the SHA-256 of its repaired rows.

    The hash runs over a long conversation's segments in order, in one stream; nothing of it is held but the segment at hand and the audits.
    """
    written = F.expr("array_join(transform(repaired, r -> concat(r.role, ':', r.text)), '\n')")
    pieces = repair(damaged(conversations), long_rows, segment_rows).withColumn("written", written)
    pieces = pieces.withColumn("any", F.size("repaired") > 0).drop("repaired")
    whole = pieces.filter("segment = 0 and last").select(
        "conv_id", *COUNTS, "cost", "audit", F.sha2("written", 256).alias("repaired_sha256")
    )
    kind = pieces.schema["conv_id"].dataType.simpleString()
    id_type = ID_TYPES[kind]
    schema = pa.schema([("conv_id", id_type), *((c, pa.int64()) for c in (*COUNTS, "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))

        def each() -> Iterator[tuple]:
            for conv_id, group in groupby(rows, itemgetter(0)):
                sums, audits, digest, begun = [0] * (len(COUNTS) + 1), [], hashlib.sha256(), False
                for _, _, *numbers, audit, text, some in group:
                    sums = [a + b for a, b in zip(sums, numbers)]
                    audits.append(audit)
                    if some:
                        digest.update((b"\n" if begun else b"") + text.encode())
                        begun = True
                yield conv_id, *sums, "".join(audits), digest.hexdigest()

        yield from _batches(each(), schema)

    long = (
        pieces.filter("not (segment = 0 and last)")
        .select("conv_id", "segment", *COUNTS, "cost", "audit", "written", "any")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "segment")
        .mapInArrow(joined, f"conv_id {kind}, {', '.join(f'{c} long' for c in (*COUNTS, 'cost'))}, audit string, repaired_sha256 string")
    )
    return whole.unionByName(long)
