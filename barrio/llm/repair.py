"""Repair of conversation structure by Hirschberg's divide and conquer.

A conversation's turns are edited at least cost until their role initials read
``(s?(ua)+)?``: Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert
(an empty turn of user or assistant, anywhere) 2.  A turn's first fault counts:
blank (nothing but white space), duplicate (role and text seen earlier in the
conversation) or truncated (its last other character is none of ``.!?``).
Blank and duplicate turns must be deleted; a truncated turn that stays adds 1.
The audit is the string of the edits' initials; of equally cheap edits the
ASCII-least audit is taken.

Four states tell what the next turn may be: nothing yet, after a system turn,
after a user turn, after an assistant turn.  An edit script is cut in the
middle of the turns: a forward vector holds each state's least cost up to
there (and how the states' least audits compare), a backward vector the least
cost from there to the end.  Of the states whose sum is least, the one with
the least audit is the crossing; both halves are solved in the same way.  No
table of turns by states is kept.  Two scripts that reach one cut with
different audits differ before either ends (each ends with an edit of the last
turn before the cut, inserts belong to the turn after them), so the order of
the first halves decides.

Rows are dealt by ranges of (conversation, turn, ...), so a conversation of any
length is spread over tasks.  One that lies inside a task and fits into a piece
is repaired there.  Others travel in pieces: each piece gives its 4 x 4 least
costs and audit orders, a conversation's chain of pieces (numbers only) gives
the crossing at every cut, and each piece is then repaired between its two
crossings.  A chain is some hundred bytes for each 1024 turns
(or 64 KB of text).

Turns are taken by ``turn`` (nulls first), ties by role, then text.  Null roles
and texts are one space.  An empty role has no initial: no such turn can be
kept, and its neighbours are illegal.  Equal rows are turns of their own (the
second is a duplicate).  A null conversation id is one conversation.  Very long
texts are pieces of their own.  An empty table gives empty results; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.runs import PIECE_ROWS, chained_digests, in_order, pieces, remembered
from barrio.llm.tables import kept, picked

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
NEVER = 1 << 60
INITIALS = "sua"
# kinds of turns: initial (s, u, a, other), the same truncated, to be deleted
OTHER, TRUNCATED, GONE = 3, 4, 8

_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_SPACES = " \t\n\x0b\x0c\r"


def _then(state: int, initial: int) -> int | None:
    """The state after a turn with that initial, if it may stand there."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def _needed(state: int) -> int:
    """The initial (user or assistant) that may follow."""
    return 2 if state == USER else 1


def _edits(kind: int) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, letters) of the best edit of a turn with inserts before it."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state = start
        for n in range(3):
            moves = [(state, DELETE, "D")]
            if kind != GONE:
                extra = CUT_OFF if kind >= TRUNCATED else 0
                moves.append((_then(state, kind % TRUNCATED), KEEP + extra, "K"))
                moves.append((_then(state, _needed(state)), REROLE + extra, "R"))
            for to, cost, letter in moves:
                if to is not None:
                    move = (cost + n * INSERT, "I" * n + letter)
                    best[start, to] = min(best.get((start, to), move), move)
            state = _then(state, _needed(state))
    return [(a, b, *move) for (a, b), move in best.items()]


EDITS = [_edits(kind) for kind in range(GONE + 1)]
LETTERS = [{(a, b): letters for a, b, _, letters in edits} for edits in EDITS]
#: Inserts that end a conversation in each state.
ENDS = [0, 2, 1, 0]

Vector = tuple[tuple[int, int], ...]          # (cost, order of audits) by state


def entry(state: int) -> Vector:
    return tuple((0, 0) if s == state else (NEVER, 0) for s in range(4))


def _ordered(best: list) -> Vector:
    """Vector of [(cost, audit key) or None] by state, keys replaced by their order."""
    keys = sorted({b[1] for b in best if b})
    return tuple((b[0], keys.index(b[1])) if b else (NEVER, 0) for b in best)


@remembered
def _forward_step(vector: Vector, kind: int) -> tuple[int, Vector]:
    best: list = [None] * 4
    for a, b, cost, letters in EDITS[kind]:
        if vector[a][0] < NEVER:
            move = (vector[a][0] + cost, (vector[a][1], letters))
            best[b] = move if best[b] is None else min(best[b], move)
    return _normal(_ordered(best))


def _normal(vector: Vector) -> tuple[int, Vector]:
    """The least cost, and the vector above it: few of them occur."""
    low = min(cost for cost, _ in vector)
    return low, tuple((cost - low, order) if cost < NEVER else (NEVER, 0) for cost, order in vector)


@remembered
def _backward_step(vector: tuple[int, ...], kind: int) -> tuple[int, tuple[int, ...]]:
    best = [NEVER] * 4
    for a, b, cost, _ in EDITS[kind]:
        if vector[b] < NEVER:
            best[a] = min(best[a], vector[b] + cost)
    low = min(best)
    return low, tuple(cost - low if cost < NEVER else NEVER for cost in best)


def forward(kinds: bytes, low: int, high: int, vector: Vector) -> tuple[int, Vector]:
    """Least costs and audit orders by state after the turns low..high."""
    total = 0
    for i in range(low, high):
        more, vector = _forward_step(vector, kinds[i])
        total += more
    return total, vector


def backward(kinds: bytes, low: int, high: int, state: int) -> tuple[int, tuple[int, ...]]:
    """Least costs by state before the turns low..high to end in ``state``."""
    total, vector = 0, tuple(0 if s == state else NEVER for s in range(4))
    for i in range(high - 1, low - 1, -1):
        more, vector = _backward_step(vector, kinds[i])
        total += more
    return total, vector


def letters(kinds: bytes, low: int, high: int, first: int, last: int) -> str:
    """The least audit of the cheapest edits of turns low..high between two states."""
    if high == low:
        return ""
    if high - low == 1:
        return LETTERS[kinds[low]][first, last]
    middle = (low + high) // 2
    _, ahead = forward(kinds, low, middle, entry(first))
    _, back = backward(kinds, middle, high, last)
    crossing = min((s for s in range(4) if ahead[s][0] < NEVER and back[s] < NEVER),
                   key=lambda s: (ahead[s][0] + back[s], ahead[s][1]))
    return letters(kinds, low, middle, first, crossing) + letters(kinds, middle, high, crossing, last)


def last_state(vector: Vector) -> int:
    """The state in which the cheapest, audit-least script passes its last turn."""
    return min((s for s in range(4) if vector[s][0] < NEVER),
               key=lambda s: (vector[s][0] + ENDS[s] * INSERT, vector[s][1]))


@remembered
def solved(kinds: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    total, vector = forward(kinds, 0, len(kinds), entry(START))
    last = last_state(vector)
    return (total + vector[last][0] + ENDS[last] * INSERT,
            letters(kinds, 0, len(kinds), START, last) + "I" * ENDS[last])


def edited(rows: list[dict], audit: str, state: int) -> list[dict]:
    """The turns that an audit makes of ``rows``, from ``state`` on."""
    out, left = [], iter(rows)
    for edit in audit:
        row = {"role": "", "text": ""} if edit == "I" else next(left)
        if edit == "D":
            continue
        initial = _needed(state) if edit in "IR" else INITIALS.index(row["role"][0])
        role = row["role"] if edit == "K" else ("user", "assistant")[initial - 1]
        out.append({"edit": edit, "role": role, "text": row["text"]})
        state = _then(state, initial)
    return out


def fault_of(text: str, seen: bool) -> str | None:
    """The first fault of a turn."""
    if not _BLANK.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return None if text.rstrip(_SPACES)[-1] in ".!?" else "truncated"


def kind_of(role: str, fault: str | None) -> int:
    if fault in ("blank", "duplicate"):
        return GONE
    initial = INITIALS.find(role[:1]) if role else -1
    return (initial if initial >= 0 else OTHER) + (TRUNCATED if fault else 0)


def counts(rows: list[dict], faults: list[str | None]) -> dict:
    """Faults, illegal neighbours and what gaps need, of consecutive turns."""
    initials = [r["role"][:1] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return {"blank": faults.count("blank"), "duplicate": faults.count("duplicate"),
            "truncated": faults.count("truncated"),
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "least": turns[0] if turns else None, "most": turns[-1] if turns else None, "distinct": len(set(turns)),
            "head": initials[0], "tail": initials[-1]}


def _gaps(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else most - least + 1 - distinct


_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_REPORT = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
_KEY = [("conv_id", pa.int64()), ("part", pa.int32()), ("at", pa.int32())]
FIRST = pa.schema([*_KEY, *_REPORT, ("audit", pa.string()), ("turns", pa.list_(_TURN)), ("open", pa.list_(pa.struct(
    [("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])))])
_SQL_TURNS = "array<struct<edit: string, role: string, text: string>>"
_SQL_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_SQL_KEY = "conv_id long, part int, at int"


def _whole(piece_rows: int):
    """Repairs the conversations that lie inside a task; gives pieces of the rest."""
    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pieces(batches, lambda r: r["conv_id"], lambda r: len(r["text"]) + len(r["role"]), piece_rows)
        out: list[dict] = []
        held = 0
        for whole, at, rows in found:
            row = {"conv_id": rows[0]["conv_id"], "part": rows[0]["part"], "at": at}
            if whole:
                seen: set[tuple[str, str]] = set()
                faults = []
                for r in rows:
                    faults.append(fault_of(r["text"], (r["role"], r["text"]) in seen))
                    seen.add((r["role"], r["text"]))
                cost, audit = solved(bytes(map(kind_of, (r["role"] for r in rows), faults)))
                n = counts(rows, faults)
                row |= {k: n[k] for k in ("blank", "duplicate", "truncated", "illegal")}
                row |= {"gaps": _gaps(n["least"], n["most"], n["distinct"]), "cost": cost, "audit": audit,
                        "turns": edited(rows, audit, START)}
            else:
                row["open"] = [{k: r[k] for k in ("turn", "role", "text")} for r in rows]
            out.append(row)
            held += sum(len(r["text"]) for r in rows)
            if held > 1 << 20 or len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, FIRST)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, FIRST)
    return rows_of


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict], list[str | None]]]:
    """(row, turns, faults) of each piece; places seen earlier are in ``repeats``."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            again = set(row["repeats"] or ())
            yield row, row["open"], [fault_of(r["text"], j in again) for j, r in enumerate(row["open"])]


LINK = pa.schema([*_KEY, *[(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "least", "most",
                                                    "distinct")],
                  ("head", pa.string()), ("tail", pa.string()), ("first_turn", pa.int64()),
                  ("costs", pa.list_(pa.int64())), ("orders", pa.list_(pa.int64()))])
_SQL_LINK = (f"{_SQL_KEY}, blank long, duplicate long, truncated long, illegal long, least long, most long, "
             "distinct long, head string, tail string, first_turn long, costs array<long>, orders array<long>")


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece, its counts and its least costs between all states."""
    for row, turns, faults in _piece_rows(batches):
        kinds = bytes(map(kind_of, (r["role"] for r in turns), faults))
        costs, orders = [], []
        for s in range(4):
            total, vector = forward(kinds, 0, len(kinds), entry(s))
            costs += [total + cost if cost < NEVER else NEVER for cost, _ in vector]
            orders += [order for _, order in vector]
        out = {k: row[k] for k in ("conv_id", "part", "at")} | counts(turns, faults)
        out |= {"first_turn": turns[0]["turn"], "costs": costs, "orders": orders}
        yield pa.RecordBatch.from_pylist([out], LINK)


CHAIN = pa.schema([*_KEY, ("first", pa.int32()), ("last", pa.int32()), ("ending", pa.bool_()), *_REPORT])
_SQL_CHAIN = (f"{_SQL_KEY}, first int, last int, ending boolean, gaps long, blank long, duplicate long, "
              "truncated long, illegal long, cost long")


def crossings(links: list[dict]) -> tuple[list[int], int]:
    """The states at the cuts of a conversation's pieces, and the whole cost."""
    vector, before = entry(START), []
    for link in links:
        best: list = [None] * 4
        for a in range(4):
            for b in range(4):
                cost = link["costs"][4 * a + b]
                if vector[a][0] < NEVER and cost < NEVER:
                    move = (vector[a][0] + cost, (vector[a][1], link["orders"][4 * a + b]), a)
                    best[b] = move if best[b] is None else min(best[b], move)
        before.append([b and b[2] for b in best])
        vector = _ordered([b and b[:2] for b in best])
    last = last_state(vector)
    cost = vector[last][0] + ENDS[last] * INSERT
    states = [last]
    for back in reversed(before):
        states.append(back[states[-1]])
    return states[::-1], cost


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Crossings of each conversation's pieces, read in order."""
    def chain(links: list[dict]) -> pa.RecordBatch:
        states, cost = crossings(links)
        out = [{k: x[k] for k in ("conv_id", "part", "at")} | {"first": a, "last": b, "ending": False}
               for x, a, b in zip(links, states, states[1:])]
        some = [x for x in links if x["least"] is not None]
        joined = sum(a["most"] == b["first_turn"] for a, b in zip(links, links[1:]) if a["most"] is not None)
        illegal = sum(a["tail"] + b["head"] not in ("su", "ua", "au") for a, b in zip(links, links[1:]))
        out[-1] |= {k: sum(x[k] for x in links) for k in ("blank", "duplicate", "truncated", "illegal")}
        out[-1]["illegal"] += illegal
        out[-1] |= {"ending": True, "cost": cost, "gaps": _gaps(
            some[0]["least"] if some else None, some[-1]["most"] if some else None,
            sum(x["distinct"] for x in links) - joined)}
        return pa.RecordBatch.from_pylist(out, CHAIN)

    held: list[dict] = []
    for batch in batches:
        for link in batch.to_pylist():
            if held and held[0]["conv_id"] != link["conv_id"]:
                yield chain(held)
                held = []
            held.append(link)
    if held:
        yield chain(held)


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repairs each piece between its two crossings."""
    fields = pa.schema([*_KEY, ("audit", pa.string()), ("turns", pa.list_(_TURN))])
    for row, turns, faults in _piece_rows(batches):
        kinds = bytes(map(kind_of, (r["role"] for r in turns), faults))
        audit = letters(kinds, 0, len(kinds), row["first"], row["last"])
        audit += "I" * ENDS[row["last"]] if row["ending"] else ""
        yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("conv_id", "part", "at")} | {
            "audit": audit, "turns": edited(turns, audit, row["first"])}], fields)


def _same(*columns: str):
    """Join condition: the columns of ``l`` and ``r`` are the same, nulls too."""
    return F.expr(" AND ".join(f"l.{c} <=> r.{c}" for c in columns))


def repaired(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(report, pieces) of every conversation that has a row.

    report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    pieces: conv_id, part, at, turns (edit, role, text), whole: the repaired
    turns in order; ``whole`` conversations are one row, others (those that are
    long or at the edge of a task) pieces by (part, at).
    """
    rows = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    place = ["conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64)]
    first = kept(in_order(rows, place, ["conv_id", "turn", "role", "text"]).mapInArrow(
        _whole(piece_rows), f"{_SQL_KEY}, {_SQL_REPORT}, turns {_SQL_TURNS}, "
                "open array<struct<turn: long, role: string, text: string>>"), "cr-first")

    # conversations in pieces: turns seen in an earlier piece or place
    open_ = first.where("open IS NOT NULL").select("conv_id", "part", "at", "open")
    each = open_.select("conv_id", "part", "at", F.posexplode("open").alias("place", "r"))
    each = each.select("conv_id", "r.role", F.sha2("r.text", 256).alias("digest"),
                       F.struct("part", "at", "place").alias("where"))
    earliest = each.groupBy("conv_id", "role", "digest").agg(F.min("where").alias("where"))
    again = (each.alias("l").join(earliest.alias("r"), _same("conv_id", "where"), "left_anti")
             .select("conv_id", "where.*").groupBy("conv_id", "part", "at").agg(F.collect_list("place").alias("repeats")))
    key = ["conv_id", "part", "at"]
    work = kept(open_.alias("l").join(again.alias("r"), _same(*key), "left").select("l.*", "r.repeats"), "cr-open")
    links = work.mapInArrow(_links, _SQL_LINK)
    chains = kept(links.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(_chains, _SQL_CHAIN), "cr-chains")
    parts = kept(work.alias("l").join(chains.alias("r"), _same(*key))
                 .select("l.*", "r.first", "r.last", "r.ending")
                 .mapInArrow(_between, f"{_SQL_KEY}, audit string, turns {_SQL_TURNS}"), "cr-parts")

    whole = first.where("open IS NULL")
    # the audit is one string of a letter a turn
    audits = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "at", "audit"))).alias("a"))
    totals = (chains.where("ending").alias("l").join(audits.alias("r"), _same("conv_id"))
              .select("l.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                      F.array_join("r.a.audit", "").alias("audit")))
    report = whole.select(*totals.columns).unionByName(totals)
    return report, (whole.select(*key, "turns", F.lit(True).alias("whole"))
                    .unionByName(parts.select(*key, "turns", F.lit(False).alias("whole"))))


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the repaired ``role:text`` lines of each conversation."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    whole = parts.where("whole").select("conv_id", F.sha2(lines, 256).alias("sha256"))
    # the others piece by piece; pieces without a turn leave no line
    pieced = parts.where("NOT whole")
    none = (pieced.groupBy("conv_id").agg(F.max(F.size("turns")).alias("n")).where("n = 0")
            .select("conv_id", F.sha2(F.lit(""), 256).alias("sha256")))
    some = pieced.where("size(turns) > 0").select("conv_id", "part", "at", lines.alias("text"))
    return whole.unionByName(none).unionByName(chained_digests(some, ["conv_id"], "\n"))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with one row in twenty dropped, one emptied, one
    without sentence ends, one repeated and one given to the user, by a checksum
    of ``conv_id:turn``.  Nulls are one space."""
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    draw = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    return (turns.select("conv_id", "turn", text["role"].alias("role"), text["text"].alias("text"), draw.alias("draw"))
            .where("draw <> 0")
            .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.expr("array_repeat(0, if(draw = 3, 2, 1))")).alias("copy")).drop("copy"))
