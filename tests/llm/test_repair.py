import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from barrio.llm import oracles_conversations, queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, cost string"


def plain_audit(kinds):
    """All edit scripts, cheapest first, by breadth: (cost, audit)."""
    # kinds: (initial, gone, truncated)
    best = {(0, ""): (0, "")}
    good = re.compile(r"(s?(ua)*u?)?")
    tail = {"": "", "s": "s", "u": "u", "a": "a"}

    def grown(states):
        out = dict(states)
        for _ in range(3):
            for (_, last), (cost, audit) in list(out.items()):
                for role in "ua":
                    seq = last + role
                    if good.fullmatch(seq if last in "s" else ("u" + role if last == "u" else "ua" + role)):
                        move = (cost + 2, audit + "I")
                        key = (0, tail[role])
                        out[key] = min(out.get(key, move), move)
        return out

    def fits(last, role):
        return {"": role in "su", "s": role == "u", "u": role == "a", "a": role == "u"}[last]

    for initial, gone, truncated in kinds:
        new = {}
        for (_, last), (cost, audit) in grown(best).items():
            moves = [(last, cost + 3, "D")]
            if not gone:
                if initial in ("s", "u", "a") and fits(last, initial):
                    moves.append((initial, cost + truncated, "K"))
                moves += [(r, cost + 2 + truncated, "R") for r in "ua" if fits(last, r)]
            for role, c, letter in moves:
                move = (c, audit + letter)
                new[0, role] = min(new.get((0, role), move), move)
        best = new
    ends = grown(best)
    return min(v for (_, last), v in ends.items() if last in ("", "a"))


def test_audits_equal_plain_search():
    kinds = [(i, g, t) for i in "suax" for g, t in ((0, 0), (0, 1))] + [("s", 1, 0)]
    codes = {k: repair.GONE if k[1] else "suax".index(k[0]) + repair.TRUNCATED * k[2] for k in kinds}
    cases = [c for n in range(4) for c in itertools.product(kinds, repeat=n)]
    rng = random.Random(3)
    cases += [tuple(rng.choice(kinds) for _ in range(rng.randrange(4, 60))) for _ in range(400)]
    for case in cases:
        assert repair.solved(bytes(codes[k] for k in case)) == plain_audit(case), case


def test_pieces_meet_in_the_same_states():
    rng = random.Random(4)
    for _ in range(200):
        kinds = bytes(rng.randrange(9) for _ in range(rng.randrange(1, 80)))
        cuts = sorted({0, len(kinds), *[rng.randrange(len(kinds) + 1) for _ in range(4)]})
        links = []
        for a, b in zip(cuts, cuts[1:]):
            costs, orders = [], []
            for s in range(4):
                total, vector = repair.forward(kinds, a, b, repair.entry(s))
                costs += [total + c if c < repair.NEVER else repair.NEVER for c, _ in vector]
                orders += [o for _, o in vector]
            links.append({"costs": costs, "orders": orders})
        states, cost = repair.crossings(links)
        audit = "".join(repair.letters(kinds, a, b, p, q)
                        for a, b, p, q in zip(cuts, cuts[1:], states, states[1:])) + "I" * repair.ENDS[states[-1]]
        assert (cost, audit) == repair.solved(kinds)


def odd_rows():
    rng = random.Random(5)
    roles, texts = ["system", "user", "assistant", "tool", "", None], ["Yes.", "No", " \n", "", None, "What? ", "Fine!", "é…"]
    rows = [(c, t, rng.choice(roles[:3] * 4 + roles), rng.choice(texts) if rng.random() < .5 else f"turn {t} of {c}.", "x")
            for c in range(80) for t in range(rng.randrange(1, 12))]
    rows += [(100, None, "user", "Hello.", "x"), (100, None, None, "Hello.", "x"), (100, 5, "user", "Hi.", "x"),
             (101, None, None, None, None), (None, 1, "user", "Hi there.", "x"), (None, 2, "assistant", "Yes.", "x")]
    rows += rows[:9]                                                           # repeated rows
    rows += [(102, 1, "user", "word " * 100000 + ".", "x"), (102, 2, "assistant", "Yes.", "x")]
    # a conversation that holds most rows, with turns seen again far apart
    rows += [(7, t, ("user", "assistant")[t % 2] if t % 7 else "system", f"Text {t % 300}" + "." * (t % 5 > 0), "x")
             for t in range(20, 1500, 1)]
    return rows


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR, cost VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?, ?)", rows)
    got = con.execute(oracles_conversations.OP13)
    names = [d[0] for d in got.description]
    return names, sorted(got.fetchall(), key=repr)


@pytest.mark.parametrize("piece_rows", [7, 1024])
def test_query_equals_sql_on_odd_rows(spark, tmp_path, monkeypatch, piece_rows):
    rows = odd_rows()
    names, expected = by_sql(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(f"{tmp_path}/conversations.parquet")
    plain = repair.repaired
    monkeypatch.setattr(repair, "repaired", lambda turns: plain(turns, piece_rows=piece_rows))
    got = queries.op13_conversation_repair(spark, str(tmp_path)).select(*names)
    assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_repair(spark, str(tmp_path)).count() == 0


def test_repaired_turns_alternate(spark):
    report, pieces = repair.repaired(spark.createDataFrame(odd_rows(), SCHEMA))
    turns = (pieces.select("conv_id", "part", "at", F.posexplode("turns").alias("place", "t"))
             .orderBy("part", "at", "place").collect())
    for conv, group in itertools.groupby(sorted(turns, key=lambda r: r.conv_id if r.conv_id is not None else -1),
                                         key=lambda r: r.conv_id):
        assert re.fullmatch(r"(s?(ua)+)?", "".join(r.t.role[0] for r in group)), conv
    assert report.count() == len({r[0] for r in odd_rows()})


def test_damage_draws_by_checksum(spark):
    turns = spark.createDataFrame([(c, t, "assistant", f"A b. C? {c}!", "x") for c in range(40) for t in range(5)], SCHEMA)
    expected = []
    for c in range(40):
        for t in range(5):
            draw = zlib.crc32(f"{c}:{t}".encode()) % 20
            text = f"A b. C? {c}!"
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            expected += [(c, t, "user" if draw == 4 else "assistant", text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    assert sorted(map(tuple, repair.damaged(turns).collect())) == sorted(expected)


def test_digest_of_pieces(spark):
    report, pieces = repair.repaired(spark.createDataFrame(odd_rows(), SCHEMA), piece_rows=5)
    lines = {}
    for r in pieces.orderBy("part", "at").collect():
        lines.setdefault(r.conv_id, []).extend(f"{t.role}:{t.text}" for t in r.turns)
    got = {r.conv_id: r.sha256 for r in repair.digests(pieces).collect()}
    assert got == {c: hashlib.sha256("\n".join(x).encode()).hexdigest() for c, x in lines.items()}
