"""Small inputs with nulls, empties, repeats, long texts and clashing columns."""
import random

WORDS = r"[^\x20\x09-\x0D]+"


def texts(seed: int, n: int = 60) -> list[str]:
    """Prose of a few words, with exact and near copies and shared passages."""
    rng = random.Random(seed)
    words = [a + b for a in "ba do fi gu ke lo".split() for b in "ra ni to mu se".split()]
    passage = [rng.choice(words) for _ in range(70)]
    out: list[str] = []
    for i in range(n):
        kind = i % 6
        if kind == 1 and out:
            out.append(out[rng.randrange(len(out))])
        elif kind == 2 and out:
            w = out[rng.randrange(len(out))].split(" ")
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(words).upper()
            out.append(" ".join(w))
        elif kind == 3:
            at = rng.randrange(10)
            own = [rng.choice(words) for _ in range(rng.randrange(0, 80))]
            out.append(" ".join(own[:40] + passage[at:at + rng.randrange(45, 60)] + own[40:]))
        else:
            out.append(rng.choice([" ", "\n", "\t \x0b"]).join(
                rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 30, 120, 200]))))
    return out


def odd_rows(seed: int = 1) -> list[tuple]:
    """(doc_id, text, source, a column with a clashing name)"""
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(texts(seed))]
    rows += [(1000, None, "s1"), (1001, "", "s1"), (1002, " \n ", None), (1003, rows[0][1], None),
             (1003, rows[0][1], None), (None, rows[3][1], "s2"), (None, None, None), (1004, "É café é́", "é"),
             (1005, "w " * 30000 + rows[3][1], "s0")]
    return [(*r, "x") for r in rows]


SCHEMA = "doc_id long, text string, source string, score string"
