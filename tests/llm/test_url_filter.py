import itertools
import math
import random
import time

import pyarrow as pa
from pyspark.sql import functions as F

from barrio.llm import url_filter as U
from barrio.llm.queries import URL_RULES

URLS = ["http://a.com/x", "https://Example.COM/en/1", "http://www.example.com/en/2?q=1", "http://b.www.example.com/en/",
        "http://sub.example.com/en/1", "http://sub.example.com/de/1", "http://n.net/es/1", "http://n.net/fr", "http://net/fr/",
        "http://n.net/en/1", "http://xcom/1", "http://a.com", "http://a.com?x/", "nothing", None, "", "://",
        "http://cheappills.example.org/en/1#a", "http://spam-farm.org/", "http://good-words.org/news/12", "x://y://com/z"]
VOCABULARY = [("cheap", 5), ("pills", 5), ("good", 50), ("words", 50), ("new", 30), ("news", 30), ("farm", 20), ("che", 1)]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = "".join(itertools.takewhile(lambda c: c not in "/?#", rest))
    path = "".join(itertools.takewhile(lambda c: c not in "?#", rest[len(host):]))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [(len(rule), verdict, rule) for verdict, rule in URL_RULES
            if ("." + host).endswith("." + rule[:rule.index("/")]) and path.startswith(rule[rule.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def test_parts_rules_and_verdicts(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[0], "x"), (0, URLS[0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = U.judged(pages, URL_RULES, spark.createDataFrame(VOCABULARY, "word string, n long")).collect()
    assert len(got) == len(rows)
    for r in got:
        url = URLS[r.page_id or 0]
        assert (r.host, r.path) == parts(url)
        verdict, rule = rule_of(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    by_id = {r.page_id: r for r in got}
    assert by_id[17].words == ["cheap", "pills", "example", "org"] and by_id[17].verdict == "block"
    assert by_id[18].verdict == "block" and by_id[19].verdict == "allow" and by_id[13].rule is None


def test_segmentation_is_the_best_cut():
    counts, total = dict(VOCABULARY), 200
    p = lambda w: math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10)
    for piece in ["cheappills", "goodnews", "newswords", "xgoodx", "farm", "q"]:
        known = [{"at": a, "length": n, "n": counts[piece[a:a + n]]} for a in range(len(piece))
                 for n in range(1, len(piece) - a + 1) if piece[a:a + n] in counts]
        batch = pa.RecordBatch.from_pylist([{"piece": piece, "known": known, "total": total}])
        words = next(U._segment(iter([batch]))).column("words").to_pylist()[0]
        best = -math.inf
        for cuts in itertools.product([0, 1], repeat=len(piece) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(piece)]
            best = max(best, sum(p(piece[a:b]) for a, b in zip(at, at[1:])))
        assert "".join(words) == piece and abs(sum(map(p, words)) - best) < 1e-9


def test_cuts_equal_plain_viterbi():
    rng = random.Random(3)
    for _ in range(300):
        piece = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 40)))
        counts = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))): rng.randrange(1, 5000) for _ in range(12)}
        p = lambda w: max(math.log(counts.get(w, 1e-99) / 1e6), math.log(10 / 1e6) - len(w) * math.log(10))
        best = [0.0]
        for end in range(1, len(piece) + 1):
            best.append(max(best[at] + p(piece[at:end]) for at in range(end)))
        known = [(a, n, counts[piece[a:a + n]]) for a in range(len(piece)) for n in range(1, len(piece) - a + 1)
                 if piece[a:a + n] in counts]
        words = U._best_cut(piece, known, 1e6)
        assert "".join(words) == piece and abs(sum(map(p, words)) - best[-1]) < 1e-6


def test_long_hosts_and_long_words(spark):
    """A host of 40,000 letters takes seconds; words of 40 letters are words."""
    word = "supercalifragilisticexpialidociousnesses"
    pages = spark.createDataFrame([(1, "http://" + "goodnewsfarm" * 3400 + ".com/a"), (2, f"http://the{word}news.com/"),
                                   (3, "http://" + "z" * 40000 + "/")], "page_id long, url string")
    vocabulary = spark.createDataFrame([*VOCABULARY, (word, 3), ("the", 900)], "word string, n long")
    start = time.time()
    got = {r.page_id: r.words for r in U.judged(pages, [], vocabulary).collect()}
    assert time.time() - start < 60
    assert got[1] == ["good", "news", "farm"] * 3400 + ["com"] and got[2] == ["the", word, "news", "com"]
    assert got[3] == ["z" * 40000]


def test_bayes_scores(spark):
    pages = spark.createDataFrame([(1, "http://spam.x/a"), (2, "http://spam.x/b"), (3, "http://ok.x/a"),
                                   (4, "http://ok.x/a"), (5, "http://new.x/b")], "page_id long, url string")
    got = {r.page_id: r.score for r in U.judged(pages, [], spark.createDataFrame(
        [("spam", 9), ("ok", 9), ("new", 9), ("x", 9)], "word string, n long")).collect()}
    bad, good = {"spam": 2, "x": 2, "/a": 1, "/b": 1}, {"ok": 2, "new": 1, "x": 3, "/a": 2, "/b": 1}
    tokens = len(set(bad) | set(good))
    odds = lambda t: math.log((bad.get(t, 0) + 1) / (6 + tokens + 1)) - math.log((good.get(t, 0) + 1) / (9 + tokens + 1))
    for page, words in {1: ["spam", "x", "/a"], 3: ["ok", "x", "/a"], 5: ["new", "x", "/b"]}.items():
        assert abs(got[page] - (math.log(3 / 4) + sum(map(odds, words)))) < 1e-9


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(empty, URL_RULES, spark.createDataFrame([], "word string, n long")).count() == 0


def test_words_do_not_change_with_the_size_of_the_vocabulary(spark):
    hosts = {"onlinepoker.com": ["online", "poker"], "cheappills.com": ["cheap", "pills"], "zuqocasinos.com": ["zuqo", "casinos"],
             "hackerzone.com": ["hacker", "zone"], "mygardennews.com": ["my", "garden", "news"]}
    pages = spark.createDataFrame([(i, f"http://{h}/a") for i, h in enumerate(hosts)], "page_id long, url string")
    share = {"com": 0.02, "my": 0.01, "garden": 0.001, "news": 0.002, "zone": 0.001}
    for size in (10 ** 4, 10 ** 6, 10 ** 9, 10 ** 12):
        words = [(w, int(p * size)) for w, p in share.items()] + [("the", int(size * (1 - sum(share.values()))))]
        got = {r.host: r for r in U.judged(pages, [], spark.createDataFrame(words, "word string, n long")).collect()}
        for host, cut in hosts.items():
            assert got[host].words == [*cut, "com"], (size, host, got[host].words)
        assert [h for h, r in got.items() if r.verdict == "allow"] == ["mygardennews.com"]


def test_forms_of_seeds():
    forms = U.inflected(U.SEEDS)
    assert {"casinos", "hacking", "hackers", "pill", "betting", "spammers", "gamblers", "gamble", "bets"} <= set(forms)
    assert "better" not in forms and "hackk" not in forms and set(U.SEEDS) <= set(forms)
