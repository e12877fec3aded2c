import datetime
import hashlib
import random
import re
import time

import pytest

from barrio.llm import pii as P
from tests.llm.helpers import SCHEMA, odd_rows


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in P.pseudonymised(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def test_formats_stay_valid_and_values_linked(spark):
    cards = ["4785380592391139", "4041894974608795", "5500 0000 0000 0004", "4111-1111-1111-1111"]
    texts = [f"card {c}, again ({c})." for c in cards]
    texts += ["call +1 (415) 555-2671 or (415) 555-2671 or 415-555-2671", "+49 30 901820 and +1 (104) 555-3296",
              "at 152.143.123.131 and 152.143.123.131", "born 1985-02-28, 28.02.1985 and 02/28/1985",
              "ssn 123-45-6789", "DE89370400440532013000 or DE89 3704 0044 0532 0130 00",
              "Mail To.Me+x@mail8.example.com", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" PASSWORD=e3b3ed3cc8548923d6',
              "+1 (269) 555-3296 4524132264652876"]
    got = replaced(spark, texts)
    for card, text in zip(cards, got):
        a, b = re.fullmatch(r"card (.*), again \((.*)\)\.", text).groups()
        assert a == b != card and luhn(re.sub(r"\D", "", a)) and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", card)
    phones = re.fullmatch(r"call \+1 \((...)\) (...)-(....) or \((...)\) (...)-(....) or (...)-(...)-(....)", got[4]).groups()
    assert phones[:3] == phones[3:6] == phones[6:] != ("415", "555", "2671") and phones[0] >= "200" <= phones[1]
    assert re.fullmatch(r"\+49 \d\d \d{6} and \+1 \(\d{3}\) \d{3}-\d{4}", got[5]) and "555-3296" not in got[5]
    ip = re.fullmatch(r"at (\S+) and (\S+)", got[6]).groups()
    assert ip[0] == ip[1] != "152.143.123.131" and all(int(x) < 256 for x in ip[0].split("."))
    y, m, d = re.fullmatch(r"born (\d{4})-(\d\d)-(\d\d), \3\.\2\.\1 and \2/\3/\1", got[7]).groups()
    assert "1900" <= y <= "2099" and (y, m, d) != ("1985", "02", "28")
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4}", got[8]) and got[8] != texts[8]
    one, two = got[9].split(" or ")
    assert one == two.replace(" ", "") != texts[9][:22] and int(one[4:] + "1314" + one[2:4]) % 97 == 1
    assert re.fullmatch(r"Mail u[0-9a-f]{16}@example\.invalid", got[10])
    assert re.fullmatch(r'token = "[0-9a-f]{40}" PASSWORD=[0-9a-f]{18}', got[11]) and "24be6443" not in got[11]
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} \d{16}", got[12]) and luhn(got[12][-16:])
    assert replaced(spark, texts) == got != replaced(spark, texts, "other")


def test_invalid_values_and_clean_texts_stay(spark):
    texts = ["plain 1234567890123456 number", "300.1.2.3 and 1.2.3.4.5", "1985-02-30 and 1850-01-01", "000-12-3456",
             "DE88370400440532013000", "no data: 42 = 6 * 7 @ home", "", "version 3.14, page 12-34"]
    assert replaced(spark, texts) == texts


def test_network_is_a_permutation(spark):
    moved = P._feistel("k", "t", "id div 11", "id % 11", "7", "11")
    got = spark.range(77).selectExpr(f"{moved} AS f").selectExpr("f.l * 11 + f.r AS x").collect()
    assert sorted(r.x for r in got) == list(range(77)) and [r.x for r in got] != list(range(77))


def test_dates_are_permuted_among_themselves(spark):
    days = spark.sql("SELECT explode(sequence(date'1999-11-01', date'2000-04-01')) AS d").selectExpr(
        "cast(d as string) AS text")
    got = [r.text for r in P.pseudonymised(days, "k").collect()]
    assert len(set(got)) == len(got) == 153 and all(re.fullmatch(r"(19|20)\d\d-[01]\d-[0-3]\d", x) for x in got)


def test_odd_rows_and_columns(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumnRenamed("score", "m").withColumnRenamed("source", "d")
    out = P.pseudonymised(df, "k", count_col="n")
    assert out.columns == df.columns + ["n"]
    assert sorted(map(str, out.select(df.columns).collect())) == sorted(map(str, df.collect()))
    assert P.pseudonymised(df.limit(0), "k").count() == 0


def test_accounts_with_letters_and_phones_in_any_groups(spark):
    accounts = ["NL91ABNA0417164300", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606",
                "AT61 1904 3002 3457 3201", "NO9386011117947"]
    phones = ["+33 1 42 68 53 00", "+33 6 12 34 56 78", "+44 20 7946 0958", "4155552671"]
    texts = [f"pay {a} NOW or {a}." for a in accounts] + [f"call {p}, or {p}." for p in phones]
    texts += ["+33 1 42 68 53 00 4111 1111 1111 1111", "+49 30 901820 4111 1111 1111 1111"]
    got = replaced(spark, texts)
    for old, text in zip(accounts, got):
        a, b = re.fullmatch(r"pay (.*) NOW or (.*)\.", text).groups()
        assert a == b != old and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", old)
        c = a.replace(" ", "")
        assert int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1
    for old, text in zip(phones, got[len(accounts):]):
        a, b = re.fullmatch(r"call (.*), or (.*)\.", text).groups()
        assert a == b != old and re.sub(r"\d", "9", a) == re.sub(r"\d", "9", old) and a[:3] == old[:3] or old[0] == "4"
    for old, text in zip(texts[-2:], got[-2:]):
        assert luhn(re.sub(r"\D", "", text[-19:])) and text[-19:] != old[-19:] and text[:-20] != old[:-20]
    stay = ["NL92ABNA0417164300", "GB28 NWBK 6016 1331 9268 19", "order 1234567890", "id x4155552671"]
    assert replaced(spark, stay) == stay


# ------------------------------------------- the same pseudonyms in plain Python


def network(key, kind, left, right, a, b):
    def h(step, x):
        return int(hashlib.sha256(f"{key}|{kind}|{step}|{a}|{x}".encode()).hexdigest()[:15], 16)
    for step in range(1, P.STEPS + 1):
        if step % 2:
            left = (left + h(step, right)) % a
        else:
            right = (right + h(step, left)) % b
    return left, right


def moved_digits(key, kind, digits):
    half = len(digits) // 2
    left, right = network(key, kind, int(digits[:half]), int(digits[half:]), 10 ** half, 10 ** (len(digits) - half))
    return f"{left:0{half}}{right:0{len(digits) - half}}"


def put(match, digits):
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in match)


def north_american(key, d):
    left, right = network(key, "phone", (int(d[-10:-7]) - 200) * 800 + int(d[-7:-4]) - 200, int(d[-4:]), 640000, 10000)
    return f"{d[:-10]}{left // 800 + 200}{left % 800 + 200}{right:04}"


def plain(key, m):
    """The replacement of a match."""
    d = re.sub("[^0-9]", "", m)
    digest = lambda x: hashlib.sha256(f"{key}|text|{x}".encode()).hexdigest()
    if re.match(r"[A-Za-z_-]+\s?[=:]", m):
        head = re.match(r'[^=:]*[=:]\s?"?', m)[0]
        value = m[len(head):]
        return head + (digest(value) * (len(m) // 64 + 1))[:len(value)]
    if "@" in m:
        lead = re.match("[._%+-]*", m)[0]
        return f"{lead}u{digest(m[len(lead):].lower())[:16]}@example.invalid"
    if m[0].isalpha():
        number = lambda x: int("".join(str(int(c, 36)) for c in x.replace(" ", ""))) % 97
        if len(d) < 4 or number(m[4:] + m[:4]) != 1:
            return m
        tail = put(m[4:], moved_digits(key, "iban", d[2:]))
        return f"{m[:2]}{98 - number(tail + m[:2] + '00'):02}{tail}"
    ten = len(d) >= 10 and d[-10:-7] >= "200" and d[-7:-4] >= "200"
    if m[0] == "+":
        if not 8 <= len(d) <= 15:
            return m
        if m[1] == "1" and len(d) == 11 and ten:
            return put(m, north_american(key, d))
        code = re.match(r"\+([0-9]{1,3})", m)[1]
        return put(m, code + moved_digits(key, "phone-digits", d[len(code):]))
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", m):
        q = list(map(int, m.split(".")))
        if max(q) > 255:
            return m
        left, right = network(key, "ip", q[0] * 256 + q[1], q[2] * 256 + q[3], 65536, 65536)
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    if re.fullmatch(r"\d{4}-..-..|..[./]..[./]\d{4}", m):
        forms = ["%Y-%m-%d"] if m[4] == "-" else [f"%d{m[2]}%m{m[2]}%Y", f"%m{m[2]}%d{m[2]}%Y"]
        for form in forms:
            try:
                day = (datetime.datetime.strptime(m, form).date() - datetime.date(1900, 1, 1)).days
            except ValueError:
                continue
            if 0 <= day < 229 * 319:
                left, right = network(key, "date", day // 319, day % 319, 229, 319)
                return (datetime.date(1900, 1, 1) + datetime.timedelta(left * 319 + right)).strftime(form)
        return m
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", m):
        a, b, c = map(int, m.split("-"))
        if a in (0, 666) or a >= 900 or not b or not c:
            return m
        left, right = network(key, "ssn", a - 2 if a > 666 else a - 1, (b - 1) * 9999 + c - 1, 898, 99 * 9999)
        return f"{left + 2 if left >= 665 else left + 1:03}-{right // 9999 + 1:02}-{right % 9999 + 1:04}"
    if len(d) > 10:
        if not luhn(d):
            return m
        body = d[0] + moved_digits(key, "card", d[1:-1])
        return put(m, body + next(c for c in "0123456789" if luhn(body + c)))
    return put(m, north_american(key, d)) if ten else m


def random_value(rng):
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    card = digits(15)
    card += next(c for c in "0123456789" if luhn(card + c))
    iban = digits(18)
    iban = f"DE{98 - int(iban + '131400') % 97:02}{iban}"
    day = datetime.date(1890, 1, 1) + datetime.timedelta(rng.randrange(80000))
    return rng.choice([
        card, " ".join(card[i:i + 4] for i in range(0, 16, 4)), digits(16), iban, f"{iban[:4]} {iban[4:8]} {iban[8:]}",
        "DE" + digits(20), f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+{rng.randrange(30, 99)} {digits(3)} {digits(6)}",
        f"({digits(3)}) {digits(3)}-{digits(4)}", digits(10), ".".join(str(rng.randrange(300)) for _ in range(4)),
        day.isoformat(), day.strftime("%d.%m.%Y"), day.strftime("%m/%d/%Y"), f"{digits(3)}-{digits(2)}-{digits(4)}",
        f"me.{digits(2)}@mail.example.org", f"-X+{digits(1)}@a-b.co.uk.", f"token = \"{digits(40)}\"", f"Password:{digits(9)}x",
        digits(rng.randrange(1, 9)), "word", "x@y", "3.14", "\uE000"])


def test_every_format_equals_plain_python(spark):
    rng = random.Random(11)
    texts = [rng.choice([" ", ", ", "; "]).join(random_value(rng) for _ in range(rng.randrange(1, 9))) for _ in range(500)]
    pattern = re.compile(P.PATTERN)
    expected = [(pattern.sub(lambda m: plain("k", m[0]), t), sum(plain("k", m[0]) != m[0] for m in pattern.finditer(t)))
                for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = P.pseudonymised(df, "k", count_col="n").orderBy("doc_id").collect()
    wrong = [(t, e, (r.text, r.n)) for t, e, r in zip(texts, expected, got) if e != (r.text, r.n)]
    assert not wrong, wrong[:3]
    assert sum(n for _, n in expected) > 500 and sum("\uE000" in t for t in texts) > 20


def test_counts_only_replaced_values(spark):
    df = spark.createDataFrame([(1, "4111 1111 1111 1112 and 4111 1111 1111 1111 and 300.1.1.1")], "id int, text string")
    assert P.pseudonymised(df, "k", count_col="n").first().n == 1


def test_a_key_is_required(spark):
    with pytest.raises((TypeError, ValueError)):
        P.pseudonymised(spark.createDataFrame([(1, "x")], "id int, text string"), "")
    with pytest.warns(UserWarning, match="not set"):
        P.key_of(spark)
    spark.conf.set(P.KEY_SETTING, "mine")
    try:
        assert P.key_of(spark) == "mine"
    finally:
        spark.conf.unset(P.KEY_SETTING)


LONG = ["a", "a.", "1", "1 ", "+1", "1-", "1.", "a@", "x@a.", "AA11", "DE12 ", "+12345 ", "(123) ", "12/", "password",
        "key=", "a-", "1234 ", "%", "@", "1 2-3 "]


@pytest.mark.parametrize("unit", LONG)
def test_a_megabyte_without_a_break_takes_linear_time(spark, unit):
    texts = [unit * (1_000_000 // len(unit)), "x@" + unit * (1_000_000 // len(unit)) + "1"]
    start = time.time()
    got = replaced(spark, texts)
    assert time.time() - start < 20 and len(got) == 2        # two of them: a second or two; quadratic is hours


def test_columns_of_the_same_names(spark):
    df = spark.createDataFrame([(1, "call +33 1 42 68 53 00", "p", "q")], "id int, text string, PIECES string, `a.b` string")
    out = P.pseudonymised(df, "k", count_col="pieces_")
    assert out.columns == df.columns + ["pieces_"]
    r = out.first()
    assert r.PIECES == "p" and r["a.b"] == "q" and r["pieces_"] == 1 and r.text != "call +33 1 42 68 53 00"
