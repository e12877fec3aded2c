r"""Format-preserving pseudonyms for personal data, in SQL expressions.

Validated numbers and dates are permuted within their own format by a keyed
Feistel network, so a pseudonym is as valid as what it replaces and equal
values get equal pseudonyms in every document:

* payment cards: 13-19 digits with a right check digit; the first digit stays,
  the others are permuted, the check digit is computed anew
* bank accounts (IBAN of each country's length): the account digits are
  permuted, letters stay, the two check digits are computed anew
* phone numbers: 10 digits with valid area and exchange codes (also without
  separators) map to such; after ``+`` 8 to 15 digits in any groups keep
  their country code; all keep their punctuation
* social security numbers (ddd-dd-dddd with valid parts), IPv4 addresses (a
  permutation of all addresses), dates from 1900 to 2099 (yyyy-mm-dd,
  dd.mm.yyyy, dd/mm/yyyy or mm/dd/yyyy; a permutation of those days)

Values without a number format get a keyed digest: e-mail addresses a local
part at a reserved domain, passwords, tokens and keys as many hex digits.
Numbers that are not valid in one of the formats stay.  The key is the
caller's secret: whoever knows it can undo the permutations.

The network alternates between a value's halves l in [0, a) and r in [0, b):
l += H(key, kind, step, r) mod a, then r += H(key, kind, step, l) mod b.  Each
step can be undone, so it permutes all a * b values.

The pattern is searched once in each text that has a digit, ``@``, ``=`` or
``:`` at all; the pieces between the matches and the changed matches are
joined again.  Row by row, nothing is shuffled.  A null text stays null, an
empty one empty; ids are not read, so null and repeated ids are as any
others; other columns pass unchanged.  DataFrame functions only.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barrio.llm.tables import col, unused

STEPS = 10
KEY_SETTING = "spark.barrio.pseudonym.key"
DEMO_KEY = "no secret: for runs on made-up data"
MARK = "\uE000"              # stands around each match while a text is searched

# Countries by the length of their account numbers.
IBAN = {15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
        22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL",
        24: "AD|CZ|DZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
        27: "BF|BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD", 28: "AL|AZ|BJ|BY|CI|CY|DO|GT|GW|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG",
        29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
_ACCOUNT = "|".join(f"(?:{who})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, who in IBAN.items())
_CARD_NEXT = "[ .-][0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])"
# Formats looked for, in order of precedence.
# Runs are possessive and start where no character of the run stands before, so
# a text of any length is read once; groups that repeat are bounded.
FORMATS = [
    r'(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\s?[=:]\s?"?[^\s"]{8,}+)',
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}+\.){1,127}[A-Za-z]{2,}+",
    rf"(?<![A-Za-z0-9])(?:{_ACCOUNT})(?![0-9A-Za-z])",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[0-9]{4}){3,6}(?: ?[0-9]{1,4})?(?![0-9A-Za-z])",
    r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,5}(?:(?!" + _CARD_NEXT + r")[ .-]?[0-9]{1,5}+){1,5}(?![0-9])",
    r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9]|[./-][0-9])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    r"(?<![0-9A-Za-z.,_/-])[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z_/-]|[.,][0-9])",
]
PATTERN = "|".join(FORMATS)
FIRST_DAY, DAYS = "1900-01-01", (229, 319)          # 229 * 319 days: up to 2099-12-31


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(key: str, kind: str, left: str, right: str, a: str, b: str) -> str:
    """A struct (l, r): the permuted pair of numbers in [0, a) and [0, b)."""
    def h(x: str) -> str:
        return (f"cast(conv(substring(sha2(concat({_sql(key + '|' + kind + '|')}, i, '|', {a}, '|', {x}), 256), 1, 15), "
                "16, 10) as bigint)")
    return (f"aggregate(sequence(1, {STEPS}), named_struct('l', cast({left} as bigint), 'r', cast({right} as bigint)), "
            f"(s, i) -> named_struct('l', if(i % 2 = 1, pmod(s.l + {h('s.r')}, {a}), s.l), "
            f"'r', if(i % 2 = 0, pmod(s.r + {h('s.l')}, {b}), s.r)))")


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _digits(key: str, kind: str, d: str) -> str:
    """The digit string ``d`` permuted among those of its length (2 to 34)."""
    half = f"(length({d}) div 2)"
    a = f"cast(rpad('1', {half} + 1, '0') as bigint)"
    b = f"cast(rpad('1', length({d}) - {half} + 1, '0') as bigint)"
    moved = _feistel(key, kind, f"substring({d}, 1, {half})", f"substring({d}, {half} + 1)", a, b)
    return _let(moved, "f", f"concat(lpad(cast(f.l as string), {half}, '0'), "
                            f"lpad(cast(f.r as string), length({d}) - {half}, '0'))")


def _put(m: str, d: str) -> str:
    """The digits ``d`` in the places of the digits of ``m``."""
    return (f"aggregate(filter(split({m}, ''), c -> c <> ''), named_struct('s', '', 'k', 1), (t, c) -> "
            f"if(c between '0' and '9', named_struct('s', concat(t.s, substring({d}, t.k, 1)), 'k', t.k + 1), "
            "named_struct('s', concat(t.s, c), 'k', t.k)), t -> t.s)")


def _check_digit(p: str) -> str:
    """The digit that makes the digits ``p`` and itself a valid card number."""
    return (f"cast((10 - aggregate(transform(sequence(1, length({p})), i -> "
            f"if((length({p}) - i) % 2 = 0, "
            f"2 * cast(substring({p}, i, 1) as int) - if(substring({p}, i, 1) > '4', 9, 0), "
            f"cast(substring({p}, i, 1) as int))), 0, (x, y) -> x + y) % 10) % 10 as string)")


def _mod97(d: str) -> str:
    """The rest by 97 of digits and letters (A is 10, Z is 35)."""
    return (f"aggregate(split({d}, ''), 0, (x, c) -> case when c = '' then x "
            "when c >= 'A' then (x * 100 + ascii(c) - 55) % 97 else (x * 10 + cast(c as int)) % 97 end)")


def _pseudonym(key: str) -> str:
    """Of a match ``m`` with the digits ``d``, its replacement."""
    digest = f"sha2(concat({_sql(key + '|text|')}, {{0}}), 256)"
    value = "substring(m, length(p) + 1)"
    secret = _let(r"regexp_extract(m, '^[^=:]*[=:]\\s?\"?', 0)", "p",
                  f"concat(p, substring(repeat({digest.format(value)}, length(m) div 64 + 1), 1, length({value})))")
    # punctuation before an address is no part of it
    address = "lower(regexp_replace(m, '^[._%+-]+', ''))"
    email = (f"concat(regexp_extract(m, '^[._%+-]*', 0), 'u', substring({digest.format(address)}, 1, 16), "
             "'@example.invalid')")

    country, account = "substring(m, 1, 2)", "replace(substring(m, 5), ' ', '')"
    fresh = f"concat(replace(n, ' ', ''), {country}, '00')"
    iban = (f"if(length(d) > 3 and {_mod97(f'concat({account}, substring(m, 1, 4))')} = 1, "
            + _let(_put("substring(m, 5)", _digits(key, "iban", "substring(d, 3)")), "n",
                   f"concat({country}, lpad(cast(98 - {_mod97(fresh)} as string), "
                   "2, '0'), n)")
            + ", m)")

    ten = "substring(d, length(d) - 9)"
    area, exchange = f"substring({ten}, 1, 3)", f"substring({ten}, 4, 3)"
    moved = _feistel(key, "phone", f"(cast({area} as int) - 200) * 800 + cast({exchange} as int) - 200",
                     f"substring({ten}, 7)", "640000", "10000")
    valid_ten = f"{area} >= '200' and {exchange} >= '200'"
    north = _let(moved, "f", "concat(substring(d, 1, length(d) - 10), cast(f.l div 800 + 200 as string), "
                             "cast(f.l % 800 + 200 as string), lpad(cast(f.r as string), 4, '0'))")
    code = r"regexp_extract(m, '^\\+([0-9]{1,3})', 1)"
    rest = _let(code, "c", "concat(c, " + _digits(key, "phone-digits", "substring(d, length(c) + 1)") + ")")
    plus = (f"if(length(d) between 8 and 15, {_put('m', f'if(m like {_sql('+1%')} and length(d) = 11 and {valid_ten}, {north}, {rest})')}, m)")
    local = f"if({valid_ten}, {_put('m', north)}, m)"

    octets = "transform(split(m, '[.]'), o -> cast(o as int))"
    ip = _let(octets, "q", "if(forall(q, o -> o <= 255), " + _let(
        _feistel(key, "ip", "q[0] * 256 + q[1]", "q[2] * 256 + q[3]", "65536", "65536"), "f",
        "concat_ws('.', f.l div 256, f.l % 256, f.r div 256, f.r % 256)") + ", m)")

    def date(parse: str, form: str) -> str:
        a, b = DAYS
        day = f"datediff(t, date'{FIRST_DAY}')"
        moved = _feistel(key, "date", f"{day} div {b}", f"{day} % {b}", str(a), str(b))
        return _let(f"to_date({parse})", "t",
                    f"if({day} between 0 and {a * b - 1}, " + _let(
                        moved, "f", f"date_format(date_add(date'{FIRST_DAY}', cast(f.l * {b} + f.r as int)), "
                                    f"{form})") + ", null)")

    sep = "substring(m, 3, 1)"
    day_first = f"concat('dd', {sep}, 'MM', {sep}, 'yyyy')"
    month_first = f"concat('MM', {sep}, 'dd', {sep}, 'yyyy')"
    year, one, two = "substring(m, 7, 4)", "substring(m, 1, 2)", "substring(m, 4, 2)"
    dates = (f"coalesce(case when m like '____-%' then {date('try_cast(m as date)', _sql('yyyy-MM-dd'))} "
             f"else coalesce({date(f'try_cast(concat({year}, {_sql('-')}, {two}, {_sql('-')}, {one}) as date)', day_first)}, "
             f"{date(f'try_cast(concat({year}, {_sql('-')}, {one}, {_sql('-')}, {two}) as date)', month_first)}) end, m)")

    part = _feistel(key, "ssn", "if(cast(substring(d, 1, 3) as int) > 666, cast(substring(d, 1, 3) as int) - 2, "
                                "cast(substring(d, 1, 3) as int) - 1)",
                    "(cast(substring(d, 4, 2) as int) - 1) * 9999 + cast(substring(d, 6, 4) as int) - 1",
                    "898", str(99 * 9999))
    ssn = ("if(substring(d, 1, 3) not in ('000', '666') and d < '9' and substring(d, 4, 2) <> '00' "
           "and substring(d, 6, 4) <> '0000', " + _let(
               part, "f", "concat(lpad(cast(if(f.l >= 665, f.l + 2, f.l + 1) as string), 3, '0'), '-', "
                          "lpad(cast(f.r div 9999 + 1 as string), 2, '0'), '-', "
                          "lpad(cast(f.r % 9999 + 1 as string), 4, '0'))") + ", m)")

    body = "substring(d, 1, length(d) - 1)"
    card = (f"if({_check_digit(body)} = substring(d, length(d)), "
            + _let(f"concat(substring(d, 1, 1), {_digits(key, 'card', 'substring(d, 2, length(d) - 2)')})", "n",
                   _put("m", f"concat(n, {_check_digit('n')})")) + ", m)")
    return f"""case
        when m rlike '^[A-Za-z_-]+\\\\s?[=:]' then {secret}
        when contains(m, '@') then {email}
        when m rlike '^[A-Z]' then {iban}
        when m like '+%' then {plus}
        when m rlike '^[0-9]+([.][0-9]+){{3}}$' then {ip}
        when m rlike '^([0-9]{{4}}-..-..|..[./]..[./][0-9]{{4}})$' then {dates}
        when m rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then {ssn}
        when length(d) > 10 then {card}
        else {local} end"""


def key_of(spark: SparkSession) -> str:
    """The key that the session names, or (with a warning) one that is no secret."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are made with a key that anyone can read", stacklevel=2)
    return key or DEMO_KEY


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced.  ``key`` is secret
    and the same wherever values are to stay linked.  ``count_col`` names a
    new column with the number of values replaced."""
    if not key:
        raise ValueError("a key is required")
    text = col(text_col)
    may = text.rlike("[0-9@=:]")
    quoted = "`" + text_col.replace("`", "``") + "`"
    mark = _sql(MARK)
    # one search marks the matches: every other piece between marks is one
    marked = f"split(regexp_replace({quoted}, {_sql(PATTERN)}, {_sql(MARK + '$0' + MARK)}), {mark}, -1)"
    # a text that holds the mark is split around the matches and searched again
    between = f"split({quoted}, {_sql(PATTERN)}, -1)"
    found = f"regexp_extract_all({quoted}, {_sql(PATTERN)}, 0)"
    apart = (f"transform(sequence(0, 2 * size({between}) - 2), i -> if(i % 2 = 0, get({between}, i div 2), "
             f"get({found}, i div 2)))")
    pieces = f"if(contains({quoted}, {mark}), {apart}, {marked})"
    digits = "regexp_replace(m, '[^0-9]', '')"
    changed = (f"transform({pieces}, (m, i) -> if(i % 2 = 0, named_struct('s', m, 'n', 0), "
               f"{_let(_let(digits, 'd', _pseudonym(key)), 'p', 'named_struct(' + _sql('s') + ', p, ' + _sql('n') + ', if(p <> m, 1, 0))')}))")
    found_at = unused(docs, "pieces", count_col or "")
    out = docs.withColumn(found_at, F.when(may, F.expr(changed)))
    some = F.col(found_at).isNotNull()
    out = out.withColumn(text_col, F.when(some, F.array_join(F.col(f"{found_at}.s"), "")).otherwise(text))
    if count_col is not None:
        n = F.aggregate(F.col(f"{found_at}.n"), F.lit(0), lambda a, b: a + b)
        out = out.withColumn(count_col, F.when(some, n).otherwise(F.lit(0)))
    return out.drop(found_at)
