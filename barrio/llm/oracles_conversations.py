"""DuckDB SQL of the queries over ``conversations``."""


def crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII string."""
    byte = "list_transform(string_split({}, ''), lambda ch: ascii(ch)::BIGINT)".format(text)
    bit = "CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END"
    return (f"xor(list_reduce({byte}, lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
            f"lambda y, z: {bit}, xor(c, b)), 4294967295::BIGINT), 4294967295)")


def _insert(s: str, line: str) -> str:
    return f"{{'c': {s}.c + 2, 'a': {s}.a || 'I', 't': {s}.t || chr(10) || '{line}:'}}"


_NEVER = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _edit(s: str, letter: str, cost: str, line: str | None) -> str:
    text = f"{s}.t" if line is None else f"{s}.t || chr(10) || {line}"
    return f"{{'c': {s}.c + {cost}, 'a': {s}.a || '{letter}', 't': {text}}}"


def _kept(s: str, initial: str) -> str:
    return (f"CASE WHEN r.gone OR r.initial <> '{initial}' THEN {_NEVER} "
            f"ELSE {_edit(s, 'K', 'r.extra', 'r.role || chr(58) || r.text')} END")


def _rerole(s: str, role: str) -> str:
    line = f"'{role}:' || r.text"
    return f"CASE WHEN r.gone THEN {_NEVER} ELSE {_edit(s, 'R', '2 + r.extra', line)} END"


# states nothing, after system, user, assistant: u and a hold the inserts before the turn
_STEP = f"""list_transform([list_transform([{{'n': v.n, 's': v.s, 'a': v.a,
    'u': {_least('v.u', _insert('v.n', 'user'), _insert('v.s', 'user'), _insert('v.a', 'user'))}}}],
  lambda w: {{'n': w.n, 's': w.s, 'u': w.u, 'a': {_least('w.a', _insert('w.u', 'assistant'))}}})[1]],
  lambda x: {{
    'n': {_edit('x.n', 'D', '3', None)},
    's': {_least(_edit('x.s', 'D', '3', None), _kept('x.n', 's'))},
    'u': {_least(_edit('x.u', 'D', '3', None), *[_kept(f'x.{f}', 'u') for f in 'nsa'], *[_rerole(f'x.{f}', 'user') for f in 'nsa'])},
    'a': {_least(_edit('x.a', 'D', '3', None), _kept('x.u', 'a'), _rerole('x.u', 'assistant'))}}})[1]"""

OP13 = rf"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS draw
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM raw WHERE draw <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
         left(role, 1) AS initial FROM damaged),
faulty AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM placed),
turns AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'role': role, 'text': text, 'initial': initial, 'gone': fault IN ('blank', 'duplicate'),
               'extra': CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END}} ORDER BY pos) AS rows
  FROM turns GROUP BY conv_id),
solved AS (
  SELECT *, list_reduce(rows, lambda v, r: {_STEP},
    {{'n': {{'c': 0::BIGINT, 'a': '', 't': ''}}, 's': {_NEVER}, 'u': {_NEVER}, 'a': {_NEVER}}}) AS v FROM counted),
ended AS (
  SELECT * EXCLUDE (v), {_least('v.n', 'v.a', _insert('v.u', 'assistant'), _insert(_insert('v.s', 'user'), 'assistant'))} AS best
  FROM solved)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

OP11 = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
members AS (
  SELECT conv_id, {crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
joined AS (
  SELECT m.conv_id, 0 AS side, t.pos, t.role, t.text FROM members m JOIN turns t ON t.conv_id = m.conv_id - m.conv_id % 100
  WHERE t.pos < m.h
  UNION ALL SELECT m.conv_id, 1, t.pos, t.role, t.text FROM members m JOIN turns t USING (conv_id) WHERE t.pos >= m.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY side, pos) AS depth,
         md5(length(role) || ':' || role || text) AS turn, length(text) AS chars FROM joined),
prefixes AS (
  SELECT conv_id, depth, chars, string_agg(turn, ',') OVER (PARTITION BY conv_id ORDER BY depth) AS name FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM members),
ends AS (
  SELECT name, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(name, depth) AS name FROM prefixes GROUP BY conv_id) GROUP BY name),
nodes AS (
  SELECT name, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(chars) AS chars, count(*) AS n_convs,
         CASE WHEN any_value(depth) = 0 THEN NULL ELSE left(name, greatest(length(name) - 33, 0)) END AS up
  FROM prefixes GROUP BY name),
children AS (SELECT up AS name, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes LEFT JOIN children USING (name)),
below AS (
  SELECT p.name, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved_tokens
  FROM counted w JOIN prefixes p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.name)
SELECT c.conv_id, c.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN below b USING (name) LEFT JOIN nodes u ON u.name = c.up LEFT JOIN ends e ON e.name = c.name"""
