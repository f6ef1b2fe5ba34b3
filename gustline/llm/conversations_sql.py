"""The repair of conversations as DuckDB SQL: a fold over each conversation's turns, from the last to the first."""

from __future__ import annotations

# Places in a list of four values (SQL counts from 1): start, system, user, assistant.
ADDED = (3, 3, 4, 3)
ROLES = {3: "user", 4: "assistant"}
KEPT = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}
NO_WAY = 1 << 40


def _turn(state: int) -> str:
    """The best from ``state`` where the next edit is the turn's own; ``acc.v`` holds the values after the turn."""
    added = ADDED[state - 1]
    keep = " ".join(f"WHEN e.i = '{i}' THEN acc.v[{to}].c + e.x" for i, to in KEPT[state].items())
    kept = " ".join(f"WHEN e.i = '{i}' THEN acc.v[{to}]" for i, to in KEPT[state].items())
    return f"""list_sort([
        {{'c': acc.v[{state}].c + 4, 'a': 'D' || acc.v[{state}].a, 't': acc.v[{state}].t}},
        {{'c': CASE WHEN e.gone THEN {NO_WAY} ELSE acc.v[{added}].c + 3 + e.x END, 'a': 'R' || acc.v[{added}].a,
          't': list_prepend('{ROLES[added]}:' || e.t, acc.v[{added}].t)}},
        {{'c': CASE WHEN e.gone THEN {NO_WAY} {keep} ELSE {NO_WAY} END,
          'a': 'K' || (CASE {kept} ELSE acc.v[1] END).a,
          't': list_prepend(e.r || ':' || e.t, (CASE {kept} ELSE acc.v[1] END).t)}}])[1]"""


def _inserted(state: int) -> str:
    once = ADDED[state - 1]
    twice = ADDED[once - 1]
    first, second = f"{ROLES[once]}:", f"{ROLES[twice]}:"
    return f"""list_sort([w.v[{state}],
        {{'c': w.v[{once}].c + 3, 'a': 'I' || w.v[{once}].a, 't': list_prepend('{first}', w.v[{once}].t)}},
        {{'c': w.v[{twice}].c + 6, 'a': 'II' || w.v[{twice}].a,
          't': list_prepend('{first}', list_prepend('{second}', w.v[{twice}].t))}}])[1]"""


_VALUES = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])[]"
_END = f"""[{{'c': 0, 'a': '', 't': []}}, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}},
        {{'c': 3, 'a': 'I', 't': ['assistant:']}}, {{'c': 0, 'a': '', 't': []}}]::{_VALUES}"""
_STATES = range(1, 5)
# One element stands for a turn, or (with v) for what is best after it.
_OWN = f"{{'gone': e.gone, 'i': e.i, 'x': e.x, 'r': e.r, 't': e.t, 'v': [{', '.join(map(_turn, _STATES))}]::{_VALUES}}}"
_STEP = f"{{'gone': w.gone, 'i': w.i, 'x': w.x, 'r': w.r, 't': w.t, 'v': [{', '.join(map(_inserted, _STATES))}]::{_VALUES}}}"

CONVERSATION_REPAIR = rf"""
WITH marked AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           xor(list_reduce(
               list_prepend(4294967295, [CAST(ascii(b) AS BIGINT) FOR b IN string_split(
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), '')]),
               lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                          lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS fault
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN fault = 0 THEN [] WHEN fault = 3 THEN [1, 2] ELSE [1] END) FROM marked)
), placed AS (
    SELECT *, left(role, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS visible
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN visible = '' THEN 'b'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'd'
                   WHEN right(visible, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'o' END AS f,
           lag(i) OVER (PARTITION BY conv_id ORDER BY place) || i AS pair
    FROM placed
), gathered AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate,
           count(*) FILTER (f = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list({{'gone': f IN ('b', 'd'), 'i': i, 'x': CAST(CASE WHEN f = 't' THEN 3 ELSE 0 END AS BIGINT),
                  'r': role, 't': text, 'v': []::{_VALUES}}} ORDER BY place DESC) AS turns
    FROM judged GROUP BY conv_id
), folded AS (
    SELECT * EXCLUDE (turns), list_reduce(
        list_prepend({{'gone': FALSE, 'i': '', 'x': 0::BIGINT, 'r': '', 't': '', 'v': {_END}}}, turns),
        lambda acc, e: list_transform([{_OWN}], lambda w: {_STEP})[1]).v[1] AS best
    FROM gathered
)
SELECT DISTINCT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM conversations c LEFT JOIN folded f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
"""
