"""SQL of the name comparison, for checking: what the Arrow function works out is here a recursive query.

The similarity of two strings is twice the length of their matching parts over both lengths. The parts are the longest
common run (the leftmost in a, then in b) and, recursively, those to its left and right. For a b of 200 characters and
more, characters that make up over 1 % of it start no run; they may lengthen one."""

from __future__ import annotations

from collections.abc import Callable

from ..functions.compare import ALIKE, REORDERED

_RUNS = """(SELECT *, coalesce(hit.k, 0) AS k, coalesce(hit.i, 1) AS i, CASE WHEN hit IS NULL THEN 1 ELSE instr(y, substr(x, hit.i, hit.k)) END AS j FROM
  (SELECT a, b, p, x, y, list_filter(flatten(list_transform(range(least(length(x), length(y)), 0, -1), lambda k: list_transform(range(1, length(x) - k + 2), lambda i: {'k': k, 'i': i}))),
    lambda h: contains(y, substr(x, h.i, h.k)) AND length(translate(substr(x, h.i, h.k), p, '')) = h.k)[1] AS hit FROM part WHERE x <> '' AND y <> ''))"""

_LONGER = f"""(SELECT *, len(list_filter(range(1, least(i, j)), lambda n: substr(x, i - n, n) = substr(y, j - n, n))) AS l,
    len(list_filter(range(1, least(length(x) - i - k, length(y) - j - k) + 2), lambda n: substr(x, i + k, n) = substr(y, j + k, n))) AS r FROM {_RUNS})"""

_SIDES = "[{'x': substr(x, 1, i - 1 - l), 'y': substr(y, 1, j - 1 - l), 'got': k + l + r}, {'x': substr(x, i + k + r), 'y': substr(y, j + k + r), 'got': 0}]"


def compared(pairs: str, sound: Callable[[str], str]) -> str:
    """Tables of a WITH RECURSIVE, the last of which is cmp: a, b (normalized names, as the query pairs selects them),
    category, score, and full_score, the score before it is rounded. sound: SQL of a token's phonetic code."""
    tokens = "list_distinct(list_filter(string_split({}, ' '), lambda t: t <> ''))"
    codes = f"list_distinct(list_transform({tokens}, lambda t: {sound('t')}))"
    return f"""given AS (SELECT DISTINCT a, b FROM ({pairs})),
coded_pair AS (SELECT a, b, {codes.format('a')} AS ca, {codes.format('b')} AS cb, list_sort({tokens.format('a')}) = list_sort({tokens.format('b')}) AS same FROM given),
contained AS (SELECT a, b, same, CASE WHEN least(len(ca), len(cb)) > 0 THEN CAST(len(list_intersect(ca, cb)) AS DOUBLE) / least(len(ca), len(cb)) ELSE 0.0 END AS c FROM coded_pair),
part AS (SELECT a, b, CASE WHEN length(b) < 200 THEN '' ELSE array_to_string(list_filter(list_distinct(string_split(b, '')), lambda z: length(b) - length(replace(b, z, '')) > length(b) // 100 + 1), '') END AS p,
  a AS x, b AS y, CAST(0 AS BIGINT) AS got FROM contained WHERE a <> '' AND b <> '' AND NOT same
UNION ALL SELECT a, b, p, s.x, s.y, s.got FROM (SELECT a, b, p, unnest({_SIDES}) AS s FROM {_LONGER} WHERE k + l + r > 0)),
ratio AS (SELECT a, b, 2.0 * CAST(sum(got) AS DOUBLE) / (length(a) + length(b)) AS ratio FROM part GROUP BY a, b),
best AS (SELECT a, b, same, greatest(c, coalesce(ratio, 0.0)) AS best FROM contained LEFT JOIN ratio USING (a, b)),
cmp AS (SELECT a, b, CASE WHEN a = '' OR b = '' THEN 'no_coincide' WHEN a = b THEN 'exacta' WHEN same THEN 'exacta_reordenada' WHEN best >= {ALIKE} THEN 'fonetica' ELSE 'no_coincide' END AS category,
  CASE WHEN a = '' OR b = '' THEN 0.0 WHEN a = b THEN 1.0 WHEN same THEN {REORDERED} ELSE CAST(format('{{:.3f}}', best) AS DOUBLE) END AS score, best AS full_score FROM best)"""
