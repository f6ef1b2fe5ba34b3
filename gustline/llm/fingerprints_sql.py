"""Winnowing as DuckDB SQL: runs by doubled lengths with LEAD, windows with MIN over the rows that follow."""

from __future__ import annotations

from gustline.llm.fingerprints import BASE, GRAM, LOW, PRIME, WINDOW


def _doubled(size: int) -> str:
    factor = pow(BASE, size, PRIME)
    return f"(h{size} * {factor} + lead(h{size}, {size}) OVER run) % {PRIME} AS h{2 * size}"


_LEVELS = []
_source = "codes"
for _size in (1, 2, 4, 8):
    _LEVELS.append(f"runs{2 * _size} AS (SELECT id, kind, place, size, {_doubled(_size)} FROM {_source} "
                   "WINDOW run AS (PARTITION BY id, kind ORDER BY place))")  # fmt: skip
    _source = f"runs{2 * _size}"

FINGERPRINTS = f"""
WITH docs AS (
    SELECT doc_id AS id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), followed AS (
    SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next,
           coalesce(lead(id) OVER o, first_value(id) OVER o) AS next_id
    FROM docs WINDOW o AS (ORDER BY id)
), edited AS (
    SELECT *, left(text, n - n // 4) || left(next, n // 4) AS changed FROM followed
), texts AS (
    SELECT id, 'text' AS kind, text FROM edited UNION ALL SELECT id, 'changed', changed FROM edited
), codes AS (
    SELECT id, kind, length(text) AS size, unnest(range(length(text))) AS place,
           unnest([CAST(unicode(c) + 1 AS BIGINT) FOR c IN regexp_extract_all(text, '(?s).')]) AS h1
    FROM texts
), {", ".join(_LEVELS)}, grams AS (
    SELECT id, kind, place, size, h{GRAM} AS h FROM runs{GRAM} WHERE place <= size - {GRAM}
    UNION ALL
    SELECT id, kind, 0, size, list_reduce(list(h1 ORDER BY place), lambda a, b: (a * {BASE} + b) % {PRIME})
    FROM codes WHERE size < {GRAM} GROUP BY id, kind, size
), windows AS (
    SELECT id, kind, place, greatest(size - {GRAM} + 1, 1) AS n,
           min(h * 4294967296 + {LOW} - place) OVER (
               PARTITION BY id, kind ORDER BY place ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS least
    FROM grams
), chosen AS (
    SELECT DISTINCT id, kind, least // 4294967296 AS h, {LOW} - least % 4294967296 AS place
    FROM windows WHERE place <= greatest(n - {WINDOW}, 0)
), spaced AS (
    SELECT *, place - coalesce(lag(place) OVER (PARTITION BY id, kind ORDER BY place), 0) AS gap FROM chosen
), marks AS (
    SELECT id, kind, string_agg(printf('%08x%04x', h, gap), '' ORDER BY place) AS fingerprint, list_distinct(list(h)) AS hashes
    FROM spaced GROUP BY id, kind
), near AS (
    SELECT e.id, e.n, e.changed, coalesce(t.fingerprint, '') AS fingerprint, coalesce(c.fingerprint, '') AS edited_fingerprint,
           coalesce(t.hashes, []) AS own, coalesce(c.hashes, []) AS other, coalesce(x.hashes, []) AS next
    FROM edited e LEFT JOIN marks t ON t.id = e.id AND t.kind = 'text'
    LEFT JOIN marks c ON c.id = e.id AND c.kind = 'changed' LEFT JOIN marks x ON x.id = e.next_id AND x.kind = 'text'
)
SELECT id AS doc_id, n AS n_chars, sha256(changed) AS edited_sha256, fingerprint, edited_fingerprint,
       coalesce(CAST(len(list_intersect(own, other)) AS DOUBLE) / nullif(len(list_distinct(list_concat(own, other))), 0), 1) AS near_edited,
       coalesce(CAST(len(list_intersect(own, next)) AS DOUBLE) / nullif(len(list_distinct(list_concat(own, next))), 0), 1) AS near_next
FROM near
"""
