"""DuckDB SQL for the rows of those training-data queries that SQL can express."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP11_COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS id, string_split(replace(piece, chr(9), ' '), ' ') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
), one AS (
    SELECT lang, id, pos, word FROM (SELECT lang, id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM pieces)
    WHERE word <> ''
), runs AS (
    SELECT lang, word AS a, lead(word, 1) OVER piece AS b, lead(word, 2) OVER piece AS c
    FROM one WINDOW piece AS (PARTITION BY id ORDER BY pos)
), phrases AS (
    SELECT lang, size, g, count(*) AS f
    FROM (SELECT lang, 1 AS size, a AS g FROM runs
          UNION ALL SELECT lang, 2, a || ' ' || b FROM runs WHERE b IS NOT NULL
          UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM runs WHERE c IS NOT NULL)
    GROUP BY ALL
), words AS (
    SELECT lang, sum(f) AS n FROM phrases WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, g, f AS a, string_split(g, ' ') AS w FROM phrases WHERE size > 1 AND f >= 10
), scored AS (
    SELECT c.lang, c.g AS phrase, c.size, c.a, x.f AS l, y.f AS r, k,
           (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
    FROM candidates c, (VALUES (1), (2)) AS v(k), phrases x, phrases y
    WHERE k < c.size AND x.lang = c.lang AND x.g = array_to_string(c.w[1:k], ' ')
      AND y.lang = c.lang AND y.g = array_to_string(c.w[k + 1:c.size], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
    SELECT lang, part, max(a) AS longer
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
          FROM candidates WHERE size = 3)
    GROUP BY ALL
), ranked AS (
    SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.part = s.phrase AND s.size = 2
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {"op11_collocations": OP11_COLLOCATIONS}
