"""Shared DuckDB SQL fragments for the oracle side of the registry.

They restate the article model and the text rules of the Spark plans in SQL
(DuckDB 2.0: RE2 regexes, ``lambda x: ...`` list lambdas, 1-based lists).
"""

from __future__ import annotations

from presswork.functions.stopwords import FUNCTION_WORDS, GENERIC_WORDS
from presswork.functions.text import TRIM_RE

WORD = r"[\p{L}\p{N}_]+"


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


STOP = sql_list(FUNCTION_WORDS)
GENERIC = sql_list(GENERIC_WORDS)

ART = """art AS (
  SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title,
         d.text AS content, CAST(NULL AS VARCHAR) AS thumbnail, d.source AS agency,
         d.lang AS category, CAST(e.ts AS TIMESTAMP) AS ts, CAST(CAST(e.ts AS TIMESTAMP) AS DATE) AS date
  FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id)"""

HOURS = ("CAST(floor((epoch_us((SELECT max(ts) FROM art)) - epoch_us(ts)) / 3600000000.0) AS BIGINT)")

SLOT = """CASE WHEN h IS NULL OR h < 0 OR h > 23 THEN NULL WHEN h >= 22 THEN 5 WHEN h >= 18 THEN 4
  WHEN h >= 14 THEN 3 WHEN h >= 10 THEN 2 WHEN h >= 6 THEN 1 ELSE 0 END"""

# K1 -> K3 -> K4
ANALYSED = f"""aged AS (
  SELECT *, {SLOT} AS slot FROM (SELECT *, (({HOURS} % 24) + 24) % 24 AS h FROM art)),
slotted AS (SELECT * FROM aged WHERE slot IS NOT NULL),
analysed AS (
  SELECT id, title, content, ts, agency, slot, coalesce(title, '') || coalesce(content, '') AS text
  FROM (SELECT *, row_number() OVER (PARTITION BY slot, title ORDER BY id) AS rn FROM slotted)
  WHERE rn = 1)"""


def merge_sentences_cte(name: str, src: str, keys: str, text: str = "text", min_len: int = 15) -> str:
    """K5 in SQL: fragments, running start count, ordered string_agg."""
    return f"""{name}_f AS (
  SELECT {keys}, unnest(string_split({text}, '.')) AS raw,
         generate_subscripts(string_split({text}, '.'), 1) AS fpos FROM {src}),
{name}_g AS (
  SELECT *, sum(CASE WHEN fpos = 1 OR length(t) > {min_len} THEN 1 ELSE 0 END)
              OVER (PARTITION BY {keys} ORDER BY fpos ROWS UNBOUNDED PRECEDING) AS grp
  FROM (SELECT *, regexp_replace(raw, '{TRIM_RE}', '', 'g') AS t FROM {name}_f)),
{name}_s AS (
  SELECT {keys}, grp, string_agg(t, ' ' ORDER BY fpos) AS sentence FROM {name}_g GROUP BY ALL),
{name} AS (
  SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY grp) - 1 AS INTEGER) AS sent, sentence
  FROM {name}_s WHERE length(sentence) > 0)"""


def tokens_expr(col: str, stop: str = STOP, min_len: int = 2) -> str:
    return (f"list_filter(regexp_extract_all({col}, '{WORD}'), "
            f"lambda t: length(t) >= {min_len} AND NOT list_contains({stop}, lower(t)))")


# K5 + K6 + K7 (counts) on the analysed articles
DAY_TOKENS = ART + ",\n" + ANALYSED + ",\n" + merge_sentences_cte("sents", "analysed", "id, slot") + f""",
tok AS (SELECT id, slot, sent, sentence, {tokens_expr('sentence')} AS tokens FROM sents),
cnt AS (
  SELECT id, sent, word, count(*) AS c
  FROM (SELECT id, sent, lower(w) AS word FROM (SELECT id, sent, unnest(tokens) AS w FROM tok))
  WHERE length(word) >= 2 AND regexp_full_match(word, '{WORD}')
  GROUP BY ALL),
xn AS (SELECT id, sent, word, c / sqrt(sum(c * c) OVER (PARTITION BY id, word)) AS x FROM cnt),
edges AS (
  SELECT a.id, a.word AS src, b.word AS dst, sum(a.x * b.x) AS w
  FROM xn a JOIN xn b ON a.id = b.id AND a.sent = b.sent GROUP BY ALL)"""


def text_rank_ctes(rounds: int, prefix: str = "r", d: float = 0.85) -> str:
    """TextRank of the word graphs of ``xn`` as chained CTEs, so many rounds
    that no digit moves; the last one is ``{prefix}{rounds}``. A round is two
    sparse products with the sentence x word table, less the diagonal."""
    parts = [f"""{prefix}_b AS (
  SELECT id, sent, word, x, CASE WHEN sum(x * (s - x)) OVER (PARTITION BY id, word) > 0
         THEN 1 / sum(x * (s - x)) OVER (PARTITION BY id, word) ELSE 0 END AS iv
  FROM (SELECT *, sum(x) OVER (PARTITION BY id, sent) AS s FROM xn)),
{prefix}0 AS (SELECT DISTINCT id, word AS node, CAST(1.0 AS DOUBLE) AS x FROM xn)"""]
    for k in range(1, rounds + 1):
        parts.append(f"""{prefix}{k} AS (
  SELECT id, word AS node, (1 - {d}) + {d} * sum(x * (t - xy)) AS x
  FROM (SELECT id, word, x, xy, sum(xy) OVER (PARTITION BY id, sent) AS t
        FROM (SELECT b.id, b.sent, b.word, b.x, b.x * b.iv * r.x AS xy
              FROM {prefix}_b b JOIN {prefix}{k - 1} r ON r.id = b.id AND r.node = b.word))
  GROUP BY ALL)""")
    return ",\n".join(parts)
