"""DuckDB SQL of the operators that SQL can express, over the same whole tables."""

from __future__ import annotations

from .common import LOWER, UPPER, WORD
from .quality import (BASE_FAILED, FUNCTION_WORDS, ITERATIONS, RULES, START_BAD, START_GOOD, START_PRIOR, SYMBOLS,
                      vote_sql)


def _vote(i: int) -> str:
    return f"(CAST(code // {3 ** i} AS BIGINT) % 3 - 1)"


def _log_odds(n: int) -> str:
    return "ln(prior / (1 - prior))" + "".join(
        f" + CASE {_vote(i)} WHEN 1 THEN ln(g{i} / (1 - b{i})) WHEN -1 THEN ln((1 - g{i}) / b{i}) ELSE 0 END"
        for i in range(n))


def quality_sql(table: str = "documents") -> str:
    n = len(RULES)
    share = lambda right, all_: f"round(least(0.999, greatest(0.001, (sum({right}) + 1.0) / (sum({all_}) + 2.0))), 9)"
    start = ", ".join([f"CAST({START_PRIOR} AS DOUBLE) AS prior", *(f"CAST({START_GOOD} AS DOUBLE) AS g{i}" for i in range(n)),
                       *(f"CAST({START_BAD} AS DOUBLE) AS b{i}" for i in range(n))])
    step = ", ".join([share("q", "n") + " AS prior",
                      *(share(f"CASE WHEN {_vote(i)} = 1 THEN q ELSE 0 END", f"CASE WHEN {_vote(i)} <> 0 THEN q ELSE 0 END")
                        + f" AS g{i}" for i in range(n)),
                      *(share(f"CASE WHEN {_vote(i)} = -1 THEN n - q ELSE 0 END", f"CASE WHEN {_vote(i)} <> 0 THEN n - q ELSE 0 END")
                        + f" AS b{i}" for i in range(n))])
    em = [f"m0 AS (SELECT {start})"]
    for k in range(1, ITERATIONS + 1):
        em.append(f"m{k} AS MATERIALIZED (SELECT {step} FROM (SELECT code, n, n / (1 + exp(-({_log_odds(n)}))) AS q "
                  f"FROM ps, m{k - 1}))")
    stop = ", ".join(f"'{w}'" for w in FUNCTION_WORDS)
    return f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM {table}),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM t),
win AS (SELECT rid, i, ws[i:i + 7] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT p) AS r FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY rid),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
        length(regexp_replace(t, '[^\\p{{L}}]+', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^\\p{{Lu}}]+', '', 'g')) AS n_capitals,
        len(list_filter(ws, lambda x: lower(x) IN ({stop}))) AS n_function,
        len(list_distinct(ws)) AS n_distinct
      FROM w LEFT JOIN rep USING (rid)),
v AS MATERIALIZED (SELECT *, {vote_sql()} AS code FROM c),
ps AS MATERIALIZED (SELECT code, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY code),
{", ".join(em)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
  NOT ({BASE_FAILED}) AND round(1 / (1 + exp(-({_log_odds(n)}))), 9) >= 0.5 AS kept
FROM v, m{ITERATIONS}"""


def near_duplicates_sql(table: str = "documents", shingle: int = 4, threshold: int = 80) -> str:
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws
  FROM {table}),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(g, ' ') AS g FROM (
    SELECT doc_id, ws[i:i + {shingle - 1}] AS g FROM (
      SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {shingle - 2}, 2))) AS i FROM w WHERE len(ws) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= {threshold} * (na.n + nb.n - c)),
r(v, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.v WHERE r.root < e.b)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id,
  w.doc_id = min(r.root) AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.v = w.doc_id GROUP BY w.doc_id"""


def spelling_sql(table: str = "documents", min_chars: int = 5, min_count: int = 3, drop_one_in: int = 97, times: int = 2) -> str:
    """The CRC-32 is computed byte by byte from its polynomial; near words meet in their words with one position cut out."""
    bit = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    steps = ", ".join(f"c{i} AS (SELECT b, CAST({bit} AS BIGINT) AS c FROM c{i - 1})" for i in range(1, 9))
    return f"""
WITH RECURSIVE c0 AS (SELECT range AS b, range AS c FROM range(256)), {steps},
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS v FROM c8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]{{{min_chars},}}')) AS r
  FROM {table}),
per AS MATERIALIZED (SELECT doc_id, r, count(*) AS k, hex(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', r)) AS x FROM runs GROUP BY ALL),
hashed AS (SELECT r, k, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(range(1, len(x), 2), lambda i: CAST(concat('0x', substr(x, i, 2)) AS BIGINT))),
    lambda s, b: xor(v[xor(s, b) % 256 + 1], s // 256)), 4294967295) AS h FROM per, crc),
w AS (SELECT CASE WHEN h % {drop_one_in} = 0 THEN concat(substr(r, 1, h % len(r)), substr(r, h % len(r) + 2)) ELSE r END AS word, k FROM hashed),
n AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE len(word) >= {min_chars} GROUP BY word HAVING sum(k) >= {min_count}),
cut AS MATERIALIZED (SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS rest
  FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM n)),
pairs AS MATERIALIZED (SELECT DISTINCT a, b, bn FROM (
  SELECT x.word AS a, y.word AS b, y.n AS bn FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION ALL SELECT x.word, n.word, n.n FROM cut x JOIN n ON n.word = x.rest
  UNION ALL SELECT n.word, x.word, x.n FROM cut x JOIN n ON n.word = x.rest)),
best AS (SELECT a, count(*) AS n_near, min(ROW(-bn, b)) AS m FROM pairs GROUP BY a),
f AS MATERIALIZED (SELECT word, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  CASE WHEN -m[1] >= {times} * n THEN m[2] END AS form, CAST(CASE WHEN -m[1] >= {times} * n THEN -m[1] END AS BIGINT) AS form_n
  FROM n LEFT JOIN best ON a = word),
up(word, top) AS (SELECT word, word FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.top WHERE f.form IS NOT NULL)
SELECT f.word, f.form, up.top AS root, f.n, f.n_near, f.form_n
FROM f JOIN up USING (word) JOIN f AS e ON e.word = up.top WHERE e.form IS NULL"""


def hard_negatives_sql(table: str = "embeddings") -> str:
    return f"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM {table} WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 10"""
