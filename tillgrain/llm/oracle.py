"""SQL of the queries whose result SQL can state, for DuckDB."""

from tillgrain.llm.decontaminate import WIDTH
from tillgrain.llm.phrases import COVERED_PERCENT, MIN_COUNT, TOP
from tillgrain.llm.quality import BASE_N, LIMITS, LINE_LIMIT, MIN_WORDS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FOLDED = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _folded(column: str) -> str:
    return _FOLDED.format(_LOWER.format(f"coalesce({column}, '')"))


OP5 = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_folded("text")} AS w FROM documents),
         i AS (SELECT item_id::VARCHAR AS item, {_folded("text")} AS w FROM benchmark),
         windows AS (
            SELECT DISTINCT item, array_to_string(w[p : p + {WIDTH - 1}], ' ') AS words,
                   least(len(w), {WIDTH}) AS n
            FROM i, unnest(range(1, greatest(len(w) - {WIDTH - 2}, 2))) AS t(p) WHERE len(w) > 0),
         sizes AS (SELECT DISTINCT n FROM windows),
         places AS (
            SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS words
            FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(p) WHERE len(w) >= n),
         hits AS (SELECT r, p, n, item FROM places JOIN windows USING (n, words)),
         hit_words AS (
            SELECT r, count(DISTINCT x) AS n_hit FROM hits, unnest(range(p, p + n)) AS t(x) GROUP BY r),
         hit_items AS (
            SELECT r, count(DISTINCT item) AS n_items,
                   string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def _covered(n: int) -> str:
    """Words of each text inside windows of n words that it holds twice or more, and their characters."""
    following = (f"lead(word, {i}) OVER (PARTITION BY r ORDER BY p)" for i in range(1, n))
    window = " || ' ' || ".join(["word", *following])
    return f"""
         c{n} AS (
            SELECT r, count(*) AS words, sum(length(word)) AS chars
            FROM (SELECT DISTINCT r, p + k AS p
                  FROM (SELECT r, p, count(*) OVER (PARTITION BY r, words) AS times
                        FROM (SELECT r, p, {window} AS words FROM flat) WHERE words IS NOT NULL),
                  unnest(range({n})) AS t(k) WHERE times > 1) JOIN flat USING (r, p)
            GROUP BY r)"""


_over = [f"line_chars::DOUBLE / greatest(word_chars, 1) > {LINE_LIMIT}::DOUBLE"] + [
    f"coalesce(c{n}.chars, 0)::DOUBLE / greatest(word_chars, 1) > {limit}::DOUBLE"
    for n, limit in LIMITS.items()
]
OP4 = f"""
    WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                   {_SPACED.format("coalesce(text, '')")} AS w
            FROM documents),
         flat AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
         lines AS (
            SELECT r, count(*) AS n,
                   sum(length(array_to_string({_SPACED.format("line")}, ''))) AS chars
            FROM (SELECT r, line, row_number() OVER (PARTITION BY r, line) AS copy
                  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
                  WHERE len({_SPACED.format("line")}) > 0)
            WHERE copy > 1 GROUP BY r),
         {",".join(_covered(n) for n in (BASE_N, *LIMITS))},
         base AS (
            SELECT d.*, len(w)::BIGINT AS n_words,
                   length(array_to_string(w, ''))::BIGINT AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                   coalesce(lines.n, 0) AS n_dup_lines, coalesce(lines.chars, 0) AS line_chars,
                   coalesce(c{BASE_N}.words, 0) AS n_repeat_words
            FROM d LEFT JOIN lines USING (r) LEFT JOIN c{BASE_N} USING (r)),
         failed AS (
            SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({" OR ".join(_over)}) AS kept
    FROM failed {" ".join(f"LEFT JOIN c{n} USING (r)" for n in LIMITS)}
"""

OP11 = rf"""
    WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
         words AS (
            SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
         flat AS (SELECT r, lang, unnest(w) AS word, unnest(range(len(w))) AS p FROM words),
         grams AS (
            SELECT lang, word, lead(word, 1) OVER piece AS second, lead(word, 2) OVER piece AS third
            FROM flat WINDOW piece AS (PARTITION BY r ORDER BY p)),
         counts AS (
            SELECT lang, 1 AS k, word AS phrase, count(*) AS f FROM grams GROUP BY ALL
            UNION ALL
            SELECT lang, 2, word || ' ' || second, count(*) FROM grams WHERE second IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT lang, 3, word || ' ' || second || ' ' || third, count(*)
            FROM grams WHERE third IS NOT NULL GROUP BY ALL),
         totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
         candidates AS (
            SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w
            FROM counts WHERE k > 1 AND f >= {MIN_COUNT}),
         cuts AS (
            SELECT lang, phrase, k, a, 1 AS c, w[1] AS head, array_to_string(w[2 : k], ' ') AS tail
            FROM candidates
            UNION ALL
            SELECT lang, phrase, k, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3),
         cut_scores AS (
            SELECT cuts.*, x.f AS l, y.f AS r,
                   ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
            FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = head
                      JOIN counts y ON y.lang = cuts.lang AND y.phrase = tail),
         lowest AS (
            SELECT * FROM cut_scores
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
         covered AS (
            SELECT DISTINCT x.lang, x.phrase
            FROM (SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM candidates WHERE k = 3
                  UNION ALL
                  SELECT lang, a, w[2] || ' ' || w[3] FROM candidates WHERE k = 3) longer
            JOIN candidates x USING (lang, phrase) WHERE 100 * longer.a >= {COVERED_PERCENT} * x.a),
         ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
            FROM lowest ANTI JOIN covered USING (lang, phrase))
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""

# The patterns of llm.urls as two regular expressions over host and rest.
_BLOCKED = "|".join(
    (
        r"^([^/?#]*\.)?(ads?|adserver|track|pixel|doubleclick)\.",
        r"/(wp-login\.php|wp-admin/|xmlrpc\.php|cgi-bin/|search\?|casino/|porn/)",
        r"/(cart|checkout|basket|login|signin|logout|register)([^0-9A-Za-z_.%-]|$)",
        r"[^0-9A-Za-z_.%-](page|replytocom|sessionid|phpsessid)=",
        r"\.(jpg|png|gif|zip|exe|css|js)$",
    )
)
_ALLOWED = "|".join(
    (
        r"^([^/?#]*\.)?docs\.",
        r"/wiki/|/help/login([^0-9A-Za-z_.%-]|$)",
        r"[^0-9A-Za-z_.%-]page=1(&|$)",
    )
)
OP13 = f"""
    WITH cut AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3)
                                      ELSE '' END AS after FROM pages),
         split AS (SELECT page_id, regexp_extract(after, '^[^/?#]*') AS authority, after FROM cut),
         named AS (
            SELECT page_id, {_LOWER.format("authority")} AS host, substr(after, length(authority) + 1) AS rest
            FROM split),
         judged AS (
            SELECT *, regexp_extract(rest, '^[^?#]*') AS path, '.' || host AS labels FROM named),
         ruled AS (
            SELECT *, CASE
                WHEN labels LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN labels LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN labels LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN labels LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM judged)
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
        WHEN rule IS NOT NULL THEN 'block'
        WHEN regexp_matches(host || rest, '{_ALLOWED}', 's') THEN 'allow'
        WHEN regexp_matches(host || rest, '{_BLOCKED}', 's') THEN 'block'
        ELSE 'allow' END AS verdict
    FROM ruled
"""

ORACLE = {"op4_quality": OP4, "op5_decontaminate": OP5, "op11_phrases": OP11, "op13_urls": OP13}
