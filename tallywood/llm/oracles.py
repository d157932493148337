"""SQL statements for the queries that SQL can express, in the dialect of DuckDB."""

from __future__ import annotations

from tallywood.llm import decontamination, lm_difference, site_lines

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


_SHORTEST = min(map(len, decontamination.MASKS))


def _masked(rows: str, key: str, whole: str) -> str:
    """The seeds of all windows of a table with ``words``, as texts, and those of ``whole``."""
    parts = []
    for number, mask in enumerate(decontamination.MASKS):
        picked = " || ' ' || ".join(f"words[pos + {k + 1}]" for k, use in enumerate(mask) if use == "1")
        parts.append(f"SELECT {key}, pos, {number} AS mask, {picked} AS seed FROM windows_{rows} WHERE pos + {len(mask)} <= len(words)")
    windows = f"SELECT {key}, words, unnest(range(0, len(words))) AS pos FROM {rows}"
    return f"windows_{rows} AS ({windows}), seeds_{rows} AS ({' UNION ALL '.join([*parts, whole])})"


# Items that are shorter than any mask are looked up as a whole.
_SHORT_ITEMS = f"SELECT item_id, 0 AS pos, 100 + len(words) AS mask, array_to_string(words, ' ') AS seed FROM items WHERE len(words) BETWEEN 1 AND {_SHORTEST - 1}"
_AS_SHORT = """SELECT doc_id, pos, 100 + n AS mask, array_to_string(words[pos + 1:pos + n], ' ') AS seed
  FROM windows_docs JOIN short ON pos + n <= len(words)"""

_WORDS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS words FROM benchmark),
short AS (SELECT DISTINCT len(words) AS n FROM items WHERE len(words) BETWEEN 1 AND {_SHORTEST - 1}),
{_masked("docs", "doc_id", _AS_SHORT)}, {_masked("items", "item_id", _SHORT_ITEMS)},
hits AS (SELECT DISTINCT doc_id, item_id, d.pos - i.pos AS shift FROM seeds_docs d JOIN seeds_items i USING (mask, seed)),
steps AS (SELECT doc_id, item_id, shift, len(i.words) AS size, unnest(range(0, len(i.words))) AS j,
  d.words AS dw, i.words AS iw FROM hits JOIN docs d USING (doc_id) JOIN items i USING (item_id)),
same AS (SELECT doc_id, item_id, shift, size, j,
  CASE WHEN j + shift >= 0 AND j + shift < len(dw) AND dw[j + shift + 1] = iw[j + 1] THEN 1 ELSE 0 END AS s FROM steps),
sums AS (SELECT *, sum(CASE WHEN s = 1 THEN 1 ELSE -{decontamination.SUBSTITUTION} END) OVER w AS total, sum(s) OVER w AS seen
  FROM same WINDOW w AS (PARTITION BY doc_id, item_id, shift ORDER BY j)),
starts AS (SELECT doc_id, item_id, shift, j, total, seen FROM sums
  UNION ALL SELECT doc_id, item_id, shift, -1, 0, 0 FROM hits),
ends AS (SELECT e.doc_id, e.item_id, e.shift, e.size, e.j AS last, e.total - min(b.total) AS score,
  arg_max(b.j, {{'t': -b.total, 'j': b.j}}) + 1 AS first, any_value(e.seen) - arg_max(b.seen, {{'t': -b.total, 'j': b.j}}) AS equal
  FROM sums e JOIN starts b ON b.doc_id = e.doc_id AND b.item_id = e.item_id AND b.shift = e.shift AND b.j < e.j
  GROUP BY e.doc_id, e.item_id, e.shift, e.size, e.j, e.total),
best AS (SELECT * FROM ends QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY score DESC, last) = 1)
SELECT doc_id, item_id, CAST(shift + first AS BIGINT) AS doc_start, CAST(first AS BIGINT) AS item_start,
  CAST(last - first + 1 AS BIGINT) AS n_words, CAST(equal AS BIGINT) AS n_equal, CAST(size AS BIGINT) AS item_words
FROM best WHERE equal >= least({decontamination.LEAST_WORDS}, size)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY score DESC, shift + first, first) = 1"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), {_LETTERS}), '[\x20\x09-\x0d]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS other FROM documents UNION SELECT node, b FROM reach JOIN links ON a = other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) USING (doc_id)"""


def _replaced(text: str) -> str:
    for entity, sign in site_lines.ENTITIES:
        text = f"replace({text}, '{entity}', '{sign}')"
    return text


_PAGE = (
    f"regexp_replace(regexp_replace(regexp_replace(html || '{site_lines.CLOSERS}', '{site_lines.HIDDEN}', chr(10), 'g'), "
    f"'{site_lines.INLINE}', '', 'g'), '{site_lines.TAG}', chr(10), 'g')"
)
_BLANK = "trim(l, ' ' || chr(9) || chr(13))"

SITE_LINES = rf"""
WITH pages_ AS (SELECT row_number() OVER () AS k, page_id,
  lower(regexp_extract(coalesce(url, ''), '{site_lines.HOST}', 1)) AS host,
  array_to_string(list_filter(list_transform(string_split({_replaced(_PAGE)}, chr(10)), lambda l: trim(l, ' ' || chr(9) || chr(13) || chr(12))),
    lambda l: l <> ''), chr(10)) AS text FROM pages),
cut AS (SELECT *, string_split(text, chr(10)) AS lines FROM pages_),
seen AS (SELECT k, host, unnest(list_distinct(list_filter(list_transform(lines, lambda l: {_BLANK}), lambda l: l <> ''))) AS l FROM cut),
sizes AS (SELECT host, count(*) AS pages FROM cut GROUP BY host),
frequent AS (SELECT host, list(l) AS bad FROM (SELECT host, l, count(*) AS n FROM seen GROUP BY host, l) JOIN sizes USING (host)
  WHERE n >= {site_lines.LEAST_PAGES} AND n > CAST({site_lines.RATIO} AS DOUBLE) * pages GROUP BY host),
kept AS (SELECT page_id, host, text, lines, list_filter(lines, lambda l: NOT list_contains(coalesce(bad, []), {_BLANK})) AS good
  FROM cut LEFT JOIN frequent USING (host))
SELECT page_id, host, CASE WHEN text IS NOT NULL THEN array_to_string(good, chr(10)) END AS text,
  CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(good), 0) AS BIGINT) AS n_dropped FROM kept"""

LM_DIFFERENCE = rf"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
  list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS words FROM documents),
cut AS (SELECT k, good, unnest(list_prepend('<', list_transform(words, lambda x: '=' || x))) AS h,
  unnest(list_append(list_transform(words, lambda x: '=' || x), '>')) AS w FROM docs WHERE len(words) > 0),
own_w AS (SELECT k, good, w, count(*) AS n FROM cut GROUP BY k, good, w),
own_h AS (SELECT k, good, h, count(*) AS n FROM cut GROUP BY k, good, h),
own_p AS (SELECT k, good, h, w, count(*) AS n FROM cut GROUP BY k, good, h, w),
own_n AS (SELECT k, good, count(*) AS n FROM cut GROUP BY k, good),
all_w AS (SELECT w, coalesce(sum(n) FILTER (good), 0) AS t, coalesce(sum(n) FILTER (NOT good), 0) AS b FROM own_w GROUP BY w),
all_h AS (SELECT h, coalesce(sum(n) FILTER (good), 0) AS t, coalesce(sum(n) FILTER (NOT good), 0) AS b FROM own_h GROUP BY h),
all_p AS (SELECT h, w, coalesce(sum(n) FILTER (good), 0) AS t, coalesce(sum(n) FILTER (NOT good), 0) AS b FROM own_p GROUP BY h, w),
all_n AS (SELECT coalesce(sum(n) FILTER (good), 0) AS t, coalesce(sum(n) FILTER (NOT good), 0) AS b FROM own_n),
size AS (SELECT count(*) AS v FROM all_w),
terms AS (SELECT p.k, p.n AS times, unnest([true, false]) AS target,
  unnest([ap.t, ap.b]) - CASE WHEN p.good = unnest([true, false]) THEN p.n ELSE 0 END AS pair,
  unnest([ah.t, ah.b]) - CASE WHEN p.good = unnest([true, false]) THEN oh.n ELSE 0 END AS history,
  unnest([aw.t, aw.b]) - CASE WHEN p.good = unnest([true, false]) THEN ow.n ELSE 0 END AS word,
  unnest([an.t, an.b]) - CASE WHEN p.good = unnest([true, false]) THEN o.n ELSE 0 END AS total, v, o.n AS tokens
  FROM own_p p JOIN own_w ow ON ow.k = p.k AND ow.w = p.w JOIN own_h oh ON oh.k = p.k AND oh.h = p.h JOIN own_n o ON o.k = p.k
  JOIN all_p ap ON ap.h = p.h AND ap.w = p.w JOIN all_h ah ON ah.h = p.h JOIN all_w aw ON aw.w = p.w, all_n an, size),
losses AS (SELECT k, target, tokens, sum(times * -ln((pair + {lm_difference.MU} * ((word + 0.5::DOUBLE) / (total + 0.5::DOUBLE * v))) / (history + {lm_difference.MU}))) / tokens AS loss
  FROM terms GROUP BY k, target, tokens),
each AS (SELECT k, any_value(tokens) AS tokens, max(loss) FILTER (target) AS t, max(loss) FILTER (NOT target) AS b FROM losses GROUP BY k)
SELECT doc_id, CAST(coalesce(tokens, 0) AS BIGINT) AS n_tokens, round(t, 6) AS target_loss, round(b, 6) AS background_loss,
  round(t - b, 6) AS difference FROM docs LEFT JOIN each USING (k)"""


def _assigned(number: int) -> str:
    """Every vector with its nearest centroid of a round, of equally near ones the first."""
    gaps = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return (
        f"a{number} AS MATERIALIZED (SELECT k, vec_id, x, best.cluster AS cluster, best.distance AS distance FROM (SELECT v.k, v.vec_id, any_value(v.x) AS x, "
        f"min({{'distance': CAST({gaps} AS BIGINT), 'cluster': c.cluster}}) AS best FROM v, c{number} c GROUP BY v.k, v.vec_id))"
    )


def _moved(number: int) -> str:
    """Centroids after a round: the floor of the mean of their vectors, or what they were."""
    floored = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    return (
        f"c{number + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{number} c LEFT JOIN (SELECT cluster, list({floored} ORDER BY i) AS x "
        f"FROM (SELECT cluster, i, sum(e) AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, unnest(range(64)) AS i FROM a{number}) GROUP BY cluster, i) "
        f"GROUP BY cluster) m ON m.cluster = c.cluster)"
    )


HADAMARD_CLUSTERS = f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda e: CAST(floor(64 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS INTEGER) AS cluster, x FROM v WHERE vec_id IS NOT NULL
  QUALIFY cluster < 16),
{_assigned(0)}, {_moved(0)}, {_assigned(1)}, {_moved(1)}, {_assigned(2)}, {_moved(2)}, {_assigned(3)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.x, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (cluster)"""
