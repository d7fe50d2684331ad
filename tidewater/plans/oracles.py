"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Each statement recomputes its query from the raw driver tables (views
``lineitem orders part customer documents events nation ...``) without the
Spark code path: the page nesting is skipped and posts are joined flat.
"""

from __future__ import annotations

from ..functions.text import (
    BOOSTER_DECAY,
    BOOSTER_INCREMENT,
    BOOSTERS_DOWN,
    BOOSTERS_UP,
    DEFAULT_LEXICON,
    NEGATION_FACTOR,
    NEGATIONS,
    SQUASH_ALPHA,
)

K = 14
METRICS = ["retweet_count", "reply_count", "like_count", "quote_count", "impression_count"]

POSTS = r"""
parts AS MATERIALIZED (
  SELECT p_partkey, p_type, p_brand,
         CASE WHEN p_size % 4 = 0 THEN list_sort([p_brand, 'Size ' || p_size])
              ELSE list_sort(list_distinct(list_concat(string_split(p_name, ' '), [p_brand]))) END AS names
  FROM part),
docs AS MATERIALIZED (SELECT doc_id, lang || '' AS lang, text || '' AS text FROM documents),
line AS MATERIALIZED (
  SELECT *, (l_orderkey * 7 + l_linenumber) % (SELECT CAST(floor((max(doc_id) + 1) * 1.05) AS BIGINT) FROM documents) AS place
  FROM lineitem),
posts AS (
  SELECT l.l_orderkey AS page_id,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS id,
         CAST(o.o_custkey AS VARCHAR) AS author_id,
         strftime(l.l_shipdate + to_minutes(l.l_partkey % 24 * 60 + l.l_suppkey % 60), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at,
         d.doc_id AS doc_id,
         d.lang AS lang,
         d.text AS text,
         CASE WHEN l.l_tax > 0 THEN p.names END AS labels,
         p.p_type AS domain,
         CASE WHEN l.l_linenumber = 7 THEN CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) % 150
              ELSE CAST(floor(l.l_extendedprice * (1 - l.l_discount)) AS BIGINT) END AS impression_count,
         CAST(l.l_quantity AS BIGINT) AS like_count,
         CAST(l.l_linenumber AS BIGINT) AS quote_count,
         CAST(round(l.l_discount * 100) AS BIGINT) AS reply_count,
         CAST(round(l.l_tax * 100) AS BIGINT) AS retweet_count,
         CASE WHEN d.doc_id IS NULL OR l.l_returnflag = 'N' THEN NULL WHEN l.l_returnflag = 'R' THEN [p.p_brand, p.p_type]
              ELSE [p.p_type] END AS hashtags,
         CASE WHEN d.doc_id IS NOT NULL AND l.l_linestatus = 'F' THEN ['supplier' || l.l_suppkey] END AS mentions,
         CASE WHEN d.doc_id IS NULL THEN 0 ELSE l.l_linenumber % 3 END AS n_urls,
         CASE WHEN d.doc_id IS NOT NULL AND l.l_linenumber % 3 > 0 AND l.l_returnflag = 'R' THEN 1 ELSE 0 END AS n_media
  FROM line l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN parts p ON p.p_partkey = l.l_partkey
  LEFT JOIN docs d ON d.doc_id = l.place
)"""

COUNTS = """
counts AS (
  SELECT label, count(*) AS cnt FROM (SELECT unnest(labels) AS label FROM posts) GROUP BY label
)"""

VOCAB = f"""
vocab AS (
  SELECT label, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, label ASC) - 1 AS INTEGER) AS idx
  FROM counts ORDER BY cnt DESC, label ASC LIMIT {K}
),
vlist AS (SELECT list(label ORDER BY idx) AS v FROM vocab)"""

PAGE_USERS = """
page_users AS (
  SELECT o.o_orderkey AS page_id,
         CAST(c.c_custkey AS VARCHAR) AS user_id,
         CAST(floor(c.c_acctbal) AS BIGINT) AS followers_count,
         CAST(floor(o.o_totalprice / 1000) AS BIGINT) AS tweet_count,
         CAST(c.c_nationkey AS BIGINT) AS following_count,
         CAST(0 AS BIGINT) AS listed_count,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS retrieved_at
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
)"""

FOLLOWERS = """
followers AS (
  SELECT user_id, arg_max(followers_count, retrieved_at) AS followers_count
  FROM page_users
  WHERE page_id IN (SELECT page_id FROM posts)
  GROUP BY user_id
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# ------------------------------------------------------------------ co-occurrence fallback
FALLBACK = f"""
eligible AS (SELECT * FROM posts WHERE doc_id IS NOT NULL AND labels IS NOT NULL),
fsets AS (
  SELECT DISTINCT array_to_string(list_sort(labels), chr(1)) AS set_key, labels
  FROM eligible, vlist
  WHERE len(list_intersect(labels, vlist.v)) = 0
),
cooc AS (
  SELECT lab AS label, cand, count(*) AS n FROM (
    SELECT unnest(labels) AS lab, cand FROM (
      SELECT labels, unnest(list_intersect(labels, vlist.v)) AS cand FROM eligible, vlist))
  WHERE lab <> cand GROUP BY lab, cand
),
grid AS (SELECT set_key, cand FROM fsets, (SELECT unnest(v) AS cand FROM vlist)),
hits AS (
  SELECT f.set_key, c.cand, sum(c.n) AS w FROM (SELECT set_key, unnest(labels) AS label FROM fsets) f
  JOIN cooc c ON c.label = f.label GROUP BY f.set_key, c.cand
),
scored AS (
  SELECT g.set_key, g.cand AS label, coalesce(h.w, 0) AS w,
         sum(coalesce(h.w, 0)) OVER (PARTITION BY g.set_key) AS total
  FROM grid g LEFT JOIN hits h ON h.set_key = g.set_key AND h.cand = g.cand
),
scores AS (
  SELECT set_key, label, CASE WHEN total > 0 THEN w / total ELSE 1.0 / {K} END AS score FROM scored
),
assigned AS (
  SELECT set_key,
         CASE WHEN count(*) FILTER (WHERE score > 0.3) > 0
              THEN array_to_string(list_sort(list(label) FILTER (WHERE score > 0.3)), ',')
              ELSE arg_min(label, (-score, label)) END AS assigned
  FROM scores GROUP BY set_key
)"""


# ------------------------------------------------------------------ sentiment
def _in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words)) + ")"


def _lexicon_values() -> str:
    return ", ".join(f"('{w}', {v})" for w, v in sorted(DEFAULT_LEXICON.items()))


def sentiment_sql(source: str, key: str, text: str, lexicon: str | None = None) -> str:
    """Per-row compound score via unnest with positions + look-back by index."""
    up, down, neg = _in_list(BOOSTERS_UP), _in_list(BOOSTERS_DOWN), _in_list(NEGATIONS)

    def prev(j: int) -> str:
        return f"CASE WHEN i > {j} THEN tk[i - {j}] END"

    boost = " + ".join(
        f"(CASE WHEN {prev(j)} IN {up} THEN {BOOSTER_INCREMENT * d!r} WHEN {prev(j)} IN {down} THEN {-BOOSTER_INCREMENT * d!r} ELSE 0.0 END)"
        for j, d in zip((1, 2, 3), BOOSTER_DECAY)
    )
    negated = " OR ".join(f"coalesce({prev(j)} IN {neg}, false)" for j in (1, 2, 3))
    return f"""
lex(word, v) AS ({lexicon or "VALUES " + _lexicon_values()}),
toks AS (
  SELECT {key} AS k,
         list_filter(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}'']+'), lambda t: t <> '') AS tk
  FROM {source}
),
pos AS (SELECT k, tk, unnest(range(1, len(tk) + 1)) AS i FROM toks),
val AS (
  SELECT p.k, p.i, coalesce(lex.v, 0.0) AS v0, ({boost}) AS boost, ({negated}) AS neg
  FROM pos p LEFT JOIN lex ON lex.word = p.tk[p.i]
),
adj AS (
  SELECT k, CASE WHEN neg THEN (v0 + sign(v0) * boost) * {NEGATION_FACTOR} ELSE v0 + sign(v0) * boost END AS v FROM val
),
sums AS (SELECT k, sum(v) AS s FROM adj GROUP BY k)"""


#: About a third of the documents' words, with valences from -4 to 4.
WORDS_LEXICON = r"""
  SELECT word, (place % 41 - 20) / 5.0 FROM (
    SELECT word, CAST(('0x' || substr(md5(word), 1, 4)) AS INTEGER) AS place FROM (
      SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}'']+')) AS word FROM documents) WHERE word <> '')
  WHERE place % 3 = 0"""


def _sentiment_query(lexicon: str | None = None) -> str:
    return (
        "WITH" + sentiment_sql("documents", "doc_id", "text", lexicon)
        + f"\nSELECT d.doc_id, round(coalesce(s.s, 0.0) / sqrt(coalesce(s.s, 0.0) * coalesce(s.s, 0.0) + {SQUASH_ALPHA}), 6) + 0.0 AS sentiment"
        + "\nFROM documents d LEFT JOIN sums s ON s.k = d.doc_id"
    )


# ------------------------------------------------------------------ ticks
TICKERS = """
tickers AS (
  SELECT c.c_custkey AS user_id, n.n_name AS ticker FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

SERIAL = "(epoch_us(date_trunc('minute', e.ts)) / 86400e6 + 25569)"
LOCAL_FROM_SERIAL = (
    "timezone('America/New_York', timezone('UTC', make_timestamp(CAST(round((xltime - 25569) * 86400e6) AS BIGINT))))"
)
IN_HOURS = "(epoch_us(ts) - epoch_us(date_trunc('day', ts)) BETWEEN 34200000000 AND 57600000000)"

TRADES = f"""
trades AS (
  SELECT t.ticker, e.event_id AS seq, {SERIAL} AS xltime, e.value AS price,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS volume,
         CASE WHEN e.event_type = 'purchase' THEN 'uncategorized' ELSE e.event_type END AS flag
  FROM events e JOIN tickers t ON t.user_id = e.user_id
  WHERE e.event_type IN ('purchase', 'error')
),
clean_t AS (
  SELECT ticker, ts, avg(price) AS trade_price, sum(volume) AS trade_volume FROM (
    SELECT ticker, xltime, {LOCAL_FROM_SERIAL} AS ts, price, volume FROM trades WHERE flag = 'uncategorized')
  WHERE {IN_HOURS}
  GROUP BY ticker, ts, round(xltime * 86400e6)
)"""

QUOTES = f"""
quotes AS (
  SELECT t.ticker, e.event_id AS seq, {SERIAL} AS xltime,
         CASE WHEN e.event_type = 'view' THEN e.value END AS bid_price,
         CASE WHEN e.event_type = 'view' THEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) END AS bid_volume,
         CASE WHEN e.event_type <> 'view' THEN e.value END AS ask_price,
         CASE WHEN e.event_type <> 'view' THEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) END AS ask_volume
  FROM events e JOIN tickers t ON t.user_id = e.user_id
  WHERE e.event_type IN ('view', 'click')
),
clean_q AS (
  SELECT ticker, ts,
         arg_max(bid_price, seq) FILTER (WHERE bid_price IS NOT NULL) AS "bid-price",
         arg_max(bid_volume, seq) FILTER (WHERE bid_volume IS NOT NULL) AS "bid-volume",
         arg_max(ask_price, seq) FILTER (WHERE ask_price IS NOT NULL) AS "ask-price",
         arg_max(ask_volume, seq) FILTER (WHERE ask_volume IS NOT NULL) AS "ask-volume"
  FROM (SELECT ticker, seq, {LOCAL_FROM_SERIAL} AS ts, bid_price, bid_volume, ask_price, ask_volume FROM quotes)
  WHERE {IN_HOURS}
  GROUP BY ticker, ts
)"""


PLACE = "CAST(('0x' || substr(md5(id), 1, 8)) AS BIGINT)"


def _two_regressor(where: str = "TRUE") -> str:
    """Closed-form OLS of impression_count on like_count and reply_count."""
    return _with(POSTS) + f""",
m AS (SELECT CAST(impression_count AS DOUBLE) AS y, CAST(like_count AS DOUBLE) AS x1, CAST(reply_count AS DOUBLE) AS x2
      FROM posts WHERE {where}),
mu AS (SELECT count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2 FROM m),
s AS (
  SELECT any_value(n) AS n, any_value(my) AS my, any_value(m1) AS m1, any_value(m2) AS m2,
         sum((x1 - m1) * (x1 - m1)) AS s11, sum((x1 - m1) * (x2 - m2)) AS s12, sum((x2 - m2) * (x2 - m2)) AS s22,
         sum((x1 - m1) * (y - my)) AS s1y, sum((x2 - m2) * (y - my)) AS s2y, sum((y - my) * (y - my)) AS syy
  FROM m, mu
),
b AS (
  SELECT *, s11 * s22 - s12 * s12 AS det,
         (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
  FROM s
),
f AS (
  SELECT *, my - b1 * m1 - b2 * m2 AS b0,
         (SELECT sum(power(y - (my - b1 * m1 - b2 * m2) - b1 * x1 - b2 * x2, 2)) FROM m) AS ssr
  FROM b
),
g AS (
  SELECT *, ssr / (n - 3) AS sigma2,
         ssr / (n - 3) * s22 / det AS v1, ssr / (n - 3) * s11 / det AS v2, -ssr / (n - 3) * s12 / det AS c12
  FROM f
)"""


def _ols_coef() -> str:
    return _two_regressor() + """
SELECT term, round(coef, 4) AS coef, round(se, 4) AS std_err, round(coef / se, 4) AS t FROM (
  SELECT 'Intercept' AS term, b0 AS coef, sqrt(sigma2 / n + m1 * m1 * v1 + m2 * m2 * v2 + 2 * m1 * m2 * c12) AS se FROM g
  UNION ALL SELECT 'like_count', b1, sqrt(v1) FROM g
  UNION ALL SELECT 'reply_count', b2, sqrt(v2) FROM g)"""


def _inference() -> str:
    """Coefficients with two-sided t tails (Simpson's rule) and 95% intervals (expansion in 1/df)."""
    z = 1.959963984540054
    return _two_regressor() + f""",
c AS (
  SELECT 'Intercept' AS term, b0 AS coef, sqrt(sigma2 / n + m1 * m1 * v1 + m2 * m2 * v2 + 2 * m1 * m2 * c12) AS se, n - 3.0 AS df FROM g
  UNION ALL SELECT 'like_count', b1, sqrt(v1), n - 3.0 FROM g
  UNION ALL SELECT 'reply_count', b2, sqrt(v2), n - 3.0 FROM g),
q AS (
  SELECT *, least(abs(coef / se), 40.0) AS a,
         {z} + ({z ** 3 + z}) / (4 * df) + ({5 * z ** 5 + 16 * z ** 3 + 3 * z}) / (96 * df * df)
             + ({3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z}) / (384 * df * df * df) AS tq
  FROM c),
area AS (
  SELECT term, sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                   * exp(-(df + 1) / 2 * ln(1 + (a * i / 4000) * (a * i / 4000) / df))) * a / 12000 AS x
  FROM q, range(4001) r(i) GROUP BY term, a, df),
inf AS (
  SELECT q.term, coef, se, coef / se AS t,
         greatest(0.0, 1 - 2 * x * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())) AS p,
         coef - tq * se AS lo, coef + tq * se AS hi
  FROM q JOIN area ON area.term = q.term),
labelled AS (
  SELECT *, CASE term WHEN 'Intercept' THEN 'Intercept' WHEN 'like_count' THEN 'Like Count' ELSE 'Reply Count' END
            || CASE WHEN p <= 0.01 THEN ' ***' WHEN p <= 0.05 THEN ' **' WHEN p <= 0.1 THEN ' *' ELSE '' END AS label
  FROM inf)
"""


INFERRED = (
    "term, round(coef, 4) AS coef, round(se, 4) AS std_err, round(t, 4) AS t, round(p, 4) AS p_value, "
    "round(lo, 4) AS ci_low, round(hi, 4) AS ci_high"
)


def _ols_fit() -> str:
    return _two_regressor() + """,
h AS (SELECT *, 1 - ssr / syy AS r2, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS llf FROM g)
SELECT stat, round(value, 4) AS value FROM (
  SELECT 'nobs' AS stat, CAST(n AS DOUBLE) AS value FROM h
  UNION ALL SELECT 'df_model', 2.0 FROM h
  UNION ALL SELECT 'df_resid', CAST(n - 3 AS DOUBLE) FROM h
  UNION ALL SELECT 'r_squared', r2 FROM h
  UNION ALL SELECT 'adj_r_squared', 1 - (1 - r2) * (n - 1) / (n - 3) FROM h
  UNION ALL SELECT 'f_statistic', (r2 / 2) / ((1 - r2) / (n - 3)) FROM h
  UNION ALL SELECT 'log_likelihood', llf FROM h
  UNION ALL SELECT 'aic', -2 * llf + 6 FROM h
  UNION ALL SELECT 'bic', -2 * llf + 3 * ln(n) FROM h)"""


def _staged() -> str:
    """The four stages on like_count and reply_count in closed form.

    ``rows_of`` holds every stage's rows, ``mo`` their centred sums, ``se``/``pv`` the log stage's tests;
    a term that the log stage drops has slope 0 in the final stage.
    """
    cut = round(0.2 * 2**32)
    sums = """count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
         regr_sxx(y, x1) AS s11, regr_sxx(y, x2) AS s22, regr_sxy(x1, x2) AS s12,
         regr_sxy(y, x1) AS s1y, regr_sxy(y, x2) AS s2y, regr_syy(y, x1) AS syy"""
    p_value = """greatest(0.0, 1 - 2 * exp(lgamma((n - 2) / 2.0) - lgamma((n - 3) / 2.0)) / sqrt((n - 3) * pi())
         * list_sum(list_transform(range(4001), lambda i: CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
             * exp(-(n - 2) / 2.0 * ln(1 + power(least(abs(t), 40.0) * i / 4000, 2) / (n - 3))))) * least(abs(t), 40.0) / 12000)"""
    return _with(POSTS) + f""",
base AS (
  SELECT row_number() OVER () AS rn, id, CAST(impression_count AS DOUBLE) AS y, CAST(like_count AS DOUBLE) AS x1, CAST(reply_count AS DOUBLE) AS x2,
         {PLACE} < {cut} AS held
  FROM posts),
logs AS (SELECT rn, id, ln(1 + y) AS y, ln(1 + x1) AS x1, ln(1 + x2) AS x2, held FROM base WHERE y >= 100),
lm AS (SELECT {sums} FROM logs),
lb AS (
  SELECT *, s11 * s22 - s12 * s12 AS det, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
         (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM lm),
lv AS (SELECT *, (syy - b1 * s1y - b2 * s2y) / (n - 3) AS sigma2 FROM lb),
tests AS (
  SELECT n, b1 / sqrt(sigma2 * s22 / det) AS t, 1 AS which FROM lv UNION ALL SELECT n, b2 / sqrt(sigma2 * s11 / det), 2 FROM lv),
picked AS (SELECT bool_or(which = 1 AND {p_value} < 0.05) AS u1, bool_or(which = 2 AND {p_value} < 0.05) AS u2 FROM tests),
rows_of AS (
  SELECT 'raw' AS stage, rn, id, y, x1, x2, TRUE AS u1, TRUE AS u2 FROM base
  UNION ALL SELECT 'threshold', rn, id, y, x1, x2, TRUE, TRUE FROM base WHERE y >= 100
  UNION ALL SELECT 'log', rn, id, y, x1, x2, TRUE, TRUE FROM logs
  UNION ALL SELECT 'final', rn, id, y, x1, x2, u1, u2 FROM logs, picked
  UNION ALL SELECT 'holdout', rn, id, y, x1, x2, u1, u2 FROM logs, picked WHERE NOT held),
mo AS (SELECT stage, any_value(u1) AS u1, any_value(u2) AS u2, {sums} FROM rows_of GROUP BY stage),
co AS (
  SELECT *, 1 + CAST(u1 AS INTEGER) + CAST(u2 AS INTEGER) AS k, s11 * s22 - s12 * s12 AS det,
         CASE WHEN u1 AND u2 THEN (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) WHEN u1 THEN s1y / s11 ELSE 0 END AS b1,
         CASE WHEN u1 AND u2 THEN (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) WHEN u2 THEN s2y / s22 ELSE 0 END AS b2
  FROM mo),
fit AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM co),
res AS (SELECT r.stage, r.rn, r.id, r.y - (f.b0 + f.b1 * r.x1 + f.b2 * r.x2) AS e FROM rows_of r JOIN fit f ON f.stage = r.stage),
ord AS (  -- posts of one id in the order of their raw residuals, in every stage
  SELECT res.stage, res.e, res.e - lag(res.e) OVER (PARTITION BY res.stage ORDER BY res.id, raw.e) AS step
  FROM res JOIN res AS raw ON raw.stage = 'raw' AND raw.rn = res.rn),
em AS (
  SELECT stage, sum(e * e) AS ssr, avg(e) AS ea, sum(step * step) / sum(e * e) AS dw FROM ord GROUP BY stage),
ce AS (
  SELECT ord.stage, avg(power(e - ea, 2)) AS c2, avg(power(e - ea, 3)) AS c3, avg(power(e - ea, 4)) AS c4
  FROM ord JOIN em ON em.stage = ord.stage GROUP BY ord.stage),
st AS (
  SELECT fit.*, em.ssr, em.dw, c3 / power(c2, 1.5) AS skew, c4 / (c2 * c2) AS kurt, CASE WHEN k = 1 THEN 0 ELSE 1 - em.ssr / syy END AS r2, em.ssr / (n - k) AS sigma2,
         -n / 2.0 * (ln(2 * pi()) + ln(em.ssr / n) + 1) AS llf
  FROM fit JOIN em ON em.stage = fit.stage JOIN ce ON ce.stage = fit.stage)"""


def _staged_fit() -> str:
    return _staged() + """,
sk AS (
  SELECT *, skew * sqrt((n + 1.0) * (n + 3) / (6.0 * (n - 2))) AS sy,
         3.0 * (1.0 * n * n + 27.0 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS beta2,
         (kurt - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / (power(n + 1.0, 2) * (n + 3) * (n + 5))) AS kx,
         6.0 * (1.0 * n * n - 5.0 * n + 2) / ((n + 7.0) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (1.0 * n * (n - 2) * (n - 3))) AS sb
  FROM st),
w AS (SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS ka FROM sk),
z AS (
  SELECT *, 1 / sqrt(0.5 * ln(w2)) * asinh(sy / sqrt(2 / (w2 - 1))) AS zs,
         ((1 - 2 / (9 * ka)) - cbrt((1 - 2 / ka) / (1 + kx * sqrt(2 / (ka - 4))))) / sqrt(2 / (9 * ka)) AS zk
  FROM w),
gram AS (
  SELECT *, CAST(n AS DOUBLE) AS g00, CASE WHEN u1 THEN n * m1 ELSE 0 END AS g01, CASE WHEN u2 THEN n * m2 ELSE 0 END AS g02,
         CASE WHEN u1 THEN s11 + n * m1 * m1 ELSE 0 END AS g11, CASE WHEN u2 THEN s22 + n * m2 * m2 ELSE 0 END AS g22,
         CASE WHEN u1 AND u2 THEN s12 + n * m1 * m2 ELSE 0 END AS g12
  FROM z),
inv AS (
  SELECT *, g00 + g11 + g22 AS tr,
         CASE WHEN u1 THEN n * s11 ELSE 0 END + CASE WHEN u2 THEN n * s22 ELSE 0 END + g11 * g22 - g12 * g12 AS c2m,
         CASE WHEN u1 AND u2 THEN n * det ELSE 0 END AS d3
  FROM gram),
big AS (
  SELECT *, tr / 3 AS q, sqrt((power(g00 - tr / 3, 2) + power(g11 - tr / 3, 2) + power(g22 - tr / 3, 2) + 2 * (g01 * g01 + g02 * g02 + g12 * g12)) / 6) AS p FROM inv),
ang AS (
  SELECT *, ((g00 - q) * ((g11 - q) * (g22 - q) - g12 * g12) - g01 * (g01 * (g22 - q) - g12 * g02) + g02 * (g01 * g12 - (g11 - q) * g02)) / (2 * p * p * p) AS cosine FROM big),
lam AS (SELECT *, q + 2 * p * cos(acos(greatest(-1.0, least(1.0, cosine))) / 3) AS l1 FROM ang),
mid AS (SELECT *, (c2m - d3 / l1) / l1 AS sm, d3 / l1 AS dm FROM lam),
cond AS (
  SELECT *, sqrt(l1 / CASE WHEN k = 3 THEN 2 * dm / (sm + sqrt(sm * sm - 4 * dm)) WHEN k = 2 THEN sm ELSE l1 END) AS cond_no FROM mid),
long AS (
  SELECT stage, unnest(['nobs', 'rank', 'df_model', 'df_resid', 'ssr', 'centered_tss', 'r_squared', 'adj_r_squared', 'f_statistic', 'log_likelihood',
                        'aic', 'bic', 'condition_number', 'omnibus', 'skew', 'kurtosis', 'jarque_bera', 'durbin_watson']) AS stat,
         unnest([n, k, k - 1, n - k, ssr, syy, r2, 1 - (1 - r2) * (n - 1) / (n - k), (r2 / (k - 1)) / ((1 - r2) / (n - k)), llf,
                 -2 * llf + 2 * k, -2 * llf + k * ln(n), cond_no, zs * zs + zk * zk, skew, kurt,
                 n / 6.0 * (skew * skew + power(kurt - 3, 2) / 4), dw]::DOUBLE[]) AS value
  FROM cond WHERE stage <> 'holdout')
SELECT stage, stat, exponent, round(value / power(10.0, exponent), 6) AS digits
FROM (SELECT *, CAST(CASE WHEN value = 0 THEN 0 ELSE floor(log10(abs(value))) END AS INTEGER) AS exponent FROM long WHERE isfinite(value))"""


def _staged_coefficients() -> str:
    return _staged() + f""",
ses AS (
  SELECT *, CASE WHEN u1 AND u2 THEN sigma2 * s22 / det WHEN u1 THEN sigma2 / s11 END AS v1,
         CASE WHEN u1 AND u2 THEN sigma2 * s11 / det WHEN u2 THEN sigma2 / s22 END AS v2,
         CASE WHEN u1 AND u2 THEN -sigma2 * s12 / det ELSE 0 END AS c12
  FROM st WHERE stage <> 'holdout'),
terms AS (
  SELECT stage, 'Intercept' AS term, b0 AS coef,
         sqrt(sigma2 / n + CASE WHEN u1 THEN m1 * m1 * v1 ELSE 0 END + CASE WHEN u2 THEN m2 * m2 * v2 ELSE 0 END + 2 * m1 * m2 * c12) AS se
  FROM ses
  UNION ALL SELECT stage, 'like_count', b1, sqrt(v1) FROM ses WHERE u1
  UNION ALL SELECT stage, 'reply_count', b2, sqrt(v2) FROM ses WHERE u2)
SELECT stage, term, round(coef, 5) AS coef, round(se, 5) AS std_err, round(coef / se, 4) AS t FROM terms"""


def _staged_holdout() -> str:
    return _staged() + """,
e AS (
  SELECT l.y - (f.b0 + f.b1 * l.x1 + f.b2 * l.x2) AS e, exp(l.y) - exp(f.b0 + f.b1 * l.x1 + f.b2 * l.x2) AS back
  FROM logs l, fit f WHERE f.stage = 'holdout' AND l.held),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(e * e) AS mse, sqrt(avg(back * back)) AS original FROM e)
SELECT stat, round(value, 4) AS value FROM (
  SELECT 'n' AS stat, n AS value FROM s UNION ALL SELECT 'mse', mse FROM s UNION ALL SELECT 'rmse', sqrt(mse) FROM s
  UNION ALL SELECT 'rmse_original', original FROM s
  UNION ALL SELECT 'discarded_terms', 3 - CAST(u1 AS INTEGER) - CAST(u2 AS INTEGER) FROM picked)"""


def _staged_final() -> str:
    return _staged() + """
SELECT count(*) AS n, sum(CASE WHEN u1 THEN x1 ELSE 0 END) AS sum_likes, sum(CASE WHEN u2 THEN x2 ELSE 0 END) AS sum_replies, sum(y) AS sum_impressions
FROM base, picked WHERE y >= 100"""


def _predict() -> str:
    return _two_regressor() + """
SELECT p.id, round(g.b0 + g.b1 * p.like_count + g.b2 * p.reply_count, 4) AS prediction FROM posts p, g"""


def _actual_vs_predicted() -> str:
    return _two_regressor() + """
SELECT CAST(p.impression_count AS DOUBLE) AS actual,
       round(g.b0 + g.b1 * p.like_count + g.b2 * p.reply_count, 4) AS predicted FROM posts p, g"""



AUTHORED = """
authors AS (
  SELECT user_id AS author_id,
         arg_max(followers_count, (retrieved_at, followers_count, following_count, listed_count, tweet_count)) AS followers_count,
         arg_max(following_count, (retrieved_at, followers_count, following_count, listed_count, tweet_count)) AS following_count,
         arg_max(tweet_count, (retrieved_at, followers_count, following_count, listed_count, tweet_count)) AS tweet_count,
         arg_max(listed_count, (retrieved_at, followers_count, following_count, listed_count, tweet_count)) AS listed_count
  FROM page_users GROUP BY user_id
),
authored AS (
  SELECT p.id, p.author_id, p.created_at, p.retweet_count, p.reply_count, p.like_count, p.quote_count,
         p.impression_count, a.followers_count, a.following_count, a.tweet_count, a.listed_count
  FROM posts p LEFT JOIN authors a ON a.author_id = p.author_id
),
long AS (
  SELECT CAST(followers_count AS DOUBLE) AS x, metric, CAST(y AS DOUBLE) AS y FROM authored
  UNPIVOT (y FOR metric IN (following_count, tweet_count, retweet_count, reply_count, like_count, quote_count, impression_count))
)"""


def _events_sql(select: str, tail: str) -> str:
    """Trades and quotes of (ticker, day)s with raw rows on both sides, full outer joined."""
    return _with(TICKERS, TRADES, QUOTES) + (
        f", days AS (SELECT DISTINCT ticker, CAST({LOCAL_FROM_SERIAL} AS DATE) AS d FROM trades "
        f"INTERSECT SELECT DISTINCT ticker, CAST({LOCAL_FROM_SERIAL} AS DATE) AS d FROM quotes),"
        " t2 AS (SELECT * FROM clean_t c WHERE EXISTS (SELECT 1 FROM days WHERE days.ticker = c.ticker AND days.d = CAST(c.ts AS DATE))),"
        " q2 AS (SELECT * FROM clean_q c WHERE EXISTS (SELECT 1 FROM days WHERE days.ticker = c.ticker AND days.d = CAST(c.ts AS DATE)))\n"
        + select + " FROM t2 t FULL OUTER JOIN q2 q ON t.ticker = q.ticker AND t.ts = q.ts" + tail
    )


CLEAN = "regexp_replace(regexp_replace(lower({x}), '[^A-Za-z0-9_]+', '', 'g'), '__', '_', 'g')"


def _dummy_columns() -> str:
    """Dummy cells as rows; the column names depend on the data."""
    return _with(POSTS, COUNTS, VOCAB) + f""",
base AS (SELECT row_number() OVER () AS rn, id, labels FROM posts),
cells AS (
  SELECT b.rn, b.id, 'dummy_' || {CLEAN.format(x="v.label")} AS name, CAST(coalesce(list_contains(b.labels, v.label), false) AS INTEGER) AS x
  FROM base b, vocab v
)
SELECT id, name, max(x) AS x FROM cells GROUP BY rn, id, name"""


def _build_features() -> str:
    """The whole feature table: fallback labels, text scores per document, followers, dummies."""
    feature_cols = (
        "impression_count, hashtags_count, mentions_count, tweet_medias_count, tweet_external_urls_count, "
        "tweet_period, tweet_sentiment, tweet_length, followers_count"
    )
    return _with(POSTS, COUNTS, VOCAB, FALLBACK, PAGE_USERS, FOLLOWERS) + "," + sentiment_sql("documents", "doc_id", "text") + f""",
feats AS (
  SELECT row_number() OVER () AS rn, p.impression_count,
         CAST(coalesce(len(p.hashtags), 0) AS BIGINT) AS hashtags_count,
         CAST(coalesce(len(p.mentions), 0) AS BIGINT) AS mentions_count,
         CAST(p.n_media AS BIGINT) AS tweet_medias_count,
         CAST(p.n_urls - p.n_media AS BIGINT) AS tweet_external_urls_count,
         CAST((hour(CAST(substr(p.created_at, 1, 19) AS TIMESTAMP)) - 5 + 24) % 24 AS BIGINT) AS tweet_period,
         round(coalesce(sm.s, 0.0) / sqrt(coalesce(sm.s, 0.0) * coalesce(sm.s, 0.0) + {SQUASH_ALPHA}), 6) AS tweet_sentiment,
         CAST(length(p.text) AS BIGINT) AS tweet_length,
         f.followers_count,
         CASE WHEN len(list_intersect(p.labels, vlist.v)) > 0 THEN list_intersect(p.labels, vlist.v)
              ELSE string_split(a.assigned, ',') END AS glabels
  FROM posts p CROSS JOIN vlist
  LEFT JOIN assigned a ON a.set_key = array_to_string(list_sort(p.labels), chr(1))
  LEFT JOIN sums sm ON sm.k = p.doc_id
  JOIN followers f ON f.user_id = p.author_id
  WHERE p.doc_id IS NOT NULL AND p.labels IS NOT NULL
),
cells AS (
  SELECT rn, {feature_cols}, 'dummy_' || {CLEAN.format(x="v.label")} AS name,
         CAST(list_contains(glabels, v.label) AS INTEGER) AS x
  FROM feats, vocab v
),
named AS (SELECT rn, {feature_cols}, name, max(x) AS x FROM cells GROUP BY ALL)
SELECT {feature_cols}, string_agg(name || '=' || x, ',' ORDER BY name) AS dummies FROM named GROUP BY rn, {feature_cols}"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["label_counts"] = _with(POSTS, COUNTS) + "SELECT label, cnt FROM counts"
    q["top_labels"] = _with(POSTS, COUNTS, VOCAB) + "SELECT label, cnt, idx FROM vocab"
    q["label_index"] = _with(POSTS, COUNTS, VOCAB) + "SELECT label, idx FROM vocab"
    q["explode_posts"] = _with(POSTS) + "SELECT page_id, id, author_id, created_at, lang FROM posts"
    q["project_posts"] = _with(POSTS) + (
        "SELECT id AS tweet_id, author_id AS user_id, created_at AS tweet_date, impression_count, text AS tweet_text, "
        "coalesce(array_to_string(hashtags, ','), '') AS hashtags, coalesce(array_to_string(mentions, ','), '') AS mentions, CAST(n_urls AS BIGINT) AS n_urls, "
        "array_to_string(list_sort(labels), ',') AS annotations FROM posts"
    )
    q["project_metrics"] = _with(POSTS) + (
        "SELECT id, author_id, created_at, retweet_count, reply_count, like_count, quote_count, impression_count FROM posts"
    )
    q["eligible_posts"] = _with(POSTS) + "SELECT id, author_id FROM posts WHERE doc_id IS NOT NULL AND labels IS NOT NULL"
    q["by_language"] = _with(POSTS) + "SELECT id, author_id, lang FROM posts WHERE lang = 'fr'"
    q["first_user"] = (
        "SELECT o.o_orderkey AS page_id, CAST(c.c_custkey AS VARCHAR) AS user_id, "
        "CAST(floor(c.c_acctbal) AS BIGINT) AS followers_count FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey"
    )
    q["sample_posts"] = _with(POSTS) + (
        "SELECT p.id, p.author_id, p.created_at, p.retweet_count, p.reply_count, p.like_count, p.quote_count, "
        "p.impression_count, CAST(floor(c.c_acctbal) AS BIGINT) AS followers_count "
        "FROM posts p JOIN orders o ON o.o_orderkey = p.page_id LEFT JOIN customer c ON c.c_custkey = o.o_custkey WHERE p.lang = 'en'"
    )
    q["project_authors"] = _with(PAGE_USERS) + (
        "SELECT user_id AS author_id, followers_count, following_count, tweet_count, listed_count FROM page_users"
    )
    q["dedup_users"] = _with(POSTS, PAGE_USERS, FOLLOWERS) + "SELECT user_id, followers_count FROM followers"
    q["attach_followers"] = _with(POSTS, PAGE_USERS, FOLLOWERS) + (
        "SELECT p.author_id AS user_id, p.id AS tweet_id, p.impression_count, f.followers_count "
        "FROM posts p JOIN followers f ON f.user_id = p.author_id"
    )
    q["posts_with_authors"] = _with(POSTS, PAGE_USERS, AUTHORED) + (
        "SELECT author_id, id, created_at, retweet_count, reply_count, like_count, quote_count, impression_count, "
        "followers_count, following_count, tweet_count, listed_count FROM authored"
    )
    q["posts_with_authors_fanout"] = _with(POSTS, PAGE_USERS) + (
        "SELECT p.author_id, p.id, p.created_at, p.retweet_count, p.reply_count, p.like_count, p.quote_count, "
        "p.impression_count, u.followers_count, u.following_count, u.tweet_count, u.listed_count "
        "FROM posts p LEFT JOIN page_users u ON u.user_id = p.author_id"
    )
    q["known_labels"] = _with(POSTS, COUNTS, VOCAB) + (
        "SELECT id, array_to_string(list_sort(list_intersect(labels, vlist.v)), ',') AS known, "
        "CAST(coalesce(len(list_intersect(labels, vlist.v)), 0) AS INTEGER) AS n_known FROM posts, vlist"
    )
    q["array_counts"] = _with(POSTS) + (
        "SELECT id, CAST(coalesce(len(hashtags), 0) AS BIGINT) AS hashtags_count, "
        "CAST(coalesce(len(mentions), 0) AS BIGINT) AS mentions_count, CAST(n_urls AS BIGINT) AS urls_count FROM posts"
    )
    q["media_counts"] = _with(POSTS) + (
        "SELECT id, CAST(n_media AS BIGINT) AS n_media_keys, CAST(n_media AS BIGINT) AS tweet_medias_count, "
        "CAST(n_urls - n_media AS BIGINT) AS tweet_external_urls_count FROM posts"
    )
    q["text_length"] = "SELECT doc_id, CAST(length(text) AS BIGINT) AS tweet_length FROM documents"
    q["local_hour"] = (
        "SELECT event_id, CAST((hour(ts) - 5 + 24) % 24 AS BIGINT) AS hour_us, CAST((hour(ts) + 1) % 24 AS BIGINT) AS hour_eu FROM events"
    )
    q["day_part_dummies"] = (
        "SELECT event_id, CAST((hour(ts) - 5 + 24) % 24 >= 6 AND (hour(ts) - 5 + 24) % 24 < 12 AS INTEGER) AS tweet_period_morning, "
        "CAST((hour(ts) - 5 + 24) % 24 >= 12 AND (hour(ts) - 5 + 24) % 24 < 18 AS INTEGER) AS tweet_period_afternoon FROM events"
    )
    q["dataset_name"] = "SELECT 'lineitem' AS dataset, count(*) AS n FROM lineitem"
    q["scan_glob"] = "SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem"
    q["parse_ts"] = "SELECT event_id, epoch_us(date_trunc('millisecond', ts)) AS ts_micros FROM events"
    q["multi_hot"] = _with(POSTS, COUNTS, VOCAB) + (
        "SELECT id, array_to_string(list_transform(vlist.v, lambda x: CASE WHEN list_contains(labels, x) THEN '1' ELSE '0' END), '') "
        "AS multi_hot FROM posts, vlist"
    )
    q["clean_name"] = _with(POSTS) + (
        "SELECT label, regexp_replace(regexp_replace(lower(label), '[^A-Za-z0-9_]+', '', 'g'), '__', '_', 'g') AS clean "
        "FROM (SELECT DISTINCT unnest(list_concat(labels, [domain])) AS label FROM posts)"
    )
    q["score_labels"] = _with(POSTS, COUNTS, VOCAB, FALLBACK) + "SELECT set_key, label, round(score, 6) AS score FROM scores"
    q["assign_labels"] = _with(POSTS, COUNTS, VOCAB, FALLBACK) + "SELECT set_key, assigned FROM assigned"
    q["group_labels"] = _with(POSTS, COUNTS, VOCAB, FALLBACK) + (
        "SELECT p.id, CASE WHEN len(list_intersect(p.labels, vlist.v)) > 0 "
        "THEN array_to_string(list_sort(list_intersect(p.labels, vlist.v)), ',') ELSE a.assigned END AS labels "
        "FROM posts p CROSS JOIN vlist LEFT JOIN assigned a ON a.set_key = array_to_string(list_sort(p.labels), chr(1)) "
        "WHERE p.doc_id IS NOT NULL AND p.labels IS NOT NULL"
    )
    q["lexicon_sentiment"] = _sentiment_query()
    q["lexicon_table"] = _sentiment_query(WORDS_LEXICON)
    q["schema_capture"] = (
        "WITH found AS (SELECT o_orderstatus AS layout, unnest(CASE o_orderstatus "
        "WHEN 'F' THEN ['key BIGINT', 'sum.price DECIMAL', 'sum.cust BIGINT'] "
        "WHEN 'O' THEN ['key BIGINT', 'tags[].name STRING'] ELSE ['key STRING', 'sum.cust BIGINT'] END) AS leaf FROM orders) "
        "SELECT split_part(leaf, ' ', 1) AS leaf, split_part(leaf, ' ', 2) AS type, count(DISTINCT layout) AS n_groups, "
        "count(DISTINCT layout) = (SELECT count(DISTINCT o_orderstatus) FROM orders) AS everywhere FROM found GROUP BY ALL"
    )
    q["score_labels_by_text"] = _with(POSTS, COUNTS, VOCAB, FALLBACK) + """,
words AS (SELECT set_key, unnest(regexp_extract_all(lower(array_to_string(labels, ' ')), '[a-z0-9]+')) AS word FROM fsets),
df AS (SELECT word, count(DISTINCT set_key) AS df FROM words GROUP BY word),
total AS (SELECT count(*) AS n FROM fsets),
cw AS (SELECT cand, unnest(regexp_extract_all(lower(cand), '[a-z0-9]+')) AS word FROM (SELECT unnest(v) AS cand FROM vlist)),
cv AS (SELECT cand, cw.word, count(*) * (ln((1.0 + any_value(n)) / (1.0 + coalesce(any_value(df.df), 0))) + 1) AS x
       FROM cw JOIN total ON TRUE LEFT JOIN df ON df.word = cw.word GROUP BY cand, cw.word),
cu AS (SELECT cand, word, x / sqrt(sum(x * x) OVER (PARTITION BY cand)) AS x FROM cv),
sv AS (SELECT set_key, words.word, count(*) * (ln((1.0 + any_value(n)) / (1.0 + any_value(df.df))) + 1) AS x
       FROM words JOIN df ON df.word = words.word JOIN total ON TRUE GROUP BY set_key, words.word),
dots AS (SELECT set_key, cand, sum(sv.x * cu.x) AS dot FROM sv JOIN cu ON cu.word = sv.word GROUP BY set_key, cand),
all_dots AS (SELECT g.set_key, g.cand AS label, coalesce(dot, 0) AS dot, sum(coalesce(dot, 0)) OVER (PARTITION BY g.set_key) AS s,
                    count(*) OVER (PARTITION BY g.set_key) AS k
             FROM grid g LEFT JOIN dots ON dots.set_key = g.set_key AND dots.cand = g.cand)
SELECT set_key, label, round(CASE WHEN s > 0 THEN dot / s ELSE 1.0 / k END, 6) AS score FROM all_dots"""
    q["dummy_columns"] = _dummy_columns()
    q["build_features"] = _build_features()
    q["log1p_all"] = _with(POSTS) + "SELECT id, " + ", ".join(
        f"round(CASE WHEN {c} > -1 THEN ln(1 + {c}) END, 6) AS {c}" for c in METRICS
    ) + " FROM posts"
    q["expm1_col"] = _with(POSTS) + "SELECT id, round(exp(ln(1 + impression_count)) - 1, 3) AS impression_count FROM posts"
    q["threshold"] = _with(POSTS) + "SELECT id, impression_count FROM posts WHERE impression_count >= 100"
    q["hash_split"] = _with(POSTS) + (
        f"SELECT id, {PLACE} AS place, CASE WHEN {PLACE} < round(0.2 * 4294967296) THEN 'validation' ELSE 'train' END AS split FROM posts"
    )
    q["summary_stats"] = _with(POSTS) + (
        "SELECT count(*) AS n, CAST(min(impression_count) AS DOUBLE) AS min_value, CAST(max(impression_count) AS DOUBLE) AS max_value, "
        "round(stddev_pop(impression_count), 4) AS stddev_pop FROM posts"
    )
    q["metric_series"] = _with(POSTS, PAGE_USERS, AUTHORED) + "SELECT x, metric, y FROM long WHERE x > 0 AND y > 0"
    per_metric = "regr_slope({y}, {x}), 6) + 0.0 AS slope, round(regr_intercept({y}, {x}), 6) + 0.0 AS intercept, round(regr_r2({y}, {x}), 6) + 0.0 AS r2 "
    all_metrics = (
        ", every AS (SELECT CAST(followers_count AS DOUBLE) AS x, metric, CAST(v AS DOUBLE) AS y FROM {source} UNPIVOT (v FOR metric IN "
        "(following_count, tweet_count, retweet_count, reply_count, like_count, quote_count, impression_count))) "
    )
    linear = "SELECT metric, count(*) AS n, round(" + per_metric.format(y="y", x="x") + "FROM every WHERE x IS NOT NULL GROUP BY metric"
    q["metric_regressions"] = _with(POSTS, PAGE_USERS, AUTHORED) + all_metrics.format(source="authored") + linear
    q["metric_regressions_few_views"] = (
        _with(POSTS, PAGE_USERS, AUTHORED) + ", few AS (SELECT * FROM authored WHERE impression_count < 10000)"
        + all_metrics.format(source="few") + linear
    )
    q["metric_regressions_log"] = _with(POSTS, PAGE_USERS, AUTHORED) + (
        "SELECT metric, count(*) AS n, round(" + per_metric.format(y="log10(y)", x="log10(x)")
        + "FROM long WHERE x > 0 AND y > 0 GROUP BY metric"
    )
    q["log_histogram"] = _with(POSTS, PAGE_USERS, AUTHORED) + (
        "SELECT metric, CAST(floor(log10(v)) AS BIGINT) AS bucket, count(*) AS n FROM ("
        "SELECT metric, CAST(v AS DOUBLE) AS v FROM authored UNPIVOT (v FOR metric IN "
        "(following_count, tweet_count, retweet_count, reply_count, like_count, quote_count, impression_count, followers_count))) "
        "WHERE v > 0 GROUP BY ALL"
    )
    q["ols_coef"] = _ols_coef()
    q["ols_inference"] = _inference() + f"SELECT {INFERRED} FROM labelled"
    q["coef_table"] = _inference() + f"SELECT {INFERRED}, label, round(coef - lo, 4) AS error FROM labelled"
    q["star_labels"] = _inference() + "SELECT term, label FROM labelled"
    q["significant_terms"] = _inference() + "SELECT term FROM labelled WHERE p < 0.05 AND term <> 'Intercept'"
    q["discarded_terms"] = _inference() + (
        "SELECT CAST(3 - count(*) FILTER (p < 0.05 AND term <> 'Intercept') AS INTEGER) AS n FROM labelled"
    )
    cut = round(0.2 * 2**32)
    q["holdout_score"] = _two_regressor(f"{PLACE} >= {cut}") + f""",
e AS (
  SELECT power(p.impression_count - (g.b0 + g.b1 * p.like_count + g.b2 * p.reply_count), 2) AS e2
  FROM posts p, f g WHERE {PLACE.replace("id", "p.id")} < {cut})
SELECT stat, round(value, 3) AS value FROM (
  SELECT 'n' AS stat, CAST(count(*) AS DOUBLE) AS value FROM e
  UNION ALL SELECT 'mse', avg(e2) FROM e UNION ALL SELECT 'rmse', sqrt(avg(e2)) FROM e)"""
    q["durbin_watson"] = _two_regressor() + """,
e AS (
  SELECT p.id, p.impression_count - (g.b0 + g.b1 * p.like_count + g.b2 * p.reply_count) AS e FROM posts p, f g),
d AS (SELECT e, e - lag(e) OVER (ORDER BY id, e) AS step FROM e)
SELECT round(sum(step * step) / sum(e * e), 4) AS durbin_watson FROM d"""
    q["threshold_range"] = _with(POSTS) + "SELECT id, impression_count FROM posts WHERE impression_count >= 5000 AND impression_count < 20000"
    q["rename_cast_select"] = _with(POSTS) + (
        "SELECT CAST(author_id AS INTEGER) AS author, TRY_CAST(id AS INTEGER) AS number, CAST(like_count AS INTEGER) AS likes FROM posts"
    )
    q["json_pages"] = _with(POSTS) + "SELECT id, author_id, created_at, lang FROM posts"
    q["ols_fit"] = _ols_fit()
    q["staged_small_fit"] = _staged_fit()
    q["staged_small_coefficients"] = _staged_coefficients()
    q["staged_small_holdout"] = _staged_holdout()
    q["model_summaries"] = _staged_final()
    q["predict_score"] = _predict()
    q["actual_vs_predicted"] = _actual_vs_predicted()
    q["serial_to_ts"] = (
        "SELECT event_id, epoch_us(make_timestamp(CAST(round(((epoch_us(ts) / 86400e6 + 25569) - 25569) * 86400e6) AS BIGINT))) "
        "AS ts_micros FROM events"
    )
    q["to_zone"] = "SELECT event_id, epoch_us(timezone('America/New_York', timezone('UTC', ts))) AS local_micros FROM events"
    q["between_time"] = (
        "SELECT event_id, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS micros_of_day FROM "
        "(SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS ts FROM events) "
        f"WHERE {IN_HOURS}"
    )
    q["clean_trades"] = _with(TICKERS, TRADES) + (
        "SELECT ticker, epoch_us(ts) AS ts, round(trade_price, 6) AS trade_price, trade_volume FROM clean_t"
    )
    q["clean_quotes"] = _with(TICKERS, QUOTES) + (
        'SELECT ticker, epoch_us(ts) AS ts, "bid-price", "bid-volume", "ask-price", "ask-volume" FROM clean_q'
    )
    merged = (
        'SELECT coalesce(t.ticker, q.ticker) AS ticker, epoch_us(coalesce(t.ts, q.ts)) AS ts, round(t.trade_price, 6) AS trade_price, '
        't.trade_volume, q."bid-price", q."bid-volume", q."ask-price", q."ask-volume"'
    )
    q["merge_events"] = _with(TICKERS, TRADES, QUOTES) + merged + " FROM clean_t t FULL OUTER JOIN clean_q q ON t.ticker = q.ticker AND t.ts = q.ts"
    q["build_events"] = _events_sql(merged + ", CAST(CAST(coalesce(t.ts, q.ts) AS DATE) AS VARCHAR) AS date", "")
    q["concat_tables"] = _with(TICKERS) + (
        ", tr AS (SELECT t.ticker, e.event_id AS seq, e.value AS tp FROM events e JOIN tickers t ON t.user_id = e.user_id "
        "WHERE e.event_type IN ('purchase', 'error')),"
        " qu AS (SELECT t.ticker, e.event_id AS seq, e.event_type, e.value FROM events e JOIN tickers t ON t.user_id = e.user_id "
        "WHERE e.event_type IN ('view', 'click'))\n"
        'SELECT ticker, seq, tp AS "trade-price", CAST(NULL AS DOUBLE) AS "bid-price", CAST(NULL AS DOUBLE) AS "ask-price" FROM tr '
        "UNION ALL SELECT ticker, seq, NULL, CASE WHEN event_type = 'view' THEN value END, "
        "CASE WHEN event_type <> 'view' THEN value END FROM qu"
    )
    q["csv_roundtrip"] = "SELECT * FROM customer"
    q["json_checkpoint"] = q["project_metrics"]
    q["parquet_roundtrip"] = "SELECT * FROM lineitem"
    q["arrow_roundtrip"] = "SELECT *, TRUE AS named FROM lineitem"
    q["first_column"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM labels"
    q["scan_any"] = "SELECT *, ['parquet', 'csv', 'arrow'][l_orderkey % 3 + 1] AS format FROM lineitem"
    q["probe_files"] = (
        "SELECT format, reason, TRUE AS found, format IN ('parquet', 'csv', 'arrow') AND reason = 'good' AS sized FROM (VALUES "
        "('parquet', 'good'), ('csv', 'good'), ('arrow', 'good'), ('parquet', 'missing'), ('none', 'unknown format')) t(format, reason)"
    )
    q["partitioned_events"] = _events_sql(
        "SELECT coalesce(t.ticker, q.ticker) AS ticker, CAST(CAST(coalesce(t.ts, q.ts) AS DATE) AS VARCHAR) AS date, count(*) AS n",
        " GROUP BY ALL",
    )
    q["expand_paths"] = _with(TICKERS) + (
        ", tk AS (SELECT DISTINCT t.ticker FROM events e JOIN tickers t ON t.user_id = e.user_id WHERE e.event_type IN ('purchase', 'error')),"
        " days AS (SELECT unnest(range(CAST((SELECT min(ts) FROM events) AS DATE), CAST((SELECT max(ts) FROM events) AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)\n"
        "SELECT ticker, CAST(CAST(d AS DATE) AS VARCHAR) AS date, "
        "'data/raw/trade/' || ticker || '/' || strftime(d, '%Y-%m-%d') || '-' || ticker || '-trade.parquet' AS path FROM tk, days"
    )
    q["paired_paths"] = _with(TICKERS) + (
        ", tk AS (SELECT DISTINCT t.ticker FROM events e JOIN tickers t ON t.user_id = e.user_id WHERE e.event_type IN ('purchase', 'error')),"
        " days AS (SELECT unnest(range(CAST((SELECT min(ts) FROM events) AS DATE), CAST((SELECT max(ts) FROM events) AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d)\n"
        "SELECT ticker, CAST(CAST(d AS DATE) AS VARCHAR) AS date, "
        "'data/raw/trade/' || ticker || '/' || strftime(d, '%Y-%m-%d') || '-' || ticker || '-trade.parquet' AS trade_path, "
        "'data/raw/bbo/' || ticker || '/' || strftime(d, '%Y-%m-%d') || '-' || ticker || '-bbo.parquet' AS quote_path FROM tk, days"
    )
    return q
