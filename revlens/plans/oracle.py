"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, over the same driver tables.
``RND`` rounds like Spark does for doubles (half-up on the shortest decimal
text of the value), so 2 dp results agree bit for bit.
"""

from __future__ import annotations

import html.entities

from revlens.functions.text import ABBREVIATIONS_JOB, ABBREVIATIONS_NOTEBOOK

SQL: dict[str, str] = {}


def RND(x: str, d: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DOUBLE)"


def QDISC(table: str, col: str, q: float) -> str:
    """Smallest value whose cumulative share reaches q (percentile_disc)."""
    return (f"(SELECT min({col}) FROM (SELECT {col}, cume_dist() OVER (ORDER BY {col}) AS cd "
            f"FROM {table} WHERE {col} IS NOT NULL) WHERE cd >= {q})")


RATING = "CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS DOUBLE)"

REVIEWS = f"""
reviews AS (
  SELECT o_orderkey AS comment_id, o_custkey AS customer_id, c_name AS customer_name,
         CAST(o_orderdate AS TIMESTAMP) AS purchased_at, CAST(o_orderdate AS TIMESTAMP) AS created_at,
         {RATING} AS rating
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
clean_reviews AS (
  SELECT * FROM reviews
  WHERE customer_id IS NOT NULL AND purchased_at IS NOT NULL
    AND purchased_at BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2035-12-31'
    AND (created_at IS NULL OR created_at BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2035-12-31'))"""

RFM_TAIL = f"""
rfm AS (
  SELECT customer_id, customer_name,
         CAST(date_diff('day', CAST(max(purchased_at) AS DATE),
              (SELECT CAST(max(purchased_at) AS DATE) + 1 FROM clean_reviews)) AS INTEGER) AS recency,
         count(DISTINCT comment_id) AS frequency,
         {RND("count(DISTINCT comment_id) * coalesce(avg(rating), 0.0)", 2)} AS monetary
  FROM clean_reviews GROUP BY customer_id, customer_name),
rfm_ok AS (SELECT * FROM rfm WHERE recency IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL),
q AS (SELECT {QDISC('rfm_ok', 'recency', 0.25)} AS r1, {QDISC('rfm_ok', 'recency', 0.5)} AS r2,
             {QDISC('rfm_ok', 'recency', 0.75)} AS r3,
             {QDISC('rfm_ok', 'frequency', 0.25)} AS f1, {QDISC('rfm_ok', 'frequency', 0.5)} AS f2,
             {QDISC('rfm_ok', 'frequency', 0.75)} AS f3,
             {QDISC('rfm_ok', 'monetary', 0.25)} AS m1, {QDISC('rfm_ok', 'monetary', 0.5)} AS m2,
             {QDISC('rfm_ok', 'monetary', 0.75)} AS m3),
scored AS (
  SELECT rfm.*,
    CASE WHEN recency <= r1 THEN 4 WHEN recency <= r2 THEN 3 WHEN recency <= r3 THEN 2 ELSE 1 END AS R,
    CASE WHEN frequency >= f3 THEN 4 WHEN frequency >= f2 THEN 3 WHEN frequency >= f1 THEN 2 ELSE 1 END AS F,
    CASE WHEN monetary >= m3 THEN 4 WHEN monetary >= m2 THEN 3 WHEN monetary >= m1 THEN 2 ELSE 1 END AS M
  FROM rfm, q),
segments AS (
  SELECT *, R + F + M AS tong_diem,
    CASE WHEN R >= 3 AND F >= 3 AND M >= 3 THEN 'VIP'
         WHEN R >= 3 AND F >= 2 THEN 'Khach trung thanh'
         WHEN R >= 3 AND F = 1 THEN 'Khach moi'
         WHEN R = 2 AND F >= 2 THEN 'Co nguy co roi bo'
         WHEN R <= 1 AND F >= 2 THEN 'Can kich hoat lai'
         ELSE 'Khach tieu thu thap' END AS phan_khuc
  FROM scored),
summary AS (
  SELECT phan_khuc, count(customer_id) AS so_khach,
         {RND("avg(recency)", 1)} AS recency_tb, {RND("avg(frequency)", 2)} AS frequency_tb,
         {RND("avg(monetary)", 2)} AS monetary_tb, {RND("avg(tong_diem)", 2)} AS diem_rfm_tb
  FROM segments GROUP BY phan_khuc),
monthly AS (
  SELECT strftime(purchased_at, '%Y-%m') AS thang, count(DISTINCT comment_id) AS so_don,
         count(DISTINCT customer_id) AS so_khach, {RND("avg(rating)", 2)} AS diem_tb
  FROM clean_reviews GROUP BY 1),
weekday AS (
  SELECT CAST(dayofweek(purchased_at) + 1 AS INTEGER) AS thu_so, count(DISTINCT comment_id) AS so_don,
         {RND("avg(rating)", 2)} AS diem_tb
  FROM clean_reviews GROUP BY 1)"""
RFM = f"{REVIEWS},{RFM_TAIL}"

SQL["rfm_metrics"] = f"WITH {RFM} SELECT * FROM rfm"
SQL["rfm_quantiles"] = (f"WITH {RFM} SELECT CAST(r1 AS DOUBLE) AS r_q25, CAST(r2 AS DOUBLE) AS r_q50, "
                        "CAST(r3 AS DOUBLE) AS r_q75, CAST(f1 AS DOUBLE) AS f_q25, CAST(f2 AS DOUBLE) AS f_q50, "
                        "CAST(f3 AS DOUBLE) AS f_q75, CAST(m1 AS DOUBLE) AS m_q25, CAST(m2 AS DOUBLE) AS m_q50, "
                        "CAST(m3 AS DOUBLE) AS m_q75 FROM q")
SQL["rfm_segments"] = f"WITH {RFM} SELECT * FROM segments"
SQL["segment_summary"] = f"WITH {RFM} SELECT * FROM summary"
SQL["segment_share"] = (f"WITH {RFM} SELECT phan_khuc, count(*) AS so_khach, "
                        f"{RND('CAST(count(*) AS DOUBLE) * 100.0 / sum(count(*)) OVER ()', 2)} AS ty_le "
                        "FROM segments GROUP BY phan_khuc")
SQL["date_range_filter"] = f"""WITH {REVIEWS} SELECT * FROM reviews
  WHERE purchased_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2035-12-31'
    AND (created_at IS NULL OR created_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2035-12-31')"""
SQL["monthly_trend"] = f"WITH {RFM} SELECT * FROM monthly"
SQL["weekday_trend"] = f"""WITH {RFM} SELECT *, CASE thu_so WHEN 1 THEN 'CN' WHEN 2 THEN 'T2' WHEN 3 THEN 'T3'
  WHEN 4 THEN 'T4' WHEN 5 THEN 'T5' WHEN 6 THEN 'T6' WHEN 7 THEN 'T7' END AS ten_thu FROM weekday"""
SQL["busiest_weekdays"] = f"""WITH {RFM} SELECT *, CASE thu_so WHEN 1 THEN 'CN' WHEN 2 THEN 'T2' WHEN 3 THEN 'T3'
  WHEN 4 THEN 'T4' WHEN 5 THEN 'T5' WHEN 6 THEN 'T6' WHEN 7 THEN 'T7' END AS ten_thu FROM weekday
  ORDER BY so_don DESC, thu_so LIMIT 3"""
SQL["recent_months"] = (f"WITH {RFM}, last AS (SELECT * FROM monthly ORDER BY thang DESC LIMIT 18) "
                        f"SELECT *, {RND('avg(so_don) OVER ()', 2)} AS so_don_tb FROM last")

SALES = "sales AS (SELECT l_orderkey AS comment_id, s_name AS seller_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)"
SQL["seller_totals"] = f"WITH {SALES} SELECT seller_name, count(DISTINCT comment_id) AS so_don FROM sales GROUP BY 1"
SQL["top_sellers"] = (f"WITH {SALES} SELECT seller_name, count(DISTINCT comment_id) AS so_don FROM sales GROUP BY 1 "
                      "ORDER BY so_don DESC, seller_name NULLS LAST LIMIT 10")
POP = """pop AS (SELECT l_partkey AS product_id, p_name AS product_name, count(DISTINCT l_orderkey) AS so_luot_mua
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_name)"""
SQL["product_popularity"] = f"WITH {POP} SELECT * FROM pop"
SQL["top5_products"] = (f"WITH {POP} SELECT *, CAST(row_number() OVER (ORDER BY so_luot_mua DESC, product_id) AS INTEGER) AS rank "
                        "FROM pop ORDER BY so_luot_mua DESC, product_id LIMIT 5")
SQL["kpi_overview"] = f"""WITH {RFM} SELECT
  (SELECT CAST(sum(so_khach) AS BIGINT) FROM summary) AS tong_khach_hang,
  (SELECT CAST(coalesce(sum(so_khach) FILTER (WHERE phan_khuc = 'VIP'), 0) AS BIGINT) FROM summary) AS vip,
  max(so_don) AS don_cao_nhat, arg_min(thang, (-so_don, thang)) AS thang_cao_nhat,
  {RND("avg(diem_tb)", 2)} AS rating_tb FROM monthly"""
SQL["distinct_totals"] = f"""WITH {REVIEWS} SELECT count(DISTINCT customer_id) AS so_khach,
  count(DISTINCT comment_id) AS so_don, CAST(min(purchased_at) AS DATE) AS ngay_dau,
  CAST(max(purchased_at) AS DATE) AS ngay_cuoi FROM clean_reviews"""

CLEAN_COMMENTS = f"""raw0 AS (
  SELECT l_orderkey * 8 + l_linenumber AS comment_id, l_partkey AS product_id, o_custkey AS customer_id,
         c_name AS customer_name, CAST({RATING} AS VARCHAR) AS rating,
         concat_ws(' ', 'order', o_orderstatus, l_returnflag) AS title,
         concat_ws(' ', o_orderpriority, 'qty', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS content,
         CAST(epoch(l_shipdate)::BIGINT AS VARCHAR) AS created_at,
         CAST(epoch(o_orderdate)::BIGINT AS VARCHAR) AS purchased_at,
         l_suppkey AS seller_id, s_name AS seller_name, l_quantity AS quantity
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey)"""
RAW_COMMENTS = f"""{CLEAN_COMMENTS},
raw_comments AS (
  SELECT comment_id, product_id, customer_id, CASE WHEN quantity = 47 THEN NULL ELSE customer_name END AS customer_name,
         CASE WHEN quantity = 48 THEN 'five' ELSE rating END AS rating, title,
         CASE WHEN p_size = 7 THEN NULL WHEN p_size = 8 THEN chr(10) || chr(9) || chr(160)
              ELSE concat_ws(' ', content, p_name, lower(p_type), seller_name, CAST(p_size AS VARCHAR)) END AS content,
         CASE WHEN quantity = 50 THEN 'n/a' WHEN quantity = 49 THEN '-99999999999999'
              WHEN substr(content, 1, 1) IN ('1', '2') THEN CAST(CAST(purchased_at AS BIGINT)
                + 86400 * (1 + customer_id % 40) + 45 * (comment_id % 8) AS VARCHAR)
              ELSE created_at END AS created_at,
         purchased_at, seller_id, seller_name, quantity
  FROM raw0 LEFT JOIN part ON p_partkey = product_id)"""
_AFTER_TIME = ["product_id", "customer_id", "customer_name", "rating", "title", "content", "created_at", "purchased_at",
               "seller_id", "seller_name", "quantity"]
for _name, _way in (("dedup_comments", "ASC NULLS FIRST"), ("dedup_comments_last", "DESC NULLS LAST")):
    SQL[_name] = (f"WITH {RAW_COMMENTS} SELECT * FROM raw_comments QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY "
                  f"TRY_CAST(created_at AS DOUBLE) {_way}, " + ", ".join(f"{c} {_way}" for c in _AFTER_TIME) + ") = 1")
SQL["duplicate_count"] = f"""WITH {CLEAN_COMMENTS} SELECT CAST(count(*) AS BIGINT) AS total_rows,
  count(DISTINCT comment_id) AS distinct_keys, CAST(count(*) - count(DISTINCT comment_id) AS BIGINT) AS duplicate_rows
  FROM raw0"""


# ------------------------------------------------------------ text (SQL) ----
ASCII_WS = r" \t\n\x0B\f\r"
UNICODE_WS = ASCII_WS + r"\x1C-\x1F\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = r"\p{L}\p{N}_"
ABBR_JOB, ABBR_NB = list(ABBREVIATIONS_JOB.items()), list(ABBREVIATIONS_NOTEBOOK.items())


def _re(x: str, pat: str, rep: str) -> str:
    return f"regexp_replace({x}, '{pat}', '{rep}', 'g')"


def _squeeze(x: str, ws: str = ASCII_WS) -> str:
    return f"trim({_re(x, f'[{ws}]+', ' ')}, ' ')"


def _map_words(words: str, pairs) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"list_transform({words}, lambda w: CASE w {cases} ELSE w END)"


def sql_expand(x: str, pairs=ABBR_JOB) -> str:
    return f"array_to_string({_map_words(f'string_split({x}, chr(32))', pairs)}, ' ')"


def sql_clean_text(x: str) -> str:
    c = f"lower(coalesce(CAST({x} AS VARCHAR), ''))"
    c = _re(c, f"http[^{ASCII_WS}]+|www[^{ASCII_WS}]+", " ")
    c = _re(c, f"[@#][{WORD}]+", " ")
    c = _re(c, f"[^{WORD}{ASCII_WS}]", " ")
    c = _squeeze(c)
    return _squeeze(sql_expand(c))


def sql_lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_unescape(x: str) -> str:
    """HTML references: every reference is looked up among what Python's html.unescape
    makes of each name; numeric ones by code point.  Its own table and rules."""
    known = {"&" + n: html.unescape("&" + n) for n in html.entities.html5}
    odd = {n: html.unescape(f"&#{n};") for n in [0, *range(1, 32), *range(127, 160)]}
    names, codes = (f"MAP([{', '.join(keys)}], [{', '.join(map(sql_lit, m.values()))}])"
                    for keys, m in ((map(sql_lit, known), known), (map(str, odd), odd)))
    numeric = ("CASE WHEN n IS NULL OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN '\uFFFD' WHEN map_contains(odd, n) THEN odd[n] "
               "WHEN n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE chr(n::INT) END")
    old = " ".join(f"WHEN map_contains(names, r[:{k}]) THEN names[r[:{k}]] || r[{k + 1}:]" for k in range(7, 2, -1))
    pattern = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
    return (f"(CASE WHEN NOT contains({x}, '&') THEN {x} ELSE (SELECT string_agg(piece || CASE WHEN r[2] = '#' THEN {numeric} "
            f"WHEN map_contains(names, r) THEN names[r] {old} ELSE r END, '' ORDER BY i) FROM ("
            f"SELECT *, CASE WHEN r[2] <> '#' THEN NULL WHEN lower(r[3]) = 'x' THEN TRY_CAST('0x' || rtrim(r[4:], ';') AS BIGINT) "
            f"ELSE TRY_CAST(rtrim(r[3:], ';') AS BIGINT) END AS n FROM ("
            f"SELECT unnest(regexp_split_to_array({x}, '{pattern}')) AS piece, unnest(list_concat(regexp_extract_all({x}, '{pattern}'), [''])) AS r, "
            f"generate_subscripts(regexp_split_to_array({x}, '{pattern}'), 1) AS i) p, (SELECT {names} AS names, {codes} AS odd) known)) END)")


def sql_clean_text_v2(x: str) -> str:
    c = sql_unescape(f"coalesce(CAST({x} AS VARCHAR), '')")
    c = _re(c, f"@[^{UNICODE_WS}]+", "")
    c = _re(c, f"#([{WORD}]+)", r"\1")
    c = _re(c, f"https?://[^{UNICODE_WS}]+|www\\.[^{UNICODE_WS}]+", "")
    c = _re(c, r"[\x{10000}-\x{10FFFF}]", "")
    c = _re(c, f"[^{WORD}{UNICODE_WS}]", " ")
    return _squeeze(c, UNICODE_WS)


def sql_words(x: str, ws: str = UNICODE_WS) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({x}, ''), '[{ws}]+'), lambda w: w <> '')"


def sql_normalize(x: str) -> str:
    c = _re(f"lower(coalesce({x}, ''))", f"[^{WORD}{UNICODE_WS}]", " ")
    return f"array_to_string({_map_words(sql_words(c), ABBR_NB)}, ' ')"


def sql_safe_text(x: str) -> str:
    c = _re(f"coalesce(CAST({x} AS VARCHAR), '')", r"[\r\n]+", " ")
    c = f"replace(replace({c}, '\"', ''''), ',', ' ')"
    return _squeeze(c)


STOPWORDS = ["the", "and", "of", "a", "to", "in", "is", "de", "la", "le", "les", "et",
             "des", "du", "el", "los", "las", "y", "en", "der", "die", "das", "und"]

SQL["clean_text"] = f"SELECT doc_id, {sql_clean_text('text')} AS content_text FROM documents"
SQL["clean_text_v2"] = f"SELECT doc_id, {sql_clean_text_v2('text')} AS content_text FROM documents"
SQL["unescape_html"] = f"SELECT page_id, {sql_unescape('html')} AS html FROM pages"
ESCAPED = r"""(SELECT conv_id, turn, CASE turn % 5
    WHEN 0 THEN replace(replace(text, 'e', '&eacute;'), ' ', '&nbsp;&ensp;') WHEN 1 THEN replace(replace(text, 'a', '&#97'), 'o', '&#x6F;')
    WHEN 2 THEN replace(replace(text, 'i', '&notit;'), ' the', '&ampthe&copy') WHEN 3 THEN replace(replace(text, 'n', '&#150;'), 's', '&#' || length(text) * 97 || ';')
    ELSE '&lt;p&gt;' || replace(text, ' ', '&CounterClockwiseContourIntegral;&no such;') || '&#x1F600;&#0;&#xD800;&#5;' END AS text FROM conversations)"""
SQL["unescape_forms"] = f"SELECT conv_id, turn, {sql_unescape('text')} AS text FROM {ESCAPED}"
SQL["clean_escaped_text"] = f"SELECT conv_id, turn, {sql_clean_text_v2('text')} AS content_text FROM {ESCAPED}"
SQL["normalize_text"] = f"SELECT doc_id, {sql_normalize(sql_clean_text_v2('text'))} AS content_text FROM documents"
_sw = ", ".join(f"'{w}'" for w in STOPWORDS)
SQL["remove_stopwords"] = (f"SELECT doc_id, array_to_string(list_filter({sql_words(sql_normalize(sql_clean_text_v2('text')))}, "
                           f"lambda w: NOT list_contains([{_sw}], w)), ' ') AS content_text FROM documents")
SQL["safe_csv_text"] = f"SELECT doc_id, {sql_safe_text('text')} AS safe_text FROM documents"
SQL["expand_abbreviations"] = (f"SELECT conv_id AS customer_id, turn AS comment_id, "
                               f"{sql_expand('lower(text)', ABBR_NB)} AS content_text FROM conversations")

# ----------------------------------------------------------- flags (SQL) ----
SECS = "CAST(floor(epoch_us({x}) / 1000000.0) AS BIGINT)"


def secs(x: str) -> str:
    return SECS.format(x=x)


def burst_sql(src: str) -> str:
    """Reference formulation: lag, running resets, second window per group."""
    return f"""
g1 AS (SELECT *, lag(created_at_ts) OVER (PARTITION BY customer_id ORDER BY created_at_ts, comment_id)
         AS previous_created_at_ts FROM {src}),
g2 AS (SELECT *, (({secs('created_at_ts')}) - ({secs('previous_created_at_ts')})) / CAST(60.0 AS DOUBLE)
         AS delta_minutes FROM g1),
thr AS (SELECT coalesce(CAST({QDISC('(SELECT delta_minutes FROM g2 WHERE delta_minutes > 0)', 'delta_minutes', 0.05)}
         AS DOUBLE), 0.0) AS t),
g3 AS (SELECT g2.*, (delta_minutes > 0 AND delta_minutes <= (SELECT t FROM thr)) AS small_gap FROM g2),
g4 AS (SELECT *, CAST(sum(CASE WHEN coalesce(small_gap, false) THEN 0 ELSE 1 END) OVER
         (PARTITION BY customer_id ORDER BY created_at_ts, comment_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
         AS burst_group FROM g3),
g5 AS (SELECT *, CAST(CASE WHEN small_gap THEN sum(CASE WHEN small_gap THEN 1 ELSE 0 END) OVER
         (PARTITION BY customer_id, burst_group ORDER BY created_at_ts, comment_id ROWS UNBOUNDED PRECEDING)
         ELSE 0 END AS BIGINT) AS burst_count FROM g4),
bursts AS (SELECT *, burst_count >= 4 AS F3_flag FROM g5)"""


def notebook_burst_sql(src: str) -> str:
    """Threshold over all gaps; zero gaps are small."""
    return (burst_sql(src).replace("WHERE delta_minutes > 0)", "WHERE delta_minutes IS NOT NULL)")
            .replace("(delta_minutes > 0 AND", "(delta_minutes >= 0 AND"))


EVENTS = "events_in AS (SELECT event_id AS comment_id, user_id AS customer_id, CAST(ts AS TIMESTAMP) AS created_at_ts FROM events)"
SQL["burst_flags"] = f"WITH {EVENTS}, {burst_sql('events_in')} SELECT * FROM bursts"
SQL["burst_flags_plain_window"] = SQL["burst_flags"]
SQL["burst_threshold"] = f"WITH {EVENTS}, {burst_sql('events_in')} SELECT t AS threshold FROM thr"

_TIMES = f"""times AS (SELECT DISTINCT comment_id, customer_id, {{ts}} AS created_at_ts FROM raw_comments WHERE {{ts}} IS NOT NULL)"""
_COMMENT_COLS = ["product_id", "customer_id", "customer_name", "rating", "title", "content", "created_at",
                 "purchased_at", "seller_id", "seller_name", "quantity"]
DEDUP_COMMENTS = ("comments AS (SELECT * FROM raw_comments QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY "
                  + ", ".join(f"{c} ASC NULLS FIRST" for c in _COMMENT_COLS) + ") = 1)")


def ts_of(x: str) -> str:
    v = f"TRY_CAST({x} AS DOUBLE)"
    return (f"CASE WHEN {v} BETWEEN -62135596800 AND 253402300799 "
            f"THEN make_timestamp(CAST(trunc({v}) AS BIGINT) * 1000000) END")


TIMES = _TIMES.format(ts=ts_of("created_at"))
COARSE_TIMES = f"""fine AS ({TIMES[len('times AS ('):]},
times AS (SELECT comment_id, customer_id, make_timestamp(CAST(floor(epoch(created_at_ts) / 90) AS BIGINT) * 90000000) AS created_at_ts
  FROM fine)"""
SQL["burst_flags_orders"] = f"WITH {RAW_COMMENTS}, {TIMES}, {burst_sql('times')} SELECT * FROM bursts"
SQL["burst_flags_notebook"] = f"WITH {RAW_COMMENTS}, {COARSE_TIMES}, {notebook_burst_sql('times')} SELECT * FROM bursts"

MERGED = f"""{RAW_COMMENTS}, {DEDUP_COMMENTS},
products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price, p_brand AS brand_name
  FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY p_name ASC NULLS FIRST,
  p_retailprice ASC NULLS FIRST, p_brand ASC NULLS FIRST) = 1),
joined AS (SELECT c.*, p.product_name, p.price, p.brand_name FROM comments c JOIN products p USING (product_id)
  WHERE c.comment_id IS NOT NULL AND c.product_id IS NOT NULL AND c.customer_id IS NOT NULL AND c.rating IS NOT NULL
    AND c.content IS NOT NULL AND c.created_at IS NOT NULL AND c.purchased_at IS NOT NULL),
conv AS (SELECT * REPLACE (TRY_CAST(rating AS DOUBLE) AS rating),
    CAST(trunc(TRY_CAST(created_at AS DOUBLE)) AS BIGINT) AS created_at_num,
    CAST(trunc(TRY_CAST(purchased_at AS DOUBLE)) AS BIGINT) AS purchased_at_num,
    {ts_of('created_at')} AS created_at_ts, {ts_of('purchased_at')} AS purchased_at_ts FROM joined),
conv2 AS (SELECT * REPLACE ({sql_safe_text('product_name')} AS product_name, {sql_safe_text('customer_name')} AS customer_name,
    {sql_safe_text('content')} AS content, {sql_safe_text('title')} AS title),
    {sql_clean_text('content')} AS content_text
  FROM conv WHERE created_at_ts IS NOT NULL AND purchased_at_ts IS NOT NULL AND rating IS NOT NULL),
{burst_sql('conv2')},
tg AS (SELECT *, (({secs('created_at_ts')}) - ({secs('purchased_at_ts')})) / CAST(60.0 AS DOUBLE) AS time_gap_minutes FROM bursts),
tthr AS (SELECT coalesce(CAST({QDISC('(SELECT time_gap_minutes FROM tg WHERE time_gap_minutes > 0)', 'time_gap_minutes', 0.05)}
  AS DOUBLE), 0.0) AS t),
f5 AS (SELECT tg.*, (time_gap_minutes > 0 AND time_gap_minutes <= (SELECT t FROM tthr)) AS F5_flag FROM tg),
merged AS (SELECT *, (coalesce(F3_flag, false) OR coalesce(F5_flag, false)) AS is_spam FROM f5)"""

SQL["merged"] = f"WITH {MERGED} SELECT * FROM merged"
UNFLAGGED = f"""{MERGED},
clean_reviews AS (SELECT comment_id, customer_id, customer_name, purchased_at_ts AS purchased_at, created_at_ts AS created_at,
    rating, seller_name FROM merged
  WHERE NOT coalesce(F3_flag, false) AND NOT coalesce(F5_flag, false)
    AND purchased_at_ts BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2035-12-31'
    AND created_at_ts BETWEEN TIMESTAMP '1990-01-01' AND TIMESTAMP '2035-12-31'),{RFM_TAIL}"""
SQL["unflagged_segments"] = f"WITH {UNFLAGGED} SELECT * FROM segments"
SQL["unflagged_monthly_trend"] = f"WITH {UNFLAGGED} SELECT * FROM monthly"
SQL["unflagged_seller_totals"] = (f"WITH {UNFLAGGED} SELECT seller_name, count(DISTINCT comment_id) AS so_don "
                                  "FROM clean_reviews GROUP BY 1")
FLAGGED = f"""{REVIEWS}, flagged AS (
  SELECT r.comment_id, CASE WHEN o_totalprice >= 20000 THEN r.customer_id END AS customer_id, customer_name,
         CASE WHEN rating <> 3 THEN purchased_at END AS purchased_at, created_at, rating,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus = 'F' END AS F3_flag, rating = 1 AS F5_flag
  FROM reviews r JOIN orders ON o_orderkey = r.comment_id)"""
SQL["clean_flag_filter"] = (f"WITH {FLAGGED} SELECT * FROM flagged WHERE NOT coalesce(F3_flag, false) "
                            "AND NOT coalesce(F5_flag, false)")
SQL["drop_missing_customer_or_date"] = (f"WITH {FLAGGED} SELECT * FROM flagged WHERE customer_id IS NOT NULL "
                                        "AND purchased_at IS NOT NULL")
SQL["drop_required_nulls"] = (f"WITH {RAW_COMMENTS} SELECT * FROM raw_comments WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ["comment_id", "product_id", "customer_id", "rating", "content", "created_at", "purchased_at"]))
SQL["timegap_threshold"] = f"""WITH {RAW_COMMENTS}, {DEDUP_COMMENTS},
tg AS (SELECT ((({secs(ts_of('created_at'))}) - ({secs(ts_of('purchased_at'))})) / CAST(60.0 AS DOUBLE)) AS time_gap_minutes
  FROM comments WHERE {ts_of('created_at')} IS NOT NULL AND {ts_of('purchased_at')} IS NOT NULL
  AND TRY_CAST(rating AS DOUBLE) IS NOT NULL)
SELECT coalesce(CAST({QDISC('(SELECT time_gap_minutes FROM tg WHERE time_gap_minutes > 0)', 'time_gap_minutes', 0.05)}
  AS DOUBLE), 0.0) AS threshold"""

CNT = "CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"
SQL["overall_summary"] = f"""WITH {MERGED} SELECT count(*) AS total_comments, count(DISTINCT product_id) AS total_products,
  count(DISTINCT customer_id) AS total_customers, {CNT.format(c='is_spam')} AS spam_comments,
  {CNT.format(c='NOT is_spam')} AS normal_comments, {RND('avg(rating)', 6)} AS avg_rating FROM merged"""
PSUM = f"""SELECT product_id, product_name, count(*) AS comment_count, {RND('avg(rating)', 6)} AS avg_rating,
  {CNT.format(c='is_spam')} AS spam_count FROM merged GROUP BY product_id, product_name"""
CSUM = f"""SELECT customer_id, customer_name, count(*) AS comment_count, {CNT.format(c='F3_flag')} AS F3_count,
  {CNT.format(c='F5_flag')} AS F5_count, {CNT.format(c='is_spam')} AS spam_count FROM merged GROUP BY customer_id, customer_name"""
SQL["product_summary"] = f"WITH {MERGED} {PSUM}"
SQL["customer_summary"] = f"WITH {MERGED} {CSUM}"
SQL["top_products_by_comments"] = f"WITH {MERGED} {PSUM} ORDER BY comment_count DESC, product_id LIMIT 20"
SQL["top_customers_by_spam"] = f"WITH {MERGED} {CSUM} ORDER BY spam_count DESC, comment_count DESC, customer_id LIMIT 20"
SQL["flagged_history_f3"] = f"""WITH {MERGED} SELECT customer_id, created_at_ts, purchased_at_ts, delta_minutes, burst_count,
  F3_flag, comment_id FROM merged WHERE customer_id IN (SELECT customer_id FROM merged WHERE F3_flag)"""
SQL["flagged_history_f5"] = f"""WITH {MERGED} SELECT customer_id, comment_id, created_at_ts, purchased_at_ts, time_gap_minutes,
  F5_flag FROM merged WHERE customer_id IN (SELECT customer_id FROM merged WHERE F5_flag)"""
SQL["null_profile"] = f"WITH {RAW_COMMENTS} SELECT " + ", ".join(
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in ["comment_id"] + _COMMENT_COLS) + " FROM raw_comments"
SQL["drop_blank_content"] = f"""SELECT * FROM (SELECT conv_id AS customer_id, turn AS comment_id,
  CASE turn WHEN 2 THEN chr(10) || chr(9) WHEN 3 THEN chr(160) || ' ' || chr(8195) WHEN 4 THEN NULL ELSE text END AS content
  FROM conversations) WHERE regexp_matches(coalesce(content, ''), '[^{UNICODE_WS}]')"""
SQL["rating_filter"] = f"WITH {REVIEWS} SELECT * FROM reviews WHERE rating >= 4"


# ------------------------------------------------------ similarity (SQL) ----
def sim_sql(src: str) -> str:
    """Per-user TF-IDF cosine, pairs enumerated explicitly (src has
    customer_id, comment_id, content)."""
    return f"""
sc AS (SELECT * FROM {src} WHERE regexp_matches(coalesce(content, ''), '[^{UNICODE_WS}]')),
su AS (SELECT customer_id, count(*) AS n FROM sc GROUP BY customer_id),
stok AS (SELECT customer_id, comment_id, unnest(regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM sc),
stf AS (SELECT customer_id, comment_id, term, count(*) AS tf FROM stok GROUP BY ALL),
sdf AS (SELECT customer_id, term, count(*) AS df FROM stf GROUP BY ALL),
sw AS (SELECT stf.*, tf * (ln((n + 1.0) / (df + 1.0)) + 1.0) AS w FROM stf JOIN sdf USING (customer_id, term)
       JOIN su USING (customer_id) WHERE n >= 2),
sv AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY customer_id, comment_id)) AS v FROM sw),
spairs AS (SELECT a.customer_id, a.comment_id AS i, b.comment_id AS j, sum(a.v * b.v) AS sim FROM sv a JOIN sv b
           ON a.customer_id = b.customer_id AND a.term = b.term AND a.comment_id < b.comment_id GROUP BY ALL),
sstat AS (SELECT su.customer_id,
            greatest(0.0, coalesce((SELECT sum(sim) FROM spairs p WHERE p.customer_id = su.customer_id), 0.0)
              * 2.0 / (n * (n - 1))) AS mean_similarity,
            coalesce((SELECT max(sim) FROM spairs p WHERE p.customer_id = su.customer_id), 0.0) AS max_similarity
          FROM su WHERE n >= 2 AND su.customer_id IN (SELECT customer_id FROM sv)),
sall AS (SELECT DISTINCT customer_id FROM {src}),
sim AS (SELECT sall.customer_id, mean_similarity, max_similarity FROM sall LEFT JOIN sstat USING (customer_id)),
sthr AS (SELECT avg(mean_similarity) + stddev_samp(mean_similarity) AS threshold_mean,
                avg(max_similarity) + stddev_samp(max_similarity) AS threshold_max FROM sim
         WHERE mean_similarity IS NOT NULL AND max_similarity IS NOT NULL),
simf AS (SELECT customer_id, {RND('mean_similarity', 6)} AS mean_similarity, {RND('max_similarity', 6)} AS max_similarity,
           coalesce(mean_similarity >= (SELECT threshold_mean FROM sthr) OR max_similarity >= (SELECT threshold_max FROM sthr),
                    false) AS F4_Flag FROM sim)"""


CONV = "conv_in AS (SELECT conv_id AS customer_id, turn AS comment_id, text AS content FROM conversations)"
SQL["text_similarity"] = f"WITH {CONV}, {sim_sql('conv_in')} SELECT * FROM simf"
SQL["similarity_thresholds"] = (f"WITH {CONV}, {sim_sql('conv_in')} SELECT {RND('threshold_mean', 6)} AS threshold_mean, "
                                f"{RND('threshold_max', 6)} AS threshold_max FROM sthr")
SQL["attach_similarity"] = (f"WITH {CONV}, {sim_sql('conv_in')} SELECT c.*, f.mean_similarity, f.max_similarity, f.F4_Flag "
                            "FROM conv_in c LEFT JOIN simf f USING (customer_id)")
SQL["comments_per_user"] = (f"WITH {CONV} SELECT customer_id, comment_id, content, count(*) OVER (PARTITION BY customer_id) "
                            "AS n_comments FROM conv_in")
NB_MERGED = f"""{MERGED}, m_in AS (SELECT customer_id, comment_id, content FROM merged), {sim_sql('m_in')},
nb AS (SELECT m.*, f.mean_similarity, f.max_similarity, f.F4_Flag,
  (coalesce(m.F3_flag, false) OR coalesce(f.F4_Flag, false) OR coalesce(m.F5_flag, false)) AS nb_spam
  FROM merged m LEFT JOIN simf f USING (customer_id))"""
SQL["notebook_merged"] = f"WITH {NB_MERGED} SELECT * EXCLUDE (is_spam, nb_spam), nb_spam AS is_spam FROM nb"
SQL["spam_ham_split"] = f"""WITH {NB_MERGED}, lab AS (SELECT *, CASE WHEN coalesce(F3_flag, false) OR coalesce(F4_Flag, false)
  OR coalesce(F5_flag, false) THEN 'spam' WHEN coalesce(F3_flag = false AND F4_Flag = false AND F5_flag = false, false)
  THEN 'ham' END AS label FROM nb)
  SELECT label, count(*) AS rows, count(DISTINCT customer_id) AS customers FROM lab GROUP BY label"""
SQL["balanced_sample"] = f"""WITH {NB_MERGED}, lab AS (SELECT *, CASE WHEN coalesce(F3_flag, false) OR coalesce(F4_Flag, false)
  OR coalesce(F5_flag, false) THEN 'spam' WHEN coalesce(F3_flag = false AND F4_Flag = false AND F5_flag = false, false)
  THEN 'ham' END AS label FROM nb),
hashed AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ('0x' || substr(md5(comment_id::VARCHAR || ':42'), 1, 15))::BIGINT,
  comment_id) AS rn FROM lab WHERE label IS NOT NULL)
SELECT comment_id, customer_id, label, F3_flag, F4_Flag, F5_flag FROM hashed
WHERE rn <= CAST(floor(0.1 * (SELECT count(*) FROM nb) / 2) AS BIGINT)"""
SQL["short_word_counts"] = f"""SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower({sql_clean_text_v2('text')}),
  '[\\p{{L}}\\p{{N}}_]+')) AS word FROM documents) WHERE length(word) BETWEEN 1 AND 2
  GROUP BY word ORDER BY freq DESC, word LIMIT 50"""
SQL["parse_event_props"] = "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"


# --------------------------------------------------- recommendations (SQL) ----
def FMT(x: str, d: int) -> str:
    """Java-style %.{d}f: half-up on the shortest decimal text."""
    return f"CAST(CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DECIMAL(38,{d})) AS VARCHAR)"


PP = "pp AS MATERIALIZED (SELECT DISTINCT o_custkey AS customer_id, l_partkey AS product_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE " + RATING + " >= 4)"
BB = ("bb AS MATERIALIZED (SELECT DISTINCT l_orderkey AS customer_id, p_brand AS product_id FROM lineitem "
      "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE " + RATING + " >= 4)")


def fim_sql(p: str, src: str, min_support: float, min_count: int = 1, levels: int = 9) -> str:
    """Apriori inside each basket: extend only frequent prefixes."""
    out = [f"{p}n AS MATERIALIZED (SELECT count(DISTINCT customer_id) AS n FROM {src})",
           f"{p}mc AS MATERIALIZED (SELECT greatest({min_count}, CAST(ceil(CAST({min_support} AS DOUBLE) * n) AS BIGINT)) AS mc FROM {p}n)",
           f"{p}R1 AS MATERIALIZED (SELECT customer_id, [product_id] AS s, product_id AS last FROM {src})",
           f"{p}L1 AS MATERIALIZED (SELECT s, count(*) AS freq FROM {p}R1 GROUP BY s HAVING count(*) >= (SELECT mc FROM {p}mc))",
           f"{p}F1 AS MATERIALIZED (SELECT r.* FROM {p}R1 r JOIN {p}L1 l ON r.s = l.s)"]
    for k in range(2, levels + 1):
        out.append(f"{p}R{k} AS MATERIALIZED (SELECT r.customer_id, list_append(r.s, x.last) AS s, x.last AS last FROM {p}F{k-1} r "
                   f"JOIN {p}F1 x ON r.customer_id = x.customer_id AND x.last > r.last)")
        out.append(f"{p}L{k} AS MATERIALIZED (SELECT s, count(*) AS freq FROM {p}R{k} GROUP BY s HAVING count(*) >= (SELECT mc FROM {p}mc))")
        out.append(f"{p}F{k} AS MATERIALIZED (SELECT r.* FROM {p}R{k} r JOIN {p}L{k} l ON r.s = l.s)")
    union = " UNION ALL ".join(f"SELECT s, freq FROM {p}L{k}" for k in range(1, levels + 1))
    out.append(f"{p}IS AS MATERIALIZED ({union})")
    out.append(f"{p}items AS MATERIALIZED (SELECT s AS items, freq, CAST(freq AS DOUBLE) / (SELECT n FROM {p}n) AS support FROM {p}IS)")
    return ",\n".join(out)


def rules_sql(p: str, min_conf: float, min_lift: float) -> str:
    return f"""{p}ex AS MATERIALIZED (SELECT s, freq, unnest(s) AS c FROM {p}IS WHERE len(s) >= 2),
{p}rules AS MATERIALIZED (SELECT list_filter(e.s, lambda x: x <> e.c) AS antecedent, [e.c] AS consequent,
    CAST(e.freq AS DOUBLE) / (SELECT n FROM {p}n) AS support,
    CAST(e.freq AS DOUBLE) / a.freq AS confidence,
    (CAST(e.freq AS DOUBLE) / a.freq) / (CAST(cs.freq AS DOUBLE) / (SELECT n FROM {p}n)) AS lift
  FROM {p}ex e JOIN {p}IS a ON a.s = list_filter(e.s, lambda x: x <> e.c) JOIN {p}IS cs ON cs.s = [e.c]
  WHERE CAST(e.freq AS DOUBLE) / a.freq >= {min_conf}
    AND (CAST(e.freq AS DOUBLE) / a.freq) / (CAST(cs.freq AS DOUBLE) / (SELECT n FROM {p}n)) >= {min_lift})"""


def baskets_sql(p: str, src: str) -> str:
    return f"{p}tx AS MATERIALIZED (SELECT customer_id, list_sort(list(product_id)) AS items FROM {src} GROUP BY customer_id)"


def R6(cols: str) -> str:
    return ", ".join(f"{RND(c, 6)} AS {c}" for c in cols.split(","))


BRAND = f"{BB}, {baskets_sql('b_', 'bb')}, {fim_sql('b_', 'bb', 0.003)}, {rules_sql('b_', 0.05, 1.0)}"
PART = f"{PP}, {baskets_sql('p_', 'pp')}, {fim_sql('p_', 'pp', 0.002, 2)}, {rules_sql('p_', 0.1, 1.0)}"
ORDER_RULES = "ORDER BY lift DESC, confidence DESC, CAST(antecedent AS VARCHAR), CAST(consequent AS VARCHAR)"

SQL["customer_baskets"] = f"WITH {PP}, {baskets_sql('p_', 'pp')} SELECT * FROM p_tx"
SQL["transactions"] = f"WITH {BB}, {baskets_sql('b_', 'bb')} SELECT * FROM b_tx WHERE len(items) > 0"
SQL["product_name_map"] = """SELECT l_partkey AS product_id, arg_min(p_name, l_orderkey * 8 + l_linenumber) AS product_name
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_name IS NOT NULL GROUP BY l_partkey"""
SQL["item_catalog"] = (f"WITH {PP} SELECT item, row_number() OVER (ORDER BY item) - 1 AS idx FROM "
                       "(SELECT DISTINCT product_id AS item FROM pp)")
SQL["frequent_itemsets"] = f"WITH {BRAND} SELECT items, freq, {RND('support', 6)} AS support FROM b_items"
SQL["frequent_itemsets_unbounded"] = (f"WITH {BB}, {fim_sql('b_', 'bb', 1e-9, levels=13)} "
                                      f"SELECT items, freq, {RND('support', 6)} AS support FROM b_items")
SQL["part_itemsets"] = f"WITH {PART} SELECT items, freq, {RND('support', 6)} AS support FROM p_items"
SQL["association_rules"] = f"WITH {BRAND} SELECT antecedent, consequent, {R6('support,confidence,lift')} FROM b_rules"
SQL["rules_sorted"] = SQL["association_rules"]
SQL["top_rules_by_lift"] = (f"WITH {BRAND}, t AS (SELECT * FROM b_rules {ORDER_RULES} LIMIT 10) "
                            f"SELECT antecedent, consequent, {R6('support,confidence,lift')} FROM t")
SQL["top_rules_by_confidence"] = (f"WITH {BRAND}, t AS (SELECT * FROM b_rules ORDER BY confidence DESC, lift DESC, "
                                  "CAST(antecedent AS VARCHAR), CAST(consequent AS VARCHAR) LIMIT 10) "
                                  f"SELECT antecedent, consequent, {R6('support,confidence,lift')} FROM t")
SQL["top_itemsets"] = (f"WITH {BRAND}, t AS (SELECT * FROM b_items ORDER BY freq DESC, CAST(items AS VARCHAR) LIMIT 5) "
                       f"SELECT items, freq, {RND('support', 6)} AS support FROM t")
SQL["rule_quality"] = f"""WITH {BRAND} SELECT count(*) AS num_rules,
  {RND('coalesce(avg(confidence), 0.0)', 6)} AS avg_confidence, {RND('coalesce(avg(lift), 0.0)', 6)} AS avg_lift,
  {RND('coalesce(avg(support), 0.0)', 6)} AS avg_support, {RND('coalesce(max(confidence), 0.0)', 6)} AS max_confidence,
  {RND('coalesce(max(lift), 0.0)', 6)} AS max_lift, {RND('coalesce(min(confidence), 0.0)', 6)} AS min_confidence,
  {RND('coalesce(min(lift), 0.0)', 6)} AS min_lift, {RND('coalesce(stddev_pop(confidence), 0.0)', 6)} AS std_confidence,
  {RND('coalesce(stddev_pop(lift), 0.0)', 6)} AS std_lift FROM b_rules"""
SQL["itemset_coverage"] = f"""WITH {BRAND} SELECT {RND('coalesce(avg(CASE WHEN list_has_any(items, (SELECT list(s[1]) FROM b_IS WHERE len(s) = 1)) THEN 1.0 ELSE 0.0 END), 0.0)', 6)} AS coverage FROM b_tx"""
SQL["export_rules"] = f"""WITH {BRAND} SELECT array_to_string(list_sort(antecedent), ', ') AS Antecedent_Products,
  array_to_string(list_sort(consequent), ', ') AS Consequent_Products, {FMT('support', 4)} AS Support,
  {FMT('confidence', 4)} AS Confidence, {FMT('lift', 4)} AS Lift FROM b_rules"""
SQL["export_rules_named"] = f"""WITH {PART}, t AS (SELECT *, row_number() OVER ({ORDER_RULES}) AS Rule_ID FROM p_rules),
top AS (SELECT * FROM t WHERE Rule_ID <= 1000),
nm AS (SELECT p_partkey, p_name FROM part)
SELECT Rule_ID,
  array_to_string(list_transform(antecedent, lambda x: CAST(x AS VARCHAR)), ', ') AS Antecedent_Products,
  (SELECT string_agg(coalesce(p_name, 'Unknown_ID_' || CAST(x AS VARCHAR)), ', ' ORDER BY i)
     FROM (SELECT unnest(antecedent) AS x, generate_subscripts(antecedent, 1) AS i) u LEFT JOIN nm ON nm.p_partkey = u.x)
     AS Antecedent_Product_Name,
  array_to_string(list_transform(consequent, lambda x: CAST(x AS VARCHAR)), ', ') AS Consequent_Products,
  (SELECT string_agg(coalesce(p_name, 'Unknown_ID_' || CAST(x AS VARCHAR)), ', ' ORDER BY i)
     FROM (SELECT unnest(consequent) AS x, generate_subscripts(consequent, 1) AS i) u LEFT JOIN nm ON nm.p_partkey = u.x)
     AS Consequent_Product_Name,
  {FMT('support', 4)} AS Support, {FMT('confidence', 4)} AS Confidence, {FMT('lift', 4)} AS Lift FROM top"""

PRED = f"""{BRAND}, pred AS MATERIALIZED (SELECT t.customer_id, r.antecedent, r.consequent,
    list_filter(r.consequent, lambda x: NOT list_contains(t.items, x)) AS new_items, r.confidence, r.lift, r.support
  FROM b_rules r JOIN b_tx t ON list_has_all(t.items, r.antecedent)),
pr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY confidence DESC, lift DESC,
    CAST(antecedent AS VARCHAR), CAST(consequent AS VARCHAR)) AS pred_rank FROM pred WHERE len(new_items) > 0)"""
SQL["predict_from_items"] = (f"WITH {PRED} SELECT customer_id, antecedent, new_items, {R6('confidence,lift,support')}, "
                             "pred_rank FROM pr")
SQL["recommend_for_items"] = f"""WITH {PRED}, e AS (SELECT customer_id, pred_rank, confidence, lift, support,
    unnest(new_items) AS item, generate_subscripts(new_items, 1) - 1 AS pos FROM pr WHERE pred_rank <= 5),
f AS (SELECT *, row_number() OVER (PARTITION BY customer_id, item ORDER BY pred_rank, pos) AS rn FROM e)
SELECT customer_id, item, {R6('confidence,lift,support')},
  CAST(row_number() OVER (PARTITION BY customer_id ORDER BY pred_rank, pos) AS INTEGER) AS position FROM f WHERE rn = 1"""
SQL["rule_explanations"] = (f"WITH {PRED} SELECT customer_id, pred_rank, antecedent, new_items AS consequent, "
                            f"{R6('confidence,lift,support')} FROM pr WHERE pred_rank <= 3")
SQL["similar_items"] = f"""WITH {BRAND}, e AS (SELECT unnest(antecedent) AS a, consequent, lift * confidence AS s FROM b_rules),
e2 AS (SELECT a, unnest(consequent) AS c, s FROM e),
bo AS (SELECT a AS item, c AS other, s FROM e2 UNION ALL SELECT c AS item, a AS other, s FROM e2),
sc AS (SELECT item, other, sum(s) AS score FROM bo WHERE item <> other GROUP BY ALL),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, other) AS INTEGER) AS rank FROM sc)
SELECT item, other, {RND('score', 6)} AS score, rank FROM rk WHERE rank <= 5"""


def hybrid_sql(p: str, top_n: int) -> str:
    """Rule scores + 0.5 x top-5-neighbour Jaccard scores, owned removed."""
    return f"""{p}rows AS MATERIALIZED (SELECT customer_id, unnest(items) AS product_id FROM {p}tx),
{p}rs AS MATERIALIZED (SELECT t.customer_id, unnest(r.consequent) AS product_id, r.lift FROM {p}rules r
  JOIN {p}tx t ON list_has_all(t.items, r.antecedent)),
{p}rscore AS MATERIALIZED (SELECT customer_id, product_id, sum(lift) AS score FROM {p}rs GROUP BY ALL),
{p}inter AS MATERIALIZED (SELECT a.customer_id, b.customer_id AS other_id, count(*) AS inter FROM {p}rows a JOIN {p}rows b
  ON a.product_id = b.product_id AND a.customer_id <> b.customer_id GROUP BY ALL),
{p}jac AS MATERIALIZED (SELECT i.customer_id, i.other_id, CAST(inter AS DOUBLE) / (len(x.items) + len(y.items) - inter) AS jaccard
  FROM {p}inter i JOIN {p}tx x ON x.customer_id = i.customer_id JOIN {p}tx y ON y.customer_id = i.other_id),
{p}nb AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY jaccard DESC, other_id) AS nrank FROM {p}jac),
{p}nscore AS MATERIALIZED (SELECT n.customer_id, r.product_id, sum(n.jaccard) AS score FROM {p}nb n JOIN {p}rows r ON r.customer_id = n.other_id
  WHERE n.nrank <= 5 GROUP BY ALL),
{p}nscore2 AS MATERIALIZED (SELECT * FROM {p}nscore s WHERE NOT EXISTS (SELECT 1 FROM {p}rows o WHERE o.customer_id = s.customer_id
  AND o.product_id = s.product_id)),
{p}parts AS MATERIALIZED (SELECT customer_id, product_id, score FROM {p}rscore UNION ALL
  SELECT customer_id, product_id, score * 0.5 FROM {p}nscore2),
{p}tot AS MATERIALIZED (SELECT customer_id, product_id, sum(score) AS score FROM {p}parts GROUP BY ALL),
{p}tot2 AS MATERIALIZED (SELECT * FROM {p}tot s WHERE NOT EXISTS (SELECT 1 FROM {p}rows o WHERE o.customer_id = s.customer_id
  AND o.product_id = s.product_id)),
{p}rk AS MATERIALIZED (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY {RND('score', 9)} DESC, product_id) AS INTEGER)
  AS rank FROM {p}tot2),
{p}recs AS MATERIALIZED (SELECT customer_id, rank, product_id, score FROM {p}rk WHERE rank <= {top_n})"""


HYB = f"{PART}, {hybrid_sql('p_', 5)}"
SQL["rule_scores"] = f"WITH {HYB} SELECT customer_id, product_id, {RND('score', 6)} AS score FROM p_rscore"
SQL["jaccard_pairs"] = f"WITH {HYB} SELECT customer_id, other_id, {RND('jaccard', 9)} AS jaccard FROM p_jac"
SQL["top_neighbours"] = (f"WITH {HYB} SELECT customer_id, other_id, {RND('jaccard', 9)} AS jaccard, "
                         "CAST(nrank AS INTEGER) AS nrank FROM p_nb WHERE nrank <= 5")
HOT = """h_pairs AS MATERIALIZED (SELECT DISTINCT o_custkey AS customer_id, -instr('FOP', o_orderstatus)::BIGINT AS product_id FROM orders
  UNION SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE """ + RATING + " >= 4)"
SQL["top_neighbours_hot"] = f"""WITH {HOT}, hn AS (SELECT customer_id, count(*) AS n FROM h_pairs GROUP BY 1),
hi AS (SELECT a.customer_id, b.customer_id AS other_id, count(*) AS inter FROM h_pairs a JOIN h_pairs b
  ON a.product_id = b.product_id AND a.customer_id <> b.customer_id GROUP BY ALL),
hj AS (SELECT hi.customer_id, other_id, CAST(inter AS DOUBLE) / (x.n + y.n - inter) AS jaccard FROM hi
  JOIN hn x ON x.customer_id = hi.customer_id JOIN hn y ON y.customer_id = hi.other_id),
hr AS (SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY jaccard DESC, other_id) AS INTEGER) AS nrank FROM hj)
SELECT customer_id, other_id, {RND('jaccard', 9)} AS jaccard, nrank FROM hr WHERE nrank <= 5"""
SQL["neighbour_scores"] = f"WITH {HYB} SELECT customer_id, product_id, {RND('score', 6)} AS score FROM p_nscore2"
SQL["hybrid_recommend"] = f"WITH {HYB} SELECT customer_id, rank, product_id, {RND('score', 6)} AS score FROM p_recs"
SQL["export_recommendations"] = f"""WITH {HYB} SELECT customer_id AS Customer_ID, rank AS Rank, product_id AS Product_ID,
  coalesce(p_name, 'Unknown') AS Product_Name FROM p_recs LEFT JOIN part ON p_partkey = product_id"""
SQL["recommend_with_fallback"] = f"""WITH {HYB}, {POP},
top5 AS (SELECT *, CAST(row_number() OVER (ORDER BY so_luot_mua DESC, product_id) AS INTEGER) AS rank FROM pop
  ORDER BY so_luot_mua DESC, product_id LIMIT 5),
wanted AS (SELECT c_custkey AS customer_id FROM customer UNION SELECT DISTINCT o_custkey + 1000000000 FROM orders),
own AS (SELECT r.customer_id, r.rank, r.product_id, p_name AS product_name, 'fp_growth' AS type FROM p_recs r
  LEFT JOIN part ON p_partkey = r.product_id WHERE r.customer_id IN (SELECT customer_id FROM wanted)),
fb AS (SELECT w.customer_id, t.rank, t.product_id, t.product_name, 'popularity_fallback' AS type FROM wanted w, top5 t
  WHERE w.customer_id NOT IN (SELECT customer_id FROM p_recs))
SELECT * FROM own UNION ALL SELECT * FROM fb"""
SQL["top_recommended_products"] = f"""WITH {HYB}, c AS (SELECT product_id, count(*) AS Recommendation_Count FROM p_recs GROUP BY 1
  ORDER BY Recommendation_Count DESC, product_id LIMIT 5)
SELECT product_id AS Product_ID, coalesce(p_name, 'Unknown') AS Product_Name, Recommendation_Count,
  {FMT('Recommendation_Count * 100.0 / (SELECT count(DISTINCT customer_id) FROM p_recs)', 2)} || '%' AS Percentage
  FROM c LEFT JOIN part ON p_partkey = product_id"""
SQL["verify_recommendations"] = f"""WITH {HYB}, j AS (SELECT r.product_id, p.p_partkey IS NOT NULL AS known FROM p_recs r
  LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON p.p_partkey = r.product_id)
SELECT count(*) AS total_recs, count(*) FILTER (WHERE known) AS mapped_count,
  count(*) FILTER (WHERE NOT known) AS unmapped_count, count(DISTINCT product_id) FILTER (WHERE NOT known) AS unmapped_ids,
  {RND('CASE WHEN count(*) > 0 THEN (1 - CAST(count(*) FILTER (WHERE NOT known) AS DOUBLE) / count(*)) * 100 ELSE 0.0 END', 6)}
    AS success_rate,
  CASE WHEN {RND('CASE WHEN count(*) > 0 THEN (1 - CAST(count(*) FILTER (WHERE NOT known) AS DOUBLE) / count(*)) * 100 ELSE 0.0 END', 6)}
    >= 99.0 THEN 'OK' ELSE 'WARNING' END AS status FROM j"""
RINGLESS = "(SELECT * FROM part WHERE NOT contains(p_name, 'ring'))"
SQL["verify_recommendations_unnamed"] = SQL["verify_recommendations"].replace("FROM part)", f"FROM {RINGLESS})")
SQL["unmapped_products"] = f"WITH {HYB} SELECT DISTINCT product_id FROM p_recs WHERE product_id NOT IN (SELECT p_partkey FROM {RINGLESS})"
SQL["all_recommended"] = f"WITH {HYB} SELECT DISTINCT product_id FROM p_recs"
SQL["basket_set_ops"] = f"""WITH {HYB}, n1 AS (SELECT * FROM p_nb WHERE nrank = 1)
SELECT n1.customer_id, n1.other_id, len(list_intersect(a.items, b.items)) AS n_common,
  len(list_distinct(list_concat(a.items, b.items))) AS n_union,
  len(list_filter(a.items, lambda x: NOT list_contains(b.items, x))) AS n_only_mine,
  len(list_filter(a.items, lambda x: NOT list_contains(b.items, x))) = 0 AS is_subset
  FROM n1 JOIN p_tx a ON a.customer_id = n1.customer_id JOIN p_tx b ON b.customer_id = n1.other_id"""
SPLIT = "('0x' || substr(md5(customer_id::VARCHAR || '|' || product_id::VARCHAR), 1, 8))::BIGINT % 100"
SQL["train_test_split"] = (f"WITH {PP} SELECT customer_id, product_id, CASE WHEN {SPLIT} >= 20 THEN 'train' ELSE 'test' END "
                           "AS part FROM pp")

EVAL = f"""{PP}, tr AS MATERIALIZED (SELECT * FROM pp WHERE {SPLIT} >= 20), te AS MATERIALIZED (SELECT * FROM pp WHERE {SPLIT} < 20),
{baskets_sql('e_', 'tr')}, {fim_sql('e_', 'tr', 0.002, 2)}, {rules_sql('e_', 0.1, 1.0)}, {hybrid_sql('e_', 10)},
act AS (SELECT DISTINCT customer_id, product_id FROM te),
sizes AS (SELECT customer_id, count(*) AS n_actual FROM act GROUP BY 1),
r AS MATERIALIZED (SELECT r.customer_id, r.rank, r.product_id, s.n_actual, CASE WHEN a.product_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM e_recs r JOIN sizes s USING (customer_id) LEFT JOIN act a USING (customer_id, product_id)),
r2 AS (SELECT *, sum(hit) OVER (PARTITION BY customer_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS hsf FROM r),
ks AS (SELECT unnest([1, 3, 5, 10]) AS k),
ex AS (SELECT r2.*, k FROM r2 JOIN ks ON k >= rank),
per AS (SELECT customer_id, k, n_actual, count(*) AS n_recs, sum(hit) AS hits,
  sum(CASE WHEN hit = 1 THEN CAST(hsf AS DOUBLE) / rank ELSE 0.0 END) AS ap_sum,
  min(CASE WHEN hit = 1 THEN rank END) AS first_hit, sum(hit / log2(rank + 1)) AS dcg FROM ex GROUP BY ALL),
pm AS (SELECT customer_id, k, CAST(hits AS DOUBLE) / n_recs AS precision, CAST(hits AS DOUBLE) / n_actual AS recall,
  ap_sum / least(k, n_actual) AS ap, coalesce(1.0 / CAST(first_hit AS DOUBLE), 0.0) AS rr,
  CASE WHEN (SELECT sum(1.0 / log2(i + 1)) FROM range(1, least(n_actual, k) + 1) t(i)) > 0
       THEN dcg / (SELECT sum(1.0 / log2(i + 1)) FROM range(1, least(n_actual, k) + 1) t(i)) ELSE 0.0 END AS ndcg FROM per),
rm AS (SELECT k, {RND('avg(precision)', 6)} AS precision, {RND('avg(recall)', 6)} AS recall, {RND('avg(ap)', 6)} AS map,
  {RND('avg(rr)', 6)} AS mrr, {RND('avg(ndcg)', 6)} AS ndcg FROM pm GROUP BY k)"""
SQL["ranking_metrics"] = f"WITH {EVAL} SELECT * FROM rm"
SQL["coverage_metrics"] = f"""WITH {EVAL}, r5 AS (SELECT * FROM e_recs WHERE rank <= 5),
pd AS (SELECT customer_id, count(DISTINCT product_id) AS d FROM r5 GROUP BY 1)
SELECT {RND('count(DISTINCT product_id) * 100.0 / (SELECT count(DISTINCT p_partkey) FROM part)', 6)} AS catalog_coverage,
  {RND('(SELECT coalesce(avg(d), 0.0) FROM pd)', 6)} AS diversity,
  {RND('count(DISTINCT customer_id) FILTER (WHERE customer_id IN (SELECT customer_id FROM te)) * 100.0 / (SELECT count(DISTINCT customer_id) FROM te)', 6)} AS customer_coverage FROM r5"""
SQL["evaluation_report"] = f"""WITH {EVAL}, pd AS (SELECT customer_id, count(DISTINCT product_id) AS d FROM e_recs GROUP BY 1),
cov AS (SELECT {RND('count(DISTINCT product_id) * 100.0 / (SELECT count(DISTINCT product_id) FROM pp)', 6)} AS cat,
  {RND('(SELECT coalesce(avg(d), 0.0) FROM pd)', 6)} AS div,
  {RND('count(DISTINCT customer_id) FILTER (WHERE customer_id IN (SELECT customer_id FROM te)) * 100.0 / (SELECT count(DISTINCT customer_id) FROM te)', 6)} AS cust FROM e_recs)
SELECT '@K=' || CAST(k AS VARCHAR) AS Metric, {FMT('precision', 4)} AS Precision, {FMT('recall', 4)} AS Recall,
  {FMT('map', 4)} AS MAP, {FMT('mrr', 4)} AS MRR, {FMT('ndcg', 4)} AS NDCG FROM rm
UNION ALL SELECT 'Coverage', {FMT('cust', 2)} || '%', {FMT('cat', 2)} || '%', {FMT('div', 2)}, '—', '—' FROM cov"""
SQL["holdout_evaluation"] = f"""WITH {EVAL}, r5 AS (SELECT * FROM e_recs WHERE rank <= 5),
j AS (SELECT r.customer_id, s.n_actual, a.product_id IS NOT NULL AS rel FROM r5 r JOIN sizes s USING (customer_id)
  LEFT JOIN act a USING (customer_id, product_id)),
hp AS (SELECT customer_id, n_actual, count(*) AS n, count(*) FILTER (WHERE rel) AS rel FROM j GROUP BY ALL)
SELECT {RND('coalesce(avg(CAST(rel AS DOUBLE) / n), 0.0)', 6)} AS precision,
  {RND('coalesce(avg(CAST(rel AS DOUBLE) / n_actual), 0.0)', 6)} AS recall,
  {RND('CAST(count(*) FILTER (WHERE rel > 0) AS DOUBLE) / CASE WHEN count(*) > 0 THEN count(*) END', 6)} AS hit_rate,
  {RND('(SELECT count(*) FROM sizes WHERE customer_id IN (SELECT customer_id FROM r5)) * 100.0 / (SELECT count(*) FROM sizes)', 6)} AS coverage,
  (SELECT count(DISTINCT product_id) FROM r5) AS diversity FROM hp"""

SQL["drop_any_null"] = f"WITH {RAW_COMMENTS} SELECT * FROM raw_comments WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in ["comment_id"] + _COMMENT_COLS)
SQL["convert_types"] = f"""WITH {RAW_COMMENTS}, {DEDUP_COMMENTS},
conv AS (SELECT * REPLACE (TRY_CAST(rating AS DOUBLE) AS rating),
    CAST(trunc(TRY_CAST(created_at AS DOUBLE)) AS BIGINT) AS created_at_num,
    CAST(trunc(TRY_CAST(purchased_at AS DOUBLE)) AS BIGINT) AS purchased_at_num,
    {ts_of('created_at')} AS created_at_ts, {ts_of('purchased_at')} AS purchased_at_ts FROM comments)
SELECT * FROM conv WHERE created_at_ts IS NOT NULL AND purchased_at_ts IS NOT NULL AND rating IS NOT NULL"""
_REQUIRED = " AND ".join(f"{c} IS NOT NULL" for c in ["comment_id", "product_id", "customer_id", "rating", "content", "created_at", "purchased_at"])
SQL["dropped_rows"] = f"""WITH {RAW_COMMENTS},
s0 AS MATERIALIZED (SELECT *, {ts_of('created_at')} AS created_at_ts, {ts_of('purchased_at')} AS purchased_at_ts, TRY_CAST(rating AS DOUBLE) AS stars FROM raw_comments),
s1 AS (SELECT * FROM s0 WHERE {_REQUIRED}),
s2 AS (SELECT * FROM s1 WHERE created_at_ts IS NOT NULL AND purchased_at_ts IS NOT NULL AND stars IS NOT NULL),
s4 AS (SELECT * FROM s2 WHERE purchased_at_ts BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2035-12-31'
  AND created_at_ts BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2035-12-31'),
n AS (SELECT (SELECT count(*) FROM s0) AS n0, (SELECT count(*) FROM s1) AS n1, (SELECT count(*) FROM s2) AS n2,
  (SELECT count(*) FROM s4) AS n4, (SELECT count(*) FROM s4 WHERE stars >= 4) AS n5)
SELECT step_no, step, rows_in, rows_kept, rows_in - rows_kept AS rows_dropped FROM (
  SELECT 0 AS step_no, 'required nulls' AS step, n0 AS rows_in, n1 AS rows_kept FROM n UNION ALL
  SELECT 1, 'timestamps and rating', n1, n2 FROM n UNION ALL SELECT 2, 'customer or date', n2, n2 FROM n UNION ALL
  SELECT 3, 'date range', n2, n4 FROM n UNION ALL SELECT 4, 'rating', n4, n5 FROM n)"""
SQL["column_projection"] = (f"WITH {CLEAN_COMMENTS} SELECT customer_id, customer_name, comment_id, purchased_at, "
                            "created_at, rating, product_id, seller_name FROM raw0")
SQL["review_gaps"] = f"""WITH {EVENTS}, {burst_sql('events_in')} SELECT comment_id, customer_id, created_at_ts,
  previous_created_at_ts, delta_minutes FROM g2"""
SQL["truncate_recommendations"] = f"WITH {HYB} SELECT customer_id, rank, product_id, {RND('score', 6)} AS score FROM p_recs WHERE rank <= 3"

SQL["flatten_reviews"] = f"""WITH {CLEAN_COMMENTS} SELECT comment_id, product_id, customer_id, customer_name,
  CAST(rating AS DOUBLE) AS rating, title, content, CAST(created_at AS BIGINT) AS created_at,
  CAST(purchased_at AS BIGINT) AS purchased_at, seller_id, seller_name FROM raw0"""
SQL["flatten_products"] = """SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price,
  p_retailprice AS original_price, CAST(NULL AS DOUBLE) AS rating_average, CAST(NULL AS BIGINT) AS review_count,
  p_brand AS brand_name, p_type AS short_description, CAST(NULL AS VARCHAR) AS url_key FROM part"""
SQL["flatten_product_ids"] = """SELECT DISTINCT l_partkey AS product_id FROM lineitem
  WHERE l_partkey IS NOT NULL AND l_partkey <> 0"""
