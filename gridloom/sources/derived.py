"""Inputs of the registered queries, derived from the given tables by SQL that Spark and DuckDB both read.

The given tables hold no endpoint text, so hosts, ports and addresses are computed from their ids. A third of
the events share a few hosts, so that keys are hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOST = """CASE n % 8 WHEN 0 THEN 'btc' WHEN 1 THEN 'ltc' WHEN 2 THEN 'etc' WHEN 3 THEN 'kas' WHEN 4 THEN 'rvn-ssl'
 WHEN 5 THEN 'pool' WHEN 6 THEN 'zec' ELSE 'doge' END || '-' ||
 CASE n % 6 WHEN 0 THEN 'eu' WHEN 1 THEN 'asia' WHEN 2 THEN 'us' WHEN 3 THEN 'na' WHEN 4 THEN 'latin' ELSE 'x1' END
 || '.pool' || CAST(n % 97 AS {string}) || '.example.com'"""

RAW_ENDPOINT = f"""
WITH e AS (
  SELECT event_id AS ord, event_type, CAST(CAST(ts AS DATE) AS {{string}}) AS day, event_id % 23 AS form,
         CASE WHEN event_id % 10 < 3 THEN 7 + event_id % 3 ELSE event_id % 401 END AS n
  FROM {{events}}
), h AS (
  SELECT *, {HOST} AS host, CAST(1000 + n % 7 * 1111 AS {{string}}) AS p FROM e
)
SELECT ord,
  CASE WHEN form <= 4 THEN 'stratum+tcp://' || host || ':' || p || '/path?user=x'
       WHEN form <= 8 THEN host
       WHEN form <= 11 THEN upper(host) || ':' || p
       WHEN form <= 14 THEN 'stratum+ssl://user@' || host || '.:' || p
       WHEN form = 15 THEN host
       WHEN form = 16 THEN '   '
       WHEN form <= 18 THEN '192.0.2.' || CAST(n % 250 AS {{string}})
       WHEN form = 19 THEN host || '/x y'
       WHEN form = 20 THEN 'bad_host!'
       WHEN form = 21 THEN '[2001:db8::' || CAST(n % 99 AS {{string}}) || ']'
       ELSE host END AS domain,
  CASE WHEN form <= 4 OR form BETWEEN 9 AND 14 THEN '' WHEN form = 15 THEN '70000' WHEN form = 22 THEN 'abc' ELSE p END AS port,
  CASE WHEN form <= 4 OR form BETWEEN 12 AND 14 THEN '' WHEN n % 11 = 0 THEN 'http' ELSE 'stratum+tcp' END AS scheme,
  'Pool' || CAST(n % 13 AS {{string}}) AS pool_name,
  CASE WHEN n % 9 = 0 THEN 'UNKNOWN' WHEN ord % 2 = 0 THEN 'btc' ELSE 'BTC' END AS coin,
  CASE WHEN ord % 5 = 0 THEN 'UNKNOWN' ELSE 'SHA-256' END AS algorithm,
  CASE WHEN ord % 7 = 0 THEN '' ELSE 'Global' END AS region,
  CASE ord % 4 WHEN 0 THEN 'official' WHEN 1 THEN 'aggregator' WHEN 2 THEN 'Open_Source' ELSE 'dns' END AS source_type,
  'https://src' || CAST(100 + ord % 17 AS {{string}}) || '.example/p' ||
    CASE WHEN ord % 6 = 0 THEN '; https://src' || CAST(100 + ord % 19 AS {{string}}) || '.example/p' ELSE '' END AS source_url,
  CASE ord % 5 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'probable' WHEN 2 THEN 'retired' ELSE 'candidate' END AS confidence,
  CASE WHEN ord % 5 = 2 THEN 'retired' WHEN ord % 5 <= 1 THEN 'active' ELSE 'unknown' END AS status,
  day AS first_seen,
  CASE WHEN ord % 31 = 0 THEN 'soon' ELSE day END AS last_seen,
  'event ' || event_type AS notes
FROM h
"""

#: Records that all pass validation, one per event: (ord, the fourteen fields), with a hot key.
RECORD = f"""
WITH e AS (
  SELECT event_id AS ord, CAST(CAST(ts AS DATE) AS {{string}}) AS day,
         CASE WHEN event_id % 10 < 3 THEN 7 ELSE event_id % 401 END AS n
  FROM {{events}}
), h AS (
  SELECT *, {HOST} AS host FROM e
)
SELECT ord, host AS domain, CAST(1000 + n % 7 * 1111 AS INT) AS port,
  CASE WHEN n % 2 = 0 THEN 'stratum+ssl' ELSE 'stratum+tcp' END AS scheme,
  'Pool' || CAST(ord % 13 AS {{string}}) AS pool_name,
  CASE WHEN n % 9 = 0 THEN 'UNKNOWN' WHEN ord % 2 = 0 THEN 'btc' ELSE 'BTC' END AS coin,
  CASE WHEN ord % 5 = 4 THEN 'UNKNOWN' ELSE 'SHA-256' END AS algorithm,
  CASE WHEN ord % 3 = 0 THEN 'USA' ELSE 'Global' END AS region,
  CASE WHEN ord % 8 = 0 THEN 'official' WHEN ord % 4 = 1 THEN 'aggregator' ELSE 'open_source' END AS source_type,
  'https://src' || CAST(100 + ord % 37 AS {{string}}) || '.example/p' AS source_url,
  CASE WHEN ord % 8 = 0 THEN 'confirmed' WHEN ord % 41 = 5 THEN 'retired' ELSE 'candidate' END AS confidence,
  CASE WHEN ord % 8 = 0 THEN 'active' WHEN ord % 41 = 5 THEN 'retired' ELSE 'unknown' END AS status,
  day AS first_seen, day AS last_seen, 'note ' || CAST(ord % 3 AS {{string}}) AS notes
FROM h
"""

#: Pages with endpoint text, anchors and a node line appended to the given html: (page_id, site, page_url, html).
PAGE = """
WITH p AS (
  SELECT page_id, page_id AS n, coalesce(html, '') AS given,
         regexp_replace(regexp_replace(coalesce(url, ''), '^[a-z]+://', ''), '[/?#].*$', '') AS host FROM {pages}
)
SELECT page_id, regexp_replace(host, '^www[.]', '') AS site, 'https://' || host || '/' AS page_url,
  given || '<p>Use stratum+ssl://eu-btc.' || host || ':' || CAST(3000 + n % 40 AS {string}) || ', ltc-asia.' || host || ' : ' ||
  CAST(10000 + n % 9 AS {string}) || ' or 192.0.2.' || CAST(n % 200 AS {string}) || ':4444 and stratum+tcp://kas.other.example:' ||
  CASE WHEN n % 5 = 0 THEN '0' ELSE '5555' END || '&nbsp;&amp; unrelated.example:443. addnode=192.0.2.' ||
  CAST(n % 200 AS {string}) || ':8333 seednode 192.0.2.77:' || CASE WHEN n % 2 = 0 THEN '9333' ELSE '4000' END || '</p>' ||
  '<a href="/help/mining?x=' || CAST(n % 3 AS {string}) || '">Mining help</a><a href="/faq">Questions</a>' ||
  '<a href="https://pool' || CAST(n % 30 AS {string}) || '.example/">External ' ||
  CASE WHEN n % 4 = 0 THEN 'Website' ELSE 'page' END || '</a><a href="https://x.com/pool">X</a>' ||
  '<a href="/pools/pool-' || CAST(n % 25 AS {string}) || '">Pool ' || CAST(n % 25 AS {string}) || '</a>' AS html
FROM p
"""

#: Code files: (doc_id, path, repo, text), config lines appended to the given text.
CODE_FILE = """
SELECT doc_id, 'src/config' || CAST(doc_id % 50 AS {string}) || '.json' AS path, 'repo/r' || CAST(doc_id % 211 AS {string}) AS repo,
  coalesce(text, '') || '
api.example.org:443
xmrig pool: pool' || CAST(doc_id % 89 AS {string}) || '.realpool.net:' || CAST(3000 + doc_id % 17 AS {string}) || '
url = "stratum+ssl://xmr' || CAST(doc_id % 13 AS {string}) || '.realpool.net:443" # miner
mining at 127.0.0.1:3333 or 10.1.2.3:4444
stratum+tcp://a' || CAST(doc_id % 7 AS {string}) || '.pool.net:3333 stratum+tcp://a' || CAST(doc_id % 7 AS {string}) || '.pool.net:3333
' AS text
FROM {documents}
"""

#: Directory data: (coin_slug, item, url, pool_id), one row per listed pool.
LISTING = """
SELECT 'coin' || CAST(10 + s_nationkey AS {string}) AS coin_slug, s_suppkey AS item,
  CASE WHEN s_suppkey % 7 = 0 THEN 'http://192.0.2.' || CAST(s_suppkey % 250 AS {string}) || ':' || CAST(3000 + s_suppkey % 5 AS {string})
       WHEN s_suppkey % 7 = 1 THEN 'https://github.com/pool' || CAST(s_suppkey AS {string})
       WHEN s_suppkey % 7 = 2 THEN 'ftp://pool.example'
       WHEN s_suppkey % 7 = 3 THEN 'https://www.site' || CAST(s_suppkey % 40 AS {string}) || '.example:8443/start?x=1'
       ELSE 'https://site' || CAST(s_suppkey % 40 AS {string}) || '.example/coin' END AS url,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name END AS pool_id
FROM {supplier}
"""

#: Fetch results: (run, source_id, ok, n_records), one row per source and run.
FETCH = """
SELECT event_id % 50 AS run, 'source' || CAST(event_id % 211 AS {string}) AS source_id,
       event_type <> 'error' AS ok, event_id % 13 AS n_records, event_id AS ord
FROM {events}
"""

SQL = {"raw_endpoint": RAW_ENDPOINT, "record": RECORD, "page": PAGE, "code_file": CODE_FILE, "listing": LISTING, "fetch": FETCH}
TABLES = ("events", "pages", "documents", "supplier", "lineitem")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(SQL[name].format(string="STRING", **{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))


def derived_sql(name: str) -> str:
    """The same input as DuckDB reads it."""
    return SQL[name].format(string="VARCHAR", **{t: t for t in TABLES}).strip()
