"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from gridloom.functions import fixed as X
from gridloom.sources.derived import derived_sql

FIELDS = ", ".join(X.ENDPOINT_FIELDS)
KEY = "domain, port, scheme, coin_key"
DAY, AS_OF, COIN_URL = "2024-03-01", "2024-02-10", "https://pools.example/"


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case_rank(column: str, ranks: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ranks.items()) + " ELSE -1 END"


# Parsing and validation.


def _parsed(source: str, kept: str = "*") -> str:
    """CTE steps that parse domain, port and scheme of ``source`` into p_domain, p_port, p_scheme and p_error."""
    return rf"""
p1 AS (SELECT {kept}, trim(coalesce(domain, '')) AS t FROM {source}),
p2 AS (SELECT *, lower(regexp_extract(t, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1)) AS own_scheme,
  regexp_extract(regexp_replace(regexp_replace(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '^[^@\s/]+@', ''), '^([^/#?\s]*)', 1) AS rest FROM p1),
p3 AS (SELECT *, regexp_extract(rest, '^.+:([0-9]{{1,5}})$', 1) AS own_port FROM p2),
p4 AS (SELECT *, CASE WHEN own_port <> '' THEN regexp_replace(rest, ':[0-9]{{1,5}}$', '') ELSE rest END AS host,
  CASE WHEN own_port <> '' THEN CAST(own_port AS INT) WHEN regexp_full_match(port, '[+-]?[0-9]+') THEN TRY_CAST(port AS INT) END AS number FROM p3),
parsed AS (SELECT *,
  CASE WHEN t <> '' THEN lower(regexp_replace(regexp_replace(regexp_replace(host, '^\[', ''), '\]$', ''), '\.$', '')) END AS p_domain,
  CASE WHEN t <> '' THEN number END AS p_port,
  CASE WHEN t <> '' THEN CASE WHEN own_scheme <> '' THEN own_scheme ELSE scheme END END AS p_scheme,
  CASE WHEN t = '' THEN 'endpoint/domain must be a non-empty string'
       WHEN own_port = '' AND port <> '' AND number IS NULL THEN 'invalid literal for int() with base 10: ''' || port || '''' END AS p_error
  FROM p4)"""


V4 = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}"
IP = f"(regexp_full_match(domain, '{V4}') OR (contains(domain, ':') AND regexp_full_match(domain, '[0-9a-f:]+')))"


def _normalized(source: str) -> str:
    """CTE steps that end in ``normal``: the fields of ``source`` normalised, with the list ``errs``."""
    enum = lambda f, allowed: f"CASE WHEN {f} NOT IN {_list(allowed)} THEN '{f} must be one of: {', '.join(sorted(allowed))}' END"
    required = ",\n    ".join(
        f"CASE WHEN {f} {'IS NULL' if f == 'port' else '= ' + chr(39) * 2} THEN '{f} is required' END" for f in X.ENDPOINT_FIELDS if f != "notes"
    )
    plain = ", ".join(f"trim(coalesce({f}, '')) AS {f}" for f in ("pool_name", "coin", "algorithm", "region", "source_url", "first_seen", "last_seen", "notes"))
    low = ", ".join(f"trim(lower(coalesce({f}, ''))) AS {f}" for f in ("source_type", "confidence", "status"))
    return _parsed(source) + rf""",
n1 AS (SELECT * EXCLUDE ({FIELDS}, t, own_scheme, rest, own_port, host, number), coalesce(domain, '') AS given_domain, coalesce(port, '') AS given_port,
  trim(coalesce(p_domain, '')) AS domain, p_port AS port, trim(lower(coalesce(p_scheme, ''))) AS scheme, {plain}, {low} FROM parsed),
normal AS (SELECT * EXCLUDE (p_domain, p_port, p_scheme, p_error), CASE WHEN p_error IS NOT NULL THEN [p_error] ELSE list_filter([
    CASE WHEN NOT ((regexp_full_match(domain, '([a-z0-9]([a-z0-9-]{{0,61}}[a-z0-9])?\.)+[a-z0-9-]{{2,63}}') AND length(domain) <= 253) OR {IP})
      THEN 'domain is not a valid normalized FQDN or IP literal: ' || domain END,
    CASE WHEN NOT coalesce(port BETWEEN 1 AND 65535, false) THEN 'port must be an integer from 1 to 65535: ' || given_port END,
    {enum('scheme', X.SCHEMES)}, {enum('source_type', X.SOURCE_TYPES)}, {enum('confidence', X.CONFIDENCE)}, {enum('status', X.STATUS)},
    {required},
    CASE WHEN NOT regexp_full_match(first_seen, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'first_seen must use YYYY-MM-DD' END,
    CASE WHEN NOT regexp_full_match(last_seen, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'last_seen must use YYYY-MM-DD' END,
    CASE WHEN regexp_matches(domain, '[/@\s]') THEN 'domain must not contain scheme, path, userinfo, or whitespace' END,
    CASE WHEN confidence = 'confirmed' AND source_type <> 'official' THEN 'confirmed records must use source_type=official' END,
    CASE WHEN confidence = 'confirmed' AND NOT starts_with(source_url, 'http') THEN 'confirmed records must include an official source_url' END,
    CASE WHEN confidence = 'probable' AND len(list_filter(string_split(source_url, ';'), lambda x: trim(x) <> '')) < 2
      THEN 'probable records must include at least two source URLs separated by semicolons' END,
    CASE WHEN confidence = 'retired' AND status <> 'retired' THEN 'retired confidence records must use status=retired' END
  ], lambda x: x IS NOT NULL) END AS errs FROM n1)"""


def _unique(source: str, name: str, rank: str = "0", url: str = "source_url", keys: str = KEY, fields: str = FIELDS) -> str:
    """CTE steps that end in ``name``: the first record per key of the highest rank, later URLs appended."""
    on = " AND ".join(f"k.{c} = w.{c}" for c in keys.split(", "))
    return f"""
{name}_k AS (SELECT *, {rank} AS rk FROM {source}),
{name}_w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY rk DESC, ord) AS rn FROM {name}_k) WHERE rn = 1),
{name}_l AS (SELECT {', '.join('k.' + c for c in keys.split(', '))}, k.{url} AS u, min(k.ord) AS o
  FROM {name}_k k JOIN {name}_w w ON {on} WHERE k.ord > w.ord AND k.{url} <> w.{url} GROUP BY ALL),
{name}_a AS (SELECT {keys}, string_agg(u, '; ' ORDER BY o) AS later FROM {name}_l GROUP BY {keys}),
{name} AS (SELECT w.ord, {', '.join(f"w.{f} || coalesce('; ' || k.later, '') AS {f}" if f == url else 'w.' + f for f in fields.split(', '))}
  FROM {name}_w w LEFT JOIN {name}_a k ON {on})"""


RAW = f"raw AS ({derived_sql('raw_endpoint')})"
RECORD = f"record AS (SELECT *, upper(coin) AS coin_key FROM ({derived_sql('record')}))"
NORMAL = f"WITH {RAW}, {_normalized('raw')}"
GOOD = f"{NORMAL}, good AS (SELECT *, upper(coin) AS coin_key FROM normal WHERE len(errs) = 0), {_unique('good', 'uniq')}"
RANK = _case_rank("confidence", X.CONFIDENCE_RANK)
DISTINCT_URLS = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
URLS = "list_filter(list_transform(string_split({0}, ';'), lambda x: trim(x)), lambda x: x <> '')"

ORACLES: dict[str, str] = {
    "parse_endpoint": f"WITH {RAW}, {_parsed('raw')} SELECT ord, p_domain AS domain, CAST(p_port AS VARCHAR) AS port, p_scheme AS scheme, p_error AS error FROM parsed",
    "normalize_record": f"{NORMAL} SELECT ord, {FIELDS} FROM normal WHERE len(errs) = 0",
    "validation_errors": f"{NORMAL} SELECT ord, len(errs)::BIGINT AS n_errors, array_to_string(errs, chr(10)) AS errors FROM normal",
    "quarantine_reasons": f"""{NORMAL} SELECT ord, 'Record ' || (ord + 1) || ' (' || given_domain || ':' || given_port || ') failed validation:' || chr(10) || '- ' ||
      array_to_string(errs, chr(10) || '- ') AS reason FROM normal WHERE len(errs) > 0""",
    "duplicate_keys": f"{GOOD} SELECT {KEY}, count(*) AS n_records FROM good GROUP BY {KEY} HAVING count(*) > 1",
    "library": f"{GOOD} SELECT {FIELDS} FROM uniq ORDER BY pool_name, coin, domain, port, scheme",
    "watchlist": f"{GOOD} SELECT {FIELDS} FROM uniq WHERE status = 'active' AND confidence IN ('confirmed', 'probable')",
    "source_urls": f"""WITH {RAW}, t AS (SELECT ord, {URLS.format("(source_url || ' ;; ' || source_url)")} AS u FROM raw)
      SELECT ord, len(u)::BIGINT AS n_urls, array_to_string({DISTINCT_URLS.format('u')}, '; ') AS urls FROM t""",
    "ip_literals": rf"""WITH {RAW}, {_parsed('raw')}, h AS (SELECT ord, coalesce(p_domain, '') AS domain FROM parsed)
      SELECT ord, domain AS host, {IP} AS strict, regexp_full_match(domain, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') OR contains(domain, ':') AS loose FROM h""",
}

# Pages.

POOL = "CASE page_id % 3 WHEN 0 THEN '2Miners' WHEN 1 THEN 'ViaBTC' ELSE 'Pool' END"
PAGE = f"page AS (SELECT *, {POOL} AS pool_name FROM ({derived_sql('page')}))"
TEXT = rf"""{PAGE}, txt AS (SELECT * EXCLUDE (html), trim(regexp_replace(replace(replace(
  regexp_replace(regexp_replace(html, '<script\b.*?</script>|<style\b.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), chr(160), ' '), '\s+', ' ', 'g')) AS text FROM page)"""
R_STRATUM = r"(?i)\b(stratum\+(?:tcp|ssl)):/+(?:[^\s/@<>]+@)?([a-z0-9][a-z0-9.-]*[a-z0-9])\s*:\s*(\d{1,5})\b"
R_HOST = r"(?i)(?:^|[^@\w.-])([a-z0-9][a-z0-9.-]*\.[a-z0-9-]{2,63})\s*:\s*(\d{2,5})\b"
R_IP = r"(?:^|[^\w.-])((?:\d{1,3}\.){3}\d{1,3})\s*:\s*(\d{2,5})\b"
R_NODE = r"(?i)\b(addnode|seednode)\b\s*[=:]?\s*((?:\d{1,3}\.){3}\d{1,3})\s*:\s*(\d{2,5})\b"
R_CODE = r"(?i)(?:^|[^@\w.-])([a-z0-9][a-z0-9.-]*\.[a-z0-9-]{2,63}|(?:\d{1,3}\.){3}\d{1,3})\s*:\s*(\d{2,5})\b"


def _hits(source: str, columns: str, pattern: str, groups: tuple[int, int, int | None]) -> str:
    host, port, scheme = groups
    third = f", lower(regexp_extract(hit, '{pattern}', {scheme})) AS scheme" if scheme else ""
    return f"""(SELECT {columns}, lower(regexp_replace(regexp_extract(hit, '{pattern}', {host}), '\\.$', '')) AS domain,
  CAST(regexp_extract(hit, '{pattern}', {port}) AS INT) AS port{third} FROM (SELECT {columns}, unnest(regexp_extract_all(text, '{pattern}')) AS hit FROM {source}))"""


INFERRED = "CASE WHEN contains(domain, 'ssl') OR (pool_name IN ('2Miners', 'RavenMiner') AND port >= 10000) THEN 'stratum+ssl' ELSE 'stratum+tcp' END"
ALLOWED = " OR ".join(f"domain = '{s}' OR ends_with(domain, '.{s}')" for s in ("net", "other.example"))
PRIORITY = f"""{TEXT}, found AS (SELECT DISTINCT page_id, pool_name, domain, port, scheme FROM (
  SELECT page_id, pool_name, domain, port, scheme FROM {_hits('txt', 'page_id, pool_name', R_STRATUM, (2, 3, 1))}
  UNION ALL SELECT page_id, pool_name, domain, port, {INFERRED} AS scheme FROM {_hits('txt', 'page_id, pool_name', R_HOST, (1, 2, None))}) WHERE {ALLOWED})"""
NODES = f"""{TEXT}, node AS (SELECT DISTINCT page_id, site, pool_name, page_url, domain AS node_host, port, scheme AS node_type
  FROM {_hits('txt', 'page_id, site, pool_name, page_url', R_NODE, (2, 3, 1))})"""
SITE = f"""{NODES}, found AS (SELECT DISTINCT page_id, site, pool_name, page_url, domain, port, scheme FROM (
  SELECT page_id, site, pool_name, page_url, domain, port, scheme FROM {_hits('txt', 'page_id, site, pool_name, page_url', R_STRATUM, (2, 3, 1))}
  UNION ALL SELECT page_id, site, pool_name, page_url, domain, port, {INFERRED} FROM {_hits('txt', 'page_id, site, pool_name, page_url', R_HOST, (1, 2, None))}
    WHERE domain = site OR ends_with(domain, '.' || site)
  UNION ALL SELECT page_id, site, pool_name, page_url, domain, port, 'stratum+tcp' FROM {_hits('txt', 'page_id, site, pool_name, page_url', R_IP, (1, 2, None))} i
    WHERE NOT EXISTS (SELECT 1 FROM node n WHERE n.page_id = i.page_id AND n.node_host = i.domain AND n.port = i.port)) WHERE port BETWEEN 1 AND 65535)"""

RULES = "rules(i, token, rcoin, ralgorithm) AS (VALUES " + ", ".join(f"({i}, '{t}', '{c}', '{a}')" for i, (t, c, a) in enumerate(X.COIN_RULES)) + ")"
PORTS = "ports(pport, pcoin, palgorithm) AS (VALUES " + ", ".join(f"({p}, '{c}', '{a}')" for p, (c, a) in X.PORT_RULES.items()) + ")"
REGION = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(replace(lower(domain), '.', '-'), '{t}')" for t in tokens) + f" THEN '{r}'" for r, tokens in X.REGION_RULES
) + f" ELSE '{X.REGION_ELSE}' END"


def _coined(source: str, coin: str = "'UNKNOWN'", algorithm: str = "'UNKNOWN'", pool: str = "pool_name") -> str:
    """CTE steps that end in ``coined``: ``source`` with coin and algorithm by the rules."""
    return f"""{RULES}, {PORTS},
hosts AS (SELECT domain, arg_min(rcoin, i) AS rcoin, arg_min(ralgorithm, i) AS ralgorithm FROM (SELECT DISTINCT domain FROM {source})
  JOIN rules ON list_contains(regexp_split_to_array(replace(lower(domain), 'ssl', ''), '[-.]'), token) GROUP BY domain),
coined AS (SELECT s.*, coalesce(pcoin, rcoin, {coin}) AS coin, coalesce(palgorithm, ralgorithm, {algorithm}) AS algorithm, {REGION.replace('domain', 's.domain')} AS region
  FROM {source} s LEFT JOIN hosts ON hosts.domain = s.domain LEFT JOIN ports ON {pool} = '{X.PORT_RULES_POOL}' AND pport = s.port)"""


NODE_NOTES = "'Blockchain peer node candidate extracted from ' || node_type || ' directive while crawling ' || site || '; not a mining pool Stratum endpoint.'"
NODE_RECORDS = f"""{NODES}, nodes AS (SELECT page_id, node_host, port, node_type, pool_name,
  CASE port WHEN 8333 THEN 'BTC' WHEN 18333 THEN 'BTC-TESTNET' WHEN 9333 THEN 'LTC' WHEN 22556 THEN 'DOGE' ELSE CASE WHEN page_id % 2 = 0 THEN 'KAS' ELSE 'UNKNOWN' END END AS coin,
  page_url AS source_url, '{DAY}' AS first_seen, '2024-03-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS last_seen, {NODE_NOTES} AS notes FROM node)"""
NODE_KEYS, NODE_FIELDS = "node_host, port, node_type", ", ".join(X.NODE_FIELDS)

ORACLES |= {
    "html_to_text": f"WITH {TEXT} SELECT page_id, text FROM txt",
    "html_to_text_unescaped": rf"""WITH {PAGE}, t AS (SELECT page_id,
      regexp_replace(regexp_replace(html, '<script\b.*?</script>|<style\b.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'g') AS t FROM page),
      u AS (SELECT page_id, replace(replace(replace(replace(t, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&nbsp;', ' ') AS t FROM t)
      SELECT page_id, trim(regexp_replace(regexp_replace(t, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text FROM u""",
    "decode_charsets": f"""WITH {PAGE} SELECT page_id, ['gbk', 'windows-1252', 'utf-8', 'no-such-charset', 'ISO-8859-1', 'utf-16le'][page_id % 6 + 1] AS charset,
      sha256(CASE page_id % 6 WHEN 0 THEN '你好' || page_id WHEN 1 THEN '“€…”' || page_id WHEN 2 THEN 'a' || chr(65533) || 'b' || chr(65533) || page_id
        WHEN 3 THEN '你' || page_id WHEN 4 THEN 'é£' || page_id ELSE html END) AS text_sha256 FROM page""",
    "fetch_outcomes": f"""WITH {SITE}, c AS (SELECT page_id, count(*) AS n FROM found GROUP BY page_id), o AS (SELECT *, page_id % 7 <> 0 AS ok FROM page)
      SELECT page_id, page_url AS url, ok, CASE WHEN ok THEN sha256(html) END AS sha256, CASE WHEN ok THEN strlen(html) ELSE 0 END::BIGINT AS bytes,
        CASE WHEN ok THEN coalesce(n, 0) ELSE 0 END AS records, CASE WHEN ok THEN 200 ELSE 503 END AS status, NOT ok AS used_cache, CASE WHEN ok THEN '' ELSE 'HTTP 503' END AS error
      FROM o LEFT JOIN c USING (page_id)""",
    "extract_priority_endpoints": f"WITH {PRIORITY} SELECT page_id, domain, port, scheme FROM found",
    "priority_records": f"""WITH {PRIORITY},
      registry(sid, name, url, source_type, confidence, pool, dcoin, dalgorithm, dregion, method, snotes) AS (VALUES
        ('s0', 'Zero', 'https://s0.example/', 'official', 'confirmed', 'ViaBTC', NULL, NULL, NULL, 'table', 'Checked.'),
        ('s1', 'One', 'https://s1.example/', 'aggregator', 'candidate', NULL, 'XMR', 'RandomX', 'Global', 'api', NULL),
        ('s2', 'Two', 'https://s2.example/', 'official', 'probable', '2Miners', NULL, NULL, '', 'help', '')),
      j AS (SELECT * EXCLUDE (pool_name), coalesce(pool, '') AS pool_name FROM found JOIN registry ON sid = 's' || CAST(page_id % 3 AS VARCHAR)),
      {_coined('j', "coalesce(dcoin, 'UNKNOWN')", "coalesce(dalgorithm, 'UNKNOWN')")}
      SELECT page_id, domain, port, scheme, coalesce(pool, name) AS pool_name, coin, algorithm, coalesce(nullif(dregion, ''), region) AS region, source_type, url AS source_url,
        confidence, CASE WHEN confidence IN ('confirmed', 'probable') THEN 'active' ELSE 'unknown' END AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
        trim('Discovered by ' || sid || ' using ' || method || '. ' || coalesce(snotes, '')) AS notes FROM coined""",
    "extract_site_endpoints": f"WITH {SITE} SELECT page_id, domain, port, scheme FROM found",
    "site_records": f"""WITH {SITE}, {_coined('found')} SELECT page_id, domain, port, scheme, pool_name, coin, algorithm, region, 'official' AS source_type, page_url AS source_url,
      'confirmed' AS confidence, 'active' AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
      'Discovered by shallow crawling official website domain ' || site || '.' AS notes FROM coined""",
    "extract_nodes": f"WITH {NODE_RECORDS} SELECT page_id, {NODE_FIELDS} FROM nodes",
    "unique_nodes": f"""WITH {NODE_RECORDS}, firsts AS (SELECT {NODE_KEYS}, source_url, min(page_id) AS o, arg_min(last_seen, page_id) AS seen FROM nodes GROUP BY ALL),
      f AS (SELECT {NODE_KEYS}, string_agg(source_url, '; ' ORDER BY o) AS urls, max(seen) AS seen FROM firsts GROUP BY {NODE_KEYS}),
      b AS (SELECT {NODE_KEYS}, arg_min(pool_name, page_id) AS pool_name, arg_min(coin, page_id) AS coin, arg_min(notes, page_id) AS notes FROM nodes GROUP BY {NODE_KEYS})
      SELECT {NODE_KEYS}, pool_name, coin, urls AS source_url, '{DAY}' AS first_seen, seen AS last_seen, notes FROM b JOIN f USING ({NODE_KEYS})""",
    "fetch_report": f"""WITH {SITE}, c AS (SELECT page_id, count(*) AS n FROM found GROUP BY page_id)
      SELECT page_id, page_url AS url, page_id % 7 <> 0 AS ok, sha256(html) AS sha256, strlen(html)::BIGINT AS bytes, coalesce(n, 0) AS records FROM page LEFT JOIN c USING (page_id)""",
}

LINK = r"""link AS (SELECT page_id, site, page_url, unnest(range(len(m))) AS pos, unnest(m) AS a FROM (
  SELECT page_id, site, page_url, regexp_extract_all(html, '<a href="[^"]+"[^>]*>.*?</a>', 0, 's') AS m FROM page)),
links AS (SELECT page_id, site, page_url, pos::INT AS pos, CASE WHEN starts_with(h, '/') THEN rtrim(page_url, '/') || h ELSE h END AS url, text FROM (
  SELECT *, regexp_extract(a, '<a href="([^"]+)"', 1) AS h, trim(regexp_replace(regexp_replace(regexp_extract(a, '^<a [^>]*>(.*)</a>$', 1, 's'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM link))"""
LINKS = f"WITH {PAGE}, {LINK}"
PATH = r"regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1)"
HOST = r"regexp_replace(lower(regexp_replace(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '^www\.', '')"
NON_SITE = "(" + " OR ".join(f"{{0}} = '{d}' OR ends_with({{0}}, '.{d}')" for d in X.NON_SITE_DOMAINS) + r" OR regexp_full_match({0}, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') OR contains({0}, ':'))"
SPEAKS = " OR ".join(f"contains(lower(regexp_extract(url, '^[^:]+://[^/?#]*(.*)$', 1) || ' ' || text), '{w}')" for w in X.HELP_WORDS)

ORACLES |= {
    "page_links": f"{LINKS} SELECT page_id, pos, url, text FROM links",
    "help_pages_topk": f"""{LINKS}, h AS (SELECT page_id, url, min(pos) AS pos FROM links WHERE starts_with(url, page_url) AND url <> page_url AND ({SPEAKS}) GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS place FROM h)
      SELECT page_id, place::INT AS place, url FROM r WHERE place < 4 UNION ALL SELECT DISTINCT page_id, 0, page_url FROM links""",
    "profiles": rf"""{LINKS}, p AS (SELECT *, regexp_extract({PATH}, '^/pools/([a-z0-9-]+)$', 1) AS slug FROM links)
      SELECT page_id, slug, arg_max(text, pos) AS pool_name, 'https://stats.example/pools/' || slug AS profile_url FROM p WHERE slug NOT IN ('', 'pools') GROUP BY page_id, slug""",
    "official_site": rf"""{LINKS}, l AS (SELECT * EXCLUDE (url), regexp_replace(url, '\.example\.(com|net|org)/', '.stats.example/') AS url FROM links),
      d AS (SELECT *, {HOST} AS dom FROM l WHERE regexp_matches(url, '^https?://[^/?#]')),
      e AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN contains(lower(text), 'website') THEN 0 ELSE 1 END, pos) AS rn FROM d
        WHERE NOT (dom = 'stats.example' OR ends_with(dom, '.stats.example')) AND NOT {NON_SITE.format('dom')})
      SELECT page_id, regexp_extract(url, '^([^:]+)://', 1) || '://' || lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) || '/' AS website_url, dom AS website_domain FROM e WHERE rn = 1""",
}

_profiles = ORACLES["profiles"]
_official = ORACLES["official_site"].replace(r", l AS (SELECT * EXCLUDE (url), regexp_replace(url, '\.example\.(com|net|org)/', '.stats.example/') AS url FROM links)", ", l AS (FROM links)")
ORACLES["profile_sites"] = f"""SELECT page_id AS ord, pool_name, website_domain, website_url, profile_url, '{COIN_URL}' AS directory_source, 'directory' AS source_type, 'candidate' AS confidence,
  '{DAY}' AS first_seen, '{DAY}' AS last_seen, 'Official website link extracted from Pools profile.' AS notes FROM ({_profiles}) p JOIN ({_official}) o USING (page_id)"""

# Code files.

WORDS = " OR ".join(f"contains(lower(line), '{w}')" for w in X.CODE_WORDS)
BLOCKED = "(" + " OR ".join(f"starts_with(domain, '{p}')" for p in X.BLOCKED_PREFIXES) + f" OR domain IN {_list(X.BLOCKED_HOSTS)})"
CODE = rf"""code AS ({derived_sql('code_file')}),
lines AS (SELECT doc_id, path, repo, line AS text FROM (SELECT doc_id, path, repo, unnest(regexp_split_to_array(text, '\r\n|[\n\r\x0b\x0c]')) AS line FROM code)
  WHERE NOT contains(lower(line), 'stratum+') AND ({WORDS})),
found AS (SELECT DISTINCT * FROM (SELECT doc_id, path, repo, domain, port, scheme FROM {_hits('code', 'doc_id, path, repo', R_STRATUM, (2, 3, 1))}
  UNION ALL SELECT doc_id, path, repo, domain, port, CASE WHEN contains(domain, 'ssl') THEN 'stratum+ssl' ELSE 'stratum+tcp' END FROM {_hits('lines', 'doc_id, path, repo', R_CODE, (1, 2, None))})
  WHERE NOT {BLOCKED})"""
R_FILE = r"(?i)\b(stratum\+(?:tcp|ssl))://(?:[^\s/@]+@)?([a-z0-9.-]+):(\d{1,5})\b"

ORACLES |= {
    "extract_code_endpoints": f"WITH {CODE} SELECT doc_id, domain, port, scheme FROM found",
    "code_records": f"""WITH {CODE}, {_coined('found', pool="'GitHub'")} SELECT doc_id, domain, port, scheme, 'UNKNOWN' AS pool_name, coin, algorithm, region, 'open_source' AS source_type,
      'https://code.example/' || repo || '/' || path AS source_url, 'candidate' AS confidence, 'unknown' AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
      'Extracted from public GitHub code search query q1; repo=' || repo || '; path=' || path || '; review before promotion.' AS notes FROM coined""",
    "extract_local_text": f"""WITH code AS ({derived_sql('code_file')}),
      m AS (SELECT doc_id, path, regexp_extract_all(text, '{R_FILE}') AS hits FROM code), u AS (SELECT doc_id, path, unnest(hits) AS hit, unnest(range(len(hits))) AS i FROM m),
      e AS (SELECT doc_id, path, lower(regexp_replace(regexp_extract(hit, '{R_FILE}', 2), '\\.$', '')) AS domain, CAST(regexp_extract(hit, '{R_FILE}', 3) AS INT) AS port,
        lower(regexp_extract(hit, '{R_FILE}', 1)) AS scheme, min(i) AS i FROM u GROUP BY ALL)
      SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS pos, domain, port, scheme, 'UNKNOWN' AS pool_name, 'UNKNOWN' AS coin, 'UNKNOWN' AS algorithm,
        'UNKNOWN' AS region, 'open_source' AS source_type, 'file:' || path AS source_url, 'candidate' AS confidence, 'unknown' AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
        'Extracted from local text; requires manual review before merging.' AS notes FROM e""",
    "infer_coin": f"""WITH {RECORD}, r AS (SELECT ord, domain, CASE WHEN ord % 2 = 0 THEN 3010 ELSE port END AS port, CASE WHEN ord % 3 = 0 THEN 'ViaBTC' ELSE 'Pool' END AS pool_name FROM record),
      {_coined('r', "'XMR'", "'RandomX'")} SELECT ord, coin, algorithm FROM coined""",
    "infer_region": f"WITH {RECORD} SELECT ord, {REGION} AS region FROM record",
    "infer_scheme": f"""WITH {RECORD}, r AS (SELECT ord, domain, CASE WHEN ord % 2 = 0 THEN '2Miners' ELSE pool_name END AS pool_name,
      (port + CASE WHEN ord % 3 = 0 THEN 9000 ELSE 0 END)::INT AS port FROM record) SELECT ord, port, {INFERRED} AS scheme FROM r""",
    "pool_names": """WITH s AS (SELECT s_suppkey, s_suppkey::VARCHAR AS n, lower(replace(s_name, '#', '-')) AS low FROM supplier),
      k AS (SELECT s_suppkey, ['f2pool', 'K1Pool', 'my-new-pool' || n, low, 'a' || n || 'b' || n || 'c-x', '--POOL.of-' || n || 'th_miners', '', '2miners'][s_suppkey % 8 + 1] AS slug FROM s),
      r AS (SELECT *, regexp_extract_all(lower(replace(slug, '-', ' ')), '[a-z]+|[^a-z]+') AS runs FROM k)
      SELECT s_suppkey, slug, CASE slug WHEN 'f2pool' THEN 'F2Pool' WHEN '2miners' THEN '2Miners' WHEN 'k1pool' THEN 'K1 Pool'
        ELSE array_to_string(list_transform(runs, lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), '') END AS pool_name FROM r""",
    "blocked_hosts": f"""WITH {RECORD}, r AS (SELECT ord, domain, (ord % 250) || '.' || (ord % 7) AS tail FROM record)
      SELECT event_id, host, {BLOCKED.replace('domain', 'lower(host)')} AS blocked FROM (SELECT ord AS event_id,
        ['127.0.' || tail, '10.1.' || tail, '192.168.' || tail, '192.169.' || tail, '101.2.' || tail, '11.0.' || tail, 'Example.com', 'example.NET', 'example.org', 'localhost',
         domain, upper(domain), 'a.example.com', 'localhost' || ord][ord % 14 + 1] AS host FROM r)""",
    "suffix_matches": f"""WITH {RECORD}, s AS (SELECT domain AS suffix FROM record WHERE port = 2111 UNION SELECT 'pool' || (ord % 40) || '.example.com' FROM record)
      SELECT r.ord, r.domain, s.suffix FROM record r JOIN s ON r.domain = s.suffix OR suffix(r.domain, '.' || s.suffix)""",
}

# Directories.

LISTING = f"listing AS ({derived_sql('listing')})"
LISTED = rf"""{LISTING}, lst AS (SELECT item AS ord, coin_slug, url, pool_id, {HOST} AS host,
  TRY_CAST(regexp_extract(url, '^[a-z]+://[^/?#]*:([0-9]+)(?:[/?#]|$)', 1) AS INT) AS port FROM listing WHERE regexp_matches(url, '^https?://')),
listed AS (SELECT *, CASE WHEN regexp_full_match(host, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') AND port > 0 THEN 'endpoint' WHEN {NON_SITE.format('host')} THEN 'none' ELSE 'site' END AS kind FROM lst)"""
SITES = f"""{LISTED}, sites AS (SELECT ord, coalesce(nullif(pool_id, ''), upper(substr(host, 1, 1)) || regexp_extract(host, '^.([^.]*)', 1)) AS pool_name, host AS website_domain,
  regexp_extract(url, '^([^:]+)://', 1) || '://' || lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) || '/' AS website_url, '{COIN_URL}' || coin_slug AS profile_url,
  '{COIN_URL}' AS directory_source, 'directory' AS source_type, 'candidate' AS confidence, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
  'Pool website URL extracted from MiningPoolStats data file for ' || coin_slug || '.' AS notes FROM listed WHERE kind = 'site')"""
SITE_FIELDS = ", ".join(X.SITE_FIELDS)

ORACLES |= {
    "canonical_domain": rf"""WITH {LISTING}, u AS (SELECT item, regexp_replace(url, '^https://www', 'https://user@WWW') AS url FROM listing), h AS (SELECT item, url, {HOST} AS domain,
      regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', '') AS netloc FROM u)
      SELECT *, {NON_SITE.format('domain')} AS non_site, regexp_full_match(domain, '[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}') AND regexp_matches(netloc, ':[0-9]+$') AS ip_endpoint FROM h""",
    "sitemap_coins": f"WITH {LISTING} SELECT DISTINCT '{COIN_URL}' || coin_slug AS url FROM listing ORDER BY url LIMIT 12",
    "coin_data_url": f"""WITH {LISTING} SELECT item, CASE WHEN item % 5 <> 0 THEN 'https://Data.miningpoolstats.stream/data/' || coin_slug || '.js?t=' || item END AS data_url FROM listing""",
    "directory_split": f"WITH {LISTED} SELECT ord, coin_slug, kind, host, CAST(port AS VARCHAR) AS port FROM listed",
    "directory_endpoints": f"""WITH {LISTED} SELECT ord, host AS domain, port, 'stratum+tcp' AS scheme, coalesce(nullif(pool_id, ''), host) AS pool_name, upper(coin_slug) AS coin, 'UNKNOWN' AS algorithm,
      'UNKNOWN' AS region, 'aggregator' AS source_type, '{COIN_URL}' || coin_slug AS source_url, 'candidate' AS confidence, 'unknown' AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
      'IP:port pool URL extracted from MiningPoolStats data file for ' || coin_slug || '; verify protocol before promotion.' AS notes FROM listed WHERE kind = 'endpoint'""",
    "directory_ip_list": f"""WITH {LISTED}, ips AS (SELECT ord, host AS domain, CAST(port AS VARCHAR) AS port, 'stratum+tcp' AS scheme, coalesce(nullif(pool_id, ''), host) AS pool_name,
      upper(coin_slug) AS coin, 'UNKNOWN' AS algorithm, 'UNKNOWN' AS region, 'aggregator' AS source_type, '{COIN_URL}' || coin_slug AS source_url, 'candidate' AS confidence,
      'unknown' AS status, '{DAY}' AS first_seen, '{DAY}' AS last_seen,
      'IP:port pool URL extracted from MiningPoolStats data file for ' || coin_slug || '; verify protocol before promotion.' AS notes FROM listed WHERE kind = 'endpoint'),
      {_normalized('ips')}, good AS (SELECT *, upper(coin) AS coin_key FROM normal WHERE len(errs) = 0), {_unique('good', 'uniq')} SELECT {FIELDS} FROM uniq""",
    "directory_sites": f"WITH {SITES} SELECT ord, {SITE_FIELDS} FROM sites",
    "unique_sites": f"WITH {SITES}, {_unique('sites', 'uniq', '0', 'profile_url', 'website_domain', SITE_FIELDS)} SELECT {SITE_FIELDS} FROM uniq",
    "merge_existing": f"""WITH {SITES}, both_runs AS (SELECT * EXCLUDE (ord, first_seen), CASE WHEN ord % 3 = 0 THEN '2024-01-01' ELSE first_seen END AS first_seen,
      CASE WHEN ord % 3 = 0 THEN ord ELSE 1000000000 + ord END AS ord FROM sites),
      {_unique('both_runs', 'uniq', '0', 'profile_url', 'website_domain', SITE_FIELDS)} SELECT {SITE_FIELDS} FROM uniq""",
    "api_coin_explode": f"""WITH {LISTING}, h AS (SELECT item, coalesce(pool_id, 'pool') AS pool_name, {HOST} AS domain FROM listing)
      SELECT domain, 443 AS port, 'stratum+tcp' AS scheme, pool_name, 'BTC' AS coin, 'SHA-256' AS algorithm FROM h
      UNION ALL SELECT domain, 443, 'stratum+tcp', pool_name, 'KAS' || CAST(item % 3 AS VARCHAR), 'UNKNOWN' FROM h""",
}

# Deduplication, promotion, snapshots, upkeep.

RANKED = f"WITH {RECORD}, {_unique('record', 'uniq', RANK)}"
ORACLES |= {
    "unique_ranked": f"{RANKED} SELECT {FIELDS} FROM uniq",
    "unique_ranked_exact": f"{RANKED} SELECT {FIELDS} FROM uniq",
    "unique_wide": f"""WITH {RECORD}, r AS (SELECT * REPLACE ('https://src' || (ord % 5) || '.example/p' || (ord * 7919 % 99991) || CASE WHEN ord % 2 = 0 THEN '/more' ELSE '' END AS source_url) FROM record),
      urls AS (SELECT {KEY}, source_url AS u, min(ord) AS o FROM r GROUP BY ALL), best AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY ord) = 1),
      held AS (SELECT DISTINCT {KEY}, a.u FROM urls a JOIN urls b USING ({KEY}) WHERE b.o < a.o AND contains(b.u, a.u)),
      joined AS (SELECT {KEY}, string_agg(u, '; ' ORDER BY o) AS whole FROM urls ANTI JOIN held USING ({KEY}, u) GROUP BY ALL)
      SELECT {FIELDS.replace('source_url', 'whole AS source_url')} FROM best JOIN joined USING ({KEY})""",
    "unique_first": f"WITH {RECORD}, {_unique('record', 'uniq')} SELECT {FIELDS} FROM uniq",
}


def _prepared(source: str) -> str:
    """CTE steps that end in ``prepared``, from records with src_label and src_kind."""
    fields = ", ".join(f for f in X.ENDPOINT_FIELDS if f not in ("notes", "confidence", "status"))
    kept = ", ".join(f for f in X.ENDPOINT_FIELDS if f not in ("notes", "confidence", "status", "port"))
    return f"""
low AS (SELECT *, src_kind = 'candidate' OR (confidence = 'probable' AND len(list_distinct({URLS.format('source_url')})) < 2) OR (confidence = 'confirmed' AND source_type <> 'official') AS lowered FROM {source}),
demoted AS (SELECT * EXCLUDE (lowered, {FIELDS}), {kept}, CAST(port AS VARCHAR) AS port, trim(coalesce(notes, '')) AS notes, CASE WHEN lowered THEN 'candidate' ELSE confidence END AS confidence,
  CASE WHEN lowered THEN 'unknown' ELSE status END AS status FROM low), {_normalized('demoted')},
held AS (SELECT *, len(errs) = 0 AND (upper(coin) = 'UNKNOWN' OR upper(algorithm) = 'UNKNOWN' OR {IP}) AS stays FROM normal),
prepared AS (SELECT * EXCLUDE (stays, {FIELDS}), {fields}, CASE WHEN stays THEN 'candidate' ELSE confidence END AS confidence, CASE WHEN stays THEN 'unknown' ELSE status END AS status,
  trim(notes || ' auto_source=' || src_label) AS notes FROM held)"""


LABELS = (("priority_sources", "trusted"), ("official_site_crawl", "trusted"), ("code_search", "candidate"))
_label = lambda m, o=0: "CASE " + m + " " + " ".join(f"WHEN {i + o} THEN '{lab}'" for i, (lab, _) in enumerate(LABELS)) + " END"
_kind = lambda m, o=0: "CASE " + m + " " + " ".join(f"WHEN {i + o} THEN '{k}'" for i, (_, k) in enumerate(LABELS)) + " END"
PREPARED_RAW = f"WITH {RAW}, tagged AS (SELECT *, {_label('ord % 3')} AS src_label, {_kind('ord % 3')} AS src_kind FROM raw), {_prepared('tagged')}"
ORACLES["prepare_records"] = f"{PREPARED_RAW} SELECT * EXCLUDE (port), CAST(port AS VARCHAR) AS port FROM (SELECT src_label, ord, {FIELDS}, array_to_string(errs, chr(10)) AS errors FROM prepared)"
ORACLES["skip_examples"] = f"""WITH {RAW}, tagged AS (SELECT *, 'priority_sources' AS src_label, 'trusted' AS src_kind FROM raw), {_prepared('tagged')}
  SELECT src_label, given_domain AS domain, 'Record 1 (' || given_domain || ':' || given_port || ') failed validation:' || chr(10) || '- ' || array_to_string(errs, chr(10) || '- ') AS reason
  FROM prepared WHERE len(errs) > 0 ORDER BY ord LIMIT 25"""

TYPE_RANK = lambda c: _case_rank(c, X.SOURCE_TYPE_RANK)
CONF_RANK = lambda c: _case_rank(c, X.CONFIDENCE_RANK)
_chosen = lambda f: f"CASE WHEN (raised AND x_{f} <> '') OR {f} = '' THEN x_{f} ELSE {f} END"
_others = ", ".join(f"s.{f} AS x_{f}" for f in X.ENDPOINT_FIELDS)
_mine = ", ".join(f"f.{f}" for f in X.ENDPOINT_FIELDS)
_parts, _source = [], "CASE WHEN port = 3222 THEN 0 WHEN port = 2111 THEN 1 + ord % 3 ELSE ord % 4 END"
for _i in range(1, 4):
    _parts.append(_unique(f"(SELECT * FROM record WHERE {_source} = {_i})", f"src{_i}"))
PROMOTED = f"""WITH RECURSIVE {RECORD}, {_unique(f'(SELECT * FROM record WHERE {_source} = 0)', 'seed0', RANK)},
seed AS (SELECT *, upper(coin) AS coin_key FROM (SELECT * REPLACE (trim(lower(status)) AS status) FROM seed0)
  WHERE NOT (confidence = 'confirmed' AND source_type <> 'official') AND NOT (confidence = 'retired' AND status <> 'retired')), {', '.join(_parts)},
tagged AS (SELECT * EXCLUDE (k), k AS src_ord, {_label('k', 1)} AS src_label, {_kind('k', 1)} AS src_kind FROM (SELECT *, 1 AS k FROM src1 UNION ALL SELECT *, 2 FROM src2 UNION ALL SELECT *, 3 FROM src3)),
{_prepared('tagged')},
rows_ AS (SELECT 0 AS src_ord, 0 AS o, {FIELDS}, coin_key FROM seed UNION ALL SELECT src_ord, ord, {FIELDS}, upper(coin) FROM prepared WHERE len(errs) = 0),
steps AS (SELECT *, {URLS.format('source_url')} AS urls, row_number() OVER (PARTITION BY {KEY} ORDER BY src_ord, o) AS i FROM rows_),
folded AS (SELECT i, coin_key, {FIELDS}, urls FROM steps WHERE i = 1
UNION ALL SELECT i, coin_key, domain, port, scheme, {_chosen('pool_name')}, coin, alg, {_chosen('region')},
  CASE WHEN {TYPE_RANK('x_source_type')} > {TYPE_RANK('source_type')} THEN x_source_type ELSE source_type END, array_to_string(all_urls, '; '),
  CASE WHEN stays THEN 'candidate' WHEN grown THEN 'probable' ELSE conf END,
  CASE WHEN stays THEN 'unknown' WHEN grown OR conf IN ('confirmed', 'probable') THEN 'active' ELSE 'unknown' END,
  least(first_seen, x_first_seen), greatest(last_seen, x_last_seen),
  substr(CASE WHEN notes = x_notes OR x_notes = '' THEN notes WHEN notes = '' THEN x_notes ELSE notes || ' | ' || x_notes END, 1, 900), all_urls
FROM (SELECT *, upper(coin) = 'UNKNOWN' OR upper(alg) = 'UNKNOWN' OR {IP} AS stays, conf = 'candidate' AND len(all_urls) >= 2 AS grown
  FROM (SELECT *, {DISTINCT_URLS.format('list_concat(urls, x_urls)')} AS all_urls, {_chosen('algorithm')} AS alg, CASE WHEN raised THEN x_confidence ELSE confidence END AS conf
    FROM (SELECT s.i, f.coin_key, {_mine}, f.urls, {_others}, s.urls AS x_urls, {CONF_RANK('s.confidence')} > {CONF_RANK('f.confidence')} AS raised
      FROM folded f JOIN steps s ON s.domain = f.domain AND s.port = f.port AND s.scheme = f.scheme AND s.coin_key = f.coin_key AND s.i = f.i + 1)))),
final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY i DESC) AS rn FROM folded) WHERE rn = 1),
promoted AS (SELECT {', '.join('p.' + f for f in X.ENDPOINT_FIELDS)},
  CASE WHEN s.coin_key IS NULL THEN 'inserted' WHEN {' AND '.join(f'p.{f} = s.{f}' for f in X.ENDPOINT_FIELDS)} THEN 'unchanged' ELSE 'updated' END AS change,
  concat_ws(chr(10), CASE WHEN p.confidence = 'confirmed' AND p.source_type <> 'official' THEN 'confirmed records must use source_type=official' END,
    CASE WHEN p.confidence = 'retired' AND p.status <> 'retired' THEN 'retired confidence records must use status=retired' END) AS errors
  FROM final p LEFT JOIN seed s ON s.domain = p.domain AND s.port = p.port AND s.scheme = p.scheme AND s.coin_key = p.coin_key)"""
ORACLES |= {
    "promoted_library": f"{PROMOTED} SELECT * FROM promoted",
    "promotion_changes": f"{PROMOTED} SELECT change, count(*) AS n FROM promoted GROUP BY change",
    "promotion_report": f"""{PROMOTED}, g AS (SELECT * FROM promoted WHERE errors = '')
      SELECT 'change' AS metric, change AS value, count(*) AS n FROM g GROUP BY change UNION ALL SELECT 'confidence', confidence, count(*) FROM g GROUP BY confidence
      UNION ALL SELECT 'status', status, count(*) FROM g GROUP BY status UNION ALL SELECT 'total', 'library', count(*) FROM g
      UNION ALL SELECT 'total', 'held_back', count(*) FROM promoted WHERE errors <> ''""",
}

_key = "lower(domain) || '|' || port || '|' || lower(scheme) || '|' || lower(coin)"


def _snapshot(name: str, until: str) -> str:
    some = "" if until > AS_OF else "WHERE ord % 2 = 0"
    return f"""{name}_r AS (SELECT domain, CAST(port AS VARCHAR) AS port, scheme, coin, confidence, status FROM record WHERE last_seen <= '{until}'),
{name}_i AS (SELECT domain, CAST(port AS VARCHAR) AS port, scheme, coin FROM normal WHERE len(errs) = 0 AND last_seen <= '{until}' AND regexp_matches(domain, '^[0-9.]+$')),
{name}_e AS (SELECT domain, port, scheme, coin FROM {name}_r UNION ALL SELECT * FROM {name}_i),
{name} AS (SELECT 'site_domains' AS metric, website_domain AS key FROM sites {some} UNION SELECT 'endpoint_domains', lower(domain) FROM {name}_e
  UNION SELECT 'endpoint_records', {_key} FROM {name}_e UNION SELECT 'ip_candidates', {_key} FROM {name}_i
  UNION SELECT 'blockchain_nodes', node_host || '|' || port || '|' || node_type FROM nodes WHERE last_seen <= '{until}'
  UNION SELECT 'stable_library', {_key} FROM {name}_r WHERE confidence = 'confirmed'
  UNION SELECT 'watchlist', {_key} FROM {name}_r WHERE status = 'active' AND confidence IN ('confirmed', 'probable'))"""


SNAPSHOT = f"WITH {RECORD}, {RAW}, {_normalized('raw')}, {SITES}, {NODE_RECORDS}, {_snapshot('now_', '2024-12-31')}"
METRICS = "(VALUES ('site_domains'), ('endpoint_domains'), ('endpoint_records'), ('ip_candidates'), ('blockchain_nodes'), ('stable_library'), ('watchlist')) m(metric)"
FETCH = f"fetches AS ({derived_sql('fetch')})"
ORACLES |= {
    "snapshot_keys": f"{SNAPSHOT} SELECT * FROM now_",
    "snapshot_delta": f"""{SNAPSHOT}, {_snapshot('old_', '2024-01-15')} SELECT m.metric, count(n.key) AS total, count(n.key) FILTER (WHERE o.key IS NULL) AS new
      FROM {METRICS} LEFT JOIN now_ n ON n.metric = m.metric LEFT JOIN old_ o ON o.metric = n.metric AND o.key = n.key GROUP BY m.metric""",
    "report_summary": f"""WITH {FETCH}, r AS (SELECT CASE WHEN ord % 2 = 0 OR ord % 5 <> 0 THEN ok END AS ok, ord % 4 = 0 AS used_cache FROM fetches)
      SELECT count(*) AS total, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS failed, count(*) FILTER (WHERE used_cache) AS used_cache FROM r""",
    "cache_fallback": f"""WITH {FETCH}, n AS (SELECT source_id, arg_max(ok, ord) AS ok, arg_max(n_records, ord) AS n FROM fetches WHERE run = 40 GROUP BY source_id),
      k AS (SELECT source_id, arg_max(n_records, run * 1000000000 + ord) AS kept FROM fetches WHERE run < 40 AND ok GROUP BY source_id)
      SELECT source_id, ok, CASE WHEN ok THEN n WHEN kept IS NOT NULL THEN kept ELSE 0 END AS n_records, NOT ok AND kept IS NOT NULL AS used_cache FROM n LEFT JOIN k USING (source_id)""",
    "run_status": """WITH r AS (SELECT event_id AS run_id, date_trunc('second', ts) AS s, date_trunc('second', ts + to_seconds((event_id % 5000 - 60)::INT)) AS e FROM events),
      d AS (SELECT *, greatest(date_diff('second', s, e), 0) AS duration_seconds FROM r)
      SELECT run_id, duration_seconds, printf('%d min %02d s', duration_seconds // 60, duration_seconds % 60) AS duration, strftime(s + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS started_utc8 FROM d""",
    "retire_stale": f"""WITH {RECORD}, r AS (SELECT *, CAST(last_seen AS DATE) < DATE '{AS_OF}' - 14 AS stale FROM record)
      SELECT ord, last_seen, CASE WHEN stale THEN 'retired' ELSE confidence END AS confidence, CASE WHEN stale THEN 'retired' ELSE status END AS status FROM r""",
    "change_audit": f"""WITH {RECORD}, {_unique('(SELECT * FROM record WHERE port <> 2111)', 'before')}, {_unique('(SELECT * FROM record WHERE port <> 3222)', 'after', RANK)},
      b AS (SELECT domain, port, scheme, upper(coin) AS coin_key, {RANK} AS old FROM before), a AS (SELECT domain, port, scheme, upper(coin) AS coin_key, {RANK} AS new FROM after)
      SELECT CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'deleted' WHEN new > old THEN 'upgraded' WHEN new < old THEN 'downgraded' ELSE 'kept' END AS change, count(*) AS n
      FROM b FULL OUTER JOIN a USING ({KEY}) GROUP BY ALL""",
}
ORACLES |= {
    "promotion_inputs": f"""{PREPARED_RAW} SELECT 'input' AS metric, src_label AS value, count(*) AS n FROM prepared GROUP BY src_label
      UNION ALL SELECT 'skipped', src_label, count(*) FILTER (WHERE len(errs) > 0) FROM prepared GROUP BY src_label
      UNION ALL SELECT 'total', 'seeds', n FROM ({PROMOTED} SELECT count(*) AS n FROM seed)""",
    "last_good_records": f"""WITH {FETCH}, {RECORD}, n AS (SELECT source_id, arg_max(ok, ord) AS ok FROM fetches WHERE run = 40 GROUP BY source_id),
      k AS (SELECT source_id, max(run) AS kept FROM fetches WHERE run < 40 AND ok GROUP BY source_id),
      c AS (SELECT source_id, CASE WHEN ok THEN 40 ELSE kept END AS run, NOT ok AS used_cache FROM n LEFT JOIN k USING (source_id))
      SELECT source_id, run, used_cache, r.ord, domain, port, scheme, coin FROM record r JOIN fetches f ON f.ord = r.ord AND f.ok JOIN c USING (source_id, run)""",
    "run_record": f"""WITH t AS (SELECT max(event_id) AS run_id, date_trunc('second', min(ts)) AS s, date_trunc('second', max(ts)) AS e FROM events),
      r AS (SELECT run_id, date_diff('second', s, e) AS duration_seconds, s FROM t),
      d AS (SELECT {", ".join(f"max({c}) FILTER (WHERE metric = '{m}') AS {m}_{c}" for m in ("site_domains", "endpoint_domains", "endpoint_records", "ip_candidates", "blockchain_nodes", "stable_library", "watchlist") for c in ("total", "new"))} FROM ({ORACLES["snapshot_delta"]})),
      f AS (SELECT total AS fetches_total, ok AS fetches_ok, failed AS fetches_failed, used_cache AS fetches_used_cache FROM ({ORACLES["report_summary"]}))
      SELECT run_id, duration_seconds, printf('%d min %02d s', duration_seconds // 60, duration_seconds % 60) AS duration,
        strftime(s + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS started_utc8, '{DAY}' AS day, '4' AS max_pages, d.*, f.* FROM r, d, f""",
}

_CYCLES = f"WITH {RECORD}, seen AS (SELECT DISTINCT {KEY}, date_diff('day', DATE '2024-01-01', last_seen::DATE) AS cycle FROM record)"
ORACLES |= {
    "baseline_delta": f"""WITH {RECORD}, {SITES}, {NODE_RECORDS}, k AS (
        SELECT 'site_domains' AS metric, website_domain AS key FROM sites UNION SELECT 'endpoint_domains', lower(domain) FROM record UNION SELECT 'endpoint_records', {_key} FROM record
        UNION SELECT 'ip_candidates', {_key} FROM record WHERE port = 2111 UNION SELECT 'blockchain_nodes', node_host || '|' || port || '|' || node_type FROM nodes
        UNION SELECT 'stable_library', {_key} FROM record WHERE confidence = 'confirmed' UNION SELECT 'watchlist', {_key} FROM record WHERE status = 'active' AND confidence IN ('confirmed', 'probable'))
      SELECT m.metric, count(k.key) AS total, 0::BIGINT AS new FROM {METRICS} LEFT JOIN k ON k.metric = m.metric GROUP BY m.metric""",
    "confirmation_runs": f"""{_CYCLES}, i AS (SELECT *, cycle - row_number() OVER (PARTITION BY {KEY} ORDER BY cycle) AS island FROM seen)
      SELECT {KEY}, min(cycle) AS first_cycle, max(cycle) AS last_cycle, count(*) AS cycles FROM i GROUP BY {KEY}, island""",
    "retire_unconfirmed": f"""{_CYCLES}, {_unique('record', 'uniq', RANK)}, l AS (SELECT {KEY}, 29 - max(cycle) AS missed FROM seen WHERE cycle <= 29 GROUP BY {KEY}),
      u AS (SELECT *, upper(coin) AS coin_key FROM uniq)
      SELECT {KEY}, missed, CASE WHEN coalesce(missed, 2) >= 2 THEN 'retired' ELSE confidence END AS confidence, CASE WHEN coalesce(missed, 2) >= 2 THEN 'retired' ELSE status END AS status
      FROM u LEFT JOIN l USING ({KEY})""",
    "published_records": ORACLES["unique_first"],
    "stored_snapshot_delta": ORACLES["snapshot_delta"],
    "published_tables": f"""SELECT 'sites' AS name, website_domain AS key, profile_url AS url FROM ({ORACLES["unique_sites"]})
      UNION ALL SELECT 'nodes', node_host || '|' || port || '|' || node_type, source_url FROM ({ORACLES["unique_nodes"]})""",
    "registry_sources": """SELECT 'source-' || s_suppkey AS id, s_name AS name, 'https://s' || s_suppkey || '.example/' AS url, CASE WHEN s_suppkey % 4 > 0 THEN 's' || s_suppkey || '.example' END AS suffixes
      FROM supplier WHERE s_suppkey % 3 <> 0 AND (s_suppkey % 5 <> 0 OR s_suppkey % 3 = 1)""",
    "cached_pages": "SELECT page_id, 200 AS status, sha256(coalesce(html, '')) AS sha256 FROM pages",
    "local_texts": """SELECT s_nationkey, sha256(string_agg('stratum+tcp://s' || s_suppkey || '.example:3333', chr(10) ORDER BY s_suppkey) || chr(10)) AS sha256
      FROM supplier GROUP BY s_nationkey""",
}
