"""The registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import read_table, shared_folder


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.secrets import scan

    return scan(read_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.suffix_dedup import remove_repeats

    return remove_repeats(read_table(spark, sf_dir, "documents"), length=100)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.near_dedup import near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.exact_dedup import mark_duplicates

    return mark_duplicates(read_table(spark, sf_dir, "documents"), keep="largest")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=0)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.fingerprints import fingerprint_pairs

    return fingerprint_pairs(read_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.language import identify

    return identify(read_table(spark, sf_dir, "documents"))


def op8_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.piece_bpe import encode_texts

    return encode_texts(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.archives import archive_pages

    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    merged = archive_pages(read_table(spark, sf_dir, "pages"), folder)
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "capture_rank")


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.sharding import shard_documents

    return shard_documents(read_table(spark, sf_dir, "documents"), shards=24)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.importance import resample

    drawn = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), longest=2, buckets=10000, least_words=20, percent=25, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.decontaminate import overlap_report

    return overlap_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), length=10)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.llm.fill_middle import fill_in_middle, restored

    cut = fill_in_middle(read_table(spark, sf_dir, "documents"), seed=1, percent=90, suffix_first=20)
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_secret_scan,
            op2_suffix_dedup,
            op3_minhash_near_dedup,
            op4_exact_dedup,
            op5_best_fit_packing,
            op6_fingerprints,
            op7_language_id,
            op8_piece_encoding,
            op9_warc_index,
            op10_feistel_shards,
            op11_importance_resampling,
            op12_decontamination,
            op13_fill_in_middle,
        )
    }


EXACT_DEDUP_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


_SHA1_PARTS = ", ".join(f"to_base(('0x' || substr(sha1(payload), {1 + 5 * i}, 5))::BIGINT, 32, 4)" for i in range(8))

WARC_SQL = f"""
WITH captures AS (SELECT page_id, coalesce(html, '') AS payload,
  regexp_replace(regexp_replace(lower(coalesce(url, '')), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '') AS rest FROM pages),
keyed AS (SELECT page_id, payload, strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 1000000000), '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
  array_to_string(list_reverse(string_split(regexp_replace(regexp_extract(rest, '^([^/?]*)', 1), '^www\\.', ''), '.')), ',') || ')' ||
    coalesce(nullif(regexp_extract(rest, '^[^/?]*(.*)$', 1), ''), '/') AS url_key FROM captures),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response_id FROM keyed)
SELECT page_id,
       strlen(payload)::BIGINT AS payload_bytes,
       translate(upper(concat({_SHA1_PARTS})), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to,
       url_key, timestamp, row_number() OVER (ORDER BY url_key, timestamp, page_id) - 1 AS capture_rank
FROM grouped
"""


# zlib's CRC is the exclusive or of what each byte does, which its distance from the end settles, and of what the length does.
IMPORTANCE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT 'd' || row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws, doc_id, true AS corpus FROM documents
  UNION ALL
  SELECT 'b' || row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), NULL, false FROM benchmark
), one AS (SELECT place, corpus, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM texts),
two AS (SELECT place, corpus, w, lead(w) OVER (PARTITION BY place ORDER BY i) AS v FROM one),
features AS (SELECT place, corpus, w AS feature FROM two UNION ALL SELECT place, corpus, w || ' ' || v FROM two WHERE v IS NOT NULL),
bits(b, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
step AS (SELECT b, c FROM bits WHERE k = 8),
words AS (SELECT DISTINCT feature FROM features),
longest AS (SELECT coalesce(max(strlen(feature)), 0) AS most FROM words),
far(k, b, c) AS (SELECT 0, b, c FROM step UNION ALL SELECT k + 1, far.b, xor(far.c // 256, step.c) FROM far JOIN step ON step.b = far.c % 256 WHERE k < (SELECT most FROM longest)),
empty(n, c) AS (SELECT 0, 4294967295 UNION ALL SELECT n + 1, xor(empty.c // 256, step.c) FROM empty JOIN step ON step.b = empty.c % 256 WHERE n < (SELECT most FROM longest)),
bytes AS (SELECT feature, strlen(feature) - i - 1 AS k, ('0x' || substr(hex(feature), 2 * i + 1, 2))::BIGINT AS b FROM (SELECT feature, unnest(range(strlen(feature))) AS i FROM words)),
crcs AS (SELECT feature, xor(xor(bit_xor(far.c), any_value(empty.c)), 4294967295) % 10000 AS bucket
  FROM bytes JOIN far USING (k, b) JOIN empty ON empty.n = strlen(feature) GROUP BY feature),
hashed AS (SELECT place, corpus, bucket FROM features JOIN crcs USING (feature)),
held AS (SELECT bucket, count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t FROM hashed GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM held),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g FROM held, sums),
weights AS (SELECT place, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM hashed JOIN gain USING (bucket) WHERE corpus GROUP BY place),
scored AS (SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (place) WHERE texts.corpus),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS r, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= 25 * n // 100 THEN r END AS rank FROM placed
"""

DECONTAMINATION_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(len(ws), 10) AS size FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(ws[i + 1:i + size], ' ') AS gram FROM (SELECT *, unnest(range(len(ws) - size + 1)) AS i FROM sized)),
starts AS (SELECT place, ws, size, unnest(range(len(ws) - size + 1)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(ws) >= size),
hits AS (SELECT place, i, s.size, item_id FROM (SELECT place, i, size, array_to_string(ws[i + 1:i + size], ' ') AS gram FROM starts) s JOIN windows USING (gram)),
covered AS (SELECT place, count(DISTINCT w) AS n_hit FROM (SELECT place, unnest(range(i, i + size)) AS w FROM hits) GROUP BY place),
owners AS (SELECT place, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT place, item_id FROM hits) GROUP BY place)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (place) LEFT JOIN owners USING (place)
"""

FILL_MIDDLE_SQL = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
numbers AS (SELECT doc_id, text, length(text) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
  ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM hashed),
cuts AS (SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": EXACT_DEDUP_SQL, "op9_warc_index": WARC_SQL, "op11_importance_resampling": IMPORTANCE_SQL, "op12_decontamination": DECONTAMINATION_SQL, "op13_fill_in_middle": FILL_MIDDLE_SQL}
