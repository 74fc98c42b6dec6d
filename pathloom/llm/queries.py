"""Registered queries of the operators, and the SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.html_text import main_text
from pathloom.llm.neighbours import nearest_neighbours
from pathloom.llm.packing import pack
from pathloom.llm.periodic_runs import periodic_runs, strongest, with_planted_runs
from pathloom.llm.pieces import encode_decode
from pathloom.llm.quality import FENCE, LEAST_GROUP, MEASURES, quality
from pathloom.llm.resampling import resample
from pathloom.llm.secret_scan import scan_secrets
from pathloom.llm.simhash import near_duplicates
from pathloom.llm.suffix_dedup import remove_repeats
from pathloom.llm.token_counts import count_tokens
from pathloom.llm.url_rules import DEFAULT, RULES, judge_urls, split_rule
from pathloom.llm.warc import round_trip


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op2_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(_table(spark, folder, "pages"))


_RULE_ROWS = ", ".join(f"('{verdict}', '{rule}', '{split_rule(rule)[0]}', '{split_rule(rule)[1]}')" for verdict, rule in RULES)

OP2_SQL = f"""
WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest)
SELECT page_id, host, path, rule, coalesce(verdict, '{DEFAULT}') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule) DESC, length(rule_host) DESC) = 1
"""

def op3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = encode_decode(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(_table(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(_table(spark, folder, "pages"))


_DIGITS = " || ".join(f"to_base(CAST('0x' || substr(hash, {1 + 10 * i}, 10) AS BIGINT), 32, 8)" for i in range(4))

OP5_SQL = f"""
WITH sizes AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hash FROM pages),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY hash) AS response FROM sizes)
SELECT page_id, payload_bytes,
       translate(upper({_DIGITS}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM firsts
"""

def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(_table(spark, folder, "pages"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(_table(spark, folder, "documents"))


def _fences_sql(keys: str, least: int) -> str:
    """The fences of a level; the KLL sketches are exact on as few texts as SQL is run on."""
    found = []
    for name, (width, lower) in MEASURES.items():
        low, high = f"quantile_disc({name}, 0.25)", f"quantile_disc({name}, 0.75)"
        spread = f"CAST('{FENCE}' AS DOUBLE) * greatest({high} - {low}, CAST('{width}' AS DOUBLE))"
        found.append(f"{low} - {spread} AS {name}_low" if lower else f"CAST('-inf' AS DOUBLE) AS {name}_low")
        found.append(f"{high} + {spread} AS {name}_high")
    return f"SELECT {keys} {', '.join(found)} FROM good GROUP BY ALL HAVING count(*) >= {least}"


_WITHIN = " AND ".join(f"coalesce({n} BETWEEN coalesce(g.{n}_low, l.{n}_low, w.{n}_low) AND coalesce(g.{n}_high, l.{n}_high, w.{n}_high), true)" for n in MEASURES)

OP7_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS n, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
split AS (
    SELECT n, doc_id, lang, source, t, regexp_extract_all(t, '[^ 	-
]+') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM texts),
windows AS (SELECT n, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS three FROM (SELECT n, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (SELECT n, i FROM windows QUALIFY count(*) OVER (PARTITION BY n, three) > 1),
inside AS (SELECT n, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS places(k) GROUP BY n),
counts AS (
    SELECT n, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split LEFT JOIN inside USING (n)),
measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           CASE WHEN n_words > 0 THEN n_symbols / n_words END AS symbol_share, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines END AS dup_line_share,
           CASE WHEN n_words > 0 THEN n_repeat_words / n_words END AS repeat_share, CASE WHEN n_words > 0 THEN word_chars / n_words END AS word_length
    FROM counts),
good AS (SELECT * FROM measured WHERE NOT base_failed),
g AS ({_fences_sql("lang, source,", LEAST_GROUP)}),
l AS ({_fences_sql("lang,", LEAST_GROUP)}),
w AS ({_fences_sql("", 1)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_WITHIN} AS kept, {", ".join(MEASURES)}
FROM measured m
LEFT JOIN g ON m.lang IS NOT DISTINCT FROM g.lang AND m.source IS NOT DISTINCT FROM g.source
LEFT JOIN l ON m.lang IS NOT DISTINCT FROM l.lang
LEFT JOIN w ON true
"""


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans",
                        F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = """
WITH bytes AS (SELECT row_number() OVER () AS n, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT n, doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT n, doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM bytes)),
again AS (SELECT n, i FROM strings QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
marked AS (SELECT n, i, CASE WHEN i <= lag(i) OVER (PARTITION BY n ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM again),
grouped AS (SELECT n, i, sum(fresh) OVER (PARTITION BY n ORDER BY i) AS span FROM marked),
spans AS (SELECT n, min(i) AS a, max(i) + 100 AS b FROM grouped GROUP BY n, span),
before AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY n ORDER BY a), 0) AS since FROM spans),
removed AS (
    SELECT n, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS until,
           string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS kept
    FROM before JOIN bytes USING (n) GROUP BY n)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * until + 1), h))) AS kept_sha256
FROM bytes LEFT JOIN removed USING (n)
"""


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_neighbours(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


# The check sum of a feature goes byte by byte through its table, which is made from the polynomial; bigints.
OP11_SQL = r"""
WITH RECURSIVE steps(n, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS crc FROM steps WHERE k = 8),
texts AS (
    SELECT 0 AS target, row_number() OVER () AS n, doc_id, text FROM documents
    UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
split AS (
    SELECT target, n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (
    SELECT target, n, unnest(w) AS f FROM split
    UNION ALL SELECT target, n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split),
counted AS (SELECT target, n, f, count(*) AS c FROM features GROUP BY ALL),
hexes AS (SELECT f, hex(encode(f)) AS h FROM counted GROUP BY f),
hashed AS (
    SELECT f, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
                              lambda a, b: xor(a >> 8, crc[1 + (xor(a, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
    FROM hexes, crc),
placed AS (SELECT target, n, c, bucket FROM counted JOIN hashed USING (f)),
sums AS (SELECT bucket, CAST(sum(c) FILTER (target = 0) AS DOUBLE) AS s, CAST(sum(c) FILTER (target = 1) AS DOUBLE) AS t FROM placed GROUP BY bucket),
whole AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM sums),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000) / ((coalesce(s, 0) + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM sums, whole),
sizes AS (SELECT n, sum(c) AS n_features, sum(c * gain) AS total FROM placed JOIN gains USING (bucket) WHERE target = 0 GROUP BY n),
scored AS (
    SELECT n, doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
           CAST(CASE WHEN n_features > 0 THEN (total - ((total % n_features) + n_features) % n_features) // n_features ELSE 0 END AS BIGINT) AS weight,
           CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
    FROM split LEFT JOIN sizes USING (n) WHERE target = 0),
drawn AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored),
ranked AS (
    SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, 25 * count(*) OVER () // 100 AS most FROM drawn WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= most THEN place END AS rank FROM drawn LEFT JOIN ranked USING (n)
"""


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(_table(spark, folder, "documents")))
    top = strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in ("start", "length", "period")]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_url_rules": op2_url_rules,
    "op3_pieces": op3_pieces,
    "op4_secrets": op4_secrets,
    "op5_warc": op5_warc,
    "op6_html_text": op6_html_text,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_neighbours": op10_neighbours,
    "op11_resampling": op11_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op2_url_rules": OP2_SQL,
    "op5_warc": OP5_SQL,
    "op7_quality": OP7_SQL,
    "op8_suffix_dedup": OP8_SQL,
    "op11_resampling": OP11_SQL,
}
