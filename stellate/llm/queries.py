"""Registered queries of the training-data operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import alignment, decontaminate, hosts, langid, lexical, packing, prefix_counts, quality_rules, resample, simhash, substrings, suffixes, weighted_sampling
from stellate.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return deco


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


@query()
def op1_simhash_gray_index(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "copies")


@query()
def op2_weighted_sampling(spark, sf_dir):
    return weighted_sampling.edit_robustness(documents(spark, sf_dir))


@query()
def op3_power_of_two_packing(spark, sf_dir):
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP4_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP4_SQL = f"""
WITH b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_OP4_WORDS} AS w FROM benchmark),
d AS (SELECT row_number() OVER () AS r, doc_id, {_OP4_WORDS} AS w FROM documents),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM
  (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM
  (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item FROM dw JOIN win ON dw.p = win.p AND dw.n = win.n),
cov AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r)"""


@query(_OP4_SQL)
def op4_fm_index_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def _repeats_sql(units: str, length: str, window: str, part: str, width: int, result: str) -> str:
    """Islands of repeated windows: texts as ``units``, windows and kept parts as SQL over them (positions
    from 0)."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {units} AS u FROM documents),
n AS (SELECT r, doc_id, u, CAST({length} AS BIGINT) AS n FROM d),
w AS (SELECT r, i, md5({window}) AS k FROM (SELECT r, u, unnest(range(0, n - {width - 1})) AS i FROM n WHERE n >= {width})),
rep AS (SELECT r, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
isl AS (SELECT r, i, sum(CASE WHEN i - before > {width} OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM rep)),
span AS (SELECT r, g, min(i) AS s, max(i) + {width} AS e FROM isl GROUP BY r, g),
gap AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS b FROM span
  UNION ALL SELECT n.r, coalesce(max(e), 0), min(n.n) FROM n LEFT JOIN span USING (r) GROUP BY n.r),
kept AS (SELECT r, {part} AS kept FROM gap JOIN n USING (r) WHERE b > a GROUP BY r),
cnt AS (SELECT r, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, {result} FROM n LEFT JOIN cnt USING (r) LEFT JOIN kept USING (r)"""


_OP5_SQL = _repeats_sql(
    r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')", "len(u)", "array_to_string(u[i + 1:i + 35], ' ')",
    "string_agg(array_to_string(u[a + 1:b], ' '), ' ' ORDER BY a)", 35,
    "n AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256")
_OP6_SQL = _repeats_sql(
    "hex(encode(coalesce(text, '')))", "length(u) // 2", "substr(u, 2 * i + 1, 400)",
    "string_agg(substr(u, 2 * a + 1, 2 * (b - a)), '' ORDER BY a)", 200,
    "n AS n_bytes, coalesce(n_removed, 0) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, "
    "sha256(unhex(coalesce(kept, ''))) AS kept_sha256")


@query(_OP5_SQL)
def op5_rabin_karp_substrings(spark, sf_dir):
    found = substrings.dedup_substrings(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query(_OP6_SQL)
def op6_suffix_merge_sort(spark, sf_dir):
    found = suffixes.dedup_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_ppm_language_id(spark, sf_dir):
    found = langid.identify(documents(spark, sf_dir))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


# Fixed rules of the query: (host, path prefix, verdict).
SITE_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
              ("net", "/es/", "block"), ("net", "/fr/", "block"))

_OP8_SQL = r"""
WITH p AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
    WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS k,
    coalesce(nullif(regexp_extract(host, '([^.]+\.[^.]+)$', 1), ''), host) AS domain, regexp_extract(host, '([^.]*)$', 1) AS suffix
    FROM p LEFT JOIN o ON page_id = doc_id GROUP BY host),
d AS (SELECT domain, min(suffix) AS suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY domain),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix),
b AS (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.5 END AS r FROM s),
m AS (SELECT 's' AS lvl, sum(n) n, sum(n * n) nn, sum(k * k) kk, sum(k * n) kn FROM s UNION ALL
      SELECT 'd', sum(n), sum(n * n), sum(k * k), sum(k * n) FROM d UNION ALL
      SELECT 'h', sum(n), sum(n * n), sum(k * k), sum(k * n) FROM h),
x AS (SELECT lvl, CASE WHEN n IS NULL OR n = 0 OR nn <= n OR r <= 0 OR r >= 1 THEN NULL
      ELSE ((kk - 2.0 * r * kn + r * r * nn) / (r * (1.0 - r)) - n) / (nn - n) END AS rho FROM m, b),
g AS (SELECT max(v) FILTER (lvl = 's') AS s1, max(v) FILTER (lvl = 'd') AS s2, max(v) FILTER (lvl = 'h') AS s3 FROM
      (SELECT lvl, CASE WHEN rho IS NULL OR rho <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, 1.0 / rho - 1.0)) END AS v FROM x)),
sr AS (SELECT suffix, (k + s1 * r) / (n + s1) AS rate FROM s, g, b),
dr AS (SELECT d.domain, (d.k + s2 * sr.rate) / (d.n + s2) AS rate FROM d JOIN sr USING (suffix), g),
hm AS (SELECT h.host, (h.k + s3 * dr.rate) / (h.n + s3) AS mean, h.n + s3 AS size FROM h JOIN dr USING (domain), g),
hb AS (SELECT host, mean, mean - 1.645 * sqrt(mean * (1.0 - mean) / (size + 1.0)) AS bound FROM hm),
j AS (SELECT page_id, p.host, path, bound, CASE {rules} ELSE NULL END AS rule, CASE {verdicts} ELSE NULL END AS said
      FROM p JOIN hb ON p.host = hb.host)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bound >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict FROM j
"""
_WHEN = [(f"(p.host = '{h}' OR ends_with(p.host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
         for h, p, v in sorted(SITE_RULES, key=lambda r: -len(r[0] + r[1]))]
_OP8_SQL = _OP8_SQL.format(rules=" ".join(f"WHEN {c} THEN '{t}'" for c, t, _ in _WHEN),
                           verdicts=" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in _WHEN))


@query(_OP8_SQL)
def op8_host_reputation(spark, sf_dir):
    """Outcomes: the label row whose doc_id is the page's page_id."""
    judged = hosts.judge(load_table(spark, sf_dir, "pages"), hosts.outcomes(load_table(spark, sf_dir, "labels")), SITE_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op9_importance_resampling(spark, sf_dir):
    """The drawn sample."""
    drawn = resample.resample(documents(spark, sf_dir), load_table(spark, sf_dir, "labels"))
    return drawn.where("selected")


@query()
def op10_prefix_token_counts(spark, sf_dir):
    counted = prefix_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), tables=False)
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query()
def op13_cross_tokenizer_alignment(spark, sf_dir):
    found, _ = alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
    return found


def _op12_sql() -> str:
    """Counts, sketches of the three levels, cutoffs and verdicts of ``quality_rules`` with its parameters."""
    rules = quality_rules
    parts = {"word_length": ("word_chars", "n_words"), "symbol_rate": ("n_symbols", "n_words"),
             "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words")}
    ratios = ", ".join(f"CASE WHEN {w} > 0 THEN {rules.SCALE} * {p} // {w} END AS {m}" for m, (p, w) in parts.items())
    size = f"greatest(length(bin(v)) - {rules.BITS}, 0)"
    highs = ", ".join(f"max(CASE WHEN metric = '{m}' THEN q90 + {rules.REACH} * greatest(q90 - q50, {t}) END) AS {m}_high"
                      for m, t in rules.TOLERANCE.items())
    lows = ", ".join(f"max(CASE WHEN metric = '{m}' THEN greatest(q10 - {rules.REACH} * greatest(q50 - q10, {rules.TOLERANCE[m]}), 0) END) AS {m}_low"
                     for m in rules.TWO_SIDED)
    names = [f"{m}_high" for m in rules.TOLERANCE] + [f"{m}_low" for m in rules.TWO_SIDED]
    quantiles = ", ".join(f"min(CASE WHEN 100 * upto >= {q} * total THEN bucket END) AS q{q}" for q in (10, 50, 90))
    levels = "".join(f"""
{level}q AS (SELECT {keys}metric, max(total) AS docs, {quantiles} FROM (SELECT {keys}metric, bucket, sum(count(*)) OVER (PARTITION BY {keys}metric ORDER BY bucket) AS upto,
  sum(count(*)) OVER (PARTITION BY {keys}metric) AS total FROM v GROUP BY {keys}metric, bucket) GROUP BY {keys}metric),
{level} AS (SELECT {keys}max(docs) AS docs, {highs}, {lows} FROM {level}q{" GROUP BY " + keys.rstrip(", ") if keys else ""}),"""
                     for level, keys in (("src", "lang, source, "), ("lng", "lang, "), ("every", "")))
    use = ", ".join(f"CASE WHEN src.docs >= {rules.LEAST} THEN src.{n} WHEN lng.docs >= {rules.LEAST} THEN lng.{n} ELSE every.{n} END AS {n}" for n in names)
    broken = " OR ".join([f"coalesce({m} > {m}_high, false)" for m in rules.TOLERANCE] + [f"coalesce({m} < {m}_low, false)" for m in rules.TWO_SIDED])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
lc AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_lines, CAST(sum(n - 1) AS BIGINT) AS n_dup_lines FROM lines GROUP BY r),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, p) AS n FROM (SELECT r, i, array_to_string(w[i:i + {rules.WINDOW - 1}], ' ') AS p FROM
  (SELECT r, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) AS i FROM d WHERE len(w) >= {rules.WINDOW}))),
rc AS (SELECT r, count(DISTINCT pos) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + {rules.WINDOW})) AS pos FROM win WHERE n > 1) GROUP BY r),
m AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lc USING (r) LEFT JOIN rc USING (r)),
x AS (SELECT *, {ratios}, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > {rules.REPEAT_PERCENT} * n_words AS base_failed FROM m),
v AS (SELECT lang, source, metric, (v >> {size}) << {size} AS bucket FROM (SELECT lang, source, unnest(['{"', '".join(parts)}']) AS metric,
  unnest([{", ".join(parts)}]) AS v FROM x WHERE n_words > 0)),{levels}
cut AS (SELECT src.lang, src.source, {use} FROM src LEFT JOIN lng ON src.lang IS NOT DISTINCT FROM lng.lang, every)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({broken}) AS kept
FROM x LEFT JOIN cut ON x.lang IS NOT DISTINCT FROM cut.lang AND x.source IS NOT DISTINCT FROM cut.source"""


@query(_op12_sql())
def op12_adaptive_quality_rules(spark, sf_dir):
    judged = quality_rules.apply_rules(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_OP11_TERMS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP11_SQL = f"""
WITH b AS (SELECT row_number() OVER () AS q, item_id, {_OP11_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qt AS (SELECT DISTINCT q, item_id, unnest(w) AS term FROM b),
d AS (SELECT * FROM (SELECT row_number() OVER () AS r, doc_id, {_OP11_TERMS} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM qt) GROUP BY r, term),
t AS (SELECT term, CAST(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY term, big_n),
sc AS (SELECT q, item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(w) * big_n) // big_l)))) AS BIGINT) AS score
  FROM qt JOIN p USING (term) JOIN t USING (term) JOIN d USING (r), s GROUP BY q, item_id, r),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM sc JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


@query(_OP11_SQL)
def op11_stratified_search(spark, sf_dir):
    return lexical.search(documents(spark, sf_dir), load_table(spark, sf_dir, "benchmark"))
