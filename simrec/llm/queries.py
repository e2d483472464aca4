"""The registered queries of the text operators and their oracle SQL.

Each query applies its operator, with the parameters of its contract, to the
whole table and derives the digest columns from the operator's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, langid, line_dedup, mixing, negatives, quality, resampling, simhash, suffix_dedup,
               token_counts, toxicity, url_filter)
from .common import small_side, table

W = r"[^\x20\x09-\x0D]+"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"), "copies")


OP1_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, coalesce(md5(text), 'null') AS th,
         coalesce(len(regexp_extract_all(text, '{W}')), 0)::BIGINT AS size FROM documents),
src AS (
  SELECT source, source_size,
         [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source)),
rounds AS (
  SELECT 0 AS i, 0.0::DOUBLE AS level, -1::BIGINT AS capped, 1.0::DOUBLE AS free
  UNION ALL
  SELECT i + 1, (1.5::DOUBLE * total - held) / free_now, at_top, free_now FROM (
    SELECT i, capped,
      count(*) FILTER (capped >= 0 AND w * level >= 2.0::DOUBLE * source_size) AS at_top,
      coalesce(sum(2.0::DOUBLE * source_size) FILTER (capped >= 0 AND w * level >= 2.0::DOUBLE * source_size), 0) AS held,
      sum(w) FILTER (NOT (capped >= 0 AND w * level >= 2.0::DOUBLE * source_size)) AS free_now,
      sum(source_size)::DOUBLE AS total
    FROM rounds, src GROUP BY i, capped)
  WHERE at_top <> capped AND free_now > 0),
last AS (SELECT level FROM rounds ORDER BY i DESC LIMIT 1),
rates AS (
  SELECT source, source_size, least(w * level, 2.0::DOUBLE * source_size) AS target,
         CASE WHEN source_size > 0 THEN least(w * level, 2.0::DOUBLE * source_size) / source_size ELSE 0 END AS rate
  FROM src, last)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (
  SELECT doc_id, size, source_size, target, (floor(rate) + CASE WHEN
      ('0x' || substr(md5('mix-0|' || coalesce(doc_id::VARCHAR, 'null') || '|' || th), 1, 13))::BIGINT
        / 4503599627370496::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source)
"""


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


OP5_SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{W}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines
  FROM documents),
grams AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM base WHERE len(w) > 2)),
twice AS (SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
covered AS (
  SELECT rid, count(*)::BIGINT AS n FROM (
    SELECT rid, i FROM twice UNION SELECT rid, i + 1 FROM twice UNION SELECT rid, i + 2 FROM twice)
  GROUP BY rid),
feats AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM base LEFT JOIN covered USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= 10 * n_words AND 100 * n_dup_lines <= 30 * n_lines
  AND word_chars BETWEEN 2 * n_words AND 25 * n_words AS kept
FROM (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM feats)
"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    seen = docs.where(~F.coalesce(held_out, F.lit(False)))
    labels, log_prob = langid.train(seen)
    out = langid.predict(docs, labels, log_prob)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


def kept_lines_sql(documents: str = "documents") -> str:
    """CTEs up to ``gone`` (pos) over ``lines`` (doc_id, i, pos, line); unique ids."""
    return rf"""lines AS (
  SELECT doc_id, i, doc_id * {1 << 27} + i AS pos, line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(0, len(string_split(text, chr(10))))) AS i FROM {documents} WHERE text IS NOT NULL)),
firsts AS (SELECT line, min(pos) AS first FROM lines WHERE regexp_matches(line, '{W}') GROUP BY line),
toks AS MATERIALIZED (
  SELECT first, unnest(list_distinct(regexp_extract_all(line, '{W}'))) AS w FROM firsts),
dfs AS (SELECT w, count(*) AS df FROM toks GROUP BY w),
ranked AS (
  SELECT first, w, row_number() OVER (PARTITION BY first ORDER BY df, w) AS k,
         count(*) OVER (PARTITION BY first) AS m FROM toks JOIN dfs USING (w)),
prefix AS MATERIALIZED (SELECT * FROM ranked WHERE k <= m - ceil(m * 4 / 5) + 1),
cand AS (
  SELECT DISTINCT a.first AS x, b.first AS y, a.m AS mx, b.m AS my FROM prefix a JOIN prefix b USING (w)
  WHERE b.first < a.first AND 5 * least(a.m, b.m) >= 4 * greatest(a.m, b.m)),
matched AS (
  SELECT DISTINCT x FROM (
    SELECT x, y, mx, my, count(*) AS o FROM cand JOIN toks a ON a.first = x
    JOIN toks b ON b.first = y AND a.w = b.w GROUP BY ALL)
  WHERE 9 * o >= 4 * (mx + my)),
gone AS (
  SELECT pos FROM lines JOIN firsts USING (line)
  WHERE pos <> first OR first IN (SELECT x FROM matched))"""


OP2_SQL = f"""
WITH {kept_lines_sql()},
per AS (
  SELECT doc_id, count(*) FILTER (regexp_matches(line, '{W}')) AS n_lines,
    count(*) FILTER (pos IN (SELECT pos FROM gone)) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (pos NOT IN (SELECT pos FROM gone)), '') AS kept
  FROM lines GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       md5(kept) AS kept_md5
FROM documents LEFT JOIN per USING (doc_id)
"""


def op3_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.simhash_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                          "component_id")


URL_RULES = (
    url_filter.UrlRule("allow", "org", "/"),
    url_filter.UrlRule("block", "example.org", "/es/"),
    url_filter.UrlRule("block", "example.org", "/en/1"),
    url_filter.UrlRule("allow", "com", "/fr/"),
    url_filter.UrlRule("block", "com", "/de/"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), URL_RULES)


_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULES_SQL = " UNION ALL ".join(
    f"SELECT '{r.verdict}' AS verdict, '{r.host}' AS h, '{r.path}' AS p" for r in URL_RULES)


def _url_parts(url: str) -> str:
    rx = "://([^/?#]*)([^?#]*)([?][^#]*)?"
    return (f"translate(coalesce(regexp_extract({url}, '{rx}', 1), ''), '{_A}', '{_Z}') AS host, "
            f"coalesce(regexp_extract({url}, '{rx}', 2), '') AS path, "
            f"coalesce(regexp_extract({url}, '{rx}', 3), '') AS query")


def _tags(before: str, inside: str, value: str) -> str:
    """The tags of a kind, then the wanted attribute of each (RE2 has no look-ahead)."""
    tags = f"regexp_extract_all(html, '(?is)<{before}\\b[^>]*>')"
    tags = f"list_filter({tags}, lambda t: regexp_matches(t, '(?is){inside}'))"
    return f"unnest(list_transform({tags}, lambda t: regexp_extract(t, '(?is){value}', 1)))"


_Q = """["'']?"""
OP4_SQL = f"""
WITH RECURSIVE rules AS ({_RULES_SQL}),
tags AS (
  SELECT url, {_tags("link", f"rel\\s*=\\s*{_Q}canonical", f"href\\s*=\\s*{_Q}([^''\"\\s>]+)")} AS href FROM pages
  UNION ALL
  SELECT url, {_tags("meta", f"http-equiv\\s*=\\s*{_Q}refresh", f"url\\s*=\\s*{_Q}([^''\"\\s>]+)")} FROM pages),
hrefs AS (SELECT url, regexp_replace(href, '&(amp|#38|#x26);', '&', 'gi') AS href FROM tags),
targets AS (
  SELECT url, CASE WHEN contains(href, '://') THEN href
    WHEN starts_with(href, '//') THEN regexp_extract(url, '^([^:/?#]*)://', 1) || ':' || href
    WHEN starts_with(href, '/') THEN '://' || host || href
    WHEN starts_with(href, '#') THEN NULL
    WHEN starts_with(href, '?') THEN '://' || host || path || href
    ELSE '://' || host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/'
      ELSE regexp_extract(path, '^(.*/)', 1) END || href END AS target
  FROM (SELECT url, href, {_url_parts("url")} FROM hrefs WHERE href <> '' AND url IS NOT NULL)),
edges AS (
  SELECT a, host || CASE WHEN regexp_matches(path, '/[.][.]?(/|$)') THEN
      list_reduce(string_split(path, '/'), lambda done, part: CASE part WHEN '.' THEN done
        WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || part END)
      || CASE WHEN regexp_matches(path, '/[.][.]?$') THEN '/' ELSE '' END ELSE path END || query AS b
  FROM (SELECT (SELECT host || path || query FROM (SELECT {_url_parts("url")})) AS a,
               {_url_parts("target")} FROM targets)
  WHERE a <> '' AND host <> '' AND a <> b),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (SELECT a AS node, a AS other FROM both_ways
          UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
judged AS (
  SELECT addr, host, path, query, h || p AS rule, verdict FROM (
    SELECT addr, {_url_parts("addr")} FROM (
      SELECT DISTINCT url AS addr FROM pages UNION SELECT '://' || other FROM reach))
  LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY addr ORDER BY length(h || p) DESC NULLS LAST,
                             verdict = 'allow' DESC, h || p DESC) = 1),
blocked AS (
  SELECT reach.node FROM reach JOIN judged ON judged.addr = '://' || reach.other
  GROUP BY reach.node HAVING max(CASE verdict WHEN 'allow' THEN 1 WHEN 'block' THEN 0 END) = 0)
SELECT page_id, j.host, j.path, j.rule,
  CASE WHEN j.rule IS NOT NULL THEN j.verdict WHEN blocked.node IS NOT NULL THEN 'block'
       ELSE 'allow' END AS verdict
FROM pages JOIN judged j ON pages.url IS NOT DISTINCT FROM j.addr
LEFT JOIN blocked ON j.host <> '' AND blocked.node = j.host || j.path || j.query
"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.cut_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"),
                                              table(spark, sf_dir, "benchmark"))


def leaks_sql(documents: str = "documents") -> str:
    """CTEs up to ``leaks`` (rid, item_id) and ``numbered`` (rid and the rows).

    No seed of the operator is used: every alignment with two neighbouring tokens alike (or the
    one token of an item) is compared whole, and every window of it counted. At 16 of 20 tokens
    at least four neighbours agree, and of fewer tokens at least two.
    """
    return rf"""numbered AS (SELECT row_number() OVER () AS rid, * FROM {documents}),
dw AS (SELECT rid, regexp_extract_all(lower(text), '{W}') AS w FROM numbered WHERE text IS NOT NULL),
bw AS (SELECT row_number() OVER () AS bid, item_id, regexp_extract_all(lower(text), '{W}') AS w
       FROM benchmark WHERE text IS NOT NULL),
dt AS (SELECT rid, unnest(w) AS tok, unnest(w[2:]) AS after, unnest(range(0, len(w))) AS i FROM dw),
bt AS (SELECT bid, len(w) AS items, unnest(w) AS tok, unnest(w[2:]) AS after,
       unnest(range(0, len(w))) AS j FROM bw),
aligned AS (
  SELECT rid, bid, i - j AS d FROM dt JOIN bt ON dt.tok = bt.tok AND dt.after = bt.after
  UNION
  SELECT rid, bid, i - j AS d FROM dt JOIN bt ON dt.tok = bt.tok AND bt.items = 1),
alike AS (
  SELECT rid, bid, least({decontaminate.WINDOW}, items) AS size, count(*) OVER (
           PARTITION BY rid, bid, d ORDER BY j RANGE BETWEEN {decontaminate.WINDOW - 1} PRECEDING AND CURRENT ROW) AS same
  FROM aligned JOIN bt USING (bid) JOIN dt USING (rid)
  WHERE dt.i = d + j AND dt.tok = bt.tok),
leaks AS (SELECT DISTINCT rid, item_id FROM alike JOIN bw USING (bid)
          WHERE same >= ceil(size * {decontaminate.MIN_MATCH}::DOUBLE))"""


OP8_SQL = f"""
WITH {leaks_sql()},
per AS (SELECT rid, count(DISTINCT item_id) AS n, list_sort(list_distinct(list(item_id))) AS ids
        FROM leaks GROUP BY rid)
SELECT doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0)::BIGINT AS n_items,
       coalesce(array_to_string(ids, ','), '') AS items
FROM numbered LEFT JOIN per USING (rid)
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate_perspectives(table(spark, sf_dir, "conversations"))
    masked = F.aggregate("masks", F.lit(0).cast("long"), lambda n, m: n + m["length"])
    edges = F.array_join(F.transform("masks", lambda m: F.concat_ws("+", m["begin"], m["length"])), ",")
    return out.select("conv_id", "perspective", "part", "n_turns",
                      F.length("dialogue").cast("long").alias("n_chars"),
                      F.size("masks").cast("long").alias("n_masks"), masked.alias("masked_chars"),
                      F.md5(edges).alias("masks_md5"), F.md5("dialogue").alias("dialogue_md5"))


OP9_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'),
                       coalesce(text, '')) AS rn FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
m AS (
  SELECT t.conv_id, perspective, (rn - 1) // {chat.PART_TURNS} AS part, rn, t.role = perspective AS own,
    CASE WHEN t.role = 'system' THEN '<|system|>' WHEN t.role = perspective THEN '<|assistant|>'
         ELSE '<|user name=' || t.role || '|>' END || chr(10) AS head, text || '<|end|>' AS body
  FROM t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
spot AS (
  SELECT *, length(head) + coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, perspective, part ORDER BY rn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM m)
SELECT conv_id, perspective, part::BIGINT AS part, count(*)::BIGINT AS n_turns,
  sum(length(head) + length(body) + 1)::BIGINT AS n_chars, count(*) FILTER (own)::BIGINT AS n_masks,
  coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS masked_chars,
  md5(coalesce(string_agg(pos::BIGINT::VARCHAR || '+' || length(body), ',' ORDER BY rn) FILTER (own), '')) AS masks_md5,
  md5(string_agg(head || body || chr(10), '' ORDER BY rn)) AS dialogue_md5
FROM spot GROUP BY conv_id, perspective, part
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = resampling.resampling_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return plan.select("doc_id", "n_features", "weight", "score", "rank")


_WORD11 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOW11 = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# DuckDB has no CRC: its table by the polynomial, then one step a byte
OP11_SQL = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
dw AS (SELECT rid, unnest(regexp_extract_all({_LOW11}, '{_WORD11}')) AS w
       FROM (SELECT row_number() OVER () AS rid, text FROM documents)),
bw AS (SELECT unnest(regexp_extract_all({_LOW11}, '{_WORD11}')) AS w FROM benchmark),
vocab AS (SELECT w, list_transform(range(0, length(hex(encode(w))), 2),
    lambda i: ('0x' || hex(encode(w))[i + 1:i + 2])::BIGINT) AS bytes
  FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
hashed AS (SELECT w, xor(list_reduce([4294967295::BIGINT] || bytes,
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM vocab, crc),
s AS (SELECT b, count(*) AS n FROM dw JOIN hashed USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN hashed USING (w) GROUP BY b),
gain AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (SELECT sum(n) + 10000 FROM s)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (SELECT coalesce(sum(n), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS g
  FROM s FULL JOIN t USING (b)),
per AS (SELECT rid, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
        FROM dw JOIN hashed USING (w) JOIN gain USING (b) GROUP BY rid),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5)
            / 4294967296::DOUBLE)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rid, doc_id FROM documents) LEFT JOIN per USING (rid)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS drawn FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= drawn THEN place::BIGINT END AS rank FROM ranked
"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    known = small_side(table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out))
    machine = toxicity.train(docs.select("doc_id", "text").join(known, "doc_id"), "toxic")
    out = toxicity.score(docs, machine)
    return out.select("doc_id", held_out.alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return negatives.mine(rows, F.col("id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


LLM_QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash_neardup": op3_simhash_neardup,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_chat_format": op9_chat_format,
    "op10_token_counts": op10_token_counts,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

LLM_ORACLE = {
    "op1_mix_sources": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op4_url_filter": OP4_SQL,
    "op5_quality_rules": OP5_SQL,
    "op8_decontaminate": OP8_SQL,
    "op9_chat_format": OP9_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
