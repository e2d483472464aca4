"""Independent SQL (DuckDB dialect) for every registered query.

Written against the base tables only (lineitem, orders, documents). The
hash constants are the same Python list the Spark jobs use; everything else
is plain SQL with the naive algorithms (for example the exact Jaccard here
is the full member self-join, not the prefix filter).
"""

from __future__ import annotations

from ..functions.constants import (BUCKET_MOD, DEFAULT_STARS, HASH_SEED, NUM_BANDS, NUM_HASHES,
                                   SIGNED_ZERO_EPS, THRESHOLD, band_rows, hash_constants)

D = "CAST({} AS DOUBLE)"

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(max(1 + CAST(floor(l_quantity) AS INTEGER) % 5) AS DOUBLE) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
TRAIN = "train AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 20 <> 0)"
HOLDOUT = "holdout AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 20 = 0)"
TEST = """test_pairs AS (
  SELECT user_id, item_id, stars FROM holdout
  UNION ALL SELECT user_id, item_id, stars FROM ratings WHERE (user_id * 31 + item_id * 17) % 20 = 1
  UNION ALL SELECT -1 - user_id, item_id, stars FROM holdout
  UNION ALL SELECT user_id, -1 - item_id, stars FROM holdout)"""
DOC_WORDS = r"""doc_words AS (
  SELECT DISTINCT item_id, member_id FROM (
    SELECT doc_id AS item_id, unnest(string_split_regex(lower(text), '\s+')) AS member_id
    FROM documents) WHERE member_id <> '')"""
TRAIN_BASKETS = "tb AS (SELECT DISTINCT item_id, user_id AS member_id FROM train)"
CF_BASE = [RATINGS, TRAIN, HOLDOUT, TEST]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _sizes(bk: str, name: str) -> str:
    return f"{name} AS (SELECT item_id, count(*) AS n FROM {bk} GROUP BY 1)"


def _exact_pairs(bk: str, name: str, t: float = THRESHOLD) -> list[str]:
    return [
        _sizes(bk, f"{name}_sz"),
        f"""{name}_ov AS (SELECT a.item_id AS item_1, b.item_id AS item_2, count(*) AS k
  FROM {bk} a JOIN {bk} b ON a.member_id = b.member_id AND a.item_id < b.item_id GROUP BY 1, 2)""",
        f"""{name} AS (SELECT o.item_1, o.item_2,
    CAST(o.k AS DOUBLE) / CAST(s1.n + s2.n - o.k AS DOUBLE) AS similarity
  FROM {name}_ov o JOIN {name}_sz s1 ON s1.item_id = o.item_1 JOIN {name}_sz s2 ON s2.item_id = o.item_2
  WHERE CAST(o.k AS DOUBLE) / CAST(s1.n + s2.n - o.k AS DOUBLE) >= {D.format(t)})""",
    ]


def _ordinals(bk: str, name: str) -> str:
    return f"""{name} AS (SELECT member_id, dense_rank() OVER (ORDER BY member_id) AS x,
    count(*) OVER () AS n FROM (SELECT DISTINCT member_id FROM {bk}))"""


def _signatures(bk: str, name: str, seed: int = HASH_SEED, num_hashes: int = NUM_HASHES) -> list[str]:
    mins = []
    for k, (ra, rb) in enumerate(hash_constants(num_hashes, seed), start=1):
        a = f"(1 + 2 * ({ra} % greatest(o.n // 2, 1)))"
        b = f"({rb} % o.n)"
        mins.append(f"min(({a} * o.x + {b}) % o.n) AS mh_{k:02d}")
    return [_ordinals(bk, f"{name}_ord"),
            f"""{name} AS (SELECT d.item_id, {", ".join(mins)}
  FROM {bk} d JOIN {name}_ord o ON o.member_id = d.member_id GROUP BY d.item_id)"""]


def _candidates(bk: str, name: str) -> list[str]:
    sig = f"{name}_sig"
    parts = []
    for label, hashes in band_rows(NUM_HASHES, NUM_BANDS):
        keys = ", ".join(f"mh_{h:02d} % {BUCKET_MOD} AS k{j}" for j, h in enumerate(hashes))
        parts.append(f"SELECT item_id, {label} AS band, {keys} FROM {sig}")
    nrows = len(band_rows(NUM_HASHES, NUM_BANDS)[0][1])
    on = " AND ".join(f"l.k{j} = r.k{j}" for j in range(nrows))
    return _signatures(bk, sig) + [
        f"{name}_bk AS ({' UNION ALL '.join(parts)})",
        f"""{name} AS (SELECT DISTINCT l.item_id AS item_1, r.item_id AS item_2
  FROM {name}_bk l JOIN {name}_bk r ON l.band = r.band AND {on} AND l.item_id < r.item_id)"""]


def _verified(bk: str, cand: str, name: str, t: float = THRESHOLD) -> list[str]:
    return [
        _sizes(bk, f"{name}_sz"),
        f"""{name}_ov AS (SELECT c.item_1, c.item_2, count(*) AS k FROM {cand} c
  JOIN {bk} a ON a.item_id = c.item_1 JOIN {bk} b ON b.item_id = c.item_2 AND b.member_id = a.member_id
  GROUP BY 1, 2)""",
        f"""{name} AS (SELECT o.item_1, o.item_2,
    CAST(o.k AS DOUBLE) / CAST(s1.n + s2.n - o.k AS DOUBLE) AS similarity
  FROM {name}_ov o JOIN {name}_sz s1 ON s1.item_id = o.item_1 JOIN {name}_sz s2 ON s2.item_id = o.item_2
  WHERE CAST(o.k AS DOUBLE) / CAST(s1.n + s2.n - o.k AS DOUBLE) >= {D.format(t)})"""]


# ---- collaborative filtering --------------------------------------------

LABELED = """lab AS (
  SELECT t.user_id, t.item_id, s.stars AS seen_stars,
         CASE WHEN s.stars IS NOT NULL THEN 'seen'
              WHEN ku.user_id IS NULL OR ki.item_id IS NULL THEN 'cold' ELSE 'cf' END AS branch
  FROM test_pairs t
  LEFT JOIN train s ON s.user_id = t.user_id AND s.item_id = t.item_id
  LEFT JOIN (SELECT DISTINCT user_id FROM train) ku ON ku.user_id = t.user_id
  LEFT JOIN (SELECT DISTINCT item_id FROM train) ki ON ki.item_id = t.item_id)"""
CF_ROWS = "cf AS (SELECT DISTINCT user_id, item_id FROM lab WHERE branch = 'cf')"

USER_NEIGH = """neigh AS (SELECT c.user_id, c.item_id, t.user_id AS neighbour_id, t.stars AS r_vi
  FROM cf c JOIN train t ON t.item_id = c.item_id)"""
USER_STATS = """ust AS (SELECT p.user_id, p.neighbour_id, CAST(count(*) AS DOUBLE) AS n,
    sum(a.stars) AS sx, sum(b.stars) AS sy, sum(a.stars * a.stars) AS sxx,
    sum(b.stars * b.stars) AS syy, sum(a.stars * b.stars) AS sxy
  FROM (SELECT DISTINCT user_id, neighbour_id FROM neigh) p
  JOIN train a ON a.user_id = p.user_id
  JOIN train b ON b.user_id = p.neighbour_id AND b.item_id = a.item_id
  GROUP BY 1, 2)"""
ITEM_NEIGH = """neigh AS (SELECT c.user_id, c.item_id, t.item_id AS neighbour_item, t.stars AS r_uj
  FROM cf c JOIN train t ON t.user_id = c.user_id)"""


def _item_stats(neigh: str) -> str:
    return f"""ist AS (SELECT p.item_id, p.neighbour_item, CAST(count(*) AS DOUBLE) AS n,
    sum(a.stars) AS sx, sum(b.stars) AS sy, sum(a.stars * a.stars) AS sxx,
    sum(b.stars * b.stars) AS syy, sum(a.stars * b.stars) AS sxy
  FROM (SELECT DISTINCT item_id, neighbour_item FROM {neigh}) p
  JOIN train a ON a.item_id = p.item_id
  JOIN train b ON b.item_id = p.neighbour_item AND b.user_id = a.user_id
  GROUP BY 1, 2)"""


def _ratio(stats: str, name: str) -> str:
    return f"""{name} AS (SELECT *, (cxx <= 0 AND cyy <= 0) AS degenerate,
    CASE WHEN cxx <= 0 AND cyy <= 0 THEN NULL
         ELSE (cxy / n) / (sqrt(greatest(cxx, 0.0) / n) + sqrt(greatest(cyy, 0.0) / n)) END AS ratio
  FROM (SELECT *, n * sxy - sx * sy AS cxy, n * sxx - sx * sx AS cxx, n * syy - sy * sy AS cyy FROM {stats}))"""


def _final(cfp: str, rounded: bool = True) -> str:
    pred = f"""CASE WHEN l.branch = 'seen' THEN l.seen_stars
             WHEN l.branch = 'cold' THEN {D.format(DEFAULT_STARS)}
             ELSE coalesce(p.cfp, {D.format(DEFAULT_STARS)}) END"""
    if rounded:
        pred = f"round({pred}, 6)"
    return f"""SELECT l.user_id, l.item_id, {pred} AS prediction, l.branch
FROM lab l LEFT JOIN {cfp} p ON p.user_id = l.user_id AND p.item_id = l.item_id"""


def _zero(den: str, signed: bool = False) -> str:
    return f"({den} IS NULL OR {f'abs({den}) < {SIGNED_ZERO_EPS!r}' if signed else f'{den} = 0'})"


def _clamp(x: str) -> str:
    return f"greatest(CAST(0.0 AS DOUBLE), least(CAST(5.0 AS DOUBLE), {x}))"


def user_cf_ctes() -> list[str]:
    return CF_BASE + [LABELED, CF_ROWS, USER_NEIGH, USER_STATS, _ratio("ust", "uw"),
        f"""usums AS (SELECT g.user_id, g.item_id,
    sum((g.r_vi - w.sy / w.n) * CASE WHEN w.degenerate THEN {D.format(0.5)} ELSE w.ratio END) AS num,
    sum(abs(CASE WHEN w.degenerate THEN {D.format(0.5)} ELSE w.ratio END)) AS den
  FROM neigh g JOIN uw w ON w.user_id = g.user_id AND w.neighbour_id = g.neighbour_id GROUP BY 1, 2)""",
        "umeans AS (SELECT user_id, avg(stars) AS mean FROM train GROUP BY 1)",
        f"""ucf AS (SELECT s.user_id, s.item_id,
    CASE WHEN {_zero('s.den')} THEN {D.format(DEFAULT_STARS)} ELSE {_clamp('m.mean + s.num / s.den')} END AS cfp
  FROM usums s JOIN umeans m ON m.user_id = s.user_id)"""]


def item_cf_sql(weighting: str = "abs", candidates: bool = False, mode: str = "filter") -> str:
    ctes = CF_BASE + [LABELED, CF_ROWS, ITEM_NEIGH]
    neigh = "neigh"
    cand_flag = "FALSE"
    if candidates:
        ctes += [TRAIN_BASKETS] + _candidates("tb", "cand")
        ctes.append("""edges AS (SELECT DISTINCT item_1 AS item_id, item_2 AS neighbour_item FROM cand
  UNION SELECT item_2, item_1 FROM cand)""")
        if mode == "filter":
            ctes.append("""neigh2 AS (SELECT g.*, FALSE AS is_cand FROM neigh g
  WHERE EXISTS (SELECT 1 FROM edges e WHERE e.item_id = g.item_id AND e.neighbour_item = g.neighbour_item))""")
        else:
            ctes.append("""neigh2 AS (SELECT g.*, e.item_id IS NOT NULL AS is_cand FROM neigh g
  LEFT JOIN edges e ON e.item_id = g.item_id AND e.neighbour_item = g.neighbour_item)""")
        neigh = "neigh2"
        cand_flag = "g.is_cand"
    base = "abs(w.ratio)" if weighting == "abs" else "w.ratio * pow(abs(w.ratio), 1.5)"
    wexpr = f"(CASE WHEN w.degenerate THEN {D.format(0.5)} ELSE {base} END)"
    if candidates and mode == "reweight":
        wexpr = f"(CASE WHEN {cand_flag} THEN {wexpr} * pow(abs({wexpr}), 0.5) ELSE {wexpr} END)"
    ctes += [_item_stats(neigh), _ratio("ist", "iw"),
             f"""isums AS (SELECT g.user_id, g.item_id, sum(g.r_uj * {wexpr}) AS num, sum({wexpr}) AS den
  FROM {neigh} g JOIN iw w ON w.item_id = g.item_id AND w.neighbour_item = g.neighbour_item GROUP BY 1, 2)""",
             f"""icf AS (SELECT user_id, item_id,
    CASE WHEN {_zero('den', weighting != 'abs')} THEN {D.format(DEFAULT_STARS)} ELSE {_clamp('num / den')} END AS cfp FROM isums)"""]
    return _with(*ctes) + _final("icf")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ratings_scan"] = _with(RATINGS) + "SELECT user_id, item_id, stars FROM ratings"
    q["item_user_counts"] = """SELECT l_partkey AS item_id, count(DISTINCT o_custkey) AS n_members,
  count(*) AS n_rows FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
    q["doc_word_counts"] = _with(DOC_WORDS) + "SELECT item_id, count(*) AS n_members FROM doc_words GROUP BY 1"
    q["exact_jaccard_pairs"] = _with(DOC_WORDS, *_exact_pairs("doc_words", "ex")) + "SELECT * FROM ex"
    q["member_ordinals"] = _with(DOC_WORDS, _ordinals("doc_words", "o")) + "SELECT member_id, x, n FROM o"
    q["minhash_signatures"] = _with(DOC_WORDS, *_signatures("doc_words", "sig")) + "SELECT * FROM sig"
    q["lsh_candidates"] = _with(DOC_WORDS, *_candidates("doc_words", "cand")) + "SELECT * FROM cand"
    q["similar_items_lsh"] = (_with(DOC_WORDS, *_candidates("doc_words", "cand"),
                                    *_verified("doc_words", "cand", "lsh")) + "SELECT * FROM lsh")
    q["lsh_pair_metrics"] = (_with(DOC_WORDS, *_candidates("doc_words", "cand"),
                                   *_verified("doc_words", "cand", "lsh"),
                                   *_exact_pairs("doc_words", "ex"))
                             + """, c AS (SELECT
    CAST((SELECT count(*) FROM lsh JOIN ex USING (item_1, item_2)) AS BIGINT) AS tp,
    CAST((SELECT count(*) FROM lsh) AS BIGINT) AS n_out, CAST((SELECT count(*) FROM ex) AS BIGINT) AS n_truth)
SELECT tp, n_out - tp AS fp, n_truth - tp AS fn,
  CASE WHEN n_out = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / n_out END AS precision,
  CASE WHEN n_truth = 0 THEN NULL ELSE CAST(tp AS DOUBLE) / n_truth END AS recall FROM c""")
    q["item_jaccard_exact"] = (_with(RATINGS, TRAIN, TRAIN_BASKETS, *_exact_pairs("tb", "ex", 0.1))
                               + "SELECT * FROM ex")
    q["lsh_candidates_train"] = _with(RATINGS, TRAIN, TRAIN_BASKETS, *_candidates("tb", "cand")) + "SELECT * FROM cand"
    q["user_means"] = (_with(RATINGS, TRAIN)
                       + "SELECT user_id, avg(stars) AS mean_stars, count(*) AS n_ratings FROM train GROUP BY 1")
    q["user_pair_stats"] = (_with(*CF_BASE, LABELED, CF_ROWS, USER_NEIGH, USER_STATS)
                            + """SELECT g.user_id, g.item_id, g.neighbour_id, g.r_vi, s.n, s.sx, s.sy, s.sxx, s.syy, s.sxy
FROM neigh g JOIN ust s ON s.user_id = g.user_id AND s.neighbour_id = g.neighbour_id""")
    q["user_cf"] = q["user_cf_stored"] = _with(*user_cf_ctes()) + _final("ucf")
    q["item_pair_stats"] = (_with(*CF_BASE, LABELED, CF_ROWS, ITEM_NEIGH, _item_stats("neigh"))
                            + """SELECT g.user_id, g.item_id, g.neighbour_item, g.r_uj, s.n, s.sx, s.sy, s.sxx, s.syy, s.sxy
FROM neigh g JOIN ist s ON s.item_id = g.item_id AND s.neighbour_item = g.neighbour_item""")
    q["item_cf"] = item_cf_sql("abs")
    q["item_cf_amplified"] = item_cf_sql("amplified")
    q["item_cf_lsh_filter"] = item_cf_sql("abs", candidates=True, mode="filter")
    q["item_cf_lsh_reweight"] = item_cf_sql("amplified", candidates=True, mode="reweight")
    q["rating_metrics_user_cf"] = (_with(*user_cf_ctes()) + ", pred AS (" + _final("ucf", rounded=False) + ")\n"
        + """SELECT CAST(count(*) AS BIGINT) AS n,
  CAST(sum(CASE WHEN p.prediction IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
  round(avg(pow(t.stars - p.prediction, 2)), 6) AS mse, round(sqrt(avg(pow(t.stars - p.prediction, 2))), 6) AS rmse
FROM test_pairs t LEFT JOIN pred p ON p.user_id = t.user_id AND p.item_id = t.item_id""")
    q["rating_metrics_duplicates"] = (_with(*user_cf_ctes()) + ", p AS (SELECT DISTINCT user_id, item_id, prediction"
        + " FROM (" + _final("ucf", rounded=False) + """) WHERE branch <> 'cold')
SELECT count(*) AS n, count(*) FILTER (prediction IS NULL) AS n_missing,
  round(avg(pow(stars - prediction, 2)), 6) AS mse, round(sqrt(avg(pow(stars - prediction, 2))), 6) AS rmse
FROM (SELECT user_id, item_id, max(stars) AS stars FROM test_pairs GROUP BY 1, 2)
LEFT JOIN p USING (user_id, item_id)""")
    q["ratings_text_parse"] = _with(RATINGS) + """SELECT '"u' || user_id AS user_id,
  'b' || item_id || '"' AS item_id, stars FROM ratings"""
    q["als_codes"] = _with(RATINGS, TRAIN) + """SELECT DISTINCT 'user' AS kind, user_id AS id,
  dense_rank() OVER (ORDER BY user_id) AS code FROM train
UNION ALL SELECT DISTINCT 'item', item_id, dense_rank() OVER (ORDER BY item_id) FROM train"""
    q["als_coverage"] = _with(*CF_BASE) + """SELECT user_id, item_id,
  user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train) AS predicted
FROM test_pairs"""
    covered = """ FROM test_pairs WHERE user_id IN (SELECT user_id FROM train)
  AND item_id IN (SELECT item_id FROM train)"""
    q["als_normal_equations"] = _with(RATINGS, TRAIN) + "SELECT DISTINCT user_id, true AS residual_ok FROM train"
    q["als_dot"] = _with(*CF_BASE) + "SELECT user_id, item_id, true AS same" + covered
    q["als_mse_dot"] = _with(*CF_BASE) + "SELECT count(*) AS n, 0::BIGINT AS n_missing, true AS same_mse" + covered
    codes = """SELECT item_id, (x - 1) // 65536 AS part, x FROM tb JOIN (
    SELECT member_id, row_number() OVER (ORDER BY member_id) AS x FROM (SELECT DISTINCT member_id FROM tb))
  USING (member_id)"""
    q["item_baskets_nested"] = (_with(RATINGS, TRAIN, TRAIN_BASKETS) + f"""SELECT item_id, part::BIGINT AS part,
  count(*) AS n_members, string_agg(x::VARCHAR, ',' ORDER BY x) AS members FROM ({codes}) GROUP BY 1, 2""")
    q["rating_maps"] = _with(RATINGS, TRAIN) + """SELECT user_id, ((x - 1) // 65536)::BIGINT AS part,
  string_agg(item_id || ':' || stars::BIGINT, ',' ORDER BY item_id) AS ratings
FROM (SELECT *, dense_rank() OVER (ORDER BY item_id) AS x FROM train) GROUP BY 1, 2"""
    q["candidate_adjacency"] = _with(RATINGS, TRAIN, TRAIN_BASKETS, *_candidates("tb", "cand"), """edges AS (
  SELECT item_1 AS item_id, item_2 AS other FROM cand UNION SELECT item_2, item_1 FROM cand)""") + """
SELECT item_id, ((x - 1) // 65536)::BIGINT AS part, count(*) AS n,
  string_agg(other::VARCHAR, ',' ORDER BY other) AS neighbours
FROM (SELECT *, dense_rank() OVER (ORDER BY other) AS x FROM edges) GROUP BY 1, 2"""
    q["item_jaccard_nested"] = _with(RATINGS, TRAIN, TRAIN_BASKETS, *_candidates("tb", "cand"),
                                     *_verified("tb", "cand", "found", 0.1)) + "SELECT * FROM found"
    q["similar_pairs_file"] = _with(DOC_WORDS, *_exact_pairs("doc_words", "ex")) + """
SELECT row_number() OVER (ORDER BY least(a, b), greatest(a, b)) AS place, least(a, b) AS item_1,
  greatest(a, b) AS item_2, round(similarity, 6) AS similarity, true AS read_back
FROM (SELECT item_1::VARCHAR AS a, item_2::VARCHAR AS b, similarity FROM ex)"""
    case = "SELECT '{}' AS case_id, user_id, item_id, prediction FROM ({})"
    q["predict_cases"] = (_with(*CF_BASE) + "SELECT '1' AS case_id, user_id, item_id, NULL::DOUBLE AS prediction"
                          + covered + "".join("\nUNION ALL " + case.format(k, sql) for k, sql in (
                              ("2", q["user_cf"]), ("3", q["item_cf"]), ("4", q["item_cf_lsh_filter"]))))
    return q
