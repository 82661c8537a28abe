"""Oracle SQL (DuckDB dialect) for the oracle-checked queries.

The SQL states each query's semantics in the most direct form (plain windows
over whole users, a users x list cross product for the baseline AUC) so it
checks the scalable Spark plans independently. Tables are the driver views.
"""

from __future__ import annotations

from quillon.sources.standins import (
    ACTIVE_THRESHOLD,
    PROFILE_ITEMS,
    PROFILE_USER,
    SEARCH_TERMS,
    WEATHER_TEST_YEAR,
    WEATHER_TRAIN_YEARS,
    WEATHER_VAL_YEAR,
)

PROFILE_TOP = 25


def _hash(salt: str, *keys: str) -> str:
    """The first 32 bits of md5('salt|key|...') as a number, stated here on its own."""
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5('{salt}|' || {text}), 1, 8) AS BIGINT)"


ROW_HASH = _hash("split", "row_a", "row_b")

RECO_CTES = f"""
ratings AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS item_raw, CAST(l.l_quantity AS BIGINT) AS plays,
         l.l_orderkey AS row_a, CAST(l.l_linenumber AS BIGINT) AS row_b
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
aliases AS (
  SELECT p.p_partkey AS alias_id, m.canonical_id
  FROM part p JOIN (SELECT p_name, p_brand, min(p_partkey) AS canonical_id
                    FROM part GROUP BY p_name, p_brand) m
    ON p.p_name = m.p_name AND p.p_brand = m.p_brand
),
resolved AS (
  SELECT r.user_id, COALESCE(a.canonical_id, r.item_raw) AS item_id, r.plays, r.row_a, r.row_b
  FROM ratings r LEFT JOIN aliases a ON r.item_raw = a.alias_id
),
user_rows AS (SELECT user_id, count(*) AS n_rows FROM resolved GROUP BY user_id),
active AS (
  SELECT r.* FROM resolved r JOIN user_rows u ON r.user_id = u.user_id WHERE u.n_rows >= {ACTIVE_THRESHOLD}
),
ranked AS (
  SELECT a.*, row_number() OVER (PARTITION BY user_id ORDER BY h, row_a, row_b, item_id, plays) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM (SELECT *, {ROW_HASH} AS h FROM active) a
),
split AS (
  SELECT user_id, item_id, plays, row_a, row_b, rn, n,
         CASE WHEN rn <= (4 * n) // 5 THEN 'train' ELSE 'test' END AS part
  FROM ranked
),
train AS (SELECT * FROM split WHERE part = 'train'),
test AS (SELECT * FROM split WHERE part = 'test'),
pop AS (SELECT item_id, count(*) AS n_train FROM train GROUP BY item_id),
top50 AS (
  SELECT CAST(row_number() OVER (ORDER BY n_train DESC, item_id) AS BIGINT) AS rank, item_id, n_train
  FROM pop ORDER BY n_train DESC, item_id LIMIT 50
),
acts AS (SELECT DISTINCT user_id, item_id FROM test)
"""


def _with(body: str) -> str:
    return f"WITH {RECO_CTES}\n{body}"


def recommender_sql() -> dict[str, str]:
    fold = f"CAST(floor(({_hash('fold', 'row_a', 'row_b')}) * 5 / 4294967296) AS INTEGER)"
    terms = ", ".join(f"('{t}')" for t in SEARCH_TERMS)
    profile = ", ".join(f"({item}, {plays})" for item, plays in PROFILE_ITEMS)
    return {
        "interactions_scan": """
            SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, CAST(l.l_quantity AS BIGINT) AS plays
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
        "alias_lines": """
            SELECT p.p_partkey AS alias_id, max(m.canonical_id) AS canonical_id
            FROM part p JOIN (SELECT p_name, p_brand, min(p_partkey) AS canonical_id
                              FROM part GROUP BY p_name, p_brand) m
              ON p.p_name = m.p_name AND p.p_brand = m.p_brand
            GROUP BY p.p_partkey""",
        "interactions_line_counts": """
            SELECT count(*) AS raw_lines,
                   count(*) FILTER (WHERE l_orderkey % 23 <> 0 AND (l_orderkey % 17 = 0) = (l_orderkey % 19 = 0)) AS parsed_rows,
                   count(*) FILTER (WHERE l_orderkey % 23 = 0 OR (l_orderkey % 17 = 0) <> (l_orderkey % 19 = 0)) AS dropped_rows
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
        "name_lines": "SELECT p_partkey AS item_id, trim(p_name) AS name FROM part",
        "alias_resolved_plays": _with("""
            SELECT item_id, count(*) AS n_ratings, CAST(sum(plays) AS BIGINT) AS total_plays
            FROM resolved GROUP BY item_id"""),
        "active_users": _with(f"""
            SELECT user_id, count(*) AS n_rows, count(DISTINCT item_id) AS n_items
            FROM resolved GROUP BY user_id HAVING count(*) >= {ACTIVE_THRESHOLD}"""),
        "active_ratings": _with("SELECT user_id, item_id, plays, row_a, row_b FROM active"),
        "user_split_counts": _with("""
            SELECT user_id, count(*) FILTER (WHERE part = 'train') AS n_train,
                   count(*) FILTER (WHERE part = 'test') AS n_test
            FROM split GROUP BY user_id"""),
        "user_split_rows": _with(
            "SELECT user_id, item_id, row_a, row_b, CAST(rn AS BIGINT) AS rn, part FROM split"),
        "fold_counts": _with(f"""
            SELECT {fold} AS fold, count(*) AS n_rows, count(DISTINCT user_id) AS n_users
            FROM train GROUP BY 1"""),
        "als_residual": _with("""
            SELECT user_id, count(*) FILTER (WHERE plays > 0) AS n_rated, CAST(0 AS DOUBLE) AS residual FROM train GROUP BY user_id"""),
        "als_profile_check": _with(f"""
            SELECT CAST({PROFILE_USER} AS BIGINT) AS user_id, count(*) FILTER (WHERE plays > 0) AS n_rated, CAST(0 AS DOUBLE) AS residual,
                   least({PROFILE_TOP}, (SELECT count(*) FROM (SELECT item_id FROM pop UNION SELECT item FROM (VALUES {profile}) v(item, plays)))) AS n_listed,
                   0 AS n_faults
            FROM (VALUES {profile}) p(item, plays)"""),
        "als_list_check": _with("""
            SELECT user_id, least(50, (SELECT count(*) FROM pop)) AS n_listed,
                   0 AS n_repeated, 0 AS n_disordered, 0 AS n_wrong_scores
            FROM test GROUP BY user_id"""),
        "popularity_top50": _with("SELECT rank, item_id, n_train FROM top50"),
        "events_split_counts": f"""
            WITH ev AS (
              SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
                     event_id AS row_a, CAST(0 AS BIGINT) AS row_b
              FROM events),
            r AS (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY h, row_a, row_b, item_id) AS rn,
                     count(*) OVER (PARTITION BY user_id) AS n
              FROM (SELECT *, {ROW_HASH} AS h FROM ev WHERE item_id IS NOT NULL) x)
            SELECT user_id, count(*) FILTER (WHERE rn <= (4 * n) // 5) AS n_train,
                   count(*) FILTER (WHERE rn > (4 * n) // 5) AS n_test,
                   count(DISTINCT CASE WHEN rn > (4 * n) // 5 THEN item_id END) AS test_items
            FROM r GROUP BY user_id""",
        "popularity_user_auc": _with("""
            , users AS (SELECT DISTINCT user_id FROM test)
            , lab AS (
              SELECT u.user_id, t.rank, CASE WHEN a.item_id IS NULL THEN 0 ELSE 1 END AS y
              FROM users u CROSS JOIN top50 t
              LEFT JOIN acts a ON a.user_id = u.user_id AND a.item_id = t.item_id)
            , walk AS (
              SELECT user_id, y, sum(y) OVER (PARTITION BY user_id ORDER BY rank
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ps
              FROM lab)
            , per AS (
              SELECT user_id, sum(CASE WHEN y = 0 THEN ps ELSE 0 END) AS num, sum(y) AS pos, count(*) AS len
              FROM walk GROUP BY user_id)
            SELECT user_id,
                   round(CASE WHEN pos = 0 OR pos = len THEN 0.5 ELSE num / (pos * (len - pos)) END, 6) AS auc
            FROM per"""),
        "popularity_mean_auc": _with("""
            , users AS (SELECT DISTINCT user_id FROM test)
            , lab AS (
              SELECT u.user_id, t.rank, CASE WHEN a.item_id IS NULL THEN 0 ELSE 1 END AS y
              FROM users u CROSS JOIN top50 t
              LEFT JOIN acts a ON a.user_id = u.user_id AND a.item_id = t.item_id)
            , walk AS (
              SELECT user_id, y, sum(y) OVER (PARTITION BY user_id ORDER BY rank
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ps
              FROM lab)
            , per AS (
              SELECT user_id, sum(CASE WHEN y = 0 THEN ps ELSE 0 END) AS num, sum(y) AS pos, count(*) AS len
              FROM walk GROUP BY user_id)
            SELECT count(*) AS users,
                   round(avg(CASE WHEN pos = 0 OR pos = len THEN 0.5 ELSE num / (pos * (len - pos)) END), 6)
                     AS mean_auc
            FROM per"""),
        "popularity_at_50": _with("""
            , items AS (SELECT count(DISTINCT item_id) AS n FROM train)
            , na AS (SELECT user_id, count(*) AS n_actual FROM acts GROUP BY user_id)
            , hits AS (SELECT a.user_id, count(*) AS hits FROM acts a JOIN top50 t ON a.item_id = t.item_id
                       GROUP BY a.user_id)
            , per AS (SELECT na.user_id, COALESCE(h.hits, 0) AS hits, na.n_actual
                      FROM na LEFT JOIN hits h ON na.user_id = h.user_id)
            , tot AS (SELECT count(*) AS users, sum(hits) AS tp, sum(50 - hits) AS fp,
                             sum(n_actual - hits) AS fn, sum(i.n - 50 - n_actual + hits) AS tn
                      FROM per CROSS JOIN items i)
            SELECT users, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
                   CAST(tn AS BIGINT) AS tn,
                   round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
                   round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
                   round(CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + fn + tn) END, 6)
                     AS accuracy
            FROM tot"""),
        "name_search": f"""
            WITH terms(term) AS (VALUES {terms}),
            hits AS (
              SELECT t.term, p.p_partkey AS item_id, p.p_name AS name,
                     row_number() OVER (PARTITION BY t.term ORDER BY p.p_partkey) AS pos
              FROM terms t JOIN part p ON contains(lower(p.p_name), lower(t.term)))
            SELECT term, CAST(pos AS BIGINT) AS pos, item_id, name FROM hits WHERE pos <= 3""",
    }




# ---------------------------------------------------------------- lists by a stated score (Job 3)

def rule_sql() -> dict[str, str]:
    base = f"""WITH {RECO_CTES},
        scored AS (SELECT user_id, item_id, CAST({_hash('score', 'user_id', 'item_id')} AS DOUBLE) / 4294967296 AS score
                   FROM (SELECT DISTINCT user_id, item_id FROM split)),
        lists AS (SELECT * FROM (SELECT user_id, item_id, score,
                    row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM scored) WHERE rank <= 10),
        rule AS (SELECT l.*, CASE WHEN a.item_id IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE AS label
                 FROM lists l LEFT JOIN acts a ON a.user_id = l.user_id AND a.item_id = l.item_id
                 WHERE l.user_id IN (SELECT user_id FROM acts))"""
    return {
        "rule_top10": f"{base} SELECT user_id, rank, item_id, round(score, 6) AS score FROM lists",
        "rule_unseen_top10": f"""{base},
            seen AS (SELECT DISTINCT user_id, item_id FROM train), popular AS (SELECT item_id, count(*) AS n FROM train GROUP BY item_id)
            SELECT user_id, rank, item_id FROM (
              SELECT u.user_id, p.item_id, row_number() OVER (PARTITION BY u.user_id ORDER BY p.n DESC, p.item_id) AS rank
              FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN popular p
              WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = p.item_id)) WHERE rank <= 10""",
        "rule_labels": f"{base} SELECT user_id, rank, item_id, label FROM rule",
        # of a user's pairs of a hit and a miss, the share with the hit in front
        "rule_user_auc": f"""{base}
            SELECT p.user_id, round(CASE WHEN pos = 0 OR neg = 0 THEN 0.5 ELSE coalesce(good, 0) / (pos * neg) END, 6) AS auc
            FROM (SELECT user_id, sum(label) AS pos, sum(1 - label) AS neg FROM rule GROUP BY user_id) p
            LEFT JOIN (SELECT h.user_id, count(*) AS good FROM rule h JOIN rule m ON h.user_id = m.user_id
                       WHERE h.label = 1 AND m.label = 0 AND h.rank < m.rank GROUP BY h.user_id) g ON g.user_id = p.user_id""",
        "rule_pooled_auc": f"""{base} {_curve_sql('score', 'label')}
            SELECT round(auc, 6) AS auc, round(aupr, 6) AS aupr, n_pos, n_neg FROM areas""",
        "rule_confusion": f"""{base},
            per AS (SELECT a.user_id, count(*) AS n_actual, count(l.item_id) AS hits
                    FROM acts a LEFT JOIN lists l ON l.user_id = a.user_id AND l.item_id = a.item_id GROUP BY a.user_id),
            tot AS (SELECT count(*) AS users, sum(hits)::BIGINT AS tp, sum(10 - hits)::BIGINT AS fp, sum(n_actual - hits)::BIGINT AS fn,
                           sum((SELECT count(DISTINCT item_id) FROM train) - 10 - n_actual + hits)::BIGINT AS tn FROM per)
            SELECT users, tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
                   round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM tot""",
        "rule_named": f"""{base}
            SELECT user_id, rank, item_id, coalesce(p_name, 'Unknown Artist') AS name
            FROM lists LEFT JOIN part ON p_partkey = item_id AND p_partkey % 7 <> 0 AND p_partkey % 11 <> 0""",
        "lookup_line_counts": """
            SELECT 'aliases' AS source, count(*) AS raw_lines,
                   count(*) FILTER (WHERE p_partkey % 13 <> 0 AND p_partkey % 17 <> 0) AS parsed_rows,
                   count(*) FILTER (WHERE p_partkey % 13 = 0 OR p_partkey % 17 = 0) AS dropped_rows FROM part
            UNION ALL
            SELECT 'names', count(*), count(*) FILTER (WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0),
                   count(*) FILTER (WHERE p_partkey % 7 = 0 OR p_partkey % 11 = 0) FROM part""",
    }


# ---------------------------------------------------------------- weather (Job 2)

def _weather_lines_sql() -> str:
    def lp(x: str, n: int) -> str:
        return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"

    return f"""
lines AS (
  SELECT concat('0000', '065900', '99999',
    {lp('year(l_shipdate)', 4)}, {lp('month(l_shipdate)', 2)}, {lp('day(l_shipdate)', 2)},
    {lp('l_orderkey % 24', 2)}, '00', '4',
    '+', {lp('l_partkey % 90000', 5)},
    '+', {lp('l_suppkey % 180000', 6)},
    'FM-12',
    '+', {lp('l_suppkey % 9000', 4)},
    'ABCDE', 'V020',
    CASE WHEN l_orderkey % 11 = 0 THEN '999' ELSE {lp('l_orderkey % 361', 3)} END, '1N',
    CASE WHEN l_partkey % 13 = 0 THEN '9999' ELSE {lp('l_partkey % 500', 4)} END, '1',
    {lp('CAST(l_quantity AS BIGINT) * 100', 5)}, '199',
    {lp('l_partkey * 7 % 160000', 6)}, '1N9',
    CASE WHEN l_linenumber = 7 THEN '+9999'
         ELSE concat(CASE WHEN month(l_shipdate) < 3 THEN '-' ELSE '+' END, {lp('l_partkey % 400', 4)}) END, '1',
    CASE WHEN l_orderkey % 17 = 0 THEN '+9999' ELSE concat('+', {lp('l_partkey % 300', 4)}) END, '1') AS value
  FROM lineitem
)"""


def _weather_parse_sql() -> str:
    from quillon.sources import fixedwidth as FW

    def tok(f) -> str:
        return f"trim(substring(value, {f.start + 1}, {f.end - f.start}))"

    cols = [
        f"CASE WHEN regexp_full_match({tok(f)}, '[+-]?[0-9]+') THEN TRY_CAST({tok(f)} AS INTEGER) END AS {f.name}"
        for f in FW.DATE_FIELDS
    ]
    for f in list(FW.OPTIONAL_FIELDS) + [FW.LABEL_FIELD]:
        codes = ", ".join(f"'{m}'" for m in f.missing)
        cols.append(
            f"CASE WHEN {tok(f)} IN ({codes}) THEN NULL "
            f"WHEN regexp_full_match({tok(f)}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({tok(f)} AS DOUBLE) / {f.scale} END AS {f.name}"
        )
    body = ",\n    ".join(cols)
    return f"""
parsed_all AS (
  SELECT length(value) AS len,
    {body}
  FROM lines
),
weather AS (
  SELECT * EXCLUDE (len) FROM parsed_all
  WHERE len >= {FW.MIN_LENGTH} AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
    AND hour IS NOT NULL AND air_temperature IS NOT NULL
),
wsplit AS (
  SELECT *, CASE WHEN year BETWEEN {WEATHER_TRAIN_YEARS[0]} AND {WEATHER_TRAIN_YEARS[1]} THEN 'train'
                 WHEN year = {WEATHER_VAL_YEAR} THEN 'validation'
                 WHEN year = {WEATHER_TEST_YEAR} THEN 'test' END AS part
  FROM weather
)"""


def weather_sql() -> dict[str, str]:
    from quillon.sources import fixedwidth as FW

    base = f"WITH {_weather_lines_sql()},{_weather_parse_sql()}"
    nullable = FW.NULLABLE_FEATURES
    med_cte = "meds AS (SELECT " + ", ".join(
        f"quantile_disc({c}, 0.5) AS m_{c}" for c in nullable) + " FROM wsplit WHERE part = 'train')"
    imputed_cte = ("imp AS (SELECT w.*, " + ", ".join(
        f"COALESCE(w.{c}, m.m_{c}) AS {c}_imputed" for c in nullable) + " FROM wsplit w CROSS JOIN meds m)")
    with_imp = f"{base},\n{med_cte},\n{imputed_cte}"
    feats = [(c, c) for c in FW.BASE_FEATURES] + [(c, f"{c}_imputed") for c in nullable]

    def r_expr(col: str) -> str:
        y = FW.LABEL
        return (f"CASE WHEN stddev_pop({col}) * stddev_pop({y}) = 0 THEN NULL "
                f"ELSE covar_pop({col}, {y}) / (stddev_pop({col}) * stddev_pop({y})) END")

    corr_union = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {i} AS pos, {r_expr(col)} AS r FROM imp" for i, (name, col) in enumerate(feats))
    x, y = "dew_point_temperature_imputed", FW.LABEL
    r6 = lambda c: f"round({c}, 6) AS {c}"
    return {
        "weather_counts": f"""WITH {_weather_lines_sql()},{_weather_parse_sql()}
            SELECT count(*) AS raw_lines,
                   count(*) FILTER (WHERE len >= {FW.MIN_LENGTH} AND year IS NOT NULL AND month IS NOT NULL
                        AND day IS NOT NULL AND hour IS NOT NULL AND air_temperature IS NOT NULL) AS parsed_rows,
                   count(*) FILTER (WHERE NOT (len >= {FW.MIN_LENGTH} AND year IS NOT NULL AND month IS NOT NULL
                        AND day IS NOT NULL AND hour IS NOT NULL AND air_temperature IS NOT NULL)) AS dropped_rows
            FROM parsed_all""",
        "weather_parse": f"""{base}
            SELECT {', '.join(FW.BASE_FEATURES)}, {', '.join(r6(c) for c in nullable + [FW.LABEL])}
            FROM weather""",
        "weather_year_bounds": f"{base} SELECT min(year) AS min_year, max(year) AS max_year FROM weather",
        "weather_split_counts": f"{base} SELECT part, count(*) AS n FROM wsplit WHERE part IS NOT NULL GROUP BY part",
        "weather_medians": f"""{with_imp}
            """ .rstrip() + " " + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST(m_{c} AS DOUBLE) AS median FROM meds" for c in nullable),
        "weather_imputed": f"""{with_imp}
            SELECT {', '.join(FW.BASE_FEATURES)}, {r6(FW.LABEL)},
                   {', '.join(r6(c + '_imputed') for c in nullable)}, part
            FROM imp""",
        "weather_correlation": f"""{with_imp}, corr AS ({corr_union})
            SELECT feature, pos, round(r, 6) AS r FROM corr""",
        "best_correlation": f"""{with_imp}, corr AS ({corr_union})
            SELECT feature, round(r, 6) AS r FROM corr WHERE r IS NOT NULL AND NOT isnan(r)
            ORDER BY abs(r) DESC, pos LIMIT 1""",
        "weather_ols_mse": f"""{with_imp},
            fit AS (SELECT regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a FROM imp WHERE part = 'train')
            SELECT part, count(*) AS n, round(avg(({y} - (a + b * {x})) * ({y} - (a + b * {x}))), 6) AS mse
            FROM imp CROSS JOIN fit WHERE part IS NOT NULL GROUP BY part""",
        "best_one_feature": f"""{with_imp} """ + " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{c}' AS feature, round(avg(({FW.LABEL} - (a + b * {c}_imputed)) ** 2), 6) AS mse
                FROM imp CROSS JOIN (SELECT regr_slope({FW.LABEL}, {c}_imputed) AS b, regr_intercept({FW.LABEL}, {c}_imputed) AS a
                                     FROM imp WHERE part = 'train') WHERE part = 'test')"""
            for c in nullable) + " ORDER BY mse LIMIT 1",
        "weather_rf_routing": f"{base} SELECT count(*) AS test_rows, 0 AS mismatches FROM wsplit WHERE part = 'test'",
        "weather_lr_conditions": base + " UNION ALL ".join(
            f" SELECT '{c}' AS feature, count(*) AS n, CAST(0 AS DOUBLE) AS gap FROM wsplit WHERE part = 'train'" for c in ["intercept", *[f for _, f in feats]]),
        "weather_ridge_coef": f"""{with_imp},
            fit AS (SELECT covar_pop({x}, {y}) / (var_pop({x}) * (1 + 0.001 / stddev_pop({y}))) AS b,
                           avg({x}) AS mx, avg({y}) AS my FROM imp WHERE part = 'train')
            SELECT round(b, 6) AS coefficient, round(my - b * mx, 6) AS intercept FROM fit""",
    }


# ---------------------------------------------------------------- survey (Job 1)

SURVEY_CTES = f"""
survey AS (
  SELECT l.l_orderkey AS row_a, CAST(l.l_linenumber AS BIGINT) AS row_b,
         l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, o.o_orderstatus, c.c_mktsegment,
         CASE WHEN l.l_linenumber = 7 THEN NULL
              WHEN ((l.l_orderkey % 13) + 13) % 13 = 0 THEN 'Maybe'
              WHEN l.l_quantity * l.l_discount > CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 1.6 END THEN 'Yes'
              ELSE 'No' END AS label_yn,
         CASE WHEN l.l_linenumber = 6 AND l.l_orderkey % 5 = 0 THEN NULL ELSE
           CAST(CAST(floor((l.l_quantity - 1) / 10) + floor(round(l.l_discount * 100) / 4)
             + {_hash('noise', 'l.l_orderkey', 'l.l_linenumber')} % 7 AS INTEGER) AS VARCHAR) END AS band
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
),
clean AS (SELECT * FROM survey WHERE label_yn IN ('Yes', 'No')),
sp AS (SELECT *, ({ROW_HASH}) * 5 < 4 * 4294967296 AS is_train FROM clean),
strain AS (SELECT * FROM sp WHERE is_train),
stest AS (SELECT * FROM sp WHERE NOT is_train),
levels AS (
  SELECT "column", level, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) - 1 AS BIGINT) AS idx, n
  FROM (SELECT "column", level, count(*) AS n FROM (
          SELECT 'l_returnflag' AS "column", l_returnflag AS level FROM strain
          UNION ALL SELECT 'l_linestatus', l_linestatus FROM strain
          UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM strain
          UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM strain
          UNION ALL SELECT 'label_yn', label_yn FROM strain
          UNION ALL SELECT 'band', band FROM strain) u
        WHERE level IS NOT NULL GROUP BY "column", level) g
),
rule AS (
  SELECT CASE WHEN label_yn = 'Yes' THEN 1.0 ELSE 0.0 END AS label,
         CASE WHEN l_quantity * l_discount > 1.3 THEN 1.0 ELSE 0.0 END AS prediction,
         l_quantity * l_discount AS score,
         CAST(band AS DOUBLE) AS band,
         CAST(floor((l_quantity - 1) / 10) + 4 AS DOUBLE) AS band_prediction
  FROM stest
)
"""


def _curve_sql(score: str, label: str) -> str:
    """CTEs g, t, c, areas for exact ROC / PR areas of (score, label) in ``rule``."""
    return f"""
, g AS (SELECT {score} AS score, sum(CASE WHEN {label} > 0.5 THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN {label} > 0.5 THEN 0 ELSE 1 END) AS neg FROM rule GROUP BY {score})
, t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g)
, c AS (SELECT g.*, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM g)
, areas AS (
  SELECT sum(pos * ((t.N - fp) + 0.5 * neg)) / (t.P * t.N) AS auc,
         sum(pos / t.P * (tp / (tp + fp)
             + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp)
                    ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) AS aupr,
         CAST(t.P AS BIGINT) AS n_pos, CAST(t.N AS BIGINT) AS n_neg
  FROM c CROSS JOIN t GROUP BY t.P, t.N)"""


def _multiclass_sql(pred: str, label: str) -> str:
    return f"""
, cells AS (SELECT {label} AS y, {pred} AS p, count(*) AS c FROM rule WHERE {label} IS NOT NULL GROUP BY 1, 2)
, act AS (SELECT y, sum(c) AS n_actual, sum(CASE WHEN y = p THEN c ELSE 0 END) AS tp FROM cells GROUP BY y)
, prd AS (SELECT p AS y, sum(c) AS n_predicted FROM cells GROUP BY p)
, per AS (SELECT a.y AS label, a.tp, a.n_actual, COALESCE(pr.n_predicted, 0) AS n_predicted,
                 CASE WHEN COALESCE(pr.n_predicted, 0) = 0 THEN 0.0 ELSE a.tp / pr.n_predicted END AS precision,
                 CASE WHEN a.n_actual = 0 THEN 0.0 ELSE a.tp / a.n_actual END AS recall
          FROM act a LEFT JOIN prd pr ON a.y = pr.y)
, overall AS (SELECT sum(tp) / sum(n_actual) AS accuracy,
                     sum(precision * n_actual) / sum(n_actual) AS weighted_precision,
                     sum(recall * n_actual) / sum(n_actual) AS weighted_recall FROM per)"""


def survey_sql() -> dict[str, str]:
    base = f"WITH {SURVEY_CTES}"
    cats = ["l_returnflag", "l_linestatus", "o_orderstatus", "c_mktsegment"]
    joins = " ".join(
        f"JOIN levels v{i} ON v{i}.\"column\" = '{c}' AND v{i}.level = s.{c}" for i, c in enumerate(cats))
    fcols = ", ".join(f"CAST(v{i}.idx AS DOUBLE) AS f{4 + i}" for i in range(len(cats)))
    return {
        "survey_filtered": f"""{base}
            SELECT row_a, row_b, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                   o_orderstatus, c_mktsegment, label_yn, band FROM clean""",
        "hash_split_counts": f"""{base}
            SELECT CASE WHEN is_train THEN 'train' ELSE 'test' END AS part, count(*) AS n,
                   count(*) FILTER (WHERE label_yn = 'Yes') AS n_yes
            FROM sp GROUP BY 1""",
        "stump_rows": f"""{base}, tr AS (
              SELECT s.*, vl.idx AS y FROM strain s JOIN levels vl ON vl."column" = 'label_yn' AND vl.level = s.label_yn
            ), cells AS (
              SELECT feature, v, count(*) AS n, sum(y) AS n1 FROM (
                SELECT 'l_quantity' AS feature, l_quantity AS v, y FROM tr
                UNION ALL SELECT 'l_discount', l_discount, y FROM tr
                UNION ALL SELECT 'l_tax', l_tax, y FROM tr) GROUP BY feature, v
            ), cuts AS (
              SELECT feature, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS ln, sum(n1) OVER w AS l1,
                     sum(n) OVER (PARTITION BY feature) AS n, sum(n1) OVER (PARTITION BY feature) AS n1
              FROM cells WINDOW w AS (PARTITION BY feature ORDER BY v)
            ), best AS (
              SELECT *, (2 * l1 > ln) = (2 * (n1 - l1) > n - ln) AS pruned FROM cuts WHERE threshold IS NOT NULL
              ORDER BY l1 * (ln - l1) / ln + (n1 - l1) * (n - ln - n1 + l1) / (n - ln) LIMIT 1
            )
            SELECT CAST(0 AS BIGINT) AS node, CASE WHEN NOT pruned THEN feature END AS feature,
                   CASE WHEN NOT pruned THEN round(threshold, 4) END AS threshold, CAST(n AS BIGINT) AS n,
                   CASE WHEN pruned THEN CAST(n AS BIGINT) END AS n_routed, CASE WHEN pruned THEN CAST(n1 AS BIGINT) END AS n_label_1 FROM best
            UNION ALL SELECT 1, NULL, NULL, CAST(ln AS BIGINT), CAST(ln AS BIGINT), CAST(l1 AS BIGINT) FROM best WHERE NOT pruned
            UNION ALL SELECT 2, NULL, NULL, CAST(n - ln AS BIGINT), CAST(n - ln AS BIGINT), CAST(n1 - l1 AS BIGINT) FROM best WHERE NOT pruned""",
        "tree_routing": f"""{base}
            SELECT (SELECT count(*) FROM stest) AS test_rows, 0 AS mismatches, (SELECT count(*) FROM strain) AS train_rows""",
        "forest_routing": f"""{base}
            SELECT count(*) AS test_rows, 0 AS mismatches, 10 AS trees FROM stest WHERE band IS NOT NULL""",
        "boosted_routing": f"""{base}
            SELECT count(*) AS test_rows, 0 AS mismatches,
                   3 * (SELECT count(DISTINCT band) FROM strain) AS trees FROM stest WHERE band IS NOT NULL""",
        "model_roundtrip": f"""{base}
            SELECT count(*) AS test_rows, 0 AS mismatches, 4 AS stages FROM stest""",
        "fold_balance": f"""{base}
            SELECT CAST(floor({_hash('fold', 'row_a', 'row_b')} * 5 / 4294967296) AS INTEGER) AS fold, row_b AS line_number,
                   count(*) AS n FROM strain GROUP BY ALL""",
        "holdout_balance": f"""{base}
            SELECT row_b AS line_number, count(*) AS n,
                   count(*) FILTER (WHERE {_hash('holdout', 'row_a', 'row_b')} * 5 >= 4 * 4294967296) AS n_holdout
            FROM strain GROUP BY 1""",
        "sorted_labels": f"""{base}
            SELECT CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS pos, label
            FROM (SELECT DISTINCT CAST(band AS INTEGER) AS label FROM clean WHERE band IS NOT NULL)""",
        "band_counts": f"""{base}
            SELECT band, count(*) FILTER (WHERE is_train) AS n_train, count(*) FILTER (WHERE NOT is_train) AS n_test
            FROM sp WHERE band IS NOT NULL GROUP BY band""",
        "string_index_levels": f"{base} SELECT \"column\", level, idx, n FROM levels",
        "feature_matrix": f"""{base}
            SELECT s.row_a, s.row_b, CAST(vl.idx AS DOUBLE) AS label,
                   s.l_quantity AS f0, s.l_extendedprice AS f1, s.l_discount AS f2, s.l_tax AS f3, {fcols}
            FROM strain s {joins}
            JOIN levels vl ON vl.\"column\" = 'label_yn' AND vl.level = s.label_yn""",
        "binary_report": f"""{base} {_multiclass_sql('prediction', 'label')} {_curve_sql('prediction', 'label')}
            SELECT 'precision_' || CAST(CAST(label AS INTEGER) AS VARCHAR) AS metric, round(precision, 6) AS value FROM per
            UNION ALL SELECT 'recall_' || CAST(CAST(label AS INTEGER) AS VARCHAR), round(recall, 6) FROM per
            UNION ALL SELECT 'accuracy', round(accuracy, 6) FROM overall
            UNION ALL SELECT 'area_under_roc', round(auc, 6) FROM areas
            UNION ALL SELECT 'area_under_pr', round(aupr, 6) FROM areas""",
        "multiclass_report": f"""{base} {_multiclass_sql('band_prediction', 'band')}
            SELECT 'precision' AS metric, label, round(precision, 6) AS value FROM per
            UNION ALL SELECT 'recall', label, round(recall, 6) FROM per
            UNION ALL SELECT 'accuracy', CAST(NULL AS DOUBLE), round(accuracy, 6) FROM overall
            UNION ALL SELECT 'weighted_precision', CAST(NULL AS DOUBLE), round(weighted_precision, 6) FROM overall
            UNION ALL SELECT 'weighted_recall', CAST(NULL AS DOUBLE), round(weighted_recall, 6) FROM overall""",
        "auc_exact": f"""{base} {_curve_sql('score', 'label')}
            SELECT round(auc, 6) AS auc, round(aupr, 6) AS aupr, n_pos, n_neg FROM areas""",
    }


# ---------------------------------------------------------------- intake and reports

def intake_sql(weather_counts: str) -> dict[str, str]:
    kind = """CASE WHEN l_orderkey % 23 = 0 THEN 'short' WHEN l_orderkey % 29 = 0 THEN 'long'
                   WHEN l_orderkey % 31 = 0 THEN 'no number' ELSE 'kept' END"""
    runs = " UNION ALL ".join(
        f"SELECT '{run}' AS run_id, '{metric}' AS metric, {value}::BIGINT AS value FROM lineitem WHERE {rule}"
        for run, rule in (("all", "true"), ("large", "l_quantity > 25"))
        for metric, value in (("lines", "count(*)"), ("orders", "count(DISTINCT l_orderkey)")))
    return {
        "weather_files": f"SELECT (SELECT count(DISTINCT year(l_shipdate)) FROM lineitem) AS n_files, w.* FROM ({weather_counts}) w",
        "csv_quarantine": f"""SELECT kind, count(*) AS n, sum(CASE WHEN kind = 'kept' THEN l_quantity::DOUBLE END) AS quantity
            FROM (SELECT {kind} AS kind, l_quantity FROM lineitem) GROUP BY kind""",
        "filed_metrics": runs,
    }


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(recommender_sql())
    out.update(rule_sql())
    out.update(weather_sql())
    out.update(survey_sql())
    out.update(intake_sql(out["weather_counts"]))
    return out
