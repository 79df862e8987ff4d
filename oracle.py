"""SQL counterparts of the registered queries, written for DuckDB.

``round(x, 4) + 0.0`` turns a negative zero into zero, as Spark's round does.
"""

from __future__ import annotations

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ROW_KEY = f"{KEYS}, l_extendedprice"
COLUMNS = f"{KEYS}, {', '.join(FEATURES)}"
PRICE_TIER = """CASE WHEN l_extendedprice < 20000 THEN 'low'
    WHEN l_extendedprice <= 70000 THEN 'medium' ELSE 'high' END AS price_tier"""

RAW_CENTERS = """c(cluster, c0, c1, c2, c3) AS (
  SELECT a, CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE), CAST(e AS DOUBLE)
  FROM (VALUES (0, 10, 15000, 0.05, 0.04), (1, 20, 30000, 0.05, 0.04),
    (2, 30, 45000, 0.05, 0.04), (3, 40, 60000, 0.05, 0.04), (4, 45, 80000, 0.05, 0.04)
  ) AS t(a, b, c, d, e))"""
SCALED_CENTERS = """c(cluster, c0, c1, c2, c3) AS (
  SELECT a, CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE), CAST(e AS DOUBLE)
  FROM (VALUES (0, -1, -1, 0.5, 0), (1, -1, 1, 0, 0.5), (2, 1, -1, -0.5, 0),
    (3, 1, 1, 0, -0.5), (4, 0, 0, 0, 0)) AS t(a, b, c, d, e))"""


def _nearest(base: str, columns: tuple[str, ...], centers: str) -> str:
    """CTEs up to ``labelled``: the rows of base with number rid and nearest centre."""
    terms = " + ".join(f"({x} - c{i}) * ({x} - c{i})" for i, x in enumerate(columns))
    return f"""{centers},
numbered AS (SELECT *, row_number() OVER () AS rid FROM {base}),
distances AS (SELECT rid, cluster, {terms} AS d FROM numbered, c),
ranked AS (SELECT rid, cluster, d,
  row_number() OVER (PARTITION BY rid ORDER BY d, cluster) AS place FROM distances),
labelled AS (SELECT n.*, r.cluster AS prediction, r.d
  FROM numbered n JOIN ranked r ON n.rid = r.rid AND r.place = 1)"""


def _keyed(k: int, rounds: int) -> str:
    """Seeds by a hash of the key, then Lloyd rounds with sums of multiples of 2**-20."""
    named = ", ".join(f"{x} AS c{i}" for i, x in enumerate(FEATURES))
    terms = " + ".join(f"({x} - c{i}) * ({x} - c{i})" for i, x in enumerate(FEATURES))
    means = ", ".join(
        f"CAST(sum(CAST(floor({x} * 1048576.0::DOUBLE + 0.5::DOUBLE) AS HUGEINT)) AS DOUBLE) / (count(*) * 1048576.0::DOUBLE) AS c{i}"
        for i, x in enumerate(FEATURES)
    )
    parts = [
        f"""WITH numbered AS (SELECT *, row_number() OVER () AS rid FROM lineitem),
drawn AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('/', {KEYS})), {", ".join(FEATURES)}) - 1 AS cluster
  FROM numbered),
m0 AS (SELECT cluster, {named} FROM drawn WHERE cluster < {k})"""
    ]
    for r in range(1, rounds + 1):
        parts.append(f"""d{r} AS (SELECT rid, cluster, row_number() OVER (PARTITION BY rid ORDER BY {terms}, cluster) AS place
  FROM numbered, m{r - 1}),
m{r} AS (SELECT cluster, count(*) AS n, {means}
  FROM numbered JOIN d{r} USING (rid) WHERE place = 1 GROUP BY cluster)""")
    rounded = ", ".join(f"round(c{i}, 4) + 0.0 AS {x}" for i, x in enumerate(FEATURES))
    return ",\n".join(parts) + f"\nSELECT CAST(cluster AS INT) AS cluster, n AS cluster_size, {rounded} FROM m{rounds}"


_SCALED_NAMES = tuple(f"{c}_scaled" for c in FEATURES)
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in FEATURES)
SCALED = f"""moments AS (SELECT {_MOMENTS} FROM lineitem),
z AS (SELECT {COLUMNS}, {", ".join(
    f"CASE WHEN s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END AS {c}_scaled" for c in FEATURES
)} FROM lineitem, moments)"""
_ROUNDED_SCALED = ", ".join(f"round({c}, 4) + 0.0 AS {c}" for c in _SCALED_NAMES)
_RAW_LABELLED = "WITH " + _nearest("lineitem", FEATURES, RAW_CENTERS)
_SCALED_LABELLED = f"WITH {SCALED},\n" + _nearest("z", _SCALED_NAMES, SCALED_CENTERS)

_NORM = " + ".join(f"{c} * {c}" for c in _SCALED_NAMES)
_DOT = " + ".join(f"l.{c} * m.y_{c}" for c in _SCALED_NAMES)
SILHOUETTE = f"""{_SCALED_LABELLED},
m AS (SELECT prediction, count(*) AS n, sum({_NORM}) AS q,
  {", ".join(f"sum({c}) AS y_{c}" for c in _SCALED_NAMES)} FROM labelled GROUP BY prediction),
pairs AS (SELECT l.rid, l.prediction AS own, m.prediction AS other, m.n,
  ({" + ".join(f"l.{c} * l.{c}" for c in _SCALED_NAMES)}) + m.q / m.n - 2 * ({_DOT}) / m.n AS d
  FROM labelled l, m),
ab AS (SELECT rid, max(CASE WHEN own = other THEN n END) AS n,
  max(CASE WHEN own = other THEN d * n / greatest(n - 1, 1) END) AS a,
  min(CASE WHEN own <> other THEN d END) AS b FROM pairs GROUP BY rid)
SELECT round(avg(CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
  ELSE 0 END), 4) AS silhouette FROM ab"""

SILHOUETTE_WIDE = SILHOUETTE.replace(
    _SCALED_LABELLED,
    f"WITH {SCALED},\nlabelled AS (SELECT *, row_number() OVER () AS rid, l_suppkey % 20 AS prediction FROM z)",
)

_WHOLE = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in FEATURES)

# lineitem with nulls, NaN and negative values in the features.
GAPS = """lineitem AS (SELECT * REPLACE (nullif(l_discount, 0) AS l_discount,
  CASE WHEN l_tax = 0.01::DOUBLE THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax,
  CASE WHEN l_quantity = 13 THEN -13 ELSE l_quantity END AS l_quantity) FROM main.lineitem)"""

_FIXED = f"""FROM lineitem WHERE {" AND ".join(
    f"{c} IS NOT NULL AND NOT isnan({c}) AND {c} >= 0" for c in FEATURES
)} AND l_quantity < 50 AND l_extendedprice < 100000 AND l_discount < 0.1::DOUBLE
  AND l_tax < 0.08::DOUBLE"""


def _band(source: str, lower: str, upper: str) -> str:
    """CTE ``band`` with two bounds per feature over the source."""
    ends = ", ".join(
        f"{lower.format(c)} AS lo_{c}, {upper.format(c)} AS hi_{c}" for c in FEATURES
    )
    return f"band AS (SELECT {ends} FROM {source})"


_DISC = ("quantile_disc({0}, 0.01)", "quantile_disc({0}, 0.99)")
_ENDS = ("min({0})", "max({0})")
_IN_BAND = " AND ".join(f"{c} >= lo_{c} AND {c} <= hi_{c}" for c in FEATURES)


def _chain(ends: tuple[str, str], limit: bool) -> str:
    last = f"ORDER BY {ROW_KEY} LIMIT 1000" if limit else ""
    return f"""WITH {GAPS}, fixed AS (SELECT {COLUMNS} {_FIXED}),
{_band("fixed", *ends)},
kept AS (SELECT {COLUMNS} FROM fixed, band WHERE {_IN_BAND} {last})
SELECT {COLUMNS}, {PRICE_TIER} FROM kept"""


def _bounds(ends: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {ends[0].format(c)} + 0.0 AS lower, "
        f"{ends[1].format(c)} + 0.0 AS upper FROM lineitem"
        for c in FEATURES
    )


_NUMBERED = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY {ROW_KEY}) - 1 AS id,
  {PRICE_TIER} FROM lineitem)"""
_VECTOR = ", ".join(f"{c} AS v{i}" for i, c in enumerate(FEATURES))
_PARTS_BY_NAME = """parts AS (SELECT *, row_number() OVER (ORDER BY p_name, p_partkey) - 1 AS id
  FROM part)"""
_UPSERTED = """SELECT p_partkey AS id, p_name, CAST(p_size AS DOUBLE) AS p_size,
  CASE WHEN p_size >= 20 THEN p_retailprice * 2 ELSE p_retailprice END AS p_retailprice FROM part"""

ORACLE = {
    "select_features": f"SELECT {', '.join(FEATURES)} FROM lineitem",
    "drop_missing": f"""WITH gaps AS (SELECT {ROW_KEY},
  nullif(l_discount, 0) AS l_discount,
  CASE WHEN l_tax = 0.01::DOUBLE THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax FROM lineitem)
SELECT * FROM gaps WHERE l_discount IS NOT NULL AND NOT isnan(l_discount)
  AND l_tax IS NOT NULL AND NOT isnan(l_tax)""",
    "non_negative": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0",
    "upper_bounds": f"""SELECT {COLUMNS} FROM lineitem WHERE l_quantity < 50
  AND l_extendedprice < 100000 AND l_discount < 0.1::DOUBLE AND l_tax < 0.08::DOUBLE""",
    "quantile_bounds_default": _bounds(_ENDS),
    "quantile_bounds_exact": _bounds(_DISC),
    "quantile_rank_error": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{end}' AS bound, count(*) AS n_rows, "
        "true AS within_error FROM lineitem"
        for c in FEATURES
        for end in ("lower", "upper")
    ),
    "quantile_band_default": f"""WITH {_band("lineitem", *_ENDS)}
SELECT {COLUMNS} FROM lineitem, band WHERE {_IN_BAND}""",
    "quantile_band_exact": f"""WITH {_band("lineitem", *_DISC)}
SELECT {COLUMNS} FROM lineitem, band WHERE {_IN_BAND}""",
    "limit_keyed": f"SELECT {COLUMNS} FROM lineitem ORDER BY {ROW_KEY} LIMIT 1000",
    "tier_bucket": """SELECT event_id, value, CASE WHEN value < 150 THEN 'low'
  WHEN value <= 350 THEN 'medium' ELSE 'high' END AS tier FROM events""",
    "tier_counts": """SELECT CASE WHEN value < 150 THEN 'low'
  WHEN value <= 350 THEN 'medium' ELSE 'high' END AS tier, count(*) AS cluster_size
FROM events GROUP BY 1""",
    "preprocess_chain": _chain(_DISC, True),
    "preprocess_chain_whole": _chain(_DISC, False),
    "preprocess_chain_default_band": _chain(_ENDS, False),
    "stage_funnel": f"""WITH {GAPS}, fixed AS (SELECT {COLUMNS} {_FIXED}),
{_band("fixed", *_DISC)},
whole AS (FROM lineitem WHERE {_WHOLE})
SELECT count(*) AS input_rows, (SELECT count(*) FROM whole) AS after_missing,
  (SELECT count(*) FROM whole WHERE {" AND ".join(f"{c} >= 0" for c in FEATURES)})
    AS after_non_negative,
  (SELECT count(*) FROM fixed) AS after_upper_bounds,
  (SELECT count(*) FROM fixed, band WHERE {_IN_BAND}) AS after_band
FROM lineitem""",
    "csv_scan": """SELECT p_partkey, p_name, p_retailprice,
  CASE WHEN p_size > 40 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS p_size FROM part""",
    "csv_feature_load": """SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice, p_name
FROM part WHERE p_size <= 40""",
    "safe_cast": """SELECT p_partkey, TRY_CAST(CASE WHEN p_size <= 10 THEN p_name
  WHEN p_size <= 20 THEN ' ' || p_size || ' ' WHEN p_size <= 35 THEN p_size || 'e1'
  ELSE '' END AS DOUBLE) AS number
FROM part""",
    "payload_schema": "SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part",
    "parquet_round_trip": "SELECT * FROM part",
    "assemble": f"SELECT {ROW_KEY}, {_VECTOR} FROM lineitem",
    "assemble_array": f"SELECT {ROW_KEY}, {_VECTOR} FROM lineitem",
    "scaler_stats": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg({c}), 4) + 0.0 AS mean, "
        f"round(stddev_samp({c}), 4) AS std FROM lineitem"
        for c in FEATURES
    ),
    "standardise": f"WITH {SCALED} SELECT {ROW_KEY}, {_ROUNDED_SCALED} FROM z",
    "feature_build": f"WITH {SCALED} SELECT {ROW_KEY}, {_ROUNDED_SCALED} FROM z",
    "constant_column": f"""SELECT {ROW_KEY}, 0.0::DOUBLE AS by_model, 0.0::DOUBLE AS by_column,
  CASE WHEN l_linenumber > 1 THEN 0.0::DOUBLE END AS with_missing FROM lineitem""",
    "assign_missing": f"""WITH {GAPS}, whole AS (SELECT * FROM lineitem
  WHERE {_WHOLE}),
{_nearest("whole", FEATURES, RAW_CENTERS)}
SELECT {ROW_KEY}, prediction AS few_terms, prediction AS many_terms FROM labelled
UNION ALL SELECT {ROW_KEY}, NULL, NULL FROM lineitem
WHERE NOT ({_WHOLE})""",
    "silhouette_wide": SILHOUETTE_WIDE,
    "kmeans_fit": """SELECT CAST(5 AS BIGINT) AS n_centers, count(*) AS n_rows,
  count(*) AS rows_within FROM lineitem""",
    "kmeans_embeddings": """SELECT CAST(10 AS BIGINT) AS n_centers, count(*) AS n_rows,
  count(*) AS rows_within FROM embeddings""",
    "assign_fixed_centers": f"{_RAW_LABELLED} SELECT {ROW_KEY}, prediction FROM labelled",
    "assign_scaled_centers": f"{_SCALED_LABELLED} SELECT {ROW_KEY}, prediction FROM labelled",
    # Distance to the unit point of axis i is |x|^2 + 1 - 2 x_i.
    "assign_embeddings": """SELECT vec_id, CASE
  WHEN embedding[1] >= embedding[2] AND embedding[1] >= embedding[3] THEN 0
  WHEN embedding[2] >= embedding[3] THEN 1 ELSE 2 END AS prediction FROM embeddings""",
    "result_projection": f"{_RAW_LABELLED} SELECT {COLUMNS}, prediction FROM labelled",
    "cluster_sizes": f"""{_RAW_LABELLED}
SELECT prediction, count(*) AS cluster_size FROM labelled GROUP BY prediction""",
    "centers_of": f"""{_RAW_LABELLED} SELECT prediction, {", ".join(
        f"round(avg({c}), 4) AS {c}" for c in FEATURES
    )} FROM labelled GROUP BY prediction""",
    "lloyd_step": f"""{_SCALED_LABELLED}
SELECT prediction AS cluster, count(*) AS cluster_size, {", ".join(
        f"round(avg({c}), 4) + 0.0 AS {c}" for c in _SCALED_NAMES
    )} FROM labelled GROUP BY prediction""",
    "kmeans_keyed": _keyed(5, 4),
    "within_cluster_cost": f"{_SCALED_LABELLED} SELECT round(sum(d), 3) AS cost FROM labelled",
    "silhouette_fixed": SILHOUETTE,
    "silhouette_by_metric": SILHOUETTE,
    "kmeans_invariants": """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS off_nearest,
  CAST(0 AS BIGINT) AS off_range, true AS labels_used,
  true AS better_than_one_cluster, true AS score_in_range FROM lineitem""",
    "kmeans_embeddings_invariants": """SELECT count(*) AS n_rows,
  CAST(0 AS BIGINT) AS off_nearest, CAST(0 AS BIGINT) AS off_range,
  true AS labels_used, true AS better_than_one_cluster,
  true AS score_in_range FROM embeddings""",
    "model_round_trip": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS changed FROM lineitem",
    "point_ids": f"WITH {_PARTS_BY_NAME} SELECT id, p_partkey, p_name FROM parts",
    "point_ids_lineitem": f"WITH {_NUMBERED} SELECT id, {ROW_KEY} FROM numbered",
    "points": f"""WITH {_NUMBERED}
SELECT id, {_VECTOR}, {", ".join(FEATURES)}, price_tier FROM numbered""",
    "clustered_points": f"""WITH {_NUMBERED.replace("numbered", "placed")},
{_nearest("placed", FEATURES, RAW_CENTERS)}
SELECT id, {_VECTOR}, {", ".join(FEATURES)}, price_tier, prediction AS cluster FROM labelled""",
    "scroll_page": f"""WITH {_PARTS_BY_NAME} SELECT id, p_partkey, p_name, p_retailprice
FROM parts WHERE id >= 75 ORDER BY id LIMIT 50""",
    "scroll_page_gaps": """SELECT p_partkey * 3 AS id, p_name, p_retailprice FROM part
WHERE p_partkey * 3 >= 50 ORDER BY id LIMIT 40""",
    "next_offset": f"""WITH {_PARTS_BY_NAME}, ids AS (
  SELECT 'dense' AS ids, id FROM parts UNION ALL
  SELECT 'spaced', p_partkey * 3 FROM part),
starts AS (SELECT unnest([-1, 50, 180]) AS start),
placed AS (SELECT ids, start, id, row_number() OVER (PARTITION BY ids, start ORDER BY id) AS place
  FROM ids, starts WHERE id >= start)
SELECT ids, CAST(start AS BIGINT) AS start, coalesce(max(CASE WHEN place = 41 THEN id END), -1) AS following
FROM placed GROUP BY ids, start""",
    "full_scan": "SELECT CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part",
    "upsert": _UPSERTED,
    "upsert_twice": _UPSERTED,
    "upsert_many": _UPSERTED,
    "batch_counts": f"""WITH {_NUMBERED}
SELECT id // 512 AS batch, count(*) AS points FROM numbered GROUP BY 1""",
    "collection_info": """SELECT 'parts' AS name, 2 AS vector_size, 'Cosine' AS distance,
  count(*) AS points_count, min(p_partkey) AS min_id, max(p_partkey) AS max_id FROM part""",
    "list_collections": """SELECT 'parts' AS name, count(*) AS points_count FROM part
UNION ALL SELECT 'small_parts', count(*) FROM part WHERE p_size < 5
UNION ALL SELECT 'emptied_parts', 0""",
    "has_data": """SELECT 'parts' AS name, true AS found, count(*) > 0 AS filled FROM part
UNION ALL SELECT 'small_parts', true, count(*) > 0 FROM part WHERE p_size < 5
UNION ALL SELECT 'emptied_parts', true, false UNION ALL SELECT 'other_parts', false, false""",
    "pages_concatenated": "SELECT p_partkey * 3 AS id, p_name, p_retailprice FROM part",
    "delete_collection": """SELECT 'parts' AS name, true AS before, false AS after, false AS filled
UNION ALL SELECT 'small_parts', true, true, count(*) > 0 FROM part WHERE p_size < 5
UNION ALL SELECT 'emptied_parts', true, true, false""",
    "empty_read_guard": """SELECT 'parts' AS name, count(*) = 0 AS raised FROM part
UNION ALL SELECT 'small_parts', count(*) = 0 FROM part WHERE p_size < 5
UNION ALL SELECT 'emptied_parts', true UNION ALL SELECT 'other_parts', true""",
    "run_modes": f"""WITH {GAPS}, fixed AS (SELECT count(*) AS n {_FIXED})
SELECT 'upload' AS mode, count(*) AS n_rows FROM lineitem WHERE {_WHOLE}
""" + "".join(
        f"UNION ALL SELECT '{mode}', n FROM fixed\n"
        for mode in ("preprocess", "cluster", "write-results", "none", "anything")
    ),
    "end_to_end": f"""WITH {GAPS.replace("lineitem", "gaps", 1)}, cleaned AS ({_chain(_DISC, False)}),
total AS (SELECT count(*) AS n, count(*) FILTER (price_tier = 'high') AS high FROM cleaned)
SELECT 'ingested' AS stage, count(*) AS n_rows FROM gaps WHERE {_WHOLE}
UNION ALL SELECT 'preprocessed', n FROM total UNION ALL SELECT 'clustered', n FROM total
UNION ALL SELECT 'published', n FROM total UNION ALL SELECT 'stored', n FROM total
UNION ALL SELECT 'clusters', 5 UNION ALL SELECT 'high_tier', high FROM total""",
}
