"""DuckDB SQL for the catalogue, written independently of the Spark operators."""

from __future__ import annotations

SEGMENT_COLOUR = """CASE {c} WHEN 'AUTOMOBILE' THEN '#FF6B6B' WHEN 'BUILDING' THEN '#4ECDC4'
  WHEN 'HOUSEHOLD' THEN '#82E0AA' WHEN 'MACHINERY' THEN '#AEB6BF' ELSE '{d}' END"""


def _colour(column: str, default: str = "#CCCCCC") -> str:
    return SEGMENT_COLOUR.format(c=column, d=default)


def _key(column: str) -> str:
    return f"CAST('0x' || substr(md5({column}), 1, 15) AS BIGINT)"


def _rs(column: str) -> str:
    return f"'Rs ' || format('{{:,.0f}}', CAST({column} AS DOUBLE))"


TXN = f"""txn AS (
  SELECT o_orderkey AS txn_id, CAST(o_orderdate AS DATE) AS date,
    upper(c_mktsegment) || ' ' || o_orderpriority AS description,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
    CASE WHEN o_orderkey % 10 <> 0 THEN c_mktsegment END AS category,
    o_orderkey % 37 = 0 AS is_anomaly,
    CAST(o_orderkey % 100 AS DOUBLE) / 100 AS confidence
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

LABELLED = TXN + """, labelled AS (
  SELECT * REPLACE (coalesce(category, 'Uncategorized') AS category) FROM txn)"""

EXPENSE = LABELLED + """, expense AS (
  SELECT * FROM labelled WHERE category NOT IN ('HOUSEHOLD', 'MACHINERY'))"""

SEGMENTS = f"""segments AS (
  SELECT DISTINCT {_key('c_mktsegment')} AS category_id, c_mktsegment AS name,
    {_colour('c_mktsegment', '#888888')} AS color_hex FROM customer)"""

RAW = """raw AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date'
         ELSE CASE o_orderkey % 10
           WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d-%b-%y')
           WHEN 2 THEN strftime(o_orderdate, '%-d %b %Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 4 THEN strftime(o_orderdate, '%b %d, %Y') WHEN 5 THEN strftime(o_orderdate, '%Y%m%d')
           WHEN 6 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 7 THEN strftime(o_orderdate, '%a, %d %b %Y')
           WHEN 8 THEN strftime(o_orderdate, '%d %B %Y') ELSE strftime(o_orderdate, '%d/%m/%Y, %H:%M') END
         END AS date,
    CASE WHEN o_orderkey % 53 = 0 THEN ''
         ELSE '  ' || upper(c_mktsegment) || '   STORE REF' || o_orderkey || ' ' END AS description,
    CASE WHEN o_orderkey % 41 = 0 THEN 'abc'
         WHEN o_orderkey % 7 = 0 THEN '(' || CAST(o_totalprice AS DECIMAL(12,2)) || ')'
         WHEN o_orderkey % 5 = 0 THEN 'Rs ' || format('{:,.2f}', o_totalprice)
         WHEN o_orderkey % 11 = 0 THEN '₹' || CAST(o_totalprice AS DECIMAL(12,2)) || ' K'
         WHEN o_orderkey % 13 = 0 THEN '-$ ' || CAST(o_totalprice AS DECIMAL(12,2))
         WHEN o_orderkey % 17 = 0 THEN 'Rs. ' || o_orderkey % 1000
         WHEN o_orderkey % 19 = 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) || '5'
         ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount,
    0 AS copy
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

COPIES = RAW + """, rows AS (
  SELECT * FROM raw UNION ALL
  SELECT k, date, lower(description), amount, 1 FROM raw WHERE k % 20 = 0)"""


def _parsed(source: str) -> str:
    return f"""parsed AS (
  SELECT k, copy, description AS raw_text,
    CAST(try_strptime(date, ['%d/%m/%Y', '%d-%b-%y', '%d %b %Y', '%Y-%m-%d', '%b %d, %Y', '%Y%m%d', '%d.%m.%Y',
      '%a, %d %b %Y', '%d %B %Y', '%d/%m/%Y, %H:%M']) AS DATE) AS date,
    CAST(round_even(abs(try_cast(regexp_replace(regexp_replace(amount, '^\\((.+)\\)$', '-\\1'), '[A-Za-z ,$₹]', '', 'g')
      AS DOUBLE)) * 100, 0) / 100 AS DECIMAL(12,2)) AS amount,
    nullif(lower(trim(regexp_replace(description, ' +', ' ', 'g'))), '') AS description
  FROM {source}), valid AS (
  SELECT * FROM parsed WHERE date IS NOT NULL AND amount IS NOT NULL AND description IS NOT NULL)"""


REPORT = """report AS (
  SELECT count(*) AS original_rows,
    count(*) FILTER (date IS NOT NULL AND amount IS NOT NULL AND description IS NOT NULL) AS clean_rows,
    count(*) FILTER (date IS NULL) AS bad_dates,
    count(*) FILTER (date IS NOT NULL AND amount IS NULL) AS bad_amounts,
    count(*) FILTER (date IS NOT NULL AND amount IS NOT NULL AND description IS NULL) AS bad_descriptions
  FROM parsed)"""

UNIQUE = """uniq AS (
  SELECT date, amount, description, arg_min(raw_text, k * 2 + copy) AS raw_text, count(*) AS copies
  FROM valid GROUP BY date, amount, description)"""

STORED = """stored AS (SELECT DISTINCT date, amount, description FROM valid WHERE k % 3 = 0)"""

FRESH = """fresh AS (
  SELECT u.* FROM uniq u ANTI JOIN stored s
  ON u.date = s.date AND u.amount = s.amount AND u.description = s.description)"""

EVT = f"""evt AS (
  SELECT event_id AS txn_id, CAST(ts AS DATE) AS date, event_type || ' ' || props AS description,
    CAST(value AS DECIMAL(12,2)) AS amount, event_type AS category, event_id % 37 = 0 AS is_anomaly
  FROM events)"""

Z = EVT + """, stats AS (
  SELECT category, count(*) AS n, avg(CAST(amount AS DOUBLE)) AS mean, stddev_pop(CAST(amount AS DOUBLE)) AS std
  FROM evt GROUP BY category), scored AS (
  SELECT txn_id, category, CAST(amount AS DOUBLE) AS amount, mean,
    abs((CAST(amount AS DOUBLE) - mean) / std) AS zed
  FROM evt JOIN stats USING (category) WHERE n >= 3 AND std > 0), z AS (
  SELECT txn_id, 'zscore' AS method,
    CASE WHEN zed > 5 THEN 'high' WHEN zed > 3.5 THEN 'medium' ELSE 'low' END AS severity,
    'Amount Rs ' || format('{:,.0f}', amount) || ' is ' || format('{:.1f}', zed) ||
    ' standard deviations above the ' || category || ' category mean of Rs ' || format('{:,.0f}', mean) ||
    '. Deviation: Rs ' || CASE WHEN amount >= mean THEN '+' ELSE '' END ||
    format('{:,.0f}', amount - mean) || '.' AS reason,
    round(zed, 2) AS z_score
  FROM scored WHERE zed > 2.5)"""

MERGED = Z + """, f AS (
  SELECT txn_id, 'isolation_forest' AS method,
    CASE WHEN amount > 300 THEN 'high' WHEN amount > 220 THEN 'medium' ELSE 'low' END AS severity,
    'large value ' || amount AS reason
  FROM evt WHERE amount > 150), merged AS (
  SELECT coalesce(z.txn_id, f.txn_id) AS txn_id,
    CASE WHEN z.txn_id IS NOT NULL AND f.txn_id IS NOT NULL THEN 'both'
         ELSE coalesce(z.method, f.method) END AS method,
    CASE WHEN z.txn_id IS NOT NULL AND f.txn_id IS NOT NULL THEN 'high'
         ELSE coalesce(z.severity, f.severity) END AS severity,
    CASE WHEN z.txn_id IS NOT NULL AND f.txn_id IS NOT NULL
         THEN 'CONFIRMED by both Z-score and Isolation Forest. ' || z.reason
         ELSE coalesce(z.reason, f.reason) END AS reason,
    CASE WHEN f.txn_id IS NULL THEN z.z_score END AS z_score
  FROM z FULL JOIN f ON z.txn_id = f.txn_id)"""

_LEVELS = 8  # ceil(log2(256))
_EULER = "0.5772156649015329"


def _path(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1.0) + {_EULER}) - 2.0 * ({n} - 1.0) / {n} END"


def _uniform(what: str) -> str:
    return f"CAST('0x' || substr(md5('{what} 42:' || tree || ':' || node), 1, 13) AS BIGINT) / 4503599627370496.0"


def _forest(source: str) -> str:
    """Forest of 100 trees over a table: samples, one pair of tables per level, and every row's walk."""
    parts = [f"""points AS (
  SELECT row_number() OVER () AS rid, txn_id, date, amount, coalesce(ln(1 + CAST(amount AS DOUBLE)), 0) AS f0,
    CAST(coalesce(isodow(date) - 1, 0) AS DOUBLE) AS f1, CAST(coalesce(day(date), 0) AS DOUBLE) AS f2 FROM {source}), total AS (
  SELECT count(*) AS n, least(256, count(*)) AS size, 200 * least(256, count(*)) AS wanted FROM points), rates AS (
  SELECT ceil(least(1.0, wanted / n) * 4294967296) AS pooled,
    ceil(least(1.0, 512.0 / least(n, wanted)) * 4294967296) AS joined, size FROM total), pool AS (
  SELECT points.*, joined, size FROM points, rates WHERE CAST('0x' || substr(md5('pool 42:' || txn_id), 1, 8) AS BIGINT) < pooled), drawn AS (
  SELECT txn_id, tree, any_value(size) AS size, min(struct_pack(f0 := f0, f1 := f1, f2 := f2)) AS f FROM pool, (SELECT unnest(range(100)) AS tree)
  WHERE CAST('0x' || substr(md5('42:' || tree || ':' || txn_id), 1, 8) AS BIGINT) < joined GROUP BY ALL), s0 AS (
  SELECT tree, CAST(1 AS BIGINT) AS node, f.f0 AS f0, f.f1 AS f1, f.f2 AS f2 FROM drawn
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY md5('rank 42:' || tree || ':' || txn_id), txn_id) <= size), depth AS (
  SELECT tree, ceil(log2(greatest(count(*), 2))) AS deepest FROM s0 GROUP BY tree)"""]
    for d in range(_LEVELS + 1):
        parts.append(f"""b{d} AS (
  SELECT tree, node, count(*) AS n, [min(f0), min(f1), min(f2)] AS low, [max(f0), max(f1), max(f2)] AS high FROM s{d} GROUP BY tree, node), v{d} AS (
  SELECT *, list_filter([1, 2, 3], lambda k: high[k] > low[k]) AS free FROM b{d}), c{d} AS (
  SELECT *, CASE WHEN n > 1 AND len(free) > 0 AND {d} < deepest THEN free[1 + CAST(floor({_uniform('feature')} * len(free)) AS BIGINT)] END AS feature
  FROM v{d} JOIN depth USING (tree)), n{d} AS (
  SELECT tree, node, feature, low[feature] + {_uniform('split')} * (high[feature] - low[feature]) AS threshold, {d} + {_path('n')} AS path FROM c{d})""")
        if d < _LEVELS:
            parts.append(f"""s{d + 1} AS (
  SELECT s.tree, 2 * s.node + CASE WHEN [f0, f1, f2][feature] <= threshold THEN 0 ELSE 1 END AS node, f0, f1, f2
  FROM s{d} s JOIN n{d} n ON s.tree = n.tree AND s.node = n.node WHERE feature IS NOT NULL)""")
    parts.append("w0 AS (SELECT rid, tree, CAST(1 AS BIGINT) AS node, f0, f1, f2 FROM points, (SELECT tree FROM depth))")
    for d in range(_LEVELS):
        parts.append(f"""w{d + 1} AS (
  SELECT rid, w.tree, 2 * w.node + CASE WHEN [f0, f1, f2][feature] <= threshold THEN 0 ELSE 1 END AS node, f0, f1, f2
  FROM w{d} w JOIN n{d} n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NOT NULL)""")
    ends = " UNION ALL ".join(
        f"SELECT rid, path FROM w{d} w JOIN n{d} n ON w.tree = n.tree AND w.node = n.node WHERE feature IS NULL" for d in range(_LEVELS + 1)
    )
    parts.append(f"""ends AS ({ends}), scores AS (
  SELECT rid, round(-pow(2.0, -(sum(path) / (SELECT count(*) FROM depth)) / (SELECT {_path('size')} FROM total)), 6) AS score FROM ends GROUP BY rid), decided AS (
  SELECT txn_id, date, amount, score - (SELECT quantile_cont(score, 0.05) FROM scores) AS decision FROM scores JOIN points USING (rid)), forest AS (
  SELECT txn_id, 'isolation_forest' AS method,
    CASE WHEN decision < -0.2 THEN 'high' WHEN decision < -0.1 THEN 'medium' ELSE 'low' END AS severity,
    'Isolation Forest detected unusual pattern. Transaction amount Rs ' || format('{{:,.0f}}', CAST(amount AS DOUBLE)) || ' on ' ||
    strftime(date, '%Y-%m-%d') || ' shows abnormal behaviour across multiple dimensions. Anomaly score: ' ||
    format('{{:.4f}}', decision) || '.' AS reason FROM decided WHERE decision < 0)""")
    return ", ".join(parts)


FLAGGED = Z + """, anomalies AS (
  SELECT txn_id, reason, severity FROM z UNION ALL
  SELECT -event_id - 1, 'orphan', 'low' FROM events WHERE event_id % 1000 = 0), flagged AS (
  SELECT a.txn_id, strftime(e.date, '%Y-%m-%d') AS date, e.description, CAST(e.amount AS DOUBLE) AS amount,
    CASE WHEN e.category = 'error' THEN 'Unknown' ELSE e.category END AS category,
    a.severity, a.reason, '2024-06-30 12:00:00' AS detected_at
  FROM anomalies a JOIN evt e ON a.txn_id = e.txn_id)"""

HISTORY = TXN + """, spent AS (
  SELECT * FROM txn WHERE category IS NOT NULL AND category NOT IN ('HOUSEHOLD', 'MACHINERY') {where}),
  totals AS (
  SELECT strftime(date, '%Y-%m') AS year_month, category, CAST(sum(amount) AS DOUBLE) AS total
  FROM spent GROUP BY ALL), months AS (
  SELECT year_month, row_number() OVER (ORDER BY year_month) AS month_num
  FROM (SELECT DISTINCT year_month FROM totals)), history AS (
  SELECT year_month, category, total, month_num FROM totals JOIN months USING (year_month))"""

FORECAST = """fitted AS (
  SELECT category, count(*) AS history_months, max(month_num) AS last_num, max(year_month) AS last_month,
    regr_slope(total, month_num) AS b, regr_intercept(total, month_num) AS a, regr_r2(total, month_num) AS r2
  FROM {h} GROUP BY category HAVING count(*) >= 3), errors AS (
  SELECT category, avg(abs(total - (a + b * month_num))) AS mae
  FROM {h} JOIN fitted USING (category) GROUP BY category), fc AS (
  SELECT category, greatest(0, a + b * (last_num + 1)) AS p, mae, b, r2, history_months,
    CAST(last_month || '-01' AS DATE) + INTERVAL 1 MONTH AS month_start
  FROM fitted JOIN errors USING (category)), forecasts AS (
  SELECT category, round(p, 2) AS predicted, round(greatest(0, p - mae), 2) AS lower_bound,
    round(p + mae, 2) AS upper_bound,
    CASE WHEN b > 500 THEN 'increasing' WHEN b < -500 THEN 'decreasing' ELSE 'stable' END AS trend,
    CASE WHEN b > 500 THEN 'Spending is rising by ~Rs ' || format('{{:,.0f}}', abs(b)) || ' per month'
         WHEN b < -500 THEN 'Spending is falling by ~Rs ' || format('{{:,.0f}}', abs(b)) || ' per month'
         ELSE 'Spending is relatively stable month to month' END AS trend_note,
    round(b, 2) AS slope, round(r2, 4) AS r2_score, round(mae, 2) AS mae,
    strftime(month_start, '%Y-%m-%d') AS forecast_month, history_months
  FROM fc)"""

ALL_HISTORY = HISTORY.format(where="")
ALL_FORECASTS = ALL_HISTORY + ", " + FORECAST.format(h="history")

SAVED = f"""saved AS (
  SELECT {_key('category')} AS category_id, category, year_month || '-01' AS forecast_month,
    CASE WHEN month_num % 3 <> 0 THEN round(total, 2) END AS predicted_amount,
    CASE WHEN month_num % 2 = 0 THEN round(total, 2) ELSE 0.0 END AS actual_amount
  FROM history WHERE category <> 'BUILDING')"""

DOCS = "docs AS (SELECT doc_id, text AS description, lang AS category FROM documents)"

CLEANED = """cleaned AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z]+'),
    lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'for', 'ltd', 'pvt')) AS words
  FROM documents)"""

VOCAB = CLEANED + """, terms AS (
  SELECT doc_id, unnest(words) AS term FROM cleaned UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
  FROM cleaned), counted AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL), per_term AS (
  SELECT term, sum(tf) AS n_total, count(*) AS n_docs FROM counted GROUP BY term), size AS (
  SELECT count(*) AS n FROM documents), vocab AS (
  SELECT term, CAST(n_total AS BIGINT) AS n_total, n_docs, ln((1.0 + n) / (1.0 + n_docs)) + 1 AS idf
  FROM per_term, size WHERE n_docs <= 0.95 * n ORDER BY n_total DESC, term LIMIT 3000)"""

CENTROIDS = """docs AS (
  SELECT doc_id, coalesce(text, '') AS text, lang AS category FROM documents), learned AS (
  SELECT * FROM docs WHERE category IS NOT NULL AND regexp_matches(text, '\\S') {where}), cleaned AS (
  SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[a-z]+'),
    lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'for', 'ltd', 'pvt')) AS words
  FROM docs), terms AS (
  SELECT doc_id, unnest(words) AS term FROM cleaned UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
  FROM cleaned), counted AS (
  SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL), per_term AS (
  SELECT term, sum(tf) AS n_total, count(*) AS n_docs FROM counted SEMI JOIN learned USING (doc_id) GROUP BY term), size AS (
  SELECT count(*) AS n FROM learned), vocab AS (
  SELECT term, ln((1.0 + n) / (1.0 + n_docs)) + 1 AS idf
  FROM per_term, size WHERE n_docs <= 0.95 * n ORDER BY n_total DESC, term LIMIT 3000), weighted AS (
  SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM counted JOIN vocab USING (term)), lengths AS (
  SELECT doc_id, sqrt(sum(w * w)) AS l FROM weighted GROUP BY doc_id), unit AS (
  SELECT doc_id, term, w / l AS u FROM weighted JOIN lengths USING (doc_id)), sums AS (
  SELECT category, term, sum(u) AS s FROM unit JOIN learned USING (doc_id) GROUP BY ALL), sizes AS (
  SELECT category, sqrt(sum(s * s)) AS l FROM sums GROUP BY category), centroid AS (
  SELECT category, term, 20.0 * s / l AS c FROM sums JOIN sizes USING (category)), dots AS (
  SELECT doc_id, category, sum(u * c) AS m FROM unit JOIN centroid USING (term) GROUP BY ALL), margins AS (
  SELECT d.doc_id, k.category, coalesce(dots.m, 0) AS m
  FROM docs d CROSS JOIN (SELECT DISTINCT category FROM learned) k
  LEFT JOIN dots ON dots.doc_id = d.doc_id AND dots.category = k.category), raised AS (
  SELECT doc_id, category, exp(m - max(m) OVER (PARTITION BY doc_id)) AS x FROM margins), scored AS (
  SELECT doc_id, category, x / sum(x) OVER (PARTITION BY doc_id) AS p FROM raised), placed AS (
  SELECT doc_id, category, p, row_number() OVER (PARTITION BY doc_id ORDER BY p DESC, category) AS place FROM scored)"""

RANKED = """ranked AS (
  SELECT doc_id, lang AS category, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS rn
  FROM documents)"""

TITLE = """array_to_string(list_transform(string_split(lower({c}), ' '), lambda w:
    CASE WHEN substr(w, 2, 1) = '-' THEN substr(w, 1, 2) || upper(substr(w, 3, 1)) || substr(w, 4)
         WHEN substr(w, 1, 2) = '{{"' THEN substr(w, 1, 2) || upper(substr(w, 3, 1)) || substr(w, 4)
         ELSE upper(substr(w, 1, 1)) || substr(w, 2) END), ' ')"""


def _explorer(view: str, where: str, order: str) -> str:
    return f"""SELECT strftime(date, '%Y-%m-%d') AS "Date", description AS "Description",
  {_rs('amount')} AS "Amount", category AS "Category",
  CASE WHEN confidence <> 0 THEN format('{{:.0f}}', round_even(confidence, 2) * 100) || '%' ELSE 'N/A' END
    AS "ML Confidence",
  CASE WHEN is_anomaly THEN '🚨 Anomaly' ELSE '✅ Normal' END AS "Status", '{view}' AS view
FROM (SELECT * FROM labelled WHERE {where} ORDER BY {order}, txn_id LIMIT 30)"""


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # --- ingest
    sql["normalise_columns"] = f"""WITH {RAW}
SELECT nullif(date, '') AS date, description, nullif(amount, '') AS amount,
  CASE WHEN k % 2 = 0 THEN 'Debit' ELSE 'Credit' END AS type FROM raw"""
    sql["validate_dates"] = f"""WITH {RAW}, {_parsed('raw')}
SELECT k, strftime(date, '%Y-%m-%d') AS date FROM parsed WHERE date IS NOT NULL"""
    sql["validate_amounts"] = f"""WITH {RAW}, {_parsed('raw')}
SELECT k, CAST(amount AS DOUBLE) AS amount FROM parsed WHERE amount IS NOT NULL"""
    sql["validate_descriptions"] = f"""WITH {RAW}, {_parsed('raw')}
SELECT k, description FROM parsed WHERE description IS NOT NULL"""
    sql["validation_report"] = f"""WITH {RAW}, {_parsed('raw')}, {REPORT}
SELECT original_rows, clean_rows, original_rows - clean_rows AS dropped_rows, bad_dates, bad_amounts,
  bad_descriptions, round((original_rows - clean_rows) / original_rows * 100, 1) AS drop_rate FROM report"""
    sql["ingest_clean"] = f"""WITH {RAW}, {_parsed('raw')}
SELECT strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount, raw_text FROM valid"""
    sql["dedupe"] = f"""WITH {COPIES}, {_parsed('rows')}, {UNIQUE}
SELECT strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount, raw_text, copies
FROM uniq"""
    sql["ingest_append"] = f"""WITH {COPIES}, {_parsed('rows')}, {UNIQUE}, {STORED}, {FRESH}
SELECT sha256(strftime(date, '%Y-%m-%d') || '|' || amount || '|' || description) AS txn_id,
  strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount, raw_text,
  false AS is_anomaly, strftime(date, '%Y-%m') AS year_month FROM fresh"""
    sql["ingest_summary"] = f"""WITH {COPIES}, {_parsed('rows')}, {REPORT}, {UNIQUE}, {STORED}, {FRESH}
SELECT original_rows AS total_read, (SELECT count(*) FROM uniq) AS total_clean,
  original_rows - clean_rows AS total_dropped,
  round((original_rows - clean_rows) / original_rows * 100, 1) AS drop_rate,
  clean_rows - (SELECT count(*) FROM uniq) AS duplicates_removed,
  (SELECT count(*) FROM fresh) AS db_inserted,
  (SELECT count(*) FROM uniq) - (SELECT count(*) FROM fresh) AS db_skipped FROM report"""
    sql["layout_ingest"] = f"""WITH {COPIES}, {_parsed('rows')}
SELECT strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN k % 3 <> 0 THEN raw_text END AS raw_text FROM valid"""
    sql["statement_run"] = f"""WITH {COPIES}, {_parsed('rows')}, {REPORT}, {UNIQUE}, facts AS (
  SELECT sha256(strftime(date, '%Y-%m-%d') || '|' || amount || '|' || description) AS txn_id, date, amount,
    upper(split_part(description, ' ', 1)) AS category FROM uniq), stats AS (
  SELECT category, count(*) AS n, avg(CAST(amount AS DOUBLE)) AS mean, stddev_pop(CAST(amount AS DOUBLE)) AS std
  FROM facts GROUP BY category), z AS (
  SELECT txn_id FROM facts JOIN stats USING (category) WHERE n >= 3 AND std > 0 AND abs((CAST(amount AS DOUBLE) - mean) / std) > 2.5),
  {_forest("facts")}, found AS (
  SELECT z.txn_id IS NOT NULL AS by_z, forest.txn_id IS NOT NULL AS by_forest FROM z FULL JOIN forest ON z.txn_id = forest.txn_id), totals AS (
  SELECT strftime(date, '%Y-%m') AS year_month, category, CAST(sum(amount) AS DOUBLE) AS total
  FROM facts WHERE category NOT IN ('HOUSEHOLD', 'MACHINERY') GROUP BY ALL), months AS (
  SELECT year_month, row_number() OVER (ORDER BY year_month) AS month_num FROM (SELECT DISTINCT year_month FROM totals)), history AS (
  SELECT year_month, category, total, month_num FROM totals JOIN months USING (year_month)), {FORECAST.format(h="history")}, counted AS (
  SELECT original_rows AS r, clean_rows AS c, (SELECT count(*) FROM uniq) AS u FROM report)
SELECT 'ingest' AS step, unnest(['total_read', 'total_clean', 'total_dropped', 'duplicates_removed', 'db_inserted', 'db_skipped']) AS name,
  CAST(unnest([r, u, r - c, c - u, u, 0]) AS DOUBLE) AS value FROM counted UNION ALL
SELECT 'categorise', 'updated', u FROM counted UNION ALL
SELECT 'detect', unnest(['zscore_flagged', 'iforest_flagged', 'total_flagged', 'new_records', 'total_transactions']),
  unnest([count(*) FILTER (by_z), count(*) FILTER (by_forest), count(*), count(*), (SELECT u FROM counted)]) FROM found UNION ALL
SELECT 'store', 'flagged', count(*) FROM found UNION ALL
SELECT 'forecast', category, predicted FROM forecasts UNION ALL
SELECT 'forecast', 'months_of_data', count(*) FROM months UNION ALL
SELECT 'forecast', 'categories_forecast', count(*) FROM forecasts"""
    sql["preview_profile"] = f"""WITH {RAW}
SELECT k, date, description, amount, (SELECT count(*) FROM raw) AS total_rows, 4 AS total_columns
FROM raw ORDER BY k LIMIT 5"""

    # --- store
    sql["txn_enriched"] = f"""WITH {TXN}
SELECT txn_id, strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount,
  coalesce(category, 'Uncategorized') AS category, {_colour('category', '#888888')} AS category_color,
  is_anomaly, CASE WHEN confidence <> 0 THEN round_even(confidence, 2) END AS confidence FROM txn"""
    sql["anomaly_summary"] = f"WITH {FLAGGED} SELECT * FROM flagged"
    summary = """SELECT {name} AS category, forecast_month,
  coalesce(predicted_amount, 0.0) AS predicted, nullif(actual_amount, 0.0) AS actual,
  '2024-06-30 12:00:00' AS created_at FROM saved"""
    unknown = "CASE WHEN category = 'FURNITURE' THEN 'Unknown' ELSE category END"
    sql["forecast_summary"] = f"WITH {ALL_HISTORY}, {SAVED} " + summary.format(name=unknown)
    sql["forecast_table"] = f"""WITH {ALL_HISTORY}, {SAVED}, s AS ({summary.format(name='category')})
SELECT category AS "Category", forecast_month AS "Forecast Month", {_rs('predicted')} AS "Predicted Amount",
  coalesce({_rs('actual')}, '⏳ Pending') AS "Actual Amount", created_at AS "Generated At" FROM s"""
    early = HISTORY.format(where="AND date < (SELECT date_trunc('month', max(date)) FROM txn)").replace("history AS", "early AS")
    late = ALL_HISTORY[len(TXN) + 2:].replace("spent", "spent2").replace("totals", "totals2").replace(
        "months AS", "months2 AS").replace("JOIN months", "JOIN months2")
    sql["forecast_upsert"] = f"""WITH {early}, {FORECAST.format(h='early')}, {late}, {SAVED}, incoming AS (
  SELECT {_key('category')} AS category_id, forecast_month, predicted FROM forecasts
  WHERE category <> 'FURNITURE')
SELECT coalesce(n.category_id, o.category_id) AS category_id,
  coalesce(n.forecast_month, o.forecast_month) AS forecast_month,
  coalesce(n.predicted, o.predicted_amount) AS predicted_amount, o.actual_amount,
  CASE WHEN n.category_id IS NULL THEN 'kept' WHEN o.category_id IS NULL THEN 'inserted' ELSE 'updated' END
    AS action
FROM incoming n FULL JOIN saved o ON n.category_id = o.category_id AND n.forecast_month = o.forecast_month"""
    sql["anomaly_save"] = f"""WITH {Z}
SELECT txn_id, reason, severity, '2024-06-30 12:00:00' AS detected_at FROM z WHERE txn_id % 5 <> 0"""
    sql["flag_update"] = f"WITH {TXN} SELECT txn_id, is_anomaly OR amount > 400000 AS is_anomaly FROM txn"
    sql["category_merge"] = f"""WITH {SEGMENTS}
SELECT category_id, name, CASE WHEN name IN ('AUTOMOBILE', 'BUILDING') THEN '#111111' ELSE color_hex END
  AS color_hex, '2024-06-30 12:00:00' AS created_at FROM segments"""
    sql["uncategorised"] = f"""WITH {TXN}
SELECT txn_id, strftime(date, '%Y-%m-%d') AS date, description, CAST(amount AS DOUBLE) AS amount
FROM txn WHERE category IS NULL"""
    sql["store_profile"] = f"""WITH {TXN}
SELECT (SELECT count(DISTINCT c_mktsegment) FROM customer) AS categories, count(*) AS transactions,
  count(*) FILTER (is_anomaly) AS anomalies FROM txn"""
    sql["integrity_report"] = f"""WITH {ALL_HISTORY}, {SAVED}, cats AS (
  SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment <> 'FURNITURE' UNION ALL
  SELECT 'BUILDING'), found AS (
  SELECT txn_id, CASE WHEN txn_id % 150 = 0 THEN 'critical' ELSE 'low' END AS severity
  FROM txn WHERE txn_id % 50 = 0), anom AS (
  SELECT * FROM found UNION ALL SELECT * FROM found WHERE txn_id % 500 = 0 UNION ALL
  SELECT -txn_id - 1, 'high' FROM txn WHERE txn_id % 700 = 0), fore AS (
  SELECT * FROM saved UNION ALL SELECT * FROM saved WHERE month(CAST(forecast_month AS DATE)) = 6)
SELECT 'transaction date not null' AS rule, count(*) FILTER (date IS NULL) AS violations FROM txn UNION ALL
SELECT 'transaction description not null', count(*) FILTER (txn_id % 101 = 0) FROM txn UNION ALL
SELECT 'transaction amount not null', count(*) FILTER (txn_id % 103 = 0) FROM txn UNION ALL
SELECT 'category name not null', count(*) FILTER (name IS NULL) FROM cats UNION ALL
SELECT 'anomaly transaction not null', count(*) FILTER (txn_id IS NULL) FROM anom UNION ALL
SELECT 'anomaly severity in domain', count(*) FILTER (severity = 'critical') FROM anom UNION ALL
SELECT 'forecast category not null', count(*) FILTER (category_id IS NULL) FROM fore UNION ALL
SELECT 'forecast month not null', count(*) FILTER (forecast_month IS NULL) FROM fore UNION ALL
SELECT 'category name unique', count(*) - count(DISTINCT name) FROM cats UNION ALL
SELECT 'one anomaly per transaction', count(*) - count(DISTINCT txn_id) FROM anom UNION ALL
SELECT 'one forecast per category and month',
  count(*) - count(DISTINCT category_id || '/' || forecast_month) FROM fore UNION ALL
SELECT 'transaction category exists', count(*) FROM txn WHERE category = 'FURNITURE' UNION ALL
SELECT 'forecast category exists', count(*) FROM fore WHERE category = 'FURNITURE' UNION ALL
SELECT 'anomaly transaction exists', count(*) FROM anom WHERE txn_id NOT IN (SELECT txn_id FROM txn)"""

    # --- reports
    sql["spend_by_category"] = f"""WITH {EXPENSE}, t AS (
  SELECT category, CAST(sum(amount) AS DOUBLE) AS total FROM expense GROUP BY category)
SELECT category, total, {_colour('category')} AS color, {_rs('total')} AS label FROM t"""
    sql["category_share"] = f"""WITH {EXPENSE}, t AS (
  SELECT category, CAST(sum(amount) AS DOUBLE) AS total FROM expense GROUP BY category)
SELECT category, total, round(total / (SELECT CAST(sum(amount) AS DOUBLE) FROM expense) * 100, 2) AS share_pct,
  {_colour('category')} AS color FROM t"""
    sql["monthly_trend"] = f"""WITH {EXPENSE}
SELECT strftime(date, '%Y-%m') AS year_month, category, CAST(sum(amount) AS DOUBLE) AS total,
  {_colour('category')} AS color FROM expense GROUP BY ALL"""
    sql["monthly_total"] = f"""WITH {EXPENSE}, t AS (
  SELECT strftime(date, '%Y-%m') AS year_month, CAST(sum(amount) AS DOUBLE) AS total FROM expense GROUP BY ALL)
SELECT year_month, total, {_rs('total')} AS label FROM t"""
    sql["kpi_summary"] = f"""WITH {LABELLED}, k AS (
  SELECT CAST(sum(amount) FILTER (category NOT IN ('HOUSEHOLD', 'MACHINERY')) AS DOUBLE) AS total_expense,
    CAST(sum(amount) FILTER (category = 'HOUSEHOLD') AS DOUBLE) AS total_income,
    count(*) AS transactions, count(*) FILTER (is_anomaly) AS anomalies,
    count(*) FILTER (category NOT IN ('HOUSEHOLD', 'MACHINERY')) AS n FROM labelled)
SELECT total_expense, total_income, round(total_income - total_expense, 2) AS net_balance, transactions,
  anomalies, round(total_expense / n, 2) AS avg_expense, round(anomalies / transactions * 100, 1) AS anomaly_rate
FROM k"""
    sql["top_category"] = f"""WITH {EXPENSE}
SELECT category, CAST(sum(amount) AS DOUBLE) AS total FROM expense GROUP BY category
ORDER BY total DESC, category LIMIT 1"""
    sql["category_options"] = f"WITH {LABELLED} SELECT DISTINCT category FROM labelled"
    sql["txn_explorer"] = f"""WITH {LABELLED}
({_explorer('all', 'true', 'date DESC')}) UNION ALL
({_explorer('normal', 'NOT is_anomaly', 'amount DESC')}) UNION ALL
({_explorer('building', "is_anomaly AND category = 'BUILDING'", 'amount')})"""
    sql["explorer_footer"] = f"""WITH {LABELLED}
SELECT least(count(*), 30) AS shown, count(*) AS matching FROM labelled
WHERE is_anomaly AND category = 'BUILDING'"""
    sql["top5_expenses"] = f"""WITH {EXPENSE}
SELECT row_number() OVER (ORDER BY amount DESC, txn_id) AS rank, txn_id, strftime(date, '%Y-%m-%d') AS date,
  {TITLE.format(c='description')} AS description, category, CAST(amount AS DOUBLE) AS amount,
  {_rs('amount')} AS label FROM expense ORDER BY amount DESC, txn_id LIMIT 5"""
    sql["anomaly_kpis"] = f"""WITH {FLAGGED}
SELECT count(*) AS flagged, count(*) FILTER (severity = 'high') AS high,
  count(*) FILTER (severity = 'medium') AS medium, count(*) FILTER (severity = 'low') AS low,
  round(sum(amount), 2) AS suspicious_amount,
  round(coalesce(sum(amount) FILTER (severity = 'high'), 0), 2) AS high_amount FROM flagged"""
    found = "severity IN ('high', 'medium') AND regexp_matches(description, '(?i)CLICK|purch')"
    sql["anomaly_search"] = f"""WITH {FLAGGED}
SELECT txn_id, date, {TITLE.format(c='description')} AS title, amount, category, severity,
  upper(severity) AS badge, reason FROM flagged WHERE {found}"""
    sql["anomaly_search_footer"] = f"""WITH {FLAGGED}
SELECT count(*) FILTER ({found}) AS shown, count(*) AS total,
  round(coalesce(sum(amount) FILTER ({found}), 0), 2) AS shown_amount FROM flagged"""
    sql["anomaly_scatter"] = f"""WITH {Z}, s AS (
  SELECT e.*, z.severity AS found FROM evt e LEFT JOIN z ON e.txn_id = z.txn_id)
SELECT txn_id, strftime(date, '%Y-%m-%d') AS date, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN is_anomaly OR found IS NOT NULL THEN 'Anomaly' ELSE 'Normal' END AS series,
  coalesce(found, 'normal') AS severity,
  CASE WHEN found = 'high' THEN '#E74C3C' WHEN found = 'low' THEN '#F1C40F'
       WHEN found = 'medium' OR is_anomaly THEN '#F39C12' ELSE '#CCCCCC' END AS color FROM s"""
    sql["label_distribution"] = """SELECT lang AS category, count(*) AS n FROM documents
WHERE doc_id % 19 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND trim(text) <> '' GROUP BY lang"""

    # --- anomalies
    sql["txn_features"] = f"""WITH {EVT}
SELECT txn_id, isodow(date) - 1 AS day_of_week, day(date) AS day_of_month, month(date) AS month,
  round(ln(1 + CAST(amount AS DOUBLE)), 6) AS amount_log FROM evt"""
    sql["category_stats"] = f"""WITH {Z}
SELECT category, n, round(mean, 4) AS mean, round(std, 4) AS std FROM stats"""
    sql["zscore"] = f"WITH {Z} SELECT txn_id, method, severity, z_score FROM z"
    sql["zscore_reason"] = f"WITH {Z} SELECT txn_id, reason FROM z"
    sql["anomaly_merge"] = f"WITH {MERGED} SELECT * FROM merged"
    sql["severity_breakdown"] = f"WITH {MERGED} SELECT severity, count(*) AS n FROM merged GROUP BY severity"
    sql["detection_summary"] = f"""WITH {MERGED}
SELECT (SELECT count(*) FROM z) AS zscore_flagged, (SELECT count(*) FROM f) AS iforest_flagged,
  count(*) AS total_flagged, count(*) FILTER (txn_id % 5 <> 0) AS new_records,
  (SELECT count(*) FROM evt) AS total_transactions FROM merged"""

    # --- forecast
    sql["monthly_history"] = f"WITH {ALL_HISTORY} SELECT * FROM history"
    sql["month_number"] = f"WITH {ALL_HISTORY} SELECT * FROM months"
    sql["forecast"] = f"WITH {ALL_FORECASTS} SELECT * FROM forecasts"
    sql["forecast_coverage"] = f"""WITH {ALL_HISTORY}, c AS (
  SELECT category, count(*) AS n FROM history GROUP BY category)
SELECT count(*) AS categories, count(*) FILTER (n >= 3) AS categories_forecast,
  count(*) FILTER (n < 3) AS categories_skipped, (SELECT count(*) FROM months) AS months_of_data FROM c"""
    overview = """overview AS (
  SELECT round(sum(predicted), 2) AS total_predicted,
    (SELECT category FROM forecasts ORDER BY predicted DESC, category LIMIT 1) AS highest_category,
    max(predicted) AS highest_amount,
    (SELECT category FROM forecasts ORDER BY predicted, category LIMIT 1) AS lowest_category,
    min(predicted) AS lowest_amount, count(*) AS forecasts FROM forecasts)"""
    sql["forecast_overview"] = f"WITH {ALL_FORECASTS}, {overview} SELECT * FROM overview"
    sql["budget_alert"] = f"""WITH {ALL_FORECASTS}, {overview}
SELECT total_predicted,
  CASE WHEN total_predicted > 200000 THEN 'high' WHEN total_predicted > 100000 THEN 'moderate' ELSE 'good' END
    AS level,
  CASE WHEN total_predicted > 200000 THEN 'High Spending Alert! Predicted total of ' || {_rs('total_predicted')} ||
      ' next month is above Rs 200,000. Consider reviewing your ' || highest_category || ' expenses.'
    WHEN total_predicted > 100000 THEN 'Moderate Spending: Predicted ' || {_rs('total_predicted')} ||
      ' next month. Your biggest category is ' || highest_category || '.'
    ELSE 'Good spending pattern! Predicted ' || {_rs('total_predicted')} || ' next month looks healthy.' END
    AS message FROM overview"""
    sql["forecast_cards"] = f"""WITH {ALL_FORECASTS}, t AS (SELECT round(sum(predicted), 2) AS total FROM forecasts)
SELECT category, upper(category) AS title, predicted, {_rs('predicted')} AS label,
  round(predicted / total * 100, 1) AS share_pct,
  CASE WHEN predicted / total * 100 > 30 THEN '#EF4444' WHEN predicted / total * 100 > 15 THEN '#F59E0B'
       ELSE '#10B981' END AS band_color,
  {_colour('category')} AS color,
  CASE trend WHEN 'increasing' THEN '↑' WHEN 'decreasing' THEN '↓' ELSE '→' END || ' ' || trend_note AS hover,
  forecast_month FROM forecasts, t"""

    # --- text and classifier
    sql["clean_text"] = f"WITH {CLEANED} SELECT doc_id, array_to_string(words, ' ') AS cleaned FROM cleaned"
    sql["ngram_vocab"] = f"WITH {VOCAB} SELECT term, n_total, n_docs, round(idf, 6) AS idf FROM vocab"
    sql["tfidf_weights"] = f"""WITH {VOCAB}, w AS (
  SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM counted JOIN vocab USING (term)), norms AS (
  SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN norms USING (doc_id)"""
    sql["class_weights"] = f"""WITH {DOCS}, c AS (SELECT category, count(*) AS n FROM docs GROUP BY category)
SELECT category, n, round((SELECT count(*) FROM docs) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c"""
    sql["iforest"] = f"WITH {EVT}, {_forest('evt')} SELECT txn_id, method, severity, reason FROM forest"
    sql["anomaly_run_summary"] = f"""WITH {Z}, {_forest("evt")}, merged AS (
  SELECT coalesce(z.txn_id, forest.txn_id) AS txn_id, z.txn_id IS NOT NULL AS by_z, forest.txn_id IS NOT NULL AS by_forest
  FROM z FULL JOIN forest ON z.txn_id = forest.txn_id)
SELECT count(*) FILTER (by_z) AS zscore_flagged, count(*) FILTER (by_forest) AS iforest_flagged, count(*) AS total_flagged,
  count(*) FILTER (txn_id % 5 <> 0) AS new_records, (SELECT count(*) FROM events) AS total_transactions FROM merged"""
    everything = CENTROIDS.format(where="")
    sql["classify_batch"] = f"""WITH {everything}
SELECT doc_id, category AS predicted_category, round(p, 4) AS predicted_confidence FROM placed WHERE place = 1"""
    sql["predict_top3"] = f"""WITH {everything}
SELECT doc_id, category, round(p, 4) AS probability FROM placed WHERE place <= 3"""
    sql["classify_update"] = f"""WITH {CENTROIDS.format(where="AND doc_id % 5 <> 0")}
SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN {_key("d.category")} ELSE {_key("b.category")} END AS category_id,
  CASE WHEN doc_id % 5 = 0 OR d.category IS NULL THEN round(b.p, 4) END AS confidence
FROM docs d JOIN placed b USING (doc_id) WHERE b.place = 1"""
    sql["stratified_split"] = f"""WITH {RANKED}
SELECT doc_id, category, CASE WHEN rn <= n - round(n * 0.2) THEN 'train' ELSE 'test' END AS split FROM ranked"""
    sql["cv_folds"] = f"WITH {RANKED} SELECT doc_id, category, CAST((rn - 1) % 5 AS INTEGER) AS fold FROM ranked"
    sql["classification_report"] = """WITH p AS (
  SELECT CAST(quality AS VARCHAR) AS label, CAST(1 - toxic AS VARCHAR) AS prediction FROM labels), c AS (
  SELECT label AS class FROM p UNION SELECT prediction FROM p), m AS (
  SELECT class, (SELECT count(*) FROM p WHERE label = class AND prediction = class) AS tp,
    (SELECT count(*) FROM p WHERE label = class) AS support,
    (SELECT count(*) FROM p WHERE prediction = class) AS predicted FROM c), r AS (
  SELECT class, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS pr,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS re FROM m), s AS (
  SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f FROM r), lines AS (
  SELECT class AS name, pr, re, f, support FROM s UNION ALL
  SELECT 'macro avg', avg(pr), avg(re), avg(f), sum(support) FROM s UNION ALL
  SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support),
    sum(f * support) / sum(support), sum(support) FROM s)
SELECT name, round(pr, 4) AS precision, round(re, 4) AS recall, round(f, 4) AS f1,
  CAST(support AS BIGINT) AS support,
  (SELECT round(count(*) FILTER (label = prediction) / count(*), 4) FROM p) AS accuracy FROM lines"""
    return sql
