"""The registered queries as SQL for DuckDB, over the same parquet tables."""

_CLEAN = """
clean AS (
  SELECT e.event_id,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
         e.event_type,
         TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id,
         CAST(p.p_size AS BIGINT) AS category_id,
         lower(p.p_type) AS category_code,
         lower(p.p_brand) AS brand,
         e.value AS price,
         e.user_id,
         CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d') AS user_session
  FROM events e
  LEFT JOIN part p ON TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey
)"""

_DIRTY = (
    _CLEAN
    + """,
dirty AS (
  SELECT event_id,
         CASE event_id % 31 WHEN 0 THEN '2024-02-30 00:00:00 UTC' WHEN 1 THEN 'garbage'
              ELSE event_time END AS event_time,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE event_type END AS event_type,
         product_id, category_id, category_code,
         CASE event_id % 20 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
              ELSE brand END AS brand,
         CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DOUBLE) WHEN 2 THEN -price
              WHEN 3 THEN CAST('NaN' AS DOUBLE) WHEN 4 THEN price + CAST(0.005 AS DOUBLE) ELSE price END AS price,
         user_id, user_session
  FROM clean
)"""
)

_DAY = "try_cast(substr(event_time, 1, 10) AS DATE)"
_VALID = "CASE WHEN price > 0 AND NOT isnan(price) THEN price END"
_NONBLANK = r"regexp_replace(brand, '^\s+|\s+$', '', 'g') <> ''"
_HUNDRED = "CAST(100 AS DOUBLE)"


def _amount(price: str) -> str:
    """A price with eight places, exactly; NULL and NaN add nothing."""
    return f"CASE WHEN NOT isnan({price}) THEN CAST({price} AS DECIMAL(26, 8)) END"


def _nan_if_any(price: str, value: str) -> str:
    """One NaN makes the result NaN."""
    return f"CASE WHEN bool_or(isnan({price})) THEN CAST('NaN' AS DOUBLE) ELSE {value} END"


def _sum(price: str) -> str:
    """An exact sum, rounded half-up to cents."""
    return _nan_if_any(price, f"CAST(round(sum({_amount(price)}), 2) AS DOUBLE)")


def _mean(price: str) -> str:
    """An exact mean, rounded half-up to cents, by whole numbers of 10^-8."""
    total, count = f"CAST(sum({_amount(price)}) * 100000000 AS HUGEINT)", f"count({price})"
    units = f"(2 * abs({total}) + 1000000 * {count}) // nullif(2000000 * {count}, 0)"
    return _nan_if_any(price, f"sign({total}) * {units} / {_HUNDRED}")


def _clean(sql: str) -> str:
    return f"WITH {_CLEAN}\n{sql}"


def _dirty(sql: str) -> str:
    return f"WITH {_DIRTY}\n{sql}"


def _distribution(table: str) -> str:
    return f"""
SELECT event_type, count(*) AS event_count,
       round(count(*) * {_HUNDRED} / (SELECT count(*) FROM {table}), 2) AS pct_of_total
FROM {table} GROUP BY event_type"""


def _daily(table: str) -> str:
    return f"""
SELECT {_DAY} AS event_date, count(*) AS num_purchases,
       {_sum("price")} AS total_revenue, {_mean("price")} AS avg_order_value
FROM {table} WHERE event_type = 'purchase' GROUP BY 1"""


def _top_brands(table: str) -> str:
    return f"""
SELECT brand, {_sum("price")} AS estimated_revenue, count(*) AS num_purchases
FROM {table} WHERE event_type = 'purchase' AND brand IS NOT NULL AND brand <> ''
GROUP BY brand ORDER BY estimated_revenue DESC, brand LIMIT 10"""


def _valid_daily() -> str:
    return f"""
SELECT {_DAY} AS event_date, count(*) AS num_purchase_events,
       {_sum(_VALID)} AS estimated_revenue, {_mean(_VALID)} AS avg_purchase_event_value
FROM dirty WHERE event_type = 'purchase' AND {_DAY} IS NOT NULL GROUP BY 1"""


def _valid_top_brands() -> str:
    return f"""
SELECT brand, {_sum(_VALID)} AS estimated_revenue, count(*) AS num_purchase_events,
       {_mean(_VALID)} AS avg_purchase_event_value
FROM dirty WHERE event_type = 'purchase' AND {_NONBLANK}
GROUP BY brand ORDER BY estimated_revenue DESC NULLS LAST, brand LIMIT 10"""


def _parts(price: str, prefix: str) -> str:
    whole = f"(abs({price}) < 1e13 AND round({price} * 100) / 100 = {price})"
    return f"""count({price}) AS {prefix}_priced,
       CAST(sum(CASE WHEN {whole} THEN CAST(round({price} * 100) AS BIGINT) END) AS DECIMAL(28, 0)) AS {prefix}_cents,
       CAST(sum(CASE WHEN NOT {whole} AND abs({price}) < 1e18 THEN CAST({price} AS DECIMAL(26, 8)) END)
         AS DECIMAL(36, 8)) AS {prefix}_other,
       CAST(sum(CASE WHEN abs({price}) >= 1e18 THEN {price} / pow(2, 64) END) AS DOUBLE) AS {prefix}_beyond"""


def _rollup(table: str) -> str:
    return f"""
SELECT event_type, {_DAY} AS event_date, brand, count(*) AS event_count,
       {_parts("price", "price")}, {_parts(f"({_VALID})", "valid")}
FROM {table} GROUP BY 1, 2, 3"""


def _price_mix(table: str) -> str:
    return f"""
SELECT brand, count(*) AS num_purchases, {_sum("price")} AS estimated_revenue, {_mean("price")} AS avg_selling_price
FROM {table} WHERE event_type = 'purchase' AND brand IS NOT NULL AND brand <> '' GROUP BY brand"""


_FIRST_HALF = "(SELECT * FROM clean ORDER BY event_id LIMIT (SELECT count(*) // 2 FROM events))"

def _quartiles(table: str) -> str:
    return f"""
SELECT brand, count(*) AS num_priced, round(quantile_cont(price, 0.25), 6) AS low,
       round(quantile_cont(price, 0.5), 6) AS middle, round(quantile_cont(price, 0.75), 6) AS high
FROM (SELECT brand, {_VALID} AS price FROM {table} WHERE event_type = 'purchase' AND brand IS NOT NULL AND brand <> '')
WHERE price IS NOT NULL GROUP BY brand"""


_CONVERSION = """
SELECT v AS num_views, p AS num_purchases,
       CAST(p AS DOUBLE) / nullif(v, 0) AS conversion_rate,
       CAST(v AS DOUBLE) / nullif(p, 0) AS views_per_purchase
FROM (SELECT count(*) FILTER (event_type = 'view') AS v,
             count(*) FILTER (event_type = 'purchase') AS p FROM clean)"""

_COLUMNS = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"


def _missing(table: str, where: str = "true", by: str | None = None) -> str:
    """Days between the first and the last of a group that it lacks."""
    group = by or "1"
    return f"""
, days AS (SELECT DISTINCT {group} AS g, {_DAY} AS d FROM {table} WHERE {where} AND {_DAY} IS NOT NULL),
every AS (SELECT g, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT g, min(d) AS first, max(d) AS last FROM days GROUP BY g))
SELECT {f"e.g AS {by}, " if by else ""}e.d AS event_date
FROM every e WHERE NOT EXISTS (SELECT 1 FROM days x WHERE x.g = e.g AND x.d = e.d)"""


def oracle_sql() -> dict[str, str]:
    return {
        "event_distribution": _clean(_distribution("clean")),
        "daily_purchase_revenue": _clean(_daily("clean")),
        "top10_brands": _clean(_top_brands("clean")),
        "event_distribution_nulls": _dirty(_distribution("dirty")),
        "daily_purchase_revenue_valid": _dirty(_valid_daily()),
        "top10_brands_valid": _dirty(_valid_top_brands()),
        "event_date_projection": _dirty(
            f"SELECT event_id, substr(event_time, 1, 10) AS event_date_text, {_DAY} AS event_date FROM dirty"
        ),
        "valid_price_projection": _dirty(
            f"SELECT event_id, price, {_VALID} AS valid_price FROM dirty"
        ),
        "purchase_filter": _dirty(
            "SELECT event_id, event_time, event_type, price FROM dirty WHERE event_type = 'purchase'"
        ),
        "branded_filter": _dirty(
            "SELECT event_id, brand, price FROM dirty WHERE brand IS NOT NULL AND brand <> ''"
        ),
        "nonblank_brand_filter": _dirty(
            f"SELECT event_id, brand, price FROM dirty WHERE {_NONBLANK}"
        ),
        "total_events": _clean("SELECT count(*) AS total_events FROM clean"),
        "clickstream_view": _clean("SELECT * FROM clean"),
        "damaged_clickstream_view": _dirty("SELECT * FROM dirty"),
        "first_n_event_distribution": _clean(
            "SELECT event_type, count(*) AS event_count,"
            f" round(count(*) * {_HUNDRED} / 500, 2) AS pct_of_total"
            " FROM (SELECT * FROM clean ORDER BY event_id LIMIT 500) GROUP BY event_type"
        ),
        "event_rollup": _clean(_rollup("clean")),
        "event_rollup_damaged": _dirty(_rollup("dirty")),
        "q1_from_rollup": _clean(_distribution("clean")),
        "q2_from_rollup": _clean(_daily("clean")),
        "q3_from_rollup": _clean(_top_brands("clean")),
        "valid_daily_from_rollup": _dirty(_valid_daily()),
        "valid_top10_brands_from_rollup": _dirty(_valid_top_brands()),
        "daily_purchase_revenue_damaged": _dirty(_daily("dirty")),
        "conversion_rate_from_rollup": _clean(_CONVERSION),
        "csv_round_trip": _clean(f"SELECT {_COLUMNS} FROM clean"),
        # An empty brand field reads as NULL.
        "csv_round_trip_damaged": _dirty(f"SELECT * REPLACE (nullif(brand, '') AS brand) FROM (SELECT {_COLUMNS} FROM dirty)"),
        "csv_rejected_lines": _dirty(
            "SELECT event_time, user_id, CAST(NULL AS BIGINT) AS product_id, 'x' AS product_text"
            " FROM dirty WHERE event_id % 37 = 0"
        ),
        "staged_in_file_order": _clean(
            f"SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_id, event_type, {_DAY} AS event_date, brand, price FROM clean"
        ),
        "stored_rollup": _clean(_rollup("clean")),
        "growing_rollup": _clean(_rollup("clean")),
        "report_input_rows": _dirty(
            "SELECT count(*) AS total_rows, count(*) FILTER (event_id % 37 = 0) AS rejected_rows FROM dirty"
        ),
        "recursive_csv_events": _clean(
            f"SELECT {_DAY} AS event_date, count(*) AS events, count(brand) AS branded FROM clean GROUP BY 1"
        ),
        "csv_rejected_rows": _dirty(
            "SELECT count(*) AS total_rows, count(*) FILTER (event_id % 37 = 0) AS rejected_rows FROM dirty"
        ),
        "result_round_trip": _dirty("""
SELECT brand, count(*) AS events, max(event_time) AS last_time
FROM (SELECT event_time, CASE WHEN event_id % 20 = 3 THEN ' ' || brand || ' ' ELSE brand END AS brand FROM dirty)
GROUP BY brand"""),
        "staged_events": _clean(
            f"SELECT event_type, {_DAY} AS event_date, brand, price,"
            f" CAST(row_number() OVER (PARTITION BY {_DAY} ORDER BY event_id) AS INTEGER) AS place_in_day FROM clean"
        ),
        "scalability_run": """
SELECT least(total * pct // 100, total) AS rows, true AS completed, true AS timed
FROM (SELECT count(*) AS total FROM events), (SELECT unnest([1, 10, 50, 100, 200]) AS pct)""",
        "timing_table": """
SELECT least(total * pct // 100, total) AS rows, true AS completed, true AS timed
FROM (SELECT count(*) AS total FROM events), (SELECT unnest([1, 10, 50, 100, 200]) AS pct)""",
        "whole_samples": """
SELECT total * pct // 100 AS requested_rows, total * pct // 100 AS rows, true AS completed
FROM (SELECT count(*) AS total FROM events), (SELECT unnest([1, 10, 50, 100]) AS pct)""",
        "largest_whole_sample": "SELECT count(*) AS largest_rows FROM events",
        "largest_sample": _clean(_daily(_FIRST_HALF)),
        "largest_sample_distribution": _clean(_distribution(_FIRST_HALF)),
        "largest_sample_top10_brands": _clean(_top_brands(_FIRST_HALF)),
        "scalability_rows": """
SELECT requested_rows, least(requested_rows, total) AS rows, true AS completed
FROM (SELECT count(*) AS total FROM events),
     (SELECT unnest([1, 10, 50, 100, 200]) AS pct),
     LATERAL (SELECT total * pct // 100 AS requested_rows)""",
        "largest_completed": "SELECT count(*) AS largest_rows FROM events",
        "conversion_rate": _clean(_CONVERSION),
        "missing_days": _clean(_missing("clean")),
        "missing_days_by_brand": _clean(
            _missing("clean", "event_type = 'purchase' AND brand IS NOT NULL AND brand <> ''", "brand")
        ),
        "daily_spikes": _clean(f"""
, daily AS ({_daily("clean")}),
rated AS (SELECT event_date, num_purchases, total_revenue,
                 round(total_revenue / nullif((SELECT median(total_revenue) FROM daily), 0), 4) AS times_median
          FROM daily WHERE event_date IS NOT NULL)
SELECT * FROM rated WHERE times_median >= 1.1"""),
        "typical_day": _clean(f"""
, daily AS ({_daily("clean")}),
long AS (SELECT 'num_purchases' AS measure, CAST(num_purchases AS DOUBLE) AS v FROM daily
         UNION ALL SELECT 'total_revenue', total_revenue FROM daily
         UNION ALL SELECT 'avg_order_value', avg_order_value FROM daily)
SELECT measure, round(quantile_cont(v, 0.25), 4) AS low, round(quantile_cont(v, 0.5), 4) AS middle,
       round(quantile_cont(v, 0.75), 4) AS high
FROM long GROUP BY measure"""),
        "brand_price_mix": _clean(_price_mix("clean")),
        "brand_price_quartiles": _clean(_quartiles("clean")),
        "brand_price_quartiles_damaged": _dirty(_quartiles("dirty")),
        "brand_price_mix_from_rollup": _clean(_price_mix("clean")),
    }
