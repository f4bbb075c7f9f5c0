"""DuckDB SQL that computes every registered query a second way.

Money is counted in whole cents, rates in hundredths and averages in units of
1e-8, all with integer arithmetic and round-half-up division, so the expected
values are exact.  Aggregations are written in the plain form (joins on day
ranges, distinct counts, ordinary windows) that the Spark side avoids.
"""

from __future__ import annotations

import re

from oracle import values as L

AS_OF = f"DATE '{L.AS_OF}'"
FIRST_DAY, LAST_DAY = (f"(SELECT {f}(CAST(created_at AS DATE)) FROM log)" for f in ("min", "max"))


# --- small SQL builders -------------------------------------------------------------

def quote(text) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def rdiv(n: str, d: str) -> str:
    """n / d rounded half away from zero."""
    return f"(CASE WHEN ({n}) < 0 THEN -1 ELSE 1 END * ((2 * abs(({n})::HUGEINT) + ({d})) // (2 * ({d}))))"


def rate(n: str, d: str, times: int = 1) -> str:
    """times * n / d in hundredths, 0 unless d > 0."""
    return f"(CASE WHEN ({d}) > 0 THEN {rdiv(f'({n})::HUGEINT * {100 * times}', d)} ELSE 0 END)"


def pct(n: str, d: str) -> str:
    return rate(n, d, 100)


def avg8(total: str, count: str, unit: int = 1) -> str:
    """Average in 1e-8, from a total counted in 1/unit."""
    return f"(CASE WHEN ({count}) > 0 THEN {rdiv(f'({total})::HUGEINT * {10**8 // unit}', count)} END)"


def _value(v, scale: int = 1):
    return quote(v) if isinstance(v, str) else str(round(v * scale))


def ladder(expr: str, steps, rest, op: str = ">=", scale: int = 1) -> str:
    whens = " ".join(f"WHEN {expr} {op} {_value(b, scale)} THEN {_value(v)}" for b, v in steps)
    return f"CASE {whens} ELSE {_value(rest)} END"


def rules(table, rest=None, scale: dict | None = None) -> str:
    parts = []
    for conditions, label in table:
        tests = []
        for name, op, value in conditions:
            if op == "in":
                tests.append(f"{name} IN ({', '.join(quote(v) for v in value)})")
            else:
                tests.append(f"{name} {op} {_value(value, (scale or {}).get(name, 1))}")
        parts.append(f"WHEN {' AND '.join(tests)} THEN {quote(label)}")
    return f"CASE {' '.join(parts)} ELSE {'NULL' if rest is None else quote(rest)} END"


def picks(index: str, values) -> str:
    return f"[{', '.join(quote(v) for v in values)}][CAST({index} AS BIGINT) + 1]"


def date_key(d: str) -> str:
    return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"


def season(month: str) -> str:
    return "CASE " + " ".join(f"WHEN {month} IN {months} THEN {quote(n)}" for n, months in L.SEASONS) + " END"


def weekend(d: str) -> str:
    return f"CASE WHEN dayofweek({d}) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"


def lookup(key: str, pairs, rest: str) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in pairs) + f" ELSE {quote(rest)} END"


def keyword(text: str, pairs, rest: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({text}, {quote(k)}) THEN {quote(v)}" for k, v in pairs) \
        + f" ELSE {quote(rest)} END"


def tier(cents: str) -> str:
    whens = " ".join(f"WHEN {cents} BETWEEN {round(float(lo) * 100)} AND {round(float(hi) * 100)} THEN {quote(t)}"
                     for lo, hi, t in L.PRICE_TIER_RANGES)
    return f"CASE {whens} ELSE 'Budget' END"


def any_word(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {quote(w)})" for w in words) + ")"


def count_when(test: str, name: str, what: str = "1") -> str:
    return f"count(CASE WHEN {test} THEN {what} END) AS {name}"


def sum_when(test: str, what: str, name: str) -> str:
    return f"coalesce(sum(CASE WHEN {test} THEN {what} END), 0) AS {name}"


# --- building blocks: name -> (blocks it reads, SELECT) -----------------------------

BLOCKS: dict[str, tuple[list[str], str]] = {}


def block(name: str, reads: str, sql: str) -> None:
    BLOCKS[name] = (reads.split(), sql)


block("people", "", f"""
SELECT c_custkey AS id, c_name AS name, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
       n_name AS country, DATE '{L.SIGNUP_START}' + CAST((c_custkey * 7) % 730 AS INTEGER) AS signup_date,
       {lookup('r_name', L.REGION_OF.items(), 'other')} AS region
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")

block("goods", "", f"""
SELECT p_partkey AS id,
       p_name || ' ' || {picks('p_partkey % 8', L.NAME_SUFFIXES)}
         || CASE WHEN p_partkey % 5 = 0 THEN ' signature' ELSE '' END AS name,
       {picks('p_partkey % 20', L.CATEGORIES)} AS category,
       (CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 100 AS BIGINT) - 89900) * 6 AS price,
       TIMESTAMP '{L.PRODUCT_CREATED}' AS created_at
FROM part""")

block("placed", "", """
SELECT *, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_date FROM orders""")

block("lines", "goods placed", """
SELECT l_orderkey,
       l_orderkey * 1000000 + l_linenumber * 1000 + row_number() OVER (
           PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) AS id,
       CAST(l_orderkey AS VARCHAR) AS order_id, l_partkey AS product_id,
       1 + CAST(l_quantity AS INTEGER) % 6 AS quantity,
       (goods.price * (100 - CAST(CAST(l_discount AS DECIMAL(10,2)) * 100 AS BIGINT)) + 50) // 100 AS unit_price,
       order_date + to_minutes(l_linenumber) AS created_at
FROM lineitem LEFT JOIN goods ON goods.id = l_partkey LEFT JOIN placed ON o_orderkey = l_orderkey""")

block("log", "placed lines", """
SELECT o_orderkey * 10 + n AS record_id, CAST(o_orderkey AS VARCHAR) AS order_id, o_custkey AS customer_id,
       order_date, s AS status, coalesce(amount, 0) AS total_amount,
       order_date + to_days(CAST(lag_days AS INTEGER)) + to_hours(CASE n WHEN 4 THEN 6 ELSE 0 END) AS created_at
FROM (SELECT *, 1 AS n, 'pending' AS s, 0 AS lag_days FROM placed
      UNION ALL SELECT *, 4, 'items added', 0 FROM placed WHERE o_orderkey % 5 = 0
      UNION ALL SELECT *, 2, 'completed', 1 + o_orderkey % 4 FROM placed WHERE o_orderstatus = 'F'
      UNION ALL SELECT *, 2, 'cancelled', 1 + o_orderkey % 4 FROM placed WHERE o_orderstatus = 'O' AND o_orderkey % 3 = 0
      UNION ALL SELECT *, 3, 'refunded', 2 + o_orderkey % 4 + o_orderkey % 2 FROM placed
                WHERE o_orderstatus = 'F' AND o_orderkey % 12 = 0)
LEFT JOIN (SELECT l_orderkey, sum(quantity * unit_price) AS amount FROM lines GROUP BY ALL) ON l_orderkey = o_orderkey""")

block("s_customers", "people", f"""
SELECT id, name, email, signup_date, country, CAST(signup_date AS TIMESTAMP) AS created_at,
       year(signup_date) AS signup_year, month(signup_date) AS signup_month,
       dayofweek(signup_date) AS signup_day_of_week, {AS_OF} - signup_date AS customer_tenure_days, region
FROM people""")

block("s_orders", "log", """
SELECT *, row_number() OVER up AS status_sequence, row_number() OVER down = 1 AS is_current_status,
       year(created_at) AS created_year, month(created_at) AS created_month, dayofweek(created_at) AS created_day_of_week
FROM log WINDOW up AS (PARTITION BY order_id ORDER BY created_at, record_id),
                down AS (PARTITION BY order_id ORDER BY created_at DESC, record_id DESC)""")

block("s_items", "lines", f"""
SELECT id, order_id, product_id, quantity, unit_price, quantity * unit_price AS line_total, created_at,
       year(created_at) AS created_year, month(created_at) AS created_month, day(created_at) AS created_day,
       dayofweek(created_at) AS created_day_of_week, hour(created_at) AS created_hour,
       row_number() OVER (PARTITION BY order_id ORDER BY created_at, id) AS item_sequence,
       {tier('unit_price')} AS price_tier,
       CASE quantity WHEN 1 THEN 'Single Item' WHEN 2 THEN 'Pair' ELSE 'Multiple Items' END AS quantity_category,
       {ladder('quantity * unit_price', L.LINE_VALUE_TIER, L.LINE_VALUE_TIER_TOP, '<', 100)} AS line_value_tier
FROM lines""")

_GROUPS = L.GROUP_OF_CATEGORY
block("s_products", "goods", f"""
SELECT *, list_position([{', '.join(quote(g) for g in L.CATEGORY_GROUPS + ['Other'])}], category_group) AS category_sort_order
FROM (SELECT id, name, category, price, created_at, year(created_at) AS product_year, month(created_at) AS product_month,
       {tier('price')} AS price_tier, {ladder('price', L.DETAILED_PRICE_TIER, 'Budget', scale=100)} AS detailed_price_tier,
       {lookup('category', _GROUPS, 'Other')} AS category_group,
       {keyword('lower(name)', L.SEASON_KEYWORDS, 'Year-Round')} AS seasonality,
       {keyword('lower(name)', L.COLLECTION_KEYWORDS, 'Regular')} AS collection_type,
       length(name) AS name_length, {any_word('lower(name)', L.LIMITED_WORDS)} AS is_limited_edition,
       {any_word('lower(name)', L.PREMIUM_WORDS)} AS is_premium_line,
       {any_word('lower(name)', L.CLASSIC_WORDS)} AS is_classic_line, true AS is_active, false AS is_discontinued
FROM goods)""")

block("d_date", "log", f"""
SELECT {date_key('d')} AS date_key, d AS calendar_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
       day(d) AS day, dayofweek(d) AS day_of_week, dayofyear(d) AS day_of_year, weekofyear(d) AS week_of_year,
       CAST(year(d) AS VARCHAR) AS year_text, strftime(d, '%Y-%m') AS year_month,
       concat(year(d), '-', quarter(d), quarter(d)) AS year_quarter,
       rpad(monthname(d), 9, ' ') AS month_name, strftime(d, '%b') AS month_short_name,
       rpad(dayname(d), 9, ' ') AS day_name, strftime(d, '%a') AS day_short_name,
       dayofweek(d) BETWEEN 1 AND 5 AS is_weekday, dayofweek(d) IN (0, 6) AS is_weekend,
       day(d) = 1 AS is_first_day_of_month, d = last_day(d) AS is_last_day_of_month,
       d = date_trunc('quarter', d) AS is_first_day_of_quarter,
       d + 1 = date_trunc('quarter', d + 1) AS is_last_day_of_quarter,
       d = date_trunc('year', d) AS is_first_day_of_year, d + 1 = date_trunc('year', d + 1) AS is_last_day_of_year,
       CASE WHEN d = {AS_OF} THEN 'Today' WHEN d = {AS_OF} - 1 THEN 'Yesterday'
            WHEN {AS_OF} - d BETWEEN 1 AND 7 THEN 'Last 7 Days' WHEN {AS_OF} - d BETWEEN 1 AND 30 THEN 'Last 30 Days'
            WHEN datediff('month', d, {AS_OF}) = 0 THEN 'This Month' WHEN datediff('month', d, {AS_OF}) = 1 THEN 'Last Month'
            WHEN year(d) = year({AS_OF}) THEN 'This Year' WHEN year(d) + 1 = year({AS_OF}) THEN 'Last Year'
            ELSE 'Other' END AS relative_period,
       {season('month(d)')} AS season
FROM (SELECT CAST(r AS DATE) AS d FROM generate_series({FIRST_DAY}, {LAST_DAY}, INTERVAL 1 DAY) AS g(r))""")

block("d_customer", "s_customers", f"""
SELECT *, CASE WHEN tenure_quartile = 4 AND region_code IN ('NA', 'EU') THEN 'Premium Loyal'
               WHEN tenure_quartile >= 3 THEN 'Core Customer' WHEN tenure_quartile = 2 THEN 'Growing Customer'
               ELSE 'New Customer' END AS customer_segment
FROM (SELECT md5(CAST(id AS VARCHAR)) AS customer_key, id AS customer_id, name AS customer_name, email, signup_date,
             country, {lookup('region', [(r, n) for r, n, _ in L.REGION_NAMES], 'Other')} AS region,
             {lookup('region', [(r, c) for r, _, c in L.REGION_NAMES], 'Other')} AS region_code, created_at,
             customer_tenure_days,
             {ladder('customer_tenure_days', L.TENURE_SEGMENT, L.TENURE_SEGMENT_REST)} AS tenure_segment,
             {ladder('customer_tenure_days', L.TENURE_QUARTILE, 1)} AS tenure_quartile,
             signup_year, signup_month, signup_day_of_week,
             CASE WHEN dayname(signup_date) = 'Monday' THEN 'Weekend' ELSE 'Weekday' END AS signup_timing,
             {season('signup_month')} AS signup_season, customer_tenure_days >= 0 AS is_current_customer,
             {ladder('customer_tenure_days', L.CHURN_BY_TENURE, 'Low Risk', '<')} AS churn_risk_segment
      FROM s_customers)""")

block("d_product", "s_products", f"""
SELECT *, {rules(L.PRICE_POSITION_RULES, L.LOWEST_QUARTER)} AS overall_price_position
FROM (SELECT md5(CAST(id AS VARCHAR)) AS product_key, id AS product_id, name AS product_name, * EXCLUDE (id, name),
             1 AS dim_version,
             ntile(10) OVER (ORDER BY price, id) AS price_decile, ntile(4) OVER (ORDER BY price, id) AS price_quartile,
             row_number() OVER (PARTITION BY category ORDER BY price DESC, id DESC) AS price_rank_in_category,
             CASE ntile(4) OVER (PARTITION BY category ORDER BY price, id)
               WHEN 4 THEN 'Category Premium' WHEN 1 THEN 'Category Budget' ELSE 'Category Mid-Market' END AS category_position
      FROM s_products)""")

block("item_totals", "s_items", f"""
SELECT order_id, count(*) AS total_line_items, sum(quantity) AS total_quantity,
       sum(line_total) AS calculated_total_amount, {avg8('sum(unit_price)', 'count(*)', 100)} AS avg_unit_price,
       min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price,
       count(DISTINCT product_id) AS unique_products_count
FROM s_items GROUP BY order_id""")

_PARTS = " ".join(f"WHEN hour(order_date) BETWEEN {a} AND {b} THEN {quote(n)}" for n, a, b in L.DAY_PARTS)
_ORDER_EXTRAS = f"""
       {date_key('order_date')} AS order_date_key,
       {rules(L.ORDER_SIZE_RULES, 'Large Order')} AS order_size_category,
       CASE WHEN unique_products_count = total_line_items THEN 'All Unique' WHEN unique_products_count = 1
            THEN 'Single Product' ELSE 'Mixed Products' END AS product_variety,
       {', '.join(f"order_status = '{s}' AS is_{s}" for s in L.SOURCE_STATUSES)},
       year(order_date) AS order_year, month(order_date) AS order_month, quarter(order_date) AS order_quarter,
       dayofweek(order_date) AS order_day_of_week, hour(order_date) AS order_hour, {weekend('order_date')} AS order_timing,
       CASE {_PARTS} ELSE 'Night' END AS order_time_of_day,
       coalesce({avg8('order_amount', 'total_line_items', 100)}, 0) AS avg_amount_per_line,
       coalesce({avg8('order_amount', 'total_quantity', 100)}, 0) AS avg_amount_per_item"""

block("order_rows", "s_orders item_totals d_customer", """
SELECT s.* EXCLUDE (status, total_amount), s.status AS order_status, s.total_amount AS order_amount,
       coalesce(i.total_line_items, 0) AS total_line_items, coalesce(i.total_quantity, 0) AS total_quantity,
       coalesce(i.calculated_total_amount, 0) AS calculated_total_amount, i.avg_unit_price, i.min_unit_price,
       i.max_unit_price, coalesce(i.unique_products_count, 0) AS unique_products_count, c.customer_key
FROM s_orders s LEFT JOIN item_totals i USING (order_id) LEFT JOIN d_customer c ON c.customer_id = s.customer_id
WHERE s.customer_id IS NOT NULL""")

block("f_orders", "order_rows", f"""
SELECT *, md5(order_id) AS order_key, created_at AS status_updated_at, {_ORDER_EXTRAS}
FROM order_rows WHERE is_current_status""")

block("f_history", "order_rows", f"""
SELECT *, md5(order_id || '-' || status_change_sequence) AS order_key,
       {date_key('status_effective_date')} AS status_effective_date_key,
       (epoch_us(status_end_date) - epoch_us(status_effective_date)) // 36 AS status_duration_hours,
       order_status = 'items added' AS is_items_added,
       year(status_effective_date) AS status_change_year, month(status_effective_date) AS status_change_month,
       hour(status_effective_date) AS status_change_hour, {weekend('status_effective_date')} AS status_change_timing,
       CASE WHEN status_change_sequence = 1 THEN 'Initial' WHEN is_current_status THEN 'Current'
            ELSE 'Historical' END AS status_lifecycle_stage,
       CASE WHEN order_status = 'completed' AND status_change_sequence > 1
            THEN (epoch_us(status_effective_date) - epoch_us(order_date)) // 36 END AS hours_to_completion,
       CASE WHEN order_status = 'cancelled' AND status_change_sequence > 1
            THEN (epoch_us(status_effective_date) - epoch_us(order_date)) // 36 END AS hours_to_cancellation, {_ORDER_EXTRAS}
FROM (SELECT *, status_sequence AS status_change_sequence, created_at AS status_effective_date,
             lead(created_at) OVER (PARTITION BY order_id ORDER BY created_at, record_id) AS status_end_date
      FROM order_rows)""")

block("f_lines", "s_items s_orders d_customer d_product", f"""
SELECT md5(CAST(i.id AS VARCHAR)) AS order_line_key, i.id AS order_line_id, md5(i.order_id) AS order_key, c.customer_key, p.product_key,
       {date_key('o.order_date')} AS order_date_key, i.order_id, i.product_id, o.customer_id, i.quantity, i.unit_price,
       i.line_total, i.item_sequence, i.quantity_category, i.price_tier AS line_price_tier, i.line_value_tier,
       i.unit_price * (i.quantity - 1) AS additional_quantity_value, i.item_sequence = 1 AS is_first_line_item,
       o.order_date, o.status AS order_status, o.total_amount AS order_total_amount,
       coalesce({avg8('i.line_total * 100', 'o.total_amount')}, 0) AS line_percentage_of_order,
       CASE WHEN i.line_total = o.total_amount THEN 'Single Line Order' WHEN o.total_amount <= 0 THEN 'Minor Line'
            WHEN 2 * i.line_total >= o.total_amount THEN 'Dominant Line'
            WHEN 4 * i.line_total >= o.total_amount THEN 'Major Line' ELSE 'Minor Line' END AS line_importance,
       CASE WHEN i.quantity < 3 THEN i.quantity_category WHEN i.quantity <= 5 THEN 'Small Batch'
            ELSE 'Large Batch' END AS quantity_category_detailed,
       {ladder('i.unit_price', L.UNIT_PRICE_CATEGORY, L.UNIT_PRICE_CATEGORY_TOP, '<', 100)} AS unit_price_category,
       year(o.order_date) AS order_year, month(o.order_date) AS order_month, quarter(o.order_date) AS order_quarter,
       dayofweek(o.order_date) AS order_day_of_week,
       {', '.join(f"o.status = '{s}' AS is_from_{s}_order" for s in L.SOURCE_STATUSES)},
       CASE WHEN o.status = 'completed' THEN i.line_total ELSE 0 END AS recognized_revenue,
       CASE WHEN o.status = 'refunded' THEN i.line_total ELSE 0 END AS refunded_amount,
       CASE WHEN o.status IN ('completed', 'refunded') THEN i.line_total ELSE 0 END AS historical_revenue,
       i.created_at AS line_created_at
FROM s_items i JOIN s_orders o ON o.order_id = i.order_id AND o.is_current_status
JOIN d_customer c ON c.customer_id = o.customer_id JOIN d_product p ON p.product_id = i.product_id""")

# one row per order and day on which the status is visible
block("held", "f_history d_date", """
SELECT d.calendar_date AS day, f.*, CAST(status_effective_date AS DATE) = d.calendar_date AS enters
FROM f_history f JOIN d_date d ON d.calendar_date >= CAST(status_effective_date AS DATE)
 AND d.calendar_date < coalesce(CAST(status_end_date AS DATE), DATE '9999-12-31')""")

_PAID = "order_status IN ('completed', 'refunded')"
_SIZES = zip(["single_item_orders", "small_orders", "medium_orders", "large_orders"], L.ORDER_SIZES)
_KINDS = zip(["all_unique_product_orders", "single_product_orders", "mixed_product_orders"], L.VARIETIES)
block("m_orders_base", "held", f"""
SELECT day AS order_date, count(DISTINCT order_id) AS total_orders,
       {', '.join(count_when(f"order_status = '{s}'", f"{s}_orders", "order_id") for s in L.SOURCE_STATUSES)},
       {count_when("order_status = 'items added'", 'items_added_orders', 'order_id')},
       {sum_when(_PAID, 'order_amount', 'total_revenue')},
       {sum_when("order_status = 'completed'", 'order_amount', 'completed_revenue')},
       {sum_when("order_status = 'refunded'", 'order_amount', 'refunded_revenue')},
       {count_when(_PAID, 'paid')},
       quantile_cont(CASE WHEN {_PAID} THEN order_amount::DOUBLE END, 0.5) AS median_order_value,
       min(CASE WHEN {_PAID} THEN order_amount END) AS min_order_value,
       max(CASE WHEN {_PAID} THEN order_amount END) AS max_order_value,
       count(DISTINCT customer_key) AS unique_customers,
       count(DISTINCT CASE WHEN order_status = 'completed' THEN customer_key END) AS customers_with_completed_orders,
       sum(total_line_items) AS total_line_items, sum(total_quantity) AS total_quantity_sold,
       sum(unique_products_count) AS total_unique_products_ordered,
       {', '.join(count_when(f"order_size_category = {quote(v)}", n) for n, v in _SIZES)},
       {', '.join(count_when(f"product_variety = {quote(v)}", n) for n, v in _KINDS)},
       {', '.join(count_when(f"order_timing = {quote(v)}", f"{v.lower()}_orders") for v in L.TIMINGS)},
       {', '.join(count_when(f"order_time_of_day = {quote(v)}", f"{v.lower()}_orders")
                  for v in ['Morning', 'Afternoon', 'Evening', 'Night'])},
       {count_when('enters', 'daily_status_changes')},
       {count_when("enters AND order_status = 'completed'", 'daily_completions')},
       {count_when("enters AND order_status = 'cancelled'", 'daily_cancellations')},
       {count_when("enters AND order_status = 'items added'", 'daily_items_added')}
FROM held GROUP BY day""")


def over7(total: str, unit: int, digits: int) -> str:
    """7-row average of a column counted in 1/unit, in 10^-digits."""
    return rdiv(f"(sum({total}) OVER week)::HUGEINT * {10**digits // unit}", f"(count({total}) OVER week)")


_WEEK = "WINDOW dates AS (ORDER BY {0}), week AS (ORDER BY {0} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def delta(c: str) -> str:
    return f"coalesce({c} - lag({c}) OVER dates, 0)"


block("m_orders", "m_orders_base", f"""
SELECT *, {over7('total_orders', 1, 2)} AS avg_7d_total_orders, {over7('completed_orders', 1, 2)} AS avg_7d_completed_orders,
       {over7('total_revenue', 100, 2)} AS avg_7d_total_revenue,
       {over7('completed_revenue', 100, 2)} AS avg_7d_completed_revenue,
       {over7('completion_rate_pct', 100, 2)} AS avg_7d_completion_rate_pct,
       {over7('cancellation_rate_pct', 100, 2)} AS avg_7d_cancellation_rate_pct,
       {over7('daily_status_changes', 1, 2)} AS avg_7d_status_changes,
       {over7('daily_activity_rate_pct', 100, 2)} AS avg_7d_activity_rate_pct,
       {delta('total_orders')} AS total_orders_change_1d, {delta('completed_orders')} AS completed_orders_change_1d,
       {delta('total_revenue')} AS total_revenue_change_1d, {delta('completion_rate_pct')} AS completion_rate_change_1d,
       {delta('daily_status_changes')} AS status_changes_change_1d
FROM (SELECT *, {date_key('order_date')} AS date_key, year(order_date) AS year, month(order_date) AS month,
             quarter(order_date) AS quarter, dayofweek(order_date) AS day_of_week,
             strftime(order_date, '%Y-%m') AS year_month, rpad(dayname(order_date), 9, ' ') AS day_name,
             {weekend('order_date')} AS day_type, 0 AS pending_revenue, 0 AS cancelled_revenue,
             {avg8('total_revenue', 'paid', 100)} AS avg_order_value,
             {avg8('total_line_items', 'total_orders')} AS avg_line_items_per_order,
             {avg8('total_quantity_sold', 'total_orders')} AS avg_quantity_per_order,
             {pct('completed_orders', 'total_orders')} AS completion_rate_pct,
             {pct('cancelled_orders', 'total_orders')} AS cancellation_rate_pct,
             {pct('refunded_orders', 'total_orders')} AS refund_rate_pct,
             {pct('items_added_orders', 'total_orders')} AS items_added_rate_pct,
             {pct('refunded_revenue', 'completed_revenue')} AS revenue_refund_rate_pct,
             {rate('unique_customers', 'total_orders')} AS orders_per_customer_ratio,
             {pct('weekend_orders', 'total_orders')} AS weekend_order_pct,
             {pct('daily_status_changes', 'total_orders')} AS daily_activity_rate_pct,
             {pct('daily_completions', 'daily_status_changes')} AS completion_conversion_rate_pct,
             {pct('daily_cancellations', 'daily_status_changes')} AS cancellation_conversion_rate_pct
      FROM m_orders_base) {_WEEK.format('order_date')}""")

_SEGMENTS = zip(["premium_loyal_customers", "core_customers", "growing_customers", "new_customers"], L.CUSTOMER_SEGMENTS)
_REGIONS = [("na", "NA"), ("eu", "EU"), ("apac", "APAC")]
block("activity", "f_orders d_customer", f"""
SELECT CAST(o.order_date AS DATE) AS metric_date, count(DISTINCT o.customer_key) AS active_customers,
       {count_when("o.order_status = 'completed'", 'customers_with_completed_orders', 'o.customer_key').replace('count(', 'count(DISTINCT ')},
       {count_when("o.order_status = 'cancelled'", 'customers_with_cancelled_orders', 'o.customer_key').replace('count(', 'count(DISTINCT ')},
       sum(o.order_amount) AS total_customer_spend, {avg8('sum(o.order_amount)', 'count(*)', 100)} AS avg_spend_per_customer,
       max(o.order_amount) AS highest_customer_spend, {avg8('sum(o.total_line_items)', 'count(*)')} AS avg_items_per_customer,
       {avg8('sum(o.total_quantity)', 'count(*)')} AS avg_quantity_per_customer, count(*) AS total_orders_by_customers,
       {', '.join(f"count(DISTINCT CASE WHEN c.customer_segment = {quote(v)} THEN o.customer_key END) AS {n}" for n, v in _SEGMENTS)},
       {', '.join(f"count(DISTINCT CASE WHEN c.region_code = {quote(v)} THEN o.customer_key END) AS {n}_customers" for n, v in _REGIONS)},
       count(DISTINCT CASE WHEN c.region_code = 'Other' THEN o.customer_key END) AS other_region_customers
FROM f_orders o JOIN d_customer c USING (customer_key) GROUP BY 1""")

block("acquisition", "d_customer", f"""
SELECT signup_date AS metric_date, {date_key('signup_date')} AS date_key, count(*) AS new_customers_acquired,
       {', '.join(count_when(f"region_code = {quote(v)}", f"new_{n}_customers") for n, v in _REGIONS)},
       {count_when("region_code = 'Other'", 'new_other_customers')},
       {count_when("dayofweek(signup_date) IN (0, 6)", 'weekend_signups')},
       {count_when("dayofweek(signup_date) NOT IN (0, 6)", 'weekday_signups')}
FROM d_customer GROUP BY signup_date""")

_ACTIVITY = """active_customers customers_with_completed_orders customers_with_cancelled_orders
total_customer_spend avg_spend_per_customer highest_customer_spend avg_items_per_customer avg_quantity_per_customer
total_orders_by_customers premium_loyal_customers core_customers growing_customers new_customers na_customers
eu_customers apac_customers other_region_customers""".split()
_ACQUISITION = """new_customers_acquired new_na_customers new_eu_customers new_apac_customers new_other_customers
weekend_signups weekday_signups""".split()
_MTD = "month AS (PARTITION BY year_month ORDER BY metric_date ROWS UNBOUNDED PRECEDING)"
block("m_customers", "activity acquisition", f"""
SELECT *, {pct('customers_with_completed_orders', 'active_customers')} AS completion_rate_by_customers_pct,
       {rate('total_orders_by_customers', 'active_customers')} AS avg_orders_per_active_customer,
       {pct('weekend_signups', 'new_customers_acquired')} AS weekend_signup_pct,
       sum(new_customers_acquired) OVER month AS mtd_new_customers,
       sum(active_customers) OVER month AS mtd_total_active_customers,
       {over7('active_customers', 1, 8)} AS avg_active_customers_7d,
       {over7('new_customers_acquired', 1, 8)} AS avg_new_customers_7d,
       {over7('total_customer_spend', 100, 8)} AS avg_customer_spend_7d,
       lag(active_customers) OVER dates AS prev_day_active_customers,
       lag(new_customers_acquired) OVER dates AS prev_day_new_customers
FROM (SELECT *, {date_key('metric_date')} AS date_key, year(metric_date) AS metric_year, month(metric_date) AS metric_month,
             strftime(metric_date, '%Y-%m') AS year_month
      FROM (SELECT metric_date, {', '.join(f'coalesce({c}, 0) AS {c}' for c in _ACTIVITY + _ACQUISITION)}
            FROM activity FULL JOIN acquisition USING (metric_date)))
{_WEEK.format('metric_date')}, {_MTD}""")


def slug(label: str) -> str:
    return label.lower().replace("-", "")


block("m_products_base", "f_lines d_product", f"""
SELECT CAST(f.order_date AS DATE) AS metric_date, count(DISTINCT f.product_key) AS unique_products_sold,
       count(*) AS total_line_items, sum(f.quantity) AS total_quantity_sold, sum(f.line_total) AS total_product_revenue,
       {sum_when("f.order_status = 'completed'", 'f.line_total', 'completed_product_revenue')},
       {sum_when("f.order_status = 'refunded'", 'f.line_total', 'refunded_product_revenue')},
       {avg8('sum(f.unit_price)', 'count(*)', 100)} AS avg_unit_price, {avg8('sum(f.line_total)', 'count(*)', 100)} AS avg_line_total,
       quantile_cont(f.unit_price::DOUBLE, 0.5) AS median_unit_price, min(f.unit_price) AS min_unit_price,
       max(f.unit_price) AS max_unit_price,
       {', '.join(f"count(DISTINCT CASE WHEN p.category_group = {quote(g)} THEN f.product_key END) AS {slug(g)}_products_sold" for g in L.CATEGORY_GROUPS)},
       {', '.join(sum_when(f"p.category_group = {quote(g)}", 'f.line_total', f'{slug(g)}_revenue') for g in L.CATEGORY_GROUPS)},
       {', '.join(count_when(f"p.price_tier = {quote(t)}", f'{slug(t)}_items_sold') for t in L.PRICE_TIERS)},
       {', '.join(sum_when(f"p.price_tier = {quote(t)}", 'f.line_total', f'{slug(t)}_revenue') for t in L.PRICE_TIERS)},
       {', '.join(count_when(f"f.quantity_category = {quote(q)}", n) for n, q in zip(['single_item_lines', 'pair_lines', 'multiple_item_lines'], L.QUANTITY_CATEGORIES))},
       {', '.join(count_when(f"f.line_importance = {quote(v)}", n) for n, v in zip(['single_line_orders', 'dominant_lines', 'major_lines', 'minor_lines'], L.LINE_IMPORTANCES))}
FROM f_lines f JOIN d_product p USING (product_key) GROUP BY 1""")

block("m_products", "m_products_base", f"""
SELECT *, {pct('unique_products_sold', 'total_line_items')} AS product_variety_pct,
       {pct('completed_product_revenue', 'total_product_revenue')} AS revenue_completion_rate_pct,
       {pct('refunded_product_revenue', 'completed_product_revenue')} AS revenue_refund_rate_pct,
       {rate('total_quantity_sold', 'total_line_items')} AS avg_quantity_per_line,
       {', '.join(f"{pct(f'{g}_revenue', 'total_product_revenue')} AS {g}_revenue_pct" for g in ('clothing', 'accessories', 'footwear'))},
       {pct('premium_items_sold + luxury_items_sold', 'total_line_items')} AS premium_luxury_items_pct,
       {pct('premium_revenue + luxury_revenue', 'total_product_revenue')} AS premium_luxury_revenue_pct,
       sum(total_product_revenue) OVER month AS mtd_product_revenue, sum(total_quantity_sold) OVER month AS mtd_quantity_sold,
       {over7('total_product_revenue', 100, 8)} AS avg_product_revenue_7d,
       {over7('unique_products_sold', 1, 8)} AS avg_unique_products_7d,
       {over7('total_quantity_sold', 1, 8)} AS avg_quantity_sold_7d,
       lag(total_product_revenue) OVER dates AS prev_day_revenue,
       lag(unique_products_sold) OVER dates AS prev_day_unique_products,
       lag(total_quantity_sold) OVER dates AS prev_day_quantity,
       lag(total_product_revenue, 7) OVER dates AS wow_revenue, lag(unique_products_sold, 7) OVER dates AS wow_unique_products
FROM (SELECT *, {date_key('metric_date')} AS date_key, year(metric_date) AS metric_year, month(metric_date) AS metric_month,
             strftime(metric_date, '%Y-%m') AS year_month FROM m_products_base)
{_WEEK.format('metric_date')}, {_MTD}""")

# metrics that are not whole numbers, with their unit
_UNITS = {**{n: 100 for n in """total_revenue completed_revenue refunded_revenue completion_rate_pct
cancellation_rate_pct total_product_revenue clothing_revenue accessories_revenue footwear_revenue intimates_revenue
activewear_revenue total_customer_spend highest_customer_spend""".split()},
          "avg_order_value": 10**8, "avg_spend_per_customer": 10**8}
_HOMES = {"orders": ("m_orders", "order_date"), "products": ("m_products", "metric_date"),
          "customers": ("m_customers", "metric_date")}
block("long_metrics", "m_orders m_products m_customers", " UNION ALL ".join(
    f"SELECT date_key, {_HOMES[d][1]} AS metric_date, year_month, {quote(d)} AS metric_domain, {quote(m)} AS metric_name, "
    f"CAST({m} AS DOUBLE) / {_UNITS.get(m, 1)} AS metric_value, {quote(t)} AS dimension_type, {quote(v)} AS dimension_value "
    f"FROM {_HOMES[d][0]} WHERE {m} IS NOT NULL" for d, m, t, v in L.METRICS))

# (dashboard column, source expression) per side
_SIDES = {
    "c": [*[(n, n) for n in """active_customers new_customers_acquired avg_orders_per_active_customer
            premium_loyal_customers core_customers avg_active_customers_7d""".split()],
          ("customer_completion_rate_pct", "completion_rate_by_customers_pct")],
    "o": [*[(n, n) for n in """total_orders completed_orders total_revenue completed_revenue avg_order_value
            weekend_order_pct""".split()],
          ("order_completion_rate_pct", "completion_rate_pct"), ("order_cancellation_rate_pct", "cancellation_rate_pct"),
          ("order_refund_rate_pct", "refund_rate_pct"), ("ordering_customers", "unique_customers"),
          ("avg_orders_7d", "avg_7d_total_orders"), ("avg_revenue_7d", "avg_7d_total_revenue")],
    "p": [(n, n) for n in """unique_products_sold avg_unit_price product_variety_pct premium_luxury_revenue_pct
          clothing_revenue_pct accessories_revenue_pct footwear_revenue_pct""".split()],
}
# units of the columns that scores and rules compare
_SCALE = {**{n: 100 for n in """customer_acquisition_rate_pct customer_completion_rate_pct premium_core_customer_pct
overall_fulfillment_rate_pct order_cancellation_rate_pct net_revenue_success_pct revenue_per_active_customer
premium_luxury_revenue_pct customer_growth_vs_7d_avg_pct revenue_growth_vs_7d_avg_pct order_growth_vs_7d_avg_pct
customer_order_conversion_pct product_variety_pct weekend_order_pct""".split()}, "avg_order_value": 10**8}


def _score(parts) -> str:
    return "least(25, greatest(0, " + " + ".join(
        f"({ladder(c, steps, rest, op, _SCALE[c])})" for c, op, steps, rest in parts) + "))"


block("indicators", "m_customers m_orders m_products", f"""
SELECT *, {pct('new_customers_acquired', 'active_customers')} AS customer_acquisition_rate_pct,
       {rate('total_revenue', 'active_customers * 100')} AS revenue_per_active_customer,
       {rate('completed_revenue', 'ordering_customers * 100')} AS completed_revenue_per_ordering_customer,
       {rate('unique_products_sold', 'total_orders')} AS products_per_order_ratio,
       {pct('ordering_customers', 'active_customers')} AS customer_order_conversion_pct,
       {pct('premium_loyal_customers + core_customers', 'active_customers')} AS premium_core_customer_pct,
       {pct('2 * completed_revenue - total_revenue', 'total_revenue')} AS net_revenue_success_pct,
       {pct('completed_orders', 'total_orders')} AS overall_fulfillment_rate_pct,
       {pct('active_customers::HUGEINT * 100000000 - avg_active_customers_7d', 'avg_active_customers_7d')} AS customer_growth_vs_7d_avg_pct,
       {pct('total_revenue - avg_revenue_7d', 'avg_revenue_7d')} AS revenue_growth_vs_7d_avg_pct,
       {pct('total_orders * 100 - avg_orders_7d', 'avg_orders_7d')} AS order_growth_vs_7d_avg_pct
FROM (SELECT metric_date, {', '.join(f'coalesce({s}.{src}, 0) AS {out}' for s, cols in _SIDES.items() for out, src in cols)}
      FROM m_customers c FULL JOIN (SELECT *, order_date AS metric_date FROM m_orders) o USING (metric_date)
      FULL JOIN m_products p USING (metric_date))""")

block("board", "indicators", f"""
SELECT *, {ladder('business_health_score', L.HEALTH_GRADE, L.HEALTH_GRADE_REST)} AS business_health_grade,
       {rules(L.ALERT_RULES, None, _SCALE)} AS primary_alert, {rules(L.OPPORTUNITY_RULES, None, _SCALE)} AS primary_opportunity,
       {date_key('metric_date')} AS date_key, strftime(metric_date, '%Y-%m') AS year_month,
       year(metric_date) AS metric_year, month(metric_date) AS metric_month
FROM (SELECT *, {' + '.join(L.SCORES)} AS business_health_score
      FROM (SELECT *, {', '.join(f'{_score(parts)} AS {name}' for name, parts in L.SCORES.items())} FROM indicators))""")

block("trend_base", "f_orders", f"""
SELECT CAST(order_date AS DATE) AS trend_date, count(*) AS total_orders,
       {count_when("order_status = 'completed'", 'completed_orders')}, sum(order_amount) AS total_revenue,
       {sum_when("order_status = 'completed'", 'order_amount', 'completed_revenue')},
       {avg8('sum(order_amount)', 'count(*)', 100)} AS avg_order_value, count(DISTINCT customer_key) AS unique_customers,
       sum(total_line_items) AS total_line_items, {avg8('sum(total_line_items)', 'count(*)')} AS avg_items_per_order
FROM f_orders GROUP BY 1""")


def _against(value: str, average: str, unit: int, names) -> str:
    v = f"({value})::HUGEINT * {10**9 // unit}"
    return (f"CASE WHEN {v} >= 12 * {average} THEN {quote(names[0])} WHEN {v} >= 8 * {average} "
            f"THEN {quote(names[1])} ELSE {quote(names[2])} END")


_SPECIAL = " ".join(f"WHEN month(trend_date) = {m} AND day(trend_date) BETWEEN {a} AND {b} THEN {quote(n)}"
                    for m, a, b, n in L.SPECIAL_PERIODS)
block("trend_days", "trend_base", f"""
SELECT *, {ladder('daily_growth_pct', L.DAILY_TREND, L.DAILY_TREND_REST, scale=100)} AS daily_trend_pattern,
       {_against('total_orders', 'orders_7d_avg', 1, L.VS_7D_LABELS)} AS performance_vs_7d,
       {_against('completed_revenue', 'revenue_30d_avg', 100, L.VS_30D_LABELS)} AS revenue_performance
FROM (SELECT *, {pct('completed_orders', 'total_orders')} AS completion_rate_pct,
       year(trend_date) AS trend_year, month(trend_date) AS trend_month, quarter(trend_date) AS trend_quarter,
       dayofweek(trend_date) AS day_of_week, strftime(trend_date, '%Y-%m') AS year_month,
       concat(year(trend_date), '-', quarter(trend_date)) AS year_quarter,
       {over7('total_orders', 1, 8)} AS orders_7d_avg, {over7('completed_revenue', 100, 8)} AS revenue_7d_avg,
       {over7('total_orders', 1, 8).replace('week', 'month')} AS orders_30d_avg,
       {over7('completed_revenue', 100, 8).replace('week', 'month')} AS revenue_30d_avg,
       {', '.join(f"lag(total_orders, {n}) OVER dates AS prev_{u}_orders, lag(completed_revenue, {n}) OVER dates AS prev_{u}_revenue" for u, n in (('day', 1), ('week', 7), ('month', 30)))},
       {', '.join(f"{pct(f'total_orders - (lag(total_orders, {n}) OVER dates)', f'lag(total_orders, {n}) OVER dates')} AS {u}_growth_pct" for u, n in (('daily', 1), ('weekly', 7), ('monthly', 30)))},
       {season('month(trend_date)')} AS season, dayname(trend_date) AS day_name, {weekend('trend_date')} AS day_type,
       CASE {_SPECIAL} ELSE 'Regular Period' END AS special_period,
       {ladder('total_orders', L.VOLUME_TIER, L.VOLUME_TIER_REST)} AS volume_tier
      FROM trend_base {_WEEK.format('trend_date')},
           month AS (ORDER BY trend_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))""")

block("trend_months", "trend_days", f"""
SELECT *, {pct('period_orders - prev_period_orders', 'prev_period_orders')} AS period_growth_pct
FROM (SELECT *, lag(period_orders) OVER (ORDER BY trend_period) AS prev_period_orders
      FROM (SELECT year_month AS trend_period, sum(total_orders) AS period_orders, sum(completed_revenue) AS period_revenue,
                   {rdiv('sum(avg_order_value)', 'count(*)')} AS period_avg_order_value,
                   sum(unique_customers) AS period_unique_customers,
                   {avg8('sum(completion_rate_pct)', 'count(*)', 100)} AS period_completion_rate
            FROM trend_days GROUP BY 1))""")

block("trends", "trend_days trend_months", """
SELECT trend_date, 'Daily' AS period_type, CAST(trend_date AS VARCHAR) AS trend_period, total_orders AS period_orders,
       completed_revenue AS period_revenue, avg_order_value AS period_avg_order_value,
       unique_customers AS period_unique_customers, completion_rate_pct * 1000000 AS period_completion_rate,
       daily_growth_pct AS period_growth_pct, season, day_name, day_type, special_period, performance_vs_7d,
       revenue_performance, daily_trend_pattern, volume_tier, season AS seasonality_pattern
FROM trend_days
UNION ALL BY NAME
SELECT 'Monthly' AS period_type, 'Monthly' AS seasonality_pattern, * EXCLUDE (prev_period_orders) FROM trend_months""")

_SPAN = "datediff('day', {0}, {1}) - CASE WHEN CAST({1} AS TIME) < CAST({0} AS TIME) THEN 1 ELSE 0 END"
block("bought", "f_orders", f"""
SELECT customer_key, count(DISTINCT order_key) AS total_orders,
       {count_when("order_status = 'completed'", 'completed_orders')},
       count(DISTINCT date_trunc('month', order_date)) AS active_months, min(order_date) AS first_purchase_date,
       max(order_date) AS last_purchase_date,
       {_SPAN.format('min(order_date)', 'max(order_date)')} AS customer_lifespan_days,
       {_SPAN.format('max(order_date)', f'CAST({AS_OF} AS TIMESTAMP)')} AS days_since_last_purchase,
       sum(order_amount) AS total_spent, {sum_when("order_status = 'completed'", 'order_amount', 'total_completed_spent')},
       {avg8('sum(order_amount)', 'count(*)', 100)} AS avg_order_value, min(order_amount) AS min_order_value,
       max(order_amount) AS max_order_value, sum(total_line_items) AS total_items_purchased,
       {avg8('sum(total_line_items)', 'count(*)')} AS avg_items_per_order,
       {count_when("order_timing = 'Weekend'", 'weekend_orders')}, {count_when("order_timing = 'Weekday'", 'weekday_orders')},
       {', '.join(count_when(f"month(order_date) IN {months}", f"{n.lower()}_orders") for n, months in L.SEASONS)}
FROM f_orders WHERE customer_key IS NOT NULL GROUP BY customer_key""")

block("liked", "f_lines d_product", f"""
SELECT * FROM (
  SELECT f.customer_key, count(DISTINCT f.product_key) AS unique_products_purchased,
         count(DISTINCT p.category) AS unique_categories_purchased,
         count(DISTINCT p.category_group) AS unique_category_groups_purchased,
         {avg8('sum(f.unit_price)', 'count(*)', 100)} AS avg_price_preference,
         {count_when("p.price_tier IN ('Premium', 'Luxury')", 'premium_purchases')},
         {count_when('p.is_limited_edition', 'limited_edition_purchases')}, sum(f.quantity) AS total_quantity_purchased,
         {avg8('sum(f.quantity)', 'count(*)')} AS avg_quantity_per_line,
         {count_when("f.line_importance = 'Single Line Order'", 'single_line_orders')},
         {count_when("f.line_importance = 'Dominant Line'", 'dominant_line_purchases')}
  FROM f_lines f JOIN d_product p USING (product_key) WHERE f.order_status = 'completed' GROUP BY 1)
JOIN (SELECT customer_key, category_group AS preferred_category_group
      FROM (SELECT f.customer_key, p.category_group, row_number() OVER (PARTITION BY f.customer_key
                   ORDER BY count(*) DESC, p.category_group) AS place
            FROM f_lines f JOIN d_product p USING (product_key) WHERE f.order_status = 'completed' GROUP BY 1, 2)
      WHERE place = 1) USING (customer_key)""")

_B = {"purchase_frequency_monthly": 100, "avg_order_value": 10**8, "premium_preference_pct": 100,
      "product_exploration_ratio": 100, "total_completed_spent": 100}
_SEASON_TOP = " ".join(f"WHEN {s}_orders = greatest(winter_orders, spring_orders, summer_orders, fall_orders) "
                       f"THEN '{s.title()} Shopper'" for s in L.SEASON_TIE_ORDER)
block("behavior", "bought liked d_customer", f"""
SELECT *, {rules(L.PERSONA_RULES, L.PERSONA_REST, _B)} AS marketing_persona, {rules(L.CHURN_RULES, L.CHURN_REST, _B)} AS churn_risk
FROM (SELECT *, {rules(L.BEHAVIORAL_RULES, L.BEHAVIORAL_REST, _B)} AS behavioral_segment,
       {ladder('product_exploration_ratio', L.PURCHASE_PATTERN, L.PURCHASE_PATTERN_REST, scale=100)} AS purchase_pattern,
       {rules(L.ENGAGEMENT_RULES, L.ENGAGEMENT_REST, _B)} AS engagement_level,
       {ladder('total_completed_spent', L.VALUE_TIER, L.VALUE_TIER_REST, scale=100)} AS value_tier,
       {ladder('weekend_preference_pct', L.TIMING_PREFERENCE, L.TIMING_PREFERENCE_REST, scale=100)} AS timing_preference,
       {ladder('premium_preference_pct', L.PRICE_SENSITIVITY, L.PRICE_SENSITIVITY_REST, scale=100)} AS price_sensitivity,
       CASE {_SEASON_TOP} END AS seasonal_preference
  FROM (SELECT *, CASE WHEN customer_lifespan_days > 0 THEN {rate('total_orders', 'customer_lifespan_days', 30)}
                       ELSE total_orders * 100 END AS purchase_frequency_monthly,
               {rate('unique_products_purchased', 'total_orders')} AS product_exploration_ratio,
               {pct('weekend_orders', 'total_orders')} AS weekend_preference_pct,
               {pct('premium_purchases', 'unique_products_purchased')} AS premium_preference_pct
        FROM bought LEFT JOIN liked USING (customer_key)
        JOIN (SELECT customer_key, customer_id, customer_name, region, tenure_segment,
                     customer_segment AS demographic_segment FROM d_customer) USING (customer_key)))""")

block("sales", "f_lines d_product", f"""
SELECT * EXCLUDE (price, created_at), price AS catalog_price, created_at AS product_created_at,
       {pct('refunded_revenue', 'completed_revenue')} AS refund_rate_pct, {pct('completed_revenue', 'total_revenue')} AS completion_rate_pct,
       {pct('avg_selling_price', 'price * 1000000')} AS price_realization_pct,
       {AS_OF} - CAST(created_at AS DATE) AS days_since_launch,
       coalesce({avg8('completed_revenue', f'{AS_OF} - CAST(created_at AS DATE)', 100)}, 0) AS revenue_per_day_since_launch
FROM (SELECT product_key, product_id, count(*) AS total_order_lines, count(DISTINCT order_key) AS unique_orders,
             count(DISTINCT customer_key) AS unique_customers, sum(quantity) AS total_quantity_sold,
             sum(line_total) AS total_revenue,
             {', '.join(sum_when(f"order_status = '{s}'", 'line_total', f'{s}_revenue') for s in ('completed', 'refunded', 'cancelled'))},
             {avg8('sum(line_total)', 'count(*)', 100)} AS avg_line_value, {avg8('sum(unit_price)', 'count(*)', 100)} AS avg_selling_price,
             {avg8('sum(quantity)', 'count(*)')} AS avg_quantity_per_line,
             {rdiv('sum(line_percentage_of_order)', 'count(*)')} AS avg_order_contribution_pct,
             {', '.join(count_when(f"line_importance = {quote(v)}", n) for n, v in zip(['single_line_orders', 'dominant_lines', 'major_lines', 'minor_lines'], L.LINE_IMPORTANCES))},
             min(order_date) AS first_sale_date, max(order_date) AS last_sale_date,
             count(DISTINCT order_date_key) AS selling_days, {count_when('is_first_line_item', 'times_first_in_order')},
             {avg8('sum(item_sequence)', 'count(*)')} AS avg_position_in_order
      FROM f_lines GROUP BY 1, 2)
JOIN (SELECT product_key, product_name, category, category_group, price, price_tier, detailed_price_tier, price_decile,
             price_quartile, category_position, is_active, is_limited_edition, is_premium_line, is_classic_line,
             created_at FROM d_product) USING (product_key)""")


def _rank(measure: str, scope: str = "") -> str:
    part = f"PARTITION BY {scope} " if scope else ""
    return f"row_number() OVER ({part}ORDER BY {measure} DESC, product_id DESC)"


_MIX = " ".join(f"WHEN 10 * {c} >= {tenths} * total_order_lines THEN {quote(n)}" for c, tenths, n in L.PURCHASE_BEHAVIOR)
block("performance", "sales", f"""
SELECT *, {rules(L.PERFORMANCE_RULES, L.PERFORMANCE_REST)} AS performance_tier,
       {rules(L.CONTRIBUTION_RULES, L.LOWEST_QUARTER)} AS revenue_contribution_tier,
       {ladder('customer_reach_quartile', L.PENETRATION, L.PENETRATION_REST)} AS customer_penetration_tier,
       {ladder('days_since_launch', L.LIFECYCLE, L.LIFECYCLE_REST, '<=')} AS lifecycle_stage,
       {ladder('price_realization_pct', L.PRICING_STRATEGY, L.PRICING_STRATEGY_REST, scale=100)} AS pricing_strategy,
       CASE {_MIX} ELSE 'Add-On Item' END AS purchase_behavior
FROM (SELECT *, {_rank('completed_revenue')} AS revenue_rank_overall,
             {_rank('completed_revenue', 'category_group')} AS revenue_rank_in_category,
             {_rank('completed_revenue', 'price_tier')} AS revenue_rank_in_price_tier,
             {_rank('total_quantity_sold')} AS volume_rank_overall,
             {_rank('total_quantity_sold', 'category_group')} AS volume_rank_in_category,
             {_rank('unique_customers')} AS customer_reach_rank,
             {_rank('unique_customers', 'category_group')} AS customer_reach_rank_in_category,
             ntile(10) OVER (ORDER BY completed_revenue, product_id) AS revenue_decile,
             ntile(4) OVER (ORDER BY completed_revenue, product_id) AS revenue_quartile,
             ntile(10) OVER (ORDER BY total_quantity_sold, product_id) AS volume_decile,
             ntile(4) OVER (ORDER BY unique_customers, product_id) AS customer_reach_quartile
      FROM sales)""")


def compose(select: str, *reads: str) -> str:
    """WITH clause of all blocks that ``reads`` needs, then ``select``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in BLOCKS[name][0]:
                visit(needed)
            order.append(name)

    for name in reads:
        visit(name)
    parts = [f"{name} AS ({BLOCKS[name][1]})" for name in order]
    return f"WITH {', '.join(parts)} {select}"


def early_blocks(name: str, loaded_until: str, as_of: str) -> str:
    """Blocks of ``name`` over the source rows created up to ``loaded_until``, as seen on ``as_of``; returns its name."""
    sources = {"people": "CAST(signup_date AS TIMESTAMP)", "goods": "created_at", "lines": "created_at", "log": "created_at"}
    for source, created in sources.items():
        block(f"early_{source}", source, f"SELECT * FROM {source} WHERE {created} <= {loaded_until}")
    whole = {"d_date", "placed"}       # the calendar is that of all rows

    def visit(n: str) -> str:
        if n in whole:
            return n
        early = f"early_{n}"
        if early not in BLOCKS:
            reads, sql = BLOCKS[n]
            for needed in reads:
                replaced = visit(needed)
                sql = re.sub(rf"(?<=FROM |JOIN ){needed}\b", replaced, sql)
            BLOCKS[early] = ([visit(r) for r in reads], sql.replace(AS_OF, as_of))
        return early

    return visit(name)


def columns(spec: str) -> str:
    """``name:kind`` items as a select list.

    Kinds: none as is, i whole number, m cents or hundredths, a 1e-8, with ``old>new`` to rename.
    """
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        source, _, target = name.partition(">")
        target = target or source
        cast = {"": source, "i": f"CAST({source} AS BIGINT)", "m": f"CAST({source} AS DOUBLE) / 100",
                "a": f"CAST({source} AS DOUBLE) / 100000000"}[kind]
        out.append(f"{cast} AS {target}")
    return ", ".join(out)
