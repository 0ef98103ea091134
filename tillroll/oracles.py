"""SQL counterparts of the registered queries, for a second engine over the same tables.

Written against the tables directly and, where possible, in another form than the Spark
side: DISTINCT ON, windows over raw rows, quantile_cont, correlated lookups.
"""

from tillroll.constants import (
    CALENDAR_COMMENTS, REVENUE_SEGMENTS, SERVICE_LEVELS, SKEW_NORMAL, SKEW_WARNING,
    STOCK_OK, STOCK_SHORTAGE, STOCK_SURPLUS, WEEKDAY_SEGMENTS, Z_BY_SERVICE_LEVEL,
)


def _round(x: str, n: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {n}) AS DOUBLE)"


def _ratio(a: str, b: str, n: int = 2, scale: int = 1) -> str:
    return _round(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0) * {scale}.0", n)


def _pct(a: str, b: str, n: int = 2) -> str:
    return _ratio(a, b, n, 100)


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _int(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _day(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _lines(product: str = "p_type") -> str:
    """CTE `s`: line-grain sales."""
    return f"""s AS (
        SELECT l_orderkey AS tx, o_custkey AS cust, CAST(o_orderdate AS DATE) AS d,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
               o_orderpriority AS pay, {product} AS item
        FROM orders, lineitem, part WHERE o_orderkey = l_orderkey AND l_partkey = p_partkey)"""


_TX = "t AS (SELECT DISTINCT ON (tx) tx, cust, d, total, pay FROM s ORDER BY tx)"

_PART = """CASE WHEN CAST(ts AS TIME) >= '08:00:00' AND CAST(ts AS TIME) < '11:00:00' THEN 'Morning'
    WHEN CAST(ts AS TIME) >= '11:00:00' AND CAST(ts AS TIME) < '16:00:00' THEN 'Afternoon'
    WHEN CAST(ts AS TIME) >= '16:00:00' AND CAST(ts AS TIME) <= '20:00:00' THEN 'Evening'
    ELSE 'Outside hours' END"""

# CTE `s`: line-grain event sales stamped with the receipt's first event.
_EVENTS = f"""raw AS (
        SELECT user_id AS cust, CAST(ts AS DATE) AS d, ts AS t0, event_type AS item,
               CAST(value AS DECIMAL(18,2)) AS price FROM events),
    stamped AS (
        SELECT cust, d, item, price, CAST(cust AS VARCHAR) || '|' || CAST(d AS VARCHAR) AS tx,
               MIN(t0) OVER (PARTITION BY cust, d) AS ts,
               CAST(SUM(price) OVER (PARTITION BY cust, d) AS DECIMAL(18,2)) AS total FROM raw),
    s AS (SELECT *, {_PART} AS part, dayname(d) AS dn, isodow(d) AS dow, isodow(d) >= 6 AS we FROM stamped)"""
_EVENT_TX = "t AS (SELECT DISTINCT ON (tx) tx, cust, d, ts, total, part, dn, dow, we FROM s ORDER BY tx)"


def _segment(names: list[str], col: str = "ts") -> str:
    return f"""CASE WHEN CAST({col} AS TIME) >= '17:00:00' THEN '{names[2]}'
        WHEN CAST({col} AS TIME) >= '14:00:00' THEN '{names[1]}'
        WHEN CAST({col} AS TIME) >= '11:00:00' THEN '{names[0]}' END"""


# CTE `r`: lines as receipts with differing totals and dates.
_RAW = """r AS (SELECT l_orderkey AS transaction_id, CAST(l_shipdate AS DATE) AS sale_date,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS total_cost FROM lineitem)"""

# CTE `p`: sales of products by shipping time.
_SOLD = """p AS (SELECT l_orderkey AS sale_id, l_partkey AS product_id, l_shipdate AS sold_at,
        CAST(l_quantity AS DECIMAL(18,2)) AS quantity FROM lineitem)"""
_SOLD_DAYS = """pd AS (SELECT product_id, CAST(sold_at AS DATE) AS d, SUM(quantity) AS q FROM p GROUP BY ALL)"""

_RETURNS = """o AS (SELECT p_type AS category, p_brand AS brand, CAST(l_shipdate AS DATE) AS day,
        CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'delivered' ELSE 'in_transit' END AS status
        FROM lineitem JOIN part ON p_partkey = l_partkey)"""

# CTE `g`: events whose value and kind are unknown for errors.
_GAPS = """g AS (SELECT event_id, user_id, ts,
        CASE WHEN event_type <> 'error' THEN event_type END AS kind,
        CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) END AS value FROM events)"""


def _summary(count: str, revenue: str, avg: str) -> str:
    return f"COUNT(*) AS {count}, {_dbl('SUM(total)')} AS {revenue}, {_ratio('SUM(total)', 'COUNT(*)')} AS {avg}"


def _q(x: str, p: float, n: int = 4) -> str:
    return _round(f"quantile_cont(CAST({x} AS DOUBLE), {p})", n)


def _receipt_queries() -> dict[str, str]:
    base = f"WITH {_lines()}, {_TX}"
    brand = f"WITH {_lines('p_brand')}"
    events = f"WITH {_EVENTS}, {_EVENT_TX}"
    skew = f"""m AS (SELECT {_ratio('SUM(total)', 'COUNT(*)')} AS a, {_q('total', 0.5, 2)} AS b, COUNT(*) AS n FROM t)
        SELECT a AS avg_check, b AS median_check, {_round('a - b')} AS avg_median_diff,
               {_pct('a - b', 'b')} AS diff_percent, n AS n_transactions,
               CASE WHEN abs(a - b) > b * 0.5 THEN '{SKEW_WARNING}' ELSE '{SKEW_NORMAL}' END AS data_quality_note FROM m"""
    sizes = f"""z AS (SELECT tx, COUNT(*) AS n_items, MAX(total) AS total FROM s GROUP BY tx)"""
    order_sizes = f"""SELECT n_items, COUNT(*) AS order_count, {_ratio('SUM(total)', 'COUNT(*)')} AS avg_check,
        {_q('total', 0.5, 2)} AS median_check, {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percent,
        {_pct('SUM(total)', 'SUM(SUM(total)) OVER ()')} AS revenue_share,
        {_pct('SUM(COUNT(*)) OVER (ORDER BY n_items)', 'SUM(COUNT(*)) OVER ()')} AS cumulative_percent
        FROM z GROUP BY n_items"""
    fence = "quantile_cont(CAST(total AS DOUBLE), 0.75) + 1.5 * (quantile_cont(CAST(total AS DOUBLE), 0.75) - quantile_cont(CAST(total AS DOUBLE), 0.25))"
    return {
        "business_totals": f"{base} SELECT {_summary('total_orders', 'total_revenue', 'avg_ticket')} FROM t",
        "kpi_distinct": f"{base}, k AS (SELECT DISTINCT tx, total FROM s) SELECT {_summary('transactions', 'total_revenue', 'avg_ticket')} FROM k",
        "kpi_summary": f"""{base}, l AS (SELECT tx, SUM(price) AS x FROM s GROUP BY tx)
            SELECT (SELECT {_dbl('SUM(total)')} FROM t) AS total_revenue, (SELECT COUNT(DISTINCT tx) FROM s) AS transactions,
                   {_ratio('SUM(x)', 'COUNT(*)')} AS avg_ticket FROM l""",
        "by_day_name": f"{base} SELECT dayname(d) AS day_name, {_summary('total_orders', 'revenue', 'avg_ticket')} FROM t GROUP BY 1",
        "weekday_vs_weekend": f"{base} SELECT isodow(d) IN (6, 7) AS is_weekend, {_summary('total_orders', 'revenue', 'avg_ticket')} FROM t GROUP BY 1",
        "drink_popularity": f"""{brand} SELECT item AS coffee_name, COUNT(*) AS drinks_sold, {_dbl('SUM(price)')} AS revenue
            FROM s GROUP BY 1 ORDER BY SUM(price) DESC, 1 LIMIT 8""",
        "by_time_of_day": f"{events} SELECT part AS time_of_day, {_summary('total_orders', 'total_revenue', 'avg_ticket')} FROM t GROUP BY 1",
        "by_time_of_day_all_parts": f"""{events} SELECT v.part AS time_of_day, COUNT(tx) AS total_orders,
            {_dbl('COALESCE(SUM(total), 0)')} AS total_revenue, COALESCE({_ratio('SUM(total)', 'COUNT(tx)')}, 0) AS avg_ticket
            FROM (VALUES ('Morning'), ('Afternoon'), ('Evening'), ('Outside hours')) v(part) LEFT JOIN t USING (part) GROUP BY 1""",
        "by_hour_tx": f"{events} SELECT hour(ts) AS hour, {_summary('num_tx', 'total_revenue', 'avg_check')} FROM t GROUP BY 1",
        "avg_items_per_order": f"{base} SELECT {_ratio('(SELECT COUNT(*) FROM s)', 'COUNT(*)')} AS avg_drinks_per_order FROM t",
        "top3_revenue_share": f"""{brand}, x AS (SELECT item, SUM(price) AS rev, RANK() OVER (ORDER BY SUM(price) DESC) AS k FROM s GROUP BY 1)
            SELECT CASE WHEN k <= 3 THEN item ELSE 'other' END AS category, {_dbl('SUM(rev)')} AS revenue,
                   {_pct('SUM(rev)', 'SUM(SUM(rev)) OVER ()')} AS share_percent FROM x GROUP BY 1""",
        "payment_mix": f"""{base} SELECT pay AS payment_method, COUNT(*) AS total_orders, {_dbl('SUM(total)')} AS revenue,
            {_pct('SUM(total)', 'SUM(SUM(total)) OVER ()')} AS percent_of_total FROM t GROUP BY 1""",
        "basket_size": f"WITH {_lines()}, {sizes} {order_sizes}",
        "order_size_distribution": f"""WITH {_lines()}, {sizes}, w AS ({order_sizes})
            SELECT n_items, order_count AS orders_count, percent, cumulative_percent FROM w""",
        "top_customers": f"""{base} SELECT cust AS customer_id, {_dbl('SUM(total)')} AS total_spent, COUNT(*) AS num_transactions,
            {_ratio('SUM(total)', 'COUNT(*)')} AS avg_check FROM t GROUP BY 1 ORDER BY SUM(total) DESC, 1 LIMIT 10""",
        "check_distribution": f"""{base} SELECT {_q('total', 0.25)} AS q1, {_q('total', 0.5)} AS median, {_q('total', 0.75)} AS q3,
            {_round('quantile_cont(CAST(total AS DOUBLE), 0.75) - quantile_cont(CAST(total AS DOUBLE), 0.25)', 4)} AS iqr,
            {_round(fence, 4)} AS upper_bound, {_dbl('MAX(total)')} AS max_amount FROM t""",
        "outlier_receipts": f"""{events}, f AS (SELECT {fence} AS hi FROM t)
            SELECT tx AS transaction_id, {_dbl('MAX(total)')} AS check_amount, COUNT(*) AS items_count,
                   STRING_AGG(item, ', ' ORDER BY item) AS items_list, {_day('MIN(d)')} AS sale_date, MIN(part) AS time_of_day,
                   {_round('MIN(hi)', 0)} AS upper_bound FROM s, f WHERE total > hi GROUP BY tx""",
        "outlier_receipt_items": f"""{events}, f AS (SELECT {fence} AS hi FROM t),
            n AS (SELECT tx, item, ROW_NUMBER() OVER (PARTITION BY tx ORDER BY item) - 1 AS place FROM s, f WHERE total > hi AND item IS NOT NULL)
            SELECT tx AS transaction_id, place // 3 AS piece, COUNT(*) AS items_count, STRING_AGG(item, ', ' ORDER BY item) AS items_list
            FROM n GROUP BY ALL""",
        "menu_engineering": f"""{brand} SELECT item AS coffee_name, {_dbl('SUM(price)')} AS revenue, COUNT(*) AS quantity,
            COUNT(DISTINCT tx) AS transactions FROM s GROUP BY 1 ORDER BY SUM(price) DESC, 1 LIMIT 10""",
        "check_skew_note": f"{base}, {skew}",
        "check_skew_note_events": f"{events}, {skew}",
        "order_size_stats": f"""WITH {_lines()}, z AS (SELECT COUNT(*) AS n FROM s GROUP BY tx)
            SELECT COUNT(*) AS orders, MIN(n) AS min_size, MAX(n) AS max_size, {_ratio('SUM(n)', 'COUNT(*)')} AS mean_size,
                   {_q('n', 0.5)} AS median_size, (SELECT n FROM z GROUP BY n ORDER BY COUNT(*) DESC, n LIMIT 1) AS mode_size,
                   {_pct('COUNT(*) FILTER (WHERE n = 1)', 'COUNT(*)', 1)} AS single_percent FROM z""",
        "receipt_box": f"""{events}, f AS (SELECT {_round(fence, 4)} AS hi FROM t)
            SELECT {_q('total', 0.25)} AS q1, {_q('total', 0.5)} AS median, {_q('total', 0.75)} AS q3, MIN(hi) AS upper_fence,
                   COUNT(*) FILTER (WHERE total > hi) AS n_outliers, COUNT(*) AS n_receipts, {_dbl('MAX(total)')} AS max_receipt
            FROM t, f""",
        "sql_text_query": f"""WITH {_lines()} SELECT pay AS payment_method, COUNT(DISTINCT tx) AS orders,
            {_dbl('SUM(price)')} AS line_revenue FROM s GROUP BY 1""",
    }


def _product_queries() -> dict[str, str]:
    def abc(product: str, a: float, b: float, columns: str) -> str:
        return f"""WITH {_lines(product)}, x AS (SELECT item, SUM(price) AS rev FROM s GROUP BY 1 HAVING SUM(price) > 0),
            y AS (SELECT item, rev, CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) AS sh,
                  CAST(SUM(rev) OVER (ORDER BY rev DESC) AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE) AS cum FROM x)
            SELECT item AS coffee_name, {columns}, CASE WHEN cum <= {a} THEN 'A' WHEN cum <= {b} THEN 'B' ELSE 'C' END AS abc_class FROM y"""

    numbers = f"{_dbl('rev')} AS revenue, {_round('sh', 4)} AS revenue_share, {_round('cum', 4)} AS cumulative_share"
    texts = """replace(format('{:,.2f}', CAST(rev AS DOUBLE)), ',', ' ') AS revenue_formatted,
        printf('%.2f', CAST(ROUND(CAST(sh * 100 AS DECIMAL(38,8)), 2) AS DOUBLE)) || '%' AS revenue_share_pct,
        printf('%.2f', CAST(ROUND(CAST(cum * 100 AS DECIMAL(38,8)), 2) AS DOUBLE)) || '%' AS cumulative_share_pct"""
    mix = f"""u AS (SELECT CAST(date_trunc('week', d) AS DATE) AS w, item, COUNT(*) AS n FROM s GROUP BY 1, 2),
        m AS (SELECT w, item, n, SUM(n) OVER (PARTITION BY w) AS wt FROM u)
        SELECT {_day('w')} AS week_start, item AS coffee_name, n AS units_sold, {_int('wt')} AS total_units_week, {_pct('n', 'wt')} AS percentage FROM m"""
    return {
        "abc_classes": abc("p_brand", 0.80, 0.95, numbers),
        "abc_classes_75": abc("p_type", 0.75, 0.95, numbers),
        "abc_formatted": abc("p_brand", 0.80, 0.95, texts),
        "weekly_product_mix": f"WITH {_lines()}, {mix}",
        "weekly_product_mix_top5": f"""WITH {_lines('p_brand')}, {mix}
            WHERE item IN (SELECT item FROM s GROUP BY item ORDER BY COUNT(*) DESC, item LIMIT 5)""",
        "product_margin": f"""WITH x AS (
            SELECT p_name AS name, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4)) AS amount,
                   CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) AS cost
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)
            SELECT name, {_dbl('SUM(amount)')} AS revenue, {_dbl('SUM(cost)')} AS cost, {_dbl('SUM(amount) - SUM(cost)')} AS profit,
                   {_pct('SUM(amount) - SUM(cost)', 'SUM(amount)')} AS margin_pct FROM x GROUP BY 1""",
        "product_daily_lag7": f"""WITH {_lines('p_brand')}, {_TX}, a AS (SELECT d, SUM(total) AS rev FROM t GROUP BY 1),
            b AS (SELECT d, COUNT(*) AS n FROM s WHERE item = 'Brand#7' GROUP BY 1)
            SELECT {_day('d')} AS sale_date, {_dbl('rev')} AS revenue, n AS product_count, LAG(n, 7) OVER (ORDER BY d) AS prev_product_count
            FROM a LEFT JOIN b USING (d)""",
        "product_totals_per_line": f"""WITH {_SOLD} SELECT product_id, sale_id, {_day('sold_at')} AS sale_date, {_dbl('quantity')} AS quantity,
            {_dbl('SUM(quantity) OVER (PARTITION BY product_id)')} AS total_sales_qty FROM p""",
        "product_stats_per_line": f"""WITH {_SOLD} SELECT product_id, sale_id, {_day('sold_at')} AS sale_date, {_dbl('quantity')} AS quantity,
            {_ratio('SUM(quantity) OVER k', 'COUNT(*) OVER k', 4)} AS avg_quantity, {_dbl('MAX(quantity) OVER k')} AS max_sale,
            COUNT(*) OVER k AS num_transactions FROM p WINDOW k AS (PARTITION BY product_id)""",
    }


def _trend_queries() -> dict[str, str]:
    base = f"WITH {_lines()}, {_TX}"
    days = f"{base}, x AS (SELECT d, SUM(total) AS r, COUNT(*) AS n FROM t GROUP BY d)"
    prev = "LAG(r) OVER (ORDER BY d)"
    rolling = "AVG(CAST(r AS DOUBLE)) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"

    def weekday(week: str) -> str:
        return f"""{base}, x AS (SELECT isodow(d) AS k, {week} AS w, SUM(total) AS r FROM t GROUP BY 1, 2)
            SELECT k AS day_of_week_num, strftime(w, '%Y-%m-%d') AS week_start, {_dbl('r')} AS weekly_dow_revenue,
                   {_dbl('LAG(r) OVER v')} AS prev_week_revenue, {_pct('r - LAG(r) OVER v', 'LAG(r) OVER v')} AS weekly_growth_pct
            FROM x WINDOW v AS (PARTITION BY k ORDER BY w)"""

    return {
        "daily_revenue_change": f"""{days} SELECT {_day('d')} AS sale_date, {_dbl('r')} AS revenue, {_dbl(prev)} AS prev_day_revenue,
            {_pct(f'r - {prev}', prev)} AS revenue_change_pct FROM x""",
        "daily_avg_check": f"{days} SELECT {_day('d')} AS sale_date, {_ratio('r', 'n')} AS avg_check FROM x",
        "daily_traffic": f"""WITH {_lines()}, x AS (SELECT d, COUNT(DISTINCT tx) AS n FROM s GROUP BY d)
            SELECT {_day('d')} AS sale_date, n AS n_transactions, LAG(n) OVER (ORDER BY d) AS prev_n_transactions FROM x""",
        "daily_trends": f"""{days} SELECT {_day('d')} AS sale_date, {_dbl('r')} AS revenue, {_dbl(prev)} AS prev_day_revenue,
            {_pct(f'r - {prev}', prev)} AS revenue_change_pct, {_ratio('r', 'n')} AS avg_check,
            LAG({_ratio('r', 'n')}) OVER (ORDER BY d) AS prev_avg_check, n AS n_transactions,
            LAG(n) OVER (ORDER BY d) AS prev_n_transactions FROM x""",
        "same_weekday_growth": weekday("CAST(date_trunc('week', d) AS DATE)"),
        "same_weekday_w_mon": weekday("d + CAST((8 - isodow(d)) % 7 AS INTEGER)"),
        "rolling_revenue_7d": f"{days} SELECT {_day('d')} AS sale_date, {_dbl('r')} AS daily_revenue, {_round(rolling, 6)} AS rolling_mean_7d FROM x",
        "rolling_revenue_7d_full": f"""{days} SELECT {_day('d')} AS sale_date, {_dbl('r')} AS daily_revenue,
            CASE WHEN ROW_NUMBER() OVER (ORDER BY d) >= 7 THEN {_round(rolling, 6)} END AS rolling_mean_7d FROM x""",
        "rolling_revenue_7d_calendar": f"""{days}, c AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM x),
            y AS (SELECT c.d, COALESCE(r, 0) AS r FROM c LEFT JOIN x ON x.d = c.d)
            SELECT {_day('d')} AS sale_date, {_dbl('r')} AS daily_revenue, {_round(rolling, 6)} AS rolling_mean_7d FROM y""",
    }


def _staffing_queries() -> dict[str, str]:
    base = f"WITH {_EVENTS}"
    load = f"{_dbl('SUM(price)')} AS revenue, COUNT(DISTINCT tx) AS transactions, COUNT(*) AS items_sold"
    hours = f"""{base}, h AS (SELECT CAST(ts AS DATE) AS d, isodow(ts) AS dow, hour(ts) AS hr, COUNT(DISTINCT tx) AS n
        FROM s WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2, 3)"""
    labels = "printf('%02d:00', hr) AS hour_label, dow || '. ' || ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][dow] AS day_label"

    def matrix(growth: str) -> str:
        return f"""{hours}, v AS (SELECT *, LAG(n) OVER (PARTITION BY dow, hr ORDER BY d) AS pv FROM h),
            g AS (SELECT *, CAST({growth} AS DECIMAL(18,1)) AS wow FROM v WHERE pv IS NOT NULL)
            SELECT {labels}, {_ratio('SUM(n)', 'COUNT(*)', 1)} AS avg_receipts,
                   {_round('quantile_cont(CAST(n AS DOUBLE), 0.5)', 1)} AS median_receipts,
                   {_round('quantile_cont(CAST(n AS DOUBLE), 0.9)', 1)} AS p90_receipts,
                   {_ratio('SUM(wow)', 'COUNT(wow)', 1)} AS avg_wow_growth_pct,
                   {_pct('COUNT(*) FILTER (WHERE n > pv)', 'COUNT(*)', 1)} AS pct_weeks_growing,
                   COUNT(*) AS data_points_with_trend FROM g GROUP BY hr, dow"""

    simple = f"{hours} SELECT {labels}, {_ratio('SUM(n)', 'COUNT(*)', 1)} AS avg_transaction_load FROM h GROUP BY hr, dow"
    weekday_segments = f"""x AS (SELECT d, dn, dow, tx, ts, MAX(total) AS total, {_segment(WEEKDAY_SEGMENTS)} AS seg
            FROM s WHERE NOT we AND CAST(ts AS TIME) >= '11:00:00' GROUP BY d, dn, dow, tx, ts),
        seg AS (SELECT dn AS day_name, dow AS day_num, seg AS time_segment, COUNT(DISTINCT tx) AS total_checks,
            {_dbl('SUM(total)')} AS total_revenue, {_ratio('SUM(total)', '3')} AS revenue_per_hour FROM x GROUP BY 1, 2, 3)"""
    cells = ", ".join(f"MAX(total_revenue) FILTER (WHERE time_segment = '{n}') AS \"{n}\"" for n in WEEKDAY_SEGMENTS)
    heat = ", ".join(f"{_dbl(f'COALESCE(SUM(total) FILTER (WHERE hour(ts) = {h}), 0)')} AS \"{h}\"" for h in range(24))
    return {
        "hourly_load": f"{base} SELECT hour(ts) AS hour, {load} FROM s GROUP BY 1",
        "weekday_load": f"{base} SELECT dn AS day_name, {load}, {_ratio('SUM(total)', 'COUNT(*)')} AS avg_ticket FROM s GROUP BY 1",
        "weekday_load_all_days": f"""{base} SELECT day_name, {_dbl('COALESCE(SUM(price), 0)')} AS revenue, COUNT(DISTINCT tx) AS transactions,
            COUNT(tx) AS items_sold, COALESCE({_ratio('SUM(total)', 'COUNT(tx)')}, 0) AS avg_ticket
            FROM (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS day_name) n
            LEFT JOIN s ON s.dn = n.day_name GROUP BY 1""",
        "morning_daily": f"""{base}, m AS (SELECT DISTINCT ON (tx) tx, d, total FROM s WHERE part = 'Morning' ORDER BY tx)
            SELECT {_day('d')} AS sale_date, {_summary('unique_transactions', 'total_revenue', 'avg_check')} FROM m GROUP BY d""",
        "revenue_per_hour_segments": f"""{base}, x AS (SELECT d, tx, MAX(total) AS total, {_segment(REVENUE_SEGMENTS)} AS seg FROM s
                WHERE NOT we AND CAST(ts AS TIME) >= '11:00:00' GROUP BY d, tx, {_segment(REVENUE_SEGMENTS)})
            SELECT seg AS real_segment, COUNT(DISTINCT d) AS unique_days, COUNT(*) AS total_checks, {_ratio('SUM(total)', 'COUNT(*)')} AS avg_check_rub,
                   {_dbl('SUM(total)')} AS total_revenue, {_ratio('SUM(total)', 'COUNT(DISTINCT d) * 3', 0)} AS revenue_per_hour FROM x GROUP BY 1""",
        "segments_by_weekday": f"{base}, {weekday_segments} SELECT * FROM seg",
        "afternoon_vs_evening_gap": f"""{base}, x AS (SELECT d, part, SUM(total) AS r FROM
                (SELECT DISTINCT d, part, tx, total FROM s WHERE NOT we AND part IN ('Afternoon', 'Evening')) GROUP BY 1, 2),
            m AS (SELECT part, COUNT(*) AS n, SUM(r) AS r, {_ratio('SUM(r)', 'COUNT(*)')} AS a FROM x GROUP BY 1)
            SELECT m.part AS time_of_day, m.n AS "days", {_dbl('m.r')} AS total_revenue, m.a AS avg_daily_revenue,
                   CASE WHEN m.part = 'Afternoon' THEN {_round('e.a - m.a')} END AS gap_to_evening_rub,
                   CASE WHEN m.part = 'Afternoon' THEN {_pct('e.a - m.a', 'e.a', 1)} END AS gap_to_evening_pct
            FROM m LEFT JOIN m e ON e.part = 'Evening'""",
        "staffing_matrix": matrix(_pct("n - pv", "pv", 1)),
        "staffing_matrix_integer": matrix("trunc(CAST(n - pv AS DOUBLE) / pv) * 100"),
        "staffing_matrix_simple": simple,
        "staffing_heatmap": f"""WITH c AS ({simple}), k AS (SELECT *, RANK() OVER (ORDER BY avg_transaction_load) AS r,
                COUNT(*) OVER (PARTITION BY avg_transaction_load) AS ties, COUNT(*) OVER () AS cells FROM c)
            SELECT hour_label, day_label, avg_transaction_load AS max_load, {_ratio('r + (ties - 1) / 2.0', 'cells', 6)} AS rank FROM k""",
        "revenue_heatmap": f"""{base}, {_EVENT_TX} SELECT day_name, {heat}
            FROM (SELECT unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS day_name) n
            LEFT JOIN t ON t.dn = n.day_name GROUP BY 1""",
        "rolling_line_revenue": f"""{base}, x AS (SELECT CAST(ts AS DATE) AS d, SUM(price) AS r FROM s GROUP BY 1)
            SELECT {_day('d')} AS day, {_round('AVG(CAST(r AS DOUBLE)) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 6)} AS rolling_mean FROM x""",
        "segments_pivot": f"""{base}, {weekday_segments} SELECT day_num, day_name, {cells}, {_round('SUM(total_revenue)')} AS row_total FROM seg GROUP BY 1, 2""",
        "checks_per_segment": f"{base}, {weekday_segments} SELECT time_segment, {_ratio('SUM(total_checks)', 'COUNT(*)')} AS avg_total_checks FROM seg GROUP BY 1",
        "dataset_row_count": "SELECT COUNT(*) AS count FROM events",
    }


def _dashboard_queries() -> dict[str, str]:
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    cells = ", ".join(f"NULLIF(COUNT(*) FILTER (WHERE item = '{t}'), 0) AS \"{t}\"" for t in types)
    week = "CAST(date_trunc('week', d) AS DATE)"
    named = ["ECONOMY", "LARGE", "PROMO"]
    listed = ", ".join(f"NULLIF(COUNT(*) FILTER (WHERE item = '{t}'), 0) AS \"{t}\"" for t in named)
    listed += ", NULLIF(COUNT(*) FILTER (WHERE item NOT IN ('ECONOMY', 'LARGE', 'PROMO')), 0) AS other"
    weekly = f"WITH {_lines()} SELECT {_day(week)} AS week_start, {cells} FROM s"
    return {
        "drinks_by_week": f"{weekly} GROUP BY 1",
        "drinks_by_week_range": f"WITH {_lines()} SELECT {_day(week)} AS week_start, {listed} FROM s WHERE d >= DATE '1998-01-05' AND d < DATE '1999-01-04' GROUP BY 1",
        "revenue_share_pie": f"""WITH {_lines('p_brand')} SELECT item AS coffee_name, {_dbl('SUM(price)')} AS revenue,
            {_ratio('SUM(price)', 'SUM(SUM(price)) OVER ()', 6)} AS contribution FROM s GROUP BY 1""",
    }


def _operation_queries() -> dict[str, str]:
    rate = f"""COUNT(*) AS total_orders, COUNT(*) FILTER (WHERE status = 'returned') AS returned_orders,
        {_pct("COUNT(*) FILTER (WHERE status = 'returned')", 'COUNT(*)')} AS return_rate_percent FROM o"""
    along = "OVER (PARTITION BY product_id ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
    falling = f"""WITH {_SOLD}, pd AS (SELECT product_id, CAST(sold_at AS DATE) AS d, SUM(quantity) AS q FROM p
            WHERE sold_at >= TIMESTAMP '2001-11-04' - INTERVAL 90 DAY GROUP BY 1, 2),
        m AS (SELECT *, COALESCE(q - LAG(q) OVER w, 0) AS diff,
              {_ratio('SUM(q) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 'COUNT(*) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS a
              FROM pd WINDOW w AS (PARTITION BY product_id ORDER BY d))
        SELECT product_id, p_type AS category, p_name AS model_name, {_day('d')} AS sale_date, {_dbl('q')} AS daily_sales,
               {_dbl('diff')} AS diff, a AS moving_avg_7d FROM m JOIN part ON p_partkey = product_id
        WHERE diff < 0 AND CAST(q AS DOUBLE) < a"""
    stats = f"""WITH {_SOLD}, {_SOLD_DAYS}, b AS (SELECT product_id, d, q, COUNT(*) {along} AS n,
            {_ratio(f'SUM(q) {along}', f'COUNT(*) {along}', 6)} AS a0, {_round(f'STDDEV_SAMP(CAST(q AS DOUBLE)) {along}', 6)} AS s0 FROM pd),
        c AS (SELECT product_id, d, q, n, s0, CASE WHEN n >= 7 THEN a0 END AS a, CASE WHEN n >= 7 THEN s0 END AS sd FROM b)"""
    safety = "1.65 * sd * sqrt(7.0)"
    levels = " ".join(f"WHEN '{name}' THEN {Z_BY_SERVICE_LEVEL[level]}" for name, level in SERVICE_LEVELS.items())
    classes = list(SERVICE_LEVELS)
    return {
        "return_rate": f"WITH {_RETURNS} SELECT category, {rate} GROUP BY 1",
        "return_rate_by_region": f"""WITH o AS (SELECT r_name AS region, CASE l_returnflag WHEN 'R' THEN 'returned' ELSE 'kept' END AS status
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
            JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey) SELECT region, {rate} GROUP BY 1""",
        "return_rate_by_brand": f"WITH {_RETURNS} SELECT brand, {rate} GROUP BY 1",
        "return_rate_case": f"""WITH {_RETURNS} SELECT category, COUNT(*) AS total_orders,
            {_int("SUM(CASE WHEN status = 'returned' THEN 1 ELSE 0 END)")} AS returned_orders,
            {_pct("SUM(CASE WHEN status = 'returned' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS return_rate_percent
            FROM o WHERE status IN ('returned', 'delivered', 'in_transit') GROUP BY 1""",
        "return_rate_last_month": f"WITH {_RETURNS} SELECT brand, {rate} WHERE day >= DATE '2001-10-04' GROUP BY 1",
        "slow_assembly_top3": f"""WITH f AS (SELECT l_suppkey AS k, o_orderdate AS a, CASE WHEN l_shipdate >= o_orderdate THEN l_shipdate END AS b
                FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
            x AS (SELECT k, COUNT(*) AS n, {_pct('COUNT(*) FILTER (WHERE epoch(b - a) / 60 > 720000)', 'COUNT(*)')} AS pct
                FROM f WHERE a >= TIMESTAMP '2001-08-01' - INTERVAL 1500 DAY AND b IS NOT NULL GROUP BY k HAVING COUNT(*) > 50),
            y AS (SELECT *, DENSE_RANK() OVER (ORDER BY pct DESC) AS rnk FROM x
                JOIN supplier ON s_suppkey = k JOIN nation ON n_nationkey = s_nationkey)
            SELECT n_name AS city_name, k AS darkstore_id, pct AS slow_pct, n AS total_orders, rnk FROM y WHERE rnk <= 3""",
        "inventory_gap": f"""WITH c AS (SELECT l_partkey AS k, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
            x AS (SELECT p_partkey AS sku, p_name AS item_name, CASE WHEN p_type <> 'PROMO' THEN p_size ELSE 0 END AS sys,
                  CASE WHEN p_type <> 'PROMO' THEN CAST(p_retailprice AS DECIMAL(18,2)) ELSE 0 END AS price, COALESCE(q, 0) AS fact
                  FROM part LEFT JOIN c ON k = p_partkey)
            SELECT sku, item_name, {_int('sys')} AS system_qty, {_dbl('fact')} AS fact_qty, {_dbl('fact - sys')} AS diff_qty,
                   {_dbl('(fact - sys) * price')} AS financial_impact_rub,
                   CASE WHEN fact = sys THEN '{STOCK_OK}' WHEN fact < sys THEN '{STOCK_SHORTAGE}' ELSE '{STOCK_SURPLUS}' END AS status FROM x""",
        "falling_demand": falling,
        "falling_demand_csv": falling,
        "sales_enriched": f"""WITH inv AS (SELECT l_partkey AS k, CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_quantity AS BIGINT)) AS stock,
                CASE l_linestatus WHEN 'F' THEN 'received' ELSE 'shipped' END AS op FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
            SELECT p_partkey AS product_id, p_type AS category, p_name AS model_name,
                   {_dbl('CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.60 AS DECIMAL(18,2))')} AS cost_price, {_dbl('CAST(p_retailprice AS DECIMAL(18,2))')} AS sale_price,
                   l_orderkey AS sale_id, {_day('CAST(l_shipdate AS DATE)')} AS sale_date, strftime(l_shipdate, '%H:%M:%S') AS sale_time,
                   {_dbl('l_quantity')} AS quantity, {_dbl('CAST(l_quantity AS BIGINT) * CAST(p_retailprice AS DECIMAL(18,2))')} AS revenue,
                   o_custkey AS customer_id, {_int('stock')} AS stock_on_hand, op AS operation_type
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
            LEFT JOIN inv ON k = l_partkey AND day = CAST(l_shipdate AS DATE)""",
        "reorder_point": f"""{stats} SELECT product_id, {_day('d')} AS sale_date, {_dbl('q')} AS daily_sales, a AS rolling_avg, sd AS rolling_std,
            {_round('a * 7', 4)} AS reorder_point, {_round(safety, 4)} AS safety_stock,
            {_round(f'a * 7 - {safety}', 4)} AS lower_band, {_round(f'a * 7 + {safety}', 4)} AS upper_band FROM c""",
        "demand_volatility": f"""{stats} SELECT product_id, {_day('d')} AS sale_date, {_dbl('q')} AS daily_sales,
            CASE WHEN n >= 30 THEN s0 END AS std_no_min, sd AS std_with_min FROM c""",
        "reorder_signal": f"""{stats}, l AS (SELECT DISTINCT ON (product_id) product_id, a, sd FROM c ORDER BY product_id, d DESC),
            k AS (SELECT p_partkey AS product_id, p_size * 4 AS stock, CASE WHEN p_size <= 12 THEN '{classes[0]}' WHEN p_size <= 25 THEN '{classes[1]}'
                  WHEN p_size <= 37 THEN '{classes[2]}' ELSE '{classes[3]}' END AS cls FROM part)
            SELECT product_id, {_int('stock')} AS stock, {_round('a * 7', 4)} AS reorder_point,
                   {_round(f'CAST(CASE cls {levels} END AS DOUBLE) * sd * sqrt(7.0)', 4)} AS safety_stock,
                   COALESCE(stock <= {_round('a * 7', 4)}, FALSE) AS reorder_flag FROM k LEFT JOIN l USING (product_id)""",
        "cohort_ltv_margin": f"""WITH x AS (SELECT o_custkey AS u, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
                CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(3,2))) AS DECIMAL(18,4))
                - CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER) AS net
                FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
            y AS (SELECT *, MIN(m) OVER (PARTITION BY u) AS c FROM x),
            z AS (SELECT c, COUNT(DISTINCT u) AS n FROM y GROUP BY c),
            w AS (SELECT c, m, SUM(net) AS net FROM y GROUP BY c, m)
            SELECT {_day('c')} AS cohort_month, {_day('m')} AS margin_month,
                   {_ratio('SUM(net) OVER (PARTITION BY c ORDER BY m)', 'n')} AS ltv_margin FROM w JOIN z USING (c)""",
    }


def _quality_queries() -> dict[str, str]:
    raw = f"WITH {_RAW}"
    latest = "SELECT DISTINCT ON (transaction_id) transaction_id, sale_date, total_cost FROM r ORDER BY transaction_id, sale_date DESC, total_cost DESC"

    def nulls(table: str, columns: list[tuple[str, str]], extra: str = "", with_type: bool = False) -> str:
        kind = lambda t: f", '{t}' AS data_type" if with_type else ""
        return " UNION ALL ".join(
            f"SELECT '{c}' AS column_name{kind(t)}, COUNT(*) - COUNT({c}) AS missing{extra} FROM {table}" for c, t in columns
        )

    event_columns = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]
    duplicates = ", COUNT(*) AS row_count, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM events)) AS duplicates"
    gap_columns = [(c, "") for c in ("event_id", "user_id", "ts", "value", "kind")]

    def numbers(column: str, x: str) -> str:
        return f"""SELECT '{column}' AS column_name, COUNT({x}) AS count, {_round(f'AVG(CAST({x} AS DOUBLE))', 4)} AS mean,
            {_round(f'STDDEV_SAMP(CAST({x} AS DOUBLE))', 4)} AS std, {_dbl(f'MIN({x})')} AS min, {_q(x, 0.25)} AS q25, {_q(x, 0.5)} AS q50,
            {_q(x, 0.75)} AS q75, {_dbl(f'MAX({x})')} AS max FROM orders"""

    def words(column: str) -> str:
        return f"""SELECT '{column}' AS column_name, COUNT({column}) AS count, COUNT(DISTINCT {column}) AS "unique",
            (SELECT {column} FROM orders GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS top,
            (SELECT COUNT(*) FROM orders GROUP BY {column} ORDER BY 1 DESC LIMIT 1) AS freq FROM orders"""

    return {
        "validate_data": nulls("events", event_columns, duplicates, True),
        "table_shape": """SELECT COUNT(*) AS row_count, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM events)) AS duplicates,
            6 AS column_count FROM events""",
        "null_counts": f"WITH {_GAPS} {nulls('g', gap_columns)}",
        "describe_numeric": f"{numbers('o_orderkey', 'o_orderkey')} UNION ALL {numbers('o_custkey', 'o_custkey')} UNION ALL {numbers('o_totalprice', 'o_totalprice')}",
        "describe_categorical": f"{words('o_orderstatus')} UNION ALL {words('o_orderpriority')}",
        "value_frequencies": f"WITH {_lines('p_brand')} SELECT item AS coffee_name, COUNT(*) AS n FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
        "audit_unique": f"""{raw}, k AS (SELECT DISTINCT transaction_id, sale_date FROM r)
            SELECT COUNT(*) AS total_rows, COUNT(DISTINCT transaction_id) AS unique_tx FROM k""",
        "audit_repeated": f"""{raw}, k AS (SELECT DISTINCT transaction_id, sale_date FROM r)
            SELECT transaction_id, COUNT(*) AS cnt FROM k GROUP BY 1 HAVING COUNT(*) > 1""",
        "audit_before_after": f"""{raw} SELECT (SELECT COUNT(*) FROM r) AS rows_before, (SELECT COUNT(*) FROM ({latest})) AS rows_after,
            COUNT(DISTINCT transaction_id) AS distinct_keys FROM r""",
        "audit_multi_line_receipts": f"""{raw} SELECT transaction_id, {_day('sale_date')} AS sale_date, {_dbl('total_cost')} AS total_cost
            FROM r WHERE transaction_id IN (SELECT transaction_id FROM r GROUP BY 1 HAVING COUNT(*) > 1)""",
        "audit_methods_agree": f"""{raw}, a AS ({latest}), b AS (SELECT transaction_id, sale_date, total_cost FROM r
                QUALIFY ROW_NUMBER() OVER (PARTITION BY transaction_id ORDER BY sale_date DESC, total_cost DESC) = 1)
            SELECT transaction_id, {_day('a.sale_date')} AS sale_date_1, {_dbl('a.total_cost')} AS total_cost_1,
                   {_day('b.sale_date')} AS sale_date_2, {_dbl('b.total_cost')} AS total_cost_2 FROM a FULL JOIN b USING (transaction_id)
            WHERE a.sale_date IS DISTINCT FROM b.sale_date OR a.total_cost IS DISTINCT FROM b.total_cost""",
        "audit_methods_differ": f"""{raw}, a AS ({latest}), b AS (SELECT transaction_id, MAX(total_cost) AS total_cost FROM r GROUP BY 1)
            SELECT transaction_id, {_dbl('a.total_cost')} AS total_cost_1, {_dbl('b.total_cost')} AS total_cost_2
            FROM a FULL JOIN b USING (transaction_id) WHERE a.total_cost IS DISTINCT FROM b.total_cost""",
        "audit_revenue_totals": f"""WITH {_lines()}, {_TX} SELECT (SELECT {_dbl('SUM(total)')} FROM s) AS sum_before, {_dbl('SUM(total)')} AS sum_after FROM t""",
        "inconsistent_receipts": f"""{raw} SELECT transaction_id, {_dbl('MIN(total_cost)')} AS min_total, {_dbl('MAX(total_cost)')} AS max_total
            FROM r GROUP BY 1 HAVING MIN(total_cost) <> MAX(total_cost)""",
        "outside_hours": f"""WITH {_EVENTS} SELECT cust AS customer_id, {_day('d')} AS sale_date, item AS coffee_name, {_dbl('price')} AS drink_price,
            CAST(ts AS VARCHAR) AS sale_ts, {_dbl('total')} AS total_cost, tx AS transaction_id,
            hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS second_of_day, part AS time_of_day, dow AS day_of_week, dn AS day_name, we AS is_weekend
            FROM s WHERE part = 'Outside hours'""",
        "constraint_checks": f"""WITH e AS (SELECT *, hour(ts) AS h FROM events)
            SELECT 'primary key user_id, hour' AS rule, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, h FROM e)) AS violations FROM e
            UNION ALL SELECT 'not null user_id', COUNT(*) - COUNT(user_id) FROM e
            UNION ALL SELECT 'not null value', COUNT(*) - COUNT(value) FROM e
            UNION ALL SELECT 'check hour 0..23', COUNT(*) FILTER (WHERE h NOT BETWEEN 0 AND 23) FROM e
            UNION ALL SELECT 'check value below 100', COUNT(*) FILTER (WHERE value >= 100) FROM e""",
        "dedup_distinct": f"{raw} SELECT DISTINCT transaction_id, {_dbl('total_cost')} AS total_cost FROM r",
        "dedup_max_by_date": f"{raw} SELECT transaction_id, {_day('sale_date')} AS sale_date, {_dbl('MAX(total_cost)')} AS total_cost FROM r GROUP BY transaction_id, sale_date",
        "dedup_first_row": f"""{raw} SELECT DISTINCT ON (transaction_id) transaction_id, {_day('sale_date')} AS sale_date,
            {_dbl('total_cost')} AS total_cost FROM r ORDER BY transaction_id, r.sale_date, r.total_cost""",
        "dedup_last_row": f"{raw}, a AS ({latest}) SELECT transaction_id, {_day('sale_date')} AS sale_date, {_dbl('total_cost')} AS total_cost FROM a",
        "dedup_first_value": f"""{raw}, n AS (SELECT transaction_id, sale_date, CASE WHEN total_cost >= 20000 THEN total_cost END AS total_cost FROM r)
            SELECT transaction_id, {_day('MIN(sale_date)')} AS sale_date,
                   {_dbl('FIRST(total_cost ORDER BY sale_date, total_cost) FILTER (WHERE total_cost IS NOT NULL)')} AS total_cost FROM n GROUP BY 1""",
        "dedup_consistent": f"{raw} SELECT transaction_id, {_dbl('MAX(total_cost)')} AS total_cost FROM r GROUP BY 1 HAVING MAX(total_cost) = MIN(total_cost)",
    }


def _prep_queries() -> dict[str, str]:
    gaps = f"WITH {_GAPS}"

    def interpolated(partition: str, order: str, columns: str) -> str:
        up = f"({partition} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        down = f"({partition} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        return f"""{gaps}, n AS (SELECT *, ROW_NUMBER() OVER ({partition} ORDER BY {order}) AS i FROM g),
            k AS (SELECT *, CASE WHEN value IS NOT NULL THEN i END AS pos, CAST(value AS DOUBLE) AS x FROM n),
            b AS (SELECT *, LAST_VALUE(pos IGNORE NULLS) OVER {up} AS p0, LAST_VALUE(x IGNORE NULLS) OVER {up} AS x0,
                  FIRST_VALUE(pos IGNORE NULLS) OVER {down} AS p1, FIRST_VALUE(x IGNORE NULLS) OVER {down} AS x1 FROM k)
            SELECT {columns}, {_round('CASE WHEN x IS NOT NULL THEN x WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN x0 ELSE x0 + (x1 - x0) / (p1 - p0) * (i - p0) END', 4)} AS value FROM b"""

    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    onehot = ", ".join(f"CASE WHEN p_type = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"p_type_{t}\"" for t in types)
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
    segment_flags = ", ".join(f"CASE WHEN seg = '{t}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"segment_{t}\"" for t in segments)
    split = """d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS total FROM orders GROUP BY 1),
        w AS (SELECT day, total, part, place, total * CASE WHEN isodow(day) >= 6 THEN we ELSE wd END / 10.0 AS x
              FROM d, (VALUES ('morning', 0, 4, 2), ('afternoon', 1, 5, 6), ('evening', 2, 1, 2)) v(part, place, wd, we)),
        f AS (SELECT *, CAST(floor(x) AS BIGINT) AS base, ROW_NUMBER() OVER (PARTITION BY day ORDER BY ROUND(x - floor(x), 6) DESC, place) AS k,
              total - SUM(CAST(floor(x) AS BIGINT)) OVER (PARTITION BY day) AS rest FROM w),
        c AS (SELECT day, total, part, base + CASE WHEN k <= rest THEN 1 ELSE 0 END AS cnt FROM f)"""
    segment = "SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS seg FROM customer"
    fence = "quantile_cont(CAST(value AS DECIMAL(18,2))::DOUBLE, {a}) {sign} 1.5 * (quantile_cont(CAST(value AS DECIMAL(18,2))::DOUBLE, 0.75) - quantile_cont(CAST(value AS DECIMAL(18,2))::DOUBLE, 0.25))"
    calendar_types = {
        "date_key": "int", "date": "date", "day_name": "string", "is_weekend": "boolean", "fiscal_year": "int", "n_orders": "bigint"
    }
    comment = lambda c: f"'{CALENDAR_COMMENTS[c]}'" if c in CALENDAR_COMMENTS else "NULL"
    calendar = f"""WITH n AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1),
        c AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM n)
        SELECT {_day('d')} AS date, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
            dayofweek(d) AS day_of_week, isodow(d) AS day_of_week_iso, dayname(d) AS day_name, strftime(d, '%a') AS day_short_name,
            isodow(d) >= 6 AS is_weekend, weekofyear(d) AS week_number, (day(d) + 6) // 7 AS week_of_month,
            {_day("CAST(date_trunc('week', d) AS DATE)")} AS week_start_date, month(d) AS month_number, monthname(d) AS month_name,
            strftime(d, '%b') AS month_short_name, {_day("CAST(date_trunc('month', d) AS DATE)")} AS first_day_of_month,
            {_day('last_day(d)')} AS last_day_of_month, quarter(d) AS quarter_number, 'Q' || quarter(d) AS quarter_name,
            {_day("CAST(date_trunc('quarter', d) AS DATE)")} AS first_day_of_quarter,
            {_day("CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)")} AS last_day_of_quarter,
            year(d) AS year, year(d + INTERVAL 6 MONTH - INTERVAL 0 DAY) AS fiscal_year, year(d) - year(d) % 10 AS decade, century(d) AS century,
            FALSE AS is_holiday, COALESCE(n, 0) AS n_orders FROM c LEFT JOIN n USING (d)"""
    return {
        "impute_mean": f"{gaps} SELECT event_id, {_round('COALESCE(CAST(value AS DOUBLE), (SELECT AVG(CAST(value AS DOUBLE)) FROM g))', 4)} AS value FROM g",
        "impute_median": f"{gaps} SELECT event_id, {_round('COALESCE(CAST(value AS DOUBLE), (SELECT quantile_cont(CAST(value AS DOUBLE), 0.5) FROM g))', 4)} AS value FROM g",
        "impute_most_frequent": f"""{gaps} SELECT event_id, COALESCE(kind, (SELECT kind FROM g WHERE kind IS NOT NULL GROUP BY kind
            ORDER BY COUNT(*) DESC, kind LIMIT 1)) AS kind FROM g""",
        "drop_missing": f"{gaps} SELECT event_id, {_dbl('value')} AS value FROM g WHERE value IS NOT NULL",
        "interpolate_per_user": interpolated("PARTITION BY user_id", "event_id", "event_id, user_id"),
        "interpolate_series": interpolated("", "ts, event_id", "event_id"),
        "remove_duplicates": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem",
        "winsorise": f"""WITH b AS (SELECT {fence.format(a=0.25, sign='-')} AS lo, {fence.format(a=0.75, sign='+')} AS hi FROM events)
            SELECT event_id, {_round('GREATEST(lo, LEAST(hi, CAST(value AS DECIMAL(18,2))::DOUBLE))', 4)} AS value FROM events, b""",
        "encode_onehot": f"SELECT p_partkey, {onehot} FROM part",
        "encode_ordinal": "SELECT p_partkey, DENSE_RANK() OVER (ORDER BY p_brand) - 1 AS p_brand FROM part",
        "encode_ordinal_unseen": """WITH k AS (SELECT p_type, ROW_NUMBER() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM part WHERE p_type <> 'PROMO'))
            SELECT p_partkey, COALESCE(code, -1) AS p_type FROM part LEFT JOIN k USING (p_type)""",
        "standard_scale": f"SELECT c_custkey, {_round('(c_acctbal - AVG(c_acctbal) OVER ()) / STDDEV_POP(c_acctbal) OVER ()', 6)} AS c_acctbal FROM customer",
        "preprocess_pipeline": f"""WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS b,
                CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS seg0 FROM customer),
            y AS (SELECT c_custkey, COALESCE(b, (SELECT AVG(b) FROM x)) AS b,
                COALESCE(seg0, (SELECT seg0 FROM x WHERE seg0 IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1)) AS seg FROM x)
            SELECT c_custkey, {_round('(b - AVG(b) OVER ()) / STDDEV_POP(b) OVER ()', 6)} AS balance, {segment_flags} FROM y""",
        "derive_time_columns": f"""WITH e AS (SELECT event_id, ts, {_PART} AS part FROM events)
            SELECT event_id, month(ts) AS month, hour(ts) AS hour, {_day('CAST(ts AS DATE)')} AS date, part AS time_of_day, {_segment(WEEKDAY_SEGMENTS)} AS segment,
                   list_position(['Morning', 'Afternoon', 'Evening', 'Outside hours'], part) - 1 AS part_rank FROM e""",
        "line_fit": f"""SELECT l_returnflag, {_round('regr_slope(l_extendedprice, l_quantity)')} AS slope, {_round('regr_intercept(l_extendedprice, l_quantity)')} AS intercept,
            {_round('regr_slope(l_extendedprice, l_quantity) * 20 + regr_intercept(l_extendedprice, l_quantity)')} AS prediction FROM lineitem GROUP BY 1""",
        "price_histogram": f"""WITH x AS (SELECT CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
            b AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM x),
            c AS (SELECT LEAST(CAST(floor((v - lo) * 20 / (hi - lo)) AS BIGINT), 19) AS bin, COUNT(*) AS n FROM x, b GROUP BY 1)
            SELECT i AS bin, {_round('lo + (hi - lo) * i / 20', 4)} AS bin_start, {_round('lo + (hi - lo) * (i + 1) / 20', 4)} AS bin_end, COALESCE(n, 0) AS n
            FROM (SELECT unnest(range(20)) AS i), b LEFT JOIN c ON c.bin = i""",
        "order_calendar": calendar,
        "calendar_dictionary": f"""WITH n AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1),
                c AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM n),
                m AS (SELECT COUNT(*) - COUNT(n) AS gaps FROM c LEFT JOIN n USING (d))
            SELECT column_name, data_type, CASE WHEN column_name = 'n_orders' THEN gaps ELSE 0 END AS missing, comment
            FROM m, (VALUES {', '.join(f"('{c}', '{t}', {comment(c)})" for c, t in calendar_types.items())}) v(column_name, data_type, comment)""",
        "attach_price": f"""SELECT p_type AS coffee_name, MAX(CASE WHEN p_type <> 'PROMO' THEN {_dbl('price')} END) AS standard_price, SUM(n)::BIGINT AS n
            FROM (SELECT p_type, MAX(CAST(p_retailprice AS DECIMAL(18,2))) OVER (PARTITION BY p_type) AS price,
                         (SELECT COUNT(*) FROM lineitem WHERE l_partkey = p_partkey) AS n FROM part) x GROUP BY 1 HAVING SUM(n) > 0""",
        "price_bands": """SELECT p_partkey, name AS band FROM part JOIN (VALUES ('low', 0, 950), ('middle', 950, 1000), ('high', 1000, 1050), ('top', 1050, 1e12)) b(name, lo, hi)
            ON CAST(p_retailprice AS DECIMAL(18,2)) >= lo AND CAST(p_retailprice AS DECIMAL(18,2)) < hi""",
        "impute_mean_nan": f"""SELECT event_id, {_round("CASE WHEN event_type IN ('error', 'signup') THEN (SELECT AVG(value) FROM events WHERE event_type NOT IN ('error', 'signup')) ELSE value END", 4)} AS value FROM events""",
        "drop_empty_rows": f"{gaps} SELECT kind, COUNT(*) AS n FROM g WHERE kind IS NOT NULL OR value IS NOT NULL GROUP BY 1",
        "remove_duplicates_subset": """SELECT event_id, user_id, event_type FROM events
            QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
        "encode_onehot_null": f"WITH x AS ({segment}) SELECT c_custkey, {segment_flags}, CASE WHEN seg IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"segment_None\" FROM x",
        "encode_onehot_index": f"""WITH x AS ({segment}), k AS (SELECT seg, ROW_NUMBER() OVER (ORDER BY seg) - 1 AS code FROM (SELECT DISTINCT seg FROM x WHERE seg IS NOT NULL))
            SELECT c_custkey, COALESCE(code, (SELECT COUNT(*) FROM k)) AS segment FROM x LEFT JOIN k USING (seg)""",
        "encode_onehot_sparse": """WITH x AS (SELECT * FROM part WHERE p_type <> 'PROMO'),
            b AS (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM x WHERE p_brand IS NOT NULL)),
            t AS (SELECT p_type, ROW_NUMBER() OVER (ORDER BY p_type) - 1 AS code FROM (SELECT DISTINCT p_type FROM x WHERE p_type IS NOT NULL))
            SELECT p_partkey, code AS "index", 1.0::DOUBLE AS "value" FROM part JOIN b USING (p_brand) UNION ALL
            SELECT p_partkey, (SELECT COUNT(*) FROM b) + code, 1.0::DOUBLE FROM part JOIN t USING (p_type)""",
        "encode_ordinal_null": f"""WITH x AS ({segment}), k AS (SELECT seg, ROW_NUMBER() OVER (ORDER BY seg) - 1 AS code FROM (SELECT DISTINCT seg FROM x WHERE seg IS NOT NULL))
            SELECT c_custkey, code AS segment FROM x LEFT JOIN k USING (seg)""",
        "date_dim_default": """WITH c AS (SELECT CAST(unnest(generate_series(DATE '1770-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
            n AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1)
            SELECT year(d) - year(d) % 10 AS decade, COUNT(*) AS n_days, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS n_orders FROM c LEFT JOIN n USING (d) GROUP BY 1""",
        "title_names": """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part""",
        "union_parties": f"""SELECT c_custkey AS party, {_dbl('CAST(c_acctbal AS DECIMAL(18,2))')} AS balance, 'customer' AS kind FROM customer
            UNION ALL SELECT s_suppkey, {_dbl('CAST(s_acctbal AS DECIMAL(18,2))')}, 'supplier' FROM supplier""",
        "limit_rows": "SELECT LEAST(100, COUNT(*)) AS n FROM orders",
        "csv_dialect": f"""SELECT p_partkey, p_name || '; "' || p_type || '"' AS label, {_dbl('CAST(p_retailprice AS DECIMAL(18,2))')} AS price FROM part""",
        "load_and_insert": f"SELECT event_type, {_PART} AS time_of_day, COUNT(*) AS n FROM (SELECT event_type, date_trunc('second', ts) AS ts FROM events) e GROUP BY 1, 2",
        "null_counts_nan": """SELECT 'event_id' AS column_name, COUNT(*) - COUNT(event_id) AS missing FROM events UNION ALL SELECT 'user_id', COUNT(*) - COUNT(user_id) FROM events
            UNION ALL SELECT 'value', COUNT(*) FILTER (WHERE event_type IN ('error', 'signup') OR value IS NULL) FROM events""",
        "split_day_orders": f"WITH {split} SELECT {_day('day')} AS date, total, part, cnt FROM c",
        "expand_day_orders": f"WITH {split} SELECT {_day('day')} AS date, part, unnest(range(1, cnt + 1)) AS seq FROM c",
        "safe_names": r"SELECT DISTINCT p_brand, trim(regexp_replace(p_brand, '[^\p{L}\p{N} _-]', '_', 'g')) AS file_name FROM part",
    }


def oracle_sql() -> dict[str, str]:
    parts = (_receipt_queries, _product_queries, _trend_queries, _staffing_queries, _dashboard_queries,
             _operation_queries, _quality_queries, _prep_queries)
    return {name: text for part in parts for name, text in part().items()}
