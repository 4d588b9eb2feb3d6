"""The retail inputs of ``sources.retail`` restated in plain SQL, for the independent check.

Order matters: an entry may use the entries above it.
"""

COMMON: dict[str, str] = {
    "items": """
SELECT p_type || '|' || p_brand AS item_id, p_partkey AS variant_id, p_type AS sub_family,
       substr(p_type, 1, 1) AS family, p_brand AS brand, p_name AS item_name, p_size AS pack,
       p_retailprice AS retail_price
FROM part""",
    "stores": """
SELECT s_suppkey AS store_id, s_nationkey AS city_id, s_name AS store_name, s_acctbal AS balance,
       n_name AS city, n_regionkey AS territory
FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "raw_lines": """
SELECT l_orderkey AS ticket_id, l_linenumber AS hour, l_partkey AS variant_id, l_suppkey AS store_id,
       CAST(l_shipdate AS DATE) AS sale_date, l_quantity AS qty,
       CAST(l_extendedprice AS DECIMAL(18,4)) AS gross,
       CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS reward,
       CAST(CASE WHEN l_returnflag = 'A' THEN l_extendedprice * l_discount ELSE 0 END AS DECIMAL(18,4)) AS coupon_disc,
       CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice * l_discount ELSE 0 END AS DECIMAL(18,4)) AS promo_disc,
       CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0 END AS DECIMAL(18,4)) AS member_disc,
       l_returnflag AS return_flag, l_linestatus AS line_status,
       CAST(round(l_discount * 100) AS INTEGER) AS disc_pct, CAST(round(l_tax * 100) AS INTEGER) AS tax_pct
FROM lineitem""",
    "lines": """
SELECT r.*, i.item_id, i.sub_family, i.family, i.brand, s.city_id, s.territory
FROM raw_lines r JOIN items i ON i.variant_id = r.variant_id JOIN stores s ON s.store_id = r.store_id""",
    "calendar": """
SELECT d.day, CAST(date_trunc('week', d.day) AS DATE) AS week_start,
       CAST(isoyear(d.day) * 100 + week(d.day) AS INTEGER) AS week_key,
       CAST(date_trunc('month', d.day) AS DATE) AS month_start, CAST(year(d.day) AS INTEGER) AS year,
       CAST(dayofweek(d.day) + 1 AS INTEGER) AS dow, d.day - 354 AS lunar_day,
       CASE WHEN strftime(d.day, '%m-%d') IN ('01-01', '05-01', '10-01') THEN 1 ELSE 0 END AS holiday,
       CASE WHEN strftime(d.day, '%m-%d') BETWEEN '02-05' AND '02-11' THEN 1
            WHEN strftime(d.day, '%m-%d') BETWEEN '09-15' AND '09-17' THEN 2 END AS festival
FROM (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS day
      FROM lineitem) d""",
    "promo_lines": """
SELECT *, promo_start + 13 AS promo_end, promo_start - 28 AS announced
FROM (SELECT c.sub_family, c.city_id, c.month,
             CAST(year(c.month) * 100 + month(c.month) AS INTEGER) AS promo_id,
             CASE WHEN c.pct > 5 * c.n THEN 50 ELSE 20 END AS version,
             c.month + CAST(c.pct % 10 AS INTEGER) AS promo_start, p.list_price,
             round(p.list_price * (70 + month(c.month) % 10) / 100, 4) AS promo_price,
             c.city_id % 5 AS slot
      FROM (SELECT sub_family, city_id, CAST(date_trunc('month', sale_date) AS DATE) AS month,
                   sum(disc_pct) AS pct, count(*) AS n
            FROM lines GROUP BY ALL) c
      JOIN (SELECT sub_family, max(retail_price) AS list_price FROM items GROUP BY ALL) p
        ON p.sub_family = c.sub_family) x""",
    "plan": "SELECT * EXCLUDE (version) FROM promo_lines WHERE version = 50",
    "promo_headers": """
SELECT CAST(year(start) * 100 + month(start) AS INTEGER) AS promo_id, start, last_day(start) AS "end",
       CAST(year(start) AS INTEGER) AS year, CASE WHEN n_r > n_a THEN '-1' ELSE '1' END AS status
FROM (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS start,
             count(*) FILTER (return_flag = 'R') AS n_r, count(*) FILTER (return_flag = 'A') AS n_a
      FROM raw_lines GROUP BY ALL) h""",
    "stock": """
SELECT d.sub_family, d.store_id, d.city_id, d.sale_date,
       CASE WHEN (ascii(d.sub_family) * 31 + d.store_id * 17 + (d.sale_date - DATE '1970-01-05') * 7) % 23 = 0 THEN 0.0
            ELSE coalesce(m.moved, 0.0) + 1 END AS balance,
       CASE WHEN (ascii(d.sub_family) + d.store_id * 5 + (d.sale_date - DATE '1970-01-05')) % 29 = 0 THEN 'Y'
            ELSE 'N' END AS stopped
FROM (SELECT sub_family, store_id, city_id,
             CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS sale_date
      FROM lines GROUP BY sub_family, store_id, city_id) d
LEFT JOIN (SELECT sub_family, store_id, sale_date, sum(qty) AS moved FROM lines GROUP BY ALL) m
  USING (sub_family, store_id, sale_date)""",
    "sold_lines": "SELECT * FROM lines WHERE return_flag <> 'R'",
    "assortment_days": """
SELECT variant_id, store_id, sale_date, sum(qty) AS unit_count,
       CASE WHEN max(disc_pct) = 0 THEN 'Y' ELSE 'N' END AS stopped,
       CAST(sum(gross) AS DOUBLE) AS list_price
FROM raw_lines GROUP BY ALL""",
    "item_codes": """
SELECT brand, sale_date AS day, max(variant_id) AS code
FROM lines WHERE disc_pct = 0 AND tax_pct = 0 GROUP BY ALL""",
    "barcodes": """
SELECT item_id, variant_id AS barcode, sale_date AS created,
       CASE WHEN line_status = 'O' THEN 'Y' ELSE 'N' END AS main,
       CASE WHEN return_flag = 'R' THEN sale_date END AS ended
FROM lines""",
    "shipments": """
SELECT variant_id, store_id, sale_date AS delivery_date, qty, line_status || CAST(ticket_id AS VARCHAR) AS order_no
FROM lines WHERE return_flag = 'R'""",
    "payments": """
SELECT o_orderkey AS ticket_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS media_type
FROM orders""",
    "coupon_headers": """
SELECT o_orderkey AS activity_id, lpad(CAST(o_custkey % 4 + 1 AS VARCHAR), 2, '0') AS type_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'CP' WHEN '2-HIGH' THEN 'MPM' WHEN '3-MEDIUM' THEN 'MP'
            ELSE 'XX' END AS type_code,
       ['27', '02|25', '60', '4', '1', '58', '11', '16|34', '56', '37', '44', '9', '10'][o_orderkey % 13 + 1] AS count_code,
       CASE WHEN o_orderstatus = 'F' THEN 'S' ELSE 'C' END AS level, o_orderstatus AS status
FROM orders""",
    "coupon_periods": """
SELECT o_orderkey AS activity_id, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + 20 AS "end"
FROM orders""",
    "coupon_areas": """
SELECT a.activity_id,
       CASE WHEN o_orderstatus = 'F' THEN lpad(CAST(sa AS VARCHAR), greatest(9, length(CAST(sa AS VARCHAR)))::INTEGER, '0') || '|' || lpad(CAST(sb AS VARCHAR), greatest(9, length(CAST(sb AS VARCHAR)))::INTEGER, '0')
            ELSE lpad(CAST(ca AS VARCHAR), greatest(9, length(CAST(ca AS VARCHAR)))::INTEGER, '0') || '|' || lpad(CAST(cb AS VARCHAR), greatest(9, length(CAST(cb AS VARCHAR)))::INTEGER, '0') END AS area_list
FROM (SELECT ticket_id AS activity_id, min(city_id) AS ca, max(city_id) AS cb, min(store_id) AS sa, max(store_id) AS sb
      FROM lines GROUP BY ALL) a
JOIN orders ON o_orderkey = a.activity_id""",
    "coupon_items": "SELECT DISTINCT l_orderkey AS activity_id, l_partkey AS variant_id FROM lineitem",
    "climate": """
SELECT lpad(CAST(m.m AS VARCHAR), 2, '0') AS month, s.city_id, CAST(s.hi AS VARCHAR) AS high, CAST(s.lo AS VARCHAR) AS low
FROM (SELECT c_nationkey AS city_id, max(c_acctbal) AS hi, min(c_acctbal) AS lo FROM customer GROUP BY ALL) s,
     (SELECT unnest(range(1, 13)) AS m) m""",
    "competitor": """
SELECT c.c_nationkey AS city_id, i.item_id, CAST(o.o_orderdate AS DATE) AS created
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'P'
JOIN customer c ON c.c_custkey = o.o_custkey JOIN items i ON i.variant_id = l.l_partkey""",
    # ---- results other checks build on, in self-join form where Spark uses windows
    "weekly": """
SELECT item_id, sub_family, family, store_id, city_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
       sum(qty) AS qty, CAST(sum(gross) AS DOUBLE) AS gross, CAST(sum(coupon_disc) AS DOUBLE) AS coupon_disc,
       CAST(sum(promo_disc) AS DOUBLE) AS promo_disc, CAST(sum(member_disc) AS DOUBLE) AS member_disc,
       CAST(year(CAST(date_trunc('week', sale_date) AS DATE) + 6) AS INTEGER) AS year
FROM lines GROUP BY ALL""",
    # ---- bulk orders
    "sold_promo": """
SELECT l.*, p.promo_id FROM sold_lines l
LEFT JOIN plan p ON p.sub_family = l.sub_family AND p.city_id = l.city_id
                AND l.sale_date BETWEEN p.promo_start AND p.promo_end""",
    "day_groups": """
SELECT item_id, store_id, sale_date,
       CAST(sum(CASE WHEN prev IS NULL OR sale_date - prev >= 7 THEN 1 ELSE 0 END)
            OVER (PARTITION BY item_id, store_id ORDER BY sale_date) AS INTEGER) AS group_id
FROM (SELECT *, lag(sale_date) OVER (PARTITION BY item_id, store_id ORDER BY sale_date) AS prev
      FROM (SELECT DISTINCT item_id, store_id, sale_date FROM sold_lines) d) x""",
    "p90_regular": """
SELECT item_id, least(round(quantile_cont(qty, 0.9)), 50) AS p90
FROM (SELECT item_id, store_id, sale_date, hour, sum(qty) AS qty FROM sold_promo
      WHERE promo_id IS NULL AND coupon_disc = 0 AND promo_disc = 0 AND member_disc = 0 GROUP BY ALL) h
GROUP BY item_id""",
    "p90_promo": """
SELECT sub_family, least(round(quantile_cont(qty, 0.9)), 50) AS p90
FROM (SELECT sub_family, item_id, store_id, sale_date, hour, sum(qty) AS qty FROM sold_promo
      WHERE promo_id IS NOT NULL OR coupon_disc > 0 OR promo_disc > 0 OR member_disc > 0 GROUP BY ALL) h
GROUP BY sub_family""",
    "flagged_groups": """
WITH g AS (SELECT s.item_id, s.store_id, max(s.sub_family) AS sub_family, s.sale_date, max(s.ticket_id) AS ticket_id,
                  d.group_id, max(s.promo_id) AS promo_id, CAST(sum(s.member_disc) AS DOUBLE) AS member_disc,
                  CAST(sum(s.promo_disc) AS DOUBLE) AS promo_disc, CAST(sum(s.coupon_disc) AS DOUBLE) AS coupon_disc,
                  sum(s.qty) AS qty
           FROM sold_promo s JOIN day_groups d USING (item_id, store_id, sale_date)
           WHERE s.qty > 0 GROUP BY s.item_id, s.store_id, s.sale_date, d.group_id),
     b AS (SELECT g.*, r.p90, 175 AS factor FROM g LEFT JOIN p90_regular r USING (item_id)
           WHERE promo_id IS NULL AND member_disc = 0 AND promo_disc = 0 AND coupon_disc = 0
           UNION ALL
           SELECT g.*, r.p90, 200 AS factor FROM g LEFT JOIN p90_promo r USING (sub_family)
           WHERE promo_id IS NOT NULL OR member_disc > 0 OR promo_disc > 0 OR coupon_disc > 0)
SELECT b.* EXCLUDE (factor),
       CASE WHEN (qty > factor * log10(p90 + 1) AND group_id IS NOT NULL) OR qty >= 250
                 OR ticket_id IN (SELECT ticket_id FROM payments WHERE media_type = 2) THEN 1 ELSE 0 END AS abnormal_flag
FROM b""",
    "shipment_scope_rows": """
SELECT m.item_id, s.store_id, s.delivery_date, sum(s.qty) AS delivery_qty
FROM shipments s
JOIN (SELECT variant_id, sale_date, max(item_id) AS item_id FROM lines GROUP BY ALL) m
  ON m.variant_id = s.variant_id AND m.sale_date = s.delivery_date
WHERE s.order_no LIKE 'O%' AND s.store_id IN (SELECT store_id FROM stores WHERE balance >= 0)
GROUP BY ALL""",
    "candidates": """
SELECT g.item_id, g.store_id, g.sale_date, g.group_id, g.qty, s.delivery_date, s.delivery_qty
FROM flagged_groups g JOIN shipment_scope_rows s ON s.item_id = g.item_id AND s.store_id = g.store_id
 AND abs(s.delivery_date - g.sale_date) <= 35
WHERE g.abnormal_flag = 1""",
    "pair_sales": """
SELECT item_id, store_id, sale_date, max(group_id) AS group_id, max(qty) AS qty,
       row_number() OVER (PARTITION BY item_id, store_id ORDER BY sale_date) AS j
FROM candidates GROUP BY item_id, store_id, sale_date""",
    "pair_shipments": """
SELECT item_id, store_id, delivery_date, max(delivery_qty) AS qty,
       row_number() OVER (PARTITION BY item_id, store_id ORDER BY delivery_date) AS i
FROM candidates GROUP BY item_id, store_id, delivery_date""",
    "shipment_links": """
WITH RECURSIVE walk AS (
  SELECT h.item_id, h.store_id, h.i, CAST(1 AS BIGINT) AS j, h.qty AS stock, false AS paired, CAST(0 AS BIGINT) AS pi, CAST(0 AS BIGINT) AS pj
  FROM pair_shipments h WHERE h.i = 1
  UNION ALL
  SELECT w.item_id, w.store_id, w.i + CAST(move AS BIGINT), w.j + CASE WHEN move THEN 0 ELSE 1 END,
         CASE WHEN move THEN n.qty WHEN near THEN greatest(w.stock - w.sold, 0) ELSE w.stock END, near AND NOT move, w.i, w.j
  FROM (SELECT w.*, s.qty AS sold, abs(h.delivery_date - s.sale_date) < 35 AS near,
               w.stock <= 0 OR (abs(h.delivery_date - s.sale_date) >= 35 AND s.sale_date > h.delivery_date) AS move
        FROM walk w JOIN pair_shipments h ON h.item_id = w.item_id AND h.store_id = w.store_id AND h.i = w.i
        JOIN pair_sales s ON s.item_id = w.item_id AND s.store_id = w.store_id AND s.j = w.j) w
  LEFT JOIN pair_shipments n ON n.item_id = w.item_id AND n.store_id = w.store_id AND n.i = w.i + 1
  WHERE NOT move OR n.i IS NOT NULL)
SELECT s.item_id, s.store_id, s.sale_date, s.group_id, s.qty, h.delivery_date, h.qty AS delivery_qty
FROM walk w JOIN pair_sales s ON s.item_id = w.item_id AND s.store_id = w.store_id AND s.j = w.pj
JOIN pair_shipments h ON h.item_id = w.item_id AND h.store_id = w.store_id AND h.i = w.pi
WHERE w.paired""",
    "bulk_shares": """
SELECT item_id, store_id, sum(qty) AS qty, sum(delivery_qty) AS delivery_qty,
       sum(qty) / sum(delivery_qty) * 100 AS percent_flagged
FROM (SELECT item_id, store_id, group_id, sum(qty) AS qty, max(delivery_qty) AS delivery_qty
      FROM (SELECT DISTINCT item_id, store_id, group_id, qty, delivery_date, delivery_qty FROM shipment_links) d
      GROUP BY ALL) g
GROUP BY item_id, store_id""",
    "clean_lines": """
SELECT l.*, d.group_id
FROM sold_lines l JOIN day_groups d USING (item_id, store_id, sale_date)
WHERE NOT EXISTS (SELECT 1 FROM shipment_links c
                  WHERE c.item_id = l.item_id AND c.store_id = l.store_id AND c.group_id = d.group_id
                    AND NOT EXISTS (SELECT 1 FROM bulk_shares s WHERE s.item_id = c.item_id
                                    AND s.store_id = c.store_id AND s.percent_flagged > 20000))""",
    # ---- dense daily demand, from the lines without planned bulk
    "assortment_state": """
SELECT DISTINCT i.sub_family, a.store_id, a.sale_date, a.stopped
FROM assortment_days a JOIN items i ON i.variant_id = a.variant_id
WHERE a.stopped = 'N'""",
    "dense_days": """
SELECT s.sub_family, s.store_id, s.city_id, s.sale_date, CAST(dayofweek(s.sale_date) + 1 AS INTEGER) AS dow, a.stopped,
       CASE WHEN s.balance <= 0 THEN 1 ELSE 0 END AS out_of_stock, coalesce(d.qty, 0.0) AS qty
FROM stock s
LEFT JOIN assortment_state a USING (sub_family, store_id, sale_date)
LEFT JOIN (SELECT sub_family, store_id, sale_date, sum(qty) AS qty FROM clean_lines GROUP BY ALL) d
  USING (sub_family, store_id, sale_date)
WHERE s.balance > 0 OR a.stopped = 'N'""",
    "oos_medians": """
SELECT a.sub_family, a.store_id, a.sale_date, a.dow, a.out_of_stock, a.stopped, median(b.qty) AS median_qty
FROM dense_days a
JOIN dense_days b ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.dow = a.dow
                 AND b.sale_date BETWEEN a.sale_date - 90 AND a.sale_date
  AND (b.out_of_stock = 0 OR b.stopped = 'N')
WHERE a.out_of_stock = 1
GROUP BY a.sub_family, a.store_id, a.sale_date, a.dow, a.out_of_stock, a.stopped""",
    "dense_demand": """
SELECT d.*, m.median_qty, coalesce(x.gross, 0) AS gross, coalesce(x.coupon_disc, 0) AS coupon_disc,
       coalesce(x.promo_disc, 0) AS promo_disc, coalesce(x.member_disc, 0) AS member_disc, x.coupon_min, x.coupon_max,
       x.coupon_mean, x.coupon_std, coalesce(x.any_bulk, 0) AS any_bulk,
       CASE WHEN m.median_qty > d.qty THEN m.median_qty ELSE d.qty END AS demand
FROM dense_days d
LEFT JOIN (SELECT sub_family, store_id, sale_date, median_qty FROM oos_medians) m USING (sub_family, store_id, sale_date)
LEFT JOIN (SELECT sub_family, store_id, sale_date, CAST(sum(gross) AS DOUBLE) AS gross,
                  CAST(sum(coupon_disc) AS DOUBLE) AS coupon_disc, CAST(sum(promo_disc) AS DOUBLE) AS promo_disc,
                  CAST(sum(member_disc) AS DOUBLE) AS member_disc, CAST(min(coupon_disc) AS DOUBLE) AS coupon_min,
                  CAST(max(coupon_disc) AS DOUBLE) AS coupon_max,
                  CAST(sum(coupon_disc) AS DOUBLE) / count(coupon_disc) AS coupon_mean,
                  round(stddev_pop(CAST(coupon_disc AS DOUBLE)), 6) AS coupon_std,
                  max(CASE WHEN qty >= 50 THEN 1 ELSE 0 END) AS any_bulk
           FROM clean_lines GROUP BY ALL) x USING (sub_family, store_id, sale_date)""",
    "dense_promo": """
SELECT d.*, p.promo_id, p.promo_start, p.promo_end, CASE WHEN p.promo_id IS NULL THEN 0 ELSE 1 END AS on_promo,
       n.promo_id AS next_promo_id, n.promo_start AS next_promo_start
FROM dense_demand d
LEFT JOIN plan p ON p.sub_family = d.sub_family AND p.city_id = d.city_id
                AND d.sale_date BETWEEN p.promo_start AND p.promo_end
LEFT JOIN (SELECT d.sub_family, d.city_id, d.sale_date, min(q.promo_start) AS promo_start,
                  arg_min(q.promo_id, q.promo_start) AS promo_id
           FROM (SELECT DISTINCT sub_family, city_id, sale_date FROM dense_days) d
           JOIN plan q ON q.sub_family = d.sub_family AND q.city_id = d.city_id AND q.promo_start > d.sale_date GROUP BY ALL) n
  ON n.sub_family = d.sub_family AND n.city_id = d.city_id AND n.sale_date = d.sale_date""",
    "dense_weeks": """
SELECT w.*, c.week_key, c.year, c.month_start, c.first_day, c.last_day, c.n_days, c.holiday_days, p.promo_start,
       p.promo_end, p.promo_price, p.list_price, p.slot, p.announced, q.promo_start AS next_promo_start,
       q.promo_end AS next_promo_end, q.announced AS next_announced
FROM (SELECT sub_family, store_id, city_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(demand) AS qty,
             sum(CAST(gross AS DECIMAL(18,4)))::DOUBLE AS gross,
             sum(CAST(coupon_disc AS DECIMAL(18,4)))::DOUBLE AS coupon_disc,
             sum(CAST(promo_disc AS DECIMAL(18,4)))::DOUBLE AS promo_disc,
             sum(CAST(member_disc AS DECIMAL(18,4)))::DOUBLE AS member_disc,
             min(coupon_min) AS coupon_min, max(coupon_max) AS coupon_max, CAST(sum(CAST(coupon_mean AS DECIMAL(24,8))) AS DOUBLE) / count(coupon_mean) AS coupon_mean,
             CAST(count(DISTINCT promo_id) AS INTEGER) AS n_current,
             CAST(count(DISTINCT next_promo_id) AS INTEGER) AS n_next, max(promo_id) AS promo_id,
             max(next_promo_id) AS next_promo_id, max(out_of_stock) AS any_oos, max(any_bulk) AS any_bulk
      FROM dense_promo GROUP BY ALL) w
JOIN (SELECT week_start, max(week_key) AS week_key, max(year) AS year, max(month_start) AS month_start,
             min(day) AS first_day, max(day) AS last_day, count(*) AS n_days,
             CAST(sum(holiday) AS INTEGER) AS holiday_days FROM calendar GROUP BY ALL) c USING (week_start)
LEFT JOIN plan p ON p.sub_family = w.sub_family AND p.city_id = w.city_id AND p.promo_id = w.promo_id
LEFT JOIN plan q ON q.sub_family = w.sub_family AND q.city_id = w.city_id AND q.promo_id = w.next_promo_id""",
    # ---- coupons
    "coupons": """
SELECT DISTINCT h.activity_id, h.type_id, h.type_code, h.count_code, h.level, a.area_list, p.start, p."end",
       i.variant_id, m.item_id
FROM coupon_headers h
LEFT JOIN coupon_areas a ON a.activity_id = h.activity_id
LEFT JOIN coupon_periods p ON p.activity_id = h.activity_id
LEFT JOIN coupon_items i ON i.activity_id = h.activity_id
JOIN items m ON m.variant_id = i.variant_id
WHERE h.status = 'O'
UNION
SELECT DISTINCT h.activity_id, h.type_id, h.type_code, h.count_code, h.level, a.area_list, p.start, p."end",
       i.variant_id, m.item_id
FROM coupon_headers h
LEFT JOIN coupon_areas a ON a.activity_id = h.activity_id
LEFT JOIN coupon_periods p ON p.activity_id = h.activity_id
LEFT JOIN coupon_items i ON i.activity_id = h.activity_id
JOIN items m ON m.variant_id = i.variant_id
WHERE h.status = 'F'""",
    "coupon_week_rows": """
SELECT DISTINCT c.activity_id, c.item_id, c.level, c.type_id, c.type_code, c.count_code, c.area_list,
       CAST(date_trunc('week', d.day) AS DATE) AS week_start
FROM coupons c, LATERAL (SELECT unnest(generate_series(c.start, c."end", INTERVAL 1 DAY)) AS day) d""",
    "coupon_places": """
SELECT DISTINCT item_id, week_start, level, CAST(place AS BIGINT) AS place_id, activity_id, type_id, type_code, count_code
FROM (SELECT *, unnest(string_split(area_list, '|')) AS place FROM coupon_week_rows)""",
    "coupon_links": """
SELECT w.item_id, w.week_start, w.level, w.place_id, c.activity_id, c.type_id, c.type_code, c.count_code
FROM (SELECT DISTINCT item_id, week_start, 'C' AS level, CAST(city_id AS BIGINT) AS place_id FROM weekly
      UNION ALL SELECT DISTINCT item_id, week_start, 'S', CAST(store_id AS BIGINT) FROM weekly) w
LEFT JOIN coupon_places c ON c.item_id = w.item_id AND c.week_start = w.week_start AND c.level = w.level
                         AND c.place_id = w.place_id""",
    "coupon_code_rows": """
SELECT w.item_id, w.store_id, w.week_start, w.qty, w.gross, w.coupon_disc, c.* EXCLUDE (item_id, store_id, week_start)
FROM weekly w
LEFT JOIN (SELECT item_id, store_id, week_start, string_agg(DISTINCT type_id, ',' ORDER BY type_id) AS type_ids,
                  string_agg(DISTINCT type_code, ',' ORDER BY type_code) AS type_codes,
                  string_agg(DISTINCT count_code, ',' ORDER BY count_code) AS count_codes,
                  CAST(count(DISTINCT type_id) AS INTEGER) AS n_type_id,
                  CAST(count(DISTINCT type_code) AS INTEGER) AS n_type_code,
                  CAST(count(DISTINCT count_code) AS INTEGER) AS n_count_code
           FROM (SELECT w.item_id, w.store_id, w.week_start, c.type_id, c.type_code, c.count_code
                 FROM weekly w JOIN coupon_places c ON c.item_id = w.item_id AND c.week_start = w.week_start
                  AND c.place_id = CASE c.level WHEN 'C' THEN w.city_id ELSE w.store_id END) m GROUP BY ALL) c
  ON c.item_id = w.item_id AND c.store_id = w.store_id AND c.week_start = w.week_start""",
    "coupon_dummy_rows": """
SELECT *, CAST(coalesce(instr(type_ids, '01') >= 1, false) AS INTEGER) AS type_dd,
       CAST(coalesce(instr(type_ids, '02') >= 1, false) AS INTEGER) AS type_np,
       CAST(coalesce(instr(type_ids, '03') >= 1, false) AS INTEGER) AS type_ac,
       CAST(coalesce(instr(type_ids, '04') >= 1, false) AS INTEGER) AS type_cc,
       CAST(coalesce(instr(type_codes, 'CP') >= 1, false) AS INTEGER) AS code_cp,
       CAST(coalesce(instr(type_codes, 'MPM') >= 1, false) AS INTEGER) AS code_mpm,
       CAST(coalesce(instr(type_codes, 'MP') >= 1, false) AS INTEGER) AS code_mp,
       CAST(coalesce(NOT regexp_matches(type_codes, 'CP|MP'), false) AS INTEGER) AS code_other,
       CAST(coalesce(instr(count_codes, '27') >= 1, false) AS INTEGER) AS count_27,
       CAST(coalesce(instr(count_codes, '02|25') >= 1, false) AS INTEGER) AS count_02_25,
       CAST(coalesce(instr(count_codes, '60') >= 1, false) AS INTEGER) AS count_60,
       CAST(coalesce(instr(count_codes, '4') >= 1, false) AS INTEGER) AS count_4,
       CAST(coalesce(instr(count_codes, '1') >= 1, false) AS INTEGER) AS count_1,
       CAST(coalesce(instr(count_codes, '58') >= 1, false) AS INTEGER) AS count_58,
       CAST(coalesce(instr(count_codes, '11') >= 1, false) AS INTEGER) AS count_11,
       CAST(coalesce(instr(count_codes, '16|34') >= 1, false) AS INTEGER) AS count_16_34,
       CAST(coalesce(instr(count_codes, '56') >= 1, false) AS INTEGER) AS count_56,
       CAST(coalesce(instr(count_codes, '37') >= 1, false) AS INTEGER) AS count_37,
       CAST(coalesce(instr(count_codes, '44') >= 1, false) AS INTEGER) AS count_44,
       CAST(coalesce(instr(count_codes, '9') >= 1, false) AS INTEGER) AS count_9,
       CAST(coalesce(instr(count_codes, '10') >= 1, false) AS INTEGER) AS count_10,
       CAST(coalesce(NOT regexp_matches(count_codes, '27|02\\|25|60|4|1|58|56|37|9'), false) AS INTEGER) AS count_other
FROM coupon_code_rows""",
    # ---- promotion table
    "promo_day_sales": """
SELECT item_id, store_id, sub_family, family, brand, city_id, sale_date, sum(qty) AS qty, sum(reward) AS reward,
       sum(CASE WHEN qty > 0 THEN qty END) AS positive_qty
FROM lines GROUP BY ALL""",
    "promos": """
WITH past AS (SELECT d.item_id, d.store_id, d.sub_family, d.city_id, p.promo_id, sum(d.qty) AS sales
              FROM promo_day_sales d JOIN plan p ON p.sub_family = d.sub_family AND p.city_id = d.city_id
               AND d.sale_date BETWEEN p.promo_start AND p.promo_end
              WHERE d.sale_date <= DATE '2001-06-30' GROUP BY ALL),
     coming AS (SELECT s.item_id, s.store_id, s.sub_family, s.city_id, p.promo_id, CAST(NULL AS DOUBLE) AS sales
                FROM plan p JOIN (SELECT DISTINCT item_id, store_id, sub_family, city_id FROM promo_day_sales) s
                  ON s.sub_family = p.sub_family AND s.city_id = p.city_id
                WHERE p.promo_start > DATE '2001-06-30'
                  AND NOT EXISTS (SELECT 1 FROM past x WHERE x.item_id = s.item_id AND x.store_id = s.store_id
                                  AND x.promo_id = p.promo_id))
SELECT u.*, p.promo_price, p.list_price, p.promo_start, p.promo_end, p.slot,
       round(p.promo_price / nullif(p.list_price, 0), 3) AS price_ratio,
       CAST(date_trunc('week', p.promo_start) AS DATE) AS start_week,
       CAST(date_trunc('week', p.promo_end) AS DATE) AS end_week,
       CAST(date_trunc('month', p.promo_start) AS DATE) AS start_month
FROM (SELECT * FROM past UNION ALL SELECT * FROM coming) u
JOIN plan p ON p.sub_family = u.sub_family AND p.city_id = u.city_id AND p.promo_id = u.promo_id""",
    "promo_map": """
SELECT promo_id, CAST(start - INTERVAL 1 YEAR AS DATE) AS last_start, CAST(start - INTERVAL 1 YEAR AS DATE) + 20 AS last_end
FROM promo_headers""",
    "lunar_map": """
SELECT week_start, lunar_week, CAST(date_trunc('week', lunar_week - 15) AS DATE) AS from_15,
       CAST(date_trunc('week', lunar_week + 15) AS DATE) AS to_15,
       CAST(date_trunc('week', lunar_week - 45) AS DATE) AS from_45,
       CAST(date_trunc('week', lunar_week + 45) AS DATE) AS to_45
FROM (SELECT week_start, max(lw) OVER (ORDER BY week_start) AS lunar_week
      FROM (SELECT a.week_start, min(b.week_start) AS lw FROM calendar a LEFT JOIN calendar b ON b.day = a.lunar_day
            GROUP BY ALL) m) f""",
    "lunar_promos": """
SELECT a.item_id, a.store_id, a.promo_id, a.sales, a.start_week, m.lunar_week,
       sum(b.sales) FILTER (b.start_week BETWEEN m.from_15 AND m.to_15)
         / nullif(count(b.sales) FILTER (b.start_week BETWEEN m.from_15 AND m.to_15), 0) AS lunar_mean_1m,
       sum(b.sales) FILTER (b.start_week BETWEEN m.from_15 AND m.to_15) AS lunar_sum_1m,
       CAST(sum(CAST(b.price_ratio AS DECIMAL(24,8))) FILTER (b.start_week BETWEEN m.from_15 AND m.to_15) AS DOUBLE)
         / nullif(count(b.price_ratio) FILTER (b.start_week BETWEEN m.from_15 AND m.to_15), 0) AS lunar_ratio_1m,
       sum(b.sales) / nullif(count(b.sales), 0) AS lunar_mean_3m, sum(b.sales) AS lunar_sum_3m,
       CAST(sum(CAST(b.price_ratio AS DECIMAL(24,8))) AS DOUBLE) / nullif(count(b.price_ratio), 0) AS lunar_ratio_3m
FROM promos a LEFT JOIN lunar_map m ON m.week_start = a.start_week
LEFT JOIN promos b ON b.item_id = a.item_id AND b.store_id = a.store_id AND b.start_week BETWEEN m.from_45 AND m.to_45
GROUP BY ALL""",
    "matched": """
SELECT d.item_id, d.store_id, d.sub_family, d.city_id, p.promo_id, sum(d.qty) AS matched_sales,
       CAST(sum(d.reward) AS DOUBLE) AS matched_reward
FROM (SELECT DISTINCT sub_family, city_id, promo_id FROM plan) p
JOIN promo_map m ON m.promo_id = p.promo_id
JOIN promo_day_sales d ON d.sub_family = p.sub_family AND d.city_id = p.city_id
 AND d.sale_date >= m.last_start AND d.sale_date <= m.last_end
GROUP BY ALL HAVING sum(d.reward) > 0""",
    "uplift_rows": """
WITH sold AS (SELECT d.store_id, d.sub_family, d.brand, d.item_id, p.promo_id, m.last_start, m.last_end, sum(d.qty) AS q
              FROM (SELECT DISTINCT promo_id, sub_family FROM plan) p JOIN promo_map m ON m.promo_id = p.promo_id
              JOIN promo_day_sales d ON d.sub_family = p.sub_family AND d.sale_date BETWEEN m.last_start AND m.last_end
              GROUP BY ALL HAVING sum(d.reward) > 0)
SELECT a.*, b.prior_sales
FROM (SELECT store_id, sub_family, brand, promo_id, min(last_start) AS last_start, min(last_end) AS last_end,
             sum(q) AS promo_sales FROM sold GROUP BY ALL) a
JOIN (SELECT s.store_id, s.sub_family, s.brand, s.promo_id, sum(d.positive_qty) AS prior_sales
      FROM sold s JOIN promo_day_sales d ON d.item_id = s.item_id AND d.store_id = s.store_id
       AND d.sale_date BETWEEN s.last_start - 14 AND s.last_start
      WHERE d.positive_qty > 0 GROUP BY ALL) b
  ON b.store_id = a.store_id AND b.sub_family = a.sub_family AND b.brand = a.brand AND b.promo_id = a.promo_id""",
    "baselines": """
SELECT p.item_id, p.store_id, p.promo_id, p.sub_family, p.promo_start, p.sales, coalesce(sum(d.positive_qty), 0) AS baseline
FROM promos p
LEFT JOIN promo_day_sales d ON d.item_id = p.item_id AND d.store_id = p.store_id
 AND d.sale_date BETWEEN p.promo_start - 56 AND p.promo_start - 28
GROUP BY ALL""",
    "uplifts": """
SELECT p.item_id, p.store_id, p.promo_id, p.sales, (u.promo_sales / nullif(u.last_end - u.last_start, 0))
         / nullif(u.prior_sales / 14, 0) AS uplift
FROM promos p
LEFT JOIN uplift_rows u ON u.store_id = p.store_id AND u.promo_id = p.promo_id AND u.sub_family = p.sub_family
  AND u.brand = split_part(p.item_id, '|', 2)""",
    # ---- splitting forecasts into days
    "regular_day_rows": """
SELECT d.sub_family, d.store_id, d.sale_date, d.out_of_stock, d.demand, w.week_start, d.dow
FROM dense_promo d
JOIN dense_weeks w ON w.sub_family = d.sub_family AND w.store_id = d.store_id
                  AND w.week_start = date_trunc('week', d.sale_date)
WHERE w.holiday_days = 0 AND w.n_current = 0 AND w.qty <> 0
  AND w.week_start > (SELECT min(week_start) FROM calendar) AND w.week_start < (SELECT max(week_start) FROM calendar)""",
    "good_day_rows": """
SELECT r.* FROM regular_day_rows r
JOIN (SELECT sub_family, store_id, week_start FROM regular_day_rows GROUP BY ALL HAVING count(DISTINCT dow) = 7) g
  ON g.sub_family = r.sub_family AND g.store_id = r.store_id AND g.week_start = r.week_start""",
    "weekday_shares": """
SELECT a.sub_family, a.store_id, a.dow, a.day_sales, b.all_sales, a.day_sales / nullif(b.all_sales, 0) AS share
FROM (SELECT sub_family, store_id, dow, sum(demand) AS day_sales FROM good_day_rows GROUP BY ALL) a
JOIN (SELECT sub_family, store_id, sum(demand) AS all_sales FROM good_day_rows GROUP BY ALL) b
  ON b.sub_family = a.sub_family AND b.store_id = a.store_id""",
    "event_weeks": """
SELECT * FROM (VALUES ('CNY', 199806), ('CNY', 199807), ('WM', 199809), ('WM', 199810), ('SD', 199845), ('SD', 199846))
  v(event, week_key)""",
    "event_impacts": """
WITH d AS (SELECT p.sub_family, p.store_id, p.sale_date, p.demand, e.event FROM dense_promo p
           JOIN calendar c ON c.day = p.sale_date JOIN event_weeks e ON e.week_key = c.week_key)
SELECT a.sub_family, a.store_id, a.sale_date, a.event, a.daily_mean, b.all_mean,
       (a.daily_mean - b.all_mean) / nullif(b.all_mean, 0) AS impact
FROM (SELECT sub_family, store_id, sale_date, event, avg(demand) AS daily_mean FROM d GROUP BY ALL) a
JOIN (SELECT sub_family, store_id, event, avg(demand) AS all_mean FROM d GROUP BY ALL) b
  ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.event = a.event""",
    "forecast_in": """
SELECT sub_family, store_id, week_start, qty, forecast, err2, forecast + 3 * sqrt(abs(err2)) AS upper
FROM (SELECT a.sub_family, a.store_id, a.week_start, a.qty, avg(b.qty) FILTER (a.rn - b.rn <= 4) AS forecast,
             sum(b.qty * b.qty) FILTER (a.rn - b.rn <= 12) / (count(*) FILTER (a.rn - b.rn <= 12))
               - (avg(b.qty) FILTER (a.rn - b.rn <= 12)) * (avg(b.qty) FILTER (a.rn - b.rn <= 12)) AS err2
      FROM (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM dense_weeks) a
      JOIN (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM dense_weeks) b
        ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.rn < a.rn AND a.rn - b.rn <= 12
      GROUP BY ALL) x""",
    "order_rows": """
SELECT a.sub_family, a.store_id, a.week_start, a.qty, a.forecast, a.err2, a.upper,
       coalesce(a.upper - (b.upper - b.forecast), a.upper) AS order_qty
FROM (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM forecast_in) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) AS rn FROM forecast_in) b
  ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.rn = a.rn - 1""",
    "promo_forecast_in": """
SELECT sub_family, store_id, promo_id, promo_start, promo_end, forecast, forecast + 1.28 * sqrt(abs(err2)) AS upper
FROM (SELECT sub_family, store_id, promo_id, promo_start, promo_end, sum(demand) AS forecast,
             sum(demand * demand) AS err2
      FROM dense_promo WHERE promo_id IS NOT NULL GROUP BY ALL) x""",
    "patterns": """
SELECT DISTINCT CAST(promo_end - promo_start AS INTEGER) AS length, CAST(dayofweek(promo_start) + 1 AS INTEGER) AS start_dow,
       CAST(dayofweek(promo_end) + 1 AS INTEGER) AS end_dow,
       'P' || CAST(dayofweek(promo_start) + 1 AS VARCHAR) || CAST(dayofweek(promo_end) + 1 AS VARCHAR) AS pattern
FROM plan""",
    "promo_day_rows": """
SELECT f.sub_family, f.store_id, f.promo_id, f.promo_start, f.promo_end, f.forecast, f.upper, f.upper AS order_qty,
       CAST(f.promo_end - f.promo_start AS INTEGER) AS length, c.day AS sale_date, p.pattern,
       CAST(dayofweek(c.day) + 1 AS INTEGER) AS dow, CAST(c.day - f.promo_start AS INTEGER) AS day_no
FROM promo_forecast_in f
JOIN LATERAL (SELECT CAST(unnest(generate_series(f.promo_start, f.promo_end, INTERVAL 1 DAY)) AS DATE) AS day) c ON true
LEFT JOIN patterns p ON p.length = f.promo_end - f.promo_start AND p.start_dow = dayofweek(f.promo_start) + 1
                    AND p.end_dow = dayofweek(f.promo_end) + 1""",
    "promo_history_days": """
SELECT d.sub_family, d.store_id, d.sale_date, d.demand, d.promo_id, d.promo_start, d.promo_end,
       CAST(d.promo_end - d.promo_start AS INTEGER) AS length, p.pattern
FROM dense_promo d
LEFT JOIN patterns p ON p.length = d.promo_end - d.promo_start AND p.start_dow = dayofweek(d.promo_start) + 1
                    AND p.end_dow = dayofweek(d.promo_end) + 1
WHERE d.promo_id IS NOT NULL""",
    "promo_day_shares": """
SELECT a.sub_family, a.store_id, a.pattern, a.day_no, a.day_sales, b.all_sales,
       CASE WHEN b.all_sales = 0 THEN 0 ELSE a.day_sales / nullif(b.all_sales, 0) END AS share
FROM (SELECT sub_family, store_id, pattern, CAST(sale_date - promo_start AS INTEGER) AS day_no, sum(demand) AS day_sales
      FROM promo_history_days WHERE pattern IS NOT NULL GROUP BY ALL) a
JOIN (SELECT sub_family, store_id, pattern, sum(demand) AS all_sales
      FROM promo_history_days WHERE pattern IS NOT NULL GROUP BY ALL) b
  ON b.sub_family = a.sub_family AND b.store_id = a.store_id AND b.pattern = a.pattern""",
    # ---- model table: weekly sales per sub family and store
    "weekly_sf": """
SELECT sub_family, store_id, city_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(qty) AS qty,
       CAST(sum(gross) AS DOUBLE) AS gross, max(CASE WHEN qty >= 50 THEN 1 ELSE 0 END) AS bulk,
       sum(CASE WHEN return_flag = 'R' THEN -qty ELSE qty END) AS net
FROM lines GROUP BY ALL""",
    "dense_sf": """
SELECT g.sub_family, g.store_id, g.week_start, coalesce(w.qty, -1.0) AS qty, w.gross, w.bulk, w.net, w.city_id
FROM (SELECT s.sub_family, s.store_id, x.w AS week_start
      FROM (SELECT DISTINCT sub_family, store_id FROM weekly_sf) s
      JOIN (SELECT sub_family, CAST(unnest(generate_series(min(week_start), max(week_start), INTERVAL 7 DAY)) AS DATE) AS w
            FROM weekly_sf GROUP BY sub_family) x ON x.sub_family = s.sub_family) g
LEFT JOIN weekly_sf w ON w.sub_family = g.sub_family AND w.store_id = g.store_id AND w.week_start = g.week_start""",
    "naive_sf": """
SELECT sub_family, store_id, week_start, qty,
       avg(qty) OVER (PARTITION BY sub_family, store_id ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS forecast
FROM weekly_sf
QUALIFY row_number() OVER (PARTITION BY sub_family, store_id ORDER BY week_start) > 1""",
}
