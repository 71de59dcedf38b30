"""The registered queries once more as SQL over the sample tables, written independently of the Spark
plans: range joins, scalar subqueries, set operators and plain windows where the plans avoid them.

Money is compared in whole cents. Means are rounded with integer arithmetic, half away from zero.
"""

from __future__ import annotations

# Views over the sample tables, in order of dependency.
_VIEWS = {
    "customer_v": """
        SELECT c_custkey AS customer_id, c_name AS first_name, n_name AS last_name,
          CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'F' WHEN 3 THEN 'M' ELSE 'U' END AS gender,
          CASE WHEN c_custkey % 17 <> 0
            THEN DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INT) END AS dob,
          CASE c_custkey % 4 WHEN 0 THEN 'Senior Analyst' WHEN 1 THEN 'Lead Engineer'
            WHEN 2 THEN 'Junior Analyst' END AS job_title,
          CASE c_mktsegment WHEN 'MACHINERY' THEN 'IT' WHEN 'BUILDING' THEN 'Financial Services'
            WHEN 'HOUSEHOLD' THEN 'Health' WHEN 'FURNITURE' THEN 'n/a' END AS job_industry_category,
          CASE c_custkey % 3 WHEN 0 THEN 'Mass Customer' WHEN 1 THEN 'High Net Worth'
            ELSE 'Affluent Customer' END AS wealth_segment,
          CASE WHEN c_custkey % 11 = 0 THEN 'Y' ELSE 'N' END AS deceased_indicator,
          CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS owns_car,
          c_nationkey || ' Market Street' AS address,
          CAST(4000 + c_nationkey * 10 + c_custkey % 10 AS VARCHAR) AS postcode,
          n_name AS state, r_name AS country, c_nationkey AS nation_no,
          CAST(floor(c_acctbal / 1000) AS INT) + 2 AS property_valuation
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "product_v": """
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 101 <> 0 THEN p_brand END AS brand,
          CASE p_type WHEN 'PROMO' THEN 'Road' WHEN 'STANDARD' THEN 'Standard' WHEN 'MEDIUM' THEN 'Mountain'
            ELSE 'Touring' END AS product_line,
          CASE WHEN p_size <= 15 THEN 'low' WHEN p_size <= 35 THEN 'medium' ELSE 'high' END AS product_class,
          CAST(p_size AS VARCHAR) AS product_size,
          CAST(p_retailprice AS DECIMAL(10,2)) AS list_price,
          CAST(p_retailprice * 0.8 AS DECIMAL(10,2)) AS standard_cost
        FROM part""",
    "orders_v": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN TRUE
            WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN FALSE END AS online_order,
          CASE WHEN o_orderstatus = 'F' THEN 'Approved' ELSE 'Cancelled' END AS order_status
        FROM orders""",
    "items_v": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
          CAST(l_quantity AS INT) AS quantity,
          CAST(l_extendedprice AS DECIMAL(10,2)) AS item_price,
          CAST(l_quantity AS BIGINT) * CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * 100 AS BIGINT) AS cents
        FROM lineitem""",
    "booking_v": """
        SELECT CAST(o_orderkey AS VARCHAR) AS ID, CAST(o_orderkey % 3 + 1 AS INT) AS n_adults,
          CAST(o_orderkey % 2 AS INT) AS n_children, CAST(o_orderkey % 3 AS INT) AS weekend_nights,
          CAST(o_orderkey % 5 AS INT) AS week_nights, 'Meal Plan ' || (o_orderkey % 4) AS meal_plan,
          CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS car_parking_space,
          'Room_Type ' || (o_orderkey % 7 + 1) AS room_type, CAST(o_orderkey % 300 AS INT) AS lead_time,
          CAST(year(o_orderdate) AS INT) AS "year", CAST(month(o_orderdate) AS INT) AS "month",
          CAST(CASE WHEN o_orderkey % 97 = 0 THEN 31 ELSE day(o_orderdate) END AS INT) AS "date",
          o_orderpriority AS market_segment, CASE WHEN o_custkey % 10 = 0 THEN 1 ELSE 0 END AS repeated_guest,
          CAST((o_orderkey % 13) // 12 AS INT) AS previous_cancellations,
          CAST(o_orderkey % 6 AS INT) AS previous_bookings_not_canceled,
          CAST(o_totalprice AS DECIMAL(10,2)) AS avg_room_price, CAST(o_orderkey % 4 AS INT) AS special_requests,
          CASE o_orderstatus WHEN 'P' THEN 'Canceled' ELSE 'Not_Canceled' END AS status
        FROM orders""",
    "stay_v": """
        SELECT *, TRY_CAST(format('{:04d}-{:02d}-{:02d}', "year", "month", "date") AS DATE) AS arrival_date,
          week_nights + weekend_nights AS total_nights, n_adults + n_children AS total_guests,
          CAST(avg_room_price * 100 AS BIGINT) * (week_nights + weekend_nights) AS revenue_cents
        FROM booking_v""",
    "movie_v": """
        SELECT CAST(p_partkey AS VARCHAR) AS _id, CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS title,
          CASE WHEN p_size % 7 <> 0 THEN p_size + 1900 END AS "year", p_partkey,
          CASE WHEN p_partkey % 19 = 0 OR p_partkey % 23 = 0 THEN NULL
            ELSE CASE split_part(p_name, ' ', 1) WHEN 'red' THEN 'Horror' WHEN 'blue' THEN 'Film-Noir'
              WHEN 'hot' THEN 'Drama' ELSE split_part(p_name, ' ', 1) END END AS first_genre,
          split_part(p_name, ' ', 2) AS second_genre
        FROM part""",
    "raw_customer_v": """
        SELECT customer_id, first_name, last_name,
          CASE customer_id % 6 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'F' WHEN 3 THEN 'U'
            WHEN 4 THEN 'M' ELSE 'Femal' END AS gender,
          CASE WHEN customer_id % 19 = 0 THEN 'unknown' ELSE strftime(dob, '%Y-%m-%d') END AS dob_text,
          job_title,
          CASE WHEN job_industry_category IS NULL AND customer_id % 2 = 0 THEN 'N/A'
            ELSE job_industry_category END AS job_industry_category,
          wealth_segment, CASE WHEN customer_id % 29 <> 0 THEN deceased_indicator END AS deceased_indicator,
          CASE WHEN customer_id % 31 <> 0 THEN owns_car END AS owns_car, address,
          CAST(4000 + (nation_no // 2) * 10 + customer_id % 10 AS VARCHAR) AS postcode,
          CASE state WHEN 'NATION_1' THEN 'VIC' WHEN 'NATION_6' THEN 'Victoria'
            WHEN 'NATION_2' THEN 'New South Wales' WHEN 'NATION_7' THEN 'NSW'
            WHEN 'NATION_3' THEN 'Border' WHEN 'NATION_4' THEN 'Border' ELSE state END AS state,
          country, property_valuation
        FROM customer_v""",
    "raw_transaction_v": """
        SELECT transaction_id, l.product_id, o.customer_id, o.order_date,
          o.online_order, o.order_status, p.brand, p.product_line, p.product_class, p.product_size,
          CASE WHEN transaction_id % 53 = 0 THEN 'abc'
            ELSE replace(CAST(l.price AS VARCHAR), '.', ',') END AS list_price,
          CASE WHEN p.brand IS NOT NULL
            THEN replace(CAST(p.standard_cost AS VARCHAR), '.', ',') END AS standard_cost
        FROM (SELECT l_orderkey AS order_id, l_partkey AS product_id,
                CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
                CAST('0x' || left(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                  CAST(l_quantity AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT))), 15) AS BIGINT)
                  AS transaction_id
              FROM lineitem) l
        JOIN orders_v o USING (order_id) JOIN product_v p USING (product_id)""",
    "transaction_name_v": """
        SELECT DISTINCT dimension, name FROM (
          SELECT 'order_statuses' AS dimension, order_status AS name FROM raw_transaction_v
          UNION SELECT 'brands', brand FROM raw_transaction_v
          UNION SELECT 'product_lines', product_line FROM raw_transaction_v
          UNION SELECT 'product_classes', product_class FROM raw_transaction_v
          UNION SELECT 'product_sizes', product_size FROM raw_transaction_v) WHERE name IS NOT NULL""",
    "customer_name_v": """
        SELECT DISTINCT dimension, name FROM (
          SELECT 'job_industries' AS dimension, job_industry_category AS name FROM raw_customer_v
            WHERE lower(job_industry_category) <> 'n/a'
          UNION SELECT 'wealth_segments', wealth_segment FROM raw_customer_v) WHERE name IS NOT NULL""",
    "member_v": """
        SELECT dimension, name,
          row_number() OVER (PARTITION BY dimension ORDER BY left(md5(name), 3), name) AS id
        FROM (SELECT * FROM customer_name_v UNION ALL SELECT * FROM transaction_name_v)""",
    "fact_product_v": """
        SELECT f.product_id, coalesce(b.id, 0) AS brand_id, coalesce(pl.id, 0) AS product_line_id,
          coalesce(pc.id, 0) AS product_class_id, coalesce(ps.id, 0) AS product_size_id,
          TRY_CAST(replace(f.list_price, ',', '.') AS DECIMAL(10,2)) AS list_price,
          coalesce(TRY_CAST(replace(f.standard_cost, ',', '.') AS DECIMAL(10,2)), 0) AS standard_cost
        FROM (SELECT * FROM raw_transaction_v
              QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY transaction_id) = 1) f
        LEFT JOIN member_v b ON b.dimension = 'brands' AND b.name = f.brand
        LEFT JOIN member_v pl ON pl.dimension = 'product_lines' AND pl.name = f.product_line
        LEFT JOIN member_v pc ON pc.dimension = 'product_classes' AND pc.name = f.product_class
        LEFT JOIN member_v ps ON ps.dimension = 'product_sizes' AND ps.name = f.product_size""",
    "fact_transaction_v": """
        SELECT t.transaction_id, t.product_id, t.customer_id, t.order_date AS transaction_date, t.online_order,
          s.id AS order_status_id
        FROM raw_transaction_v t LEFT JOIN member_v s ON s.dimension = 'order_statuses' AND s.name = t.order_status
        WHERE t.customer_id IN (SELECT customer_id FROM customer_v WHERE deceased_indicator = 'N')""",
    "sale_v": """
        SELECT o.*, i.order_item_id, i.product_id, i.quantity, i.cents
        FROM orders_v o JOIN items_v i ON i.order_id = o.order_id""",
    "order_value_v": """
        SELECT customer_id, order_id, CAST(sum(cents) AS BIGINT) AS cents
        FROM sale_v WHERE order_status = 'Approved' GROUP BY customer_id, order_id""",
    "total_v": """
        SELECT c.customer_id, c.first_name, c.last_name,
          coalesce((SELECT sum(v.cents) FROM order_value_v v WHERE v.customer_id = c.customer_id), 0) AS cents
        FROM customer_v c""",
    "segment_rank_v": """
        SELECT c.first_name, c.last_name, c.wealth_segment, t.cents,
          row_number() OVER (PARTITION BY c.wealth_segment ORDER BY t.cents DESC, c.customer_id) AS place
        FROM customer_v c
        JOIN (SELECT customer_id, sum(cents) AS cents FROM order_value_v GROUP BY customer_id) t USING (customer_id)""",
}

_STATS = """
    SELECT customer_id, CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue,
      CAST(max(cents) AS DOUBLE) / 100 AS max_order_value, CAST(min(cents) AS DOUBLE) / 100 AS min_order_value,
      count(*) AS orders_count,
      CAST((2 * CAST(sum(cents) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_order_value
    FROM order_value_v GROUP BY customer_id"""

_QUERIES = {
    # --- shop: relational questions ---
    "shop_high_cost_brands": """
        SELECT brand FROM (
          SELECT p.brand, i.quantity FROM items_v i, product_v p
          WHERE i.product_id = p.product_id AND p.standard_cost > 775)
        GROUP BY brand HAVING sum(quantity) >= 1000""",
    "shop_daily_online_orders": """
        SELECT order_date, count(DISTINCT order_id) AS cnt_order, count(DISTINCT customer_id) AS cnt_customers
        FROM orders_v
        WHERE online_order AND order_status = 'Approved' AND year(order_date) IN (1997, 1998)
        GROUP BY order_date""",
    "shop_distinct_by_period": """
        SELECT period, CAST(date_trunc(period, order_date) AS DATE) AS first_day, count(DISTINCT order_id) AS cnt_order,
          count(DISTINCT customer_id) AS cnt_customers
        FROM orders_v, (VALUES ('day'), ('week'), ('month')) AS p(period)
        WHERE online_order AND order_status = 'Approved' AND year(order_date) IN (1997, 1998)
        GROUP BY 1, 2""",
    "shop_senior_titles": """
        SELECT job_title FROM customer_v
        WHERE ((job_industry_category = 'IT' AND starts_with(job_title, 'Senior'))
            OR (job_industry_category = 'Financial Services' AND starts_with(job_title, 'Lead')))
          AND 1999 - year(dob) - CASE WHEN month(dob) * 100 + day(dob) > 101 THEN 1 ELSE 0 END > 35""",
    "shop_brand_except": """
        SELECT brand, product_id FROM product_v WHERE product_id IN (
          SELECT product_id FROM sale_v JOIN customer_v USING (customer_id)
          WHERE job_industry_category = 'Financial Services')
        EXCEPT
        SELECT brand, product_id FROM product_v WHERE product_id IN (
          SELECT product_id FROM sale_v JOIN customer_v USING (customer_id) WHERE job_industry_category = 'IT')""",
    "shop_brand_except_by_brand": """
        SELECT brand FROM product_v WHERE product_id IN (
          SELECT product_id FROM sale_v JOIN customer_v USING (customer_id)
          WHERE job_industry_category = 'Financial Services')
        EXCEPT
        SELECT brand FROM product_v WHERE product_id IN (
          SELECT product_id FROM sale_v JOIN customer_v USING (customer_id) WHERE job_industry_category = 'IT')""",
    "shop_top_customers_above_avg": """
        SELECT customer_id, first_name, last_name, count(order_item_id) AS cnt_orders_online
        FROM (SELECT *, avg(property_valuation) OVER (PARTITION BY state) AS usual FROM customer_v)
        JOIN sale_v USING (customer_id)
        WHERE property_valuation > usual AND deceased_indicator = 'N' AND online_order
          AND product_id IN (SELECT product_id FROM product_v WHERE brand IN ('Brand#1', 'Brand#2', 'Brand#3'))
        GROUP BY ALL ORDER BY cnt_orders_online DESC, customer_id LIMIT 10""",
    "shop_inactive_car_owners": """
        SELECT c.customer_id, c.first_name, c.last_name FROM customer_v c
        LEFT JOIN (SELECT DISTINCT customer_id FROM orders_v WHERE online_order AND order_status = 'Approved'
                     AND order_date >= DATE '2000-08-01') recent USING (customer_id)
        WHERE recent.customer_id IS NULL AND c.owns_car = 'Yes' AND c.wealth_segment <> 'Mass Customer'""",
    "shop_two_of_top_road": """
        SELECT customer_id, first_name, last_name FROM customer_v c
        WHERE job_industry_category = 'IT' AND 2 = (
          SELECT count(DISTINCT s.product_id) FROM sale_v s
          WHERE s.customer_id = c.customer_id AND s.order_status = 'Approved' AND s.product_id IN (
            SELECT product_id FROM product_v
            WHERE product_line = 'Road' ORDER BY list_price DESC NULLS FIRST, product_id LIMIT 50))""",
    "shop_loyal_high_revenue": """
        SELECT c.customer_id, c.first_name, c.last_name, c.job_industry_category FROM customer_v c
        JOIN (SELECT customer_id FROM order_value_v JOIN orders_v USING (order_id, customer_id)
              WHERE year(order_date) = 1997 GROUP BY customer_id
              HAVING count(*) >= 3 AND sum(cents) > 1000000) loyal USING (customer_id)
        WHERE c.job_industry_category IN ('Health', 'IT')""",
    # --- shop: grouping and windows ---
    "shop_industry_distribution": """
        SELECT job_industry_category, count(*) AS customer_cnt FROM customer_v
        WHERE job_industry_category IS NOT NULL GROUP BY 1""",
    "shop_monthly_revenue": """
        SELECT CAST(year(order_date) AS INT) AS report_year, CAST(month(order_date) AS INT) AS report_month,
          job_industry_category, CAST(sum(cents) AS DOUBLE) / 100 AS total_revenue
        FROM sale_v JOIN customer_v USING (customer_id) WHERE order_status = 'Approved' GROUP BY 1, 2, 3""",
    "shop_brand_it_orders_with_zero": """
        SELECT p.brand, p.product_size, count(DISTINCT s.order_id) AS it_online_order_cnt
        FROM product_v p LEFT JOIN (
          SELECT product_id, order_id FROM sale_v JOIN customer_v USING (customer_id)
          WHERE job_industry_category = 'IT' AND order_status = 'Approved' AND online_order) s USING (product_id)
        WHERE p.brand IS NOT NULL GROUP BY p.brand, p.product_size""",
    "shop_brand_it_orders": """
        SELECT p.brand, count(DISTINCT s.order_id) AS it_online_order_cnt
        FROM product_v p LEFT JOIN (
          SELECT product_id, order_id FROM sale_v JOIN customer_v USING (customer_id)
          WHERE job_industry_category = 'IT' AND order_status = 'Approved' AND online_order) s USING (product_id)
        WHERE p.brand IS NOT NULL GROUP BY p.brand""",
    "shop_customer_order_stats_groupby": _STATS,
    "shop_customer_order_stats_window": _STATS,
    "shop_top_bottom_customers": """
        SELECT CASE WHEN high <= 3 THEN 'MAX' ELSE 'MIN' END AS "type", first_name, last_name,
          CAST(cents AS DOUBLE) / 100 AS total_amount
        FROM (SELECT *, row_number() OVER (ORDER BY cents DESC, customer_id) AS high,
                row_number() OVER (ORDER BY cents, customer_id) AS low FROM total_v)
        WHERE high <= 3 OR low <= 3""",
    "shop_second_order": """
        SELECT order_id, customer_id, order_date, order_status FROM orders_v
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) = 2""",
    "shop_max_order_gap": """
        SELECT c.first_name, c.last_name, c.job_title, CAST(max(g.gap) AS INT) AS max_days_between_orders
        FROM customer_v c JOIN (
          SELECT customer_id, date_diff('day', lag(order_date) OVER (
            PARTITION BY customer_id ORDER BY order_date, order_id), order_date) AS gap
          FROM orders_v WHERE order_status = 'Approved') g USING (customer_id)
        WHERE g.gap IS NOT NULL GROUP BY c.customer_id, c.first_name, c.last_name, c.job_title""",
    "shop_top5_by_segment": """
        SELECT first_name, last_name, wealth_segment, CAST(cents AS DOUBLE) / 100 AS total_revenue
        FROM segment_rank_v WHERE place <= 5""",
    # --- documents ---
    "doc_nested_filter": """
        SELECT CAST(c_custkey AS VARCHAR) AS _id, c_custkey AS theater_id, c_custkey || ' Main Street' AS street,
          n_name AS city, r_name AS state, CAST(10000 + c_nationkey AS VARCHAR) AS zipcode
        FROM customer, nation, region
        WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey AND n_name = 'NATION_3' AND r_name = 'EUROPE'""",
    "doc_find_one": "SELECT text FROM documents WHERE source = 'src7' ORDER BY doc_id LIMIT 1",
    "doc_array_first_count": "SELECT count(*) AS n_movies FROM movie_v WHERE first_genre = 'Horror'",
    "doc_or_range_filter": """
        SELECT coalesce(title, 'Без названия') AS title, coalesce(CAST("year" AS VARCHAR), 'Неизвестно') AS "year",
          first_genre || '|' || second_genre AS genres
        FROM movie_v WHERE "year" BETWEEN 1940 AND 1949 AND (first_genre = 'Film-Noir' OR first_genre = 'Horror')""",
    "doc_projection": """
        SELECT title, "year" FROM movie_v
        WHERE "year" >= 1940 AND "year" <= 1949 AND first_genre IN ('Film-Noir', 'Horror')""",
    "doc_comment_counts": """
        SELECT count(*) AS "count", any_value(title) AS title, any_value("year") AS "year"
        FROM movie_v JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey""",
    "doc_movies_with_comments": """
        SELECT _id, any_value(title) AS title, 0 AS part, CAST(count(l_partkey) AS INTEGER) AS n_comments,
          coalesce(string_agg(strftime(l_shipdate, '%Y-%m-%d') || ' ' || l_orderkey || '-' || l_linenumber || ' Customer '
            || l_orderkey % 100, '|' ORDER BY l_shipdate, l_orderkey || '-' || l_linenumber), '') AS comments
        FROM movie_v LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY _id""",
    "doc_unwound_comments": """
        SELECT _id, title, CAST(l_shipdate AS DATE) AS date, l_orderkey || '-' || l_linenumber AS comment_id,
          'Customer ' || l_orderkey % 100 AS name
        FROM movie_v LEFT JOIN lineitem ON l_partkey = p_partkey""",
    "doc_top20_commented": """
        SELECT CAST(row_number() OVER (ORDER BY n DESC, _id) AS INT) AS position,
          title || ' (' || coalesce(CAST("year" AS VARCHAR), 'N/A') || ')' AS label, n AS "count"
        FROM (SELECT l_partkey AS p_partkey, count(*) AS n FROM lineitem GROUP BY 1) JOIN movie_v USING (p_partkey)
        ORDER BY position LIMIT 20""",
    # --- bookings ---
    "calendar_days": """
        SELECT CAST(d AS DATE) AS calendar_dt FROM (
          SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
            date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
          FROM orders)""",
    "booking_enriched": """
        SELECT ID, n_adults, n_children, weekend_nights, week_nights, meal_plan, car_parking_space, room_type,
          lead_time, "year", "month", "date", market_segment, repeated_guest, previous_cancellations,
          previous_bookings_not_canceled, CAST(avg_room_price AS DOUBLE) AS avg_room_price, special_requests,
          status, arrival_date, total_nights, CAST(revenue_cents AS DOUBLE) / 100 AS booking_revenue, total_guests
        FROM stay_v""",
    "booking_avg_nights": """
        SELECT "year", "month", CAST((200 * CAST(sum(total_nights) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE)
          / 100 AS avg_nights
        FROM stay_v WHERE status <> 'Canceled' GROUP BY 1, 2""",
    "booking_cancel_rate_top3": """
        SELECT "month", n AS total_bookings, canceled AS canceled_bookings,
          CAST((20000 * canceled + n) // (2 * n) AS DOUBLE) / 100 AS cancellation_rate_percent
        FROM (SELECT "month", count(*) AS n, count(*) FILTER (status = 'Canceled') AS canceled
              FROM booking_v WHERE "year" = 1998 GROUP BY 1)
        ORDER BY cancellation_rate_percent DESC, "month" LIMIT 3""",
    "booking_avg_lead_time": """
        SELECT "year", "month", CAST((20 * CAST(sum(lead_time) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE)
          / 10 AS avg_lead_time_days
        FROM booking_v WHERE status <> 'Canceled' GROUP BY 1, 2""",
    "booking_revenue_pivot": """
        SELECT "year", "month", max(mean) FILTER (market_segment = '1-URGENT') AS "1-URGENT",
          max(mean) FILTER (market_segment = '2-HIGH') AS "2-HIGH",
          max(mean) FILTER (market_segment = '3-MEDIUM') AS "3-MEDIUM",
          max(mean) FILTER (market_segment = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
          max(mean) FILTER (market_segment = '5-LOW') AS "5-LOW"
        FROM (SELECT "year", "month", market_segment,
                CAST((2 * CAST(sum(revenue_cents) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS mean
              FROM stay_v WHERE status <> 'Canceled' GROUP BY 1, 2, 3)
        GROUP BY 1, 2""",
    "booking_top5_repeat_share": """
        SELECT ID, CAST(cents AS DOUBLE) / 100 AS total_guest_revenue,
          CAST((20000 * CAST(cents AS HUGEINT) + overall) // (2 * overall) AS DOUBLE) / 100 AS revenue_share_percent
        FROM (SELECT ID, cents, sum(cents) OVER () AS overall FROM (
                SELECT ID, sum(revenue_cents) AS cents FROM stay_v
                WHERE repeated_guest = 1 AND status <> 'Canceled' GROUP BY ID))
        ORDER BY cents DESC, ID LIMIT 5""",
    "booking_daily_occupancy": """
        SELECT calendar_dt, CAST(coalesce(sum(total_guests), 0) AS BIGINT) AS total_guests_on_day,
          CAST((200 * CAST(coalesce(sum(total_guests), 0) AS BIGINT) * 100 + 400) // 800 AS DOUBLE) / 100
            AS occupancy_percent
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
                date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                INTERVAL 1 DAY)) AS DATE) AS calendar_dt FROM orders)
        LEFT JOIN (SELECT * FROM stay_v WHERE status <> 'Canceled')
          ON arrival_date <= calendar_dt AND arrival_date + total_nights > calendar_dt
        GROUP BY calendar_dt""",
    "booking_stays_in_house": """
        SELECT calendar_dt, count(arrival_date) AS stays, CAST(max(total_nights) AS INTEGER) AS longest_stay,
          CAST((200 * CAST(sum(total_nights) AS BIGINT) + count(arrival_date)) // (2 * nullif(count(arrival_date), 0)) AS DOUBLE) / 100 AS avg_nights,
          count(DISTINCT room_type) AS room_types, count(*) FILTER (repeated_guest = 1) AS repeat_guests
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
                date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                INTERVAL 1 DAY)) AS DATE) AS calendar_dt FROM orders)
        LEFT JOIN (SELECT * FROM stay_v WHERE status <> 'Canceled' AND total_nights > 0)
          ON arrival_date <= calendar_dt AND arrival_date + total_nights > calendar_dt
        GROUP BY calendar_dt""",
    # --- warehouse load ---
    "dedup_keep_first": """
        SELECT product_id, transaction_id, brand, list_price, standard_cost FROM raw_transaction_v
        WHERE (product_id, transaction_id) IN (
          SELECT (product_id, min(transaction_id)) FROM raw_transaction_v GROUP BY product_id)""",
    "dedup_keep_best": """
        SELECT product_id, CAST(best AS DOUBLE) AS list_price, min(order_id) AS order_id
        FROM items_v JOIN (SELECT product_id, max(item_price) AS best FROM items_v GROUP BY 1) USING (product_id)
        WHERE item_price = best GROUP BY product_id, best""",
    "incremental_append": """
        SELECT * FROM orders_v WHERE order_id NOT IN (
          SELECT order_id FROM orders_v WHERE order_date < DATE '2001-01-01')""",
    "dim_load_simple": """
        , early AS (
          SELECT DISTINCT dimension, name FROM (
            SELECT * FROM raw_transaction_v WHERE order_date < DATE '1995-01-03'
          ) UNPIVOT (name FOR dimension IN (order_status AS 'order_statuses', brand AS 'brands',
              product_line AS 'product_lines', product_class AS 'product_classes', product_size AS 'product_sizes'))),
        everything AS (SELECT * FROM customer_name_v UNION ALL SELECT * FROM transaction_name_v),
        staged AS (
          SELECT dimension, name, (dimension, name) NOT IN (SELECT (dimension, name) FROM early) AS added
          FROM everything)
        SELECT dimension, name, added, row_number() OVER (
          PARTITION BY dimension ORDER BY added, left(md5(name), 3), name) AS id
        FROM staged""",
    "dim_load_location": """
        , place AS (
          SELECT DISTINCT country, CASE state WHEN 'VIC' THEN 'Victoria' WHEN 'New South Wales' THEN 'NSW'
            ELSE state END AS state, postcode FROM raw_customer_v),
        countries AS (
          SELECT country, row_number() OVER (ORDER BY left(md5(country), 3), country) AS id
          FROM (SELECT DISTINCT country FROM place)),
        states AS (
          SELECT state, country, country_id, row_number() OVER (
            ORDER BY left(md5(state || '|' || country_id), 3), state, country_id) AS id
          FROM (SELECT DISTINCT state, country, id AS country_id FROM place JOIN countries USING (country)))
        SELECT 'country' AS "level", id, country AS name, CAST(NULL AS BIGINT) AS parent_id FROM countries
        UNION ALL SELECT 'state', id, state, country_id FROM states
        UNION ALL SELECT 'postcode', NULL, postcode, min(states.id)
          FROM place JOIN states USING (state, country) GROUP BY postcode""",
    "dim_surrogate_key": """
        SELECT dimension, name, row_number() OVER (
          PARTITION BY dimension ORDER BY left(md5(name), 3), name) AS id
        FROM (SELECT DISTINCT 'brands' AS dimension, p_brand AS name FROM part
              UNION ALL SELECT DISTINCT 'product_names', p_name FROM part)""",
    "dim_unknown_member": """
        , named AS (
          SELECT 'brands' AS dimension, brand AS name FROM product_v WHERE brand IS NOT NULL
          UNION SELECT 'product_lines', product_line FROM product_v
          UNION SELECT 'product_classes', product_class FROM product_v
          UNION SELECT 'product_sizes', product_size FROM product_v)
        SELECT dimension, name, row_number() OVER (
          PARTITION BY dimension ORDER BY left(md5(name), 3), name) AS id FROM named
        UNION ALL SELECT DISTINCT dimension, 'Unknown', 0 FROM named""",
    "fact_products": """
        SELECT product_id, brand_id, product_line_id, product_class_id, product_size_id,
          CAST(list_price AS DOUBLE) AS list_price, CAST(standard_cost AS DOUBLE) AS standard_cost
        FROM fact_product_v""",
    "fact_customers": """
        , member AS (
          SELECT dimension, name, row_number() OVER (
            PARTITION BY dimension ORDER BY left(md5(name), 3), name) AS id FROM customer_name_v)
        SELECT customer_id, first_name, last_name,
          CASE gender WHEN 'Male' THEN 'M' WHEN 'Female' THEN 'F' WHEN 'F' THEN 'F' ELSE 'U' END AS gender,
          TRY_CAST(dob_text AS DATE) AS dob, job_title, i.id AS job_industry_category_id, w.id AS wealth_segment_id,
          coalesce(deceased_indicator = 'Y', FALSE) AS deceased_indicator, coalesce(owns_car = 'Yes', FALSE) AS owns_car,
          address, postcode, property_valuation
        FROM raw_customer_v
        LEFT JOIN member i ON i.dimension = 'job_industries' AND i.name = job_industry_category
        LEFT JOIN member w ON w.dimension = 'wealth_segments' AND w.name = wealth_segment""",
    "fact_transactions": "SELECT * FROM fact_transaction_v",
    "report_transactions_wide": """
        SELECT t.transaction_id, t.product_id, t.customer_id, t.transaction_date, t.online_order,
          s.name AS order_status, coalesce(b.name, 'Unknown') AS brand, pl.name AS product_line,
          pc.name AS product_class, ps.name AS product_size, CAST(p.list_price AS DOUBLE) AS list_price,
          CAST(p.standard_cost AS DOUBLE) AS standard_cost
        FROM fact_transaction_v t LEFT JOIN fact_product_v p USING (product_id)
        LEFT JOIN member_v s ON s.dimension = 'order_statuses' AND s.id = t.order_status_id
        LEFT JOIN member_v b ON b.dimension = 'brands' AND b.id = p.brand_id
        LEFT JOIN member_v pl ON pl.dimension = 'product_lines' AND pl.id = p.product_line_id
        LEFT JOIN member_v pc ON pc.dimension = 'product_classes' AND pc.id = p.product_class_id
        LEFT JOIN member_v ps ON ps.dimension = 'product_sizes' AND ps.id = p.product_size_id""",
    "orphan_reject": """
        SELECT order_id, customer_id, customer_id IN (
          SELECT customer_id FROM customer_v WHERE deceased_indicator = 'N') AS kept FROM orders_v""",
    "check_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_foreign_key": """
        SELECT o.customer_id, count(*) AS n_rows FROM orders_v o
        WHERE NOT EXISTS (SELECT 1 FROM customer_v c
          WHERE c.customer_id = o.customer_id AND c.deceased_indicator = 'N') GROUP BY 1""",
    "check_not_null": "",
    # --- reports of the daily job ---
    "report_min_max_customers": """
        SELECT first_name, last_name, CAST(cents AS DOUBLE) / 100 AS amount,
          CASE WHEN low <= 3 THEN 'Min_3' ELSE 'Max_3' END AS "type"
        FROM (SELECT *, row_number() OVER (ORDER BY cents DESC, customer_id) AS high,
                row_number() OVER (ORDER BY cents, customer_id) AS low FROM total_v)
        WHERE high <= 3 OR low <= 3""",
    "report_wealth_top5": """
        SELECT first_name, last_name, wealth_segment, CAST(cents AS DOUBLE) / 100 AS revenue
        FROM segment_rank_v WHERE place < 6""",
    "report_quality_gate": """
        SELECT report, n_rows, n_rows > 0 AS ok FROM (
          SELECT 'report_min_max' AS report, least(3, count(*)) + least(3, count(*)) AS n_rows FROM total_v
          UNION ALL SELECT 'report_wealth', count(*) FROM segment_rank_v WHERE place <= 5
          UNION ALL SELECT 'report_orphans', count(DISTINCT customer_id) FROM orders_v
            WHERE customer_id NOT IN (SELECT customer_id FROM customer_v))""",
}

_CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "gender", "dob", "job_title", "job_industry_category",
    "wealth_segment", "deceased_indicator", "owns_car", "address", "postcode", "state", "country",
    "property_valuation",
)
_QUERIES["check_not_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM customer_v" for c in _CUSTOMER_COLUMNS
)


def statements() -> dict[str, str]:
    views = ", ".join(f"{name} AS ({body})" for name, body in _VIEWS.items())
    return {name: f"WITH {views} {body}" for name, body in _QUERIES.items()}
