"""The sample queries once more, as independent SQL for another engine."""

from __future__ import annotations

# Named sub-queries, each listed after those it needs.
_PARTS: dict[str, str] = {
    # Sample tables in the shape of the star schema.
    "items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS price,
               round(l_quantity * (1 + l_tax), 2) AS freight_value,
               concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(round(l_extendedprice * 100) AS BIGINT)) AS item_key
        FROM lineitem""",
    "products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 23 = 0 THEN NULL
                    ELSE p_type || ' ' || p_brand END AS product_category_name,
               length(p_name) AS product_name_lenght,
               200 + p_partkey % 800 AS product_description_lenght,
               1 + p_partkey % 6 AS product_photos_qty,
               CASE WHEN p_partkey % 41 = 0 THEN NULL
                    ELSE CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm,
               CAST(1 + p_partkey % 40 AS DOUBLE) AS product_height_cm,
               CAST(p_partkey % 60 AS DOUBLE) AS product_width_cm
        FROM part""",
    "translation": """
        SELECT DISTINCT p_type || ' ' || p_brand AS product_category_name,
               lower(p_type || CASE WHEN p_type = 'PROMO' THEN chr(39) || 's ' ELSE ' ' END || p_brand)
                 AS product_category_name_english
        FROM part WHERE p_type <> 'ECONOMY'""",
    "sales_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS order_purchase_timestamp
        FROM orders""",
    "payments": """
        SELECT l_orderkey AS order_id,
               CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'N' THEN 'credit_card'
                                 WHEN 'R' THEN 'voucher' END AS payment_type,
               1 + CAST(l_quantity AS INT) % 12 AS payment_installments
        FROM lineitem WHERE l_linestatus = 'O'""",
    "reviews": """
        SELECT event_id AS review_id, event_id // 2 AS order_id,
               1 + CAST(floor(value) AS INT) % 5 AS review_score, ts AS review_creation_date
        FROM events
        WHERE event_id // 2 NOT IN (
            SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey
            WHERE p_partkey % 23 <> 0 AND p_type = 'SMALL' AND p_brand = 'Brand#3')""",
    "customers": """
        SELECT c_custkey AS customer_id, n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    # Aggregates.
    "installments": """
        SELECT order_id, max(payment_installments) AS max_installments
        FROM payments GROUP BY order_id""",
    "payment_ranks": """
        SELECT order_id, payment_type,
               row_number() OVER (PARTITION BY order_id
                                  ORDER BY count(*) DESC, payment_type) AS place
        FROM payments WHERE payment_type IS NOT NULL GROUP BY order_id, payment_type""",
    "payment_profile": """
        SELECT i.order_id, i.max_installments, r.payment_type AS payment_type_mode
        FROM installments i LEFT JOIN payment_ranks r ON r.order_id = i.order_id AND r.place = 1""",
    "review_ranks": """
        SELECT order_id, review_score,
               row_number() OVER (PARTITION BY order_id ORDER BY review_creation_date
                                  DESC NULLS FIRST, review_id DESC) AS place
        FROM reviews""",
    "latest_reviews": "SELECT order_id, review_score FROM review_ranks WHERE place = 1",
    "order_reviews": """
        SELECT order_id, avg(review_score) AS review_score FROM reviews GROUP BY order_id""",
    "product_reviews": """
        SELECT product_id, avg(review_score) AS product_avg_review
        FROM latest_reviews JOIN items USING (order_id) GROUP BY product_id""",
    "seller_reviews": """
        SELECT seller_id, avg(review_score) AS seller_avg_review
        FROM latest_reviews JOIN items USING (order_id) GROUP BY seller_id""",
    "product_sales": """
        SELECT product_id, count(*) AS product_sales_count FROM items GROUP BY product_id""",
    "seller_sales": """
        SELECT seller_id, count(*) AS seller_sales_count,
               count(DISTINCT product_id) AS seller_product_diversity
        FROM items GROUP BY seller_id""",
    # Facts and features.
    "facts": """
        SELECT items.*, products.* EXCLUDE (product_id), product_category_name_english,
               product_sales_count, seller_sales_count, seller_product_diversity,
               product_avg_review, seller_avg_review, seller_state,
               order_purchase_timestamp, customer_id, customer_state,
               max_installments, payment_type_mode
        FROM items
        LEFT JOIN products USING (product_id)
        LEFT JOIN translation USING (product_category_name)
        LEFT JOIN product_sales USING (product_id)
        LEFT JOIN seller_sales USING (seller_id)
        LEFT JOIN product_reviews USING (product_id)
        LEFT JOIN seller_reviews USING (seller_id)
        LEFT JOIN sellers USING (seller_id)
        LEFT JOIN sales_orders USING (order_id)
        LEFT JOIN customers USING (customer_id)
        LEFT JOIN payment_profile USING (order_id)""",
    "priced": "SELECT * FROM facts WHERE price IS NOT NULL",
    "imputed": """
        SELECT * REPLACE (
            coalesce(product_avg_review,
                     (SELECT median(product_avg_review) FROM priced)) AS product_avg_review,
            coalesce(seller_avg_review,
                     (SELECT median(seller_avg_review) FROM priced)) AS seller_avg_review,
            coalesce(CAST(max_installments AS DOUBLE),
                     (SELECT median(max_installments) FROM priced)) AS max_installments)
        FROM priced""",
    "engineered": """
        SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3,
               product_weight_g / (product_volume_cm3 + 1) AS density,
               freight_value / (product_weight_g + 1) AS shipping_ratio,
               ln(1 + product_weight_g) AS log_weight,
               ln(1 + product_volume_cm3) AS log_volume,
               product_photos_qty * CAST(0.5 AS DOUBLE)
                 + product_description_lenght * CAST(0.01 AS DOUBLE)
                 + product_name_lenght * CAST(0.02 AS DOUBLE) AS complexity_score,
               CASE WHEN product_volume_cm3 <= 0 THEN NULL
                    WHEN product_volume_cm3 <= 1000 THEN 'small'
                    WHEN product_volume_cm3 <= 10000 THEN 'medium'
                    WHEN product_volume_cm3 <= 100000 THEN 'large'
                    WHEN product_volume_cm3 > 100000 THEN 'very_large' END AS size_category,
               month(order_purchase_timestamp) AS purchase_month,
               isodow(order_purchase_timestamp) - 1 AS purchase_day_of_week,
               hour(order_purchase_timestamp) AS purchase_hour,
               CASE WHEN purchase_day_of_week IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN purchase_month IN (11, 12) THEN 1 ELSE 0 END AS is_peak_season
        FROM imputed""",
    # Cleaning of the current model.
    "complete": """
        SELECT * FROM engineered
        WHERE freight_value IS NOT NULL AND product_photos_qty IS NOT NULL
          AND product_weight_g IS NOT NULL AND product_volume_cm3 IS NOT NULL
          AND product_description_lenght IS NOT NULL AND product_name_lenght IS NOT NULL
          AND complexity_score IS NOT NULL AND purchase_month IS NOT NULL
          AND product_avg_review IS NOT NULL AND seller_avg_review IS NOT NULL
          AND max_installments IS NOT NULL AND product_sales_count IS NOT NULL
          AND seller_sales_count IS NOT NULL AND seller_product_diversity IS NOT NULL
          AND density IS NOT NULL AND shipping_ratio IS NOT NULL AND log_weight IS NOT NULL
          AND log_volume IS NOT NULL AND is_peak_season IS NOT NULL AND price IS NOT NULL""",
    "bounds": """
        SELECT quantile_cont(price, 0.01) AS low, quantile_cont(price, 0.99) AS high
        FROM complete""",
    "known": """
        SELECT * REPLACE (
            coalesce(product_category_name_english, 'unknown') AS product_category_name_english,
            coalesce(size_category, 'unknown') AS size_category,
            coalesce(payment_type_mode, 'unknown') AS payment_type_mode,
            coalesce(customer_state, 'unknown') AS customer_state,
            coalesce(seller_state, 'unknown') AS seller_state)
        FROM engineered""",
    "cleaned": """
        SELECT complete.* REPLACE (
            coalesce(product_category_name_english, 'unknown') AS product_category_name_english,
            coalesce(size_category, 'unknown') AS size_category,
            coalesce(payment_type_mode, 'unknown') AS payment_type_mode,
            coalesce(customer_state, 'unknown') AS customer_state,
            coalesce(seller_state, 'unknown') AS seller_state)
        FROM complete, bounds WHERE price >= low AND price <= high""",
    # Split and encodings.
    "item_split": """
        SELECT item_key, price, ln(1 + price) AS label,
               CASE WHEN CAST('0x' || substr(md5(item_key), 1, 8) AS UBIGINT) % 5 = 0
                    THEN 'test' ELSE 'train' END AS split
        FROM items""",
    "split_rows": """
        SELECT *, ln(1 + price) AS label,
               CASE WHEN CAST('0x' || substr(md5(item_key), 1, 8) AS UBIGINT) % 5 = 0
                    THEN 'test' ELSE 'train' END AS split
        FROM cleaned""",
    "fallback": """
        SELECT exp(avg(label)) - 1 AS global_avg_price FROM split_rows WHERE split = 'train'""",
    "category_prices": """
        SELECT product_category_name_english, avg(exp(label) - 1) AS category_price
        FROM split_rows WHERE split = 'train' GROUP BY product_category_name_english""",
    "seller_prices": """
        SELECT seller_id, avg(exp(label) - 1) AS seller_price
        FROM split_rows WHERE split = 'train' GROUP BY seller_id""",
    "encoded": """
        SELECT split_rows.*, coalesce(category_price, global_avg_price) AS category_avg_price,
               coalesce(seller_price, global_avg_price) AS seller_avg_price
        FROM split_rows CROSS JOIN fallback
        LEFT JOIN category_prices USING (product_category_name_english)
        LEFT JOIN seller_prices USING (seller_id)""",
    "scores": """
        SELECT count(*) AS rows,
               1 - sum((price - category_avg_price) * (price - category_avg_price))
                   / sum((price - mean_price) * (price - mean_price)) AS r2,
               avg(abs(price - category_avg_price)) AS mae,
               avg((price - category_avg_price) * (price - category_avg_price)) AS mse,
               sqrt(mse) AS rmse,
               avg(abs((price - category_avg_price) / price)) * 100 AS mape
        FROM encoded,
             (SELECT avg(price) AS mean_price FROM encoded WHERE split = 'test')
        WHERE split = 'test'""",
    # Older model.
    "full_means": """
        SELECT product_category_name_english, avg(price) AS category_avg_price
        FROM priced WHERE product_category_name_english IS NOT NULL
        GROUP BY product_category_name_english""",
    "baseline": """
        SELECT engineered.*, category_avg_price
        FROM engineered LEFT JOIN full_means USING (product_category_name_english)""",
    "baseline_complete": """
        SELECT * FROM baseline
        WHERE product_weight_g IS NOT NULL AND product_volume_cm3 IS NOT NULL
          AND product_photos_qty IS NOT NULL AND freight_value IS NOT NULL
          AND complexity_score IS NOT NULL AND purchase_hour IS NOT NULL
          AND category_avg_price IS NOT NULL AND product_category_name_english IS NOT NULL
          AND size_category IS NOT NULL AND density IS NOT NULL AND shipping_ratio IS NOT NULL
          AND log_weight IS NOT NULL AND log_volume IS NOT NULL AND purchase_month IS NOT NULL
          AND purchase_day_of_week IS NOT NULL AND is_weekend IS NOT NULL
          AND is_peak_season IS NOT NULL AND product_sales_count IS NOT NULL
          AND seller_sales_count IS NOT NULL AND seller_product_diversity IS NOT NULL
          AND price IS NOT NULL""",
    "baseline_bounds": """
        SELECT quantile_cont(price, 0.01) AS low, quantile_cont(price, 0.99) AS high
        FROM baseline_complete""",
    "baseline_rows": """
        SELECT baseline_complete.* FROM baseline_complete, baseline_bounds
        WHERE price >= low AND price <= high""",
    # Categories.
    "category_items": """
        SELECT items.*, product_category_name_english AS category
        FROM items JOIN products USING (product_id) JOIN translation USING (product_category_name)""",
    "category_prices_all": """
        SELECT category, round_even(avg(price) * 100, 0) / 100 AS avg_price
        FROM category_items GROUP BY category""",
    "category_reviews": """
        SELECT category, round_even(avg(review_score) * 100, 0) / 100 AS avg_review
        FROM category_items LEFT JOIN order_reviews USING (order_id) GROUP BY category""",
    "category_sales": """
        SELECT category, CAST(round_even(median(sales_count), 0) AS BIGINT) AS median_sales_count
        FROM (SELECT category, product_id, count(order_id) AS sales_count
              FROM category_items GROUP BY category, product_id)
        GROUP BY category""",
    "stats": """
        SELECT category, avg_price,
               coalesce(avg_review, (SELECT round_even(avg(avg_review) * 100, 0) / 100
                                     FROM category_reviews)) AS avg_review,
               median_sales_count, 'credit_card' AS most_common_payment_type,
               CASE WHEN avg_price < 50 THEN 1 WHEN avg_price < 100 THEN 3
                    WHEN avg_price < 200 THEN 6 ELSE 12 END AS default_max_installments
        FROM category_prices_all
        FULL JOIN category_reviews USING (category)
        FULL JOIN category_sales USING (category)""",
    "seed": r"""
        SELECT category,
               '(''' || replace(category, '''', '''''') || ''', '
               || regexp_replace(CAST(CAST(avg_price AS DECIMAL(20, 2)) AS VARCHAR),
                                 '(\.\d)0$', '\1') || ', '
               || regexp_replace(CAST(CAST(avg_review AS DECIMAL(20, 2)) AS VARCHAR),
                                 '(\.\d)0$', '\1') || ', '
               || median_sales_count || ', ''credit_card'', '
               || default_max_installments || ')' AS row_sql
        FROM stats""",
    # Scoring.
    "requests": """
        SELECT item_key AS request_id,
               CASE WHEN order_id % 50 = 0 THEN -freight_value
                    WHEN order_id % 110 = 1 THEN CAST('NaN' AS DOUBLE)
                    ELSE freight_value END AS freight_value,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm,
               product_width_cm, product_description_lenght, product_name_lenght,
               product_category_name_english,
               CASE WHEN order_id % 70 = 0 THEN 13 ELSE month(order_purchase_timestamp) END
                 AS purchase_month,
               CASE WHEN product_id % 3 <> 0 THEN CAST(3.5 AS DOUBLE) END AS review,
               CASE WHEN product_id % 3 <> 0 THEN 2 END AS installments_given,
               CASE WHEN product_id % 3 <> 0 THEN 'boleto' END AS payment_given,
               CASE WHEN product_id % 3 <> 0 THEN 'RJ' END AS state_given
        FROM items LEFT JOIN products USING (product_id)
        LEFT JOIN translation USING (product_category_name)
        LEFT JOIN sales_orders USING (order_id)""",
    "checked": """
        SELECT *, concat_ws('; ',
            CASE WHEN freight_value IS NULL THEN 'freight_value: required' END,
            CASE WHEN isnan(freight_value) THEN 'freight_value: must be a finite number' END,
            CASE WHEN freight_value < 0 THEN 'freight_value: must be >= 0' END,
            CASE WHEN product_photos_qty IS NULL THEN 'product_photos_qty: required' END,
            CASE WHEN product_photos_qty < 0 THEN 'product_photos_qty: must be >= 0' END,
            CASE WHEN product_weight_g IS NULL THEN 'product_weight_g: required' END,
            CASE WHEN product_weight_g <= 0 THEN 'product_weight_g: must be > 0' END,
            CASE WHEN product_length_cm IS NULL THEN 'product_length_cm: required' END,
            CASE WHEN product_length_cm <= 0 THEN 'product_length_cm: must be > 0' END,
            CASE WHEN product_height_cm IS NULL THEN 'product_height_cm: required' END,
            CASE WHEN product_height_cm <= 0 THEN 'product_height_cm: must be > 0' END,
            CASE WHEN product_width_cm IS NULL THEN 'product_width_cm: required' END,
            CASE WHEN product_width_cm <= 0 THEN 'product_width_cm: must be > 0' END,
            CASE WHEN product_description_lenght IS NULL
                 THEN 'product_description_lenght: required' END,
            CASE WHEN product_description_lenght < 0
                 THEN 'product_description_lenght: must be >= 0' END,
            CASE WHEN product_name_lenght IS NULL THEN 'product_name_lenght: required' END,
            CASE WHEN product_name_lenght < 0 THEN 'product_name_lenght: must be >= 0' END,
            CASE WHEN product_category_name_english IS NULL
                 THEN 'product_category_name_english: required' END,
            CASE WHEN purchase_month IS NULL THEN 'purchase_month: required' END,
            CASE WHEN purchase_month < 1 THEN 'purchase_month: must be >= 1' END,
            CASE WHEN purchase_month > 12 THEN 'purchase_month: must be <= 12' END) AS reasons
        FROM requests""",
    "accepted": """
        SELECT * EXCLUDE (review, installments_given, payment_given, state_given),
               coalesce(review, 4.0) AS product_avg_review,
               coalesce(review, 4.0) AS seller_avg_review,
               coalesce(installments_given, 1) AS max_installments,
               coalesce(payment_given, 'credit_card') AS payment_type_mode,
               coalesce(state_given, 'SP') AS customer_state,
               coalesce(state_given, 'SP') AS seller_state,
               0 AS product_sales_count, 0 AS seller_sales_count, 0 AS seller_product_diversity,
               CAST(100 AS DOUBLE) AS category_avg_price, CAST(100 AS DOUBLE) AS seller_avg_price
        FROM checked WHERE reasons = ''""",
    "accepted_features": """
        SELECT *, product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3,
               product_weight_g / (product_volume_cm3 + 1) AS density,
               freight_value / (product_weight_g + 1) AS shipping_ratio,
               ln(1 + product_weight_g) AS log_weight,
               ln(1 + product_volume_cm3) AS log_volume,
               product_photos_qty * CAST(0.5 AS DOUBLE)
                 + product_description_lenght * CAST(0.01 AS DOUBLE)
                 + product_name_lenght * CAST(0.02 AS DOUBLE) AS complexity_score,
               CASE WHEN product_volume_cm3 <= 1000 THEN 'small'
                    WHEN product_volume_cm3 <= 10000 THEN 'medium'
                    WHEN product_volume_cm3 <= 100000 THEN 'large'
                    ELSE 'very_large' END AS size_category,
               CASE WHEN purchase_month IN (11, 12) THEN 1 ELSE 0 END AS is_peak_season
        FROM accepted""",
    # Models.
    "baseline_split": """
        SELECT ln(1 + price) AS label,
               CASE WHEN CAST('0x' || substr(md5(item_key), 1, 8) AS UBIGINT) % 5 = 0
                    THEN 'test' ELSE 'train' END AS split
        FROM baseline_complete""",
    "line": """
        SELECT regr_slope(label, complexity_score) AS slope,
               regr_intercept(label, complexity_score) AS intercept
        FROM encoded WHERE split = 'train'""",
    "priced_requests": """
        SELECT request_id,
               round_even(exp(intercept + slope * complexity_score) - 1, 2) AS predicted_price
        FROM accepted_features CROSS JOIN line""",
}


def _sql(body: str) -> str:
    """Put the named sub-queries ``body`` needs in front of it."""
    names = list(_PARTS)
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace(",", " ").replace("(", " ").replace(")", " ").split())
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                visit(_PARTS[name])

    visit(body)
    parts = ",\n".join(f"{name} AS ({_PARTS[name]})" for name in names if name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def _r(*columns: str) -> str:
    """Columns rounded to four places as on the other side."""
    return ", ".join(
        f"floor(CAST({c} AS DOUBLE) * 10000 + 0.5003) / 10000 AS {c}" for c in columns
    )


def _i(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


_PHYSICAL = _r(
    "product_volume_cm3", "density", "shipping_ratio", "log_weight", "log_volume",
    "complexity_score",
)
_STATS = (
    f"category, {_r('avg_price', 'avg_review')}, {_i('median_sales_count')}, "
    f"most_common_payment_type, {_i('default_max_installments')}"
)
_REPORT = (
    f"category, {_r('avg_price', 'avg_review')}, "
    f"{_i('median_sales_count', 'default_max_installments')}"
)
_CURRENT = (
    f"{_r('freight_value', 'product_weight_g')}, {_PHYSICAL}, "
    + _i(
        "product_photos_qty", "product_description_lenght", "product_name_lenght",
        "purchase_month", "is_peak_season", "product_sales_count", "seller_sales_count",
        "seller_product_diversity",
    )
    + f", {_r('product_avg_review', 'seller_avg_review')}, "
    + _r("category_avg_price", "seller_avg_price")
    + ", product_category_name_english, size_category, payment_type_mode, customer_state,"
    + " seller_state"
)

_BODIES: dict[str, str] = {
    "scan_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {part}"
        for name, part in [
            ("items", "items"), ("products", "products"), ("translation", "translation"),
            ("orders", "sales_orders"), ("payments", "payments"), ("reviews", "reviews"),
            ("customers", "customers"), ("sellers", "sellers"),
        ]
    ),
    "category_stats": f"SELECT {_STATS} FROM stats",
    "category_avg_review": f"SELECT category, {_r('avg_review')} FROM category_reviews",
    "category_median_sales": "SELECT category, median_sales_count FROM category_sales",
    "top_categories": f"SELECT {_REPORT} FROM (SELECT * FROM stats ORDER BY avg_price DESC, category LIMIT 10)",
    "bottom_categories": f"SELECT {_REPORT} FROM (SELECT * FROM stats ORDER BY avg_price, category LIMIT 5)",
    "category_ranges": """
        SELECT count(*) AS categories, min(avg_price) AS min_avg_price,
               max(avg_price) AS max_avg_price, min(avg_review) AS min_avg_review,
               max(avg_review) AS max_avg_review, min(median_sales_count) AS min_median_sales_count,
               max(median_sales_count) AS max_median_sales_count
        FROM stats """,
    "category_seed_rows": "SELECT category, row_sql FROM seed",
    "category_seed_file": """
        SELECT 'INSERT INTO category_stats (category, avg_price, avg_review, median_sales_count, '
               || 'most_common_payment_type, default_max_installments)' AS value
        UNION ALL SELECT 'VALUES'
        UNION ALL
        SELECT '  ' || row_sql || CASE WHEN category = (SELECT max(category) FROM seed)
                                       THEN '' ELSE ',' END FROM seed
        UNION ALL SELECT 'ON CONFLICT (category) DO NOTHING;'""",
    "category_insert_if_absent": f"""
        SELECT {_STATS.replace(_r('avg_price', 'avg_review'),
            "CASE WHEN category < 'm' THEN 0.0 ELSE avg_price END AS avg_price, "
            + _r('avg_review'))}
        FROM stats """,
    "installment_tier": """
        SELECT product_id, CAST(CASE WHEN avg_price < 50 THEN 1 WHEN avg_price < 100 THEN 3
                                     WHEN avg_price < 200 THEN 6 ELSE 12 END AS BIGINT)
                             AS installments
        FROM (SELECT product_id, round_even(avg(price / 500) * 100, 0) / 100 AS avg_price
              FROM items GROUP BY product_id)""",
    "order_payment_profile": f"""
        SELECT order_id, {_i('max_installments')}, payment_type_mode FROM payment_profile """,
    "latest_review_per_order": f"SELECT order_id, {_i('review_score')} FROM latest_reviews",
    "order_mean_review": f"SELECT order_id, {_r('review_score')} FROM order_reviews",
    "product_avg_review": f"SELECT product_id, {_r('product_avg_review')} FROM product_reviews",
    "seller_avg_review": f"SELECT seller_id, {_r('seller_avg_review')} FROM seller_reviews",
    "product_demand": "SELECT product_id, product_sales_count FROM product_sales",
    "seller_demand": """
        SELECT seller_id, seller_sales_count, seller_product_diversity FROM seller_sales """,
    "order_item_facts": f"""
        SELECT item_key, order_id, product_id, seller_id, customer_id, product_category_name,
               product_category_name_english, order_purchase_timestamp, customer_state,
               seller_state, payment_type_mode,
               {_i('order_item_id', 'product_name_lenght', 'product_description_lenght',
                   'product_photos_qty', 'product_sales_count', 'seller_sales_count',
                   'seller_product_diversity', 'max_installments')},
               {_r('price', 'freight_value', 'product_weight_g', 'product_length_cm',
                   'product_height_cm', 'product_width_cm', 'product_avg_review',
                   'seller_avg_review')}
        FROM facts """,
    "physical_features": f"SELECT item_key, {_PHYSICAL} FROM engineered",
    "size_category": """
        SELECT product_id,
               CASE WHEN volume <= 0 THEN NULL WHEN volume <= 1000 THEN 'small'
                    WHEN volume <= 10000 THEN 'medium' WHEN volume <= 100000 THEN 'large'
                    WHEN volume > 100000 THEN 'very_large' END AS size_category
        FROM (SELECT product_id,
                     product_length_cm * product_height_cm * product_width_cm AS volume
              FROM products )""",
    "date_features": """
        SELECT order_id, month(order_purchase_timestamp) AS purchase_month,
               isodow(order_purchase_timestamp) - 1 AS purchase_day_of_week,
               hour(order_purchase_timestamp) AS purchase_hour,
               CAST(isodow(order_purchase_timestamp) >= 6 AS BIGINT) AS is_weekend,
               CAST(month(order_purchase_timestamp) >= 11 AS BIGINT) AS is_peak_season
        FROM sales_orders """,
    "median_impute": f"""
        SELECT item_key, {_r('product_avg_review', 'seller_avg_review', 'max_installments')}
        FROM imputed """,
    "unknown_fill": """
        SELECT item_key, product_category_name_english, size_category, payment_type_mode,
               customer_state, seller_state FROM known """,
    "outlier_bounds": f"SELECT {_r('low', 'high')} FROM bounds",
    "outlier_trim": f"SELECT item_key, {_r('price')} FROM cleaned",
    "clean_row_count": "SELECT count(*) AS clean_rows FROM cleaned",
    "baseline_clean_rows": """
        SELECT 'baseline' AS mode, count(*) AS clean_rows FROM baseline_rows
        UNION ALL SELECT 'comparison', count(*) FROM baseline_complete """,
    "baseline_features": f"""
        SELECT item_key, {_r('price', 'freight_value', 'product_weight_g', 'category_avg_price')},
               {_PHYSICAL},
               {_i('product_photos_qty', 'purchase_month', 'purchase_day_of_week',
                   'purchase_hour', 'is_weekend', 'is_peak_season', 'product_sales_count',
                   'seller_sales_count', 'seller_product_diversity')},
               product_category_name_english, size_category
        FROM baseline_rows """,
    "feature_row": f"SELECT item_key, split, {_CURRENT}, {_r('max_installments')} FROM encoded",
    "split_counts": "SELECT split, count(*) AS rows FROM item_split GROUP BY split",
    "target_roundtrip": f"""
        SELECT item_key, {_r('label')},
               {_r('price').removesuffix(' AS price')} AS restored_price FROM item_split """,
    "global_avg_price": f"SELECT {_r('global_avg_price')} FROM fallback",
    "category_avg_price_train": f"SELECT item_key, split, {_r('category_avg_price')} FROM encoded",
    "seller_avg_price_train": f"SELECT item_key, split, {_r('seller_avg_price')} FROM encoded",
    "category_avg_price_full": f"""
        SELECT item_key, product_category_name_english, {_r('category_avg_price')}
        FROM baseline """,
    "one_hot_levels": """
        SELECT count(DISTINCT product_category_name_english) AS product_category_name_english,
               count(DISTINCT size_category) AS size_category,
               count(DISTINCT payment_type_mode) AS payment_type_mode,
               count(DISTINCT customer_state) AS customer_state,
               count(DISTINCT seller_state) AS seller_state
        FROM split_rows WHERE split = 'train'""",
    "regression_metrics": f"SELECT rows, {_r('r2', 'mae', 'mse', 'rmse', 'mape')} FROM scores",
    "baseline_delta": f"""
        SELECT {_r('r2_delta', 'mae_delta')}, improved
        FROM (SELECT r2 - CAST(0.7831 AS DOUBLE) AS r2_delta,
                     mae - CAST(20.50 AS DOUBLE) AS mae_delta, r2 > 0.7831 AS improved
              FROM scores )""",
    "score_validate": "SELECT request_id, nullif(reasons, '') AS error FROM checked",
    "score_defaults": f"""
        SELECT request_id, payment_type_mode, customer_state, seller_state,
               {_i('product_sales_count', 'seller_sales_count', 'seller_product_diversity',
                   'max_installments')},
               {_r('product_avg_review', 'seller_avg_review', 'category_avg_price',
                   'seller_avg_price')}
        FROM accepted """,
    "score_features": f"""
        SELECT request_id, {_CURRENT}, {_i('max_installments')} FROM accepted_features """,
}



def _fit(algorithm: str, rows: str) -> str:
    return f"""
        SELECT '{algorithm}' AS algorithm,
               count(CASE WHEN split = 'train' THEN 1 END) AS train_rows,
               count(CASE WHEN split = 'test' THEN 1 END) AS test_rows,
               {_r("avg(CASE WHEN split = 'train' THEN label END)").rsplit(" AS ", 1)[0]}
                 AS mean_label, TRUE AS mean_kept, TRUE AS finite_scores
        FROM {rows} """


def _search(candidates: int) -> str:
    return f"""
        SELECT {candidates} AS candidates, 1 AS winners, TRUE AS winner_is_best,
               {candidates} AS distinct_params, TRUE AS within_space"""


_SCORED = f"""
        SELECT request_id, {_r('predicted_price')}, nullif(reasons, '') AS error
        FROM checked LEFT JOIN priced_requests USING (request_id) """

_BODIES |= {
    "scan_counts_csv": _BODIES["scan_counts"],
    "scan_counts_layout": _BODIES["scan_counts"],
    "csv_multiline_records": "SELECT doc_id, md5(text) AS digest FROM documents",
    "reviews_csv": f"""
        SELECT {_i('review_id', 'order_id', 'review_score')},
               date_trunc('second', review_creation_date) AS review_creation_date FROM reviews """,
    "job_counts": _BODIES["scan_counts"]
    + " UNION ALL SELECT 'training_rows', count(*) FROM encoded",
    "order_item_facts_layout": _BODIES["order_item_facts"],
    "seller_diversity_sketch": """
        SELECT seller_id, seller_product_diversity, TRUE AS within FROM seller_sales """,
    "quantile_sketch": """
        SELECT unnest(['price_low', 'price_median', 'price_high', 'freight_value_low',
                       'freight_value_median', 'freight_value_high']) AS target,
               TRUE AS within FROM (SELECT 1) """,
    "search_prefix_scores": "SELECT unnest([2, 4, 6]) AS rounds, TRUE AS equal",
    "category_median_sales_csv": _BODIES["category_median_sales"],
    "category_avg_review_csv": _BODIES["category_avg_review"],
    "fit_linear": _fit("Linear Regression", "baseline_split"),
    "fit_tree": _fit("Decision Tree", "baseline_split"),
    "fit_forest": _fit("Random Forest", "baseline_split"),
    "fit_gbt": _fit("Gradient Boosting", "baseline_split"),
    "fit_gbt_tuned": _fit("Gradient Boosting, tuned", "encoded"),
    "tune_summary": _search(3),
    "tune_summary_baseline": _search(2),
    "result_record": """
        SELECT 'GBT' AS algorithm, 26 AS features_count,
               'freight_value,product_photos_qty,product_weight_g,'
               || 'product_volume_cm3,product_description_lenght,product_name_lenght,'
               || 'density,shipping_ratio,complexity_score,log_weight,log_volume,'
               || 'purchase_month,is_peak_season,product_avg_review,seller_avg_review,'
               || 'max_installments,product_sales_count,seller_sales_count,'
               || 'seller_product_diversity,category_avg_price,seller_avg_price' AS features_numeric,
               'product_category_name_english,size_category,payment_type_mode,customer_state,seller_state' AS features_categorical, 7 AS params,
               'olist_order_payments_dataset.csv,olist_order_reviews_dataset.csv,'
               || 'olist_customers_dataset.csv,olist_sellers_dataset.csv' AS new_tables_used,
               TRUE AS leakage_fixed, TRUE AS r2_delta_right, TRUE AS mae_delta_right""",
    "model_comparison": """
        SELECT unnest(['Linear Regression', 'Decision Tree', 'Random Forest',
                       'Gradient Boosting']) AS algorithm, TRUE AS in_order""",
    "model_roundtrip": """
        SELECT count(*) AS rows, 0 AS different FROM encoded WHERE split = 'test'""",
    "score_batch": _SCORED,
    "score_stream": _SCORED,
    "score_stream_sinks": f"""
        SELECT request_id, CASE WHEN reasons = '' THEN predicted_price END AS predicted_price,
               error, CASE WHEN error IS NULL THEN 'priced' ELSE 'rejected' END AS sink
        FROM (SELECT request_id, {_r('predicted_price')}, nullif(reasons, '') AS error, reasons
              FROM checked LEFT JOIN priced_requests USING (request_id)) """,
    "score_batch_tree": """
        SELECT request_id, CASE WHEN reasons = '' THEN TRUE END AS priced,
               nullif(reasons, '') AS error FROM checked """,
}

ORACLES: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
