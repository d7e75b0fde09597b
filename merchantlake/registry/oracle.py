"""The queries again, as SQL on the input tables (DuckDB dialect)."""

from __future__ import annotations

_TX = """
SELECT CASE WHEN l_partkey % 211 <> 0 THEN 'M_' || CAST(l_partkey // 2 AS VARCHAR) END AS merchant_id,
       l_extendedprice AS purchase_amount,
       NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS category,
       o_orderdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS purchase_date,
       CASE WHEN o_custkey % 97 <> 13 THEN CAST(floor(sqrt(3 * o_custkey)) AS INTEGER) END AS city_id,
       CASE WHEN c_nationkey = 0 THEN -1 ELSE c_nationkey END AS state_id,
       CASE WHEN l_linenumber <> 7 THEN l_linenumber - 1 END AS installments
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

_MERCHANTS = """
SELECT 'M_' || CAST(p_partkey // 2 AS VARCHAR) AS merchant_id,
       CASE WHEN p_partkey % 50 <> 0 THEN p_name || ' ' || p_brand END AS merchant_name,
       CASE p_size % 6 WHEN 0 THEN 'A' WHEN 1 THEN ' b ' WHEN 2 THEN 'C' WHEN 3 THEN 'd' WHEN 4 THEN 'E'
            ELSE 'z' END AS most_recent_sales_range,
       CASE p_size % 5 WHEN 0 THEN 'E' WHEN 1 THEN 'D' WHEN 2 THEN 'C' WHEN 3 THEN 'B'
            ELSE 'A' END AS most_recent_purchases_range,
       p_size % 13 AS active_months_lag12,
       p_size % 7 AS active_months_lag6,
       p_size % 4 AS active_months_lag3,
       p_retailprice AS avg_purchases_lag12
FROM part
WHERE (p_partkey // 2) % 10 <> 9 AND NOT (p_partkey % 2 = 1 AND (p_partkey // 2) % 3 = 0)"""


def _letter(column: str) -> str:
    return (
        f"CASE upper(trim({column})) WHEN 'A' THEN 1 WHEN 'B' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 "
        "WHEN 'E' THEN 5 END"
    )


_RANKED = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY merchant_id ORDER BY
            {_letter("most_recent_sales_range")} ASC NULLS LAST,
            {_letter("most_recent_purchases_range")} ASC NULLS LAST,
            active_months_lag12 DESC NULLS LAST, active_months_lag6 DESC NULLS LAST,
            active_months_lag3 DESC NULLS LAST, avg_purchases_lag12 DESC NULLS LAST,
            merchant_name ASC NULLS LAST,
            most_recent_sales_range ASC NULLS LAST, most_recent_purchases_range ASC NULLS LAST) AS INTEGER)
         AS resolution_rank,
       count(*) OVER (PARTITION BY merchant_id) AS rows_for_id
FROM merchants"""

_SILVER = """
SELECT tx.merchant_id, purchase_amount AS amount, coalesce(category, 'Unknown category') AS category,
       purchase_date AS purchase_ts, city_id, state_id, installments,
       coalesce(r.merchant_name, tx.merchant_id) AS merchant_name
FROM tx LEFT JOIN ranked r ON tx.merchant_id = r.merchant_id AND r.resolution_rank = 1"""

_MONEY = "CAST(sum(CAST(amount AS DECIMAL(38,10))) AS DOUBLE)"

_Q1 = f"""
SELECT "Month", "City", "Merchant", "Purchase Total", "No of sales" FROM (
  SELECT *, row_number() OVER (PARTITION BY "Month", "City"
                               ORDER BY "Purchase Total" DESC NULLS LAST, "Merchant" ASC NULLS FIRST) AS place
  FROM (SELECT strftime(purchase_ts, '%Y-%m') AS "Month", 'City_' || CAST(city_id AS VARCHAR) AS "City",
               merchant_name AS "Merchant", {_MONEY} AS "Purchase Total", count(*) AS "No of sales"
        FROM silver GROUP BY 1, 2, 3))
WHERE place <= 5"""

_Q2 = f"""
SELECT merchant_name AS "Merchant", state_id AS "State ID",
       {_MONEY} / NULLIF(CAST(count(amount) AS DOUBLE), 0) AS "Average Amount"
FROM silver GROUP BY 1, 2"""

_Q3 = f"""
SELECT category, hour_of_day * 100 AS "Hour", total_amount, hour_of_day FROM (
  SELECT *, row_number() OVER (PARTITION BY category
                               ORDER BY total_amount DESC NULLS LAST, hour_of_day ASC NULLS FIRST) AS place
  FROM (SELECT category, CAST(hour(purchase_ts) AS INTEGER) AS hour_of_day, {_MONEY} AS total_amount
        FROM silver GROUP BY 1, 2))
WHERE place <= 3"""

_Q4 = """
SELECT city_id, count(*) AS total_transactions, count(DISTINCT merchant_id) AS distinct_merchants,
       count(DISTINCT category) AS distinct_categories, 'City_' || CAST(city_id AS VARCHAR) AS "City"
FROM silver WHERE city_id IS NOT NULL GROUP BY city_id"""

# Chi-square in its textbook form over the dense matrix.
_ASSOCIATION = """
SELECT CASE WHEN (SELECT count(*) FROM row_totals) < 2 OR (SELECT count(*) FROM column_totals) < 2
            THEN CAST('NaN' AS DOUBLE)
            ELSE sqrt((SELECT sum((coalesce(o, 0) - r * c / n) ** 2 / (r * c / n)) FROM dense)
                      / ((SELECT sum(r) FROM row_totals)
                         * least((SELECT count(*) FROM row_totals) - 1, (SELECT count(*) FROM column_totals) - 1)))
       END AS city_category_cramers_v,
       'cramers_v_city_x_category_global' AS metric_description,
       CAST(50 AS BIGINT) AS min_city_tx_for_contingency"""
_ASSOCIATION_CTES = {
    "heavy": """
SELECT city_id, category, count(*) AS o FROM silver
WHERE city_id IN (SELECT city_id FROM silver WHERE city_id IS NOT NULL GROUP BY city_id HAVING count(*) >= 50)
GROUP BY 1, 2""",
    "row_totals": "\nSELECT city_id, CAST(sum(o) AS DOUBLE) AS r FROM heavy GROUP BY 1",
    "column_totals": "\nSELECT category, CAST(sum(o) AS DOUBLE) AS c FROM heavy GROUP BY 1",
    "dense": """
SELECT o, r, c, (SELECT sum(r) FROM row_totals) AS n
FROM row_totals CROSS JOIN column_totals
LEFT JOIN heavy ON heavy.city_id = row_totals.city_id AND heavy.category = column_totals.category""",
}

_Q4_TOP = """
SELECT CAST(global_rank AS INTEGER) AS global_rank, t.merchant_id, t.merchant_name, total_transactions,
       p.city_id AS primary_city_id, 'City_' || CAST(p.city_id AS VARCHAR) AS "City",
       p.tx_in_city AS tx_in_primary_city, n_cities_active
FROM (SELECT *, row_number() OVER (ORDER BY total_transactions DESC, merchant_id ASC NULLS FIRST) AS global_rank
      FROM (SELECT merchant_id, merchant_name, count(*) AS total_transactions,
                   count(DISTINCT city_id) AS n_cities_active
            FROM silver WHERE city_id IS NOT NULL GROUP BY 1, 2)) t
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY tx_in_city DESC, city_id ASC) AS place
           FROM (SELECT merchant_id, city_id, count(*) AS tx_in_city
                 FROM silver WHERE city_id IS NOT NULL GROUP BY 1, 2)) p
  ON p.merchant_id = t.merchant_id AND p.place = 1
WHERE global_rank <= 100"""

_Q4_DISTRIBUTION = """
SELECT primary_city_id, "City", count(*) AS n_top_merchants_in_top_k,
       CAST(count(*) AS DOUBLE) / 100.0e0 * 100.0e0 AS pct_of_top_k
FROM q4_top GROUP BY 1, 2"""

_Q4_POPULARITY = """
SELECT 'City_' || CAST(city_id AS VARCHAR) AS "City", city_id, merchant_id, merchant_name, transaction_count,
       CAST(place AS INTEGER) AS popularity_rank
FROM (SELECT *, row_number() OVER (PARTITION BY city_id
                                   ORDER BY transaction_count DESC, merchant_id ASC NULLS FIRST) AS place
      FROM (SELECT city_id, merchant_id, merchant_name, count(*) AS transaction_count
            FROM silver WHERE city_id IS NOT NULL GROUP BY 1, 2, 3))
WHERE place <= 5"""

_REVENUE = "(0.771e0 * {a} + 0.229e0 * 0.5e0 * {a})"

_Q5 = f"""
SELECT merchant_name, category, city_id, amount, installments,
       CASE WHEN installments > 0 THEN 'with_installments' ELSE 'without_installments' END AS installments_flag,
       {_REVENUE.format(a="amount")} AS expected_revenue_installments,
       {_REVENUE.format(a="amount")} * 0.25e0 AS expected_profit_installments,
       amount * 0.25e0 AS expected_profit_no_installments,
       {_REVENUE.format(a="amount")} * 0.25e0 - amount * 0.25e0 AS expected_profit_delta_installments,
       coalesce(amount * 0.25e0 * 0.771e0 + amount * 0.5e0 * 0.25e0 * 0.229e0 >= amount * 0.25e0 * 0.8e0, false)
         AS installments_recommended,
       CAST(0.221375 AS FLOAT) AS expected_profit_margin,
       CAST(0.229 AS FLOAT) AS risk_score,
       'Gross profit margin 25%; Default rate 22.9% per month; Payment before default 50% of principal; '
         || 'Equal monthly installments' AS assumptions
FROM silver"""

_FLAG = "CASE WHEN installments > 0 THEN 'with_installments' ELSE 'without_installments' END"
_FINANCING = (
    "'q5e_installments_overall', 'q5_installments_impact', 'q5e_installments_by_category', "
    "'q5e_installments_by_city'"
)


def _section(name: str, part: str, flag: str, where: str = "true") -> str:
    return f"""
SELECT '{name}' AS section, {part} AS part, {flag} AS flag, count(*) AS n,
       sum(CAST(amount AS DECIMAL(38,10))) AS total
FROM silver WHERE {where} GROUP BY 2, 3"""


_NONE = "CAST(NULL AS VARCHAR)"
_CITY = "CAST(city_id AS VARCHAR)"
_PARTS = "\nUNION ALL".join(
    [
        _section("q5a_cities", _CITY, _NONE, "city_id IS NOT NULL"),
        _section("q5b_categories", "category", _NONE),
        _section("q5c_months", "strftime(purchase_ts, '%Y-%m')", _NONE),
        _section("q5d_hours", "CAST(hour(purchase_ts) AS VARCHAR)", _NONE),
        _section("q5e_installments_overall", _NONE, _FLAG),
        _section("q5_installments_impact", _NONE, _FLAG),
        _section("q5e_installments_by_category", "category", _FLAG),
        _section("q5e_installments_by_city", _CITY, _FLAG, "city_id IS NOT NULL"),
    ]
)
_SCORED = """
SELECT *, CASE WHEN section = 'q5a_cities' THEN
                 0.4e0 * percent_rank() OVER (PARTITION BY section ORDER BY n)
                 + 0.4e0 * percent_rank() OVER (PARTITION BY section ORDER BY total)
                 + 0.2e0 * percent_rank() OVER (PARTITION BY section ORDER BY avg_ticket)
               ELSE CAST(total AS DOUBLE) END AS ordering,
       ntile(4) OVER (PARTITION BY section ORDER BY n DESC, part ASC) AS by_volume,
       ntile(4) OVER (PARTITION BY section ORDER BY avg_ticket DESC, part ASC) AS by_ticket
FROM (SELECT *, CAST(total AS DOUBLE) / NULLIF(CAST(n AS DOUBLE), 0) AS avg_ticket FROM parts)"""
_KEPT = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY section ORDER BY ordering DESC NULLS LAST,
                                            TRY_CAST(part AS INTEGER) ASC NULLS FIRST) AS place FROM scored)
WHERE section <> 'q5a_cities' OR place <= 40"""
_ADVISORY = f"""
SELECT section,
       CASE WHEN section IN ({_FINANCING}) THEN concat_ws('|', part, flag) ELSE part END AS detail_key,
       CASE WHEN section = 'q5a_cities' THEN 'City_' || part
            WHEN section = 'q5e_installments_by_city' THEN 'City_' || part || ' | ' || flag
            WHEN section IN ({_FINANCING}) THEN concat_ws(' | ', part, flag) ELSE part END AS detail_label,
       n AS transaction_count, CAST(total AS DOUBLE) AS total_amount, avg_ticket,
       CASE WHEN section NOT IN ({_FINANCING}) THEN NULL
            WHEN flag = 'with_installments' THEN {_REVENUE.format(a="CAST(total AS DOUBLE)")}
            ELSE CAST(total AS DOUBLE) END AS expected_revenue,
       CASE WHEN section NOT IN ({_FINANCING}) THEN NULL
            WHEN flag = 'with_installments' THEN {_REVENUE.format(a="CAST(total AS DOUBLE)")} * 0.25e0
            ELSE CAST(total AS DOUBLE) * 0.25e0 END AS expected_profit,
       CAST(total AS DOUBLE) / NULLIF(CAST(sum(total) OVER (PARTITION BY section) AS DOUBLE), 0) AS share_of_total,
       CASE WHEN section NOT IN ('q5e_installments_by_category', 'q5e_installments_by_city') THEN
         CAST(sum(total) OVER (PARTITION BY section ORDER BY ordering DESC NULLS LAST
                               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
         / NULLIF(CAST(sum(total) OVER (PARTITION BY section) AS DOUBLE), 0) END AS cumulative_share,
       CASE WHEN section = 'q5b_categories' THEN
              CASE WHEN by_volume = 1 AND by_ticket > 2 THEN 'high_volume'
                   WHEN by_ticket = 1 AND by_volume > 2 THEN 'high_value' ELSE 'balanced' END
            WHEN section IN ('q5e_installments_by_category', 'q5e_installments_by_city') THEN part END AS segment,
       CASE section WHEN 'q5a_cities' THEN 'score=0.4*volume+0.4*revenue+0.2*avg_ticket'
            WHEN 'q5b_categories' THEN 'segment based on transaction_count and avg_ticket quartiles'
            WHEN 'q5e_installments_overall' THEN 'default_rate=22.9%, recovery=50%, gross_margin=25%'
            WHEN 'q5_installments_impact' THEN 'default_rate=22.9%, recovery=50%, gross_margin=25%'
            WHEN 'q5e_installments_by_category' THEN 'segmented installment comparison by category'
            WHEN 'q5e_installments_by_city' THEN 'segmented installment comparison by city' END AS extra_note
FROM kept"""

# Common table expressions and what each reads.
_CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "tx": (_TX, ()),
    "merchants": (_MERCHANTS, ()),
    "ranked": (_RANKED, ("merchants",)),
    "silver": (_SILVER, ("tx", "ranked")),
    "q1": (_Q1, ("silver",)),
    "q2": (_Q2, ("silver",)),
    "q3": (_Q3, ("silver",)),
    "q4": (_Q4, ("silver",)),
    "heavy": (_ASSOCIATION_CTES["heavy"], ("silver",)),
    "row_totals": (_ASSOCIATION_CTES["row_totals"], ("heavy",)),
    "column_totals": (_ASSOCIATION_CTES["column_totals"], ("heavy",)),
    "dense": (_ASSOCIATION_CTES["dense"], ("heavy", "row_totals", "column_totals")),
    "association": (_ASSOCIATION, ("dense",)),
    "q4_top": (_Q4_TOP, ("silver",)),
    "q4_distribution": (_Q4_DISTRIBUTION, ("q4_top",)),
    "q4_popularity": (_Q4_POPULARITY, ("silver",)),
    "q5": (_Q5, ("silver",)),
    "parts": (_PARTS, ("silver",)),
    "scored": (_SCORED, ("parts",)),
    "kept": (_KEPT, ("scored",)),
    "advisory": (_ADVISORY, ("kept",)),
    "states": (
        """
SELECT "State ID", count(DISTINCT "Merchant") AS n_merchants, avg("Average Amount") AS avg_of_avg
FROM q2 WHERE "State ID" IS NOT NULL AND "Average Amount" IS NOT NULL AND "State ID" <> -1 GROUP BY 1""",
        ("q2",),
    ),
    "per_id": (
        """
SELECT merchant_id, count(*) AS rows_for_id, count(DISTINCT (merchants)) AS unique_rows_for_id,
       count(DISTINCT merchant_name) + max(CASE WHEN merchant_name IS NULL THEN 1 ELSE 0 END) > 1 AS v1,
       count(DISTINCT most_recent_sales_range) > 1 AS v2,
       count(DISTINCT most_recent_purchases_range) > 1 AS v3,
       count(DISTINCT active_months_lag12) > 1 AS v4,
       count(DISTINCT active_months_lag6) > 1 AS v5,
       count(DISTINCT active_months_lag3) > 1 AS v6,
       count(DISTINCT avg_purchases_lag12) > 1 AS v7
FROM merchants GROUP BY merchant_id""",
        ("merchants",),
    ),
    "groups": (
        """
SELECT merchant_id, rows_for_id, unique_rows_for_id,
       list_filter([CASE WHEN v1 THEN 'merchant_name' END, CASE WHEN v2 THEN 'most_recent_sales_range' END,
                    CASE WHEN v3 THEN 'most_recent_purchases_range' END, CASE WHEN v4 THEN 'active_months_lag12' END,
                    CASE WHEN v5 THEN 'active_months_lag6' END, CASE WHEN v6 THEN 'active_months_lag3' END,
                    CASE WHEN v7 THEN 'avg_purchases_lag12' END], lambda x : x IS NOT NULL) AS names
FROM per_id WHERE rows_for_id > 1 AND merchant_id IS NOT NULL""",
        ("per_id",),
    ),
    "orphans": (
        """
SELECT DISTINCT merchant_id FROM tx
WHERE merchant_id IS NOT NULL AND merchant_id NOT IN (SELECT merchant_id FROM merchants)""",
        ("tx", "merchants"),
    ),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []
    for name in names:
        for n in [*_needed(_CTES[name][1]), name]:
            if n not in order:
                order.append(n)
    return order


def _sql(select: str, *reads: str) -> str:
    ctes = [f"{n} AS ({_CTES[n][0]}\n)" for n in _needed(reads)]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select.strip()


def _all(name: str) -> str:
    return _sql(f"SELECT * FROM {name}", name)


def _advisory_section(name: str) -> str:
    return _sql(f"SELECT * FROM advisory WHERE section = '{name}'", "advisory")


def _null_ratios() -> str:
    columns = ["merchant_id", "purchase_amount", "category", "purchase_date", "city_id", "state_id", "installments"]
    rows = [
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
  coalesce(CAST(count(*) - count({c}) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0), 0e0) AS null_ratio,
  coalesce(CAST(count(*) - count({c}) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0), 0e0) <= 0.05e0 AS ok FROM tx"""
        for c in columns
    ]
    return _sql("\nUNION ALL ".join(rows), "tx")


def _profile() -> str:
    columns = ["amount", "installments", "city_id"]
    statistics = {
        "count": "CAST(count({c}) AS DOUBLE)",
        "mean": "round(avg({c}), 4)",
        "stddev": "round(stddev_samp({c}), 4)",
        "min": "CAST(min({c}) AS DOUBLE)",
        "max": "CAST(max({c}) AS DOUBLE)",
    }
    rows = [
        f"SELECT '{name}' AS summary, " + ", ".join(f"{f.format(c=c)} AS {c}" for c in columns) + " FROM silver"
        for name, f in statistics.items()
    ]
    return _sql("\nUNION ALL ".join(rows), "silver")


def _column_contract() -> str:
    known = ["merchant_id", "category", "city_id", "state_id", "installments"]
    extra = ["amount", "purchase_ts", "merchant_name"]
    rows = [
        f"""SELECT 'enriched_transactions' AS table_name, '{c}' AS column_name, '{"ok" if c in known else "extra"}' AS status,
  'info' AS severity, CAST(NULL AS VARCHAR) AS known_as, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM silver"""
        for c in known + extra
    ]
    rows += [
        f"""SELECT 'enriched_transactions', '{c}', 'missing', 'warn', '{new}',
  CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"""
        for c, new in (("purchase_amount", "amount"), ("purchase_date", "purchase_ts"))
    ]
    return _sql("\nUNION ALL ".join(rows), "silver")


def _merchant_contract() -> str:
    present = [
        "merchant_id", "merchant_name", "most_recent_sales_range", "most_recent_purchases_range",
        "active_months_lag12", "active_months_lag6", "active_months_lag3", "avg_purchases_lag12",
    ]
    absent = [
        "merchant_group_id", "merchant_category_id", "subsector_id", "numerical_1", "numerical_2", "avg_sales_lag3",
        "avg_purchases_lag3", "avg_sales_lag6", "avg_purchases_lag6", "avg_sales_lag12", "city_id", "state_id",
    ]
    rows = [
        f"""SELECT 'merchants' AS table_name, '{c}' AS column_name, 'ok' AS status, 'info' AS severity,
  CAST(NULL AS VARCHAR) AS known_as, count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM merchants"""
        for c in present
    ]
    rows += [
        f"SELECT 'merchants', '{c}', 'missing', 'warn', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"
        for c in absent
    ]
    return _sql("\nUNION ALL ".join(rows), "merchants")


def _merchant_profile() -> str:
    columns = [
        "merchant_id", "merchant_name", "most_recent_sales_range", "most_recent_purchases_range",
        "active_months_lag12", "active_months_lag6", "active_months_lag3", "avg_purchases_lag12",
    ]
    rows = [
        "SELECT 'rows' AS metric, count(*) AS value FROM merchants",
        "SELECT 'repeated_id_rows', CAST(sum(rows_for_id - 1) AS BIGINT) FROM per_id",
    ]
    rows += [f"SELECT 'nulls:{c}', count(*) - count({c}) FROM merchants" for c in columns]
    return _sql("\nUNION ALL ".join(rows), "merchants", "per_id")


_SCHEMA_DRIFT = """
SELECT 'load=0' AS part, count(*) AS n_rows, CAST(7 AS INTEGER) AS n_columns, false AS differs FROM tx WHERE state_id <= 12
UNION ALL
SELECT 'load=1', count(*), CAST(6 AS INTEGER), true FROM tx WHERE state_id > 12"""


def _gold_findings() -> str:
    """Every rule again, as (question, code, ok, severity when it fails, message)."""

    def rows(question: str, prefix: str, table: str, columns: str, schema_code: str) -> list[str]:
        return [
            f"SELECT '{question}', '{prefix}_rows', true, 'info', "
            f"'rows: ' || CAST((SELECT count(*) FROM {table}) AS VARCHAR) || '; columns: {columns}'",
            f"SELECT '{question}', '{schema_code}', true, 'info', 'missing columns: '",
        ]

    def rule(question: str, code: str, severity: str, values: str, ok: str, message: str) -> str:
        return f"""SELECT '{question}', '{code}', {ok}, CASE WHEN {ok} THEN 'info' ELSE '{severity}' END, {message}
FROM (SELECT {values})"""

    q4_top_columns = (
        "global_rank, merchant_id, merchant_name, total_transactions, primary_city_id, City, "
        "tx_in_primary_city, n_cities_active"
    )
    q5_columns = (
        "merchant_name, category, city_id, amount, installments, installments_flag, "
        "expected_revenue_installments, expected_profit_installments, expected_profit_no_installments, "
        "expected_profit_delta_installments, installments_recommended, expected_profit_margin, risk_score, assumptions"
    )
    advisory_columns = (
        "section, detail_key, detail_label, transaction_count, total_amount, avg_ticket, expected_revenue, "
        "expected_profit, share_of_total, cumulative_share, segment, extra_note"
    )
    found = [
        *rows("Q1", "q1", "q1", "Month, City, Merchant, Purchase Total, No of sales", "q1_schema"),
        rule(
            "Q1", "q1_top5_per_month_city", "error",
            """(SELECT max(n) FROM (SELECT count(*) AS n FROM q1 GROUP BY "Month", "City")) AS largest,
               (SELECT count(*) FROM (SELECT count(*) AS n FROM q1 GROUP BY "Month", "City") WHERE n > 5) AS over""",
            "over = 0", "'largest group: ' || largest || '; groups over 5: ' || over",
        ),
        rule(
            "Q1", "q1_amounts_non_negative", "warn",
            """(SELECT count(*) FROM (SELECT min("Purchase Total") AS m FROM q1 GROUP BY "Month", "City") WHERE m < 0)
               AS negative""",
            "negative = 0", "'groups with a negative total: ' || negative",
        ),
        *rows("Q2", "q2", "q2", "Merchant, State ID, Average Amount", "q2_schema_pdf"),
        rule(
            "Q2", "q2_order_desc", "warn",
            """(SELECT count(*) FROM (SELECT "Average Amount" AS v, lag("Average Amount") OVER (
                 ORDER BY "Average Amount" DESC NULLS LAST) AS before FROM q2) WHERE v > before) AS breaks""",
            "breaks = 0", "'rows larger than the row before: ' || breaks",
        ),
        *rows("Q3", "q3", "q3", "category, Hour, total_amount, hour_of_day", "q3_schema"),
        rule(
            "Q3", "q3_top3_per_category", "error",
            """(SELECT max(n) FROM (SELECT count(*) AS n FROM q3 GROUP BY category)) AS largest,
               (SELECT count(*) FROM (SELECT count(*) AS n FROM q3 GROUP BY category) WHERE n > 3) AS over""",
            "over = 0", "'largest group: ' || largest || '; groups over 3: ' || over",
        ),
        rule(
            "Q3", "q3_hours_range", "warn",
            "(SELECT count(*) FROM q3 WHERE hour_of_day NOT BETWEEN 0 AND 23) AS outside",
            "outside = 0", "'hours outside 0-23: ' || outside",
        ),
        *rows(
            "Q4", "q4", "q4", "city_id, total_transactions, distinct_merchants, distinct_categories, City", "q4_schema"
        ),
        rule("Q4", "q4_city_metrics", "info", "1 AS one", "true", "'volume per city is present'"),
        *rows("Q5", "q5", "q5", q5_columns, "q5_schema"),
        rule(
            "Q5", "q5_ev_margin", "warn",
            """(SELECT min(expected_profit_margin) = max(expected_profit_margin)
                       AND abs(CAST(min(expected_profit_margin) AS DOUBLE) - 0.221375e0) <= 1e-5 FROM q5) AS same""",
            "same", "'expected profit margin: 0.221375'",
        ),
        rule(
            "Q5", "q5_default_rate", "warn",
            """(SELECT min(risk_score) = max(risk_score)
                       AND abs(CAST(min(risk_score) AS DOUBLE) - 0.229e0) <= 1e-5 FROM q5) AS same""",
            "same", "'default rate: 0.229'",
        ),
        rule("Q5", "q5_advisory_tables", "info", "1 AS one", "true", "'aggregates are in the advisory summary'"),
        rule("Q5", "q5_gross_assumption", "info", "1 AS one", "true", "'gross margin: 0.25'"),
        *rows(
            "Q4a", "q4/city_category_association", "association",
            "city_category_cramers_v, metric_description, min_city_tx_for_contingency", "q4_assoc_schema",
        ),
        rule(
            "Q4a", "q4_assoc_rows", "warn", "(SELECT count(*) FROM association) AS n",
            "n = 1", "'rows: ' || n || ', expected 1'",
        ),
        rule(
            "Q4a", "q4_cramers_v_bounds", "warn", "(SELECT city_category_cramers_v FROM association) AS v",
            "isnan(v) OR v BETWEEN 0 AND 1", "'Cramer''s V: ' || printf('%.6f', v)",
        ),
        *rows("Q4b", "q4/top_merchants_global", "q4_top", q4_top_columns, "q4_global_schema"),
        rule(
            "Q4b", "q4_global_top_k", "warn",
            "(SELECT count(*) FROM q4_top) AS n, (SELECT max(global_rank) FROM q4_top) AS last",
            "n <= 100 AND last <= 100", "'rows: ' || n || '; last rank: ' || last",
        ),
        *rows(
            "Q4c", "q4/top_merchants_distribution_by_city", "q4_distribution",
            "primary_city_id, City, n_top_merchants_in_top_k, pct_of_top_k", "q4_dist_schema",
        ),
        rule(
            "Q4c", "q4_dist_sum", "warn",
            """(SELECT sum(n_top_merchants_in_top_k) FROM q4_distribution) AS merchants,
               least((SELECT count(*) FROM q4_top), 100) AS expected""",
            "merchants = expected", "'merchants: ' || merchants || '; expected: ' || expected",
        ),
        *rows(
            "Q4+", "q4/merchant_popularity_by_city", "q4_popularity",
            "City, city_id, merchant_id, merchant_name, transaction_count, popularity_rank", "q4_pop_schema",
        ),
        rule(
            "Q4+", "q4_pop_top5", "error",
            "(SELECT count(DISTINCT city_id) FROM q4_popularity WHERE popularity_rank > 5) AS over",
            "over = 0", "'cities with a rank over 5: ' || over",
        ),
        *rows("Q5+", "q5_advisory_summary", "advisory", advisory_columns, "q5_adv_schema"),
        rule(
            "Q5+", "q5_adv_sections", "error",
            """(SELECT count(DISTINCT section) FROM advisory WHERE section IN ('q5a_cities', 'q5b_categories',
                 'q5c_months', 'q5d_hours', 'q5_installments_impact')) AS present""",
            "present = 5", "'missing sections: '",
        ),
    ]
    return _sql(
        "SELECT * FROM (\n" + "\nUNION ALL ".join(found) + "\n) AS f(question, code, ok, severity, message)",
        "q1", "q2", "q3", "q4", "association", "q4_top", "q4_distribution", "q4_popularity", "q5", "advisory",
    )


_TOTAL = 'CAST(sum(CAST("Purchase Total" AS DECIMAL(38,10))) AS DOUBLE)'
_FIRST_CITY = '(SELECT min("City") FROM q1)'
_FOURTH_MONTH = (
    f'(SELECT max("Month") FROM (SELECT DISTINCT "Month" FROM q1 WHERE "City" = {_FIRST_CITY} AND "Month" IS NOT NULL '
    'ORDER BY 1 LIMIT 4))'
)


def _of(mode: str, column: str) -> str:
    return f"max(CASE WHEN detail_label = '{mode}' THEN {column} END)"


_WITH, _WITHOUT = "with_installments", "without_installments"

ORACLE: dict[str, str] = {
    "bronze_transactions": _sql(
        "SELECT *, '2024-01-01T00:00:00+00:00' AS _ingested_at, 'transactions' AS _bronze_source FROM tx", "tx"
    ),
    "bronze_merchants": _sql(
        "SELECT *, '2024-01-01T00:00:00+00:00' AS _ingested_at, 'merchants' AS _bronze_source FROM merchants",
        "merchants",
    ),
    "merchants_resolved": _sql(
        "SELECT * EXCLUDE (resolution_rank, rows_for_id) FROM ranked WHERE resolution_rank = 1", "ranked"
    ),
    "merchants_duplicates_audit": _sql(
        "SELECT * EXCLUDE (rows_for_id), resolution_rank = 1 AS is_resolved_winner "
        "FROM ranked WHERE rows_for_id > 1 AND merchant_id IS NOT NULL",
        "ranked",
    ),
    "enriched_transactions": _all("silver"),
    "stored_layers_q1": _all("q1"),
    "bronze_locations": _sql(
        """
SELECT installments, count(*) AS n_rows, CAST(sum(CAST(purchase_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_amount,
       'folder|file|parts' AS layouts, 'folder' AS resolved
FROM tx WHERE state_id IS NOT NULL GROUP BY installments""",
        "tx",
    ),
    "silver_month_rebuilt": _sql(
        """
SELECT CAST(year(purchase_ts) AS INTEGER) AS purchase_year, CAST(month(purchase_ts) AS INTEGER) AS purchase_month,
       count(*) AS transaction_count,
       CAST(sum(CAST(amount AS DECIMAL(38,10))
                + CASE WHEN date_trunc('month', purchase_ts) = (SELECT date_trunc('month', min(purchase_ts)) FROM silver) THEN 1 ELSE 0 END)
            AS DOUBLE) AS total_amount
FROM silver GROUP BY 1, 2""",
        "silver",
    ),
    "silver_city_month": _sql(
        "SELECT * FROM silver WHERE city_id = 14 AND purchase_ts >= DATE '1996-07-01' AND purchase_ts < DATE '1996-08-01'", "silver"
    ),
    "dq_gate": _sql(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS null_ratio, "
            f"CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) <= 0.05e0 AS ok FROM silver"
            for c in ("merchant_id", "amount", "purchase_ts", "city_id", "installments")
        ),
        "silver",
    ),
    "dq_csv_misfits": _sql(
        """
SELECT 'active_months_lag12' AS column_name, 'int' AS declared, count(*) AS n_misfits, 'string' AS kept_as, 'n/a' AS first_misfit
FROM merchants WHERE active_months_lag12 = 5 HAVING count(*) > 0
UNION ALL
SELECT 'active_months_lag6', 'int', count(*), 'double', '2.5' FROM merchants WHERE active_months_lag6 = 2 HAVING count(*) > 0""",
        "merchants",
    ),
    "dq_gold_path": """
SELECT *, true AS strict_fails FROM (VALUES
  ('Q2', 'q2_path', 'error'), ('Q3', 'q3_schema', 'error'), ('Q5', 'q5_path', 'error'),
  ('Q4a', 'q4/city_category_association_path', 'warn'), ('Q4b', 'q4/top_merchants_global_path', 'warn'),
  ('Q4c', 'q4/top_merchants_distribution_by_city_path', 'warn'), ('Q4+', 'q4/merchant_popularity_by_city_path', 'warn'),
  ('Q5+', 'q5_advisory_summary_path', 'warn')) t (question, code, severity)""",
    "q4_merchants_by_month": _sql(
        "SELECT strftime(purchase_ts, '%Y-%m') AS month, city_id, count(DISTINCT merchant_id) AS distinct_merchants "
        "FROM silver WHERE merchant_id IS NOT NULL GROUP BY 1, 2",
        "silver",
    ),
    "q4_merchants_by_period": _sql(
        """
SELECT CAST(year(purchase_ts) AS VARCHAR) || '-Q' || CAST(quarter(purchase_ts) AS VARCHAR) AS quarter, CAST(NULL AS INTEGER) AS city_id,
       count(DISTINCT merchant_id) AS distinct_merchants
FROM silver WHERE merchant_id IS NOT NULL GROUP BY 1
UNION ALL
SELECT 'all', city_id, count(DISTINCT merchant_id) FROM silver WHERE merchant_id IS NOT NULL GROUP BY 2""",
        "silver",
    ),
    "q5_transaction_sample": _sql(
        "SELECT * FROM q5 ORDER BY amount DESC NULLS LAST, merchant_name NULLS FIRST, category NULLS FIRST, city_id NULLS FIRST, "
        "installments NULLS FIRST LIMIT 500",
        "q5",
    ),
    "q1_top_merchants": _all("q1"),
    "q2_avg_by_state": _all("q2"),
    "q3_peak_hours": _all("q3"),
    "q4_city_metrics": _all("q4"),
    "q4_city_category_association": _sql(
        "SELECT * REPLACE (round(city_category_cramers_v, 10) AS city_category_cramers_v) FROM association",
        "association",
    ),
    "q4_top_merchants_global": _all("q4_top"),
    "q4_top_merchants_distribution": _all("q4_distribution"),
    "q4_merchant_popularity_by_city": _all("q4_popularity"),
    "q5_transactions_ev": _all("q5"),
    **{
        name: _advisory_section(name)
        for name in (
            "q5a_cities", "q5b_categories", "q5c_months", "q5d_hours", "q5e_installments_overall",
            "q5_installments_impact", "q5e_installments_by_category", "q5e_installments_by_city",
        )
    },
    "q5_advisory_summary": _all("advisory"),
    "monthly_volume": _sql(
        f"SELECT CAST(date_trunc('month', purchase_ts) AS DATE) AS month_start, count(*) AS transaction_count, "
        f"{_MONEY} AS total_amount FROM silver GROUP BY 1",
        "silver",
    ),
    "dq_null_ratio": _null_ratios(),
    "dq_profile_numeric": _profile(),
    "dq_gold_findings": _gold_findings(),
    "dq_column_contract": _column_contract(),
    "dq_column_contract_merchants": _merchant_contract(),
    "dq_merchant_profile": _merchant_profile(),
    "dq_schema_drift": _sql(_SCHEMA_DRIFT, "tx"),
    "dq_orphan_merchants": _sql(
        "SELECT count(*) AS n_orphans, (SELECT coalesce(string_agg(merchant_id, '|' ORDER BY merchant_id), '') "
        "FROM (SELECT * FROM orphans ORDER BY merchant_id LIMIT 15)) AS sample FROM orphans",
        "orphans",
    ),
    "dq_orphan_ids": _all("orphans"),
    "dq_duplicate_groups": _sql(
        "SELECT merchant_id, rows_for_id, unique_rows_for_id, CAST(len(names) AS INTEGER) AS varying_columns_count, "
        "array_to_string(names, '|') AS varying_columns FROM groups",
        "groups",
    ),
    "dq_duplicate_metrics": _sql(
        "SELECT (SELECT count(*) FROM merchants) AS merchant_rows_total, "
        "(SELECT count(DISTINCT merchant_id) FROM merchants) AS merchant_id_distinct, "
        "(SELECT CAST(coalesce(sum(rows_for_id), 0) AS BIGINT) FROM per_id WHERE rows_for_id > 1) AS duplicate_rows, "
        "count(*) AS duplicate_ids, count(*) FILTER (unique_rows_for_id > 1) AS groups_with_differences, "
        "coalesce(max(rows_for_id), 0) AS max_rows_same_id, "
        "(SELECT CAST(count(DISTINCT name) AS INTEGER) FROM (SELECT unnest(names) AS name FROM groups)) "
        "AS top_varying_columns_count FROM groups",
        "groups", "per_id", "merchants",
    ),
    "dq_duplicate_rows": _sql(
        "SELECT * EXCLUDE (resolution_rank, rows_for_id) FROM ranked WHERE rows_for_id > 1 AND merchant_id IS NOT NULL",
        "ranked",
    ),
    "dq_duplicate_tx_impact": _sql(
        """
SELECT n AS tx_rows_total, hit AS tx_rows_with_duplicate_merchant_id,
       CAST(hit AS DOUBLE) / CAST(n AS DOUBLE) AS tx_rows_impact_ratio,
       CAST(total AS DOUBLE) AS tx_amount_total, CAST(total_hit AS DOUBLE) AS tx_amount_with_duplicate_merchant_id,
       CAST(total_hit AS DOUBLE) / CAST(total AS DOUBLE) AS tx_amount_impact_ratio,
       joined AS possible_join_multiplication_rows
FROM (SELECT count(*) AS n, count(*) FILTER (g.merchant_id IS NOT NULL) AS hit,
             sum(CAST(purchase_amount AS DECIMAL(38,10))) AS total,
             sum(CAST(purchase_amount AS DECIMAL(38,10))) FILTER (g.merchant_id IS NOT NULL) AS total_hit,
             CAST(sum(g.rows_for_id) AS BIGINT) AS joined
      FROM tx LEFT JOIN groups g ON tx.merchant_id = g.merchant_id)""",
        "tx", "groups",
    ),
    "dq_silver_anomalies": _sql(
        """
SELECT count(*) AS n_rows, count(*) FILTER (merchant_id IS NULL) AS null_merchant_id,
       count(*) FILTER (merchant_id IS NOT NULL AND merchant_name IS NULL) AS null_name_with_id,
       count(*) FILTER (merchant_id IS NOT NULL AND merchant_name = '') AS empty_name_with_id,
       count(*) FILTER (category IS NULL) AS null_category, count(*) FILTER (category = '') AS empty_category,
       count(*) FILTER (category = 'Unknown category') AS unknown_category
FROM silver""",
        "silver",
    ),
    "rep_q1_kpis": _sql(
        f'SELECT count(DISTINCT "Month") AS n_months, count(DISTINCT "City") AS n_cities, '
        f'count(DISTINCT "Merchant") AS n_merchants, {_TOTAL} AS total_purchase FROM q1',
        "q1",
    ),
    "rep_q1_months": _sql(
        'SELECT * FROM q1 WHERE "Month" IN '
        '(SELECT DISTINCT "Month" FROM q1 WHERE "Month" IS NOT NULL ORDER BY 1 LIMIT 3)',
        "q1",
    ),
    "rep_q1_focus": _sql(
        f'SELECT * FROM q1 WHERE "City" = {_FIRST_CITY} AND "Month" = {_FOURTH_MONTH} '
        'ORDER BY "Purchase Total" DESC NULLS LAST, "Merchant" ASC NULLS FIRST LIMIT 5',
        "q1",
    ),
    "rep_q1_city_trend": _sql(
        f'SELECT "Month", {_TOTAL} AS "Purchase Total" FROM q1 '
        f'WHERE "City" = {_FIRST_CITY} AND "Month" IS NOT NULL GROUP BY 1',
        "q1",
    ),
    "rep_q1_city_choices": _sql('SELECT DISTINCT "City" FROM q1 WHERE "City" IS NOT NULL', "q1"),
    "rep_q2_state_summary": _sql(
        'SELECT "State ID", n_merchants, round(avg_of_avg, 4) AS avg_of_avg FROM states', "states"
    ),
    "rep_q2_state_kpis": _sql(
        'SELECT count(*) AS n_states, (SELECT "State ID" FROM states ORDER BY avg_of_avg DESC, "State ID" LIMIT 1) '
        "AS top_state, round(max(avg_of_avg), 4) AS top_avg_of_avg FROM states",
        "states",
    ),
    "rep_q2_top_merchants": _sql(
        'SELECT * FROM q2 WHERE "State ID" = (SELECT "State ID" FROM states ORDER BY avg_of_avg DESC, "State ID" '
        'LIMIT 1) AND "Average Amount" IS NOT NULL ORDER BY "Average Amount" DESC, "Merchant" ASC NULLS FIRST LIMIT 15',
        "q2", "states",
    ),
    "rep_q2_state_leaderboard": _sql(
        'SELECT "State ID", n_merchants, round(avg_of_avg, 4) AS avg_of_avg FROM '
        '(SELECT * FROM states ORDER BY avg_of_avg DESC, "State ID" LIMIT 10)',
        "states",
    ),
    "rep_q3_overall_peak": _sql(
        "SELECT hour_of_day, category, total_amount FROM q3 "
        "ORDER BY total_amount DESC NULLS LAST, category, hour_of_day LIMIT 1",
        "q3",
    ),
    "rep_q3_category": _sql("SELECT * FROM q3 WHERE category = (SELECT min(category) FROM q3)", "q3"),
    "rep_q4_top_cities": _sql("SELECT * FROM q4 ORDER BY total_transactions DESC, city_id LIMIT 10", "q4"),
    "rep_q4_city_kpis": _sql(
        'SELECT (SELECT "City" FROM q4 ORDER BY total_transactions DESC, city_id LIMIT 1) AS top_city, '
        "max(total_transactions) AS top_city_transactions, "
        "CAST(sum(total_transactions) AS BIGINT) AS all_transactions FROM q4",
        "q4",
    ),
    "rep_q4_global_clean": _sql(
        "SELECT * FROM q4_top WHERE merchant_id IS NOT NULL AND merchant_name IS NOT NULL "
        "ORDER BY global_rank LIMIT 50",
        "q4_top",
    ),
    "rep_q4_distribution_clean": _sql(
        'SELECT * FROM q4_distribution WHERE primary_city_id IS NOT NULL AND "City" IS NOT NULL', "q4_distribution"
    ),
    "rep_q4_local": _sql(
        'SELECT * FROM q4_popularity WHERE "City" = (SELECT min("City") FROM q4_popularity) '
        "ORDER BY transaction_count DESC, popularity_rank LIMIT 15",
        "q4_popularity",
    ),
    "rep_q5_kpis": _sql(
        """
SELECT c.detail_label AS best_city, c.total_amount AS best_city_revenue, c.avg_ticket AS best_city_avg_ticket,
       m.detail_label AS peak_month
FROM (SELECT * FROM advisory WHERE section = 'q5a_cities' ORDER BY total_amount DESC, detail_key LIMIT 1) c,
     (SELECT * FROM advisory WHERE section = 'q5c_months' ORDER BY total_amount DESC, detail_key LIMIT 1) m""",
        "advisory",
    ),
    "rep_q5_pareto": _sql(
        """
SELECT detail_key, detail_label, transaction_count, total_amount, avg_ticket,
       CAST(running AS DOUBLE) / CAST(whole AS DOUBLE) AS cum_share_revenue
FROM (SELECT *, sum(CAST(total_amount AS DECIMAL(38,10))) OVER (
                  ORDER BY total_amount DESC, CAST(detail_key AS INTEGER)
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running,
             sum(CAST(total_amount AS DECIMAL(38,10))) OVER () AS whole
      FROM advisory WHERE section = 'q5a_cities')
ORDER BY total_amount DESC, CAST(detail_key AS INTEGER) LIMIT 10""",
        "advisory",
    ),
    "rep_q5_categories": _sql(
        "SELECT detail_label, segment, transaction_count, total_amount, avg_ticket FROM advisory "
        "WHERE section = 'q5b_categories' ORDER BY total_amount DESC, detail_label LIMIT 4",
        "advisory",
    ),
    "rep_q5_peak_hours": _sql(
        """
SELECT (SELECT CAST(detail_key AS INTEGER) FROM advisory WHERE section = 'q5d_hours'
        ORDER BY transaction_count DESC, CAST(detail_key AS INTEGER) LIMIT 1) AS peak_hour_by_volume,
       (SELECT CAST(detail_key AS INTEGER) FROM advisory WHERE section = 'q5d_hours'
        ORDER BY total_amount DESC, CAST(detail_key AS INTEGER) LIMIT 1) AS peak_hour_by_revenue""",
        "advisory",
    ),
    "rep_q5_profit_gap": _sql(
        f"SELECT {_of(_WITH, 'expected_profit')} AS profit_with, {_of(_WITHOUT, 'expected_profit')} AS profit_without, "
        f"{_of(_WITH, 'expected_profit')} - {_of(_WITHOUT, 'expected_profit')} AS profit_gap "
        "FROM advisory WHERE section = 'q5_installments_impact'",
        "advisory",
    ),
    "rep_q5_city_focus": _sql(
        """
SELECT split_part(detail_key, '|', 1) AS city_id, detail_label, transaction_count, total_amount,
       expected_revenue, expected_profit
FROM advisory WHERE section = 'q5e_installments_by_city' AND split_part(detail_key, '|', 1) =
  (SELECT min(split_part(detail_key, '|', 1)) FROM advisory WHERE section = 'q5e_installments_by_city')""",
        "advisory",
    ),
    "rep_month_over_month": _sql(
        """
SELECT detail_key AS month, total_amount,
       (total_amount / NULLIF(lag(total_amount) OVER (ORDER BY detail_key), 0) - 1.0e0) * 100.0e0 AS change_pct
FROM advisory WHERE section = 'q5c_months' AND detail_key IS NOT NULL""",
        "advisory",
    ),
    "rep_pareto_cut": _sql(
        """
SELECT CAST(sum(total) FILTER (place <= 5) AS DOUBLE) / CAST(max(whole) AS DOUBLE) AS top_5_share,
       CAST(sum(total) FILTER (place <= 10) AS DOUBLE) / CAST(max(whole) AS DOUBLE) AS top_10_share,
       count(*) FILTER (CAST(upto - total AS DOUBLE) / CAST(whole AS DOUBLE) < 0.8e0) AS cities_for_share
FROM (SELECT total, row_number() OVER o AS place, sum(total) OVER o AS upto, sum(total) OVER () AS whole
      FROM (SELECT city_id, sum(CAST(amount AS DECIMAL(38,10))) AS total FROM silver
            WHERE city_id IS NOT NULL GROUP BY 1)
      WINDOW o AS (ORDER BY total DESC, city_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
        "silver",
    ),
    "rep_installment_gap": _sql(
        f"SELECT ({_of(_WITH, 'avg_ticket')} / {_of(_WITHOUT, 'avg_ticket')} - 1.0e0) * 100.0e0 AS ticket_uplift_pct, "
        f"({_of(_WITH, 'expected_profit')} / {_of(_WITH, 'total_amount')} - "
        f"{_of(_WITHOUT, 'expected_profit')} / {_of(_WITHOUT, 'total_amount')}) * 100.0e0 AS margin_gap_pp "
        "FROM advisory WHERE section = 'q5_installments_impact'",
        "advisory",
    ),
    "rep_city_profit_delta": _sql(
        """
SELECT CAST(segment AS INTEGER) AS city_id,
       coalesce(max(CASE WHEN split_part(detail_key, '|', 2) = 'with_installments' THEN expected_profit END), 0.0e0)
       - coalesce(max(CASE WHEN split_part(detail_key, '|', 2) = 'without_installments' THEN expected_profit END), 0.0e0)
         AS profit_delta
FROM advisory WHERE section = 'q5e_installments_by_city' GROUP BY 1""",
        "advisory",
    ),
}
