"""SQL twins of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Ledger tables over the order tables, as common table expressions.
# ---------------------------------------------------------------------------

_CTES = {
    "tx": """
        SELECT o_orderkey AS transaction_id,
               CAST(o_orderdate AS DATE) AS transaction_date,
               CAST(o_custkey % 97 AS INTEGER) AS account_id,
               CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS plan_id,
               CASE WHEN o_orderkey % 41 <> 0 THEN n_regionkey END AS category_id,
               CASE WHEN o_orderkey % 41 <> 0 AND o_orderkey % 7 <> 0 THEN n_nationkey END AS subcategory_id,
               (['income', 'transfer_out', 'transfer_in', 'credit_payment', 'loan_given', 'loan_received',
                 'loan_repayment_in', 'loan_repayment_out', 'credit_purchase', 'credit_purchase',
                 'credit_purchase', 'expense', 'expense', 'expense', 'expense', 'expense', 'expense',
                 'expense', 'expense', 'expense'])[o_orderkey % 20 + 1] AS transaction_type,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'extra' WHEN '2-HIGH' THEN 'extra'
                    WHEN '5-LOW' THEN NULL ELSE 'fixed' END AS spending_type,
               CAST(floor(o_totalprice) AS DECIMAL(15, 0)) AS amount,
               (['cash', 'bank_transfer', 'credit_card', 'momo', NULL])[o_orderkey % 5 + 1] AS payment_method,
               CASE WHEN o_orderkey % 13 <> 0 THEN 'note ' || CAST(o_orderkey % 1000 AS VARCHAR) END AS note,
               CASE WHEN o_orderkey % 100 = 3 THEN -o_orderkey
                    WHEN o_orderkey % 20 = 3 THEN o_orderkey - 3
                    WHEN o_orderkey % 20 IN (6, 7) THEN o_orderkey - 2 END AS related_transaction_id,
               o_orderstatus = 'P' AS is_regretted,
               CASE WHEN o_orderkey % 2 = 0 THEN 'python' ELSE 'nodejs' END AS source_data
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "accounts": """
        SELECT account_id, 'Account ' || CAST(account_id AS VARCHAR) AS account_name,
               (['credit', 'expense', 'savings'])[account_id % 3 + 1] AS account_type, 'VND' AS currency
        FROM (SELECT CAST(c_custkey % 97 AS INTEGER) AS account_id FROM customer UNION SELECT 1000)""",
    "categories": """
        SELECT r_regionkey AS category_id, r_name AS category_name, 'expense' AS category_type FROM region""",
    "subcategories": """
        SELECT n_nationkey AS subcategory_id, n_regionkey AS category_id, n_name AS subcategory_name FROM nation""",
    "months": """
        SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS plan_id FROM orders""",
    "plans": """
        SELECT plan_id, CAST(plan_id // 100 AS INTEGER) AS plan_year, CAST(plan_id % 100 AS INTEGER) AS plan_month,
               CAST(6000000 + (plan_id % 7) * 1250000 + CASE WHEN plan_id % 5 = 0 THEN 1 ELSE 0 END
                    AS BIGINT) AS fixed_budget,
               CAST(2000000 + (plan_id % 7) * 500000 AS BIGINT) AS savings_target,
               'plan ' || CAST(plan_id AS VARCHAR) AS note
        FROM months""",
    "items": """
        SELECT CAST(plan_id AS BIGINT) * 10 + r_regionkey AS item_id, plan_id, r_regionkey AS category_id,
               CAST(1000000 + (plan_id % 7) * 250000 + r_regionkey * 100000 AS BIGINT) AS budgeted
        FROM months, region""",
    "stg": """
        SELECT t.transaction_id AS id, t.transaction_date AS expense_date,
               CAST(year(t.transaction_date) AS INTEGER) AS yr, CAST(month(t.transaction_date) AS INTEGER) AS mo,
               t.amount, a.account_name, a.account_type, a.currency, t.transaction_type, t.spending_type,
               t.category_id, c.category_name, t.subcategory_id, s.subcategory_name, t.payment_method,
               t.note AS description, t.is_regretted, t.source_data AS source
        FROM tx t LEFT JOIN accounts a USING (account_id)
             LEFT JOIN categories c ON c.category_id = t.category_id
             LEFT JOIN subcategories s ON s.subcategory_id = t.subcategory_id
        WHERE t.transaction_date IS NOT NULL AND t.transaction_type IN ('credit_purchase', 'expense')""",
    "monthly": """
        SELECT yr, mo, count(id) AS transaction_count, CAST(sum(amount) AS BIGINT) AS total_spend,
               CAST(coalesce(sum(amount) FILTER (WHERE spending_type = 'fixed'), 0) AS BIGINT) AS fixed_spend,
               CAST(coalesce(sum(amount) FILTER (WHERE spending_type = 'extra'), 0) AS BIGINT) AS extra_spend,
               CAST(coalesce(sum(amount) FILTER (WHERE is_regretted), 0) AS BIGINT) AS regretted_spend,
               count(DISTINCT category_id) AS categories_used
        FROM stg GROUP BY yr, mo""",
    "breakdown": """
        SELECT g.*, round(total_spend * 100.0::DOUBLE / (sum(total_spend) OVER (PARTITION BY yr, mo))::DOUBLE, 2)
               AS pct_of_month
        FROM (SELECT yr, mo, category_id, category_name, subcategory_name, spending_type,
                     count(id) AS tx_count, CAST(sum(amount) AS BIGINT) AS total_spend
              FROM stg GROUP BY ALL) g""",
    "merchants": """
        SELECT g.*, CAST(1 + (SELECT count(*) FROM grouped h WHERE h.total_spend > g.total_spend) AS INTEGER)
               AS spend_rank
        FROM grouped g""",
    "grouped": """
        SELECT coalesce(subcategory_name, category_name) AS merchant, category_name, spending_type,
               count(id) AS visit_count, CAST(sum(amount) AS BIGINT) AS total_spend,
               min(expense_date) AS first_seen, max(expense_date) AS last_seen
        FROM stg GROUP BY ALL""",
}
for _name, _account, _note in (
    ("sheet", "account_text", "note_text"),
    (
        "resent",
        "CASE WHEN o_orderstatus = 'P' THEN 'Account 0' ELSE account_text END",
        "CASE WHEN o_orderstatus = 'F' THEN note_text || ' (revised)' ELSE note_text END",
    ),
):
    _CTES[_name] = f"""
        SELECT CASE WHEN k % 10 = 0 THEN 'n/a'
                    WHEN k % 10 = 1 THEN '  ' || CAST(d AS VARCHAR) || ' '
                    ELSE CAST(month(d) AS VARCHAR) || '/' || CAST(day(d) AS VARCHAR) || '/' || CAST(year(d) AS VARCHAR)
               END AS date,
               CASE WHEN k % 3 = 0 THEN upper({_account}) ELSE ' ' || {_account} END AS account,
               transaction_type, coalesce(spending_type, '') AS spending_type,
               coalesce(payment_method, '') AS type_payment,
               CASE WHEN k % 41 = 0 THEN '' ELSE lower(r_name) || '  ' END AS category,
               CASE WHEN k % 41 = 0 OR k % 7 = 0 THEN '' ELSE n_name END AS sub_category,
               CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '(' || price || ')' ELSE price END AS amount,
               {_note} || ' ' AS note,
               (['yes', ' TRUE', '1', 'no', ''])[k % 5 + 1] AS regret,
               '0' AS input, '0' AS "total  extra using", k AS row_idx
        FROM (SELECT tx.*, o.o_orderstatus, o.o_orderkey AS k, tx.transaction_date AS d, r_name, n_name,
                     'Account ' || CAST(account_id AS VARCHAR) AS account_text, coalesce(tx.note, '') AS note_text,
                     CAST(CAST(amount AS BIGINT) // 1000 AS VARCHAR) || ',' ||
                         lpad(CAST(CAST(amount AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS price
              FROM tx JOIN orders o ON o.o_orderkey = tx.transaction_id
                   JOIN customer ON o.o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                   JOIN region ON n_regionkey = r_regionkey)"""

for _name, _from in (("cleaned", "sheet"), ("cleaned_resent", "resent")):
    _CTES[_name] = f"""
        SELECT * EXCLUDE (number), number AS amount, number IS NULL AS needs_cleaning, 'python-api' AS source_data
        FROM (SELECT CAST(try_strptime(trim(date), ['%m/%d/%Y', '%Y-%m-%d']) AS DATE) AS date,
                     trim(account) AS account, transaction_type, spending_type, type_payment,
                     trim(category) AS category, trim(sub_category) AS sub_category,
                     TRY_CAST(regexp_replace(replace(amount, ',', ''), '\\((.*?)\\)', '-\\1', 'g') AS DOUBLE) AS number,
                     trim(note) AS note, trim(regret) AS regret, row_idx
              FROM {_from})
        WHERE date IS NOT NULL"""
for _name, _from in (("offered", "cleaned"), ("offered_resent", "cleaned_resent")):
    _CTES[_name] = f"""
        SELECT date AS transaction_date, CAST(trunc(amount) AS BIGINT) AS amount, transaction_type,
               nullif(spending_type, '') AS spending_type, nullif(type_payment, '') AS payment_method,
               nullif(note, '') AS note, lower(regret) IN ('true', '1', 'yes') AS is_regretted,
               account, category, sub_category, row_idx
        FROM {_from} WHERE NOT needs_cleaning"""
_CTES["fresh"] = """
        SELECT CAST(f.transaction_date AS DATE) AS transaction_date, a.account_id,
               CAST(p.plan_id AS INTEGER) AS plan_id, c.category_id, s.subcategory_id, f.transaction_type,
               f.spending_type, f.amount, f.payment_method, f.note, CAST(NULL AS BIGINT) AS related_transaction_id,
               f.is_regretted, 'python' AS source_data, f.row_idx
        FROM offered_resent f
             LEFT JOIN accounts a ON lower(a.account_name) = lower(f.account)
             LEFT JOIN categories c ON lower(c.category_name) = lower(f.category)
             LEFT JOIN subcategories s ON lower(s.subcategory_name) = lower(f.sub_category)
                                      AND s.category_id = c.category_id
             LEFT JOIN plans p ON p.plan_year = year(f.transaction_date) AND p.plan_month = month(f.transaction_date)
        WHERE NOT EXISTS (
            SELECT 1 FROM tx WHERE tx.transaction_date = f.transaction_date AND tx.amount = f.amount
               AND tx.transaction_type = f.transaction_type
               AND coalesce(tx.spending_type, '') = coalesce(f.spending_type, '')
               AND coalesce(tx.payment_method, '') = coalesce(f.payment_method, '')
               AND coalesce(tx.note, '') = coalesce(f.note, ''))"""
_CTES["plan_sheet"] = """
        SELECT CAST(plan_id // 100 + CASE WHEN v = 7 THEN 7 ELSE 0 END AS INTEGER) AS plan_year,
               CAST(plan_id % 100 AS INTEGER) AS plan_month,
               CAST((2000 + plan_id % 11 + v) * 1000 AS BIGINT) AS fixed_budget,
               CAST(CASE WHEN v = 1 THEN 0 ELSE 750000 END AS BIGINT) AS savings_target,
               CASE WHEN v > 0 THEN 'v' || CAST(v AS VARCHAR) END AS note
        FROM months, (VALUES (1), (7)) AS t(v)"""
_CTES["item_sheet"] = """
        SELECT plan_id // 100 + CASE WHEN plan_id % 100 = 12 AND r_regionkey = 0 THEN 50 ELSE 0 END AS yr,
               CASE WHEN NOT (plan_id % 100 = 11 AND r_regionkey = 1) THEN plan_id % 100 END AS mo,
               CASE WHEN plan_id % 100 = 10 AND r_regionkey = 2 THEN 'Nowhere' ELSE r_name END AS category_name,
               CAST((900 + plan_id % 13 + r_regionkey) * 1000 + 500 AS BIGINT) AS budgeted,
               CAST(plan_id AS BIGINT) * 10 + r_regionkey AS row_idx
        FROM months, region"""
_CTES["item_found"] = """
        SELECT i.*, p.plan_id, c.category_id
        FROM item_sheet i LEFT JOIN plans p ON p.plan_year = i.yr AND p.plan_month = i.mo
             LEFT JOIN categories c USING (category_name)"""
_CTES["rolling"] = """
    SELECT id, expense_date, category_id, amount::BIGINT AS amount,
           CAST(isodow(expense_date) - 1 AS INTEGER) AS day_of_week, n AS window_count,
           round(mean, 4) AS rolling_mean,
           CASE WHEN std > 0 THEN round((amount::DOUBLE - mean) / std, 6) END AS rolling_z,
           coalesce(abs(CASE WHEN std > 0 THEN round((amount::DOUBLE - mean) / std, 6) END) > 3, false) AS is_anomaly
    FROM (SELECT *, count(*) OVER w AS n, sum(amount) OVER w::DOUBLE / count(*) OVER w AS mean,
                 stddev_pop(amount::DOUBLE) OVER w AS std
          FROM stg WINDOW w AS (PARTITION BY coalesce(category_id, -1) ORDER BY expense_date
                                RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))"""
_CTES["month_sums"] = """
    SELECT kind, series, yr * 12 + mo - 1 AS t, CAST(sum(amount) AS DOUBLE) AS y FROM (
        SELECT 'category' AS kind, category_name AS series, yr, mo, amount FROM stg WHERE category_name IS NOT NULL
        UNION ALL SELECT 'total', 'all', yr, mo, amount FROM stg) GROUP BY ALL"""
_CTES["series"] = """
    SELECT kind, series, t, t % 12 + 1 AS mo, coalesce(y, 0) AS y
    FROM (SELECT kind, series, unnest(generate_series(min(t), (SELECT max(t) FROM month_sums))) AS t
          FROM month_sums GROUP BY kind, series) LEFT JOIN month_sums USING (kind, series, t)"""
_CTES["training"] = """
    SELECT * FROM series q WHERE t <= (SELECT max(t) FROM series m WHERE m.kind = q.kind AND m.series = q.series) - 3"""
for _name, _from in (("fit", "series"), ("fit_training", "training")):
    _CTES[_name] = f"""
        SELECT kind, series, regr_slope(y, t) AS slope, regr_intercept(y, t) AS intercept, max(t) AS last_t,
               max_by(y, t) AS last_y
        FROM {_from} GROUP BY kind, series"""
    _CTES[f"{_name}_season"] = f"""
        SELECT kind, series, mo, avg(y - (intercept + slope * t)) AS effect
        FROM {_from} JOIN {_name} USING (kind, series) GROUP BY ALL"""

# The forest: 100 trees of 8 levels, about 256 rows each, drawn by remainders.
_PRIME = 2147483647
_FOREST = 100


def _draw(key: str, tree: str) -> str:
    line = f"(({key}) % {_PRIME} * ((48271 * ({tree} + 1) + 16807) % {_PRIME}) + (69621 * ({tree} + 7)) % {_PRIME}) % {_PRIME}"
    return f"(({line}) * ({line}) % {_PRIME} * 39373 + ({line})) % {_PRIME}"


_SIDE = "([amount, day_of_week, category, rolling_z])[feature + 1] > cut"
_CTES["features"] = """
    SELECT id, expense_date, category_id, amount AS whole, amount::DOUBLE AS amount, day_of_week::DOUBLE AS day_of_week,
           coalesce(category_id, -1)::DOUBLE AS category, coalesce(rolling_z, 0)::DOUBLE AS rolling_z
    FROM rolling"""
_CTES["points0"] = f"""
    SELECT tree, 0 AS node, amount, day_of_week, category, rolling_z
    FROM features, generate_series(0, {_FOREST - 1}) t(tree)
    WHERE {_draw("id", "tree")} < (
        SELECT least({_PRIME}, ({_PRIME} * 256::BIGINT + count(*) - 1) // count(*)) FROM features)"""
for _level in range(9):
    _CTES[f"nodes{_level}"] = f"""
    SELECT tree, node, n, CASE WHEN len(choices) > 0 THEN choices[{_draw("2 * node + 1", "tree")} % len(choices) + 1]
                          ELSE -1 END AS feature,
           CASE WHEN len(choices) > 0 THEN lows[choices[{_draw("2 * node + 1", "tree")} % len(choices) + 1] + 1]
                + spans[choices[{_draw("2 * node + 1", "tree")} % len(choices) + 1] + 1]
                  * (({_draw("2 * node + 2", "tree")})::DOUBLE / {_PRIME}::DOUBLE) END AS cut
    FROM (SELECT *, CASE WHEN {_level} >= 8 OR n <= 1 THEN CAST([] AS INTEGER[])
                    ELSE list_filter([0, 1, 2, 3], lambda f: spans[f + 1] > 0) END AS choices
          FROM (SELECT tree, node, count(*) AS n,
                       [min(amount), min(day_of_week), min(category), min(rolling_z)] AS lows,
                       [max(amount) - min(amount), max(day_of_week) - min(day_of_week),
                        max(category) - min(category), max(rolling_z) - min(rolling_z)] AS spans
                FROM points{_level} GROUP BY tree, node))"""
    _CTES[f"points{_level + 1}"] = f"""
    SELECT p.tree, 2 * p.node + 1 + CAST({_SIDE} AS INTEGER) AS node, amount, day_of_week, category, rolling_z
    FROM points{_level} p JOIN nodes{_level} n ON n.tree = p.tree AND n.node = p.node WHERE feature >= 0"""
    # A row's place, and the depth at which its way ended.
    _start = (
        f"(SELECT *, tree, 0 AS node FROM features, generate_series(0, {_FOREST - 1}) t(tree))"
        if _level == 0
        else f"walk{_level - 1}"
    )
    _CTES[f"walk{_level}"] = f"""
    SELECT w.* EXCLUDE (node, depth), CASE WHEN feature >= 0 THEN 2 * w.node + 1 + CAST({_SIDE} AS INTEGER) END AS node,
           coalesce(depth, CASE WHEN feature < 0 THEN {_level} + CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1
               ELSE 2 * (ln(n - 1.0::DOUBLE) + 0.5772156649015329) - 2 * (n - 1.0::DOUBLE) / n END END) AS depth
    FROM {"(SELECT *, NULL::DOUBLE AS depth FROM " + _start + ")" if _level == 0 else _start} w
         LEFT JOIN nodes{_level} n ON n.tree = w.tree AND n.node = w.node"""
_CTES["scored"] = f"""
    SELECT id, expense_date, category_id, whole,
           round(power(2.0::DOUBLE, -sum(coalesce(depth, 0)) / {_FOREST}
                       / (2 * (ln(255::DOUBLE) + 0.5772156649015329) - 2 * 255::DOUBLE / 256)), 9) AS score
    FROM walk8 GROUP BY ALL"""

_NEEDS = {
    "scored": ["walk8"],
    "sheet": ["tx"],
    "resent": ["tx"],
    "cleaned": ["sheet"],
    "cleaned_resent": ["resent"],
    "offered": ["cleaned"],
    "offered_resent": ["cleaned_resent"],
    "fresh": ["offered_resent", "tx", "accounts", "categories", "subcategories", "plans"],
    "plan_sheet": ["months"],
    "item_sheet": ["months"],
    "item_found": ["item_sheet", "plans", "categories"],
    "rolling": ["stg"],
    "features": ["rolling"],
    "points0": ["features"],
    **{f"nodes{i}": [f"points{i}"] for i in range(9)},
    **{f"points{i + 1}": [f"nodes{i}"] for i in range(9)},
    **{f"walk{i}": [f"nodes{i}", *([f"walk{i - 1}"] if i else [])] for i in range(9)},
    "month_sums": ["stg"],
    "series": ["month_sums"],
    "training": ["series"],
    "fit": ["series"],
    "fit_season": ["fit"],
    "fit_training": ["training"],
    "fit_training_season": ["fit_training"],
    "plans": ["months"],
    "items": ["months"],
    "stg": ["tx", "accounts", "categories", "subcategories"],
    "monthly": ["stg"],
    "breakdown": ["stg"],
    "grouped": ["stg"],
    "merchants": ["grouped"],
}


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        _ordered(_NEEDS.get(name, []), done)
        if name not in done:
            done.append(name)
    return done


def _sql(body: str, *ctes: str) -> str:
    parts = [f"{name} AS ({_CTES[name]})" for name in _ordered(list(ctes), [])]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# Report range, as given to the queries: March 1996 to October 2000.
RANGE = "yr * 12 + mo BETWEEN 1996 * 12 + 3 AND 2000 * 12 + 10"
LABEL = "strftime(make_date(yr, mo, 1), '%b %Y')"

LEDGER = {
    "stg_expenses": _sql("SELECT * REPLACE (CAST(amount AS BIGINT) AS amount) FROM stg", "stg"),
    "mart_monthly_summary": _sql("SELECT * FROM monthly", "monthly"),
    "mart_category_breakdown": _sql("SELECT * FROM breakdown", "breakdown"),
    "mart_top_merchants": _sql("SELECT * FROM merchants", "merchants"),
    "account_cash_balance": _sql(
        """
        SELECT a.account_id, a.account_name, a.account_type, CAST(coalesce((
                   SELECT sum(CASE transaction_type
                                WHEN 'income' THEN amount WHEN 'transfer_in' THEN amount
                                WHEN 'loan_received' THEN amount WHEN 'loan_repayment_in' THEN amount
                                WHEN 'credit_purchase' THEN 0 ELSE -amount END)
                   FROM tx WHERE tx.account_id = a.account_id), 0) AS BIGINT) AS cash_balance
        FROM accounts a""",
        "tx",
        "accounts",
    ),
    "monthly_expense_summary": _sql(
        """
        SELECT yr, mo, s.category_name, c.category_type, subcategory_name, spending_type,
               count(*) AS tx_count, CAST(sum(amount) AS BIGINT) AS total_amount
        FROM stg s LEFT JOIN categories c ON c.category_id = s.category_id GROUP BY ALL""",
        "stg",
    ),
    "credit_outstanding": _sql(
        """
        SELECT account_id, account_name, total_purchased, total_paid, total_purchased - total_paid AS outstanding
        FROM (SELECT a.account_id, a.account_name,
                     CAST(coalesce(sum(amount) FILTER (WHERE transaction_type = 'credit_purchase'), 0) AS BIGINT)
                         AS total_purchased,
                     CAST(coalesce(sum(amount) FILTER (WHERE transaction_type = 'credit_payment'), 0) AS BIGINT)
                         AS total_paid
              FROM accounts a LEFT JOIN tx ON tx.account_id = a.account_id
              WHERE a.account_type = 'credit' GROUP BY ALL)""",
        "tx",
        "accounts",
    ),
    "budget_vs_actual": _sql(
        """
        SELECT plan_year AS yr, plan_month AS mo, category_name, budgeted, actual_spent,
               budgeted - actual_spent AS remaining
        FROM (SELECT p.plan_year, p.plan_month, c.category_name, i.budgeted,
                     CAST(coalesce(sum(t.amount), 0) AS BIGINT) AS actual_spent
              FROM items i JOIN plans p USING (plan_id) JOIN categories c USING (category_id)
                   LEFT JOIN (SELECT * FROM tx WHERE transaction_type IN ('credit_purchase', 'expense')) t
                          ON t.plan_id = i.plan_id AND t.category_id = i.category_id
              GROUP BY ALL)""",
        "tx",
        "items",
        "plans",
        "categories",
    ),
    "kpi_latest_month": _sql(
        """
        SELECT yr, mo, total_spend, transaction_count FROM monthly
        WHERE yr * 12 + mo = (SELECT max(yr * 12 + mo) FROM monthly)""",
        "monthly",
    ),
    "kpi_top_category": _sql(
        """
        SELECT category_name, total_spend FROM breakdown
        ORDER BY yr DESC, mo DESC, total_spend DESC, category_name NULLS FIRST LIMIT 1""",
        "breakdown",
    ),
    "kpi_latest_date": _sql("SELECT max(last_seen) AS latest FROM grouped", "grouped"),
    "overview_monthly": _sql(
        f"""
        SELECT yr, mo, total_spend, fixed_spend, extra_spend, transaction_count, {LABEL} AS month_label,
               make_date(yr, mo, 1) AS month_date,
               CAST((SELECT sum(e.total_spend) FROM monthly e
                     WHERE e.yr * 12 + e.mo BETWEEN 1996 * 12 + 3 AND m.yr * 12 + m.mo) AS BIGINT) AS cumulative_spend
        FROM monthly m WHERE {RANGE}""",
        "monthly",
    ),
    "overview_table": _sql(
        f"""
        SELECT {LABEL} AS "Month", format('{{:,}}', total_spend) AS "Total", format('{{:,}}', fixed_spend) AS "Fixed",
               format('{{:,}}', extra_spend) AS "Extra", transaction_count AS "Transactions"
        FROM monthly WHERE {RANGE}""",
        "monthly",
    ),
    "category_detail": _sql(
        f"""
        SELECT yr, mo, category_name, spending_type, tx_count, total_spend, pct_of_month, {LABEL} AS month_label
        FROM breakdown WHERE {RANGE}""",
        "breakdown",
    ),
    "category_totals": _sql(
        f"""
        SELECT category_name, total_spend,
               round(total_spend::DOUBLE / (sum(total_spend) OVER ())::DOUBLE, 6) AS share
        FROM (SELECT category_name, CAST(sum(amount) AS BIGINT) AS total_spend
              FROM stg WHERE {RANGE} AND category_name IS NOT NULL GROUP BY category_name)""",
        "stg",
    ),
    "category_mom": _sql(
        f"""
        SELECT {LABEL} AS month_label, yr, mo, category_name, CAST(sum(amount) AS BIGINT) AS total_spend
        FROM stg WHERE {RANGE} AND category_name IS NOT NULL GROUP BY yr, mo, category_name""",
        "stg",
    ),
    "month_order": _sql(f"SELECT DISTINCT yr, mo, {LABEL} AS month_label FROM stg WHERE {RANGE}", "stg"),
    "merchants_top_n": _sql(
        """
        SELECT * FROM grouped
        WHERE last_seen BETWEEN DATE '1996-03-01' AND DATE '2001-12-31' AND category_name IN ('AFRICA', 'ASIA', 'EUROPE')
        ORDER BY total_spend DESC, merchant, category_name, spending_type NULLS FIRST LIMIT 10""",
        "grouped",
    ),
    "merchant_categories": _sql(
        """
        SELECT DISTINCT category_name FROM grouped
        WHERE last_seen BETWEEN DATE '1996-03-01' AND DATE '2001-12-31' AND category_name IS NOT NULL""",
        "grouped",
    ),
    "trend_rolling": _sql(
        f"""
        SELECT m.yr, m.mo, m.total_spend, m.transaction_count, make_date(m.yr, m.mo, 1) AS month_date,
               strftime(make_date(m.yr, m.mo, 1), '%b %Y') AS month_label,
               round(avg(e.total_spend::DOUBLE), 4) AS rolling_3mo, CAST(m.yr AS VARCHAR) AS yr_str
        FROM (SELECT *, row_number() OVER (ORDER BY yr, mo) AS i FROM monthly WHERE {RANGE}) m
        JOIN (SELECT *, row_number() OVER (ORDER BY yr, mo) AS i FROM monthly WHERE {RANGE}) e
          ON e.i BETWEEN m.i - 2 AND m.i
        GROUP BY m.yr, m.mo, m.total_spend, m.transaction_count""",
        "monthly",
    ),
    "yoy_comparison": _sql(
        "SELECT mo, "
        + ", ".join(
            f"CAST(sum(total_spend) FILTER (WHERE yr = {y}) AS BIGINT) AS y{y}" for y in range(1996, 2001)
        )
        + f" FROM monthly WHERE {RANGE} GROUP BY mo",
        "monthly",
    ),
    "spend_heatmap": _sql(
        "SELECT yr, "
        + ", ".join(
            f'CAST(sum(total_spend) FILTER (WHERE mo = {i}) AS BIGINT) AS "{name}"'
            for i, name in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split(), 1)
        )
        + f" FROM monthly WHERE {RANGE} GROUP BY yr",
        "monthly",
    ),
}

_NUMBER_NODE = "TRY_CAST(nullif(regexp_replace(amount, '[^0-9.-]', '', 'g'), '') AS DOUBLE)"
_KEY_COLUMNS = "date, account, transaction_type, amount, type_payment, category, sub_category"

INGEST = {
    "clean_expenses": _sql("SELECT * FROM cleaned", "cleaned"),
    "clean_expenses_node": _sql(
        f"""
        SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS date, trim(account) AS account, transaction_type, spending_type,
               type_payment, trim(category) AS category, trim(sub_category) AS sub_category,
               CASE WHEN amount LIKE '(%)' THEN -number ELSE number END AS amount, trim(note) AS note,
               trim(regret) AS regret, 'nodejs' AS source_data, row_idx
        FROM (SELECT *, try_strptime(trim(date), ['%m/%d/%Y', '%Y-%m-%d']) AS day, {_NUMBER_NODE} AS number FROM sheet)
        WHERE day IS NOT NULL AND (amount = '' OR number IS NOT NULL)""",
        "sheet",
    ),
    "sheet_round_trip": _sql("SELECT * FROM sheet", "sheet"),
    "stage_append": _sql(
        f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY {_KEY_COLUMNS} ORDER BY batch_id DESC, row_idx DESC) AS place
            FROM (SELECT *, CAST(1 AS BIGINT) AS batch_id FROM sheet
                  UNION ALL SELECT *, CAST(2 AS BIGINT) FROM resent))
        WHERE place = 1""",
        "sheet",
        "resent",
    ),
    "first_in_batch": _sql(
        """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY transaction_date, amount, transaction_type, coalesce(spending_type, ''),
                                    coalesce(payment_method, ''), coalesce(note, '')
                       ORDER BY batch_id, row_idx) AS place
            FROM (SELECT *, CAST(1 AS BIGINT) AS batch_id FROM offered
                  UNION ALL SELECT *, CAST(2 AS BIGINT) FROM offered_resent))
        WHERE place = 1""",
        "offered",
        "offered_resent",
    ),
    "load_transactions": _sql("SELECT * EXCLUDE (row_idx) FROM fresh WHERE amount > 0", "fresh"),
    "rejected_transactions": _sql(
        "SELECT row_idx, amount, 'amount' AS reject_reason FROM fresh WHERE amount <= 0", "fresh"
    ),
    "surrogate_keys": _sql(
        """
        SELECT (SELECT max(transaction_id) FROM tx) + row_number() OVER (
                   ORDER BY transaction_date, amount, transaction_type, spending_type NULLS FIRST,
                            payment_method NULLS FIRST, note NULLS FIRST) AS transaction_id,
               transaction_date, amount, note
        FROM fresh WHERE amount > 0""",
        "fresh",
    ),
    "unresolved_names": _sql(
        """
        SELECT 'category' AS kind, lower(category_name) AS name, count(*) AS row_count
        FROM item_found WHERE category_id IS NULL GROUP BY ALL""",
        "item_found",
    ),
    "upsert_plans": _sql(
        """
        SELECT CAST(coalesce(p.plan_id, (SELECT max(plan_id) FROM plans) + row_number() OVER (
                   PARTITION BY p.plan_id IS NULL ORDER BY plan_year, plan_month)) AS INTEGER) AS plan_id,
               plan_year, plan_month, coalesce(s.fixed_budget, p.fixed_budget) AS fixed_budget,
               coalesce(s.savings_target, p.savings_target) AS savings_target,
               CASE WHEN s.plan_year IS NULL THEN p.note ELSE s.note END AS note
        FROM plans p FULL JOIN plan_sheet s USING (plan_year, plan_month)""",
        "plans",
        "plan_sheet",
    ),
    "upsert_plan_items": _sql(
        """
        SELECT i.item_id, i.plan_id, i.category_id, coalesce(f.budgeted, i.budgeted) AS budgeted,
               CAST(NULL AS VARCHAR) AS note
        FROM items i LEFT JOIN item_found f ON f.plan_id = i.plan_id AND f.category_id = i.category_id""",
        "items",
        "item_found",
    ),
    "skipped_plan_items": _sql(
        "SELECT row_idx, plan_id, category_id FROM item_found WHERE plan_id IS NULL OR category_id IS NULL",
        "item_found",
    ),
}
_LOADED = _sql(
    """
    SELECT CAST(f.transaction_date AS DATE) AS transaction_date, a.account_id, CAST(p.plan_id AS INTEGER) AS plan_id,
           c.category_id, s.subcategory_id, f.transaction_type, f.spending_type, f.amount, f.payment_method, f.note,
           f.is_regretted, 'python' AS source_data
    FROM (SELECT * FROM offered UNION ALL SELECT * FROM offered_resent WHERE note LIKE '%(revised)') f
         LEFT JOIN accounts a ON lower(a.account_name) = lower(f.account)
         LEFT JOIN categories c ON lower(c.category_name) = lower(f.category)
         LEFT JOIN subcategories s ON lower(s.subcategory_name) = lower(f.sub_category)
                                  AND s.category_id = c.category_id
         LEFT JOIN (SELECT plan_year, plan_month, row_number() OVER (ORDER BY plan_year, plan_month) AS plan_id
                    FROM (SELECT DISTINCT plan_year, plan_month FROM plan_sheet)) p
           ON p.plan_year = year(f.transaction_date) AND p.plan_month = month(f.transaction_date)
    WHERE f.amount > 0""",
    "offered",
    "offered_resent",
    "accounts",
    "categories",
    "subcategories",
    "plan_sheet",
)
INGEST["source_run"] = _LOADED
INGEST["incremental_load"] = _LOADED
INGEST["stateful_load"] = _LOADED
# Rows that take part: dated, readable, each natural key once; a sheet without rows is an error.
_EXPENSES_RUN = """
    SELECT {run} AS run, 'expenses' AS source, 'ok' AS status, (SELECT count(*) FROM {sheet}) AS rows_in_sheet,
           count(*) AS rows_attempted, count(*) FILTER (WHERE amount > 0) AS rows_loaded,
           count(*) FILTER (WHERE amount <= 0) AS rows_rejected FROM ({rows})"""
INGEST["source_status"] = _sql(
    _EXPENSES_RUN.format(run=1, sheet="sheet", rows="SELECT * FROM offered")
    + " UNION ALL "
    + _EXPENSES_RUN.format(
        run=2,
        sheet="resent",
        rows="""SELECT r.* FROM offered_resent r WHERE NOT EXISTS (
            SELECT 1 FROM offered o WHERE o.amount > 0 AND o.transaction_date = r.transaction_date
            AND o.amount = r.amount AND o.transaction_type IS NOT DISTINCT FROM r.transaction_type
            AND o.spending_type IS NOT DISTINCT FROM r.spending_type
            AND o.payment_method IS NOT DISTINCT FROM r.payment_method AND o.note IS NOT DISTINCT FROM r.note)""",
    )
    + """
    UNION ALL SELECT 1, 'plans', 'ok', 3 * count(*), 3 * count(*), 3 * count(*), 0 FROM months
    UNION ALL SELECT 2, 'plans', 'error', NULL, NULL, NULL, NULL
    UNION ALL SELECT run, 'plan_items', 'ok', count(*), count(*), count(*) FILTER (WHERE found), count(*) FILTER (WHERE NOT found)
        FROM (SELECT i.*, run, c.category_id IS NOT NULL AND p.plan_year IS NOT NULL AS found
              FROM item_sheet i CROSS JOIN (VALUES (1), (2)) t(run) LEFT JOIN categories c USING (category_name)
                   LEFT JOIN (SELECT DISTINCT plan_year, plan_month FROM plan_sheet) p
                     ON p.plan_year = i.yr AND p.plan_month = i.mo)
        GROUP BY run""",
    "sheet",
    "resent",
    "offered",
    "offered_resent",
    "plan_sheet",
    "item_sheet",
    "categories",
)
INGEST["dirty_sheet"] = _sql(
    """
    SELECT date, account, CASE WHEN short THEN '' ELSE spending_type END AS spending_type,
           transaction_type, CASE WHEN short THEN '' ELSE type_payment END AS type_payment,
           CASE WHEN short THEN '' ELSE category END AS category,
           CASE WHEN short THEN '' ELSE sub_category END AS sub_category,
           CASE WHEN NOT short THEN amount END AS amount, CASE WHEN short THEN '' ELSE note END AS note,
           CASE WHEN short THEN '' ELSE regret END AS regret, short OR needs_cleaning AS needs_cleaning, source_data
    FROM (SELECT *, row_idx % 19 = 0 AS short FROM cleaned WHERE row_idx % 17 <> 0)""",
    "cleaned",
)


def _checks() -> str:
    tx_key = "transaction_date, account_id, transaction_type, spending_type, amount, payment_method, left(note, 200)"

    def nulls(model: str, table: str, *columns: str) -> list[str]:
        return [
            f"SELECT 'not_null:{model}.{c}' AS check_name, count(*) AS failed FROM {table} WHERE {c} IS NULL"
            for c in columns
        ]

    def outside(model: str, table: str, column: str, *values: str) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"SELECT 'accepted:{model}.{column}', count(*) FROM {table} WHERE {column} NOT IN ({listed})"

    def orphans(model: str, table: str, column: str, parent: str, key: str | None = None) -> str:
        return (
            f"SELECT 'relationship:{model}.{column}', count(*) FROM {table} x WHERE x.{column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{key or column} = x.{column})"
        )

    def repeated(check: str, table: str, keys: str, where: str = "true") -> str:
        return (
            f"SELECT 'unique:{check}', count(*) FROM "
            f"(SELECT 1 FROM {table} WHERE {where} GROUP BY {keys} HAVING count(*) > 1)"
        )

    parts = [
        *nulls("stg_expenses", "stg", "id", "expense_date", "amount", "category_id"),
        *nulls("mart_monthly_summary", "monthly", "yr", "mo", "total_spend"),
        *nulls("mart_category_breakdown", "breakdown", "yr", "category_name", "total_spend"),
        *nulls("mart_top_merchants", "grouped", "merchant", "total_spend"),
        outside(
            "transactions",
            "tx",
            "transaction_type",
            *"income expense transfer_out transfer_in credit_purchase credit_payment".split(),
            *"loan_given loan_received loan_repayment_in loan_repayment_out".split(),
        ),
        outside("transactions", "tx", "spending_type", "fixed", "extra"),
        outside("transactions", "tx", "payment_method", "cash", "bank_transfer", "credit_card", "momo"),
        outside("transactions", "tx", "source_data", "nodejs", "python"),
        outside("accounts", "accounts", "account_type", "savings", "expense", "credit"),
        outside("categories", "categories", "category_type", "expense", "income", "transfer", "debt"),
        "SELECT 'expression:transactions.amount_positive', count(*) FROM tx WHERE amount <= 0",
        "SELECT 'expression:monthly_plans.plan_month', count(*) FROM plans WHERE plan_month NOT BETWEEN 1 AND 12",
        orphans("transactions", "tx", "account_id", "accounts"),
        orphans("transactions", "tx", "plan_id", "plans"),
        orphans("transactions", "tx", "category_id", "categories"),
        orphans("transactions", "tx", "subcategory_id", "subcategories"),
        orphans("transactions", "tx", "related_transaction_id", "tx", "transaction_id"),
        orphans("monthly_plan_items", "items", "plan_id", "plans"),
        orphans("monthly_plan_items", "items", "category_id", "categories"),
        orphans("subcategories", "subcategories", "category_id", "categories"),
        "SELECT 'note_required:transactions.note', count(*) FROM tx JOIN categories USING (category_id) "
        "WHERE category_name = 'AFRICA' AND coalesce(trim(note), '') = ''",
        repeated("stg_expenses.id", "stg", "id"),
        repeated("categories.category_name", "categories", "category_name"),
        repeated("subcategories.category_id_name", "subcategories", "category_id, subcategory_name"),
        repeated("monthly_plans.year_month", "plans", "plan_year, plan_month"),
        repeated("monthly_plan_items.plan_category", "items", "plan_id, category_id"),
        repeated(
            "transactions.key",
            "tx",
            tx_key,
            "spending_type IS NOT NULL AND payment_method IS NOT NULL AND note IS NOT NULL",
        ),
        "SELECT 'consistent:monthly_plans.fixed_budget', count(*) FROM plans p WHERE p.fixed_budget <> "
        "(SELECT sum(budgeted) FROM items i WHERE i.plan_id = p.plan_id)",
    ]
    return " UNION ALL ".join(parts)


QUALITY = {
    "dq_report": _sql(
        _checks(),
        *"stg monthly breakdown grouped tx accounts categories subcategories items plans".split(),
    ),
    "dangling_links": _sql(
        """
        SELECT related_transaction_id AS linked_id, count(*) AS n FROM tx
        WHERE related_transaction_id NOT IN (SELECT transaction_id FROM tx) GROUP BY ALL""",
        "tx",
    ),
    "plan_budget_gaps": _sql(
        """
        SELECT p.plan_id, plan_year, plan_month, fixed_budget, CAST(sum(budgeted) AS BIGINT) AS items_total
        FROM plans p JOIN items i USING (plan_id) GROUP BY ALL HAVING sum(budgeted) <> fixed_budget""",
        "plans",
        "items",
    ),
}

def _scored(mean: str, std: str) -> str:
    return f"CASE WHEN {std} > 0 THEN round((CAST(amount AS DOUBLE) - {mean}) / {std}, 6) END"


SCIENCE = {
    "spend_profile": _sql(
        """
        SELECT s.category_id, s.category_name, count(*) AS tx_count,
               count(*) - count(spending_type) AS missing_spending_type,
               count(*) - count(payment_method) AS missing_payment_method,
               count(*) - count(description) AS missing_description,
               round(avg(amount::DOUBLE), 4) AS mean_amount, round(stddev_pop(amount::DOUBLE), 4) AS std_amount,
               min(amount)::BIGINT AS min_amount, any_value(q1) AS q1_amount, any_value(q2) AS median_amount,
               any_value(q3) AS q3_amount, max(amount)::BIGINT AS max_amount,
               count(*) FILTER (WHERE amount < q1 - 1.5 * (q3 - q1) OR amount > q3 + 1.5 * (q3 - q1)) AS outliers
        FROM stg s JOIN (SELECT coalesce(category_id, -1) AS key, quantile_cont(amount::DOUBLE, 0.25) AS q1,
                                quantile_cont(amount::DOUBLE, 0.5) AS q2, quantile_cont(amount::DOUBLE, 0.75) AS q3
                         FROM stg GROUP BY ALL) q ON q.key = coalesce(s.category_id, -1)
        GROUP BY s.category_id, s.category_name""",
        "stg",
    ),
    "anomaly_zscore": _sql(
        f"""
        SELECT id, expense_date, category_id, amount::BIGINT AS amount, z_score,
               coalesce(abs(z_score) > 3, false) AS is_anomaly
        FROM (SELECT stg.*, {_scored("mean", "std")} AS z_score
              FROM stg, (SELECT sum(amount)::DOUBLE / count(*) AS mean, stddev_pop(amount::DOUBLE) AS std FROM stg))""",
        "stg",
    ),
    "anomaly_category_zscore": _sql(
        f"""
        SELECT id, expense_date, category_id, amount::BIGINT AS amount, z_score,
               coalesce(abs(z_score) > 3, false) AS is_anomaly
        FROM (SELECT stg.*, {_scored("mean", "std")} AS z_score
              FROM stg JOIN (SELECT coalesce(category_id, -1) AS key, sum(amount)::DOUBLE / count(*) AS mean,
                                    stddev_pop(amount::DOUBLE) AS std FROM stg GROUP BY ALL)
                ON key = coalesce(category_id, -1))""",
        "stg",
    ),
    "anomaly_rolling_z": _sql("SELECT * FROM rolling", "rolling"),
    "anomaly_iforest": _sql(
        f"""
        SELECT id, expense_date, category_id, whole AS amount, score,
               CASE WHEN score > (SELECT quantile_cont(score, 0.95) FROM scored) THEN -1 ELSE 1 END AS anomaly_iforest
        FROM scored""",
        "scored",
    ),
    "spend_forecast": _sql(
        """
        SELECT kind, series, CAST(t // 12 AS INTEGER) AS yr, CAST(t % 12 + 1 AS INTEGER) AS mo, step,
               CAST(round(forecast) AS BIGINT) AS forecast, CAST(round(forecast - 1.96 * sigma) AS BIGINT) AS lower,
               CAST(round(forecast + 1.96 * sigma) AS BIGINT) AS upper
        FROM (SELECT f.kind, f.series, f.last_t + step AS t, CAST(step AS INTEGER) AS step, sigma,
                     intercept + slope * (f.last_t + step) + coalesce(effect, 0) AS forecast
              FROM fit f CROSS JOIN generate_series(1, 3) AS g(step)
                   JOIN (SELECT kind, series, stddev_pop(y - (intercept + slope * t) - effect) AS sigma
                         FROM series JOIN fit USING (kind, series) JOIN fit_season USING (kind, series, mo)
                         GROUP BY kind, series) USING (kind, series)
                   LEFT JOIN fit_season e ON e.kind = f.kind AND e.series = f.series
                                         AND e.mo = (f.last_t + step) % 12 + 1)""",
        "fit_season",
    ),
    "forecast_backtest": _sql(
        """
        SELECT s.kind, s.series, count(*) AS months,
               CAST(round(sqrt(avg(power(y - (intercept + slope * t + coalesce(effect, 0)), 2)))) AS BIGINT)
                   AS rmse_model,
               CAST(round(sqrt(avg(power(y - last_y, 2)))) AS BIGINT) AS rmse_last
        FROM series s JOIN fit_training f USING (kind, series)
             LEFT JOIN fit_training_season e ON e.kind = s.kind AND e.series = s.series AND e.mo = s.mo
        WHERE t > (SELECT max(m.t) FROM series m WHERE m.kind = s.kind AND m.series = s.series) - 3
        GROUP BY s.kind, s.series""",
        "fit_training_season",
    ),
}

INGEST["landed_once"] = _sql(
    """
    SELECT run, 'ok' AS status, count(*) FILTER (WHERE row_idx % 3 = run - 1) AS rows_in_sheet,
           count(*) FILTER (WHERE row_idx % 3 < run) AS raw_rows
    FROM sheet, (VALUES (1), (2), (3)) t(run) GROUP BY run
    UNION ALL SELECT 4, 'unchanged', 0, count(*) FROM sheet""",
    "sheet",
)
# The same marts, whichever way they are kept.
for _kept, _whole in (("monthly", "monthly_summary"), ("categories", "category_breakdown"), ("merchants", "top_merchants")):
    INGEST[f"{_kept}_by_deltas"] = LEDGER[f"mart_{_whole}"]

# ---------------------------------------------------------------------------
# Least squares: sums of products as lists of lists, solved by elimination.
# ---------------------------------------------------------------------------

_RIDGE = 0.001


def _least_squares(rows: str, group: str, terms: int) -> str:
    """``coef`` and ``n`` by group, from rows with a list ``x`` and a number ``y``."""
    equations = ", ".join(
        "["
        + ", ".join(f"sum(x[{i}] * x[{j}]){f' + {_RIDGE}' if i == j else ''}" for j in range(1, terms + 1))
        + f", sum(x[{i}] * y)]"
        for i in range(1, terms + 1)
    )
    found = f"SELECT {group}, count(*) AS n, [{equations}]::DOUBLE[][] AS m FROM {rows} GROUP BY {group}"
    for k in range(1, terms + 1):
        found = f"""
        SELECT {group}, n, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / m[{k}][{k}])
                   ELSE list_transform(r, lambda v, j: v - r[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m FROM ({found})"""
    return f"SELECT {group}, n, list_transform(m, lambda r: r[{terms + 1}]) AS coef FROM ({found})"


def _seasonal_terms(end: str) -> str:
    bends = [f"CASE WHEN changes > 0 THEN greatest((t - (first + ({end} - first) * {j / 4})) / 12.0::DOUBLE, 0) ELSE 0 END" for j in (1, 2, 3)]
    waves = [f"CASE WHEN harmonics >= {k} THEN {f}(((t * {k}) % 12) * pi() / 6) ELSE 0 END" for k in (1, 2) for f in ("sin", "cos")]
    return f"[1, (t - first) / 12.0::DOUBLE, {', '.join(bends + waves)}]::DOUBLE[]"


_CTES["scaled"] = """
    SELECT kind, series, t, y / scale AS y, scale, first, last FROM series JOIN (
        SELECT kind, series, min(t) AS first, max(t) AS last, greatest(max(y), 1.0::DOUBLE) AS scale
        FROM series GROUP BY kind, series) USING (kind, series)"""
_CTES["tried"] = f"""
    SELECT *, {_seasonal_terms("origin")} AS x
    FROM (SELECT *, last - back AS origin FROM scaled, (VALUES (3), (6), (9), (12)) b(back)),
         (VALUES (0), (3)) c(changes), (VALUES (1), (2)) h(harmonics)
    WHERE origin - first + 1 >= 24"""
_MODEL = "kind, series, changes, harmonics, origin"
_CTES["tried_fit"] = _least_squares("(SELECT * FROM tried WHERE t <= origin)", _MODEL, 9)
_CTES["back_tested"] = """
    SELECT kind, series, changes, harmonics, origin, scale, CAST(t - origin AS INTEGER) AS step,
           power(y - list_dot_product(x, coef), 2) AS squared
    FROM tried JOIN tried_fit USING (kind, series, changes, harmonics, origin) WHERE t BETWEEN origin + 1 AND origin + 3"""
_CTES["chosen"] = f"""
    SELECT s.*, {_seasonal_terms("last")} AS x FROM (
        SELECT s.*, coalesce(m.changes, 0) AS changes, coalesce(m.harmonics, 1) AS harmonics
        FROM scaled s LEFT JOIN (
            SELECT kind, series, arg_min(changes, place) AS changes, arg_min(harmonics, place) AS harmonics FROM (
                SELECT *, row_number() OVER (PARTITION BY kind, series ORDER BY error, changes, harmonics) AS place FROM (
                    SELECT kind, series, changes, harmonics, round(avg(squared), 12) AS error FROM back_tested GROUP BY ALL))
            GROUP BY kind, series) m USING (kind, series)) s"""
_CTES["chosen_fit"] = _least_squares("chosen", "kind, series", 9)


def _lags(rows: str, value: str, lags: int) -> list[str]:
    return [f"lag({value}, {i}) OVER (PARTITION BY kind, series ORDER BY t)" for i in range(1, lags + 1)]


def _arma(name: str, rows: str) -> None:
    """CTEs up to the model of each series: orders, coefficients, last values."""
    _CTES[f"{name}_long"] = f"""
        SELECT kind, series, t, y, list_concat([1.0::DOUBLE], ys) AS x, ys FROM (
            SELECT *, [{", ".join(_lags(rows, "y", 3))}] AS ys FROM {rows}) WHERE ys[3] IS NOT NULL"""
    _CTES[f"{name}_shocks"] = f"""
        SELECT kind, series, t, y, ys, y - list_dot_product(x, coef) AS e
        FROM {name}_long JOIN ({_least_squares(f"{name}_long", "kind, series", 4)}) USING (kind, series)"""
    _CTES[f"{name}_tried"] = f"""
        SELECT *, [1, ys[1], CASE WHEN ar >= 2 THEN ys[2] ELSE 0 END, CASE WHEN ma >= 1 THEN e1 ELSE 0 END]::DOUBLE[] AS x
        FROM (SELECT *, {_lags(rows, "e", 1)[0]} AS e1 FROM {name}_shocks), (VALUES (1), (2)) p(ar), (VALUES (0), (1)) q(ma)
        WHERE e1 IS NOT NULL"""
    _CTES[f"{name}_model"] = f"""
        SELECT kind, series, ar, ma, coef, last.y AS y1, last.ys[1] AS y2, last.e AS e1, last.t AS t_end FROM (
            SELECT kind, series, ar, ma, any_value(coef) AS coef,
                   row_number() OVER (PARTITION BY kind, series ORDER BY round(
                       max(n) * ln(greatest(avg(power(y - list_dot_product(x, coef), 2)), 1e-12::DOUBLE))
                       + (1 + ar + ma) * ln(max(n)), 6), ar, ma) AS place
            FROM {name}_tried JOIN ({_least_squares(f"{name}_tried", "kind, series, ar, ma", 4)}) USING (kind, series, ar, ma)
            GROUP BY kind, series, ar, ma)
        JOIN (SELECT kind, series, arg_max({{y: y, ys: ys, e: e, t: t}}, t) AS last FROM {name}_shocks GROUP BY ALL)
        USING (kind, series) WHERE place = 1"""
    _CTES[f"{name}_ahead"] = f"""
        SELECT *, coef[1] + coef[2] * f2 + coef[3] * f1 AS f3 FROM (
            SELECT *, coef[1] + coef[2] * f1 + coef[3] * y1 AS f2 FROM (
                SELECT *, coef[1] + coef[2] * y1 + coef[3] * y2 + coef[4] * e1 AS f1 FROM {name}_model))"""
    parts = [f"{name}_{p}" for p in ("long", "shocks", "tried", "model", "ahead")]
    _NEEDS.update({part: [before] for part, before in zip(parts, [rows, *parts])})


_CTES["scaled_training"] = "SELECT * FROM scaled WHERE t <= last - 3"
_arma("arma", "scaled_training")
_arma("arma_all", "scaled")
_NEEDS |= {
    "scaled": ["series"],
    "tried": ["scaled"],
    "tried_fit": ["tried"],
    "back_tested": ["tried_fit"],
    "chosen": ["back_tested"],
    "chosen_fit": ["chosen"],
    "scaled_training": ["scaled"],
}

SCIENCE["seasonal_backtest"] = _sql(
    """
    SELECT kind, series, changes, harmonics, step, count(*) AS origins,
           CAST(round(sqrt(avg(squared)) * max(scale)) AS BIGINT) AS rmse
    FROM back_tested GROUP BY kind, series, changes, harmonics, step""",
    "back_tested",
)
SCIENCE["seasonal_forecast"] = _sql(
    f"""
    SELECT kind, series, CAST(t // 12 AS INTEGER) AS yr, CAST(t % 12 + 1 AS INTEGER) AS mo, CAST(step AS INTEGER) AS step,
           changes, harmonics, CAST(round(list_dot_product({_seasonal_terms("last")}, coef) * scale) AS BIGINT) AS forecast
    FROM (SELECT *, last + step AS t FROM (
              SELECT DISTINCT kind, series, first, last, scale, changes, harmonics FROM chosen), generate_series(1, 3) g(step))
         JOIN chosen_fit USING (kind, series)""",
    "chosen_fit",
)
SCIENCE["arma_backtest"] = _sql(
    """
    SELECT kind, series, ar, ma, count(*) AS months,
           CAST(round(sqrt(avg(power(y - [f1, f2, f3][t - t_end], 2))) * max(scale)) AS BIGINT) AS rmse_arma
    FROM scaled JOIN arma_ahead USING (kind, series) WHERE t > last - 3 GROUP BY kind, series, ar, ma""",
    "arma_ahead",
)
SCIENCE["arma_forecast"] = _sql(
    """
    SELECT kind, series, CAST((t_end + step) // 12 AS INTEGER) AS yr, CAST((t_end + step) % 12 + 1 AS INTEGER) AS mo,
           CAST(step AS INTEGER) AS step, ar, ma, CAST(round([f1, f2, f3][step] * scale) AS BIGINT) AS forecast
    FROM arma_all_ahead JOIN (SELECT DISTINCT kind, series, scale FROM scaled) USING (kind, series), generate_series(1, 3) g(step)""",
    "arma_all_ahead",
)

# ---------------------------------------------------------------------------
# Checks batch by batch: rows whose id leaves remainder r modulo 4 are batch r + 1.
# ---------------------------------------------------------------------------

_SPENT = "x.transaction_type IN ('expense', 'credit_purchase') AND x.transaction_date IS NOT NULL"
_ROW_CHECKS = {
    **{
        f"not_null:stg_expenses.{shown}": f"{_SPENT} AND x.{c} IS NULL"
        for shown, c in zip(("id", "expense_date", "amount", "category_id"), "transaction_id transaction_date amount category_id".split())
    },
    "accepted:transactions.transaction_type": "x.transaction_type NOT IN ('income', 'expense', 'transfer_out', 'transfer_in', "
    "'credit_purchase', 'credit_payment', 'loan_given', 'loan_received', 'loan_repayment_in', 'loan_repayment_out')",
    "accepted:transactions.spending_type": "x.spending_type NOT IN ('fixed', 'extra')",
    "accepted:transactions.payment_method": "x.payment_method NOT IN ('cash', 'bank_transfer', 'credit_card', 'momo')",
    "accepted:transactions.source_data": "x.source_data NOT IN ('nodejs', 'python')",
    "expression:transactions.amount_positive": "x.amount <= 0",
    **{
        f"relationship:transactions.{c}": f"x.{c} IS NOT NULL AND x.{c} NOT IN (SELECT {c} FROM {t})"
        for c, t in (("account_id", "accounts"), ("plan_id", "plans"), ("category_id", "categories"), ("subcategory_id", "subcategories"))
    },
    "note_required:transactions.note": "coalesce(trim(x.note), '') = '' AND x.category_id IN "
    "(SELECT category_id FROM categories WHERE category_name = 'AFRICA')",
}
_BATCHED = " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, count(*) FILTER (batch = 4 AND hit) AS failed, count(*) FILTER (batch = 4) AS checked, "
    f"count(*) FILTER (batch < 4 AND hit) AS failed_before, count(*) FILTER (batch < 4) AS checked_before "
    f"FROM (SELECT x.transaction_id % 4 + 1 AS batch, coalesce({condition}, false) AS hit FROM tx x)"
    for name, condition in _ROW_CHECKS.items()
)
_CHECK_TABLES = "tx accounts categories subcategories plans".split()
QUALITY["checks_by_batch"] = _sql(
    f"SELECT check_name, failed + failed_before AS failed, checked + checked_before AS checked FROM ({_BATCHED})", *_CHECK_TABLES
)
QUALITY["check_drift"] = _sql(
    f"""
    SELECT * EXCLUDE (z), round(z, 6) AS z, coalesce(abs(z) > 3, false) AS drifted FROM (
        SELECT *, CASE WHEN p > 0 AND p < 1 THEN (failed / checked - failed_before / checked_before)
                   / sqrt(p * (1 - p) * (1.0::DOUBLE / checked + 1.0::DOUBLE / checked_before)) END AS z
        FROM (SELECT *, (failed + failed_before)::DOUBLE / (checked + checked_before) AS p FROM ({_BATCHED}))) t(
            check_name, failed, checked, failed_before, checked_before, p, z)""".replace("SELECT * EXCLUDE (z)", "SELECT * EXCLUDE (z, p)"),
    *_CHECK_TABLES,
)
