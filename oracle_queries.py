"""Independent SQL for DuckDB, one statement per registered query, over the same Parquet tables.

Written by hand, not generated from the Spark plans. Lookups are real joins here, also where the Spark
side leaves one out because its result is already known.
"""

from __future__ import annotations


def _sum(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(18,4)))::DOUBLE"


def _avg(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(30,12)))::DOUBLE / NULLIF(COUNT({x}), 0)"


_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_NET = f"{_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_SIZE = "CASE WHEN {0} < 2500 THEN 'Small' WHEN {0} < 6500 THEN 'Medium' ELSE 'Large' END"
_BREACH_RATE = "100.0::DOUBLE * SUM(sla_breach_flag) / COUNT(sla_breach_flag)"

# name -> (needed CTEs, body). Listed so that each follows what it needs.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    # ---- raw inputs ----
    "places": ((), """
        SELECT s_suppkey::INTEGER AS agency_id, s_name, s_acctbal, n_name AS country,
               'C' || lpad(n_nationkey::VARCHAR, 2, '0') AS country_code, r_name
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "agency_once": (("places",), f"""
        SELECT agency_id, s_name AS agency_name, country, country_code, {_SIZE.format('s_acctbal')} AS org_size,
               CASE agency_id % 4 WHEN 0 THEN 'Finance' WHEN 1 THEN 'Health' WHEN 2 THEN 'Justice'
                    ELSE 'Education' END AS sector_type,
               r_name AS aws_pref_region,
               CASE r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' ELSE 'XCD' END AS currency,
               CASE WHEN r_name = 'AMERICA' THEN 'Americas' WHEN r_name IN ('EUROPE', 'MIDDLE EAST') THEN 'EMEA'
                    ELSE 'APAC' END AS region_group
        FROM places"""),
    "agencies": (("agency_once",), """
        SELECT * FROM agency_once UNION ALL SELECT * FROM agency_once WHERE agency_id % 10 = 0"""),
    "usage_monthly": (("places",), f"""
        SELECT agency_id, country, country_code, strftime(first_day, '%Y-%m') AS month, service_type,
               10 * qty AS compute_hours, gross::DOUBLE / 100 AS storage_gb, qty AS data_egress_gb,
               2 * qty / n AS utilisation_pct, net::DOUBLE AS cost_usd,
               CASE WHEN agency_id % 7 = 0 THEN 'ASIA' ELSE r_name END AS aws_region,
               CASE WHEN agency_id % 2 = 0 AND first_day >= DATE '1998-07-01' THEN 'Post' ELSE 'Pre' END
                   AS migration_status,
               n::INTEGER AS resource_count
        FROM (
            SELECT l_suppkey::INTEGER AS agency_id, date_trunc('month', l_shipdate)::DATE AS first_day,
                   CASE l_returnflag WHEN 'A' THEN 'IaaS' WHEN 'N' THEN 'PaaS' ELSE 'SaaS' END AS service_type,
                   SUM(l_quantity) AS qty, SUM({_PRICE}) AS gross, SUM({_NET}) AS net, COUNT(*) AS n
            FROM lineitem GROUP BY ALL
        ) LEFT JOIN places USING (agency_id)"""),
    "tagging_compliance": (("places",), f"""
        SELECT agency_id, country, country_code, month,
               100.0::DOUBLE * tagged / n AS tagged_pct, untagged::DOUBLE AS untagged_cost_usd
        FROM (
            SELECT l_suppkey::INTEGER AS agency_id, strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS n,
                   COUNT(*) FILTER (o_orderpriority <> '4-NOT SPECIFIED') AS tagged,
                   SUM(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN {_PRICE} ELSE 0 END) AS untagged
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
        ) LEFT JOIN places USING (agency_id)"""),
    "provider_spend": (("places",), f"""
        SELECT agency_id, country, country_code, year, cloud_provider, spend::DOUBLE AS spend_usd
        FROM (
            SELECT l_suppkey::INTEGER AS agency_id, year(o_orderdate)::INTEGER AS year,
                   CASE o_orderstatus WHEN 'F' THEN 'AWS' WHEN 'O' THEN 'Azure' ELSE 'GCP' END AS cloud_provider,
                   SUM({_PRICE}) AS spend
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
        ) LEFT JOIN places USING (agency_id)"""),
    "migration_summary": (("places",), f"""
        SELECT agency_id, country, country_code, {_SIZE.format('s_acctbal')} AS org_size,
               CASE WHEN agency_id % 2 = 0 THEN 'Yes' ELSE 'No' END AS migrated,
               CASE WHEN agency_id % 2 = 0 THEN (1 + agency_id % 9)::VARCHAR || '/7/1998' ELSE '' END
                   AS migration_date,
               pre::DOUBLE AS pre_migration_cost_usd, post::DOUBLE AS post_migration_cost_usd,
               CASE WHEN agency_id % 2 = 0 THEN 20.0 ELSE 0.0 END::DOUBLE AS expected_savings_pct,
               100.0::DOUBLE * (pre::DOUBLE - post::DOUBLE) / NULLIF(pre::DOUBLE, 0) AS realized_savings_pct,
               heavy_pre::INTEGER AS sla_breaches_pre, heavy_post::INTEGER AS sla_breaches_post
        FROM (
            SELECT l_suppkey::INTEGER AS agency_id,
                   SUM(CASE WHEN l_shipdate < DATE '1998-07-01' THEN {_PRICE} ELSE 0 END) AS pre,
                   SUM(CASE WHEN l_shipdate < DATE '1998-07-01' THEN 0 ELSE {_PRICE} END) AS post,
                   COUNT(*) FILTER (l_shipdate < DATE '1998-07-01' AND l_quantity > 40) AS heavy_pre,
                   COUNT(*) FILTER (l_shipdate >= DATE '1998-07-01' AND l_quantity > 40) AS heavy_post
            FROM lineitem GROUP BY ALL
        ) LEFT JOIN places USING (agency_id)"""),
    "baseline_adoption": ((), f"""
        SELECT n_name AS country, 'C' || lpad(n_nationkey::VARCHAR, 2, '0') AS country_code,
               year(o_orderdate)::INTEGER AS year, {_SIZE.format('c_acctbal')} AS org_size,
               100.0::DOUBLE * COUNT(*) FILTER (o_orderstatus = 'F') / COUNT(*) AS adoption_pct
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY ALL"""),
    "budget": (("places",), f"""
        SELECT agency_id, strftime(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)), '%Y-%m')
                   AS month,
               floor(net::DOUBLE / n)::DOUBLE AS monthly_budget_usd
        FROM (
            SELECT agency_id, MIN(m) AS lo, MAX(m) AS hi, SUM(net) AS net, COUNT(*) AS n
            FROM (
                SELECT l_suppkey::INTEGER AS agency_id, date_trunc('month', l_shipdate)::DATE AS m, SUM({_NET}) AS net
                FROM lineitem GROUP BY ALL
            ) GROUP BY agency_id
        )"""),
    # ---- dimensions ----
    "dim_agency_clean": (("agencies",), """
        SELECT agency_id, MAX(agency_name) AS agency_name, MAX(country) AS country,
               MAX(country_code) AS country_code, MAX(org_size) AS org_size, MAX(sector_type) AS sector_type,
               MAX(aws_pref_region) AS aws_pref_region, MAX(currency) AS currency,
               MAX(region_group) AS region_group
        FROM agencies GROUP BY agency_id"""),
    "dim_service": ((), """
        SELECT * FROM (VALUES
            (1, 'IaaS', 'Compute Infrastructure', 'High'),
            (2, 'PaaS', 'Platform Services', 'Medium'),
            (3, 'SaaS', 'Application Services', 'High'))
            AS v(service_id, service_type, service_name, criticality_level)"""),
    "dim_region": (("agencies",), """
        SELECT ROW_NUMBER() OVER (ORDER BY aws_pref_region)::INTEGER AS region_id, aws_pref_region AS aws_region,
               MAX(region_group) AS region_group, 'Primary' AS tier
        FROM agencies GROUP BY aws_pref_region"""),
    "dim_date": (("usage_monthly",), """
        SELECT d AS date_key, month[1:4] AS year, month[6:7] AS month,
               month[1:4] || '-Q' || quarter(d)::VARCHAR AS quarter,
               -- Peak months are fixed values.
               CASE WHEN month(d) IN (1, 2, 3, 7, 8, 9) THEN 1 ELSE 0 END AS peak_period_flag,
               (year(d) * 100 + month(d))::INTEGER AS month_key, monthname(d) AS month_name
        FROM (SELECT DISTINCT month, (month || '-01')::DATE AS d FROM usage_monthly)"""),
    # ---- facts ----
    "fact_usage_monthly": (("usage_monthly", "dim_service", "dim_region", "dim_date"), """
        SELECT u.agency_id, d.date_key, s.service_id, r.region_id, u.service_type, u.compute_hours, u.storage_gb,
               u.data_egress_gb, u.utilisation_pct, u.cost_usd, u.resource_count, u.migration_status, u.aws_region
        FROM usage_monthly u
        LEFT JOIN dim_service s USING (service_type)
        LEFT JOIN dim_region r USING (aws_region)
        LEFT JOIN dim_date d ON d.date_key = (u.month || '-01')::DATE"""),
    "fact_cost_monthly": (("fact_usage_monthly",), """
        SELECT agency_id, date_key, service_id, region_id, service_type, cost_usd, compute_hours, storage_gb,
               data_egress_gb, utilisation_pct, resource_count, migration_status,
               CASE WHEN compute_hours + storage_gb + data_egress_gb > 0 THEN
                   cost_usd / NULLIF(compute_hours + storage_gb * 0.05::DOUBLE + data_egress_gb * 0.5::DOUBLE, 0)
               END AS cost_per_unit
        FROM fact_usage_monthly"""),
    "fact_performance": (("fact_usage_monthly", "dim_date"), """
        SELECT agency_id, date_key, service_id, region_id, service_type, migration_status, compute_hours, storage_gb,
               data_egress_gb, utilisation_pct, cost_usd, resource_count, peak_period_flag, latency_ms,
               error_rate_pct,
               (COALESCE(latency_ms > 500, FALSE) OR COALESCE(error_rate_pct > 3, FALSE)
                OR COALESCE(utilisation_pct > 85, FALSE))::INTEGER AS sla_breach_flag,
               CASE WHEN latency_ms <= 250 THEN 100 WHEN latency_ms <= 500 THEN 70 ELSE 40 END
                   AS response_time_score,
               CASE WHEN cost_usd > 0 THEN utilisation_pct / cost_usd END AS efficiency_ratio
        FROM (
            SELECT f.*, d.peak_period_flag,
                   150 + 3 * utilisation_pct + IF(migration_status = 'Pre', 80, 40) AS latency_ms,
                   (IF(utilisation_pct > 80, 3.5, IF(utilisation_pct > 70, 2.0, 0.8))
                    + IF(migration_status = 'Pre', 0.7, 0.0))::DOUBLE AS error_rate_pct
            FROM fact_usage_monthly f LEFT JOIN dim_date d USING (date_key)
        )"""),
    "fact_migration_summary": (("migration_summary", "dim_agency_clean"), """
        SELECT m.agency_id, a.country, a.country_code, a.org_size, (migrated = 'Yes')::INTEGER AS migration_flag,
               try_strptime(NULLIF(migration_date, ''), '%d/%m/%Y')::DATE AS migration_date,
               pre_migration_cost_usd, post_migration_cost_usd, expected_savings_pct, realized_savings_pct,
               sla_breaches_pre, sla_breaches_post,
               post_migration_cost_usd - pre_migration_cost_usd AS cost_delta_usd
        FROM migration_summary m LEFT JOIN dim_agency_clean a USING (agency_id)"""),
    "fact_tagging_compliance": (("tagging_compliance", "dim_date"), """
        SELECT agency_id, date_key, tagged_pct, untagged_cost_usd
        FROM tagging_compliance t LEFT JOIN dim_date d ON d.date_key = (t.month || '-01')::DATE"""),
    "fact_finance_governance": (("fact_tagging_compliance",), """
        SELECT *, 100 - tagged_pct AS tagging_gap, IF(tagged_pct < 80, 1, 0) AS governance_risk_flag
        FROM fact_tagging_compliance"""),
    "fact_provider_spend": (("provider_spend",), f"""
        SELECT p.*, spend_usd / NULLIF(total, 0) AS provider_share_pct
        FROM provider_spend p
        JOIN (SELECT agency_id, year, {_sum('spend_usd')} AS total FROM provider_spend GROUP BY ALL)
            USING (agency_id, year)"""),
    "monthly_spend": (("fact_cost_monthly",), f"""
        SELECT agency_id, date_key, {_sum('cost_usd')} AS monthly_cost FROM fact_cost_monthly GROUP BY ALL"""),
    "fact_forecast_input": (("monthly_spend",), """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY agency_id ORDER BY date_key)::INTEGER AS month_index
        FROM monthly_spend"""),
    # ---- shared steps of the measures ----
    "stable": (("fact_performance",), """
        SELECT *, response_time_score * 0.4::DOUBLE + (100 - error_rate_pct) * 0.3::DOUBLE
                  + utilisation_score * 0.3::DOUBLE AS stability_score
        FROM (SELECT *, CASE WHEN utilisation_pct < 20 THEN 60 WHEN utilisation_pct <= 85 THEN 100 ELSE 40 END::DOUBLE
                     AS utilisation_score
              FROM fact_performance)"""),
    "budget_variance": (("monthly_spend", "budget"), f"""
        SELECT *, actual_usd - budget_usd AS variance_usd,
               (actual_usd - budget_usd) / NULLIF(budget_usd, 0) AS variance_pct
        FROM (
            SELECT agency_id, date_key, COALESCE(monthly_cost, 0) AS actual_usd, COALESCE(b, 0) AS budget_usd
            FROM monthly_spend FULL JOIN (
                SELECT agency_id, (month || '-01')::DATE AS date_key, {_sum('monthly_budget_usd')} AS b
                FROM budget GROUP BY ALL
            ) USING (agency_id, date_key)
        )"""),
    "optimisation_total": (("fact_performance", "fact_tagging_compliance"), f"""
        SELECT *, untagged_usd + idle_usd + high_risk_usd AS optimisation_usd
        FROM (
            SELECT agency_id, COALESCE(actual_spend_usd, 0) AS actual_spend_usd,
                   COALESCE(untagged_usd, 0) AS untagged_usd, COALESCE(idle_usd, 0) AS idle_usd,
                   COALESCE(high_risk_usd, 0) AS high_risk_usd
            FROM (SELECT agency_id, {_sum('cost_usd')} AS actual_spend_usd,
                         {_sum('IF(utilisation_pct < 20, cost_usd, 0)')} AS idle_usd,
                         {_sum('IF(sla_breach_flag = 1, cost_usd, 0)')} AS high_risk_usd
                  FROM fact_performance GROUP BY agency_id)
            FULL JOIN (SELECT agency_id, {_sum('untagged_cost_usd')} AS untagged_usd
                       FROM fact_tagging_compliance GROUP BY agency_id) USING (agency_id)
        )"""),
    "provider_wide": (("provider_spend",), f"""
        SELECT agency_id, year, {_sum("IF(cloud_provider = 'AWS', spend_usd, 0)")} AS aws,
               {_sum("IF(cloud_provider = 'Azure', spend_usd, 0)")} AS azure,
               {_sum("IF(cloud_provider = 'GCP', spend_usd, 0)")} AS gcp
        FROM provider_spend GROUP BY ALL"""),
}


def _with(body: str, *needs: str) -> str:
    """The statement, headed by the CTEs it needs in dependency order."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in _CTES[name][0]:
                add(other)

    for name in needs:
        add(name)
    head = ",\n".join(f"{n} AS ({_CTES[n][1].strip()}\n)" for n in _CTES if n in wanted)
    return f"WITH {head}\n{body.strip()}" if head else body.strip()


def _table(name: str) -> str:
    return _with(f"SELECT * FROM {name}", name)


def _intake(table: str, nulls: bool, key: str = "agency_id", commas_of_short: int = 1) -> str:
    """Lines by fate: every row once, and once more broken by its key's remainder; ``nulls`` keeps bad values as NULL.

    A line cut after two fields still has its country where that is one of them.
    """
    return _with(f"""
        SELECT 'none' AS problem, TRUE AS kept, COUNT(*) AS lines, COUNT(*) AS commas FROM {table}
        UNION ALL
        SELECT 'fields', FALSE, COUNT(*), COUNT(*) FILTER ({key} % 3 = 2 OR {commas_of_short} = 1)
        FROM {table} WHERE {key} % 3 IN (0, 2) HAVING COUNT(*) > 0
        UNION ALL
        SELECT 'value: {key}', {nulls}, COUNT(*), COUNT(*) FROM {table} WHERE {key} % 3 = 1 HAVING COUNT(*) > 0""", table)


def _odd_amounts(table: str, *columns: str) -> str:
    test = " OR ".join(f"NOT isfinite({c})" for c in columns)
    return (f"SELECT 'raw_{table}' AS table_name, 'Amount not finite' AS check_type, COUNT(*) AS failing_rows "
            f"FROM {table} WHERE {test}")


def _repeated(table: str, *keys: str) -> str:
    return (f"SELECT 'raw_{table}' AS table_name, 'Repeated key' AS check_type, COALESCE(SUM(n - 1), 0)::BIGINT AS failing_rows "
            f"FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {', '.join(keys)})")


def _fails(table: str, label: str, condition: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{label}' AS check_type, COUNT(*) AS failing_rows "
            f"FROM {table} WHERE {condition}")


def _orphan(table: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'Orphaned agency_id' AS check_type, COUNT(*) AS failing_rows "
            f"FROM {table} f WHERE NOT EXISTS (FROM dim_agency_clean a WHERE a.agency_id = f.agency_id)")


def _counts(curated: str, raw: str) -> str:
    return (f"SELECT '{curated}' AS table_name, 'Row count reconciliation' AS check_type, c AS curated_rows, "
            f"r AS raw_rows, c - r AS variance "
            f"FROM (SELECT COUNT(*) AS c FROM {curated}), (SELECT COUNT(*) AS r FROM {raw})")


_TREND = """
    SELECT *, LAG(cost_usd) OVER w AS prev,
           SUM(CAST(cost_usd AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE
               / COUNT(cost_usd) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_avg_cost
    FROM fact_cost_monthly WINDOW w AS (PARTITION BY agency_id, service_type ORDER BY date_key)"""

_TOTAL_MONTHLY = f"""
    SELECT date_key, {_sum('cost_usd')} AS total_spend_usd FROM fact_cost_monthly GROUP BY date_key"""

_TAGGING = f"""COUNT(*) AS records, {_avg('tagged_pct')} AS avg_tagged_pct, {_avg('tagging_gap')} AS avg_tagging_gap,
    SUM(governance_risk_flag)::BIGINT AS risk_records, {_sum('untagged_cost_usd')} AS untagged_cost_usd"""

_CORR = "ROUND(CASE WHEN isfinite({0}) THEN {0} END, 6)"


def _corr(x: str, y: str) -> str:
    return _CORR.format(f"corr({x}::DOUBLE, {y}::DOUBLE)")


def _risk_arm(kind: str, column: str) -> str:
    return f"""SELECT '{kind}' AS entity_type, {column}::VARCHAR AS entity, {_BREACH_RATE} AS breach_rate_pct,
        {_avg('stability_score')} AS avg_stability FROM stable GROUP BY {column}"""


def statements() -> dict[str, str]:
    sql = {
        # ---- scans ----
        "scan_usage": _table("usage_monthly"),
        "scan_provider_spend": _table("provider_spend"),
        "scan_migration": _with(
            "SELECT * REPLACE (NULLIF(migration_date, '') AS migration_date) FROM migration_summary",
            "migration_summary"),
        "scan_agencies": _table("agencies"),
        "scan_adoption": _table("baseline_adoption"),
        "scan_tagging": _table("tagging_compliance"),
        "intake_usage": _intake("usage_monthly", False),
        "intake_provider_spend": _intake("provider_spend", True),
        "intake_migration": _intake("migration_summary", True),
        "intake_agencies": _intake("agencies", False, commas_of_short=0),
        "intake_adoption": _intake("baseline_adoption", False, "year"),
        "intake_tagging": _intake("tagging_compliance", False),
        # ---- tables ----
        **{n: _table(n) for n in (
            "dim_agency_clean", "dim_region", "dim_date", "fact_usage_monthly", "fact_cost_monthly",
            "fact_performance", "fact_migration_summary", "fact_tagging_compliance", "fact_finance_governance",
            "fact_provider_spend", "fact_forecast_input", "monthly_spend", "budget_variance",
            "optimisation_total")},
        "fact_provider_finance": _table("fact_provider_spend"),
        # The constant dimension is read with the rows that use it, so that the query runs over the tables.
        "dim_service": _with(f"""
            SELECT s.*, COUNT(u.agency_id) AS usage_rows, {_sum('u.cost_usd')} AS cost_usd
            FROM dim_service s LEFT JOIN usage_monthly u USING (service_type) GROUP BY ALL""",
            "dim_service", "usage_monthly"),
        "join_star_lookup": _with("""
            SELECT u.agency_id, u.month, u.service_type, s.service_id, s.service_name, u.aws_region, r.region_id,
                   r.region_group, u.cost_usd
            FROM usage_monthly u LEFT JOIN dim_service s USING (service_type) LEFT JOIN dim_region r USING (aws_region)
            """, "usage_monthly", "dim_service", "dim_region"),
        "join_month_lookup": _with("""
            SELECT t.agency_id, t.month AS raw_month, d.date_key, d.quarter, d.peak_period_flag
            FROM tagging_compliance t LEFT JOIN dim_date d ON (t.month || '-01')::DATE = d.date_key
            """, "tagging_compliance", "dim_date"),
        "anti_join_orphans": _with("""
            SELECT user_id, COUNT(*) AS events, 'customer' AS missing FROM events
            WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id) GROUP BY user_id
            UNION ALL
            SELECT c_custkey, 0::BIGINT, 'event' FROM customer
            WHERE NOT EXISTS (SELECT 1 FROM events WHERE c_custkey = user_id)"""),
        "topk_preview": _with(f"""
            SELECT agency_id, date_key, service_type, cost_usd, rolling_3m_avg_cost FROM ({_TREND})
            ORDER BY agency_id, date_key, service_type LIMIT 10""", "fact_cost_monthly"),
        # ---- views ----
        "v_cost_trends": _with(f"""
            SELECT agency_id, date_key, service_type, cost_usd, rolling_3m_avg_cost,
                   ROUND((cost_usd - prev) / NULLIF(prev, 0) * 100, 2) AS mom_growth_pct,
                   COALESCE((cost_usd - prev) / NULLIF(prev, 0) * 100 > 15, FALSE)::INTEGER AS spend_acceleration_flag
            FROM ({_TREND})""", "fact_cost_monthly"),
        "v_cost_spikes": _with("""
            SELECT agency_id, date_key, monthly_cost AS cost_usd, g AS spend_growth_pct,
                   COALESCE(g > 0.25, FALSE)::INTEGER AS spike_flag
            FROM (SELECT *, (monthly_cost - LAG(monthly_cost) OVER w) / NULLIF(LAG(monthly_cost) OVER w, 0) AS g
                  FROM monthly_spend WINDOW w AS (PARTITION BY agency_id ORDER BY date_key))""", "monthly_spend"),
        "v_cloud_waste": _with("""
            SELECT agency_id, date_key, cost_usd, utilisation_pct, IF(utilisation_pct < 20, cost_usd, 0) AS idle_cost,
                   IF(utilisation_pct < 20, 1, 0) AS idle_flag
            FROM fact_cost_monthly""", "fact_cost_monthly"),
        "v_budget_runrate": _with(f"""
            SELECT agency_id, fiscal_year, months_elapsed, ytd_spend,
                   ROUND((ytd_spend / NULLIF(months_elapsed, 0) * 12)::DECIMAL(38,6), 2)::DOUBLE AS projected_annual_spend,
                   ROUND((ytd_spend / NULLIF(months_elapsed, 0))::DECIMAL(38,6), 2)::DOUBLE AS avg_monthly_burn
            FROM (SELECT agency_id, year(date_key)::VARCHAR AS fiscal_year, MAX(month(date_key))::INTEGER
                         AS months_elapsed, {_sum('monthly_cost')} AS ytd_spend
                  FROM monthly_spend GROUP BY ALL)""", "monthly_spend"),
        # Years from October to September, named by the year they end in.
        "v_budget_runrate_fiscal": _with(f"""
            SELECT agency_id, fiscal_year, months_elapsed, ytd_spend,
                   ROUND((ytd_spend / NULLIF(months_elapsed, 0) * 12)::DECIMAL(38,6), 2)::DOUBLE AS projected_annual_spend,
                   ROUND((ytd_spend / NULLIF(months_elapsed, 0))::DECIMAL(38,6), 2)::DOUBLE AS avg_monthly_burn
            FROM (SELECT agency_id, (year(date_key) + IF(month(date_key) >= 10, 1, 0))::VARCHAR AS fiscal_year,
                         COUNT(date_key)::INTEGER AS months_elapsed, {_sum('monthly_cost')} AS ytd_spend
                  FROM monthly_spend GROUP BY ALL)""", "monthly_spend"),
        "v_cost_trends_dense": _with("""
            SELECT agency_id, date_key, service_type, cost_usd,
                   SUM(CAST(cost_usd AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::DOUBLE
                       / COUNT(cost_usd) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_avg_cost,
                   ROUND((cost_usd - LAG(cost_usd) OVER w) / NULLIF(LAG(cost_usd) OVER w, 0) * 100, 2) AS mom_growth_pct,
                   COALESCE((cost_usd - LAG(cost_usd) OVER w) / NULLIF(LAG(cost_usd) OVER w, 0) * 100 > 15, FALSE)::INTEGER
                       AS spend_acceleration_flag
            FROM (SELECT agency_id, service_type, date_key, COALESCE(f.cost_usd, 0) AS cost_usd
                  FROM (SELECT agency_id, service_type, unnest(generate_series(
                                   MIN(date_key)::TIMESTAMP, MAX(date_key)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS date_key
                        FROM fact_cost_monthly GROUP BY agency_id, service_type)
                  LEFT JOIN fact_cost_monthly f USING (agency_id, service_type, date_key))
            WINDOW w AS (PARTITION BY agency_id, service_type ORDER BY date_key)""", "fact_cost_monthly"),
        "v_cost_spikes_by_service": _with("""
            SELECT agency_id, service_type, date_key, cost_usd, g AS spend_growth_pct,
                   COALESCE(g > 0.25, FALSE)::INTEGER AS spike_flag
            FROM (SELECT *, (cost_usd - LAG(cost_usd) OVER w) / NULLIF(LAG(cost_usd) OVER w, 0) AS g
                  FROM fact_cost_monthly WINDOW w AS (PARTITION BY agency_id, service_type ORDER BY date_key))""",
            "fact_cost_monthly"),
        "v_seasonality_index": _with("""
            SELECT agency_id, date_key, monthly_cost AS monthly_spend, base AS rolling_6m_avg,
                   ROUND(monthly_cost / NULLIF(base, 0), 3) AS seasonality_index,
                   COALESCE(monthly_cost / NULLIF(base, 0) > 1.2, FALSE)::INTEGER AS high_pressure_flag
            FROM (SELECT *, SUM(CAST(monthly_cost AS DECIMAL(18,4))) OVER w::DOUBLE / COUNT(monthly_cost) OVER w AS base
                  FROM monthly_spend
                  WINDOW w AS (PARTITION BY agency_id ORDER BY date_key ROWS 5 PRECEDING))""", "monthly_spend"),
        "v_sla_bands": _with("""
            SELECT agency_id, date_key, service_id, region_id, migration_status, peak_period_flag, latency_ms,
                   error_rate_pct, utilisation_pct, sla_breach_flag, latency_band, error_band, utilisation_band,
                   ROUND(CASE latency_band WHEN 'Green' THEN 40 WHEN 'Amber' THEN 28 ELSE 16 END
                         + CASE error_band WHEN 'Green' THEN 40 WHEN 'Amber' THEN 28 ELSE 16 END
                         + CASE utilisation_band WHEN 'Healthy' THEN 20 WHEN 'Under-utilised' THEN 12 ELSE 8 END, 1
                   )::DOUBLE AS composite_health_score
            FROM (
                SELECT *,
                    CASE WHEN latency_ms <= 250 THEN 'Green' WHEN latency_ms <= 500 THEN 'Amber' ELSE 'Red' END
                        AS latency_band,
                    CASE WHEN error_rate_pct <= 1 THEN 'Green' WHEN error_rate_pct <= 3 THEN 'Amber' ELSE 'Red' END
                        AS error_band,
                    CASE WHEN utilisation_pct < 20 THEN 'Under-utilised' WHEN utilisation_pct <= 85 THEN 'Healthy'
                         ELSE 'High Risk' END AS utilisation_band
                FROM fact_performance)""", "fact_performance"),
        # ---- checks ----
        "dq_row_counts": _with("\nUNION ALL ".join([
            _counts("fact_usage_monthly", "usage_monthly"), _counts("fact_migration_summary", "migration_summary"),
            _counts("fact_tagging_compliance", "tagging_compliance"), _counts("fact_provider_spend", "provider_spend"),
            _counts("fact_cost_monthly", "usage_monthly")]),
            "fact_cost_monthly", "fact_migration_summary", "fact_tagging_compliance", "fact_provider_spend"),
        "dq_null_keys": _with("\nUNION ALL ".join(
            [_fails("fact_usage_monthly", f"Null {c}", f"{c} IS NULL")
             for c in ("agency_id", "date_key", "service_id", "region_id")]
            + [_fails("fact_tagging_compliance", "Null date_key", "date_key IS NULL"),
               _fails("fact_cost_monthly", "Null date_key", "date_key IS NULL")]),
            "fact_cost_monthly", "fact_tagging_compliance"),
        "dq_bounds": _with("\nUNION ALL ".join([
            _fails("fact_usage_monthly", "Utilisation out of bounds", "utilisation_pct NOT BETWEEN 0 AND 100"),
            _fails("fact_usage_monthly", "Negative cost_usd", "cost_usd < 0"),
            _fails("fact_usage_monthly", "Negative compute_hours", "compute_hours < 0"),
            _fails("fact_tagging_compliance", "tagged_pct out of bounds", "tagged_pct NOT BETWEEN 0 AND 100"),
            _fails("fact_tagging_compliance", "Negative untagged_cost_usd", "untagged_cost_usd < 0"),
            _fails("fact_provider_spend", "provider_share_pct out of bounds", "provider_share_pct NOT BETWEEN 0 AND 1"),
        ]), "fact_usage_monthly", "fact_tagging_compliance", "fact_provider_spend"),
        "dq_finite": _with("\nUNION ALL ".join([
            _odd_amounts("usage_monthly", "compute_hours", "storage_gb", "data_egress_gb", "utilisation_pct", "cost_usd"),
            _odd_amounts("tagging_compliance", "tagged_pct", "untagged_cost_usd"),
            _odd_amounts("provider_spend", "spend_usd"),
            _odd_amounts("migration_summary", "pre_migration_cost_usd", "post_migration_cost_usd", "expected_savings_pct",
                         "realized_savings_pct"),
        ]), "usage_monthly", "tagging_compliance", "provider_spend", "migration_summary"),
        "dq_grain": _with("\nUNION ALL ".join([
            _repeated("tagging_compliance", "agency_id", "month"),
            _repeated("provider_spend", "agency_id", "year", "cloud_provider"),
            _repeated("migration_summary", "agency_id"),
        ]), "tagging_compliance", "provider_spend", "migration_summary"),
        "dq_orphans": _with("\nUNION ALL ".join(
            _orphan(t) for t in ("fact_usage_monthly", "fact_tagging_compliance", "fact_migration_summary")),
            "fact_usage_monthly", "fact_tagging_compliance", "fact_migration_summary", "dim_agency_clean"),
        "dq_month_format": _with(
            "SELECT 'raw_tagging_compliance' AS table_name, 'Invalid month format' AS check_type, COUNT(*) AS "
            "failing_rows FROM tagging_compliance WHERE NOT regexp_full_match(month, '[0-9]{4}-[0-9]{2}')",
            "tagging_compliance"),
    }
    sql.update(_reliability())
    sql.update(_finops())
    views = ("v_cost_trends", "v_cost_spikes", "v_cloud_waste", "v_budget_runrate", "v_seasonality_index", "v_sla_bands")
    sql |= {f"catalogue_{n}": sql[n] for n in views}
    # Published tables by year carry it as a column.
    sql["published_fact_performance"] = _with("SELECT *, year(date_key)::INTEGER AS year FROM fact_performance", "fact_performance")
    return sql


def _reliability() -> dict[str, str]:
    grouped = "GROUP BY agency_id, service_type"
    return {
        "stability_score": _with("""
            SELECT agency_id, service_type, date_key, response_time_score, error_rate_pct, utilisation_score,
                   stability_score FROM stable""", "stable"),
        "sla_breach_rate": _with(f"""
            SELECT agency_id, service_type, COUNT(*) AS months, SUM(sla_breach_flag)::BIGINT AS breaches,
                   {_BREACH_RATE} AS breach_rate_pct FROM fact_performance {grouped}""", "fact_performance"),
        "avg_latency_error": _with(f"""
            SELECT agency_id, service_type, {_avg('latency_ms')} AS avg_latency_ms,
                   {_avg('error_rate_pct')} AS avg_error_pct FROM fact_performance {grouped}""", "fact_performance"),
        "stability_trend": _with(
            f"SELECT date_key, {_avg('stability_score')} AS avg_stability FROM stable GROUP BY date_key", "stable"),
        "top_risk_services": _with(f"""
            SELECT * FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_type
                    ORDER BY breach_rate_pct DESC, avg_stability, entity NULLS LAST)::INTEGER AS risk_rank
                FROM ({_risk_arm('service', 'service_type')} UNION ALL {_risk_arm('agency', 'agency_id')}
                      UNION ALL {_risk_arm('region', 'region_id')}))
            WHERE risk_rank <= 10""", "stable"),
        "breach_breakdown": _with(f"""
            SELECT agency_id, service_type, COUNT(*) FILTER (latency_ms > 500) AS latency_breaches,
                   COUNT(*) FILTER (error_rate_pct > 3) AS error_breaches,
                   COUNT(*) FILTER (utilisation_pct > 85) AS utilisation_breaches,
                   SUM(sla_breach_flag)::BIGINT AS breaches FROM fact_performance {grouped}""", "fact_performance"),
        "engineering_risk_score": _with(f"""
            SELECT *, breach_rate_pct * 0.5::DOUBLE + (100 - avg_stability) * 0.5::DOUBLE AS risk_score
            FROM (SELECT agency_id, service_type, {_BREACH_RATE} AS breach_rate_pct,
                         {_avg('stability_score')} AS avg_stability FROM stable {grouped})""", "stable"),
        "sla_breach_trend": _with(f"""
            SELECT date_key, peak_period_flag, {_BREACH_RATE} AS breach_rate_pct,
                   CASE WHEN peak_period_flag = 1 THEN {_BREACH_RATE} END AS peak_breach_rate_pct
            FROM fact_performance GROUP BY date_key, peak_period_flag""", "fact_performance"),
        "latency_vs_utilisation": _with(f"""
            SELECT agency_id, service_type, {_avg('utilisation_pct')} AS avg_utilisation,
                   {_avg('latency_ms')} AS avg_latency_ms,
                   {_corr('utilisation_pct', 'latency_ms')} AS correlation
            FROM fact_performance {grouped}""", "fact_performance"),
        "risk_correlation": _with(f"""
            SELECT agency_id, {_corr('utilisation_pct', 'sla_breach_flag')} AS utilisation_breach_corr,
                   {_corr('cost_usd', 'sla_breach_flag')} AS cost_breach_corr,
                   {_corr('utilisation_pct', 'cost_usd')} AS utilisation_cost_corr
            FROM fact_performance GROUP BY agency_id""", "fact_performance"),
        "peak_vs_offpeak": _with(f"""
            SELECT peak_period_flag, COUNT(*) AS months, {_avg('stability_score')} AS avg_stability,
                   {_avg('latency_ms')} AS avg_latency_ms, {_avg('error_rate_pct')} AS avg_error_pct,
                   {_BREACH_RATE} AS breach_rate_pct FROM stable GROUP BY peak_period_flag""", "stable"),
        "peak_collapse": _with(f"""
            SELECT *, offpeak_stability - peak_stability AS stability_drop FROM (
                SELECT agency_id, service_type,
                       {_avg('IF(peak_period_flag = 1, stability_score, NULL)')} AS peak_stability,
                       {_avg('IF(peak_period_flag = 0, stability_score, NULL)')} AS offpeak_stability
                FROM stable {grouped})
            WHERE offpeak_stability - peak_stability > 2""", "stable"),
        "breach_concentration": _with(f"""
            SELECT *, breaches::DOUBLE / NULLIF((SUM(breaches) OVER ())::DOUBLE, 0) AS share_of_breaches,
                   peak_breaches::DOUBLE / NULLIF((SUM(peak_breaches) OVER ())::DOUBLE, 0) AS share_of_peak_breaches,
                   offpeak_breaches::DOUBLE / NULLIF((SUM(offpeak_breaches) OVER ())::DOUBLE, 0)
                       AS share_of_offpeak_breaches
            FROM (SELECT agency_id, service_type, SUM(sla_breach_flag)::BIGINT AS breaches,
                         SUM(sla_breach_flag * peak_period_flag)::BIGINT AS peak_breaches,
                         SUM(sla_breach_flag * (1 - peak_period_flag))::BIGINT AS offpeak_breaches
                  FROM fact_performance {grouped})""", "fact_performance"),
        "region_performance": _with(f"""
            SELECT p.region_id, aws_region, region_group, COUNT(*) AS months, {_avg('latency_ms')} AS avg_latency_ms,
                   {_avg('error_rate_pct')} AS avg_error_pct, {_BREACH_RATE} AS breach_rate_pct
            FROM fact_performance p LEFT JOIN dim_region r USING (region_id) GROUP BY ALL""",
            "fact_performance", "dim_region"),
        "region_mismatch": _with(f"""
            SELECT agency_id, aws_pref_region, {_sum('cost_usd')} AS total_spend_usd,
                   {_sum('IF(r.aws_region <> a.aws_pref_region, cost_usd, 0)')} AS mismatch_spend_usd,
                   SUM(IF(r.aws_region <> a.aws_pref_region, sla_breach_flag, 0))::BIGINT AS mismatch_breaches
            FROM fact_performance p JOIN dim_region r USING (region_id) JOIN dim_agency_clean a USING (agency_id)
            GROUP BY ALL""", "fact_performance", "dim_region", "dim_agency_clean"),
        "sla_by_criticality": _with("""
            SELECT criticality_level, COUNT(*) AS months, SUM(sla_breach_flag)::BIGINT AS breaches,
                   100.0::DOUBLE * SUM(sla_breach_flag) / COUNT(*) AS breach_rate_pct
            FROM fact_performance LEFT JOIN dim_service USING (service_id) GROUP BY criticality_level""",
            "fact_performance", "dim_service"),
        "seasonal_load": _with(f"""
            SELECT month(date_key)::INTEGER AS calendar_month, {_avg('utilisation_pct')} AS avg_utilisation,
                   {_avg('compute_hours')} AS avg_compute_hours, {_avg('data_egress_gb')} AS avg_egress_gb
            FROM fact_performance GROUP BY ALL""", "fact_performance"),
        "pre_post_migration": _with(f"""
            SELECT migration_status, COUNT(*) AS months, {_avg('latency_ms')} AS avg_latency_ms,
                   {_avg('error_rate_pct')} AS avg_error_pct, SUM(sla_breach_flag)::BIGINT AS breaches,
                   {_BREACH_RATE} AS breach_rate_pct, {_avg('stability_score')} AS avg_stability
            FROM stable GROUP BY migration_status""", "stable"),
        "migration_roi": _with(f"""
            SELECT m.agency_id, migration_flag, cost_delta_usd, realized_savings_pct, stability_before, stability_after,
                   stability_after - stability_before AS stability_delta
            FROM fact_migration_summary m LEFT JOIN (
                SELECT agency_id,
                       {_avg("IF(migration_status = 'Pre', stability_score, NULL)")} AS stability_before,
                       {_avg("IF(migration_status = 'Post', stability_score, NULL)")} AS stability_after
                FROM stable GROUP BY agency_id) USING (agency_id)""", "fact_migration_summary", "stable"),
        "migration_improved_share": _with("""
            SELECT n AS migrated_agencies, k AS improved_agencies, k::DOUBLE / NULLIF(n, 0) AS improved_share,
                   b AS breaches_before, a AS breaches_after,
                   (b - a)::DOUBLE / NULLIF(b, 0) * 100 AS breach_reduction_pct
            FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (sla_breaches_post < sla_breaches_pre) AS k,
                         SUM(sla_breaches_pre)::BIGINT AS b, SUM(sla_breaches_post)::BIGINT AS a
                  FROM fact_migration_summary WHERE migration_flag = 1)""", "fact_migration_summary"),
        "measured_reliability": """
            SELECT day, COUNT(*) AS events, COUNT(*) FILTER (event_type = 'error') AS errors,
                   100.0::DOUBLE * COUNT(*) FILTER (event_type = 'error') / COUNT(*) AS error_rate_pct,
                   SUM(CAST(value AS DECIMAL(18,6)))::DOUBLE / NULLIF(COUNT(value), 0) AS avg_latency_ms,
                   ceil(quantile_disc(value, 0.95))::BIGINT AS p95_latency_ms
            FROM (SELECT *, ts::DATE AS day FROM events) GROUP BY day""",
    }


def _finops() -> dict[str, str]:
    runs = """
        SELECT agency_id, run, COUNT(*) FILTER (over = 1) AS n FROM (
            SELECT agency_id, over, SUM(1 - over) OVER (PARTITION BY agency_id ORDER BY date_key
                ROWS UNBOUNDED PRECEDING) AS run
            FROM (SELECT agency_id, date_key, IF(variance_usd > 0, 1, 0) AS over FROM budget_variance))
        GROUP BY ALL"""
    services = ("IaaS", "PaaS", "SaaS")
    wide = "SELECT agency_id, date_key, " + ", ".join(
        f"{_sum(f'''IF(service_type = '{s}', cost_usd, 0)''')} AS {s}" for s in services)
    wide += " FROM fact_cost_monthly GROUP BY ALL"
    rises = "SELECT agency_id, date_key, " + ", ".join(f"{s} - LAG({s}) OVER w AS {s}" for s in services)
    rises += f" FROM ({wide}) WINDOW w AS (PARTITION BY agency_id ORDER BY date_key)"
    shares = ", ".join(f"{p} / NULLIF(0::DOUBLE + aws + azure + gcp, 0) AS {p}_share" for p in ("aws", "azure", "gcp"))
    known = ", ".join(f"COALESCE(MAX(IF(provider = '{p}', share, NULL)), 0) AS {p.lower()}_share"
                      for p in ("AWS", "Azure", "GCP"))
    parts = ("overrun_usd", "waste_share", "untagged_usd", "high_risk_usd")
    risk = " + ".join(f"PERCENT_RANK() OVER (ORDER BY {c})" for c in parts)
    fit = """
        SELECT agency_id, COUNT(*) AS n, MAX(date_key) AS last_month, regr_avgx(y, x) AS mx, MAX(x) AS last_x, regr_slope(y, x) AS b,
               regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy
        FROM (SELECT agency_id, date_key, (year(date_key) * 12 + month(date_key))::DOUBLE AS x, monthly_cost AS y FROM fact_forecast_input
              WHERE date_key IS NOT NULL)
        GROUP BY agency_id"""
    ahead = f"""
        SELECT agency_id, step, (last_month + to_months(step))::DATE AS forecast_month, a + b * (last_x + step) AS p,
               CASE WHEN n >= 3 THEN sqrt(greatest(syy - b * b * sxx, 0) / (n - 2))
                   * sqrt(1 + 1.0::DOUBLE / n + pow(last_x + step - mx, 2) / sxx) END AS e
        FROM ({fit}), (SELECT unnest(range(1, 7))::INTEGER AS step)"""
    return {
        "actual_spend": _with(f"""
            SELECT agency_id, agency_name, a.country, sector_type, {_sum('cost_usd')} AS actual_spend_usd
            FROM fact_cost_monthly LEFT JOIN dim_agency_clean a USING (agency_id) GROUP BY ALL""",
            "fact_cost_monthly", "dim_agency_clean"),
        "budget_variance_ytd": _with(f"""
            SELECT *, CASE WHEN ytd_variance_usd <= 0 THEN 'Green'
                           WHEN ytd_variance_usd <= ytd_budget_usd * 0.1::DOUBLE THEN 'Yellow' ELSE 'Red' END AS status
            FROM (SELECT *, ytd_actual_usd - ytd_budget_usd AS ytd_variance_usd,
                         (ytd_actual_usd - ytd_budget_usd) / NULLIF(ytd_budget_usd, 0) AS ytd_variance_pct
                  FROM (SELECT agency_id, year(date_key)::INTEGER AS fiscal_year, date_key,
                               SUM(CAST(actual_usd AS DECIMAL(18,4))) OVER w::DOUBLE AS ytd_actual_usd,
                               SUM(CAST(budget_usd AS DECIMAL(18,4))) OVER w::DOUBLE AS ytd_budget_usd
                        FROM budget_variance
                        WINDOW w AS (PARTITION BY agency_id, year(date_key) ORDER BY date_key
                                     ROWS UNBOUNDED PRECEDING)))""", "budget_variance"),
        "recurring_overruns": _with(f"""
            SELECT agency_id, SUM(n)::BIGINT AS months_over, MAX(n)::BIGINT AS longest_run,
                   IF(MAX(n) >= 3, 1, 0) AS recurring_flag
            FROM ({runs}) GROUP BY agency_id""", "budget_variance"),
        "spike_drivers": _with(f"""
            SELECT agency_id, date_key, total AS total_increase_usd, top.service AS driver_service,
                   top.rise AS driver_increase_usd, top.rise / NULLIF(total, 0) AS driver_share
            FROM (SELECT *, IaaS + PaaS + SaaS AS total,
                         greatest({{'rise': IaaS, 'service': 'IaaS'}}, {{'rise': PaaS, 'service': 'PaaS'}},
                                  {{'rise': SaaS, 'service': 'SaaS'}}) AS top
                  FROM ({rises}))
            WHERE total > 0""", "fact_cost_monthly"),
        "spend_forecast": _with(f"""
            SELECT agency_id, step, forecast_month, ROUND(p, 2) AS forecast,
                   ROUND(p - 1.2816::DOUBLE * e, 2) AS low_80, ROUND(p + 1.2816::DOUBLE * e, 2) AS high_80,
                   ROUND(p - 1.96::DOUBLE * e, 2) AS low_95, ROUND(p + 1.96::DOUBLE * e, 2) AS high_95
            FROM ({ahead})""", "fact_forecast_input"),
        "spend_trend": _with(f"""
            SELECT date_key, total_spend_usd,
                   ROUND((total_spend_usd - LAG(total_spend_usd) OVER w)
                         / NULLIF(LAG(total_spend_usd) OVER w, 0) * 100, 2) AS mom_growth_pct,
                   SUM(CAST(total_spend_usd AS DECIMAL(18,4))) OVER (w ROWS 2 PRECEDING)::DOUBLE
                       AS rolling_3m_spend_usd
            FROM ({_TOTAL_MONTHLY}) WINDOW w AS (ORDER BY date_key)""", "fact_cost_monthly"),
        "service_mix": _with(f"""
            SELECT *, spend_usd / NULLIF(SUM(CAST(spend_usd AS DECIMAL(18,4))) OVER (PARTITION BY date_key)::DOUBLE, 0)
                       AS spend_share
            FROM (SELECT date_key, service_type, {_sum('cost_usd')} AS spend_usd FROM fact_cost_monthly GROUP BY ALL)
            """, "fact_cost_monthly"),
        "top_growth_agencies": _with("""
            SELECT *, ROW_NUMBER() OVER (ORDER BY growth_pct DESC, agency_id)::INTEGER AS growth_rank
            FROM (SELECT agency_id, date_key, monthly_cost, prev AS previous_cost,
                         (monthly_cost - prev) / NULLIF(prev, 0) * 100 AS growth_pct
                  FROM (SELECT *, LAG(monthly_cost) OVER w AS prev,
                               date_key = MAX(date_key) OVER (PARTITION BY agency_id) AS latest
                        FROM monthly_spend WINDOW w AS (PARTITION BY agency_id ORDER BY date_key))
                  WHERE latest AND (monthly_cost - prev) / NULLIF(prev, 0) IS NOT NULL)
            ORDER BY growth_pct DESC, agency_id LIMIT 10""", "monthly_spend"),
        "acceleration_concentration": _with(f"""
            SELECT agency_id, increase_usd, share_of_increase, increase_rank,
                   SUM(share_of_increase) OVER (ORDER BY increase_rank ROWS UNBOUNDED PRECEDING) AS cumulative_share
            FROM (SELECT *, increase_usd / SUM(CAST(increase_usd AS DECIMAL(18,4))) OVER ()::DOUBLE
                             AS share_of_increase,
                         ROW_NUMBER() OVER (ORDER BY increase_usd DESC, agency_id)::INTEGER AS increase_rank
                  FROM (SELECT agency_id, {_sum('greatest(rise, 0)')} AS increase_usd
                        FROM (SELECT agency_id, monthly_cost - LAG(monthly_cost)
                                     OVER (PARTITION BY agency_id ORDER BY date_key) AS rise FROM monthly_spend)
                        GROUP BY agency_id))
            WHERE increase_rank <= 2""", "monthly_spend"),
        "tagging_summary": _with(
            f"SELECT agency_id, {_TAGGING} FROM fact_finance_governance GROUP BY agency_id", "fact_finance_governance"),
        "tagging_trend": _with(
            f"SELECT date_key, {_TAGGING} FROM fact_finance_governance GROUP BY date_key", "fact_finance_governance"),
        "untagged_share": _with(f"""
            SELECT *, untagged_cost_usd / NULLIF(actual_spend_usd, 0) AS untagged_share
            FROM (SELECT agency_id, {_sum('cost_usd')} AS actual_spend_usd FROM fact_cost_monthly GROUP BY ALL)
            FULL JOIN (SELECT agency_id, {_sum('untagged_cost_usd')} AS untagged_cost_usd
                       FROM fact_finance_governance GROUP BY ALL) USING (agency_id)""",
            "fact_cost_monthly", "fact_finance_governance"),
        "governance_heat": _with("SELECT agency_id, year(date_key)::INTEGER AS year, " + ", ".join(
            f"MAX(governance_risk_flag) FILTER (month(date_key) = {m}) AS m{m:02d}" for m in range(1, 13))
            + " FROM fact_finance_governance GROUP BY ALL", "fact_finance_governance"),
        "waste_by_service": _with(f"""
            SELECT *, idle_cost_usd / NULLIF(actual_spend_usd, 0) * 100 AS waste_pct
            FROM (SELECT agency_id, service_type, {_sum('cost_usd')} AS actual_spend_usd,
                         {_sum('IF(utilisation_pct < 20, cost_usd, 0)')} AS idle_cost_usd
                  FROM fact_cost_monthly GROUP BY ALL)""", "fact_cost_monthly"),
        "unmatched_spend": _with(f"""
            SELECT *, unmatched_spend_usd / NULLIF(total_spend_usd, 0) AS unmatched_share
            FROM (SELECT agency_id, {_sum('cost_usd')} AS total_spend_usd,
                         {_sum('IF(cost_usd > pc AND util <= pu AND compute_hours <= ph, cost_usd, 0)')}
                             AS unmatched_spend_usd
                  FROM (SELECT *, LAG(cost_usd) OVER w AS pc, LAG(util) OVER w AS pu, LAG(compute_hours) OVER w AS ph
                        FROM (SELECT *, CAST(utilisation_pct AS DECIMAL(18,6))::DOUBLE AS util FROM fact_cost_monthly)
                        WINDOW w AS (PARTITION BY agency_id, service_type ORDER BY date_key))
                  GROUP BY agency_id)""", "fact_cost_monthly"),
        "provider_pivot": _with(f"""
            SELECT year, aws AS aws_spend_usd, azure AS azure_spend_usd, gcp AS gcp_spend_usd,
                   0::DOUBLE AS other_spend_usd, 0::DOUBLE + aws + azure + gcp AS total_spend_usd, {shares}
            FROM (SELECT year, {_sum('aws')} AS aws, {_sum('azure')} AS azure, {_sum('gcp')} AS gcp
                  FROM provider_wide GROUP BY year)""", "provider_wide"),
        "provider_concentration": _with(f"""
            SELECT agency_id, year, {known}, MAX(share) AS dominant_share,
                   arg_max(provider, (share, provider)) AS dominant_provider,
                   SUM(CAST(share * share AS DECIMAL(30,12)))::DOUBLE AS concentration_index,
                   IF(MAX(share) > 0.7, 1, 0) AS high_dependence_flag,
                   IF(SUM(CAST(share * share AS DECIMAL(30,12)))::DOUBLE <= 0.4, 1, 0) AS fragmented_flag
            FROM (SELECT agency_id, year, provider, spend / NULLIF(
                             SUM(CAST(spend AS DECIMAL(18,4))) OVER (PARTITION BY agency_id, year)::DOUBLE, 0) AS share
                  FROM (SELECT agency_id, year, COALESCE(cloud_provider, 'Unknown') AS provider,
                               {_sum('spend_usd')} AS spend FROM provider_spend GROUP BY ALL))
            GROUP BY ALL""", "provider_spend"),
        "financial_risk_rank": _with(f"""
            SELECT *, RANK() OVER (ORDER BY risk_score DESC) AS risk_rank
            FROM (SELECT *, ({risk}) / 4 AS risk_score
                  FROM (SELECT agency_id, greatest(COALESCE(v, 0), 0) AS overrun_usd,
                               COALESCE(idle_usd / NULLIF(actual_spend_usd, 0), 0) AS waste_share,
                               COALESCE(untagged_usd, 0) AS untagged_usd, COALESCE(high_risk_usd, 0) AS high_risk_usd
                        FROM optimisation_total FULL JOIN (
                            SELECT agency_id, {_sum('variance_usd')} AS v FROM budget_variance GROUP BY agency_id)
                            USING (agency_id)))""", "optimisation_total", "budget_variance"),
        "budget_over_time": _with(f"""
            SELECT *, actual_usd - budget_usd AS variance_usd,
                   (actual_usd - budget_usd) / NULLIF(budget_usd, 0) AS variance_pct
            FROM (SELECT date_key, {_sum('actual_usd')} AS actual_usd, {_sum('budget_usd')} AS budget_usd
                  FROM budget_variance GROUP BY date_key)""", "budget_variance"),
        "executive_summary": _with(f"""
            SELECT *, idle_cost_usd / NULLIF(actual_spend_usd, 0) * 100 AS waste_pct,
                   untagged_cost_usd / NULLIF(actual_spend_usd, 0) AS untagged_share
            FROM (SELECT COUNT(*) AS service_months, {_avg('stability_score')} AS avg_stability,
                         {_BREACH_RATE} AS breach_rate_pct, {_avg('latency_ms')} AS avg_latency_ms,
                         {_avg('error_rate_pct')} AS avg_error_pct, {_sum('cost_usd')} AS actual_spend_usd,
                         {_sum('IF(utilisation_pct < 20, cost_usd, 0)')} AS idle_cost_usd,
                         {_sum('IF(sla_breach_flag = 1, cost_usd, 0)')} AS high_risk_usd FROM stable),
                 (SELECT {_avg('tagged_pct')} AS avg_tagged_pct,
                         SUM(governance_risk_flag)::BIGINT AS governance_risk_records,
                         {_sum('untagged_cost_usd')} AS untagged_cost_usd FROM fact_finance_governance),
                 (SELECT {_sum("IF(cloud_provider = 'AWS', spend_usd, 0)")} / {_sum('spend_usd')} AS aws_share
                  FROM provider_spend),
                 (SELECT SUM(migration_flag)::BIGINT AS migrated_agencies,
                         {_sum('cost_delta_usd')} AS migration_cost_delta_usd,
                         SUM(sla_breaches_pre)::BIGINT AS breaches_before,
                         SUM(sla_breaches_post)::BIGINT AS breaches_after FROM fact_migration_summary)""",
            "stable", "fact_finance_governance", "provider_spend", "fact_migration_summary"),
    }
