"""The same queries as plain SQL over the given tables, for checking against DuckDB.

Every statement starts from the given tables: raw views, cleaning, lead summary and predictions
are common table expressions, written down independently of the Spark code.
"""

from __future__ import annotations


def _mix(key: str, multiplier: int, buckets: int) -> str:
    return f"((((({key}) + 1) * {multiplier}) % 4294967296) // 65536) % {buckets}"


def _pick(index: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {whens} END"


def _p6(expr: str) -> str:
    return f"(round({expr}, 6) + CAST(0 AS DOUBLE))"


def _r6(expr: str) -> str:
    return f"(round({expr} + CAST(1e-9 AS DOUBLE), 6) + CAST(0 AS DOUBLE))"


def _r2(expr: str) -> str:
    return f"(round({expr} + CAST(1e-9 AS DOUBLE), 2) + CAST(0 AS DOUBLE))"


def _n(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


LEAD = (
    "lead_id, contact_name, company_name, industry, company_size, company_size_missing, lead_source, "
    "job_title, country, region, status, created_date"
)
ACT = "activity_id, lead_id, activity_date, activity_type, channel, outcome"
TOUCH = "touch_id, lead_id, campaign_id, touch_date, response, treatment_group"

_CTES: list[tuple[str, str]] = [
    ("first_orders", f"""
        SELECT o_custkey, o_orderkey AS ok, o_orderstatus AS st, o_totalprice AS price, CAST(o_orderdate AS DATE) AS od
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
        WHERE rn = 1 AND {_mix('o_custkey', 374761393, 10)} < 6"""),
    ("dated_customers", f"""
        SELECT c.*, f.st, CAST(coalesce(f.od, DATE '1998-01-01') - CAST({_mix('c_custkey', 461845907, 120)} AS INTEGER) AS DATE) AS created_date
        FROM customer c LEFT JOIN first_orders f ON f.o_custkey = c.c_custkey"""),
    ("raw_leads", f"""
        SELECT 'L' || c_custkey AS lead_id, 'Contact ' || c_custkey AS contact_name, c_name AS company_name,
               c_mktsegment AS industry,
               CASE WHEN {_mix('c_custkey', 2654435761, 50)} = 0 THEN NULL
                    WHEN {_mix('c_custkey', 2246822519, 100)} = 1 THEN sz || ' emp'
                    WHEN {_mix('c_custkey', 2246822519, 100)} = 2 THEN sz || '.0'
                    ELSE sz END AS company_size,
               {_pick(_mix('c_custkey', 3266489917, 6), ['Website', 'Referral', 'Cold Call', 'LinkedIn', 'Trade Show', 'Webinar'])} AS lead_source,
               {_pick(_mix('c_custkey', 668265263, 6), ['VP Sales', 'Marketing Manager', 'CEO', 'Procurement Lead', 'Operations Director', 'IT Manager'])} AS job_title,
               n_name AS country, r_name AS region,
               CASE st WHEN 'F' THEN 'Converted' WHEN 'P' THEN 'Lost' WHEN 'O' THEN 'Qualified'
                    ELSE {_pick(_mix('c_custkey', 374761393, 3), ['New', 'Contacted', 'Unqualified'])} END AS status,
               created_date
        FROM (SELECT *, CAST(CAST(floor(abs(c_acctbal) / 10) + 5 AS INTEGER) AS VARCHAR) AS sz FROM dated_customers)
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""),
    ("raw_opportunities", f"""
        SELECT 'O' || ok AS opportunity_id,
               CASE WHEN {_mix('ok', 2246822519, 200)} = 0 THEN 'L99999999' ELSE 'L' || o_custkey END AS lead_id,
               CASE WHEN {_mix('ok', 3266489917, 300)} = 0 THEN CAST(999999999 AS DOUBLE)
                    WHEN {_mix('ok', 2654435761, 40)} = 0 THEN NULL ELSE price END AS deal_value,
               CASE st WHEN 'F' THEN 'Closed-Won' WHEN 'P' THEN 'Closed-Lost'
                    ELSE {_pick(_mix('ok', 668265263, 4), ['Prospecting', 'Qualification', 'Proposal', 'Negotiation'])} END AS stage,
               'Owner ' || (o_custkey % 20) AS owner, od AS open_date,
               CAST(od + CAST(20 + {_mix('ok', 374761393, 71)} AS INTEGER) AS DATE) AS expected_close_date,
               CAST(CASE WHEN st = 'O' THEN NULL
                    WHEN {_mix('ok', 461845907, 97)} = 0 THEN od - 200
                    ELSE od + CAST(10 + {_mix('ok', 374761393, 71)} + {_mix('ok', 3432918353, 31)} AS INTEGER) END AS DATE) AS actual_close_date
        FROM first_orders"""),
    ("raw_activities", f"""
        SELECT 'T' || event_id AS activity_id,
               CASE WHEN event_id % 200 = 0 OR (copy = 1 AND event_id % 1000 = 103) THEN 'L99999999'
                    ELSE 'L' || (user_id * 10 + event_id % 10) END AS lead_id,
               CAST(ts AS DATE) AS activity_date, event_type AS activity_type,
               {_pick('event_id % 4', ['Email', 'Phone', 'LinkedIn', 'In-person'])} AS channel,
               {_pick('(event_id // 4) % 4', ['Positive', 'Neutral', 'Negative', 'No Response'])} AS outcome,
               CAST(event_id * 2 + copy AS BIGINT) AS ingest_seq
        FROM (SELECT *, 0 AS copy FROM events UNION ALL SELECT *, 1 AS copy FROM events WHERE event_id % 100 = 3)"""),
    ("raw_campaign_touches", f"""
        SELECT 'P' || c_custkey AS touch_id, 'L' || c_custkey AS lead_id, 'CMP001' AS campaign_id,
               CAST(created_date + CAST(5 + c_custkey % 26 AS INTEGER) AS DATE) AS touch_date,
               {_pick(_mix('c_custkey', 3432918353, 5), ['Opened', 'Clicked', 'Replied', 'Unsubscribed', 'No Action'])} AS response,
               CASE WHEN {_mix('c_custkey', 2870177451, 2)} = 0 THEN 'Treatment' ELSE 'Control' END AS treatment_group,
               c_custkey AS ingest_seq
        FROM dated_customers WHERE {_mix('c_custkey', 1540483477, 20)} < 9"""),
    ("leads_clean", r"""
        SELECT lead_id, contact_name, company_name, industry,
               TRY_CAST(nullif(regexp_extract(company_size, '(\d+)', 1), '') AS INTEGER) AS company_size,
               TRY_CAST(nullif(regexp_extract(company_size, '(\d+)', 1), '') AS INTEGER) IS NULL AS company_size_missing,
               lead_source, job_title, country, region, status, created_date
        FROM raw_leads"""),
    ("opportunities_clean", """
        SELECT opportunity_id, lead_id, CASE WHEN deal_value > 50000000 THEN NULL ELSE deal_value END AS deal_value,
               coalesce(deal_value > 50000000, false) AS deal_value_outlier,
               stage, owner, open_date, expected_close_date, actual_close_date
        FROM raw_opportunities WHERE lead_id IN (SELECT lead_id FROM leads_clean)"""),
    ("activities_first", """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY activity_id ORDER BY ingest_seq) AS rn FROM raw_activities) WHERE rn = 1"""),
    ("activities_clean", f"SELECT {ACT} FROM activities_first WHERE lead_id IN (SELECT lead_id FROM leads_clean)"),
    ("activities_rejected", f"""
        SELECT {ACT}, 'orphan_lead_id' AS rejection_reason FROM activities_first a
        WHERE NOT EXISTS (SELECT 1 FROM leads_clean l WHERE l.lead_id = a.lead_id)"""),
    ("campaign_touches_clean", f"""
        SELECT {TOUCH} FROM (SELECT *, row_number() OVER (PARTITION BY touch_id ORDER BY ingest_seq) AS rn FROM raw_campaign_touches)
        WHERE rn = 1 AND lead_id IN (SELECT lead_id FROM leads_clean)"""),
    ("fact_activities", "SELECT activity_id, lead_id, activity_date AS date_id, activity_type, channel, outcome FROM activities_clean"),
    ("fact_opportunities", """
        SELECT opportunity_id, lead_id, deal_value, deal_value_outlier, stage, owner, open_date AS open_date_id,
               expected_close_date AS expected_close_date_id, actual_close_date AS actual_close_date_id
        FROM opportunities_clean"""),
    ("fact_campaign_touches", "SELECT touch_id, lead_id, campaign_id, touch_date AS date_id, response, treatment_group FROM campaign_touches_clean"),
    ("lead_summary", """
        SELECT l.*, coalesce(a.total_activities, 0) AS total_activities, a.first_activity_date, a.last_activity_date,
               t.lead_id IS NOT NULL AS received_campaign, t.touch_date AS campaign_touch_date,
               t.response AS campaign_response, t.treatment_group,
               o.lead_id IS NOT NULL AS has_opportunity, o.opportunity_id, o.stage AS opportunity_stage, o.deal_value,
               o.deal_value_outlier, o.open_date, o.expected_close_date, o.actual_close_date,
               CASE WHEN l.status = 'Converted' THEN 1 ELSE 0 END AS event_converted,
               CAST(CASE WHEN l.status = 'Converted' AND o.actual_close_date IS NOT NULL
                    THEN date_diff('day', l.created_date, o.actual_close_date)
                    ELSE date_diff('day', l.created_date, DATE '2002-01-01') END AS INTEGER) AS duration_days
        FROM leads_clean l
        LEFT JOIN (SELECT lead_id, CAST(count(*) AS BIGINT) AS total_activities, min(activity_date) AS first_activity_date,
                          max(activity_date) AS last_activity_date FROM activities_clean GROUP BY lead_id) a ON a.lead_id = l.lead_id
        LEFT JOIN opportunities_clean o ON o.lead_id = l.lead_id
        LEFT JOIN campaign_touches_clean t ON t.lead_id = l.lead_id"""),
    ("survival_input", """
        SELECT lead_id, CAST(duration_days AS DOUBLE) AS duration_days, event_converted, industry, lead_source, region, job_title,
               CAST(company_size AS DOUBLE) AS company_size, CAST(total_activities AS INTEGER) AS total_activities,
               CAST(coalesce(received_campaign, false) AS INTEGER) AS received_campaign
        FROM lead_summary WHERE duration_days > 0"""),
    ("portfolio", """
        SELECT lead_id, company_name, industry, company_size, job_title, lead_source, country, region, status, created_date,
               total_activities, received_campaign, campaign_response, treatment_group, opportunity_stage,
               coalesce(deal_value, 0) AS deal_value, actual_close_date, duration_days
        FROM lead_summary"""),
    ("campaign", "SELECT * FROM portfolio WHERE received_campaign AND treatment_group IN ('Treatment', 'Control')"),
    # scoring
    ("rule_scores", f"""
        SELECT l.lead_id, g.p AS conversion_probability, coalesce(l.deal_value, 0) AS deal_value, l.event_converted
        FROM lead_summary l JOIN (SELECT lead_source, industry, {_p6('sum(event_converted) / CAST(count(*) AS DOUBLE)')} AS p
                                  FROM lead_summary GROUP BY lead_source, industry) g
             ON g.lead_source = l.lead_source AND g.industry = l.industry"""),
    ("tier_cuts", "SELECT quantile_cont(conversion_probability, 0.2) AS q20, quantile_cont(conversion_probability, 0.8) AS q80 FROM rule_scores"),
    ("rule_outputs", """
        SELECT lead_id, conversion_probability,
               CASE WHEN conversion_probability >= q80 THEN 'Low' WHEN conversion_probability >= q20 THEN 'Medium' ELSE 'High' END AS risk_tier,
               round_even((1 - conversion_probability) * deal_value, 2) AS expected_loss
        FROM rule_scores, tier_cuts"""),
    ("scored", """
        SELECT s.*, l.company_name, l.industry, l.region, l.lead_source, l.job_title, l.company_size, l.status, l.deal_value,
               l.event_converted, l.duration_days
        FROM rule_outputs s LEFT JOIN lead_summary l ON l.lead_id = s.lead_id"""),
    # survival
    ("km_days", """
        SELECT 'lead_source' AS dim, lead_source AS seg, duration_days AS t, sum(event_converted) AS d, count(*) AS c FROM survival_input GROUP BY ALL
        UNION ALL
        SELECT 'industry', industry, duration_days, sum(event_converted), count(*) FROM survival_input GROUP BY ALL"""),
    ("km_risk", "SELECT *, sum(c) OVER (PARTITION BY dim, seg ORDER BY t DESC) AS at_risk FROM km_days"),
    ("km", "SELECT *, product(1 - CAST(d AS DOUBLE) / at_risk) OVER (PARTITION BY dim, seg ORDER BY t) AS s FROM km_risk"),
    ("km_medians", """
        SELECT dim, seg, min(CASE WHEN s <= 0.5 THEN t END) AS median_days, CAST(sum(c) AS BIGINT) AS n, CAST(sum(d) AS BIGINT) AS events
        FROM km GROUP BY dim, seg"""),
    # value
    ("industry_medians", "SELECT industry, quantile_cont(deal_value, 0.5) AS m FROM lead_summary WHERE deal_value > 0 GROUP BY industry"),
    ("priced", """
        SELECT l.lead_id, l.industry, l.lead_source, l.region,
               coalesce(s.conversion_probability, (SELECT avg(conversion_probability) FROM rule_outputs)) AS conversion_probability,
               CASE WHEN l.deal_value > 0 THEN l.deal_value
                    ELSE coalesce(m.m, (SELECT quantile_cont(deal_value, 0.5) FROM lead_summary WHERE deal_value > 0)) END AS effective_deal_value,
               NOT coalesce(l.deal_value > 0, false) AS used_imputed_deal,
               CASE WHEN k.median_days / 365.25 > 0 THEN k.median_days / CAST(365.25 AS DOUBLE) ELSE CAST(5 AS DOUBLE) END AS median_years
        FROM lead_summary l LEFT JOIN rule_outputs s ON s.lead_id = l.lead_id
        LEFT JOIN industry_medians m ON m.industry = l.industry
        LEFT JOIN survival_input v ON v.lead_id = l.lead_id
        LEFT JOIN km_medians k ON k.dim = 'lead_source' AND k.seg = v.lead_source"""),
    ("valued", """
        SELECT *, exp(-CAST(0.1 AS DOUBLE) * median_years) AS discount_factor,
               conversion_probability * effective_deal_value AS clv_undiscounted,
               conversion_probability * effective_deal_value * exp(-CAST(0.1 AS DOUBLE) * median_years) AS clv_discounted
        FROM priced"""),
    ("value_cuts", "SELECT quantile_cont(clv_discounted, 0.5) AS q50, quantile_cont(clv_discounted, 0.8) AS q80, quantile_cont(clv_discounted, 0.9) AS q90 FROM valued"),
    ("clv", """
        SELECT *, CASE WHEN clv_discounted IS NULL THEN 'Unscored' WHEN clv_discounted >= (SELECT q80 FROM value_cuts) THEN 'High'
                       WHEN clv_discounted >= (SELECT q50 FROM value_cuts) THEN 'Medium' ELSE 'Low' END AS clv_tier
        FROM valued"""),
    ("clv_detail", """
        SELECT c.*, s.risk_tier, l.event_converted FROM clv c LEFT JOIN rule_outputs s ON s.lead_id = c.lead_id
        LEFT JOIN lead_summary l ON l.lead_id = c.lead_id"""),
    # uplift
    ("cohort", """
        SELECT lead_id, treatment_group, event_converted, total_activities, company_size, industry, lead_source, region, job_title
        FROM lead_summary WHERE received_campaign AND treatment_group IN ('Treatment', 'Control')"""),
    ("arm_all", """
        SELECT avg(CASE WHEN treatment_group = 'Treatment' THEN event_converted END) AS rt,
               avg(CASE WHEN treatment_group = 'Control' THEN event_converted END) AS rc FROM cohort"""),
    ("arm_cells", f"""
        SELECT lead_source, industry,
               {_p6("(sum(CASE WHEN treatment_group = 'Treatment' THEN event_converted ELSE 0 END) + 10 * any_value(rt)) / CAST(count(*) FILTER (WHERE treatment_group = 'Treatment') + 10 AS DOUBLE)")} AS p_treatment,
               {_p6("(sum(CASE WHEN treatment_group = 'Control' THEN event_converted ELSE 0 END) + 10 * any_value(rc)) / CAST(count(*) FILTER (WHERE treatment_group = 'Control') + 10 AS DOUBLE)")} AS p_control
        FROM cohort, arm_all GROUP BY lead_source, industry"""),
    ("uplift", f"""
        SELECT c.lead_id, c.treatment_group, c.event_converted, c.industry, c.lead_source, c.region, a.p_treatment, a.p_control,
               {_p6('a.p_treatment - a.p_control')} AS uplift
        FROM cohort c JOIN arm_cells a ON a.lead_source = c.lead_source AND a.industry = c.industry"""),
    ("uplift_seg", """
        SELECT *, CASE WHEN uplift >= 0.05 THEN 'Persuadable' WHEN uplift <= -0.05 THEN 'Do Not Disturb'
                       WHEN p_control >= (SELECT quantile_cont(p_control, 0.5) FROM uplift) THEN 'Sure Thing' ELSE 'Lost Cause' END AS uplift_segment
        FROM uplift"""),
    ("uplift_valued", "SELECT u.*, l.deal_value FROM uplift_seg u LEFT JOIN lead_summary l ON l.lead_id = u.lead_id"),
    # proxy risk
    ("rank_input", """
        SELECT *, CAST(coalesce(duration_days, (SELECT quantile_cont(duration_days, 0.5) FROM portfolio)) AS DOUBLE) AS dd FROM portfolio"""),
    ("ranked", """
        SELECT *, (rank() OVER (ORDER BY total_activities) + (count(*) OVER (PARTITION BY total_activities) - 1) / CAST(2 AS DOUBLE)) / count(*) OVER () AS activity_rank,
                  (rank() OVER (ORDER BY dd) + (count(*) OVER (PARTITION BY dd) - 1) / CAST(2 AS DOUBLE)) / count(*) OVER () AS duration_rank
        FROM rank_input"""),
    ("risk_scored", """
        SELECT *, least(greatest(
            CAST(0.45 AS DOUBLE) * CASE status WHEN 'Lost' THEN 1.0 WHEN 'Unqualified' THEN 0.85 WHEN 'New' THEN 0.55 WHEN 'Contacted' THEN 0.45
                            WHEN 'Qualified' THEN 0.30 WHEN 'Converted' THEN 0.10 ELSE 0.5 END
            + CAST(0.20 AS DOUBLE) * (1 - activity_rank) + CAST(0.20 AS DOUBLE) * duration_rank
            + CAST(0.15 AS DOUBLE) * CASE WHEN received_campaign AND (campaign_response IS NULL OR campaign_response IN ('No Response', 'None')) THEN 1 ELSE 0 END,
            0), 1) AS whole_score
        FROM ranked"""),
    ("risks", f"""
        SELECT * EXCLUDE whole_score, {_p6('whole_score')} AS risk_score, whole_score * exposure AS expected_loss FROM (
            SELECT *, CASE WHEN whole_score <= 0.4 THEN 'Low' WHEN whole_score <= 0.7 THEN 'Medium' ELSE 'High' END AS risk_tier,
                   CASE WHEN deal_value > 0 THEN deal_value ELSE coalesce((SELECT avg(deal_value) FROM portfolio WHERE deal_value > 0), 0) END AS exposure
            FROM risk_scored)"""),
    # countries
    ("countries", """
        SELECT l.country, l.region, CAST(count(*) AS BIGINT) AS total_leads, CAST(sum(l.event_converted) AS BIGINT) AS conversions,
               avg(CAST(l.event_converted AS DOUBLE)) AS conversion_rate, avg(l.deal_value) AS avg_deal_value, sum(l.deal_value) AS total_deal_value,
               CAST(count(*) FILTER (WHERE s.risk_tier = 'High') AS BIGINT) AS high_risk_count,
               avg(c.clv_discounted) AS avg_clv, sum(c.clv_discounted) AS total_clv
        FROM lead_summary l LEFT JOIN rule_outputs s ON s.lead_id = l.lead_id LEFT JOIN clv c ON c.lead_id = l.lead_id
        GROUP BY l.country, l.region HAVING count(*) > 0"""),
    ("arm_summary", """
        SELECT treatment_group, CAST(count(*) AS BIGINT) AS leads, CAST(count(*) FILTER (WHERE status = 'Converted') AS BIGINT) AS conversions,
               sum(CASE WHEN opportunity_stage = 'Closed-Won' THEN deal_value ELSE 0 END) AS won_revenue,
               count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE) AS conversion_rate
        FROM campaign GROUP BY treatment_group"""),
    ("source_uplift", """
        SELECT lead_source, c AS control_rate, t AS treatment_rate, t - c AS uplift_pp FROM (
            SELECT lead_source,
                   100 * avg(CASE WHEN treatment_group = 'Control' THEN CASE WHEN status = 'Converted' THEN 1 ELSE 0 END END) AS c,
                   100 * avg(CASE WHEN treatment_group = 'Treatment' THEN CASE WHEN status = 'Converted' THEN 1 ELSE 0 END END) AS t
            FROM campaign GROUP BY lead_source) WHERE t - c IS NOT NULL"""),
    ("checks", """
        SELECT CAST(count(*) AS BIGINT) AS total_leads, CAST(count(*) FILTER (WHERE lead_id IS NULL) AS BIGINT) AS missing_lead_ids,
               CAST(count(*) FILTER (WHERE company_name IS NULL OR trim(company_name) = '') AS BIGINT) AS missing_company_names,
               CAST(count(*) FILTER (WHERE region IS NULL OR trim(region) = '') AS BIGINT) AS missing_regions,
               CAST(count(*) FILTER (WHERE status IS NULL OR trim(status) = '') AS BIGINT) AS missing_statuses,
               CAST(count(*) FILTER (WHERE deal_value < 0) AS BIGINT) AS negative_deal_values
        FROM lead_summary"""),
]

_LAYERS = {
    "Bronze": ["raw_leads", "raw_opportunities", "raw_activities", "raw_campaign_touches"],
    "Silver": ["leads_clean", "opportunities_clean", "activities_clean", "campaign_touches_clean"],
    "Gold": ["dim_leads", "fact_opportunities", "fact_activities", "fact_campaign_touches", "lead_summary"],
}
_CTES.insert(13, ("dim_leads", f"SELECT {LEAD} FROM leads_clean"))

_PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _CTES) + "\n"

_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{t}' AS table_name, {_n('count(*)')} AS row_count FROM {t}"
    for layer, tables in _LAYERS.items() for t in tables)

_KEYS = [
    ("raw_leads", "lead_id"), ("raw_opportunities", "opportunity_id"), ("raw_activities", "activity_id"),
    ("raw_campaign_touches", "touch_id"), ("leads_clean", "lead_id"), ("opportunities_clean", "opportunity_id"),
    ("activities_clean", "activity_id"), ("campaign_touches_clean", "touch_id"), ("dim_leads", "lead_id"),
    ("fact_activities", "activity_id"), ("fact_opportunities", "opportunity_id"), ("fact_campaign_touches", "touch_id"),
    ("lead_summary", "lead_id"), ("rule_outputs", "lead_id"), ("clv", "lead_id"), ("uplift", "lead_id"), ("survival_input", "lead_id"),
    ("opportunities_clean", "lead_id"), ("campaign_touches_clean", "lead_id"),
]
_PUBLIC = {"rule_outputs": "ml_lead_scores", "clv": "ml_clv_predictions", "uplift": "ml_uplift_predictions", "survival_input": "ml_survival_predictions"}
_PK = " UNION ALL ".join(
    f"SELECT '{_PUBLIC.get(t, t)}' AS table_name, '{k}' AS key_column, CAST({k} AS VARCHAR) AS key_value, {_n('count(*)')} AS copies "
    f"FROM {t} GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL" for t, k in _KEYS)

_LEAD_REFS = [
    "raw_opportunities", "raw_activities", "raw_campaign_touches", "opportunities_clean", "activities_clean",
    "campaign_touches_clean", "fact_opportunities", "fact_activities", "fact_campaign_touches",
]
_DATE_REFS = [
    ("dim_leads", "created_date"), ("fact_activities", "date_id"), ("fact_campaign_touches", "date_id"),
    ("fact_opportunities", "open_date_id"), ("fact_opportunities", "expected_close_date_id"),
    ("fact_opportunities", "actual_close_date_id"),
]
_FK = " UNION ALL ".join(
    [
        f"SELECT '{t}' AS table_name, 'lead_id' AS ref_column, lead_id AS ref_value, {_n('count(*)')} AS rows FROM {t} "
        f"WHERE lead_id IS NOT NULL AND lead_id NOT IN (SELECT lead_id FROM dim_leads) GROUP BY lead_id" for t in _LEAD_REFS
    ] + [
        f"SELECT '{t}', '{c}', CAST({c} AS VARCHAR), {_n('count(*)')} FROM {t} "
        f"WHERE {c} < DATE '1994-01-01' OR {c} > DATE '2024-12-31' GROUP BY {c}" for t, c in _DATE_REFS
    ])

_LIMITS = {
    "raw_leads": {"lead_id": 20, "contact_name": 150, "company_name": 150, "industry": 50, "company_size": 50, "lead_source": 50, "job_title": 100, "country": 100, "region": 50, "status": 50},
    "raw_opportunities": {"opportunity_id": 20, "lead_id": 20, "stage": 50, "owner": 150},
    "raw_activities": {"activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50},
    "raw_campaign_touches": {"touch_id": 20, "lead_id": 20, "campaign_id": 20, "response": 50, "treatment_group": 20},
    "leads_clean": {"lead_id": 20, "contact_name": 150, "company_name": 150, "industry": 50, "lead_source": 50, "job_title": 100, "country": 100, "region": 50, "status": 50},
    "opportunities_clean": {"opportunity_id": 20, "lead_id": 20, "stage": 50, "owner": 150},
    "activities_clean": {"activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50},
    "activities_rejected": {"activity_id": 20, "lead_id": 20, "activity_type": 50, "channel": 50, "outcome": 50, "rejection_reason": 100},
    "campaign_touches_clean": {"touch_id": 20, "lead_id": 20, "campaign_id": 20, "response": 50, "treatment_group": 20},
}
_LENGTHS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({n} AS INTEGER) AS length_limit, "
    f"CAST(coalesce(max(length({c})), 0) AS INTEGER) AS longest, {_n(f'count(*) FILTER (WHERE length({c}) > {n})')} AS too_long FROM {t}"
    for t, columns in _LIMITS.items() for c, n in columns.items())

_COUNTERS = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, 'rows_in' AS metric, {_n('count(*)')} AS value FROM {t}" for t in _LAYERS["Bronze"]]
    + [f"SELECT '{t}', 'rows_out', {_n('count(*)')} FROM {t}" for t in [*_LAYERS["Silver"], "activities_rejected"]]
    + [
        f"SELECT 'leads_clean', 'company_size_missing', {_n('count(*) FILTER (WHERE company_size_missing)')} FROM leads_clean",
        f"SELECT 'opportunities_clean', 'deal_value_outlier', {_n('count(*) FILTER (WHERE deal_value_outlier)')} FROM opportunities_clean",
    ])


def _tiers(table: str, column: str, tiers: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{t}' AS {column}, {_n(f'count(*) FILTER (WHERE {column} = {chr(39)}{t}{chr(39)})')} AS leads FROM {table}"
        for i, t in enumerate(tiers))


def _histogram(table: str, value: str, bins: int, colour: str | None = None) -> str:
    extra = f", {colour}" if colour else ""
    return f"""
        SELECT bin{extra}, {_n('count(*)')} AS leads, {_r6(f'any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / {bins})')} AS bin_start
        FROM (SELECT CAST(least(CASE WHEN hi > lo THEN floor(({value} - lo) / (hi - lo) * {bins}) ELSE 0 END, {bins - 1}) AS INTEGER) AS bin, lo, hi{extra}
              FROM {table}, (SELECT min({value}) AS lo, max({value}) AS hi FROM {table}))
        GROUP BY bin{extra}"""


def _clv_by(key: str) -> str:
    return f"""SELECT {key}, {_r2('avg(clv_discounted)')} AS mean_clv, {_r2('sum(clv_discounted)')} AS total_clv,
               {_n('count(*)')} AS n FROM clv GROUP BY {key}"""


def _conv_by(key: str) -> str:
    return f"""SELECT {key}, {_n('count(*)')} AS leads, {_n("count(*) FILTER (WHERE status = 'Converted')")} AS conversions,
               {_r6("count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE)")} AS conversion_rate
               FROM portfolio GROUP BY {key}"""


def _km_by(dim: str) -> str:
    return f"SELECT seg AS {dim}, {_r6('median_days')} AS median_days, n, events FROM km_medians WHERE dim = '{dim}'"


def _cox_columns() -> str:
    levels = {
        "lead_source": ["LinkedIn", "Referral", "Trade Show", "Webinar", "Website"],
        "industry": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "region": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    }
    return ", ".join(
        f'CAST(CASE WHEN {c} = \'{v}\' THEN 1 ELSE 0 END AS DOUBLE) AS "{c}_{v}"' for c, vs in levels.items() for v in vs)


_UPLIFT_COLUMNS = "lead_id, industry, lead_source, region, round(deal_value, 2) AS deal_value, p_control, p_treatment, uplift, event_converted"
_CLV_ROUNDED = (
    f"lead_id, industry, lead_source, region, {_r6('conversion_probability')} AS conversion_probability, "
    f"{_r2('effective_deal_value')} AS effective_deal_value, {_r6('median_years')} AS median_years, "
    f"{_r6('discount_factor')} AS discount_factor, {_r2('clv_discounted')} AS clv_discounted, clv_tier"
)
_RISK = (
    f"lead_id, company_name, industry, region, status, total_activities, duration_days, risk_score, risk_tier, "
    f"{_r2('expected_loss')} AS expected_loss"
)


def _scaled(column: str) -> str:
    source = f"(SELECT lead_id, coalesce(CAST({column} AS DOUBLE), (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.5) FROM lead_summary)) AS x FROM lead_summary)"
    return (
        f"(SELECT lead_id, {_r6(f'(x - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END')} AS {column} FROM {source}, "
        f"(SELECT avg(x) AS m, stddev_pop(x) AS sd FROM {source}))"
    )


_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_MODEL_COLUMNS = ["intercept", "total_activities", "company_size", "received_campaign", *[f"region_{r}" for r in _REGIONS]]


def _standard(column: str) -> str:
    """The filled and standardised column as a lateral pair of subqueries over lead_summary."""
    number = f"CAST(CAST({column} AS INTEGER) AS DOUBLE)"
    filled = f"coalesce({number}, (SELECT quantile_cont({number}, 0.5) FROM lead_summary))"
    return f"({filled} - (SELECT avg({filled}) FROM lead_summary)) / (SELECT CASE WHEN stddev_pop({filled}) = 0 THEN 1 ELSE stddev_pop({filled}) END FROM lead_summary)"


def _logistic(select: str, steps: int = 12) -> str:
    """Newton's method for the logistic model with an L2 penalty of 1: each step sums derivatives over the rows, then
    eliminates column by column and substitutes back."""
    p = len(_MODEL_COLUMNS)
    design = ["CAST(1 AS DOUBLE)", *[_standard(c) for c in _MODEL_COLUMNS[1:4]], *[f"CASE WHEN region = '{r}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END" for r in _REGIONS]]
    rows = "SELECT lead_id, CAST(event_converted AS DOUBLE) AS y, " + ", ".join(f"{d} AS x{i}" for i, d in enumerate(design)) + " FROM lead_summary"
    betas = ", ".join(f"b{i}" for i in range(p))
    eta = " + ".join(f"b{i} * x{i}" for i in range(p))
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    level = (
        f"SELECT step, {betas}, " + ", ".join(f"sum(q * (1 - q) * x{i} * x{j}){' + 1' if i == j and i else ''} AS a{i}_{j}" for i, j in upper) + ", "
        + ", ".join(f"sum((y - q) * x{i}){f' - b{i}' if i else ''} AS g{i}" for i in range(p))
        + f" FROM (SELECT n.*, r.*, 1 / (1 + exp(-({eta}))) AS q FROM newton n, model_rows r WHERE n.step < {steps}) GROUP BY step, {betas}")
    for k in range(p):
        kept = [f"a{i}_{j}" if i <= k else f"a{i}_{j} - a{k}_{i} / a{k}_{k} * a{k}_{j} AS a{i}_{j}" for i, j in upper]
        right = [f"g{i}" if i <= k else f"g{i} - a{k}_{i} / a{k}_{k} * g{k} AS g{i}" for i in range(p)]
        level = f"SELECT step, {betas}, {', '.join(kept)}, {', '.join(right)} FROM ({level})"
    for k in reversed(range(p)):
        known = " - ".join([f"g{k}", *[f"a{k}_{j} * d{j}" for j in range(k + 1, p)]])
        level = f"SELECT *, ({known}) / a{k}_{k} AS d{k} FROM ({level})"
    moved = ", ".join(f"b{i} + d{i} AS b{i}" for i in range(p))
    start = ", ".join(f"CAST(0 AS DOUBLE) AS b{i}" for i in range(p))
    prefix = _PREFIX.replace("WITH ", "WITH RECURSIVE ", 1)
    return (
        f"{prefix}, model_rows AS MATERIALIZED ({rows}),\nnewton AS (SELECT 0 AS step, {start} UNION ALL SELECT step + 1, {moved} FROM ({level})),\n"
        f"fitted AS (SELECT * FROM newton WHERE step = {steps})\n{select.format(eta=eta)}")


_COEFFICIENTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_r6(f'b{i}')} AS coefficient FROM fitted" for i, c in enumerate(_MODEL_COLUMNS))
_LOGISTIC_SCORES = "SELECT lead_id, " + _r6("1 / (1 + exp(-({eta})))") + " AS conversion_probability FROM model_rows, fitted"

_RULE_LINES = """
    SELECT tp, fp, fn, tn,
           coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0, coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
           coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
           (tp + tn) / (tp + fp + fn + tn) AS right_share, tn + fp AS n0, tp + fn AS n1
    FROM (SELECT CAST(count(*) FILTER (WHERE conversion_probability > 0.2 AND event_converted = 1) AS DOUBLE) AS tp,
                 CAST(count(*) FILTER (WHERE conversion_probability > 0.2 AND event_converted = 0) AS DOUBLE) AS fp,
                 CAST(count(*) FILTER (WHERE conversion_probability <= 0.2 AND event_converted = 1) AS DOUBLE) AS fn,
                 CAST(count(*) FILTER (WHERE conversion_probability <= 0.2 AND event_converted = 0) AS DOUBLE) AS tn FROM rule_scores)"""


def _report_line(name: str, precision: str, recall: str, f1: str, support: str) -> str:
    return (f"SELECT '{name}' AS line, round({precision}, 4) AS precision, round({recall}, 4) AS recall, round({f1}, 4) AS f1, "
            f"{_n(support)} AS support FROM ({_RULE_LINES})")


_RULE_MEDIANS = """
    SELECT lead_id, lead_source, round(CASE WHEN events > 0 THEN ln(2) * days / events END, 6) AS d
    FROM (SELECT lead_id, lead_source, CAST(sum(duration_days) OVER g AS DOUBLE) AS days, sum(event_converted) OVER g AS events
          FROM survival_input WINDOW g AS (PARTITION BY lead_source, industry))"""

_SELECTS: dict[str, str] = {
    "csv_activities": f"SELECT {ACT}, {_n('row_number() OVER (ORDER BY ingest_seq) - 1')} AS ingest_seq FROM raw_activities",
    "rule_auc": f"""
        SELECT {_n('sum(y)')} AS positives, {_n('sum(1 - y)')} AS negatives, {_r6('(sum(rank * y) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y))')} AS auc
        FROM (SELECT CAST(event_converted AS DOUBLE) AS y,
                     rank() OVER (ORDER BY conversion_probability) + (count(*) OVER (PARTITION BY conversion_probability) - 1) / 2.0 AS rank FROM rule_scores)""",
    "rule_class_report": " UNION ALL ".join([
        _report_line("0", "p0", "r0", "f0", "n0"), _report_line("1", "p1", "r1", "f1", "n1"),
        _report_line("accuracy", "right_share", "right_share", "right_share", "n0 + n1"),
        _report_line("macro avg", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n0 + n1"),
        _report_line("weighted avg", *[f"(n0 * {m}0 + n1 * {m}1) / (n0 + n1)" for m in "prf"], "n0 + n1")]),
    "rule_prediction_stats": f"""
        SELECT {_n('count(*)')} AS leads, {_n('count(d)')} AS reached, {_r6('count(d) / CAST(count(*) AS DOUBLE)')} AS share_reached,
               {_r6('quantile_cont(d / 365.25, 0.5)')} AS median_years, {_r6('quantile_cont(d / 365.25, 0.1)')} AS fastest_tenth_years FROM ({_RULE_MEDIANS})""",
    "rule_fastest_leads": f"""
        SELECT m.lead_id, s.lead_source, s.industry, s.region, {_r6('m.d')} AS predicted_median_days, {_r6('m.d / 365.25')} AS predicted_years,
               s.duration_days, s.event_converted
        FROM (SELECT * FROM ({_RULE_MEDIANS}) WHERE d IS NOT NULL ORDER BY d, lead_id LIMIT 10) m JOIN lead_summary s ON s.lead_id = m.lead_id""",
    "rule_prediction_histogram": _histogram(f"(SELECT lead_id, lead_source, d AS predicted_median_days FROM ({_RULE_MEDIANS}))", "predicted_median_days", 50, "lead_source"),
    "bronze_leads": "SELECT * FROM raw_leads",
    "bronze_opportunities": "SELECT * FROM raw_opportunities",
    "bronze_activities": "SELECT * FROM raw_activities",
    "bronze_campaign_touches": "SELECT * FROM raw_campaign_touches",
    "silver_leads": "SELECT * FROM leads_clean",
    "silver_opportunities": "SELECT * FROM opportunities_clean",
    "silver_activities": "SELECT * FROM activities_clean",
    "silver_touches": "SELECT * FROM campaign_touches_clean",
    "activities_rejected": "SELECT * FROM activities_rejected",
    "cleaning_report": _COUNTERS,
    "reject_profile": f"SELECT rejection_reason, CAST(date_trunc('week', activity_date) AS DATE) AS week_start, {_n('count(*)')} AS rejects FROM activities_rejected GROUP BY 1, 2",
    "dim_time": """
        SELECT d AS date_id, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               rpad(monthname(d), 9, ' ') AS month_name, CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
               rpad(dayname(d), 9, ' ') AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) AS TIMESTAMP), CAST(date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(d) AS lo, max(d) AS hi FROM (
                    SELECT created_date AS d FROM raw_leads UNION ALL SELECT open_date FROM raw_opportunities
                    UNION ALL SELECT expected_close_date FROM raw_opportunities UNION ALL SELECT actual_close_date FROM raw_opportunities
                    UNION ALL SELECT activity_date FROM raw_activities UNION ALL SELECT touch_date FROM raw_campaign_touches)))""",
    "dim_leads": "SELECT * FROM dim_leads",
    "fact_activities": "SELECT * FROM fact_activities",
    "fact_opportunities": "SELECT * FROM fact_opportunities",
    "fact_campaign_touches": "SELECT * FROM fact_campaign_touches",
    "lead_summary": "SELECT * FROM lead_summary",
    "survival_input": "SELECT * FROM survival_input",
    "lead_summary_scored": "SELECT l.*, s.conversion_probability, s.risk_tier, s.expected_loss FROM lead_summary l LEFT JOIN rule_outputs s ON s.lead_id = l.lead_id",
    "pk_violations": _PK,
    "fk_violations": _FK,
    "required_values": f"""
        SELECT 'leads_clean' AS table_name, 'company_size_missing' AS column_name, {_n('count(*) FILTER (WHERE company_size_missing IS NULL)')} AS nulls FROM leads_clean
        UNION ALL SELECT 'opportunities_clean', 'deal_value_outlier', {_n('count(*) FILTER (WHERE deal_value_outlier IS NULL)')} FROM opportunities_clean""",
    "text_lengths": _LENGTHS,
    "row_counts": _ROW_COUNTS,
    "layer_totals": f"SELECT layer, {_n('sum(row_count)')} AS row_count FROM ({_ROW_COUNTS}) GROUP BY layer",
    "quality_checks": "SELECT * FROM checks",
    "quality_issue_list": " UNION ALL ".join([
        f"SELECT '{label}' AS check_name, {_n(c)} AS issues FROM checks" for label, c in {
            "Missing Lead IDs": "missing_lead_ids", "Missing Company Names": "missing_company_names",
            "Missing Regions": "missing_regions", "Missing Statuses": "missing_statuses",
            "Negative Deal Values": "negative_deal_values",
            "Total": "missing_lead_ids + missing_company_names + missing_regions + missing_statuses + negative_deal_values"}.items()]),
    "scoring_features": """
        SELECT lead_id, CAST(total_activities AS DOUBLE) AS total_activities, CAST(company_size AS DOUBLE) AS company_size,
               CAST(CAST(received_campaign AS INTEGER) AS DOUBLE) AS received_campaign, industry, lead_source, region, job_title,
               treatment_group, campaign_response, event_converted, coalesce(deal_value, 0) AS deal_value FROM lead_summary""",
    "target_distribution": f"SELECT event_converted, {_n('count(*)')} AS n, {_r6('count(*) / CAST((SELECT count(*) FROM lead_summary) AS DOUBLE)')} AS share FROM lead_summary GROUP BY event_converted",
    "imputed_features": f"SELECT a.lead_id, total_activities, company_size, received_campaign FROM {_scaled('total_activities')} a JOIN {_scaled('company_size')} b ON a.lead_id = b.lead_id JOIN {_scaled('received_campaign').replace('CAST(received_campaign AS DOUBLE)', 'CAST(CAST(received_campaign AS INTEGER) AS DOUBLE)')} c ON a.lead_id = c.lead_id",
    "class_weights": f"""
        SELECT event_converted, {_n('count(*)')} AS n,
               {_r6('(SELECT count(*) FROM lead_summary) / CAST((SELECT count(DISTINCT event_converted) FROM lead_summary) * count(*) AS DOUBLE)')} AS balanced_weight,
               {_r6('CASE WHEN event_converted = 1 THEN (SELECT count(*) FILTER (WHERE event_converted = 0) / CAST(count(*) FILTER (WHERE event_converted = 1) AS DOUBLE) FROM lead_summary) ELSE CAST(1 AS DOUBLE) END')} AS boosting_weight
        FROM lead_summary GROUP BY event_converted""",
    "confusion_metrics": """
        SELECT tp, fp, fn, tn, round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 4) AS accuracy,
               round(coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0), 4) AS precision,
               round(coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0), 4) AS recall,
               round(coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0), 4) AS f1
        FROM (SELECT CAST(count(*) FILTER (WHERE conversion_probability > 0.2 AND event_converted = 1) AS BIGINT) AS tp,
                     CAST(count(*) FILTER (WHERE conversion_probability > 0.2 AND event_converted = 0) AS BIGINT) AS fp,
                     CAST(count(*) FILTER (WHERE conversion_probability <= 0.2 AND event_converted = 1) AS BIGINT) AS fn,
                     CAST(count(*) FILTER (WHERE conversion_probability <= 0.2 AND event_converted = 0) AS BIGINT) AS tn FROM rule_scores)""",
    "risk_tiers": "SELECT lead_id, conversion_probability, risk_tier FROM rule_outputs",
    "tier_thresholds": f"SELECT {_r6('q20')} AS q20, {_r6('q80')} AS q80 FROM tier_cuts",
    "expected_loss": "SELECT lead_id, expected_loss FROM rule_outputs",
    "risk_tier_counts": _tiers("rule_outputs", "risk_tier", ["Low", "Medium", "High"]),
    "survival_cohort": f"SELECT {_n('count(*)')} AS leads, {_n('sum(event_converted)')} AS events, {_r6('avg(event_converted)')} AS event_rate, {_r6('quantile_cont(duration_days, 0.5)')} AS median_duration FROM survival_input",
    "km_curve": f"SELECT seg AS lead_source, t AS duration_days, {_n('d')} AS deaths, {_n('c')} AS leaving, {_n('at_risk')} AS at_risk, {_r6('s')} AS survival FROM km WHERE dim = 'lead_source'",
    "km_by_lead_source": _km_by("lead_source"),
    "km_by_industry": _km_by("industry"),
    "cox_design": f"""
        SELECT lead_id, duration_days, event_converted, coalesce(company_size, (SELECT quantile_cont(company_size, 0.5) FROM survival_input)) AS company_size,
               CAST(total_activities AS DOUBLE) AS total_activities, CAST(received_campaign AS DOUBLE) AS received_campaign, {_cox_columns()}
        FROM survival_input""",
    "concordance": f"""
        SELECT concordant, tied, comparable, {_r6('(concordant + tied / 2) / comparable')} AS c_index FROM (
            SELECT CAST(count(*) FILTER (WHERE a.s > b.s) AS DOUBLE) AS concordant, CAST(count(*) FILTER (WHERE a.s = b.s) AS DOUBLE) AS tied,
                   CAST(count(*) AS DOUBLE) AS comparable
            FROM (SELECT v.duration_days AS d, r.conversion_probability AS s FROM survival_input v JOIN rule_scores r ON r.lead_id = v.lead_id WHERE v.event_converted = 1) a
            JOIN (SELECT v.duration_days AS d, v.event_converted AS e, r.conversion_probability AS s FROM survival_input v JOIN rule_scores r ON r.lead_id = v.lead_id) b
              ON b.d > a.d OR (b.d = a.d AND b.e = 0))""",
    "deal_medians": f"SELECT industry, {_r2('m')} AS segment_median FROM industry_medians",
    "clv": f"SELECT {_CLV_ROUNDED}, used_imputed_deal, {_r2('clv_undiscounted')} AS clv_undiscounted, CAST(0.1 AS DOUBLE) AS discount_rate FROM clv",
    "clv_summary": f"""
        SELECT {_n('count(*)')} AS total_leads, {_n('count(conversion_probability)')} AS leads_with_probability,
               {_n('count(*) FILTER (WHERE used_imputed_deal)')} AS imputed_deals, {_r2('sum(clv_discounted)')} AS total_clv,
               {_r2('avg(clv_discounted)')} AS mean_clv, {_r2('max(clv_discounted)')} AS max_clv, {_r2('(SELECT q50 FROM value_cuts)')} AS median_clv,
               {_r2('(SELECT q80 FROM value_cuts)')} AS q80_clv, {_r2('(SELECT q90 FROM value_cuts)')} AS p90_clv FROM clv""",
    "clv_tier_counts": _tiers("clv", "clv_tier", ["High", "Medium", "Low", "Unscored"]),
    "campaign_cohort": "SELECT * FROM cohort",
    "arm_outcomes": f"SELECT treatment_group, event_converted, {_n('count(*)')} AS n FROM cohort GROUP BY 1, 2",
    "arm_rates": f"SELECT treatment_group, {_r6('avg(event_converted)')} AS conv_rate, {_n('count(*)')} AS n FROM cohort GROUP BY 1",
    "uplift_stats": f"SELECT {_r6('avg(uplift)')} AS mean_uplift, {_r6('quantile_cont(uplift, 0.5)')} AS median_uplift, {_r6('quantile_cont(uplift, 0.9)')} AS p90_uplift, {_r6('quantile_cont(uplift, 0.1)')} AS p10_uplift FROM uplift",
    "uplift_segments": "SELECT * FROM uplift_seg",
    "uplift_summary": f"""
        SELECT {_n('count(*)')} AS n_leads, {_r6('avg(uplift)')} AS mean_uplift,
               {_r6("avg(CASE WHEN uplift_segment = 'Persuadable' THEN CAST(1 AS DOUBLE) ELSE 0 END)")} AS share_persuadable,
               {_r6("avg(CASE WHEN uplift_segment = 'Do Not Disturb' THEN CAST(1 AS DOUBLE) ELSE 0 END)")} AS share_do_not_disturb,
               {_n("count(*) FILTER (WHERE uplift_segment = 'Persuadable')")} AS n_persuadable, {_n("count(*) FILTER (WHERE uplift_segment = 'Sure Thing')")} AS n_sure_thing,
               {_n("count(*) FILTER (WHERE uplift_segment = 'Lost Cause')")} AS n_lost_cause, {_n("count(*) FILTER (WHERE uplift_segment = 'Do Not Disturb')")} AS n_do_not_disturb,
               {_r6('quantile_cont(uplift, 0.5)')} AS median_uplift FROM uplift_seg""",
    "qini_curve": f"""
        SELECT {_r6('f')} AS fraction, n, {_r6('q')} AS qini, {_r6('f * last_value(q) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')} AS random FROM (
            SELECT f, k AS n, sum(CASE WHEN pos <= k AND treatment_group = 'Treatment' THEN event_converted ELSE 0 END)
                   - sum(CASE WHEN pos <= k AND treatment_group = 'Control' THEN event_converted ELSE 0 END) * (any_value(nt) / CAST(any_value(nc) AS DOUBLE)) AS q
            FROM (SELECT f, CAST(floor(f * n) AS BIGINT) AS k, nt, nc FROM
                    (SELECT CASE WHEN i = 24 THEN CAST(1 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) + i * (CAST(0.95 AS DOUBLE) / 24) END AS f FROM (SELECT unnest(range(25)) AS i)),
                    (SELECT count(*) AS n, count(*) FILTER (WHERE treatment_group = 'Treatment') AS nt, count(*) FILTER (WHERE treatment_group = 'Control') AS nc FROM uplift)),
                 (SELECT *, row_number() OVER (ORDER BY uplift DESC, lead_id) AS pos FROM uplift)
            GROUP BY f, k)""",
    "uplift_by_segment": f"SELECT uplift_segment, {_n('count(*)')} AS n, {_r6('avg(uplift)')} AS mean_uplift, {_r6('avg(p_treatment)')} AS mean_p_treatment, {_r6('avg(p_control)')} AS mean_p_control FROM uplift_seg GROUP BY 1",
    "uplift_with_value": "SELECT * FROM uplift_valued",
    "top_persuadable": f"SELECT {_UPLIFT_COLUMNS} FROM uplift_valued WHERE uplift_segment = 'Persuadable' ORDER BY uplift DESC, lead_id LIMIT 25",
    "top_do_not_disturb": f"SELECT {_UPLIFT_COLUMNS} FROM uplift_valued WHERE uplift_segment = 'Do Not Disturb' ORDER BY uplift, lead_id LIMIT 15",
    "lead_projection": "SELECT * FROM portfolio",
    "country_metrics": f"""
        SELECT country, region, total_leads, conversions, {_r6('conversion_rate')} AS conversion_rate, {_r2('avg_deal_value')} AS avg_deal_value,
               {_r2('total_deal_value')} AS total_deal_value, high_risk_count, {_r2('avg_clv')} AS avg_clv, {_r2('total_clv')} AS total_clv FROM countries""",
    "lead_search": "SELECT lead_id, company_name, status FROM portfolio WHERE regexp_matches(lead_id, 'customer#0000000[1-3]|^l10[0-9]$', 'i') OR regexp_matches(company_name, 'customer#0000000[1-3]|^l10[0-9]$', 'i')",
    "customer_kpis": f"""
        SELECT {_n('count(*)')} AS total_customers, {_n("count(*) FILTER (WHERE status = 'Converted')")} AS converted, {_r2('sum(deal_value)')} AS pipeline_value,
               {_r6("count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE)")} AS conversion_rate FROM portfolio""",
    "customer_portfolio": "SELECT lead_id, company_name, industry, company_size, job_title, region, lead_source, total_activities, status, opportunity_stage, deal_value FROM portfolio",
    "funnel": f"""
        SELECT CAST(step AS INTEGER) AS step, stage, leads,
               CASE WHEN step = 0 THEN CAST(0 AS DOUBLE) ELSE round_even((lag(leads) OVER (ORDER BY step) - leads) * 100 / CAST(lag(leads) OVER (ORDER BY step) AS DOUBLE), 1) END AS dropoff_pct
        FROM (SELECT 0 AS step, 'New' AS stage, {_n("count(*) FILTER (WHERE status IN ('New', 'Contacted', 'Qualified', 'Converted'))")} AS leads FROM portfolio
              UNION ALL SELECT 1, 'Contacted', {_n("count(*) FILTER (WHERE status IN ('Contacted', 'Qualified', 'Converted'))")} FROM portfolio
              UNION ALL SELECT 2, 'Qualified', {_n("count(*) FILTER (WHERE status IN ('Qualified', 'Converted'))")} FROM portfolio
              UNION ALL SELECT 3, 'Converted', {_n("count(*) FILTER (WHERE status = 'Converted')")} FROM portfolio)""",
    "funnel_exits": f"SELECT status, {_n('count(*)')} AS leads, {_r6('count(*) / CAST((SELECT count(*) FROM portfolio) AS DOUBLE)')} AS share FROM portfolio WHERE status IN ('Lost', 'Unqualified') GROUP BY status",
    "customer_360": f"SELECT *, {_r2('total_activities - (SELECT avg(total_activities) FROM portfolio)')} AS activities_vs_average FROM portfolio WHERE lead_id = 'L7'",
    "pct_rank": f"SELECT lead_id, total_activities, {_r6('activity_rank')} AS activity_rank, duration_days, {_r6('duration_rank')} AS duration_rank FROM ranked",
    "proxy_risk": f"""
        SELECT lead_id, company_name, industry, company_size, job_title, lead_source, country, region, status, created_date, total_activities,
               received_campaign, campaign_response, treatment_group, opportunity_stage, deal_value, actual_close_date, duration_days,
               {_r6('activity_rank')} AS activity_rank, {_r6('duration_rank')} AS duration_rank, risk_score, risk_tier,
               {_r2('exposure')} AS exposure, {_r2('expected_loss')} AS expected_loss FROM risks""",
    "risk_kpis": f"""
        SELECT {_n('count(*)')} AS total_customers, {_n("count(*) FILTER (WHERE risk_tier = 'High')")} AS high_risk, {_r2('sum(exposure)')} AS total_exposure,
               {_r2('sum(expected_loss)')} AS total_expected_loss, {_r6('avg(risk_score)')} AS avg_risk_score,
               {_r6("count(*) FILTER (WHERE risk_tier = 'High') * 100 / CAST(count(*) AS DOUBLE)")} AS high_risk_rate
        FROM risks WHERE region IN ('ASIA', 'EUROPE') AND risk_tier IN ('Low', 'Medium')""",
    "risk_histogram": _histogram("risks", "risk_score", 25),
    "score_histogram": _histogram("rule_outputs", "conversion_probability", 40, "risk_tier"),
    "clv_histogram": _histogram("(SELECT * FROM clv WHERE clv_discounted > 0)", "clv_discounted", 60, "clv_tier"),
    "uplift_histogram": _histogram("uplift_seg", "uplift", 60, "uplift_segment"),
    "risk_tier_breakdown": _tiers("risks", "risk_tier", ["Low", "Medium", "High"]),
    "uplift_segment_counts": _tiers("uplift_seg", "uplift_segment", ["Persuadable", "Sure Thing", "Lost Cause", "Do Not Disturb"]),
    "risk_by_industry": f"SELECT industry, {_r6('avg(risk_score)')} AS avg_risk FROM risks GROUP BY industry ORDER BY avg(risk_score) DESC, industry LIMIT 8",
    "loss_by_region": f"SELECT region, {_r2('sum(expected_loss)')} AS expected_loss FROM risks GROUP BY region",
    "top_risk": f"SELECT {_RISK} FROM risks ORDER BY risk_score DESC, lead_id LIMIT 15",
    "intervention_summary": f"SELECT treatment_group, leads, conversions, {_r2('won_revenue')} AS won_revenue, {_r6('conversion_rate')} AS conversion_rate FROM arm_summary",
    "intervention_effect": f"""
        SELECT t.leads AS treatment_leads, t.conversions AS treatment_conversions, {_r6('t.conversion_rate')} AS treatment_rate, {_r6('c.conversion_rate')} AS control_rate,
               {_r2('t.won_revenue - c.won_revenue')} AS revenue_difference, {_r6('t.conversion_rate - c.conversion_rate')} AS uplift_pp,
               {_r6('t.conversions - t.leads * c.conversion_rate / 100')} AS additional_conversions
        FROM arm_summary t, arm_summary c WHERE t.treatment_group = 'Treatment' AND c.treatment_group = 'Control'""",
    "response_by_arm": f"SELECT campaign_response, treatment_group, {_n('count(*)')} AS leads FROM campaign WHERE campaign_response IS NOT NULL GROUP BY 1, 2",
    "uplift_by_source": f"SELECT lead_source, {_r6('control_rate')} AS control_rate, {_r6('treatment_rate')} AS treatment_rate, {_r6('uplift_pp')} AS uplift_pp FROM source_uplift",
    "best_source_uplift": f"SELECT lead_source, {_r6('uplift_pp')} AS uplift_pp FROM source_uplift ORDER BY source_uplift.uplift_pp DESC, lead_source LIMIT 1",
    "scored_leads": "SELECT * FROM scored",
    "score_kpis": f"SELECT {_n('count(*)')} AS leads, {_r6('avg(conversion_probability)')} AS mean_probability, {_r2('sum(expected_loss)')} AS total_expected_loss, {_r6('avg(event_converted)')} AS actual_rate FROM scored",
    "calibration": f"""
        SELECT CASE WHEN conversion_probability <= 0.2 THEN '0-20%' WHEN conversion_probability <= 0.4 THEN '20-40%' WHEN conversion_probability <= 0.6 THEN '40-60%'
                    WHEN conversion_probability <= 0.8 THEN '60-80%' ELSE '80-100%' END AS prob_bin,
               {_r6('avg(conversion_probability)')} AS predicted, {_r6('avg(event_converted)')} AS actual, {_n('count(*)')} AS leads
        FROM scored WHERE conversion_probability > 0 GROUP BY 1""",
    "top_leads": "SELECT lead_id, company_name, industry, region, lead_source, job_title, deal_value, conversion_probability, risk_tier, expected_loss, event_converted FROM scored ORDER BY conversion_probability DESC, lead_id LIMIT 25",
    "km_report": f"""
        SELECT seg AS lead_source, {_r6('median_days')} AS median_days, n, events, {_r6('events / CAST(n AS DOUBLE)')} AS conversion_rate,
               {_r6('median_days / 365.25')} AS median_years, median_days IS NOT NULL AS reached FROM km_medians WHERE dim = 'lead_source'""",
    "clv_detail": f"SELECT {_CLV_ROUNDED}, {_r2('clv_undiscounted')} AS clv_undiscounted, risk_tier, event_converted FROM clv_detail",
    "clv_quadrant": f"""
        SELECT industry, lead_source, {_r6('avg(conversion_probability)')} AS mean_prob, {_r2('avg(clv_discounted)')} AS mean_clv, {_n('count(*)')} AS n_leads
        FROM clv GROUP BY industry, lead_source HAVING count(*) >= 20""",
    "top_clv": f"SELECT {_CLV_ROUNDED}, risk_tier, event_converted FROM clv_detail ORDER BY clv_detail.clv_discounted DESC, lead_id LIMIT 25",
    "clv_by_industry": _clv_by("industry"),
    "clv_by_source": _clv_by("lead_source"),
    "best_clv_segments": f"""
        (SELECT 'industry' AS segment_by, industry AS segment, {_r2('avg(clv_discounted)')} AS mean_clv FROM clv GROUP BY industry ORDER BY avg(clv_discounted) DESC LIMIT 1)
        UNION ALL
        (SELECT 'lead_source', lead_source, {_r2('avg(clv_discounted)')} FROM clv GROUP BY lead_source ORDER BY avg(clv_discounted) DESC LIMIT 1)""",
    "map_kpis": f"""
        SELECT {_n('count(*) FILTER (WHERE total_leads > 0)')} AS countries, {_n('sum(total_leads)')} AS total_leads, {_n('sum(conversions)')} AS conversions,
               {_r2('coalesce(sum(total_clv), 0)')} AS total_clv, {_r6('sum(conversions) / CAST(sum(total_leads) AS DOUBLE)')} AS global_conversion FROM countries""",
    "top_countries": "SELECT country, total_leads FROM countries ORDER BY total_leads DESC, country LIMIT 10",
    "top_countries_by_rate": f"SELECT country, {_r6('conversion_rate')} AS conversion_rate FROM countries ORDER BY countries.conversion_rate DESC, country LIMIT 10",
    "top_countries_by_value": f"SELECT country, {_r2('total_clv')} AS total_clv FROM countries ORDER BY countries.total_clv DESC, country LIMIT 10",
    "top_countries_by_risk": "SELECT country, high_risk_count FROM countries ORDER BY high_risk_count DESC, country LIMIT 10",
    "region_rollup": f"""
        SELECT region, {_n('sum(total_leads)')} AS total_leads, {_n('sum(conversions)')} AS conversions,
               {_r6('sum(conversions) / CAST(sum(total_leads) AS DOUBLE)')} AS conversion_rate FROM countries GROUP BY region""",
    "country_drilldown": f"SELECT country, total_leads, conversions, {_r6('conversion_rate')} AS conversion_rate, {_r2('avg_clv')} AS avg_clv FROM countries WHERE country = 'NATION_3'",
    "dashboard_kpis": f"""
        SELECT {_n('count(*)')} AS total_leads, {_n("count(*) FILTER (WHERE status = 'Converted')")} AS converted,
               {_r2("sum(CASE WHEN opportunity_stage = 'Closed-Won' THEN deal_value ELSE 0 END)")} AS won_revenue,
               {_n("count(*) FILTER (WHERE status IN ('Lost', 'Unqualified'))")} AS at_risk, {_n("count(*) FILTER (WHERE risk_tier = 'High')")} AS high_risk,
               {_r6("count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE)")} AS conversion_rate,
               (SELECT {_n('missing_lead_ids + missing_company_names + missing_regions + missing_statuses + negative_deal_values')} FROM checks) AS quality_issues
        FROM risks""",
    "conversion_by_source": _conv_by("lead_source"),
    "overview_kpis": f"""
        SELECT {_n('count(*)')} AS total_leads, {_n("count(*) FILTER (WHERE status = 'Converted')")} AS converted, {_n("count(*) FILTER (WHERE status IN ('Lost', 'Unqualified'))")} AS at_risk,
               {_r2("sum(CASE WHEN opportunity_stage = 'Closed-Won' THEN deal_value END)")} AS won_revenue, {_r2("avg(CASE WHEN opportunity_stage = 'Closed-Won' THEN deal_value END)")} AS avg_won_deal,
               {_r2('sum(deal_value)')} AS exposure, {_r6("count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE)")} AS conversion_rate,
               {_r6("count(*) FILTER (WHERE status IN ('Lost', 'Unqualified')) * 100 / CAST(count(*) AS DOUBLE)")} AS at_risk_rate FROM portfolio""",
    "monthly_trend": f"""
        SELECT CAST(date_trunc('month', created_date) AS DATE) AS month_start, strftime(date_trunc('month', created_date), '%b %Y') AS month, {_n('count(*)')} AS leads,
               {_n("count(*) FILTER (WHERE status = 'Converted')")} AS converted, {_r6("count(*) FILTER (WHERE status = 'Converted') * 100 / CAST(count(*) AS DOUBLE)")} AS conversion_rate
        FROM portfolio GROUP BY 1, 2 ORDER BY 1 DESC LIMIT 12""",
    "status_distribution": f"SELECT status, {_n('count(*)')} AS leads FROM portfolio GROUP BY status",
    "top_industries": f"SELECT industry, {_n('count(*)')} AS leads FROM portfolio GROUP BY industry ORDER BY count(*) DESC, industry LIMIT 5",
    "value_by_region": f"SELECT region, {_r2('avg(deal_value)')} AS avg_value FROM portfolio GROUP BY region",
    "recent_customers": "SELECT lead_id, company_name, industry, region, status, opportunity_stage, deal_value, created_date FROM portfolio ORDER BY created_date DESC, lead_id LIMIT 10",
    "filter_values": " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS filter_name, {c} AS value FROM portfolio WHERE {c} IS NOT NULL"
        for c in ["region", "industry", "lead_source", "treatment_group", "campaign_response"]),
    "conversion_profile": " UNION ALL ".join(
        f"SELECT '{name}' AS profile, {expr} AS value, round(avg(event_converted), 3) AS conversion_rate, {_n('count(*)')} AS leads FROM lead_summary GROUP BY 2"
        for name, expr in {"overall": "'all'", "lead_source": "lead_source", "industry": "industry",
                           "received_campaign": "CAST(received_campaign AS VARCHAR)"}.items()),
}

_SUMMARIES = {
    "risk_tier_counts": ("risk_tier", "leads"), "clv_tier_counts": ("clv_tier", "leads"),
    "uplift_segment_counts": ("uplift_segment", "leads"), "rule_class_report": ("line", "f1")}
_SELECTS["summary_report"] = " UNION ALL ".join([
    *[f"SELECT '{name.removeprefix('rule_')}' AS summary, {label} AS label, {_r6(f'CAST({value} AS DOUBLE)')} AS value FROM ({_SELECTS[name]})"
      for name, (label, value) in _SUMMARIES.items()],
    *[f"SELECT 'risk_tier_thresholds' AS summary, '{q}' AS label, {_r6(q)} AS value FROM tier_cuts" for q in ("q20", "q80")]])
ORACLES = {name: _PREFIX + select for name, select in _SELECTS.items()}
ORACLES |= {"logistic_coefficients": _logistic(_COEFFICIENTS), "logistic_scores": _logistic(_LOGISTIC_SCORES)}
