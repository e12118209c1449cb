"""The same questions in plain SQL over the test tables, written independently."""

from __future__ import annotations

from segrisk.dims import (
    HS_TO_NAICS,
    NAICS_LABELS,
    SECTOR_SHORT_NAMES,
    SERIES_TO_NAICS,
    US_STATES,
    VALID_STATES,
)
from segrisk.workload.facts import PRODUCT_OF_EVENT, SERIES_OF_TYPE, STATE_OF_NATION

ORACLE: dict[str, str] = {}


def _quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _dim(name: str, key: str, value: str, mapping) -> str:
    rows = ", ".join(
        f"({k if isinstance(k, int) else _quoted([k])}, {_quoted([v])})" for k, v in mapping.items()
    )
    return f"{name}({key}, {value}) AS (VALUES {rows})"


DIMS = ",\n".join(
    [
        _dim("state_dim", "nationkey", "code", STATE_OF_NATION),
        _dim("product_dim", "event", "hs_code", PRODUCT_OF_EVENT),
        _dim("hs_dim", "hs_code", "naics_code", HS_TO_NAICS),
        _dim("label_dim", "naics_code", "naics_label", NAICS_LABELS),
        _dim("short_dim", "naics_code", "short_name", SECTOR_SHORT_NAMES),
        _dim("series_dim", "p_type", "series_id", SERIES_OF_TYPE),
        _dim("sector_dim", "series_id", "naics_code", SERIES_TO_NAICS),
        f"us_dim(state) AS (SELECT unnest([{_quoted(US_STATES)}]))",
    ]
)

AWARDS = f"""
award_raw AS (
  SELECT CASE WHEN s_acctbal >= 0 THEN s_name END AS recipient_name,
         CAST(l_extendedprice AS DECIMAL(28,2)) AS amount,
         l_returnflag, l_linenumber, l_suppkey,
         CASE WHEN l_tax = 0 THEN NULL WHEN l_tax = CAST(0.08 AS DOUBLE) THEN 'ZZ'
              WHEN l_returnflag = 'A' THEN ' ' || lower(code) || ' ' ELSE code END AS state_raw,
         CAST(l_shipdate AS DATE) AS start_date
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN state_dim ON s_nationkey = nationkey),
award AS (
  SELECT recipient_name, amount, state_raw, start_date, l_returnflag, l_linenumber, l_suppkey,
         CASE WHEN upper(trim(state_raw)) IN ({_quoted(VALID_STATES)}) THEN upper(trim(state_raw)) END AS state
  FROM award_raw)"""

STATES = """
entity AS (
  SELECT state, recipient_name, coalesce(sum(amount), 0) AS x, count(amount) AS n
  FROM award WHERE state IS NOT NULL GROUP BY state, recipient_name),
state_sum AS (
  SELECT state, CAST(sum(x) AS DOUBLE) AS total, CAST(sum(n) AS BIGINT) AS awards, count(recipient_name) AS names,
         sum(CASE WHEN recipient_name IS NOT NULL THEN CAST(x AS DOUBLE) * CAST(x AS DOUBLE) END) AS squares,
         CAST(sum(CASE WHEN recipient_name IS NOT NULL THEN x END) AS DOUBLE) AS named
  FROM entity GROUP BY state),
state_hhi AS (
  SELECT state, total, awards, names, CASE WHEN squares = 0 THEN 0 ELSE squares / NULLIF(named * named, 0) * 10000 END AS hhi FROM state_sum)"""

TRADE = """
trade AS (
  SELECT hs_code, 'Destination ' || user_id AS country,
         CAST(round_even(value * 100, 0) AS BIGINT) AS raw_value, value >= 1 AS shown
  FROM events JOIN product_dim ON event_type = event),
dest AS (
  SELECT hs_code, country, sum(CASE WHEN shown THEN raw_value ELSE 0 END) AS v FROM trade GROUP BY hs_code, country),
exported AS (
  SELECT naics_code, CAST(sum(v) AS DOUBLE) AS export_value FROM dest JOIN hs_dim USING (hs_code) GROUP BY naics_code),
named_dest AS (SELECT * FROM dest WHERE country IS NOT NULL),
product_sum AS (
  SELECT hs_code, sum(v) AS total, max(v) AS top, count(*) AS countries FROM named_dest GROUP BY hs_code),
product_top AS (
  SELECT hs_code, min(country) AS top_country FROM named_dest JOIN product_sum USING (hs_code) WHERE v = top GROUP BY hs_code),
product AS (
  SELECT hs_code, top_country,
         round_even(CAST(top AS DOUBLE) / total * 100, 2) AS top_country_share, countries AS country_count,
         round_even(least(100.0, CAST(top AS DOUBLE) / total * 100 * 0.7 + 3000.0 / countries), 2) AS geo_risk_score
  FROM product_sum JOIN product_top USING (hs_code) WHERE total <> 0),
sector_score AS (
  SELECT naics_code, round_even(avg(geo_risk_score), 2) AS geo_risk_score
  FROM product JOIN hs_dim USING (hs_code) GROUP BY naics_code),
sector_geo AS (SELECT * FROM exported LEFT JOIN sector_score USING (naics_code))"""

QUANTITY = """
monthly AS (
  SELECT p_type AS series_id, CAST(year(l_shipdate) AS BIGINT) AS y, CAST(month(l_shipdate) AS BIGINT) AS m, avg(l_quantity) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""

ORDER_COUNTS = """
monthly AS (
  SELECT o_orderpriority AS series_id, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
         CAST(count(*) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2, 3)"""

STRESS = """
change AS (
  SELECT series_id, y, m, value, value - lag(value) OVER (PARTITION BY series_id ORDER BY y, m) AS d FROM monthly),
metric AS (
  SELECT series_id, count(*) AS observations, sum(value) AS value_sum, arg_max(value, y * 100 + m) AS latest, max(value) AS peak,
         avg(d) AS trend, stddev_pop(d) AS sd FROM change GROUP BY series_id),
stress_part AS (
  SELECT *, CASE WHEN peak > 0 THEN (peak - latest) / peak * 100 ELSE 0 END AS p FROM metric),
stress AS (
  SELECT *,
    CASE WHEN p > 10 THEN least(70 + (p - 10), 100) WHEN p >= 5 THEN 30 + (p - 5) * 8 ELSE p * 6 END AS ps,
    CASE WHEN sd > 5 THEN least(70 + (sd - 5) * 6, 100) WHEN sd >= 2 THEN 30 + (sd - 2) / 3 * 40 ELSE sd * 15 END AS vs,
    CASE WHEN trend < 0 THEN 20.0 ELSE 0.0 END AS tp
  FROM stress_part),
stress_score AS (
  SELECT *, CAST(format('{:.2f}', greatest(0, least(100, CAST(0.5 AS DOUBLE) * ps + CAST(0.3 AS DOUBLE) * vs + CAST(0.2 AS DOUBLE) * CAST(tp AS DOUBLE)))) AS DOUBLE) AS workforce_risk_score
  FROM stress)"""

STRESS_SELECT = """
SELECT series_id, observations, round_even(latest, 4) AS latest_employment, round_even(peak, 4) AS peak_employment,
       round_even(p, 4) AS peak_to_current_ratio, round_even(sd, 4) AS volatility,
       CAST(format('{:.2f}', ps) AS DOUBLE) AS peak_score, CAST(format('{:.2f}', vs) AS DOUBLE) AS volatility_score, CAST(tp AS DOUBLE) AS trend_penalty,
       workforce_risk_score FROM stress_score"""

SECTOR_WORK = """
sector_work AS (
  SELECT naics_code, CAST(round_even(sum(value_sum) / sum(observations) * 1000, 0) AS BIGINT) AS employment_count,
         max(workforce_risk_score) AS workforce_risk_score
  FROM stress_score JOIN series_dim ON stress_score.series_id = p_type JOIN sector_dim ON sector_dim.series_id = series_dim.series_id
  GROUP BY naics_code)"""

SEGMENTS = """
raw_segment AS (
  SELECT 'NAICS' AS row_type, naics_code, naics_label, CAST(NULL AS VARCHAR) AS state,
         CAST(NULL AS DOUBLE) AS total_contract_value, CAST(NULL AS BIGINT) AS recipient_count,
         export_value, employment_count, CAST(NULL AS DOUBLE) AS hhi, 'N/A' AS concentration_risk_label,
         geo_risk_score, workforce_risk_score,
         CASE WHEN geo_risk_score IS NOT NULL AND workforce_risk_score IS NOT NULL THEN (geo_risk_score + workforce_risk_score) / 2
              ELSE coalesce(geo_risk_score, workforce_risk_score) END AS score, FALSE AS padded
  FROM sector_geo FULL JOIN sector_work USING (naics_code) LEFT JOIN label_dim USING (naics_code)
  UNION ALL
  SELECT 'STATE', NULL, NULL, state, total, awards, NULL, NULL, CASE WHEN names > 0 THEN hhi ELSE 0 END,
         CASE WHEN names > 0 AND hhi > 2500 THEN 'High' WHEN names > 0 AND hhi > 1500 THEN 'Moderate' ELSE 'Low' END,
         NULL, NULL, CASE WHEN names > 0 THEN hhi ELSE 0 END / 100, FALSE
  FROM state_hhi
  UNION ALL
  SELECT 'STATE', NULL, NULL, state, 0, 0, NULL, NULL, 0, 'Low', NULL, NULL, 0, TRUE
  FROM us_dim WHERE state NOT IN (SELECT state FROM state_hhi)),
segment AS (
  SELECT row_type, naics_code, naics_label, state, round_even(total_contract_value, 2) AS total_contract_value, recipient_count,
         round_even(export_value, 2) AS export_value, employment_count, round_even(hhi, 2) AS hhi_score, concentration_risk_label,
         geo_risk_score, workforce_risk_score, round_even(score, 2) AS composite_risk_score,
         CASE WHEN score IS NULL THEN 'Unknown' WHEN score >= 70 THEN 'High' WHEN score >= 40 THEN 'Medium'
              WHEN score >= 1 THEN 'Low' ELSE 'Minimal' END AS risk_tier, padded
  FROM raw_segment)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


ON_AWARDS = _with(DIMS, AWARDS)
ON_STATES = _with(DIMS, AWARDS, STATES)
ON_TRADE = _with(DIMS, TRADE)
ON_WORK = _with(DIMS, QUANTITY, STRESS, SECTOR_WORK)
ON_SEGMENTS = _with(DIMS, AWARDS, STATES, TRADE, QUANTITY, STRESS, SECTOR_WORK, SEGMENTS)

# --- concentration -----------------------------------------------------------

NATION = """
supplier_total AS (
  SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS x FROM lineitem GROUP BY l_suppkey),
nation_entity AS (
  SELECT n_name, s_name, x FROM supplier_total JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""


def _nation_hhi() -> str:
    return """
nation_share AS (
  SELECT n_name, CAST(x AS DOUBLE) / CAST(sum(x) OVER (PARTITION BY n_name) AS DOUBLE) AS share FROM nation_entity),
nation_score AS (SELECT n_name, round_even(sum(share * share) * 10000, 4) AS hhi_score FROM nation_share GROUP BY n_name),
nation_hhi AS (
  SELECT n_name, hhi_score,
         CASE WHEN hhi_score > 2500 THEN 'High' WHEN hhi_score > 1500 THEN 'Moderate' ELSE 'Low' END AS concentration_risk_label
  FROM nation_score)"""


ON_NATION = _with(NATION, _nation_hhi())

ORACLE["hhi_by_nation"] = ON_NATION + " SELECT * FROM nation_hhi"
ORACLE["entity_shares"] = _with(NATION) + """
SELECT n_name, s_name, round_even(CAST(x AS DOUBLE), 6) AS entity_total,
       round_even(CAST(x AS DOUBLE) / CAST(sum(x) OVER (PARTITION BY n_name) AS DOUBLE), 6) AS share FROM nation_entity"""
ORACLE["top_hhi_nations"] = ON_NATION + """
SELECT *, row_number() OVER (ORDER BY hhi_score DESC, n_name) AS rank FROM nation_hhi ORDER BY rank LIMIT 10"""
ORACLE["hhi_padded"] = _with(DIMS, NATION, _nation_hhi()) + """,
coded AS (SELECT code, hhi_score, concentration_risk_label FROM nation_hhi JOIN nation USING (n_name) JOIN state_dim ON n_nationkey = nationkey)
SELECT state, coalesce(hhi_score, 0.0) AS hhi_score, coalesce(concentration_risk_label, 'Low') AS concentration_risk_label
FROM us_dim LEFT JOIN coded ON state = code"""
ORACLE["hhi_label_counts"] = ON_NATION + """
SELECT concentration_risk_label, count(*) AS row_count FROM nation_hhi GROUP BY 1"""
ORACLE["null_state_audit"] = ON_AWARDS + """
SELECT count(*) AS rows_before, count(*) - count(state) AS rows_dropped, count(state) AS rows_after,
       count(DISTINCT state) AS distinct_keys FROM award"""

# --- destinations ------------------------------------------------------------

ORACLE["dest_dependence"] = ON_TRADE + """
SELECT hs_code, top_country, top_country_share, country_count, geo_risk_score FROM product"""

_GENERIC_PROFILE = """
profile_sum AS (SELECT k, sum(v) AS total, max(v) AS top, count(*) AS n FROM cell GROUP BY k),
profile AS (
  SELECT k, CAST(any_value(total) AS DOUBLE) AS total, min(d) AS top_country,
         round_even(any_value(CAST(top AS DOUBLE) / CAST(total AS DOUBLE)) * 100, 2) AS top_country_share, any_value(n) AS country_count,
         round_even(least(100.0, any_value(CAST(top AS DOUBLE) / CAST(total AS DOUBLE)) * 100 * 0.7 + 3000.0 / any_value(n)), 2) AS geo_risk_score
  FROM cell JOIN profile_sum USING (k) WHERE v = top AND total <> 0 GROUP BY k)"""

ORACLE["dest_dependence_capped"] = _with(
    """
cell AS (
  SELECT p_type AS k, n_name AS d, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)""",
    _GENERIC_PROFILE,
) + " SELECT k AS p_type, top_country, top_country_share, country_count, geo_risk_score FROM profile"

ORACLE["dest_rollup_worst"] = _with(
    """
cell AS (
  SELECT p_brand AS k, CAST(o_custkey AS VARCHAR) AS d, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS v
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
    _GENERIC_PROFILE,
    """
member AS (
  SELECT 'Group ' || CAST(CAST(substr(k, 7) AS INTEGER) // 5 AS VARCHAR) AS g, * FROM profile
  WHERE CAST(substr(k, 7) AS INTEGER) < 25),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY top_country_share DESC, k) AS place FROM member)""",
) + """
SELECT g AS brand_group, round_even(sum(total), 2) AS total_value, round_even(avg(geo_risk_score), 2) AS geo_risk_score,
       max(CASE WHEN place = 1 THEN top_country END) AS top_country,
       max(CASE WHEN place = 1 THEN top_country_share END) AS top_country_share,
       max(CASE WHEN place = 1 THEN country_count END) AS country_count
FROM placed GROUP BY g"""

ORACLE["unmapped_products"] = ON_TRADE + """
SELECT hs_code, CAST(sum(v) AS BIGINT) AS export_value, count(country) AS country_count FROM dest
WHERE hs_code NOT IN (SELECT hs_code FROM hs_dim) GROUP BY hs_code"""
ORACLE["trade_by_industry"] = ON_TRADE + """,
placed AS (
  SELECT naics_code, product.*, row_number() OVER (PARTITION BY naics_code ORDER BY top_country_share DESC, hs_code) AS place
  FROM product JOIN hs_dim USING (hs_code))
SELECT naics_code, g.geo_risk_score, top_country, top_country_share, country_count, naics_label
FROM placed JOIN sector_geo g USING (naics_code) JOIN label_dim USING (naics_code) WHERE place = 1"""

# --- workforce ---------------------------------------------------------------

ORACLE["series_stress"] = _with(QUANTITY, STRESS) + STRESS_SELECT
ORACLE["series_stress_volatile"] = _with(ORDER_COUNTS, STRESS) + STRESS_SELECT
ORACLE["series_changes"] = _with(ORDER_COUNTS) + """
SELECT series_id, y AS year, m AS month, value, value - lag(value) OVER (PARTITION BY series_id ORDER BY y, m) AS change FROM monthly"""
ORACLE["series_peak_month"] = _with(ORDER_COUNTS, """
placed AS (
  SELECT *, avg(value) OVER (PARTITION BY series_id) AS mean_value,
         row_number() OVER (PARTITION BY series_id ORDER BY value DESC, y, m) AS place FROM monthly)""") + """
SELECT series_id, round_even(mean_value, 4) AS mean_value, y AS peak_year, monthname(make_date(y, m, 1)) AS peak_period,
       value AS peak_value FROM placed WHERE place = 1"""
ORACLE["missing_states"] = ON_AWARDS + """
SELECT state FROM us_dim WHERE state NOT IN (SELECT state FROM award WHERE state IS NOT NULL)"""

# --- unification and composite ----------------------------------------------

ORACLE["awards_by_key"] = ON_AWARDS + """
SELECT CAST(NULL AS VARCHAR) AS naics_code, state, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_contract_value,
       count(amount) AS recipient_count FROM award GROUP BY state"""
# Awards of return flag R carry an industry code; both kinds count towards their state.
CODED = f"""
coded AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN list_extract([{_quoted(NAICS_LABELS)}], CAST(l_suppkey % {len(NAICS_LABELS)} AS INTEGER) + 1) END AS code
  FROM award),
sector_value AS (
  SELECT code AS naics_code, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_contract_value, count(amount) AS recipient_count
  FROM coded WHERE code IS NOT NULL GROUP BY code)"""
ORACLE["coded_awards_by_key"] = _with(DIMS, AWARDS, CODED) + """
SELECT code AS naics_code, state, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_contract_value,
       count(amount) AS recipient_count FROM coded GROUP BY code, state"""
ORACLE["scored_row_level"] = ON_SEGMENTS + "," + CODED + """
SELECT row_type, coalesce(s.naics_code, v.naics_code) AS naics_code, coalesce(s.naics_label, l.naics_label) AS naics_label, state,
       round_even(coalesce(s.total_contract_value, v.total_contract_value), 2) AS total_contract_value,
       coalesce(s.recipient_count, v.recipient_count) AS recipient_count, export_value, employment_count, hhi_score,
       concentration_risk_label, geo_risk_score, workforce_risk_score, composite_risk_score, risk_tier
FROM segment s LEFT JOIN sector_value v USING (naics_code) LEFT JOIN label_dim l USING (naics_code)
UNION ALL
SELECT 'NAICS', naics_code, naics_label, NULL, round_even(total_contract_value, 2), recipient_count, NULL, NULL, NULL, 'N/A',
       NULL, NULL, NULL, 'Unknown'
FROM sector_value JOIN label_dim USING (naics_code) WHERE naics_code NOT IN (SELECT naics_code FROM segment WHERE naics_code IS NOT NULL)"""
ORACLE["recipient_profile"] = ON_STATES + """
SELECT state, total AS total_contract_value, awards AS award_count, names AS distinct_recipients,
       round_even(hhi, 4) AS hhi_score FROM state_hhi"""
ORACLE["exports_by_industry"] = ON_TRADE + " SELECT naics_code, export_value FROM sector_geo"
ORACLE["employment_by_industry"] = ON_WORK + " SELECT naics_code, employment_count FROM sector_work"
ORACLE["unify_segments"] = ON_SEGMENTS + """
SELECT naics_code, naics_label, state, row_type, total_contract_value, recipient_count, export_value, employment_count,
       CAST(NULL AS DOUBLE) AS hhi_score, CASE WHEN row_type = 'NAICS' THEN 'N/A' END AS concentration_risk_label FROM raw_segment"""
ORACLE["coverage_report"] = ON_AWARDS + """,
missing AS (SELECT state FROM us_dim WHERE state NOT IN (SELECT state FROM award WHERE state IS NOT NULL)),
keyed AS (SELECT DISTINCT state FROM award)
SELECT (SELECT count(*) FROM keyed) AS total_rows, CAST(0 AS BIGINT) AS naics_rows, (SELECT count(state) FROM keyed) AS state_rows,
       (SELECT count(*) - count(state) FROM keyed) AS orphan_rows, (SELECT count(*) FROM missing) AS missing_states,
       (SELECT coalesce(string_agg(state, ',' ORDER BY state), '') FROM missing) AS missing_list"""
ORACLE["scored_segments"] = ON_SEGMENTS + " SELECT * EXCLUDE (padded) FROM segment"
ORACLE["scored_stepwise"] = ON_SEGMENTS + " SELECT * EXCLUDE (padded) FROM segment"
ORACLE["export_order"] = ON_SEGMENTS + """
SELECT row_number() OVER (ORDER BY row_type, naics_code, padded, state) AS line, row_type, naics_code, state FROM segment"""
ORACLE["segment_preview"] = ON_SEGMENTS + """
SELECT row_type, naics_code, state, composite_risk_score, risk_tier FROM segment
ORDER BY row_type, naics_code, padded, state LIMIT 6"""
ORACLE["registry_scores"] = ON_SEGMENTS + """,
hidden AS (
  SELECT naics_code, CAST(count(*) - count(CASE WHEN shown THEN 1 END) AS DOUBLE) / count(*) * 100 AS suppression
  FROM trade JOIN hs_dim USING (hs_code) GROUP BY naics_code),
part_score AS (
  SELECT row_type, naics_code, state, hhi / 100 AS c, geo_risk_score AS g, workforce_risk_score AS w, suppression AS s
  FROM raw_segment LEFT JOIN hidden USING (naics_code)),
blended AS (
  SELECT *, CASE WHEN row_type = 'STATE' THEN c ELSE
      (coalesce(g * 0.5, 0) + coalesce(w * 0.5, 0) + coalesce(s * 0.25, 0))
      / ((CASE WHEN g IS NULL THEN 0 ELSE 0.5 END) + (CASE WHEN w IS NULL THEN 0 ELSE 0.5 END) + (CASE WHEN s IS NULL THEN 0 ELSE 0.25 END)) END AS score
  FROM part_score)
SELECT row_type, naics_code, state, round_even(c, 4) AS concentration_score, round_even(g, 4) AS geographic_score, round_even(w, 4) AS workforce_score,
       round_even(s, 4) AS suppression_score, round_even(score, 4) AS composite_risk_score,
       CASE WHEN score IS NULL THEN 'Unknown' WHEN score >= 70 THEN 'High' WHEN score >= 40 THEN 'Medium'
            WHEN score >= 1 THEN 'Low' ELSE 'Minimal' END AS risk_tier FROM blended"""
ORACLE["composite_tiers"] = """
WITH r AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'STATE' ELSE 'NAICS' END AS row_type,
         CASE WHEN c_acctbal > 0 THEN c_acctbal END AS hhi,
         CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN abs(c_acctbal) / 100 END AS g,
         CASE WHEN c_mktsegment <> 'HOUSEHOLD' AND c_acctbal > 500 THEN c_acctbal / 200 END AS w FROM customer),
s AS (
  SELECT c_custkey, row_type, round_even(CASE WHEN row_type = 'STATE' THEN hhi / 10000 * 100
         WHEN g IS NOT NULL AND w IS NOT NULL THEN g * 0.5 + w * 0.5 ELSE coalesce(g, w) END, 6) AS composite_risk_score FROM r)
SELECT *, CASE WHEN composite_risk_score IS NULL THEN 'Unknown' WHEN composite_risk_score >= 70 THEN 'High'
       WHEN composite_risk_score >= 40 THEN 'Medium' WHEN composite_risk_score >= 1 THEN 'Low' ELSE 'Minimal' END AS risk_tier FROM s"""

# --- views over the segments --------------------------------------------------

_VIEW = """
SELECT row_type AS "Type", coalesce(state, '') AS "State", coalesce(naics_label, '') AS "Sector", composite_risk_score AS "Risk Score",
       risk_tier AS "Risk Tier", hhi_score AS "HHI", geo_risk_score AS "Geo Risk", workforce_risk_score AS "Workforce Risk" FROM segment"""

ORACLE["filtered_view"] = ON_SEGMENTS + _VIEW + """
WHERE risk_tier IN ('High', 'Medium', 'Low') AND coalesce(composite_risk_score, 0) >= 20"""
ORACLE["filtered_view_states"] = ON_SEGMENTS + """
SELECT state, composite_risk_score, risk_tier FROM segment
WHERE risk_tier IN ('High', 'Medium', 'Low', 'Minimal') AND row_type = 'STATE'"""
ORACLE["dashboard_kpis"] = ON_SEGMENTS + """
SELECT count(*) AS total_segments, count(CASE WHEN risk_tier = 'High' THEN 1 END) AS high_risk_segments,
       max(composite_risk_score) AS highest_score,
       round_even(coalesce(sum(CASE WHEN row_type = 'STATE' THEN total_contract_value END), 0) / 1e9, 6) AS contract_value_bn FROM segment"""
ORACLE["state_map"] = ON_SEGMENTS + """
SELECT state, composite_risk_score, risk_tier, total_contract_value, recipient_count, hhi_score FROM segment
WHERE row_type = 'STATE' AND state IS NOT NULL AND composite_risk_score IS NOT NULL"""
ORACLE["default_selection"] = ON_SEGMENTS + """
SELECT state, composite_risk_score, risk_tier FROM segment WHERE row_type = 'STATE'
ORDER BY composite_risk_score DESC NULLS LAST, state LIMIT 1"""

_MONEY_SHORT = """CASE WHEN {c} IS NULL THEN 'N/A' WHEN {c} >= 1e9 THEN '$' || format('{{:,.2f}}', {c} / 1e9) || 'B'
       WHEN {c} >= 1e6 THEN '$' || format('{{:,.2f}}', {c} / 1e6) || 'M' ELSE '$' || format('{{:,.0f}}', {c}) END"""


def _num(column: str, missing: str = "N/A") -> str:
    return f"CASE WHEN {column} IS NULL THEN '{missing}' ELSE format('{{:,.2f}}', {column}) END"


_PANEL = f"""
SELECT coalesce(state, naics_code) AS identifier,
       CASE WHEN row_type = 'STATE' THEN 'State: ' || state ELSE 'NAICS ' || naics_code || ' — ' || naics_label END AS title,
       risk_tier AS tier, {_num('composite_risk_score')} AS composite_risk, {_num('geo_risk_score')} AS geo_risk,
       {_num('workforce_risk_score')} AS workforce_risk, {_num('hhi_score')} AS hhi,
       {_MONEY_SHORT.format(c='total_contract_value')} AS contract_value,
       CASE WHEN recipient_count IS NULL THEN 'N/A' ELSE format('{{:,}}', recipient_count) END AS recipients FROM segment"""

ORACLE["panel_metrics"] = ON_SEGMENTS + _PANEL
ORACLE["panel_selection"] = ON_SEGMENTS + _PANEL + " WHERE row_type = 'NAICS' AND naics_code = '336411'"
ORACLE["sector_cards"] = ON_SEGMENTS + f"""
SELECT naics_code, coalesce(short_name, naics_label, naics_code) AS sector, {_num('composite_risk_score', '—')} AS composite,
       risk_tier AS tier, {_num('geo_risk_score', '—')} AS geo, {_num('workforce_risk_score', '—')} AS workforce
FROM segment LEFT JOIN short_dim USING (naics_code) WHERE row_type = 'NAICS'"""

# --- chart data sets ----------------------------------------------------------

ORACLE["top20_states"] = ON_SEGMENTS + """
SELECT row_number() OVER (ORDER BY composite_risk_score DESC, state) AS rank, state, composite_risk_score, risk_tier
FROM segment WHERE row_type = 'STATE' AND composite_risk_score IS NOT NULL ORDER BY rank LIMIT 20"""


def _histogram(head: str, table: str, column: str, where: str) -> str:
    return head + f"""
x AS (SELECT CAST({column} AS DOUBLE) AS v FROM {table} WHERE {where} AND {column} IS NOT NULL),
b AS (SELECT CASE WHEN min(v) < max(v) THEN min(v) ELSE min(v) - 0.5 END AS lo,
             CASE WHEN min(v) < max(v) THEN max(v) ELSE max(v) + 0.5 END AS hi FROM x),
c AS (SELECT least(CAST(floor((v - lo) * 20 / (hi - lo)) AS BIGINT) + 1, 20) AS bin, count(*) AS n FROM x, b GROUP BY 1)
SELECT bins.bin, round_even(lo + (bins.bin - 1) * ((hi - lo) / 20), 4) AS bin_low, round_even(lo + bins.bin * ((hi - lo) / 20), 4) AS bin_high,
       coalesce(n, 0) AS row_count
FROM (SELECT unnest(range(1, 21)) AS bin) bins CROSS JOIN b LEFT JOIN c ON c.bin = bins.bin"""


ORACLE["score_histogram"] = _histogram(ON_SEGMENTS + ",", "segment", "composite_risk_score", "row_type = 'STATE'")
ORACLE["price_histogram"] = _histogram("WITH", "orders", "o_totalprice", "TRUE")
ORACLE["sector_heatmap"] = ON_SEGMENTS + """
SELECT naics_label, d.dimension, CASE d.dimension WHEN 'geo_risk_score' THEN geo_risk_score
       WHEN 'workforce_risk_score' THEN workforce_risk_score ELSE composite_risk_score END AS score
FROM segment CROSS JOIN (VALUES ('geo_risk_score'), ('workforce_risk_score'), ('composite_risk_score')) AS d(dimension)
WHERE row_type = 'NAICS'"""

_SCATTER = """,
scatter AS (
  SELECT state, total_contract_value, composite_risk_score, risk_tier,
         least(800.0, greatest(25.0, recipient_count * CAST(1.5 AS DOUBLE))) AS marker_size FROM segment
  WHERE row_type = 'STATE' AND total_contract_value > 0 AND composite_risk_score IS NOT NULL AND recipient_count IS NOT NULL)"""
ORACLE["value_against_risk"] = ON_SEGMENTS + _SCATTER + " SELECT * FROM scatter"
ORACLE["annotated_states"] = ON_SEGMENTS + _SCATTER + """
SELECT row_number() OVER (ORDER BY total_contract_value DESC, state) AS rank, state, total_contract_value, composite_risk_score
FROM scatter ORDER BY rank LIMIT 5"""
ORACLE["eda_summary"] = ON_SEGMENTS + _SCATTER + """,
s AS (SELECT * FROM segment WHERE row_type = 'STATE'),
top AS (SELECT state, composite_risk_score FROM s WHERE composite_risk_score IS NOT NULL ORDER BY composite_risk_score DESC, state LIMIT 1),
big AS (SELECT * FROM scatter ORDER BY total_contract_value DESC, state LIMIT 1)
SELECT (SELECT state FROM top) AS top_state, (SELECT composite_risk_score FROM top) AS top_score,
       count(CASE WHEN risk_tier = 'High' THEN 1 END) AS high_count, count(CASE WHEN risk_tier = 'Medium' THEN 1 END) AS medium_count,
       count(CASE WHEN risk_tier = 'Low' THEN 1 END) AS low_count, count(CASE WHEN risk_tier = 'Minimal' THEN 1 END) AS minimal_count,
       round_even(avg(composite_risk_score), 4) AS mean_score, round_even(median(composite_risk_score), 4) AS median_score,
       (SELECT state FROM big) AS top_contract_state, (SELECT total_contract_value FROM big) AS top_contract_value,
       (SELECT composite_risk_score FROM big) AS top_contract_score FROM s"""
ORACLE["tier_counts"] = ON_SEGMENTS + """
SELECT row_type, risk_tier, count(*) AS row_count FROM segment GROUP BY 1, 2"""
ORACLE["score_coverage"] = ON_SEGMENTS + """
SELECT count(DISTINCT state) AS states, count(DISTINCT naics_code) AS industries, count(hhi_score) AS with_hhi,
       count(geo_risk_score) AS with_geo, count(workforce_risk_score) AS with_workforce FROM segment"""

# --- source summaries ---------------------------------------------------------

ORACLE["award_grand_total"] = """
SELECT count(*) AS row_count, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS DOUBLE) AS total_value,
       round_even(CAST(sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS DOUBLE) / 1e9, 2) AS total_bn FROM lineitem"""
ORACLE["top_recipients"] = ON_AWARDS + """,
t AS (SELECT recipient_name, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_value FROM award GROUP BY 1)
SELECT *, row_number() OVER (ORDER BY total_value DESC, recipient_name NULLS LAST) AS rank, round_even(total_value / 1e9, 2) AS total_bn
FROM t ORDER BY rank LIMIT 5"""
ORACLE["top_destinations"] = """
WITH t AS (
  SELECT n_nationkey, n_name, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) AS total_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT *, row_number() OVER (ORDER BY total_value DESC, n_nationkey) AS rank, round_even(total_value / 1e9, 2) AS total_bn
FROM t ORDER BY rank LIMIT 10"""
ORACLE["largest_awards"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank
FROM lineitem ORDER BY rank LIMIT 100"""
ORACLE["ranked_orders"] = """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders"""
ORACLE["fiscal_year_totals"] = """
WITH o AS (
  SELECT *, CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS fy FROM orders
  WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '4-NOT SPECIFIED')
SELECT CAST(fy AS BIGINT) AS fiscal_year, count(*) AS row_count, CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE) AS total_value,
       CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_day
FROM o WHERE fy BETWEEN 1997 AND 1999 GROUP BY fy"""

# --- briefs -------------------------------------------------------------------

_BATCH = """,
batch AS (
  SELECT * FROM (SELECT CAST(0 AS BIGINT) AS branch, * FROM segment WHERE row_type = 'STATE'
                 ORDER BY composite_risk_score DESC NULLS LAST, padded, state LIMIT 10)
  UNION ALL SELECT 1, * FROM segment WHERE row_type = 'NAICS')"""
ORACLE["brief_selection"] = ON_SEGMENTS + _BATCH + """
SELECT branch, coalesce(state, naics_code) AS identifier, composite_risk_score, risk_tier,
       row_number() OVER (PARTITION BY branch ORDER BY CASE WHEN branch = 0 THEN composite_risk_score END DESC NULLS LAST,
                          naics_code, padded, state) AS place FROM batch
"""
ORACLE["cache_split"] = """
SELECT doc_id, lang, CAST(CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 1 ELSE 0 END AS BIGINT) AS cached FROM documents"""
ORACLE["cache_todo"] = """
SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def _lines(*lines: str) -> str:
    return " || chr(10) || ".join(lines)


def _int(column: str, missing: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '{missing}' ELSE format('{{:,}}', {column}) END"


def _dollars(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'N/A' ELSE '$' || format('{{:,.0f}}', {column}) END"


# The wording of the prompts.
_CLOSING = (
    "'Using only the metrics above, write the one-page risk brief in the exact "
    "four-section format defined in your instructions.'"
)
_STATE_PROMPT = _lines(
    "'Supplier Segment: U.S. State — ' || state",
    "''",
    "'Risk metrics for this segment:'",
    "'- Row type: STATE'",
    "'- State: ' || state",
    f"'- Total contract value: ' || {_dollars('total_contract_value')}",
    f"'- Recipient count: ' || {_int('recipient_count', 'N/A')}",
    f"'- HHI score (0-10000): ' || {_num('hhi_score')}",
    "'- Concentration risk label: ' || concentration_risk_label",
    f"'- Composite risk score (0-100): ' || {_num('composite_risk_score')}",
    "'- Risk tier: ' || risk_tier",
    "''",
    _CLOSING,
)
_SECTOR_PROMPT = _lines(
    "'Supplier Segment: NAICS ' || naics_code || ' — ' || naics_label",
    "''",
    "'Risk metrics for this segment:'",
    "'- Row type: NAICS'",
    "'- NAICS code: ' || naics_code",
    "'- NAICS label: ' || naics_label",
    f"'- Export value: ' || {_dollars('export_value')}",
    f"'- Employment count: ' || {_int('employment_count', 'N/A')}",
    "'- Export concentration risk score (0-100) — measures dependency on single export destination country: ' || "
    + _num("geo_risk_score"),
    f"'- Workforce risk score (0-100): ' || {_num('workforce_risk_score')}",
    f"'- Composite risk score (0-100): ' || {_num('composite_risk_score')}",
    "'- Risk tier: ' || risk_tier",
    "''",
    _CLOSING,
)
ORACLE["segment_prompts"] = ON_SEGMENTS + f"""
SELECT coalesce(state, naics_code) AS identifier, row_type || ' ' || coalesce(state, naics_code) AS label,
       CASE WHEN row_type = 'STATE' THEN {_STATE_PROMPT} ELSE {_SECTOR_PROMPT} END AS prompt FROM segment"""

_MANIFEST = _BATCH + """,
manifest AS (
  SELECT row_type, state, naics_code, composite_risk_score, risk_tier,
         'briefs/' || coalesce(state, naics_code) || '.txt' AS brief_file_path,
         CASE WHEN row_type = 'NAICS' THEN 0 ELSE recipient_count END AS tokens_used,
         CASE WHEN row_type = 'NAICS' THEN '2024-01-31T10:20:30+00:00' ELSE '2024-01-31T10:20:30.250000+00:00' END AS generated_at
  FROM batch)"""
ORACLE["brief_manifest"] = ON_SEGMENTS + _MANIFEST + " SELECT * FROM manifest"
ORACLE["manifest_array"] = ON_SEGMENTS + _MANIFEST + """
SELECT row_type, coalesce(state, naics_code) AS key, format('{:.2f}', composite_risk_score) AS score, risk_tier AS tier,
       tokens_used, brief_file_path FROM manifest"""
ORACLE["token_usage"] = ON_SEGMENTS + _MANIFEST + """
SELECT count(*) AS briefs, count(CASE WHEN tokens_used > 0 THEN 1 END) AS calls,
       CAST(coalesce(sum(tokens_used), 0) AS BIGINT) AS total_tokens FROM manifest"""
ORACLE["manifest_file"] = ON_SEGMENTS + _MANIFEST + """
SELECT row_type, coalesce(state, naics_code) AS key, format('{:.2f}', composite_risk_score) AS score, risk_tier AS tier,
       tokens_used, brief_file_path FROM manifest"""


def _score(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'n/a' ELSE format('{{:.2f}}', {column}) END"


_REPORT_MONEY = """CASE WHEN {c} IS NULL THEN 'n/a' WHEN {c} >= 1e9 THEN '$' || format('{{:.2f}}', {c} / 1e9) || 'B'
       WHEN {c} >= 1e6 THEN '$' || format('{{:.2f}}', {c} / 1e6) || 'M' WHEN {c} >= 1e3 THEN '$' || format('{{:.2f}}', {c} / 1e3) || 'K'
       ELSE '$' || format('{{:,.0f}}', {c}) END""".format(c="total_contract_value")
ORACLE["metric_panel"] = ON_SEGMENTS + f"""
SELECT coalesce(state, naics_code) AS identifier,
       CASE WHEN row_type = 'STATE' THEN 'State of ' || state ELSE 'NAICS ' || naics_code || ' — ' || naics_label END AS title,
       CAST(place AS BIGINT) AS position,
       CASE WHEN place = 1 THEN 'Composite Risk'
            WHEN row_type = 'STATE' THEN CASE place WHEN 2 THEN 'HHI Score' WHEN 3 THEN 'Contract Value' ELSE 'Recipients' END
            ELSE CASE place WHEN 2 THEN 'Geo Risk' ELSE 'Workforce Risk' END END AS label,
       CASE WHEN place = 1 THEN {_score('composite_risk_score')}
            WHEN row_type = 'STATE' THEN CASE place WHEN 2 THEN {_score('hhi_score')} WHEN 3 THEN {_REPORT_MONEY} ELSE {_int('recipient_count', 'n/a')} END
            ELSE CASE place WHEN 2 THEN {_score('geo_risk_score')} ELSE {_score('workforce_risk_score')} END END AS value
FROM segment CROSS JOIN (SELECT unnest(range(1, 5)) AS place) p WHERE place <= 3 OR row_type = 'STATE'"""

# RE2 has no look-around: an isolated pair is matched with its neighbours, twice for shared ones.
_FOLDED = "replace(translate(html, '•–—‘’“”' || chr(160), '---''''\"\" '), '…', '...')"
_SINGLE = "regexp_replace({x}, '(^|[^-])--([^-]|$)', '\\1-\\2', 'gs')"
ORACLE["text_fold"] = f"""
SELECT page_id, replace({_SINGLE.format(x=_SINGLE.format(x=_FOLDED))}, '__', '') AS html FROM pages"""

_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || ' ' || chr(133) || chr(160)"
_LINES = f"""
parts AS (SELECT doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS lines FROM given WHERE text <> ''),
kept AS (SELECT doc_id, CASE WHEN lines[-1] = '' THEN lines[:-2] ELSE lines END AS lines FROM parts),
l AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS line_no, rtrim(unnest(lines), {_SPACE}) AS bare FROM kept),
k AS (SELECT *, ltrim(bare, {_SPACE}) AS inside,
        CASE WHEN ltrim(bare, {_SPACE}) = '' THEN 'blank' WHEN starts_with(bare, '# ') THEN 'title' WHEN starts_with(bare, '## ') THEN 'heading'
             WHEN substr(ltrim(bare, {_SPACE}), 1, 2) IN ('- ', '• ', '* ') THEN 'bullet' ELSE 'paragraph' END AS kind FROM l)
SELECT doc_id, line_no, kind, CASE kind WHEN 'heading' THEN trim(substr(bare, 4), {_SPACE}) WHEN 'bullet' THEN trim(substr(inside, 3), {_SPACE})
       WHEN 'blank' THEN '' ELSE bare END AS payload FROM k WHERE kind <> 'title'"""
ORACLE["line_classes"] = "WITH given AS (SELECT doc_id, text FROM documents)," + _LINES

_MARKED = """
  concat_ws(chr(10), '# ' || source, '##  ' || lang || ' – part' || chr(160) || 'one ', '- ' || source || ' a--b a---b',
            ' • “quoted” ‘' || lang || '’ ', '* more… — __' || lang || '__', '### ' || lang, ' ' || chr(160), '-', text)"""
_FOLDED_MARKS = _FOLDED.replace("html", "marked")
ORACLE["cleaned_lines"] = f"""
WITH marked AS (SELECT doc_id, {_MARKED} AS marked FROM documents),
given AS (SELECT doc_id, replace({_SINGLE.format(x=_SINGLE.format(x=_FOLDED_MARKS))}, '__', '') AS text FROM marked),""" + _LINES

# --- selection, periods, sketches, layout ------------------------------------------

ORACLE["median_price_by_nation"] = """
SELECT s_nationkey, count(*) AS n, round_even(median(l_extendedprice), 4) AS median_price
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey"""
ORACLE["scope_totals"] = """
WITH daily AS (
  SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(28,2))) AS price FROM lineitem GROUP BY 1),
period AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS starts, CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INTEGER) AS ends FROM orders)
SELECT o_orderkey, CAST(coalesce(sum(n), 0) AS BIGINT) AS award_count, CAST(sum(price) AS DOUBLE) AS total_value
FROM period LEFT JOIN daily ON day BETWEEN starts AND ends GROUP BY o_orderkey"""
ORACLE["fiscal_scope_pairs"] = ON_AWARDS + """,
scopes AS (SELECT kind || y AS scope, make_date(y - 1, 10, 1) AS starts, CASE kind WHEN 'FY' THEN make_date(y, 9, 30) ELSE make_date(y, 3, 31) END AS ends
  FROM (VALUES ('FY'), ('H')) AS k(kind), (SELECT CAST(unnest(range(1995, 2003)) AS BIGINT) AS y))
SELECT scope, count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS total_value
FROM award JOIN scopes ON start_date BETWEEN starts AND ends GROUP BY scope"""
ORACLE["merged_distinct_suppliers"] = """
WITH item AS (
  SELECT n_regionkey, n_name, CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
SELECT 3 - grouping(n_regionkey) - grouping(n_name) - grouping(year) AS depth, n_regionkey, n_name, year,
       count(DISTINCT l_suppkey) AS suppliers, TRUE AS is_exact
FROM item GROUP BY ROLLUP (n_regionkey, n_name, year)"""
ORACLE["laid_out_awards"] = ON_AWARDS + """
SELECT 'state' AS scan, count(*) AS row_count, CAST(sum(amount) AS DOUBLE) AS total_value FROM award WHERE state_raw = 'WI'
UNION ALL SELECT 'year', count(*), CAST(sum(amount) AS DOUBLE) FROM award WHERE year(start_date) = 1997
UNION ALL SELECT 'recipient', count(*), CAST(sum(amount) AS DOUBLE) FROM award WHERE recipient_name = 'Supplier#000000007'
UNION ALL SELECT 'none', count(*), CAST(sum(amount) AS DOUBLE) FROM award WHERE state_raw IS NULL"""

# --- landed responses ---------------------------------------------------------

ORACLE["ingest_awards"] = """
SELECT l_returnflag AS state, CAST(NULL AS VARCHAR) AS naics_code, count(*) AS row_count,
       count(CASE WHEN l_discount <> CAST(0.1 AS DOUBLE) THEN 1 END) AS amount_count,
       CAST(sum(CASE WHEN l_discount <> CAST(0.1 AS DOUBLE) THEN CAST(l_extendedprice AS DECIMAL(28,2)) END) AS DOUBLE) AS total_value,
       count(DISTINCT l_suppkey) AS recipients, CAST(CAST(min(l_shipdate) AS DATE) AS VARCHAR) AS first_start,
       CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_start
FROM lineitem GROUP BY l_returnflag"""

_CELLS = """
WITH cell AS (
  SELECT o_orderpriority AS hs_description, '880' || substr(o_orderpriority, 1, 1) AS hs_code, CAST(year(o_orderdate) AS BIGINT) AS year,
         n_nationkey, n_name, CAST(round_even(CAST(sum(CAST(o_totalprice AS DECIMAL(28,2))) AS DOUBLE), 0) AS BIGINT) AS export_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
shown AS (
  SELECT hs_description, hs_code, year, '1' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS country_code, n_name AS country_name, export_value FROM cell
  UNION ALL SELECT DISTINCT hs_description, hs_code, year, '1999', 'UNREADABLE', CAST(NULL AS BIGINT) FROM cell)"""
ORACLE["ingest_trade"] = _CELLS + """
SELECT hs_code, hs_description, country_code, country_name, export_value, year FROM shown WHERE hs_code <> '8803' AND year IN (1996, 1998, 2000)"""
ORACLE["ingest_employment"] = _with(DIMS, QUANTITY) + """
SELECT coalesce(d.series_id, p.series_id) AS series_id, y AS year, 'M' || lpad(CAST(m AS VARCHAR), 2, '0') AS period,
       monthname(make_date(y, m, 1)) AS period_name, round_even(value, 4) AS value,
       CASE p.series_id WHEN 'ECONOMY' THEN 'Aircraft Manufacturing' WHEN 'LARGE' THEN 'Aircraft Engine & Engine Parts'
            WHEN 'MEDIUM' THEN 'Other Aircraft Parts & Auxiliary Equipment' ELSE p.series_id END AS series_label
FROM (SELECT * FROM monthly UNION ALL
      SELECT * FROM (SELECT DISTINCT series_id, 1990 FROM monthly), (VALUES (1, CAST(NULL AS DOUBLE)), (2, NULL), (3, NULL))) AS p(series_id, y, m, value)
LEFT JOIN series_dim d ON p.series_id = d.p_type"""

# --- sinks ---------------------------------------------------------------------

ORACLE["raw_landing"] = _CELLS + """
SELECT hs_code, count(*) AS row_count, CAST(sum(export_value) AS BIGINT) AS export_value FROM shown GROUP BY hs_code"""
ORACLE["landed_folder"] = ORACLE["raw_landing"]
ORACLE["ingest_rejects"] = _with(_CELLS.strip().removeprefix("WITH "), QUANTITY) + """
SELECT 'awards' AS kind, 'no list of records' AS reason, count(CASE WHEN l_linenumber IN (5, 6, 7) THEN 1 END) AS row_count FROM lineitem
UNION ALL SELECT 'awards', 'read', count(CASE WHEN l_linenumber < 4 THEN 1 END) FROM lineitem
UNION ALL SELECT 'trade', 'no list of records', count(*) FROM (SELECT DISTINCT hs_code, year FROM cell)
UNION ALL SELECT 'trade', 'read', count(*) FROM shown
UNION ALL SELECT 'employment', 'status REQUEST_FAILED', count(DISTINCT series_id) FROM monthly
UNION ALL SELECT 'employment', 'read', count(*) + 3 * count(DISTINCT series_id) FROM monthly"""
ORACLE["series_guard"] = _with(DIMS, QUANTITY) + """
SELECT d.series_id, naics_code, count(*) AS months FROM monthly p JOIN series_dim d ON p.series_id = d.p_type
JOIN sector_dim s ON d.series_id = s.series_id GROUP BY 1, 2"""
ORACLE["clean_csv"] = ON_AWARDS + """
SELECT state_raw AS state, count(*) AS row_count, count(recipient_name) AS named, CAST(sum(amount) AS DOUBLE) AS total_value,
       CAST(max(start_date) AS VARCHAR) AS last_start FROM award GROUP BY state_raw"""
ORACLE["clean_csv_text"] = ON_AWARDS + """
SELECT CAST(start_date AS VARCHAR) AS start_date, count(*) AS row_count FROM award GROUP BY 1"""
ORACLE["foreign_csv"] = """
SELECT doc_id, source, length(text) AS n_chars, md5(text) AS text_md5,
       length(text) - length(replace(text, chr(10), '')) AS line_feeds FROM documents"""
ORACLE["stored_segments"] = ON_SEGMENTS + """
SELECT naics_code, geo_risk_score, workforce_risk_score FROM segment WHERE row_type = 'NAICS'"""
ORACLE["rescored_segments"] = ORACLE["scored_stepwise"]
ORACLE["running_concentration"] = ORACLE["recipient_profile"]
ORACLE["delivered_awards"] = """
SELECT l_returnflag AS state, count(*) AS row_count, count(CASE WHEN l_discount <> CAST(0.1 AS DOUBLE) THEN 1 END) AS amount_count,
       CAST(sum(CASE WHEN l_discount <> CAST(0.1 AS DOUBLE) THEN CAST(l_extendedprice AS DECIMAL(28,2)) END) AS DOUBLE) AS total_value,
       count(DISTINCT l_suppkey) AS recipients FROM lineitem GROUP BY l_returnflag"""
ORACLE["replaced_versions"] = ON_SEGMENTS + """
SELECT 'first' AS version, row_type, risk_tier, count(*) AS row_count FROM segment WHERE row_type = 'NAICS' GROUP BY ALL
UNION ALL SELECT 'second', row_type, risk_tier, count(*) FROM segment GROUP BY ALL"""
ORACLE["exported_segments"] = ON_SEGMENTS + " SELECT * EXCLUDE (padded) FROM segment"
ORACLE["exported_view"] = ON_SEGMENTS + """
SELECT row_type AS "Type", state AS "State", naics_label AS "Sector", composite_risk_score AS "Risk Score", risk_tier AS "Risk Tier",
       hhi_score AS "HHI", geo_risk_score AS "Geo Risk", workforce_risk_score AS "Workforce Risk" FROM segment WHERE risk_tier = 'High'"""
ORACLE["brief_files"] = ON_SEGMENTS + f"""
SELECT coalesce(state, naics_code) AS identifier, md5(body) AS brief_md5, length(body) AS n_chars
FROM (SELECT state, naics_code, CASE WHEN state IN ('WY', 'AK') THEN NULL
             ELSE CASE WHEN row_type = 'STATE' THEN {_STATE_PROMPT} ELSE {_SECTOR_PROMPT} END || chr(10) END AS body FROM segment)"""
ORACLE["brief_lookup"] = """
WITH store AS (
  SELECT 'D' || doc_id AS identifier, text FROM documents WHERE doc_id NOT IN (SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'D' || s_suppkey, s_name FROM supplier)
SELECT identifier, md5(text) AS brief_md5 FROM store WHERE identifier IN (SELECT 'D' || (s_suppkey * 3) FROM supplier)"""
ORACLE["brief_store"] = ON_SEGMENTS + """
SELECT coalesce(state, naics_code) AS identifier,
       CASE WHEN state = 'WY' THEN NULL WHEN row_type = 'NAICS' THEN 'second NAICS ' || naics_code ELSE 'STATE ' || state END AS brief_text
FROM segment"""
