"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is plain SQL over the driver's pre-registered tables. The CTEs below restate
the fixture mapping of ``peerscope.fixtures`` and the model of ``peerscope.plans`` in SQL,
independently of the Spark code, so a mismatch points at one side or the other.

Comparison rules kept on both sides:
* ranks use the integer form of round-half-up (``rr`` below), never ``round(double)``;
* percentiles are compared after ``round(x, 6)``;
* ``sum(bigint)`` is cast back to BIGINT (DuckDB widens it to HUGEINT).
"""

from __future__ import annotations

MIN_PEERS = 30
YEAR = 2023


def rr(k: str, n: str, decimals: int = 4) -> str:
    """Exact half-up rounding of k/n (SQL text)."""
    s = 10 ** decimals
    return f"(CAST((2 * ({k}) * {s} + ({n})) // (2 * ({n})) AS DOUBLE) / CAST({s} AS DOUBLE))"


def shown(x: str, d: int) -> str:
    """Half-up rounding of a double's shortest decimal form (SQL text)."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 12)), {d}) AS DOUBLE)"


def r6(x: str) -> str:
    return f"round({x}, 6)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


STATE = ("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'CA' WHEN 'BUILDING' THEN 'DC' "
         "WHEN 'FURNITURE' THEN 'PR' WHEN 'HOUSEHOLD' THEN 'TX' WHEN 'MACHINERY' THEN 'XX' END")
FIPS = ("CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '06' WHEN 'BUILDING' THEN '11' "
        "WHEN 'FURNITURE' THEN '72' WHEN 'HOUSEHOLD' THEN '48' END")
RUCA = ("CASE n.n_regionkey WHEN 0 THEN '1' WHEN 1 THEN '1.0' WHEN 2 THEN '2' "
        "WHEN 3 THEN '10.1' END")

PROVIDER_B = f"""lpad(CAST(c.c_custkey AS VARCHAR), 10, '0')                          AS Rndrng_NPI,
           c.c_name                                                              AS Rndrng_Prvdr_Last_Org_Name,
           CASE WHEN c.c_mktsegment <> 'BUILDING'
                THEN 'FN' || CAST(c.c_nationkey AS VARCHAR) END                  AS Rndrng_Prvdr_First_Name,
           CAST(NULL AS VARCHAR)                                                 AS Rndrng_Prvdr_MI,
           CASE WHEN c.c_mktsegment <> 'AUTOMOBILE' THEN 'M.D.' END              AS Rndrng_Prvdr_Crdntls,
           CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'O' ELSE 'I' END         AS Rndrng_Prvdr_Ent_Cd,
           'STREET ' || CAST(c.c_custkey AS VARCHAR)                             AS Rndrng_Prvdr_St1,
           CAST(NULL AS VARCHAR)                                                 AS Rndrng_Prvdr_St2,
           'CITY ' || CAST(c.c_nationkey AS VARCHAR)                             AS Rndrng_Prvdr_City,
           {STATE}                                                               AS Rndrng_Prvdr_State_Abrvtn,
           {FIPS}                                                                AS Rndrng_Prvdr_State_FIPS,
           lpad(CAST(c.c_nationkey * 1000 AS VARCHAR), 5, '0')                   AS Rndrng_Prvdr_Zip5,
           {RUCA}                                                                AS Rndrng_Prvdr_RUCA,
           'RUCA ' || {RUCA}                                                     AS Rndrng_Prvdr_RUCA_Desc,
           'US'                                                                  AS Rndrng_Prvdr_Cntry,
           n.n_name                                                              AS Rndrng_Prvdr_Type,
           'Y'                                                                   AS Rndrng_Prvdr_Mdcr_Prtcptg_Ind"""
PROVIDER_D = f"""lpad(CAST(c.c_custkey AS VARCHAR), 10, '0')                          AS Prscrbr_NPI,
           CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN ' ' || upper(c.c_name)
                ELSE c.c_name END                                                AS Prscrbr_Last_Org_Name,
           'FN' || CAST(c.c_nationkey AS VARCHAR)                                AS Prscrbr_First_Name,
           CASE WHEN n.n_regionkey = 1 THEN lower('CITY ' || CAST(c.c_nationkey AS VARCHAR))
                WHEN n.n_regionkey = 2 THEN 'TOWN ' || CAST(c.c_nationkey AS VARCHAR)
                ELSE 'CITY ' || CAST(c.c_nationkey AS VARCHAR) END               AS Prscrbr_City,
           {STATE}                                                               AS Prscrbr_State_Abrvtn,
           coalesce({FIPS}, '99')                                                AS Prscrbr_State_FIPS,
           c.c_mktsegment                                                        AS Prscrbr_Type"""

RAW_B = f"""
b_lines AS (
    SELECT o.o_custkey, p.p_brand, l.l_linestatus,
           CAST(count(DISTINCT l.l_orderkey) AS BIGINT) AS Tot_Benes,
           CAST(sum(l.l_quantity) AS DOUBLE)             AS Tot_Srvcs,
           CAST(count(*) AS BIGINT)                      AS Tot_Bene_Day_Srvcs,
           max(l.l_extendedprice)                        AS hi,
           min(l.l_extendedprice)                        AS lo
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p   ON l.l_partkey = p.p_partkey
    GROUP BY o.o_custkey, p.p_brand, l.l_linestatus
),
raw_b AS (
    SELECT {PROVIDER_B},
           b.p_brand                                                             AS HCPCS_Cd,
           'PROCEDURE ' || b.p_brand                                             AS HCPCS_Desc,
           CASE WHEN b.p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Y' ELSE 'N' END
                                                                                 AS HCPCS_Drug_Ind,
           b.l_linestatus                                                        AS Place_Of_Srvc,
           b.Tot_Benes, b.Tot_Srvcs, b.Tot_Bene_Day_Srvcs,
           b.hi AS Avg_Sbmtd_Chrg, b.lo AS Avg_Mdcr_Alowd_Amt,
           b.lo AS Avg_Mdcr_Pymt_Amt, b.hi AS Avg_Mdcr_Stdzd_Amt
    FROM b_lines b
    JOIN customer c ON b.o_custkey = c.c_custkey
    JOIN nation n   ON c.c_nationkey = n.n_nationkey
)"""

RAW_D = f"""
d_lines AS (
    SELECT o.o_custkey, p.p_brand, p.p_type,
           CAST(count(*) AS BIGINT)                      AS clms,
           CAST(count(DISTINCT l.l_orderkey) AS BIGINT)  AS benes,
           CAST(sum(l.l_quantity) AS DOUBLE)             AS qty,
           round(sum(l.l_extendedprice), 2)              AS cost
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p   ON l.l_partkey = p.p_partkey
    GROUP BY o.o_custkey, p.p_brand, p.p_type
),
raw_d AS (
    SELECT {PROVIDER_D},
           'S'                                                                   AS Prscrbr_Type_Src,
           d.p_brand                                                             AS Brnd_Name,
           d.p_type                                                              AS Gnrc_Name,
           d.clms                                                                AS Tot_Clms,
           d.qty                                                                 AS Tot_30day_Fills,
           CAST(d.qty AS BIGINT) * 30                                            AS Tot_Day_Suply,
           d.cost                                                                AS Tot_Drug_Cst,
           CASE WHEN d.clms >= 2 THEN d.benes END                                AS Tot_Benes,
           CASE WHEN d.clms < 2 THEN '*' END                                     AS GE65_Sprsn_Flag,
           CASE WHEN d.clms >= 2 THEN d.clms END                                 AS GE65_Tot_Clms,
           CASE WHEN d.clms >= 2 THEN d.qty END                                  AS GE65_Tot_30day_Fills,
           CASE WHEN d.clms >= 2 THEN CAST(d.qty AS BIGINT) * 30 END             AS GE65_Tot_Day_Suply,
           CASE WHEN d.clms >= 2 THEN d.cost END                                 AS GE65_Tot_Drug_Cst,
           CASE WHEN d.benes < 2 THEN '#' END                                    AS GE65_Bene_Sprsn_Flag,
           CASE WHEN d.benes >= 2 THEN d.benes END                               AS GE65_Tot_Benes
    FROM d_lines d
    JOIN customer c ON d.o_custkey = c.c_custkey
    JOIN nation n   ON c.c_nationkey = n.n_nationkey
)"""

# provider rows of the two files: every order, by its customer in one file or in both
SIDES = tuple(f"""
{name} AS (SELECT {columns} FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE o.o_custkey % 3 <> {left_out})"""
              for name, columns, left_out in (("raw_b", PROVIDER_B, 0), ("raw_d", PROVIDER_D, 1)))

PEER_B = "PARTITION BY year, specialty, hcpcs_code, place_of_service"
PEER_D = "PARTITION BY year, specialty, brand_name"

FACT_B_BASE_COLS = """npi, hcpcs_code, place_of_service, specialty, state, ruca, tot_benes, tot_srvcs,
           tot_bene_day_srvcs, avg_submitted_charge, avg_medicare_allowed, avg_medicare_payment,
           avg_medicare_standardized, year"""
FACT_D_BASE_COLS = """npi, brand_name, generic_name, specialty, state, specialty_source, tot_claims,
           tot_30day_fills, tot_day_supply, tot_drug_cost, tot_benes, ge65_suppression_flag,
           ge65_tot_claims, ge65_tot_30day_fills, ge65_tot_day_supply, ge65_tot_drug_cost,
           ge65_bene_suppression_flag, ge65_tot_benes, year"""

FACT_B = f"""
fact_b_base AS (
    SELECT Rndrng_NPI AS npi, HCPCS_Cd AS hcpcs_code, Place_Of_Srvc AS place_of_service,
           Rndrng_Prvdr_Type AS specialty, Rndrng_Prvdr_State_Abrvtn AS state,
           Rndrng_Prvdr_RUCA AS ruca, Tot_Benes AS tot_benes, Tot_Srvcs AS tot_srvcs,
           Tot_Bene_Day_Srvcs AS tot_bene_day_srvcs, Avg_Sbmtd_Chrg AS avg_submitted_charge,
           Avg_Mdcr_Alowd_Amt AS avg_medicare_allowed, Avg_Mdcr_Pymt_Amt AS avg_medicare_payment,
           Avg_Mdcr_Stdzd_Amt AS avg_medicare_standardized, {YEAR} AS year
    FROM raw_b
),
fact_b_k AS (
    SELECT *,
           count(*) OVER ({PEER_B})                                            AS n_,
           count(*) OVER ({PEER_B} ORDER BY tot_srvcs)                         AS k1,
           count(*) OVER ({PEER_B} ORDER BY tot_benes)                         AS k2,
           count(*) OVER ({PEER_B} ORDER BY avg_medicare_standardized)         AS k3,
           count(*) OVER ({PEER_B} ORDER BY tot_srvcs * avg_medicare_payment)  AS k4
    FROM fact_b_base
),
fact_b AS (
    SELECT {FACT_B_BASE_COLS},
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k1', 'n_')} END AS tot_srvcs_pct,
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k2', 'n_')} END AS tot_benes_pct,
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k3', 'n_')} END AS avg_medicare_standardized_pct,
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k4', 'n_')} END AS total_medicare_payment_pct
    FROM fact_b_k
)"""

FACT_D = f"""
fact_d_base AS (
    SELECT Prscrbr_NPI AS npi, Brnd_Name AS brand_name, Gnrc_Name AS generic_name,
           Prscrbr_Type AS specialty, Prscrbr_State_Abrvtn AS state,
           Prscrbr_Type_Src AS specialty_source, Tot_Clms AS tot_claims,
           Tot_30day_Fills AS tot_30day_fills, Tot_Day_Suply AS tot_day_supply,
           Tot_Drug_Cst AS tot_drug_cost, Tot_Benes AS tot_benes,
           GE65_Sprsn_Flag AS ge65_suppression_flag, GE65_Tot_Clms AS ge65_tot_claims,
           GE65_Tot_30day_Fills AS ge65_tot_30day_fills, GE65_Tot_Day_Suply AS ge65_tot_day_supply,
           GE65_Tot_Drug_Cst AS ge65_tot_drug_cost, GE65_Bene_Sprsn_Flag AS ge65_bene_suppression_flag,
           GE65_Tot_Benes AS ge65_tot_benes, {YEAR} AS year
    FROM raw_d
),
fact_d_k AS (
    SELECT *,
           count(*) OVER ({PEER_D})                                                     AS n_,
           count(*) OVER ({PEER_D} ORDER BY tot_claims)                                 AS k1,
           count(*) OVER ({PEER_D} ORDER BY tot_drug_cost)                              AS k2,
           count(*) OVER ({PEER_D} ORDER BY tot_drug_cost / nullif(tot_claims, 0))      AS k3
    FROM fact_d_base
),
fact_d AS (
    SELECT {FACT_D_BASE_COLS},
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k1', 'n_')} END AS tot_claims_pct,
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k2', 'n_')} END AS tot_drug_cost_pct,
           CASE WHEN n_ >= {MIN_PEERS} THEN {rr('k3', 'n_')} END AS cost_per_claim_pct
    FROM fact_d_k
)"""

PCTS = [("p10", 0.10), ("p25", 0.25), ("p50", 0.50), ("p75", 0.75), ("p90", 0.90),
        ("p95", 0.95), ("p99", 0.99)]
PCT_COLS = ", ".join(n for n, _ in PCTS)


def _quantiles(value: str = "value", rounded: bool = False) -> str:
    parts = []
    for name, p in PCTS:
        q = f"quantile_cont({value}, {p})"
        parts.append(f"{'round(' + q + ', 6)' if rounded else q} AS {name}")
    return ",\n           ".join(parts)


PEER_STATS = f"""
ps_long AS (
    SELECT year, 'part_b' AS dataset, specialty, hcpcs_code AS code, place_of_service, npi,
           'tot_srvcs' AS measure, CAST(tot_srvcs AS DOUBLE) AS value FROM fact_b
    UNION ALL
    SELECT year, 'part_b', specialty, hcpcs_code, place_of_service, npi,
           'tot_benes', CAST(tot_benes AS DOUBLE) FROM fact_b
    UNION ALL
    SELECT year, 'part_b', specialty, hcpcs_code, place_of_service, npi,
           'avg_medicare_standardized', CAST(avg_medicare_standardized AS DOUBLE) FROM fact_b
    UNION ALL
    SELECT year, 'part_b', specialty, hcpcs_code, place_of_service, npi,
           'total_medicare_payment', CAST(tot_srvcs * avg_medicare_payment AS DOUBLE) FROM fact_b
    UNION ALL
    SELECT year, 'part_d', specialty, brand_name, CAST(NULL AS VARCHAR), npi,
           'tot_claims', CAST(tot_claims AS DOUBLE) FROM fact_d
    UNION ALL
    SELECT year, 'part_d', specialty, brand_name, CAST(NULL AS VARCHAR), npi,
           'tot_drug_cost', CAST(tot_drug_cost AS DOUBLE) FROM fact_d
    UNION ALL
    SELECT year, 'part_d', specialty, brand_name, CAST(NULL AS VARCHAR), npi,
           'cost_per_claim', CAST(tot_drug_cost / nullif(tot_claims, 0) AS DOUBLE) FROM fact_d
),
peer_stats AS (
    SELECT dataset, specialty, code, place_of_service, measure,
           count(DISTINCT npi) AS n_providers,
           count(*)            AS n_rows,
           {_quantiles()},
           year
    FROM ps_long
    WHERE value IS NOT NULL
    GROUP BY year, dataset, specialty, code, place_of_service, measure
    HAVING count(*) >= {MIN_PEERS}
)"""

BUILD = (RAW_B, RAW_D, FACT_B, FACT_D, PEER_STATS)
PS_ROUNDED = ("dataset, specialty, code, place_of_service, measure, n_providers, n_rows, "
              + ", ".join(f"round({n}, 6) AS {n}" for n, _ in PCTS) + ", year")


def q(*ctes: str, body: str) -> str:
    return with_(*ctes) + body


# ------------------------------------------------------------------ dimensions
# Part B's columns come first, Part D's fill what it leaves open: one grouped pass over the
# provider rows of both files, marked with the file they come from.
_B_ONLY = {"entity_type": "Ent_Cd", "middle_initial": "MI", "credentials": "Crdntls",
           "street1": "St1", "street2": "St2", "zip5": "Zip5", "country": "Cntry", "ruca": "RUCA",
           "ruca_desc": "RUCA_Desc", "medicare_participating": "Mdcr_Prtcptg_Ind"}
_EITHER = {"last_or_org_name": "Last_Org_Name", "first_name": "First_Name", "specialty": "Type",
           "city": "City", "state": "State_Abrvtn"}


def _providers() -> str:
    names = [*_EITHER, *_B_ONLY]
    of_b = ", ".join(f"Rndrng_Prvdr_{c} AS {a}" for a, c in (_EITHER | _B_ONLY).items())
    of_d = ", ".join([f"Prscrbr_{c} AS {a}" for a, c in _EITHER.items()]
                     + [f"NULL AS {a}" for a in _B_ONLY])
    first = ", ".join(
        f"coalesce(min({a}) FILTER (file = 'b'), min({a}) FILTER (file = 'd')) AS {a}"
        for a in names)
    return f"""
provider_rows AS (SELECT DISTINCT 'b' AS file, Rndrng_NPI AS npi, {of_b} FROM raw_b
    UNION ALL SELECT DISTINCT 'd', Prscrbr_NPI, {of_d} FROM raw_d),
dim_provider AS (SELECT npi, {first}, bool_or(file = 'b') AS in_part_b,
    bool_or(file = 'd') AS in_part_d FROM provider_rows GROUP BY npi)"""


PROVIDERS = _providers()
DIMS = PROVIDERS + """,
dim_hcpcs AS (
    SELECT hcpcs_code, list_min(texts) AS hcpcs_desc, list_min(flags) = 'Y' AS is_drug
    FROM (SELECT HCPCS_Cd AS hcpcs_code, list(DISTINCT HCPCS_Desc) AS texts,
                 list(DISTINCT HCPCS_Drug_Ind) AS flags FROM raw_b GROUP BY ALL)
),
dim_drug AS (SELECT DISTINCT Brnd_Name AS brand_name, Gnrc_Name AS generic_name FROM raw_d),
state_kind(state, category) AS (VALUES
    ('DC', 'district'), ('AS', 'territory'), ('GU', 'territory'), ('MP', 'territory'),
    ('PR', 'territory'), ('VI', 'territory'), ('FM', 'freely_associated'), ('AA', 'military'),
    ('AE', 'military'), ('AP', 'military'), ('XX', 'unknown'), ('ZZ', 'unknown')
),
seen_fips AS (
    SELECT 'b' AS file, Rndrng_Prvdr_State_Abrvtn AS state, Rndrng_Prvdr_State_FIPS AS fips
    FROM raw_b UNION SELECT 'd', Prscrbr_State_Abrvtn, Prscrbr_State_FIPS FROM raw_d
),
dim_geography AS (
    SELECT f.state, state_fips, coalesce(category, 'state') AS category,
           category IS NULL AS is_us_state
    FROM (SELECT state, greatest(min(fips) FILTER (file = 'b'), min(fips) FILTER (file = 'd'))
                 AS state_fips FROM seen_fips GROUP BY state) f
    LEFT JOIN state_kind k ON k.state = f.state
),
dim_ruca AS (
    SELECT ruca, list_min(texts) AS ruca_desc
    FROM (SELECT Rndrng_Prvdr_RUCA AS ruca, list(DISTINCT Rndrng_Prvdr_RUCA_Desc) AS texts
          FROM raw_b GROUP BY ALL) WHERE ruca IS NOT NULL
)"""

ALL = (RAW_B, RAW_D, FACT_B, FACT_D, PEER_STATS, DIMS)

# ------------------------------------------------------------------ checks (wide bodies)
def _grain(table: str, keys: str) -> str:
    """Keys that occur again, and all rows of such keys, from a running count of each key."""
    return f"""
SELECT count(*) FILTER (nth = 2) AS duplicate_keys,
       count(*) FILTER (nth > 1) + count(*) FILTER (nth = 2) AS rows_in_duplicate_keys
FROM (SELECT row_number() OVER (PARTITION BY {keys}) AS nth FROM {table})"""


CHECK_GRAIN_B = _grain("fact_b", "year, npi, hcpcs_code, place_of_service")
CHECK_GRAIN_D = _grain("fact_d", "year, npi, brand_name, generic_name")


def _ends(raw: str, npi: str, **columns: str) -> str:
    """Least and greatest value of each attribute by provider; they differ when it has more
    than one."""
    parts = ", ".join(f"min({c}) AS {a}, max({c}) AS {a}_to" for a, c in columns.items())
    return f"(SELECT {npi} AS npi, {parts} FROM {raw} GROUP BY ALL)"


_ATTRS = ("specialty", "name", "city")
ATTR_CTES = f"""
both_files AS (
    SELECT b.npi AS b_npi, d.npi AS d_npi, {", ".join(f"b.{a} AS b_{a}, b.{a}_to AS b_{a}_to, "
                                                      f"d.{a} AS d_{a}, d.{a}_to AS d_{a}_to"
                                                      for a in _ATTRS)}
    FROM {_ends("raw_b", "Rndrng_NPI", specialty="Rndrng_Prvdr_Type",
                name="Rndrng_Prvdr_Last_Org_Name", city="Rndrng_Prvdr_City")} b
    FULL JOIN {_ends("raw_d", "Prscrbr_NPI", specialty="Prscrbr_Type",
                     name="Prscrbr_Last_Org_Name", city="Prscrbr_City")} d ON b.npi = d.npi
)"""


def _check_attr() -> str:
    shared = "b_npi IS NOT NULL AND d_npi IS NOT NULL"
    out = ["count(b_npi) AS part_b_providers", "count(d_npi) AS part_d_providers",
           f"count(*) FILTER ({shared}) AS overlapping_npis"]
    for f in "bd":
        out += [f"count(*) FILTER ({f}_{a} <> {f}_{a}_to) AS part_{f}_npis_multi_{a}"
                for a in _ATTRS]
    for a in _ATTRS:
        out.append(f"count(*) FILTER ({shared} AND b_{a} IS DISTINCT FROM d_{a})"
                   f" AS {a}_disagreements")
        if a != "specialty":
            out.append(f"count(*) FILTER ({shared} AND upper(trim(b_{a})) IS DISTINCT FROM"
                       f" upper(trim(d_{a}))) AS {a}_disagreements_normalized")
    return "SELECT " + ", ".join(out) + " FROM both_files"


CHECK_ATTR = _check_attr()
CHECK_DIMS = """
SELECT b.codes AS dim_hcpcs_rows, m.codes AS hcpcs_codes_multi_desc,
       d.pairs AS dim_drug_rows, d.brands AS distinct_brands, d.generics AS distinct_generics,
       g.states AS dim_geography_rows, g.named AS geography_rows_labelled_state,
       b.areas AS dim_ruca_rows
FROM (SELECT count(DISTINCT HCPCS_Cd) AS codes, count(DISTINCT Rndrng_Prvdr_RUCA) AS areas
      FROM raw_b) b,
     (SELECT count(*) AS codes FROM (SELECT min(HCPCS_Desc) AS a, max(HCPCS_Desc) AS z FROM raw_b
                                     GROUP BY HCPCS_Cd) WHERE a <> z) m,
     (SELECT count(DISTINCT (Brnd_Name, Gnrc_Name)) AS pairs, count(DISTINCT Brnd_Name) AS brands,
             count(DISTINCT Gnrc_Name) AS generics FROM raw_d) d,
     (SELECT count(*) AS states, count(*) FILTER (is_us_state) AS named FROM dim_geography) g"""
PS_CHECK_CTES = """
fgb AS (SELECT DISTINCT year, specialty, hcpcs_code AS code, place_of_service
        FROM fact_b WHERE tot_srvcs_pct IS NOT NULL),
sgb AS (SELECT year, specialty, code, place_of_service FROM peer_stats
        WHERE dataset = 'part_b' AND measure = 'tot_srvcs'),
fgd AS (SELECT DISTINCT year, specialty, brand_name AS code, CAST(NULL AS VARCHAR) AS place_of_service
        FROM fact_d WHERE tot_claims_pct IS NOT NULL),
sgd AS (SELECT year, specialty, code, place_of_service FROM peer_stats
        WHERE dataset = 'part_d' AND measure = 'tot_claims')"""


def _setdiff(f: str, s: str) -> str:
    return (f"(SELECT count(*) FROM {f} FULL JOIN {s} ON {f}.year = {s}.year "
            f"AND {f}.specialty IS NOT DISTINCT FROM {s}.specialty "
            f"AND {f}.code IS NOT DISTINCT FROM {s}.code "
            f"AND {f}.place_of_service IS NOT DISTINCT FROM {s}.place_of_service "
            f"WHERE {f}.year IS NULL OR {s}.year IS NULL)")


_CHAIN = " AND ".join(f"{x} <= {y}" for (x, _), (y, _) in zip(PCTS, PCTS[1:]))
CHECK_PS = f"""
SELECT p.*, {_setdiff('fgb', 'sgb')} AS part_b_group_mismatch,
       {_setdiff('fgd', 'sgd')} AS part_d_group_mismatch,
       b.rest AS part_b_unscoreable_rows, d.rest AS part_d_unscoreable_rows,
       d.small AS part_d_unscoreable_rows_generic_key
FROM (SELECT count(*) AS peer_stats_rows, count(*) FILTER (dataset = 'part_b') AS part_b_rows,
             count(*) FILTER (dataset = 'part_d') AS part_d_rows,
             count(*) FILTER (n_rows < {MIN_PEERS}) AS groups_below_min_peers,
             count(*) FILTER (NOT ({_CHAIN})) AS non_monotonic_breakpoints,
             count(*) FILTER (n_providers <> n_rows) AS groups_with_repeat_providers
      FROM peer_stats) p,
     (SELECT count(*) - count(tot_srvcs_pct) AS rest FROM fact_b) b,
     (SELECT count(*) - count(tot_claims_pct) AS rest, count(*) FILTER (of_key < {MIN_PEERS}) AS small
      FROM (SELECT tot_claims_pct, count(*) OVER (PARTITION BY year, specialty, generic_name)
                   AS of_key FROM fact_d)) d"""

CHECK_SPECS = [
    # (check name, body, metrics, expect_zero, expect_at_most)
    ("grain_fact_part_b_service", CHECK_GRAIN_B, ["duplicate_keys", "rows_in_duplicate_keys"],
     ["duplicate_keys"], {}),
    ("grain_fact_part_d_drug", CHECK_GRAIN_D, ["duplicate_keys", "rows_in_duplicate_keys"],
     ["duplicate_keys"], {}),
    ("provider_attributes", CHECK_ATTR,
     ["part_b_providers", "part_d_providers", "overlapping_npis", "part_b_npis_multi_specialty",
      "part_d_npis_multi_specialty", "part_b_npis_multi_name", "part_d_npis_multi_name",
      "part_b_npis_multi_city", "part_d_npis_multi_city", "specialty_disagreements",
      "name_disagreements", "name_disagreements_normalized", "city_disagreements",
      "city_disagreements_normalized"],
     ["part_b_npis_multi_specialty", "part_d_npis_multi_specialty", "specialty_disagreements"],
     {}),
    ("reference_dims", CHECK_DIMS,
     ["dim_hcpcs_rows", "hcpcs_codes_multi_desc", "dim_drug_rows", "distinct_brands",
      "distinct_generics", "dim_geography_rows", "geography_rows_labelled_state",
      "dim_ruca_rows"],
     ["hcpcs_codes_multi_desc"], {"geography_rows_labelled_state": 50}),
    ("peer_stats", CHECK_PS,
     ["peer_stats_rows", "part_b_rows", "part_d_rows", "part_b_group_mismatch",
      "part_d_group_mismatch", "groups_below_min_peers", "non_monotonic_breakpoints",
      "groups_with_repeat_providers", "part_b_unscoreable_rows", "part_d_unscoreable_rows",
      "part_d_unscoreable_rows_generic_key"],
     ["part_b_group_mismatch", "part_d_group_mismatch", "groups_below_min_peers",
      "non_monotonic_breakpoints"], {}),
]


def _run_checks_sql() -> str:
    ctes = []
    parts = []
    for i, (name, body, metrics, zero, at_most) in enumerate(CHECK_SPECS):
        ctes.append(f"chk{i} AS ({body.strip()})")
        for m in metrics:
            if m in zero:
                exp, bound = "'= 0'", 0
            elif m in at_most:
                exp, bound = f"'<= {at_most[m]}'", at_most[m]
            else:
                exp, bound = "CAST(NULL AS VARCHAR)", None
            status = ("'info'" if bound is None else
                      f"CASE WHEN {m} <= {bound} THEN 'ok' ELSE 'FAIL' END")
            parts.append(f"SELECT '{name}' AS \"check\", '{m}' AS metric, "
                         f"CAST({m} AS BIGINT) AS value, {exp} AS expectation, "
                         f"{status} AS status FROM chk{i}")
    return with_(*ALL, ATTR_CTES, PS_CHECK_CTES, *ctes) + "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ serving
GB = "specialty = 'NATION_7' AND hcpcs_code = 'Brand#13' AND place_of_service IS NOT DISTINCT FROM 'O' AND year = 2023"
GD = "specialty = 'HOUSEHOLD' AND brand_name = 'Brand#7' AND year = 2023"
SB = ("dataset = 'part_b' AND specialty = 'NATION_7' AND code = 'Brand#13' "
      "AND place_of_service IS NOT DISTINCT FROM 'O' AND year = 2023")
SD = ("dataset = 'part_d' AND specialty = 'HOUSEHOLD' AND code = 'Brand#7' "
      "AND place_of_service IS NOT DISTINCT FROM NULL AND year = 2023")
R6 = ", ".join(f"round({n}, 6) AS {n}" for n, _ in PCTS)
CPC = "CAST(tot_drug_cost AS DOUBLE) / nullif(CAST(tot_claims AS DOUBLE), 0)"


def _title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda t: upper(t[1]) || lower(t[2:])), '')")


def _cands(fact: str, where: str, value: str, pct: str, limit: int, npi: bool = True) -> str:
    return f"""
SELECT {'top.npi, ' if npi else ''}p.last_or_org_name AS provider, p.first_name, p.city, top.state,
       top.value, top.percentile
FROM (SELECT f.npi, f.state, CAST({value} AS DOUBLE) AS value, 100 * f.{pct} AS percentile
      FROM {fact} f WHERE {where} AND f.{pct} IS NOT NULL
      QUALIFY row_number() OVER (ORDER BY value DESC, f.npi) <= {limit}) top
JOIN dim_provider p ON p.npi = top.npi ORDER BY top.value DESC, top.npi"""


def _fq(where: str, alias: str = "f") -> str:
    """Qualify the bare column names of a group predicate with a table alias."""
    out = where
    for c in ("specialty", "hcpcs_code", "brand_name", "place_of_service", "year"):
        out = out.replace(f"{c} ", f"{alias}.{c} ")
    return out


def _size_profile(src: str, keys: str, label: str, min_peers: int = 30) -> str:
    under_r = f"coalesce(sum(n) FILTER (WHERE n < {min_peers}), 0)"
    under_g = f"count(*) FILTER (WHERE n < {min_peers})"
    return f"""
SELECT '{label}' AS peer_key, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows,
       {rr('sum(n)', 'count(*)', 1)} AS mean_rows,
       quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99,
       max(n) AS max_rows, {under_g} AS groups_under_min, CAST({under_r} AS BIGINT) AS rows_under_min,
       {rr('100 * ' + under_g, 'count(*)', 1)} AS pct_groups_under_min,
       {rr('100 * ' + under_r, 'sum(n)', 2)} AS pct_rows_under_min
FROM (SELECT count(*) AS n FROM {src} GROUP BY {keys})"""


def _dist(src: str, measures: list) -> str:
    long = "\nUNION ALL ".join(f"SELECT '{n}' AS measure, CAST({e} AS DOUBLE) AS value FROM {src}"
                               for n, e in measures)
    at = ", ".join(f"{r6(f'quantile_cont(value, {p})')} AS {n}" for n, p in (
        ("p50", 0.5), ("p90", 0.9), ("p99", 0.99), ("p999", 0.999)))
    return f"""
SELECT measure, {at}, {r6('max(value)')} AS max, {r6('avg(value)')} AS mean,
       {r6('avg(value) / nullif(quantile_cont(value, 0.5), 0)')} AS mean_over_median
FROM ({long}) WHERE value IS NOT NULL GROUP BY measure ORDER BY measure"""


def _spread(src: str, keys: str, price: str, volume: str) -> str:
    return f"""
SELECT {keys}, n_rows, {r6('price[1]')} AS price_p50, {r6('price[2]')} AS price_p99,
       {r6('price[2] / nullif(price[1], 0)')} AS price_p99_over_p50,
       {r6('volume[1]')} AS volume_p50, {r6('volume[2]')} AS volume_p99,
       {r6('volume[2] / nullif(volume[1], 0)')} AS volume_p99_over_p50
FROM (SELECT {keys}, count(*) AS n_rows, quantile_cont({price}, [0.5, 0.99]) AS price,
             quantile_cont({volume}, [0.5, 0.99]) AS volume FROM {src} GROUP BY ALL)
WHERE n_rows >= 30 ORDER BY n_rows DESC, {keys} LIMIT 25"""


MEASURES_B = [(c, c) for c in ("Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt",
                               "Avg_Mdcr_Pymt_Amt", "Avg_Mdcr_Stdzd_Amt")] + [
    ("row_total_payment", "Tot_Srvcs * Avg_Mdcr_Pymt_Amt")]


def _null_profile(src: str, cols: list) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls FROM {src}"
        for c in cols)


def _lineitem_rank_sql() -> str:
    w = "PARTITION BY l_returnflag, l_linestatus"
    return f"""
WITH k AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
           l_extendedprice, l_quantity,
           count(*) OVER ({w}) AS n_,
           count(*) OVER ({w} ORDER BY l_extendedprice) AS k1,
           count(*) OVER ({w} ORDER BY l_quantity) AS k2
    FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
       l_extendedprice, l_quantity,
       CASE WHEN n_ >= 30 THEN {rr('k1', 'n_')} END AS price_pct,
       CASE WHEN n_ >= 30 THEN {rr('k2', 'n_')} END AS qty_pct
FROM k"""



# One row for each provider of either file: in which file it is, and the specialties it has there.
LISTED = """
listed AS (SELECT npi, bool_or(file = 'b') AS in_b, bool_or(file = 'd') AS in_d,
                  coalesce(list(DISTINCT specialty) FILTER (file = 'b'), []) AS in_b_as,
                  coalesce(list(DISTINCT specialty) FILTER (file = 'd'), []) AS in_d_as
           FROM (SELECT 'b' AS file, Rndrng_NPI AS npi, Rndrng_Prvdr_Type AS specialty FROM raw_b
                 UNION ALL SELECT 'd', Prscrbr_NPI, Prscrbr_Type FROM raw_d) GROUP BY npi)"""


def _largest(dataset: str, specialty: str) -> str:
    """The codes of a specialty with the provider count of their largest measure."""
    return f"""
largest AS (SELECT code, place_of_service AS pos, max(n_providers) AS n_providers
            FROM peer_stats WHERE dataset = '{dataset}' AND specialty = '{specialty}'
            GROUP BY ALL)"""


def oracle_sql() -> dict:
    from peerscope.schema import PART_D_COLUMNS

    A = ALL
    cpc_raw = "CAST(Tot_Drug_Cst AS DOUBLE) / nullif(CAST(Tot_Clms AS DOUBLE), 0)"
    out = {
        # build
        "fact_part_b_service": q(RAW_B, FACT_B, body="SELECT * FROM fact_b"),
        "fact_part_d_drug": q(RAW_D, FACT_D, body="SELECT * FROM fact_d"),
        "peer_stats": q(*BUILD, body=f"SELECT {PS_ROUNDED} FROM peer_stats"),
        "peer_stats_updated": q(*BUILD, body=f"SELECT {PS_ROUNDED} FROM peer_stats"),
        "peer_stats_hot": q(*BUILD, body=f"SELECT {PS_ROUNDED} FROM peer_stats"),
        "peer_rank": _lineitem_rank_sql(),
        "peer_rank_hot": _lineitem_rank_sql(),
        "peer_size": "SELECT l_orderkey, l_linenumber, l_partkey, "
                     "count(*) OVER (PARTITION BY l_partkey) AS peer_rows FROM lineitem",
        "project_rename": q(RAW_B, FACT_B, body="SELECT * EXCLUDE (year) FROM fact_b_base"),
        "derive_total_payment": q(RAW_B, FACT_B, body=(
            "SELECT npi, hcpcs_code, place_of_service, "
            "CAST(tot_srvcs * avg_medicare_payment AS DOUBLE) AS total_medicare_payment "
            "FROM fact_b_base")),
        "derive_cost_per_claim": q(RAW_D, FACT_D, body=(
            f"SELECT npi, brand_name, generic_name, {CPC} AS cost_per_claim FROM fact_d_base")),
        "unpivot_measures": q(RAW_D, FACT_D, body="""
SELECT * FROM (
    SELECT npi, brand_name, generic_name, 'tot_claims' AS measure, CAST(tot_claims AS DOUBLE) AS value FROM fact_d_base
    UNION ALL SELECT npi, brand_name, generic_name, 'tot_benes', CAST(tot_benes AS DOUBLE) FROM fact_d_base
    UNION ALL SELECT npi, brand_name, generic_name, 'ge65_tot_benes', CAST(ge65_tot_benes AS DOUBLE) FROM fact_d_base
) WHERE value IS NOT NULL"""),
        "dim_provider": q(RAW_B, RAW_D, DIMS, body="SELECT * FROM dim_provider"),
        "dim_provider_sides": q(*SIDES, PROVIDERS, body="SELECT * FROM dim_provider"),
        "dim_hcpcs": q(RAW_B, RAW_D, DIMS, body="SELECT * FROM dim_hcpcs"),
        "dim_drug": q(RAW_B, RAW_D, DIMS, body="SELECT * FROM dim_drug"),
        "dim_geography": q(RAW_B, RAW_D, DIMS, body="SELECT * FROM dim_geography"),
        "dim_ruca": q(RAW_B, RAW_D, DIMS, body="SELECT * FROM dim_ruca"),
        # checks
        "check_grain_part_b": q(RAW_B, FACT_B, body=CHECK_GRAIN_B),
        "check_grain_part_d": q(RAW_D, FACT_D, body=CHECK_GRAIN_D),
        "check_provider_attributes": q(RAW_B, RAW_D, ATTR_CTES, body=CHECK_ATTR),
        "check_provider_sides": q(*SIDES, ATTR_CTES, body=CHECK_ATTR),
        "check_reference_dims": q(RAW_B, RAW_D, DIMS, body=CHECK_DIMS),
        "check_peer_stats": q(*BUILD, PS_CHECK_CTES, body=CHECK_PS),
        "run_checks": _run_checks_sql(),
        "grain_check": _grain("lineitem", "l_orderkey, l_linenumber"),
        "unscoreable_rows": q(RAW_D, FACT_D, body=f"""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS unscoreable_rows
FROM (SELECT count(*) AS n FROM fact_d GROUP BY year, specialty, generic_name
      HAVING count(*) < {MIN_PEERS})"""),
        # serving
        "specialties": q(*BUILD, body=(
            "SELECT DISTINCT specialty FROM peer_stats WHERE dataset = 'part_b' ORDER BY 1")),
        "codes": q(*A, _largest("part_b", "NATION_7"), body="""
SELECT code, pos, hcpcs_desc AS label, n_providers
FROM largest LEFT JOIN (SELECT hcpcs_code AS code, hcpcs_desc FROM dim_hcpcs) USING (code)"""),
        "codes_drug": q(*A, _largest("part_d", "HOUSEHOLD"), """
names AS (SELECT brand_name AS code, array_to_string(list_sort(list(generic_name)), ', ') AS label
          FROM dim_drug WHERE generic_name IS NOT NULL GROUP BY brand_name)""", body="""
SELECT code, pos, label, n_providers FROM largest LEFT JOIN names USING (code)"""),
        "codes_unlabelled": q(*BUILD, body="""
SELECT code, place_of_service AS pos, code AS label, max(n_providers) AS n_providers
FROM peer_stats WHERE dataset = 'part_b' AND specialty = 'NATION_7'
GROUP BY code, place_of_service ORDER BY n_providers DESC, code, pos NULLS FIRST"""),
        "distribution": q(*BUILD, body=(
            f"SELECT n_providers, n_rows, {R6} FROM peer_stats WHERE {SB} AND measure = 'tot_srvcs'")),
        "distribution_drug": q(*BUILD, body=(
            f"SELECT n_providers, n_rows, {R6} FROM peer_stats WHERE {SD} AND measure = 'cost_per_claim'")),
        "distribution_curve": q(*BUILD, body="\nUNION ALL ".join(
            f"SELECT {int(round(p * 100))} AS percentile, round({n}, 6) AS value FROM peer_stats "
            f"WHERE {SB} AND measure = 'total_medicare_payment'" for n, p in PCTS)),
        "live_percentile": q(RAW_B, FACT_B, body=(
            "SELECT count(DISTINCT npi) FILTER (WHERE tot_srvcs IS NOT NULL) AS n_providers, "
            "count(tot_srvcs) AS n_rows, "
            + ", ".join(f"round(quantile_cont(tot_srvcs, {p}), 6) AS {n}" for n, p in PCTS)
            + f" FROM fact_b WHERE {GB}")),
        "live_percentile_hot": q(RAW_B, FACT_B, body=(
            "SELECT count(DISTINCT npi) FILTER (WHERE tot_srvcs IS NOT NULL) AS n_providers, "
            "count(tot_srvcs) AS n_rows, "
            + ", ".join(f"round(quantile_cont(tot_srvcs, {p}), 6) AS {n}" for n, p in PCTS)
            + f" FROM fact_b WHERE {GB}")),
        "outliers": q(*A, body=_cands("fact_b", _fq(GB), "f.tot_srvcs * f.avg_medicare_payment",
                                      "total_medicare_payment_pct", 25, npi=False)),
        "outliers_state": q(*A, body=_cands("fact_b", _fq(GB) + " AND f.state = 'TX'",
                                            "f.tot_srvcs", "tot_srvcs_pct", 25, npi=False)),
        "outliers_drug": q(*A, body=_cands(
            "fact_d", _fq(GD), "CAST(f.tot_drug_cost AS DOUBLE) / nullif(CAST(f.tot_claims AS DOUBLE), 0)",
            "cost_per_claim_pct", 25, npi=False)),
        "outliers_display": q(*A, body=f"""
SELECT npi, {_title('provider')} || ', ' || {_title('first_name')} AS provider, city, state,
       {shown('value', 1)} AS value, {shown('percentile', 1)} AS percentile
FROM ({_cands('fact_d', _fq(GD), 'f.tot_drug_cost', 'tot_drug_cost_pct', 25)})"""),
        "candidates": q(*A, body=_cands("fact_d", _fq(GD), "f.tot_claims", "tot_claims_pct", 200)),
        "provider_detail": q(*A, body=f"""
SELECT p.npi, p.last_or_org_name, p.first_name, p.credentials, p.city, f.state,
       CAST(f.tot_benes AS DOUBLE) AS value, 100 * f.tot_benes_pct AS percentile
FROM fact_b f JOIN dim_provider p USING (npi)
WHERE {_fq(GB)} AND f.npi = '0000000270'"""),
        "states": q(RAW_B, FACT_B, body=(
            "SELECT DISTINCT state FROM fact_b WHERE specialty = 'NATION_7' "
            "AND hcpcs_code = 'Brand#13' AND year = 2023 ORDER BY 1")),
        "drilldown": q(RAW_B, FACT_B, body=(
            f"SELECT npi, tot_srvcs, tot_srvcs_pct FROM fact_b WHERE {GB} "
            "ORDER BY tot_srvcs DESC, npi LIMIT 10")),
        "provider_vs_median": q(*BUILD, body=f"""
SELECT f.year, f.npi, f.specialty, f.brand_name AS code, CAST(NULL AS VARCHAR) AS place_of_service,
       f.generic_name, round({CPC.replace('tot_', 'f.tot_')}, 6) AS value,
       f.cost_per_claim_pct AS rank, round(s.p50, 6) AS p50,
       round(({CPC.replace('tot_', 'f.tot_')}) / nullif(s.p50, 0), 6) AS ratio_to_median
FROM fact_d f JOIN peer_stats s
  ON s.dataset = 'part_d' AND s.measure = 'cost_per_claim' AND s.year = f.year
 AND s.specialty = f.specialty AND s.code = f.brand_name
 AND s.place_of_service IS NOT DISTINCT FROM NULL
WHERE f.cost_per_claim_pct IS NOT NULL"""),
        "largest_peer_group": q(RAW_B, FACT_B, body="""
SELECT year, specialty, hcpcs_code, place_of_service, count(*) AS n_rows FROM fact_b
GROUP BY year, specialty, hcpcs_code, place_of_service
ORDER BY n_rows DESC, year, specialty, hcpcs_code, place_of_service LIMIT 1"""),
        "peer_group_rows": q(RAW_B, FACT_B, body=f"SELECT * FROM fact_b WHERE {GB}"),
        "null_safe_filter": q(*BUILD, body=(
            f"SELECT {PS_ROUNDED} FROM peer_stats WHERE place_of_service IS NOT DISTINCT FROM NULL "
            "AND code = 'Brand#7'")),
        # profiles
        "cardinality": q(RAW_B, body="""
SELECT count(DISTINCT Rndrng_NPI) AS providers, count(DISTINCT Rndrng_Prvdr_Type) AS specialties,
       count(DISTINCT HCPCS_Cd) AS hcpcs_codes, count(DISTINCT Rndrng_Prvdr_State_Abrvtn) AS states,
       count(DISTINCT Rndrng_Prvdr_RUCA) AS ruca_codes, count(DISTINCT Place_Of_Srvc) AS places_of_service,
       count(DISTINCT Rndrng_Prvdr_Ent_Cd) AS entity_types FROM raw_b"""),
        "null_profile": q(RAW_D, body=_null_profile("raw_d", PART_D_COLUMNS)),
        "part_b_nulls": q(RAW_B, body="""
SELECT count(*) AS rows, count(*) - count(Tot_Benes) AS tot_benes_null,
       count(*) - count(Tot_Srvcs) AS tot_srvcs_null, count(*) - count(Avg_Mdcr_Stdzd_Amt) AS stdzd_amt_null,
       count(*) - count(Rndrng_Prvdr_Type) AS specialty_null,
       count(*) - count(Rndrng_Prvdr_State_Abrvtn) AS state_null,
       count(*) - count(Rndrng_Prvdr_RUCA) AS ruca_null,
       count(*) FILTER (WHERE Rndrng_Prvdr_Cntry <> 'US') AS non_us_rows FROM raw_b"""),
        "suppression_report": q(RAW_D, body=f"""
SELECT count(*) AS rows, count(*) FILTER (WHERE Tot_Benes IS NULL) AS tot_benes_null,
       {rr('100 * count(*) FILTER (WHERE Tot_Benes IS NULL)', 'count(*)', 2)} AS tot_benes_null_pct,
       count(*) FILTER (WHERE GE65_Sprsn_Flag IS NOT NULL) AS ge65_suppressed,
       count(*) FILTER (WHERE GE65_Bene_Sprsn_Flag IS NOT NULL) AS ge65_bene_suppressed,
       count(*) FILTER (WHERE Tot_Clms IS NULL) AS tot_clms_null,
       count(*) FILTER (WHERE Tot_Drug_Cst IS NULL) AS tot_drug_cst_null FROM raw_d"""),
        "suppression_floor": q(RAW_B, body="""
SELECT min(Tot_Benes) AS min_tot_benes, min(Tot_Srvcs) AS min_tot_srvcs,
       min(Tot_Bene_Day_Srvcs) AS min_bene_day_srvcs,
       count(*) FILTER (WHERE Tot_Benes < 11) AS rows_below_11 FROM raw_b"""),
        "suppression_floor_drug": q(RAW_D, body="""
SELECT min(Tot_Clms) AS min_tot_clms, min(Tot_Benes) AS min_tot_benes,
       min(GE65_Tot_Benes) AS min_ge65_tot_benes,
       count(*) FILTER (Tot_Clms < 11) AS rows_below_11 FROM raw_d"""),
        "low_end_histogram": q(RAW_B, body=(
            "SELECT Tot_Benes, count(*) AS n_rows FROM raw_b WHERE Tot_Benes <= 20 "
            "GROUP BY 1 ORDER BY 1")),
        "low_end_histogram_services": q(RAW_B, body=(
            "SELECT Tot_Srvcs, count(*) AS n_rows FROM raw_b WHERE Tot_Srvcs <= 20 "
            "GROUP BY 1 ORDER BY 1")),
        "peer_key_variants_drug": q(RAW_D, body="\nUNION ALL ".join([
            _size_profile("raw_d", "Prscrbr_Type, Gnrc_Name", "specialty + generic"),
            _size_profile("raw_d", "Prscrbr_Type, Brnd_Name", "specialty + brand"),
            _size_profile("raw_d", "Prscrbr_Type, Gnrc_Name, Prscrbr_State_Abrvtn",
                          "specialty + generic + state")])),
        "group_size_profile": q(RAW_D, body=_size_profile("raw_d", "Prscrbr_Type, Gnrc_Name",
                                                          "specialty + generic")),
        "peer_key_variants": q(RAW_B, body="\nUNION ALL ".join([
            _size_profile("raw_b", "Rndrng_Prvdr_Type, HCPCS_Cd", "specialty + code"),
            _size_profile("raw_b", "Rndrng_Prvdr_Type, HCPCS_Cd, Place_Of_Srvc",
                          "specialty + code + place of service"),
            _size_profile("raw_b", "Rndrng_Prvdr_Type, HCPCS_Cd, Rndrng_Prvdr_RUCA",
                          "specialty + code + RUCA"),
            _size_profile("raw_b", "Rndrng_Prvdr_Type, HCPCS_Cd, Rndrng_Prvdr_State_Abrvtn",
                          "specialty + code + state")])),
        "measure_distribution": q(RAW_B, body=_dist("raw_b", MEASURES_B)),
        "measure_distribution_hot": q(RAW_B, body=_dist("raw_b", MEASURES_B)),
        "measure_distribution_drug": q(RAW_D, body=_dist("raw_d", [
            *((c, c) for c in ("Tot_Clms", "Tot_30day_Fills", "Tot_Day_Suply", "Tot_Drug_Cst",
                               "Tot_Benes")), ("cost_per_claim", cpc_raw)])),
        "within_group_spread": q(RAW_B, body=_spread(
            "raw_b", "Rndrng_Prvdr_Type, HCPCS_Cd", "Avg_Mdcr_Stdzd_Amt", "Tot_Srvcs")),
        "within_group_spread_drug": q(RAW_D, body=_spread(
            "raw_d", "Prscrbr_Type, Gnrc_Name", cpc_raw, "Tot_Clms::DOUBLE")),
        "key_spread_comparison": q(RAW_D, body=f"""
SELECT key_def, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows_covered,
       {r6('quantile_cont(ends[2] / ends[1], 0.5)')} AS median_p99_over_p50,
       {r6('quantile_cont(ends[2] / ends[1], 0.9)')} AS p90_p99_over_p50,
       {r6('max(ends[2] / ends[1])')} AS max_p99_over_p50
FROM (SELECT CASE WHEN grouping(Brnd_Name) = 1 THEN 'specialty + generic'
                  ELSE 'specialty + brand' END AS key_def, count(*) AS n,
             quantile_cont({cpc_raw}, [0.5, 0.99]) AS ends
      FROM raw_d GROUP BY GROUPING SETS ((Prscrbr_Type, Gnrc_Name), (Prscrbr_Type, Brnd_Name)))
WHERE n >= 30 AND ends[1] > 0 GROUP BY key_def ORDER BY key_def"""),
        "fanout_profile": q(RAW_D, body=f"""
SELECT len(ks) AS parents, len(list_filter(ks, lambda k: k = 1)) AS with_one,
       {rr('list_sum(ks)', 'len(ks)', 2)} AS mean_children,
       list_aggregate(ks, 'quantile_cont', 0.5) AS p50_children,
       list_aggregate(ks, 'quantile_cont', 0.9) AS p90_children, list_max(ks) AS max_children
FROM (SELECT list(k) AS ks FROM (SELECT count(Brnd_Name) AS k FROM (
        SELECT DISTINCT Gnrc_Name, Brnd_Name FROM raw_d) GROUP BY Gnrc_Name))"""),
        "provider_set_overlap": q(*SIDES, LISTED, body="""
SELECT count_if(in_b) AS part_b_providers, count_if(in_d) AS part_d_prescribers,
       count_if(in_b AND in_d) AS in_both, count_if(NOT in_d) AS part_b_only,
       count_if(NOT in_b) AS part_d_only FROM listed"""),
        "providers_in_both": q(*SIDES, body=(
            "SELECT Rndrng_NPI AS npi FROM raw_b INTERSECT SELECT Prscrbr_NPI AS npi FROM raw_d")),
        "providers_b_only": q(*SIDES, body=(
            "SELECT Rndrng_NPI AS npi FROM raw_b EXCEPT SELECT Prscrbr_NPI AS npi FROM raw_d")),
        "providers_d_only": q(*SIDES, body=(
            "SELECT Prscrbr_NPI AS npi FROM raw_d EXCEPT SELECT Rndrng_NPI AS npi FROM raw_b")),
        "provider_overlap": q(*SIDES, body="""
SELECT npi, specialty_b, specialty_d
FROM (SELECT DISTINCT Rndrng_NPI AS npi, Rndrng_Prvdr_Type AS specialty_b FROM raw_b)
JOIN (SELECT DISTINCT Prscrbr_NPI AS npi, Prscrbr_Type AS specialty_d FROM raw_d) USING (npi)"""),
        "multi_specialty": q(RAW_B, RAW_D, LISTED, body="""
SELECT dataset, sum(n)::BIGINT AS providers,
       coalesce(sum(n) FILTER (held > 1), 0)::BIGINT AS with_multiple_specialties,
       max(held) AS max_specialties
FROM (SELECT dataset, held, count(*) AS n FROM (
        SELECT 'part_b' AS dataset, len(in_b_as) AS held FROM listed WHERE in_b
        UNION ALL SELECT 'part_d', len(in_d_as) FROM listed WHERE in_d) GROUP BY dataset, held)
GROUP BY dataset"""),
        "specialty_agreement": q(*SIDES, LISTED, body=f"""
SELECT pairs AS npi_specialty_pairs, same AS exact_string_match,
       {rr('100 * same', 'pairs', 1)} AS pct_match
FROM (SELECT sum(len(in_b_as) * len(in_d_as))::BIGINT AS pairs,
             sum(len(list_intersect(in_b_as, in_d_as)))::BIGINT AS same
      FROM listed WHERE in_b AND in_d)"""),
        "specialty_mismatches": q(*SIDES, LISTED, body="""
SELECT specialty_b, specialty_d, count(*) AS n_providers
FROM (SELECT specialty_b, unnest(list_filter(in_d_as, lambda s: s <> specialty_b)) AS specialty_d
      FROM (SELECT unnest(in_b_as) AS specialty_b, in_d_as FROM listed WHERE in_b AND in_d))
GROUP BY ALL ORDER BY n_providers DESC, specialty_b, specialty_d LIMIT 30"""),
        "entity_split": q(*SIDES, body=f"""
SELECT entity, count(*) AS part_b_providers, count(*) FILTER (NOT in_d) AS part_b_only,
       {rr('100 * count(*) FILTER (NOT in_d)', 'count(*)', 1)} AS pct_not_in_part_d,
       max(codes) AS max_entity_codes_per_npi
FROM (SELECT npi, min(code) AS entity, count(DISTINCT code) AS codes, bool_or(file = 'b') AS in_b,
             bool_or(file = 'd') AS in_d
      FROM (SELECT 'b' AS file, Rndrng_NPI AS npi, Rndrng_Prvdr_Ent_Cd AS code FROM raw_b
            UNION ALL SELECT 'd', Prscrbr_NPI, NULL FROM raw_d) GROUP BY npi)
WHERE in_b GROUP BY entity ORDER BY entity"""),
        "provider_attribute_counts": q(RAW_D, body="""
SELECT Prscrbr_NPI AS npi, count(DISTINCT Prscrbr_Type) AS n_specialty,
       count(DISTINCT Prscrbr_Last_Org_Name) AS n_name, count(DISTINCT Prscrbr_City) AS n_city
FROM raw_d GROUP BY 1"""),
        "key_profile": """
SELECT count(*) AS rows, min(k) AS min_key, max(k) AS max_key, count(DISTINCT k) AS distinct_keys,
       count(*) FILTER (before > k) AS descending_steps,
       count(*) FILTER (before > k) = 0 AS is_sorted
FROM (SELECT o_custkey AS k, lag(o_custkey) OVER (ORDER BY o_orderkey) AS before FROM orders)""",
    }
    from peerscope.sources.registered import oracle_twins
    out.update(oracle_twins())
    return out
