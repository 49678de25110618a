"""Fact tables: raw lines renamed to the model, plus the precomputed peer ranks.

All ranks of one fact share a single Exchange on the peer key (plus ``year``, so two
yearly builds are never pooled); each measure adds one Sort + Window on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.operators.rank import DEFAULT_HOT_ROWS, find_hot, peer_rank
from peerscope.schema import MIN_PEERS, PART_B, PART_D, RANK_DECIMALS

# Raw -> model column names of the two facts, in output order.
PART_B_RENAMES = [
    ("Rndrng_NPI", "npi"),
    ("HCPCS_Cd", "hcpcs_code"),
    ("Place_Of_Srvc", "place_of_service"),
    ("Rndrng_Prvdr_Type", "specialty"),
    ("Rndrng_Prvdr_State_Abrvtn", "state"),
    ("Rndrng_Prvdr_RUCA", "ruca"),
    ("Tot_Benes", "tot_benes"),
    ("Tot_Srvcs", "tot_srvcs"),
    ("Tot_Bene_Day_Srvcs", "tot_bene_day_srvcs"),
    ("Avg_Sbmtd_Chrg", "avg_submitted_charge"),
    ("Avg_Mdcr_Alowd_Amt", "avg_medicare_allowed"),
    ("Avg_Mdcr_Pymt_Amt", "avg_medicare_payment"),
    ("Avg_Mdcr_Stdzd_Amt", "avg_medicare_standardized"),
]
PART_D_RENAMES = [
    ("Prscrbr_NPI", "npi"),
    ("Brnd_Name", "brand_name"),
    ("Gnrc_Name", "generic_name"),
    ("Prscrbr_Type", "specialty"),
    ("Prscrbr_State_Abrvtn", "state"),
    ("Prscrbr_Type_Src", "specialty_source"),
    ("Tot_Clms", "tot_claims"),
    ("Tot_30day_Fills", "tot_30day_fills"),
    ("Tot_Day_Suply", "tot_day_supply"),
    ("Tot_Drug_Cst", "tot_drug_cost"),
    ("Tot_Benes", "tot_benes"),
    ("GE65_Sprsn_Flag", "ge65_suppression_flag"),
    ("GE65_Tot_Clms", "ge65_tot_claims"),
    ("GE65_Tot_30day_Fills", "ge65_tot_30day_fills"),
    ("GE65_Tot_Day_Suply", "ge65_tot_day_supply"),
    ("GE65_Tot_Drug_Cst", "ge65_tot_drug_cost"),
    ("GE65_Bene_Sprsn_Flag", "ge65_bene_suppression_flag"),
    ("GE65_Tot_Benes", "ge65_tot_benes"),
]


def project_rename(raw: DataFrame, renames) -> DataFrame:
    """Rename + project to model names."""
    return raw.select(*[F.col(a).alias(b) for a, b in renames])


def hot_groups(raw: DataFrame, renames, spec, year: int, hot_rows):
    """Probe the dataset's peer groups once (see ``operators.rank.find_hot``); the result
    serves both the ranks and the serving table of the same build."""
    base = project_rename(raw, renames).withColumn("year", F.lit(int(year)))
    return find_hot(base, ["year", *spec.peer], hot_rows)


def _build(raw: DataFrame, renames, spec, year: int, min_peers: int, decimals: int,
           hot_rows, range_partitions, hot=None) -> DataFrame:
    base = project_rename(raw, renames).withColumn("year", F.lit(int(year)))
    measures = {m.rank_col: m.expr() for m in spec.measures}
    return peer_rank(base, ["year", *spec.peer], measures, min_peers=min_peers,
                     decimals=decimals, hot_rows=hot_rows, range_partitions=range_partitions,
                     range_keys=list(spec.peer), hot=hot)   # year is constant in one build


def fact_part_b_service(raw_b: DataFrame, year: int = 2023, *, min_peers: int = MIN_PEERS,
                        decimals: int = RANK_DECIMALS, hot_rows=DEFAULT_HOT_ROWS,
                        range_partitions: int | None = None, hot=None) -> DataFrame:
    """One row per (npi, hcpcs_code, place_of_service); four ``_pct`` ranks inside
    (specialty, hcpcs_code, place_of_service)."""
    return _build(raw_b, PART_B_RENAMES, PART_B, year, min_peers, decimals, hot_rows,
                  range_partitions, hot)


def fact_part_d_drug(raw_d: DataFrame, year: int = 2023, *, min_peers: int = MIN_PEERS,
                     decimals: int = RANK_DECIMALS, hot_rows=DEFAULT_HOT_ROWS,
                     range_partitions: int | None = None, hot=None) -> DataFrame:
    """One row per (npi, brand_name, generic_name); three ``_pct`` ranks inside
    (specialty, brand_name) — the peer key is coarser than the grain."""
    return _build(raw_d, PART_D_RENAMES, PART_D, year, min_peers, decimals, hot_rows,
                  range_partitions, hot)
