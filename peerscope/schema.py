"""Declared schemas and the two registries (datasets, measures).

Identifiers (NPI, zip, FIPS, RUCA) are text, never numbers. Only the typed columns are
declared; everything else is read as a string, bound by header name.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerscope.functions.columns import safe_divide

# The raw column names of the two yearly files, in file order, and the
# declared types of the typed ones ("bigint" / "double"); every other column is a string.
PART_B_COLUMNS = [
    "Rndrng_NPI", "Rndrng_Prvdr_Last_Org_Name", "Rndrng_Prvdr_First_Name", "Rndrng_Prvdr_MI",
    "Rndrng_Prvdr_Crdntls", "Rndrng_Prvdr_Ent_Cd", "Rndrng_Prvdr_St1", "Rndrng_Prvdr_St2",
    "Rndrng_Prvdr_City", "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_State_FIPS",
    "Rndrng_Prvdr_Zip5", "Rndrng_Prvdr_RUCA", "Rndrng_Prvdr_RUCA_Desc", "Rndrng_Prvdr_Cntry",
    "Rndrng_Prvdr_Type", "Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "HCPCS_Cd", "HCPCS_Desc",
    "HCPCS_Drug_Ind", "Place_Of_Srvc", "Tot_Benes", "Tot_Srvcs", "Tot_Bene_Day_Srvcs",
    "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt", "Avg_Mdcr_Stdzd_Amt",
]
PART_B_TYPES = {
    "Tot_Benes": "bigint",
    "Tot_Srvcs": "double",
    "Tot_Bene_Day_Srvcs": "bigint",
    "Avg_Sbmtd_Chrg": "double",
    "Avg_Mdcr_Alowd_Amt": "double",
    "Avg_Mdcr_Pymt_Amt": "double",
    "Avg_Mdcr_Stdzd_Amt": "double",
}
PART_D_COLUMNS = [
    "Prscrbr_NPI", "Prscrbr_Last_Org_Name", "Prscrbr_First_Name", "Prscrbr_City",
    "Prscrbr_State_Abrvtn", "Prscrbr_State_FIPS", "Prscrbr_Type", "Prscrbr_Type_Src",
    "Brnd_Name", "Gnrc_Name", "Tot_Clms", "Tot_30day_Fills", "Tot_Day_Suply", "Tot_Drug_Cst",
    "Tot_Benes", "GE65_Sprsn_Flag", "GE65_Tot_Clms", "GE65_Tot_30day_Fills",
    "GE65_Tot_Day_Suply", "GE65_Tot_Drug_Cst", "GE65_Bene_Sprsn_Flag", "GE65_Tot_Benes",
]
PART_D_TYPES = {
    "Tot_Clms": "bigint",
    "Tot_30day_Fills": "double",
    "Tot_Day_Suply": "bigint",
    "Tot_Drug_Cst": "double",
    "Tot_Benes": "bigint",
    "GE65_Tot_Clms": "bigint",
    "GE65_Tot_30day_Fills": "double",
    "GE65_Tot_Day_Suply": "bigint",
    "GE65_Tot_Drug_Cst": "double",
    "GE65_Tot_Benes": "bigint",
}

# Build parameters (fixed values): minimum rows in a peer group before anyone in it is
# ranked, decimals kept on a rank, and the seven served breakpoints.
MIN_PEERS = 30
RANK_DECIMALS = 4
BREAKPOINTS = [("p10", 0.10), ("p25", 0.25), ("p50", 0.50), ("p75", 0.75),
               ("p90", 0.90), ("p95", 0.95), ("p99", 0.99)]


@dataclass(frozen=True)
class Measure:
    """A ranked measure: its name (== peer_stats.measure), the fact column holding its rank
    (name + '_pct') and a builder of its value from fact columns."""

    name: str
    value: callable

    @property
    def rank_col(self) -> str:
        return f"{self.name}_pct"

    def expr(self) -> Column:
        return self.value().cast("double")


@dataclass(frozen=True)
class DatasetSpec:
    name: str                 # 'part_b' / 'part_d'
    fact: str                 # fact table name
    code_col: str             # fact column playing the role of peer_stats.code
    peer: tuple               # peer key on the fact (without year)
    grain: tuple              # unique key of the fact (without year)
    sort: tuple               # physical sort of the written fact (after year)
    has_place_of_service: bool
    measures: tuple = field(default_factory=tuple)

    def measure(self, name: str) -> Measure:
        for m in self.measures:
            if m.name == name:
                return m
        raise KeyError(f"{self.name} has no measure {name!r}")


PART_B = DatasetSpec(
    name="part_b",
    fact="fact_part_b_service",
    code_col="hcpcs_code",
    peer=("specialty", "hcpcs_code", "place_of_service"),
    grain=("npi", "hcpcs_code", "place_of_service"),
    sort=("specialty", "hcpcs_code", "place_of_service", "npi"),
    has_place_of_service=True,
    measures=(
        Measure("tot_srvcs", lambda: F.col("tot_srvcs")),
        Measure("tot_benes", lambda: F.col("tot_benes")),
        Measure("avg_medicare_standardized", lambda: F.col("avg_medicare_standardized")),
        Measure("total_medicare_payment",
                lambda: F.col("tot_srvcs") * F.col("avg_medicare_payment")),
    ),
)

PART_D = DatasetSpec(
    name="part_d",
    fact="fact_part_d_drug",
    code_col="brand_name",
    peer=("specialty", "brand_name"),
    grain=("npi", "brand_name", "generic_name"),
    sort=("specialty", "brand_name", "generic_name", "npi"),
    has_place_of_service=False,
    measures=(
        Measure("tot_claims", lambda: F.col("tot_claims")),
        Measure("tot_drug_cost", lambda: F.col("tot_drug_cost")),
        Measure("cost_per_claim",
                lambda: safe_divide(F.col("tot_drug_cost"), F.col("tot_claims"))),
    ),
)

DATASETS = {"part_b": PART_B, "part_d": PART_D}

# The serving table's types; a build without any scoreable group writes no file to tell them.
PEER_STATS_SCHEMA = ("dataset string, specialty string, code string, place_of_service string, "
                     "measure string, n_providers bigint, n_rows bigint, "
                     + ", ".join(f"{name} double" for name, _ in BREAKPOINTS) + ", year int")
# Column order of the serving table (year is the partition column).
PEER_STATS_COLUMNS = ["dataset", "specialty", "code", "place_of_service", "measure",
                      "n_providers", "n_rows"] + [name for name, _ in BREAKPOINTS]
