"""Dimensions: provider, HCPCS, drug, geography, RUCA.

``any_value`` per column is replaced by ``min`` per column: it skips NULLs like the
original and is deterministic, so repeated builds agree byte for byte.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscope.operators.grain import ends_of_distinct

# State-code categories; every other code is a 'state'.
DISTRICT = ("DC",)
TERRITORIES = ("AS", "GU", "MP", "PR", "VI")
FREELY_ASSOCIATED = ("FM",)
MILITARY = ("AA", "AE", "AP")
UNKNOWN = ("XX", "ZZ")

PART_B_PROVIDER_COLS = [
    ("Rndrng_Prvdr_Ent_Cd", "entity_type"),
    ("Rndrng_Prvdr_Last_Org_Name", "last_or_org_name"),
    ("Rndrng_Prvdr_First_Name", "first_name"),
    ("Rndrng_Prvdr_MI", "middle_initial"),
    ("Rndrng_Prvdr_Crdntls", "credentials"),
    ("Rndrng_Prvdr_Type", "specialty"),
    ("Rndrng_Prvdr_St1", "street1"),
    ("Rndrng_Prvdr_St2", "street2"),
    ("Rndrng_Prvdr_Zip5", "zip5"),
    ("Rndrng_Prvdr_City", "city"),
    ("Rndrng_Prvdr_State_Abrvtn", "state"),
    ("Rndrng_Prvdr_Cntry", "country"),
    ("Rndrng_Prvdr_RUCA", "ruca"),
    ("Rndrng_Prvdr_RUCA_Desc", "ruca_desc"),
    ("Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "medicare_participating"),
]
PART_D_PROVIDER_COLS = [
    ("Prscrbr_Last_Org_Name", "last_or_org_name"),
    ("Prscrbr_First_Name", "first_name"),
    ("Prscrbr_Type", "specialty"),
    ("Prscrbr_City", "city"),
    ("Prscrbr_State_Abrvtn", "state"),
]
# Attributes present on both sides: Part B wins, Part D fills its NULLs.
SHARED = ("last_or_org_name", "first_name", "specialty", "city", "state")
DIM_PROVIDER_COLUMNS = [
    "npi", "entity_type", "last_or_org_name", "first_name", "middle_initial", "credentials",
    "specialty", "street1", "street2", "zip5", "city", "state", "country", "ruca", "ruca_desc",
    "medicare_participating", "in_part_b", "in_part_d",
]


def collapse(raw: DataFrame, key: str, cols) -> DataFrame:
    """One row per key, first non-NULL (here: smallest) value per column (A1)."""
    return ends_of_distinct(raw.select(key, *[a for a, _ in cols]), key, "npi",
                            [F.min(a).alias(b) for a, b in cols])


def dim_provider(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    b = collapse(raw_b, "Rndrng_NPI", PART_B_PROVIDER_COLS).withColumn("_in_b", F.lit(True))
    d = collapse(raw_d, "Prscrbr_NPI", PART_D_PROVIDER_COLS).withColumn("_in_d", F.lit(True))
    d = d.select("npi", "_in_d", *[F.col(c).alias(f"d_{c}") for c in SHARED])
    j = b.join(d, "npi", "full_outer")     # sort-merge; both sides already hashed on npi
    out = []
    for c in DIM_PROVIDER_COLUMNS:
        if c == "npi":
            out.append(F.col("npi"))
        elif c in SHARED:
            out.append(F.coalesce(F.col(c), F.col(f"d_{c}")).alias(c))
        elif c == "in_part_b":
            out.append(F.col("_in_b").isNotNull().alias(c))
        elif c == "in_part_d":
            out.append(F.col("_in_d").isNotNull().alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


#: Columns of Part B that its three small dimensions are made from.
DOMAINS = {
    "dim_hcpcs": ("HCPCS_Cd", "HCPCS_Desc", "HCPCS_Drug_Ind"),
    "dim_geography": ("Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_State_FIPS"),
    "dim_ruca": ("Rndrng_Prvdr_RUCA", "Rndrng_Prvdr_RUCA_Desc"),
}


def domains(raw_b: DataFrame) -> DataFrame:
    """The distinct rows of each of ``DOMAINS``, told apart by ``_set``, from one scan: grouping
    sets, added up on the map side to a few thousand rows."""
    columns = [c for cols in DOMAINS.values() for c in cols]
    sets = [[F.col(c) for c in cols] for cols in DOMAINS.values()]
    found = raw_b.groupingSets(sets, *columns).agg(F.grouping_id().alias("_gid"))
    name = F.coalesce(*[F.when(F.col("_gid") == sum(
        1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in cols), F.lit(n))
        for n, cols in DOMAINS.items()])
    return found.select(name.alias("_set"), *columns)


def dim_hcpcs(raw_b: DataFrame) -> DataFrame:
    return ends_of_distinct(
        raw_b.select("HCPCS_Cd", "HCPCS_Desc", "HCPCS_Drug_Ind"), "HCPCS_Cd", "hcpcs_code",
        [F.min("HCPCS_Desc").alias("hcpcs_desc"),
         (F.min("HCPCS_Drug_Ind") == "Y").alias("is_drug")])


def dim_drug(raw_d: DataFrame) -> DataFrame:
    return raw_d.select(F.col("Brnd_Name").alias("brand_name"),
                        F.col("Gnrc_Name").alias("generic_name")).distinct()


def geography_category(state):
    return (F.when(state.isin(*DISTRICT), "district")
            .when(state.isin(*TERRITORIES), "territory")
            .when(state.isin(*FREELY_ASSOCIATED), "freely_associated")
            .when(state.isin(*MILITARY), "military")
            .when(state.isin(*UNKNOWN), "unknown")
            .otherwise("state"))


def dim_geography(raw_b: DataFrame, raw_d: DataFrame) -> DataFrame:
    def observed(raw, state, fips):
        return ends_of_distinct(raw.select(state, fips), state, "state",
                                [F.min(fips).alias("state_fips")])

    merged = observed(raw_b, "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_State_FIPS").unionByName(
        observed(raw_d, "Prscrbr_State_Abrvtn", "Prscrbr_State_FIPS")
    ).groupBy("state").agg(F.max("state_fips").alias("state_fips"))
    cat = geography_category(F.col("state"))
    return merged.select("state", "state_fips", cat.alias("category"),
                         (cat == "state").alias("is_us_state"))


def dim_ruca(raw_b: DataFrame) -> DataFrame:
    known = raw_b.filter(F.col("Rndrng_Prvdr_RUCA").isNotNull())
    return ends_of_distinct(known.select("Rndrng_Prvdr_RUCA", "Rndrng_Prvdr_RUCA_Desc"),
                            "Rndrng_Prvdr_RUCA", "ruca",
                            [F.min("Rndrng_Prvdr_RUCA_Desc").alias("ruca_desc")])
