"""Raw claim-file-shaped inputs derived from the driver's TPC-H-like tables.

The library operators expect the two raw yearly files (Part B service lines, Part D drug
lines) with their original column names. The test data has no such files, so these
functions derive rows of exactly that shape from ``lineitem ⋈ orders ⋈ customer ⋈ part ⋈
nation``; every operator then runs unchanged on them and its work grows with the tables.

Mapping (fixed; the SQL twin in ``peerscope.oracle`` must say the same):

* provider  = customer: NPI = c_custkey left-padded to 10 digits, name = c_name;
* Part B lines are all lines, grain (customer, p_brand, l_linestatus):
  specialty = n_name, HCPCS code = p_brand, place of service = l_linestatus,
  Tot_Benes = distinct orders, Tot_Srvcs = sum(l_quantity), Tot_Bene_Day_Srvcs = lines,
  submitted/standardized = max(l_extendedprice), allowed/payment = min(l_extendedprice);
* Part D lines are all lines, grain (customer, p_brand, p_type):
  specialty = c_mktsegment, brand = p_brand, generic = p_type, Tot_Clms = lines,
  Tot_Drug_Cst = round(sum(l_extendedprice), 2), Tot_Benes blanked when Tot_Clms < 2;
* state and FIPS from c_mktsegment, RUCA from n_regionkey, city from c_nationkey;
* the provider sides (``provider_sides``) deal all orders to the two files by their customer, so
  that each side has providers the other lacks.

Measures are exact (counts, sums of integral quantities, max/min, 2-dp rounded sums), so
ranks and percentiles can be compared bit for bit with another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscope.sources.parquet import partitions_for

#: Parquet bytes of ``lineitem`` for each partition of the joined lines: some 300,000 lines, which
#: a task joins and groups in a few hundred MB whatever the session's partition settings are.
LINE_BYTES = 4 * 1024 * 1024

# State code and FIPS per market segment (Part B leaves XX's FIPS blank,
# Part D reports 99), and RUCA code per region key (region 4 has none).
SEGMENT_STATE = {
    "AUTOMOBILE": ("CA", "06"),
    "BUILDING": ("DC", "11"),
    "FURNITURE": ("PR", "72"),
    "HOUSEHOLD": ("TX", "48"),
    "MACHINERY": ("XX", None),
}
PART_D_UNKNOWN_FIPS = "99"
REGION_RUCA = {0: "1", 1: "1.0", 2: "2", 3: "10.1"}
DRUG_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
NOT_IN_B, NOT_IN_D = 0, 1


def load_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "orders", "customer",
                                                         "part", "nation")) -> dict:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _case_map(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def line_partitions(lineitem: DataFrame) -> int:
    """Partitions of the joined lines, from the bytes of the files: in proportion to the input,
    so that a task's share, and with it its memory, stays the same as the input grows."""
    spark = lineitem.sparkSession
    files = lineitem.inputFiles()
    return max(1, sum(partitions_for(spark, f, LINE_BYTES, minimum=1) for f in files))


def _lines(t: dict) -> DataFrame:
    """All lines with their order's customer and their part, dealt by customer. Every exchange
    has the same number of partitions, which adaptive execution does not merge again; rows whose
    keys are null meet nothing and are not moved."""
    n = line_partitions(t["lineitem"])
    by = lambda df, key: df.filter(F.col(key).isNotNull()).repartition(n, key)
    orders = t["orders"].select("o_orderkey", "o_custkey")
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                              "l_linestatus").filter(F.col("l_partkey").isNotNull())
    part = t["part"].select("p_partkey", "p_brand", "p_type")
    lines = by(li, "l_orderkey").join(
        by(orders.filter(F.col("o_custkey").isNotNull()), "o_orderkey"),
        F.col("l_orderkey") == F.col("o_orderkey"))
    lines = by(lines, "l_partkey").join(by(part, "p_partkey"),
                                        F.col("l_partkey") == F.col("p_partkey"))
    return by(lines, "o_custkey")


def _customers(t: dict) -> DataFrame:
    return (t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
            .join(t["nation"].select("n_nationkey", "n_name", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey")))


def _npi(col):
    return F.lpad(col.cast("string"), 10, "0")


def _provider_b() -> list:
    """The provider columns of Part B, over customer and nation columns."""
    seg = F.col("c_mktsegment")
    state = _case_map(seg, {k: v[0] for k, v in SEGMENT_STATE.items()})
    fips = _case_map(seg, {k: v[1] for k, v in SEGMENT_STATE.items()})
    ruca = _case_map(F.col("n_regionkey"), REGION_RUCA)
    nation_txt = F.col("c_nationkey").cast("string")
    return [
        _npi(F.col("c_custkey")).alias("Rndrng_NPI"),
        F.col("c_name").alias("Rndrng_Prvdr_Last_Org_Name"),
        F.when(seg != "BUILDING", F.concat(F.lit("FN"), nation_txt))
         .alias("Rndrng_Prvdr_First_Name"),
        F.lit(None).cast("string").alias("Rndrng_Prvdr_MI"),
        F.when(seg != "AUTOMOBILE", F.lit("M.D.")).alias("Rndrng_Prvdr_Crdntls"),
        F.when(seg == "AUTOMOBILE", F.lit("O")).otherwise(F.lit("I")).alias("Rndrng_Prvdr_Ent_Cd"),
        F.concat(F.lit("STREET "), F.col("c_custkey").cast("string")).alias("Rndrng_Prvdr_St1"),
        F.lit(None).cast("string").alias("Rndrng_Prvdr_St2"),
        F.concat(F.lit("CITY "), nation_txt).alias("Rndrng_Prvdr_City"),
        state.alias("Rndrng_Prvdr_State_Abrvtn"),
        fips.alias("Rndrng_Prvdr_State_FIPS"),
        F.lpad((F.col("c_nationkey") * 1000).cast("string"), 5, "0").alias("Rndrng_Prvdr_Zip5"),
        ruca.alias("Rndrng_Prvdr_RUCA"),
        F.concat(F.lit("RUCA "), ruca).alias("Rndrng_Prvdr_RUCA_Desc"),
        F.lit("US").alias("Rndrng_Prvdr_Cntry"),
        F.col("n_name").alias("Rndrng_Prvdr_Type"),
        F.lit("Y").alias("Rndrng_Prvdr_Mdcr_Prtcptg_Ind"),
    ]


def raw_part_b(t: dict) -> DataFrame:
    agg = (_lines(t)
           .groupBy("o_custkey", "p_brand", "l_linestatus")
           .agg(F.count_distinct("l_orderkey").cast("long").alias("Tot_Benes"),
                F.sum("l_quantity").cast("double").alias("Tot_Srvcs"),
                F.count(F.lit(1)).cast("long").alias("Tot_Bene_Day_Srvcs"),
                F.max("l_extendedprice").alias("hi"),
                F.min("l_extendedprice").alias("lo")))
    c = _customers(t)
    j = agg.join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.select(
        *_provider_b(),
        F.col("p_brand").alias("HCPCS_Cd"),
        F.concat(F.lit("PROCEDURE "), F.col("p_brand")).alias("HCPCS_Desc"),
        F.when(F.col("p_brand").isin(*DRUG_BRANDS), F.lit("Y")).otherwise(F.lit("N"))
         .alias("HCPCS_Drug_Ind"),
        F.col("l_linestatus").alias("Place_Of_Srvc"),
        "Tot_Benes", "Tot_Srvcs", "Tot_Bene_Day_Srvcs",
        F.col("hi").alias("Avg_Sbmtd_Chrg"),
        F.col("lo").alias("Avg_Mdcr_Alowd_Amt"),
        F.col("lo").alias("Avg_Mdcr_Pymt_Amt"),
        F.col("hi").alias("Avg_Mdcr_Stdzd_Amt"),
    )


def _provider_d() -> list:
    """The provider columns of Part D, over customer and nation columns."""
    seg = F.col("c_mktsegment")
    nation_txt = F.col("c_nationkey").cast("string")
    city = F.concat(F.lit("CITY "), nation_txt)
    return [
        _npi(F.col("c_custkey")).alias("Prscrbr_NPI"),
        F.when(seg == "HOUSEHOLD", F.concat(F.lit(" "), F.upper("c_name")))
         .otherwise(F.col("c_name")).alias("Prscrbr_Last_Org_Name"),
        F.concat(F.lit("FN"), nation_txt).alias("Prscrbr_First_Name"),
        F.when(F.col("n_regionkey") == 1, F.lower(city))
         .when(F.col("n_regionkey") == 2, F.concat(F.lit("TOWN "), nation_txt))
         .otherwise(city).alias("Prscrbr_City"),
        _case_map(seg, {k: v[0] for k, v in SEGMENT_STATE.items()}).alias("Prscrbr_State_Abrvtn"),
        F.coalesce(_case_map(seg, {k: v[1] for k, v in SEGMENT_STATE.items()}),
                   F.lit(PART_D_UNKNOWN_FIPS)).alias("Prscrbr_State_FIPS"),
        seg.alias("Prscrbr_Type"),
    ]


def raw_part_d(t: dict) -> DataFrame:
    agg = (_lines(t)
           .groupBy("o_custkey", "p_brand", "p_type")
           .agg(F.count(F.lit(1)).cast("long").alias("clms"),
                F.count_distinct("l_orderkey").cast("long").alias("benes"),
                F.sum("l_quantity").cast("double").alias("qty"),
                F.round(F.sum("l_extendedprice"), 2).alias("cost")))
    c = _customers(t)
    j = agg.join(c, F.col("o_custkey") == F.col("c_custkey"))
    big = F.col("clms") >= 2
    return j.select(
        *_provider_d(),
        F.lit("S").alias("Prscrbr_Type_Src"),
        F.col("p_brand").alias("Brnd_Name"),
        F.col("p_type").alias("Gnrc_Name"),
        F.col("clms").alias("Tot_Clms"),
        F.col("qty").alias("Tot_30day_Fills"),
        (F.col("qty").cast("long") * 30).alias("Tot_Day_Suply"),
        F.col("cost").alias("Tot_Drug_Cst"),
        F.when(big, F.col("benes")).alias("Tot_Benes"),
        F.when(~big, F.lit("*")).alias("GE65_Sprsn_Flag"),
        F.when(big, F.col("clms")).alias("GE65_Tot_Clms"),
        F.when(big, F.col("qty")).alias("GE65_Tot_30day_Fills"),
        F.when(big, F.col("qty").cast("long") * 30).alias("GE65_Tot_Day_Suply"),
        F.when(big, F.col("cost")).alias("GE65_Tot_Drug_Cst"),
        F.when(F.col("benes") < 2, F.lit("#")).alias("GE65_Bene_Sprsn_Flag"),
        F.when(F.col("benes") >= 2, F.col("benes")).alias("GE65_Tot_Benes"),
    )


def raw_inputs(spark: SparkSession, sf_dir: str):
    t = load_tables(spark, sf_dir)
    return raw_part_b(t), raw_part_d(t)


def provider_sides(spark: SparkSession, sf_dir: str):
    """Provider rows of the two files, one for each order: of three customers in a row, one has
    its orders in Part D only, one in Part B only and one in both."""
    t = load_tables(spark, sf_dir, ("orders", "customer", "nation"))

    def side(left_out, columns):
        orders = t["orders"].filter(F.col("o_custkey") % 3 != left_out).select("o_custkey")
        return (orders.join(_customers(t), F.col("o_custkey") == F.col("c_custkey"))
                .select(*columns))
    return side(NOT_IN_B, _provider_b()), side(NOT_IN_D, _provider_d())
