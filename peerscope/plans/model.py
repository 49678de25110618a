"""The built model as lazy DataFrames: raw inputs -> dimensions, facts, peer_stats.

``Model`` holds one set of plans per input; nothing is computed until an action. The
pipeline in ``plans.build`` materialises the same plans to Parquet in two passes; queries
and tests can use the plans directly.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from peerscope.operators.percentiles import PERCENTILE_ROWS
from peerscope.operators.rank import DEFAULT_HOT_ROWS
from peerscope.plans import dims, facts, stats
from peerscope.schema import MIN_PEERS, PART_B, PART_D, RANK_DECIMALS
from peerscope.session import release, scratch_path
from peerscope.sources.parquet import FACT_BYTES, input_partitions


@dataclass
class Model:
    raw_b: DataFrame
    raw_d: DataFrame
    year: int = 2023
    min_peers: int = MIN_PEERS
    decimals: int = RANK_DECIMALS
    hot_rows: int | None = DEFAULT_HOT_ROWS
    percentile_rows: int | None = PERCENTILE_ROWS
    extra: dict = field(default_factory=dict)
    #: metrics by name that were taken while the tables were written
    observed: dict | None = None
    #: whether raw inputs that are read more than once are written out for it; for inputs that
    #: are themselves the result of joins, which every reading would compute again
    keep: bool = False

    def _kept(self, raw: DataFrame, name: str, columns=None) -> DataFrame:
        if not self.keep:
            return raw
        path = scratch_path(raw.sparkSession, name)
        raw.select(*(columns or raw.columns)).write.option("compression", "zstd").parquet(path)
        release(raw.sparkSession)  # the joins of the next one need the disk
        return raw.sparkSession.read.parquet(path)

    @cached_property
    def lines_b(self) -> DataFrame:
        """What the fact needs of the raw rows; its probe, its ranks and its readers share it."""
        return self._kept(self.raw_b, "lines_b", [c for c, _ in facts.PART_B_RENAMES])

    @cached_property
    def lines_d(self) -> DataFrame:
        return self._kept(self.raw_d, "lines_d", [c for c, _ in facts.PART_D_RENAMES])

    @cached_property
    def kept(self) -> Model:
        """The model for readers that need the whole raw inputs several times."""
        return replace(self, raw_b=self._kept(self.raw_b, "raw_b"),
                       raw_d=self._kept(self.raw_d, "raw_d"), keep=False) if self.keep else self

    @cached_property
    def hot_b(self):
        """One hot-group probe per dataset, shared by all its ranks."""
        return facts.hot_groups(self.lines_b, facts.PART_B_RENAMES, PART_B, self.year,
                                self.hot_rows)

    @cached_property
    def hot_d(self):
        return facts.hot_groups(self.lines_d, facts.PART_D_RENAMES, PART_D, self.year,
                                self.hot_rows)

    @cached_property
    def fact_b(self) -> DataFrame:
        return facts.fact_part_b_service(self.lines_b, self.year, min_peers=self.min_peers,
                                         decimals=self.decimals, hot_rows=self.hot_rows,
                                         hot=self.hot_b)

    @cached_property
    def fact_d(self) -> DataFrame:
        return facts.fact_part_d_drug(self.lines_d, self.year, min_peers=self.min_peers,
                                      decimals=self.decimals, hot_rows=self.hot_rows,
                                      hot=self.hot_d)

    def dealt_fact(self, dataset: str) -> DataFrame:
        """A fact for a reader that takes it whole, ranks and all: dealt by the peer key into a
        partition for each ``FACT_BYTES`` of lines, so that what a task sorts for each rank does
        not grow with the input, whatever the session's partitions. Readers of other columns need
        no such exchange."""
        make, lines, hot, renames, spec = {
            "part_b": (facts.fact_part_b_service, self.lines_b, self.hot_b, facts.PART_B_RENAMES,
                       PART_B),
            "part_d": (facts.fact_part_d_drug, self.lines_d, self.hot_d, facts.PART_D_RENAMES,
                       PART_D)}[dataset]
        peer = [raw for raw, name in renames if name in spec.peer]
        return make(lines.repartition(input_partitions(lines, FACT_BYTES), *peer), self.year,
                    min_peers=self.min_peers, decimals=self.decimals, hot_rows=self.hot_rows,
                    hot=hot)

    @cached_property
    def peer_stats(self) -> DataFrame:
        return stats.peer_stats(self.fact_b, self.fact_d, min_peers=self.min_peers,
                                hot_rows=self.percentile_rows)

    @cached_property
    def dim_provider(self) -> DataFrame:
        return dims.dim_provider(self.raw_b, self.raw_d)

    @cached_property
    def dim_hcpcs(self) -> DataFrame:
        return dims.dim_hcpcs(self.raw_b)

    @cached_property
    def dim_drug(self) -> DataFrame:
        return dims.dim_drug(self.raw_d)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return dims.dim_geography(self.raw_b, self.raw_d)

    @cached_property
    def dim_ruca(self) -> DataFrame:
        return dims.dim_ruca(self.raw_b)

    def fact(self, dataset: str) -> DataFrame:
        return self.fact_b if dataset == "part_b" else self.fact_d

    def tables(self) -> dict:
        return {
            "dim_provider": self.dim_provider, "dim_hcpcs": self.dim_hcpcs,
            "dim_drug": self.dim_drug, "dim_geography": self.dim_geography,
            "dim_ruca": self.dim_ruca, "fact_part_b_service": self.fact_b,
            "fact_part_d_drug": self.fact_d, "peer_stats": self.peer_stats,
        }


_MODELS: dict = {}


def fixture_model(spark: SparkSession, sf_dir: str, **kw) -> Model:
    """Model over the fixture inputs derived from the driver's tables (memoised per
    session and directory, so the queries of one run share their plans)."""
    from peerscope.fixtures import raw_inputs

    app = spark.sparkContext.applicationId
    for old in [k for k in _MODELS if k[0] != app]:  # of sessions that have ended
        del _MODELS[old]
    key = (app, sf_dir, tuple(sorted(kw.items())))
    m = _MODELS.get(key)
    if m is None:
        raw_b, raw_d = raw_inputs(spark, sf_dir)
        m = Model(raw_b, raw_d, **{"keep": True} | kw)
        _MODELS[key] = m
    return m
