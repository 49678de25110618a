"""peerscope — peer-group outlier analytics as Spark DataFrame operators.

The package reads yearly claim files under declared types, builds a star schema
(provider, procedure, drug, geography and RUCA dimensions plus two fact tables),
ranks every fact row inside its peer group with the empirical CDF, precomputes exact
percentile breakpoints per peer group and measure, writes range-sorted, year-partitioned
Parquet, checks grain and cross-table agreement, and answers serving and profiling
questions. Every operator takes and returns DataFrames and is parameterised by keys and
measures, so it runs on any table of the same shape.

Layout:
    sources/    typed CSV scans, partitioned Parquet scans and sorted sinks, footer audits
    functions/  Column builders (exact rank rounding, guarded division, title case, ...)
    operators/  generic relational operators (peer rank, distributed CDF, percentiles,
                grain audit, unpivot)
    plans/      the composed product: dimensions, facts, peer_stats, checks, serving
                queries, profiles, the two-pass build
    streaming/  intentionally empty: the workload is batch only
"""

__all__ = ["schema", "session"]
