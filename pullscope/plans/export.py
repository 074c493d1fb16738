"""The repository export: per-repository PR counts joined to metadata, sorted, as CSV, with the
top 10 and the metadata-coverage statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pullscope.operators import repos


@dataclass
class Export:
    table: DataFrame      # sorted export (L1)
    top10: DataFrame      # L2
    stats: DataFrame      # Q3 + A20 + F8


def export_repos(baseline: DataFrame, repository: DataFrame, order_col: str = "id") -> Export:
    exp = repos.repo_export(baseline, repository, order_col)
    return Export(repos.sorted_export(exp), repos.top_exported(exp, 10),
                  repos.metadata_report(baseline, repository, exp))


def write_export(res: Export, csv_path: str) -> None:
    """K5: header CSV in the sorted order (range-partitioned sort: several ordered files)."""
    from pullscope.sources.sinks import write_csv
    write_csv(res.table, csv_path)
