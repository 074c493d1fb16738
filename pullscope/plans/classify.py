"""The classification flow: label titles, keep fix PRs, cut commits and details to them.

Reads the collector's tables (or any DataFrames of the same shape) and returns lazy frames;
``write_classified`` persists them (K1). The PR ids are never collected: the subsets are
semi-joins against the fix PR frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from pullscope.operators.details import lean_details
from pullscope.operators.labels import classify_all, filter_to_prs, fix_only
from pullscope.operators.reports import crosstab


@dataclass
class Classified:
    classified: DataFrame        # fix_classified_prs
    fix_prs: DataFrame           # fix_prs_only
    fix_commits: DataFrame | None
    fix_details: DataFrame | None

    def summary(self) -> DataFrame:
        """Source x type counts."""
        return crosstab(self.classified)


def classify(prs: DataFrame, commits: DataFrame | None = None,
             details: DataFrame | None = None) -> Classified:
    classified = classify_all(prs)
    fix = fix_only(classified)
    fc = filter_to_prs(commits, fix) if commits is not None else None
    fd = filter_to_prs(lean_details(details), fix) if details is not None else None
    return Classified(classified, fix, fc, fd)


def write_classified(res: Classified, out_dir: str) -> None:
    """K1: the classified table is written first; the fix PRs are made from what was written."""
    from pullscope.sources.sinks import write_table
    from pullscope.sources.tables import read_table
    write_table(res.classified, f"{out_dir}/fix_classified_prs")
    write_table(fix_only(read_table(res.classified.sparkSession, f"{out_dir}/fix_classified_prs")), f"{out_dir}/fix_prs_only")
    if res.fix_commits is not None:
        write_table(res.fix_commits, f"{out_dir}/fix_pr_commits")
    if res.fix_details is not None:
        write_table(res.fix_details, f"{out_dir}/fix_pr_commit_details")
