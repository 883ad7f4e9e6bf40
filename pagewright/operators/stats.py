"""Progress aggregates (A1-A3) and run status (K2).

Each is a single aggregation with partial (map-side) combine, so the result
is one small row or a handful of groups whatever the page count.

The aggregates can be kept up to date instead: :func:`status_counts` has one
row per combination of statuses, :func:`count_change` the signed difference
that some pages' new statuses make, :func:`add_counts` their sum. A1-A3 take
such counts (``weight="n"``) in place of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ACTIVE, IDLE, SUCCESS, STAGES

#: Columns whose combinations say all that A1-A3 need of a page.
STATUSES = ("status", *STAGES)


def status_counts(pages: DataFrame) -> DataFrame:
    """Pages per combination of status and stage statuses: a few hundred rows at most."""
    return pages.groupBy(*STATUSES).agg(F.count(F.lit(1)).alias("n"))


def add_counts(*counts: DataFrame) -> DataFrame:
    """The sum of status counts and their changes; combinations that no page has any more go."""
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy(*STATUSES).agg(F.sum("n").alias("n")).filter("n <> 0")


def count_change(before: DataFrame | None, after: DataFrame | None) -> DataFrame:
    """Signed status counts of pages that had the statuses ``before`` and have ``after``.

    Only pages that changed (or may have) need to be in both; new pages are
    in ``after`` alone, removed ones in ``before`` alone.
    """
    signs = [df.select(*STATUSES, F.lit(sign).cast("long").alias("n")) for df, sign in ((before, -1), (after, 1)) if df is not None]
    rows = signs[0] if len(signs) == 1 else signs[0].unionByName(signs[1])
    return rows.groupBy(*STATUSES).agg(F.sum("n").alias("n")).filter("n <> 0")


def _pages(weight: str | None, cond: Column | None = None) -> Column:
    """Number of pages for which ``cond`` holds."""
    n = F.lit(1).cast("long") if weight is None else F.col(weight)
    return F.coalesce(F.sum(n if cond is None else F.when(cond, n)), F.lit(0).cast("long"))


def processing_complete(pages: DataFrame, weight: str | None = None) -> DataFrame:
    """A1: no ACTIVE page has a stage that is not SUCCESS.

    ``!=`` on a NULL status is unknown, so such a page does not count as
    pending here (it does in A2), as in the reference.
    """
    not_done = None
    for s in STAGES:
        c = F.col(s) != SUCCESS
        not_done = c if not_done is None else (not_done | c)
    act = pages.filter(F.col("status") == ACTIVE)
    return act.agg(_pages(weight, not_done).alias("pending_pages")) \
        .withColumn("complete", F.col("pending_pages") == 0)


def processing_stats(pages: DataFrame, weight: str | None = None) -> DataFrame:
    """A2: totals, completed, remaining and completion rate in percent."""
    done = None
    for s in STAGES:
        c = F.col(s) == SUCCESS
        done = c if done is None else (done & c)
    act = pages.filter(F.col("status") == ACTIVE)
    agg = act.agg(_pages(weight).alias("total_active_pages"), _pages(weight, done).alias("completed_pages"))
    return agg.select(
        "total_active_pages", "completed_pages",
        (F.col("total_active_pages") - F.col("completed_pages")).alias("remaining_pages"),
        F.when(F.col("total_active_pages") > 0,
               F.col("completed_pages") / F.col("total_active_pages") * 100)
        .otherwise(F.lit(0.0)).alias("completion_rate"))


def all_done():
    """Whether every stage of a page succeeded; a NULL status has not."""
    done = F.lit(True)
    for s in STAGES:
        done = done & F.coalesce(F.col(s) == SUCCESS, F.lit(False))
    return done


def stage_progress(pages: DataFrame, weight: str | None = None) -> DataFrame:
    """A3: ACTIVE pages per (stage, status), the four stage columns unpivoted."""
    kept = [weight] if weight else []
    act = pages.filter(F.col("status") == ACTIVE).select(*STAGES, *kept)
    long = act.unpivot(kept, list(STAGES), "stage", "stage_status")
    return long.groupBy("stage", "stage_status").agg(_pages(weight).alias("n"))


def current_run_status(run_state: DataFrame) -> DataFrame:
    """K2: status of the latest run (highest id), ``IDLE`` when there is none."""
    latest = run_state.agg(F.max_by("status", "id").alias("status"))
    return latest.select(F.coalesce("status", F.lit(IDLE)).alias("status"))
