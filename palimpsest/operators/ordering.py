"""Rows of a page together and in time order, without any page too big for one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.storage import Scratch

ROW_BYTES = 256  # Rough size of a revision document without its text.
FILE_BYTES = 1024 * 1024 * 1024  # Text per file if the number of files is left open.
SLICE_BYTES = 64 * 1024 * 1024  # A page of less is never cut.
SAMPLES_PER_SLICE = 1000


def order_by_page(
    revdocs: DataFrame, files: int | None, row_id: str, scratch: Scratch, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """Spread revision documents over `files` partitions, sorted by page, timestamp and id in each.

    With `files` None there are as many as it takes to give each about `FILE_BYTES`.

    A page lies in one partition, unless it alone is more than the fair share of one and than `slice_bytes`.
    Such a page is cut into slices of consecutive time, one partition each, so that a page holding a third of
    everything is written by a third of the tasks. No two slices of a page overlap in time.

    `row_id` is a number column that tells even copies of a row apart and stays the same when the rows are
    read again; rows of one time are dealt out by it. Rows are read more than once, so they should come from
    files: all reads but the last touch a few narrow columns only. What they find goes to `scratch`.
    """
    total = revdocs.agg(F.sum(_weight())).first()[0] or 0
    if files is None:
        files = max(1, math.ceil(total / FILE_BYTES))
    share = max(total / files, slice_bytes)
    target = F.hash("page_id").cast("bigint")
    placed = revdocs
    cuts = hot_page_cuts(revdocs, share, scratch) if total > share else None
    if cuts is not None:
        # Bounded by the number of files, see there.
        placed = revdocs.join(F.broadcast(cuts), _same_page("page_id", "hot_page"), "left")
        target += F.coalesce(_slice(F.col("cuts"), _clock(), F.col(row_id)), F.lit(0))
    return (
        placed.withColumn("target", F.pmod(target, F.lit(files)).cast("int"))
        .repartitionById(files, "target")
        .sortWithinPartitions("page_id", "timestamp", "id")
        .select(*revdocs.columns)
    )


def hot_page_cuts(revdocs: DataFrame, share: float, scratch: Scratch) -> DataFrame | None:
    """`(hot_page, cuts)`: the times at which to cut every page that weighs more than `share`; None if no page does.

    `share` is a `files`-th of the total or more, so fewer pages than files weigh more, and together they get
    fewer than two cuts per file, whatever the size of the data. The cuts are quantiles of a sample, as for a range
    partitioning: the sample decides where pages are cut, never which rows are kept. Each step is written
    before the next one, so no broadcast waits for a scan of everything.
    """
    hot = scratch.keep(
        revdocs.groupBy("page_id")
        .agg(F.sum(_weight()).alias("weight"), F.count("*").alias("n"))
        .where(F.col("weight") > share)
        .select(F.col("page_id").alias("hot_page"), "n", F.ceil(F.col("weight") / share).cast("int").alias("slices")),
        "hot_pages",
    )
    if hot.isEmpty():
        return None
    sample = (
        revdocs.select("page_id", _clock().alias("clock"))
        .join(F.broadcast(hot), _same_page("page_id", "hot_page"))
        .where(F.rand(7) < SAMPLES_PER_SLICE * F.col("slices") / F.col("n"))
    )
    # The number of quantiles has to be a constant: take fine ones, as the page with most slices needs, and keep every
    # so many. The accuracy tells that many apart.
    fine = max(4 * hot.agg(F.max("slices")).first()[0], 200)
    steps = ", ".join(f"{i / fine}D" for i in range(1, fine))
    quantiles = F.expr(f"percentile_approx(clock, array({steps}), {max(10_000, 10 * fine)})")
    kept = F.expr(f"transform(sequence(1, slices - 1), i -> fine[cast(i * {fine}L div slices as int) - 1])")
    cuts = sample.groupBy("hot_page", "slices").agg(quantiles.alias("fine")).select("hot_page", kept.alias("cuts"))
    return scratch.keep(cuts, "cuts")


def _weight() -> Column:
    return F.coalesce(F.col("bytes"), F.lit(0)) + ROW_BYTES


def _clock() -> Column:
    return F.coalesce(F.unix_seconds(F.try_to_timestamp("timestamp")), F.lit(0))


def _slice(cuts: Column, clock: Column, row_id: Column) -> Column:
    """The slice of a time. Rows of one time that spans several slices, such as copies of one revision, are
    dealt out over those slices; the number that does it must not change if a task is run again."""
    earlier = F.size(F.filter(cuts, lambda cut: cut < clock))
    equal = F.size(F.filter(cuts, lambda cut: cut == clock))
    return F.when(cuts.isNotNull(), earlier + F.pmod(row_id, equal + 1))


def _same_page(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))
