"""A run over a set of broadcast days and channels: every table the reference produces.

The reference loops over days, channels and groups; here all of them are columns of one
plan. ``DailyRun`` builds each stage once and hands the same DataFrame to every consumer.

Stages read by several consumers are written once as tables in the shared checkpoint
folder (``stockout.stage``): always the small dimension blocks (broadcast x product,
product options, option totals) and the per-minute order aggregate (bucketed by group, the
only pass over the order lines the grid needs); with ``materialize=True`` also the report
rows and the censored grid, which the report, the snapshots and the imputation all read.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockout.operators import grid as grid_ops
from stockout.operators import impute as impute_ops
from stockout.operators import orders as order_ops
from stockout.operators import present as present_ops
from stockout.operators import report as report_ops
from stockout.operators import snapshot as snapshot_ops
from stockout.operators import soldout as soldout_ops
from stockout.operators.grid import GROUP, OPTION
from stockout.operators.scope import ALL, Scope
from stockout.sources import Sources
from stockout.stage import new_run_tag, write_stage


class DailyRun:
    """Every stage of one run over ``scope`` (default: all days, both channels)."""

    def __init__(self, src: Sources, scope: Scope = ALL, *, materialize: bool = False,
                 impute_settings: impute_ops.ImputeSettings | None = None, resume_tag: str | None = None,
                 numbered: DataFrame | None = None):
        """``numbered``: the run's airings by a kept state (``operators.airings``), else they are numbered
        from all history. ``resume_tag``: stages of an earlier, broken run under this tag are taken as they are; the tag
        must follow from all that the run reads (``plans.backfill``)."""
        self.src = src
        self.scope = scope
        self.materialize = materialize
        self.impute_settings = impute_settings or impute_ops.ImputeSettings()
        self.run_tag = resume_tag or new_run_tag()
        self.resume = resume_tag is not None
        self.numbered = numbered

    def prepare(self, grid: bool = True, report: bool = False) -> "DailyRun":
        """Write the run's independent base stages side by side (Spark runs jobs submitted
        from several threads concurrently): the per-minute order aggregate next to the
        broadcast x product block, then what depends on the latter."""
        first = [lambda: self.pgm] + ([lambda: self.lines] if grid and report else [lambda: self.minutes] if grid else [])
        with ThreadPoolExecutor(max_workers=len(first)) as pool:
            for fut in [pool.submit(f) for f in first]:
                fut.result()
        second = [lambda: self.products] + ([lambda: self.order_totals] if report else []) + ([lambda: self.minutes] if grid else [])
        with ThreadPoolExecutor(max_workers=len(second)) as pool:
            for fut in [pool.submit(f) for f in second]:
                fut.result()
        return self

    def _write(self, df: DataFrame, name: str, **kwargs) -> DataFrame:
        return write_stage(df, name, run_tag=self.run_tag, resume=self.resume, **kwargs)

    # -- report SQL blocks -------------------------------------------------------------
    @cached_property
    def pgm(self) -> DataFrame:
        """Broadcast x product of the run: read by seven blocks, so written once (it is
        bounded by the run's broadcasts, tiny next to the order lines)."""
        return self._write(report_ops.broadcast_sequence(self.src, self.scope, self.numbered), "pgm")

    @cached_property
    def products(self) -> DataFrame:
        """Options of the run's products (bounded by the catalogue): written once."""
        return self._write(report_ops.product_attributes(self.src, self.pgm), "products")

    @cached_property
    def order_base(self) -> DataFrame:
        return report_ops.order_base(self.src, self.pgm, self.scope)

    @cached_property
    def lines(self) -> DataFrame:
        """The run's only pass over the order lines, summed to option, channel, time code and minute and
        written bucketed by group: the minute orders and the order figures are both rolled up from it."""
        return self._write(report_ops.line_minutes(self.src, self.scope), "line_minutes", bucket_by=GROUP)

    def _summed_lines(self) -> DataFrame | None:
        """``lines`` if the run has written them or will for both of its readers, else None: a run that
        asks for the grid or for the order figures alone sums the lines for it and writes no stage of them."""
        return self.lines if self.materialize or "lines" in self.__dict__ else None

    @cached_property
    def order_totals(self) -> DataFrame:
        """Order figures per (broadcast, product, option), written once: revenue and
        option quantities both read it (bounded by the run's options)."""
        lines = self._summed_lines()
        lines = report_ops.line_minutes(self.src, self.scope) if lines is None else lines
        minutes = report_ops.in_broadcast_days(lines, self.pgm, self.scope)
        return self._write(report_ops.option_totals(minutes), "order_totals")

    @cached_property
    def report_rows(self) -> DataFrame:
        """Report base plus the run channel; materialized when the run is."""
        out = report_ops.report_base(self.src, self.scope, keep_run_columns=True, pgm=self.pgm, prd=self.products,
                                     totals=self.order_totals)
        return self._keep(out, "report_rows")

    @cached_property
    def report_base(self) -> DataFrame:
        return self.report_rows.select(*report_ops.REPORT_BASE_COLUMNS)

    @cached_property
    def options(self) -> DataFrame:
        """Report options with supply: the report's rows without its order figures, built
        from the written broadcast and product blocks (no pass over the order lines)."""
        return report_ops.report_options(self.src, self.scope, pgm=self.pgm, prd=self.products)

    def _keep(self, df: DataFrame, name: str, **kwargs) -> DataFrame:
        """Cut the lineage of a stage several consumers read: written once to the shared
        checkpoint folder (survives executor loss; later plans start from the files)."""
        return self._write(df, name, **kwargs) if self.materialize else df

    # -- minute grid and sold-out ------------------------------------------------------
    @cached_property
    def minutes(self) -> DataFrame:
        """Units per option and minute: always written once (the grid, the option frame and the gate all
        read it). Taken from ``lines`` where the run has summed them already or will for the report,
        else from the order lines of the grid alone."""
        lines = self._summed_lines()
        return self._write(order_ops.minute_orders(self.src, self.scope, lines), "minutes", bucket_by=GROUP)

    @cached_property
    def option_frame(self) -> DataFrame:
        return grid_ops.option_frame(self.minutes, self.options)

    @cached_property
    def grid(self) -> DataFrame:
        return grid_ops.order_grid(self.minutes, self.option_frame)

    @cached_property
    def censored(self) -> DataFrame:
        # The fit, the profile, the sold-out minutes and the snapshots all work by group.
        return self._keep(soldout_ops.censor(self.grid), "censored", bucket_by=GROUP)

    @cached_property
    def gate(self) -> DataFrame:
        return grid_ops.group_gate(self.option_frame)

    @cached_property
    def passing_censored(self) -> DataFrame:
        """Censored grid of the groups whose options match the report's rows."""
        return self.censored.where(F.col("passes"))

    @cached_property
    def soldout_time(self) -> DataFrame:
        return soldout_ops.soldout_time(self.censored)

    @cached_property
    def snapshot(self) -> DataFrame:
        return snapshot_ops.soldout_snapshot(self.passing_censored)

    # -- imputation --------------------------------------------------------------------
    @cached_property
    def train_profile(self) -> DataFrame:
        return impute_ops.train_set_profile(self.censored)

    @cached_property
    def imputed(self) -> DataFrame:
        # Every reader of the estimates reads the one solution.
        return self._write(impute_ops.impute_demand(self.censored, self.impute_settings), "imputed")

    @cached_property
    def estimated(self) -> DataFrame:
        return impute_ops.estimated_demand(self.imputed)

    # -- audit -------------------------------------------------------------------------
    @cached_property
    def audit(self) -> DataFrame:
        """Every group that the report lists or that was ordered on air, and what became of it: kept, left
        out because its options differ (the gate), or left out because nobody ordered on air."""
        listed = self.options.groupBy(*GROUP, "broad_dt").agg(F.count("*").alias("n_listed"))
        seen = (self.option_frame.groupBy(*GROUP, F.col("broad_dt").alias("grid_dt"), "n_grid_options", "passes")
                .agg(F.lit(1).alias("_one")).drop("_one"))
        outcome = (F.when(F.col("passes").isNull(), "no order on air").when(F.col("passes"), "kept")
                   .otherwise("options differ"))
        return (listed.join(seen, GROUP, "full")
                .select(*GROUP, F.coalesce("n_listed", F.lit(0)).alias("n_report_rows"),
                        F.coalesce("n_grid_options", F.lit(0)).alias("n_grid_options"), outcome.alias("outcome"),
                        F.coalesce("broad_dt", "grid_dt").alias("broad_dt")))

    # -- report ------------------------------------------------------------------------
    def report(self, with_estimate: bool = True, display_names: bool = True) -> DataFrame:
        """The written report: report rows of groups with on-air orders that pass the gate,
        with sold-out minute and flag, first-event value, estimate and presentation columns."""
        passing = self.passing_censored.select(*GROUP).distinct()
        rows = self.report_base.join(passing, GROUP, "left_semi")
        soldout = soldout_ops.soldout_time(self.passing_censored).select(*OPTION, "sold_out_dtm", "sold_out_flag")
        value = snapshot_ops.first_soldout_value(self.snapshot)
        out = rows.join(soldout, OPTION, "left").join(value, OPTION, "left")
        if with_estimate:
            out = out.join(self.estimated.select(*OPTION, "estim_qty"), OPTION, "left")
        out = present_ops.present(out, with_estimate=with_estimate)
        return present_ops.to_display_names(out) if display_names else out
