"""The whole derivation from stored tables to signals, intent and reports, for all dates.

Each property is a lazy DataFrame. Frames that several others read go through a staging
policy (see ``tidemark.plans.staging``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes, intent, report, signals, snapshots, traction, universe
from tidemark.params import DEFAULT, Params
from tidemark.plans.staging import NoStaging, Staging, task_count
from tidemark.sources.tables import Tables, scan_holdings


class History:
    def __init__(
        self,
        tables: Tables,
        params: Params = DEFAULT,
        staging: Staging | NoStaging | None = None,
        created_at: Column | None = None,
    ):
        self.tables = tables
        self.params = params
        self.staging = staging or NoStaging()
        self.created_at = F.current_timestamp() if created_at is None else created_at

    # Snapshot level.

    @cached_property
    def rows(self) -> DataFrame:
        return scan_holdings(self.tables.holdings, self.tables.non_stock)

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.staging.keep(snapshots.snapshot_profile(self.rows, params=self.params), "snapshots")

    @cached_property
    def canonical(self) -> DataFrame:
        return snapshots.canonical_snapshot(self.snapshots)

    @cached_property
    def latest(self) -> DataFrame:
        return universe.latest_holdings_date(self.snapshots)

    @cached_property
    def members(self) -> DataFrame:
        return self.staging.keep(universe.membership(self.tables.universe, self.latest), "members")

    @cached_property
    def entries(self) -> DataFrame:
        """Canonical snapshots of funds eligible on the date, indexed along each fund."""
        eligible = universe.only_eligible(self.canonical, self.members, carry=["issuer"])
        return self.staging.keep(changes.with_fund_index(eligible), "entries")

    @cached_property
    def date_list(self) -> DataFrame:
        return self.snapshots.groupBy("date").agg((F.max("holding_rows") > 0).alias("has_holdings"))

    @cached_property
    def coverage(self) -> DataFrame:
        return universe.coverage(self.date_list, self.members, self.entries)

    @cached_property
    def dates(self) -> DataFrame:
        """Date dimension: one row per date."""
        dimension = universe.date_dimension(self.coverage, self.params)
        return self.staging.keep(dimension.join(self.date_list, "date"), "dates")

    @cached_property
    def eligible(self) -> DataFrame:
        return universe.eligible_universe(self.date_list, self.members)

    @cached_property
    def missing(self) -> DataFrame:
        return universe.missing_funds(self.eligible, self.entries)

    # Position level.

    @cached_property
    def tasks(self) -> int:
        """Tasks for the rows of all entries, placed by fund."""
        return task_count(self.entries.agg(F.sum("row_count").alias("n")).first()["n"])

    @cached_property
    def ranked(self) -> DataFrame:
        ranked = snapshots.ranked_holdings(self.tables.holdings, self.entries, self.tasks)
        return self.staging.keep(ranked, "ranked_holdings")

    @cached_property
    def paired(self) -> DataFrame:
        return changes.paired_positions(self.ranked, self.dates, self.tasks)

    @cached_property
    def ratios(self) -> DataFrame:
        return changes.pair_ratios(self.paired, self.params)

    @cached_property
    def diagnostics(self) -> DataFrame:
        rows = changes.change_diagnostics(self.entries, self.dates, self.ratios, self.created_at)
        return self.staging.keep(rows, "diagnostics")

    @cached_property
    def measured(self) -> DataFrame:
        return changes.with_fund_measures(self.paired, self.params)

    @cached_property
    def changes(self) -> DataFrame:
        return self.staging.keep(changes.holding_changes_from_pairs(self.paired, self.params), "changes")

    # Derived layers.

    @cached_property
    def signal_facts(self) -> DataFrame:
        return self.staging.keep(signals.signal_facts(self.changes, self.params), "signal_facts")

    @cached_property
    def signals(self) -> DataFrame:
        return signals.manager_signals(self.changes, self.params, tasks=self.tasks)

    @cached_property
    def intent(self) -> DataFrame:
        """Intent rows of all windows without their evidence lists."""
        rows = intent.manager_intent(
            self.changes, self.ranked, self.entries, self.diagnostics, self.members,
            params=self.params, evidence=False,
        )
        return self.staging.keep(rows, "intent")

    @cached_property
    def flow(self) -> DataFrame:
        return traction.net_active_flow(self.changes, self.params)

    @cached_property
    def available(self) -> DataFrame:
        return universe.latest_available(self.missing, self.entries)

    @cached_property
    def weight_changes(self) -> DataFrame:
        return report.stock_weight_change(self.ranked, self.dates)

    @cached_property
    def warnings(self) -> DataFrame:
        return report.data_warnings(self.coverage, self.ranked, self.params)

    @cached_property
    def skips(self) -> DataFrame:
        return report.skipped_diagnostics(self.diagnostics, self.members)

    @cached_property
    def quality(self) -> DataFrame:
        return report.data_quality(self.coverage, self.available, self.skips, self.warnings)

    @cached_property
    def movers(self) -> DataFrame:
        return report.top_movers(self.changes, self.params)

    @cached_property
    def opened(self) -> DataFrame:
        return report.new_positions(self.changes, self.params)

    @cached_property
    def closed(self) -> DataFrame:
        return report.removed_positions(self.changes, self.params)

    @cached_property
    def consensus_holdings(self) -> DataFrame:
        return report.consensus_holdings(self.ranked, self.coverage, params=self.params)

    @cached_property
    def intent_ranking(self) -> DataFrame:
        return report.intent_ranking(self.intent, self.params)

    @cached_property
    def observations(self) -> DataFrame:
        return report.observations(
            self.consensus_holdings, self.weight_changes, self.opened, self.closed, self.movers,
            self.dates, self.params,
        )
