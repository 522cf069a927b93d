"""The whole ledger allocation: billed days, storage by database, compute by user, balance check."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import readable_bytes
from tidewell.operators import ledger as L
from tidewell.workspace import stored


@dataclass
class Allocation:
    """The steps of an allocation. A step is computed when it is first asked for; those that several others read are small
    tables (rows per service and day, user or database) and are stored, so each input is scanned once."""

    ledger: DataFrame
    parts: DataFrame
    statements: DataFrame
    samples: DataFrame
    first: Column
    last: Column
    spec: L.LedgerSpec
    core_metric: str = "CGroupMaxCPU"

    @cached_property
    def shares(self) -> DataFrame:
        return stored(L.storage_shares(self.parts), "shares")

    @cached_property
    def billed(self) -> DataFrame:
        whole = L.billed_days(L.current(self.ledger), self.spec, self.first, self.last)
        return stored(L.split_shared(whole, self.shares), "billed")

    @cached_property
    def storage(self) -> DataFrame:
        return L.allocate_storage(self.billed, self.shares)

    @cached_property
    def cpu(self) -> DataFrame:
        return stored(L.user_cpu(self.statements, self.first, self.last), "cpu")

    @cached_property
    def capacity(self) -> DataFrame:
        return stored(L.capacity(self.samples, self.core_metric, self.first, self.last), "capacity")

    @cached_property
    def days(self) -> DataFrame:
        return stored(L.rate_days(self.billed, self.cpu, self.capacity), "days")

    @cached_property
    def compute(self) -> DataFrame:
        return L.allocate_compute(self.cpu, self.days)

    @cached_property
    def balance(self) -> DataFrame:
        return L.balance(self.days, self.compute, self.storage)

    def storage_report(self) -> DataFrame:
        """Per service and database active bytes, share of the service and allocated amount; the service's total comes last."""
        amounts = self.storage.groupBy("service", "database").agg(F.sum("allocated").alias("allocated"))
        rows = self.shares.join(amounts, ["service", "database"], "left")
        sums = {"bytes_on_disk": F.sum("bytes"), "_share": F.sum("share"), "_amount": F.sum("allocated")}
        report = (
            rows.groupingSets([["service", "database"], ["service"]], "service", "database")
            .agg(F.grouping("database").alias("is_total"), *[c.alias(n) for n, c in sums.items()])
            .withColumn("database", F.when(F.col("is_total") == 1, "total").otherwise(F.col("database")))
        )
        return report.select(
            "service",
            "is_total",
            "database",
            readable_bytes(F.col("bytes_on_disk")).alias("active_size"),
            "bytes_on_disk",
            F.round(100 * F.col("_share"), 2).alias("share_pct"),
            F.round("_amount", 6).alias("allocated_storage"),
        ).orderBy("service", "is_total", F.desc("bytes_on_disk"), "database")

    def compute_report(self) -> DataFrame:
        return L.compute_report(self.compute, self.days)


def allocate(
    ledger: DataFrame,
    parts: DataFrame,
    statements: DataFrame,
    samples: DataFrame,
    first: Column,
    last: Column,
    spec: L.LedgerSpec,
    core_metric: str = "CGroupMaxCPU",
    check: bool = True,
) -> Allocation:
    """The allocation; with ``check`` the guard runs first and the balance is asserted."""
    found = Allocation(ledger, parts, statements, samples, first, last, spec, core_metric)
    if check:
        L.guard_billed(found.billed)
        L.assert_balanced(found.balance)
    return found
