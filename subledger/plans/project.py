"""All derived tables of one source, by name."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.operators import HotKeys, date_spine, find_hot_keys
from subledger.plans import core, intermediate, reporting, staging
from subledger.settings import Settings
from subledger.sources import RAW_TABLES, Source


# Table names by layer, inputs before the tables that read them.
STAGING = [
    "stg_shopify__orders", "stg_shopify__customers", "stg_shopify__order_line_items", "stg_recharge__subscriptions",
    "stg_recharge__charges", "stg_recharge__customers", "stg_stripe__charges", "stg_stripe__refunds",
]
INTERMEDIATE = ["int_customers__unified", "int_orders__enriched", "int_payments__reconciled"]
CORE = ["dim_dates", "dim_products", "dim_customers", "fct_orders", "fct_subscriptions", "fct_charges"]
REPORTING = ["rpt_monthly_cohort_retention", "rpt_revenue_reconciliation", "rpt_subscription_health"]


class Project:
    """Tables as lazy DataFrames, each planned once. Attribute names are the published table names."""

    def __init__(self, source: Source, settings: Settings | None = None):
        self.source, self.spark, self.settings = source, source.spark, settings or Settings()

    def replace(self, name: str, df: DataFrame) -> None:
        """Let tables planned from here on read ``df``, a written copy, in place of the planned table."""
        self.__dict__[name] = df
        self.written.add(name)

    def table(self, name: str) -> DataFrame:
        """Any table by its name, raw ones included."""
        for system, tables in RAW_TABLES.items():
            if name in tables:
                return self.source.read(system, name)
        if name not in STAGING + INTERMEDIATE + CORE + REPORTING:
            raise KeyError(name)
        return getattr(self, name)

    # Staging

    @cached_property
    def stg_shopify__orders(self) -> DataFrame:
        return staging.shop_orders(self.source.read("shopify", "raw_shopify__orders"), self.settings)

    @cached_property
    def stg_shopify__customers(self) -> DataFrame:
        return staging.shop_customers(self.source.read("shopify", "raw_shopify__customers"), self.settings)

    @cached_property
    def stg_shopify__order_line_items(self) -> DataFrame:
        return staging.shop_line_items(self.source.read("shopify", "raw_shopify__order_line_items"))

    @cached_property
    def stg_recharge__subscriptions(self) -> DataFrame:
        return staging.subscriptions(self.source.read("recharge", "raw_recharge__subscriptions"), self.settings)

    @cached_property
    def stg_recharge__charges(self) -> DataFrame:
        return staging.subscription_charges(self.source.read("recharge", "raw_recharge__charges"))

    @cached_property
    def stg_recharge__customers(self) -> DataFrame:
        return staging.subscription_customers(self.source.read("recharge", "raw_recharge__customers"))

    @cached_property
    def stg_stripe__charges(self) -> DataFrame:
        return staging.payment_charges(self.source.read("stripe", "raw_stripe__charges"))

    @cached_property
    def stg_stripe__refunds(self) -> DataFrame:
        return staging.payment_refunds(self.source.read("stripe", "raw_stripe__refunds"))

    # Keys too large for one task. Looked for in the raw tables, where the search reads one column and joins nothing; not
    # for primary keys, which the declared checks watch.

    def _hot(self, system: str, table: str, column: str, name: str) -> HotKeys:
        keys = self.source.read(system, table).select(F.col(column).alias(name))
        return find_hot_keys(keys, name, self.settings.rows_per_task)

    @cached_property
    def hot_customers(self) -> HotKeys:
        """Customers with very many orders."""
        return self._hot("shopify", "raw_shopify__orders", "customer_id", "shopify_customer_id")

    @cached_property
    def hot_paid_orders(self) -> HotKeys:
        """Orders with very many successful charges."""
        payments = intermediate.successful_payments(self.stg_stripe__charges).select("order_id")
        return find_hot_keys(payments, "order_id", self.settings.rows_per_task)

    # Intermediate

    @cached_property
    def int_customers__unified(self) -> DataFrame:
        return intermediate.unified_customers(self.stg_shopify__customers, self.stg_recharge__customers)

    @cached_property
    def valid_orders(self) -> DataFrame:
        """Enriched orders before their items and sequence: all that customer aggregates need."""
        if "int_orders__enriched" in self.written:
            return self.int_orders__enriched
        return intermediate.valid_orders(self.stg_shopify__orders)

    @cached_property
    def order_history(self) -> DataFrame:
        return intermediate.order_history(
            self.stg_shopify__orders, self.stg_shopify__order_line_items, self.hot_customers
        )

    @cached_property
    def int_orders__enriched(self) -> DataFrame:
        return intermediate.enriched_orders(self.order_history)

    @cached_property
    def int_payments__reconciled(self) -> DataFrame:
        return intermediate.reconciled_payments(
            self.stg_shopify__orders, intermediate.successful_payments(self.stg_stripe__charges),
            self.stg_stripe__refunds, self.hot_paid_orders, self.settings,
        )

    # Core

    @cached_property
    def dim_customers(self) -> DataFrame:
        return core.customers(
            self.int_customers__unified, self.valid_orders, self.stg_recharge__subscriptions, self.settings
        )

    @cached_property
    def dim_dates(self) -> DataFrame:
        return core.dates(date_spine(self.spark, self.settings.spine_start, self.settings.spine_end))

    @cached_property
    def dim_products(self) -> DataFrame:
        return core.products(self.stg_shopify__order_line_items)

    @cached_property
    def acquired(self) -> DataFrame:
        """Cohort and first channel per customer: from the customer dimension where that is written already."""
        if "dim_customers" in self.written:
            return self.dim_customers
        return core.acquisition(self.stg_shopify__customers, self.valid_orders)

    @cached_property
    def fct_orders(self) -> DataFrame:
        if not self.written and not self.hot_customers:
            history = intermediate.with_acquisition(self.order_history)
            orders = intermediate.enriched_orders(history, "acquisition_cohort_month", "acquisition_channel")
            return core.order_facts_from_history(orders, self.stg_shopify__customers)
        return core.order_facts(self.int_orders__enriched, self.acquired, self.hot_customers)

    @cached_property
    def fct_subscriptions(self) -> DataFrame:
        return core.subscription_facts(self.stg_recharge__subscriptions, self.stg_recharge__charges, self.settings)

    @cached_property
    def fct_charges(self) -> DataFrame:
        return core.charge_facts(self.stg_recharge__charges)

    # Reporting

    @cached_property
    def rpt_monthly_cohort_retention(self) -> DataFrame:
        if "fct_orders" in self.written:
            months = self.fct_orders.select("customer_id", "acquisition_cohort_month", "order_month").distinct()
        else:
            months = reporting.customer_months(self.valid_orders, self.stg_shopify__customers)
        return reporting.cohort_retention(months)

    @cached_property
    def rpt_revenue_reconciliation(self) -> DataFrame:
        return reporting.revenue_reconciliation(self.int_payments__reconciled, self.settings)

    @cached_property
    def rpt_subscription_health(self) -> DataFrame:
        return reporting.subscription_health(self.fct_subscriptions, self.fct_charges, self.settings)

    @cached_property
    def written(self) -> set[str]:
        """Names of tables that are read back from a written copy."""
        return set()
