"""Flat marts over the subscription export: customer and subscriptions.

Both are rename projections of the staging table (one row per
subscription, no de-duplication; the nested arrays are not carried).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Staging columns carried into each mart, in output order.
# Output names drop the "customer_" / "subscription_" prefix.
CUSTOMER_COLUMNS = (
    "customer_id", "customer_first_name", "customer_last_name", "customer_email", "customer_company",
    "customer_auto_collection", "customer_offline_payment_method", "customer_net_term_days",
    "customer_allow_direct_debit", "customer_created_at", "customer_created_from_ip",
    "customer_taxability", "customer_updated_at", "customer_pii_cleared", "customer_channel",
    "customer_resource_version", "customer_deleted", "customer_object",
    "customer_billing_address_first_name", "customer_billing_address_last_name",
    "customer_billing_address_email", "customer_billing_address_company",
    "customer_billing_address_line1", "customer_billing_address_city",
    "customer_billing_address_country", "customer_billing_address_zip",
    "customer_billing_address_validation_status", "customer_billing_address_object",
    "customer_card_status", "customer_promotional_credits", "customer_refundable_credits",
    "customer_excess_payments", "customer_unbilled_charges", "customer_preferred_currency_code",
    "customer_mrr",
)
SUBSCRIPTION_COLUMNS = (
    "subscription_id", "subscription_billing_period", "subscription_billing_period_unit",
    "subscription_customer_id", "subscription_status", "subscription_current_term_start",
    "subscription_current_term_end", "subscription_next_billing_at", "subscription_created_at",
    "subscription_started_at", "subscription_activated_at", "subscription_created_from_ip",
    "subscription_updated_at", "subscription_has_scheduled_changes", "subscription_channel",
    "subscription_resource_version", "subscription_deleted", "subscription_object",
    "subscription_coupon", "subscription_currency_code", "subscription_due_invoices_count",
    "subscription_due_since", "subscription_total_dues", "subscription_mrr",
    "subscription_exchange_rate", "subscription_base_currency_code",
    "subscription_has_scheduled_advance_invoices", "subscription_create_pending_invoices",
    "subscription_auto_close_invoices",
)


def out_name(col: str, prefix: str) -> str:
    # customer_id and subscription_id keep their names
    if col == f"{prefix}id":
        return col
    return col[len(prefix):] if col.startswith(prefix) else col


def renamed(df: DataFrame, columns: tuple[str, ...], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(out_name(c, prefix)) for c in columns])


def customer(stg_subscriptions: DataFrame) -> DataFrame:
    return renamed(stg_subscriptions, CUSTOMER_COLUMNS, "customer_")


def subscriptions(stg_subscriptions: DataFrame) -> DataFrame:
    return renamed(stg_subscriptions, SUBSCRIPTION_COLUMNS, "subscription_")
