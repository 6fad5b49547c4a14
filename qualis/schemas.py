"""Declared raw-layer schemas (the seven landed tables).

Types follow the staging column documentation: 64-bit integers are
``bigint``, floats ``double``, raw times stay ``string``.  The three
nested subscription arrays carry ``array<struct<id:string,quantity:bigint>>``.
"""

from __future__ import annotations

from pyspark.sql import types as T

ITEM_ARRAY = "array<struct<id:string,quantity:bigint>>"

# Column names and declared types of the raw tables, in
# the order the landed files carry them.
RAW_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "autoqa_ratings": [
        ("autoqa_review_id", "string"), ("autoqa_rating_id", "string"), ("payment_id", "bigint"),
        ("team_id", "bigint"), ("payment_token_id", "bigint"), ("external_ticket_id", "bigint"),
        ("rating_category_id", "bigint"), ("rating_category_name", "string"),
        ("rating_scale_score", "double"), ("score", "double"), ("reviewee_internal_id", "bigint"),
    ],
    "autoqa_reviews": [
        ("autoqa_review_id", "string"), ("payment_id", "bigint"), ("payment_token_id", "bigint"),
        ("external_ticket_id", "bigint"), ("created_at", "string"), ("conversation_created_at", "string"),
        ("conversation_created_date", "string"), ("team_id", "bigint"),
        ("reviewee_internal_id", "double"), ("updated_at", "string"),
    ],
    "autoqa_root_cause": [
        ("autoqa_rating_id", "string"), ("category", "double"), ("count", "double"), ("root_cause", "string"),
    ],
    "conversations": [
        ("payment_id", "bigint"), ("payment_token_id", "bigint"), ("external_ticket_id", "bigint"),
        ("conversation_created_at", "string"), ("conversation_created_at_date", "string"),
        ("channel", "string"), ("assignee_id", "bigint"), ("updated_at", "string"), ("closed_at", "string"),
        ("message_count", "bigint"), ("last_reply_at", "string"), ("language", "string"),
        ("imported_at", "string"), ("unique_public_agent_count", "bigint"),
        ("public_mean_character_count", "double"), ("public_mean_word_count", "double"),
        ("private_message_count", "bigint"), ("public_message_count", "bigint"),
        ("klaus_sentiment", "string"), ("is_closed", "boolean"), ("agent_most_public_messages", "bigint"),
        ("first_response_time", "double"), ("first_resolution_time_seconds", "double"),
        ("full_resolution_time_seconds", "double"), ("most_active_internal_user_id", "double"),
        ("deleted_at", "double"),
    ],
    "customer_subscriptions": [
        ("subscription_id", "string"), ("subscription_billing_period", "bigint"),
        ("subscription_billing_period_unit", "string"), ("subscription_customer_id", "string"),
        ("subscription_status", "string"), ("subscription_current_term_start", "bigint"),
        ("subscription_current_term_end", "bigint"), ("subscription_next_billing_at", "bigint"),
        ("subscription_created_at", "bigint"), ("subscription_started_at", "bigint"),
        ("subscription_activated_at", "bigint"), ("subscription_created_from_ip", "string"),
        ("subscription_updated_at", "bigint"), ("subscription_has_scheduled_changes", "boolean"),
        ("subscription_channel", "string"), ("subscription_resource_version", "bigint"),
        ("subscription_deleted", "boolean"), ("subscription_object", "string"),
        ("subscription_coupon", "string"), ("subscription_currency_code", "string"),
        ("subscription_subscription_items", ITEM_ARRAY), ("subscription_item_tiers", ITEM_ARRAY),
        ("subscription_coupons", ITEM_ARRAY), ("subscription_due_invoices_count", "bigint"),
        ("subscription_due_since", "bigint"), ("subscription_total_dues", "bigint"),
        ("subscription_mrr", "bigint"), ("subscription_exchange_rate", "double"),
        ("subscription_base_currency_code", "string"),
        ("subscription_has_scheduled_advance_invoices", "boolean"),
        ("subscription_create_pending_invoices", "boolean"), ("subscription_auto_close_invoices", "boolean"),
        ("customer_id", "string"), ("customer_first_name", "string"), ("customer_last_name", "string"),
        ("customer_email", "string"), ("customer_company", "string"), ("customer_auto_collection", "string"),
        ("customer_offline_payment_method", "string"), ("customer_net_term_days", "bigint"),
        ("customer_allow_direct_debit", "boolean"), ("customer_created_at", "bigint"),
        ("customer_created_from_ip", "string"), ("customer_taxability", "string"),
        ("customer_updated_at", "bigint"), ("customer_pii_cleared", "string"), ("customer_channel", "string"),
        ("customer_resource_version", "bigint"), ("customer_deleted", "boolean"), ("customer_object", "string"),
        ("customer_billing_address_first_name", "string"), ("customer_billing_address_last_name", "string"),
        ("customer_billing_address_email", "string"), ("customer_billing_address_company", "string"),
        ("customer_billing_address_line1", "string"), ("customer_billing_address_city", "string"),
        ("customer_billing_address_country", "string"), ("customer_billing_address_zip", "string"),
        ("customer_billing_address_validation_status", "string"), ("customer_billing_address_object", "string"),
        ("customer_card_status", "string"), ("customer_promotional_credits", "bigint"),
        ("customer_refundable_credits", "bigint"), ("customer_excess_payments", "bigint"),
        ("customer_unbilled_charges", "bigint"), ("customer_preferred_currency_code", "string"),
        ("customer_mrr", "bigint"), ("customer_tax_providers_fields", "bigint"),
        ("customer_auto_close_invoices", "boolean"), ("customer_cf_payment_id", "bigint"),
        ("subscription_auto_collection", "string"), ("subscription_offline_payment_method", "string"),
        ("customer_billing_address_state_code", "string"), ("customer_billing_address_state", "string"),
        ("dt_customer_signup_date", "date"),
    ],
    "manual_rating": [
        ("payment_id", "bigint"), ("team_id", "bigint"), ("review_id", "bigint"), ("category_id", "bigint"),
        ("rating", "double"), ("cause", "string"), ("rating_max", "bigint"), ("weight", "double"),
        ("critical", "boolean"), ("category_name", "string"),
    ],
    "manual_reviews": [
        ("review_id", "bigint"), ("payment_id", "bigint"), ("payment_token_id", "bigint"), ("created", "string"),
        ("conversation_created_at", "string"), ("conversation_created_date", "string"),
        ("conversation_external_id", "bigint"), ("team_id", "bigint"), ("reviewer_id", "bigint"),
        ("reviewee_id", "double"), ("comment_id", "double"), ("scorecard_id", "double"),
        ("scorecard_tag", "string"), ("score", "double"), ("updated_at", "string"), ("updated_by", "bigint"),
        ("assignment_review", "boolean"), ("seen", "boolean"), ("disputed", "boolean"),
        ("review_time_seconds", "double"), ("assignment_name", "string"), ("imported_at", "string"),
    ],
}

RAW_TABLES = tuple(RAW_COLUMNS)


def ddl(table: str) -> str:
    """Spark DDL string of a raw table's schema."""
    return ", ".join(f"`{c}` {t}" for c, t in RAW_COLUMNS[table])


def struct_type(table: str) -> T.StructType:
    return T.StructType.fromDDL(ddl(table))


def columns(table: str) -> list[str]:
    return [c for c, _ in RAW_COLUMNS[table]]
