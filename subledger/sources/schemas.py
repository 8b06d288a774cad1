"""Schemas of the eight raw tables. Numbers are typed, all else is text that staging casts."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names and types of the raw exports, grouped by source system.
RAW_TABLES: dict[str, dict[str, str]] = {
    "shopify": {
        "raw_shopify__customers": """
            id bigint, email string, first_name string, last_name string, state string, created_at string,
            orders_count int, total_spent double, tags string, accepts_marketing string""",
        "raw_shopify__orders": """
            id bigint, order_number bigint, customer_id bigint, email string, created_at string, financial_status string,
            fulfillment_status string, subtotal_price double, total_tax double, total_shipping double,
            total_price double, total_discounts double, discount_codes string, source_name string,
            landing_site string, referring_site string, cancel_reason string, cancelled_at string, tags string,
            billing_address_province string""",
        "raw_shopify__order_line_items": """
            id bigint, order_id bigint, product_id string, title string, variant_title string, sku string,
            quantity int, price double, total_discount double""",
    },
    "recharge": {
        "raw_recharge__customers": """
            id bigint, shopify_customer_id bigint, email string, first_name string, last_name string,
            created_at string, status string, has_payment_method_in_dunning string""",
        "raw_recharge__subscriptions": """
            id bigint, customer_id bigint, shopify_customer_id bigint, email string, product_title string,
            variant_title string, sku string, price double, quantity int, status string, created_at string,
            cancelled_at string, cancellation_reason string, charge_interval_frequency int,
            order_interval_unit string, next_charge_scheduled_at string""",
        "raw_recharge__charges": """
            id bigint, subscription_id bigint, customer_id bigint, shopify_order_id bigint, email string,
            created_at string, processed_at string, type string, status string, total_price double,
            subtotal_price double, tax_lines double, discount_codes string, error_message string,
            payment_processor string""",
    },
    "stripe": {
        "raw_stripe__charges": """
            id string, amount bigint, amount_refunded bigint, currency string, status string, created string,
            customer_email string, metadata_shopify_order_id bigint, metadata_recharge_charge_id bigint,
            payment_method_type string, failure_code string, failure_message string""",
        "raw_stripe__refunds": """
            id string, charge_id string, amount bigint, currency string, status string, created string, reason string,
            metadata_shopify_order_id bigint""",
    },
}


def raw_schema(system: str, table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_TABLES[system][table])
