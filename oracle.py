"""The same tables in DuckDB SQL, written independently of the Spark plans, for the side-by-side check.

Each table is a named subquery; ``sql(name)`` prefixes a query with the subqueries it mentions. Money and ratios come
out as DOUBLE and whole numbers as BIGINT, as in the registered Spark queries. Quotients are rounded half up in whole
numbers, so no binary fraction decides a tie.
"""

from __future__ import annotations

import re

from subledger.sources.retail import COLUMNS, INPUTS, raw_select

# The window of the test tables, the same as in the registered queries.
AS_OF, FIRST_DAY, LAST_DAY = "date '2001-12-31'", "date '1995-01-01'", "date '2001-12-31'"


def half_up(numerator: str, denominator: str, places: int) -> str:
    """numerator / denominator for whole numbers, denominator > 0; null when it is 0 or null."""
    n, d, unit = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)", 10**places
    return f"(case when {denominator} > 0 then sign({n}) * ((abs({n}) * {2 * unit} + {d}) // (2 * {d})) / {unit}.0 end)"


def cents(amount: str) -> str:
    return f"cast(round({amount} * 100) as bigint)"


def dollars(whole_cents: str) -> str:
    return f"(cast({whole_cents} as double) / 100)"


def capitalised(name: str) -> str:
    """Enough for the test names, which are one word each, with no letter after a punctuation mark."""
    return f"upper(left(trim({name}), 1)) || lower(substr(trim({name}), 2))"


def utc_from_shop(text: str) -> str:
    return f"cast(left({text}, 19) as timestamp) at time zone 'America/New_York' at time zone 'UTC'"


def stamp(text: str) -> str:
    return f"cast(left(nullif(trim({text}), ''), 19) as timestamp)"


def _columns(table: str) -> list[str]:
    return list(COLUMNS[table][0][2])


# Columns with fractions, which count in hundredths in a digest.
_FRACTIONS = {
    "total_spent", "subtotal_price", "total_tax", "total_shipping", "total_price", "total_discounts", "price", "total_discount",
}


def _order(table: str, skip: tuple[str, ...]) -> str:
    """The tie-break between copies: the digest of the columns as text, chr(30) for nothing, chr(31) between."""
    texts = [
        f"coalesce(cast({cents(c) if c in _FRACTIONS else c} as varchar), chr(30))" for c in _columns(table) if c not in skip
    ]
    return f"md5(concat_ws(chr(31), {', '.join(texts)}))"


TABLES: dict[str, str] = {
    **INPUTS,
    **{table: raw_select(table) for table in COLUMNS},
    "s_orders": f"""
        select id as order_id, cast(order_number as bigint) as order_number, customer_id as shopify_customer_id, lower(trim(email)) as customer_email,
            {utc_from_shop('created_at')} as order_created_at_utc,
            {cents('subtotal_price')} as subtotal_c, {cents('total_tax')} as tax_c,
            {cents('total_shipping')} as shipping_c, {cents('total_price')} as gross_c,
            {cents('total_discounts')} as discount_c, gross_c - discount_c as net_c,
            financial_status, fulfillment_status, source_name,
            source_name is not distinct from 'subscription_contract' as is_subscription_order,
            discount_codes, tags, billing_address_province as billing_state,
            case when landing_site like '%utm_source=%'
                then regexp_extract(landing_site, 'utm_source=([^&]*)', 1) end as utm_source,
            case when landing_site like '%utm_medium=%'
                then regexp_extract(landing_site, 'utm_medium=([^&]*)', 1) end as utm_medium,
            cancel_reason, cancelled_at
        from raw_shopify__orders
        qualify row_number() over (partition by id order by created_at nulls last,
            {_order('raw_shopify__orders', ('id', 'created_at'))}) = 1""",
    "s_customers": f"""
        select id as shopify_customer_id, lower(trim(email)) as customer_email,
            {capitalised('first_name')} as first_name, {capitalised('last_name')} as last_name,
            upper(trim(state)) as billing_state, {utc_from_shop('created_at')} as customer_created_at_utc,
            cast(orders_count as bigint) as shopify_orders_count, {cents('total_spent')} as spent_c,
            lower(accepts_marketing) is not distinct from 'true' as accepts_marketing, tags as customer_tags
        from raw_shopify__customers
        qualify row_number() over (partition by lower(trim(email)) order by created_at desc nulls first,
            {_order('raw_shopify__customers', ('created_at',))}) = 1""",
    "s_items": f"""
        select id as line_item_id, order_id, product_id, title as product_title, variant_title, sku,
            cast(quantity as bigint) as quantity, {cents('price')} as price_c, {cents('total_discount')} as discount_c,
            price_c * quantity as gross_c, price_c * quantity - discount_c as net_c
        from raw_shopify__order_line_items
        qualify row_number() over (partition by id order by {_order('raw_shopify__order_line_items', ('id',))}) = 1""",
    "s_subscriptions": f"""
        select id as subscription_id, customer_id as recharge_customer_id, shopify_customer_id,
            lower(trim(email)) as customer_email, product_title, variant_title, sku, {cents('price')} as price_c,
            cast(quantity as bigint) as quantity,
            status = 'active' and nullif(trim(cancelled_at), '') is not null as had_status_mismatch,
            if(had_status_mismatch, 'cancelled', lower(status)) as subscription_status,
            {stamp('created_at')} as subscription_created_at_utc, {stamp('cancelled_at')} as subscription_cancelled_at_utc,
            lower(nullif(trim(cancellation_reason), '')) as cancellation_reason,
            cast(charge_interval_frequency as bigint) as charge_interval_days, lower(order_interval_unit) as charge_interval_unit,
            case when charge_interval_frequency <= 30 then '30-day'
                when charge_interval_frequency <= 90 then '90-day' else 'other' end as subscription_frequency_tier,
            {stamp('next_charge_scheduled_at')} as next_charge_at_utc
        from raw_recharge__subscriptions""",
    "s_attempts": f"""
        select id as charge_id, subscription_id, customer_id as recharge_customer_id, shopify_order_id,
            lower(trim(email)) as customer_email, {stamp('created_at')} as charge_created_at_utc,
            {stamp('processed_at')} as charge_processed_at_utc, upper(type) as charge_type, upper(status) as charge_status,
            upper(status) is not distinct from 'SUCCESS' as is_successful_charge,
            coalesce(list_contains(['ERROR', 'DECLINED'], upper(status)), false) as is_failed_charge,
            {cents('total_price')} as total_c, {cents('subtotal_price')} as subtotal_c, {cents('tax_lines')} as tax_c,
            discount_codes, nullif(trim(raw_recharge__charges.error_message), '') as error_message,
            case when contains(lower(error_message), 'declined') then 'card_declined'
                when contains(lower(error_message), 'insufficient') then 'insufficient_funds'
                when contains(lower(error_message), 'expired') then 'card_expired'
                when contains(lower(error_message), 'update') then 'payment_method_update_needed'
                when length(trim(error_message)) > 0 then 'other_error' end as error_category,
            lower(payment_processor) as payment_processor
        from raw_recharge__charges""",
    "s_subscribers": f"""
        select id as recharge_customer_id, shopify_customer_id, lower(trim(email)) as customer_email,
            {capitalised('first_name')} as first_name, {capitalised('last_name')} as last_name,
            {stamp('created_at')} as recharge_created_at_utc, lower(status) as recharge_status,
            lower(has_payment_method_in_dunning) is not distinct from 'true' as is_in_dunning
        from raw_recharge__customers""",
    "s_payments": f"""
        select id as stripe_charge_id, amount as charge_c, amount_refunded as refunded_c, upper(currency) as currency,
            status as stripe_status, status is not distinct from 'succeeded' as is_successful,
            {stamp('created')} as charge_created_at_utc, lower(trim(customer_email)) as customer_email,
            metadata_shopify_order_id as shopify_order_id, metadata_recharge_charge_id as recharge_charge_id,
            lower(payment_method_type) as payment_method_type, lower(nullif(trim(raw_stripe__charges.failure_code), '')) as failure_code,
            status is not distinct from 'failed'
                and coalesce(metadata_shopify_order_id, metadata_recharge_charge_id) is null as is_ghost_failure
        from raw_stripe__charges""",
    "s_refunds": f"""
        select id as stripe_refund_id, charge_id as stripe_charge_id, amount as refund_c, upper(currency) as currency,
            status as refund_status, {stamp('created')} as refund_created_at_utc,
            coalesce(lower(nullif(trim(reason), '')), 'not_specified') as refund_reason,
            metadata_shopify_order_id as shopify_order_id
        from raw_stripe__refunds""",
    "unified": """
        with newest as (
            select customer_email, unnest(max_by(x, coalesce(recharge_created_at_utc, timestamp '9999-01-01')))
            from (select customer_email, recharge_created_at_utc,
                    {'recharge_customer_id': recharge_customer_id, 'recharge_status': recharge_status,
                     'is_in_dunning': is_in_dunning} as x from s_subscribers)
            group by customer_email)
        select s_customers.*, recharge_customer_id, recharge_customer_id is not null as is_subscriber, recharge_status,
            is_in_dunning
        from s_customers left join newest using (customer_email)""",
    "baskets": """
        select order_id, count(*) as item_count, cast(sum(quantity) as bigint) as total_units, sum(net_c) as items_c,
            coalesce(array_to_string(list_sort(list(distinct product_title)), ', '), '') as product_names,
            coalesce(array_to_string(list_sort(list(distinct sku)), ', '), '') as skus
        from s_items group by all""",
    "enriched": """
        select order_id, order_number, shopify_customer_id, customer_email, order_created_at_utc,
            cast(date_trunc('month', order_created_at_utc) as date) as order_month,
            row_number() over (partition by shopify_customer_id
                order by order_created_at_utc nulls last, order_id nulls last) as customer_order_sequence,
            gross_c, discount_c, net_c, tax_c, shipping_c, coalesce(item_count, 0) as item_count,
            coalesce(total_units, 0) as total_units, product_names, skus, is_subscription_order, financial_status,
            fulfillment_status, discount_codes, billing_state, utm_source, utm_medium,
            utm_source || ' / ' || coalesce(utm_medium, '(none)') as channel
        from s_orders left join baskets using (order_id)
        where financial_status <> 'voided'""",
    "reconciled": f"""
        with refunded as (
            select shopify_order_id as order_id, sum(refund_c) as back_c, count(*) as refunds from s_refunds group by all)
        select order_id, order_created_at_utc, cast(date_trunc('month', order_created_at_utc) as date) as order_month,
            shopify_customer_id, gross_c, financial_status, stripe_charge_id, charge_c, stripe_status,
            is_successful, coalesce(back_c, 0) as refund_c, coalesce(refunds, 0) as refund_count,
            coalesce(charge_c, 0) - coalesce(back_c, 0) as settled_c, gross_c - charge_c as gap_c,
            case when stripe_charge_id is null then 'no_stripe_match'
                when gap_c not between -1 and 1 then 'amount_mismatch'
                when back_c > 0 and financial_status <> 'refunded' and financial_status <> 'partially_refunded'
                    then 'orphaned_refund'
                else 'reconciled' end as reconciliation_status
        from s_orders
            left join (select shopify_order_id as order_id, * exclude (shopify_order_id) from s_payments where is_successful)
                using (order_id)
            left join refunded using (order_id)""",
    "buyers": """
        select shopify_customer_id, count(*) as n, sum(net_c) as net_c, min(order_created_at_utc) as first_at,
            max(order_created_at_utc) as last_at, cast(date_trunc('month', min(order_created_at_utc)) as date) as cohort,
            (list(channel order by order_created_at_utc nulls last, order_id nulls last) filter (where channel is not null))[1] as channel
        from enriched group by all""",
    "subscribed": """
        select shopify_customer_id, count(*) as total, count(*) filter (where subscription_status = 'active') as active,
            max(price_c) filter (where subscription_status = 'active') as price_c
        from s_subscriptions group by all""",
    "d_customers": f"""
        select shopify_customer_id as customer_id, customer_email, first_name, last_name, billing_state,
            customer_created_at_utc, accepts_marketing, coalesce(n, 0) as lifetime_orders,
            coalesce(buyers.net_c, 0) as net_c, first_at as first_order_at, last_at as last_order_at,
            cohort as acquisition_cohort_month, {half_up('buyers.net_c * 10000', 'n', 0)} / 1e6 as avg_order_value,
            channel as acquisition_channel, if(is_subscriber, 'subscriber', 'one_time') as customer_type,
            coalesce(total, 0) as total_subscriptions, coalesce(active, 0) as active_subscriptions, price_c, is_in_dunning,
            date_diff('day', last_at, {AS_OF}) as days_since_last_order
        from unified left join buyers using (shopify_customer_id) left join subscribed using (shopify_customer_id)""",
    "f_orders": """
        select e.* exclude (shopify_customer_id, order_created_at_utc, customer_email), shopify_customer_id as customer_id,
            cast(order_created_at_utc as date) as order_date, c.acquisition_cohort_month, c.acquisition_channel,
            customer_order_sequence = 1 as is_first_order
        from enriched e left join d_customers c on c.customer_id = e.shopify_customer_id""",
    "f_charges": """
        select * exclude (charge_processed_at_utc), cast(charge_created_at_utc as date) as charge_date,
            cast(date_trunc('month', charge_created_at_utc) as date) as charge_month
        from s_attempts""",
    "f_subscriptions": f"""
        with attempts as (
            select subscription_id, count(*) as tries, count(*) filter (where is_successful_charge) as wins,
                count(*) filter (where is_failed_charge) as losses,
                coalesce(sum(total_c) filter (where is_successful_charge), 0) as paid_c
            from s_attempts group by all)
        select s.*, date_diff('day', subscription_created_at_utc,
                coalesce(subscription_cancelled_at_utc, cast({AS_OF} as timestamp))) as subscription_duration_days,
            coalesce(tries, 0) as total_charge_attempts, coalesce(wins, 0) as successful_charges,
            coalesce(losses, 0) as failed_charges, coalesce(paid_c, 0) as paid_c,
            {half_up('losses', 'tries', 4)} as failure_rate,
            if(subscription_status = 'active', {half_up('price_c * 30', 'charge_interval_days', 0)}, 0) as mrr_c
        from s_subscriptions s left join attempts using (subscription_id)""",
    "months": f"select cast(unnest(generate_series({FIRST_DAY}, {LAST_DAY}, interval 1 month)) as date) as report_month",
}


def sql(query: str) -> str:
    """``query`` after the named subqueries it needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"(?:from|join|,)\s+([a-z_]+)", text)):
            if word in TABLES and word not in needed:
                visit(TABLES[word])
                needed.append(word)

    visit(query)
    if not needed:
        return query
    return "with " + ", ".join(f"{n} as ({TABLES[n]})" for n in needed) + f" select * from ({query})"


_M = dollars

ORACLES: dict[str, str] = {
    "stg_orders": f"""
        select order_id, order_number, shopify_customer_id, customer_email, order_created_at_utc,
            {_M('subtotal_c')} as subtotal_amount, {_M('tax_c')} as tax_amount, {_M('shipping_c')} as shipping_amount,
            {_M('gross_c')} as gross_revenue, {_M('discount_c')} as discount_amount, {_M('net_c')} as net_revenue,
            financial_status, fulfillment_status, source_name, is_subscription_order, discount_codes, tags, billing_state,
            utm_source, utm_medium, cancel_reason, cancelled_at
        from s_orders""",
    "stg_customers": f"select * exclude (spent_c), {_M('spent_c')} as shopify_total_spent from s_customers",
    "stg_line_items": f"""
        select * exclude (price_c, discount_c, gross_c, net_c), {_M('price_c')} as unit_price,
            {_M('discount_c')} as line_discount_amount, {_M('gross_c')} as gross_line_amount, {_M('net_c')} as net_line_amount
        from s_items""",
    "stg_subscriptions": f"select * exclude (price_c), {_M('price_c')} as subscription_price from s_subscriptions",
    "stg_recharge_charges": f"""
        select * exclude (total_c, subtotal_c, tax_c), {_M('total_c')} as charge_total, {_M('subtotal_c')} as charge_subtotal,
            {_M('tax_c')} as charge_tax
        from s_attempts""",
    "stg_recharge_customers": "select * from s_subscribers",
    "stg_stripe_charges": f"""
        select * exclude (charge_c, refunded_c), {_M('charge_c')} as charge_amount, {_M('refunded_c')} as refunded_amount,
            {_M('charge_c - refunded_c')} as net_charge_amount
        from s_payments""",
    "stg_stripe_refunds": f"select * exclude (refund_c), {_M('refund_c')} as refund_amount from s_refunds",
    "customers_unified": f"""
        select * exclude (spent_c, customer_tags), {_M('spent_c')} as shopify_total_spent from unified""",
    "orders_enriched": f"""
        select * exclude (gross_c, discount_c, net_c, tax_c, shipping_c), {_M('gross_c')} as gross_revenue,
            {_M('discount_c')} as discount_amount, {_M('net_c')} as net_revenue, {_M('tax_c')} as tax_amount,
            {_M('shipping_c')} as shipping_amount
        from enriched""",
    "payments_reconciled": f"""
        select order_id, order_created_at_utc, order_month, shopify_customer_id, {_M('gross_c')} as shopify_gross_revenue,
            financial_status as shopify_financial_status, stripe_charge_id, {_M('charge_c')} as stripe_charge_amount,
            stripe_status, is_successful as stripe_is_successful, {_M('refund_c')} as stripe_refund_amount,
            refund_count as stripe_refund_count, {_M('settled_c')} as stripe_net_settled, reconciliation_status,
            {_M('gap_c')} as revenue_variance
        from reconciled""",
    "dim_customers": f"""
        select * exclude (net_c, price_c), {_M('net_c')} as lifetime_revenue, {_M('price_c')} as current_subscription_price
        from d_customers""",
    "dim_products": f"""
        select product_id, product_title, variant_title, sku, {_M('price_c')} as current_price,
            case when contains(lower(variant_title), '30-day') then 30::bigint
                when contains(lower(variant_title), '90-day') then 90::bigint end as supply_duration_days,
            case supply_duration_days when 30 then '30-day' when 90 then '90-day' else 'other' end as supply_tier,
            if(contains(lower(product_title), 'bundle'), 'bundle', 'single') as product_type
        from s_items group by all""",
    "fct_orders": f"""
        select * exclude (gross_c, discount_c, net_c, tax_c, shipping_c), {_M('gross_c')} as gross_revenue,
            {_M('discount_c')} as discount_amount, {_M('net_c')} as net_revenue, {_M('tax_c')} as tax_amount,
            {_M('shipping_c')} as shipping_amount
        from f_orders""",
    "fct_subscriptions": f"""
        select subscription_id, shopify_customer_id as customer_id, customer_email, product_title, variant_title, sku,
            {_M('price_c')} as subscription_price, subscription_frequency_tier, charge_interval_days, subscription_status,
            subscription_created_at_utc, subscription_cancelled_at_utc, cancellation_reason, had_status_mismatch,
            subscription_duration_days, total_charge_attempts, successful_charges, failed_charges,
            {_M('paid_c')} as total_charged_revenue, failure_rate, {_M('mrr_c')} as monthly_recurring_revenue
        from f_subscriptions""",
    "fct_charges": f"""
        select * exclude (total_c, subtotal_c, tax_c), {_M('total_c')} as charge_total, {_M('subtotal_c')} as charge_subtotal,
            {_M('tax_c')} as charge_tax
        from f_charges""",
    "cohort_retention": """
        with seen as (
            select customer_id, acquisition_cohort_month as cohort_month,
                date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order
            from f_orders),
        active as (
            select cohort_month, months_since_first_order, count(distinct customer_id) as customers_active
            from seen group by all)
        select a.*, s.customers_active as cohort_size, round(a.customers_active / s.customers_active, 4) as retention_rate
        from active a join active s on s.cohort_month = a.cohort_month and s.months_since_first_order = 0""",
    "revenue_reconciliation": f"""
        with monthly as (
            select order_month, count(*) as total_orders, sum(gross_c) as shop,
                coalesce(sum(charge_c) filter (where is_successful), 0) as paid, sum(refund_c) as back, sum(settled_c) as settled,
                count(*) filter (where reconciliation_status = 'reconciled') as reconciled_orders,
                count(*) filter (where reconciliation_status = 'no_stripe_match') as unmatched_orders,
                count(*) filter (where reconciliation_status = 'amount_mismatch') as amount_mismatches,
                count(*) filter (where reconciliation_status = 'orphaned_refund') as orphaned_refunds
            from reconciled group by all)
        select order_month, total_orders, {_M('shop')} as shopify_revenue, {_M('paid')} as stripe_gross_revenue,
            {_M('back')} as stripe_total_refunds, {_M('settled')} as stripe_net_settled,
            {_M('shop - paid')} as gross_revenue_variance, {half_up('(shop - paid)', 'shop', 4)} as variance_pct,
            coalesce(abs(variance_pct) > 0.02, false) as exceeds_variance_threshold, reconciled_orders, unmatched_orders,
            amount_mismatches, orphaned_refunds, {half_up('reconciled_orders', 'total_orders', 4)} as reconciliation_rate
        from monthly""",
    "subscription_health": f"""
        with paired as (
            select report_month,
                count(distinct subscription_id) filter (where live) as active_subscriptions,
                count(distinct subscription_id) filter (where born = report_month) as new_subscriptions,
                count(distinct subscription_id) filter (where gone = report_month) as cancelled_subscriptions,
                coalesce(sum(mrr_c) filter (where live), 0) as mrr_c
            from (select report_month, subscription_id, mrr_c,
                    date_trunc('month', subscription_created_at_utc) as born,
                    date_trunc('month', subscription_cancelled_at_utc) as gone,
                    subscription_created_at_utc <= report_month + interval 1 month
                        and coalesce(subscription_cancelled_at_utc > report_month, true) as live
                from months, f_subscriptions)
            group by all),
        charged as (
            select charge_month as report_month, count(*) as tries, count(*) filter (where is_successful_charge) as wins,
                count(*) filter (where is_failed_charge) as losses, sum(total_c) filter (where is_successful_charge) as paid_c
            from f_charges group by all)
        select report_month, active_subscriptions, new_subscriptions, cancelled_subscriptions,
            {_M('mrr_c')} as monthly_recurring_revenue,
            {half_up('cancelled_subscriptions', 'active_subscriptions', 4)} as churn_rate,
            new_subscriptions - cancelled_subscriptions as net_subscription_change,
            coalesce(tries, 0) as total_charge_attempts, coalesce(wins, 0) as successful_charges,
            coalesce(losses, 0) as failed_charges, {half_up('losses', 'tries', 4)} as payment_failure_rate,
            {_M('coalesce(paid_c, 0)')} as charged_revenue
        from paired left join charged using (report_month)""",
    "dim_dates": """
        with bounds as (
            select min(cast(order_created_at_utc as date)) as a, max(cast(order_created_at_utc as date)) as b from s_orders),
        days as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as d from bounds)
        select d as date_key, d as full_date, year(d) as year, month(d) as month_number, day(d) as day_of_month,
            strftime(d, '%a') as day_name, strftime(d, '%b') as month_name,
            cast(date_trunc('month', d) as date) as month_start, last_day(d) as month_end, quarter(d) as quarter_number,
            printf('%d-Q%d', year(d), quarter(d)) as year_quarter, strftime(d, '%Y-%m') as year_month,
            isodow(d) >= 6 as is_weekend
        from days""",
    "order_sequence": """
        select order_id, shopify_customer_id, order_created_at_utc, customer_order_sequence from enriched""",
    "first_touch": "select shopify_customer_id, channel as acquisition_channel from buyers",
    "utm_parse": "select order_id, utm_source, utm_medium from s_orders",
    "listagg_distinct": f"""
        select * exclude (items_c), {_M('items_c')} as line_item_revenue from baskets""",
    "cents_to_dollars": f"select id, amount, {_M('amount')} as dollars from raw_stripe__charges",
    "safe_divide": f"""
        select line_item_id, {half_up('(discount_c * 100)', '(quantity - 1)', 0)} / 1e4 as discount_per_extra_unit
        from s_items""",
    "month_diff": "select shopify_customer_id, date_diff('month', first_at, last_at) as months_as_customer from buyers",
    "day_diff": f"select charge_id, date_diff('day', charge_created_at_utc, {AS_OF}) as days_ago from s_attempts",
    "tz_to_utc": f"select id, created_at, {utc_from_shop('created_at')} as created_at_utc from raw_shopify__orders",
    "error_category": f"""
        select error_category, count(*) as charges, {_M('sum(total_c)')} as charge_total from s_attempts group by all""",
    "conditional_distinct": """
        select charge_month, count(distinct subscription_id) as subscriptions,
            count(distinct subscription_id) filter (where is_successful_charge) as paid_subscriptions,
            count(distinct subscription_id) filter (where is_failed_charge) as failed_subscriptions
        from f_charges group by all""",
    "distinct_products": "select distinct product_id, product_title, sku from s_items",
    "month_spine": """
        select report_month, count(order_id) as orders
        from months left join s_orders on date_trunc('month', order_created_at_utc) = report_month group by all""",
    "dq_unique": """
        select id, count(*) as occurrences from raw_shopify__orders where id is not null group by all having count(*) > 1
        union all
        select id, count(*) from raw_shopify__order_line_items where id is not null group by all having count(*) > 1""",
    "dq_not_null": "select stripe_charge_id, stripe_status from s_payments where shopify_order_id is null",
    "dq_accepted_values": """
        select id, status from raw_recharge__charges
        where status not in ('SUCCESS', 'ERROR', 'DECLINED', 'QUEUED', 'REFUNDED')""",
    "dq_relationships": """
        select order_id, shopify_customer_id from enriched
        where shopify_customer_id is not null
            and not exists (from s_customers c where c.shopify_customer_id = enriched.shopify_customer_id)""",
    "dq_expression": f"select order_id, {_M('settled_c')} as stripe_net_settled from reconciled where settled_c < 0",
    "dq_recency": f"""
        select max(order_created_at_utc) as most_recent, {AS_OF} - interval 3 day as threshold
        from s_orders having max(order_created_at_utc) < {AS_OF} - interval 3 day""",
    "dq_tolerance": f"""
        select order_month, {_M('sum(gross_c)')} as shopify_revenue, {_M('sum(settled_c)')} as stripe_net_settled
        from reconciled group by all having abs(sum(gross_c) - sum(settled_c)) * 20 >= sum(gross_c)""",
    "churn_mrr_bridge": f"""
        with lives as (
            select shopify_customer_id as customer_id, report_month, {half_up('price_c * 30', 'charge_interval_days', 0)} as c,
                subscription_created_at_utc <= report_month + interval 1 month
                    and coalesce(subscription_cancelled_at_utc > report_month, true) as live
            from s_subscriptions, months),
        levels as (
            select customer_id, report_month, coalesce(sum(c) filter (where live), 0) as now from lives group by all),
        steps as (
            select *, lag(now, 1, 0) over (partition by customer_id order by report_month) as before from levels)
        select report_month, {_M('coalesce(sum(now) filter (where before = 0), 0)')} as new_mrr,
            {_M('coalesce(sum(now - before) filter (where before > 0 and now > before), 0)')} as expansion_mrr,
            {_M('coalesce(sum(now - before) filter (where now > 0 and now < before), 0)')} as contraction_mrr,
            {_M('coalesce(sum(-before) filter (where now = 0 and before > 0), 0)')} as churned_mrr
        from steps group by all having count(*) filter (where now <> before) > 0""",
    "active_mom_change": f"""
        with health as (
            select report_month, count(distinct subscription_id) as active_subscriptions
            from months left join f_subscriptions on subscription_created_at_utc <= report_month + interval 1 month
                and coalesce(subscription_cancelled_at_utc > report_month, true)
            group by all),
        beside as (select *, lag(active_subscriptions) over (order by report_month) as before from health)
        select report_month, active_subscriptions, active_subscriptions - before as change,
            {half_up('(active_subscriptions - before)', 'before', 4)} as change_rate
        from beside""",
    "ltv_curve": f"""
        with spent as (
            select acquisition_cohort_month as cohort_month,
                date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order,
                sum(net_c) as c, count(distinct customer_id) as n
            from f_orders where acquisition_cohort_month is not null group by all),
        grown as (
            select s.cohort_month, s.months_since_first_order, first.n as cohort_size, s.c,
                sum(s.c) over (partition by s.cohort_month order by s.months_since_first_order) as total_c
            from spent s join spent first on first.cohort_month = s.cohort_month and first.months_since_first_order = 0)
        select cohort_month, months_since_first_order, cohort_size, {_M('c')} as net_revenue,
            {_M('total_c')} as cumulative_revenue, {half_up('total_c', 'cohort_size', 0)} / 100 as revenue_per_customer
        from grown""",
    "ltv_by_channel": f"""
        with channels as (
            select acquisition_channel, count(*) as customers, sum(net_c) as c,
                cast(sum(lifetime_orders) as bigint) as lifetime_orders
            from d_customers group by all)
        select * exclude (c), {_M('c')} as lifetime_revenue, {half_up('c', 'customers', 0)} / 100 as revenue_per_customer
        from channels""",
    "channel_conversion": f"""
        with channels as (
            select acquisition_channel, count(*) as customers, count(recharge_customer_id) as subscribers
            from unified left join (select shopify_customer_id, channel as acquisition_channel from buyers)
                using (shopify_customer_id)
            group by all)
        select *, {half_up('subscribers', 'customers', 4)} as conversion_rate from channels""",
    "refund_rate": f"""
        with monthly as (
            select order_month, coalesce(sum(charge_c) filter (where is_successful), 0) as paid, sum(refund_c) as back,
                sum(settled_c) as settled
            from reconciled group by all)
        select order_month, {_M('paid')} as stripe_gross_revenue, {_M('back')} as stripe_total_refunds,
            {half_up('back', 'paid', 4)} as refund_rate, {_M('settled')} as net_revenue_after_returns
        from monthly""",
    "dunning_recovery": f"""
        with failed as (
            select charge_month, exists (
                    from s_attempts w where w.subscription_id = f.subscription_id and w.is_successful_charge
                        and w.charge_created_at_utc > f.charge_created_at_utc
                        and w.charge_created_at_utc <= f.charge_created_at_utc + interval 30 day) as recovered
            from f_charges f where is_failed_charge and subscription_id is not null),
        monthly as (
            select charge_month, count(*) as failed_charges, count(*) filter (where recovered) as recovered_charges
            from failed group by all)
        select *, {half_up('recovered_charges', 'failed_charges', 4)} as recovery_rate from monthly""",
    "retention_by_segment": f"""
        with seen as (
            select acquisition_channel, acquisition_cohort_month as cohort_month,
                date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order,
                count(distinct customer_id) as customers_active
            from f_orders where acquisition_cohort_month is not null group by all)
        select a.*, b.customers_active as cohort_size, round(a.customers_active / b.customers_active, 4) as retention_rate
        from seen a join seen b on b.cohort_month = a.cohort_month and b.months_since_first_order = 0
            and b.acquisition_channel is not distinct from a.acquisition_channel""",
    "channel_first_vs_repeat": f"""
        select channel, is_first_order, count(*) as orders, {_M('sum(net_c)')} as net_revenue from f_orders group by all""",
    "retention_by_product": """
        with firsts as (
            select shopify_customer_id as customer_id, product_names as first_products
            from enriched where product_names is not null and customer_order_sequence = 1),
        seen as (
            select first_products, acquisition_cohort_month as cohort_month,
                date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order,
                count(distinct customer_id) as customers_active
            from f_orders left join firsts using (customer_id) where acquisition_cohort_month is not null group by all)
        select a.*, b.customers_active as cohort_size, round(a.customers_active / b.customers_active, 4) as retention_rate
        from seen a join seen b on b.cohort_month = a.cohort_month and b.months_since_first_order = 0
            and b.first_products is not distinct from a.first_products""",
    "retention_by_interval": """
        with tiers as (
            select shopify_customer_id as customer_id, subscription_frequency_tier as subscription_tier from s_subscriptions
            qualify row_number() over (partition by shopify_customer_id
                order by subscription_created_at_utc nulls last, subscription_id nulls last) = 1),
        seen as (
            select subscription_tier, acquisition_cohort_month as cohort_month,
                date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order,
                count(distinct customer_id) as customers_active
            from f_orders left join tiers using (customer_id) where acquisition_cohort_month is not null group by all)
        select a.*, b.customers_active as cohort_size, round(a.customers_active / b.customers_active, 4) as retention_rate
        from seen a join seen b on b.cohort_month = a.cohort_month and b.months_since_first_order = 0
            and b.subscription_tier is not distinct from a.subscription_tier""",
    "dq_fact_relationships": """
        select order_id, customer_id from f_orders
        where customer_id is not null and not exists (from d_customers c where c.customer_id = f_orders.customer_id)""",
    "csv_to_view": "select billing_state, count(*) as customers from s_customers group by all",
    "dq_report": "",
}

ORACLES["subscription_health_recovery"] = f"""
    select h.*, d.recovered_charges, d.recovery_rate
    from ({ORACLES['subscription_health']}) h left join ({ORACLES['dunning_recovery']}) d on d.charge_month = h.report_month"""

# The declared checks, as "table: unique and not null columns / not null columns".
DECLARED_KEYS = """
raw_shopify__customers: id /
raw_shopify__orders: / id customer_id
raw_shopify__order_line_items: / id order_id
raw_recharge__subscriptions: id / customer_id
raw_recharge__charges: id /
raw_recharge__customers: id / shopify_customer_id
raw_stripe__charges: id /
raw_stripe__refunds: id /
stg_shopify__orders: order_id / shopify_customer_id gross_revenue
stg_shopify__customers: shopify_customer_id customer_email /
stg_shopify__order_line_items: line_item_id / order_id
stg_recharge__subscriptions: subscription_id / recharge_customer_id
stg_recharge__charges: charge_id /
stg_recharge__customers: recharge_customer_id shopify_customer_id /
stg_stripe__charges: stripe_charge_id / charge_amount
stg_stripe__refunds: stripe_refund_id / refund_amount
int_customers__unified: shopify_customer_id customer_email /
int_orders__enriched: order_id /
int_payments__reconciled: order_id /
dim_dates: date_key /
dim_products: sku /
dim_customers: customer_id /
fct_orders: order_id / customer_id
fct_subscriptions: subscription_id /
fct_charges: charge_id /
rpt_revenue_reconciliation: order_month /
rpt_subscription_health: report_month /
"""
# Kind of check, table, column, and the condition of a row that fails it.
DECLARED_CONDITIONS = [
    ("accepted_values", "raw_shopify__orders", "financial_status", "financial_status not in ('paid', 'pending', 'refunded', 'partially_refunded', 'voided')"),
    ("accepted_values", "raw_recharge__charges", "status", "status not in ('SUCCESS', 'ERROR', 'DECLINED', 'QUEUED', 'REFUNDED')"),
    ("accepted_values", "raw_stripe__charges", "status", "status not in ('succeeded', 'failed', 'pending')"),
    ("accepted_values", "stg_shopify__orders", "financial_status", "financial_status not in ('paid', 'pending', 'refunded', 'partially_refunded', 'voided')"),
    ("accepted_values", "stg_recharge__subscriptions", "subscription_status", "subscription_status not in ('active', 'cancelled', 'expired')"),
    ("accepted_values", "stg_recharge__charges", "charge_status", "charge_status not in ('SUCCESS', 'ERROR', 'DECLINED', 'QUEUED', 'REFUNDED')"),
    ("accepted_values", "int_payments__reconciled", "reconciliation_status",
     "reconciliation_status not in ('reconciled', 'no_stripe_match', 'amount_mismatch', 'orphaned_refund')"),
    ("accepted_values", "dim_customers", "customer_type", "customer_type not in ('subscriber', 'one_time')"),
    ("expression", "stg_stripe__charges", "charge_amount", "charge_amount < 0"),
    ("expression", "stg_stripe__refunds", "refund_amount", "refund_amount <= 0"),
    ("expression", "fct_subscriptions", "monthly_recurring_revenue", "monthly_recurring_revenue < 0"),
    ("expression", "rpt_monthly_cohort_retention", "retention_rate", "retention_rate > 1"),
    ("expression", "rpt_subscription_health", "monthly_recurring_revenue", "monthly_recurring_revenue < 0"),
]


def _report() -> str:
    """Every declared check, counted over the published columns of its table."""
    published = {
        "stg_shopify__orders": "stg_orders", "stg_shopify__customers": "stg_customers",
        "stg_shopify__order_line_items": "stg_line_items", "stg_recharge__subscriptions": "stg_subscriptions",
        "stg_recharge__charges": "stg_recharge_charges", "stg_recharge__customers": "stg_recharge_customers",
        "stg_stripe__charges": "stg_stripe_charges", "stg_stripe__refunds": "stg_stripe_refunds",
        "int_customers__unified": "customers_unified", "int_orders__enriched": "orders_enriched",
        "int_payments__reconciled": "payments_reconciled", "rpt_monthly_cohort_retention": "cohort_retention",
        "rpt_revenue_reconciliation": "revenue_reconciliation", "rpt_subscription_health": "subscription_health",
    }

    def count(table: str, column: str, check: str, condition: str, grouped: bool = False) -> str:
        rows = table if table in COLUMNS else f"({ORACLES[published.get(table, table)]})"
        hits = (
            f"(select {column} from {rows} where {column} is not null group by all having count(*) > 1)" if grouped
            else f"{rows} where {condition}"
        )
        return (
            f"select '{table}' as table_name, '{column}' as column_name, '{check}' as check_name, "
            f"(select count(*) from {hits}) as violations"
        )

    parts = []
    for line in DECLARED_KEYS.strip().splitlines():
        table, _, columns = line.partition(":")
        unique, _, present = columns.partition("/")
        parts += [count(table, column, "unique", "", grouped=True) for column in unique.split()]
        parts += [count(table, column, "not_null", f"{column} is null") for column in (unique + present).split()]
    parts += [count(table, column, kind, fails) for kind, table, column, fails in DECLARED_CONDITIONS]
    return " union all ".join(parts)


ORACLES["dq_report"] = _report()


# Whatever the batches were, the tables are those of a full rebuild.
for _name in ("fct_orders", "dim_customers", "cohort_retention"):
    ORACLES[f"incremental_{_name}"] = ORACLES[_name]
ORACLES["rebuilt_fct_orders"] = ORACLES["fct_orders"]

_PROFILES = """
    with points as (
        select customer_email, order_created_at_utc as since, channel, is_subscription_order, financial_status,
            md5(concat_ws(chr(31), coalesce(channel, chr(30)), cast(is_subscription_order as varchar), financial_status)) as digest
        from enriched where customer_email is not null and order_created_at_utc is not null
        qualify row_number() over (partition by customer_email, order_created_at_utc order by digest desc) = 1
    ), changed as (
        select * from points qualify digest is distinct from lag(digest) over (partition by customer_email order by since)
    )
    select customer_email, channel, is_subscription_order, financial_status, since as valid_from,
        lead(since) over (partition by customer_email order by since) as valid_to
    from changed"""
ORACLES["customer_history"] = ORACLES["customer_history_late"] = _PROFILES
ORACLES["charges_as_of"] = f"""
    select charge_id, c.customer_email, charge_created_at_utc, charge_status, {_M('total_c')} as charge_total,
        channel, is_subscription_order, financial_status
    from f_charges c left join ({_PROFILES}) p on p.customer_email = c.customer_email
        and p.valid_from <= charge_created_at_utc and (p.valid_to is null or p.valid_to > charge_created_at_utc)"""
_AT_RISK = """
    select charge_id, subscription_id, charge_created_at_utc, total_c, (
            select max({'at': w.charge_created_at_utc, 'digest': md5(concat_ws(chr(31), cast(w.charge_created_at_utc as varchar),
                cast(w.total_c / 100.0 as decimal(38, 2))::varchar)), 'price': w.total_c})
            from f_charges w where w.subscription_id = f.subscription_id and w.is_successful_charge
                and w.charge_created_at_utc < f.charge_created_at_utc) as last
    from f_charges f where is_failed_charge"""
ORACLES["failed_charge_price"] = f"""
    select charge_id, subscription_id, charge_created_at_utc, {_M('total_c')} as charge_total, last['at'] as paid_at,
        {_M("last['price']")} as last_price
    from ({_AT_RISK})"""
ORACLES["revenue_at_risk"] = f"""
    select cast(date_trunc('month', charge_created_at_utc) as date) as charge_month, count(*) as failed_charges,
        count(last['price']) as with_earlier_price, {_M("sum(last['price'])")} as revenue_at_risk
    from ({_AT_RISK}) group by all"""


# Greedy: all possible pairs in order, each taken if neither of its rows is.
ORACLES["matched_payments"] = f"""
    with recursive loose as (
        select stripe_charge_id, customer_email, charge_created_at_utc as r_time, charge_c from s_payments
        where shopify_order_id is null and customer_email is not null
    ), open_orders as (
        select order_id, o.customer_email, o.order_created_at_utc as l_time, o.gross_c
        from s_orders o join reconciled r using (order_id) where reconciliation_status = 'no_stripe_match'
    ), pairs as (
        select order_id, stripe_charge_id, abs(gross_c - charge_c) as gap_c,
            abs(epoch(l_time) - epoch(r_time))::bigint as seconds, l_time, gross_c, r_time, charge_c
        from open_orders join loose using (customer_email) where gap_c <= 500 and seconds <= 45 * 86400
    ), numbered as (
        select order_id, stripe_charge_id, gap_c, seconds, row_number() over (
            order by gap_c, seconds, l_time, gross_c, r_time, charge_c, order_id, stripe_charge_id) as n from pairs
    ), walk as (
        select 0::bigint as n, []::bigint[] as orders_used, []::varchar[] as charges_used
        union all
        select p.n, case when free then list_append(orders_used, order_id) else orders_used end,
            case when free then list_append(charges_used, stripe_charge_id) else charges_used end
        from (select q.*, w.orders_used, w.charges_used, not list_contains(w.orders_used, q.order_id)
                and not list_contains(w.charges_used, q.stripe_charge_id) as free
            from walk w join numbered q on q.n = w.n + 1) p
    ), used as (
        select unnest(orders_used) as order_id, unnest(charges_used) as stripe_charge_id
        from (select * from walk order by n desc limit 1)
    )
    select order_id, stripe_charge_id, {_M('gap_c')} as amount_gap, seconds as seconds_gap
    from numbered join used using (order_id, stripe_charge_id)"""
ORACLES["customer_identity"] = """
    with recursive ties as (
        select 'shop:' || id as a, 'email:' || lower(trim(email)) as b from raw_shopify__customers
        union all select 'subscription:' || recharge_customer_id, 'email:' || customer_email from s_subscribers
        union all select 'subscription:' || recharge_customer_id, 'shop:' || shopify_customer_id from s_subscribers
        union all select 'payment:' || stripe_charge_id, coalesce('email:' || customer_email, 'payment:' || stripe_charge_id) from s_payments
    ), edges as (
        select a, b from ties where b is not null union select b, a from ties where b is not null
    ), reach as (
        select distinct a as start, a as node from edges where a not like 'payment:%'
        union
        select start, b from reach join edges on a = node where b not like 'payment:%'
    ), least as (
        select start as node, min(node) as customer from reach group by start
    )
    select node as record, customer from least where node not like 'email:%'
    union all
    select distinct a, coalesce(customer, b) from ties left join least on node = b where a like 'payment:%'"""


def _sketched(by: str) -> str:
    """The exact figures; estimates keep their bounds."""
    return f"""
        select {by}, count(*) as lines, count(distinct shopify_customer_id) as customers, true as customers_within_bound, true as median_within_bound
        from enriched join s_items using (order_id) group by {by}"""


ORACLES["sketch_rollup"] = _sketched("channel")
ORACLES["sketch_rollup_by_month"] = _sketched("channel, order_month")
ORACLES["sketch_retention"] = """
    select acquisition_cohort_month as cohort_month, date_diff('month', acquisition_cohort_month, order_month) as months_since_first_order,
        count(distinct customer_id) as customers_active, true as within_bound
    from f_orders where acquisition_cohort_month is not null and order_month is not null group by 1, 2"""
ORACLES["customer_streaks"] = """
    with recursive active as (
        select distinct customer_id, order_month from f_orders
        where order_month is not null and customer_id in (select customer_id from d_customers)
    ), runs as (
        select customer_id, order_month as streak_start, order_month as streak_end, 1 as n from active a
        where not exists (select 1 from active b where b.customer_id = a.customer_id and b.order_month = a.order_month - interval 1 month)
        union all
        select r.customer_id, streak_start, a.order_month, n + 1
        from runs r join active a on a.customer_id = r.customer_id and a.order_month = r.streak_end + interval 1 month
    ), longest as (
        select customer_id, streak_start, max(streak_end) as streak_end, max(n)::bigint as active_months from runs group by all
    )
    select *, (select date_diff('month', max(b.streak_end), a.streak_start) - 1 from longest b
        where b.customer_id = a.customer_id and b.streak_end < a.streak_start) as months_paused
    from longest a"""
ORACLES["channel_credit"] = """
    with known as (
        select order_id, shopify_customer_id as customer, order_created_at_utc as placed, channel, net_c from enriched
        where channel is not null and shopify_customer_id is not null and order_created_at_utc is not null
    ), touches as (
        select o.order_id, o.net_c, t.channel from known o join known t on t.customer = o.customer
            and (t.placed, t.order_id) <= (o.placed, o.order_id) group by all
    ), linear as (
        select channel, sum(cast(net_c as decimal(30, 8)) / 100 / n) as linear
        from touches join (select order_id, count(*) as n from touches group by all) using (order_id) group by channel
    ), last as (
        select channel, sum(net_c) as last_c from known group by channel
    ), first as (
        select first_channel as channel, sum(net_c) as first_c from (
            select net_c, first_value(channel) over (partition by customer order by placed, order_id) as first_channel from known
        ) group by all
    )
    select channel, coalesce(first_c, 0) / 100.0 as first_touch, coalesce(last_c, 0) / 100.0 as last_touch, round(linear, 2)::double as linear
    from linear left join last using (channel) left join first using (channel)"""
ORACLES["subscription_survival"] = f"""
    with lives as (
        select subscription_frequency_tier as tier, subscription_cancelled_at_utc is not null as gone, greatest(0, date_diff('month',
            subscription_created_at_utc, coalesce(subscription_cancelled_at_utc, cast({AS_OF} as timestamp)))) as tenure
        from s_subscriptions where subscription_created_at_utc is not null
    ), tenures as (
        select t.tier, t.tenure, (select count(*) from lives l where l.tier = t.tier and l.tenure >= t.tenure) as at_risk,
            (select count(*) from lives l where l.tier = t.tier and l.tenure = t.tenure and gone) as ended,
            (select count(*) from lives l where l.tier = t.tier and l.tenure = t.tenure and not gone) as censored
        from (select distinct tier, tenure from lives) t
    )
    select tier, tenure as tenure_months, at_risk, ended, censored,
        round((select product(1 - e.ended / e.at_risk) from tenures e where e.tier = t.tier and e.tenure <= t.tenure), 6) as survival
    from tenures t"""
ORACLES["order_differences"] = f"""
    with orders_now as (
        select order_id, shopify_customer_id, order_month, financial_status, order_month is not null and year(order_month) = 1997 as in_year from enriched
    )
    select order_id, 'removed' as change, null::varchar as "column", null::varchar as before, null::varchar as after, 1::bigint as copies
    from orders_now where in_year and order_id % 40 = 9
    union all
    select order_id, 'added', null, null, null, 1 from orders_now
    where in_year and order_id % 60 = 2 and order_id % 40 <> 9 and not (order_id % 50 = 4 and financial_status <> 'refunded')
    union all
    select order_id, 'changed', 'financial_status', financial_status, 'refunded', 1 from orders_now
    where in_year and order_id % 50 = 4 and financial_status <> 'refunded' and order_id % 40 <> 9 and order_id % 60 <> 2
    union all
    select order_id, unnest(['removed', 'added']), null, null, null, unnest([1, 2]) from orders_now
    where in_year and order_id % 50 = 4 and financial_status <> 'refunded' and order_id % 40 <> 9 and order_id % 60 = 2"""


def oracle_sql() -> dict[str, str]:
    return {name: sql(query) for name, query in ORACLES.items()}
