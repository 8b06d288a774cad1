"""How long customers and subscriptions last: streaks of active months, touches of channels, survival by tenure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.functions import months_between
from subledger.settings import Settings


def streaks(active_months: DataFrame) -> DataFrame:
    """Runs of consecutive months in which a customer ordered, and for all but the first how long the pause before was.

    ``active_months`` has a row per customer and month, so a customer's rows are bounded by the calendar however many orders
    there are. A month's number less its place among the customer's months is the same throughout a run.
    """
    number = 12 * F.year("order_month") + F.month("order_month")
    months = active_months.filter("order_month is not null").select("customer_id", "order_month", number.alias("_number"))
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy("order_month"))
    runs = months.withColumn("_run", F.col("_number") - place).groupBy("customer_id", "_run").agg(
        F.min("order_month").alias("streak_start"), F.max("order_month").alias("streak_end"), F.count("*").alias("active_months")
    )
    before = F.lag("streak_end").over(Window.partitionBy("customer_id").orderBy("streak_start"))
    return runs.withColumn("_before", before).select(
        "customer_id", "streak_start", "streak_end", "active_months",
        (months_between(F.col("_before"), F.col("streak_start")) - 1).alias("months_paused"),
    )


def channel_credit(orders: DataFrame) -> DataFrame:
    """Revenue of each channel by three rules: to the channel of a customer's first order, to that of the order, and in equal
    parts to all channels the customer has come by so far.

    A touch is the first order by a channel, so a customer has as many as there are channels. Tasks reduce orders to touches
    ahead of the shuffle, and an order meets its customer's touches as one array: a customer with very many orders is on the
    side of the join that adaptive execution splits.
    """
    known = orders.filter("channel is not null and shopify_customer_id is not null and order_created_at_utc is not null")
    when = F.struct(F.col("order_created_at_utc").alias("placed"), F.col("order_id").alias("id"))
    touches = known.groupBy("shopify_customer_id", "channel").agg(F.min(when).alias("at")).groupBy("shopify_customer_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "channel"))).alias("_touches")
    )
    so_far = F.filter("_touches", lambda t: t["at"] <= F.col("_when"))
    touched = known.select("shopify_customer_id", "channel", "net_revenue", when.alias("_when")).join(touches, "shopify_customer_id").select(
        "channel", "net_revenue", F.col("_touches")[0]["channel"].alias("_first"), F.transform(so_far, lambda t: t["channel"]).alias("_all"),
    )
    none = F.lit(0).cast("decimal(30,8)")
    shares = touched.select(
        F.inline(F.concat(
            F.array(
                F.struct(F.col("_first").alias("channel"), F.col("net_revenue").cast("decimal(30,8)").alias("first_touch"), none.alias("last_touch"), none.alias("linear")),
                F.struct(F.col("channel"), none.alias("first_touch"), F.col("net_revenue").cast("decimal(30,8)").alias("last_touch"), none.alias("linear")),
            ),
            F.transform("_all", lambda c: F.struct(
                c.alias("channel"), none.alias("first_touch"), none.alias("last_touch"),
                (F.col("net_revenue") / F.size("_all")).cast("decimal(30,8)").alias("linear"),
            )),
        ))
    )
    return shares.groupBy("channel").agg(*[F.round(F.sum(c), 2).alias(c) for c in ("first_touch", "last_touch", "linear")])


def survival(subscriptions: DataFrame, settings: Settings) -> DataFrame:
    """Product-limit curves by tier: of the subscriptions that reached a tenure in months, how many ended then, and the share
    that lasts longer. Subscriptions that still run left the watch at their present tenure (censored).

    From counts of ends and censorings per tenure alone: whoever is at risk later is whoever has not left yet.
    """
    end = F.coalesce("subscription_cancelled_at_utc", F.lit(settings.as_of.isoformat(" ")).cast("timestamp_ntz") if settings.as_of else F.current_timestamp().cast("timestamp_ntz"))
    tenure = F.greatest(F.lit(0), months_between(F.col("subscription_created_at_utc"), end)).cast("bigint")
    ended = F.col("subscription_cancelled_at_utc").isNotNull()
    counts = subscriptions.filter("subscription_created_at_utc is not null").groupBy(
        F.col("subscription_frequency_tier").alias("tier"), tenure.alias("tenure_months")
    ).agg(F.count_if(ended).alias("ended"), F.count_if(~ended).alias("censored"))
    later = Window.partitionBy("tier").orderBy("tenure_months").rowsBetween(0, Window.unboundedFollowing)
    so_far = Window.partitionBy("tier").orderBy("tenure_months").rowsBetween(Window.unboundedPreceding, 0)
    watched = counts.withColumn("at_risk", F.sum(F.col("ended") + F.col("censored")).over(later))
    share = F.product(1 - F.col("ended").cast("double") / F.col("at_risk")).over(so_far)
    return watched.select("tier", "tenure_months", "at_risk", "ended", "censored", F.round(share, 6).alias("survival"))
