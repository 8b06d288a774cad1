"""Subscription-commerce analytics on Spark: shop, subscription and payment data in one set of tables."""

from subledger.plans.project import Project
from subledger.settings import Settings

__all__ = ["Project", "Settings"]
