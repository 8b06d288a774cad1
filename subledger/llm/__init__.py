"""Operators for preparing training data: each module holds one, ``queries`` applies them to whole tables."""
