"""Strings and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters after which the warehouse's initcap starts a new word, besides white space.
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"

_AFTER_BREAK = "(?<=[\\s" + "".join("\\" + c for c in WORD_BREAKS) + "])"


def flag(condition: Column) -> Column:
    """A condition that is false, never null, where it cannot be decided."""
    return F.coalesce(condition, F.lit(False))


def clean_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def proper_name(name: Column) -> Column:
    """Trim and capitalise each word. Spark's ``initcap`` knows only the space as a word break."""
    words = F.split(F.lower(F.trim(name)), _AFTER_BREAK)
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), F.substring(w, 2, 2**31 - 1))), "")


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value) == "")


def blank_to_null(value: Column, then: Column | None = None) -> Column:
    """``then`` (by default the value itself) where the value has text in it, else null."""
    return F.when(F.trim(value) != "", value if then is None else then)


def url_parameter(url: Column, name: str) -> Column:
    """A query parameter of a landing page; '' when present but empty, null when absent.

    Presence is a LIKE on ``name=``, where ``_`` stands for any character, so a look-alike name gives ''. Nothing is
    URL-decoded. Most pages are decided by plain substring tests; the pattern only has to look at the rest.
    """
    key = f"{name}="
    after = F.substr(url, F.locate(key, url) + len(key))
    value = F.substring_index(F.substring_index(after, key, 1), "&", 1)
    look_alike = url.contains(key.split("_")[0]) & url.like(f"%{key}%")
    return F.when(url.contains(key), value).when(look_alike, F.lit(""))
