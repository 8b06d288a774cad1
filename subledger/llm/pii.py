"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their scores.

Everything is a column expression over one row, so nothing is shuffled and no row leaves the JVM. Where a match lies
follows from the lengths of the matches and of the texts between them; the ends of those texts are also the context that
scores are adjusted by.

Patterns are written so that the time for a text is proportional to its length: repeated groups are possessive, and a run
of letters that turned out to be no address is not tried again from its second letter on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a match that its context words are looked for in.
BEFORE, AFTER = 48, 24
#: A proposal needs this score, after its context has been looked at.
THRESHOLD = 0.5
#: What a word for, or against, a kind of data nearby does to the score.
SUPPORT, DOUBT = 0.35, -0.2
#: Matches whose places are summed up at a time; keeps the work for a text with very many of them nearly linear.
BLOCK = 256

#: Lengths of account numbers by country (ISO 13616). Fixed values.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26,
}
#: Words that doubt any number. Fixed values.
OTHER_NUMBERS = "isbn|issn|order|invoice|version|ticket|serial|tracking|sku|part no|bestellnummer|commande|pedido"


@dataclass(frozen=True)
class Rule:
    """One kind of data.

    ``gate`` is a cheaper test that a text with a valid proposal always passes. ``valid`` says of a proposal's text whether it can be one; ``before`` and ``after`` are patterns that the text on
    either side must not end or start with. ``score`` counts for a valid proposal without context, ``words`` are those that
    support it. Proposals of a ``certain`` rule are reported whatever the context.
    """

    kind: str
    gate: Callable[[Column], Column]
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    before: str = ""
    after: str = ""
    certain: bool = False


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text end in the right check digit."""
    return F.call_function("luhn_check", digits(text))


def mod_97(text: Column) -> Column:
    """Whether an account number, its first four characters put last and its letters read as 10 to 35, leaves 1 by 97."""
    plain = F.regexp_replace(text, "[^0-9A-Z]", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _iban_pattern() -> str:
    def of(country: str, length: int) -> str:
        groups, rest = divmod(length - 4, 4)
        return f"{country}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")

    return "(?:" + "|".join(of(*item) for item in IBAN_LENGTHS.items()) + ")"


PHONE_WORDS = "phone|tel|call|mobile|cell|fax|whatsapp|telefon|handy|portable|móvil"

_LOCAL = "[A-Za-z0-9._%+-]"
_TO_255 = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_LETTER = "[A-Za-z0-9]"

#: The first four are the base: their order is the order of spans that start together.
RULES: tuple[Rule, ...] = (
    Rule(
        "email", lambda text: text.contains("@"), rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda text: F.lit(True), 0.9,
        "mail|e-mail|contact|write|correo|courriel", certain=True,
    ),
    Rule(
        "ip", lambda text: text.rlike(r"[0-9]\.[0-9]+\.[0-9]"), r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda text: text.rlike(rf"^{_TO_255}(?:\.{_TO_255}){{3}}$"), 0.6,
        "ip|address|host|server|login|client", certain=True,
    ),
    Rule(
        "card", lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), r"[0-9](?:[\x20-]?[0-9])++", lambda text: F.length(digits(text)).between(12, 19) & luhn(text), 0.8,
        "card|visa|credit|debit|karte|carte|tarjeta|amex|maestro", certain=True,
    ),
    Rule(
        "phone", lambda text: text.contains("+"), r"\+[0-9][\x20().0-9-]+[0-9]", lambda text: F.length(digits(text)).between(9, 15), 0.7,
        PHONE_WORDS, certain=True,
    ),
    Rule(
        "iban", lambda text: text.rlike("[A-Z][A-Z][0-9][0-9] ?[A-Z0-9]{4}"), _iban_pattern(), mod_97, 0.9,
        "iban|account|bank|konto|compte|cuenta", before=f"{_LETTER}$", after=f"^{_LETTER}",
    ),
    Rule(
        "ssn", lambda text: text.contains("-") & text.rlike("-[0-9]{2}-[0-9]{4}"), "[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda text: ~text.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3,
        "ssn|social security|social-security|taxpayer", before=r"(?:[A-Za-z0-9+]|[0-9+][ .()-])$", after="^(?:[ -]?[0-9]|[A-Za-z@_])",
    ),
    Rule(
        "tel", lambda text: text.rlike("[0-9]{3}[ .-]?[0-9]{4}"), r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}", lambda text: F.lit(True), 0.3,
        PHONE_WORDS, before=r"(?:[A-Za-z0-9+_%]|[0-9][ .()-]|\+[0-9][ ().0-9-]*)$",
        after="^(?:[ .-]?[0-9]|[A-Za-z@_%+])",
    ),
)
BASE = 4


def find(
    df: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: key, and the spans of all rules by start, then by rule, as an array of (start, rule, end, kind, score,
    text). Places are code points, ends exclusive.

    Per rule, matches are leftmost and do not overlap; one that is not valid is dropped, without looking for a shorter one.
    A null or empty text has no spans (an empty array). Whole texts are read however long; repeated rows are searched each,
    an empty table gives no rows, other columns of the input are not looked at.
    """
    found = df.select(F.col(key).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    found = found.withColumn("_any", F.col("_t").rlike("[0-9@]"))  # what every kind has
    found = found.select("_id", "_t", *[_matched(n, rule) for n, rule in enumerate(rules)])
    found = found.select("_id", *[f"_m{n}" for n in range(len(rules))], *[_between(n, rule) for n, rule in enumerate(rules)])
    found = found.select("_id", *[_with_sides(n) for n in range(len(rules))])
    found = found.select("*", *[_blocks(n) for n in range(len(rules))])
    found = found.select("*", *[_block_starts(n) for n in range(len(rules))])
    found = found.select("*", *[_starts(n) for n in range(len(rules))])
    kept = [_judged(n, rule, threshold) for n, rule in enumerate(rules)]
    return found.select(F.col("_id").alias(key), F.sort_array(F.flatten(F.array(*kept))).alias("spans"))


def _matched(n: int, rule: Rule) -> Column:
    """The matches in a text that passes the gate."""
    found = F.regexp_extract_all("_t", F.lit(rule.pattern), F.lit(0))
    return F.when(F.col("_any") & rule.gate(F.col("_t")), found).otherwise(F.array().cast("array<string>")).alias(f"_m{n}")


def _between(n: int, rule: Rule) -> Column:
    """Of the texts between the matches the lengths and both ends, if any match is valid."""
    pieces = F.transform(
        F.split("_t", rule.pattern, -1),
        lambda p: F.struct(F.length(p).cast("bigint").alias("n"), F.right(p, F.lit(BEFORE)).alias("end"), F.left(p, F.lit(AFTER)).alias("start")),
    )
    none = F.array().cast("array<struct<n bigint, end string, start string>>")
    return F.when(F.exists(f"_m{n}", rule.valid), pieces).otherwise(none).alias(f"_p{n}")


def _with_sides(n: int) -> Column:
    """A row per match: itself, what lies before and what after it."""
    many = F.greatest(F.size(f"_p{n}") - 1, F.lit(0))
    before, after = F.slice(f"_p{n}", F.lit(1), many), F.slice(f"_p{n}", F.lit(2), many)
    rows = F.arrays_zip(F.slice(f"_m{n}", F.lit(1), many).alias("text"), before.alias("before"), after.alias("after"))
    made = F.transform(rows, lambda r: F.struct(
        r["text"].alias("text"), F.length(r["text"]).cast("bigint").alias("length"), r["before"]["n"].alias("gap"),
        r["before"]["end"].alias("before"), r["after"]["start"].alias("after"),
    ))
    return made.alias(f"_r{n}")


def _blocks(n: int) -> Column:
    many = F.size(f"_r{n}")
    cut = F.transform(F.sequence(F.lit(0), F.floor((many - 1) / BLOCK).cast("int")), lambda b: F.slice(f"_r{n}", b * BLOCK + 1, F.lit(BLOCK)))
    return F.when(many > 0, cut).otherwise(F.slice(cut, F.lit(1), F.lit(0))).alias(f"_b{n}")


def _block_starts(n: int) -> Column:
    """Where each block of matches begins in the text."""
    lengths = F.transform(f"_b{n}", lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda sum, r: sum + r["gap"] + r["length"]))
    sums = F.aggregate(lengths, F.array(F.lit(0).cast("bigint")), lambda sums, more: F.concat(sums, F.array(F.element_at(sums, -1) + more)))
    return F.slice(sums, F.lit(1), F.size(f"_b{n}")).alias(f"_s{n}")


def _starts(n: int) -> Column:
    """Where each match begins: running sums within its block. A block's sums start with where the match before it ended."""

    def within(block: Column, start: Column) -> Column:
        ends = F.aggregate(block, F.array(start), lambda ends, r: F.concat(ends, F.array(F.element_at(ends, -1) + r["gap"] + r["length"])))
        return F.zip_with(F.slice(ends, F.lit(1), F.size(block)), block, lambda end, r: end + r["gap"])

    return F.flatten(F.zip_with(f"_b{n}", f"_s{n}", within)).alias(f"_at{n}")


def _judged(n: int, rule: Rule, threshold: float) -> Column:
    """The spans of one rule that hold."""
    near = lambda r: F.lower(F.concat(r["before"], F.lit(" "), r["after"]))

    def span(r: Column, start: Column) -> Column:
        score = (
            F.lit(rule.score)
            + F.when(near(r).rlike(rf"(?<![a-z])(?:{rule.words})"), SUPPORT).otherwise(0.0)
            + F.when(near(r).rlike(rf"(?<![a-z])(?:{OTHER_NUMBERS})(?![a-z])"), DOUBT).otherwise(0.0)
        )
        score = F.least(F.lit(1.0), F.greatest(score, F.lit(threshold)) if rule.certain else score)
        valid = rule.valid(r["text"])
        for side, pattern in (("before", rule.before), ("after", rule.after)):
            valid = valid & ~r[side].rlike(pattern) if pattern else valid
        return F.struct(
            start.alias("start"), F.lit(n).alias("rule"), (start + r["length"]).alias("end"), F.lit(rule.kind).alias("kind"),
            F.round(F.when(valid, score).otherwise(0.0), 2).alias("score"), r["text"].alias("text"),
        )

    return F.filter(F.zip_with(f"_r{n}", f"_at{n}", span), lambda s: s["score"] >= threshold)


def named(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, a digest of their spans, and all spans by name."""
    base = F.filter("spans", lambda s: s["rule"] < BASE)
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, r.kind))).cast("bigint").alias(f"n_{r.kind}") for r in RULES[:BASE]]
    return find(df, key=key, text=text).select(
        key, *counts, F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans")
    )
