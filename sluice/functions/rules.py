"""Ordered keyword rules, pricing signals and predicates; rules are data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import text_or_empty

# Markers of a company that works on artificial intelligence.
AI_MARKERS = ["artificial intelligence", "generative ai", "machine learning", " ai ", "ai/ml"]

# Role families, the first that matches holds.
ROLE_RULES = [
    ("Engineering", ["engineer", "developer", "swe", "software", "backend", "frontend", "full stack", "fullstack", "devops", "sre", "infrastructure", "platform"]),
    ("Data Science / ML", ["machine learning", "ml engineer", "data scientist", "data science", "research scientist", "ai engineer", "applied scientist", "mlops", "llm"]),
    ("Research", ["research", "scientist"]),
    ("Product", ["product manager", "product owner", "pm "]),
    ("Design", ["designer", "ux", "ui", "product design"]),
    ("Sales", ["sales", "account executive", "business development", "bdr", "sdr"]),
    ("Marketing", ["marketing", "growth", "content", "seo", "brand"]),
    ("Customer Support", ["support", "customer success", "customer experience"]),
    ("Operations", ["operations", "ops", "recruiter", "people ", "hr ", "finance", "legal", "people ops"]),
]

# Patterns of a free tier, a price and a sales contact, and of a negation before a free tier.
FREE = [r"\bfree plan\b", r"\bfree tier\b", r"\bstart(s)? free\b", r"\bfree forever\b", r"\b100% free\b", r"\balways free\b", r"\bfree to use\b"]
PAID = [r"\$\d+(\.\d{2})?\s*/\s*(mo|month|user|seat)", r"\$\d+(\.\d{2})?\s*per\s*(month|user|seat)", r"\busd?\s?\d+\s*/\s*(mo|month)"]
ENTERPRISE = [r"\bcontact sales\b", r"\btalk to sales\b", r"\bbook a demo\b", r"\bcustom pricing\b", r"\benterprise plan\b", r"\bcontact us for pricing\b", r"\brequest a quote\b"]
NEGATION = r"\b(no|not|without|n't have|never)\s+(?:\w+\s+)*\w*\s*$"
LOOK_BACK = 30


def has_any(haystack: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(haystack, F.lit(n)) for n in needles], F.lit(False))


def has_markers(parts: list[Column], markers: list[str] = AI_MARKERS) -> Column:
    """Whether a marker stands in the joined, padded, lower-case parts; arrays are joined by blanks."""
    return has_any(F.concat(F.lit(" "), F.lower(F.concat_ws(" ", *parts)), F.lit(" ")), markers)


def matches_keywords(c: Column, keywords: list[str]) -> Column:
    """Substring match in lower case; no keywords match everything."""
    return has_any(F.lower(text_or_empty(c)), [k.lower() for k in keywords]) if keywords else F.lit(True)


def first_rule(haystack: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The name of the first rule with a keyword in haystack."""
    if not rules:
        return F.lit(default)
    (name, words), *rest = rules
    out = F.when(has_any(haystack, words), F.lit(name))
    for name, words in rest:
        out = out.when(has_any(haystack, words), F.lit(name))
    return out.otherwise(F.lit(default))


def role_family(title: Column, extra: Column | None = None) -> Column:
    more = text_or_empty(extra) if extra is not None else F.lit("")
    return first_rule(F.concat(F.lit(" "), F.lower(text_or_empty(title)), F.lit(" "), F.lower(more), F.lit(" ")), ROLE_RULES, "Other")


def unnegated_match(c: Column, patterns: list[str] = FREE, negation: str = NEGATION, look_back: int = LOOK_BACK) -> Column:
    """Whether a pattern matches somewhere without a negation among the look_back characters before it."""
    pattern = "(?i)(?U)" + "|".join(f"(?:{p})" for p in patterns)
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    gaps = F.split(c, pattern, -1)
    zero = F.struct(F.lit("").alias("before"), F.lit(False).alias("hit"))

    def step(acc: Column, k: Column) -> Column:
        before = F.right(F.concat(acc["before"], F.get(gaps, k)), F.lit(look_back))
        clear = ~before.rlike("(?i)(?U)" + negation)
        return F.struct(F.concat(before, F.get(found, k)).alias("before"), (acc["hit"] | clear).alias("hit"))

    return F.when(F.size(found) == 0, F.lit(False)).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step, lambda a: a["hit"])
    )


def pricing_model(c: Column) -> Column:
    """FREE, FREEMIUM, PAID, ENTERPRISE or null."""
    text = F.lower(text_or_empty(c))
    free, paid, sales = unnegated_match(text), text.rlike("(?U)" + "|".join(PAID)), text.rlike("(?U)" + "|".join(ENTERPRISE))
    return F.when(free & (paid | sales), F.lit("FREEMIUM")).when(free, F.lit("FREE")).when(paid, F.lit("PAID")).when(sales, F.lit("ENTERPRISE"))


def is_evidence(address: Column, text: Column) -> Column:
    """Whether an address stands in a text as it is."""
    return F.coalesce((F.trim(address) != "") & F.contains(text, address), F.lit(False))


def valid_url(c: Column, most: int = 2083) -> Column:
    return F.coalesce((F.length(c) <= most) & c.rlike(r"^(?i:https?)://[^/\s?#:@]+(:\d+)?([/?#]\S*)?$"), F.lit(False))


def normal_url(c: Column) -> Column:
    """Scheme and host in lower case; a bare host gains a slash. Null where the address is not valid."""
    head = F.lower(F.regexp_extract(c, r"^(?i:https?)://[^/\s?#]+", 0))
    rest = F.substring(c, F.length(head) + 1, F.length(c))
    return F.when(valid_url(c), F.concat(head, F.when(F.startswith(rest, F.lit("/")), F.lit("")).otherwise(F.lit("/")), rest))


def status_class(status: Column) -> Column:
    """What a fetch's status asks for: ok, retry (429, 5xx and the codes of a time-out and a broken connection) or failed."""
    return F.when(status.between(200, 299), "ok").when((status == 429) | (status >= 500), "retry").otherwise("failed")
