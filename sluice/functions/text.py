"""Text functions as Columns; the two that Spark has no expression for are Arrow UDFs."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Designators of a legal form that end a company's name.
LEGAL_SUFFIXES = [
    "incorporated", "inc", "llc", "l.l.c", "ltd", "limited", "corp", "corporation",
    "co", "company", "gmbh", "srl", "s.r.l", "plc", "pte", "pte ltd", "pty", "pty ltd",
    "sa", "s.a", "ag", "bv", "b.v", "nv", "n.v", "kk", "k.k", "lp", "l.p", "pbc", "a.s",
]


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    """White space of any script as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize_for_hash(c: Column) -> Column:
    return F.lower(collapse(text_or_empty(c)))


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the parts, each normalised by itself, joined by two bars."""
    return F.sha2(F.concat_ws("||", *[normalize_for_hash(p) for p in parts]), 256)


@F.pandas_udf(T.StringType())
def _without_marks(s: pd.Series) -> pd.Series:
    def one(x):
        if x is None or x.isascii():
            return x
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))

    return s.map(one)


#: What can be a reference that its semicolon ends.
_CLOSED = re.compile(r"&(?:#[0-9]+;|#[xX][0-9a-fA-F]+;|([^\s<&#;]{1,32};))?")


def bare_kept(page: str) -> str:
    """page with the ampersands that begin no reference closed by a semicolon as references themselves, so that they stay."""
    return _CLOSED.sub(lambda m: m[0] if m[0] != "&" and (m[1] is None or m[1] in html5) else "&amp;" + m[0][1:], page)


@F.pandas_udf(T.StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else html.unescape(x))


@F.pandas_udf(T.StringType())
def _unescaped_closed(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None else html.unescape(bare_kept(x)))


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks; the text of rows within ASCII does not leave the JVM."""
    return F.coalesce(_without_marks(F.when(F.octet_length(c) != F.length(c), c)), c)


def html_unescape(c: Column, bare: bool = True) -> Column:
    """Entities as characters; only the text of rows with an ampersand goes to Python. bare: those without a semicolon too, as HTML has some."""
    read = _unescaped if bare else _unescaped_closed
    return F.coalesce(read(F.when(F.contains(c, F.lit("&")), c)), c)


def normalize_name(c: Column, strip_suffix: bool = True, accents: bool = True) -> Column:
    """A company's name for comparison: no accents, lower case, no punctuation, no legal form at the end."""
    plain = F.lower(strip_accents(text_or_empty(c)) if accents else text_or_empty(c))
    plain = collapse(F.regexp_replace(plain, r"(?U)[^\w\s]", " "))
    if not strip_suffix:
        return plain
    # punctuation is gone by now, so a dotted form can't be met; a run of forms goes at once
    forms = "|".join(s.replace(" ", r"\s*") for s in LEGAL_SUFFIXES if "." not in s)
    return F.trim(F.regexp_replace(plain, rf"(?U)(?:\b(?:{forms})\s*)+$", ""))


def estimate_tokens(c: Column) -> Column:
    """A token for each four characters begun, one at least."""
    return F.greatest(F.lit(1), F.floor((F.length(text_or_empty(c)) + 3) / 4).cast("int"))


def split_paragraphs(c: Column, separator: str = "\n\n") -> Column:
    parts = F.transform(F.split(text_or_empty(c), separator, -1), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def tail_by_tokens(c: Column, tokens: int) -> Column:
    return F.right(c, F.lit(4 * tokens))


def truncate(c: Column, n: int) -> Column:
    return F.left(c, F.lit(n))


def path_tail_id(c: Column) -> Column:
    """The last part of a path without a version at its end."""
    tail = F.element_at(F.split(F.regexp_replace(c, "/+$", ""), "/", -1), -1)
    return F.regexp_replace(tail, r"v\d+$", "")


def title_parts(c: Column) -> Column:
    """(company, role) of "company: role". Without anything behind a colon the company is unknown; a blank role leaves the whole title as the role."""
    at = F.instr(c, ":")
    behind = F.when(at == 0, F.lit("")).otherwise(F.substring(c, at + 1, F.length(c)))
    return F.struct(
        F.when(behind == "", F.lit("Unknown")).otherwise(F.trim(F.substring_index(c, ":", 1))).alias("company"),
        F.when(F.trim(behind) == "", c).otherwise(F.trim(behind)).alias("role"),
    )


REPO_URL = r"https?://(?:www\.)?github\.com/[\w.-]+/[\w.-]+"


def repo_url(*texts: Column) -> Column:
    """The first repository address in the first text that has one, without trailing punctuation."""
    found = [F.nullif(F.regexp_extract(text_or_empty(t), REPO_URL, 0), F.lit("")) for t in texts]
    return F.rtrim(F.coalesce(*found), F.lit(").,;"))


def repo_slug(c: Column) -> Column:
    """owner/repo of a repository address; null where it is none."""
    part = lambda k: F.regexp_extract(c, r"github\.com/([^/\s]+)/([^/\s?#]+)", k)
    return F.when(part(1) != "", F.concat(part(1), F.lit("/"), F.regexp_replace(part(2), r"\.git$", "")))


def try_float(c: Column) -> Column:
    return F.expr("null").cast("double") if c is None else c.try_cast("double")


def token_sort(c: Column) -> Column:
    """The words of a text in order."""
    return F.array_join(F.array_sort(F.filter(F.split(c, r"\s+"), lambda x: x != "")), " ")


@F.pandas_udf(T.IntegerType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    def one(x, y):
        if x is None or y is None:
            return None
        places: dict[str, int] = {}
        for k, c in enumerate(x):
            places[c] = places.get(c, 0) | 1 << k
        full = (1 << len(x)) - 1
        row = full  # a zero for each letter of x at which the subsequence grows
        get = places.get
        for c in y:
            hit = row & get(c, 0)
            row = (row + hit | row - hit) & full
        return len(x) - row.bit_count()

    return pd.Series(map(one, a, b), dtype="Int32")


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence: a row of the usual table is one number with a bit a letter, so a step is a few machine words."""
    return _lcs(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names in percent, whatever the order of their words: 200 * LCS / (both lengths)."""
    x, y = token_sort(a), token_sort(b)
    total = F.length(x) + F.length(y)
    return F.when(x == y, F.lit(100.0)).when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs_length(x, y) / total)
