"""JSON objects out of replies that wrap them in prose or fences."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def salvage(text: str | None) -> str | None:
    """Canonical text of the object in a reply: the whole, else a fenced part, else the first balanced braces; else null."""
    if text is None:
        return None
    text = text.strip()
    candidates = [text]
    if "```" in text:
        for part in map(str.strip, text.split("```")):
            candidates.append(part[4:].strip() if part.startswith("json") else part)
    for c in candidates:
        try:
            return _shown(json.loads(c))
        except ValueError:
            continue
    start, depth = text.find("{"), 0
    for i in range(start, len(text)) if start >= 0 else ():
        depth += (text[i] == "{") - (text[i] == "}")
        if depth == 0:
            try:
                return _shown(json.loads(text[start : i + 1]))
            except ValueError:
                return None
    return None


def _shown(value) -> str | None:
    """Only an object is an answer."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if isinstance(value, dict) else None


@F.pandas_udf(T.StringType())
def _salvaged(s: pd.Series) -> pd.Series:
    return s.map(salvage)


def json_salvage(c: Column) -> Column:
    return _salvaged(c)
