"""Texts that people and other systems read: made inert, redacted, parsed back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What is taken out of anything written, and what is put there.
SECRETS = [
    (r"sk-ant-[A-Za-z0-9_-]{8,}", "sk-ant-[REDACTED]"),
    (r"(?i)([?&](?:api_key|apikey|key|token|usertoken)=)[^&\s\"']+", "$1[REDACTED]"),
    (r"(?i)(x-api-key|authorization|usertoken)([\"']?\s*[:=]\s*[\"']?)[^\"'\s,}]+", "$1$2[REDACTED]"),
]
_TICK = r"(?m)^- \[[xX]\] (approve|reject) `([0-9a-f]{16})`[ \t\r]*$"


def redact(text: Column, known: dict[str, str] | None = None) -> Column:
    """Without key-like texts, nor the known secrets (name to value) of eight characters or more."""
    for pattern, put in SECRETS:
        text = F.regexp_replace(text, pattern, put)
    for name, value in (known or {}).items():
        if len(value) >= 8:
            text = F.replace(text, F.lit(value), F.lit(f"[{name}]"))
    return text


def inert(text: Column, most: int = 300) -> Column:
    """One plain line: no line breaks, markup, code marks or check boxes, cut to `most` characters."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\r\\n\u0085  \\t\\x0b\\f]+", " ")
    s = F.regexp_replace(F.translate(s, "<>`", "‹›'"), r"\[( |x|X)\]", "($1)")
    s = F.trim(F.regexp_replace(s, r"(?U)\s+", " "))
    return F.when(F.length(s) > most, F.concat(F.substr(s, F.lit(1), F.lit(most - 1)), F.lit("…"))).otherwise(s)


def ticks(body: Column) -> Column:
    """Ticked decisions in an issue body: array of (id, decision) in order of id; if both are ticked, reject."""
    lines = F.regexp_extract_all(body, F.lit(_TICK), F.lit(0))
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, _TICK, 2).alias("id"), F.regexp_extract(x, _TICK, 1).alias("decision")))
    ids = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["id"])))
    rejected = lambda i: F.exists(pairs, lambda p: (p["id"] == i) & (p["decision"] == "reject"))
    return F.transform(ids, lambda i: F.struct(i.alias("id"), F.when(rejected(i), "reject").otherwise("approve").alias("decision")))
