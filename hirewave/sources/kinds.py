"""Kinds of raw tables, told by their columns."""

from __future__ import annotations

from hirewave.functions import rules

POSTINGS, COMPANIES, OTHER = "postings", "companies", "other"
#: columns that only a table of companies has all of
COMPANY_KEYS = ["company_name", "company_industry"]


def kind_of(columns: list[str]) -> str:
    """postings (every dedup key is there), companies, or other; letter case does not matter."""
    have = {c.lower() for c in columns}
    if {k.lower() for k in rules.DEDUP_KEYS} <= have:
        return POSTINGS
    return COMPANIES if set(COMPANY_KEYS) <= have else OTHER
