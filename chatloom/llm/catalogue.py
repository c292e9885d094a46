"""The queries of this folder by name."""

from __future__ import annotations

import importlib

MODULES = [
    "chatloom.llm.item_pairs",
    "chatloom.llm.leaks",
    "chatloom.llm.near_copies",
    "chatloom.llm.one_form",
    "chatloom.llm.reading_level",
    "chatloom.llm.term_bitmaps",
    "chatloom.llm.tokenize_corpus",
    "chatloom.llm.top_n",
]


def _merged(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(name), attribute)
    return out


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
