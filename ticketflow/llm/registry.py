"""Queries of this subpackage and their SQL, for ``__spark_entry__.py``."""

from __future__ import annotations

from . import (chat, decontaminate, fim, html_text, langid, mixing, ngram_lm, quality_lm, quality_rules, secrets,
               simhash, substring_dedup, token_alignment)

_MODULES = (quality_lm, simhash, secrets, html_text, langid, ngram_lm, quality_rules, decontaminate, chat, mixing,
            substring_dedup, fim, token_alignment)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in getattr(m, "ORACLE_SQL", {}).items()}
