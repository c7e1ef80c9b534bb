"""Queries and SQL of all operators in this subpackage."""

from __future__ import annotations

from . import decontamination, fingerprints, line_dedup, lm_scoring, near_dups, packing, secret_scan, token_counts, toxicity, url_filter

_MODULES = (token_counts, near_dups, packing, fingerprints, decontamination, secret_scan, line_dedup, toxicity, lm_scoring, url_filter)
QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
SQL = {name: q for m in _MODULES for name, q in m.SQL.items()}
