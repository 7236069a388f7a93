"""Operators of a training-data pipeline; nothing else in the library imports it."""

from __future__ import annotations

from .centroid_clusters import OP11_SQL, op11_centroids
from .exact_search import OP5_SQL, op5_exact_search
from .fill_in_middle import OP12_SQL, op12_fill_in_middle
from .fingerprints import op1_fingerprints
from .language_codes import op13_language
from .mixing import op2_mix
from .near_duplicates import op6_near_duplicates
from .packing import op8_pack
from .personal_data import op3_personal_data
from .quality import op9_quality
from .token_counts import op10_section_tokens
from .token_shards import op4_token_shards
from .url_filter import op7_url_filter

_QUERIES = [
    op1_fingerprints,
    op2_mix,
    op3_personal_data,
    op4_token_shards,
    op5_exact_search,
    op6_near_duplicates,
    op7_url_filter,
    op8_pack,
    op9_quality,
    op10_section_tokens,
    op11_centroids,
    op12_fill_in_middle,
    op13_language,
]


def queries() -> dict:
    """Name to query; each takes the session and the folder of the tables."""
    return {run.__name__: run for run in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL twins of the queries that SQL can express."""
    return {
        "op5_exact_search": OP5_SQL,
        "op11_centroids": OP11_SQL,
        "op12_fill_in_middle": OP12_SQL,
    }
