"""Queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from .decontamination import OP7_SQL, op7_decontamination
from .fingerprints import op6_fingerprints
from .html_extraction import op8_html_extraction
from .jaccard_join import op9_jaccard_join
from .licenses import OP10_SQL, op10_license_scan
from .packing import op1_packing
from .suffix_dedup import op2_suffix_dedup
from .token_counts import op5_token_counts
from .toxicity import op3_toxicity
from .url_filters import OP4_SQL, op4_url_filters

QUERIES = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_url_filters": op4_url_filters,
    "op5_token_counts": op5_token_counts,
    "op6_fingerprints": op6_fingerprints,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_license_scan": op10_license_scan,
}
ORACLES: dict[str, str] = {
    "op4_url_filters": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op10_license_scan": OP10_SQL,
}
