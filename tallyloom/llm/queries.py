"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from . import decontam, infill, ngramjoin, ranked
from .decontam import op6_benchmark_decontamination
from .editprint import op3_edit_fingerprints
from .infill import op13_fill_in_middle
from .katz import op2_katz_backoff
from .langid import op1_language_id
from .licenses import op5_license_scan
from .ngramjoin import op8_ngram_jaccard
from .packing import op4_harmonic_packing
from .pii import op7_pseudonyms
from .quality import op12_quality_trees
from .ranked import op11_ranked_search
from .secrets import op9_secret_ownership
from .urls import op10_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_katz_backoff,
        op3_edit_fingerprints,
        op4_harmonic_packing,
        op5_license_scan,
        op6_benchmark_decontamination,
        op7_pseudonyms,
        op8_ngram_jaccard,
        op9_secret_ownership,
        op10_url_filter,
        op11_ranked_search,
        op12_quality_trees,
        op13_fill_in_middle,
    )
}
ORACLES = {
    "op6_benchmark_decontamination": decontam.ORACLE,
    "op8_ngram_jaccard": ngramjoin.ORACLE,
    "op11_ranked_search": ranked.ORACLE,
    "op13_fill_in_middle": infill.ORACLE,
}
