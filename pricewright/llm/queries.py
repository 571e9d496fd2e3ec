"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from .decontaminate import op3_decontaminate
from .divergence import op12_source_divergence
from .filter_audit import op13_filter_audit
from .oracles import ORACLES
from .outliers import op9_outliers
from .packing import op4_packing
from .pii import op2_pii
from .sharding import op7_sharding
from .simhash import op6_simhash
from .suffix_dedup import op1_suffix_dedup
from .token_counts import op11_token_counts
from .toxicity import op10_toxicity
from .warc import op8_warc
from .window_dedup import op5_window_dedup

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_pii": op2_pii,
    "op3_decontaminate": op3_decontaminate,
    "op4_packing": op4_packing,
    "op5_window_dedup": op5_window_dedup,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_warc": op8_warc,
    "op9_outliers": op9_outliers,
    "op10_toxicity": op10_toxicity,
    "op11_token_counts": op11_token_counts,
    "op12_source_divergence": op12_source_divergence,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["ORACLES", "QUERIES"]
