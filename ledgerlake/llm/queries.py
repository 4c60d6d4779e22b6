"""The registered queries of the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from .decontaminate import op8_decontaminate
from .exact_dedup import OP7_SQL, op7_exact_dedup
from .filter_audit import OP11_SQL, op11_filter_audit
from .licenses import OP4_SQL, op4_license_scan
from .merkle import OP12_SQL, op12_merkle_manifest
from .mixing import op1_mix_sources
from .near_dup import op3_ngram_join
from .quality import op5_quality
from .simhash import op13_simhash
from .suffix_dedup import op10_suffix_dedup
from .token_counts import op2_token_counts
from .token_output import op9_token_output
from .toxicity import op6_toxicity

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_join": op3_ngram_join,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_output": op9_token_output,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash": op13_simhash,
}

ORACLE_SQL = {
    "op4_license_scan": OP4_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
