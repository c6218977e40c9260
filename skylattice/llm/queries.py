"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .fingerprints import op5_fingerprints
from .licenses import op6_license_scan
from .lines import OP12_SQL, op12_line_dedup
from .mixing import op8_mix_sources
from .ngram_join import op4_ngram_join
from .packing import op10_pack
from .phrases import OP11_SQL, op11_phrases
from .quality_model import op9_quality_model
from .quality_rules import op1_quality_rules
from .ranked_search import OP13_SQL, op13_ranked_search
from .repeats import op2_suffix_dedup
from .token_counts import op3_token_counts
from .toxicity import op7_toxicity

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_join": op4_ngram_join,
    "op5_fingerprints": op5_fingerprints,
    "op6_license_scan": op6_license_scan,
    "op7_toxicity": op7_toxicity,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality_model": op9_quality_model,
    "op10_pack": op10_pack,
    "op11_phrases": op11_phrases,
    "op12_line_dedup": op12_line_dedup,
    "op13_ranked_search": op13_ranked_search,
}

SQL: dict[str, str] = {"op11_phrases": OP11_SQL, "op12_line_dedup": OP12_SQL, "op13_ranked_search": OP13_SQL}
