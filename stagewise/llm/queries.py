"""The queries of this subpackage and their SQL."""

from stagewise.llm import (
    op1_toxicity, op2_substring_dedup, op3_url_filter, op4_warc, op5_jaccard_join, op6_decontamination, op7_html_extraction,
    op8_lattice_dedup, op9_sentencepiece, op10_sharding, op11_quality_divergence, op12_bisector_clusters, op13_norm_of_sum_codes,
)

_MODULES = (
    op1_toxicity, op2_substring_dedup, op3_url_filter, op4_warc, op5_jaccard_join, op6_decontamination, op7_html_extraction,
    op8_lattice_dedup, op9_sentencepiece, op10_sharding, op11_quality_divergence, op12_bisector_clusters, op13_norm_of_sum_codes,
)
#: Query and SQL (None where SQL can't express it) by name.
QUERIES = {
    name: (getattr(module, name), getattr(module, "SQL", None))
    for module in _MODULES for name in [module.__name__.rpartition(".")[2]]
}
