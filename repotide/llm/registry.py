"""The subpackage's queries and, where SQL can express them, the SQL they are checked against."""

from repotide.llm.decontamination import op4_benchmark_decontamination
from repotide.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from repotide.llm.importance import OP11_SQL, op11_importance_resampling
from repotide.llm.line_dedup import OP3_SQL, op3_line_dedup
from repotide.llm.main_text import op12_html_main_text
from repotide.llm.packing import op5_best_fit_packing
from repotide.llm.pii import op10_pii
from repotide.llm.quality_gam import op1_quality_classifier
from repotide.llm.quality_rules import op9_quality_rules
from repotide.llm.sharding import op7_sharding
from repotide.llm.simhash import op6_simhash_near_dedup
from repotide.llm.suffix_dedup import op2_suffix_array_dedup
from repotide.llm.url_filters import op8_url_filters

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_url_filters": op8_url_filters,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii": op10_pii,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_html_main_text": op12_html_main_text,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
