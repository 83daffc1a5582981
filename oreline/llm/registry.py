"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .collocations import OP12_SQL, op12_collocations
from .common import ship
from .decontaminate import op9_decontamination
from .exact import OP10_SQL, op10_exact_dedup
from .fertility import op11_quality_rules
from .hardneg import OP13_SQL, op13_hard_negatives
from .licenses import op1_license_scans
from .lines import op5_line_dedup
from .mixing import op2_mixing
from .near import op6_minhash_near_dedup
from .ngrams import OP3_SQL, OP3_TRIGRAMS_SQL, op3_lm_scoring, op3_lm_scoring_trigrams
from .repeats import op8_substring_dedup
from .toxicity import op4_toxicity
from .urls import OP7_SQL, op7_url_filters



def _shipped(query):
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_mixing": op2_mixing,
    "op3_lm_scoring": op3_lm_scoring,
    "op3_lm_scoring_trigrams": op3_lm_scoring_trigrams,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_url_filters": op7_url_filters,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}

ORACLE = {
    "op3_lm_scoring": OP3_SQL,
    "op3_lm_scoring_trigrams": OP3_TRIGRAMS_SQL,
    "op7_url_filters": OP7_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_collocations": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
