"""The operators as registered queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

from flightlake.llm.brown_lm import op10_brown_lm_scoring
from flightlake.llm.centroids import OP13_SQL, op13_centroid_clustering
from flightlake.llm.chat import OP11_SQL, op11_chat_formatting
from flightlake.llm.decontam import OP9_SQL, op9_benchmark_decontamination
from flightlake.llm.fim import OP12_SQL, op12_fill_in_middle
from flightlake.llm.html_tree import op5_html_extraction
from flightlake.llm.langid import op2_language_id
from flightlake.llm.license_scan import OP1_SQL, op1_license_scans
from flightlake.llm.packing import op6_best_fit_packing
from flightlake.llm.pii import op8_pii_surrogates
from flightlake.llm.quality import OP7_SQL, op7_quality_rules
from flightlake.llm.secret_scan import op3_secret_scans
from flightlake.llm.simhash import op4_simhash_near_dedup

QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_language_id": op2_language_id,
    "op3_secret_scans": op3_secret_scans,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_brown_lm_scoring": op10_brown_lm_scoring,
    "op11_chat_formatting": op11_chat_formatting,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_centroid_clustering": op13_centroid_clustering,
}

SQL = {
    "op1_license_scans": OP1_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op7_quality_rules": OP7_SQL,
    "op11_chat_formatting": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_centroid_clustering": OP13_SQL,
}
