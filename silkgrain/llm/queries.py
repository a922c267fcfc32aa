"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from silkgrain.llm import fill_middle, filter_audit, mixing, warc
from silkgrain.llm.fill_middle import op11_fill_in_middle
from silkgrain.llm.filter_audit import op13_filter_audit
from silkgrain.llm.hash_ring import op12_hash_ring_shards
from silkgrain.llm.mixing import op9_entropy_mixing
from silkgrain.llm.ppm import op7_ppm_scores
from silkgrain.llm.pu_quality import op3_pu_quality
from silkgrain.llm.secret_scan import op4_char_cnn_secrets
from silkgrain.llm.simhash import op6_simhash_components
from silkgrain.llm.suffix_dedup import op2_suffix_dedup
from silkgrain.llm.templates import op8_template_decontamination
from silkgrain.llm.text_density import op10_text_density
from silkgrain.llm.warc import op1_warc_transactions
from silkgrain.llm.weak_rules import op5_weak_quality_rules

QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_transactions, op2_suffix_dedup, op3_pu_quality, op4_char_cnn_secrets, op5_weak_quality_rules,
        op6_simhash_components, op7_ppm_scores, op8_template_decontamination, op9_entropy_mixing, op10_text_density,
        op11_fill_in_middle, op12_hash_ring_shards, op13_filter_audit,
    )
}
SQL = {"op1_warc_transactions": warc.SQL, "op9_entropy_mixing": mixing.SQL, "op11_fill_in_middle": fill_middle.SQL, "op13_filter_audit": filter_audit.SQL}
