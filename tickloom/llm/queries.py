"""The queries of this subpackage, and the SQL of those that SQL can express."""

from tickloom.llm.byte_bpe import op7_byte_bpe
from tickloom.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from tickloom.llm.jaccard_join import op9_jaccard_join
from tickloom.llm.language_id import op6_language_id
from tickloom.llm.license_scan import op3_license_scan
from tickloom.llm.line_cleaning import op2_line_cleaning
from tickloom.llm.mixing import OP4_SQL, op4_mixing
from tickloom.llm.periodic_runs import op12_periodic_runs
from tickloom.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from tickloom.llm.quality_rules import op8_quality_rules
from tickloom.llm.simhash_anchors import op11_simhash_anchors
from tickloom.llm.token_counts import op5_token_counts
from tickloom.llm.token_shards import op1_token_shards

LLM_QUERIES = {
    f.__name__: f
    for f in (
        op1_token_shards,
        op2_line_cleaning,
        op3_license_scan,
        op4_mixing,
        op5_token_counts,
        op6_language_id,
        op7_byte_bpe,
        op8_quality_rules,
        op9_jaccard_join,
        op10_exact_dedup,
        op11_simhash_anchors,
        op12_periodic_runs,
        op13_prefix_trie,
    )
}
LLM_ORACLES = {"op4_mixing": OP4_SQL, "op10_exact_dedup": OP10_SQL, "op13_prefix_trie": OP13_SQL}
