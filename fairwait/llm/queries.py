"""The registered queries of this package, and SQL for those that SQL can state."""

from fairwait.llm.bpe import op3_byte_bpe
from fairwait.llm.collocations import OP13_SQL, op13_collocations
from fairwait.llm.extraction import op7_extract_main_text
from fairwait.llm.jaccard import OP5_SQL, op5_jaccard_join
from fairwait.llm.line_runs import OP6_SQL, op6_line_runs
from fairwait.llm.mixing import OP4_SQL, op4_mix_sources
from fairwait.llm.near_vectors import OP1_SQL, op1_near_vectors
from fairwait.llm.pii import op9_find_personal_data
from fairwait.llm.quality import op10_quality_rules
from fairwait.llm.repeated_windows import OP11_SQL, op11_repeated_windows
from fairwait.llm.resampling import op12_importance_resampling
from fairwait.llm.secrets import op8_scan_secrets
from fairwait.llm.token_files import op2_token_files

REGISTRY = {
    "op1_near_vectors": op1_near_vectors,
    "op2_token_files": op2_token_files,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mix_sources": op4_mix_sources,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_line_runs": op6_line_runs,
    "op7_extract_main_text": op7_extract_main_text,
    "op8_scan_secrets": op8_scan_secrets,
    "op9_find_personal_data": op9_find_personal_data,
    "op10_quality_rules": op10_quality_rules,
    "op11_repeated_windows": op11_repeated_windows,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op1_near_vectors": OP1_SQL,
    "op4_mix_sources": OP4_SQL,
    "op5_jaccard_join": OP5_SQL,
    "op6_line_runs": OP6_SQL,
    "op11_repeated_windows": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
