"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from docloom.llm.audio import op7_audio_features
from docloom.llm.bpe import op3_bpe_encoding
from docloom.llm.classifier import op1_rule_ensemble
from docloom.llm.importance import OP12_SQL, op12_importance_resampling
from docloom.llm.jaccard import OP4_SQL, op4_jaccard_join
from docloom.llm.licenses import OP9_SQL, op9_license_scans
from docloom.llm.packing import op6_packing
from docloom.llm.periods import op13_periodic_runs
from docloom.llm.rules import op2_adaptive_rules
from docloom.llm.secret_scans import OP11_SQL, op11_secret_scans
from docloom.llm.sharding import op5_ring_sharding
from docloom.llm.substrings import OP8_SQL, op8_substring_dedup
from docloom.llm.token_counts import op10_token_counts

QUERIES = {f.__name__: f for f in (op1_rule_ensemble, op2_adaptive_rules, op3_bpe_encoding, op4_jaccard_join, op5_ring_sharding, op6_packing, op7_audio_features, op8_substring_dedup, op9_license_scans, op10_token_counts, op11_secret_scans, op12_importance_resampling, op13_periodic_runs)}
ORACLE: dict[str, str] = {"op4_jaccard_join": OP4_SQL, "op8_substring_dedup": OP8_SQL, "op9_license_scans": OP9_SQL, "op11_secret_scans": OP11_SQL, "op12_importance_resampling": OP12_SQL}
