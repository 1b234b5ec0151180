"""The registered corpus queries and their DuckDB SQL, where SQL can say it."""

from __future__ import annotations

from caprank.llm import curriculum, merkle
from caprank.llm.bpe import op1_bpe
from caprank.llm.curriculum import op9_curriculum_mix
from caprank.llm.jaccard import op3_jaccard_join
from caprank.llm.language import op4_language_id
from caprank.llm.licenses import op7_license_scan
from caprank.llm.merkle import op11_merkle_manifest
from caprank.llm.neighbours import op10_nearest
from caprank.llm.periodic import op13_periodic_runs
from caprank.llm.quality import op8_quality_rules
from caprank.llm.repeats import op2_suffix_dedup
from caprank.llm.scoring import op5_backoff_score
from caprank.llm.slots import op12_virtual_slots
from caprank.llm.token_files import op6_token_files

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_backoff_score": op5_backoff_score,
    "op6_token_files": op6_token_files,
    "op7_license_scan": op7_license_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_curriculum_mix": op9_curriculum_mix,
    "op10_nearest": op10_nearest,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_virtual_slots": op12_virtual_slots,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op9_curriculum_mix": curriculum.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
}
