"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from sluice.llm.centroids import OP11_SQL, op11_centroids
from sluice.llm.chat import OP12_SQL, op12_chat
from sluice.llm.dedup import OP2_SQL, op2_exact_dedup
from sluice.llm.lm_score import op5_lm_score
from sluice.llm.mixing import OP7_SQL, op7_mix
from sluice.llm.ngram_join import op1_ngram_join
from sluice.llm.packing import op4_pack
from sluice.llm.quality import OP10_SQL, op10_host_quality
from sluice.llm.repeats import op8_repeats
from sluice.llm.resample import op13_resample
from sluice.llm.secrets import op9_secrets
from sluice.llm.sharding import op3_kd_shards
from sluice.llm.token_store import op6_token_store

QUERIES = {"op8_repeats": op8_repeats, "op1_ngram_join": op1_ngram_join, "op5_lm_score": op5_lm_score, "op9_secrets": op9_secrets, "op10_host_quality": op10_host_quality, "op3_kd_shards": op3_kd_shards, "op2_exact_dedup": op2_exact_dedup, "op7_mix": op7_mix, "op4_pack": op4_pack, "op6_token_store": op6_token_store, "op11_centroids": op11_centroids, "op12_chat": op12_chat, "op13_resample": op13_resample}
ORACLE_SQL: dict[str, str] = {"op10_host_quality": OP10_SQL, "op11_centroids": OP11_SQL, "op12_chat": OP12_SQL, "op2_exact_dedup": OP2_SQL, "op7_mix": OP7_SQL}
