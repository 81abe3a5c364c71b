"""Queries of the training-data operators and the SQL that gives the same rows."""

from __future__ import annotations

from softsearch.llm.chat_format import OP7_SQL, op7_chat_round_trip
from softsearch.llm.collocations import OP11_SQL, op11_phrase_collocation
from softsearch.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from softsearch.llm.importance import op6_importance_resampling
from softsearch.llm.license_scan import OP13_SQL, op13_license_scan
from softsearch.llm.metric_join import OP3_SQL, op3_metric_join
from softsearch.llm.minhash import OP8_SQL, op8_minhash
from softsearch.llm.packing import op9_cost_packing
from softsearch.llm.quality_rules import op1_quality_divergence
from softsearch.llm.secret_scan import op2_secret_ownership
from softsearch.llm.segment_sampling import op4_gumbel_segmentation
from softsearch.llm.sharding import op10_minimax_sharding
from softsearch.llm.toxicity import op5_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_divergence, op2_secret_ownership, op3_metric_join, op4_gumbel_segmentation, op5_toxicity,
        op6_importance_resampling, op7_chat_round_trip, op8_minhash, op9_cost_packing, op10_minimax_sharding,
        op11_phrase_collocation, op12_conversation_repair, op13_license_scan,
    )
}
ORACLES: dict[str, str] = {
    "op3_metric_join": OP3_SQL, "op7_chat_round_trip": OP7_SQL, "op8_minhash": OP8_SQL, "op11_phrase_collocation": OP11_SQL,
    "op12_conversation_repair": OP12_SQL, "op13_license_scan": OP13_SQL,
}
