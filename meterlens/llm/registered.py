"""The registered queries of the text operators, and SQL for those that it can express."""

from meterlens.llm.byte_bpe import byte_bpe_query
from meterlens.llm.conversations import conversations_query
from meterlens.llm.exact_dedup import EXACT_DEDUP_SQL, exact_dedup_query
from meterlens.llm.fingerprints import fingerprints_query
from meterlens.llm.kd_shards import kd_shards_query
from meterlens.llm.ngram_join import NGRAM_JOIN_SQL, ngram_join_query
from meterlens.llm.packing import packing_query
from meterlens.llm.passages import PASSAGES_SQL, passages_query
from meterlens.llm.phrases import PHRASES_SQL, phrases_query
from meterlens.llm.secrets import secrets_query
from meterlens.llm.substring_dedup import substring_dedup_query
from meterlens.llm.token_counts import token_counts_query
from meterlens.llm.toxicity import toxicity_query

QUERIES = {
    "op1_fingerprints": fingerprints_query,
    "op2_exact_dedup": exact_dedup_query,
    "op3_toxicity": toxicity_query,
    "op4_ngram_join": ngram_join_query,
    "op5_packing": packing_query,
    "op6_substring_dedup": substring_dedup_query,
    "op7_secrets": secrets_query,
    "op8_token_counts": token_counts_query,
    "op9_kd_shards": kd_shards_query,
    "op10_byte_bpe": byte_bpe_query,
    "op11_passages": passages_query,
    "op12_conversations": conversations_query,
    "op13_phrases": phrases_query,
}

ORACLES = {
    "op2_exact_dedup": EXACT_DEDUP_SQL,
    "op4_ngram_join": NGRAM_JOIN_SQL,
    "op11_passages": PASSAGES_SQL,
    "op13_phrases": PHRASES_SQL,
}
