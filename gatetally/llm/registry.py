"""The queries of this subpackage and the SQL they are compared with."""

from gatetally.llm.bpe_counts import op10_token_counts
from gatetally.llm.byte_bpe import op12_byte_bpe
from gatetally.llm.count_rtree import op4_count_rtree
from gatetally.llm.decontaminate import OP7_SQL, op7_decontaminate
from gatetally.llm.language import op6_language
from gatetally.llm.prefix_free import op2_prefix_free
from gatetally.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from gatetally.llm.quality import op5_quality_rules
from gatetally.llm.sentencepiece_sa import op1_sentencepiece
from gatetally.llm.sharding import OP8_SQL, op8_sharding
from gatetally.llm.spelling import OP11_SQL, op11_spelling
from gatetally.llm.token_ids import op9_token_ids
from gatetally.llm.toxicity import op3_toxicity

QUERIES = {
    "op6_language": op6_language,
    "op7_decontaminate": op7_decontaminate,
    "op4_count_rtree": op4_count_rtree,
    "op2_prefix_free": op2_prefix_free,
    "op1_sentencepiece": op1_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op8_sharding": op8_sharding,
    "op9_token_ids": op9_token_ids,
    "op10_token_counts": op10_token_counts,
    "op11_spelling": op11_spelling,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL = {
    "op7_decontaminate": OP7_SQL,
    "op8_sharding": OP8_SQL,
    "op11_spelling": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
