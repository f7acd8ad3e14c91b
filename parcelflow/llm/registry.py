"""Registered queries of this package and their DuckDB SQL."""

from parcelflow.llm.bpe import op2_bpe
from parcelflow.llm.collocations import OP11_SQL, op11_collocations
from parcelflow.llm.conversations import op13_conversation_repair
from parcelflow.llm.jaccard_join import OP5_SQL, op5_ngram_jaccard_join
from parcelflow.llm.language_id import op6_language_mixture
from parcelflow.llm.line_dedup import OP1_SQL, op1_line_dedup
from parcelflow.llm.mixing import OP9_SQL, op9_mixing
from parcelflow.llm.pii import op3_pii
from parcelflow.llm.secrets import OP8_SQL, op8_secret_scan
from parcelflow.llm.topk_search import OP4_SQL, op4_exact_topk
from parcelflow.llm.toxicity import op10_toxicity
from parcelflow.llm.url_rules import op12_url_rules
from parcelflow.llm.vector_dedup import OP7_SQL, op7_embedding_near_dedup

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_bpe": op2_bpe,
    "op3_pii": op3_pii,
    "op4_exact_topk": op4_exact_topk,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_language_mixture": op6_language_mixture,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_mixing": op9_mixing,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_url_rules": op12_url_rules,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op1_line_dedup": OP1_SQL,
    "op4_exact_topk": OP4_SQL,
    "op5_ngram_jaccard_join": OP5_SQL,
    "op7_embedding_near_dedup": OP7_SQL,
    "op8_secret_scan": OP8_SQL,
    "op9_mixing": OP9_SQL,
    "op11_collocations": OP11_SQL,
}
