"""Registered queries of the training-data operators, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.bpe import op9_bpe
from quarry.llm.chat_format import OP1_SQL, op1_chat_format
from quarry.llm.collocations import OP13_SQL, op13_collocations
from quarry.llm.embedding_dedup import op3_embedding_dedup
from quarry.llm.exact_dedup import OP8_SQL, op8_exact_dedup
from quarry.llm.lexical_search import OP12_SQL, op12_lexical_search
from quarry.llm.line_dedup import op5_line_dedup, op5_line_members
from quarry.llm.minhash_dedup import op4_minhash_dedup
from quarry.llm.mixing import op10_mix_sources
from quarry.llm.passages import op7_repeated_passages
from quarry.llm.sharding import OP11_SQL, op11_shards
from quarry.llm.token_counts import op2_token_counts
from quarry.llm.toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_counts": op2_token_counts,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op5_line_members": op5_line_members,
    "op6_toxicity": op6_toxicity,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_mix_sources": op10_mix_sources,
    "op11_shards": op11_shards,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_shards": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
