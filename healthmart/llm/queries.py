"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from healthmart.llm.bag_minhash import op5_bag_minhash
from healthmart.llm.bloom_dedup import OP9_SQL, op9_bloom_exact_dedup
from healthmart.llm.byte_cnn import op7_byte_cnn_language
from healthmart.llm.class_lm import op3_class_lm
from healthmart.llm.decontaminate import OP12_SQL, op12_prefix_decontaminate
from healthmart.llm.line_chunks import OP4_SQL, op4_line_chunk_dedup
from healthmart.llm.max_plus import op6_max_plus_pieces
from healthmart.llm.packing import op1_best_fit_pack
from healthmart.llm.pivot_index import OP2_SQL, op2_pivot_top_k
from healthmart.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from healthmart.llm.pu_quality import op8_pu_quality
from healthmart.llm.suffix_dedup import op10_suffix_array_dedup
from healthmart.llm.token_align import op13_merge_path_align

QUERIES = {f.__name__: f for f in (op1_best_fit_pack, op2_pivot_top_k, op3_class_lm, op4_line_chunk_dedup, op5_bag_minhash, op6_max_plus_pieces,
                                     op7_byte_cnn_language, op8_pu_quality,
                                     op9_bloom_exact_dedup, op10_suffix_array_dedup,
                                     op11_prefix_trie, op12_prefix_decontaminate, op13_merge_path_align)}

ORACLE = {"op2_pivot_top_k": OP2_SQL, "op4_line_chunk_dedup": OP4_SQL, "op9_bloom_exact_dedup": OP9_SQL,
          "op11_prefix_trie": OP11_SQL, "op12_prefix_decontaminate": OP12_SQL}
