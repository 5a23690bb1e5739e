"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from functools import wraps

from . import byte_bpe, lexical, lm_score, mixing, ngram_join, nn_descent, prefix_trie, quality, suffix_dedup, token_files, topk, url_filter, warc
from .common import ship


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    ngram_join.op1_ngram_join,
    topk.op2_topk,
    lm_score.op3_lm_score,
    suffix_dedup.op4_suffix_dedup,
    quality.op5_quality,
    token_files.op6_token_files,
    nn_descent.op7_nn_descent,
    warc.op8_warc,
    byte_bpe.op9_byte_bpe,
    mixing.op10_mixing,
    url_filter.op11_url_filter,
    prefix_trie.op12_prefix_trie,
    lexical.op13_lexical,
)}

ORACLES = {
    "op1_ngram_join": ngram_join.OP1_SQL,
    "op2_topk": topk.OP2_SQL,
    "op8_warc": warc.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_url_filter": url_filter.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_lexical": lexical.OP13_SQL,
}
