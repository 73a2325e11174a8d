"""Queries of this subpackage."""

from . import bpe_chunks, chat_repair, exact_dedup, ngram_join, ogg_media, pii_crf, prefix_trie, quality_qda, secret_scan, source_mix, token_shards, token_transducer, toxicity_cf

QUERIES = {
    "op1_pii_crf": pii_crf.op1_pii_crf,
    "op2_ogg_media": ogg_media.op2_ogg_media,
    "op3_toxicity_cf": toxicity_cf.op3_toxicity_cf,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_ngram_join": ngram_join.op5_ngram_join,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_quality_qda": quality_qda.op7_quality_qda,
    "op8_source_mix": source_mix.op8_source_mix,
    "op9_token_shards": token_shards.op9_token_shards,
    "op10_bpe_chunks": bpe_chunks.op10_bpe_chunks,
    "op11_chat_repair": chat_repair.op11_chat_repair,
    "op12_token_transducer": token_transducer.op12_token_transducer,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
ORACLES = {
    "op6_exact_dedup": exact_dedup.SQL,
    "op8_source_mix": source_mix.SQL,
    "op11_chat_repair": chat_repair.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
}
