"""The registered queries of the package and their SQL."""

from .chat import op1_chat_masks
from .collocations import op13_setm_phrases
from .forest import op4_prefix_forest
from .minhash import op5_hyperminhash
from .mixing import op7_systematic_mix
from .ngram_join import op12_token_group_join
from .oracles import ORACLES
from .packing import op6_vector_packing
from .pii import op9_surrogates
from .quality import op3_quality_bands
from .repair import op11_hirschberg_repair
from .secret_scan import op10_trigram_secrets
from .sharding import op2_extendible_shards
from .toxicity import op8_toxicity_crf

QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_masks, op2_extendible_shards, op3_quality_bands, op4_prefix_forest, op5_hyperminhash,
        op6_vector_packing,
        op7_systematic_mix, op8_toxicity_crf, op9_surrogates, op10_trigram_secrets,
        op11_hirschberg_repair, op12_token_group_join, op13_setm_phrases,
    )
}

__all__ = ["ORACLES", "QUERIES"]
