"""The registered queries of this subpackage and their SQL."""
from tickloom.llm import (capfilters, contamination, language, lexical, outliers, periodicity, personal, sharding, simhash,
                          tokenfile, tokens, toxicity, warc)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_personal_data": personal.op2_personal_data,
    "op3_warc": warc.op3_warc,
    "op4_tokens": tokens.op4_tokens,
    "op5_token_files": tokenfile.op5_token_files,
    "op6_quality": outliers.op6_quality,
    "op7_sharding": sharding.op7_sharding,
    "op8_language_id": language.op8_language_id,
    "op9_decontamination": contamination.op9_decontamination,
    "op10_simhash": simhash.op10_simhash,
    "op11_periodic_runs": periodicity.op11_periodic_runs,
    "op12_embedding_duplicates": capfilters.op12_embedding_duplicates,
    "op13_lexical_search": lexical.op13_lexical_search,
}
ORACLES = {
    "op3_warc": warc.OP3_SQL,
    "op9_decontamination": contamination.OP9_SQL,
    "op12_embedding_duplicates": capfilters.OP12_SQL,
    "op13_lexical_search": lexical.OP13_SQL,
}
