"""The text operators' queries, one for each operator, and their SQL where SQL can express them."""

from . import decontamination, licenses, lines, lm, mixing, ngram_join, pii, quality, sharding, urls

QUERIES = {
    "op1_licenses": licenses.op1_licenses,
    "op2_pii": pii.op2_pii,
    "op3_sharding": sharding.op3_sharding,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_url_filter": urls.op7_url_filter,
    "op8_quality": quality.op8_quality,
    "op9_lm_score": lm.op9_lm_score,
    "op10_ngram_join": ngram_join.op10_ngram_join,
}
SQL = {
    "op5_mixing": mixing.OP5_SQL,
    "op6_decontamination": decontamination.OP6_SQL,
    "op7_url_filter": urls.OP7_SQL,
    "op8_quality": quality.OP8_SQL,
    "op10_ngram_join": ngram_join.OP10_SQL,
}
