"""Queries of the numbered operators, by name, and their SQL where SQL can express them."""

from ordertide.llm import alignment, fingerprint, jaccard, licenses, mixing, phrases, pieces, secrets, substrings, suffixes, topk, toxicity, wrappers

QUERIES = {
    "op1_jaccard": jaccard.op1_jaccard,
    "op2_suffixes": suffixes.op2_suffixes,
    "op3_licenses": licenses.op3_licenses,
    "op4_substrings": substrings.op4_substrings,
    "op5_secrets": secrets.op5_secrets,
    "op6_topk": topk.op6_topk,
    "op7_mixing": mixing.op7_mixing,
    "op8_pieces": pieces.op8_pieces,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_fingerprints": fingerprint.op10_fingerprints,
    "op11_wrappers": wrappers.op11_wrappers,
    "op12_alignment": alignment.op12_alignment,
    "op13_phrases": phrases.op13_phrases,
}
ORACLE_SQL = {
    "op3_licenses": licenses.ORACLE,
    "op6_topk": topk.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op13_phrases": phrases.ORACLE,
}
