"""The queries of this subpackage and their expected results in SQL."""

from tidemark.llm import collocations, decontaminate, filter_audit, fingerprint, language, mixing, near_copies, perplexity, quality, relative_parse, repeats, surrogates, url_filter

QUERIES = {
    "op1_url_filter": url_filter.query,
    "op2_decontaminate": decontaminate.query,
    "op3_surrogates": surrogates.query,
    "op4_language": language.query,
    "op5_repeats": repeats.query,
    "op6_quality": quality.query,
    "op7_fingerprint": fingerprint.query,
    "op8_perplexity": perplexity.query,
    "op9_mixing": mixing.query,
    "op10_near_copies": near_copies.query,
    "op11_filter_audit": filter_audit.query,
    "op12_collocations": collocations.query,
    "op13_relative_parse": relative_parse.query,
}

ORACLE = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_relative_parse": relative_parse.ORACLE,
}
