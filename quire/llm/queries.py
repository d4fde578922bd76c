"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from quire.llm.chat import OP8_SQL, op8_chat_format
from quire.llm.compress import op9_language_model_scores
from quire.llm.decontaminate import op1_benchmark_decontamination
from quire.llm.licenses import op6_license_scan
from quire.llm.main_text import op2_main_text
from quire.llm.mixture import OP4_SQL, op4_source_mixture
from quire.llm.ngram_join import op10_ngram_jaccard_join
from quire.llm.pii import op3_personal_data
from quire.llm.quality import op5_quality_classifier
from quire.llm.sketch import op7_document_fingerprints

QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_main_text,
        op3_personal_data,
        op4_source_mixture,
        op5_quality_classifier,
        op6_license_scan,
        op7_document_fingerprints,
        op8_chat_format,
        op9_language_model_scores,
        op10_ngram_jaccard_join,
    )
}
SQL = {"op4_source_mixture": OP4_SQL, "op8_chat_format": OP8_SQL}
