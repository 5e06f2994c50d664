"""Queries of this subpackage and their DuckDB oracles (where SQL can express them)."""

from __future__ import annotations

from driftcheck.llm import ranked_search, warc
from driftcheck.llm.ann import op1_ann
from driftcheck.llm.conversation_repair import op13_conversation_repair
from driftcheck.llm.fingerprint import op8_fingerprints
from driftcheck.llm.jaccard_join import op7_jaccard_join
from driftcheck.llm.langid import op3_language_id
from driftcheck.llm.packing import op6_packing
from driftcheck.llm.quality import op4_quality
from driftcheck.llm.repeats import op5_repeats
from driftcheck.llm.sentencepiece_bpe import op10_sentencepiece
from driftcheck.llm.token_counts import op2_token_counts
from driftcheck.llm.url_filter import op9_url_filter


def queries() -> dict:
    found = (op1_ann, op2_token_counts, op3_language_id, op4_quality, op5_repeats, op6_packing, op7_jaccard_join, op8_fingerprints, op9_url_filter, op10_sentencepiece, warc.op11_warc, ranked_search.op12_ranked_search, op13_conversation_repair)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return warc.ORACLE | ranked_search.ORACLE
