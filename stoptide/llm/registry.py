"""The operators' queries: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from stoptide.llm.decontaminate import op8_decontaminate
from stoptide.llm.langid import op3_langid
from stoptide.llm.licenses import op5_licenses
from stoptide.llm.lm_score import op7_lm_score
from stoptide.llm.neighbours import OP11_SQL, op11_neighbours
from stoptide.llm.ngram_join import op2_ngram_join
from stoptide.llm.periodic import op12_periodic_runs
from stoptide.llm.quality import op9_quality
from stoptide.llm.sampling import op10_sampling
from stoptide.llm.secrets import op6_secrets
from stoptide.llm.spelling import op13_spelling
from stoptide.llm.token_files import op1_token_files
from stoptide.llm.urls import op4_urls

QUERIES = {
    "op1_token_files": (op1_token_files, None),
    "op2_ngram_join": (op2_ngram_join, None),
    "op3_langid": (op3_langid, None),
    "op4_urls": (op4_urls, None),
    "op5_licenses": (op5_licenses, None),
    "op6_secrets": (op6_secrets, None),
    "op7_lm_score": (op7_lm_score, None),
    "op8_decontaminate": (op8_decontaminate, None),
    "op9_quality": (op9_quality, None),
    "op10_sampling": (op10_sampling, None),
    "op11_neighbours": (op11_neighbours, OP11_SQL),
    "op12_periodic_runs": (op12_periodic_runs, None),
    "op13_spelling": (op13_spelling, None),
}
