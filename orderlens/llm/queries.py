"""Queries of the training-data operators, and the DuckDB text of those that
SQL can express."""

from __future__ import annotations

from orderlens.llm.jaccard import OP2_SQL, op2_jaccard
from orderlens.llm.lexicon import op10_bpe
from orderlens.llm.licenses import op4_licences
from orderlens.llm.linededup import OP3_SQL, op3_line_dedup
from orderlens.llm.packing import op9_packing
from orderlens.llm.periodicruns import op13_periodic_runs
from orderlens.llm.pipeline import run
from orderlens.llm.prefixtrie import OP11_SQL, op11_prefix_trie
from orderlens.llm.quality import OP6_SQL, op6_quality
from orderlens.llm.secretscan import op8_secrets
from orderlens.llm.tokenfile import op5_token_file
from orderlens.llm.topk import OP1_SQL, op1_topk
from orderlens.llm.urlfilter import op7_url_filter
from orderlens.llm.warc import OP12_SQL, op12_warc

QUERIES = {
    "op1_topk": op1_topk,
    "op2_jaccard": op2_jaccard,
    "op3_line_dedup": op3_line_dedup,
    "op4_licences": op4_licences,
    "op5_token_file": op5_token_file,
    "op6_quality": op6_quality,
    "op7_url_filter": op7_url_filter,
    "op8_secrets": op8_secrets,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_warc": op12_warc,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": run,
}

ORACLE: dict[str, str] = {
    "op1_topk": OP1_SQL,
    "op2_jaccard": OP2_SQL,
    "op3_line_dedup": OP3_SQL,
    "op6_quality": OP6_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_warc": OP12_SQL,
}
