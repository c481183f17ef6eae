"""Queries of this subpackage and the SQL that says the same, where SQL can say it."""

from __future__ import annotations

from .ann import op1_multi_index_search
from .bpe import op11_bpe_trie
from .linededup import OP9_SQL, op9_line_dedup
from .lm import op7_maxent_scores
from .merkle import OP12_SQL, op12_merkle_manifest
from .minhash import OP3_SQL, op3_minhash_near_dedup
from .mixing import OP8_SQL, op8_source_mixing
from .packing import op10_best_fit_packing
from .pii import op4_pii_contexts
from .quality import OP2_SQL, op2_quality_rules
from .sortmeans import OP13_SQL, op13_sort_means
from .urlfilter import OP5_SQL, op5_url_filter
from .warc import OP6_SQL, op6_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_multi_index_search, op2_quality_rules, op3_minhash_near_dedup, op4_pii_contexts, op5_url_filter,
        op6_warc, op7_maxent_scores, op8_source_mixing, op9_line_dedup, op10_best_fit_packing,
        op11_bpe_trie, op12_merkle_manifest, op13_sort_means,
    )
}
SQL = {
    "op2_quality_rules": OP2_SQL, "op3_minhash_near_dedup": OP3_SQL, "op5_url_filter": OP5_SQL, "op6_warc": OP6_SQL, "op8_source_mixing": OP8_SQL, "op9_line_dedup": OP9_SQL,
    "op12_merkle_manifest": OP12_SQL, "op13_sort_means": OP13_SQL,
}
