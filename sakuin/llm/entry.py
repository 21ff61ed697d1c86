"""Queries of the corpus operators and their SQL. A library that is missing shows at import."""

from __future__ import annotations

import corpus_pipeline
from sakuin.llm.centroids import OP13_SQL, op13_centroid_clustering
from sakuin.llm.context_tree import op9_lm_scoring
from sakuin.llm.decontamination import OP5_SQL, op5_decontamination
from sakuin.llm.importance import OP12_SQL, op12_importance_resampling
from sakuin.llm.jaccard_join import op4_jaccard_join
from sakuin.llm.language_id import op1_language_id
from sakuin.llm.minhash import op11_fingerprints
from sakuin.llm.packing import op2_best_fit_packing
from sakuin.llm.quality_rules import op3_quality_rules
from sakuin.llm.suffix_dedup import op10_suffix_dedup
from sakuin.llm.token_rollup import op8_token_counts
from sakuin.llm.url_filters import op6_url_filters
from sakuin.llm.warc import op7_warc

_OPERATORS = (op1_language_id, op2_best_fit_packing, op3_quality_rules, op4_jaccard_join, op5_decontamination, op6_url_filters, op7_warc, op8_token_counts, op9_lm_scoring, op10_suffix_dedup,
              op11_fingerprints, op12_importance_resampling, op13_centroid_clustering)


def queries():
    return {"pipeline": corpus_pipeline.run, **{f.__name__: f for f in _OPERATORS}}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5_SQL, "op12_importance_resampling": OP12_SQL, "op13_centroid_clustering": OP13_SQL}
