"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .line_rules import OP8_SQL, op8_quality_rules
from .mixing import op2_mixing
from .packing import op1_packing
from .bloom_lm import op9_lm_scoring
from .centroid_clusters import OP12_SQL, op12_centroid_clusters
from .jaccard_forest import op3_ngram_jaccard_join
from .line_runs import OP5_SQL, op5_line_dedup
from .main_text import op13_main_text
from .qda import op7_quality_classifier
from .run_detection import op11_periodic_runs
from .syncmers import op6_document_fingerprints
from .token_order import op4_training_order
from .warc import OP10_SQL, op10_warc

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_mixing": op2_mixing,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_training_order": op4_training_order,
    "op5_line_dedup": op5_line_dedup,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_main_text": op13_main_text,
}

LLM_SQL: dict[str, str] = {
    "op5_line_dedup": OP5_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_warc": OP10_SQL,
    "op12_centroid_clusters": OP12_SQL,
}
