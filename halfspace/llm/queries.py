"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from halfspace.llm.exact_dedup import OP3_SQL, op3_exact_dedup
from halfspace.llm.licenses import op10_license_scan
from halfspace.llm.packing import op4_packing
from halfspace.llm.page_text import op8_page_text
from halfspace.llm.quality_crf import op2_quality_classifier
from halfspace.llm.quality_rules import op9_quality_rules
from halfspace.llm.repeats import op13_repeated_passages
from halfspace.llm.sentence_pieces import op7_sentence_pieces
from halfspace.llm.sharding import op5_sharding
from halfspace.llm.simhash import op6_simhash
from halfspace.llm.toxicity import op1_toxicity
from halfspace.llm.turn_trie import OP11_SQL, op11_prefix_trie
from halfspace.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_toxicity,
        op2_quality_classifier,
        op3_exact_dedup,
        op4_packing,
        op5_sharding,
        op6_simhash,
        op7_sentence_pieces,
        op8_page_text,
        op9_quality_rules,
        op10_license_scan,
        op11_prefix_trie,
        op12_whitening,
        op13_repeated_passages,
    )
}

ORACLES: dict[str, str] = {"op3_exact_dedup": OP3_SQL, "op11_prefix_trie": OP11_SQL}
