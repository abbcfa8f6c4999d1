"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from quizlake.llm.chat import OP5_SQL, op5_prefix_targets
from quizlake.llm.decontam import op7_decontamination
from quizlake.llm.fingerprint import op8_bottom_k_fingerprints
from quizlake.llm.huffman import op13_huffman_ids
from quizlake.llm.langid import op3_language_id
from quizlake.llm.lm import op2_maxent_lm
from quizlake.llm.mixing import op4_sainte_lague_mix
from quizlake.llm.periods import op12_periodic_runs
from quizlake.llm.phrases import OP11_SQL, op11_phrase_collocations
from quizlake.llm.quality import op1_quality_classifier
from quizlake.llm.sketch_join import op9_jaccard_join
from quizlake.llm.toxicity import op10_toxicity
from quizlake.llm.warc import op6_warc_derivatives

QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_maxent_lm, op3_language_id, op4_sainte_lague_mix, op5_prefix_targets,
    op6_warc_derivatives, op7_decontamination, op8_bottom_k_fingerprints, op9_jaccard_join, op10_toxicity,
    op11_phrase_collocations, op12_periodic_runs, op13_huffman_ids,
)}

ORACLE: dict[str, str] = {"op5_prefix_targets": OP5_SQL, "op11_phrase_collocations": OP11_SQL}
