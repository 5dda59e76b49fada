"""The queries of this subpackage, for the driver's entry file."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from clienttrail.llm import divergence
from clienttrail.llm.divergence import op13_source_divergence
from clienttrail.llm.html_text import op2_text_density
from clienttrail.llm.langid import op9_string_kernel_language
from clienttrail.llm.mixing import op4_soft_mixing
from clienttrail.llm.neighbours import op6_stable_projections
from clienttrail.llm.packing import op5_best_fit_packing
from clienttrail.llm.quality import op1_mcd_quality
from clienttrail.llm.sharding import op11_bounded_ring
from clienttrail.llm.simhash import op7_simhash_blocks
from clienttrail.llm.spelling import op12_spelling_forms
from clienttrail.llm.substring import op10_fm_substring_dedup
from clienttrail.llm.token_output import op3_packed_matrices
from clienttrail.llm.toxicity import op8_ordinal_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mcd_quality": op1_mcd_quality,
        "op2_text_density": op2_text_density,
        "op3_packed_matrices": op3_packed_matrices,
        "op4_soft_mixing": op4_soft_mixing,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_stable_projections": op6_stable_projections,
        "op7_simhash_blocks": op7_simhash_blocks,
        "op8_ordinal_toxicity": op8_ordinal_toxicity,
        "op9_string_kernel_language": op9_string_kernel_language,
        "op10_fm_substring_dedup": op10_fm_substring_dedup,
        "op11_bounded_ring": op11_bounded_ring,
        "op12_spelling_forms": op12_spelling_forms,
        "op13_source_divergence": op13_source_divergence,
        "pipeline": corpus_pipeline.run,
    }


# All windows of all texts, counted as text.
_SUBSTRING_SQL = r"""
    WITH cut AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    starts AS (
        SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i
        FROM cut WHERE len(words) >= 35),
    windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS word_window FROM starts),
    repeated AS (
        SELECT word_window FROM windows GROUP BY word_window HAVING count(*) > 1),
    removed AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place
        FROM windows SEMI JOIN repeated USING (word_window)),
    places AS (
        SELECT doc_id, list(place) AS gone FROM removed GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
           sha256(array_to_string(list_filter(words, lambda w, k:
               NOT list_contains(coalesce(gone, CAST([] AS BIGINT[])), k)), ' ')) AS kept_sha256
    FROM cut LEFT JOIN places USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """Statements for what SQL can express; the others are tested against brute force."""
    return {"op10_fm_substring_dedup": _SUBSTRING_SQL, "op13_source_divergence": divergence.SQL}
