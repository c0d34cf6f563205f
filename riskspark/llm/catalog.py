"""The registered queries of this subpackage and the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from riskspark.llm import language, mixing, near, packing, pii, quality, repeats, search, urls, variants, warc, whiten, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_maxscore": search.op2_maxscore,
    "op3_personal_data": pii.op3_personal_data,
    "op4_minhash_dedup": near.op4_minhash_dedup,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_warc": warc.op6_warc,
    "op7_winnowing": winnow.op7_winnowing,
    "op8_pack": packing.op8_pack,
    "op9_language_id": language.op9_language_id,
    "op10_url_filter": urls.op10_url_filter,
    "op11_whitening": whiten.op11_whitening,
    "op12_spelling_variants": variants.op12_spelling_variants,
    "op13_substring_dedup": repeats.op13_substring_dedup,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {"op2_maxscore": search.OP2_SQL}
