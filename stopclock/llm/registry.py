"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stopclock.llm.decontamination import OP5_SQL, op5_decontamination
from stopclock.llm.language import op10_language
from stopclock.llm.license_scan import op7_license_scan
from stopclock.llm.mixing import OP9_SQL, op9_mixing
from stopclock.llm.quality_classifier import op6_quality_classifier
from stopclock.llm.quality_rules import OP2_SQL, op2_quality_rules
from stopclock.llm.secret_scan import op11_secret_scan
from stopclock.llm.sharding import op8_sharding
from stopclock.llm.simhash import op3_simhash
from stopclock.llm.source_divergence import OP13_SQL, op13_source_divergence
from stopclock.llm.suffix_dedup import op1_suffix_dedup
from stopclock.llm.toxicity import op4_toxicity
from stopclock.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_license_scan": op7_license_scan,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_secret_scan": op11_secret_scan,
    "op12_vector_codes": op12_vector_codes,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": OP2_SQL,
    "op5_decontamination": OP5_SQL,
    "op9_mixing": OP9_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
