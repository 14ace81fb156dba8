"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratecraft.llm import license_scan, minmax, vector_codes
from ratecraft.llm.alignment import op13_alignment
from ratecraft.llm.ann import op1_ann
from ratecraft.llm.language_id import op10_language_id
from ratecraft.llm.license_scan import op2_license_scan
from ratecraft.llm.minmax import op11_minhash
from ratecraft.llm.mixing import op4_mixing
from ratecraft.llm.packing import op7_packing
from ratecraft.llm.quality import op3_quality
from ratecraft.llm.repeats import op9_repeats
from ratecraft.llm.sharding import op6_sharding
from ratecraft.llm.simhash import op8_simhash
from ratecraft.llm.topk import op5_topk
from ratecraft.llm.vector_codes import op12_vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ann": op1_ann,
        "op2_license_scan": op2_license_scan,
        "op3_quality": op3_quality,
        "op4_mixing": op4_mixing,
        "op5_topk": op5_topk,
        "op6_sharding": op6_sharding,
        "op7_packing": op7_packing,
        "op8_simhash": op8_simhash,
        "op9_repeats": op9_repeats,
        "op10_language_id": op10_language_id,
        "op11_minhash": op11_minhash,
        "op12_vector_codes": op12_vector_codes,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_license_scan": license_scan.oracle_sql(), "op11_minhash": minmax.oracle_sql(),
            "op12_vector_codes": vector_codes.oracle_sql()}
