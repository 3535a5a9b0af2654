"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lagjoin.llm import (align, bpe, chat, decontaminate, jaccard, langid, merkle, packing, quality, secrets,
                         toxicity, warc, wavelet)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": bpe.query, "op2_jaccard_join": jaccard.query, "op3_warc": warc.query,
        "op4_decontamination": decontaminate.query, "op5_quality_rules": quality.query,
        "op6_language_id": langid.query, "op7_wavelet_tokens": wavelet.query, "op8_toxicity": toxicity.query,
        "op9_secret_scan": secrets.query, "op10_chat_format": chat.query, "op11_merkle_manifest": merkle.query,
        "op12_tokenizer_alignment": align.query, "op13_harmonic_packing": packing.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": warc.ORACLE, "op10_chat_format": chat.ORACLE, "op11_merkle_manifest": merkle.ORACLE}
