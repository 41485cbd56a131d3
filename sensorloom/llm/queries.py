"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from sensorloom.llm import backoff, bitplanes, caps, decontaminate, licenses, pieces, pii, quality, repeats, secrets, simhash, variants, warc


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_warc": warc.op2_warc,
        "op3_licenses": licenses.op3_licenses,
        "op4_secrets": secrets.op4_secrets,
        "op5_sentencepiece": pieces.op5_sentencepiece,
        "op6_decontaminate": decontaminate.op6_decontaminate,
        "op7_simhash": simhash.op7_simhash,
        "op8_suffix_repeats": repeats.op8_suffix_repeats,
        "op9_backoff": backoff.op9_backoff,
        "op10_pii": pii.op10_pii,
        "op11_variants": variants.op11_variants,
        "op12_bitplanes": bitplanes.op12_bitplanes,
        "op13_caps": caps.op13_caps,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc": warc.SQL,
        "op3_licenses": licenses.SQL,
        "op6_decontaminate": decontaminate.SQL,
        "op8_suffix_repeats": repeats.SQL,
        "op9_backoff": backoff.SQL,
        "op11_variants": variants.SQL,
        "op12_bitplanes": bitplanes.SQL,
        "op13_caps": caps.SQL,
    }
