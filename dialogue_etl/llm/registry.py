"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from dialogue_etl.llm import decontaminate, embedding_dedup, hard_negatives, html_extract, language_id, licenses, line_dedup, minhash_dedup, mixing, quality, ranked_search, token_output, warc


def queries() -> dict:
    return {
        "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
        "op2_decontaminate": decontaminate.op2_decontaminate,
        "op3_mix_sources": mixing.op3_mix_sources,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_html_extract": html_extract.op5_html_extract,
        "op6_warc_archive": warc.op6_warc_archive,
        "op7_quality_classifier": quality.op7_quality_classifier,
        "op8_token_output": token_output.op8_token_output,
        "op9_language_id": language_id.op9_language_id,
        "op10_minhash_near_dedup": minhash_dedup.op10_minhash_near_dedup,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_ranked_search": ranked_search.op12_ranked_search,
        "op13_license_scan": licenses.op13_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": embedding_dedup.SQL,
        "op2_decontaminate": decontaminate.SQL,
        "op3_mix_sources": mixing.SQL,
        "op4_line_dedup": line_dedup.SQL,
        "op6_warc_archive": warc.SQL,
        "op10_minhash_near_dedup": minhash_dedup.SQL,
        "op11_hard_negatives": hard_negatives.SQL,
        "op12_ranked_search": ranked_search.SQL,
    }
