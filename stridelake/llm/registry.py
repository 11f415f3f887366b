"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridelake.llm import collocations, decontaminate, exact_dedup, language, piece_bpe, quality, sentence_spans, simhash, spelling, token_files, topk_search, url_filter, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to a callable of (spark, sf_dir)."""
    return {
        "op1_token_files": token_files.op1_token_files,
        "op2_simhash": simhash.op2_simhash,
        "op3_warc": warc.op3_warc,
        "op4_decontaminate": decontaminate.op4_decontaminate,
        "op5_sentencepiece": piece_bpe.op5_sentencepiece,
        "op6_quality": quality.op6_quality,
        "op7_language": language.op7_language,
        "op8_url_filter": url_filter.op8_url_filter,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_sentence_spans": sentence_spans.op10_sentence_spans,
        "op11_spelling": spelling.op11_spelling,
        "op12_topk_search": topk_search.op12_topk_search,
        "op13_collocations": collocations.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL, for the queries that SQL can express."""
    return {
        "op4_decontaminate": decontaminate.SQL,
        "op8_url_filter": url_filter.SQL,
        "op9_exact_dedup": exact_dedup.SQL,
        "op10_sentence_spans": sentence_spans.SQL,
        "op11_spelling": spelling.SQL,
        "op12_topk_search": topk_search.SQL,
        "op13_collocations": collocations.SQL,
    }
