"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import op8_chat_windows, windows_sql
from .language import op5_language_crf
from .licenses import op1_license_scan
from .line_dedup import op4_line_dedup
from .media import op6_media_sequences, page_sequences
from .packing import op2_curve_packing
from .pieces import op7_piece_viterbi
from .pipeline import run as pipeline
from .quality_rules import op10_quality_rules, rules_sql
from .simhash import op3_simhash
from .tree_bpe import op11_tree_bpe
from .vector_codes import op13_ball_codes
from .weak_quality import op9_weak_quality
from .whitening import op12_jacobi_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_curve_packing": op2_curve_packing,
    "op3_simhash": op3_simhash,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_crf": op5_language_crf,
    "op6_media_sequences": op6_media_sequences,
    "op7_piece_viterbi": op7_piece_viterbi,
    "op8_chat_windows": op8_chat_windows,
    "op9_weak_quality": op9_weak_quality,
    "op10_quality_rules": op10_quality_rules,
    "op11_tree_bpe": op11_tree_bpe,
    "op12_jacobi_whitening": op12_jacobi_whitening,
    "op13_ball_codes": op13_ball_codes,
    "page_sequences": page_sequences,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {"op8_chat_windows": windows_sql(), "op10_quality_rules": rules_sql()}
