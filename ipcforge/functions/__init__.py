"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from .codes import (
    AI_ITEMS_TYPE,
    canonicalize_code,
    code_parts,
    expert_codes,
    first_ai_line,
    has_ai_items,
    expert_main_groups,
    label_match,
    main_group_of,
    parse_ai_line,
)
from .lists import (
    decode_code_list,
    decode_score_list,
    encode_code_list,
    encode_score_list,
    zip_scores,
)
from .months import (
    bulletin_code_from_key,
    dataset_code_from_key,
    dataset_name,
    month_code_of,
    month_series,
    check_folder,
)
from .text import decode_utf8_lenient, first_line_starting_with, let, py_rstrip, py_strip

__all__ = [
    "AI_ITEMS_TYPE",
    "bulletin_code_from_key",
    "canonicalize_code",
    "code_parts",
    "dataset_code_from_key",
    "dataset_name",
    "decode_code_list",
    "decode_score_list",
    "decode_utf8_lenient",
    "encode_code_list",
    "encode_score_list",
    "expert_codes",
    "first_ai_line",
    "first_line_starting_with",
    "has_ai_items",
    "expert_main_groups",
    "label_match",
    "let",
    "main_group_of",
    "month_code_of",
    "month_series",
    "check_folder",
    "parse_ai_line",
    "py_rstrip",
    "py_strip",
    "zip_scores",
]
