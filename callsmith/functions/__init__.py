"""Column builders: text extraction, conversion."""
from callsmith.functions.text import (  # noqa: F401
    all_matches, as_array, classify_pattern_phrase, classify_replacement_phrase,
    exclude_used, extract_after_keyword, extract_any_quoted, extract_longest_quoted,
    extract_numbers, extract_quoted, extract_quoted_pair, extract_sub_source, first_match,
    is_blank, kth_distinct, longest_of, rx, strip_ws,
)
from callsmith.functions.convert import (  # noqa: F401
    convert_text, convert_variant, default_for_type, py_float,
)
