"""Column expressions: everything here returns a ``Column`` and runs inside
whole-stage codegen (no Python UDFs)."""

from revlens.functions.text import (  # noqa: F401
    ABBREVIATIONS_JOB, ABBREVIATIONS_NOTEBOOK, clean_text, clean_text_v2,
    expand_abbreviations, normalize_text, remove_stopwords, safe_csv_text,
    word_tokens,
)
from revlens.functions.scoring import score_ge, score_le, segment_rule  # noqa: F401
from revlens.functions.fmt import fixed, percent_text  # noqa: F401
