"""Text cleaning expressions.

Regular expressions are written with explicit character classes so that Java
(Spark) and RE2 (the DuckDB oracle) agree: Java's ``\\w``/``\\s`` are ASCII-only
unless ``(?U)`` is given, and RE2 has no ``\\v`` in ``\\s``.  Letters and digits
are therefore spelled ``\\p{L}\\p{N}``.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.html import unescape_html

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Abbreviation dictionary of the Spark cleaning job (20 entries, in order).
ABBREVIATIONS_JOB = {
    "k": "không", "ko": "không", "kh": "không", "kg": "không",
    "dc": "được", "đc": "được", "sp": "sản_phẩm", "ng": "người",
    "ok": "ổn", "shop": "cửa_hàng", "mn": "mọi_người", "vs": "với",
    "mk": "mình", "r": "rồi", "khong": "không", "oke": "ổn",
    "oki": "ổn", "ms": "mới", "cx": "cũng", "sdt": "số_điện_thoại",
}
# Abbreviation dictionary of the exploration notebook (27 entries, in order).
ABBREVIATIONS_NOTEBOOK = {
    "k": "không", "ko": "không", "kh": "không", "kg": "không",
    "dc": "được", "đc": "được", "sp": "sản_phẩm", "ng": "người",
    "ok": "ổn", "ad": "quản_trị_viên", "ib": "nhắn_tin", "rep": "trả_lời",
    "shop": "cửa_hàng", "mn": "mọi_người", "vs": "với", "mk": "mình",
    "r": "rồi", "khong": "không", "km": "Khuyến_mãi", "oke": "ổn",
    "oki": "ổn", "okê": "ổn", "ms": "mới", "cx": "cũng", "of": "của",
    "or": "hoặc", "sdt": "số_điện_thoại",
}
# ---------------------------------------------------------------------------

# ASCII whitespace as Java's \s sees it (space, \t \n \x0B \f \r).
ASCII_WS = " \\t\\n\\x0B\\f\\r"
# Unicode whitespace as Python's str.split()/\s see it.
UNICODE_WS = (ASCII_WS + "\\x1C-\\x1F\\x85\\xA0\\u1680\\u2000-\\u200A"
              "\\u2028\\u2029\\u202F\\u205F\\u3000")
WORD = "\\p{L}\\p{N}_"
# Letters, digits and blanks that most texts are made of, each written singly: Java looks single
# Latin-1 characters up in one table, while a class of ranges and properties asks each in turn.
_LATIN = "".join(chr(i) for i in range(0x100) if chr(i).isalpha() and not 0x80 <= i < 0xC0)
_PLAIN = "0123456789_" + _LATIN


def _other_than(chars: str) -> str:
    """``[^chars]`` with the plain characters and the blank, all of them in ``chars``, ruled out first."""
    return f"[[^{_PLAIN} ]&&[^{chars}]]"


def _one_of(chars: str) -> str:
    """``[chars]``, none of them plain, with the plain characters ruled out first."""
    return f"[[^{_PLAIN}]&&[{chars}]]"


def _text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def _replaced(c: Column, pattern: str, by: str, *signs: str) -> Column:
    """``regexp_replace`` for texts that hold one of ``signs``, without which nothing can match;
    other texts are not searched.  ``c`` is worked out once."""
    def one(x: Column) -> Column:
        held = reduce(or_, [F.contains(x, F.lit(sign)) for sign in signs])
        return F.when(held, F.regexp_replace(x, pattern, by)).otherwise(x)
    return F.get(F.transform(F.array(c), one), 0)


def _squeeze(c: Column, ws: str = ASCII_WS) -> Column:
    if ws == ASCII_WS:  # few signs: most texts have no run to squeeze
        return F.trim(_replaced(c, f"{_one_of(ws)}+", " ", "  ", "\t", "\n", "\x0B", "\f", "\r"))
    return F.trim(F.regexp_replace(c, f"{_one_of(ws)}+", " "))


def _words_only(c: Column) -> Column:
    """Runs of other than word characters to one blank, none outside."""
    return F.trim(F.regexp_replace(c, f"{_one_of(f'^{WORD}')}+", " "))


def _map_words(words: Column, mapping: dict) -> Column:
    """Replace every array element found in ``mapping`` (one pass)."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    # a look-up asks each key in turn, membership is one hash: other words are not looked up
    return F.transform(words, lambda w: F.when(w.isin(*mapping), F.try_element_at(lookup, w)).otherwise(w))


def expand_abbreviations(c, mapping: dict = ABBREVIATIONS_JOB) -> Column:
    """whole-word replacement on space-separated, squeezed text.  Texts without any
    abbreviation stay as they are."""
    def one(x: Column) -> Column:
        words = F.split(x, " ")
        return F.when(F.exists(words, lambda w: w.isin(*mapping)), F.array_join(_map_words(words, mapping), " ")).otherwise(x)
    return F.get(F.transform(F.array(_text(c)), one), 0)


def clean_text(c, mapping: dict = ABBREVIATIONS_JOB) -> Column:
    """the cleaning job's ``content_text``.

    null -> "", lower, URLs and @mentions/#hashtags out, everything but
    letters/digits/underscore/whitespace to space, squeeze, trim, expand
    abbreviations, squeeze again.
    """
    c = F.lower(_text(c))
    c = _replaced(c, f"http[^{ASCII_WS}]+|www[^{ASCII_WS}]+", " ", "http", "www")
    c = _replaced(c, f"[@#][{WORD}]+", " ", "@", "#")
    c = expand_abbreviations(_words_only(c), mapping)
    return _squeeze(c)


def clean_text_v2(c) -> Column:
    """the notebook's cleaner (case kept).

    HTML character references decoded, ``@x`` dropped, ``#tag`` -> ``tag``,
    URLs dropped, characters outside the Basic Multilingual Plane (emoji)
    dropped, non-word characters to space, whitespace squeezed and trimmed.
    """
    c = unescape_html(_text(c))
    c = _replaced(c, f"@[^{UNICODE_WS}]+", "", "@")
    c = _replaced(c, f"#([{WORD}]+)", "$1", "#")
    c = _replaced(c, f"https?://[^{UNICODE_WS}]+|www\\.[^{UNICODE_WS}]+", "", "http", "www.")
    c = F.regexp_replace(c, "[\\x{10000}-\\x{10FFFF}]", "")
    c = F.regexp_replace(c, _other_than(WORD + UNICODE_WS), " ")
    return _squeeze(c, UNICODE_WS)


def word_tokens(c, ws: str = UNICODE_WS) -> Column:
    """Whitespace split that drops empty pieces (Python ``str.split()``)."""
    return F.filter(F.split(_text(c), f"{_one_of(ws)}+"), lambda w: w != "")


def normalize_text(c, mapping: dict = ABBREVIATIONS_NOTEBOOK) -> Column:
    """lower, punctuation to space, split, map lookup, join."""
    c = F.regexp_replace(F.lower(_text(c)), _other_than(WORD + UNICODE_WS), " ")
    return F.array_join(_map_words(word_tokens(c), mapping), " ")


def remove_stopwords(c, stopwords) -> Column:
    """drop whitespace-separated words found in ``stopwords``.

    ``stopwords`` is a Python collection (inlined as an array literal) or a
    Column holding an array (e.g. a scalar subquery over a stopword table).
    """
    sw = stopwords if isinstance(stopwords, Column) else F.array(*[F.lit(w) for w in sorted(stopwords)])
    return F.array_join(F.filter(word_tokens(c), lambda w: ~F.array_contains(sw, w)), " ")


def safe_csv_text(c) -> Column:
    """newlines to space, double quote to single, comma to space."""
    # squeezing takes the newlines
    c = F.replace(_text(c), F.lit('"'), F.lit("'"))
    c = F.replace(c, F.lit(","), F.lit(" "))
    return _squeeze(c)
