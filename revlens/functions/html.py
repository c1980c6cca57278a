"""HTML character references decoded as column expressions (part of F3).

The rules are those of the HTML standard, as Python's ``html.unescape`` applies
them: numeric references, named ones, and the old names that count without their
semicolon (the longest one that fits).  The name table is Python's own
``html.entities.html5``.

A text is split once at its references; each reference is decoded and put back
between the pieces.  Names are looked up in a table of ``SLOTS`` slots addressed by
their CRC, so a look-up reads one slot instead of searching 2,231 names.  Texts
without ``&`` are passed through untouched.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
SLOTS = 4096
#: longest name that counts without its semicolon
OLD_LENGTH = max(len(n) for n in html5 if not n.endswith(";"))


@cache
def _slots() -> str:
    """The names with what they stand for, dealt by CRC: JSON of an array of maps."""
    slots: list[dict[str, str]] = [{} for _ in range(SLOTS)]
    for name, chars in html5.items():
        slots[crc32(name.encode()) % SLOTS][name] = chars
    return json.dumps(slots)


def _named(name: Column) -> Column:
    """What a name (with or without ';') stands for, else null."""
    slots = F.from_json(F.lit(_slots()), "array<map<string,string>>")
    return F.try_element_at(F.get(slots, F.pmod(F.crc32(name.cast("binary")), F.lit(SLOTS)).cast("int")), name)


def _character(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _numbered(digits: Column, base: int) -> Column:
    """The character a numeric reference stands for.

    0, surrogates and numbers beyond Unicode: the replacement character; 0x80-0x9F: the
    Windows-1252 character of that byte, where it has one; other controls and
    non-characters: nothing."""
    stripped = F.regexp_replace(digits, "^0+", "")
    code = F.when(F.length(stripped) > 8, F.lit(0x110000)).otherwise(
        F.conv(F.when(stripped == "", "0").otherwise(stripped), base, 10).cast("bigint"))
    windows = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")
    second = F.get(F.array(*[F.lit(chr(0x80 + i) if c == "�" else c) for i, c in enumerate(windows)]), (code - 0x80).cast("int"))
    nothing = (code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
               | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("�"))
            .when(code.between(0x80, 0x9F), second).when(nothing, F.lit("")).otherwise(_character(code)))


def _decoded(reference: Column) -> Column:
    body = F.substr(reference, F.lit(2))
    digits = F.regexp_replace(body, "[#xX;]", "")
    # the longest old name that begins the reference; what follows it stays as it is
    begun = [F.concat(_named(F.substring(body, 1, n)), F.substr(body, F.lit(n + 1))) for n in range(OLD_LENGTH, 1, -1)]
    return (F.when(F.substring(body, 1, 2).isin("#x", "#X"), _numbered(digits, 16))
            .when(F.substring(body, 1, 1) == "#", _numbered(digits, 10))
            .otherwise(F.coalesce(_named(body), *begun, reference)))


def unescape_html(c: Column) -> Column:
    """``c`` with all HTML character references decoded once (null stays null)."""
    found = F.transform(F.regexp_extract_all(c, F.lit(REFERENCE), 0), _decoded)
    joined = F.array_join(F.zip_with(F.split(c, REFERENCE, -1), found, lambda text, ref: F.concat(text, F.coalesce(ref, F.lit("")))), "")
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)
