"""HTML5 character references as column expressions."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of a reference and the code points that the HTML standard maps to others or to nothing.
REFERENCE = "^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"
REPLACEMENT = "�"
NOTHING = [(0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF)]

#: Tried before the names are looked up.
USUAL = ["amp;", "lt;", "gt;", "quot;", "nbsp;"]

#: Names are looked up by hash in lists of some 35 names, as a map's lookup reads its keys one by one.
LISTS = 64


@cache
def _names() -> str:
    lists: list[dict[str, str]] = [{} for _ in range(LISTS)]
    for name, value in html5.items():
        lists[zlib.crc32(name.encode()) % LISTS][name] = value
    return json.dumps(lists)


@cache
def _open_names() -> str:
    """Pattern of the names that need no semicolon, the longest first."""
    return "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)) + ")"


@cache
def _windows_1252() -> str:
    """What the references to 0x80 to 0x9f stand for: the bytes' characters, where they have one."""
    return "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0))


def _named(name: Column) -> Column:
    """The value of a name, with its semicolon if it has one; null if there is no such name."""
    lists = F.from_json(F.lit(_names()), "array<map<string,string>>")
    return F.try_element_at(F.get(lists, F.pmod(F.crc32(name.cast("binary")), F.lit(LISTS)).cast("int")), name)


def _character(code: Column) -> Column:
    """The character of a code point. The byte order mark in front keeps U+FEFF itself a character."""
    return F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(code), 8, "0"))), "UTF-32")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where the value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _of_code(code: Column) -> Column:
    nothing = (code.bitwiseAND(0xFFFE) == 0xFFFE) & (code <= 0x10FFFF)
    for low, high in NOTHING:
        nothing = nothing | code.between(low, high)
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit(REPLACEMENT))
        .when(code.between(0x80, 0x9F), F.substring(F.lit(_windows_1252()), code - 0x7F, F.lit(1)))
        .when(nothing, F.lit(""))
        .otherwise(_character(code))
    )


def _numbered(reference: Column) -> Column:
    """The character of a number in decimal or hexadecimal digits; of any length, as beyond seven digits none has one."""
    digits = F.regexp_extract(reference, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    code = F.call_function("conv", F.concat(F.lit("0"), digits), F.when(reference.rlike("^#[xX]"), 16).otherwise(10), F.lit(10)).cast("int")
    return bound(F.when(F.length(digits) > 7, F.lit(0x110000)).otherwise(code), _of_code)


def _decoded(reference: Column) -> Column:
    """What a reference, given without its '&', stands for; with its '&' again if it is none."""
    start = F.regexp_extract(reference, _open_names(), 1)
    by_name = F.coalesce(_named(reference), F.concat(_named(start), F.substr(reference, F.length(start) + 1)), F.concat(F.lit("&"), reference))
    return F.when(reference.startswith("#"), _numbered(reference)).otherwise(by_name)


def _read(piece: Column) -> Column:
    """The text between two '&', which may begin with a reference."""
    out = F
    for name in USUAL:
        out = out.when(piece.startswith(name), F.concat(F.lit(html5[name]), F.substr(piece, F.lit(len(name) + 1))))
    other = bound(F.regexp_extract(piece, REFERENCE, 0), lambda x: F.concat(_decoded(x), F.substr(piece, F.length(x) + 1)))
    return out.otherwise(other)


def html_unescape(text: Column) -> Column:
    """Character references decoded as browsers do: names with or without semicolon, numbers of any length.

    The text is cut at each '&', and pieces are decoded one by one, so that what a reference stands for is never read
    again. Texts without '&' stay as they are, null stays null.
    """

    def read(x: Column) -> Column:
        pieces = F.transform(F.split(x, "&", -1), lambda piece, place: F.when(place == 0, piece).otherwise(_read(piece)))
        return F.when(x.contains("&"), F.array_join(pieces, "")).otherwise(x)

    # The text is bound once, as its own expression may be long.
    return bound(text, read)
