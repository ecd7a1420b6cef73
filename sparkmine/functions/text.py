"""Tokens, word splitting and HTML clean-up as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separators (white space, ASCII punctuation, em dash, ellipsis, curly quotes).
TOKEN_SEPARATORS = r"[\s\p{Punct}\x{2014}\x{2026}\x{201C}\x{201E}]+"

# The characters that count as white space when splitting text into words.
WORD_SPACES = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

# Clean-up patterns for web text, applied in this order.
WEB_TEXT_PATTERNS = [
    r'[#",!?;<>/\\*&-]',  # punctuation
    r"\[[^\]]*\]",  # bracketed notes
    r"[:.+=()–©°′″•↑—]",  # other symbols
    r"\d+\.?\d*",  # numbers
]

# A classifier's word rule (two or more word characters).
WORD_RULE = r"[\p{L}\p{N}_]{2,}"


def tokens(text: str | Column) -> Column:
    """Lower-case tokens between separators, as an array; an empty first or last piece
    stands for a leading or trailing separator and is dropped where rows are formed."""
    column = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(column), TOKEN_SEPARATORS)


def words(text: str | Column) -> Column:
    """Words between white space, as an array (with the empty end pieces of :func:`tokens`)."""
    column = F.col(text) if isinstance(text, str) else text
    return F.split(column, WORD_SPACES)


def rule_words(text: str | Column) -> Column:
    """Lower-case runs of two or more word characters, as an array."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(column), F.lit(f"({WORD_RULE})"), 1)


def non_empty(parts: Column) -> Column:
    return F.array_remove(parts, "")


def word_count(text: str | Column) -> Column:
    return F.size(non_empty(words(text))).cast("bigint")


def decoded_entities(text: Column) -> Column:
    """Replace named and decimal/hex character references once, left to right."""
    named = F.create_map(*[F.lit(v) for name, code in sorted(name2codepoint.items()) for v in (f"&{name};", chr(code))])

    def character(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def piece(p: Column) -> Column:
        decimal = F.regexp_extract(p, r"^&#(\d{1,7});$", 1).try_cast("bigint")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(p, r"^&#[xX]([0-9A-Fa-f]{1,6});$", 1), F.lit("")), 16, 10).try_cast("bigint")
        code = F.coalesce(decimal, hexadecimal)
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        return F.coalesce(F.try_element_at(named, p), F.when(valid, character(code)), p)

    pieces = F.split(text, r"(?=&(?:#?\w{1,8});)|(?<=&#?\w{1,8};)")
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def html_text(html: str | Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags become blanks."""
    column = F.col(html) if isinstance(html, str) else html
    without_code = F.regexp_replace(column, r"(?is)<(script|style|template)\b.*?</\1\s*>", " ")
    without_comments = F.regexp_replace(without_code, r"(?s)<!--.*?-->", " ")
    return decoded_entities(F.regexp_replace(without_comments, r"<[^>]*>", " "))


def cleaned_web_text(html: str | Column) -> Column:
    """Page text with symbols, bracketed notes and numbers blanked."""
    text = html_text(html)
    for pattern in WEB_TEXT_PATTERNS:
        text = F.regexp_replace(text, pattern, " ")
    return text
