"""Names found in query text, as native column expressions (no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlens.functions import fixed_values as fixed

# What counts as blank at either end of a token: the Unicode white space characters
# and the four ASCII separators.
_BLANK = r"[ \t\n\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The first word of a text without outer blanks: up to a space, or up to any blank.
_STRICT_NAME = rf"^{_BLANK}*([^ ]*?)(?:{_BLANK}*\z| )"
_CLEAN_NAME = rf"^{_BLANK}*(.*?)[;,)]*(?:{_BLANK}|\z)"
_PLAIN_INTEGER = r"^(0|-?[1-9][0-9]{0,27})\z"
_PLAIN_NUMBER = r"^([+-]?)(?=\.?[0-9])([0-9]*)(\.?[0-9]*)\z"
_EXPONENT_NUMBER = r"^[+-]?[0-9]*\.?([0-9]*)[eE]([+-]?[0-9]{1,9})\z"
_JSON_NUMBER = r"(?<![-+.\w])(-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?)(?=\s*+[,}\]])"
# Code points that are no characters.
_MARK, _BACKSLASH, _QUOTE = "﷐", "﷑", "﷒"
_KEPT_NAME = r"\.|^[\p{L}\p{N}]+\z"


def referenced_tables(upper: Column, clean: bool = False) -> Column:
    """Array of table names following a table keyword, in keyword order.

    ``upper`` is the text in upper case. The strict form looks for a keyword anywhere,
    even inside a word, ends a name at a space only, and keeps names that are dotted or
    purely alphanumeric, repeats included. ``clean`` ends a name at any white space and
    cuts off punctuation behind it.
    """
    pattern = _CLEAN_NAME if clean else _STRICT_NAME
    nothing = F.array().cast("array<string>")
    found = []
    for keyword in fixed.TABLE_KEYWORDS:
        parts = F.split(upper, re.escape(keyword))
        behind = F.slice(parts, F.lit(2), F.size(parts))
        names = F.transform(behind, lambda part: F.regexp_extract(part, pattern, 1))
        kept = F.filter(names, lambda name: name.rlike(_KEPT_NAME))
        # Most texts lack most keywords; a plain search is cheaper than a split.
        found.append(F.when(F.contains(upper, F.lit(keyword)), kept).otherwise(nothing))
    return F.concat(*found)


def extract(text: Column, pattern: str, group: int) -> Column:
    """First match of a pattern, null when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def after_merge_phrase(text: Column) -> Column:
    """Upper-cased text behind the merge phrase without leading blanks, or null."""
    upper = F.upper(text)
    position = F.instr(upper, fixed.MERGE_PHRASE)
    rest = F.substring(upper, position + len(fixed.MERGE_PHRASE), F.length(upper))
    return F.when(position > 0, F.ltrim(rest))


def first_word(text: Column) -> Column:
    """Text up to the first blank, newline or semicolon, at most 99 characters."""
    ends = [F.nullif(F.instr(text, mark), F.lit(0)) for mark in (" ", "\n", ";")]
    end = F.least(*ends, F.lit(fixed.MERGE_TARGET_LIMIT))
    return F.substring(text, F.lit(1), end - 1)


def numbers_as_marked_text(json: Column) -> Column:
    """JSON in which each number has become a string between two ``_MARK``, so that parsing
    keeps its text. Strings are skipped one by one; escaped quotes and backslashes are set
    aside meanwhile, so a string ends at the next quote."""
    for mark in (_MARK, _BACKSLASH, _QUOTE):
        json = F.replace(json, F.lit(mark), F.lit(f"\\u{ord(mark):04x}"))
    json = F.replace(F.replace(json, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    json = F.regexp_replace(json, f'("[^"]*+")|{_JSON_NUMBER}', f'$1"{_MARK}$2{_MARK}"')
    json = F.replace(json, F.lit(f'"{_MARK}{_MARK}"'), F.lit(""))
    return F.replace(F.replace(json, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def without_marks(text: Column) -> Column:
    """A value out of ``numbers_as_marked_text``, its numbers as they stood."""
    bare = F.regexp_replace(text, f'"{_MARK}([-+.0-9eE]+){_MARK}"', "$1")
    return F.regexp_replace(bare, f"^{_MARK}([-+.0-9eE]+){_MARK}\\z", "$1")


def canonical_scalar(text: Column) -> Column:
    """Numbers without padding and with all their digits, else booleans as true/false, else
    the text itself. A number with an exponent is written out if 38 digits, 18 of them
    behind the point, hold it, and stays as it is otherwise."""
    trimmed = F.trim(text)
    sign = F.regexp_extract(trimmed, _PLAIN_NUMBER, 1)
    whole = F.regexp_replace(F.regexp_extract(trimmed, _PLAIN_NUMBER, 2), "^0+", "")
    part = F.regexp_replace(F.regexp_extract(trimmed, _PLAIN_NUMBER, 3), r"0+\z", "")
    part = F.when(F.length(part) > 1, part).otherwise("")
    size = F.concat(F.when(whole == "", "0").otherwise(whole), part)
    signed = F.concat(F.when((sign == "-") & (size != "0"), "-").otherwise(""), size)
    decimal = trimmed.try_cast("decimal(38,18)").cast("string")
    plain = F.regexp_replace(F.regexp_replace(decimal, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    digits = F.length(F.regexp_replace(F.regexp_extract(trimmed, _EXPONENT_NUMBER, 1), r"0+\z", ""))
    fits = digits - F.regexp_extract(trimmed, _EXPONENT_NUMBER, 2).try_cast("int") <= 18
    word = F.lower(trimmed)
    return (
        F.when(text.rlike(_PLAIN_INTEGER), text)
        .when(trimmed.rlike(_PLAIN_NUMBER), signed)
        .when(trimmed.rlike(_EXPONENT_NUMBER) & decimal.isNotNull() & fits, plain)
        .when(word.isin(*fixed.BOOLEAN_WORDS["true"]), F.lit("true"))
        .when(word.isin(*fixed.BOOLEAN_WORDS["false"]), F.lit("false"))
        .otherwise(text)
    )
