"""Word breaks of Unicode text, as the standard tokenizer of full-text engines makes them.

Letters, digits and connectors run together; an apostrophe, colon or full stop stays inside between
letters, a comma or full stop between digits (``can't``, ``3.14``); every ideograph and every hiragana
is a token, katakana and scripts written without spaces are taken run by run; marks and
format characters belong to what they follow. Signs and emoji are no tokens. Tokens of more than
255 characters are cut into pieces of 255.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column, functions as F

# The word-break classes of Unicode text segmentation (UAX 29) that join words.
MID_LETTER = r":··՟״‧︓﹕："
MID_NUMBER = r",;;։،؍٬߸⁄︐︔﹐﹔，；"
MID_BOTH = r"'.‘’․﹒＇．"
# Katakana by word break that other scripts share; scripts written without spaces.
KATAKANA = r"\p{IsKatakana}〱-〵゛゜゠ーｰ"
UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
MAX_TOKEN = 255

_AFTER = r"(?:\p{M}|(?!​)\p{Cf})*+"
_LETTER = rf"(?:[\p{{L}}\p{{Nl}}&&[^\p{{IsIdeographic}}\p{{IsHiragana}}{KATAKANA}{UNSPACED}]]{_AFTER})++"
_DIGIT = rf"(?:[\p{{Nd}}&&[^{UNSPACED}]]{_AFTER})++"
_LETTERS = rf"{_LETTER}(?:[{MID_LETTER}{MID_BOTH}]{_AFTER}{_LETTER})*+"
_DIGITS = rf"{_DIGIT}(?:[{MID_NUMBER}{MID_BOTH}]{_AFTER}{_DIGIT})*+"
_RUN = rf"(?:(?:{_LETTERS}|{_DIGITS})++|(?:[{KATAKANA}]{_AFTER})++)"
_JOIN = rf"(?:\p{{Pc}}{_AFTER})"
STANDARD = rf"{_JOIN}*+{_RUN}(?:{_JOIN}++{_RUN})*+{_JOIN}*+|[\p{{IsIdeographic}}\p{{IsHiragana}}]{_AFTER}|(?:[{UNSPACED}]{_AFTER})++"

# Most tokens: small Latin letters before a space, a comma or the end, where nothing can follow them.
_PLAIN = r"[a-zß-öø-ÿ]++(?=[ ,\n\r\t]|\.[ \n\r\t]|\z)"

_STANDARD_PY = regex.compile("(?V1)" + STANDARD)


def standard_tokens(text: Column) -> Column:
    """Array of the tokens of folded text, in order."""
    return F.filter(F.split(token_text(text), " "), lambda t: t != "")


def token_text(text: Column) -> Column:
    """The tokens of folded text with one space between: what matchers and counts work on."""
    joined = F.array_join(F.regexp_extract_all(text, F.lit(f"{_PLAIN}|{STANDARD}"), F.lit(0)), " ")
    # Looked for where a token or a piece begins, not from every character.
    return F.regexp_replace(joined, rf"(?:(?<![^ ])|\G)([^ ]{{{MAX_TOKEN}}})(?=[^ ])", "$1 ")


def standard_terms(text: str) -> list[str]:
    """Tokens of a query text, in order."""
    found = _STANDARD_PY.findall(text.lower())
    return [t[i : i + MAX_TOKEN] for t in found for i in range(0, len(t), MAX_TOKEN)]
