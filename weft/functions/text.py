"""Text functions as Column expressions, with Unicode classes spelled out.

Words are runs of letters, numbers and underscores; combining marks are symbols.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes and patterns that results depend on.
WORD = "[\\p{L}\\p{N}_]+"
SYMBOL = "(?U)[^\\p{L}\\p{N}_\\s]"
#: Where a text is cut into sentences.
SENTENCE_END = "(?<=[.!?])\\s+|\\n+"
CONTROL = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x9f]"
#: The characters of (?U)\\s.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
URL = "https?://\\S+|www\\.\\S+"
NUMBER = "(?U)(?<![\\p{L}\\p{N}_])(?:\\p{Nd}[\\p{Nd}\\s-]{6,}\\p{Nd})(?![\\p{L}\\p{N}_])"
RUN = "(?U)(?<!\\S)(\\S+)(?:\\s+\\1){5,}(?!\\S)"
LINE_BREAKS = "[\\n\\r\\u2028\\u2029]+"
ARABIC_DIGITS = "".join(chr(c + k) for c in (0x660, 0x6F0) for k in range(10))
MIN_CHARS, MIN_WORDS, MAX_SYMBOLS, MAX_REPETITION, MIN_QUALITY = 200, 20, 0.3, 0.5, 0.5


def _normal_form(form: str):
    @F.arrow_udf("string")
    def apply(s: pa.Array) -> pa.Array:
        return pa.array([x if x is None or unicodedata.is_normalized(form, x) else unicodedata.normalize(form, x) for x in s.to_pylist()], pa.string())

    return apply


def normal_form(text: Column, form: str = "NFC") -> Column:
    """Unicode normal form; Spark has no builtin, so this is the one Arrow UDF of the cleaning chain.

    A text below U+0300 is its own NFC and isn't sent to Python.
    """
    if form != "NFC":
        return _normal_form(form)(text)
    return F.coalesce(_normal_form(form)(F.when(text.rlike("[^\\x00-\\u02ff]"), text)), text)


def strip_controls(text: Column) -> Column:
    """Control characters but TAB, LF and CR go."""
    return F.regexp_replace(text, CONTROL, "")


def fold_digits(text: Column) -> Column:
    return F.translate(text, ARABIC_DIGITS, "01234567890123456789")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACES))


def persian_letters(text: Column) -> Column:
    """Arabic yeh and kaf become Persian, tatweel goes, runs of zero-width non-joiners become one."""
    return F.regexp_replace(F.translate(text, "يكـ", "یک"), "‌{2,}", "‌")


#: Script rules by profile name; unknown names are ignored.
RULES = {
    "persian_yeh_kaf": persian_letters,
    "sorani_arabic": persian_letters,
    "arabic_presentation_forms": lambda c: normal_form(c, "NFKC"),
    "kurdish_latin": strip_controls,
    "welsh_digraphs": lambda c: c,
}


def normalize(text: Column, form: str | None = "NFC", digits: bool = False, rules: tuple[str, ...] = ()) -> Column:
    """Normal form, controls, digits, script rules, then blanks; null becomes the empty text."""
    out = F.coalesce(text, F.lit(""))
    out = strip_controls(normal_form(out, form) if form else out)
    out = fold_digits(out) if digits else out
    for name in rules:
        out = RULES[name](out) if name in RULES else out
    out = F.regexp_replace(F.regexp_replace(out, "[ \\t]+", " "), "\\n{3,}", "\n\n")
    return strip(out)


def canonical(text: Column) -> Column:
    """The form in which equal texts are duplicates."""
    return F.regexp_replace(strip(F.lower(text)), "(?U)\\s+", " ")


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def blank_words(text: Column) -> Column:
    """Words separated by white space, as an array."""
    return F.array_remove(F.split(text, "(?U)\\s+"), "")


def symbol_ratio(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOL)) / F.greatest(F.length(text), F.lit(1))


def repetition_ratio(text: Column) -> Column:
    """1 - distinct / all stripped lines with text; 0 for one line or none."""
    lines = F.array_remove(F.transform(F.split(text, LINE_BREAKS), strip), "")
    return F.when(F.size(lines) <= 1, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(lines)) / F.size(lines))


def quality_score(symbols: Column, repetition: Column, max_symbols: float = MAX_SYMBOLS) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 * (1 - symbols / max_symbols) + 0.5 * (1 - repetition)))


def scrub(text: Column) -> tuple[Column, Column, Column, Column]:
    """Text without personal data, and how many e-mail addresses, URLs and numbers were replaced, in that order."""
    n_email = F.regexp_count(text, F.lit(EMAIL))
    one = F.regexp_replace(text, EMAIL, "[EMAIL]")
    n_url = F.regexp_count(one, F.lit(URL))
    two = F.regexp_replace(one, URL, "[URL]")
    n_num = F.regexp_count(two, F.lit(NUMBER))
    return F.regexp_replace(two, NUMBER, "[NUM]"), n_email.cast("long"), n_url.cast("long"), n_num.cast("long")


def degenerate(text: Column) -> Column:
    """Six or more equal words in a row."""
    return F.coalesce(text, F.lit("")).rlike(RUN)


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, SENTENCE_END), strip), lambda s: s != "")
