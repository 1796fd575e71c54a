"""Column functions that find, label and hide keywords."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import WORD_CHARS, _col

OTHER = "Other"
# Separates labels inside one string while they are gathered; not allowed in a label.
MARK = chr(1)
# The dotted capital I, dotless i, long s and Kelvin sign, which a case-blind
# match treats as i, i, s and k.
FOLDS = [(chr(0x130), "i"), (chr(0x131), "i"), (chr(0x17F), "s"), (chr(0x212A), "k")]

# Letters that differ in lower case only, such as the two small sigmas, and the usual one of each.
SAME_UPPER = {c: u for c in map(chr, range(0x80, 0x10000)) if len(u := c.upper().lower()) == len(c.upper()) == 1
              and u != c == c.lower()}


def keyword_pattern(keyword: str) -> str:
    """Case-blind whole-word pattern with Unicode word boundaries.

    A boundary lies between a word character and anything else, so which look-around
    is needed depends on the keyword's own first and last character.
    """
    if not keyword:
        raise ValueError("a keyword must not be empty")
    word = re.compile(r"\w")
    before = "(?<!" if word.match(keyword[0]) else "(?<="
    after = "(?!" if word.match(keyword[-1]) else "(?="
    quoted = r"\Q" + keyword.replace(r"\E", r"\E\\E\Q") + r"\E"
    return f"(?iu){before}[{WORD_CHARS}]){quoted}{after}[{WORD_CHARS}])"


def pattern_column(keyword: Column | str) -> Column:
    """`keyword_pattern` of a keyword that is a column."""
    c = _col(keyword)
    before = F.when(c.rlike(f"^[{WORD_CHARS}]"), "(?<!").otherwise("(?<=")
    after = F.when(c.rlike(f"[{WORD_CHARS}]$"), "(?!").otherwise("(?=")
    quoted = F.replace(c, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    edge = F.lit(f"[{WORD_CHARS}])")
    return F.concat(F.lit("(?iu)"), before, edge, F.lit(r"\Q"), quoted, F.lit(r"\E"), after, edge)


def fold_case(text: Column | str) -> Column:
    """Lower case, with the non-ASCII letters that equal an ASCII one when case is ignored."""
    plain = reduce(lambda c, f: F.replace(c, F.lit(f[0]), F.lit(f[1])), FOLDS, _col(text))
    return F.lower(plain)


def fold_token(text: Column | str) -> Column:
    """A form that is the same for all texts that are equal when case is ignored."""
    return F.translate(fold_case(text), "".join(SAME_UPPER), "".join(SAME_UPPER.values()))


def contains_keyword(text: Column | str, keyword: str) -> Column:
    """Case-blind substring test."""
    return F.lower(_col(text)).contains(F.lower(F.lit(keyword)))


def contains_any(text: Column | str, keywords: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [contains_keyword(text, k) for k in keywords], F.lit(False))


def has_keyword(text: Column | str, keyword: str, folded: Column | None = None) -> Column:
    """Case-blind whole-word test.

    For an ASCII keyword a byte search over the folded text goes first, so the regex only
    runs on rows that hold the keyword somewhere.
    """
    whole = _col(text).rlike(keyword_pattern(keyword))
    if not keyword.isascii():
        return whole
    hay = fold_case(text) if folded is None else folded
    return hay.contains(keyword.lower()) & whole


def found_labels(text: Column | str, pairs: list[tuple[str, str]], folded: Column | None = None) -> Column:
    """Labels of all keywords found, in map order and with repeats, joined by `MARK`."""
    if any(MARK in label for _, label in pairs):
        raise ValueError("labels must not contain U+0001")
    # concat_ws skips the NULLs of keywords that are absent, and stays in generated code.
    return F.concat_ws(MARK, *[F.when(has_keyword(text, k, folded), F.lit(v)) for k, v in pairs])


def label_list(found: Column | str, other: str = OTHER) -> Column:
    """`found_labels` as an array; `[other]` if none."""
    return F.when(_col(found) == "", F.array(F.lit(other))).otherwise(F.split(_col(found), MARK))


def hide_keywords(text: Column | str, keywords: list[str]) -> Column:
    """Remove whole-word keywords one after the other; the spaces around them stay."""
    return reduce(lambda c, k: F.regexp_replace(c, keyword_pattern(k), ""), keywords, _col(text))


def count_keywords(text: Column | str, keywords: list[str]) -> Column:
    """How many substitutions `hide_keywords` makes."""
    total, rest = F.lit(0), _col(text)
    for k in keywords:
        total = total + F.regexp_count(rest, F.lit(keyword_pattern(k)))
        rest = F.regexp_replace(rest, keyword_pattern(k), "")
    return total


def hide_label_names(text: Column | str, labels: list[str]) -> Column:
    """Remove every label name as a substring, as written, in lower and in upper case."""
    forms = [form for label in labels for form in (label, label.lower(), label.upper())]
    return reduce(lambda c, form: F.replace(c, F.lit(form), F.lit("")), forms, _col(text))
