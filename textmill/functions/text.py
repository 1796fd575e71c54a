"""Column functions that cut, clean and reshape text."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points of Unicode white space (the regex class \s covers ASCII only).
SPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
SPACE_CHARS = "".join(map(chr, SPACE_CODES))
SPACE = f"[{SPACE_CHARS}]"
# Characters a word consists of, and quotation marks that part words.
WORD_CHARS = r"\p{L}\p{N}_"
QUOTES = "«»“”‘’„"
# A word that may hold full stops, but not at its ends.
WORD_RUN = r"[\p{L}\p{N}](?:[\p{L}\p{N}.-]*[\p{L}\p{N}])?"
# Words the word tokenizer breaks in two (can|not, gon|na, ...).
SPLIT_WORDS = r"(?U)(?=[cglw])\b(can(?=not\b)|gon(?=na\b)|got(?=ta\b)|gim(?=me\b)|lem(?=me\b)|wan(?=na\b))"
# Suffix rules for English nouns, (ending, replacement).
NOUN_ENDINGS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_sentences(text: Column | str, abbreviations: list[str] | None = None) -> Column:
    """Array of sentences: cut at white space between `.`, `!` or `?` and an upper-case letter.

    With `abbreviations` (lower case, without the last full stop) there is no cut behind one of them.
    """
    if not abbreviations:
        return F.split(_col(text), rf"(?<=[.!?]){SPACE}+(?=\p{{Lu}})")
    mark = chr(0xFDD0)  # no character: it does not occur in text

    def glued(parts: Column) -> Column:
        def lead(i: Column) -> Column:
            last = F.lower(F.regexp_extract(F.get(parts, i - 1), rf"({WORD_RUN})\.$", 1))
            return F.when((i == 0) | ((last != "") & last.isin(abbreviations)), "").otherwise(mark)
        return F.array_join(F.transform(parts, lambda p, i: F.concat(lead(i), p)), "")
    # The cuts keep their white space, so that what is glued is as it was.
    joined = bind(F.split(_col(text), rf"(?<=[.!?])(?={SPACE}+\p{{Lu}})"), glued)
    return F.split(F.regexp_replace(joined, f"{mark}{SPACE}+", mark), mark)


def stopped_words(text: Column | str) -> Column:
    """Array of (word, stop) for each white-space separated token that is a word: lower case, without outer
    punctuation, and whether a full stop follows."""
    spaced = F.translate(_col(text), SPACE_CHARS, " " * len(SPACE_CHARS))
    shape = rf"^[(\[\"']*({WORD_RUN})(\.?)[)\]\"',;:]*$"
    words = F.transform(F.split(spaced, " "), lambda t: F.struct(
        F.lower(F.regexp_extract(t, shape, 1)).alias("word"), (F.regexp_extract(t, shape, 2) == ".").alias("stop")))
    return F.filter(words, lambda w: w["word"].rlike(r"\p{L}"))


def lowercase(text: Column | str) -> Column:
    return F.lower(_col(text))


def strip_punctuation(text: Column | str) -> Column:
    """Delete the ASCII punctuation characters (no space is left in their place)."""
    return F.translate(_col(text), string.punctuation, "")


def _pieces(text: Column | str, delete: str = "") -> Column:
    # One translation serves white space, quotes and the characters to delete; a split at
    # a plain space is cheaper than one at a character class and leaves only empty pieces.
    blank = SPACE_CHARS + QUOTES
    spaced = F.translate(_col(text), blank + delete, " " * len(blank))
    return F.split(F.regexp_replace(spaced, SPLIT_WORDS, "$1 "), " ")


def word_tokens(text: Column | str) -> Column:
    """Split at white space and typographic quotes; break `cannot`, `gonna`, ... in two."""
    return F.filter(_pieces(text), lambda t: t != "")


def alpha_tokens(tokens: Column | str) -> Column:
    """Keep tokens made of letters only."""
    return F.filter(_col(tokens), lambda t: t.rlike(r"^\p{L}+$"))


def stop_words(language: str = "english") -> list[str]:
    """Spark's stop-word list."""
    return StopWordsRemover.loadDefaultStopWords(language)


def remove_stop_words(tokens: Column | str, words: list[str] | None = None) -> Column:
    """Drop stop words, keeping repeats of the other tokens."""
    stop = stop_words() if words is None else words
    return F.filter(_col(tokens), lambda t: ~t.isin(stop))


def join_tokens(tokens: Column | str) -> Column:
    return F.array_join(_col(tokens), " ")


def normal_tokens(text: Column | str, words: list[str] | None = None) -> Column:
    """The whole normaliser but for lemmas: lower case, no punctuation, letters-only
    tokens, no stop words."""
    stop = stop_words() if words is None else words
    # One pass over the array; the cheap set lookup runs before the regex.
    return F.filter(
        _pieces(lowercase(text), delete=string.punctuation),
        lambda t: ~t.isin(stop) & t.rlike(r"^\p{L}+$"),
    )


def lemma_candidates(term: Column | str) -> Column:
    """Array of the term itself and every form that one noun suffix rule yields."""
    c = _col(term)
    forms = [
        F.when(c.endswith(end), F.concat(c.substr(F.lit(1), F.length(c) - len(end)), F.lit(new)))
        for end, new in NOUN_ENDINGS
    ]
    return F.array_compact(F.array(c, *forms))


def terms_whitespace(text: Column | str) -> Column:
    """White-space separated terms."""
    spaced = F.translate(_col(text), SPACE_CHARS, " " * len(SPACE_CHARS))
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def terms_word2(text: Column | str) -> Column:
    """Lower-case words of at least two word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(f"([{WORD_CHARS}]{{2,}})"), F.lit(1))


def bind(value: Column, make) -> Column:
    """`make(value)` with `value` evaluated once, however often `make` uses it."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def term_counts(terms: Column | str) -> Column:
    """Array of (term, n) of one row, without a shuffle: sort the terms, then measure runs."""
    def run_starts(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1)).otherwise(
            F.array().cast("array<int>"))
        return F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(starts, lambda s, i: F.struct(
            F.get(ordered, s).alias("term"),
            (F.coalesce(F.get(starts, i + 1), F.size(ordered)) - s).cast("long").alias("n")))

    return bind(F.sort_array(_col(terms)),
                lambda ordered: bind(run_starts(ordered), lambda starts: runs(ordered, starts)))


def trim_space(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(SPACE_CHARS))


def split_semicolons(text: Column | str) -> Column:
    """Trimmed, non-blank parts of `;`-separated input."""
    parts = F.transform(F.split(_col(text), ";"), trim_space)
    return F.filter(parts, lambda p: p != "")


def parse_annotations(reply: Column | str) -> Column:
    """Array with one trimmed label list for each non-blank line of an annotator's reply."""
    lines = F.transform(F.split(trim_space(reply), "\n"), trim_space)
    return F.transform(
        F.filter(lines, lambda line: line != ""),
        lambda line: F.transform(F.split(line, ","), trim_space),
    )


# The named XML references.
NAMED_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|lt|gt|quot|apos|amp);"
_CDATA = r"(?s)<!\[CDATA\[.*?\]\]>"


def _woven(text: Column, pattern: str, between: Callable, match: Callable) -> Column:
    """The text with `match` of every match of the pattern and `between` of every part between them."""
    def weave(parts: Column, found: Column) -> Column:
        return F.array_join(F.transform(parts, lambda p, i: F.concat(between(p), F.coalesce(match(F.get(found, i)), F.lit("")))), "")
    flags, body = ("(?s)", pattern[4:]) if pattern.startswith("(?s)") else ("", pattern)
    return bind(F.split(text, pattern, -1), lambda parts: bind(
        F.regexp_extract_all(text, F.lit(f"{flags}({body})"), F.lit(1)), lambda found: weave(parts, found)))


def decode_references(text: Column | str) -> Column:
    """Decode named and numeric XML references, each once: what a reference yields is not decoded again."""
    def sign(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"([0-9A-Fa-f]+);", 1)
        code = F.when(ref.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        # Four bytes, big-endian, are the sign in UTF-32.
        decoded = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        named = F.coalesce(*[F.when(ref == k, F.lit(v)) for k, v in NAMED_REFERENCES.items()])
        return F.when(~ref.startswith("&#"), named).when(valid, decoded).otherwise(ref)
    return _woven(_col(text), _REFERENCE, lambda p: p, sign)


def markup_text(markup: Column | str) -> Column:
    """The text of an XML fragment: without tags and comments, references decoded, CDATA sections as they stand."""
    def plain(part: Column) -> Column:
        return decode_references(F.regexp_replace(part, r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>", ""))
    return _woven(_col(markup), _CDATA, plain, lambda c: F.substring(c, 10, F.length(c) - 12))


def sigmoid(z: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(z)))
