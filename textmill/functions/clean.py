"""Cleaning steps for messages, each a Column -> Column function."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import fixed, rules
from textmill.functions.expressions import UNICODE, collapse_spaces, strip, sub
from textmill.functions.html import html_text
from textmill.functions.rulechain import rule_chain


def strip_leading_newline(text: Column) -> Column:
    return sub(text, r"^\n")


def strip_greeting(text: Column, pattern: str = fixed.GREETING) -> Column:
    """Remove a greeting and up to four name words from the start."""
    return sub(text, pattern)


def cut_at_sign_off(text: Column) -> Column:
    """Keep what stands before the first sign-off; later lines go as well.

    All sign-offs start with two of the letters looked ahead at, which rules out most positions.
    """
    return F.get(F.split(text, UNICODE + r"(?=[bdhkmrsvw][ehi])" + fixed.SIGN_OFF, 2), F.lit(0))


def cut_at_sign_off_older(text: Column) -> Column:
    """Cut where the text of the first sign-off line is first found, then trim."""
    found = F.regexp_extract(text, UNICODE + "(" + fixed.SIGN_OFF_OLDER + ".*)", 1)
    cut = strip(F.substr(text, F.lit(1), F.position(found, text) - 1))
    return F.when(found != "", cut).otherwise(text)


def drop_through_thanks(text: Column) -> Column:
    return sub(text, fixed.THANKS_FOR)


def drop_closing(text: Column) -> Column:
    return sub(sub(text, fixed.CLOSING_TO_LINE_END), fixed.CLOSING_WISHES)


def dots_after_letters(text: Column) -> Column:
    """A period after a letter or underscore becomes an underscore (found by the period, then looking back)."""
    return sub(text, r"\.(?<=[^\d\W]\.)", "_")


def dots_in_numbers(text: Column) -> Column:
    """A period between digits goes, if two word characters stand before it."""
    return sub(text, r"\.(?<=[^\W]\d\.)(?=\d)")


def drop_dots_and_exclamations(text: Column) -> Column:
    return F.translate(text, ".!", "")


def remove_addresses(text: Column) -> Column:
    return native_chain(text, rules.ADDRESSES)


def remove_email(text: Column) -> Column:
    return sub(text, rules.EMAIL)


def remove_system_phrases(text: Column) -> Column:
    return native_chain(text, rules.SYSTEM_PHRASES)


def remove_short_words(text: Column) -> Column:
    """Remove words of one or two characters."""
    return sub(text, r"\b\w{1,2}\b")


def native_chain(text: Column, table: Iterable[tuple[str, str]]) -> Column:
    """Fold a short rule table into nested regexp_replace calls; long tables use `rule_chain`."""
    for pattern, replacement in table:
        text = sub(text, pattern, replacement)
    return text


def replace_literals(text: Column, table: Iterable[tuple[str, str]] = fixed.LITERALS) -> Column:
    """Replace fixed strings in order, anywhere in the text."""
    for old, new in table:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def replace_keywords(text: Column, keywords: Mapping[str, Iterable[str]] = fixed.KEYWORDS) -> Column:
    """Replace whole-word variants by their canonical term in one pass, longest variant first."""
    canonical = {variant.lower(): term for term, variants in keywords.items() for variant in variants}
    ordered = sorted(canonical, key=lambda variant: (-len(variant), variant))
    quoted = "|".join(rf"\Q{variant}\E" for variant in ordered)
    pattern = rf"(?iu)(?<![A-Za-z0-9_])(?:{quoted})(?![A-Za-z0-9_])"
    table = F.create_map(*[F.lit(part) for pair in canonical.items() for part in pair])
    terms = F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hit: F.element_at(table, F.lower(hit))
    )
    pieces = F.split(text, pattern, -1)
    return F.array_join(
        F.zip_with(pieces, terms, lambda piece, term: F.concat(piece, F.coalesce(term, F.lit("")))), ""
    )


def non_ascii_words(text: Column) -> Column:
    """The blank-separated words that hold a character outside ASCII."""
    return F.filter(F.split(text, " "), lambda word: word.rlike(r"[^\x00-\x7F]"))


def mark_non_ascii_words(text: Column, mark: str = fixed.NON_ASCII_MARK) -> Column:
    marked = F.transform(
        F.split(text, " "), lambda word: F.when(word.rlike(r"[^\x00-\x7F]"), F.lit(mark)).otherwise(word)
    )
    return F.array_join(marked, " ")


def clean_simple(text: Column) -> Column:
    """Lower case, greeting, sign-off, dots and exclamation marks: the training path."""
    text = strip_leading_newline(F.lower(text))
    text = strip_leading_newline(strip_greeting(text))
    text = dots_in_numbers(dots_after_letters(cut_at_sign_off(text)))
    return drop_dots_and_exclamations(text)


def clean_full(text: Column, mode: str = "sequential") -> Column:
    """All cleaning steps; the three long rule tables run in one Arrow pass."""
    tables = (rules.ABBREVIATIONS, rules.KEY_CONCEPTS, rules.LEMMAS)
    text = rule_chain(html_text(text), tables, mode, lower=True)
    text = strip_leading_newline(strip_greeting(strip_leading_newline(text)))
    text = cut_at_sign_off(dots_in_numbers(dots_after_letters(text)))
    text = drop_closing(drop_through_thanks(text))
    text = remove_system_phrases(remove_addresses(text))
    return strip(strip_leading_newline(text))


def _legacy_text(text: Column) -> Column:
    text = F.lower(strip(html_text(text)))
    return strip_leading_newline(cut_at_sign_off_older(strip_greeting(text, fixed.GREETING_OLDER)))


def _legacy_words(text: Column, literals: Iterable[tuple[str, str]]) -> Column:
    text = replace_literals(collapse_spaces(text), literals)
    return remove_short_words(remove_email(text))


def clean_legacy(text: Column) -> Column:
    """The older preparation: HTML, greeting, sign-off, white space, literals, addresses, short words."""
    return _legacy_words(_legacy_text(text), fixed.LITERALS_OLDER)


def clean_serving(text: Column) -> Column:
    """Text part of the single-message path: no-break spaces go; tokens, stop words and stems follow."""
    return _legacy_words(F.translate(_legacy_text(text), "\u00a0", ""), fixed.LITERALS)
