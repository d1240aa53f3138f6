"""Tokens, n-grams inside a row, stop words and sentences as array columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions import fixed
from textmill.functions.expressions import UNICODE, let, matches, strip, sub

# fixed values: separators and contractions of the public treebank word tokenizer
_COMMA = r"([:,])([^0-9])"
_SEPARATORS = ';@#$%&[](){}<>"`«»“”„‘’'
_LONG_SEPARATORS = r"\.\.\.|--"
_CONTRACTIONS = r"([^' ])('ll|'re|'ve|n't|'s|'m|'d) "
_KEPT = r"[^\p{L}\p{N}_!?\s\p{Z}]+"
_SPACES = r"[\s\p{Z}]+"


def _separate(text: Column) -> Column:
    text = F.regexp_replace(text, _COMMA, " $2")
    text = F.regexp_replace(F.translate(text, _SEPARATORS, " " * len(_SEPARATORS)), _LONG_SEPARATORS, " ")
    text = F.concat(F.lit(" "), text, F.lit(" "))
    # the test for an apostrophe is far cheaper than the pattern
    text = F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, _CONTRACTIONS, "$1 $2 ")).otherwise(text)
    return F.regexp_replace(text, r"([?!])", " $1 ")


def word_tokens(text: Column) -> Column:
    """Word tokens, cleaned of punctuation, digit runs and outer underscores; `?` and `!` stay.

    The clean-up runs on the whole text before it is split, so no lambda runs per token. Patterns
    start with the rare character and look back, so most positions fail at once.
    """
    text = F.regexp_replace(_separate(text), UNICODE + _KEPT, "")
    text = sub(text, r"\d+(?:_(?!\S))?|_(?:(?<!\S_)|(?!\S))")
    text = sub(text, r"_(?:(?<!\S_)|(?!\S))")
    return F.array_remove(F.split(text, UNICODE + _SPACES), "")


def clean_tokens(tokens: Column) -> Column:
    """The same clean-up for tokens that are already an array."""
    kept = F.filter(
        F.transform(tokens, lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_!?]+", "")),
        lambda t: ~matches(t, r"^\d*$"),
    )
    stripped = F.transform(
        kept, lambda t: sub(sub(t, r"^_|(\d)+(_$|)|_\W|\W_|_$"), r"^_|_$")
    )
    return F.array_remove(stripped, "")


def raw_tokens(text: Column) -> Column:
    return F.array_remove(F.split(_separate(text), UNICODE + _SPACES), "")


def everygrams(tokens: Column, longest: int) -> Column:
    """All runs of 1..longest tokens joined by an underscore, shorter runs first."""

    def runs(items: Column, length: int) -> Column:
        return F.when(
            F.size(items) >= length,
            F.transform(
                F.sequence(F.lit(1), F.size(items) - (length - 1)),
                lambda start: F.array_join(F.slice(items, start, length), "_"),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return let(tokens, lambda items: F.concat(*[runs(items, n) for n in range(1, longest + 1)]))


def tokenize(text: Column, n_gram: int = 1) -> Column:
    """Tokens of a text; with n_gram > 1 all runs up to that length, joined before the clean-up."""
    if n_gram == 1:
        return word_tokens(text)
    return clean_tokens(everygrams(raw_tokens(text), n_gram))


def distinct_tokens(tokens: Column) -> Column:
    return F.array_distinct(tokens)


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, ", ")


def split_tokens(text: Column) -> Column:
    """Split at commas only: the blank after a comma stays with the next token."""
    return F.split(text, ",")


def stopwords(extra: Iterable[str] = (), domain: bool = True, phrases: bool = True) -> tuple[str, ...]:
    """The de-duplicated stop list; `extra` takes further lists, e.g. read by `sources.files.word_list`."""
    collected = set(fixed.DANISH_STOPWORDS) | set(extra)
    if domain:
        collected |= set(fixed.DOMAIN_STOPWORDS)
    if phrases:
        collected |= set(fixed.PHRASE_STOPWORDS)
    return tuple(sorted(collected))


def remove_stopwords(tokens: Column, stop: Iterable[str]) -> Column:
    """Drop tokens that equal a stop word or a whole stop phrase; duplicates of others stay."""
    listed = list(stop)
    return F.filter(tokens, lambda t: ~t.isin(listed))


def longer_tokens(tokens: Column, stop: Iterable[str], minimum: int = 4) -> Column:
    """Tokens outside the stop list with at least `minimum` characters."""
    listed = list(stop)
    return F.filter(tokens, lambda t: ~t.isin(listed) & (F.length(t) >= minimum))


def keep_listed(tokens: Column, listed: Iterable[str]) -> Column:
    """Keep only tokens of a list of bounded size, in order."""
    values = list(listed)
    return F.filter(tokens, lambda t: t.isin(values))


def skip_pairs(tokens: Column) -> Column:
    """Neighbour pairs, then first and third of each run of three, then of each run of four."""

    def pairs(items: Column) -> Column:
        def take(run: int, distance: int) -> Column:
            return F.when(
                F.size(items) >= run,
                F.transform(
                    F.sequence(F.lit(0), F.size(items) - run),
                    lambda i: F.struct(
                        F.get(items, i).alias("first"), F.get(items, i + distance).alias("second")
                    ),
                ),
            ).otherwise(F.array().cast("array<struct<first:string,second:string>>"))

        return F.concat(take(2, 1), take(3, 2), take(4, 2))

    return let(tokens, pairs)


def normalise_sentences(text: Column) -> Column:
    """Blanks, line ends after question marks, and dates, before sentences are split."""
    for pattern, replacement in fixed.SENTENCE_NORMALISE:
        text = sub(text, pattern, replacement)
    return text


def split_sentences(text: Column) -> Column:
    """Lines, without outer periods, split at periods; empty lines go, empty pieces stay."""
    lines = F.array_remove(F.transform(F.split(text, "\n"), strip), "")
    pieces = F.transform(lines, lambda line: F.split(F.regexp_replace(line, r"^\.+|\.+\z", ""), r"\."))
    return F.transform(F.flatten(pieces), strip)


def sentence_tokens(text: Column) -> Column:
    """Tokens per sentence; sentences without tokens go."""
    return F.filter(F.transform(split_sentences(text), word_tokens), lambda t: F.size(t) > 0)


def _first_tag(sentence: Column, table: Iterable[tuple[str, str]]) -> Column:
    tag = None
    for pattern, label in table:
        test = matches(sentence, rf"^(?:{pattern})")
        tag = F.when(test, label) if tag is None else tag.when(test, label)
    return tag.otherwise("CONTENT")


def tag_sentences(sentences: Column, table=fixed.SENTENCE_TAGS, after_ending: bool = True) -> Column:
    """Array of (pos, sentence, tag); what follows the first ENDING is AFTER ENDING.

    The state stays inside the row, so tagging needs no shuffle.
    """
    tagged = F.transform(
        sentences,
        lambda s: let(
            strip(F.lower(s)),
            lambda low: F.struct(low.alias("sentence"), _first_tag(low, table).alias("tag")),
        ),
    )

    def finish(items: Column) -> Column:
        ending = F.array_position(F.transform(items, lambda x: x["tag"]), "ENDING")

        def with_state(end: Column) -> Column:
            late = (end > 0) & F.lit(after_ending)
            return F.transform(
                items,
                lambda x, i: F.struct(
                    i.alias("pos"),
                    x["sentence"].alias("sentence"),
                    F.when(late & (i + 1 > end), F.lit("AFTER ENDING")).otherwise(x["tag"]).alias("tag"),
                ),
            )

        return let(ending, with_state)

    return let(tagged, finish)
