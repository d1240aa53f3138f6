"""Building blocks of the DuckDB statements, written without look-around."""

from __future__ import annotations

from collections.abc import Iterable

SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
WORD = r"[\p{L}\p{N}_]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def replaced(expression: str, pattern: str, replacement: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expression}, {quoted(pattern)}, {quoted(replacement)}, '{flags}')"


def stripped(expression: str) -> str:
    return replaced(expression, rf"^{SPACE}+|{SPACE}+$")


def split_words(expression: str) -> str:
    return f"list_filter(regexp_split_to_array({expression}, {quoted(SPACE + '+')}), lambda w: w <> '')"


def separated(expression: str) -> str:
    text = replaced(expression, r"([:,])([^0-9])", r" \2")
    text = replaced(text, r"""\.\.\.|--|[;@#$%&\[\](){}<>"`«»“”„‘’]""", " ")
    text = replaced(f"(' ' || {text} || ' ')", r"([^' ])('ll|'re|'ve|n't|'s|'m|'d) ", r"\1 \2 ")
    return replaced(text, r"([?!])", r" \1 ")


def cleaned_tokens(tokens: str) -> str:
    kept = f"list_transform({tokens}, lambda t: {replaced('t', r'[^\p{L}\p{N}_!?]+')})"
    kept = f"list_filter({kept}, lambda t: not regexp_full_match(t, {quoted(r'\p{Nd}*')}))"
    body = replaced("t", r"^_|(\p{Nd})+(_$|)|_[!?]|[!?]_|_$")
    body = replaced(body, r"^_|_$")
    return f"list_filter(list_transform({kept}, lambda t: {body}), lambda t: t <> '')"


def raw_tokens(expression: str) -> str:
    return split_words(separated(expression))


def tokens(expression: str) -> str:
    """Cleaned word tokens of a text, token by token."""
    return cleaned_tokens(raw_tokens(expression))


def ascii_shape(expression: str) -> str:
    """A copy of the same length in which other letters are q and other spaces are blanks.

    On it, word boundaries and classes mean the same with and without Unicode rules. The Danish
    letters stay, since the patterns name them.
    """
    letters = replaced(expression, r"[^\x00-\x7Fæøå\P{L}]|[^\x00-\x7F\P{N}]", "q")
    return replaced(letters, r"[^\x00-\x7F\P{Z}]|[\x0b\x1c-\x1f\x{85}]", " ")
