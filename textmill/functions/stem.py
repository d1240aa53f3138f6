"""Danish and English stems of token arrays, written from the public descriptions of the algorithms."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

_CACHE = 1 << 17

# fixed values: letters and endings of the Danish Snowball algorithm
_DANISH_VOWELS = "aeiouyæåø"
_DANISH_DOUBLED = "bcdfghjklmnpqrstvwxz"
_DANISH_S_BEFORE = "abcdfghjklmnoprtvyzå"
_DANISH_ENDINGS = (
    "erendes erende hedens ethed erede heden heder endes ernes erens erets ered ende erne eren erer heds enes eres "
    "eret hed ene ere ens ers ets en er es et e s"
).split()
_DANISH_PAIRS = ("gd", "dt", "gt", "kt")
_DANISH_LAST = ("elig", "løst", "lig", "els", "ig")


def _danish_region(word: str) -> int:
    """Start of the part after the first consonant that follows a vowel, at least 3."""
    for i in range(1, len(word)):
        if word[i] not in _DANISH_VOWELS and word[i - 1] in _DANISH_VOWELS:
            return max(3, i + 1)
    return len(word)


def _danish_pair(word: str, region: int) -> str:
    if word[-2:] in _DANISH_PAIRS and len(word) - 2 >= region:
        return word[:-1]
    return word


@lru_cache(maxsize=_CACHE)
def danish_stem(word: str) -> str:
    word = word.lower()
    region = _danish_region(word)
    for ending in _DANISH_ENDINGS:
        if word.endswith(ending) and len(word) - len(ending) >= region:
            if ending != "s":
                word = word[: -len(ending)]
            elif word[-2:-1] and word[-2] in _DANISH_S_BEFORE:
                word = word[:-1]
            break
    word = _danish_pair(word, region)
    if word.endswith("igst") and len(word) - 4 >= region:
        word = word[:-2]
    for ending in _DANISH_LAST:
        if word.endswith(ending) and len(word) - len(ending) >= region:
            word = word[:-1] if ending == "løst" else _danish_pair(word[: -len(ending)], region)
            break
    if len(word) > 3 and word[-1] == word[-2] and word[-1] in _DANISH_DOUBLED:
        word = word[:-1]
    return word


# fixed values: irregular words and endings of the Porter algorithm with its usual extensions
_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
_STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"),
)
_STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""),
)
_STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _consonant(word: str, i: int) -> bool:
    if word[i] in "aeiou":
        return False
    return word[i] != "y" or i == 0 or not _consonant(word, i - 1)


def _shape(word: str) -> str:
    return "".join("c" if _consonant(word, i) else "v" for i in range(len(word)))


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _has_vowel(word: str) -> bool:
    return "v" in _shape(word)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _consonant(word, len(word) - 1)


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return (len(word) >= 3 and shape[-3:] == "cvc" and word[-1] not in "wxy") or (len(word) == 2 and shape == "vc")


def _plural(word: str) -> str:
    if word.endswith("ies") and len(word) == 4:
        return word[:-1]
    for ending, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(ending):
            return word[: -len(ending)] + new
    return word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-3] + ("ie" if len(word) == 4 else "i")
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for ending in ("ed", "ing"):
        if word.endswith(ending) and _has_vowel(word[: -len(ending)]):
            rest = word[: -len(ending)]
            if rest.endswith(("at", "bl", "iz")):
                return rest + "e"
            if _double_consonant(rest):
                return rest if rest[-1] in "lsz" else rest[:-1]
            return rest + "e" if _measure(rest) == 1 and _short_end(rest) else rest
    return word


def _long_ending(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _long_ending(word[:-4] + "al")
    for ending, new in _STEP_2:
        if word.endswith(ending):
            rest = word[: -len(ending)]
            return rest + new if _measure(rest) > 0 else word
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return word


def _third(word: str) -> str:
    for ending, new in _STEP_3:
        if word.endswith(ending):
            rest = word[: -len(ending)]
            return rest + new if _measure(rest) > 0 else word
    return word


def _fourth(word: str) -> str:
    for ending in _STEP_4:
        if word.endswith(ending):
            rest = word[: -len(ending)]
            fits = _measure(rest) > 1 and (ending != "ion" or rest[-1:] in ("s", "t"))
            return rest if fits else word
    return word


def _last_e_and_l(word: str) -> str:
    if word.endswith("e"):
        rest = word[:-1]
        if _measure(rest) > 1 or (_measure(rest) == 1 and not _short_end(rest)):
            word = rest
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@lru_cache(maxsize=_CACHE)
def english_stem(word: str) -> str:
    word = word.lower()
    if word in _IRREGULAR:
        return _IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and len(word) > 2 and _consonant(word, len(word) - 2):
        word = word[:-1] + "i"
    return _last_e_and_l(_fourth(_third(_long_ending(word))))


def _stems(tokens: Column, one) -> Column:
    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        # only the distinct tokens of a batch become Python strings
        known = batch.flatten().dictionary_encode()
        stems = pa.array([None if t is None else one(t) for t in known.dictionary.to_pylist()], pa.string())
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pa.ListArray.from_arrays(offsets, stems.take(known.indices), mask=batch.is_null())

    return run(tokens)


def danish_stems(tokens: Column) -> Column:
    """Stem every token; stems of frequent tokens are kept in a bounded memo per worker, so nothing is joined."""
    return _stems(tokens, danish_stem)


def english_stems(tokens: Column) -> Column:
    return _stems(tokens, english_stem)
