import random
import re

import pytest
from pyspark.sql import functions as F

from textmill.functions import clean, expressions, fixed, html, rulechain, rules


def texts(seed=1, n=300):
    """Invented messages from fragments that touch the patterns."""
    pick = random.Random(seed)
    parts = [
        "hej anna,", "kære bo ib holm ask", "dear sir or madam", "hvor er mit kort?", "venlig hilsen bo", "kind regards",
        "på forhånd tak", "mange tak for hjælpen", "god weekend", "jeg har fået 1.250.000 kr.", "se www.eks.dk nu.", "12.34.5",
        "a1.2.3", "før æble", "mdr. 3", "ang. mødet, ca. 3 t. pr. uge", "dvs. 5 mdr. i dk", "\n", "\n\n", " ", "til mødet",
        "arbejdet, betaling.", "du har fået brev", "medlemmer. sendte, udbetaling", "14 dage", "skriv til bo@eks.dk",
        "http://eks.dk/a?b=1", "kontrakten ", "min praktikplads ", "tillægget ", "vh", "ok!", "vi ses", "aps", "uger",
    ]
    return ["".join(pick.choice(parts) + pick.choice(["", " ", "\n"]) for _ in range(pick.randint(0, 8))) for _ in range(n)]


def test_rule_tables_have_their_sizes():
    assert {k: len(v) for k, v in rules.RULE_SETS.items()} == {
        "abbreviations": 38, "system_phrases": 4, "key_concepts": 80, "lemmas": 177, "addresses": 2,
    }


def test_required_prefix_is_in_every_match():
    probes = texts(2) + [r for table in rules.RULE_SETS.values() for _, r in table]
    probes += [" ".join(re.findall(r"\w+", p)) + ". " for table in rules.RULE_SETS.values() for p, _ in table]
    known = 0
    for table in rules.RULE_SETS.values():
        for pattern, _ in table:
            needed = rulechain.required_prefix(pattern)
            known += bool(needed)
            for text in probes:
                for found in re.finditer(pattern, text):
                    assert needed in found.group(0), (pattern, needed)
    assert known > 150


def test_chain_equals_plain_substitution():
    for table in (rules.ABBREVIATIONS, rules.KEY_CONCEPTS, rules.LEMMAS):
        compiled = rulechain.compile_rules(table)
        for text in texts(3, 100):
            plain, entered, masked = text, text, text
            for pattern, replacement in table:
                plain = re.sub(pattern, replacement, plain)
                if re.search(pattern, entered):
                    masked = re.sub(pattern, replacement, masked)
            assert rulechain.apply_rules(text, compiled, masked=False) == plain
            assert rulechain.apply_rules(text, compiled, masked=True) == masked


def test_chain_modes(column):
    first, second = (("a", "x"), ("x", "y")), (("a", "bb"), ("b", "c"))
    chain = lambda table, mode: lambda c: rulechain.rule_chain(c, (table,), mode)
    assert column(["ab", None], chain(first, "sequential")) == ["yb", None]
    assert column(["ab"], chain(first, "masked")) == ["xb"]
    assert column(["ab"], chain(second, "sequential")) == column(["ab"], chain(second, "masked")) == ["ccc"]
    with pytest.raises(ValueError):
        rulechain.rule_chain(F.lit("a"), (), "other")


def test_native_rules_equal_python_rules(spark):
    """Every rule alone, in the JVM and in Python, on the same texts."""
    tables = [*rules.RULE_SETS.values(), fixed.LITERALS_REGEX, fixed.SENTENCE_NORMALISE]
    every = [rule for table in tables for rule in table]
    given = texts(6, 60)
    df = spark.createDataFrame([(t,) for t in given], "v string").coalesce(1)
    for start in range(0, len(every), 60):
        part = every[start : start + 60]
        rows = df.select(F.array(*[expressions.sub(F.col("v"), p, r) for p, r in part]).alias("out")).collect()
        for text, row in zip(given, rows):
            assert row.out == [re.sub(p, r, text) for p, r in part]


@pytest.mark.parametrize(
    "function,plain",
    [
        (clean.strip_greeting, lambda t: re.sub(fixed.GREETING, "", t)),
        (clean.cut_at_sign_off, lambda t: re.split(fixed.SIGN_OFF + ".*", t)[0]),
        (clean.dots_after_letters, lambda t: re.sub(r"(?<=[^\d\W])\.", "_", t)),
        (clean.dots_in_numbers, lambda t: re.sub(r"(?<=[^\W]\d)\.(?=\d)", "", t)),
        (clean.drop_through_thanks, lambda t: re.sub(fixed.THANKS_FOR, "", t)),
        (clean.remove_email, lambda t: re.sub(rules.EMAIL, "", t)),
        (clean.remove_short_words, lambda t: re.sub(r"\b\w{1,2}\b", "", t)),
        (clean.collapse_spaces, lambda t: " ".join(t.split())),
        (clean.drop_dots_and_exclamations, lambda t: re.sub(r"[\.!]", "", t)),
    ],
)
def test_native_steps_equal_python_patterns(column, function, plain):
    given = texts(4)
    assert column(given, function) == [plain(t) for t in given]


def test_simple_clean_equals_python(column):
    def plain(text):
        text = re.sub(r"^\n", "", re.sub(fixed.GREETING, "", re.sub(r"^\n", "", text.lower())))
        text = re.split(fixed.SIGN_OFF + ".*", text)[0]
        text = re.sub(r"(?<=[^\W]\d)\.(?=\d)", "", re.sub(r"(?<=[^\d\W])\.", "_", text))
        return re.sub(r"[\.!]", "", text)

    given = texts(5) + [None]
    assert column(given, clean.clean_simple) == [plain(t) for t in given[:-1]] + [None]


def test_older_sign_off(column):
    given = ["see attached\nkind regards\nbo\nline 4", "jeg spørger. mvh bo", "mvh", "intet her "]
    assert column(given, clean.cut_at_sign_off_older) == ["see attached", "jeg spørger.", "", "intet her "]


def test_greeting_in_the_middle_stays(column):
    assert column(["vi ses alle til mødet"], clean.strip_greeting) == ["vi ses alle til mødet"]


def test_keywords_take_the_longest_variant_once(column):
    table = {"jeg_har": ("jeg har",), "jeg": ("jeg_har", "mig"), "hej": ("hej,",)}
    given = ["Jeg har det, mig!", "hej, du", "hej,du", "xjeg har"]
    assert column(given, lambda c: clean.replace_keywords(c, table)) == [
        "jeg_har det, jeg!", "hej du", "hej,du", "xjeg har",
    ]


def test_non_ascii(column):
    assert column(["en ø og å"], clean.non_ascii_words) == [["ø", "å"]]
    assert column(["en ø og å"], clean.mark_non_ascii_words) == ["en qwerty og qwerty"]


def test_literals_run_in_order(column):
    given = ["vedr. mdr.s att: ", "m.m. ph.d. att.: re: bh.", " re  d. mdr"]

    def plain(text):
        for old, new in fixed.LITERALS:
            text = text.replace(old, new)
        return text

    assert column(given, clean.replace_literals) == [plain(t) for t in given]


def test_html(column):
    given = ["<p>a</p><p>b &amp; c</p><!-- x --><script>s()</script>", "plain", None]
    assert column(given, html.html_text) == ["a.\nb & c", "plain", None]
    assert column(given[:1], lambda c: html.html_text(c, keep_code=True)) == ["a.\nb & cs()"]
    entities = ["&#230;&#xE5;&#128512;", "&amp;lt; &unknown; &oslash", "a < b &nbsp;c", "<STYLE x>p{}</style >t<!-- <b> -->", "&#0;&#xD800;"]
    assert column(entities, html.html_text) == ["æå😀", "&lt; &unknown; &oslash", "a < b \xa0c", "t", "\ufffd\ufffd"]


def test_full_clean_runs_all_steps(column):
    given = ["<p>Hej Anna,</p>\nAng. mødet, har i modtaget dokumentationen. Mvh Bo", None]
    full = column(given, clean.clean_full)
    assert full[1] is None
    assert full[0] == ",\nangående møde, har i modtage dokumentation_"


def test_legacy_and_serving(column):
    given = ["<p>Hej Anna</p> jeg skriver ang. kortet\nmvh Bo", None]
    legacy = column(given, clean.clean_legacy)
    assert legacy[1] is None and "angående" in legacy[0] and "bo" not in legacy[0].split()
    assert column(["et\u00a0ord der her"], clean.clean_serving) == ["etord der her"]
    assert column(["et\u00a0ord der her"], clean.clean_legacy) == [" ord der her"]
