"""Queries on cleaning, tokens, n-grams and sentences."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from textmill.catalog.registry import query
from textmill.catalog.relational import conversations, documents
from textmill.catalog.sql import (
    SPACE,
    WORD,
    ascii_shape,
    cleaned_tokens,
    in_list,
    quoted,
    raw_tokens,
    replaced,
    split_words,
    stripped,
    tokens,
)
from textmill.functions import clean, fixed, html, rulechain, rules, stem
from textmill.functions import tokens as tok
from textmill.functions.expressions import explode_rows, inline_rows
from textmill.operators import eda, ngrams, sentences, vocabulary
from textmill.session import materialise
from textmill.sources.tables import table

# Messages around the given texts, so that greetings, closings and rules have something to match.
OPENINGS = ("Hej Anna Bo,", "Kære Bo Ib Holm", "Dear sir or madam\n", "Hi ", "tak for din mail. ", "")
INSERTS = (
    "\nJeg har sendt mit skema pr. 1.250.000 kr. til aka.dk evt. i 14 dage, medl. nr 7. Kan i hjælpe?",
    "\nSe www.eksempel.dk/a?b=1 eller http://eksempel.dk/side og skriv til bo.holm@eksempel.dk.",
    "\nVedhæft venligst filer om min opsigelse, mdr. 3 og 12.34.5. Håber i kan hjælpe.",
    "\nDu skal logge på selvbetjeningen! Udbetaling Danmark har du fået arbejdsgiver.",
)
CLOSINGS = (
    "\nmange tak for svaret\nMed venlig hilsen\nAnna",
    "\nPå forhånd tak og god weekend. Kind regards Bo",
    "\nmvh Ib\nps: ring 12345678",
    "\nSent from my phone",
    "",
)


def _pick(column, options):
    index = F.pmod(column, F.lit(len(options)))
    return F.get(F.array(*[F.lit(o) for o in options]), index.cast("int"))


def _pick_sql(column, options):
    listed = ", ".join(quoted(o) for o in options)
    return f"([{listed}])[CAST({column} % {len(options)} AS INTEGER) + 1]"


def letters(spark, sf):
    number = F.col("conv_id") + F.col("turn")
    return conversations(spark, sf).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        "role",
        F.concat(_pick(number, OPENINGS), F.col("text"), _pick(number, INSERTS), _pick(number, CLOSINGS)).alias("text"),
    )


LETTERS = f"""(SELECT conv_id * 1000 + turn AS doc_id, role, {_pick_sql('(conv_id + turn)', OPENINGS)} || text
    || {_pick_sql('(conv_id + turn)', INSERTS)} || {_pick_sql('(conv_id + turn)', CLOSINGS)} AS text FROM conversations)"""


def spaced(pattern: str) -> str:
    """A pattern whose classes mean the same without Unicode rules."""
    return (
        pattern.replace(r"\s", SPACE).replace(r"[\w", r"[\p{L}\p{N}_").replace(r"(\w)", f"({WORD})").replace(r"\d", r"\p{Nd}")
    )


def cut_greeting(text: str, greeting: str = fixed.GREETING) -> str:
    return f"substr({text}, length(regexp_extract({ascii_shape(text)}, {quoted(greeting)})) + 1)"


def cut_sign_off(text: str) -> str:
    return replaced(text, f"(?s){spaced(fixed.SIGN_OFF)}.*", "", "")


def number_dots(text: str) -> str:
    marked = replaced(text, rf"({WORD}\p{{Nd}})\.", "\\1\x01")
    return f"replace({replaced(marked, chr(1) + r'(\p{Nd})', r'\1')}, chr(1), '.')"


def letter_dots(text: str) -> str:
    return replaced(text, r"([\p{L}_])\.", r"\1_")


def no_first_newline(text: str) -> str:
    return replaced(text, r"^\n")


def simple_clean_sql(source: str, key: str = "doc_id") -> str:
    steps = [
        no_first_newline("lower(text)"),
        cut_greeting("text"),
        no_first_newline("text"),
        cut_sign_off("text"),
        letter_dots("text"),
        number_dots("text"),
        "translate(text, '.!', '')",
    ]
    statement = f"SELECT {key}, text FROM {source}"
    for step in steps:
        statement = f"SELECT {key}, {step} AS text FROM ({statement})"
    return statement


@query("simple_clean", simple_clean_sql(LETTERS))
def simple_clean(spark, sf):
    return letters(spark, sf).select("doc_id", clean.clean_simple(F.col("text")).alias("text"))


@query("simple_clean_documents", simple_clean_sql("documents"))
def simple_clean_documents(spark, sf):
    return documents(spark, sf).select("doc_id", clean.clean_simple(F.col("text")).alias("text"))


@query("lower_case", "SELECT doc_id, lower(text) AS text FROM documents")
def lower_case(spark, sf):
    return documents(spark, sf).select("doc_id", F.lower("text").alias("text"))


@query(
    "greeting_strip",
    f"SELECT doc_id, {no_first_newline('text')} AS text FROM (SELECT doc_id, {cut_greeting('text')} AS text"
    f" FROM (SELECT doc_id, lower(text) AS text FROM {LETTERS}))",
)
def greeting_strip(spark, sf):
    stripped_text = clean.strip_leading_newline(clean.strip_greeting(F.lower("text")))
    return letters(spark, sf).select("doc_id", stripped_text.alias("text"))


@query("signoff_truncate", f"SELECT doc_id, {cut_sign_off('lower(text)')} AS text FROM {LETTERS}")
def signoff_truncate(spark, sf):
    return letters(spark, sf).select("doc_id", clean.cut_at_sign_off(F.lower("text")).alias("text"))


OLDER_START = f"regexp_extract({ascii_shape('t')}, {quoted('(?s)^(.*?)' + fixed.SIGN_OFF_OLDER)}, 1)"
OLDER_LINE = f"string_split(substr(t, length({OLDER_START}) + 1), chr(10))[1]"


@query(
    "signoff_truncate_older",
    f"""SELECT doc_id, CASE WHEN regexp_matches({ascii_shape('t')}, {quoted(fixed.SIGN_OFF_OLDER)})
    THEN {stripped(f'substr(t, 1, position({OLDER_LINE} IN t) - 1)')} ELSE t END AS text
    FROM (SELECT doc_id, lower(text) AS t FROM {LETTERS})""",
)
def signoff_truncate_older(spark, sf):
    return letters(spark, sf).select("doc_id", clean.cut_at_sign_off_older(F.lower("text")).alias("text"))


CLOSING_SQL = replaced(
    replaced(replaced("lower(text)", spaced(fixed.THANKS_FOR)), spaced(fixed.CLOSING_TO_LINE_END)),
    spaced(fixed.CLOSING_WISHES),
)


@query("closing_strip", f"SELECT doc_id, {CLOSING_SQL} AS text FROM {LETTERS}")
def closing_strip(spark, sf):
    text = clean.drop_closing(clean.drop_through_thanks(F.lower("text")))
    return letters(spark, sf).select("doc_id", text.alias("text"))


@query("number_dots", f"SELECT doc_id, {number_dots(letter_dots('text'))} AS text FROM {LETTERS}")
def number_dots_query(spark, sf):
    text = clean.dots_in_numbers(clean.dots_after_letters(F.col("text")))
    return letters(spark, sf).select("doc_id", text.alias("text"))


ADDRESS_SQL = replaced(replaced("text", spaced(rules.EMAIL)), spaced(rules.URL))


@query(
    "email_url_strip",
    f"SELECT doc_id, {ADDRESS_SQL} AS text FROM {LETTERS} UNION ALL SELECT doc_id, {ADDRESS_SQL} AS text FROM documents",
)
def email_url_strip(spark, sf):
    both = letters(spark, sf).select("doc_id", "text").unionByName(documents(spark, sf).select("doc_id", "text"))
    return both.select("doc_id", clean.remove_addresses(F.col("text")).alias("text"))


def chained_sql(expression, table_of_rules):
    for pattern, replacement in table_of_rules:
        expression = replaced(expression, pattern, replacement)
    return expression


SYSTEM_SQL = chained_sql("lower(text)", [(spaced(p), r) for p, r in rules.SYSTEM_PHRASES[:3]])
SYSTEM_SQL = replaced(SYSTEM_SQL, r"(^|[^\p{L}\p{N}_])(?:du har fået)+.*.(?:a-kasse:)", r"\1")


@query("system_phrases", f"SELECT doc_id, {SYSTEM_SQL} AS text FROM {LETTERS}")
def system_phrases(spark, sf):
    return letters(spark, sf).select("doc_id", clean.remove_system_phrases(F.lower("text")).alias("text"))


LITERAL_SQL = "lower(text)"
for _old, _new in fixed.LITERALS:
    LITERAL_SQL = f"replace({LITERAL_SQL}, {quoted(_old)}, {quoted(_new)})"


@query("literal_replace", f"SELECT doc_id, {LITERAL_SQL} AS text FROM {LETTERS}")
def literal_replace(spark, sf):
    return letters(spark, sf).select("doc_id", clean.replace_literals(F.lower("text")).alias("text"))


LITERAL_RULES = [(spaced(p), r) for p, r in fixed.LITERALS_REGEX]


@query("literal_rules", f"SELECT doc_id, {chained_sql('lower(text)', LITERAL_RULES)} AS text FROM {LETTERS}")
def literal_rules(spark, sf):
    return letters(spark, sf).select("doc_id", clean.native_chain(F.lower("text"), fixed.LITERALS_REGEX).alias("text"))


OTHER = r"[^\p{L}\p{N}_]"
SHORT_SQL = replaced("text", f"({OTHER})", r"\1\1")
SHORT_SQL = replaced(SHORT_SQL, rf"(^|{OTHER})({WORD}{{1,2}})({OTHER}|$)", r"\1\3")
SHORT_SQL = replaced(SHORT_SQL, f"({OTHER}){OTHER}", r"\1")


@query("short_word_strip", f"SELECT doc_id, {SHORT_SQL} AS text FROM documents")
def short_word_strip(spark, sf):
    return documents(spark, sf).select("doc_id", clean.remove_short_words(F.col("text")).alias("text"))


@query(
    "space_collapse",
    f"SELECT doc_id, array_to_string({split_words('text')}, ' ') AS text FROM documents",
)
def space_collapse(spark, sf):
    return documents(spark, sf).select("doc_id", clean.collapse_spaces(F.col("text")).alias("text"))


@query(
    "non_ascii_words",
    r"""SELECT doc_id, w AS word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents)
    WHERE regexp_matches(w, '[^\x00-\x7F]') GROUP BY doc_id, w""",
)
def non_ascii_words(spark, sf):
    found = explode_rows(documents(spark, sf), ["doc_id"], clean.non_ascii_words(F.col("text")), "word")
    return found.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "non_ascii_marked",
    r"""SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w:
    CASE WHEN regexp_matches(w, '[^\x00-\x7F]') THEN 'qwerty' ELSE w END), ' ') AS text FROM documents""",
)
def non_ascii_marked(spark, sf):
    return documents(spark, sf).select("doc_id", clean.mark_non_ascii_words(F.col("text")).alias("text"))


KEYWORDS = {"conj": ("and the", "the", "und die"), "of_in": ("of", "in", "de la")}


@query(
    "keyword_replace",
    f"""SELECT doc_id, {replaced(replaced('text', r'(?i)\b(?:and the|und die|the)\b', 'conj'), r'(?i)\b(?:de la|of|in)\b', 'of_in')}
    AS text FROM documents""",
)
def keyword_replace(spark, sf):
    return documents(spark, sf).select("doc_id", clean.replace_keywords(F.col("text"), KEYWORDS).alias("text"))


KEYWORD_SQL = "lower(text)"
for _term, _pattern in (
    ("hej", r"(?i)\bhej[,.]\B"),
    ("jeg_har", r"(?i)\bjeg har\b"),
    ("jobnet_dk", r"(?i)\bjobnet\b"),
    ("planlægge", r"(?i)\b(?:planlægger|planlagt)\b"),
    ("supplerende_dagpenge", r"(?i)\bsupplerende dagpenge\b"),
):
    KEYWORD_SQL = replaced(KEYWORD_SQL, _pattern, _term)


@query("keyword_replace_messages", f"SELECT doc_id, {KEYWORD_SQL} AS text FROM {LETTERS}")
def keyword_replace_messages(spark, sf):
    return letters(spark, sf).select("doc_id", clean.replace_keywords(F.lower("text")).alias("text"))


# --- HTML and long rule chains ---------------------------------------------------------------


HTML_SQL = "replace(html, '</p><p>', '</p>.' || chr(10) || '<p>')"
for _pattern in (r"(?s)<!--.*?-->", r"(?is)<(script|style)\b.*?</(script|style)\s*>", r"(?s)<[A-Za-z/!][^>]*>"):
    HTML_SQL = replaced(HTML_SQL, _pattern)
for _entity, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    HTML_SQL = f"replace({HTML_SQL}, '&{_entity};', {quoted(_char)})"


@query("html_text", f"SELECT page_id, {HTML_SQL} AS text FROM pages")
def html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.html_text(F.col("html")).alias("text"))


CODE_SQL = "replace(html, '</p><p>', '</p>.' || chr(10) || '<p>')"
for _pattern in (r"(?s)<!--.*?-->", r"(?s)<[A-Za-z/!][^>]*>"):
    CODE_SQL = replaced(CODE_SQL, _pattern)
for _entity, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    CODE_SQL = f"replace({CODE_SQL}, '&{_entity};', {quoted(_char)})"


@query("html_text_with_code", f"SELECT page_id, {CODE_SQL} AS text FROM pages")
def html_text_with_code(spark, sf):
    return table(spark, sf, "pages").select("page_id", html.html_text(F.col("html"), keep_code=True).alias("text"))


def plain_rules(*tables_of_rules):
    """Rules that work without look-around."""
    return tuple(
        (p, r)
        for rows in tables_of_rules
        for p, r in rows
        if not any(x in p for x in ("(?=", "(?<", "(?!", r"|\b", r"\w")) and not p.endswith((r"\s", r"\s)"))
    )


PLAIN_RULES = plain_rules(rules.ABBREVIATIONS, rules.KEY_CONCEPTS, rules.LEMMAS)


def bounded_sql(expression, rows):
    for pattern, replacement in rows:
        if pattern.startswith(r"\b"):
            expression = replaced(
                expression, r"(^|[^\p{L}\p{N}_])(?:" + spaced(pattern[2:]) + ")", r"\1" + replacement
            )
        else:
            expression = replaced(expression, spaced(pattern), replacement)
    return expression


@query("rule_chain_plain", f"SELECT doc_id, {bounded_sql('lower(text)', PLAIN_RULES)} AS text FROM {LETTERS}")
def rule_chain_plain(spark, sf):
    return letters(spark, sf).select("doc_id", rulechain.rule_chain(F.lower("text"), (PLAIN_RULES,)).alias("text"))


MARK = "\x02"
DELIMITER = r"[\s\p{Z}\x0b\x1c-\x1f\x{85},.]"
AHEAD = r"(?=[\s,\.])"


def marked_rule(expression, pattern, replacement):
    """A rule with look-ahead for text in which a mark follows every delimiter.

    The delimiter that is looked at is matched and put back, and the mark after it is left for the
    boundary of the next match.
    """
    before, body = "", pattern
    if body.startswith(r"\b"):
        before, body = r"(^|[^\p{L}\p{N}_])", body[2:]
    elif body.startswith(r"(?<=([0-9])\s)"):
        before, body = f"([0-9]{SPACE}{MARK})", body.removeprefix(r"(?<=([0-9])\s)")
    elif body.startswith(r"(?<=([0-9]))"):
        before, body = "([0-9])", body.removeprefix(r"(?<=([0-9]))")
    ahead = body.endswith(AHEAD)
    body = body.removesuffix(AHEAD)
    body = re.sub(r"\((?!\?)", "(?:", body)
    body = body.replace(r"\.", r"[.]" + MARK).replace(",", "," + MARK).replace(" ", " " + MARK)
    body = body.replace(r"\s", SPACE + MARK).replace(r"\w", WORD)
    groups = [g for g in (before, f"({DELIMITER})" if ahead else "") if g]
    put_back = [f"\\{i + 1}" for i in range(len(groups))]
    new = re.sub(r"([ ,.])", r"\1" + MARK, replacement)
    start, end = (put_back[0] if before else ""), (put_back[-1] if ahead else "")
    return replaced(expression, f"{before}(?:{body}){groups[-1] if ahead else ''}", start + new + end)


def marked_sql(expression, rows):
    expression = replaced(expression, f"({DELIMITER})", r"\1" + MARK)
    for pattern, replacement in rows:
        expression = marked_rule(expression, pattern, replacement)
    return f"replace({expression}, chr(2), '')"


def with_ahead_only(rows):
    return tuple((p, r) for p, r in rows if "(?!" not in p and not (AHEAD in p and not p.endswith(AHEAD)))


def _one_table(name, rows):
    expressible = with_ahead_only(rows) == rows
    sql = f"SELECT doc_id, {marked_sql('lower(text)', rows)} AS text FROM {LETTERS}"

    @query(f"rules_{name}", sql if expressible else None)
    def run(spark, sf):
        return letters(spark, sf).select("doc_id", rulechain.rule_chain(F.lower("text"), (rows,)).alias("text"))

    return run


for _name in ("abbreviations", "key_concepts", "lemmas"):
    _one_table(_name, rules.RULE_SETS[_name])

CONCEPTS = with_ahead_only(rules.KEY_CONCEPTS)


@query("rules_key_concepts_ahead", f"SELECT doc_id, {marked_sql('lower(text)', CONCEPTS)} AS text FROM {LETTERS}")
def rules_key_concepts_ahead(spark, sf):
    return letters(spark, sf).select("doc_id", rulechain.rule_chain(F.lower("text"), (CONCEPTS,)).alias("text"))


@query("rule_clean_full")
def rule_clean_full(spark, sf):
    return letters(spark, sf).select("doc_id", clean.clean_full(F.col("text")).alias("text"))


@query("rule_clean_masked")
def rule_clean_masked(spark, sf):
    return letters(spark, sf).select("doc_id", clean.clean_full(F.col("text"), "masked").alias("text"))


def legacy_sql(source: str, keys: str, markup: str) -> str:
    """The older preparation of a column of texts or markup, step by step."""
    literals = "text"
    for old, new in fixed.LITERALS_OLDER:
        literals = f"replace({literals}, {quoted(old)}, {quoted(new)})"
    older = f"""CASE WHEN regexp_matches({ascii_shape('t')}, {quoted(fixed.SIGN_OFF_OLDER)})
        THEN {stripped(f'substr(t, 1, position({OLDER_LINE} IN t) - 1)')} ELSE t END"""
    steps = [f"lower({stripped('text')})", cut_greeting("text", fixed.GREETING_OLDER)]
    later = [no_first_newline("text"), f"array_to_string({split_words('text')}, ' ')", literals, replaced("text", spaced(rules.EMAIL)), SHORT_SQL]
    statement = f"SELECT {keys}, {markup} AS text FROM {source}"
    for step in steps:
        statement = f"SELECT {keys}, {step} AS text FROM ({statement})"
    statement = f"SELECT {keys}, {older} AS text FROM (SELECT {keys}, text AS t FROM ({statement}))"
    for step in later:
        statement = f"SELECT {keys}, {step} AS text FROM ({statement})"
    return statement


@query("legacy_clean", legacy_sql("pages", "page_id", HTML_SQL))
def legacy_clean(spark, sf):
    return table(spark, sf, "pages").select("page_id", clean.clean_legacy(F.col("html")).alias("text"))


LONG_SQL = f"""(SELECT doc_id, 'role' AS category, role AS html FROM {LETTERS} UNION ALL SELECT doc_id, 'text', text FROM {LETTERS})"""


@query(
    "thread_extract_clean",
    f"""SELECT doc_id, category, text AS content, CAST(length(text) AS INTEGER) AS char_count, length(text) < 5000 AS less_than_5000
    FROM ({legacy_sql(LONG_SQL, 'doc_id, category', HTML_SQL)}) WHERE text IS NOT NULL""",
)
def thread_extract_clean(spark, sf):
    """Subject and body of each message, long form, cleaned, with their lengths; long rows are flagged, not dropped."""
    from textmill.operators.shape import melt, not_null

    long = melt(not_null(letters(spark, sf), "role", "text"), ["doc_id"], ["role", "text"], "category", "content")
    cleaned = long.withColumn("content", clean.clean_legacy(F.col("content")))
    count = F.length("content")
    return cleaned.filter("content IS NOT NULL").withColumns({"char_count": count, "less_than_5000": count < 5000})


@query("serving_tokens")
def serving_tokens(spark, sf):
    stop = tok.stopwords(extra=fixed.SERVING_STOPWORDS, domain=False, phrases=False)
    words = tok.remove_stopwords(tok.tokenize(clean.clean_serving(F.col("text"))), stop)
    return letters(spark, sf).select("doc_id", F.array_join(stem.english_stems(words), " ").alias("tokens"))


# --- tokens ----------------------------------------------------------------------------------

LOWER_TOKENS = tokens("lower(text)")
STOP = tok.stopwords()


def tokenized(spark, sf):
    return documents(spark, sf).select("doc_id", tok.tokenize(F.lower("text")).alias("tokens"))


@query(
    "token_counts",
    f"SELECT token, count(*) AS n FROM (SELECT unnest({LOWER_TOKENS}) AS token FROM documents) GROUP BY token",
)
def token_counts(spark, sf):
    return eda.token_counts(tokenized(spark, sf), "tokens")


@query(
    "top_token_counts",
    f"""SELECT token, count(*) AS n FROM (SELECT unnest({LOWER_TOKENS}) AS token FROM documents)
    WHERE token NOT IN {in_list(STOP)} GROUP BY token ORDER BY n DESC, token LIMIT 50""",
)
def top_token_counts(spark, sf):
    kept = tokenized(spark, sf).select(tok.remove_stopwords(F.col("tokens"), STOP).alias("tokens"))
    return eda.top_n(eda.token_counts(kept, "tokens"), [F.desc("n"), F.asc("token")], 50)


@query(
    "clean_token_list",
    f"SELECT doc_id, array_to_string({LOWER_TOKENS}, ' ') AS tokens FROM documents",
)
def clean_token_list(spark, sf):
    return tokenized(spark, sf).withColumn("tokens", F.array_join("tokens", " "))


@query(
    "distinct_tokens",
    f"SELECT doc_id, len(list_distinct({LOWER_TOKENS}))::BIGINT AS n FROM documents",
)
def distinct_tokens(spark, sf):
    return tokenized(spark, sf).select("doc_id", F.size(tok.distinct_tokens(F.col("tokens"))).cast("long").alias("n"))


def _runs_sql(n):
    return f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], '_'))"


@query(
    "everygrams",
    f"""SELECT conv_id, turn, array_to_string({cleaned_tokens('g')}, ' ') AS grams FROM (SELECT conv_id, turn,
    list_concat(list_concat({_runs_sql(1)}, {_runs_sql(2)}), {_runs_sql(3)}) AS g
    FROM (SELECT conv_id, turn, {raw_tokens('lower(text)')} AS w FROM conversations))""",
)
def everygrams(spark, sf):
    grams = tok.tokenize(F.lower("text"), n_gram=3)
    return conversations(spark, sf).select("conv_id", "turn", F.array_join(grams, " ").alias("grams"))


@query(
    "stopwords_removed",
    f"""SELECT doc_id, array_to_string(list_filter({LOWER_TOKENS}, lambda x: x NOT IN {in_list(STOP)}), ' ') AS tokens
    FROM documents""",
)
def stopwords_removed(spark, sf):
    kept = tok.remove_stopwords(F.col("tokens"), STOP)
    return tokenized(spark, sf).select("doc_id", F.array_join(kept, " ").alias("tokens"))


@query(
    "long_tokens",
    f"""SELECT doc_id, array_to_string(list_filter({LOWER_TOKENS}, lambda x: x NOT IN {in_list(STOP)} AND length(x) > 3), ' ')
    AS tokens FROM documents""",
)
def long_tokens(spark, sf):
    kept = tok.longer_tokens(F.col("tokens"), STOP)
    return tokenized(spark, sf).select("doc_id", F.array_join(kept, " ").alias("tokens"))


TOP_SQL = """(SELECT token FROM (SELECT token, count(DISTINCT doc_id) AS df FROM t GROUP BY token)
    WHERE df >= 5 AND df <= floor(0.5 * (SELECT count(*) FROM documents)) ORDER BY df DESC, token LIMIT 500)"""
TOKEN_ROWS = f"""t AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos
    FROM (SELECT doc_id, {LOWER_TOKENS} AS w FROM documents))"""


def _top_list(docs):
    statistics = vocabulary.token_statistics(docs, "tokens")
    return vocabulary.filter_extremes(statistics, docs.count(), keep_n=500, keep_tokens=())


@query(
    "top_words_only",
    f"""WITH {TOKEN_ROWS}, k AS {TOP_SQL} SELECT d.doc_id, coalesce(string_agg(token, ', ' ORDER BY pos), '') AS tokens
    FROM documents d LEFT JOIN (SELECT * FROM t WHERE token IN (SELECT token FROM k)) USING (doc_id) GROUP BY d.doc_id""",
)
def top_words_only(spark, sf):
    docs = materialise(tokenized(spark, sf))  # the list and the rows read the same tokens
    kept = vocabulary.only_top_words(docs, "doc_id", "tokens", materialise(_top_list(docs)), "kept")
    return kept.select("doc_id", tok.join_tokens(F.col("kept")).alias("tokens"))


@query(
    "listed_words_only",
    f"""SELECT doc_id, array_to_string(list_filter({LOWER_TOKENS}, lambda x: x IN {in_list(fixed.DOMAIN_STOPWORDS)}), ', ') AS tokens
    FROM documents""",
)
def listed_words_only(spark, sf):
    kept = tok.keep_listed(F.col("tokens"), fixed.DOMAIN_STOPWORDS)
    return tokenized(spark, sf).select("doc_id", tok.join_tokens(kept).alias("tokens"))


@query(
    "skipgrams",
    f"""WITH c AS (SELECT conv_id * 1000 + turn AS doc_id, {LOWER_TOKENS} AS w FROM conversations)
    SELECT doc_id, p.a AS first, p.b AS second, count(*) AS n FROM (
    SELECT doc_id, unnest(list_concat(list_concat(
    list_transform(range(1, len(w)), lambda i: {{'a': w[i], 'b': w[i + 1]}}),
    list_transform(range(1, len(w) - 1), lambda i: {{'a': w[i], 'b': w[i + 2]}})),
    list_transform(range(1, len(w) - 2), lambda i: {{'a': w[i], 'b': w[i + 2]}}))) AS p FROM c) GROUP BY ALL""",
)
def skipgrams(spark, sf):
    made = conversations(spark, sf).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), tok.tokenize(F.lower("text")).alias("tokens")
    )
    pairs = ngrams.skip_grams(made, "doc_id", "tokens")
    return pairs.groupBy("doc_id", "first", "second").agg(F.count(F.lit(1)).alias("n"))


COUNTED_SQL = f"""WITH d AS (SELECT doc_id, {LOWER_TOKENS} AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS pos, len(w)::DOUBLE AS n FROM d),
    u AS (SELECT doc_id, w, count(*)::DOUBLE AS c FROM t GROUP BY ALL),"""

BIGRAM_SQL = f"""{COUNTED_SQL}
    p AS (SELECT a.doc_id, a.w AS w1, b.w AS w2, a.n, count(*)::DOUBLE AS ii FROM t a JOIN t b
      ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 GROUP BY ALL),
    m AS (SELECT p.*, x.c - ii AS io, y.c - ii AS oi, p.n - x.c - y.c + ii AS oo FROM p
      JOIN u x ON x.doc_id = p.doc_id AND x.w = p.w1 JOIN u y ON y.doc_id = p.doc_id AND y.w = p.w2),
    s AS (SELECT doc_id, w1, w2, round(CASE WHEN (ii + io) * (ii + oi) * (io + oo) * (oi + oo) = 0 THEN 0
      ELSE n * (ii * oo - io * oi) * (ii * oo - io * oi) / ((ii + io) * (ii + oi) * (io + oo) * (oi + oo)) END, 6) AS score FROM m)
    SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, w1, w2) AS rank,
      w1 || ' ' || w2 AS ngram, score FROM s) WHERE rank <= 500"""


def _ranked_rows(found):
    return found.withColumn("rank", F.col("rank").cast("long"))


@query("bigram_collocations", BIGRAM_SQL)
def bigram_collocations(spark, sf):
    return _ranked_rows(ngrams.bigram_collocations(tokenized(spark, sf), "doc_id", "tokens"))


_CELLS = {
    "iii": "iii",
    "oii": "(xii - iii)",
    "ioi": "(ixi - iii)",
    "iio": "(iix - iii)",
    "ooi": "(xxi - xii - ixi + iii)",
    "oio": "(xix - xii - iix + iii)",
    "ioo": "(ixx - ixi - iix + iii)",
    "ooo": "(n - ixx - xix - xxi + xii + ixi + iix - iii)",
}


def _term_sql(cell, seen):
    sides = [s if c == "i" else f"(n - {s})" for c, s in zip(cell, ("ixx", "xix", "xxi"))]
    expected = f"({' * '.join(sides)} / (n * n))"
    return f"({seen} - {expected}) * ({seen} - {expected}) / ({expected} + 1e-20)"


TRIGRAM_SQL = f"""{COUNTED_SQL}
    r AS (SELECT a.doc_id, a.n, a.w AS w1, b.w AS w2, c.w AS w3 FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
      LEFT JOIN t c ON a.doc_id = c.doc_id AND c.pos = a.pos + 2),
    b2 AS (SELECT doc_id, w1, w2, count(*)::DOUBLE AS c FROM r GROUP BY ALL),
    wild AS (SELECT doc_id, w1, w3, count(*)::DOUBLE AS c FROM r WHERE w3 IS NOT NULL GROUP BY ALL),
    q AS (SELECT doc_id, n, w1, w2, w3, count(*)::DOUBLE AS iii FROM r WHERE w3 IS NOT NULL GROUP BY ALL),
    m AS (SELECT q.*, e.c AS iix, f.c AS xii, g.c AS ixi, x.c AS ixx, y.c AS xix, z.c AS xxi FROM q
      JOIN b2 e ON e.doc_id = q.doc_id AND e.w1 = q.w1 AND e.w2 = q.w2
      JOIN b2 f ON f.doc_id = q.doc_id AND f.w1 = q.w2 AND f.w2 = q.w3
      JOIN wild g ON g.doc_id = q.doc_id AND g.w1 = q.w1 AND g.w3 = q.w3
      JOIN u x ON x.doc_id = q.doc_id AND x.w = q.w1 JOIN u y ON y.doc_id = q.doc_id AND y.w = q.w2
      JOIN u z ON z.doc_id = q.doc_id AND z.w = q.w3),
    s AS (SELECT doc_id, w1, w2, w3, round({' + '.join(_term_sql(c, e) for c, e in _CELLS.items())}, 6) AS score FROM m)
    SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, w1, w2, w3) AS rank,
      w1 || ' ' || w2 || ' ' || w3 AS ngram, score FROM s) WHERE rank <= 500"""


@query("trigram_collocations", TRIGRAM_SQL)
def trigram_collocations(spark, sf):
    return _ranked_rows(ngrams.trigram_collocations(tokenized(spark, sf), "doc_id", "tokens"))


@query(
    "combined_ngrams",
    f"""WITH bi AS (SELECT doc_id, list(ngram ORDER BY rank) AS b FROM ({BIGRAM_SQL}) GROUP BY doc_id),
    tri AS (SELECT doc_id, list(ngram ORDER BY rank) AS t FROM ({TRIGRAM_SQL}) GROUP BY doc_id)
    SELECT doc_id, array_to_string(list_filter(list_concat(list_concat({LOWER_TOKENS}, coalesce(b, [])), coalesce(t, [])),
    lambda x: x NOT IN {in_list(STOP)}), '|') AS ngrams
    FROM documents LEFT JOIN bi USING (doc_id) LEFT JOIN tri USING (doc_id)""",
)
def combined_ngrams(spark, sf):
    made = ngrams.with_collocations(tokenized(spark, sf), "doc_id", "tokens")
    return made.select("doc_id", F.array_join(tok.remove_stopwords(F.col("ngrams"), STOP), "|").alias("ngrams"))


@query("stem_tokens_danish")
def stem_tokens_danish(spark, sf):
    return tokenized(spark, sf).select("doc_id", F.array_join(stem.danish_stems(F.col("tokens")), " ").alias("stems"))


@query("stem_tokens_english")
def stem_tokens_english(spark, sf):
    return tokenized(spark, sf).select("doc_id", F.array_join(stem.english_stems(F.col("tokens")), " ").alias("stems"))


# --- sentences -------------------------------------------------------------------------------

_LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda s: {stripped('s')}), lambda s: s <> '')"
_PIECES = f"flatten(list_transform({_LINES}, lambda s: string_split({replaced('s', r'^[.]+|[.]+$')}, '.')))"
SENTENCES = f"list_transform({_PIECES}, lambda s: {stripped('s')})"


def sentence_rows(source):
    return f"""(SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS pos
    FROM (SELECT doc_id, {SENTENCES} AS s FROM {source}))"""


@query("sentence_split", f"SELECT doc_id, pos::BIGINT AS pos, sentence FROM {sentence_rows('documents')}")
def sentence_split(spark, sf):
    numbered = F.transform(
        tok.split_sentences(F.col("text")), lambda s, i: F.struct(i.cast("long").alias("pos"), s.alias("sentence"))
    )
    return inline_rows(documents(spark, sf), ["doc_id"], numbered)


@query("sentences_normalised")
def sentences_normalised(spark, sf):
    text = tok.normalise_sentences(rulechain.rule_chain(F.lower("text"), (rules.ABBREVIATIONS,)))
    return sentences.tagged_sentences(letters(spark, sf).withColumn("text", text), "doc_id", "text")


@query(
    "sentence_tokens",
    f"""SELECT doc_id, len(list_filter(list_transform({SENTENCES}, lambda s: len({tokens('s')})), lambda n: n > 0))::BIGINT AS n_sentences,
    coalesce(list_sum(list_transform({SENTENCES}, lambda s: len({tokens('s')}))), 0)::BIGINT AS n_tokens FROM {LETTERS}""",
)
def sentence_tokens(spark, sf):
    made = tok.sentence_tokens(F.col("text"))
    return letters(spark, sf).select("doc_id", made.alias("s")).select(
        "doc_id",
        F.size("s").cast("long").alias("n_sentences"),
        F.size(F.flatten("s")).cast("long").alias("n_tokens"),
    )


def tag_sql(table_of_tags):
    cases = " ".join(
        f"WHEN regexp_matches(sentence, {quoted('^(?:' + spaced(p.removeprefix(chr(92) + 'b')) + ')')}) THEN {quoted(label)}"
        for p, label in table_of_tags
        if label != "EMAIL"
    )
    return f"CASE {cases} ELSE 'CONTENT' END"


def tagged_sql(source, table_of_tags, state=True):
    first = f"SELECT doc_id, pos, {stripped('lower(sentence)')} AS sentence FROM {sentence_rows(source)}"
    tag = f"SELECT doc_id, pos, sentence, {tag_sql(table_of_tags)} AS tag FROM ({first})"
    if not state:
        return f"SELECT doc_id, pos::BIGINT AS pos, sentence, tag FROM ({tag})"
    return f"""SELECT doc_id, pos::BIGINT AS pos, sentence, CASE WHEN coalesce(max(CASE WHEN tag = 'ENDING' THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1
    THEN 'AFTER ENDING' ELSE tag END AS tag FROM ({tag})"""


def _tagged(frame, **settings):
    return sentences.tagged_sentences(frame, "doc_id", "text", **settings).withColumn("pos", F.col("pos").cast("long"))


@query("sentence_tags", tagged_sql(LETTERS, fixed.SENTENCE_TAGS))
def sentence_tags(spark, sf):
    return _tagged(letters(spark, sf))


@query("sentence_tags_older", tagged_sql(LETTERS, fixed.SENTENCE_TAGS_OLDER, state=False))
def sentence_tags_older(spark, sf):
    return _tagged(letters(spark, sf), table=fixed.SENTENCE_TAGS_OLDER, after_ending=False)


TAG_COUNTS = f"""SELECT sentence, tag, count(*) AS counts FROM ({tagged_sql(LETTERS, fixed.SENTENCE_TAGS)})
    GROUP BY sentence, tag"""


@query("sentence_tag_counts", TAG_COUNTS)
def sentence_tag_counts(spark, sf):
    return sentences.tag_counts(_tagged(letters(spark, sf)))


@query(
    "sentence_tag_top",
    f"SELECT * FROM ({TAG_COUNTS}) WHERE tag = 'ENDING' ORDER BY counts DESC, sentence LIMIT 10",
)
def sentence_tag_top(spark, sf):
    return sentences.with_tag(sentences.tag_counts(_tagged(letters(spark, sf))), "ENDING", 10)


@query(
    "sentences_by_tag",
    f"SELECT tag, sentence FROM ({TAG_COUNTS})",
)
def sentences_by_tag(spark, sf):
    """The listed sentences themselves, taken out of their lists."""
    listed = sentences.sentences_by_tag(_tagged(letters(spark, sf)), part_size=200)
    return listed.select("tag", F.explode("sentences").alias("sentence"))
