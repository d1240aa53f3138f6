"""Queries on sources, filters, reshaping, aggregates and threads."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.catalog.registry import query
from textmill.catalog.sql import in_list, split_words, tokens
from textmill.functions import features
from textmill.functions import tokens as tok
from textmill.operators import audit, eda, shape, threads
from textmill.session import scratch_path
from textmill.sources import files
from textmill.sources.tables import sql_query, table


def documents(spark, sf):
    return table(spark, sf, "documents")


def conversations(spark, sf):
    return table(spark, sf, "conversations")


def rounded(name):
    return F.round(name, 6).alias(name if isinstance(name, str) else None)


# --- sources and sinks -----------------------------------------------------------------------

SCAN = """SELECT doc_id, text FROM documents WHERE n_chars < {limit}"""


@query("scan_by_query", SCAN.format(limit=2000))
def scan_by_query(spark, sf):
    statement = SCAN.replace("documents", "{documents}").format(documents="{documents}", limit=":limit")
    return sql_query(spark, statement, {"limit": 2000}, documents=documents(spark, sf))


FLAT_TEXT = "regexp_replace(text, '[\\n\\r;]', ' ', 'g')"


@query(
    "csv_load",
    f"""SELECT CAST(doc_id AS VARCHAR) AS ContentID, 'https://example.org/' || doc_id AS ContentUrl, lang AS ContentType,
    '2020-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS PublishDate, 'kicker "a"' AS ContentTagsKicker,
    source || ',' || lang AS ContentTagsContent, source AS ContentTagsMultiple, 'Title ' || source AS ContentTitle,
    left({FLAT_TEXT}, 100) AS ContentDesriptionHeader, left({FLAT_TEXT}, 500) AS ContentDesriptionManchet,
    {FLAT_TEXT} AS ContentDesriptionText FROM documents""",
)
def csv_load(spark, sf):
    """All columns of the article file. The format has no quotes, so a separator or line end cannot be part of a value; quotes can."""
    path = scratch_path(spark, "articles")
    text = F.regexp_replace("text", "[\n\r;]", " ")
    articles = documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("ContentID"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("ContentUrl"),
        F.col("lang").alias("ContentType"),
        F.concat(F.lit("2020-01-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0")).alias("PublishDate"),
        F.lit('kicker "a"').alias("ContentTagsKicker"),
        F.concat_ws(",", "source", "lang").alias("ContentTagsContent"),
        F.col("source").alias("ContentTagsMultiple"),
        F.concat(F.lit("Title "), F.col("source")).alias("ContentTitle"),
        F.left(text, F.lit(100)).alias("ContentDesriptionHeader"),
        F.left(text, F.lit(500)).alias("ContentDesriptionManchet"),
        text.alias("ContentDesriptionText"),
    )
    files.write_articles(articles, path)
    return files.checked_widths(files.read_articles(spark, path))


@query(
    "wide_strings",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars,
    CASE WHEN length(text) > 500 THEN 0 ELSE 1 END AS fits FROM documents""",
)
def wide_strings(spark, sf):
    return files.to_strings(documents(spark, sf)).withColumn(
        "fits", F.when(F.length("text") > 500, 0).otherwise(1)
    )


@query(
    "union_tables",
    "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id AS id, text FROM benchmark",
)
def union_tables(spark, sf):
    return files.union_all(
        documents(spark, sf).select(F.col("doc_id").alias("id"), "text"),
        table(spark, sf, "benchmark").select("text", F.col("item_id").alias("id")),
    )


@query("full_reload", "SELECT doc_id, text FROM documents")
def full_reload(spark, sf):
    path = scratch_path(spark, "reload")
    files.replace_table(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text"), path)
    files.replace_table(documents(spark, sf).select("doc_id", "text"), path)
    return spark.read.parquet(path)


@query(
    "append_runs",
    """SELECT 'run-a' AS iteration_guid, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents WHERE lang = 'en'
    UNION ALL SELECT 'run-b', count(*), sum(n_chars)::BIGINT FROM documents WHERE lang <> 'en'""",
)
def append_runs(spark, sf):
    path = scratch_path(spark, "runs")
    docs = documents(spark, sf).select("doc_id", "n_chars", "lang")
    for guid, part in (("run-a", docs.filter("lang = 'en'")), ("run-b", docs.filter("lang <> 'en'"))):
        files.append_table(shape.with_constants(part, {"iteration_guid": guid}), path, "iteration_guid")
    return spark.read.parquet(path).groupBy("iteration_guid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )


@query(
    "stored_tokens",
    f"SELECT conv_id, turn, array_to_string({tokens('lower(text)')}, ' ') AS tokens FROM conversations",
)
def stored_tokens(spark, sf):
    made = conversations(spark, sf).select("conv_id", "turn", tok.tokenize(F.lower("text")).alias("tokens"))
    return files.stored(made, scratch_path(spark, "tokens")).withColumn("tokens", F.array_join("tokens", " "))


@query(
    "csv_export",
    f"SELECT doc_id, array_to_string({tokens('lower(text)')}, ', ') AS tokens FROM documents",
)
def csv_export(spark, sf):
    path = scratch_path(spark, "export")
    made = documents(spark, sf).select("doc_id", tok.tokenize(F.lower("text")).alias("tokens"))
    files.export_csv(made, path)
    return spark.read.csv(path, header=True, schema="doc_id long, tokens string", emptyValue="")


@query("group_files", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def group_files(spark, sf):
    path = scratch_path(spark, "groups")
    files.write_groups(documents(spark, sf), path, "lang", "source")
    return spark.read.parquet(path).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@query(
    "list_strings",
    f"""SELECT doc_id, array_to_string(w, ', ') AS joined, len(string_split(array_to_string(w, ', '), ',')) AS parts,
    string_split(array_to_string(w, ', '), ',')[2] AS second_part
    FROM (SELECT doc_id, {tokens('lower(text)')} AS w FROM documents)""",
)
def list_strings(spark, sf):
    made = documents(spark, sf).select("doc_id", tok.tokenize(F.lower("text")).alias("w"))
    text = files.lists_as_text(made)
    back = files.text_as_lists(text.withColumn("again", F.col("w")), ["again"])
    return back.select(
        "doc_id",
        F.col("w").alias("joined"),
        F.size("again").cast("long").alias("parts"),
        F.get("again", F.lit(1)).alias("second_part"),
    )


@query(
    "word_list_file",
    f"SELECT DISTINCT w AS entry FROM (SELECT unnest({split_words('lower(text)')}) AS w FROM documents)",
)
def word_list_file(spark, sf):
    path = scratch_path(spark, "words")
    listed = documents(spark, sf).select(F.explode(features.words(F.lower("text"))).alias("value"))
    listed.write.text(path)
    return files.word_list(spark, path)


# --- projection, filters, samples, reshaping -------------------------------------------------


@query(
    "columns_renamed",
    """SELECT doc_id AS MessageID, lang AS ThreadResponsibleTeam, 'run-1' AS iteration_guid, 3 AS lda_num_topics
    FROM documents""",
)
def columns_renamed(spark, sf):
    named = shape.select_renamed(documents(spark, sf), {"doc_id": "MessageID", "lang": "ThreadResponsibleTeam"})
    return shape.with_constants(named, {"iteration_guid": "run-1", "lda_num_topics": 3})


@query(
    "scope_filter",
    """SELECT doc_id, source FROM documents WHERE text IS NOT NULL AND regexp_matches(source, 'src1')""",
)
def scope_filter(spark, sf):
    return shape.in_scope(documents(spark, sf), "text", "source", "src1").select("doc_id", "source")


@query("scope_all", "SELECT doc_id FROM documents WHERE text IS NOT NULL")
def scope_all(spark, sf):
    return shape.in_scope(documents(spark, sf), "text", "source", "All").select("doc_id")


@query(
    "joint_filters",
    """SELECT conv_id, turn FROM conversations WHERE role = 'user' AND turn = 0 AND length(text) < 500""",
)
def joint_filters(spark, sf):
    return shape.where_all(
        conversations(spark, sf), [F.col("role") == "user", F.col("turn") == 0, F.length("text") < 500]
    ).select("conv_id", "turn")


@query(
    "case_flags",
    """SELECT vec_id, CASE WHEN label IN (5, 7) THEN 0 ELSE 1 END AS in_scope FROM embeddings""",
)
def case_flags(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", shape.flag_index(F.col("label"), [5, 7]).alias("in_scope"))


@query(
    "prefix_flags",
    """SELECT doc_id, CASE WHEN text LIKE 'The%' THEN 0 WHEN text LIKE 'De%' THEN 0 ELSE 1 END AS keep_row
    FROM documents""",
)
def prefix_flags(spark, sf):
    return documents(spark, sf).select("doc_id", shape.flag_prefix(F.col("text"), ["The", "De"]).alias("keep_row"))


@query(
    "not_in_threshold",
    "SELECT event_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'view') AND value > 10",
)
def not_in_threshold(spark, sf):
    return (
        table(spark, sf, "events")
        .filter(~F.col("event_type").isin("error", "view") & (F.col("value") > 10))
        .select("event_id", "event_type", "value")
    )


@query(
    "subject_in_first_message",
    """SELECT conv_id, turn, CASE WHEN turn = 0 THEN text || ' ' || upper(role) ELSE text END AS text FROM conversations""",
)
def subject_in_first_message(spark, sf):
    return conversations(spark, sf).select(
        "conv_id",
        "turn",
        shape.subject_in_first_message(F.col("text"), F.upper("role"), F.col("turn") == 0).alias("text"),
    )


@query("subject_body_concat", "SELECT conv_id, turn, role || text AS text FROM conversations")
def subject_body_concat(spark, sf):
    return conversations(spark, sf).select("conv_id", "turn", F.concat("role", "text").alias("text"))


@query("category_strip", "SELECT doc_id, regexp_replace(source, '1[0-9]|src', '', 'g') AS source FROM documents")
def category_strip(spark, sf):
    return shape.remove_from_category(documents(spark, sf).select("doc_id", "source"), "source", "1[0-9]|src")


SAMPLE = "SELECT doc_id FROM documents ORDER BY md5(concat_ws('-', CAST(doc_id AS VARCHAR), '1')), doc_id LIMIT 200"


@query("sample_n", SAMPLE)
def sample_n(spark, sf):
    return shape.sample_n(documents(spark, sf).select("doc_id"), 200, "doc_id", 1)


@query("sample_complement", f"SELECT doc_id FROM documents WHERE doc_id NOT IN ({SAMPLE})")
def sample_complement(spark, sf):
    docs = documents(spark, sf).select("doc_id")
    return shape.without(docs, shape.sample_n(docs, 200, "doc_id", 1), "doc_id")


@query(
    "sample_fraction",
    f"""SELECT doc_id FROM documents
    WHERE md5(concat_ws('-', CAST(doc_id AS VARCHAR), '7')) < '{int(0.25 * 2**128):032x}'""",
)
def sample_fraction(spark, sf):
    return shape.sample_fraction(documents(spark, sf).select("doc_id"), 0.25, "doc_id", 7)


@query(
    "melt_messages",
    """SELECT conv_id, turn, 'role' AS category, role AS content FROM conversations
    UNION ALL SELECT conv_id, turn, 'text', text FROM conversations""",
)
def melt_messages(spark, sf):
    return shape.melt(conversations(spark, sf), ["conv_id", "turn"], ["role", "text"], "category", "content")


AUDIT_SQL = """(SELECT o_orderkey, ',cust,status,price,,priority,extra,' AS mask,
    'customer,' || o_custkey || '~' || o_orderstatus || '~~' || CASE WHEN o_custkey % 2 = 0 THEN 'x' ELSE '' END
    || '~' || o_orderpriority AS data FROM orders)"""
AUDIT_PAIRS_SQL = f"""(SELECT o_orderkey, unnest(list_zip(m[1:least(len(m), len(d))], d[1:least(len(m), len(d))])) AS p
    FROM (SELECT o_orderkey, string_split(substr(mask, 2, length(mask) - 2), ',') AS m, string_split(data, '~') AS d
    FROM {AUDIT_SQL}))"""


def audit_rows(spark, sf):
    even = F.when(F.col("o_custkey") % 2 == 0, "x").otherwise("")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        audit.trim_mask(F.lit(",cust,status,price,,priority,extra,")).alias("mask"),
        F.concat(
            F.lit("customer,"), "o_custkey", F.lit("~"), "o_orderstatus", F.lit("~~"), even, F.lit("~"), "o_orderpriority"
        ).alias("data"),
    )


@query(
    "audit_unpivot", f"SELECT o_orderkey, p[1] AS attribute, p[2] AS value FROM {AUDIT_PAIRS_SQL}"
)
def audit_unpivot(spark, sf):
    return audit.unpivot_audit(audit_rows(spark, sf), "o_orderkey", "mask", "data")


@query(
    "audit_unpivot_table", f"SELECT o_orderkey, p[1] AS attribute, p[2] AS value FROM {AUDIT_PAIRS_SQL}"
)
def audit_unpivot_table(spark, sf):
    """The same unpivot as a lateral call of a table function from SQL."""
    function = audit.register_audit_pairs(spark)
    audit_rows(spark, sf).createOrReplaceTempView("audit_rows")
    return spark.sql(f"SELECT r.o_orderkey, p.attribute, p.value FROM audit_rows r, LATERAL {function}(r.mask, r.data) p")


@query(
    "audit_pairs",
    f"""SELECT o_orderkey, p[1] AS entry, string_split(p[2], ',')[1] AS value, string_split(p[2], ',')[2] AS identifier
    FROM {AUDIT_PAIRS_SQL} WHERE length(p[2]) > 0""",
)
def audit_pairs(spark, sf):
    return audit.changed_values(audit_rows(spark, sf), "o_orderkey", "mask", "data")


@query(
    "audit_arrays",
    f"""SELECT o_orderkey, string_agg(p[1] || '=' || replace(p[2], ',', '|'), ';' ORDER BY p[1]) AS changes
    FROM {AUDIT_PAIRS_SQL} WHERE length(p[2]) > 0 GROUP BY o_orderkey""",
)
def audit_arrays(spark, sf):
    listed = audit.with_changes(audit_rows(spark, sf), "mask", "data")
    shown = F.transform(
        "changes", lambda c: F.concat(c["attribute"], F.lit("="), F.array_join(c["parts"], "|"))
    )
    return listed.select("o_orderkey", F.array_join(F.array_sort(shown), ";").alias("changes"))


@query(
    "vocabulary_list",
    f"SELECT DISTINCT t AS token FROM (SELECT unnest({tokens('lower(text)')}) AS t FROM documents)",
)
def vocabulary_list(spark, sf):
    return shape.vocabulary_list(
        documents(spark, sf).select(tok.tokenize(F.lower("text")).alias("tokens")), "tokens"
    )


@query("short_texts", "SELECT doc_id FROM documents WHERE length(text) < 5000")
def short_texts(spark, sf):
    return shape.shorter_than(documents(spark, sf), "text", 5000).select("doc_id")


@query("word_cutoff", "SELECT doc_id FROM documents WHERE len(string_split(text, ' ')) < 300")
def word_cutoff(spark, sf):
    return shape.fewer_words_than(documents(spark, sf), "text", 300).select("doc_id")


@query("subset_counts", "SELECT lang, source, count(*) AS n FROM documents WHERE lang <> 'de' GROUP BY lang, source")
def subset_counts(spark, sf):
    return documents(spark, sf).filter("lang <> 'de'").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


NULLABLE = """(SELECT d.doc_id, CASE WHEN n_chars > 1000 THEN text END AS text, CASE WHEN lang <> 'en' THEN lang END AS lang,
    quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def nullable(spark, sf):
    return (
        documents(spark, sf)
        .join(table(spark, sf, "labels"), "doc_id", "left")
        .select(
            "doc_id",
            F.when(F.col("n_chars") > 1000, F.col("text")).alias("text"),
            F.when(F.col("lang") != "en", F.col("lang")).alias("lang"),
            "quality",
            "toxic",
        )
    )


@query(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {NULLABLE}"
        for c in ("doc_id", "text", "lang", "quality", "toxic")
    ),
)
def null_profile(spark, sf):
    return shape.null_profile(nullable(spark, sf))


@query(
    "null_fill",
    f"SELECT doc_id, coalesce(text, ' ') AS text, coalesce(lang, ' ') AS lang FROM {NULLABLE}",
)
def null_fill(spark, sf):
    return shape.fill_null_text(nullable(spark, sf).select("doc_id", "text", "lang"), ["text", "lang"])


@query("not_null_rows", f"SELECT doc_id FROM {NULLABLE} WHERE text IS NOT NULL AND lang IS NOT NULL")
def not_null_rows(spark, sf):
    return shape.not_null(nullable(spark, sf), "text", "lang").select("doc_id")


@query("distinct_values", "SELECT DISTINCT source FROM documents")
def distinct_values(spark, sf):
    return documents(spark, sf).select("source").distinct()


@query("row_count", "SELECT count(*) AS n FROM documents")
def row_count(spark, sf):
    return documents(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query("incremental_new", "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def incremental_new(spark, sf):
    return shape.without(documents(spark, sf).select("doc_id", "text"), table(spark, sf, "labels"), "doc_id")


# --- joins -----------------------------------------------------------------------------------


@query(
    "filtered_left_join",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1""",
)
def filtered_left_join(spark, sf):
    joined = documents(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.filter("quality = 1").select("doc_id", "quality")


@query(
    "topic_label_join",
    """SELECT vec_id, label, CASE label WHEN 0 THEN 'payment' WHEN 1 THEN 'member' WHEN 3 THEN 'job' END AS pred_label
    FROM embeddings""",
)
def topic_label_join(spark, sf):
    from textmill.operators.topics import topic_names, with_label

    names = topic_names(spark, {0: "payment", 1: "member", 3: "job"})
    predicted = table(spark, sf, "embeddings").select("vec_id", F.col("label").alias("pred_index"))
    return with_label(predicted, names).select("vec_id", F.col("pred_index").alias("label"), "pred_label")


# --- row features ----------------------------------------------------------------------------

WORDS_SQL = split_words("text")


@query(
    "text_features",
    f"""SELECT doc_id, length(text) AS "text_CharCount", length(text) < 5000 AS "text_LessThan5000", n AS "text_WordCount",
    CASE WHEN n > 0 AND n <= 5 THEN 'Simple' WHEN n > 5 AND n <= 12 THEN 'Normal' WHEN n > 12 THEN 'Complex' ELSE 'Empty' END
    AS "text_WordCount_Bucket", q AS "text_Questionmarks", q = 1 AS "text_1Question", e AS "text_Exclamationmarks"
    FROM (SELECT doc_id, text, len({WORDS_SQL}) AS n, length(text) - length(replace(text, '?', '')) AS q,
    length(text) - length(replace(text, '!', '')) AS e FROM documents)""",
)
def text_features(spark, sf):
    made = features.with_text_features(documents(spark, sf).select("doc_id", "text"), "text").drop("text")
    return made.withColumns(
        {c: F.col(c).cast("long") for c, t in made.dtypes if t == "int"}
    )


@query(
    "word_buckets",
    f"""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN n > 0 AND n <= 5 THEN 'Simple' WHEN n > 5 AND n <= 12
    THEN 'Normal' WHEN n > 12 THEN 'Complex' ELSE 'Empty' END AS bucket
    FROM (SELECT len({WORDS_SQL}) AS n FROM conversations)) GROUP BY bucket""",
)
def word_buckets(spark, sf):
    bucket = features.word_bucket(shape.word_count(F.col("text"))).alias("bucket")
    return conversations(spark, sf).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))


@query(
    "date_parts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS "Date", weekofyear(ts)::BIGINT AS "Week", strftime(ts, '%Y-W%V') AS "Year_Week",
    (isodow(ts) - 1)::BIGINT AS "Weekday", month(ts)::BIGINT AS "Month", strftime(ts, '%Y-%m') AS "Year_Month",
    year(ts)::BIGINT AS "Year" FROM events""",
)
def date_parts(spark, sf):
    made = features.with_date_parts(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")
    return made.withColumns({c: F.col(c).cast("long") for c, t in made.dtypes if t == "int"})


TOP_WORDS = ("the", "and", "de", "la", "und")


@query(
    "topword_features",
    f"""SELECT doc_id, len(list_filter(w, lambda x: x IN {in_list(TOP_WORDS)})) AS topwords_count,
    len(list_filter(w, lambda x: x IN {in_list(TOP_WORDS)})) > 0 AS topwords_found,
    {', '.join(f'list_contains(w, {chr(39)}{t}{chr(39)}) AS "{t}"' for t in TOP_WORDS)}
    FROM (SELECT doc_id, {WORDS_SQL} AS w FROM documents)""",
)
def topword_features(spark, sf):
    made = features.with_topword_features(documents(spark, sf).select("doc_id", "text"), "text", TOP_WORDS)
    return made.drop("text").withColumn("topwords_count", F.col("topwords_count").cast("long"))


# --- aggregates ------------------------------------------------------------------------------


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def value_counts(spark, sf):
    return eda.value_counts(table(spark, sf, "events"), ["event_type"])


@query(
    "value_counts_top",
    "SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20",
)
def value_counts_top(spark, sf):
    return eda.value_counts(table(spark, sf, "events"), ["user_id"], top=20)


@query(
    "monthly_agg",
    """SELECT strftime(o_orderdate, '%Y-%m') AS year_month, round(sum(o_totalprice), 2) AS total,
    round(avg(o_totalprice), 4) AS mean, count(o_totalprice) AS n FROM orders GROUP BY 1""",
)
def monthly_agg(spark, sf):
    made = eda.monthly(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return made.select("year_month", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), "n")


@query("calendar_month_counts", "SELECT month(o_orderdate)::BIGINT AS month, count(*) AS n FROM orders GROUP BY 1")
def calendar_month_counts(spark, sf):
    made = eda.by_calendar_month(table(spark, sf, "orders"), "o_orderdate")
    return made.withColumn("month", F.col("month").cast("long"))


@query(
    "value_share",
    """SELECT v::BIGINT AS value, count_if(turns = v) AS n, round(count_if(turns = v) / count(*), 6) AS share
    FROM (SELECT unnest(range(2, 20)) AS v), (SELECT count(*) AS turns FROM conversations GROUP BY conv_id) GROUP BY v""",
)
def value_share(spark, sf):
    turns = conversations(spark, sf).groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    made = eda.value_share(turns, "turns")
    return made.select(F.col("value").cast("long").alias("value"), "n", F.round("share", 6).alias("share"))


@query(
    "cumulative_share",
    """SELECT v::BIGINT AS value, count_if(n_chars <= v) AS n, round(count_if(n_chars <= v) / count(*), 6) AS share
    FROM (SELECT unnest(range(200, 601, 25)) AS v), documents GROUP BY v""",
)
def cumulative_share(spark, sf):
    made = eda.cumulative_share(documents(spark, sf), "n_chars")
    return made.select(F.col("value").cast("long").alias("value"), "n", F.round("share", 6).alias("share"))


@query(
    "length_stats",
    """SELECT count(*) AS n_rows, sum(n)::BIGINT AS n_words, round(avg(n), 6) AS mean_words, min(n) AS min_words,
    max(n) AS max_words, count_if(n > 250) AS over_limit, count_if(n <= 5) AS tops_five
    FROM (SELECT len(string_split(text, ' ')) AS n FROM documents)""",
)
def length_stats(spark, sf):
    made = eda.length_stats(documents(spark, sf), "text", 250)
    return made.withColumns(
        {
            "mean_words": F.round("mean_words", 6),
            "min_words": F.col("min_words").cast("long"),
            "max_words": F.col("max_words").cast("long"),
        }
    )


@query(
    "word_share",
    f"""SELECT word, n AS abs_freq, round(n / sum(n) OVER (), 9) AS abs_perc,
    round(sum(n) OVER (ORDER BY n DESC, word ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 9) AS abs_perc_cum
    FROM (SELECT word, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS word FROM documents) GROUP BY word)""",
)
def word_share(spark, sf):
    made = eda.word_frequency(documents(spark, sf), "text")
    return made.select(
        "word", "abs_freq", F.round("abs_perc", 9).alias("abs_perc"), F.round("abs_perc_cum", 9).alias("abs_perc_cum")
    )


@query(
    "describe_exact",
    """SELECT statistic, round(value, 6) AS value FROM (UNPIVOT (SELECT count(o_totalprice)::DOUBLE AS count, avg(o_totalprice) AS mean,
    stddev_samp(o_totalprice) AS std, min(o_totalprice) AS min, quantile_cont(o_totalprice, 0.25) AS "25%",
    quantile_cont(o_totalprice, 0.5) AS "50%", quantile_cont(o_totalprice, 0.75) AS "75%", max(o_totalprice) AS max FROM orders)
    ON COLUMNS(*) INTO NAME statistic VALUE value)""",
)
def describe_exact(spark, sf):
    made = eda.describe(table(spark, sf, "orders"), "o_totalprice")
    return made.select("statistic", F.round("value", 6).alias("value"))


@query(
    "histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT CASE WHEN value = hi THEN 10
    ELSE floor((value - lo) / ((hi - lo) / 10))::BIGINT + 1 END AS bin, lo, (hi - lo) / 10 AS w FROM events, e)
    SELECT bin, round(min(lo) + (bin - 1) * min(w), 6) AS bin_low, round(min(lo) + bin * min(w), 6) AS bin_high,
    count(*) AS n FROM b GROUP BY bin""",
)
def histogram(spark, sf):
    made = eda.histogram(table(spark, sf, "events"), "value", 10)
    return made.select("bin", F.round("bin_low", 6).alias("bin_low"), F.round("bin_high", 6).alias("bin_high"), "n")


@query(
    "label_shares",
    "SELECT lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY lang",
)
def label_shares(spark, sf):
    return eda.proportions(documents(spark, sf), "lang").withColumn("share", F.round("share", 6))


@query(
    "least_probable_row",
    """SELECT user_id, value, event_id FROM (SELECT user_id, value, event_id, row_number() OVER (PARTITION BY user_id
    ORDER BY value, event_id) AS rn FROM events) WHERE rn = 1""",
)
def least_probable_row(spark, sf):
    return eda.least_probable(
        table(spark, sf, "events").select("user_id", "value", "event_id"), "user_id", "value", "event_id"
    )


@query(
    "most_probable_row",
    """SELECT user_id, value, event_id FROM (SELECT user_id, value, event_id, row_number() OVER (PARTITION BY user_id
    ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def most_probable_row(spark, sf):
    return eda.least_probable(
        table(spark, sf, "events").select("user_id", "value", "event_id"), "user_id", "value", "event_id", most=True
    )


@query(
    "rank_in_group",
    """SELECT lang, source, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, source) - 1 AS word_rank
    FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source)""",
)
def rank_in_group(spark, sf):
    counted = documents(spark, sf).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    made = eda.rank_in_group(counted, "lang", [F.desc("n"), F.asc("source")], "word_rank")
    return made.withColumn("word_rank", F.col("word_rank").cast("long"))


@query("top_n_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 9")
def top_n_rows(spark, sf):
    ordered = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return eda.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ordered, 9)


THREAD_SQL = """SELECT conv_id, count(*) AS message_count, min(turn) AS first_message_id, arg_min(text, turn) AS first_message_body,
    arg_min(role, turn) AS initiated_by, min(turn) FILTER (role = 'user') AS first_member_message_id,
    arg_min(text, turn) FILTER (role = 'user') AS first_member_message_body,
    min(turn) FILTER (role = 'assistant') AS first_response_id,
    arg_min(text, turn) FILTER (role = 'assistant') AS first_response_body, max(turn) AS last_message_id,
    arg_max(text, turn) AS last_message_body, coalesce(bool_or(role = 'user'), false) AS has_member_message,
    coalesce(max(turn) FILTER (role = 'assistant') > min(turn) FILTER (role = 'user'), false) AS has_response_to_member,
    coalesce(max(turn) FILTER (role = 'user') > min(turn) FILTER (role = 'assistant'), false) AS has_response_from_member
    FROM conversations GROUP BY conv_id"""


@query("thread_summary", THREAD_SQL)
def thread_summary(spark, sf):
    return threads.thread_summary(conversations(spark, sf))
