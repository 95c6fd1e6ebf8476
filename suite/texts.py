"""Words, hashtags, log lines."""

from __future__ import annotations

from suite.tables import as_long, table
from tablewright.functions import registered
from tablewright.functions import text as T
from tablewright.operators import rows as R
from tablewright.plans.text import log_profile as profile
from tablewright.plans.text import word_count
from tablewright.operators.ordering import with_position


def word_count_ascii(spark, folder):
    return word_count(table(spark, folder, "documents"), "text", "ascii")


def word_count_ws(spark, folder):
    return word_count(table(spark, folder, "documents"), "text", "whitespace")


def word_count_regex(spark, folder):
    return word_count(table(spark, folder, "documents"), "text", "regex")


def word_count_position(spark, folder):
    """Every word with its place by count, then by its bytes."""
    placed = with_position(word_count_ws(spark, folder), ["-count", "word"])
    return placed.withColumns(as_long("position"))


# Hashtag texts from event rows; every seventh has none and every ninth has two.
TAGGED = (
    "CASE WHEN event_id % 7 = 0 THEN concat('user ', CAST(user_id AS STRING)) "
    "WHEN event_id % 9 = 0 THEN concat('a #', event_type, ' and #u', CAST(user_id AS STRING), '!') "
    "WHEN event_id % 11 = 0 THEN NULL "
    "WHEN event_id % 5 = 0 THEN concat('#हिन्दी #x² #½', event_type, ' #na', 'i\u0308ve #ж', CAST(user_id AS STRING)) "
    "ELSE concat('did #', event_type, '.') END AS text"
)


def _tagged(spark, folder):
    return table(spark, folder, "events").selectExpr("event_id", TAGGED)


def hashtags(spark, folder):
    return T.hashtags(_tagged(spark, folder), "text")


def hashtag_count(spark, folder):
    return _tagged(spark, folder).select("event_id", T.hashtag_count("text").cast("long").alias("n"))


def hashtag_count_registered(spark, folder):
    registered.register_functions(spark)
    counted = _tagged(spark, folder).selectExpr("event_id", f"{registered.COUNT_HASHTAG}(text) AS n")
    return counted.withColumns(as_long("n"))


def hashtags_udtf(spark, folder):
    registered.register_functions(spark)
    _tagged(spark, folder).createOrReplaceTempView("tagged_texts")
    return spark.sql(
        "SELECT event_id, text, hashtag FROM tagged_texts, "
        f"LATERAL {registered.HASHTAG_TABLE}(text)"
    )


def format_label_registered(spark, folder):
    registered.register_functions(spark)
    part = table(spark, folder, "part").selectExpr("p_partkey", "p_name", "nullif(p_size, 7) AS size")
    return part.selectExpr("p_partkey", f"{registered.LABEL}(p_name, CAST(size AS STRING)) AS label")


# Log lines from event rows; every thirteenth is cut short.
LINE = (
    "CASE WHEN event_id % 13 = 0 THEN concat('10.0.0.', CAST(user_id AS STRING), ' - -') "
    "ELSE concat('10.0.0.', CAST(user_id AS STRING), ' - - [01/Jan/2024:00:00:00 +0000] \"GET /', "
    "event_type, ' HTTP/1.1\" ', CASE WHEN event_type = 'error' THEN '500' ELSE '200' END, ' 12') "
    "END AS value"
)


def _lines(spark, folder):
    return table(spark, folder, "events").selectExpr("event_id", LINE)


def split_fields(spark, folder):
    names = [f"field{position}" for position in range(10)]
    return R.split_fields(_lines(spark, folder), "value", " ", names)


def log_profile(spark, folder):
    return profile(_lines(spark, folder))


def log_words(spark, folder):
    lines = table(spark, folder, "events").selectExpr(
        "concat(CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END, ': ', event_type, "
        "'  by user ', CAST(user_id AS STRING)) AS value"
    )
    return R.log_words(lines, "value", "ERROR")


def parse_delimited(spark, folder):
    lines = table(spark, folder, "part").selectExpr(
        "concat_ws(',', CAST(p_partkey AS STRING), p_name, p_type, CAST(p_size AS STRING)) AS value"
    )
    return R.parse_delimited(lines, "value", "product_id bigint, name string, category string, quantity bigint")


QUERIES = {
    "word_count_ascii": word_count_ascii,
    "word_count_ws": word_count_ws,
    "word_count_regex": word_count_regex,
    "word_count_position": word_count_position,
    "hashtags": hashtags,
    "hashtag_count": hashtag_count,
    "hashtag_count_registered": hashtag_count_registered,
    "hashtags_udtf": hashtags_udtf,
    "format_label_registered": format_label_registered,
    "split_fields": split_fields,
    "log_profile": log_profile,
    "log_words": log_words,
    "parse_delimited": parse_delimited,
}


def _words(tokens: str) -> str:
    return (
        f"SELECT word, count(*) AS count FROM (SELECT unnest({tokens}) AS word FROM documents) AS w "
        "WHERE word <> '' GROUP BY word"
    )


_TAGS = f"(SELECT event_id, {TAGGED} FROM events) AS t"
_TAG_ROWS = f"SELECT event_id, text, unnest(regexp_extract_all(text, '#[\\p{{L}}\\p{{N}}_]+')) AS hashtag FROM {_TAGS}"
_TAG_COUNT = (
    f"SELECT event_id, CAST(len(regexp_extract_all(text, '#[\\p{{L}}\\p{{N}}_]+')) AS BIGINT) AS n FROM {_TAGS}"
)
_LINES = f"(SELECT event_id, {LINE} FROM events) AS l"


def _hits(field: str, position: int) -> str:
    token = f"string_split(value, ' ')[{position + 1}]"
    return f"SELECT '{field}' AS field, {token} AS value, count({token}) AS count FROM {_LINES} GROUP BY 1, 2"


ORACLE = {
    "word_count_ascii": _words("list_transform(regexp_split_to_array(text, '[^a-zA-Z0-9_]+'), lambda x: lower(x))"),
    "word_count_ws": _words("regexp_split_to_array(text, '[\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}]+')"),
    "word_count_regex": _words(
        "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+(?: ''[\\p{L}\\p{N}_]+)*')"
    ),
    "hashtags": _TAG_ROWS,
    "hashtag_count": _TAG_COUNT,
    "hashtag_count_registered": _TAG_COUNT,
    "hashtags_udtf": _TAG_ROWS,
    "format_label_registered": """SELECT p_partkey, 'Name: ' || p_name || ', Age: ' ||
        coalesce(CAST(nullif(p_size, 7) AS VARCHAR), 'None') AS label FROM part""",
    "split_fields": "SELECT event_id, "
    + ", ".join(f"string_split(value, ' ')[{n + 1}] AS field{n}" for n in range(10))
    + f" FROM {_LINES}",
    "log_profile": " UNION ALL ".join([_hits("ip", 0), _hits("endpoint", 6), _hits("status", 8)]),
    "log_words": """SELECT upper(unnest(['ERROR:', event_type, 'by', 'user', CAST(user_id AS VARCHAR)])) AS word
        FROM events WHERE event_type = 'error'""",
    "parse_delimited": """SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
        CAST(p_size AS BIGINT) AS quantity FROM part""",
}
ORACLE["word_count_position"] = f"""SELECT word, count, row_number() OVER (ORDER BY count DESC, encode(word)) AS position
    FROM ({ORACLE["word_count_ws"]}) AS w"""
