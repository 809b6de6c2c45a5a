"""Text processors over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import text as T
from gleaner.plans.inputs import pages
from gleaner.plans.registry import query
from gleaner.session import spread
from gleaner.sources.tables import table

WS = T.WHITESPACE
LINES = "string_split(text, chr(10))"


def _documents(spark, folder):
    return spread(table(spark, folder, "documents"))


def _lines():
    return F.split("text", "\n")


@query("md5_hash", "SELECT doc_id, md5(text) AS digest FROM documents")
def md5_hash(spark, folder):
    return _documents(spark, folder).select("doc_id", T.md5_hash(F.col("text")).alias("digest"))


@query("prefix", "SELECT doc_id, 'doc: ' || text AS value FROM documents")
def prefix(spark, folder):
    return _documents(spark, folder).select("doc_id", T.prefix("doc: ")(F.col("text")).alias("value"))


@query(
    "postfix",
    f"""SELECT doc_id, array_to_string(list_transform({LINES}, lambda x: trim(x, '{WS}') || ' #'), '|') AS stripped,
               text || ' #' AS kept FROM documents""",
)
def postfix(spark, folder):
    lines = T.each(T.postfix(" #"))(_lines())
    return _documents(spark, folder).select(
        "doc_id", F.array_join(lines, "|").alias("stripped"), T.postfix(" #", stripped=False)(F.col("text")).alias("kept")
    )


@query(
    "strip_nonempty",
    f"""SELECT doc_id, array_to_string(list_filter(list_transform({LINES}, lambda x: trim(x, '{WS}')), lambda x: x <> ''), '|') AS lines,
               array_to_string(list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, ' ,abc')), lambda x: x <> ''), '|') AS parts
        FROM documents""",
)
def strip_nonempty(spark, folder):
    return _documents(spark, folder).select(
        "doc_id",
        F.array_join(T.strip_nonempty(_lines()), "|").alias("lines"),
        F.array_join(T.strip_nonempty(F.split("text", r"\."), " ,abc"), "|").alias("parts"),
    )


@query(
    "coalesce_list",
    f"""SELECT doc_id, list_filter({LINES}, lambda x: x <> '')[1] AS first_line,
               list_filter({LINES}, lambda x: x <> '')[-1] AS last_line FROM documents""",
)
def coalesce_list(spark, folder):
    return _documents(spark, folder).select(
        "doc_id",
        T.coalesce_list(_lines()).alias("first_line"),
        T.coalesce_list(_lines(), last=True).alias("last_line"),
    )


@query(
    "extract_first",
    f"""SELECT doc_id, coalesce({LINES}[1], 'none') AS plain,
               CASE WHEN regexp_matches({LINES}[1], '([A-Z][a-z]+) ') THEN regexp_extract({LINES}[1], '([A-Z][a-z]+) ', 1)
                    ELSE 'none' END AS matched FROM documents""",
)
def extract_first(spark, folder):
    return _documents(spark, folder).select(
        "doc_id",
        T.extract_first(_lines(), "none").alias("plain"),
        T.extract_first(_lines(), "none", "([A-Z][a-z]+) ").alias("matched"),
    )


@query(
    "normalized_join",
    f"""SELECT doc_id, array_to_string(list_filter(list_transform({LINES}, lambda x: trim(x, '{WS}')), lambda x: x <> ''), ' / ') AS value
        FROM documents""",
)
def normalized_join(spark, folder):
    return _documents(spark, folder).select("doc_id", T.normalized_join(_lines(), " / ").alias("value"))


_CONTENT = "(?is)" + "|".join(rf"<{t}\b.*?</{t}>|<{t}\s*/>" for t in T.CONTENT_TAGS)


@query("strip_tags_with_content", f"SELECT page_id, regexp_replace(html, '{_CONTENT}', '', 'g') AS value FROM pages")
def strip_tags_with_content(spark, folder):
    return pages(spark, folder).select("page_id", T.remove_tags_with_content(F.col("html")).alias("value"))


@query(
    "normalized_join_without_tags",
    f"""SELECT page_id, concat_ws(chr(10), nullif(url, ''), regexp_replace(trim(html, '{WS}'), '{_CONTENT}', '', 'g')) AS value FROM pages""",
)
def normalized_join_without_tags(spark, folder):
    values = F.array(F.col("url"), F.lit(" "), F.col("html"))
    return pages(spark, folder).select("page_id", T.normalized_join_without_tags(values).alias("value"))


@query("replace_tags_with_space", r"SELECT page_id, regexp_replace(html, '(?s)<[a-zA-Z/!].*?>', ' ', 'g') AS value FROM pages")
def replace_tags_with_space(spark, folder):
    return pages(spark, folder).select("page_id", T.replace_tags_with_space(F.col("html")).alias("value"))


@query("nl2br", "SELECT doc_id, replace(replace(text, chr(13), ''), chr(10), '<br>') AS value FROM documents")
def nl2br(spark, folder):
    return _documents(spark, folder).select("doc_id", T.nl2br(F.col("text")).alias("value"))


@query(
    "convert_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS us, strftime(o_orderdate, '%Y-%b-%d') AS named FROM orders""",
)
def convert_date(spark, folder):
    texts = F.array(
        F.col("o_orderstatus"), F.concat(F.lit(" "), F.date_format("o_orderdate", "dd/MMM/yyyy")), F.lit("31/Foo/2016")
    )
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.array_join(T.convert_date(texts, "%d/%b/%Y"), "|").alias("us"),
        F.array_join(T.convert_date(texts, "%d/%b/%Y", "%Y-%b-%d"), "|").alias("named"),
    )


@query("parse_date", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders")
def parse_date(spark, folder):
    text = F.date_format("o_orderdate", "d.M.yyyy H:mm")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.unix_seconds(T.parse_date(text, "%d.%m.%Y %H:%M")).alias("seconds")
    )


@query("regex_replace", r"SELECT doc_id, regexp_replace(text, '([aeiou])([a-z])', '\2-\1', 'g') AS value FROM documents")
def regex_replace(spark, folder):
    return _documents(spark, folder).select("doc_id", T.regex_replace("([aeiou])([a-z])", r"\2-\1")(F.col("text")).alias("value"))


@query(
    "html_escape_codes",
    """SELECT doc_id, replace(replace(replace(replace(replace(text, 'é', '&eacute;'), 'ç', '&ccedil;'), 'ü', '&uuml;'), ', ', '&ndash;'), '.', '''') AS value
       FROM documents""",
)
def html_escape_codes(spark, folder):
    value = F.col("text")
    for plain, code in (("é", "&#233;"), ("ç", "&#231;"), ("ü", "&#252;"), (", ", "&#8211;"), (".", "&#39;")):
        value = F.replace(value, F.lit(plain), F.lit(code))
    return _documents(spark, folder).select("doc_id", T.html_escape_codes(value).alias("value"))


@query(
    "clean_special_chars",
    f"""SELECT doc_id, array_to_string(list_transform(list_filter(list_transform({LINES}, lambda x: trim(x, '{WS}')), lambda x: x <> ''),
                 lambda x: regexp_replace(x, '[^a-zA-Z0-9]', ' ', 'g')), '|') AS value FROM documents""",
)
def clean_special_chars(spark, folder):
    return _documents(spark, folder).select("doc_id", F.array_join(T.clean_special_chars(_lines()), "|").alias("value"))


@query("remove_words", "SELECT doc_id, replace(replace(lower(text), 'the', ''), 'in ', '') AS value FROM documents")
def remove_words(spark, folder):
    return _documents(spark, folder).select("doc_id", T.remove_words(["The", "in "])(F.col("text")).alias("value"))


@query(
    "remove_empty_tags",
    """SELECT doc_id, replace(replace(text, '<', ''), '. ', 'x<h1></h1>') AS value FROM documents""",
)
def remove_empty_tags(spark, folder):
    plain = F.replace("text", F.lit("<"), F.lit(""))
    nested = F.lit("<div><p><b> </b>&nbsp;</p>\n</div>x<h1></h1>")
    return _documents(spark, folder).select("doc_id", T.remove_empty_tags(F.replace(plain, F.lit(". "), nested)).alias("value"))


@query(
    "html_format",
    r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          html, '(?s)<!--.*?-->', ' ', 'g'),
          '<(p|b|li|a|div|h1|title)>[\s\x{a0}\x{c2}]*</(p|b|li|a|div|h1|title)>', '', 'g'),
          '(?s)(</?)(?:h1|b)\b.*?>', '\1strong>', 'g'),
          '(?s)</?(?:!DOCTYPE|html|head|meta|title|style|script|body|nav|a|article|footer)\b.*?>|<!DOCTYPE html>', ' ', 'g'),
          '(?s)<([^>]*?) .*?>', '<\1>', 'g') AS value FROM pages""",
)
def html_format(spark, folder):
    return pages(spark, folder).select("page_id", T.html_format(F.col("html")).alias("value"))


@query(
    "digits_of",
    """SELECT c_custkey, CAST(regexp_replace(c_name, '[^0-9]', '', 'g') AS BIGINT) AS number, CAST(-1 AS BIGINT) AS no_number FROM customer""",
)
def digits_of(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", T.digits_of(F.col("c_name")).alias("number"), T.digits_of(F.col("c_mktsegment")).alias("no_number")
    )


@query("language_prefix", "SELECT doc_id, substr(lang || '-' || source, 1, 2) AS language FROM documents")
def language_prefix(spark, folder):
    return _documents(spark, folder).select("doc_id", T.language_prefix(F.concat_ws("-", "lang", "source")).alias("language"))
