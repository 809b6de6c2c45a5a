"""Scores, dictionary search and boilerplate over whole pages and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions.urls import url_host
from gleaner.operators import boilerplate as B
from gleaner.operators import matching as K
from gleaner.operators.elements import TREE_FIELDS, node_text, parse_pages
from gleaner.plans.inputs import pages
from gleaner.plans.page_queries import LINKS_SQL
from gleaner.plans.registry import query
from gleaner.plans.tree_sql import REMAINING_SQL, REMOVED_SQL, TREE_SQL
from gleaner.sources.tables import table


@query(
    "best_element",
    f"""WITH {LINKS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(label) DESC, pos) AS rn FROM links)
        SELECT page_id, label, CAST(length(label) AS INTEGER) AS score FROM r WHERE rn = 1""",
)
def best_element(spark, folder):
    parsed = parse_pages(pages(spark, folder), keep=["page_id"])
    best = K.best_element(lambda n: F.when(n["tag"] == "a", n["text_len"]))
    scored = parsed.select("page_id", "page_text", best.alias("best")).filter("best IS NOT NULL")
    return scored.select("page_id", node_text(F.col("best.node")).alias("label"), F.col("best.score").alias("score"))


@query(
    "description_score",
    f"""WITH {TREE_SQL}, s AS (SELECT *, CAST(length(text) AS DOUBLE) * length(text) / html_len AS score FROM tree
          WHERE tag NOT IN ('html', 'body', 'head', 'script') AND length(text) > 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, node_id) AS rn FROM s)
        SELECT page_id, score, tag, path, text AS description FROM r WHERE rn = 1""",
)
def description_score(spark, folder):
    fields = (*TREE_FIELDS, "html_len", "path")
    parsed = parse_pages(pages(spark, folder), keep=["page_id"], fields=fields)
    scored = parsed.select("page_id", "page_text", K.best_element().alias("best")).filter("best IS NOT NULL")
    return scored.select(
        "page_id",
        F.col("best.score").alias("score"),
        F.col("best.node.tag").alias("tag"),
        F.col("best.node.path").alias("path"),
        node_text(F.col("best.node")).alias("description"),
    )


def _grams_sql(name: str, source: str, key: str, text: str, n: int) -> str:
    pad = "$" * (n - 1)
    return f"""{name} AS (SELECT {key}, size, gram, row_number() OVER (PARTITION BY {key}, gram) AS seen FROM
        (SELECT {key}, length(t) + {n - 1} AS size, unnest(list_transform(range(1, length(t) + {n}), lambda i: substr('{pad}' || t || '{pad}', i, {n}))) AS gram
         FROM (SELECT {key}, lower({text}) AS t FROM {source})))"""


@query(
    "ngram_search",
    f"""WITH names AS (SELECT DISTINCT p_name AS term FROM part), {_grams_sql('a', "part", 'p_partkey', "p_name || ' ' || p_type", 3)},
        {_grams_sql('b', 'names', 'term', 'term', 3)}, p AS (SELECT p_partkey, term, a.size + b.size - count(*) AS n, count(*) AS s
          FROM a JOIN b ON a.gram = b.gram AND a.seen = b.seen GROUP BY p_partkey, term, a.size, b.size)
        SELECT p_partkey, term, s / n AS similarity FROM p WHERE s / n >= 0.2""",
)
def ngram_search(spark, folder):
    part = table(spark, folder, "part")
    texts = part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return K.ngram_search(texts, ["p_partkey"], "text", part.select(F.col("p_name").alias("term")))


@query(
    "ngram_titles",
    f"""WITH names AS (SELECT DISTINCT n_name || ' ' || c_mktsegment AS term FROM customer JOIN nation ON n_nationkey = c_nationkey),
        texts AS (SELECT s_suppkey, n_name || ' machine ' || s_name AS t0 FROM supplier JOIN nation ON n_nationkey = s_nationkey),
        {_grams_sql('a', 'texts', 's_suppkey', 't0', 5)}, {_grams_sql('b', 'names', 'term', 'term', 5)},
        p AS (SELECT s_suppkey, term, a.size + b.size - count(*) AS n, count(*) AS s FROM a JOIN b ON a.gram = b.gram AND a.seen = b.seen GROUP BY s_suppkey, term, a.size, b.size)
        SELECT s_suppkey, term, s / n AS similarity FROM p WHERE s / n >= 0.2""",
)
def ngram_titles(spark, folder):
    nation = table(spark, folder, "nation")
    customers = table(spark, folder, "customer").join(nation, F.col("n_nationkey") == F.col("c_nationkey"))
    suppliers = table(spark, folder, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
    terms = customers.select(F.concat_ws(" ", "n_name", "c_mktsegment").alias("term"))
    texts = suppliers.select("s_suppkey", F.concat_ws(" ", "n_name", F.lit("machine"), "s_name").alias("text"))
    return K.ngram_search(texts, ["s_suppkey"], "text", terms, K.TITLE_N)


@query(
    "fuzzy_field",
    f"""WITH {TREE_SQL}, words AS (SELECT DISTINCT unnest(string_split_regex(text, '[\\s.,]+')) AS term FROM benchmark),
        terms AS (SELECT term FROM words WHERE term <> ''), texts AS (SELECT DISTINCT lower(text) AS label FROM tree
          WHERE length(text) + 2 <= 5 * (SELECT max(length(term)) + 2 FROM terms)),
        {_grams_sql('a', 'texts', 'label', 'label', 3)}, {_grams_sql('b', 'terms', 'term', 'term', 3)},
        p AS (SELECT label, term, count(*) / (a.size + b.size - count(*)) AS similarity FROM a JOIN b ON a.gram = b.gram AND a.seen = b.seen
          GROUP BY label, term, a.size, b.size HAVING similarity >= 0.2),
        r AS (SELECT page_id, node_id, tag, p.term, similarity, row_number() OVER (PARTITION BY page_id ORDER BY similarity DESC, node_id, p.term) AS rn
          FROM tree JOIN p ON lower(tree.text) = p.label)
        SELECT page_id, node_id, tag, term, similarity FROM r WHERE rn = 1""",
)
def fuzzy_field(spark, folder):
    words = table(spark, folder, "benchmark").select(F.explode(F.split("text", r"[\s.,]+")).alias("term")).filter("term <> ''")
    return K.fuzzy_field(parse_pages(pages(spark, folder), keep=["page_id"]), words)


def _by_host(spark, folder):
    return pages(spark, folder).withColumn("host", url_host(F.col("url")))


@query("remove_boilerplate", REMAINING_SQL)
def remove_boilerplate(spark, folder):
    return B.remove_boilerplate(_by_host(spark, folder))


@query("boilerplate_elements", REMOVED_SQL)
def boilerplate_elements(spark, folder):
    return B.boilerplate_elements(_by_host(spark, folder))
