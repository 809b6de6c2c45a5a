"""Secrets in texts, with DataFrame functions only: base patterns, and a randomness test battery.

Tokens that mix letters and digits are tested as symbols of the alphabet that their letters imply: hexadecimal digits, base 32,
letters and digits, or base 64. Three tests ask whether a token could be drawn evenly from its alphabet: a chi-squared test of
uniformity, a runs test of symbols above and below the middle of the alphabet, and a test of the serial correlation of
neighbours. Their p-values are combined; a token passes unless they reject. Its evidence against ordinary text is the
likelihood ratio of even draws over draws with the symbol shares that ordinary words have. Tokens are then called by length
class: ordered by evidence, the e-value procedure keeps the share of false calls in each class below a level whatever the
dependence between tokens, and long classes, where a test has power, do not pay for short ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import let
from gleaner.llm.common import texts
from gleaner.session import cut_lineage

#: Share of false calls allowed in a length class, and the level at which the battery rejects randomness.
FALSE_CALLS = 0.01
REJECT = 1e-3

# The base patterns. Failing matches are dropped after the search, never searched again.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
KINDS = ("assign", "access", "hex", "random")

# Symbols of each alphabet in the order that the runs and serial tests use.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789",
    "alnum": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
# Shares of symbols in ordinary identifiers and words: letters in lower case, then capitals, digits, and the rest.
ORDINARY = {"lower": 0.80 / 26, "upper": 0.08 / 26, "digit": 0.08 / 10, "other": 0.04 / 4}


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, length, size>> of the matches of `pattern`: code points, and the length of `group` in the match.

    What stands between matches is cut out by the same pattern, so a start is the sum of what comes before.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("hit"), parts.alias("part"))
    empty = F.expr(f"cast(array() as {_HIT})")
    step = lambda a, r: F.struct(
        (a["at"] + F.length(r["gap"]) + F.length(r["hit"])).alias("at"),
        F.concat(
            a["out"],
            F.array(
                F.struct(
                    (a["at"] + F.length(r["gap"])).alias("start"),
                    F.length(r["hit"]).alias("length"),
                    F.length(r["part"]).alias("size"),
                    r["hit"].alias("hit"),
                )
            ),
        ).alias("out"),
    )
    return F.aggregate(rows, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda a: a["out"])


def _alphabet(token: Column) -> Column:
    """Name of the smallest alphabet that holds a token."""
    found = F.when(token.rlike("^[0-9a-f]+$"), "hex").when(token.rlike("^[0-9A-F]+$"), "HEX").when(token.rlike("^[A-Z2-7]+$"), "base32")
    found = found.when(token.rlike("^[A-Z0-9]+$"), "upper").when(token.rlike("^[a-z0-9]+$"), "lower")
    return found.when(token.rlike("^[A-Za-z0-9]+$"), "alnum").otherwise("base64")


def _two_sided(z: Column) -> Column:
    """p-value of a standard normal statistic, by the logistic approximation of its distribution."""
    return 2 / (1 + F.exp(1.5976 * F.abs(z) + 0.07056 * F.pow(F.abs(z), 3)))


def _count(token: Column, letters: str) -> Column:
    return (F.length(token) - F.length(F.regexp_replace(token, letters, ""))).cast("double")


def battery(token: Column) -> Column:
    """struct<size_class, p_random, evidence> of a token: the combined tests, and the log likelihood ratio against words."""
    symbols = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    return let(
        F.regexp_replace(token, "=+$", ""),
        lambda body: let(
            F.struct(
                body.alias("body"),
                symbols[_alphabet(body)].alias("symbols"),
                F.length(body).cast("double").alias("n"),
            ),
            lambda t: let(
                F.transform(F.split(t["body"], ""), lambda c: (F.instr(t["symbols"], c) - 1).cast("double")),
                lambda x: _tests(t, x, F.length(t["symbols"]).cast("double")),
            ),
        ),
    )


def _tests(t: Column, x: Column, k: Column) -> Column:
    """The battery of a token: t holds body, symbols and n; x the places of its symbols in the alphabet; k the size of it."""
    n = t["n"]
    # Chi-squared: the expected count of a symbol is n / k.
    counts = F.transform(F.split(t["symbols"], ""), lambda s: n - F.length(F.replace(t["body"], s, F.lit(""))))
    chi = F.aggregate(counts, F.lit(0.0), lambda a, c: a + F.pow(c - n / k, 2)) * k / n
    free = k - 1
    # Cube-root transformation of a chi-squared statistic; only an excess speaks against evenness.
    cube = (F.pow(chi / free, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    high = F.transform(x, lambda v: v > (k - 1) / 2)
    above = F.aggregate(high, F.lit(0.0), lambda a, v: a + v.cast("double"))
    neighbours = F.arrays_zip(F.slice(x, 2, F.size(x) - 1).alias("a"), F.slice(x, 1, F.size(x) - 1).alias("b"))
    crossing = lambda p: ((p["a"] > (k - 1) / 2) != (p["b"] > (k - 1) / 2)).cast("double")
    runs = F.aggregate(neighbours, F.lit(1.0), lambda a, p: a + crossing(p))
    centre = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n

    def moments(m: Column) -> Column:
        below = n - m["above"]
        mean = 1 + 2 * m["above"] * below / n
        spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
        square = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(v - m["centre"], 2))
        lagged = F.aggregate(neighbours, F.lit(0.0), lambda a, p: a + (p["a"] - m["centre"]) * (p["b"] - m["centre"]))
        serial = F.when(square > 0, lagged / square * F.sqrt(n) + 1 / F.sqrt(n)).otherwise(F.lit(99.0))
        return F.struct(
            F.when(m["cube"] > 0, _two_sided(m["cube"]) / 2).otherwise(1 - _two_sided(m["cube"]) / 2).alias("uniform"),
            F.when((m["above"] == 0) | (below == 0), F.lit(0.0)).otherwise(_two_sided((m["runs"] - mean) / spread)).alias("runs"),
            _two_sided(serial).alias("serial"),
        )

    def combined(p: Column) -> Column:
        # Fisher's combination: half the statistic is gamma distributed with three degrees, whose tail is a short sum.
        half = -sum((F.log(F.greatest(p[name], F.lit(1e-15))) for name in ("uniform", "runs", "serial")), F.lit(0.0))
        return let(half, lambda h: F.exp(-h) * (1 + h + F.pow(h, 2) / 2))

    classes = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "other": "[^A-Za-z0-9]"}
    words = sum((_count(t["body"], letters) * F.lit(math.log(ORDINARY[name])) for name, letters in classes.items()), F.lit(0.0))
    first = F.struct(cube.alias("cube"), above.alias("above"), runs.alias("runs"), centre.alias("centre"))
    return F.struct(
        F.floor(F.log2(n) * 2).cast("int").alias("size_class"),
        let(let(first, moments), combined).alias("p_random"),
        (-n * F.log(k) - words).alias("evidence"),
    )


def least_evidence(tested: DataFrame, level: float = FALSE_CALLS) -> dict[int, float]:
    """Length class -> the evidence from which its tokens are called, from rows with a struct `t` of the battery.

    With m tokens in a class, the e-value procedure calls the r strongest for the greatest r whose r-th e-value is at least
    m / (level r). Evidence is counted in steps of 1/8, so a class has a bounded number of rows whatever the corpus holds,
    and there are as many classes as half powers of two in the longest token: the driver sees a few numbers.
    """
    steps = tested.groupBy("t.size_class", F.floor(F.least(F.col("t.evidence"), F.lit(400.0)) * 8).alias("step")).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("t.p_random") >= REJECT, 1)).alias("passing")
    )
    sums = steps.selectExpr(
        "size_class",
        "step",
        "sum(n) over (partition by size_class) as m",
        "sum(passing) over (partition by size_class order by step desc) as r",
    )
    good = sums.filter((F.col("r") > 0) & (F.col("step") / 8 >= F.log(F.col("m") / (level * F.col("r")))))
    return {r["size_class"]: r["least"] for r in good.groupBy("size_class").agg((F.min("step") / 8).alias("least")).collect()}


_SPAN = "array<struct<start:int,rank:int,end:int>>"
_HIT = "array<struct<start:int,length:int,size:int,hit:string>>"


def _spans(found: Column, rank: int) -> Column:
    spans = F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), (m["start"] + m["length"]).alias("end")))
    return F.coalesce(spans, F.expr(f"cast(array() as {_SPAN})"))


def searched(rows: DataFrame) -> DataFrame:
    """Adds base (array<struct<start, rank, end>>, by start, then kind) and tested (tokens with their battery) to rows with text.

    Row by row, in the JVM. A cheap test of the text comes before each search. Tokens that touch a base span are not tested.
    """
    text = F.col("text")
    found = rows.withColumns(
        {
            "_assign": F.when(text.rlike(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"), F.filter(located(text, ASSIGN, 1), lambda m: m["size"] >= 8)),
            "_access": F.when(F.contains(text, F.lit("AKIA")), located(text, ACCESS)),
            "_hex": F.when(text.rlike(HEX), located(text, HEX)),
            "_random": F.when(text.rlike(TOKEN), located(text, TOKEN)),
        }
    )
    found = found.withColumn("base", F.array_sort(F.concat(*[_spans(F.col(f"_{name}"), rank) for rank, name in enumerate(KINDS[:3])])))
    free = lambda m: ~F.exists("base", lambda b: (b["start"] < m["start"] + m["length"]) & (m["start"] < b["end"]))
    mixed = lambda m: m["hit"].rlike("[0-9]") & m["hit"].rlike("[A-Za-z]")
    tokens = F.filter("_random", lambda m: mixed(m) & free(m))
    tested = F.transform(
        tokens, lambda m: F.struct(m["start"].alias("start"), (m["start"] + m["length"]).alias("end"), battery(m["hit"]).alias("t"))
    )
    return found.withColumn("tested", tested).drop("_assign", "_access", "_hex", "_random")


def called(tested: Column, least: dict[int, float]) -> Column:
    """Spans of the tokens that the procedure calls."""
    if not least:
        return F.expr(f"cast(array() as {_SPAN})")
    bounds = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
    kept = F.filter(tested, lambda m: (m["t"]["p_random"] >= REJECT) & (m["t"]["evidence"] >= F.element_at(bounds, m["t"]["size_class"])))
    spans = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("rank"), m["end"].alias("end")))
    return F.coalesce(spans, F.expr(f"cast(array() as {_SPAN})"))


def written(spans: Column) -> Column:
    """Comma-joined kind:start:end."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, level: float = FALSE_CALLS) -> DataFrame:
    """doc_id, counts of the base kinds, base and all spans (`kind:start:end`, code points, end exclusive) of every row.

    The texts are searched once, without a shuffle; what is found, a few numbers a row, is written to the shared checkpoint
    folder, from where the counts per length class and then the result are read. A null or empty text has no spans; repeated
    rows come out repeated; an empty table gives no rows.
    """
    found = cut_lineage(searched(texts(docs)).drop("text"))
    least = least_evidence(found.select(F.explode("tested.t").alias("t")), level)
    spans = F.array_sort(F.concat("base", called(F.col("tested"), least)))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        *[count(rank).alias(f"n_{name}") for rank, name in enumerate(KINDS[:3])],
        written(F.col("base")).alias("base"),
        written(spans).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]", level: float = FALSE_CALLS) -> DataFrame:
    """Rows of `docs` with each secret in `text` replaced by `mark`; overlapping spans are one.

    The texts are searched twice, row by row, since a search costs less than a shuffle of the texts. A null text stays null.
    """
    least = least_evidence(searched(docs).select(F.explode("tested.t").alias("t")), level)
    found = searched(docs).withColumn("_spans", F.array_sort(F.concat("base", called(F.col("tested"), least))))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        between = F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(a["out"], between, F.lit(mark))).otherwise(a["out"]).alias("out"),
        )

    rest = lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text")))
    text = F.when(F.size("_spans") > 0, F.aggregate("_spans", state, step, rest)).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*docs.columns)
