"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learned from a part of the labelled rows: words and word beginnings that stand in toxic texts far more often than
in others. The features of a text are the density and spread of lexicon words, how near they stand to words that address the
reader, and the rates of capitals, punctuation and obfuscated words. Another part of the labelled rows trains the trees, a
third one the calibration. Nothing but the text enters a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, give_back, map_batches, texts
from gleaner.session import cut_lineage

#: Labelled rows used for training, the first by the hash of their id; bounds what is broadcast and what training reads.
LABELLED = 20_000
#: Entries of the lexicon, the strongest first.
LEXICON = 400
STRENGTH = 12.0
STEMS = (4, 5, 6)
NEAR = 5

_WORD = re.compile(r"[^\s]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"(?<=[^\W\d_])[\d@$*.!_-]+(?=[^\W\d_])")
_LEET = str.maketrans("013457@$!", "oieastasi")
# Capitals of every script.
_CAPITAL = regex.compile(r"\p{Uppercase}")
_PUNCTUATION = re.compile(r"[!?.,;:*#%&$]")
# Words that address the reader, in the languages of the texts.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)


def plain(token: str) -> str:
    """A word without the marks around it, in lower case."""
    return _EDGE.sub("", token).lower()


def pieces(word: str) -> set[str]:
    """What the lexicon can hold of a word: itself, and its beginnings, marked by a star."""
    return {word} | {word[:n] + "*" for n in STEMS if len(word) > n}


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(doc_id, toxic, part) of at most `limit` rows that are not held out; the greatest label of an id counts.

    Rows without an id or a label are left out. Parts by hash: 0 to 4 for the lexicon, 5 to 7 for the trees, 8 and 9 for
    calibration.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return known.withColumn("part", F.pmod(F.hash("doc_id", F.lit(7)), F.lit(10)))


def learn_lexicon(docs: DataFrame, chosen: DataFrame) -> dict[str, float]:
    """Piece -> log odds of toxic against other texts, for the `LEXICON` pieces with the greatest likelihood ratio."""
    read = docs.join(F.broadcast(chosen.filter("part < 5")), "doc_id").select("text", "toxic")
    arrow = arrow_schema(docs.sparkSession, "piece string, toxic long, other long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = {p for w in {plain(t) for t in set(_WORD.findall(text))} if w for p in pieces(w)}
                counts[toxic == 1].update(found | {""})
        # Only pieces of toxic texts can enter; the empty piece counts the texts.
        names = list(counts[1] | Counter({"": 0}) | Counter({p: n for p, n in counts[0].items()}))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[1][p] for p in names]), pa.array([counts[0][p] for p in names])],
            schema=arrow,
        )
        del counts, names
        give_back()

    counted = read.mapInArrow(run, "piece string, toxic long, other long").groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counted = cut_lineage(counted.filter("toxic > 0 or piece = ''"))
    total = counted.filter("piece = ''").first()
    if total is None or not total["toxic"] or not total["other"]:
        return {}
    p, n = F.col("toxic"), F.col("other")
    odds = F.log((p + 0.5) / (total["toxic"] + 1.0)) - F.log((n + 0.5) / (total["other"] + 1.0))
    base = total["toxic"] / (total["toxic"] + total["other"])
    here = p / (p + n)
    ratio = 2 * (p * F.log(here / base) + F.when(n > 0, n * F.log((1 - here) / (1 - base))).otherwise(0.0))
    best = counted.filter("piece != ''").select("piece", odds.alias("odds"), ratio.alias("ratio"))
    best = best.filter((F.col("odds") > 1.5) & (F.col("ratio") >= STRENGTH)).orderBy(F.desc("ratio"), "piece").limit(LEXICON)
    return {r["piece"]: float(r["odds"]) for r in best.collect()}


class Measure:
    """Dense features of a text; what it knows of a token is kept for the next text."""

    def __init__(self, lexicon: dict[str, float], remembered: int = 150_000):
        self.lexicon, self.remembered = lexicon, remembered
        self.known: dict[str, tuple[float, float, bool, bool]] = {}

    def _weight(self, word: str) -> float:
        return max((self.lexicon.get(p, 0.0) for p in pieces(word)), default=0.0)

    def _token(self, token: str) -> tuple[float, float, bool, bool]:
        """Weight in the lexicon, weight once cleared of obfuscation, whether obfuscated, whether it addresses the reader."""
        word = plain(token)
        weight = self._weight(word) if word else 0.0
        hidden = bool(_INNER.search(token)) or bool(re.search(r"(.)\1\1", word))
        cleared = 0.0
        if hidden and not weight:
            clear = re.sub(r"(.)\1\1+", r"\1", "".join(_LETTERS.findall(word.translate(_LEET))))
            cleared = self._weight(clear)
        return weight, cleared, hidden, word in SECOND_PERSON

    def __call__(self, text: str) -> list[float]:
        tokens = _WORD.findall(text)
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        hits, near, hidden, weights, cleared, kinds = [], 0, 0, 0.0, 0, set()
        reader = []
        for i, token in enumerate(tokens):
            found = known.get(token)
            if found is None:
                found = known[token] = self._token(token)
            if found[0] > 0 or found[1] > 0:
                hits.append(i)
                kinds.add(plain(token))
                weights += found[0] + found[1]
                cleared += found[0] == 0
            hidden += found[2]
            if found[3]:
                reader.append(i)
        if hits and reader:
            at = np.array(reader)
            place = np.searchsorted(at, hits)
            left = np.abs(np.array(hits) - at[np.maximum(place - 1, 0)])
            right = np.abs(at[np.minimum(place, len(at) - 1)] - np.array(hits))
            near = int((np.minimum(left, right) <= NEAR).sum())
        n = max(1, len(tokens))
        size = max(1, len(text))
        upper = len(_CAPITAL.findall(text))
        strongest = max((max(known[tokens[i]][:2]) for i in hits), default=0.0)
        return [
            len(hits) / n,
            weights / n,
            strongest,
            math.log1p(len(hits)),
            math.log1p(len(kinds)),
            near / n,
            len(reader) / n,
            upper / size,
            len(_PUNCTUATION.findall(text)) / size,
            text.count("!") / size,
            hidden / n,
            math.log1p(cleared),
            math.log1p(len(tokens)),
        ]


def dense_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`rows` with the column features; a null text is measured as empty."""
    schema = ", ".join([f"`{name}` {kind}" for name, kind in rows.dtypes] + ["features array<double>"])
    measure = Measure(lexicon)

    def add(batch: pa.RecordBatch) -> dict[str, list]:
        found = dict(zip(batch.schema.names, batch.columns))
        return found | {"features": [measure(t or "") for t in batch["text"].to_pylist()]}

    return map_batches(rows, add, schema)


class Model:
    """A lexicon, trees over its features and a calibration, learned from labelled rows."""

    def __init__(self, docs: DataFrame, labels: DataFrame, limit: int = LABELLED):
        """Texts are scanned twice for at most `limit` labelled rows, found by a broadcast of their ids."""
        chosen = cut_lineage(labelled(labels, limit))
        self.lexicon = learn_lexicon(docs, chosen)
        rows = dense_features(docs.join(F.broadcast(chosen.filter("part >= 5")), "doc_id").select("text", "part", "toxic"), self.lexicon)
        known = cut_lineage(rows.select("part", F.col("toxic").cast("double").alias("label"), array_to_vector("features").alias("features")))
        n = {(r["trees"], r["label"]): r["n"] for r in known.groupBy((F.col("part") < 8).alias("trees"), "label").agg(F.count("*").alias("n")).collect()}
        self.trees = self.fair = None
        # Without both kinds of labels every score is the share of toxic ones.
        self.share = float(chosen.agg(F.coalesce(F.avg(F.col("toxic").cast("double")), F.lit(0.0))).first()[0])
        if n.get((True, 1.0)) and n.get((True, 0.0)):
            trees = GBTClassifier(maxIter=10, maxDepth=3, stepSize=0.3, seed=7, maxBins=64, featuresCol="features", labelCol="label")
            # Training sees a bounded table; one partition spares its many small steps a shuffle.
            self.trees = trees.fit(known.filter("part < 8").coalesce(1))
            if n.get((False, 1.0)) and n.get((False, 0.0)):
                fair = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score")
                self.fair = fair.fit(self._raw(known.filter("part >= 8")).drop("features").coalesce(1))

    def _raw(self, rows: DataFrame) -> DataFrame:
        return self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")

    def score(self, rows: DataFrame) -> DataFrame:
        """`rows` with the column score: one pass over the texts, no shuffle."""
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share))
        kept = rows.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
        found = self._raw(dense_features(kept, self.lexicon).select("row", array_to_vector("features").alias("features")))
        found = self.fair.transform(found) if self.fair else found.withColumn("score", F.col("raw"))
        return found.select("row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row, trained on the labelled rows that are not held out.

    A null or empty text has features of zeros and a score like any other. A null id is not held out; repeated rows are
    scored alike; an empty table gives no rows.
    """
    docs = texts(docs)
    return Model(docs, labels, limit).score(docs).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """The rows of `docs` that score below 0.5, with their columns."""
    scored = Model(texts(docs), labels, limit).score(docs.select(F.struct("*").alias("_row"), "text"))
    return scored.filter("score < 0.5").select("_row.*")
