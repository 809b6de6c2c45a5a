"""Spelling variants: pairs of words one edit apart, by composing the acceptor of the vocabulary with a one-edit transducer.

The words of a partition make a minimised deterministic acceptor. Composed with a transducer that changes, adds or drops one
letter, and with the acceptor again, it accepts exactly the pairs of words one edit apart; the transducer edits only where two
words part, so each pair has one path. A partition holds the words behind one state: the state that the first letters of a word
lead to, in the acceptor of the words for edits behind these letters, in that of the reversed words for edits before them. A
state with too many words is split by the place of the edit: an edit in the front half of an interval leaves the letters behind
it equal, one in the back half those before it. An interval of one place bounds its words by the alphabet alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import arrow_schema, table_of, texts
from gleaner.session import cut_lineage

#: Distinct words counted in a Python worker before they go to the shuffle; it bounds memory and changes no result.
HELD = 200_000
#: Words of a state from which it is split, and letters that lead to the first states.
CROWD, LEAD = 4000, 3
#: Characters of a text looked at in one go.
STRETCH = 1 << 20
#: Pairs sent on in one batch.
SENT = 20_000

#: Letters are A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1; every other byte ends a run.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
_GROUP = ["size", "stop", "head", "tail"]
_ANYWHERE = (1 << 31) - 1


def runs(text: str) -> Counter[bytes]:
    """How often each run of letters stands in a text, in Latin-1, A-Z in lower case."""
    # Code points beyond Latin-1 become question marks, which are no letters.
    data = text.encode("latin-1", "replace").translate(_LETTERS)
    if len(data) <= STRETCH:
        return Counter(data.split())
    found: Counter[bytes] = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + STRETCH)
        end = len(data) if end < 0 else end
        found.update(data[at:end].split())
        at = end
    return found


def altered(run: bytes, key: int, every: int) -> bytes:
    """The run, without one letter where `every` divides the checksum of the document's key and the run."""
    mark = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), key)
    if mark % every:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least: int = 6, often: int = 5, every: int = 199) -> DataFrame:
    """(word, n) of the words of at least `least` letters and `often` occurrences in all texts.

    Words are counted per task before the shuffle, so a frequent word moves one row per task. A null doc_id is written empty.
    """
    schema = "word string, n long"
    arrow = arrow_schema(docs.sparkSession, schema)

    def counted(words: Counter[bytes]) -> pa.RecordBatch:
        names = [w.decode("latin-1") for w in words]
        return table_of(arrow, {"word": names, "n": list(words.values())}).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                key = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for letters, n in runs(text).items():
                    if len(letters) >= least:
                        word = altered(letters, key, every)
                        if len(word) >= least:
                            words[word] += n
                if len(words) > HELD:
                    yield counted(words)
                    words.clear()
        if words:
            yield counted(words)

    return texts(docs).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


class Acceptor:
    """The least deterministic acceptor of sorted distinct words: states with equal endings are one."""

    def __init__(self, words: Iterable[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def close(depth: int) -> None:
            """Replace the states of the last word behind `depth` by known ones with the same endings."""
            while len(path) - 1 > depth:
                state = path.pop()
                kept = known.setdefault((self.final[state], tuple(self.arcs[state].items())), state)
                self.arcs[path[-1]][last[len(path) - 1]] = kept

        for word in words:
            same = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                same += 1
            close(same)
            for letter in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        close(0)

    def endings(self, state: int, other: int) -> list[str]:
        """What both states accept."""
        out, todo = [], [(state, other, "")]
        while todo:
            p, q, done = todo.pop()
            walked: list[str] = []
            while True:
                if self.final[p] and self.final[q]:
                    out.append(done + "".join(walked))
                both = self.arcs[p].keys() & self.arcs[q].keys() if p != q else self.arcs[p].keys()
                if len(both) != 1:
                    break
                [letter] = both
                walked.append(letter)
                p, q = self.arcs[p][letter], self.arcs[q][letter]
            done += "".join(walked)
            todo.extend((self.arcs[p][c], self.arcs[q][c], done + c) for c in both)
        return out

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of endings of `state` that one edit at their first letter makes equal."""
        arcs = self.arcs[state]
        out = []
        for (x, p), (y, q) in combinations(arcs.items(), 2):
            out.extend([(x + end, y + end) for end in self.endings(p, q)])
        for x, p in arcs.items():
            # The two words part here, so the shorter one goes on with another letter.
            out.extend([(end, x + end) for end in self.endings(state, p) if not end.startswith(x)])
        return out

    def pairs(self, places: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs one edit apart whose first difference is one of the first `places` letters."""
        known: dict[int, list[tuple[str, str]]] = {}
        todo = [(0, "")]
        while todo:
            state, done = todo.pop()
            walked: list[str] = []
            while len(self.arcs[state]) == 1 and not self.final[state]:
                [(letter, state)] = self.arcs[state].items()
                walked.append(letter)
            done += "".join(walked)
            if len(done) >= places:
                continue
            if state not in known:
                known[state] = self.edits(state)
            for a, b in known[state]:
                yield done + a, done + b
            todo.extend((p, done + letter) for letter, p in self.arcs[state].items())


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, int]]]:
    """(size, stop, head, tail) and its words with their counts, from rows sorted by group and word."""
    now, words = None, {}
    for batch in batches:
        columns = [batch[name].to_pylist() for name in (*_GROUP, "word", "n")]
        for *group, word, n in zip(*columns):
            if group != now:
                if now is not None:
                    yield tuple(now), words
                now, words = group, {}
            words[word] = n
    if now is not None:
        yield tuple(now), words


def _near_words(groups: DataFrame) -> DataFrame:
    """(word, near, near_n), both ways, of the pairs in groups of bounded size."""
    schema = "word string, near string, near_n long"
    arrow = arrow_schema(groups.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str, int]] = []

        def sent() -> Iterator[pa.RecordBatch]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
            rows.clear()

        for (size, stop, head, _), words in _grouped(batches):
            # The words of a group are the endings of the state that the head leads to.
            behind = Acceptor(w[len(head) :] for w in words)
            for a, b in behind.pairs(stop - len(head)):
                a, b = head + a, head + b
                if size and min(len(a), len(b)) > size:
                    # Two of the longer words: the group of their own length has this pair.
                    continue
                rows += [(a, b, words[b]), (b, a, words[a])]
                if len(rows) >= SENT:
                    yield from sent()
        if rows:
            yield from sent()

    return groups.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "word").mapInArrow(run, schema)


def _group(size: Column, stop: Column, head: Column, tail: Column) -> Column:
    return F.struct(size.cast("int").alias("size"), stop.cast("int").alias("stop"), head.alias("head"), tail.alias("tail"))


def _first_groups(words: DataFrame, least: int) -> DataFrame:
    """The groups of each word: behind its first letters, and before what follows them, as the shorter and the longer of a pair."""
    lead, word, n = min(LEAD, least // 2), F.col("word"), F.length("word")
    groups = [_group(F.lit(0), F.lit(_ANYWHERE), F.substring(word, 1, lead), F.lit(""))]
    for size in [n, n - 1] if lead else []:
        groups.append(F.when(size >= least, _group(size, F.lit(lead), F.lit(""), F.right(word, size - lead))))
    return words.select("word", "n", F.explode(F.array_compact(F.array(*groups))).alias("group")).select("word", "n", "group.*")


def _halves(groups: DataFrame, least: int) -> DataFrame:
    """Groups by the half of the interval that holds the edit; the length of the shorter word is stated first."""
    sizes = F.when(F.col("size") > 0, F.array("size")).otherwise(F.array(F.length("word"), F.length("word") - 1))
    stated = groups.withColumn("s", F.explode(sizes)).filter(F.col("s") >= least)
    stated = stated.withColumn("stop", F.when(F.col("size") > 0, F.col("stop")).otherwise(F.col("s") + 1))
    s, stop, head, tail, word = (F.col(c) for c in ("s", "stop", "head", "tail", "word"))
    half = F.floor((F.length(head) + stop) / 2).cast("int")
    front = _group(s, half, head, F.right(word, s - half))
    back = _group(s, stop, F.left(word, half), tail)
    return stated.select("word", "n", F.explode(F.array(front, back)).alias("group")).select("word", "n", "group.*")


def near_words(words: DataFrame, least: int, crowd: int = CROWD) -> DataFrame:
    """(word, near, near_n) of all words (word, n) of at least `least` letters that are one edit apart, both ways, each once.

    A group is enumerated in one task once it has at most `crowd` words or one place for the edit; larger ones are split, in
    rounds that grow with the logarithm of the length of their words. Words without company in a group leave it.
    """
    rows, found = _first_groups(words, least), []
    while True:
        counts = rows.groupBy(*_GROUP).agg(F.count("*").alias("words")).filter("words > 1")
        sized = cut_lineage(rows.join(counts, _GROUP))
        crowded = (F.col("words") > crowd) & (F.col("stop") - F.length("head") > 1)
        found.append(_near_words(sized.filter(~crowded)))
        hot = sized.filter(crowded).drop("words")
        if hot.isEmpty():
            break
        rows = _halves(hot, least)
    near = found[0]
    for other in found[1:]:
        near = near.unionByName(other)
    return near


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the forms are followed with doubled steps, and counts grow on the way, so all end."""
    reached = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        stepped = cut_lineage(reached.join(ahead, "root", "left"))
        reached = stepped.select("word", F.coalesce("ahead", "root").alias("root"))
        if stepped.filter("ahead is not null").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, least: int = 6, often: int = 5, every: int = 199, factor: int = 5, crowd: int = CROWD) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of `least` letters and `often` occurrences.

    A form is the most frequent near word (ties: the first in code-point order) that stands at least `factor` times as often;
    the root is the last form on the way. Null and empty texts have no words; repeated rows count again; a run of any length
    is one word; an empty table gives no rows.
    """
    if least < 1:
        raise ValueError("a word has a letter at least")
    words = cut_lineage(vocabulary(docs, least, often, every))
    near = near_words(words, least, crowd).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    best_n = -F.col("best.less")
    is_form = best_n >= factor * F.col("n")
    found = cut_lineage(
        words.join(near, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, best_n).alias("form_n"),
        )
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
