"""Language of words and texts by a linear-chain conditional random field.

The words of a text are a chain of labels. A word's score for a language adds the weights of its beginnings, its endings, its
letter n-grams and of the lexicon classes it stands in; learned transitions tie it to its neighbours. Forward and backward sums
give the probability of each language at each word, so a text that changes its language is labelled word by word; the language
of the text is the one with the greatest expected share of its words.

Training sees chains that change their language: stretches of sampled texts, joined at random, beside stretches of one text.
Chains are summed in blocks: the transfer matrix of every block is made for all blocks at once, the messages between the blocks
of a text follow one after another, and the probabilities inside all blocks are taken at once again. This is the exact sum.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import map_batches, texts
from gleaner.session import cut_lineage

#: Texts of each language that training reads, the first by the hash of their id, and words of a stretch of one.
TRAINING_TEXTS, TRAINING_WORDS = 400, 120
#: Hash slots of the features, rounds of training, chains of it, and what pulls weights to zero.
SLOTS, ROUNDS, CHAINS, SHRINK = 1 << 17, 40, 900, 1e-3
_PRIME, _MIXER, _SHIFT = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15), np.uint64(47)
#: Languages that training reads, those with most ids.
LANGUAGES = 100
#: Words of a block of a chain, blocks summed at once, words and letters remembered per Python worker, characters cut into
#: words at once. They bound memory and change no result.
BLOCK, AT_ONCE, REMEMBERED, LETTERS, STRETCH = 64, 4096, 200_000, 1 << 23, 1 << 20

UNKNOWN = "und"
#: Runs of letters; numerals beyond Latin-1 stand as letters beside one.
_WORD = re.compile(r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+")
#: Latin-1 letters in lower case, everything else blank.
_LATIN = bytes(ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))
#: Steps of a chain between two that bring its sums back to 1; scores of a word differ by 60 at most.
_STEPS = 8


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def feature_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash slot) of the features of lower-case words: each word whole, its length, the first and the last one to
    four letters, and its letter n-grams with a mark at each end."""
    letters = np.frombuffer("".join([f"\n{w}\n" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) for w in words])
    start = np.cumsum(sizes + 2) - sizes - 1
    number = np.arange(len(words))
    owner = np.repeat(number, sizes + 2)
    powers = np.multiply.accumulate(np.full(int(sizes.max()) + 2, _PRIME, np.uint64))
    whole = np.add.reduceat(letters * powers[np.arange(len(letters)) - np.repeat(start - 1, sizes + 2)], start - 1)
    found = [(number, whole * _PRIME), (number, np.minimum(sizes, 12).astype(np.uint64) * _PRIME + np.uint64(1))]
    code = np.zeros(len(letters), np.uint64)
    for n in range(1, 4):
        code = code[: len(letters) - n + 1] * _PRIME + letters[n - 1 :]
        inside = np.flatnonzero(owner[: len(code)] == owner[n - 1 :])
        found.append((owner[inside], code[inside] * _PRIME + np.uint64(1 + n)))
    first, last = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    for n in range(1, 5):
        longer = sizes > n
        first[longer] = first[longer] * _PRIME + letters[start[longer] + n - 1]
        last[longer] = last[longer] * _PRIME + letters[(start + sizes - n)[longer]]
        found += [(number[longer], first[longer] * _PRIME + np.uint64(4 + n)), (number[longer], last[longer] * _PRIME + np.uint64(8 + n))]
    slots = np.concatenate([c for _, c in found]) * _MIXER >> _SHIFT
    return np.concatenate([o for o, _ in found]), slots.astype(np.int64)


class Transfers:
    """Sums over the label chains of texts whose words have scores."""

    def __init__(self, change: np.ndarray):
        self.size = len(change)
        self.change = np.exp(change - change.max())

    def _products(self, odds: np.ndarray, real: np.ndarray) -> np.ndarray:
        """Transfer matrix of each block: from the label before the block to the label of its last word."""
        n, k = len(odds), self.size
        out = np.broadcast_to(np.eye(k), (n, k, k)).copy()
        for t in range(odds.shape[1]):
            step = (out.reshape(-1, k) @ self.change).reshape(n, k, k)
            step *= odds[:, t, None, :]
            if t % _STEPS == _STEPS - 1:
                step /= step.sum(axis=(1, 2), keepdims=True)
            np.copyto(out, step, where=real[:, t, None, None])
        return out

    def _messages(self, products: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Messages that enter each block from its left and from its right; `first` is the first block of each text."""
        left = np.full((len(products), self.size), 1.0)
        right = np.full((len(products), self.size), 1.0)
        longest = int(counts.max())
        order = np.argsort(-counts, kind="stable")
        first, counts = first[order], counts[order]
        for t in range(1, longest):
            # Texts with more than t blocks stand first.
            at = first[: np.searchsorted(-counts, -t)]
            step = np.einsum("ni,nij->nj", left[at + t - 1], products[at + t - 1])
            left[at + t] = step / step.sum(axis=1, keepdims=True)
            last = at + counts[: len(at)] - 1 - t
            step = np.einsum("nij,nj->ni", products[last + 1], right[last + 1])
            right[last] = step / step.sum(axis=1, keepdims=True)
        return left, right

    def probabilities(self, odds: np.ndarray, real: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each label at each word of blocks, and the backward messages at each word."""
        n, width, k = odds.shape
        ahead, behind = np.empty((n, width, k)), np.empty((n, width, k))
        message = left.copy()
        for t in range(width):
            step = message @ self.change
            step *= odds[:, t]
            if t % _STEPS == _STEPS - 1:
                step /= step.sum(axis=1, keepdims=True)
            np.copyto(message, step, where=real[:, t, None])
            ahead[:, t] = message
        message = right.copy()
        for t in range(width - 1, -1, -1):
            behind[:, t] = message
            step = (message * odds[:, t]) @ self.change.T
            if t % _STEPS == 0:
                step /= step.sum(axis=1, keepdims=True)
            np.copyto(message, step, where=real[:, t, None])
        found = ahead * behind
        found /= found.sum(axis=2, keepdims=True)
        return found, behind

    def blocks(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word in blocks of `BLOCK` words, a text after another, and the number of blocks of each text."""
        per_text = -(-counts // BLOCK)
        first = np.cumsum(per_text) - per_text
        starts = np.cumsum(counts) - counts
        return np.repeat(first * BLOCK - starts, counts) + np.arange(int(counts.sum())), per_text

    def label(self, words: np.ndarray, counts: np.ndarray, odds_of: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        """Probability of each label at each word, some words after others; `words` are rows of `odds_of`, texts in turn."""
        place, per_text = self.blocks(counts)
        total = int(per_text.sum())
        padded = np.full(total * BLOCK, -1, np.int32)
        padded[place] = words
        padded = padded.reshape(total, BLOCK)
        products = np.empty((total, self.size, self.size))
        for i in range(0, total, AT_ONCE):
            part = padded[i : i + AT_ONCE]
            products[i : i + AT_ONCE] = self._products(odds_of[part], part >= 0)
        # A first word has no label before it: the message that enters is even over labels.
        left, right = self._messages(products, np.cumsum(per_text) - per_text, per_text)
        done = 0
        for i in range(0, total, AT_ONCE):
            part = padded[i : i + AT_ONCE]
            found, _ = self.probabilities(odds_of[part], part >= 0, left[i : i + AT_ONCE], right[i : i + AT_ONCE])
            found = found[part >= 0]
            yield slice(done, done + len(found)), found
            done += len(found)


def odds(scores: np.ndarray) -> np.ndarray:
    """Exponentials of the scores of words, the greatest of each word 1."""
    return np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -60.0))


class Known(dict):
    """Words by number; a word not met before gets the next one and waits to be scored."""

    def __init__(self):
        super().__init__()
        self.waiting: list[bytes | str] = []
        self.letters = 0

    def __missing__(self, word: bytes | str) -> int:
        self.waiting.append(word)
        self.letters += len(word)
        self[word] = number = len(self)
        return number


class Field:
    """Weights of the features, transitions and the lexicon; what it knows of a word is kept for the next text."""

    def __init__(self, names: list[str], weights: np.ndarray, change: np.ndarray, lexicon: dict[str, list[int]]):
        self.names, self.weights, self.change, self.lexicon = names, weights, change, lexicon
        self.chains = Transfers(change)
        self.known = Known()
        self.odds_of = np.ones((1, len(names)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": Known(), "odds_of": np.ones((1, len(self.names)))}

    def _numbers(self, text: str) -> np.ndarray:
        """Numbers of a text's words, cut stretch by stretch; new ones wait for their odds."""
        number = self.known.__getitem__
        parts = [np.fromiter(map(number, words), np.int32, len(words)) for words in _stretches(text)]
        return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.int32), *parts])

    def _score(self) -> None:
        """Odds of the words that wait."""
        waiting, self.known.waiting = self.known.waiting, []
        if not waiting:
            return
        end = len(self.known)
        if end > len(self.odds_of):
            room = np.ones((2 * end, len(self.names)))
            room[: len(self.odds_of)] = self.odds_of
            self.odds_of = room
        at = end - len(waiting)
        for i in range(0, len(waiting), AT_ONCE):
            words = [w.decode("latin-1") if isinstance(w, bytes) else w for w in waiting[i : i + AT_ONCE]]
            owner, slots = hashed(words, self.lexicon)
            scores = np.stack([np.bincount(owner, self.weights[slots, j], len(words)) for j in range(len(self.names))], axis=1)
            self.odds_of[at + i : at + i + len(words)] = odds(scores)

    def shares(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Expected share of each language in the words of each text, and the number of its words."""
        if len(self.known) > REMEMBERED or self.known.letters > LETTERS:
            self.known = Known()
        words = [self._numbers(text) for text in batch]
        self._score()
        counts = np.array([len(w) for w in words])
        out = np.zeros((len(batch), len(self.names)))
        some = np.flatnonzero(counts)
        if len(some):
            of = np.repeat(some, counts[some])
            for part, found in self.chains.label(np.concatenate(words), counts[some], self.odds_of):
                for k in range(len(self.names)):
                    out[:, k] += np.bincount(of[part], found[:, k], len(batch))
            out[some] /= counts[some, None]
        return out, counts

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, language) of the runs of words with one most likely language, in code points."""
        words = self._numbers(text)
        self._score()
        if not len(words):
            return []
        best = np.concatenate([found.argmax(axis=1) for _, found in self.chains.label(words, np.array([len(words)]), self.odds_of)])
        out: list[tuple[int, int, str]] = []
        lettered = (m for m in _WORD.finditer(text) if any(map(str.isalpha, m[0])))
        for m, k in zip(lettered, best.tolist()):
            name = self.names[k]
            if out and out[-1][2] == name:
                out[-1] = (out[-1][0], m.end(), name)
            else:
                out.append((m.start(), m.end(), name))
        return out


def _stretches(text: str) -> Iterator[list[bytes] | list[str]]:
    """Words in lower case, stretch by stretch of a long text; a stretch ends where a word ends.

    Those of a Latin-1 stretch are bytes, as these are cut and lowered at once.
    """
    at = 0
    while at < len(text):
        end = min(at + STRETCH, len(text))
        while end < len(text) and _WORD.match(text[end]):
            end += 1
        part = text if end - at == len(text) else text[at:end]
        try:
            yield part.encode("latin-1").translate(_LATIN).split()
        except UnicodeEncodeError:
            yield [w.lower() for w in _WORD.findall(part) if any(map(str.isalpha, w))]
        at = end


def hashed(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, slot) of the features of words and of the lexicon classes they stand in."""
    owner, slots = feature_slots(words)
    classes = [(i, slot) for i, found in enumerate(map(lexicon.get, words)) if found for slot in found]
    if classes:
        more = np.array(classes).T
        owner, slots = np.concatenate([owner, more[0]]), np.concatenate([slots, more[1]])
    return owner, slots


def _lexicon(samples: list[tuple[str, list[str]]], names: list[str]) -> dict[str, list[int]]:
    """Word -> classes: the languages it stands in at least twice, and whether all, most or some of its occurrences are in one.

    Classes have slots of their own behind those of the features.
    """
    counts: dict[str, Counter] = {}
    for name, words in samples:
        for word in words:
            counts.setdefault(word, Counter())[name] += 1
    out = {}
    for word, by_name in counts.items():
        total = sum(by_name.values())
        classes = [SLOTS + 3 * names.index(name) + (n < total) + (2 * n <= total) for name, n in sorted(by_name.items()) if n > 1]
        if classes:
            out[word] = classes
    return out


def _training_chains(samples: list[tuple[str, list[str]]], draw: random.Random) -> list[list[tuple[str, str]]]:
    """Chains of (word, language): stretches of one text, and joined stretches of several."""
    chains = []
    for k in range(CHAINS):
        chain: list[tuple[str, str]] = []
        for _ in range(1 if k % 3 == 0 else draw.randint(2, 4)):
            name, words = draw.choice(samples)
            size = draw.randint(3, 20)
            at = draw.randrange(max(1, len(words) - size + 1))
            chain += [(w, name) for w in words[at : at + size]]
        chains.append(chain[:BLOCK])
    return chains


def train(samples: list[tuple[str, list[str]]]) -> Field | None:
    """A field from (language, words) of sampled stretches, by ascent on the conditional likelihood of training chains.

    The lexicon comes from one half of the samples and the chains from the other, so that its classes are as sure in training
    as they are later; null without any word.
    """
    samples = [s for s in samples if s[1]]
    names = sorted({name for name, _ in samples})
    if not names:
        return None
    draw = random.Random(11)
    lexicon = _lexicon(samples[::2], names)
    chains = _training_chains(samples[1::2] or samples, draw)
    vocabulary = sorted({w for chain in chains for w, _ in chain})
    number = {w: i for i, w in enumerate(vocabulary)}
    owner, slot = hashed(vocabulary, lexicon)
    used, slot = np.unique(slot, return_inverse=True)

    k = len(names)
    words = np.full((len(chains), BLOCK), -1)
    truth = np.zeros((len(chains), BLOCK), np.int64)
    for i, chain in enumerate(chains):
        words[i, : len(chain)] = [number[w] for w, _ in chain]
        truth[i, : len(chain)] = [names.index(name) for _, name in chain]
    real = words >= 0
    pair = real[:, 1:] & real[:, :-1]
    own = np.zeros((len(chains), BLOCK, k))
    own[np.nonzero(real) + (truth[real],)] = 1.0
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:, :-1][pair], truth[:, 1:][pair]), 1.0)

    weights, change = np.zeros((len(used), k)), np.zeros((k, k))
    moments = [np.zeros_like(weights), np.zeros_like(change)]
    even = np.ones((len(chains), k))
    for _ in range(ROUNDS):
        scores = np.stack([np.bincount(owner, weights[slot, j], len(vocabulary)) for j in range(k)], axis=1)
        likely = odds(scores)
        chain = Transfers(change)
        p, behind = chain.probabilities(likely[words], real, even, even)
        # Expected transitions: the probability of a label times that of the next one after it.
        both = chain.change[None, None] * (likely[words] * behind)[:, 1:, None, :]
        both *= p[:, :-1, :, None] / both.sum(axis=3, keepdims=True)
        rest = (own - p) * real[..., None]
        slope = np.stack([np.bincount(words[real], rest[..., j][real], len(vocabulary)) for j in range(k)], axis=1)
        slopes = [
            np.stack([np.bincount(slot, slope[owner, j], len(used)) for j in range(k)], axis=1) - SHRINK * weights * len(chains),
            seen - (both * pair[..., None, None]).sum(axis=(0, 1)) - SHRINK * change * len(chains),
        ]
        for value, moment, g in zip((weights, change), moments, slopes):
            moment += g * g
            value += 0.3 * g / np.sqrt(moment + 1e-8)
    full = np.zeros((SLOTS + 3 * k, k), np.float32)
    full[used] = weights
    return Field(names, full, change, lexicon)


def learned_field(docs: DataFrame, most: int = TRAINING_TEXTS, size: int = TRAINING_WORDS) -> Field | None:
    """A field learned from about the first `most` ids of each language by their hash, a stretch of `size` words of each.

    Only rows with an id that is not held out and a language count. Ids are chosen without reading a text, and cut to some
    thousands by their hash before they are compared; the stretch starts at a place given by the hash of the id. At most
    `most` * `LANGUAGES` stretches come to the driver.
    """
    known = docs.filter("doc_id is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    mark = F.xxhash64("doc_id")
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).orderBy(F.desc("ids"), "lang").limit(LANGUAGES)
    some = known.select("doc_id", "lang").join(F.broadcast(sizes), "lang").filter(F.pmod(mark, F.greatest(F.lit(1), F.floor(F.col("ids") / (2 * most)))) == 0)
    first = F.row_number().over(Window.partitionBy("lang").orderBy(mark, "doc_id"))
    chosen = some.select("doc_id", "lang").distinct().withColumn("rank", first).filter(F.col("rank") <= most)
    chosen = cut_lineage(chosen.select("doc_id", "lang"))
    letters = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    start = F.pmod(mark, F.greatest(F.lit(1), F.size("words") - size + 1)).cast("int") + 1
    rows = known.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", letters.alias("words"))
    # Rows that share an id and a language give one stretch.
    rows = rows.select("doc_id", "lang", F.slice("words", start, size).alias("words")).groupBy("doc_id", "lang").agg(F.min("words").alias("words"))
    return train([(r["lang"], list(r["words"])) for r in sorted(rows.collect(), key=lambda r: (r["doc_id"], r["lang"]))])


def language(docs: DataFrame, field: Field | None = None, spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_words of every row of `docs` (doc_id, text, lang), and its spans if asked for.

    The score is the expected share of the language in the words of the text, 0 to 1; ties go to the first name. A null text or
    one without a letter is `und` with score 0, and so is every text where nothing could be learned. A null id is not held out;
    repeated rows are labelled alike; a text of any length is labelled whole; an empty table gives no rows.
    """
    field = learned_field(texts_with_lang(docs)) if field is None else field

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        found = batch["text"].to_pylist()
        if field is None:
            shares, counts = np.zeros((len(found), 1)), np.zeros(len(found), np.int64)
        else:
            shares, counts = field.shares(found)
        best = shares.argmax(axis=1).tolist()
        out = {
            "doc_id": batch["doc_id"],
            "lang_pred": [field.names[k] if n else UNKNOWN for k, n in zip(best, counts.tolist())],
            "score": np.clip(shares.max(axis=1), 0.0, 1.0).tolist(),
            "n_words": counts.tolist(),
        }
        if spans:
            out["spans"] = [[dict(zip(("start", "end", "lang"), s)) for s in field.spans(t)] if field else [] for t in found]
        return out

    schema = "doc_id long, lang_pred string, score double, n_words long"
    schema += ", spans array<struct<start:int, end:int, lang:string>>" * spans
    labelled = map_batches(texts(docs), rows, schema)
    return labelled.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *labelled.columns[1:])


def texts_with_lang(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
