"""Byte-pair encoding and decoding with a pair occurrence index.

The vocabulary file gives the symbols, the merges in rank order and the text rules. Texts are cut into chunks between white
space, chunks into words by the pattern of the file. The words that a batch brings anew are laid out in one symbol array; an
index holds every position of every mergeable pair in it; the active ranks are applied in ascending order, and each merge
updates the position lists of the pairs that it makes. A chunk keeps its ids for later batches. Packing needs ids alone: there
a batch is cut into words as arrays, and distinct words of one length are merged side by side.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gleaner.llm.common import map_batches, texts

#: Chunks remembered per Python worker before the memory is emptied; it bounds memory and changes no result.
REMEMBERED = 300_000
#: Positions of a rank from which they are merged at once; it changes no result.
MANY = 40
#: Bytes of a word up to which words of a length are merged side by side; it changes no result.
SIDE = 32
#: Above the rank of every pair.
_NONE = np.int32(1 << 30)

# White space as the pattern language of the vocabulary file sees it, and the word pattern of the file.
_SPACE = regex.compile(r"[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: Beyond these letters the library's and this module's Unicode tables can differ in age; the library cuts such chunks.
_PLAIN = re.compile(r"[\x00-\u052f]*").fullmatch

#: Kinds of letters for cutting texts as arrays; a chunk with a hard letter is cut by itself.
_GAP, _LETTER, _DIGIT, _OTHER, _HARD = range(5)
#: One above the last white space. All letters from here on are hard.
_BEYOND = 0x3001

_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, side_by_side: bool = False) -> Encoder:
    """The encoder of a vocabulary file, made once per Python worker.

    `side_by_side` merges words of one length in lockstep instead of by the pair index.
    """
    key = path, side_by_side
    if key not in _ENCODERS:
        with open(path, encoding="utf-8") as file:
            _ENCODERS[key] = Encoder(file.read(), side_by_side)
    return _ENCODERS[key]


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable, else the next free code point."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


def _letter_kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point up to `_BEYOND`, which stands for all from there on.

    Hard are apostrophes, which open the word pattern's endings, letters that can compose or change with their neighbours, that
    lower to more than one letter, or that are not plain.
    """
    kinds, low = np.full(_BEYOND + 1, _HARD, np.uint8), np.arange(_BEYOND + 1, dtype=np.uint32)
    for c in range(_BEYOND):
        letter = chr(c)
        lower = _lower(letter)
        if _SPACE.fullmatch(letter):
            kinds[c] = _GAP
        elif not _PLAIN(letter) or letter == "'" or unicodedata.combining(letter):
            continue
        elif unicodedata.normalize("NFC", letter) == letter and len(lower) == 1 and _PLAIN(lower):
            kinds[c] = next((k for k, p in ((_LETTER, r"\p{L}"), (_DIGIT, r"\p{N}")) if regex.fullmatch(p, lower)), _OTHER)
            low[c] = ord(lower)
    return kinds, low


class Encoder:
    def __init__(self, text: str, side_by_side: bool):
        file = json.loads(text)
        model = file["model"]
        # Only the text rules are asked of the library; its model would take more memory than all else here.
        self.rules = Tokenizer.from_str(json.dumps({**file, "added_tokens": [], "model": {**model, "vocab": {}, "merges": []}}))
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.merges: dict[int, tuple[int, int]] = {}
        self.parts: list[tuple[int, int]] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.ids[left], self.ids[right]
            self.parts.append((a, b))
            self.merges.setdefault(a << 20 | b, (rank, self.ids[left + right]))
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.names = {i: s for s, i in [*self.ids.items(), *self.special.items()]}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        rules = file["pre_tokenizer"]["pretokenizers"]
        self.words_of = regex.compile(next(r["pattern"]["Regex"] for r in rules if r["type"] == "Split")).findall
        letters = _byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.inner = np.array([self.ids[c] for c in letters], np.int32)
        self.last = np.array([self.ids[c + self.suffix] for c in letters], np.int32)
        self.pairs = np.array(sorted(self.merges))
        self.pair_ranks = np.array([self.merges[p][0] for p in self.pairs.tolist()])
        self.known: dict[str, bytes] = {}
        self.words_ids = self.merged
        if side_by_side:
            self.words_ids = self.merged_side_by_side
            self._hash_pairs()
            self.kinds, self.low = _letter_kinds()
        self.forget()

    def forget(self) -> None:
        """Give up all that is remembered of earlier batches."""
        self.known.clear()
        self.seen, self.seen_ids, self.seen_ends = pa.array([], pa.string()), np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it does not merge."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], -1)

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian: all pairs of all words are indexed by rank and merged rank by rank.

        A rank with many positions is merged at all of them at once, one with few position by position.
        """
        coded = [word.encode() for word in words]
        data = np.frombuffer(b"".join(coded), np.uint8)
        size = len(data)
        ends = np.cumsum([len(c) for c in coded])
        # The arrays lend their memory to numpy; the slot behind the last symbol stands for "no symbol".
        symbols, after, before = (array("i", bytes(4 * (size + 1))) for _ in range(3))
        symbol, next_to, prior = (np.frombuffer(a, np.int32) for a in (symbols, after, before))
        symbol[:size] = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        symbol[size] = -1
        next_to[:] = np.arange(1, size + 2)
        next_to[ends - 1] = size
        prior[:] = np.arange(-1, size)
        prior[0] = size
        prior[ends[:-1]] = size

        at: dict[int, list[int]] = {}
        active: list[int] = []

        def index(pairs: np.ndarray, places: np.ndarray) -> None:
            ranks = self._ranks(pairs)
            hits = np.flatnonzero(ranks >= 0)
            hits = hits[np.argsort(ranks[hits], kind="stable")]
            ranks, found = ranks[hits], places[hits].tolist()
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1)).tolist()
            for rank, i, j in zip(ranks[cuts].tolist(), cuts, [*cuts[1:], len(found)]):
                if rank in at:
                    at[rank].extend(found[i:j])
                else:
                    at[rank] = found[i:j]
                    heapq.heappush(active, rank)

        wide = symbol.astype(np.int64)
        index(wide[:size] << 20 | wide[next_to[:size]], np.arange(size))
        merges = self.merges
        while active:
            rank = heapq.heappop(active)
            places = at.pop(rank)
            a, b = self.parts[rank]
            new = merges[a << 20 | b][1]
            if len(places) >= MANY and a != b:
                p = np.array(places)
                p = p[symbol[p] == a]
                q = next_to[p]
                both = symbol[q] == b
                p, q = p[both], q[both]
                symbol[p], symbol[q] = new, -1
                n = next_to[q]
                next_to[p], prior[n] = n, p
                m = prior[p]
                index(
                    np.concatenate((symbol[n].astype(np.int64) | new << 20, symbol[m].astype(np.int64) << 20 | new)),
                    np.concatenate((p, m)),
                )
                continue
            if a == b:
                places.sort()
            for p in places:
                q = after[p]
                if symbols[p] != a or symbols[q] != b:
                    continue
                symbols[p], symbols[q] = new, -1
                n = after[p] = after[q]
                before[n] = p
                m = before[p]
                for place, pair in ((p, new << 20 | symbols[n]), (m, symbols[m] << 20 | new)):
                    found = merges.get(pair)
                    if found:
                        if found[0] in at:
                            at[found[0]].append(place)
                        else:
                            at[found[0]] = [place]
                            heapq.heappush(active, found[0])
        left = symbol[:size] >= 0
        packed = symbol[:size][left].astype("<u4").tobytes()
        bounds = [0, *(4 * np.cumsum(left)[ends - 1]).tolist()]
        return [packed[i:j] for i, j in zip(bounds, bounds[1:])]

    def _hash_pairs(self) -> None:
        """A hash table of the pairs, at most an eighth full; a pair stands in the first free slot from its own on."""
        self.shift = np.uint64(61 - max(1, len(self.pairs)).bit_length())
        size = 1 << (64 - int(self.shift))
        self.slot_pair, self.slot_rank = np.full(size, -1), np.full(size, _NONE)
        self.made = np.array([self.merges[a << 20 | b][1] for a, b in self.parts], np.int32)
        left, slot = np.arange(len(self.pairs)), self._slots(self.pairs)
        while len(left):
            free = self.slot_pair[slot] < 0
            self.slot_pair[slot[free]] = self.pairs[left[free]]
            got = self.slot_pair[slot] == self.pairs[left]
            self.slot_rank[slot[got]] = self.pair_ranks[left[got]] * SIDE
            left, slot = left[~got], (slot[~got] + 1) % size

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _hashed_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`SIDE` times the rank of each pair, `_NONE` where it does not merge."""
        pairs = left.astype(np.int64) << 20 | right
        slot = self._slots(pairs)
        there = self.slot_pair[slot]
        ranks = np.where(there == pairs, self.slot_rank[slot], _NONE)
        other = np.flatnonzero((there != pairs) & (there >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) % len(self.slot_pair)
            there = self.slot_pair[slot[other]]
            met = there == pairs[other]
            ranks[other[met]] = self.slot_rank[slot[other[met]]]
            other = other[~met & (there >= 0)]
        return ranks

    def merged_side_by_side(self, words: list[str]) -> list[bytes]:
        """Ids of each word, little-endian: words of a length stand side by side, and each round merges the best pair of each.

        Words longer than `SIDE` bytes go through the pair index.
        """
        coded = [word.encode() for word in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        ids, begins, counts = self._merge(np.frombuffer(b"".join(coded), np.uint8), np.cumsum(size) - size, size)
        packed = ids.tobytes()
        return [packed[4 * i : 4 * (i + n)] for i, n in zip(begins.tolist(), counts.tolist())]

    def _merge(self, data: np.ndarray, begins: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, given by their bytes, first bytes and sizes: all ids, and where those of each word begin and their number."""
        order = np.argsort(size, kind="stable")
        cuts = np.flatnonzero(np.diff(size[order], prepend=0)).tolist()
        ids, counts = [np.empty(0, np.uint32)], np.empty(len(size), np.int64)
        for i, j in zip(cuts, [*cuts[1:], len(order)]):
            own, n = order[i:j], int(size[order[i]])
            if n > SIDE:
                found = self.merged([data[k : k + n].tobytes().decode() for k in begins[own].tolist()])
                ids.append(np.frombuffer(b"".join(found), "<u4"))
                counts[own] = [len(f) // 4 for f in found]
            else:
                some, counts[own] = self._lockstep(data[begins[own] + np.arange(n)[:, None]])
                ids.append(some)
        first = np.empty(len(size), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return np.concatenate(ids), first, counts

    def _lockstep(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the columns of bytes, one after another, and their number per column."""
        n, m = letters.shape
        # The row behind the last letters stands for "no symbol" on either side of a word.
        symbol = np.full((n + 1, m), 0xFFFFF, np.int32)
        symbol[:n] = self.inner[letters]
        symbol[n - 1] = self.last[letters[n - 1]]
        place = np.arange((n + 1) * m).reshape(n + 1, m)
        after, before = np.roll(place, -1, axis=0).ravel(), np.roll(place, 1, axis=0).ravel()
        # Rank and row of each pair in one number, so the least of a column is its first pair of the best rank.
        best = np.full((n + 1, m), _NONE)
        best[: n - 1] = self._hashed_ranks(symbol[: n - 1].ravel(), symbol[1:n].ravel()).reshape(n - 1, m) + np.arange(n - 1, dtype=np.int32)[:, None]
        flat, ranks = symbol.ravel(), best.ravel()
        while True:
            least = best.min(axis=0)
            column = np.flatnonzero(least < _NONE)
            if len(column) == 0:
                break
            rank, row = np.divmod(least[column], np.int32(SIDE))
            new = self.made[rank]
            p = row.astype(np.int64) * m + column
            q = after[p]
            follows, leads = after[q], before[p]
            flat[p], flat[q], ranks[q] = new, -1, _NONE
            after[p], before[follows] = follows, p
            ranks[p] = self._hashed_ranks(new, flat[follows]) + row
            ranks[leads] = self._hashed_ranks(flat[leads], new) + (leads // m).astype(np.int32)
        kept = symbol[:n].T
        left = kept >= 0
        return kept[left].astype("<u4"), left.sum(axis=1)

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of chunks not met before, remembered for later batches."""
        if len(self.known) + len(chunks) > REMEMBERED:
            self.known.clear()
        new = self._chunk_ids(chunks)
        self.known.update(new)
        return new

    def _chunk_ids(self, chunks: set[str]) -> dict[str, bytes]:
        """Ids of each chunk."""
        whole: dict[str, str] = {}
        parts: dict[str, list[str]] = {}
        for chunk in chunks:
            if _PLAIN(chunk):
                low = chunk.lower() if chunk.isascii() else _lower(unicodedata.normalize("NFC", chunk))
                if low.isalpha():
                    whole[chunk] = low
                else:
                    parts[chunk] = self.words_of(low)
            else:
                parts[chunk] = self._cut(chunk)
        words = list({*whole.values(), *chain.from_iterable(parts.values())})
        ids = dict(zip(words, self.words_ids(words))) if words else {}
        new = {chunk: ids[word] for chunk, word in whole.items()}
        for chunk, found in parts.items():
            new[chunk] = b"".join([ids[w] for w in found])
        return new

    def _cut(self, chunk: str) -> list[str]:
        """Words of a chunk by the library's own rules."""
        found = self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(chunk))
        return [bytes([self.bytes_of[c] for c in word]).decode() for word, _ in found]

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        known = self.known.get
        pieces: list[tuple[int, list[str], list, str]] = []
        missing: set[str] = set()
        for k, text in enumerate(batch):
            parts = self.special_at.split(text) if "<|" in text else [text]
            for i in range(0, len(parts), 2):
                chunks = _chunks(parts[i])
                found = list(map(known, chunks))
                if None in found:
                    missing.update([c for c, f in zip(chunks, found) if f is None])
                pieces.append((k, chunks, found, parts[i + 1] if i + 1 < len(parts) else ""))
        new = self._learn(missing) if missing else {}
        out: list[list[bytes]] = [[] for _ in batch]
        for k, chunks, found, special in pieces:
            out[k].extend([new[c] if f is None else f for c, f in zip(chunks, found)] if new else found)
            if special:
                out[k].append(struct.pack("<I", self.special[special]))
        return list(map(b"".join, out))

    def encode_rows(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and their number per text; for an encoder that merges side by side.

        All texts are cut into words at once, as arrays of kinds of letters, and each distinct word is merged once. A chunk with a
        hard letter and a special token are words of their own.
        """
        if not batch:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        # White space between the texts, so that no word or special token reaches from one into the next.
        joined = "\n".join(batch)
        letters = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = self.kinds.take(letters, mode="clip")
        inked = kind != _GAP
        marks = [m.span() for m in self.special_at.finditer(joined)] if "<|" in joined else []
        for i, j in marks:
            kind[i:j] = _HARD
        opens = kind == _DIGIT
        opens[:1] = True
        opens[1:] |= kind[1:] != kind[:-1]
        opens &= inked
        low = self.low.take(letters, mode="clip")
        hard = kind == _HARD
        if hard.any():
            begins = inked.copy()
            begins[1:] &= ~inked[:-1]
            begins[[k for span in marks for k in span if k < len(begins)]] = True
            begins &= inked
            chunk = np.cumsum(begins, dtype=np.int32) - 1
            whole = np.zeros(chunk[-1] + 1, bool)
            whole[chunk[hard]] = True
            hard = whole[chunk] & inked
            opens[hard], low[hard] = begins[hard], letters[hard]
        at = np.flatnonzero(opens)
        words = _strings(low[inked], np.flatnonzero(opens[inked])).dictionary_encode()
        own = np.unique(words.indices.to_numpy()[hard[at]])
        first, count = self._word_ids(words.dictionary, own)
        first, count = first[words.indices], count[words.indices]
        ends = np.concatenate(([0], np.cumsum(count)))
        ids = self.seen_ids[np.repeat(first - ends[:-1], count) + np.arange(ends[-1])]
        lengths = np.fromiter(map(len, batch), np.int64, len(batch)) + 1
        rows = ends[np.searchsorted(at, np.cumsum(lengths))]
        return ids, np.diff(rows, prepend=0)

    def _word_ids(self, words: pa.StringArray, hard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in `seen_ids` the ids of each distinct word begin, and their number; new words are remembered for later batches."""
        if len(self.seen) > REMEMBERED:
            self.forget()
        place = pc.index_in(words, self.seen)
        new = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().astype(np.int64)
        by_itself = np.zeros(len(words), bool)
        by_itself[hard] = True
        for some, ids_of in ((new & ~by_itself, self._plain_ids), (new & by_itself, self._hard_ids)):
            if some.any():
                place[some] = len(self.seen) + np.arange(np.count_nonzero(some))
                some = words.filter(pa.array(some))
                ids, counts = ids_of(some)
                self.seen = pa.concat_arrays([self.seen, some])
                self.seen_ends = np.concatenate((self.seen_ends, self.seen_ends[-1] + np.cumsum(counts)))
                self.seen_ids = np.concatenate((self.seen_ids, ids))
        return self.seen_ends[place], self.seen_ends[place + 1] - self.seen_ends[place]

    def _plain_ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and their number per word."""
        _, bounds, data = words.buffers()
        bounds = np.frombuffer(bounds, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        ids, first, count = self._merge(np.frombuffer(data, np.uint8), bounds[:-1], np.diff(bounds))
        ends = np.cumsum(count)
        return ids[np.repeat(first - ends + count, count) + np.arange(len(ids))], count

    def _hard_ids(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The same of chunks with hard letters and of special tokens."""
        chunks = chunks.to_pylist()
        known = self._chunk_ids({c for c in chunks if c not in self.special})
        known.update({c: struct.pack("<I", i) for c, i in self.special.items()})
        found = [known[c] for c in chunks]
        return np.frombuffer(b"".join(found), "<u4"), np.array([len(f) // 4 for f in found])

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids, as the library joins it."""
        return " ".join(map(self.names.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


def _chunks(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [c for c in _SPACE.split(text) if c]
    return text.split()


def _strings(letters: np.ndarray, begins: np.ndarray) -> pa.StringArray:
    """Words that follow each other without a gap, given by their code points and first letters."""
    bounds = np.append(begins, len(letters))
    if len(letters) and letters.max() >= 0x80:
        data = letters.tobytes().decode("utf-32-le").encode()
        width = (letters >= 0x80).view(np.uint8) + np.uint8(1)
        width += letters >= 0x800
        width += letters >= 0x10000
        bounds = np.concatenate(([0], np.cumsum(np.add.reduceat(width, begins, dtype=np.int64))))
    else:
        data = letters.astype(np.uint8).tobytes()
    return pa.StringArray.from_buffers(len(begins), pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data))


def _lower(text: str) -> str:
    """Lower case letter by letter, without the final form of sigma."""
    return text.replace("Σ", "σ").lower()


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens and the decoded text of every row.

    Narrow: no shuffle, a batch of texts at a time. Null and empty texts have no ids; repeated rows come out repeated.
    """

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        own = encoder(path)
        found = own.encode_batch(batch["text"].to_pylist())
        return {
            "doc_id": batch["doc_id"],
            "n_tokens": [len(ids) // 4 for ids in found],
            "ids": found,
            "decoded": [own.decode(ids) for ids in found],
        }

    return map_batches(texts(docs), rows, "doc_id long, n_tokens long, ids binary, decoded string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """The round trip with SHA-256 digests in place of ids and decoded text, taken before the rows leave Python."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        own = encoder(path)
        found = own.encode_batch(batch["text"].to_pylist())
        return {
            "doc_id": batch["doc_id"],
            "n_tokens": [len(ids) // 4 for ids in found],
            "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids in found],
            "decoded_sha256": [hashlib.sha256(own.decode(ids).encode()).hexdigest() for ids in found],
        }

    return map_batches(texts(docs), rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
