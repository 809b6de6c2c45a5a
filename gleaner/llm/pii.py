"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

The field scores whole candidate segments of up to `MOST_TOKENS` white-space tokens by features of the span: its shape, the
lengths of its digit groups, its separators, a check digit, and the word before it. Dynamic programming over the tokens of a
stretch chooses the boundaries and types jointly; a segment has a bounded number of tokens, so the work is linear in the text.
The weights maximise the conditional likelihood of labelled stretches, by the forward and backward sums over segmentations.
Labelled are the base spans, the same rewritten into other forms, and clean numbers and words in their place. A segment of the
texts that has such a form and is no base span is neither: it takes no part in training.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import map_batches, texts

KINDS = ("email", "ip", "card", "phone")
MOST_TOKENS = 7
#: Letters of the longest entity; a longer segment is none.
LONGEST = 120
#: Texts that training looks at, chosen by the hash of the text, and the letters of the longest of them: both bound what comes
#: to the driver.
TRAINING_TEXTS, TRAINING_LETTERS = 500, 20_000
#: Least conditional probability of a segment that is added.
SURE = 0.9

# A match begins where its digits begin: from a later digit it would end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = re.compile(r"\S+")
_DIGIT = re.compile(r"[0-9]")
_TELLING = re.compile(r"@|[0-9]+")
_ZEROS = str.maketrans("123456789", "000000000")
_LABEL, _BRACKETED, _WRITTEN = r"[A-Za-z0-9-]+", r"[ ]*[\[({{][ ]*(?:{0})[ ]*[\])}}][ ]*", r"[ ]+{0}[ ]+"
_DOT = rf"(?:{_WRITTEN.format('dot')}|{_BRACKETED.format('dot|[.]')})"
#: Addresses with a written at. With an at of two letters alone the dots are written too: `look at index.html` is no address.
_HIDDEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:{_WRITTEN.format('at')}{_LABEL}(?:{_DOT}{_LABEL})+|(?:@|{_BRACKETED.format('at|@')}){_LABEL}(?:(?:[.]|{_DOT}){_LABEL})+)", re.I
)
_AT_WORD = re.compile(r"(?<=[A-Za-z0-9 \[({])at(?=[\])} ])", re.I)
#: Characters of a text around a rewritten span that training sees.
AROUND = 60
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterable[Span]:
    """Matches found from each @: the longest local part before it that no earlier match has taken."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL_LETTERS:
                start -= 1
        if domain and start < at:
            yield start, domain.end(), 0
            done = domain.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base patterns, by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = m[0].split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                out.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def stretches(text: str) -> Iterable[np.ndarray]:
    """Runs of tokens (start, end) that could hold personal data, with a token around each run; some bytes a token."""
    tokens = np.fromiter(chain.from_iterable(m.span() for m in _TOKEN.finditer(text)), np.int32).reshape(-1, 2)
    # A run of digits or an @ lies within one token, an address with a written at in several.
    found = np.fromiter((m.start() for m in _TELLING.finditer(text)), np.int32)
    hot = [np.searchsorted(tokens[:, 1], found, "right")]
    for m in _HIDDEN.finditer(text) if _AT_WORD.search(text) else ():
        hot.append(np.arange(np.searchsorted(tokens[:, 1], m.start(), "right"), np.searchsorted(tokens[:, 0], m.end())))
    hot = np.unique(np.concatenate(hot))
    if not len(hot):
        return
    edges = np.flatnonzero(np.diff(hot) > MOST_TOKENS) + 1
    for first, last in zip(hot[np.concatenate([[0], edges])].tolist(), hot[np.concatenate([edges - 1, [len(hot) - 1]])].tolist()):
        yield tokens[max(0, first - 1) : last + 2]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Segment without the punctuation around it."""
    closed = text.rfind(")", start, end)
    while start < end and text[start] in "\"'([{<,;:" and not (text[start] == "(" and closed > start):
        start += 1
    while end > start and text[end - 1] in "\"')]}>,;:.!?":
        end -= 1
    return start, end


def _lengths(groups: list[str]) -> str:
    return "-".join([str(len(g)) for g in groups[:8]])


def features(text: str, start: int, end: int, tokens: int, kind: int) -> list[str]:
    """Features of a whole segment as one entity of `kind`; they say nothing of single tokens."""
    span = text[start:end]
    groups = re.findall("[0-9]+", span)
    digits = "".join(groups)
    rest = re.sub(r"[0-9]+", "0", span)
    letters = re.sub(r"[A-Za-z]+", "a", rest)
    name = KINDS[kind]
    out = [
        f"{name}:bias",
        f"{name}:tokens={tokens}",
        f"{name}:digits={min(len(digits), 20)}",
        f"{name}:groups={min(len(groups), 8)}",
        f"{name}:shape={letters[:24]}",
        f"{name}:letters={bool(re.search('[^0-9 ().+-]', span))}",
        f"{name}:lengths={_lengths(groups)}",
    ]
    if _HIDDEN.fullmatch(span):
        out.append(f"{name}:hidden")
    if "@" in span:
        out.append(f"{name}:at={span.count('@')},dot={'.' in span.split('@')[-1]}")
    if span[:1] == "+":
        out.append(f"{name}:plus")
    if 14 <= len(digits) <= 19:
        out.append(f"{name}:check={luhn(digits)}")
    if len(groups) == 4 and rest == "0.0.0.0":
        out.append(f"{name}:octets={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    return out


def _plausible(span: str) -> bool:
    """A segment that could be an entity at all: an @, written or not, three dots, or the digits of a short phone number."""
    return len(span) <= LONGEST and ("@" in span or _AT_WORD.search(span) and _HIDDEN.fullmatch(span) or span.count(".") >= 3 and "0" <= span[0] <= "9" or sum(map(span.count, "0123456789")) >= 9)


def _segments(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int, list[str]]]:
    """(first token, token after, start, end, kind, features) of every candidate entity."""
    out = []
    tokens = [(int(a), int(b)) for a, b in tokens]
    for i in range(len(tokens)):
        for j in range(i + 1, min(i + MOST_TOKENS, len(tokens)) + 1):
            start, end = _trimmed(text, tokens[i][0], tokens[j - 1][1])
            if start < tokens[i][1] and end > tokens[j - 1][0] and _plausible(text[start:end]):
                for kind in range(len(KINDS)):
                    out.append((i, j, start, end, kind, features(text, start, end, j - i, kind)))
    return out


def _sums(n: int, segments: list, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums over segmentations of the tokens before and after each boundary; a token outside entities scores 0."""
    ends: dict[int, list[int]] = {}
    starts: dict[int, list[int]] = {}
    for k, s in enumerate(segments):
        ends.setdefault(s[1], []).append(k)
        starts.setdefault(s[0], []).append(k)
    before, after = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        before[j] = np.logaddexp.reduce([before[j - 1], *[before[segments[k][0]] + scores[k] for k in ends.get(j, ())]])
    for i in range(n - 1, -1, -1):
        after[i] = np.logaddexp.reduce([after[i + 1], *[after[segments[k][1]] + scores[k] for k in starts.get(i, ())]])
    return before, after


def rewritten(span: str, kind: int, draw: random.Random) -> str:
    """A base span in a form that is none of the base patterns."""
    digits = "".join(c for c in span if c.isdigit())
    if kind == 0:
        local, domain = span.split("@", 1)
        # Addresses without digits and with fewer labels look alike.
        local = (draw.random() < 0.5 and re.sub("[0-9]", "", local).strip("._%+-")) or local
        domain = ".".join(domain.split(".")[-2 if draw.random() < 0.5 else 0 :])
        at = draw.choice([" at ", " [at] ", " (at) ", "[at]", "(at)"])
        return local + at + domain.replace(".", draw.choice([" dot ", "[dot]", "(dot)", " [dot] ", *["."] * (at != " at ")]))
    if kind == 1:
        return span.replace(".", draw.choice(["[.]", "(.)", " . "]))
    if kind == 2:
        return draw.choice(["  ", ".", " - ", "/", "_"]).join([digits[k : k + 4] for k in range(0, len(digits), 4)])
    code, area, middle, last = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    sep = draw.choice(["-", ".", " ", "/"])
    plain = draw.choice([f"({area}) {middle}-{last}", f"({area}) {middle} {last}", sep.join([area, middle, last])])
    return f"{code}{draw.choice(['-', ' ', '.'])}{plain}" if code and draw.random() < 0.4 else plain


def clean(span: str, kind: int, draw: random.Random) -> list[str]:
    """What looks like a rewritten span and is none."""
    digits = "".join(c for c in span if c.isdigit())
    number = lambda n: "".join(draw.choices("0123456789", k=n))
    if kind == 0:
        return [f"{span.split('@')[0]} at {draw.choice(['the', 'our', 'this'])} place"]
    if kind == 1:
        return [f"{draw.randint(256, 999)}[.]{number(3)}[.]{draw.randint(256, 999)}[.]{number(2)}", f"{number(1)}.{number(1)}.{number(2)}-{number(4)}"]
    if kind == 2:
        wrong = digits[:-1] + str((int(digits[-1]) + draw.randint(1, 9)) % 10)
        return [rewritten(wrong, 2, draw), number(len(digits) + 6)]
    return [
        number(len(digits)),
        number(10),
        f"20{number(2)}-{draw.randint(10, 12)}-{draw.randint(10, 28)} {draw.randint(10, 23)}:{draw.randint(10, 59)}:{draw.randint(10, 59)}",
        f"{number(3)},{number(3)},{number(3)},{number(3)}",
        f"{number(5)} {number(5)}",
    ]


def _form(span: str, kind: int) -> tuple[int, str] | None:
    """What segments of an entity's form have in common; null for those that a check rules out."""
    groups = re.findall("[0-9]+", span)
    if kind == 0:
        return (0, "@") if "@" in span or _HIDDEN.fullmatch(span) else None
    if re.search("[A-Za-z:,@]", span):
        return None
    if kind == 1 and not all(int(g) <= 255 for g in groups if len(g) <= 3) or kind == 2 and not luhn("".join(groups)):
        return None
    return kind, _lengths(groups)


def labelled(samples: list[str]) -> list[tuple[int, list, np.ndarray]]:
    """(tokens, segments, which of them are entities) of the stretches of texts and of rewritten and clean ones."""
    draw = random.Random(7)
    stated: list[tuple[str, set[Span], int, int]] = []
    forms: set[tuple[int, str] | None] = set()
    for text in samples:
        gold = base_spans(text)
        for a, b, kind in gold:
            before, after = text[max(0, a - AROUND) : a], text[b : b + AROUND]
            # Another span beside this one would be cut or stand unlabelled.
            before = before if _DIGIT.search(before) is None and "@" not in before else " "
            after = after if _DIGIT.search(after) is None and "@" not in after else " "
            new = rewritten(text[a:b], kind, draw)
            forms.add(_form(new, kind))
            for words, is_new in [(new, True), (draw.choice(clean(text[a:b], kind, draw)), False)]:
                at, end = len(before), len(before) + len(words)
                stated.append((before + words + after, {(*_trimmed(before + words + after, at, end), kind)} if is_new else set(), at, end))
    forms.discard(None)
    data = []
    for text in samples:
        gold = set(base_spans(text))
        for tokens in stretches(text):
            open_ = lambda s: (s[2], s[3], s[4]) not in gold and _form(text[s[2] : s[3]], s[4]) in forms and all(  # noqa: E731, B023
                s[3] <= a or b <= s[2] for a, b, _ in gold  # noqa: B023
            )
            segments = [s for s in _segments(text, tokens) if not open_(s)]
            if segments:
                data.append((len(tokens), segments, np.array([(s[2], s[3], s[4]) in gold for s in segments])))
    for text, gold, a, b in stated:
        for tokens in stretches(text):
            segments = [s for s in _segments(text, tokens) if s[2] < b and a < s[3]]
            if segments:
                data.append((len(tokens), segments, np.array([(s[2], s[3], s[4]) in gold for s in segments])))
    return data


def train(samples: list[str], rounds: int = 8, step: float = 0.5, shrink: float = 1e-3) -> dict[str, float]:
    """Weights by gradient ascent on the conditional likelihood of the labelled stretches of `samples`."""
    data = labelled(samples)
    weights: dict[str, float] = {}
    for t in range(rounds):
        rate = step / (1 + t)
        for n, segments, truth in data:
            scores = np.array([sum(weights.get(f, 0.0) for f in s[5]) for s in segments])
            before, after = _sums(n, segments, scores)
            for k, s in enumerate(segments):
                p = np.exp(before[s[0]] + scores[k] + after[s[1]] - before[n])
                change = rate * (truth[k] - p)
                if abs(change) > 1e-4:
                    for f in s[5]:
                        weights[f] = weights.get(f, 0.0) * (1 - rate * shrink) + change
    return weights


class Scores:
    """Scores of segments by their form; what it knows of a form is kept for the next segment.

    No feature looks at a digit itself but by the check digit and the size of octets, so segments of equal form and checks score
    alike. Of the form of a segment of digits and separators alone, only what has a weight is told apart.
    """

    def __init__(self, weights: dict[str, float], remembered: int = 50_000):
        self.weights, self.remembered = weights, remembered
        self.known: dict[tuple, tuple[float, ...] | None] = {}
        # Features of group lengths and of shapes that have a weight, of whatever kind.
        self.lengths = {f.partition(":lengths=")[2] for f in weights if ":lengths=" in f}
        self.shapes = {f.partition(":shape=")[2] for f in weights if ":shape=" in f}

    def _form(self, span: str) -> tuple:
        form = span.translate(_ZEROS)
        n = form.count("0")
        checks = 14 <= n <= 19 and luhn("".join(re.findall("[0-9]", span)))
        if not _NUMERIC(form):
            return form, checks
        groups = form.translate(_GAPS).split()
        shape = _RUNS.sub("0", form)[:24]
        lengths = _lengths(groups)
        octets = len(groups) == 4 and _IP_FORM(form) is not None and all(len(g) <= 3 and int(g) <= 255 for g in span.split("."))
        plain = lengths if lengths in self.lengths else "", shape if shape in self.shapes else ""
        return (*plain, min(n, 20), min(len(groups), 8), _IP_FORM(form) is not None, span[:1] == "+", form.count(".") >= 3 and form[0] == "0", checks, octets)

    def __call__(self, text: str, tokens: list[tuple[int, int]]) -> tuple[int, int, tuple[float, ...]] | None:
        """(start, end, score of each kind) of the segment of all `tokens`; null if it can be no entity."""
        start, end = _trimmed(text, tokens[0][0], tokens[-1][1])
        if end - start > LONGEST or start >= tokens[0][1] or end <= tokens[-1][0]:
            return None
        span = text[start:end]
        key = len(tokens), *self._form(span)
        if key not in self.known:
            if len(self.known) > self.remembered:
                self.known.clear()
            self.known[key] = (
                tuple(sum(self.weights.get(f, 0.0) for f in features(text, start, end, len(tokens), k)) for k in range(len(KINDS)))
                if _plausible(span)
                else None
            )
        found = self.known[key]
        return found and (start, end, found)


_IP_FORM = re.compile(r"0+(?:\.0+){3}").fullmatch
_NUMERIC = re.compile(r"[0 ().+-]*").fullmatch
_RUNS = re.compile("0+")
_GAPS = str.maketrans("().+-", "     ")


def decode(text: str, tokens: np.ndarray, scores: Scores) -> list[tuple[int, int, int, float]]:
    """Best segmentation of a stretch: (start, end, kind, conditional probability) of its entities.

    Segments are scored as they come, in a window of `MOST_TOKENS` tokens, once from each side, so a stretch of any length
    holds some numbers a token and no segment.
    """
    n = len(tokens)
    best, before, after = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    width, sort = np.zeros(n + 1, np.int8), np.zeros(n + 1, np.int8)
    window: list[tuple[int, int]] = []
    some = False
    for j in range(1, n + 1):
        window = [*window[1 - MOST_TOKENS :], tuple(tokens[j - 1].tolist())]
        top, sums = best[j - 1], [before[j - 1]]
        for size in range(1, len(window) + 1):
            found = scores(text, window[-size:])
            if found:
                some = True
                for kind, score in enumerate(found[2]):
                    sums.append(before[j - size] + score)
                    if best[j - size] + score > top:
                        top, width[j], sort[j] = best[j - size] + score, size, kind
        best[j] = top
        before[j] = _log_sum(sums)
    if not some or not width.any():
        return []
    window = []
    for i in range(n - 1, -1, -1):
        window = [tuple(tokens[i].tolist()), *window[: MOST_TOKENS - 1]]
        sums = [after[i + 1]]
        for size in range(1, len(window) + 1):
            found = scores(text, window[:size])
            if found:
                sums.extend(after[i + size] + score for score in found[2])
        after[i] = _log_sum(sums)
    out, j = [], n
    while j > 0:
        size = int(width[j])
        if not size:
            j -= 1
            continue
        start, end, found = scores(text, [tuple(t) for t in tokens[j - size : j].tolist()])
        score = found[sort[j]]
        out.append((start, end, int(sort[j]), math.exp(before[j - size] + score + after[j] - before[n])))
        j -= size
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


def all_spans(text: str, weights: dict[str, float] | Scores) -> tuple[list[Span], list[Span]]:
    """Base spans, and base spans with the segments of the field that touch none of them."""
    scores = weights if isinstance(weights, Scores) else Scores(weights)
    base = base_spans(text)
    found = list(base)
    if "@" in text or _DIGIT.search(text) or _AT_WORD.search(text):
        ends = np.maximum.accumulate([b for _, b, _ in base]) if base else np.empty(0, np.int64)
        starts = [a for a, _, _ in base]
        for tokens in stretches(text):
            for start, end, kind, sure in decode(text, tokens, scores):
                # Of the base spans that begin before its end, the one that reaches farthest ends before it.
                at = bisect.bisect_left(starts, end)
                if sure >= SURE and (at == 0 or ends[at - 1] <= start):
                    found.append((start, end, kind))
    return base, sorted(found, key=lambda s: (s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def learned_weights(docs: DataFrame, training: int = TRAINING_TEXTS) -> dict[str, float]:
    """Weights from about `training` distinct texts with a digit group or an @, chosen and ordered by hash; a bounded collect.

    Texts of `TRAINING_LETTERS` and more do not train.
    """
    seen = docs.filter(F.col("text").rlike("@[A-Za-z0-9]|[0-9][0-9 .-]{6}")).filter(F.length("text") < TRAINING_LETTERS)
    every = max(1, seen.agg(F.approx_count_distinct("text")).first()[0] // training)
    mark = F.xxhash64("text")
    chosen = seen.filter(F.pmod(mark, F.lit(every)) == 0).select("text").distinct().orderBy(mark, "text").limit(2 * training)
    return train(sorted({r["text"] for r in chosen.collect()}))


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, their spans and all spans (`kind:start:end`, code points) of every row.

    One pass over the texts, no shuffle; the weights are a few hundred numbers. A null or empty text has no spans; a text of any
    length is read whole, with some numbers a token; repeated rows come out repeated; an empty table gives no rows and trains on
    nothing.
    """
    docs = texts(docs)
    scores = Scores(learned_weights(docs) if weights is None else weights)

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base": [], "base_sha256": [], "spans": []}
        for text in batch["text"].to_pylist():
            base, found = all_spans(text, scores)
            for k, name in enumerate(KINDS):
                out[f"n_{name}"].append(sum(s[2] == k for s in base))
            out["base"].append(written(base))
            out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
            out["spans"].append(written(found))
        return out | {"doc_id": batch["doc_id"]}

    return map_batches(docs, rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, spans string")
