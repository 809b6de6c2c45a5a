"""Spelling variants against brute force over all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from gleaner.llm import spelling

SCHEMA = "doc_id long, text string, word string, head string, n long"


def brute_words(texts, least, often, every):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % every == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + 1 :] == b[same + 1 :] if len(a) == len(b) else a[same:] == b[same + 1 :]


def brute_rows(texts, least=6, often=5, every=199, factor=5):
    words = brute_words(texts, least, often, every)
    near = {w: [] for w in words}
    for a, b in itertools.combinations(sorted(words), 2):
        if one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
    rows = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def rows_of(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "w", "h", 7) for i, t in texts], SCHEMA).repartition(3)
    found = spelling.spelling_variants(docs, **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()))


def corpus():
    draw = random.Random(3)
    base = ["".join(draw.choices("abcdé", k=draw.randint(5, 9))) for _ in range(60)]
    words = [w for w in base for _ in range(draw.choice([1, 6, 30, 160]))]
    for w in base:
        for _ in range(4):
            at = draw.randrange(len(w))
            other = draw.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "z" + w[at + 1 :], w + "s"])
            words += [other] * draw.choice([4, 5, 7, 26])
    words += ["planted"] * 300 + ["planteds"] * 45 + ["plantedsx"] * 7
    draw.shuffle(words)
    texts = [(i, " ".join(words[i::40])) for i in range(40)]
    texts += [(40, None), (41, ""), (None, " ".join(words[:50]) + " ×÷ABCDEF-Ābcdéab"), (42, "12 34 中文 _"), (3, texts[3][1]), (3, texts[3][1])]
    texts += [(50 + k, "Q" * 3000 + "r" + " " + "q" * 3000 + " " + "q" * 2999 + "rr") for k in range(6)]
    return texts


def test_equals_brute_force(spark):
    texts = corpus()
    want = brute_rows(texts)
    assert sum(r[4] > 0 for r in want) > 50 and any(r[1] and r[1] != r[2] for r in want) and any(len(r[0]) > 2999 for r in want)
    assert rows_of(spark, texts) == want


@pytest.mark.parametrize("least,crowd", [(6, 2), (6, 9), (1, 3), (2, 1000), (3, 1)])
def test_crowded_states_split_without_loss(spark, least, crowd):
    texts = corpus()
    assert rows_of(spark, texts, least=least, often=2, crowd=crowd) == brute_rows(texts, least=least, often=2)


def test_every_run_loses_a_letter(spark):
    texts = corpus()[:20]
    assert rows_of(spark, texts, least=4, often=1, every=1) == brute_rows(texts, least=4, often=1, every=1)


def test_ties_take_the_first_form_in_code_point_order(spark):
    texts = [(1, "abcdéa " * 30 + "abcdea " * 30 + "abcdeaé " * 2 + "abcda " * 6)]
    rows = {r[0]: r for r in rows_of(spark, texts, least=5)}
    assert rows["abcda"][1] == "abcdea" and rows["abcda"][5] == 30


def test_empty_table_and_long_text(spark):
    assert rows_of(spark, []) == []
    text = ("sparrow " * 5000 + "sparow " * 900) * 40
    assert rows_of(spark, [(199, text)]) == brute_rows([(199, text)])


def test_hot_lead_goes_to_many_groups(spark):
    draw = random.Random(9)
    words = sorted({"con" + "".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)})
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    found = {(r["word"], r["near"]) for r in spelling.near_words(table, 6, crowd=50).collect()}
    near = set()
    known = set(words)
    for w in words:
        for i in range(3, len(w)):
            near |= {(w, v) for c in "abcdefghij" if (v := w[:i] + c + w[i + 1 :]) in known and v != w}
    assert found == near and len(near) > 100


def test_acceptor_shares_equal_endings():
    acceptor = spelling.Acceptor(["tap", "taps", "top", "tops"])
    reached = {0}
    for state in [0] + list(range(len(acceptor.arcs))):
        if state in reached:
            reached |= set(acceptor.arcs[state].values())
    assert len(reached) == 5
    assert sorted(map(tuple, map(sorted, acceptor.pairs(9)))) == [("tap", "taps"), ("tap", "top"), ("taps", "tops"), ("top", "tops")]
