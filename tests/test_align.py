"""Alignment of a model's pieces with their text, against a full edit-distance table."""

import json
import random

import numpy as np
import pytest

from tomeloom.config import DEFAULT
from tomeloom.functions import align
from tomeloom.operators import chunking


def table(a, b):
    """Edit distances of all prefixes."""
    d = np.zeros((len(a) + 1, len(b) + 1), int)
    d[:, 0], d[0] = range(len(a) + 1), range(len(b) + 1)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
    return d


def test_places_have_the_least_cost():
    rnd = random.Random(3)
    for _ in range(150):
        a = [rnd.randrange(4) for _ in range(rnd.randrange(0, 60))]
        b = [x for x in a if rnd.random() > 0.1] if rnd.random() < 0.6 else [rnd.randrange(4) for _ in range(rnd.randrange(0, 60))]
        cuts = sorted(rnd.sample(range(len(a) + 1), min(3, len(a) + 1)))
        got, total = align.places(np.array(a, np.int64), np.array(b, np.int64), cuts)
        ahead, behind = table(a, b), table(a[::-1], b[::-1])
        assert total == ahead[-1, -1] and got == sorted(got)
        for c, j in zip(cuts, got):
            both = ahead[c] + behind[len(a) - c][::-1]
            assert both[j] == total == both.min() and j == both.argmin()


def words_of(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(n))


@pytest.mark.parametrize("seed", range(12))
def test_changed_copies_get_exact_spans(seed):
    rnd = random.Random(seed)
    parts = [words_of(rnd, rnd.randrange(8, 60)) for _ in range(rnd.randrange(2, 9))]
    text = "\n\n".join(parts) + " "

    def changed(p):
        inner = list(p.replace(" ", rnd.choice([" ", "\n", "  "])))
        for _ in range(3):  # letters, not at the ends
            inner[rnd.randrange(5, len(inner) - 5)] = rnd.choice("xyz")
        return "".join(inner)

    got = align.spans(text, [changed(p) for p in parts])
    assert got[0][0] == 0 and got[-1][1] == len(text) and all(x[1] == y[0] for x, y in zip(got, got[1:]))
    assert [text[i:j].strip() for i, j in got] == parts


def test_defined_cases_of_alignment():
    rnd = random.Random(1)
    a, b, c = (words_of(rnd, 30) for _ in range(3))
    text = f"{a}\n\n{b}\n\n{c}"
    assert [text[i:j].strip() for i, j in align.spans(text, [a, c])] == [a, f"{b}\n\n{c}"]  # left out: of the next piece
    assert [text[i:j] for i, j in align.spans(text, [a, b])][-1] == f"{b}\n\n{c}"  # at the end: of the last one
    assert [text[i:j].strip() for i, j in align.spans(text, [a, " ", b, c])] == [a, "", b, c]  # an empty piece
    assert align.spans(text, [words_of(rnd, 90)[::-1].upper()]) is None and align.spans(text, [""]) is None and align.spans(" ", [a]) is None
    long = "ab " * 4000  # no gram occurs once
    got = align.spans(long, ["ab " * 1000, "ab " * 3000])
    assert got == [(0, 3000), (3000, 12000)]
    emoji = "\U0001f600 " + a + " \U0001f601 " + b
    assert [emoji[i:j].strip() for i, j in align.spans(emoji, ["\U0001f600 " + a, "\U0001f601 " + b])] == ["\U0001f600 " + a, "\U0001f601 " + b]


def test_a_batch_is_python_objects_in_slices_only():
    import pyarrow as pa

    rnd, sizes = random.Random(4), []
    texts = [None if i % 9 == 0 else words_of(rnd, 20) for i in range(300)]
    said = [t and [t[:40].replace(" ", "\n"), t[40:]] for t in texts]
    columns = pa.array(texts), pa.array(said, pa.list_(pa.string()))

    def noted(t, s):
        sizes.append(len(t))
        return align.aligned_lists(t, s)

    assert chunking.by_slices(noted, *columns).to_pylist() == align.aligned_lists(texts, said).to_pylist()
    assert sum(sizes) == 300 and max(sizes) <= chunking.SLICE < 300
    assert len(chunking.by_slices(noted, *(c.slice(0, 0) for c in columns))) == 0


def test_a_model_split_is_aligned(spark):
    rnd = random.Random(2)
    parts = [words_of(rnd, 30) for _ in range(4)]
    far = words_of(rnd, 3000)  # longer than what the model sees
    rows = [(1, "\n\n".join(parts)), (2, "short"), (3, "none of it. " + parts[0] + "\n\n" + parts[1]), (4, far), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "i int, content string")

    def model(t):
        if t.startswith("none"):
            return json.dumps({"paragraphs": [{"text": "QWERTZ " * 40, "start_marker": ""}]})
        cut = t.split("\n\n") if "\n\n" in t and len(t) < 5000 else [t[:3000], t[3000:]]
        return json.dumps({"paragraphs": [{"text": x.replace(" ", "\n").replace("ab", "ax"), "start_marker": "no such"} for x in cut]})

    got = {}
    for r in chunking.split_paragraphs(df, model, config=DEFAULT.updated(align_pieces=True)).orderBy("i", "paragraph_index").collect():
        got.setdefault(r.i, []).append(r)
    whole = dict(rows)
    assert set(got) == {1, 2, 3, 4} and [r.paragraph.strip() for r in got[1]] == parts
    assert {i: r[0].method for i, r in got.items()} == {1: "llm", 2: "whole", 3: "rule", 4: "llm"}
    for i in (1, 4):
        assert "".join(r.paragraph for r in got[i]) == whole[i] and all(r.position_exact and whole[i][r.para_start : r.para_end] == r.paragraph for r in got[i])
    assert got[4][0].para_end == 3000 or whole[4][got[4][0].para_end - 1].isspace()
