"""Golden feature vector, and properties against slow definitions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwright.functions import features as X
from linkwright.functions import lexicon as L
from linkwright.functions import similarity as S


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def slow_partial(a, b):
    if not a or not b:
        return float(not a and not b)
    best = 0.0
    for s, t in ((a, b), (b, a)) if len(a) == len(b) else ((a, b) if len(a) < len(b) else (b, a),):
        for k in range(1 - len(s), len(t)):
            w = t[max(0, k) : k + len(s)]
            best = max(best, 2 * slow_lcs(s, w) / (len(s) + len(w)))
    return best


words = st.text(alphabet="ab cé\0", max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), max_size=8))
def test_ratios(pairs):
    a, b = [p[0] for p in pairs], [p[1] for p in pairs]
    assert S.lcs(a, b).tolist() == [slow_lcs(x, y) for x, y in pairs]
    assert np.allclose(S.partial_ratios(a, b), [slow_partial(x, y) for x, y in pairs])
    assert np.allclose(S.indel_ratios(a, a), 1)


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet="abc", min_size=60, max_size=150), st.text(alphabet="abc", min_size=60, max_size=150))
def test_long_strings(a, b):
    assert S.lcs([a], [b])[0] == slow_lcs(a, b)


def test_golden_vector(spark):
    rows = [("S1-1", "microsoft", "one microsoft way redmond wa", "us"), ("S2-1", "microsoft", "1 microsoft way redmond washington", "us")]
    records = spark.createDataFrame(rows, "entity_id string, name_norm string, addr_norm string, country_norm string")
    pairs = spark.createDataFrame([("S1-1", "S2-1")], "sid string, cid string")
    got = X.pair_features(pairs, records.filter("entity_id like 'S1%'"), records.filter("entity_id like 'S2%'")).first()
    want = [1.0] * 10 + [1, 1, 0.806452, 0.774194, 0.857143, 0.925926, 0.5, 0.6, 0.75, 0.647059, 0.823529, 5, 4, 1.0, 0.812596, 0.812596, 0.812596, 1.0, 0.0]
    assert [got[f] for f in L.FEATURES] == pytest.approx(want, abs=1e-5)


def test_set_overlaps(spark):
    rows = [([], []), (["a"], []), ([], ["a"]), (["a", "b"], ["b", "c"])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>").orderBy("i")
    assert [r[0] for r in df.select(S.jaccard(F.col("a"), F.col("b"))).collect()] == pytest.approx([1, 0, 0, 1 / 3])
    assert [r[0] for r in df.select(S.containment(F.col("a"), F.col("b"))).collect()] == pytest.approx([1, 0, 0, 0.5])


def test_token_set_cases():
    assert S.token_set_ratios(["a b", "", "a b", "x"], ["b a c", "a", "c d", "y"]) == pytest.approx([1, 0, 1 - (6 - 2) / 6, 0])


def test_gram_jaccards_by_definition():
    grams = lambda x: {x[i : i + 3] for i in range(len(x) - 2)} or ({x} - {""})
    texts = ["", "a", "ab", "abc", "abcabc", "xabc", "é", "ab\0", "\0ab", "𝒳yz𝒳yz", "hello world", "world hello"]
    pairs = [(x, y) for x in texts for y in texts]
    want = [1.0 if not grams(x) and not grams(y) else len(grams(x) & grams(y)) / len(grams(x) | grams(y)) for x, y in pairs]
    assert S.gram_jaccards(*map(list, zip(*pairs))).tolist() == want
    assert S.gram_jaccards([], []).tolist() == []


def test_ngram_overlaps_a_few_texts_at_a_time(monkeypatch):
    """Few and many different characters, either side with fewer different texts, and tables of one text or several."""
    rng = random.Random(4)
    for alphabet in ("ab \u00e9\U0001f600", "".join(map(chr, range(200, 700)))):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(40)]
        a, b = [rng.choice(texts[:7]) for _ in range(300)], [rng.choice(texts) for _ in range(300)]
        sets = lambda x: {x[i : i + 3] for i in range(max(1, len(x) - 2))} if x else set()
        want = [len(sets(x) & sets(y)) / len(sets(x) | sets(y)) if x or y else 1.0 for x, y in zip(a, b)]
        for cells in (1, 300, 1 << 22):
            monkeypatch.setattr(S, "_CELLS", cells)
            assert S.gram_jaccards(a, b).tolist() == pytest.approx(want) and S.gram_jaccards(b, a).tolist() == pytest.approx(want)
    char = S._grams(["abc", "ab"])
    assert len(char) == 4 and char[2].tolist() == [1, 1]
