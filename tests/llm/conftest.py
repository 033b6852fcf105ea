import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), in several partitions, with columns whose names clash with those
    that the operators use inside."""

    def make(rows, clash=False):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        if clash:
            from pyspark.sql import functions as F

            extra = ("tag", "node", "k", "g", "at", "items", "spans", "kept", "score", "ratio", "n", "h", "file", "_id", "_tag", "_keep_0", "features", "place", "start")
            extra += ("_n_tokens", "_place", "_block", "_source", "_tie", "_weight", "_alpha", "_quota", "_order", "_n_source", "_n_copies", "_own", "_copy", "_within", "_before", "_bits", "key", "col", "with.dot")
            df = df.withColumns({c: F.lit("x") for c in extra})
        return df

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with exact and near copies, shared passages, periodic text, empty and null ones."""
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randrange(1, 8))) for _ in range(400)]
    sentence = lambda: " ".join(rng.choice(vocab) for _ in range(rng.randrange(2, 30))).capitalize() + rng.choice(".!?")
    text = lambda n: " ".join(sentence() + ("\n" if rng.random() < 0.3 else "") for _ in range(n))
    passage = text(6)
    rows = [text(rng.randrange(1, 25)) for _ in range(40)]
    for i in range(12):
        rows.append(rows[i])
        w = rows[i].split(" ")
        for _ in range(max(1, len(w) // 40)):
            w[rng.randrange(len(w))] = "changed"
        rows.append(" ".join(w))
        rows.append(text(2) + " " + passage + " " + text(2))
    rows += ["", None, " \n ", "a", "one two three", "one two three", "la " * 300, "la " * 310, "ab" * 400, "é" * 150, rows[0] + rows[1], "x" * 199, "y" * 200, "y" * 201]
    return list(enumerate(rows))
