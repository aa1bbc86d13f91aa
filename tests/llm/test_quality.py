import random

import numpy as np
import pyarrow as pa
from cases import SCHEMA, awkward, empty

from tripartite.llm import quality as q


def test_votes():
    good = "This is a plain sentence, with enough words to be looked at by all. " * 8
    texts = [good, good.upper(), "a | b | c | d | e | f | g | h | i | j | k", "buy " * 40, "#$% @@ ** ##", ""]
    names = dict(enumerate(q.LABELLERS))
    bad = [{names[k] for k in np.flatnonzero(v == -1)} for v in q.votes(pa.array(texts))]
    assert bad[0] <= {"variety"}
    assert "capitals" in bad[1] and "separators" in bad[2]
    assert {"runs", "variety"} <= bad[3] and "symbols" in bad[4] and "length" in bad[5]


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    miss, alarm = np.array([0.2, 0.4, 0.1]), np.array([0.002, 0.001, 0.003])
    bad_vote = np.where(good[:, None], rng.random((len(good), 3)) < alarm, rng.random((len(good), 3)) > miss)
    ballots, counts = np.unique(np.where(bad_vote, -1, 1), axis=0, return_counts=True)
    posterior, accuracy, share = q.label_model(ballots, counts.astype(float))
    assert abs(share - 0.8) < 0.08
    assert posterior[(ballots == -1).all(axis=1)][0] < 0.01 and posterior[(ballots == 1).all(axis=1)][0] > 0.9
    assert (accuracy > 0.75).all()


def test_scorer_learns_and_awkward_rows(spark):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice("abcdefgh") + rng.choice("aeiou") + rng.choice("lmnr") for _ in range(n))
    rows = []
    for i in range(300):
        text = say(80)
        if i % 4 == 0:
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        rows.append((i, text, "en", "s", None, None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = q.fit(docs)
    found = q.score(docs, model).select("row.doc_id", "predicted").collect()
    assert sum(r.predicted != int(r.doc_id % 4 != 0) for r in found) <= 5
    df = awkward(spark)
    scored = q.score(df, model).collect()
    assert len(scored) == df.count() and all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in scored)


def test_empty_table(spark):
    assert q.score(empty(spark), q.fit(empty(spark))).collect() == []
