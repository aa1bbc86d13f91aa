import random

import numpy as np
from cases import awkward, empty, written

from tripartite.llm import language_id as li
from tripartite.llm.bytewords import words


def brute(word, table):
    alpha = [np.ones(2)]
    for end in range(1, len(word) + 1):
        total = np.zeros(2)
        for begin in range(max(0, end - li.LONGEST), end):
            if word[begin:end] in table:
                total = total + alpha[begin] * table[word[begin:end]]
        alpha.append(total)
    return np.log(alpha[-1])


def test_forward_sums_all_segmentations():
    found = li.pieces()
    p = np.random.default_rng(1).random((len(found) + 1, 2))
    p[0] = 0
    table = {piece: p[k + 1] for k, piece in enumerate(found)}
    text = "the Idiotische été zzzzqqq A internationalisierungen ".encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    starts, ends = words(data, offsets, li.BETWEEN)
    rows, size = li._matrix(data, starts, ends)
    log = li.forward(rows, size, p, li.vocabulary())
    for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
        np.testing.assert_allclose(log[k], brute(b" " + text[a:b].lower(), table), rtol=1e-9)


def test_expected_counts_add_up_to_the_bytes():
    data = np.frombuffer(b"abcde", np.uint8)
    rows, _ = li._matrix(data, np.array([0]), np.array([5]))
    of = li.vocabulary()
    p = np.full((of.size, 1), 1e-3)
    p[0] = 0
    counts = li.expected_counts(rows, np.array([[3.0]]), p, of)
    sizes = np.array([0, *map(len, li.pieces())])
    assert abs((counts[:, 0] * sizes).sum() - 3 * 6) < 1e-9


def test_expected_counts_of_words_of_any_length():
    of, found = li.vocabulary(), li.pieces()
    assert max(map(len, found)) == li.LONGEST == 128
    p = np.random.default_rng(2).random((of.size, 2)) * 1e-6
    p[0] = 0
    p /= p.sum(axis=0)
    texts = ["日本語の文章" * 200, "é", "—" * 64, "internationalisierungen" * 3, "ÃÂ" * 40]
    spelt = [t.encode() for t in texts]
    data, ends = np.frombuffer(b"".join(spelt), np.uint8), np.cumsum([len(w) for w in spelt])
    rows, size = li._matrix(data, ends - [len(w) for w in spelt], ends)
    weight = np.arange(1.0, 11.0).reshape(5, 2)
    counts = li.expected_counts(rows, weight, p, of, size)
    sizes = np.array([0, *map(len, found)])
    np.testing.assert_allclose(sizes @ counts, size @ weight, rtol=1e-9)
    log = li.forward(rows, size, p, of)
    table = {piece: p[k + 1] for k, piece in enumerate(found)}
    for k in (1, 2, 3, 4):
        np.testing.assert_allclose(log[k], brute(rows[k, : size[k]].tobytes(), table), rtol=1e-9)


def test_languages_of_long_runs_are_told_apart(spark):
    rng = random.Random(4)
    say = {"zh": "的一是不了人我在有他这中大来上国", "ja": "のにはをたがでてとしれさるいるも"}
    rows = [(i, "".join(rng.choice(say[k]) for _ in range(40)), k) for i, k in enumerate(["zh", "ja"] * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = li.predict(df, li.fit(df.where("doc_id < 40"))).select("row.doc_id", "lang_pred").collect()
    assert {r.doc_id: r.lang_pred for r in found} == {i: k for i, _, k in rows}


def test_held_out_and_awkward_texts(spark, tmp_path):
    rng = random.Random(3)
    say = {
        "en": lambda: " ".join(rng.choice(["the", "house", "with", "three", "windows", "and", "a", "door"]) for _ in range(12)),
        "de": lambda: " ".join(rng.choice(["das", "haus", "mit", "drei", "fenstern", "und", "einer", "tür"]) for _ in range(12)),
    }
    rows = [(i, say[k](), k, None, None, None, None, None) for i, k in enumerate(["en", "de"] * 60, 100)]
    df = written(awkward(spark, *rows), tmp_path / "documents.parquet")
    found = {r.doc_id: r for r in li.op5_language_id(spark, str(tmp_path)).collect() if r.doc_id is not None}
    assert all(found[i].lang_pred == k for i, _, k, *_ in rows)
    for i in (3, 4, 5, 6):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_no_labels_and_no_rows(spark):
    df = awkward(spark).withColumn("lang", li.F.lit(None).cast("string"))
    model = li.fit(df)
    assert {r.lang_pred for r in li.predict(df, model).collect()} == {"und"}
    assert li.predict(empty(spark), li.fit(empty(spark))).collect() == []
