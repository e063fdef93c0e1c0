"""Classes of the words that aren't exchanged one by one."""

import random
from collections import Counter

import numpy as np

from linkwright.llm import class_lm

DOCS = "doc_id long, text string"


def test_every_repeated_word_gets_the_class_of_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "SINGLE_WORDS", 6)
    rng = random.Random(21)
    spell = lambda: "".join(rng.choice("abcdefghij") for _ in range(9))
    kinds = [[spell() for _ in range(60)] for _ in range(2)]
    around = [("the", "sat", "."), ("will", "often", "!")]
    docs = []
    for i in range(150):
        parts = []
        for _ in range(12):
            k = rng.randrange(2)
            parts += [around[k][0], rng.choice(kinds[k]), *around[k][1:]]
        docs.append((i, " ".join(parts) + f" once{spell()}"))
    df = class_lm.texts(spark.createDataFrame(docs, DOCS))
    counts = class_lm.word_counts(df)
    m = class_lm.train(df, counts, n_classes=9, dictionary=40)
    table = class_lm.word_classes(df, m, 6).checkpoint()
    want = Counter(w for _, t in docs for w in t.encode().split())
    assert {bytes(r.word): r.n for r in table.collect()} == want
    cls = {bytes(r.word).decode(): r.cls for r in table.collect()}
    sets = [{cls[w] for w in words if want[w.encode()] > 1} for words in kinds]
    assert not sets[0] & sets[1]
    assert all(cls[w.decode()] == m.class_of[m.ids.size + class_lm.ending(w)] for w, n in want.items() if n == 1)

    rows = class_lm.class_rows(df, table, m).checkpoint()
    step, in_class, unknown = class_lm.refit(rows, table, m)
    assert np.allclose((10**step).sum(axis=1), 1)
    assert in_class.sum() == sum(want.values()) + len(docs)
    for c in range(1, len(in_class)):
        members = [n for w, n in want.items() if cls[w.decode()] == c]
        assert sum(members) == in_class[c]
        if members:
            assert abs(sum((n - m.discount) / in_class[c] for n in members) + 10 ** unknown[c] - 1) < 1e-9

    got = {r.doc_id: r.score for r in class_lm.scored(rows, step, in_class, unknown).collect()}
    for i, t in docs[:20]:
        ws = t.split()
        path = [0, *[cls[w] for w in ws], 0]
        score = sum(step[a, b] for a, b in zip(path, path[1:], strict=False))
        score += sum(np.log10((want[w.encode()] - m.discount) / in_class[cls[w]]) for w in ws)
        assert abs(got[i] - score) < 1e-6
