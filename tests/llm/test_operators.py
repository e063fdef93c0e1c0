"""Results against brute force, by definition, or on planted cases."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import class_lm, common, decontaminate, graph, license_scan, linear, near_dups, packing, quality_classifier, quality_rules, sharding, text_stats, toxicity, url_filter

DOCS = "doc_id long, text string"


def shingles(text, k):
    w = text.split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    label = {i: i for i in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        new = dict(label)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(2000)]
    base = [rng.choice(vocab) for _ in range(120)]
    docs = []
    for _ in range(150):  # one dense group, where many pairs are just under the threshold
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        docs.append(" ".join(w))
    for _ in range(60):
        docs.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 150))))
    for t in rng.sample(docs[150:], 20):
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        docs += [" ".join(w), t]
    return list(enumerate(docs))


@pytest.mark.parametrize(("small", "pivots", "block"), [(near_dups.SMALL, near_dups.PIVOTS, 16), (12, 1, 16)])
def test_near_duplicates_match_brute_force(spark, near_copies, monkeypatch, small, pivots, block):
    monkeypatch.setattr(near_dups, "SMALL", small)
    monkeypatch.setattr(near_dups, "PIVOTS", pivots)
    monkeypatch.setattr(near_dups, "BLOCK", block)
    monkeypatch.setattr(near_dups, "DIRECT_BLOCKS", 2 if small == 12 else near_dups.DIRECT_BLOCKS)
    want = brute_components(near_copies, 2, 80)
    got = near_dups.near_duplicates(spark.createDataFrame(near_copies, DOCS), 2, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t, 2)) for i, t in near_copies}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_of_many_edges_send_no_labels(spark, monkeypatch):
    """240,000 edges, 480,000 both ways, are joined by shuffle: their labels would fill a small driver."""

    def sent(df):
        raise AssertionError("labels of many edges were broadcast")

    monkeypatch.setattr(graph.F, "broadcast", sent)
    edges = spark.range(240_000).selectExpr("id * 2 AS a", "id * 2 + 1 AS b")
    got = graph.components(edges)
    assert got.count() == 480_000 and got.filter("label <> v - v % 2").isEmpty()


def test_many_ids_taken_out_send_nothing(spark):
    """60,000 ids and the null one are taken out by shuffle: their table would fill a small driver."""
    docs = spark.range(120_000).selectExpr("nullif(id, 7) AS doc_id", "'a b' AS text")
    bad = docs.filter("doc_id % 2 = 0 OR doc_id IS NULL")
    left = common.without_ids(docs, bad)
    got = left.agg(F.count("*").alias("n"), F.sum(F.col("doc_id") % 2).alias("odd"))
    assert got.first() == (59_999, 59_999)
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    few = common.without_ids(docs, bad.filter("doc_id < 10 OR doc_id IS NULL"))
    assert few.count() == 120_000 - 6


@pytest.mark.parametrize(("most", "taken", "free", "collects"), [(750, 600, 500, True), (750, 400, 300, False), (750, 400, 100, True), (8000, 7000, 6000, False)])
def test_a_small_heap_that_has_grown_is_collected(most, taken, free, collects):
    from types import SimpleNamespace as Made

    done = []
    heap = Made(maxMemory=lambda: most << 20, totalMemory=lambda: taken << 20, freeMemory=lambda: free << 20)
    lang = Made(Runtime=Made(getRuntime=lambda: heap), System=Made(gc=lambda: done.append(1)))
    common.tidy(Made(_jvm=Made(java=Made(lang=lang))))
    assert bool(done) == collects


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(30)] + [(200, i) for i in range(201, 260)]
    label = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.v: r.label for r in got} == label


def test_prefixes_hold_a_common_item():
    rng = np.random.default_rng(1)
    for _ in range(300):
        base = rng.choice(400, 60, replace=False)
        a, b = (np.unique(np.concatenate([rng.permutation(base)[: rng.integers(50, 61)], rng.integers(400, 500, rng.integers(0, 6))])).astype(np.uint64) for _ in "ab")
        pivots = near_dups.Pivots([7, 8], [base[:40].astype(np.uint64), base[20:].astype(np.uint64)][: rng.integers(0, 3)])
        if near_dups.alike(a, b, 80):
            a, b = sorted((a, b), key=len)
            (x, inner), (y, _) = pivots.prefix(np.sort(a), 80), pivots.prefix(np.sort(b), 80)
            assert set(x[:inner].tolist()) & set(y.tolist())
    known = near_dups.Pivots([5, 6], [np.arange(10, dtype=np.uint64), np.arange(3, 11, dtype=np.uint64)])
    assert known.alike(np.arange(9, dtype=np.uint64), 80).tolist() == [5] and known.alike(np.arange(3, 11, dtype=np.uint64), 60).tolist() == [5, 6]


def test_boilerplate_makes_no_pairs(spark, monkeypatch):
    """Documents that share most of their words, none similar enough: work must follow their number, not its square."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(75)]
    made = []
    monkeypatch.setattr(near_dups, "DIRECT_BLOCKS", 2)

    def watched(name):
        inner = getattr(near_dups, name)
        monkeypatch.setattr(near_dups, name, lambda *a: made.append((name, a[0].count())) or inner(*a))

    for name in ("block_pairs", "confirmed", "star_links", "prefix_items"):
        watched(name)
    rows = {}
    for n in (800, 2400):
        made.clear()
        docs = [(i, " ".join([*base, *[f"u{rng.randrange(10**9)}" for _ in range(30)]])) for i in range(n)]
        got = near_dups.near_duplicates(spark.createDataFrame(docs, DOCS), 2, 80)
        assert got.filter("kept").count() == n
        rows[n] = sum(c for _, c in made)
        assert not any(c for name, c in made if name in ("block_pairs", "confirmed")) and rows[n] >= n
    assert rows[2400] <= 3.2 * rows[800]


def test_block_links_are_exact():
    rng = np.random.default_rng(0)
    sets = [(i, np.unique(rng.integers(0, 40, 30)).astype(np.uint64)) for i in range(14)]
    left, right = sets[:6], sets[4:]
    pairs = [(i, j) for i, a in left for j, b in right if near_dups.alike(a, b, 60)]

    def joined(links):
        root = {i: i for i, _ in sets}
        for _ in root:
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    links = near_dups.block_links(left, right, 60)
    assert set(links) <= set(pairs) and joined(links) == joined(pairs) and len(links) < 14


def test_licences(spark):
    mit = license_scan.TEMPLATES["mit"]
    paragraphs = "\n\n".join([mit[:480], mit[480:690], mit[690:]])
    code = "\n".join(f"int f{i}(int a{i}) {{ return a{i} + {i}; }}" for i in range(60))
    docs = [
        (1, "Prose.\nReleased under the MIT License.\nMore."), (2, mit.replace("hereby", "now")), (3, paragraphs), (4, "Licensed to drive"), (5, "licensed under cc by-nc 4.0"),
        (6, "This work is licenced under the GNU General Public Licence, version 3!"), (7, paragraphs + "\n\n" + code), (8, mit + "\n" + code),
        (9, "This project is Released under the MIT License. Have a look at it."), (10, None), (11, ""), (12, code + license_scan.TEMPLATES["bsd-3-clause"] + code),
    ]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(docs, DOCS)).collect()}
    assert (got[1].license, got[1].first_token, got[1].n_tokens, got[1].dice) == ("mit-notice", 1, 5, 1.0)
    assert got[2].license == got[3].license == got[7].license == got[8].license == "mit" and 0.9 < got[2].dice < 1 and got[7].dice == got[8].dice == 1
    assert got[4].license is None and got[5].license == "cc-by-nc-4.0-notice" and got[6].license == "gpl-3.0-notice"
    assert (got[9].license, got[9].first_token) == ("mit-notice", 3) and got[10].license is got[11].license is None and got[10].licenses == []
    assert got[12].license == "bsd-3-clause" and "bsd-2-clause" in got[12].licenses


def test_licence_windows_match_brute_force():
    texts = {k: license_scan.TEMPLATES[k] for k in ("mit-notice", "mit-notice-licensed", "apache-2.0-notice", "mpl-2.0-header", "isc")}
    made = license_scan.Templates(texts, 0.8)
    sets = {t: license_scan.bigrams(license_scan.tokens(x)) for t, x in texts.items()}
    rng = random.Random(1)
    for _ in range(120):
        w = [rng.choice(["the", "license", "under", "zz", "of"]) for _ in range(rng.randint(0, 12))]
        for name in rng.sample(sorted(texts), rng.randint(0, 2)):
            t = license_scan.tokens(texts[name])
            for _ in range(rng.randint(0, max(1, len(t) // 6))):
                t.insert(rng.randrange(len(t) + 1), rng.choice(["zz", "the", t[0]])) if rng.random() < 0.5 else t.pop(rng.randrange(len(t)))
            w += t + [rng.choice(["the", "license", "zz"]) for _ in range(rng.randint(0, 9))]
        want = []
        for t, x in texts.items():
            m = len(license_scan.tokens(x))
            hits = []
            for span in {min(len(w), max(2, m * a // b)) for a, b in license_scan.PARTS}:
                for i in range(len(w) - span + 1):
                    g = license_scan.bigrams(w[i : i + span])
                    hits.append((-2 * len(g & sets[t]) / (len(g) + len(sets[t])), i, span))
            if len(w) > 1 and -min(hits)[0] >= 0.8:
                want.append((-min(hits)[0], len(sets[t]), t, *min(hits)[1:]))
        assert sorted(made.matches(" ".join(w))) == sorted(want)


def test_leaks(spark):
    item = "If Anna has 3 apples and Bob has 12 apples, how many kg do Anna and Bob carry in total today?"
    docs = [
        (1, f"Before it all. {item} And after."), (2, "If Carl has 7.5 apples and Dora has 15 apples, how many miles do Carl and Dora carry in total today?"),
        (3, "If Carl has 7 apples and Dora has 15 apples, how many miles do Eve and Frank carry in total today?"), (4, "Nothing of the kind is in here, not one of its windows at all."),
        (5, " ".join(item.split()[:11])), (6, "just two words"),
    ]
    items = spark.createDataFrame([(10, item), (11, "two words")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_items(spark.createDataFrame(docs, DOCS), items).collect()}
    assert set(found) == {(1, 10), (2, 10), (3, 10), (5, 10), (6, 11)}
    assert found[(1, 10)].leaked and found[(2, 10)].leaked and found[(6, 11)].leaked
    assert not found[(3, 10)].consistent and not found[(3, 10)].leaked and not found[(5, 10)].leaked
    by_shuffle = decontaminate.find_items(spark.createDataFrame(docs, DOCS), items, broadcast_rows=0).collect()
    assert sorted(map(str, by_shuffle)) == sorted(map(str, found.values()))
    kept = decontaminate.without_leaks(spark.createDataFrame(docs, DOCS), items)
    assert kept.columns == ["doc_id", "text"] and {r.doc_id for r in kept.collect()} == {3, 4, 5}


def labelled(spark, n=400):
    rng = random.Random(2)
    vocab = [f"plain{chr(97 + i % 26)}{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(40)]
        toxic, junk = i % 5 == 0, i % 4 == 1
        if toxic:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["moron", "scum", "idiot"])
        if junk:
            w = [x.upper() + "%%%" for x in w]
        docs.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_rows_without_labels(spark):
    docs, labels = labelled(spark)
    got = toxicity.toxicity_scores(docs, labels.filter("doc_id % 3 <> 0")).filter("doc_id % 3 = 0").collect()
    wrong = [r.doc_id for r in got if r.is_toxic != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 2
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and abs(kept.count() - 320) <= 3


def test_logistic_regression_reaches_the_optimum():
    rng = np.random.default_rng(4)
    dense = rng.normal(size=(300, 3))
    y = (dense @ [1.0, -2.0, 0.5] + rng.normal(size=300) > 0.3).astype(float)
    cols = np.tile(np.arange(3), 300)
    x = linear.Rows(cols, dense.ravel(), np.arange(0, 901, 3), np.zeros((300, 0)), 3)
    w, b = linear.fit_logistic(x, y, l2=1.0, rounds=200)
    r = linear.sigmoid(dense @ w + b) - y
    assert np.abs(np.append(dense.T @ r + w, r.sum())).max() < 0.3
    part = x.take(np.array([5, 2]))
    assert np.allclose(part.dot(np.append(w, [])), dense[[5, 2]] @ w)


def test_quality_on_rows_held_out(spark):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_classifier.quality_scores(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(r.predicted == truth[r.doc_id] for r in held) and all(0 <= r.score <= 1 for r in got)
    flipped = labels.withColumn("quality", __import__("pyspark").sql.functions.expr("if(crc32(encode(cast(doc_id AS string), 'UTF-8')) % 4 = 2, 1 - quality, quality)"))
    again = {r.doc_id: r.score for r in quality_classifier.quality_scores(docs, flipped).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)  # labels held out are never learned


def test_packing_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(30):
        n, k = int(rng.integers(1, 9)), int(rng.integers(1, 5))
        lengths = np.sort(rng.choice(np.arange(1, 40), n, replace=False))
        counts = rng.integers(1, 9, n)

        def waste(bounds, lengths=lengths, counts=counts):
            return sum(int(c) * (min(b for b in bounds if b >= x) - int(x)) for x, c in zip(lengths, counts, strict=True))

        best = min(waste([*c, int(lengths[-1])]) for r in range(min(k, n)) for c in itertools.combinations(map(int, lengths), r))
        bounds = packing.best_bounds(lengths, counts, lengths * counts, k)
        assert len(bounds) <= k and waste(bounds) == best


def test_packing_batches(spark):
    rng = random.Random(6)
    docs = [(i, " ".join("x" * rng.randint(0, 60))) for i in range(300)] + [(300, "x " * 5000)]
    got = packing.pack_documents(spark.createDataFrame(docs, DOCS), n_buckets=4, budget=500).collect()
    tokens = {i: len(t.split()) + 1 for i, t in docs}
    assert {r.doc_id: r.n_tokens for r in got} == tokens and len({r.bucket for r in got}) == 4
    batches = Counter((r.bucket, r.batch) for r in got)
    for r in got:
        assert r.n_tokens <= r.pad_to and (batches[(r.bucket, r.batch)] * r.pad_to <= 500 or batches[(r.bucket, r.batch)] == 1)
    for b in range(4):
        rows = sorted((r.batch, r.slot, r.doc_id) for r in got if r.bucket == b)
        assert [r[2] for r in rows] == sorted(r[2] for r in rows)


def test_class_model_is_a_distribution(spark):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choice(["the cat", "a dog", "sat down", "ran off", f"rare{i}"]) for _ in range(12))) for i in range(80)]
    df = class_lm.texts(spark.createDataFrame(docs, DOCS))
    counts = class_lm.word_counts(df)
    m = class_lm.train(df, counts, n_classes=6, dictionary=30)
    assert np.allclose((10**m.step).sum(axis=1), 1)
    words = {bytes(r.word): r.n for r in counts.collect()}
    for c in range(1, len(m.class_tokens)):
        if m.class_tokens[c] == 0:
            continue
        total = 10 ** m.class_unknown[c]
        for w, n in words.items():
            if w != class_lm.END and m.class_of[m.ids[w]] == c:
                total += (n - m.discount) / m.class_tokens[c]
        assert abs(total - 1) < 1e-9, c


def test_scores_of_texts(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice(["The Cat sat", "a DOG ran", f"odd{i} thing"]) for _ in range(10))) for i in range(120)]
    got = {r.doc_id: r for r in class_lm.lm_scores(spark.createDataFrame(docs, DOCS), n_classes=8, dictionary=5).collect()}
    c = Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 10:
            c.update([*t.lower().split(), " "])
    total, types = sum(c.values()), len(c)
    for i, t in docs:
        toks = [*t.lower().split(), " "]
        base = sum(np.log10((c[w] + 0.1) / (total + 0.1 * (types + 1))) for w in toks)
        r = got[i]
        assert abs(r.base_score - base) < 1e-6 and (r.n_tokens, r.n_known, r.train_tokens) == (len(toks), sum(c[w] > 0 for w in toks), total)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_exchange_separates_what_alternates():
    n = np.zeros((9, 9))
    for a in (1, 2, 3, 4):
        for b in (5, 6, 7, 8):
            n[a, b], n[b, a] = 50 + a, 40 + b
    n[0, 1:5], n[5:, 0] = 10, 10
    cls = class_lm.exchange(n, 3)
    assert len(set(cls[1:5])) == 1 and len(set(cls[5:])) == 1 and cls[1] != cls[5] and cls[0] == 0


def brute_counts(text):
    w = text.split()
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g, c in Counter(grams).items() if c > 1}
    covered = {i + j for i, g in enumerate(grams) if g in twice for j in range(3)}
    lines = [x for x in text.split("\n") if x.split()]
    return len(w), sum(map(len, w)), sum(text.count(s) for s in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered)


def test_counts(spark):
    rng = random.Random(9)
    texts = ["\n".join(" ".join(rng.choice(["a", "bb", "c#", "d|d", "ü"]) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 6))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = text_stats.with_counts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_rules_adapt_to_groups(spark):
    rng = random.Random(10)
    rows = []
    for i in range(600):
        symbols = i % 2 == 0  # one source writes with symbols as a rule
        w = [f"w{rng.randrange(5000)}" + ("##" if symbols else "") for _ in range(80)]
        if i in (7, 9):
            w = [x + "##" for x in w]
        rows.append((i, " ".join(w), "en", "marked" if symbols else "plain"))
    got = {r.doc_id: r for r in quality_rules.rule_verdicts(spark.createDataFrame(rows, DOCS + ", lang string, source string")).collect()}
    assert {i for i, r in got.items() if not r.kept} == {7, 9}


def test_shards(spark):
    rng = random.Random(12)
    docs = [(i, "x" * rng.randrange(200)) for i in range(500)]
    got = sorted((r.shard, r.slot, r.doc_id, r.size) for r in sharding.assign_shards(spark.createDataFrame(docs, DOCS)).collect())
    assert [g[2] for g in got] == list(range(500)) and [g[1] for g in got] == [k for s in range(16) for k in range(sum(g[0] == s for g in got))]
    total = sum(g[3] for g in got)
    assert all(abs(sum(g[3] for g in got if g[0] == s) - total / 16) <= 200 for s in range(16))


def test_page_rank(spark):
    links = {"a.org": ["b.net", "c.net"], "b.net": ["c.net"], "d.net": ["bad.com"], "e.net": ["d.net", "a.org"], "bad.com": []}
    rows = []
    for i, (h, to) in enumerate(links.items()):
        path = "/de/" if h == "bad.com" else "/x"
        rows.append((i, f"http://{h}{path}", "".join(f'<a href="https://{t}/q">' for t in to) + "<a href='/own'>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in url_filter.host_scores(pages, rounds=12).collect()}
    hosts = sorted({*links, "c.net"})
    fwd = np.zeros((6, 6))
    for h, to in links.items():
        for t in to:
            fwd[hosts.index(h), hosts.index(t)] = 1 / len(to)
    back = fwd.T / np.maximum(fwd.T.sum(axis=1, keepdims=True), 1e-300)

    def rank(m, seed):
        v = s = np.array([0.5 if h == seed else 0.0 for h in hosts])
        for _ in range(12):
            v = 0.15 * s + 0.85 * v @ m
        return v

    for k, h in enumerate(hosts):
        assert abs(got[h].trust - rank(fwd, "a.org")[k]) < 1e-12 and abs(got[h].distrust - rank(back, "bad.com")[k]) < 1e-12
    verdicts = {r.host: r.verdict for r in url_filter.judge_pages(pages).collect()}
    assert verdicts == {"a.org": "allow", "b.net": "allow", "d.net": "block", "e.net": "block", "bad.com": "block"}
