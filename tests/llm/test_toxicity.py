import math
import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tremorlake.llm.toxicity import (
    MIN_LIFT, MIN_RATIO, Model, Scanner, Trie, Variants, _EDGES, edit_of, fit_logistic, fit_signed, learn_lexicon, op1_toxicity, toxicity, weigh_variants)

from fixtures import SF_DIR, awkward, awkward_rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(nxt[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    words = {"".join(rng.choices("abc", k=rng.randint(5, 8))): 1.0 for _ in range(12)}
    trie = Trie(words, {})
    for _ in range(3000):
        probe = "".join(rng.choices("abc", k=rng.randint(4, 9)))
        assert (trie.near(probe) is not None) == any(distance(probe, w) <= 1 for w in words)


def test_stems_and_short_words_equal_brute_force():
    rng = random.Random(2)
    for _ in range(20):
        words = {"".join(rng.choices("abcdef", k=rng.randint(4, 8))): 1.0 for _ in range(4)}
        stems = {"".join(rng.choices("abcdef", k=rng.randint(4, 8))): 2.0 for _ in range(4)}
        trie = Trie(words, stems)
        for _ in range(400):
            probe = "".join(rng.choices("abcdef", k=rng.randint(2, 11)))
            if rng.random() < 0.7:
                entry = list(rng.choice([*words, *stems]))
                entry[(at := rng.randrange(len(entry))):at + rng.randint(0, 1)] = rng.choice(["", "a", "f"])
                probe = "".join(entry) + rng.choice(["", probe])
            want = any(distance(probe, w) <= 1 for w in words) or any(
                distance(probe[:n], s) <= 1 for s in stems for n in range(len(probe) + 1))
            assert (trie.near(probe) is not None) == want


def test_misspelled_stems_and_short_words_are_hits():
    trie = Trie({"scum": 2.5}, {"achlich": 1.5, "réeux": 1.0})
    assert trie.judge("achhlichau") == (1.5, True) and trie.judge("réeeuxvi") == (1.0, True) and trie.judge("réuxvi") == (1.0, True)
    assert trie.judge("scumm") == (2.5, True) and trie.judge("scm") == (2.5, True) and trie.judge("achtung") is None


def test_stems_words_and_misspellings():
    trie = Trie({"grumbly": 2.0}, {"vorp": 1.5})
    assert trie.judge("grumbly") == (2.0, False) and trie.judge("vorpal") == (1.5, False)
    assert trie.judge("grumblyy") == (2.0, True) and trie.judge("gruumbly") == (2.0, True) and trie.judge("grumpy") is None


def test_quotation_is_told_from_abuse():
    scanner = Scanner(Trie({"grumbly": 2.0}, {}))
    abuse = scanner.features("you are grumbly and a grumbly one")
    quote = scanner.features('they said the word "grumbly" was used in the old letter')
    assert abuse[0] > 0 and abuse[2] == 0 and quote[2] > 0 and quote[0] == 0


def corpus(spark, n=900):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("aeioulnrst", k=rng.randint(3, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = i % 8 == 0
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words[rng.randrange(len(words))] = rng.choice(["grumbly", "blargh", "snorked", f"vorp{rng.choice(['al', 'ing', 'ed', 'er', 'est', 'y'])}"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == r.toxic for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_misspelled_texts_score_as_toxic(spark):
    """One edit in every term, stems included; words the clean texts hold are no misspellings."""
    docs, labels = corpus(spark)
    model = Model.fit(docs, labels)
    wrong = [(r.doc_id, r.text.replace("vorp", "vorrp").replace("grumbly", "grummbly").replace("blargh", "blarrgh").replace("snorked", "snoorked"))
             for r in docs.join(labels.where("toxic = 1"), "doc_id").collect()]
    got = model.score(spark.createDataFrame(wrong, "doc_id long, text string")).collect()
    assert sum(r.predicted for r in got) >= 0.95 * len(got)
    assert Trie({"scum": 1.0}, {}, frozenset(["scup"])).judge("scup") is None


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark, 300)
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r.doc_id, r.score) for r in toxicity(docs, x).collect()) for x in (labels, other))
    assert one == two


def test_awkward_rows(spark):
    docs, labels = corpus(spark, 200)
    model = Model.fit(docs, labels)
    got = model.score(awkward(spark)).collect()
    assert len(got) == len(awkward_rows()) and all(0 <= r.score < 0.5 for r in got)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 5), (3, 1), (3, 0)], "doc_id long, toxic int")
    assert toxicity(awkward(spark), odd).count() == len(awkward_rows())
    assert toxicity(awkward(spark), labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity(docs.limit(0), labels).count() == 0


def test_logistic_fit_separates():
    x = np.array([[0.0], [0.2], [1.8], [2.0]])
    w = fit_logistic(x, np.array([0.0, 0, 1, 1]))
    assert (x[:, 0] * w[0] + w[1] > 0).tolist() == [False, False, True, True]


def test_edits_equal_brute_force():
    rng = random.Random(5)
    for _ in range(4000):
        entry = "".join(rng.choices("abc", k=rng.randint(4, 6)))
        probe = "".join(rng.choices("abc", k=rng.randint(3, 8)))
        stem = rng.random() < 0.5
        found = edit_of(entry, probe, stem)
        prefixes = [probe[:n] for n in range(len(probe) + 1)] if stem else [probe]
        if (probe.startswith(entry) if stem else probe == entry):
            continue
        assert (found is not None) == any(distance(entry, v) == 1 for v in prefixes)
        if found:
            kind, at, variant = found
            assert variant in prefixes and distance(entry, variant) == 1 and variant[:at] == entry[:at]
            assert len(variant) - len(entry) == {"delete": -1, "replace": 0, "insert": 1}[kind]


def test_ordinary_variants_are_no_hits():
    """A stem's neighbour that clean texts hold is none; one never seen is; the first letter needs evidence of its own."""
    rows = [("achlich", "", 0, "achlich", f"achlich{i}", 20, 0) for i in range(5)]
    rows += [("achlich", "delete", 1, "alich", f"alich{i}", 1, 30) for i in range(5)] + [("achlich", "replace", 0, "xchlich", "xchlich", 9, 0)]
    known, variants = weigh_variants(rows, 200, 2000, {}, {"achlich": 3.0})
    trie = Trie({}, {"achlich": 3.0}, known, variants)
    assert trie.judge("alichneu") is None and trie.judge("alich0") is None and trie.judge("ochlichau") is None
    weight, misspelled = trie.judge("achhlichau")
    assert misspelled and math.log(MIN_LIFT) <= weight <= 3.0 and trie.judge("xchlichau")[1]
    assert trie.judge("achlichau") == (3.0, False)
    assert Trie({"scum": 1.0}, {}, frozenset(), Variants({}, {}, {"scum": 0.0})).judge("scm") is None


def test_signs_hold():
    rng = np.random.default_rng(1)
    x = np.abs(rng.normal(size=(400, 3)))
    y = (x[:, 0] - x[:, 1] + 0.1 * x[:, 2] > 0).astype(float)
    w = fit_signed(x, y, (1, 1, -1))
    assert w[0] > 0 and w[1] == 0 and w[2] <= 0


def test_lexicon_equals_brute_force(spark):
    """Counts of places, ratios and lifts in plain Python; the strongest entries, none inside another."""
    docs, labels = corpus(spark)
    rows = [(r.text, r.toxic) for r in docs.join(labels, "doc_id").collect()]
    places = set()
    for text, toxic in rows:
        t = text.lower().split()
        for i, w in enumerate(t):
            places.add((toxic, w.strip(_EDGES), t[i - 1] if i else None, t[i + 1] if i + 1 < len(t) else None))
    count = defaultdict(lambda: [0, 0])
    for toxic, w, _, _ in places:
        if len(w) > 1:
            count[w][toxic] += 1
    prefixes = defaultdict(lambda: [0, 0, 0])
    for w, (good, bad) in count.items():
        for k in range(2, min(16, len(w)) + 1):
            for j, v in enumerate((good, bad, 1)):
                prefixes[w[:k]][j] += v
    good, bad = (sum(c[j] for c in count.values()) for j in (0, 1))
    rate = bad / (good + bad)

    def lift(g, b):
        return (b + 0.5) / (g + 0.5) * (1 - rate) / rate

    def ratio(g, b):
        return 2 * (b * math.log(b / ((g + b) * rate)) + (g * math.log(g / ((g + b) * (1 - rate))) if g else 0))

    strong = {p: ratio(g, b) for p, (g, b, _) in prefixes.items() if b and lift(g, b) >= MIN_LIFT and ratio(g, b) >= MIN_RATIO}
    words, stems = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(stems) <= set(strong) and all(any(w.startswith(p) for p in strong) for w in words)
    entries = [*words, *stems]
    assert all(not a.startswith(b) for a in entries for b in entries if a != b)
    assert all(any(p.startswith(e) or e.startswith(p) for e in entries) for p in strong)
    for s, w in stems.items():
        g, b, n = prefixes[s]
        assert n >= 4 and abs(w - min(6.0, math.log(lift(g, b)))) < 1e-9
    for s, w in words.items():
        assert abs(w - min(6.0, math.log(lift(*count[s])))) < 1e-9
    assert {"grumbly", "blargh", "snorked"} <= set(words) and "vorp" in stems


def test_clean_documents_stay_clean(spark):
    """The registered query on a given table: held-out clean documents are left alone."""
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = op1_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    seen = {(r.toxic, r.predicted): r["count"] for r in got}
    assert seen[0, 1] <= 2 and seen[1, 1] >= 91
    assert op1_toxicity(spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
