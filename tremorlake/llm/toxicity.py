"""Toxicity: a lexicon trie learned from labels, met by Levenshtein automata, with scores of the words around a hit.

Learning takes a bounded sample of labelled texts. For every prefix of their words it counts the distinct places
(word before, word after) in toxic and in clean texts; counting places instead of documents keeps copies of one
document from looking like evidence. Prefixes that stand in toxic texts far more often than in clean ones enter the
lexicon, strongest first and never one inside another: as a stem when many different words continue it, else as a
whole word. Each carries the logarithm of its lift as weight.

Scoring reads whole texts. A word is a hit when it starts with a stem, equals a lexicon word, or is a likely
misspelling of one: the automaton of the word walks down the trie, gives up a branch when its whole row of distances is
above the bound, and accepts words, or stems by a prefix, within edit distance 1. A misspelling is judged as a variant
of its entry: the sample's clean texts tell how ordinary the variant itself is, or, where it was never seen, how often
edits of this kind at this letter make ordinary words. It weighs what its own lift says, never more than its entry, and
is no hit below ``MIN_LIFT``. Stems are not met with an edit of their first letter unless the sample holds that variant.
Each hit is weighed by its window: quotation marks or words of reporting around it speak for a quotation, other hits
close by for abuse. A logistic model, fitted on the same sample, turns the weights into the score; hits outside of
quotations only raise it, quoted ones never do.

Two bounds are part of the method: prefixes are learned up to ``LONGEST_PREFIX`` letters (a longer word is an entry by
that prefix or as a whole word), and no entry weighs more than ``MOST_WEIGHT``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorlake.llm.common import Scratch, map_texts, table, use_text_batches

#: At most so many labelled texts of either label are learned from.
FIT_ROWS = 3000
#: A lexicon entry needs this log-likelihood ratio and this lift over the sample's own rate.
MIN_RATIO = 30.0
MIN_LIFT = 6.0
#: A prefix with so many different words is a stem.
FAMILY_WORDS = 4
LONGEST_PREFIX = 16
MOST_WEIGHT = 6.0
#: The share of an entry's occurrences taken to be misspelled, spread evenly over its possible edits.
MISSPELT = 0.2
#: Entries from this length on are also met with one edit.
SHORTEST_NEAR = 4
WINDOW = 8
SEEN_WORDS = 400_000
FEATURES = 6
#: The sign that each feature's weight may have.
SIGNS = (1, 1, -1, 1, 1, 1)

_EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>«»„“”‚‘’…|*_~`#$%&^+=-–—/\\"
_QUOTES = frozenset("\"«»„“”")
#: Verbs that announce someone else's words.
_REPORTING = frozenset("said says wrote called quote quoted sagte schrieb zitat dit écrit cité dijo escribió cita".split())


def edit_of(entry: str, word: str, stem: bool) -> tuple[str, int, str] | None:
    """(kind, place, variant) of the one edit between ``entry`` and ``word``, or the shortest fitting prefix of it."""
    for n in ((len(entry) - 1, len(entry), len(entry) + 1) if stem else (len(word),)):
        variant = word[:n]
        if len(variant) < n or abs(n - len(entry)) > 1:
            continue
        at = 0
        while at < min(n, len(entry)) and variant[at] == entry[at]:
            at += 1
        if n < len(entry) and variant[at:] == entry[at + 1:]:
            return "delete", at, variant
        if n == len(entry) and variant[at + 1:] == entry[at + 1:]:
            return "replace", at, variant
        if n > len(entry) and variant[at + 1:] == entry[at:]:
            return "insert", at, variant
    return None


class Variants:
    """Weights of misspellings: of variants that the sample holds, and of others by entry, kind and place of the edit."""

    def __init__(self, seen: dict[tuple[str, str], float], cells: dict[tuple[str, str, int], float], unseen: dict[str, float]):
        self.seen, self.cells, self.unseen = seen, cells, unseen

    def weight(self, entry: str, word: str, stem: bool) -> float:
        kind, at, variant = edit_of(entry, word, stem) or ("", 0, "")
        if not kind:
            return 0.0
        if (entry, variant) in self.seen:
            return self.seen[entry, variant]
        if stem and at == 0:
            return 0.0
        return self.cells.get((entry, kind, at), self.unseen[entry])


class Trie:
    """Lexicon words and stems as nested dicts, both with their weights.

    ``None`` leads to the whole word and ``""`` to the stem that ends in a node. Entries below ``SHORTEST_NEAR`` letters
    are only met as they stand. ``known`` holds words that are no misspellings of an entry; ``variants`` weighs the
    others, which without it count as their entry.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], known: frozenset[str] = frozenset(), variants: Variants | None = None):
        self.root: dict = {}
        self.words, self.stems, self.known, self.variants = words, stems, known, variants
        self.stem_lengths = sorted({len(s) for s in stems})
        long = [w for w in words if len(w) >= SHORTEST_NEAR]
        long_stems = [s for s in stems if len(s) >= SHORTEST_NEAR]
        for entry, end in [*((w, None) for w in long), *((s, "") for s in long_stems)]:
            node = self.root
            for ch in entry:
                node = node.setdefault(ch, {})
            node[end] = entry
        # One edit leaves the first or the second half of an entry whole: a cheap test before the walk. The second
        # half of a stem stands where it belongs or one letter beside it.
        self.heads = frozenset(w[:len(w) // 2] for w in [*long, *long_stems])
        self.tails = frozenset(w[len(w) // 2:] for w in long)
        self.stem_tails = frozenset(w[len(w) // 2:] for w in long_stems)
        self.head_lengths = sorted({len(x) for x in self.heads})
        self.tail_lengths = sorted({len(x) for x in self.tails})
        self.stem_tail_places = sorted({(at, len(s) - len(s) // 2) for s in long_stems for at in range(len(s) // 2 - 1, len(s) // 2 + 2)})

    def near(self, word: str) -> str | None:
        """An entry that the automaton of ``word`` (distance at most 1) accepts: a lexicon word for the whole word, a
        stem for any of its prefixes."""
        return next((entry for entry, _ in self.accepted(word)), None)

    def accepted(self, word: str) -> Iterator[tuple[str, bool]]:
        """All (entry, is it a stem) that the automaton of ``word`` accepts."""
        if len(word) < SHORTEST_NEAR - 1:
            return
        if not (any(word[:n] in self.heads for n in self.head_lengths) or any(word[-n:] in self.tails for n in self.tail_lengths)
                or any(word[at:at + n] in self.stem_tails for at, n in self.stem_tail_places)):
            return
        stack = [(self.root, tuple(range(len(word) + 1)))]
        while stack:
            node, row = stack.pop()
            for ch, child in node.items():
                if ch is None:
                    if row[-1] <= 1:
                        yield child, False
                    continue
                if ch == "":
                    if min(row) <= 1:
                        yield child, True
                    continue
                nxt = [row[0] + 1]
                for j, own in enumerate(word):
                    nxt.append(min(nxt[j] + 1, row[j + 1] + 1, row[j] + (own != ch)))
                if min(nxt) <= 1:
                    stack.append((child, tuple(nxt)))

    def exact(self, word: str) -> str | None:
        """The entry that ``word`` is or begins with."""
        if word in self.words:
            return word
        return next((word[:n] for n in self.stem_lengths if word[:n] in self.stems), None)

    def judge(self, word: str) -> tuple[float, bool] | None:
        """(weight, misspelled) of a hit."""
        entry = self.exact(word)
        if entry is not None:
            return (self.words[entry] if entry == word and entry in self.words else self.stems[entry]), False
        if word in self.known:
            return None
        best = 0.0
        for entry, stem in self.accepted(word):
            best = max(best, self.variants.weight(entry, word, stem) if self.variants else (self.stems if stem else self.words)[entry])
        return (best, True) if best > 0 else None


class Scanner:
    """Finds hits in whole texts and turns them into features; remembers the words it has judged."""

    def __init__(self, trie: Trie):
        self.trie = trie
        self.clean: set[str] = set()
        self.hits: dict[str, tuple[float, bool]] = {}

    def features(self, text: str | None) -> list[float]:
        if not text:
            return [0.0] * FEATURES
        tokens = text.lower().split()
        present = set(tokens)
        for token in present - self.clean:
            if token not in self.hits:
                judged = self.trie.judge(token.strip(_EDGES))
                if judged:
                    self.hits[token] = judged
                else:
                    self.clean.add(token)
        if len(self.clean) > SEEN_WORDS:
            self.clean = set()
        found = present & self.hits.keys()
        if not found:
            return [0.0] * FEATURES
        places = [i for i, token in enumerate(tokens) if token in found]
        weights = [self.hits[tokens[at]][0] for at in places]
        cited = [self._quoted(tokens, at) for at in places]
        own = [at for at, q in zip(places, cited) if not q]
        abuse = sum(w for w, q in zip(weights, cited) if not q)
        quoted = sum(w for w, q in zip(weights, cited) if q)
        crowded = sum((n > 0 and at - own[n - 1] <= WINDOW) or (n + 1 < len(own) and own[n + 1] - at <= WINDOW) for n, at in enumerate(own))
        return [math.log1p(abuse), math.log1p(crowded), math.log1p(quoted), float(len(own) >= 2), float(len(own) >= 3),
                math.log1p(100 * abuse / len(tokens))]

    @staticmethod
    def _quoted(tokens: list[str], at: int) -> bool:
        around = tokens[max(0, at - WINDOW):at + WINDOW + 1]
        before = sum(ch in _QUOTES for token in tokens[max(0, at - WINDOW):at] for ch in token)
        own = tokens[at]
        opened = before % 2 == 1 or own[0] in _QUOTES
        closed = own[-1] in _QUOTES or any(ch in _QUOTES for token in tokens[at + 1:at + WINDOW + 1] for ch in token)
        return (opened and closed) or any(w.strip(_EDGES) in _REPORTING for w in around)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int, folds: bool) -> DataFrame:
    """Up to ``fit_rows`` labelled texts of each label, chosen by a hash of the id; equal texts once.

    With ``folds`` the rows whose crc32 of the id is divisible by 5 are left out.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    if folds:
        known = known.where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    order = F.xxhash64("id", F.lit(5))
    picked = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(order, "id").limit(fit_rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    # at most 2 * fit_rows ids by construction
    return texts.join(F.broadcast(picked), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn_lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """(words, stems) with their weights, from prefixes of words that stand in toxic texts far more often."""
    edge = "".join("\\" + ch for ch in _EDGES if not ch.isspace())
    tokens = F.filter(F.split(F.lower("text"), r"\s+"), lambda t: t != "")
    n = F.size("t")
    # the words on both sides, whole: short texts inside a sample, so the array of one text is small
    places = sample.select("toxic", tokens.alias("t")).where(n > 0).select("toxic", F.explode(F.transform(
        F.sequence(F.lit(1), n), lambda i: F.struct(
            F.regexp_replace(F.element_at("t", i), f"^[{edge}]+|[{edge}]+$", "").alias("word"),
            F.xxhash64(F.when(i > 1, F.try_element_at("t", F.greatest(i - 1, F.lit(1)))), F.try_element_at("t", i + 1)).alias("place")))).alias("p"))
    words = (places.where(F.length("p.word") > 1).select("toxic", "p.word", "p.place").distinct().groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")))
    lengths = F.sequence(F.lit(2), F.least(F.length("word"), F.lit(LONGEST_PREFIX)))
    prefixes = words.select("word", "bad", "good", F.explode(F.transform(
        lengths, lambda k: F.substring("word", F.lit(1), k))).alias("prefix"))
    table_ = prefixes.groupBy("prefix").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("words"),
        F.max_by("word", "bad").alias("top"), F.max("bad").alias("top_bad"), F.max_by("good", "bad").alias("top_good"))
    total = words.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    if not total.bad or not total.good:
        return {}, {}
    rate = total.bad / (total.bad + total.good)

    def ratio(bad, good):
        count = bad + good
        return 2 * (bad * F.log(bad / (count * rate)) + F.when(good > 0, good * F.log(good / (count * (1 - rate)))).otherwise(0))

    def lift(bad, good):
        return (bad + 0.5) / (good + 0.5) * (1 - rate) / rate

    strong = table_.where((F.col("bad") > 0) & (lift(F.col("bad"), F.col("good")) >= MIN_LIFT)).withColumn(
        "ratio", ratio(F.col("bad"), F.col("good"))).where(F.col("ratio") >= MIN_RATIO)
    # a row stands for many places in toxic texts of the sample, so their number is bounded with it
    rows = sorted(strong.collect(), key=lambda r: (-r.ratio, -len(r.prefix), r.prefix))
    found_words: dict[str, float] = {}
    found_stems: dict[str, float] = {}
    for r in rows:
        entries = [*found_words, *found_stems]
        if any(e.startswith(r.prefix) or r.prefix.startswith(e) for e in entries):
            continue
        weight = lambda bad, good: min(MOST_WEIGHT, math.log((bad + 0.5) / (good + 0.5) * (1 - rate) / rate))
        if r.words >= FAMILY_WORDS and 2 * r.top_bad < r.bad and len(r.prefix) > 2:
            found_stems[r.prefix] = weight(r.bad, r.good)
        elif 2 * r.top_bad >= r.bad:
            found_words[r.top] = weight(r.top_bad, r.top_good)
    return found_words, found_stems


def learn_variants(sample: DataFrame, words: dict[str, float], stems: dict[str, float]) -> tuple[frozenset[str], Variants]:
    """(words that are no misspellings, weights of the misspellings), from words of the sample one edit from an entry.

    A variant that the sample holds has its own lift, drawn toward that of its cell (entry, kind and place of the edit).
    For variants it lacks, the cell's clean variants that stand there once tell how many more there are, drawn toward
    the average of the entry's cells.
    """
    def make():
        trie = Trie(words, stems)
        judged: dict[str, list[tuple[str, str, int, str]]] = {}

        def judge(word):
            entry = trie.exact(word)
            if entry is not None:
                return [(entry, "", 0, entry)]
            return [(e, *found) for e, stem in trie.accepted(word) if (found := edit_of(e, word, stem))]

        def work(batch):
            out: dict[str, list] = {n: [] for n in ("entry", "kind", "at", "variant", "word", "toxic")}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                for word in {token.strip(_EDGES) for token in text.lower().split()}:
                    if word not in judged:
                        judged[word] = judge(word)
                    for row in judged[word]:
                        for name, value in zip(out, (*row, word, toxic)):
                            out[name].append(value)
            return out

        return work

    texts = {x.toxic: x["count"] for x in sample.groupBy("toxic").count().collect()}
    fields = [("entry", T.StringType()), ("kind", T.StringType()), ("at", T.IntegerType()), ("variant", T.StringType()),
              ("word", T.StringType()), ("toxic", T.IntegerType())]
    bad, good = F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    # words of the bounded sample, and of them only entries and their neighbours
    rows = map_texts(sample, ["text", "toxic"], fields, make).groupBy("entry", "kind", "at", "variant", "word").agg(bad, good).collect()
    return weigh_variants([tuple(r) for r in rows], texts.get(1, 0), texts.get(0, 0), words, stems)


def weigh_variants(rows: list[tuple], toxic: int, clean: int, words: dict[str, float], stems: dict[str, float]) -> tuple[frozenset[str], Variants]:
    """The judgement of ``learn_variants`` from its counts: (entry, kind, place, variant, word, toxic texts, clean texts)."""
    entry_bad: dict[str, int] = {}
    counts: dict[tuple[str, str, int], dict[str, list[int]]] = {}
    spoken: dict[str, tuple[int, int]] = {}
    for entry, kind, at, variant, word, bad, good in rows:
        if not kind:
            entry_bad[entry] = entry_bad.get(entry, 0) + bad
            continue
        pair = counts.setdefault((entry, kind, at), {}).setdefault(variant, [0, 0])
        pair[0] += bad
        pair[1] += good
        spoken[word] = (bad, good)
    known = frozenset(w for w, (bad, good) in spoken.items() if good * toxic >= bad * clean)

    def weight(entry, bad, good):
        if not toxic or not clean or bad <= 0:
            return 0.0
        lift = math.log(bad / toxic * clean / good)
        full = max(words.get(entry, 0.0), stems.get(entry, 0.0))
        return 0.0 if lift < math.log(MIN_LIFT) else min(lift, full)

    places = {e: 3 * len(e) + 1 for e in {*words, *stems}}
    expected = {e: MISSPELT * entry_bad.get(e, 0) / places[e] for e in places}
    once_in = {key: sum(good == 1 for _, good in found.values()) for key, found in counts.items()}
    # what an average cell of the entry holds: all that is known of cells without any variant
    average = {e: (0.5 + sum(n for (own, _, _), n in once_in.items() if own == e)) / places[e] for e in places}
    seen, cells = {}, {}
    for (entry, kind, at), found in counts.items():
        once = once_in[entry, kind, at] + average[entry]
        prior = 0.0 if entry in stems and at == 0 else expected[entry]
        cells[entry, kind, at] = weight(entry, prior, once)
        for variant, (bad, good) in found.items():
            seen[entry, variant] = weight(entry, bad + prior, good + once)
    return known, Variants(seen, cells, {e: weight(e, expected[e], average[e]) for e in places})


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (bias last) of a logistic model by damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_signed(x: np.ndarray, y: np.ndarray, signs: tuple[int, ...]) -> np.ndarray:
    """As ``fit_logistic``; a feature whose weight gets the wrong sign is left out (weight 0), the worst one first."""
    kept = list(range(x.shape[1]))
    while True:
        w = fit_logistic(x[:, kept], y)
        wrong = [(w[i] * signs[k], k) for i, k in enumerate(kept) if w[i] * signs[k] < 0]
        if not wrong:
            break
        kept.remove(min(wrong)[1])
    full = np.zeros(x.shape[1] + 1)
    full[[*kept, x.shape[1]]] = w
    return full


def _features(df: DataFrame, lexicon: tuple, keep: list[tuple[str, T.DataType]]) -> DataFrame:
    names = [n for n, _ in keep]

    def make():
        scanner = Scanner(Trie(*lexicon))
        return lambda batch: {**{n: batch[n] for n in names}, "f": [scanner.features(t) for t in batch["text"]]}

    return map_texts(df, [*names, "text"], [*keep, ("f", T.ArrayType(T.DoubleType()))], make)


class Model:
    """A lexicon (words, stems, words that are no misspellings, weights of misspellings) and the weights of its features."""

    def __init__(self, lexicon: tuple[dict[str, float], dict[str, float], frozenset[str], Variants], weights: list[float]):
        self.lexicon, self.weights = lexicon, weights

    @staticmethod
    def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", fit_rows=FIT_ROWS, folds=True) -> Model:
        """Learn from labelled rows; without any, or with one label only, the model scores everything low.

        The sample, at most twice ``fit_rows`` texts, is written once and deleted after the fit.
        """
        use_text_batches(docs.sparkSession)
        with Scratch(docs.sparkSession, "toxicity") as scratch:
            sample = scratch.stage(labelled_sample(docs, labels, id_col, text_col, label_col, fit_rows, folds), "sample")
            words, stems = learn_lexicon(sample)
            lexicon = (words, stems, *learn_variants(sample, words, stems))
            # at most 2 * fit_rows rows of a few numbers
            rows = _features(sample, lexicon, [("toxic", T.IntegerType())]).collect()
        y = np.array([r.toxic for r in rows], float)
        if len(set(y)) < 2:
            return Model(lexicon, [0.0] * FEATURES + [-3.0])
        return Model(lexicon, fit_signed(np.array([r.f for r in rows], float), y, SIGNS).tolist())

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id_col, score, predicted) for every row."""
        named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        weights = self.weights
        scored = _features(named, self.lexicon, [("id", docs.schema[id_col].dataType)])
        logit = sum((F.col("f")[i] * w for i, w in enumerate(weights[:-1])), F.lit(weights[-1]))
        p = 1 / (1 + F.exp(-logit))
        return scored.select(F.col("id").alias(id_col), p.alias("score")).withColumn(
            "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of ``docs``; the label is read from training rows only.

    Null and empty texts get the score of a text without hits. A null id is not held out and carried through;
    repeated rows are scored each for itself. Labels other than 0 and 1, labels of unknown ids and repeated labels
    (the higher counts) do no harm. Other columns are not read. An empty table gives an empty result.
    """
    model = Model.fit(docs, labels, id_col, text_col, label_col)
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return model.score(docs, id_col, text_col).select(id_col, held_out.alias("held_out"), "score", "predicted")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
