import random

from tremorlake.llm.common import Scratch, components
from tremorlake.llm import minhash
from tremorlake.llm.minhash import COORDS, MATCH, near_duplicates, odd_sketch, op2_minhash, signature, _coefficients
from tremorlake.llm.common import shingles

from fixtures import SF_DIR, awkward, awkward_rows, documents, texts


def brute(rows):
    """Component of every id and size of every set, by comparing all pairs of full word sets."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                one, two = sorted((find(i), find(j)))
                parent[two] = one
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_documents_equal_brute_force(spark):
    component, size = brute(texts(spark).items())
    got = op2_minhash(spark, SF_DIR).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles, r.kept) for r in got} == {
        i: (component[i], size[i], component[i] == i) for i in component}


def test_copies_drifting_from_one_text(spark):
    """A large group of copies, each with a few changed words; and a chain whose ends are far apart."""
    rng = random.Random(5)
    base = [f"b{k}" for k in range(150)]
    rows = [(100, " ".join(base))]
    for n in range(120):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        rows.append((101 + n, " ".join(words)))
    chain = [f"d{k}" for k in range(200)]
    for n in range(8):
        rows.append((500 - n, " ".join(chain)))
        for k in range(3):
            chain[20 * n + 3 * k] = f"e{n}{k}"
    component, _ = brute(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == component


def from_template(count, own, rng, shared=300):
    """Documents of one template with words of their own in one place."""
    words = [f"t{k}" for k in range(shared)]
    return [" ".join(words + [f"o{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(count)]


def test_documents_of_a_template_leave_their_postings(spark, monkeypatch):
    """3,000 documents just below the threshold share nearly all tokens; hardly any is left to meet others."""
    rng = random.Random(6)
    rows = list(enumerate(from_template(3000, 30, rng))) + [(5000, " ".join(f"z{k}" for k in range(100)))]
    seen = []

    def counted(*args):
        postings = open_postings(*args)
        seen.append((args[0].count(), args[0].selectExpr("sum(size(prefix))").first()[0], postings.agg({"posted": "sum"}).first()[0] or 0))
        return postings

    open_postings = minhash.open_postings
    monkeypatch.setattr(minhash, "open_postings", counted)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id and r.kept for r in got)
    (documents_, tokens, met), = seen
    assert documents_ > 2900 and met < 20 * tokens


def test_long_postings_meet_in_blocks(spark, monkeypatch):
    """Templates around the threshold with words that several share; every block pair is met, in whatever sizes."""
    monkeypatch.setattr(minhash.cross_pairs, "__defaults__", (3,))
    rng, rows = random.Random(3), []
    for n, text in enumerate(from_template(90, 0, rng, 200)):
        words = text.split()
        for _ in range(rng.choice([2, 3, 4, 5])):
            at = rng.randrange(200)
            words[at] = f"v{at}-{rng.randrange(3)}"
        rows.append((n, " ".join(words + [f"o{rng.randrange(40)}" for _ in range(rng.choice([0, 1, 5, 20, 30]))])))
    rows += [(n, None) for n in (200, 201)] + [(7, "one more text of the same id"), (8, rows[8][1])]
    component, _ = brute([r for r in rows if r[1] != "one more text of the same id"])
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == component and len(set(component.values())) > 10


def test_awkward_rows(spark):
    got = near_duplicates(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert sorted(got[0].asDict()) == ["component_id", "doc_id", "kept", "n_shingles"]
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3)] == [0, 0, 0] and all(by[i].component_id == i and by[i].kept for i in (1, 2, 3))
    assert by[5].component_id == 4 and not by[5].kept
    assert by[None].component_id is None and by[None].kept
    assert by[7].component_id == 6 and by[9].component_id == 8
    assert sum(r.doc_id == 6 and r.kept for r in got) == 2


def test_empty_table(spark):
    assert near_duplicates(documents(spark).limit(0)).count() == 0


def test_collisions_and_sketch_bound_the_similarity():
    a, b = _coefficients(COORDS)
    rng = random.Random(2)
    low = 0
    for _ in range(300):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        other = list(base)
        for _ in range(rng.randint(0, 3)):
            other[rng.randrange(200)] = "new"
        x, y = shingles(" ".join(base)), shingles(" ".join(other))
        apart = sum(bin((int(p) ^ int(q)) & (2**64 - 1)).count("1") for p, q in zip(odd_sketch(x), odd_sketch(y)))
        assert apart <= len(set(x.tolist()) ^ set(y.tolist()))
        both = len(set(x.tolist()) & set(y.tolist()))
        if 100 * both >= 85 * (len(x) + len(y) - both):
            low += (signature(x, a, b) == signature(y, a, b)).sum() < MATCH
    assert low == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 90), (90, 100), (7, 7)], "a long, b long")
    got = {r.id: r.component_id for r in components(Scratch(spark, "t"), edges).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 90: 90, 100: 90}
