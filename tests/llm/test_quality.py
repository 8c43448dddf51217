import random
import re

from tremorlake.llm.quality import op4_quality_rules, quality_rules, text_counts

from fixtures import SF_DIR, awkward, awkward_rows, documents, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    places = {}
    for k, gram in enumerate(grams):
        places.setdefault(gram, []).append(k)
    inside = {k + j for ks in places.values() if len(ks) > 1 for k in ks for j in range(8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(x in lines[:n] for n, x in enumerate(lines)), "n_repeat_words": len(inside)}


def test_documents_equal_brute_force(spark):
    want = {i: brute(t) for i, t in texts(spark).items()}
    for r in op4_quality_rules(spark, SF_DIR).collect():
        base = want[r.doc_id]
        failed = base["n_words"] < 20 or 100 * base["n_repeat_words"] > 30 * base["n_words"]
        assert {k: r[k] for k in base} == base and r.base_failed == failed and r.kept <= (not failed)


def test_counts_of_awkward_texts():
    for _, text in awkward_rows():
        if text is None or len(text) < 50_000:
            got = text_counts(text)
            assert {k: got[k] for k in brute(text)} == brute(text)
    assert text_counts("a b c d e f g h " * 3)["n_repeat_words"] == 24
    assert text_counts(" ".join("abcdefgh"))["n_repeat_words"] == 0


def test_lines_over_the_limit_deplete(spark):
    """160 documents share a footer; one holds little else. Copies of one text are no evidence."""
    footer = "this footer stands in very many documents of the host and says nothing that anyone needs 20{}"
    letter = "abcdefghijklmnopqrstuvwxyzäöüßéèçàùêñíóúáïîôûæœ".replace("", " ").split()
    own = [" ".join(f"own{letter[n % 40]}x{letter[n // 40]}{letter[k]}" for k in range(40)) for n in range(160)]
    legal = "all of these rights are kept by whoever wrote the pages and may not be given away"
    rows = [(n, f"{own[n]}\n{footer.format(n % 10)}\n  {legal.upper()}", "h") for n in range(160)]
    rows.append((999, "\n".join([footer.format(1), legal + " ", "only five words of own"]), "h"))
    rows += [(500 + n, " ".join(f"copy{k}" for k in range(60)), "h") for n in range(40)]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[n].kept and got[n].n_words_left == 40 for n in range(160))
    assert not got[999].base_failed and got[999].n_words_left == 5 and not got[999].kept
    assert all(got[500 + n].kept for n in range(40))
    elsewhere = [(i, t, f"host{i}") for i, t, _ in rows]
    assert {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(elsewhere, "doc_id long, text string, source string")).collect()}[999]


def brute_kept(rows, floor=20, share=0.05):
    """kept per id from distinct documents (words, A-Z lower-cased) per host and line, all in plain Python."""
    def key(line):
        return " ".join(WORD.findall(re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), line))))

    holders, hosts = {}, {}
    for _, text, host in rows:
        document = tuple(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        hosts.setdefault(host, set()).add(document)
        for line in {key(x) for x in text.split("\n")} - {""}:
            holders.setdefault((host, line), set()).add(document)
    kept = {}
    for i, text, host in rows:
        base, left = brute(text), 0
        for line in text.split("\n"):
            held = len(holders.get((host, key(line)), ()))
            left += 0 if held > floor and held > share * len(hosts[host]) else len(WORD.findall(line))
        failed = base["n_words"] < 20 or 100 * base["n_repeat_words"] > 30 * base["n_words"]
        kept[i] = not failed and left >= 10 and 100 * left >= 30 * base["n_words"]
    return kept


def test_mostly_boilerplate_equals_brute_force(spark):
    """Most documents are a long shared line and eight words or numbers of their own; they count each and go."""
    rng = random.Random(4)
    shared = " ".join(f"shared{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    rows = [(n, f"{shared}\n" + " ".join(f"own{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(8)), "words") for n in range(100)]
    rows += [(1000 + n, f"{shared}\n" + " ".join(str(rng.randrange(1000, 10_000)) for _ in range(8)), "numbers") for n in range(100)]
    rows += [(2000 + n, " ".join(f"full{chr(97 + rng.randrange(26))}{rng.randrange(99)}" for _ in range(50)), "words") for n in range(60)]
    rows += [(3000 + n, f"{shared}\nthe very same words", "copies") for n in range(100)]
    rows += [(4000 + n, f"{shared}\nonly few hold this line {n}", "few") for n in range(20)]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got == brute_kept(rows)
    assert not any(got[n] for n in [*range(100), *range(1000, 1100)])
    assert all(got[n] for n in [*range(2000, 2060), *range(3000, 3100), *range(4000, 4020)])


def test_awkward_rows(spark):
    got = quality_rules(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert sum(r.doc_id == 6 for r in got) == 2 and sum(r.doc_id is None for r in got) == 1
    assert quality_rules(documents(spark).limit(0)).count() == 0
