import hashlib
import random
import re

from pyspark.sql import functions as F

from tremorlake.llm.secrets import op8_secret_scans, redact, scan

from fixtures import SF_DIR, awkward, awkward_rows, documents, texts

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def by_source(df):
    return scan(df, F.concat_ws("/", "source", "lang"), F.col("source"))


def marks(row):
    return ",".join(f"{m.kind}:{m.start}:{m.end}" for m in row.marks if m.kind != "key")


def test_documents_equal_brute_force(spark):
    want = texts(spark)
    for r in op8_secret_scans(spark, SF_DIR).collect():
        assert r.base_sha256 == hashlib.sha256(base(want[r.doc_id]).encode()).hexdigest()


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(4)
    parts = ["password", "passwd", "token", "Api_Key", "APIKEY", "secret", "=", ":", " ", "'", '"', "abcdef", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef",
             "é", "\U0001F600", "\n", "token=token: abcdefgh", "x"]
    rows = [(n, "".join(rng.choices(parts, k=rng.randint(0, 30))), "s", "en") for n in range(400)]
    got = by_source(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    assert {r.doc_id: marks(r) for r in got} == {n: base(t) for n, t, _, _ in rows}


def test_ownership_tells_examples_from_live(spark):
    key = "aB3dE5gH7jK9mN1pQ3sT"
    rows = [(n, f"password=hunter2{'' if n < 4 else n}", f"owner{n}", "en") for n in range(6)] + [(9, f"use {key} here", "owner1", "en")]
    rows += [(20 + n, f"see {key[::-1]}", f"owner{n}", "en") for n in range(3)]
    got = {r.doc_id: r for r in by_source(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert [got[n].n_example for n in range(6)] == [1, 1, 1, 1, 0, 0] and [got[n].n_live for n in range(6)] == [0, 0, 0, 0, 1, 1]
    assert [(m.kind, m.start, m.end) for m in got[9].marks] == [("key", 4, 24)]
    assert all(not got[20 + n].marks for n in range(3))


def test_many_repositories_of_one_owner_are_a_copy(spark):
    rows = [(n, "password=hunter22", "one", f"l{n % 4}") for n in range(8)] + [(20 + n, "password=hunter33", "one", f"l{n % 3}") for n in range(9)]
    rows += [(40, "token: abcdefgh", "one", "l0"), (41, "token: abcdefgh", "two", "l1"), (42, "token: abcdefgh", "two", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: (r.n_live, r.n_example) for r in by_source(df).collect()}
    assert all(got[n] == (0, 1) for n in range(8)) and all(got[n] == (1, 0) for n in [*range(20, 29), 40, 41, 42])
    found = scan(df, F.concat_ws("/", "source", "lang"), F.col("source"), example_repos=3).collect()
    assert {r.doc_id: r.n_example for r in found} == {i: 1 for i, *_ in rows}


def test_redaction(spark):
    rows = [(1, "a password=hunter22 b " + "0f" * 12 + " c", "o", "en"), (2, "nothing", "o", "en"), (None, "token: abcdef123", "o", None), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("start", F.lit(1))
    for name in ("__hash", "__marks", "__id", "hash", "marks", "doc", "id", "text_hash", "marked"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = {r.doc_id: r for r in redact(docs, F.col("source"), F.col("source")).collect()}
    assert got[1].text == "a [secret] b [secret] c" and got[2].text == "nothing" and got[None].text == "[secret]" and got[3].text is None
    assert redact(docs, F.col("source"), F.col("source")).columns == docs.columns


def test_awkward_rows(spark):
    got = by_source(awkward(spark)).collect()
    assert len(got) == len(awkward_rows())
    want = {i: base(t) for i, t in awkward_rows()}
    assert all(marks(r) == want[r.doc_id] for r in got) and want[15]
    assert by_source(documents(spark).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op8_secret_scans(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
