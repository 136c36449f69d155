import hashlib
import random

from tripmart.llm import fim


def plain(doc_id, text):
    """One row by slices."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, output string")
    cut = fim.transform(docs)
    got = cut.withColumn("restored", fim.restore(cut["output"], cut["form"])).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((plain(i, t) for i, t in rows), key=str)
    assert sorted((str(r.doc_id), r.restored) for r in got) == sorted((str(i), t or "") for i, t in rows)
    return got


def test_random_texts(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice("ab<>PSM é🙂\ń") for _ in range(rng.randrange(40)))) for i in range(600)]
    got = check(spark, rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "abc"), (3, "same"), (3, "same"), (3, "other"), (4, "<P>"), (-5, "<P"), (6, "\x00\r\n")]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fim.digests(fim.transform(empty)).count() == 0


def test_long_texts_in_blocks(spark, monkeypatch):
    text = "".join(chr(97 + i % 26) for i in range(50_000)) + "🙂é" * 10_000
    rows = [(i, text) for i in range(8)]
    want = check(spark, rows)
    monkeypatch.setattr(fim, "BLOCK", 777)
    assert sorted(check(spark, rows)) == sorted(want)


def test_other_units(spark):
    docs = spark.createDataFrame([(i, "one two  three\nfour") for i in range(30)] + [(99, "!")], "doc_id long, text string")
    got = fim.transform(docs, r"\w+\s*").collect()
    for row in got:
        if row.doc_id == 99:
            assert (row.n, row.form, row.output) == (None, "plain", "!")
        else:
            assert row.n == 4
            if row.form != "plain":
                assert {row.prefix_chars, row.prefix_chars + row.middle_chars} <= {0, 4, 9, 15, 19}
