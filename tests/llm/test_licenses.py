import re

from tripmart.llm import licenses

WORDS = re.compile(r"[^\W_]+")


def grams(text):
    words = WORDS.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return set(zip(words, words[1:]))


def expected(rows):
    known = [(i, name, grams(t)) for i, (name, t) in enumerate(licenses.TEMPLATES)]
    out = []
    for d, text in rows:
        units = [(i + 1, u) for i, u in enumerate((text or "").split("\n"))]
        units += [(0, text)] if "\n" in (text or "") else []
        for line, unit in units:
            own = grams(unit)
            best = max(((2 * len(g & own) / (len(g) + len(own)), -i, name) for i, name, g in known))
            if best[0] >= licenses.LEAST:
                out.append((d, line, best[2], -best[1], round(best[0], 12)))
    return sorted(out, key=str)


def scanned(df):
    return sorted(((r.doc_id, r.line, r.license, r.template, round(r.dice, 12)) for r in licenses.scan(df).collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = scanned(docs)
    assert len(got) > 10 and got == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_variants_and_edges(spark):
    rows = [(i, t.upper().replace(" ", "\t ")) for i, (_, t) in enumerate(licenses.TEMPLATES)]
    rows += [(50, f"text\n{t}!!\nmore words here") for _, t in licenses.TEMPLATES[:3]]
    rows += [(60, "Released under the\nMIT License"), (61, None), (62, ""), (63, "licensed"), (64, "the " * 50_000), (None, "Licensed under CC BY 4.0"), (50, "a\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line", "2 AS n")
    got = scanned(df)
    assert got == expected(rows)
    assert {(60, 0, "MIT"), (None, 1, "CC-BY-4.0")} <= {r[:3] for r in got}
    assert scanned(df.limit(0)) == []


def test_size_bounds_are_sound():
    for n in range(1, 60):
        low, high = licenses.bounds(n)
        assert all((2 * min(n, m) / (n + m) >= licenses.LEAST - 1e-12) == (low <= m <= high) for m in range(1, 120))


def test_every_match_holds_a_signal_word():
    for _, text in licenses.TEMPLATES:
        own = licenses._bigrams_of(text)
        words = licenses.signal_words(own)
        held = sum(any(word in words for word in gram.split(" ")) for gram in own)
        assert len(own) - held < licenses.LEAST / (2 - licenses.LEAST) * len(own)


def wrapped(text, width):
    import textwrap

    return "\n".join(f" * {line}" for line in textwrap.wrap(text, width))


def test_wrapped_notices_and_notices_inside_lines(spark):
    prose = " ".join(f"word{i} of the story{i % 7}" for i in range(400))
    longer = [(name, text) for name, text in licenses.NOTICES if name != "MPL-2.0"]
    texts = [f"{prose}\n{prose}\n{wrapped(text, 72)}\n{prose}" for _, text in longer]
    texts.append("Copyright 2024 the authors of this page. Released under the MIT License. More follows here.")
    changed = licenses.NOTICES[3][1].replace("copyright holder", "owner").replace("3. Neither", "3. Further, neither")
    texts += [f"{prose}\n{wrapped(changed, 60)}", f"{wrapped(longer[0][1], 60)}\n{prose}\n{wrapped(longer[0][1], 80)}", prose]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.scan(df).collect():
        if r.template >= len(licenses.TEMPLATES):
            got.setdefault(r.doc_id, []).append((r.line, r.license, round(r.dice, 6)))
        elif r.doc_id == len(longer):
            assert (r.line, r.license, r.dice) == (1, "MIT", 1.0)
            got[r.doc_id] = None
    for i, (name, _) in enumerate(longer):
        assert got[i] == [(3, name, 1.0)]
    n = len(longer)
    assert got[n] is None and [x[:2] for x in got[n + 1]] == [(2, "BSD-3-Clause")]
    assert [x[1:] for x in got[n + 2]] == [("MIT", 1.0)] * 2 and n + 3 not in got


def test_every_match_holds_a_word_of_each_group():
    for _, text in licenses.TEMPLATES + licenses.NOTICES:
        own = licenses._bigrams_of(text)
        for words in licenses.signal_groups(own):
            held = sum(any(word in words for word in gram.split(" ")) for gram in own)
            assert len(own) - held < licenses.LEAST / (2 - licenses.LEAST) * len(own)
