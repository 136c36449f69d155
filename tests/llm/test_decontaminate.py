import random

from brute import shingles

from tripmart.llm import decontaminate


def found(docs, items):
    return sorted((r.doc_id, r.item_id, r.n_item, r.n_found) for r in decontaminate.find(docs, items).collect())


def expected(docs, items):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            s = shingles(item)
            if s and 100 * len(s & own) >= 75 * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(set(out))


def texts():
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(i, words(rng.choice((3, 5, 9, 14, 30, 60, 200)))) for i in range(60)]
    docs = []
    for d in range(150):
        text = words(rng.choice((0, 4, 50, 400, 6000)))
        for _ in range(rng.randrange(3)):
            item = list(rng.choice(items)[1])
            if rng.random() < 0.5:
                item[rng.randrange(len(item))] = "other"
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        docs.append((d, " ".join(text)))
    docs.append((150, " ".join(items[0][1])))
    return docs, [(i, " ".join(w)) for i, w in items] + [(60, " ".join(items[5][1]).upper())]


def test_same_as_brute_force(spark, monkeypatch):
    docs, items = texts()
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = found(*frames)
    assert whole == expected(docs, items) and len(whole) > 60
    monkeypatch.setattr(decontaminate, "BLOCK", 100)
    assert found(*frames) == whole
    hit = {d for d, *_ in whole}
    assert sorted(r.doc_id for r in decontaminate.remove(frames[0], frames[1]).collect()) == [d for d, _ in docs if d not in hit]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "a b c d e f", 3), (3, "a b", 4), (3, "a b", 4)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(None, "a b c d e f"), (7, None), (8, " "), (9, "A b")], "item_id long, text string")
    rows = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()}
    assert rows == {(None, None), (3, 9)}
    assert [r.doc_id for r in decontaminate.remove(docs, items).orderBy("doc_id").collect()] == [1, 2]
    assert decontaminate.find(docs, items.limit(0)).count() == 0
    assert decontaminate.find(docs.limit(0), items).count() == 0
    assert decontaminate.remove(docs, items.limit(0)).count() == 5
