import corpus_pipeline
from brute import base_spans, components, shingles

from tripmart.llm.secrets import REDACTED

SF = "/root/testdata/sf0.01"


def test_stages_on_whole_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(number)))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
        seen.append({r.doc_id: r for r in docs.collect()})
    good, distinct, clean, redacted, mixed = seen
    assert sum(labels.get(i) == 1 for i in good) >= 0.97 * sum(q == 1 for q in labels.values())
    assert sum(labels.get(i) == 0 for i in good) <= 0.15 * sum(q == 0 for q in labels.values())
    groups = components([(i, r.text) for i, r in good.items()])
    assert set(distinct) == {low for _, low in groups.values()}
    hit = {i for i, r in distinct.items() if any(100 * len(s & shingles(r.text)) >= 75 * len(s) for s in items)}
    assert hit and set(clean) == set(distinct) - hit
    assert set(redacted) == set(clean) == set(mixed)
    assert not any(base_spans(r.text) for r in redacted.values())
    assert all(r.n_chars == len(r.text) for r in redacted.values())
    assert any(REDACTED in r.text for r in redacted.values())
    assert all(r.taken <= 3 * r.size for r in mixed.values())


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"] and got.count() > 0


def test_one_row_of_each_group_stays_where_ids_repeat(spark):
    w, v, u = (" ".join(f"{c}{i}" for i in range(40)) for c in "wvu")
    rows = [(1, w, 0), (1, w, 1), (2, v, 2), (3, w, 3), (3, v, 4), (3, u, 5), (None, u, 6), (None, "", 7), (None, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int")
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert found == sorted([(1, w), (2, v), (3, u), (None, ""), (None, None)], key=str)
