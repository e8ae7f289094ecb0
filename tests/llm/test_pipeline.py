"""The stages on the smallest tables: each keeps what it should of its own input."""

from conftest import SMALL

import corpus_pipeline as p
from zonalis.llm import fuzzy_lines, neighbour_quality, signature_tree
from zonalis.session import materialise


def test_stages(spark):
    assert [n for n, _ in p.STAGES][0] == "quality classifier" and len(p.STAGES) == 5
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in p.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SMALL), "stage")
        kept[name] = (before, docs)
        if name != p.STAGES[-1][0]:
            assert docs.columns == p.COLUMNS
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}

    before, after = kept["quality classifier"]
    model = neighbour_quality.train(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r["doc_id"] for r in neighbour_quality.score_quality(before, model).collect() if r["score"] >= p.QUALITY_LEAST}
    assert ids(after) == good and 0 < len(good) < before.count()

    before, after = kept["line dedup"]
    texts = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(before, short=True).collect()}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == {i: t for i, t in texts.items() if t.split()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = kept["n-gram Jaccard join"]
    groups = signature_tree.jaccard_components(before).collect()
    assert ids(after) == {r["component_id"] for r in groups}

    before, after = kept["mixing sources to target weights"]
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))
    assert [str(r) for r in before.collect()] != [str(r) for r in after.collect()]

    before, after = kept["SentencePiece encoding"]
    assert ids(before) == ids(after) and after.filter("n_tokens = 0 or mix_row is null").count() == 0
