import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martloom.llm import packing, quality, toxicity
from martloom.llm.rows import tokenizer_path
from tests.llm.test_divergence import LAYOUT as THREE
from tests.llm.test_simhash import plain_print, roots_of

LAYOUT = THREE + ", source STRING, n_chars LONG"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(2)
    words = "the of and to in is that it on was be river stone house garden light water winter letter morning road story".split()
    rows = []
    for i in range(160):
        text = " ".join(rng.choices(words, k=rng.randrange(40, 90)))
        if i % 10 == 0:
            text += " vilefool vilebrat vilecrook"
        rows.append((i, text, "en"))
    rows += [(200 + i, rows[i][1], "en") for i in range(1, 12)]
    rows += [(300 + i, rows[i][1].replace(" ", "  "), "en") for i in range(1, 5)]
    rows += [(400 + i, rows[i][1] + " coda", "en") for i in range(21, 30)]
    rows += [(500, "%% ## ** " * 40 + " ".join(f"x{i}%" for i in range(80)), "en"), (501, None, None), (502, "", "en"), (None, "short", None)]
    path = tmp_path_factory.mktemp("sf")
    wide = [(*r, "src", len(r[1] or "")) for r in rows]
    spark.createDataFrame(wide, LAYOUT).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(i % 10 == 0)) for i in range(160)]
    spark.createDataFrame(marks, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages_and_run(spark, folder, monkeypatch):
    """Each stage against a plain version of it, on what the stage before has left."""
    path, rows = folder
    loose = toxicity.Settings(least_errors=3.0)
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: train(docs, labels, loose))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = tuple([name, docs, stage(spark, docs, path)])
        rows_before, rows_after = out[1].collect(), out[2].collect()
        left[name] = (rows_before, rows_after)
        if name != "packing":
            assert out[2].columns == docs.columns
            docs = spark.createDataFrame(rows_after, docs.schema)

    before, after = left["toxicity"]
    assert not any("vile" in (r.text or "") for r in after)
    assert sum("vile" not in (r.text or "") for r in before) == len(after)

    before, after = left["quality"]
    judged = {str(r): r for r in quality.assessed(spark.createDataFrame(before, docs.schema)).collect()}
    assert sorted(map(str, (r.doc_id for r in after))) == sorted(str(r.doc_id) for r in judged.values() if r.kept)
    assert not {500, 501, 502} & {r.doc_id for r in after} and len(after) > 100

    before, after = left["exact_dedup"]
    first = {}
    for r in before:
        body = " ".join(r.text.split())
        first[body] = min(first.get(body, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())

    before, after = left["near_dedup"]
    prints = {r.doc_id: plain_print(r.text) for r in before}
    edges = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = roots_of(prints, edges)
    assert sorted(r.doc_id for r in after) == sorted({roots[i] for i in prints}) and edges

    before, after = left["packing"]
    library = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
    assert {r.doc_id: r.length for r in after} == sizes
    assert len({r.sequence_id for r in after}) == -(-sum(sizes.values()) // packing.CAPACITY)

    whole = corpus_pipeline.run(spark, path).select("doc_id", "piece", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in after)
