import re
import sys

import corpus_pipeline
import pytest

from telemetra.llm import queries


@pytest.fixture(scope="module")
def sf_dir(tmp_path_factory, spark):
    path = tmp_path_factory.mktemp("sf")
    clean = [" ".join(f"word{(k * 7 + i * 13) % 997}x{i} of the" for k in range(30)) for i in range(60)]
    toxic = [t + " you idiot moron" for t in clean[:20]]
    rows = [(i, t) for i, t in enumerate(clean)] + [(100 + i, t + " extra") for i, t in enumerate(toxic)]
    rows += [(200 + i, clean[i] + " tail") for i in range(5)] + [(300, "short"), (301, None), (302, "### " * 80)]
    rows += [(400, clean[59] + " " + " ".join(f"new{k} in a" for k in range(80)) + " password=abcdef123456")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100 + i, 1, 1) for i in range(20)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_act_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids, columns = [], docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, sf_dir)
        assert docs.columns == columns, name
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    clean, near = set(range(60)), set(range(200, 205))
    assert ids[0] == clean | near | set(range(100, 120)) | {400}
    assert ids[1] == clean | near | {400}
    assert ids[2] == ids[3] == clean | {400}
    assert docs.filter("doc_id = 400").first().text.endswith("a [SECRET]")


def test_run_packs_what_was_kept(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(range(60)) | {400}
    assert len({r.sequence_id for r in rows}) == -(-sum(r.length for r in rows) // 4096)


def test_every_operator_is_registered():
    names = set(queries.QUERIES)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n != "pipeline"} == set(range(1, 14))
    assert "pipeline" in names and set(queries.ORACLE) <= names
    assert "corpus_pipeline" in sys.modules
