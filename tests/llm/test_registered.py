"""The registered queries on the smallest tables."""

import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from millrace.llm.common import BATCH_BYTES
from millrace.llm.queries import REGISTRY, SQL
from test_dedup import brute_components, plain_fingerprint
from workload.check import _rows, connect

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_surrogates": ["doc_id"],
    "op4_quality_classifier": ["doc_id"],
    "op5_pitman_yor": [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
    ],
    "op6_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7_decontamination": ["doc_id"],
    "op8_bpe_codec": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op9_simhash": ["doc_id", "fingerprint", "component_id"],
    "op10_licences": ["doc_id"],
    "op11_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
    "op12_quality_rules": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    ],
}


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_all_are_registered():
    assert set(REGISTRY) == {*COLUMNS, "op13_collocations"}
    assert {*COLUMNS, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_every_row_comes_back(spark, database, name):
    found = REGISTRY[name](spark, FOLDER)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]
    source = "pages" if name == "op6_warc" else "documents"
    ids = database.execute(f"SELECT {COLUMNS[name][0]} FROM {source} ORDER BY 1").fetchall()
    assert sorted(r[0] for r in found.collect()) == [r[0] for r in ids]


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, database, name):
    found = REGISTRY[name](spark, FOLDER)
    wanted = database.execute(SQL[name])
    names = [d[0] for d in wanted.description]
    assert _rows(found.columns, found.collect()) == _rows(names, wanted.fetchall())


def test_components_of_the_table(spark, database):
    texts = database.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()
    wanted = [texts[i][0] for i in brute_components([plain_fingerprint(t) for _, t in texts])]
    found = dict(REGISTRY["op9_simhash"](spark, FOLDER).select("doc_id", "component_id").collect())
    assert [found[i] for i, _ in texts] == wanted


def test_pipeline_stages(spark):
    """Each stage returns some of its predecessor's rows with the columns of documents."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, before, FOLDER)
        ids = {r["doc_id"] for r in made.select("doc_id").collect()}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "bpe":
            assert made.columns == ["doc_id", "ids", "n_tokens", "decoded"]
            texts = {r["doc_id"]: r["text"] or "" for r in before.select("doc_id", "text").collect()}
            assert all(r["decoded"] == texts[r["doc_id"]] for r in made.select("doc_id", "decoded").collect())
        else:
            assert made.columns == columns
            before = corpus_pipeline.materialize(made, f"test-{name}")


def test_stages_hand_small_batches_to_workers(spark):
    """Workers get about BATCH_BYTES of text at a time, however many rows that is."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    session = spark.newSession()
    texts = session.range(0, 400, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), 10000) AS text")
    held = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    for _, stage in corpus_pipeline.STAGES:
        session.conf.unset(name)
        stage(session, session.read.parquet(f"{FOLDER}/documents.parquet").limit(20), FOLDER)
        sizes = [r["n"] for r in texts.mapInArrow(held, "n long").collect()]
        assert len(sizes) > 1 and max(sizes) < 1.1 * BATCH_BYTES
    session.conf.set(name, "1m")
    corpus_pipeline.accepted(session, texts, FOLDER)
    assert session.conf.get(name) == "1m"
