import public_tokenizers
import pyarrow as pa
import pytest

from tabml.llm import encoding, packing
from tabml.llm import text as tx
from tabml.llm.frames import empty_table, in_batches, sample_of
from tabml.llm.secrets import LEDGER_SCHEMA, read_ledger

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture
def left():
    """What a packing task leaves in its worker."""
    encoding.encoder(WORD, True)
    yield tx.kept
    tx.kept.clear()


def test_freed_memory_goes_back_batch_by_batch(monkeypatch):
    seen = []
    monkeypatch.setattr(tx, "release", lambda: seen.append("release"))

    def work(batches):
        for batch in batches:
            seen.append(batch)
            yield batch

    assert list(tx.released(work, iter([1, 2, 3]), True)) == [1, 2, 3]
    assert seen == [1, "release", 2, "release", 3, "release", "release"]
    seen.clear()
    assert list(tx.released(work, iter([]), True)) == [] and seen == ["release"]


@pytest.mark.parametrize("keeps", [True, False])
def test_tasks_of_another_kind_drop_the_encoder(left, keeps):
    during = []
    list(tx.released(lambda batches: (during.append(len(left)) or b for b in batches), iter([1]), keeps))
    assert during == [len(left)] == [int(keeps)]
    assert encoding.encoder(WORD, True).encode_all(["a word"]) == encoding.Encoder(WORD, True).encode_all(["a word"])


def test_no_worker_holds_an_encoder_in_other_tasks(spark):
    docs = spark.range(64).selectExpr("id AS doc_id", "concat('word ', id) AS text").repartition(16)
    assert packing.packed(docs, WORD, end_id=2, drops_space=True).count() > 0

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(tx.kept)] * batch.num_rows)], names=["held"])

    assert {r["held"] for r in in_batches(docs, held, "held long").collect()} == {0}


def started_by_python(df):
    """Whether the rows, or some of them, come from a list of Python rows by way of Python workers."""
    return "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_small_tables_start_no_python_workers(spark, tmp_path):
    keys = spark.range(400).selectExpr("id AS key", "IF(id % 4 = 0, 1, IF(id % 7 = 0, NULL, 0)) AS label")
    sample = sample_of(keys, "label", 50)
    assert started_by_python(spark.createDataFrame([(1,)], "n long")) and not started_by_python(sample)
    rows = sample.collect()
    assert sorted(sample.columns) == ["key", "label", "weight"] and sample.schema["label"].dataType == keys.schema["label"].dataType
    assert {(r["label"], r["weight"]) for r in rows} == {(1, 2.0), (0, 257 / 50)} and 50 < len(rows) < 150

    empty = empty_table(spark, LEDGER_SCHEMA)
    assert not started_by_python(empty) and empty.collect() == []
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], LEDGER_SCHEMA).schema]
    assert not started_by_python(read_ledger(spark, str(tmp_path / "none")))
