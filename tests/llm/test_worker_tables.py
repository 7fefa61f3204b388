"""What operators keep in a Python worker, which later stages use again."""
import pyarrow as pa
import public_tokenizers
from revlake.llm import hyperlang, setsketch, textblock, triebpe


def test_tables_of_another_operator_go_when_a_task_begins():
    docs = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two three four five six", "Ärger über Öl"]})
    path = public_tokenizers.path("word_bpe_49k.json")
    both = list(triebpe._decoded(triebpe._encoded(iter([docs]), path, ["doc_id"]), path, ["doc_id", "ids"]))
    assert both[0].column("decoded").to_pylist()[0] and triebpe._loaded
    textblock.keeping("hyperlang", hyperlang.forget)
    hyperlang.bundles(*hyperlang.runs(docs)[:3], 2)
    assert not triebpe._loaded and len(hyperlang._vectors) and hyperlang._symbols is not None
    assert len(list(setsketch._sets(5)(iter([docs])))) == 1
    assert not len(hyperlang._vectors) and not hyperlang._ids and hyperlang._symbols is None
    assert all(len(p) == 1 for p in textblock._powers)


def test_round_trip_takes_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    trip = triebpe.round_trip(docs, path, ["doc_id"])
    assert trip._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = triebpe.decode(triebpe.encode(docs, path, ["doc_id"]), path, ["doc_id", "ids"])
    assert trip.columns == ["doc_id", "ids", "decoded"] and sorted(map(tuple, trip.collect())) == sorted(map(tuple, apart.collect()))
