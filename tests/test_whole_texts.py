"""The text service gets whole texts."""

import tracemalloc

import pyarrow as pa

from saltmarsh.operators.transform import _answers
from saltmarsh.plans.texts import udf_text_transform_whole


def test_whole_texts_reach_the_service(spark):
    rows = [(1, "long text " * 5000), (2, ""), (3, None), (4, "x" * 21)]
    out = {r["doc_id"]: r["out"] for r in udf_text_transform_whole(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: f"[{t}]" if t else "" for i, t in rows}


def test_only_a_slice_of_a_batch_is_in_python_at_a_time():
    texts = [None, "", "a" * 3_000_000] + [f"{k} " * 2000 for k in range(4000)] * 2
    tracemalloc.start()
    found, given = [], pa.array(texts)
    tracemalloc.reset_peak()
    for part in _answers(given, "[{}]".format):
        found.append(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16_000_000 < given.nbytes
    assert pa.concat_arrays(found).to_pylist() == [f"[{t}]" if t else "" for t in texts]
