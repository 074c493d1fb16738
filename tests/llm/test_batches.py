"""Arrow batches handed to the operators are bounded."""

import pyarrow as pa

from pullscope.llm import text as T


def test_batches_are_small_however_many_rows_a_task_has(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
    got = [r["n"] for r in T.mapped(spark.range(0, 30_000, 1, 1), sizes, "n long").collect()]
    assert sum(got) == 30_000 and max(got) <= 2000
