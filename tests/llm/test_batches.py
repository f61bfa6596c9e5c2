"""How much of the rows a Python worker holds at once."""

import pyarrow as pa

from seismic_lake.llm.common import BLOCK_BYTES, text_blocks


def test_long_texts_go_to_python_in_batches_of_bounded_bytes(spark, docs_of):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "n"])

    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat(cast(id % 10 AS string), 10000) AS text")
    rows = docs.mapInArrow(sizes, "bytes long, n long").collect()
    assert sum(r["n"] for r in rows) == 2000 and max(r["bytes"] for r in rows) < 6 << 20


def test_blocks_of_texts_are_small_and_whole():
    texts = pa.array(["x" * 300_000, None, "", "y" * 3_000_000] + ["z" * 1000] * 4000)
    blocks = list(text_blocks(texts))
    assert [(a, b) for a, b, _, _ in blocks] == list(zip([0, *(b for _, b, _, _ in blocks)], [b for _, b, _, _ in blocks], strict=False))
    assert blocks[-1][1] == len(texts) and BLOCK_BYTES <= 1 << 20
    assert all(len(data) <= BLOCK_BYTES or b - a == 1 for a, b, data, _ in blocks)
