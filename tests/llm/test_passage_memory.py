"""Memory of the passage search, and the size of what its tasks send at once."""

import random
import tracemalloc

import pyarrow as pa

from loomhouse.llm.substring_dedup import MOST_BYTES, _cutter, _packer, _sorter


def test_bucket_takes_little_memory_for_each_window():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(5000)]
    texts = [" ".join(draw.choices(vocabulary, k=300)) for _ in range(1000)]
    batch = pa.RecordBatch.from_pydict({
        "doc": pa.array(range(1000)), "text_id": pa.array(range(1000)), "text": texts})
    blocks = pa.Table.from_batches(_packer(13, 4, [], 1)([batch])).combine_chunks().to_batches()
    list(_sorter(13, 4, MOST_BYTES)(iter(blocks)))  # powers of the hashes are made once
    tracemalloc.start()
    list(_sorter(13, 4, MOST_BYTES)(iter(blocks)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 90 * 1000 * (300 - 12), most


def test_rows_go_back_to_spark_in_slices():
    texts = [f"{i} " + "word " * 60_000 for i in range(8)] + [None, ""]
    row = pa.StructArray.from_arrays([pa.array(range(10)), pa.array(texts)], ["doc_id", "text"])
    spans = pa.array([[{"first": 0, "last": 1}]] + 9 * [None])
    whole = pa.RecordBatch.from_arrays([row, spans], ["row", "spans"])
    made = list(_cutter(iter([whole, whole.slice(0, 0)])))
    assert max(b.num_rows for b in made) < 8
    done = pa.Table.from_batches(made).to_pydict()
    assert done["doc_id"] == list(range(10))
    assert done["n_words"] == 8 * [60_001] + [0, 0] and done["n_removed"] == [1] + 9 * [0]
    assert done["kept_text"][:2] == [texts[0].split(" ", 1)[1].strip(), texts[1].strip()]
