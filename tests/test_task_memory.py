"""What a task holds of a large batch of texts."""

import tracemalloc

import pyarrow as pa

from corpuskiln.operators import backend, masking
from corpuskiln.plans import flows


def most(steps):
    tracemalloc.start()
    n = sum(steps)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, peak


class Requests:
    columns = ["part", "chunk", "prompt", "tokens"]
    dtypes = [("part", "int"), ("chunk", "string"), ("prompt", "string"), ("tokens", "array<string>")]

    def mapInArrow(self, run, schema):
        return run


def test_answers_of_a_batch_are_not_held_together():
    prompt = '<CHUNK>\n{"chunk_id": "a", "pages": [1]}\n</CHUNK>\n<SOURCE>\n' + "text " * 4000 + "\n</SOURCE>"
    n = 1500
    batch = pa.RecordBatch.from_pydict({"part": list(range(n)), "chunk": ["c"] * n, "prompt": [prompt] * n, "tokens": [[]] * n}, pa.schema([("part", pa.int32()), ("chunk", pa.string()), ("prompt", pa.string()), ("tokens", pa.list_(pa.string()))]))
    run = backend.generate(Requests(), flows.echo_fragment, shape=flows.fragment_error)
    rows, peak = most(b.num_rows for b in run(iter([batch])))
    assert rows == n and peak < 8 << 20  # all answers are 30 MB


def test_masked_texts_of_a_batch_are_not_held_together():
    texts, kinds = pa.array([f"{i} $x$ " + "word " * 1000 for i in range(6000)]), pa.array(["Markdown"] * 6000)
    rows, peak = most(len(b) for b in masking.masked_slices(iter([(texts, kinds)])))
    assert rows == 6000 and peak < 8 << 20  # all texts are 30 MB
