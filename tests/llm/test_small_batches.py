"""Personal data is found and replaced in batches of little text."""

from collections import Counter

import pytest

pa = pytest.importorskip("pyarrow")
from stagetime.llm import pii  # noqa: E402


def test_personal_data_is_handled_in_small_batches():
    texts = [None, "", *(f"a{i}@mail.example.com " + "word " * 10_000 for i in range(200))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text_key", "text"])
    found = list(pii._find(iter([batch])))
    assert sum(b.num_rows for b in found) == len(texts) and max(b.num_rows for b in found) < 20
    spans = pa.array([[] if not t else [{"start": 0, "kind": 0, "end": t.index(" ")}] for t in texts])
    marked = batch.append_column("spans", spans.cast(pii._BASE_TYPE))
    clean = list(pii._sanitise(iter([marked])))
    assert max(b.nbytes for b in clean) < 1 << 20
    assert [t for b in clean for t in b.column(2).to_pylist()] == [t and "[EMAIL]" + t[t.index(" ") :] for t in texts]
    counted = Counter()
    for b in pii._document_frequencies(iter([batch]), most=100):
        counted.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)))
    assert sorted(counted.values())[-5:] == [1, 200, 200, 200, 200] and len(counted) == 194
