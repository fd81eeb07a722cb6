"""What a packing task holds of a batch of texts."""

import tracemalloc
from types import SimpleNamespace

import pyarrow as pa

from claimforge.llm import packing, subword


def test_texts_of_a_batch_are_held_some_at_a_time(monkeypatch):
    """A whole batch of texts was made Python strings at once: over 32 MB here."""
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    kind = SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))
    docs = SimpleNamespace(schema={"doc_id": kind}, select=lambda *_: SimpleNamespace(mapInArrow=lambda run, _: run))
    run = packing.pieces(docs, subword.default_path(), 2048, 0, "doc_id", "text")
    texts = [f"{i} é " + "word " * 100_000 for i in range(32)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(32), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    del texts
    next(run(iter([batch.slice(0, 1)])))  # loads the vocabulary
    tracemalloc.start()
    rows = [r for made in run(iter([batch])) for r in made.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6
    assert [r["doc_id"] for r in rows if r["piece"] == 0] == list(range(32))
    for length in {r["length"] for r in rows}:  # ranks go on from part to part
        ranks = [r["local_rank"] for r in rows if r["length"] == length]
        assert ranks == list(range(len(ranks)))
