import re
from pathlib import Path

import pyarrow as pa
import pytest

from crewlens.llm import pieces, workers


def held():
    """MB of this process that are no mapped files."""
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def scattered():
    """Some 200 MB of blocks, freed but for a few bytes after each."""
    blocks, pins = [], []
    for _ in range(2000):
        blocks.append(b"x" * 100_000)
        pins.append(b"y" * 600)
    del blocks
    return pins


BATCH = pa.RecordBatch.from_arrays([pa.array(["a" * workers.LARGE])], ["text"])
KINDS = {
    "lean": (workers.lean, lambda run: list(run(iter([BATCH])))),
    "lean_group": (workers.lean_group, lambda run: run(pa.Table.from_batches([BATCH]))),
    "lean_cogroup": (workers.lean_cogroup, lambda run: run(*[pa.Table.from_batches([BATCH])] * 2)),
}


@pytest.mark.parametrize("kind", KINDS)
def test_freed_memory_is_handed_back(kind):
    wrap, call = KINDS[kind]
    kept = []

    def batches(rows):
        for batch in rows:
            kept.append(scattered())
            yield batch

    def tables(rows, *_):
        kept.append(scattered())
        return rows

    work = {"lean": batches, "lean_group": lambda rows: tables(rows), "lean_cogroup": tables}[kind]
    workers.hand_back()
    before = held()
    out = call(work)
    freed_only = held() - before
    assert out == call(wrap(work))
    assert freed_only > 60 and held() - before < 20


def test_memory_is_handed_back_after_an_error(monkeypatch):
    calls = []
    monkeypatch.setattr(workers, "hand_back", lambda: calls.append(1))

    def broken(rows):
        yield next(rows)
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        list(workers.lean(broken)(iter([BATCH])))
    assert calls == [1]


def test_workers_keep_no_segments_between_tasks(spark, make):
    docs = make("doc_id long, text string", [(i, f"some words and number{i} in text {i}") for i in range(400)])
    assert pieces.encode(docs.repartition(8), "doc_id", ids=True).where("n_tokens > 1").count() == 400

    def kept(batches):
        for _ in batches:
            own = pieces.pieces(pieces.MODEL)
            yield pa.RecordBatch.from_arrays([pa.array([len(own.ids) + len(own.raw)])], ["n"])

    assert {r.n for r in spark.range(64, numPartitions=32).mapInArrow(kept, "n long").collect()} == {0}
