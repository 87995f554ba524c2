import re
from pathlib import Path

import corpus_pipeline
from prosemill.llm import frames
from prosemill.llm.frames import table
from tests.llm.common import SF


def resident():
    found = Path("/proc/self/smaps_rollup").read_text()
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", found))) >> 10


def test_free_memory_is_handed_back():
    """Blocks between others that stay are free, but not at the heap's end."""

    def run(batches):
        blocks = [bytes(100_000) for _ in range(1500)]
        blocks[:] = blocks[::100]
        yield resident()

    work = frames.handing_back(run)([])
    held = next(work)
    assert next(work, None) is None
    assert resident() < held - 80


def test_texts_are_cut_into_parts_a_few_at_a_time(spark, monkeypatch):
    limits = []
    monkeypatch.setattr(frames, "map_texts", lambda df, fields, prepare, limit=frames.SLICE_BYTES, finish=None: limits.append(limit))
    corpus_pipeline.sentencepiece(spark, table(spark, SF, "documents"), SF)
    assert limits == [1 << 20]
