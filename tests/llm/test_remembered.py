import re
from pathlib import Path

from lendspark.llm import vocabulary
from lendspark.llm.frames import returned_memory
from lendspark.llm.vocabulary import ENTRY_BYTES, Remembered


def test_rare_words_come_back_without_encoding():
    asked = []
    held = Remembered(lambda key: asked.append(key) or key.upper())
    words = [f"w{i}" for i in range(600_000)]
    for _ in range(2):
        assert [held[w] for w in words[:1000]] == [w.upper() for w in words[:1000]]
        for w in words:
            held[w]
    assert len(asked) == len(words)


def test_the_bound_is_in_bytes(monkeypatch):
    monkeypatch.setattr(vocabulary, "REMEMBERED_BYTES", 20 * (ENTRY_BYTES + 4 * 60))
    held = Remembered(len)
    for i in range(1000):
        assert held[f"{i:060}"] == 60
        assert len(held) <= 10 and len(held.earlier) <= 10
    assert held["x" * 1000] == 1000 and "x" * 1000 not in held


def test_a_task_returns_its_memory():
    def resident():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) // 1024

    before = resident()
    held = [b"x" * size for _ in range(3000) for size in (60_000, 600)]  # each too small to be mapped by itself
    pins = held[1::2]  # in use above the holes
    del held
    assert resident() - before > 150
    assert list(returned_memory(iter)([1, 2])) == [1, 2]
    assert resident() - before < 60 and len(pins) == 3000
