"""A Python worker keeps little of the memory that its task has freed."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from changefeed.llm import common

ROLLUP = Path("/proc/self/smaps_rollup")
ENCODES = """
import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from changefeed.llm import common, tokens


def held():
    found = re.findall(r"\\nPss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())
    return sum(map(int, found))


rng = np.random.default_rng(3)
letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
encode = tokens.encoder("word_bpe_49k.json", "word")
for _ in range(2):
    texts = [" ".join("".join(w) for w in rng.choice(letters, (60, 7))) for _ in range(2_000)]
    found, edges = encode(pa.array(texts), 2)
del texts, found, edges
before = held()
common.give_back()
print(before, held())
"""


@pytest.mark.skipif(common._TRIM is None or not ROLLUP.exists(), reason="needs glibc and smaps_rollup")
def test_the_tokenizer_gives_back_what_new_pieces_left():
    done = subprocess.run([sys.executable, "-c", ENCODES], capture_output=True, text=True, check=True,
                          cwd=Path(__file__).parents[2])
    before, after = map(int, done.stdout.split())
    assert before - after < 24_000, (before, after)


def test_rows_pass_and_memory_is_given_back_when_a_task_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"a": [i]}) for i in range(3)]
    run = common.giving_back(lambda rows: (b for b in rows))
    assert list(run(iter(batches))) == batches and len(calls) == 1
    half = run(iter(batches))
    next(half)
    half.close()
    assert len(calls) == 2
