"""What a Python worker holds when a task of a stage has ended."""

import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest

from evenkeel.llm import common, tokens

REPO = Path(__file__).resolve().parent.parent.parent
# In a process of its own, as the memory of this one depends on the tests before.
MEASURED = """
import gc, random, re
from pathlib import Path
import numpy as np
import public_tokenizers
import pyarrow as pa
from evenkeel.llm import ngram_join, packing, toxicity, tokens
from evenkeel.llm.common import tidied

def held():
    gc.collect()
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) // 1024

class Context:
    partitionId = staticmethod(lambda: 0)
    get = classmethod(lambda cls: cls)

ngram_join.TaskContext = Context
rng = random.Random(1)
words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(60_000)]
texts = [" ".join(rng.choices(words, k=800)) for _ in range(2000)]
deal = tidied(ngram_join._deal(5))
before = held()
tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
for ids in tokens.encoder(public_tokenizers.path("byte_bpe_50k.json")).batch(texts):
    pass
del ids
print(held() - before)
for batch in deal(iter([pa.RecordBatch.from_pydict({"text": texts})])):
    pass
del batch
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="needs /proc")
def test_a_task_hands_back_what_it_and_earlier_stages_took():
    environment = {**os.environ, "PYTHONPATH": str(REPO)}
    done = subprocess.run([sys.executable, "-c", MEASURED], env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    packed, dealt = map(int, done.stdout.split())
    assert packed > 20  # the encoder and its store
    assert dealt < 40


def test_a_step_drops_what_others_keep():
    common.kept_for(tokens.STORE)["a"] = 1
    batches = [pa.RecordBatch.from_pydict({"a": [i]}) for i in range(3)]
    assert list(common.tidied(iter, tokens.STORE)(batches)) == batches
    assert common.kept_for(tokens.STORE) == {"a": 1}
    assert list(common.tidied(iter)(batches)) == batches
    assert common.kept_for(tokens.STORE) == {}


def test_a_step_that_fails_hands_back_too(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "hand_back", lambda: calls.append(1))

    def broken(batches):
        yield from batches
        raise ValueError

    with pytest.raises(ValueError):
        list(common.tidied(broken)([1, 2]))
    assert calls == [1]
