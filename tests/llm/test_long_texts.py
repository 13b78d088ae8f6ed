import numpy as np
import pytest

from cairn.llm import simhash
from tests.llm.test_simhash import brute_fingerprint


@pytest.mark.parametrize("tail", ["\n", " " * 10, "\n" * (3 << 20), " last", " " * (1 << 20) + "last"])
def test_white_tails_after_the_last_cut(tail):
    for body in ["w" * (simhash._PIECE - 8) + " ab cd e", "ab cd ef" + "x" * simhash._PIECE, "ab " + "x" * simhash._PIECE, "ab cd " * (simhash._PIECE // 6 + 1)]:
        text = body + tail
        hashes = np.concatenate([simhash._shingle_hashes(r, 3) for r in simhash._word_runs(text.encode(), 2)])
        assert sorted(hashes.tolist()) == sorted(simhash._shingle_hashes(text.encode().split(), 3).tolist())
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
