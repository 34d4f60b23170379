import tracemalloc

import numpy as np

from newsight.llm.fingerprint import fingerprints


def test_hashing_of_many_characters_goes_in_parts():
    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 123, 4_000).astype(np.uint32) for _ in range(500)]
    tracemalloc.start()
    try:
        fingerprints(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # all at once took over 16 bytes for each of the two million characters
    assert peak < 14 * 2_000_000
