"""Levels read shard by shard are those that each n-gram has by itself."""

import numpy as np

from medloom.llm import lm_scoring as lm


def test_levels_in_any_order():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 1 << 63, 3000, dtype=np.int64).view(np.uint64)
    shards, bits = 7, 8 * 1024
    assert (lm._modulo(hashes.copy(), bits + 8) == hashes % np.uint64(bits + 8)).all()
    packed = np.packbits(rng.random(shards * bits) < 0.8, bitorder="little")
    log_filter = lm.LogFilter(packed, shards, bits, 9)

    def level(h: np.ndarray) -> int:
        for q in range(1, 10):
            at = [int(lm._shard(h, shards)[0]) * bits + int(lm._place(h, q, i, bits)[0]) for i in range(lm.HASHES)]
            if not all(packed[a >> 3] >> (a & 7) & 1 for a in at):
                return q - 1
        return 9

    before = hashes.copy()
    got = log_filter.levels(hashes)
    assert (hashes == before).all()
    assert got.tolist() == [level(hashes[k : k + 1]) for k in range(len(hashes))] and got.max() > 1
