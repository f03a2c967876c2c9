"""A chunk's fragments take a bounded memory a window, also where every key is heavy."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

suffix_dedup = pytest.importorskip("shoalkit.llm.suffix_dedup")
WIDTH, SHARDS = 50, 8


def passes(texts, heavy):
    """The chunk of the texts and its shared keys and windows, by the operator's own passes."""
    rows = pd.DataFrame({"id": range(1, len(texts) + 1), "text": texts, "rest": [None] * len(texts)})
    (chunk,) = suffix_dedup._pack([rows])
    told = pd.concat(suffix_dedup._hashes(WIDTH, 1)([chunk]))
    keys = suffix_dedup._shared(heavy)(told).drop(columns="split").assign(windows=None)
    told = suffix_dedup._singles(WIDTH, 1)(chunk, keys)
    if len(told):
        windows = suffix_dedup._shared(suffix_dedup.LAST)(told).drop(columns="split").rename(columns={"keys": "windows"})
        keys = pd.concat([keys, windows.assign(keys=None)])
    return chunk, keys


def results(texts, heavy):
    """Per text (bytes, bytes removed, kept text), of the passes from the fragments on."""
    chunk, keys = passes(texts, heavy)
    found = []
    for _, shard in suffix_dedup._fragments(WIDTH, SHARDS)(chunk, keys).groupby("shard"):
        found.append(suffix_dedup._sorted(WIDTH)(shard))
    known = pd.concat([keys.assign(shard=None, firsts=None), *found])
    out = suffix_dedup._cleaned(WIDTH, SHARDS, True)(chunk, known)
    return list(out[["n_bytes", "n_removed", "kept"]].itertuples(index=False, name=None))


def brute(texts):
    seen, out = set(), []
    for t in texts:
        own = {t[i:i + WIDTH] for i in range(len(t) - WIDTH + 1)}
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - WIDTH + 1):
            if t[i:i + WIDTH] in seen:
                gone[i:i + WIDTH] = True
        seen |= own
        out.append((len(t), int(gone.sum()), "".join(c for c, g in zip(t, gone) if not g)))
    return out


@pytest.mark.parametrize("heavy", [0, 1 << 16])
def test_fragments_give_the_removed_bytes(heavy):
    r = random.Random(3)
    word = lambda n: "".join(r.choices("abcd ", k=n))
    parts = [word(n) for n in (49, 50, 51, 120, 400, 1500)] + ["x" * 700, "ab" * 300]
    texts = ["".join(r.choices(parts, k=r.randint(1, 6))) + word(r.randint(0, 90)) for _ in range(40)] + ["x" * 2000, "x" * 300, "short"]
    assert results(texts, heavy) == brute(texts)


def test_memory_of_a_chunk_of_heavy_keys():
    r = random.Random(5)
    a, b = ("".join(r.choices("abcdefgh ", k=150_000)) for _ in range(2))
    chunk, keys = passes([a + b, b + a], heavy=0)
    tracemalloc.start()
    try:
        out = suffix_dedup._fragments(WIDTH, SHARDS)(chunk, keys)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    windows = sum(len(x) // 8 for x in out["lens"])
    assert windows > 299_000
    left = sum(len(x) for c in ("data", "lens", "docs") for x in out[c])
    assert (peak - left) / 600_000 < 150, f"{(peak - left) / 600_000:.0f} bytes a window"
