"""Sets of hashed word shingles of a batch of texts, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE_WORDS = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of `words` words.

    Words are parted by ASCII white space and compared with A-Z in lower case. A text of fewer words, but one at least, has
    one shingle, all its words; a null text and one without words have none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    offsets, flat = lists.offsets.to_numpy(), lists.flatten()
    coded = flat.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    h = hashes[coded.indices.to_numpy()] if len(flat) else np.zeros(0, dtype=np.uint64)
    full = max(0, len(h) - words + 1)
    runs = np.zeros(full, dtype=np.uint64)
    for k in range(words):
        runs = mixed(runs * _MIX + h[k : k + full])
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = h[a:b]
        if len(own) and not len(flat[a].as_py()):  # white space in front gives an empty first word
            a, own = a + 1, own[1:]
        if len(own) and not len(flat[b - 1].as_py()):
            b, own = b - 1, own[:-1]
        if len(own) >= words:
            yield np.unique(runs[a : b - words + 1])
        elif len(own):
            few = np.zeros(1, dtype=np.uint64)
            for x in own:
                few = mixed(few * _MIX + x)
            yield few + np.uint64(len(own))
        else:
            yield own[:0]
