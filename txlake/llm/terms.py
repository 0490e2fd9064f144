"""Terms of texts: maximal stretches of digits, letters A-Z in either case, and characters beyond ASCII."""

from __future__ import annotations

import numpy as np

from txlake.llm.batches import SEPARATOR, placed_words

# Term bytes keep their place, with A-Z as a-z; all other bytes become a space.
_TO_TERMS = np.full(256, 32, dtype=np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _TO_TERMS[_first : _last + 1] = np.arange(_first, _last + 1)
_TO_TERMS[0x41:0x5B] = np.arange(0x61, 0x7B)


def placed_terms(block: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, begin, end) of every term of the block in order, places in bytes; A-Z count as a-z."""
    return placed_words(_TO_TERMS[block], starts, fold=False)


def term_hashes(terms: list[str]) -> np.ndarray:
    """Hashes of terms that are already in lower case."""
    data = np.frombuffer("".join(f"{t} " for t in terms).encode() + bytes([SEPARATOR]), np.uint8)
    return placed_words(data, np.array([0, len(data)]), fold=False)[0]
