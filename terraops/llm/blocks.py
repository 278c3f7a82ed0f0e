"""Large cells of a join as pairs of blocks, each a task of its own."""

from __future__ import annotations

import numpy as np


def mixed(values: np.ndarray) -> np.ndarray:
    """31 well-mixed bits of 64-bit integers."""
    return (values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)


def block_pairs(key: np.ndarray, home: np.ndarray, homes: np.ndarray, guests: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, guest, low, high, right): every block pair that each row of a cell is in.

    A cell has homes blocks of the rows at home in it and guests blocks of its visitors, and a row's key names its
    block. Home blocks meet each other and all visitors' blocks; visitors do not meet. guest tells whether the pair
    is with visitors, right on which side of it the row stands; the sides of a block with itself are all left.
    """
    block = key % np.where(home, homes, guests)
    times = np.where(home, homes + guests, homes)
    row = np.repeat(np.arange(len(key)), times)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    own, at_home, n = block[row], home[row], homes[row]
    guest = ~at_home | (turn >= n)
    other = np.where(at_home & guest, turn - n, turn)
    low = np.where(guest, np.where(at_home, own, other), np.minimum(own, other))
    high = np.where(guest, np.where(at_home, other, own), np.maximum(own, other))
    return row, guest, low, high, np.where(guest, ~at_home, own != low)
