"""Static range asymmetric numeral system over token ids, many lanes at a time.

A state x of a lane lies between 2**31 and 2**63. To encode a symbol with frequency f and
cumulated frequency c of 2**18, a lane whose state would leave that range first puts out
32 bits. Decoding runs the other way round, so encoding goes from the last symbol to the
first. All lanes of all blocks take one step together.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

SCALE_BITS = 18
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LANES = 64
BLOCK = 1 << 16
#: States are kept so many times in a block, evenly; decoding can begin at each.
CHECKPOINTS = 4


@dataclass
class Block:
    n: int
    words: bytes  # uint32
    states: bytes  # uint64, CHECKPOINTS x LANES
    offsets: list[int]  # first word of each checkpoint
    crc32: int  # of the ids as little-endian uint32


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols in ``ids``, ascending, and frequencies that add up to 2**18."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    (symbols,) = np.nonzero(counts)
    counts = counts[symbols]
    if len(symbols) >= 1 << SCALE_BITS:
        raise ValueError(f"{len(symbols)} symbols; at most {(1 << SCALE_BITS) - 1} fit")
    if not len(symbols):
        return symbols.astype(np.uint32), counts.astype(np.uint32)
    room = (1 << SCALE_BITS) - len(symbols)
    scaled = 1 + counts.astype(np.int64) * room // counts.sum()
    scaled[np.argmax(scaled)] += (1 << SCALE_BITS) - scaled.sum()
    return symbols.astype(np.uint32), scaled.astype(np.uint32)


def encode(ids: np.ndarray, symbols: np.ndarray, frequencies: np.ndarray) -> list[Block]:
    """Blocks of ``BLOCK`` ids (the last may be shorter), each decodable by itself."""
    n = len(ids)
    if not n:
        return []
    blocks = -(-n // BLOCK)
    size = min(BLOCK, -(-n // (LANES * CHECKPOINTS)) * LANES * CHECKPOINTS)
    index = np.full(blocks * size, np.argmax(frequencies), np.int64)
    place = np.zeros(int(symbols[-1]) + 1, np.int64)
    place[symbols] = np.arange(len(symbols))
    index[:n] = place[ids]
    # steps x (blocks * lanes)
    index = index.reshape(blocks, size // LANES, LANES).transpose(1, 0, 2).reshape(size // LANES, -1)
    freq = frequencies.astype(np.uint64)
    start = np.cumsum(freq) - freq
    steps = len(index)
    every = steps // CHECKPOINTS
    state = np.full(index.shape[1], LOW, np.uint64)
    states = np.zeros((CHECKPOINTS, index.shape[1]), np.uint64)
    lanes: list[np.ndarray] = []
    words: list[np.ndarray] = []
    limit = np.uint64(63 - SCALE_BITS)
    for t in range(steps - 1, -1, -1):
        f = freq[index[t]]
        out = np.flatnonzero(state >= (f << limit))
        words.append(state[out].astype(np.uint32))
        lanes.append(out)
        state[out] >>= WORD
        whole = state // f
        state = (whole << np.uint64(SCALE_BITS)) + (state - whole * f) + start[index[t]]
        if t % every == 0:
            states[t // every] = state
    counts = np.array([len(x) for x in reversed(lanes)])
    lane = np.concatenate(lanes[::-1])
    word = np.concatenate(words[::-1])
    step = np.repeat(np.arange(steps), counts)
    block = lane // LANES
    order = np.argsort(block, kind="stable")
    word, step, block = word[order], step[order], block[order]
    edges = np.searchsorted(block, np.arange(blocks + 1))
    found = []
    for b in range(blocks):
        own = slice(edges[b], edges[b + 1])
        part = np.ascontiguousarray(ids[b * BLOCK : (b + 1) * BLOCK], "<u4")
        found.append(
            Block(
                len(part),
                word[own].astype("<u4").tobytes(),
                np.ascontiguousarray(states[:, b * LANES : (b + 1) * LANES]).astype("<u8").tobytes(),
                np.searchsorted(step[own], np.arange(CHECKPOINTS) * every).tolist(),
                zlib.crc32(part),
            )
        )
    return found


def decode(blocks: list[Block], symbols: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """The ids of blocks of one table. Every checkpoint of every block is decoded at once;
    a block whose ids do not have its checksum is an error."""
    if not blocks:
        return np.zeros(0, np.uint32)
    freq = frequencies.astype(np.uint64)
    start = np.cumsum(freq) - freq
    of_slot = np.repeat(np.arange(len(freq)), frequencies)
    size = min(BLOCK, -(-max(b.n for b in blocks) // (LANES * CHECKPOINTS)) * LANES * CHECKPOINTS)
    every = size // LANES // CHECKPOINTS
    streams = [np.frombuffer(b.words, "<u4") for b in blocks]
    base = np.cumsum([0, *map(len, streams)])
    stream = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    # One run for each checkpoint.
    at = np.concatenate([np.array(b.offsets, np.int64) + base[i] for i, b in enumerate(blocks)])
    state = np.concatenate([np.frombuffer(b.states, "<u8") for b in blocks]).astype(np.uint64)
    runs = len(at)
    out = np.zeros((every, runs * LANES), np.int64)
    mask = np.uint64((1 << SCALE_BITS) - 1)
    for t in range(every):
        slot = state & mask
        symbol = of_slot[slot]
        out[t] = symbol
        state = freq[symbol] * (state >> np.uint64(SCALE_BITS)) + slot - start[symbol]
        low = (state < LOW).reshape(runs, LANES)
        need = low.sum(1)
        if need.any():
            # Lanes that need a word take the next ones of their run in order.
            place = (np.cumsum(low, 1) - 1 + at[:, None])[low]
            few = np.flatnonzero(low.ravel())
            state[few] = (state[few] << WORD) | stream[np.minimum(place, len(stream) - 1)]
            at += need
    flat = out.reshape(every, runs, LANES).transpose(1, 0, 2).reshape(len(blocks), -1)
    parts = []
    for b, row in zip(blocks, flat):
        ids = np.ascontiguousarray(symbols[row[: b.n]], "<u4")
        if zlib.crc32(ids) != b.crc32:
            raise ValueError("a block does not have its checksum")
        parts.append(ids)
    return np.concatenate(parts)
