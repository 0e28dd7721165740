"""Burrows-Wheeler transforms of string collections, merged by interleave refinement."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Bwt:
    """``symbol[i]`` stands before the i-th suffix (0 ends a string); ``at[i]`` is its place;
    ``head[i]`` are its first bytes, with zeros behind the end of its string."""

    symbol: np.ndarray
    at: np.ndarray
    head: np.ndarray


def build(text: np.ndarray, starts: np.ndarray, base: int, depth: int) -> Bwt:
    """The transform of strings in ``text`` (symbols from 1, each string ended by 0).

    Suffixes are ordered by at least their first ``depth`` symbols, or up to the end of their
    string; the order of equal ones is open. Eight symbols are packed into one number, then
    ranks are doubled, over whole arrays. ``base`` is added to the places.
    """
    n = len(text)
    place = np.arange(n)
    end = np.flatnonzero(text == 0)
    # The end of the string of each place; a suffix never reads past it.
    room = end[np.searchsorted(end, place)] - place
    padded = np.concatenate([text, np.zeros(8, text.dtype)])
    bits = np.uint64(8 * text.itemsize)
    known = 64 // int(bits)
    key = np.zeros(n, np.uint64)
    for j in range(known):
        key = key << bits | np.where(j <= room, padded[j:j + n], 0).astype(np.uint64)
    # The first symbols twice as far, as big-endian bytes that compare like the suffixes.
    head = np.stack([key, np.where(known <= room, key[np.minimum(place + known, n - 1)], 0)], 1).astype(">u8")
    while True:
        order = np.argsort(key)
        new = np.ones(n, np.int64)
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if known >= depth or rank[order[-1]] == n:
            break
        key = rank * np.int64(n + 1) + np.where(known <= room, rank[place + np.minimum(known, room)], 0)
        known *= 2
    before = np.empty_like(text)
    before[1:] = text[:-1]
    before[starts] = 0
    return Bwt(before[order], order + base, head[order].view(f"S{head.itemsize * 2}")[:, 0])


def merge(shards: list[Bwt], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places in merged order, number of the interval of each).

    Start with the interleave by the heads, which merges sorted runs. In each round the rows are dealt out by the
    symbol before them, keeping their order: what was sorted by h symbols is then sorted by
    h + 1, and rows of a shard never change places among each other, so only the interleave
    of the shards is refined. An interval border falls where the symbol or the interval of
    the source changes; after ``depth`` rounds an interval holds the suffixes whose first
    ``depth`` symbols are equal, which is a run of common prefixes of at least that length.
    """
    sizes = [len(s.symbol) for s in shards]
    n = sum(sizes)
    source = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    interval = np.zeros(n, np.int32)
    symbol = np.empty(n, np.result_type(*(s.symbol for s in shards)))
    border = np.zeros(n, bool)
    known = min(s.head.itemsize // s.symbol.itemsize for s in shards)
    if n and known <= depth and len({s.symbol.dtype for s in shards}) == 1:
        head = np.concatenate([s.head for s in shards])
        deal = np.argsort(head, kind="stable")
        source, head = source[deal], head[deal]
        np.not_equal(head[1:], head[:-1], out=border[1:])
        interval = np.cumsum(border, dtype=np.int32)
    else:
        known = 0
    for _ in range(depth - known):
        for i, shard in enumerate(shards):
            symbol[source == i] = shard.symbol
        deal = np.argsort(symbol, kind="stable")
        dealt, part = symbol[deal], interval[deal]
        source = source[deal]
        np.not_equal(part[1:], part[:-1], out=border[1:])
        border[1:] |= dealt[1:] != dealt[:-1]
        interval = np.cumsum(border, dtype=np.int32)
    places = np.empty(n, np.int64)
    for i, shard in enumerate(shards):
        places[source == i] = shard.at
    return places, interval
