"""Prefix-free parsing of a set of strings, and its use to find repeated windows.

Rolling-hash triggers cut each string into phrases that overlap by one trigger, so no
phrase suffix longer than a trigger starts another one. The suffix array of the distinct
phrases (the dictionary) and that of the phrase sequences (the parse) are built apart;
together they give the order of all positions: first by the phrase suffix that starts
there, then by the parse suffix that follows. Text that repeats adds to the parse only.
"""

from __future__ import annotations

import numpy as np

from braidwork.llm.grams import BYTE_VALUES, Rolling
from braidwork.llm.runs import run_starts

U = np.uint64


def rank_suffixes(rank: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """Ranks of all suffixes by prefix doubling; equal suffixes get equal ranks.

    ``rank`` orders the first ``step`` symbols from each position (any values, at least
    1); ``ends`` is where the string of each position ends. Only positions that still
    share a rank are sorted again.
    """
    n = len(rank)
    order = np.argsort(rank, kind="stable")
    starts = np.flatnonzero(run_starts(rank[order]))
    sizes = np.diff(np.r_[starts, n])
    out = np.empty(n, dtype=np.int64)
    out[order] = np.repeat(starts, sizes) + 1
    shared = np.repeat(sizes > 1, sizes)
    active = order[shared]
    place = np.arange(n)
    while len(active):
        ahead = active + step
        inside = ahead < ends[active]
        second = np.zeros(len(active), dtype=np.int64)
        second[inside] = out[ahead[inside]]
        by = np.lexsort((second, out[active]))
        active, second = active[by], second[by]
        first = out[active]
        group = run_starts(first)
        part = run_starts(first, second)
        where = place[: len(active)]
        base = np.maximum.accumulate(np.where(group, where, 0))
        head = np.maximum.accumulate(np.where(part, where, 0))
        out[active] = first + head - base
        cuts = np.flatnonzero(part)
        sizes = np.diff(np.r_[cuts, len(active)])
        # A part whose members all end within the compared span is settled.
        going = (second > 0) & np.repeat(sizes > 1, sizes)
        active = active[going]
        step *= 2
    return out


def parse(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, trigger: int, spacing: int):
    """(phrase start, phrase end, string number) of every phrase of the strings
    data[starts[k]:ends[k]], which lie end to end."""
    roll = Rolling(BYTE_VALUES[data])
    cut = np.flatnonzero(roll.all_of(trigger) % U(spacing) == 0)
    string = np.searchsorted(starts, cut, side="right") - 1
    good = (cut > starts[string]) & (cut + trigger <= ends[string])
    begin = np.concatenate([starts, cut[good]])
    owner = np.concatenate([np.arange(len(starts)), string[good]])
    by = np.argsort(begin, kind="stable")
    begin, owner = begin[by], owner[by]
    finish = ends[owner].copy()
    inner = owner[:-1] == owner[1:]
    finish[:-1][inner] = begin[1:][inner] + trigger
    return roll, begin, finish, owner


def corpus_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, positions: np.ndarray, trigger: int = 6, spacing: int = 24) -> tuple[np.ndarray, Rolling]:
    """The order of the suffixes at ``positions`` of strings that lie end to end."""
    roll, begin, finish, owner = parse(data, starts, ends, trigger, spacing)
    other = Rolling(BYTE_VALUES[data ^ np.uint8(0x5A)], 1)
    names = np.stack([roll.spans(begin, finish - begin), other.spans(begin, finish - begin), (finish - begin).astype(U)], axis=1)
    by = np.lexsort(names.T)
    new = run_starts(*names[by].T)
    ident = np.empty(len(by), dtype=np.int64)
    ident[by] = np.cumsum(new) - 1
    shown = by[new]  # one occurrence of each distinct phrase
    # Dictionary: its phrases end to end, its suffixes ranked seven bytes at once at first.
    size = finish[shown] - begin[shown]
    d_start = np.cumsum(size) - size
    total = int(size.sum())
    source = np.repeat(begin[shown] - d_start, size) + np.arange(total)
    d_end = np.repeat(d_start + size, size)
    value = np.zeros(total + 7, dtype=U)
    value[:total] = data[source].astype(U) + U(1)
    packed = np.zeros(total, dtype=U)
    here = np.arange(total)
    for k in range(7):
        packed = packed << U(9) | np.where(here + k < d_end, value[k : k + total], U(0))
    d_rank = rank_suffixes(packed, d_end, 7)
    # Parse: the phrase ranks of each string, in place order.
    ends_of = np.searchsorted(owner, owner, side="right")
    p_rank = rank_suffixes(d_rank[d_start[ident]], ends_of, 1)
    phrase = np.searchsorted(begin, positions, side="right") - 1
    first = d_rank[d_start[ident[phrase]] + positions - begin[phrase]]
    after = np.where(phrase + 1 < ends_of[phrase], np.r_[p_rank, 0][phrase + 1], 0)
    return np.lexsort((after, first)), roll


def repeated(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, positions: np.ndarray, size: int, **params) -> np.ndarray:
    """Whether the ``size`` bytes at each position also start at another position.

    In corpus order equal windows are neighbours, so each is compared with the next.
    """
    order, roll = corpus_order(data, starts, ends, positions, **params)
    at = positions[order]
    other = Rolling(BYTE_VALUES[data ^ np.uint8(0x5A)], 1)
    same = ~run_starts(roll.spans(at, size), other.spans(at, size))
    hit = same.copy()
    hit[:-1] |= same[1:]
    out = np.empty(len(positions), dtype=bool)
    out[order] = hit
    return out
