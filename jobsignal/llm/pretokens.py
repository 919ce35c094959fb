"""Pre-tokens of the byte-level tokenizers without a regex: code point classes and an associative automaton scan.

The split pattern is a small automaton. Every code point becomes a class, every class a function from state to
state; functions compose associatively, so a block of text is reduced to one function, the functions of all blocks
are scanned by doubling, and each block then replays from its known entry state. Boundaries follow from the
state before a code point, its class and the class of the next one.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

# The split pattern this automaton recognizes, in the notation of the public tokenizers.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes. BREAK stands between texts; S_LIKE are s, t, m, d; R_LIKE are r and v.
BREAK, SPACE, BLANK, LETTER, NUMBER, OTHER, APOSTROPHE, S_LIKE, R_LIKE, L_LIKE, E_LIKE = range(11)
LETTERS = (LETTER, S_LIKE, R_LIKE, L_LIKE, E_LIKE)
CLASSES = 11
# States. FRESH: nothing before joins the next token; QUOTE: a token began with an apostrophe; QUOTE_R, QUOTE_L: then
# came r or v, or l.
FRESH, AFTER_SPACE, AFTER_BLANK, IN_LETTERS, IN_NUMBER, IN_OTHER, QUOTE, QUOTE_R, QUOTE_L = range(9)
STATES = 9

BLOCK = 256


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = BLANK
    for chars, kind in ((" ", SPACE), ("'", APOSTROPHE), ("stmd", S_LIKE), ("rv", R_LIKE), ("l", L_LIKE), ("e", E_LIKE)):
        table[[ord(c) for c in chars]] = kind
    return table


def _after(state: int, kind: int) -> int:
    """State after a code point of class ``kind`` was read in ``state``."""
    if kind == BREAK:
        return FRESH
    if kind in (SPACE, BLANK):
        return AFTER_SPACE if kind == SPACE else AFTER_BLANK
    if kind == NUMBER:
        return IN_NUMBER
    if kind == OTHER:
        return IN_OTHER
    if kind == APOSTROPHE:
        return IN_OTHER if state in (AFTER_SPACE, IN_OTHER, QUOTE) else QUOTE
    if state == QUOTE and kind == S_LIKE or state == QUOTE_R and kind == E_LIKE or state == QUOTE_L and kind == L_LIKE:
        return FRESH  # a contraction is complete
    if state == QUOTE and kind in (R_LIKE, L_LIKE):
        return QUOTE_R if kind == R_LIKE else QUOTE_L
    return IN_LETTERS


def _starts(state: int, kind: int, following: int) -> bool:
    """Whether a token starts at a code point of class ``kind`` read in ``state``."""
    if kind == BREAK:
        return True
    if kind in (SPACE, BLANK):
        within = state in (AFTER_SPACE, AFTER_BLANK)
        return not within or following not in (BREAK, SPACE, BLANK)  # the last blank before a word stands apart
    if state == AFTER_SPACE:
        return False
    if kind in LETTERS:
        contracted = state == QUOTE and (kind == S_LIKE or kind == R_LIKE and following == E_LIKE
                                         or kind == L_LIKE and following == L_LIKE)
        return not (state in (IN_LETTERS, QUOTE_R, QUOTE_L) or contracted)
    if kind == NUMBER:
        return state != IN_NUMBER
    return state not in (IN_OTHER, QUOTE)


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Transitions with states multiplied by CLASSES, and starts; both flat."""
    moves = [_after(s, k) * CLASSES for s in range(STATES) for k in range(CLASSES)]
    starts = [_starts(s, k, n) for s in range(STATES) for k in range(CLASSES) for n in range(CLASSES)]
    return np.array(moves, np.uint8), np.array(starts, bool)


def states_before(kinds: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """State (times CLASSES) before each code point: reduce blocks to functions, scan those, replay the blocks."""
    moves, _ = _tables()
    blocks = -(-len(kinds) // block)
    grid = np.zeros((block, blocks), np.uint8)  # columns are blocks; BREAK fills the last one
    padded = np.zeros(blocks * block, np.uint8)
    padded[:len(kinds)] = kinds
    grid[:] = padded.reshape(blocks, block).T
    maps = np.repeat((np.arange(STATES) * CLASSES).astype(np.uint8)[:, None], blocks, axis=1)
    for row in grid:
        maps = moves[maps + row]
    step = 1
    while step < blocks:  # inclusive scan; composing is associative, so the distance doubles
        later, earlier = maps[:, step:], maps[:, :-step] // CLASSES
        maps[:, step:] = np.take_along_axis(later, earlier.astype(np.intp), axis=0)
        step *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = maps[FRESH, :-1]
    before = np.empty((block, blocks), np.uint8)
    for i, row in enumerate(grid):
        before[i] = state
        state = moves[state + row]
    return before.T.ravel()[:len(kinds)]


def pretokens(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All pre-tokens of ``texts``: the joined string, starts and ends in it, and the number of the text of each."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = class_table()[points]
    breaks = np.cumsum([len(t) + 1 for t in texts]) - 1 if texts else np.zeros(0, np.int64)
    kinds[breaks] = BREAK
    _, table = _tables()
    following = np.zeros(len(kinds), np.uint8)
    following[:-1] = kinds[1:]
    index = (states_before(kinds) + kinds).astype(np.uint16) * CLASSES + following
    starts = np.flatnonzero(table[index])
    ends = np.append(starts[1:], len(kinds))
    words = kinds[starts] != BREAK
    starts, ends = starts[words], ends[words]
    return joined, starts, ends, np.searchsorted(breaks, starts)
