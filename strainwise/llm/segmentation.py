"""Cutting text into pre-tokens with arrays only: codepoint classes, then an associative scan over transition functions.

The boundaries a pattern finds from left to right are those of a small automaton.  Each codepoint acts on the automaton as
a function from state to state; composing such functions is associative, and the few functions that can arise form a finite
monoid whose product is one table.  So a chunk of texts is cut into blocks, each block's product is computed for all blocks
at once, the products are combined by doubling, and a last pass reads the state, and with it the boundary, at every
codepoint.  A text's first codepoint acts as a constant function, which keeps texts apart without any loop over them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from strainwise.llm.ragged import gather

# Classes of codepoints.  The letters that occur in contractions have classes of their own.
OTHER, LETTER, NUMBER, SPACE, WHITE, APOSTROPHE = range(6)
SINGLES, RE, VE, LL = "stmd", ("r", "e"), ("v", "e"), ("l", "l")

# Symbols of the automata: classes, with what follows taken into account.
S_OTHER, S_LETTER, S_NUMBER, S_SHORT, S_LONG, S_SPACE, S_WHITE, S_INNER = range(8)
# States of the automata.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE_MORE, TWO_MORE = range(8)

BLOCK = 128


@dataclass
class CodepointClasses:
    """Class of every codepoint, kept as runs so that it travels cheaply to the tasks."""

    first: np.ndarray
    kind: np.ndarray

    @classmethod
    def of(cls, letters, numbers, whites) -> CodepointClasses:
        """From the codepoints that a library's pattern classes match."""
        table = np.full(0x110000, OTHER, np.uint8)
        for members, kind in ((letters, LETTER), (numbers, NUMBER), (whites, WHITE)):
            table[members] = kind
        table[ord(" ")] = SPACE
        table[ord("'")] = APOSTROPHE
        first = np.flatnonzero(np.r_[True, table[1:] != table[:-1]])
        return cls(first, table[first])

    def table(self) -> np.ndarray:
        return np.repeat(self.kind, np.diff(np.r_[self.first, 0x110000]))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def every_codepoint() -> str:
    return "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))


class Automaton:
    """Transition table, boundary table, and the monoid of the transition functions."""

    def __init__(self, move):
        states, symbols = 8, 8
        self.next = np.zeros((states, 2 * symbols), np.uint8)
        self.cut = np.zeros((states, 2 * symbols), bool)
        for state in range(states):
            for symbol in range(symbols):
                self.next[state, symbol], self.cut[state, symbol] = move(state, symbol)
        # A text's first codepoint: the automaton starts afresh whatever came before.
        self.next[:, symbols:] = self.next[FRESH, :symbols]
        self.cut[:, symbols:] = True
        generators = [tuple(self.next[:, a]) for a in range(2 * symbols)]
        elements = {tuple(range(states)): 0}
        queue = list(elements)
        for element in queue:
            for g in generators:
                product = tuple(g[s] for s in element)
                if product not in elements:
                    elements[product] = len(elements)
                    queue.append(product)
        maps = np.array(queue)
        self.size = len(queue)
        self.maps = maps.astype(np.uint8)
        self.of_symbol = np.array([elements[g] for g in generators], np.int32)
        number = {e: i for e, i in elements.items()}
        self.product = np.array(
            [number[tuple(row)] for row in maps[:, maps].transpose(1, 0, 2).reshape(-1, states)], np.int32
        )  # at a * size + b: first a, then b

    def cuts(self, symbols: np.ndarray) -> np.ndarray:
        """True where a segment begins.  ``symbols`` has 8 added at the first codepoint of every text."""
        n = len(symbols)
        blocks = -(-n // BLOCK)
        padded = np.full(blocks * BLOCK, S_OTHER, np.uint8)
        padded[:n] = symbols
        steps = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
        acts = self.of_symbol[steps]
        total = acts[0]
        for row in acts[1:]:
            total = self.product[total * self.size + row]
        reach = 1
        while reach < blocks:  # inclusive products of all blocks up to each, by doubling
            total = np.concatenate([total[:reach], self.product[total[:-reach] * self.size + total[reach:]]])
            reach *= 2
        state = np.zeros(blocks, np.int32)
        state[1:] = self.maps[total[:-1], FRESH]
        out = np.empty((BLOCK, blocks), bool)
        width = self.next.shape[1]
        follow, cut = self.next.ravel().astype(np.int32), self.cut.ravel()
        for t in range(BLOCK):
            at = state * width + steps[t]
            out[t] = cut[at]
            state = follow[at]
        return out.T.ravel()[:n]


def _byte_level(state: int, symbol: int) -> tuple[int, bool]:
    """Contractions; runs of letters, numbers or others with one space before; white space, the last of it kept apart."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if symbol in (S_LETTER, S_NUMBER):
        inside = IN_LETTERS if symbol == S_LETTER else IN_NUMBERS
        return inside, state not in (inside, AFTER_SPACE)
    if symbol == S_OTHER or symbol in (S_SHORT, S_LONG) and state in (IN_OTHERS, AFTER_SPACE):
        return IN_OTHERS, state not in (IN_OTHERS, AFTER_SPACE)
    if symbol in (S_SHORT, S_LONG):
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    if symbol == S_INNER:
        return IN_WHITE, state != IN_WHITE
    return (AFTER_SPACE if symbol == S_SPACE else FRESH), True


def _word_level(state: int, symbol: int) -> tuple[int, bool]:
    """Contractions; runs of letters or others, single numbers; white space as segments of its own (to be dropped)."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FRESH, False
    if symbol == S_LETTER:
        return IN_LETTERS, state != IN_LETTERS
    if symbol == S_NUMBER:
        return FRESH, True
    if symbol == S_OTHER or symbol in (S_SHORT, S_LONG) and state == IN_OTHERS:
        return IN_OTHERS, state != IN_OTHERS
    if symbol in (S_SHORT, S_LONG):
        return (ONE_MORE if symbol == S_SHORT else TWO_MORE), True
    return IN_WHITE, state != IN_WHITE


class Segmenter:
    """Finds the pre-tokens of many texts at once.  ``byte_level`` picks one of the two fixed patterns."""

    def __init__(self, classes: CodepointClasses, byte_level: bool):
        self.classes = classes.table()
        self.automaton = Automaton(_byte_level if byte_level else _word_level)

    def segments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(codepoints of all texts, start of every segment, end of every segment, first segment of every text and the end)."""
        points = codepoints("".join(texts))
        bounds = offsets_of_texts(texts)
        n = len(points)
        if not n:
            return points, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        kinds = self.classes[points]
        last = np.zeros(n, bool)  # last codepoint of its text
        filled = np.diff(bounds) > 0
        last[bounds[1:][filled] - 1] = True
        symbols = np.array([S_OTHER, S_LETTER, S_NUMBER, S_SPACE, S_WHITE, S_OTHER], np.uint8)[kinds]
        white = (kinds == SPACE) | (kinds == WHITE)
        at = np.flatnonzero(white)
        inner = last[at] | white[np.minimum(at + 1, n - 1)]
        symbols[at[inner]] = S_INNER
        at = np.flatnonzero((kinds == APOSTROPHE) & ~last)
        if len(at):
            one = points[at + 1]
            two = np.where(last[at + 1], 0, points[np.minimum(at + 2, n - 1)])
            short = np.isin(one, [ord(c) for c in SINGLES])
            long = np.zeros(len(at), bool)
            for a, b in (RE, VE, LL):
                long |= (one == ord(a)) & (two == ord(b))
            symbols[at[short]] = S_SHORT
            symbols[at[long]] = S_LONG
        symbols[bounds[:-1][filled]] += 8
        starts = np.flatnonzero(self.automaton.cuts(symbols))
        ends = np.r_[starts[1:], n]
        return points, starts, ends, np.searchsorted(starts, bounds)

    def is_white(self, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        kinds = self.classes[points[starts]]
        return (kinds == SPACE) | (kinds == WHITE)


def slices(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    """The segments as strings: copied with a codepoint that the texts do not hold after each, then split at it once."""
    if not len(starts):
        return []
    lengths = ends - starts
    mark = 0
    while (points == mark).any():
        mark += 1
    marked = np.full(int(lengths.sum()) + len(starts), mark, "<u4")
    if len(points) == int(lengths.sum()):
        spread = np.repeat(np.arange(len(starts)), lengths)
        spread += np.arange(len(points))
        marked[spread] = points
    else:
        marked[gather(np.cumsum(lengths + 1) - lengths - 1, lengths)] = points[gather(starts, lengths)]
    return marked.tobytes().decode("utf-32-le", "surrogatepass").split(chr(mark))[:-1]


def offsets_of_texts(texts: list[str]) -> np.ndarray:
    out = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=out[1:])
    return out
