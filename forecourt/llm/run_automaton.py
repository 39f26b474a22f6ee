"""Periodic runs of words, found by a suffix automaton and link-cut access.

The automaton of a stretch of words has a state for each class of factors with the same end
positions; suffix links make the states a tree. The words are then appended in turn. Access to
the state of the new prefix recolours the path from it to the root with the new end. The path
falls into segments of one colour, the end at which those suffixes were last seen. For a segment
with last end e, now seen at i, and longest suffix L, the words e-L+1..i have period d = i - e;
if d <= L that is a square. L cannot be made longer, so the stretch starts at the run's own
start, and no shorter period is possible, as those suffixes would have been seen later than at
e. As i grows the same (start, d) comes back until the run ends, so its last i is the end.

A link-cut tree keeps each segment in a search tree. Here the tree is known before the first
access, so the segments of a heavy path are a stack: an access covers the upper part of each
heavy path it meets, which takes whole segments off the top and puts one on. Recolourings are
O(n log n) in all, as for link-cut trees.

Only stretches that can hold a run of MIN_WORDS words and MIN_PERIODS periods are appended. In
such a run each of the first length - period >= 16 words begins, or lies in, a 16-gram that
comes again one period on, so all its words lie in repeated 16-grams of the document. Hashes of
16-grams find those words; a collision only makes a stretch longer.

Texts are independent, so Spark deals them out as it reads them and nothing is shuffled. Null
texts are empty and have no words, n_runs 0 and four nulls. A row without doc_id is taken as it
is, without the planted repetition. Repeated rows each have their row, an empty table gives no
rows, other columns are not read. A text is held by one task; appending takes some hundreds of
bytes of memory a word of the longest stretch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forecourt.llm import common

MIN_WORDS = 24
MIN_PERIODS = 3
# (MIN_PERIODS - 1) / MIN_PERIODS of MIN_WORDS: what a run surely repeats.
GRAM = MIN_WORDS - MIN_WORDS // MIN_PERIODS
ROWS = 64

Run = tuple[int, int, int]  # start, length, period


class Automaton:
    """Suffix automaton of numbers: len, link, and the states of its prefixes."""

    def __init__(self, words: Sequence[int]):
        length, link, step = [0], [-1], [{}]
        self.prefix = []
        last = 0
        for word in words:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            step.append({})
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            if at >= 0:
                to = step[at][word]
                if length[to] == length[at] + 1:
                    link[new] = to
                else:
                    copy = len(length)
                    length.append(length[at] + 1)
                    link.append(link[to])
                    step.append(step[to].copy())
                    while at >= 0 and step[at].get(word) == to:
                        step[at][word] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new
            self.prefix.append(new)
        self.length, self.link = length, link


class LinkTree:
    """The tree of suffix links in heavy paths, each with the stack of its coloured segments."""

    def __init__(self, automaton: Automaton):
        self.length, link = automaton.length, automaton.link
        n = len(link)
        downward = np.argsort(np.array(self.length), kind="stable").tolist()
        size, heavy, most = [1] * n, [-1] * n, [0] * n
        for state in reversed(downward[1:]):
            up, own = link[state], size[state]
            size[up] += own
            if own > most[up]:
                most[up], heavy[up] = own, state
        head, self.above = list(range(n)), [-1] * n
        for state in downward[1:]:
            up = link[state]
            if heavy[up] == state:
                head[state], self.above[state] = head[up], self.above[up]
            else:
                self.above[state] = up
        self.head = head
        # by head: segments from the deepest to the topmost, as (longest suffix, last end)
        self.stacks: dict[int, list[tuple[int, int]]] = {}

    def access(self, state: int, end: int) -> Iterator[tuple[int, int]]:
        """Recolour the path to the root; yield (longest suffix, last end) of its segments.

        Deepest first; a segment on several heavy paths comes once for each.
        """
        head, above, length, stacks = self.head, self.above, self.length, self.stacks
        while state > 0:
            longest, top = length[state], head[state]
            stack = stacks.get(top)
            if stack is None:
                stacks[top] = [(longest, end)]
            else:
                covered = []
                while stack and stack[-1][0] <= longest:
                    covered.append(stack.pop())
                if stack and not (covered and covered[-1][0] == longest):
                    yield longest, stack[-1][1]
                yield from reversed(covered)
                stack.append((longest, end))
            state = above[state]


def squares(words: Sequence[int]) -> list[Run]:
    """All runs of at least two periods: (start, length, smallest period)."""
    automaton = Automaton(words)
    tree = LinkTree(automaton)
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(automaton.prefix):
        deeper = -1
        for longest, last in tree.access(state, i):
            # a segment that leaves a heavy path goes on above it: its deepest part counts
            period = i - last
            if last != deeper and period <= longest:
                ends[last - longest + 1, period] = i
            deeper = last
    return [(start, end - start + 1, period) for (start, period), end in ends.items()]


def stretches(words: np.ndarray, gram: int = GRAM) -> list[tuple[int, int]]:
    """Maximal stretches (start, end) of words that lie in repeated runs of `gram` words."""
    if len(words) <= gram:
        return []
    code = common.mix(words.astype(np.uint64) + common.BASE)
    hashes, width = code, 1
    while width < gram:  # doubling, then what is left
        more = min(width, gram - width)
        hashes = common.mix(hashes[: len(hashes) - more] * common.BASE + hashes[more:])
        width += more
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return []
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    change = np.zeros(len(words) + 1, np.int64)
    change[:-gram] += repeated
    change[gram:] -= repeated
    inside = np.cumsum(change) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2) if b - a >= MIN_WORDS]


def runs(words: Sequence) -> list[Run]:
    """Runs of MIN_WORDS words and MIN_PERIODS periods at least, by start, then period."""
    if len(words) < MIN_WORDS:
        return []
    known: dict = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], np.int64)
    found = []
    for a, b in stretches(ids):
        for start, length, period in squares(ids[a:b].tolist()):
            if length >= MIN_WORDS and length >= MIN_PERIODS * period:
                found.append((a + start, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(found: list[Run]) -> Run | None:
    """The run of greatest length / period; ties by start, then period."""
    best = None
    for run in found:  # sorted, so that the first of equals stays
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: Sequence, found: list[Run]) -> list:
    """The words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(keep).tolist()] if found else list(words)


def planted(words: list, doc_id: int | None) -> list:
    """The words, periodic from some place on for one doc_id of ten."""
    if doc_id is None or not words:
        return words
    share, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return words
    a = share % len(words)
    tail = len(words) - a
    period = 1 + tail // (3 + share % 8)
    return words[:a] + (words[a : a + period] * (tail // period + 1))[:tail]


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _report(doc_id: int | None, text: str) -> tuple:
    words = planted(text.encode().split(), doc_id)  # bytes split at ASCII white space only
    found = runs(words)
    best = strongest(found)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    return (
        doc_id,
        len(found),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: its runs, the strongest one, and the text without repetitions."""
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def report(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                ids = part.column("doc_id").to_pylist()
                rows = [_report(i, t.as_py()) for i, t in zip(ids, part.column("text"), strict=True)]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names
                )

    return common.texts(docs).mapInArrow(report, SCHEMA)
