"""Benchmark decontamination with a suffix automaton of the test items.

The automaton holds all substrings of the normalised items, one item after another with separators
no document has. Document words are streamed through it and the longest match ending at each word
is tracked: a match of at least ``window`` words, or a whole shorter item, hits the words it spans.

The items are the broadcast side. They are read in blocks of at most ``block_words`` words (about
60 MB as an automaton); a benchmark beyond one block is matched block after block, each pass adding
to what the one before found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playerlens.llm.text import ALNUM, WordHasher, mix64, set_aside
from playerlens.session import cut_lineage

BLOCK_WORDS = 200_000
_WORD = re.compile(rb"[^ ]+")
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """States are numbers; ``step[state << 32 | word]`` is the next one."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int):
        self.window = window
        known, ids = np.unique(
            np.concatenate([np.empty(0, np.uint64), *(w for _, w in items)]), return_inverse=True
        )
        self.known = known
        cuts = np.cumsum([len(w) for _, w in items])[:-1]
        texts = [x.tolist() for x in np.split(ids, cuts)] if items else []
        pairs = [w[:-1] * _PAIR + w[1:] for _, w in items if len(w) > 1]
        self.pairs = np.unique(mix64(np.concatenate([np.empty(0, np.uint64), *pairs])))
        self.shortest = min([window, *(len(t) for t in texts)])
        self._build(texts, len(known))
        self._label(texts)

    def _build(self, texts: list[list[int]], words: int) -> None:
        step: dict[int, int] = {}
        outs: list[list[int]] = [[]]
        link, length, last = [-1], [0], 0
        separator = words
        for text in texts:
            for c in (*text, separator):
                new = len(link)
                length.append(length[last] + 1)
                link.append(0)
                outs.append([])
                p = last
                while p >= 0 and (p << 32 | c) not in step:
                    step[p << 32 | c] = new
                    outs[p].append(c)
                    p = link[p]
                if p >= 0:
                    q = step[p << 32 | c]
                    if length[q] == length[p] + 1:
                        link[new] = q
                    else:
                        copy = len(link)
                        length.append(length[p] + 1)
                        link.append(link[q])
                        outs.append(list(outs[q]))
                        for x in outs[q]:
                            step[copy << 32 | x] = step[q << 32 | x]
                        while p >= 0 and step.get(p << 32 | c) == q:
                            step[p << 32 | c] = copy
                            p = link[p]
                        link[q] = link[new] = copy
                last = new
            separator += 1
        self.step, self.link, self.length = step, link, length

    def _label(self, texts: list[list[int]]) -> None:
        """Which items a window's state stands for, and where short items end."""
        self.items: dict[int, list[int]] = {}
        self.short: dict[int, list[tuple[int, list[int]]]] = {}
        ends: dict[int, tuple[int, list[int]]] = {}
        for n, text in enumerate(texts):
            state = 0
            for i, c in enumerate(text):
                state = self._window_state(self.step[state << 32 | c])
                if i + 1 >= self.window:
                    found = self.items.setdefault(state, [])
                    if not found or found[-1] != n:
                        found.append(n)
            if 0 < len(text) < self.window:
                ends.setdefault(state, (len(text), []))[1].append(n)
        if ends:
            for state in sorted(range(len(self.link)), key=self.length.__getitem__):
                above = self.short.get(self.link[state], [])
                own = [ends[state]] if state in ends else []
                if above or own:
                    self.short[state] = above + own

    def _window_state(self, state: int) -> int:
        """The state of the last ``window`` words of what ``state`` matches."""
        while self.length[self.link[state]] >= self.window and state:
            state = self.link[state]
        return state

    def scan(self, words: list[int]) -> Iterator[tuple[int, int, list[int]]]:
        """Position, matched length and items wherever something counts; -1 is an unknown word."""
        step, link, length = self.step, self.link, self.length
        state = size = 0
        for i, c in enumerate(words):
            to = step.get(state << 32 | c) if c >= 0 else None
            while to is None and state and c >= 0:
                state = link[state]
                size = length[state]
                to = step.get(state << 32 | c)
            if to is None:
                state = size = 0
                continue
            state = to
            size += 1
            if size >= self.window:
                yield i, size, self.items.get(self._window_state(state), [])
            if self.short:
                for k, found in self.short.get(state, ()):
                    if k <= size:
                        yield i, k, found

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which of a text's words are hit, and by which items.

        Only runs of words whose neighbouring pairs all occur in items are streamed: every match
        lies inside one.
        """
        n = len(hashes)
        marks = np.zeros(n + 1, np.int64)
        items: set[int] = set()
        if not n or not len(self.known) or n < self.shortest:
            return marks[:n] > 0, items
        if self.shortest == 1:
            runs = [(0, n)]
        else:
            pair = mix64(hashes[:-1] * _PAIR + hashes[1:])
            ok = np.zeros(n + 1, bool)
            if len(self.pairs):
                at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
                ok[1:n] = self.pairs[at] == pair
            edges = np.flatnonzero(ok[1:] != ok[:-1])
            runs = [
                (a, b + 1)
                for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True)
                if b + 1 - a >= self.shortest
            ]
        for a, b in runs:
            part = hashes[a:b]
            at = np.minimum(np.searchsorted(self.known, part), len(self.known) - 1)
            ids = np.where(self.known[at] == part, at, -1).tolist()
            for i, size, found in self.scan(ids):
                marks[a + i - size + 1] += 1
                marks[a + i + 1] -= 1
                items.update(found)
        return np.cumsum(marks)[:n] > 0, items


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and one-past-last word of each run of hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True))


def without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``text`` with those words, and what stands between them, replaced by a line break."""
    at = [m.span() for m in _WORD.finditer(text.translate(ALNUM))]
    out, done = [], 0
    for a, b in runs:
        out += [text[done : at[a][0]], b"\n"]
        done = at[b - 1][1]
    return b"".join([*out, text[done:]])


def _match(automaton: SuffixAutomaton, ids: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALNUM)
        for batch in batches:
            names = batch.schema.names
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                texts = part.column(names.index("text")).cast(pa.binary()).to_pylist()
                before = part.column(names.index("spans")).to_pylist()
                had = part.column(names.index("items")).to_pylist()
                words, hits, items, runs = [], [], [], []
                for hashes, old, seen in zip(hasher.many(texts), before, had, strict=True):
                    hit, found = automaton.hits(hashes)
                    for span in old:
                        hit[span["start"] : span["end"]] = True
                    words.append(len(hashes))
                    hits.append(int(hit.sum()))
                    items.append(sorted({*seen, *(ids[n] for n in found)}))
                    runs.append([{"start": a, "end": b} for a, b in spans(hit)])
                made = {
                    "n_words": pa.array(words, pa.int64()),
                    "n_hit": pa.array(hits, pa.int64()),
                    "items": pa.array(items, pa.list_(pa.string())),
                    "spans": pa.array(
                        runs, pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()}))
                    ),
                }
                yield pa.RecordBatch.from_arrays(
                    [made.get(n, part.column(i)) for i, n in enumerate(names)], names=names
                )

    return run


def _strip(automata: list[SuffixAutomaton]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(ALNUM)
        for batch in batches:
            i, j = batch.schema.names.index("text"), batch.schema.names.index("spans")
            texts = batch.column(i).cast(pa.binary()).to_pylist()
            for n, found in enumerate(batch.column(j).to_pylist()):
                runs = [(x["start"], x["end"]) for x in found]
                while runs:  # joining what is left may complete another window
                    texts[n] = without(texts[n], runs)
                    hashes = hasher.one(texts[n])
                    hit = np.zeros(len(hashes), bool)
                    for automaton in automata:
                        hit |= automaton.hits(hashes)[0]
                    runs = spans(hit)
            columns = list(batch.columns)
            columns[i] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def automata(
    items: DataFrame, *, window: int = 10, block_words: int = BLOCK_WORDS
) -> Iterator[tuple[SuffixAutomaton, list[str]]]:
    """Automata of the items, each over at most ``block_words`` words (or one longer item)."""
    hasher = WordHasher(ALNUM)
    block, ids, size = [], [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = hasher.one((row[1] or "").encode("utf-8", "surrogatepass"))
        if row[0] is None or not len(words):
            continue
        if block and size + len(words) > block_words:
            yield SuffixAutomaton(block, window), ids
            block, ids, size = [], [], 0
        block.append((len(ids), words))
        ids.append(row[0])
        size += len(words)
    yield SuffixAutomaton(block, window), ids


_MADE = {
    "n_words": "bigint",
    "n_hit": "bigint",
    "items": "array<string>",
    "spans": "array<struct<start:bigint,end:bigint>>",
}


def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with ``n_words, n_hit, items, spans`` (columns of those names are replaced).

    ``spans`` are the hit words as first and one-past-last word; ``items`` the ids, as sorted
    strings, of items with a window in the text. A null text has no words. Items without an id or
    without words match nothing; repeated items count once by id.
    """
    for name, kind in _MADE.items():
        empty = F.lit(0) if kind == "bigint" else F.array()
        docs = docs.withColumn(name, empty.cast(kind))
    first = True
    for automaton, ids in automata(items, window=window, block_words=block_words):
        docs = docs if first else cut_lineage(docs)
        docs = docs.mapInArrow(_match(automaton, ids), docs.schema)
        first = False
    return docs


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 10,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without the hit spans; documents with a larger share of hit words go as a whole.

    What is left holds no window of any item, also not across a removed span. Documents that are
    not hit come back unchanged, with null texts among them.
    """
    docs, columns = set_aside(docs, list(_MADE))
    found = contamination(docs, items, window=window, block_words=block_words)
    found = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
    every = [a for a, _ in automata(items, window=window, block_words=block_words)]
    return found.mapInArrow(_strip(every), found.schema).select(*columns)
