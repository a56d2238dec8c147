"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is a run of texts of about 2 MB. Words that no benchmark item holds cannot be part of an occurrence, so
the shard's sequence keeps only the runs of benchmark words that are long enough for some window, with a separator
after each run. Its suffixes are sorted by prefix doubling (separators differ from each other, so no comparison
passes one), the last column of the sorted rotations goes into a wavelet matrix, and all windows are searched
backwards at once by its ranks. Every eighth place of a run, and its first, keeps its position; the others walk
back to one. Covered words are merged into removal spans.

The benchmark is the query set. It is searched in blocks of at most ``BLOCK_CHARS`` characters (a longer item is
a block of its own), one pass over the shard each, so what is sent to the tasks has a fixed bound.

Words are compared by 64-bit hashes. Defined cases: null, empty and wordless texts have no words and no hits;
null and wordless items have no window; items with one id count as one; repeated documents give equal rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import text
from haulmark.llm.common import cut, map_batches, packed, unpacked, widened

WINDOW = 10
BLOCK_CHARS = 1 << 23
_KEEP = 8  # every how many places of a run keep their position
_ADDED = ("n_words", "word_from", "word_to", "char_from", "char_to", "items")
_SCHEMA = ("n_words long, word_from array<int>, word_to array<int>, char_from array<int>, char_to array<int>, "
           "items array<string>")


@dataclass
class Phrases:
    """Distinct windows of a block of items as rows of symbols (word numbers from 1), and the items of each."""

    words: np.ndarray  # sorted hashes; symbol k is words[k - 1]
    symbols: np.ndarray
    lengths: np.ndarray
    item_bounds: np.ndarray
    item_of: np.ndarray
    names: list[str]


def phrases(items: list[tuple], window: int = WINDOW) -> Phrases | None:
    """The windows of (item_id, text) pairs; null if there is none."""
    names = sorted({str(i) for i, _ in items})
    number = {name: k for k, name in enumerate(names)}
    rows: dict[tuple, set[int]] = {}
    row = 0
    for _, _, data, offsets in text.pieces(pa.array([v for _, v in items], pa.string())):
        found = text.words(data, offsets, text.ALNUM)
        for d in range(len(offsets) - 1):
            item, hashes = number[str(items[row][0])], found.hashes[found.bounds[d]:found.bounds[d + 1]].tolist()
            row += 1
            if hashes:
                for k in range(max(1, len(hashes) - window + 1)):
                    rows.setdefault(tuple(hashes[k:k + window]), set()).add(item)
    if not rows:
        return None
    lengths = np.array([len(r) for r in rows])
    words = np.unique(np.array([h for r in rows for h in r], dtype=np.uint64))
    symbols = np.zeros((len(rows), window), dtype=np.int32)
    for k, r in enumerate(rows):
        symbols[k, window - len(r):] = np.searchsorted(words, np.array(r, dtype=np.uint64)) + 1
    return Phrases(words, symbols, lengths, np.concatenate([[0], np.cumsum([len(s) for s in rows.values()])]),
                   np.array([i for s in rows.values() for i in sorted(s)]), names)


class Ranks:
    """Wavelet matrix: per level the zeros before each place, with the symbols ordered by the levels above."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.zeros: list[np.ndarray] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            before = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(bit == 0, out=before[1:])
            self.zeros.append(before)
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each symbol before each of its places."""
        at = [np.zeros_like(places[0]), *places]
        for k, before in enumerate(self.zeros):
            one = ((symbol >> (self.levels - 1 - k)) & 1).astype(bool)
            at = [np.where(one, before[-1] + p - before[p], before[p]) for p in at]
        return [p - at[0] for p in at[1:]]

    def at(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and its occurrences before it."""
        symbol = np.zeros(len(place), dtype=np.int64)
        low = np.zeros_like(place)
        for before in self.zeros:
            one = before[place + 1] == before[place]
            symbol = symbol * 2 + one
            place, low = (np.where(one, before[-1] + p - before[p], before[p]) for p in (place, low))
        return symbol, place - low


class Index:
    """FM-index of a sequence in which 0 separates runs, for patterns without 0."""

    def __init__(self, sequence: np.ndarray, top: int):
        n = len(sequence)
        split = sequence == 0
        count = int(split.sum())
        rank = np.where(split, np.cumsum(split) - 1, sequence.astype(np.int64) + count)
        width = 1
        while True:
            key = rank * (count + max(n, top) + 2)  # the first ranks are symbols, of which there can be more than places
            key[:n - width] += rank[width:] + 1
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(~same)])
            if not same.any():
                break
            width *= 2
        last = sequence[order - 1]  # the sequence starts with a separator, so nothing wraps
        self.ranks = Ranks(last.astype(np.int64), top)
        sizes = np.bincount(sequence, minlength=top + 2)
        self.before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        since = np.arange(n) - np.maximum.accumulate(np.where(split, np.arange(n), 0)) - 1
        kept = split | (since % _KEEP == 0)
        self.kept = kept[order]
        self.kept_before = np.cumsum(self.kept) - self.kept
        self.positions = order[self.kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all patterns, given as right-aligned symbols."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.kept), dtype=np.int64)
        width = patterns.shape[1]
        for step in range(1, width + 1):
            live = np.flatnonzero((high > low) & (lengths >= step))
            if len(live):
                symbol = patterns[live, width - step]
                a, b = self.ranks.rank(symbol, low[live], high[live])
                low[live], high[live] = self.before[symbol] + a, self.before[symbol] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffix rows."""
        out, rows = np.zeros(len(rows), dtype=np.int64), rows.copy()
        left, steps = np.arange(len(rows)), 0
        while len(left):
            here = self.kept[rows]
            out[left[here]] = self.positions[self.kept_before[rows[here]]] + steps
            left, rows = left[~here], rows[~here]
            if len(left):
                symbol, before = self.ranks.at(rows)
                rows = self.before[symbol] + before
            steps += 1
        return out


def _occurrences(found: text.Words, asked: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every place where a window occurs in a shard."""
    none = np.zeros(0, dtype=np.int64)
    slot = np.zeros(1 << 20, dtype=bool)
    slot[(asked.words & np.uint64(0xFFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(slot[(found.hashes & np.uint64(0xFFFFF)).astype(np.int64)])
    place = np.minimum(np.searchsorted(asked.words, found.hashes[maybe]), len(asked.words) - 1)
    known = asked.words[place] == found.hashes[maybe]
    at, symbol = maybe[known], place[known] + 1
    if not len(at):
        return none, none
    owner = np.searchsorted(found.bounds, at, side="right")
    opens = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(owner) > 0)])
    sizes = np.diff(np.concatenate([np.flatnonzero(opens), [len(at)]]))
    keep = np.repeat(sizes >= asked.lengths.min(), sizes)
    at, symbol, opens = at[keep], symbol[keep], opens[keep]
    if not len(at):
        return none, none
    # A separator in front of each run, and one at the end.
    target = np.arange(len(at)) + np.cumsum(opens)
    sequence = np.zeros(target[-1] + 2, dtype=np.int64)
    word = np.full(len(sequence), -1, dtype=np.int64)
    sequence[target], word[target] = symbol, at
    index = Index(sequence, len(asked.words))
    low, high = index.search(asked.symbols, asked.lengths)
    hits = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(hits)), hits)
    rows = low[window] + np.arange(len(window)) - np.repeat(np.cumsum(hits) - hits, hits)
    return window, word[index.locate(rows)]


def _runs(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _pass(batch: pa.RecordBatch, asked: Phrases | None):
    """Add, or extend, the columns of ``_ADDED``."""
    names = batch.schema.names
    earlier = batch.select(list(_ADDED)).to_pylist() if _ADDED[0] in names else None
    out: dict[str, list] = {k: [] for k in _ADDED}
    for row, _, data, offsets in text.pieces(batch.column(names.index("text"))):
        found = text.words(data, offsets, text.ALNUM)
        change = np.zeros(len(found.starts) + 1, dtype=np.int64)
        items: list[set] = [set() for _ in offsets[1:]]
        if asked is not None:
            window, first = _occurrences(found, asked)
            np.add.at(change, first, 1)
            np.add.at(change, first + asked.lengths[window], -1)
            owner = np.searchsorted(found.bounds, first, side="right") - 1
            count = np.diff(asked.item_bounds)[window]
            flat = np.repeat(asked.item_bounds[window] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            for pair in np.unique(np.repeat(owner, count) * len(asked.names) + asked.item_of[flat]).tolist():
                items[pair // len(asked.names)].add(asked.names[pair % len(asked.names)])
        if earlier is not None:
            for d in range(len(items)):
                old = earlier[row + d]
                items[d].update(old["items"])
                np.add.at(change, found.bounds[d] + np.array(old["word_from"], dtype=np.int64), 1)
                np.add.at(change, found.bounds[d] + np.array(old["word_to"], dtype=np.int64), -1)
        covered = np.cumsum(change)[:-1] > 0
        chars = text.char_positions(data) if covered.any() else None
        for d in range(len(items)):
            b, e = found.bounds[d], found.bounds[d + 1]
            starts, ends = _runs(covered[b:e]) if items[d] else ((), ())
            out["n_words"].append(e - b)
            out["word_from"].append(starts)
            out["word_to"].append(ends)
            zero = chars[offsets[d]] if items[d] else 0
            out["char_from"].append([chars[found.starts[b + s]] - zero for s in starts])
            out["char_to"].append([chars[found.ends[b + s - 1]] - zero for s in ends])
            out["items"].append(sorted(items[d]))
    ints = pa.list_(pa.int32())
    kinds = (pa.int64(), ints, ints, ints, ints, pa.list_(pa.string()))
    kept = [n for n in names if n not in _ADDED]
    yield pa.RecordBatch.from_arrays(
        [batch.column(names.index(n)) for n in kept] + [pa.array(out[k], kind) for k, kind in zip(_ADDED, kinds, strict=True)],
        names=kept + list(_ADDED))


def mark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows with their number of words, the covered words and characters as merged runs, and the items found."""
    spark = documents.sparkSession
    rest = documents.drop(*_ADDED)
    schema = widened(rest, _SCHEMA)
    asked = benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    total = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long")).first()[0]
    blocks = max(1, -(-total // (BLOCK_CHARS // 2)))  # half full on average
    marked = rest
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        packed = spark.sparkContext.broadcast(phrases([tuple(r) for r in part]))
        marked = map_batches(marked, schema, lambda batch, packed=packed: _pass(batch, packed.value))
    return marked


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items and whether it is contaminated."""
    hit = F.aggregate(F.zip_with("word_from", "word_to", lambda a, b: b - a), F.lit(0), lambda acc, x: acc + x).cast("long")
    return (mark(documents.select("doc_id", "text"), benchmark)
            .select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
                    F.array_join(F.zip_with("char_from", "char_to", lambda a, b: F.concat_ws(
                        ":", a.cast("string"), b.cast("string"))), ",").alias("spans")))


def remove(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows with the found passages cut out of ``text``. Further columns keep their values, whatever their names."""
    runs = F.zip_with("char_from", "char_to", lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b")))
    clean = F.when(F.size("char_from") > 0, cut(F.col("text"), runs)).otherwise(F.col("text"))
    return unpacked(mark(packed(documents), benchmark).withColumn("text", clean), documents.columns)
