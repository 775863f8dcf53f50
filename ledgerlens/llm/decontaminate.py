"""Benchmark decontamination: an FM-index over each shard of training text.

A shard is a run of documents inside a Spark task.  Its words are numbered by
the benchmark's vocabulary, an FM-index is built over them (suffix order,
Burrows-Wheeler transform in a wavelet matrix, sampled suffix positions), every
benchmark window is searched backwards through the wavelet ranks, occurrences
are located by walking to the next sampled position, and their word ranges are
merged into removal spans.

Words that no benchmark item contains cannot be part of an occurrence, so only
runs of known words at least as long as the shortest window enter the index;
this is exact.  The text never moves: there is no shuffle.

Defined results: null and empty texts have no words; an item with no words has
no window; equal windows of several items count for each of them; repeated item
ids are one item and a null item id counts as an item whose id is left out of
the id list; duplicated documents each get their row; an empty benchmark or
table gives rows without hits or no rows.  Other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.textops import row_starts, text_buffers, text_chunks, word_bounds, words

#: Words in a window.
WINDOW = 10
#: Windows of one broadcast block: about 2 MB; a larger benchmark makes more blocks.
BLOCK_WINDOWS = 20_000
#: Distance of the sampled suffix positions.
SAMPLE = 16


class PhraseBlock:
    """Windows of some benchmark items over a vocabulary of their words (ids from 1)."""

    def __init__(self, rows: list[tuple[object, np.ndarray]], window: int):
        hashes = [h for _, h in rows if len(h)]
        self.vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        self.items: list[object] = []
        number: dict[object, int] = {}
        found: dict[int, dict[tuple, set]] = {}
        for item, h in rows:
            if not len(h):
                continue
            if item not in number:
                number[item] = len(self.items)
                self.items.append(item)
            ids = np.searchsorted(self.vocabulary, h) + 1
            k = min(window, len(ids))
            for at in range(len(ids) - k + 1):
                found.setdefault(k, {}).setdefault(tuple(ids[at:at + k]), set()).add(number[item])
        #: length -> (windows as rows of word ids, items of each window)
        self.windows = {k: (np.array(list(w), np.int64), [sorted(s) for s in w.values()])
                        for k, w in found.items()}
        self.shortest = min(self.windows, default=0)
        self.bits = 20
        slot = (self.vocabulary & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        self.table = np.zeros(1 << self.bits, np.int32)
        self.table[slot] = np.arange(1, len(slot) + 1)
        taken, count = np.unique(slot, return_counts=True)
        self.table[taken[count > 1]] = -1

    def word_ids(self, h: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word hash; 0 for other words."""
        known = np.concatenate(([np.uint64(0)], self.vocabulary))
        ids = self.table[(h & np.uint64((1 << self.bits) - 1)).astype(np.int64)]
        shared = np.flatnonzero(ids < 0)
        if len(shared):
            at = np.minimum(np.searchsorted(self.vocabulary, h[shared]), len(self.vocabulary) - 1)
            ids[shared] = at + 1
        ids[(known[ids] != h)] = 0
        return ids


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last symbol must be unique and smallest."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key)
        ordered = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2


class FMIndex:
    """Backward search over a sequence of integers from 1 upwards."""

    def __init__(self, text: np.ndarray, symbols: int):
        text = np.concatenate((text, [0])).astype(np.int64)
        order = suffix_order(text)
        self.n = len(text)
        self.bwt = text[order - 1]
        counts = np.bincount(text, minlength=symbols + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.sampled = order % SAMPLE == 0
        # positions of the sampled suffixes only, found by their places in the order
        self.marks = np.flatnonzero(self.sampled)
        self.position = order[self.marks]
        self.levels = []
        seq = self.bwt
        for shift in range(int(symbols).bit_length() - 1, -1, -1):
            bit = (seq >> shift) & 1
            ones = np.concatenate(([0], np.cumsum(bit)))
            zeros = self.n - ones[-1]
            self.levels.append((shift, ones, zeros))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position of the transform."""
        start = np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            up = ((symbol >> shift) & 1).astype(bool)
            at = np.where(up, zeros + ones[at], at - ones[at])
            start = np.where(up, zeros + ones[start], start - ones[start])
        return at - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, and their ranges of suffixes."""
        which = np.arange(len(phrases))
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for at in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[which, at]
            low = self.first[symbol] + self.rank(symbol, low)
            high = self.first[symbol] + self.rank(symbol, high)
            alive = high > low
            which, low, high = which[alive], low[alive], high[alive]
            if not len(which):
                break
        return which, low, high

    def locate(self, suffixes: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by stepping back to sampled ones."""
        at, steps = suffixes.copy(), np.zeros(len(suffixes), np.int64)
        open_ = np.flatnonzero(~self.sampled[at])
        while len(open_):
            symbol = self.bwt[at[open_]]
            at[open_] = self.first[symbol] + self.rank(symbol, at[open_])
            steps[open_] += 1
            open_ = open_[~self.sampled[at[open_]]]
        return self.position[np.searchsorted(self.marks, at)] + steps


def occurrences(block: PhraseBlock, h: np.ndarray, row: np.ndarray, n_rows: int):
    """(first word, number of words, items) arrays of all window occurrences in a shard."""
    out = []
    if not block.shortest or not len(h):
        return out
    ids = block.word_ids(h)
    start, end, _ = word_bounds(ids > 0, row_starts(row, n_rows))
    long = end - start >= block.shortest
    start, end = start[long], end[long]
    if not len(start):
        return out
    size = end - start
    word = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    slot = np.arange(len(word)) + np.repeat(np.arange(len(size)), size)
    # 1 parts the runs; the words follow from 2
    text = np.ones(len(word) + len(size), np.int64)
    text[slot] = ids[word].astype(np.int64) + 1
    back = np.zeros(len(text), np.int64)
    back[slot] = word
    index = FMIndex(text, len(block.vocabulary) + 1)
    for k, (windows, items) in block.windows.items():
        which, low, high = index.search(windows + 1)
        if not len(which):
            continue
        count = high - low
        suffix = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
        out.append((back[index.locate(suffix)], k, np.repeat(which, count), items))
    return out


def scan_shard(blocks, data: np.ndarray, offsets: np.ndarray):
    """Of each document: words, hit words, items, and byte spans to remove."""
    n = len(offsets) - 1
    _, start, end, row, h = words(data, offsets)
    first = row_starts(row, n)
    change = np.zeros(len(h) + 1, np.int64)
    items: list[set] = [set() for _ in range(n)]
    for block in blocks:
        for at, k, window, owners in occurrences(block.value, h, row, n):
            np.add.at(change, at, 1)
            np.add.at(change, at + k, -1)
            pairs = np.unique(np.stack((row[at], window)), axis=1)
            for doc, w in pairs.T:
                items[doc].update(block.value.items[i] for i in owners[w])
    hit = np.cumsum(change[:-1]) > 0
    n_hit = np.add.reduceat(np.concatenate((hit, [False])).astype(np.int64), first[:-1]) if n else np.zeros(0, int)
    n_hit = np.where(first[1:] > first[:-1], n_hit, 0)
    run_start, run_end, run_row = word_bounds(hit, first)
    spans: list[list] = [[] for _ in range(n)]
    for a, b, doc in zip(start[run_start], end[run_end - 1], run_row):
        spans[doc].append({"start": int(a - offsets[doc]), "end": int(b - offsets[doc])})
    return np.diff(first), n_hit, items, spans


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_windows: int):
    """Broadcast blocks of windows, each of a bounded size; a block at a time is on the driver."""
    sc = benchmark.sparkSession.sparkContext
    blocks, rows, held = [], [], 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator():
        data, offsets = text_buffers(pa.array([text], pa.string()))
        h = words(data[offsets[0]:offsets[-1]], offsets - offsets[0])[4]
        rows.append((item, h))
        held += max(1, len(h) - window + 1)
        if held >= block_windows:
            blocks.append(sc.broadcast(PhraseBlock(rows, window)))
            rows, held = [], 0
    if rows or not blocks:
        blocks.append(sc.broadcast(PhraseBlock(rows, window)))
    return blocks


def find_phrases(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", keep: list[str] | None = None, window: int = WINDOW,
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: the columns in ``keep``, then ``n_words``, ``n_hit``,
    ``n_items``, ``items`` (ids as sorted strings) and ``spans`` (UTF-8 byte ranges,
    merged, end exclusive) of the benchmark windows found."""
    keep = ["doc_id"] if keep is None else keep
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, window, block_windows)
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("t"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span)])
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            for lo, hi, data, offsets in text_chunks(text):
                n_words, n_hit, items, spans = scan_shard(blocks, data, offsets)
                own = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([
                    *own, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([len(s) for s in items], pa.int64()),
                    pa.array([sorted(i for i in s if i is not None) for s in items], pa.list_(pa.string())),
                    pa.array(spans, span_type)], names=[f.name for f in schema.fields])

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                        "n_words", "n_hit", "n_items", "items", "spans")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest columns of the decontamination query."""
    found = find_phrases(docs, benchmark, **options)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with all their columns."""
    found = find_phrases(docs, benchmark, keep=docs.columns, **options)
    return found.where("n_hit = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
