"""Removal of repeated passages by a distributed, sparse suffix array.

Every byte covered by a string of ``min_bytes`` bytes that also starts anywhere
else is removed.  Whether a suffix shares its first bytes with another is found
by sorting: suffix records carry their leading bytes, a digest of the prefix in
question and where they start; ``repeatedly`` deals them to ranges between
sampled splitters, every range is sorted locally by leading bytes, then digest,
then place, neighbours are compared, and the ends of the ranges are compared
with those next to them.  As the place is part of the order, a prefix that very
many suffixes share is split over several ranges.

All suffixes of a corpus would not fit, so two rounds narrow them down without
losing any (the digest stands for the bytes after the leading ones).  A record
of these rounds stands for several windows of ``min_bytes``: it is sorted by the
bytes that all of them hold (the core), then by the bytes that they span
together.  A unique core rules the windows out; a repeated span settles them as
repeated; the rest are open and go on, with one settled record of each span that
shares its core with an open one as a witness.

1. zones: the window at x is represented by the least hash of its first
   ``window`` positions (winnowing), so equal windows have equal anchors; a zone
   is the windows of one anchor;
2. blocks of ``STEP`` windows, aligned to the anchor;
3. single windows: their whole prefix is compared.

Texts are first reduced to the different ones; a text that two rows hold is
removed as a whole if it is long enough.

Defined results: null counts as the empty text; shorter texts keep all bytes;
repeated rows each get their row; ids are passed through, null or not; an empty
table gives no rows.  The removal works on bytes, so a kept piece may start or
end inside a multi-byte character, exactly where the matches do.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.textops import mix, powers, prefix_hash, slice_hash, text_buffers, row_runs

#: Length of the strings that may occur once only.
MIN_BYTES = 400
#: Windows of a block in the third round.
STEP = 16
LEAD = 8
KEY = ("lead", "digest", "h1", "h2", "ref")
GROUP_KEY = ("lead", "digest", "span", "h1", "h2", "ref")
GROUP_RECORD = "lead long, digest long, span long, h1 long, h2 long, ref long"
RECORD = "lead long, digest long, h1 long, h2 long, ref long"


@dataclass(frozen=True)
class Lengths:
    """Lengths that follow from the match length."""

    match: int

    def __post_init__(self):
        if not 40 <= self.match <= 1600:
            raise ValueError("min_bytes must be from 40 to 1600")

    @property
    def gram(self) -> int:
        return min(16, self.match // 4)

    @property
    def window(self) -> int:
        return self.match * 5 // 8

    @property
    def core(self) -> int:
        return self.match - self.window + 1


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i:i + width] for each i (the end is padded)."""
    top = np.uint64(np.iinfo(np.uint64).max)
    n = len(values)
    blocks = -(-(n + width) // width)
    padded = np.full(blocks * width, top)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:n + width - 1])


def zones(prefix: np.ndarray, offsets: np.ndarray, size: Lengths):
    """Anchor, first and last window start of each zone (places in the run of rows)."""
    n = len(prefix) - 1
    empty = np.zeros(0, np.int64)
    if n < size.match:
        return empty, empty, empty
    bits = np.uint64(n.bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    at = np.arange(n - size.gram + 1)
    _, inverse = powers(n + 1)
    gram = mix((prefix[size.gram:] - prefix[:-size.gram]) * inverse[at])
    # low bits: the place, so that of equal hashes the last one is least
    gram = (gram & ~mask) | (mask - at.astype(np.uint64))
    least = sliding_min(gram, size.window)
    ok = np.zeros(n + 1, np.int8)
    long = np.diff(offsets) >= size.match
    np.add.at(ok, offsets[:-1][long], 1)
    np.add.at(ok, offsets[1:][long] - size.match + 1, -1)
    x = np.flatnonzero(np.cumsum(ok[:len(least)], dtype=np.int8))
    if not len(x):
        return empty, empty, empty
    anchor = (mask - (least[x] & mask)).astype(np.int64)
    change = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    last = np.concatenate((change[1:], [len(x)])) - 1
    return anchor[change], x[change], x[last]


def records(data, prefix, batch, rows, start, end, ref, span=None) -> pa.RecordBatch:
    """Suffix records of the byte ranges given; ``rows`` are rows of the batch."""
    lead = np.zeros(len(start), np.uint64)
    for k in range(LEAD):
        lead |= data[start + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    lead ^= np.uint64(1 << 63)  # signed order is byte order
    own = pa.array(rows)
    key = [pa.array(lead.view(np.int64)), pa.array(slice_hash(prefix, start, end).view(np.int64))]
    place = [batch.column(0).take(own), batch.column(1).take(own), pa.array(ref.astype(np.int64))]
    if span is None:
        return pa.RecordBatch.from_arrays([*key, *place], names=list(KEY))
    return pa.RecordBatch.from_arrays([*key, pa.array(span.view(np.int64)), *place], names=list(GROUP_KEY))


def text_runs(batch):
    """Of each run of rows: first row, bytes, offsets, prefix hash (text is column 2)."""
    data, offsets = text_buffers(batch.column(2))
    for lo, hi in row_runs(offsets):
        own = offsets[lo:hi + 1]
        part = data[own[0]:own[-1]]
        yield lo, hi, part, own - own[0], prefix_hash(part)


def listed(column, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Row (from 0) and value of the entries of rows lo..hi-1 of a list column."""
    part = column.slice(lo, hi - lo)
    size = part.value_lengths().fill_null(0).to_numpy()
    return np.repeat(np.arange(hi - lo), size), part.flatten().to_numpy()


def unpack_zone(ref: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start packed in a zone's reference."""
    anchor = ref & ((1 << 40) - 1)
    return anchor, anchor - (ref >> 50), anchor - ((ref >> 40) & 1023)


def zone_records(size: Lengths):
    """A record for each zone: core after the anchor, span of all its windows."""
    def run(batches):
        for batch in batches:
            for lo, _, data, offsets, prefix in text_runs(batch):
                p, x1, x2 = zones(prefix, offsets, size)
                if not len(p):
                    continue
                row = np.searchsorted(offsets, p, side="right") - 1
                ref = (p - offsets[row]) | ((p - x2) << 40) | ((p - x1) << 50)
                yield records(data, prefix, batch, lo + row, p, p + size.core, ref, slice_hash(prefix, x1, x2 + size.match))
    return run


def block_records(size: Lengths):
    """A record for each block of the open zones (column 3)."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets, prefix in text_runs(batch):
                row, ref = listed(batch.column(3), lo, hi)
                if not len(ref):
                    continue
                anchor, x1, x2 = unpack_zone(ref)
                low, high = (anchor - x2) // STEP, (anchor - x1) // STEP
                count = high - low + 1
                j = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                last = np.repeat(anchor, count) - STEP * j
                row, last = np.unique(np.stack((np.repeat(row, count), last)), axis=1)
                length = np.diff(offsets)[row]
                ok = last - STEP + 1 + size.match <= length
                row, last, length = row[ok], last[ok], length[ok]
                if not len(row):
                    continue
                at = offsets[row]
                # a block that the text's end cuts has no span; its own place keeps it apart from all others
                span = mix(batch.column(0).take(pa.array(lo + row)).to_numpy().view(np.uint64) ^ last.astype(np.uint64))
                whole = last + size.match <= length
                span[whole] = slice_hash(prefix, (at + np.maximum(last - STEP + 1, 0))[whole], (at + last + size.match)[whole])
                yield records(data, prefix, batch, lo + row, at + last, at + last - STEP + 1 + size.match, last, span)
    return run


def window_records(size: Lengths):
    """A record for each window of the open blocks (column 3)."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets, prefix in text_runs(batch):
                row, last = listed(batch.column(3), lo, hi)
                x = (last[:, None] - np.arange(STEP)).ravel()
                row = np.repeat(row, STEP)
                ok = (x >= 0) & (x + size.match <= np.diff(offsets)[row])
                row, x = row[ok], x[ok]
                if len(x):
                    row, x = np.unique(np.stack((row, x)), axis=1)
                    yield records(data, prefix, batch, lo + row, offsets[row] + x, offsets[row] + x + size.match, x)
    return run


def judge_groups(table: pa.RecordBatch, first_cut: bool, last_cut: bool):
    """Sorted records with their state: 0 open, 1 settled as repeated, 2 settled and a
    witness.  Records whose core is unique are left out.  Where the first or last
    group may go on outside the table (a range's end), what cannot be told is open."""
    n = table.num_rows
    lead, digest, span = (table.column(i).to_numpy() for i in range(3))
    same_core = (lead[1:] == lead[:-1]) & (digest[1:] == digest[:-1])
    same_span = same_core & (span[1:] == span[:-1])
    core = np.concatenate(([first_cut], same_core)) | np.concatenate((same_core, [last_cut]))
    settled = np.concatenate(([False], same_span)) | np.concatenate((same_span, [False]))
    group = np.cumsum(np.concatenate(([0], ~same_core)))
    open_group = np.bincount(group, core & ~settled, minlength=group[-1] + 1) > 0
    if first_cut:
        open_group[0] = True
    if last_cut:
        open_group[-1] = True
    head = settled & ~np.concatenate(([False], same_span)) & open_group[group]
    at = np.flatnonzero(core)
    state = np.where(head, 2, np.where(settled, 1, 0)).astype(np.int32)[at]
    own = table.take(pa.array(at))
    return pa.RecordBatch.from_arrays([own.column(3), own.column(4), own.column(5), pa.array(state)], names=["h1", "h2", "ref", "state"])


#: Records of one group that a task holds at a time.
GROUP_ROWS = 100_000


def compare_groups(batches):
    """``judge_groups`` over a sorted range; the last group waits for the next batch."""
    held, cut = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = batch if held is None else pa.Table.from_batches([held, pa.RecordBatch.from_arrays(batch.columns, schema=held.schema)]).combine_chunks().to_batches()[0]
        lead, digest = table.column(0).to_numpy(), table.column(1).to_numpy()
        last = table.num_rows - int(np.argmax(((lead != lead[-1]) | (digest != digest[-1]))[::-1])) if (lead[0] != lead[-1] or digest[0] != digest[-1]) else 0
        if last:
            yield judge_groups(table.slice(0, last), cut, False)
            cut = False
            held = table.slice(last)
        else:
            held = table
        if held.num_rows > GROUP_ROWS:
            yield judge_groups(held, True, True)
            held, cut = None, True
    if held is not None:
        yield judge_groups(held, cut, True)


def compare_neighbours(batches):
    """Of sorted records: those whose key a neighbour has (state 0), and the first
    and last of the range, state 1 if no neighbour in the range has the key, else 2."""
    names = [*KEY, "state"]
    held, before, first = None, False, True

    def out(table, state):
        return pa.RecordBatch.from_arrays([*table.columns, pa.array(state.astype(np.int32))], names=names)

    def settle(table, same, last):
        """Rows of the table are settled but for the last one, unless nothing follows."""
        nonlocal first
        n = table.num_rows
        repeated = np.concatenate(([before], same)) | np.concatenate((same, [False]))
        upto = n if last else n - 1
        if upto:
            hit = np.flatnonzero(repeated[:upto])
            if len(hit):
                yield out(table.take(pa.array(hit)), np.zeros(len(hit)))
            ends = ([0] if first else []) + ([n - 1] if last and (n > 1 or not first) else [])
            for at in ends:
                yield out(table.slice(at, 1), np.array([2 if repeated[at] else 1]))
            first = False

    for batch in batches:
        if not batch.num_rows:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, names=list(KEY))
        table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        lead, digest = table.column(0).to_numpy(), table.column(1).to_numpy()
        same = (lead[1:] == lead[:-1]) & (digest[1:] == digest[:-1])
        yield from settle(table, same, False)
        before = bool(same[-1]) if len(same) else before
        held = table.slice(table.num_rows - 1, 1)
    if held is not None:
        yield from settle(held, np.zeros(0, bool), True)


def repeatedly(found: DataFrame) -> DataFrame:
    """(h1, h2, refs): the records whose key another record has, by text."""
    ranges = found.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    compared = ranges.mapInArrow(compare_neighbours, RECORD + ", state int")
    inside = compared.where("state = 0").select("h1", "h2", "ref")
    # at most two rows of a range: a key that two ranges end with is repeated
    across = (compared.where("state > 0").groupBy("lead", "digest")
              .agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("state") == 1, F.struct("h1", "h2", "ref"))).alias("own"))
              .where("n > 1").select(F.explode("own").alias("o")).select("o.h1", "o.h2", "o.ref"))
    return inside.unionByName(across).groupBy("h1", "h2").agg(F.collect_list("ref").alias("refs"))


def sifted(found: DataFrame) -> DataFrame:
    """(h1, h2, settled, open): by text, the records settled as repeated, and those to look into."""
    ranges = found.repartitionByRange(*GROUP_KEY).sortWithinPartitions(*GROUP_KEY)
    judged = ranges.mapInArrow(compare_groups, "h1 long, h2 long, ref long, state int")
    return judged.groupBy("h1", "h2").agg(
        F.collect_list(F.when(F.col("state") > 0, F.col("ref"))).alias("settled"),
        F.collect_list(F.when(F.col("state") != 1, F.col("ref"))).alias("open"))


def removed_spans(size: Lengths, length: int, zone, block, window) -> np.ndarray:
    """Merged byte ranges to remove from a text of so many bytes."""
    parts = []
    if len(zone):
        _, x1, x2 = unpack_zone(zone)
        parts.append(np.stack((x1, x2 + size.match)))
    if len(block):
        parts.append(np.stack((np.maximum(block - STEP + 1, 0), block + size.match)))
    if len(window):
        parts.append(np.stack((window, window + size.match)))
    if not parts:
        return np.zeros((0, 2), np.int64)
    spans = np.concatenate(parts, axis=1)
    spans = spans[:, np.argsort(spans[0], kind="stable")]
    reach = np.maximum.accumulate(spans[1])
    new = np.flatnonzero(np.concatenate(([True], spans[0][1:] > reach[:-1])))
    return np.stack((spans[0][new], np.concatenate((reach[new[1:] - 1], reach[-1:]))), axis=1)


def cut(size: Lengths):
    """Columns: h1, h2, text, rows that hold it, repeated zones, blocks, windows."""
    names = ["h1", "h2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(2))
            copies = batch.column(3).to_numpy()
            lists = []
            for c in (4, 5, 6):
                row, value = listed(batch.column(c), 0, batch.num_rows)
                lists.append((np.searchsorted(row, np.arange(batch.num_rows + 1)), value))
            n_removed, n_spans, sha, all_spans = [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i]:offsets[i + 1]]
                if copies[i] > 1 and len(text) >= size.match:
                    spans = np.array([[0, len(text)]])
                else:
                    spans = removed_spans(size, len(text), *(v[a[i]:a[i + 1]] for a, v in lists))
                digest, at = hashlib.sha256(), 0
                for a, b in spans:
                    digest.update(text[at:a])
                    at = b
                digest.update(text[at:])
                n_removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
                n_spans.append(len(spans))
                sha.append(digest.hexdigest())
                all_spans.append([{"start": int(a), "end": int(b)} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(offsets)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(all_spans, span_type)], names=names)
    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte ranges removed) of every row."""
    size = Lengths(min_bytes)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumns({"h1": F.xxhash64("t"), "h2": F.xxhash64(F.lit("second"), "t")})
    # the different texts; copies meet before the shuffle
    texts = rows.groupBy("h1", "h2").agg(F.max("t").alias("t"), F.count(F.lit(1)).alias("n"))
    long = texts.where(F.octet_length("t") >= min_bytes).select("h1", "h2", "t")
    key = ["h1", "h2"]

    zone = sifted(long.mapInArrow(zone_records(size), GROUP_RECORD))
    block = sifted(long.join(zone.select(*key, "open"), key).select(*key, "t", "open").mapInArrow(block_records(size), GROUP_RECORD))
    window = repeatedly(long.join(block.select(*key, "open"), key).select(*key, "t", "open").mapInArrow(window_records(size), RECORD))
    judged = (texts.join(zone.select(*key, F.col("settled").alias("z")), key, "left")
              .join(block.select(*key, F.col("settled").alias("b")), key, "left")
              .join(window.select(*key, F.col("refs").alias("w")), key, "left")
              .select(*key, "t", "n", "z", "b", "w")
              .mapInArrow(cut(size), "h1 long, h2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                     "spans array<struct<start:long,end:long>>"))
    return (rows.select("doc_id", "h1", "h2").join(judged, key)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"))
