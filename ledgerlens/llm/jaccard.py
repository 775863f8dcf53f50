"""N-gram Jaccard join with Bayesian candidate pruning.

Documents with the same set of word shingles form a class.  Classes that share a
band of MinHash values are compared: their values are read a few at a time, and
a pair is dropped as soon as the posterior probability that its similarity
reaches the threshold falls below a tolerance.  The pairs left connect classes
into candidate groups, and within a group every pair is verified exactly on the
shingle sets.

No pair is ever written out.  A bucket or group with many members is dealt in
blocks of members, every two blocks meet in one task, and a task returns one row
per member (its links there, the least member it is linked with).

Defined results: words are runs of letters A-Z (either case), digits and all
non-ASCII characters; a document of fewer words than a shingle has one shingle,
of all its words; one without words (null, empty, punctuation) has no links and
is a class of its own.  Repeated rows are members of one class and linked to
each other.  Null ids are passed through and never represent a class unless all
its ids are null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.graph import components
from ledgerlens.llm.textops import mix, row_starts, text_chunks, words
from ledgerlens.session import scratch_root

#: Words of a shingle, and the similarity from which two documents are linked.
SHINGLE, THRESHOLD = 5, (4, 5)
#: MinHash values; the first BANDS * BAND of them make the bands.  A pair at the
#: threshold shares no band with probability (1 - 0.8 ** 4) ** 24 = 3e-6.
VALUES, BANDS, BAND = 128, 24, 4
#: Values compared at a time, and the posterior probability below which a pair is dropped.
AT_A_TIME, TOLERANCE = 16, 1e-6
#: Members of a block of a bucket; members and shingles of a block of a group.
BLOCK, GROUP_BLOCK, GROUP_SHINGLES = 1024, 256, 400_000
#: Bits of the filter of classes whose shingles are wanted: 2 MB, whatever the data.
FILTER_BYTES = 3

_rng = np.random.default_rng(7)
MULTIPLY = _rng.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, VALUES, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the different shingles of each row, sorted."""
    n = len(offsets) - 1
    _, _, _, row, h = words(data, offsets)
    first = row_starts(row, n)
    count = np.diff(first)
    parts_row, parts = [], []
    if len(h) >= size:
        own = np.zeros(len(h) - size + 1, np.uint64)
        for k in range(size):
            own = own * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - size + 1 + k]
        inside = row[:len(own)] == row[size - 1:]
        parts_row.append(row[:len(own)][inside])
        parts.append(mix(own[inside]))
    for doc in np.flatnonzero((count > 0) & (count < size)):
        own = np.uint64(count[doc])
        with np.errstate(over="ignore"):
            for x in h[first[doc]:first[doc + 1]]:
                own = own * np.uint64(0x9E3779B97F4A7C15) + x
        parts_row.append(np.array([doc]))
        parts.append(mix(np.array([own], np.uint64)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row, value = np.concatenate(parts_row), np.concatenate(parts)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.concatenate(([True], (value[1:] != value[:-1]) | (row[1:] != row[:-1]))) if len(row) else np.zeros(0, bool)
    return row[new], value[new]


def class_keys(first: np.ndarray, value: np.ndarray) -> list[bytes | None]:
    """Digest of each row's shingle set; none without shingles."""
    return [hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(first[:-1], first[1:])]


def signatures(first: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row with shingles: its band hashes, and a byte of each MinHash value."""
    some = np.flatnonzero(np.diff(first))
    start = first[some]
    least = np.empty((len(some), VALUES), np.uint64)
    work = np.empty_like(value)
    for k in range(VALUES):
        np.multiply(value, MULTIPLY[k], out=work)
        np.add(work, ADD[k], out=work)
        least[:, k] = np.minimum.reduceat(work, start)
    least = mix(least)
    bands = np.zeros((len(some), BANDS), np.uint64)
    for k in range(BAND):
        bands = mix(bands * np.uint64(31) + least[:, k:BANDS * BAND:BAND] + np.arange(BANDS, dtype=np.uint64))
    return bands.view(np.int64), (least & np.uint64(255)).astype(np.uint8)


def sketch_rows(size: int, keep: int):
    """For batches of ``keep`` columns and the text: those columns, class key,
    shingles, bands, signature."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(keep)):
                n = hi - lo
                row, value = shingles(data, offsets, size)
                first = row_starts(row, n)
                some = np.diff(first) > 0
                bands = pa.nulls(n, pa.list_(pa.int64()))
                signature = pa.nulls(n, pa.binary())
                if some.any():
                    own, sig = signatures(first, value)
                    at = np.cumsum(some) - 1
                    take = pa.array(np.where(some, at, 0), mask=~some)
                    bands = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * BANDS), pa.array(own.ravel())).take(take)
                    signature = pa.array([s.tobytes() for s in sig], pa.binary()).take(take)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, n) for i in range(keep)], pa.array(class_keys(first, value), pa.binary()),
                     pa.array(np.diff(first).astype(np.int32)), bands, signature],
                    names=[*[f"k{i}" for i in range(keep)], "cid", "n", "bands", "sig"])
    return run


def least_matches(threshold: float) -> list[int]:
    """After 16, 32, ... values: matches below which a pair is dropped.  The prior of
    the similarity is uniform; a byte of unequal values agrees once in 256 times."""
    grid = np.linspace(0, 1, 4001)
    agree = np.clip(grid + (1 - grid) / 256, 1e-12, 1 - 1e-12)
    out = []
    for n in range(AT_A_TIME, VALUES + 1, AT_A_TIME):
        for m in range(n + 1):
            log = m * np.log(agree) + (n - m) * np.log1p(-agree)
            mass = np.exp(log - log.max())
            if mass[grid >= threshold].sum() / mass.sum() >= TOLERANCE:
                break
        out.append(m)
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Which pairs of signature rows pass every comparison."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for step, enough in enumerate(least):
        part = slice(step * AT_A_TIME, (step + 1) * AT_A_TIME)
        matches = matches + (a[alive, part] == b[alive, part]).sum(axis=1)
        ok = matches >= enough
        alive, matches = alive[ok], matches[ok]
        if not len(alive):
            break
    return alive


def whole_groups(batches, n_key: int):
    """Tables of whole groups from sorted batches whose first columns are the key."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, pa.table(table.columns, schema=held.schema)])
        held = held.combine_chunks()
        new = changes(held, n_key)
        last = int(new[-1])
        if last:
            yield held.slice(0, last).combine_chunks(), new[:-1]
            held = held.slice(last)
    if held is not None:
        held = held.combine_chunks()
        yield held, changes(held, n_key)


def changes(table: pa.Table, n_key: int) -> np.ndarray:
    """First rows of the groups."""
    if not table.num_rows:
        return np.zeros(0, np.int64)
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for i in range(n_key):
        column = table.column(i)
        ids = column.dictionary_encode().combine_chunks().indices.to_numpy() if pa.types.is_binary(column.type) else column.to_numpy()
        new[1:] |= ids[1:] != ids[:-1]
    return np.flatnonzero(new)


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def join_roots(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite the trees of a[i] and b[i]; roots stay the least members."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        low, high = np.minimum(ra, rb)[open_], np.maximum(ra, rb)[open_]
        np.minimum.at(parent, high, low)
        parent = roots(parent)


def connect_buckets(least: list[int]):
    """key, i, j, cid, sig (sorted) -> edges to the least member that surviving pairs connect with."""
    def run(batches):
        for table, start in whole_groups(batches, 3):
            n = table.num_rows
            end = np.concatenate((start[1:], [n]))
            stop = np.repeat(end, end - start)
            sig = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint8).reshape(n, VALUES)
            parent = np.arange(n)
            place = np.arange(n)
            for d in range(1, int((end - start).max())):
                a = place[place + d < stop]
                a = a[parent[a] != parent[a + d]]
                if not len(a):
                    # all pairs this far apart are connected or none is left
                    if not (place + d < stop).any():
                        break
                    continue
                ok = a[survivors(sig[a], sig[a + d], least)]
                if len(ok):
                    parent = join_roots(parent, ok, ok + d)
            linked = np.flatnonzero(parent != place)
            if len(linked):
                cid = table.column(3).combine_chunks()
                yield pa.RecordBatch.from_arrays([cid.take(pa.array(linked)), cid.take(pa.array(parent[linked]))], names=["a", "b"])
    return run


def shared_shingles(sets: list[np.ndarray]) -> np.ndarray:
    """Common elements of every two sets."""
    k = len(sets)
    size = np.array([len(s) for s in sets])
    vocabulary, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(k), size)
    out = np.zeros((k, k), np.float64)
    width = max(1, (1 << 22) // k)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for low in range(0, len(vocabulary), width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((k, min(width, len(vocabulary) - low)), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def verify_groups(threshold: tuple[int, int]):
    """root, i, j, cid, block, copies, shingles (sorted) -> of each member its verified
    links here (classes, documents) and the least member it is connected with."""
    up, down = threshold

    def run(batches):
        for table, start in whole_groups(batches, 3):
            end = np.concatenate((start[1:], [table.num_rows]))
            cid, block = table.column(3).combine_chunks(), table.column(4).to_numpy()
            copies = table.column(5).to_numpy()
            i, j = table.column(1).to_numpy(), table.column(2).to_numpy()
            values = table.column(6).combine_chunks()
            for a, b in zip(start, end):
                sets = [np.frombuffer(values[k].as_py(), np.uint64) for k in range(a, b)]
                common = shared_shingles(sets)
                size = np.array([len(s) for s in sets])
                linked = down * common >= up * (size[:, None] + size - common)
                np.fill_diagonal(linked, False)
                if i[a] != j[a]:
                    linked &= block[a:b, None] != block[a:b]
                x, y = np.nonzero(linked)
                parent = join_roots(np.arange(b - a), x, y)
                yield pa.RecordBatch.from_arrays(
                    [cid.slice(a, b - a), cid.slice(a, b - a).take(pa.array(parent)), pa.array(linked.sum(1)), pa.array((linked * copies[a:b]).sum(1))],
                    names=["a", "b", "classes", "documents"])
    return run


def dealt(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Deal the members of each group into ``blocks`` blocks; every two blocks meet
    under (key, i, j), as does each block with itself (i = j)."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    return (rows.withColumn("block", F.pmod(F.xxhash64("cid"), F.col(blocks)).cast("int"))
            .withColumn("other", other)
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))


def filter_bits(cid: DataFrame) -> np.ndarray:
    """A bit for each value of the first bytes of a class key: set where one has it."""
    at = F.conv(F.hex(F.substring("cid", 1, FILTER_BYTES)), 16, 10).cast("long")
    bits = np.zeros(1 << (8 * FILTER_BYTES), bool)
    rows = (cid.select(at.alias("at")).groupBy((F.col("at") / 32768).cast("int").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")))
    for r in rows.collect():  # 512 rows of 4 kB at most
        bits[r["bucket"] * 32768:(r["bucket"] + 1) * 32768] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little").astype(bool)
    return bits


def wanted_shingles(docs: DataFrame, wanted, size: int) -> DataFrame:
    """(cid, shingles) of the classes that the filter lets pass, once for each."""
    def run(batches):
        seen: set[bytes] = set()
        bits = np.unpackbits(wanted.value)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(0)):
                row, value = shingles(data, offsets, size)
                first = row_starts(row, hi - lo)
                keys, values = [], []
                for i, key in enumerate(class_keys(first, value)):
                    if key is not None and key not in seen and bits[int.from_bytes(key[:FILTER_BYTES], "big")]:
                        seen.add(key)
                        keys.append(key)
                        values.append(value[first[i]:first[i + 1]].tobytes())
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["cid", "shingles"])

    return docs.select("t").mapInArrow(run, "cid binary, shingles binary").groupBy("cid").agg(F.max("shingles").alias("shingles"))


def similarity_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       threshold: tuple[int, int] = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, cid) of every row, and of every class its key ``cid``, its
    ``copies``, its least id ``rep``, its group's key ``root`` and least id ``group_rep``,
    and how many classes and documents it is linked with."""
    spark = docs.sparkSession
    scratch_root(spark)
    source = docs.select(F.col(id_col).alias("k0"), F.col(text_col).alias("t"))
    schema = T.StructType([source.schema.fields[0], T.StructField("cid", T.BinaryType()), T.StructField("n", T.IntegerType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType())])
    sketched = source.mapInArrow(sketch_rows(size, 1), schema).withColumnRenamed("k0", "doc_id").checkpoint()
    classes = (sketched.where("cid is not null").groupBy("cid")
               .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                    F.first("bands").alias("bands"), F.first("sig").alias("sig"))).checkpoint()

    # classes that share a band
    entries = classes.select("cid", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    bucket = (entries.join(shared, "key").join(classes.select("cid", "sig"), "cid")
              .withColumn("blocks", F.ceil(F.col("m") / BLOCK)))
    pairs = (dealt(bucket, "key", "blocks").select("key", "i", "j", "cid", "sig")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "cid"))
    edges = pairs.mapInArrow(connect_buckets(least_matches(threshold[0] / threshold[1])), "a binary, b binary")
    member = components(edges).select(F.col("node").alias("cid"), F.col("root").alias("candidates")).checkpoint()

    # verification within the candidate groups
    wanted = spark.sparkContext.broadcast(np.packbits(filter_bits(member)))
    own = member.join(classes.select("cid", "copies", "n"), "cid")
    total = own.groupBy("candidates").agg(F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_BLOCK, F.sum("n") / GROUP_SHINGLES)).alias("blocks"))
    own = own.join(total, "candidates").join(wanted_shingles(source, wanted, size), "cid")
    pairs = (dealt(own, "candidates", "blocks").select("candidates", "i", "j", "cid", "block", "copies", "shingles")
             .repartition("candidates", "i", "j").sortWithinPartitions("candidates", "i", "j", "cid"))
    verified = pairs.mapInArrow(verify_groups(threshold), "a binary, b binary, classes long, documents long").checkpoint()
    links = verified.groupBy("a").agg(F.sum("classes").alias("class_links"), F.sum("documents").alias("document_links"))
    root = components(verified.select("a", "b"))

    found = (classes.select("cid", "copies", "rep")
             .join(links.withColumnRenamed("a", "cid"), "cid", "left")
             .join(root.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")))
    group = found.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull(), "rep", "cid")).alias("least"))
    found = (found.join(group, "root")
             .select("cid", "copies", "rep", "root", F.col("least.rep").alias("group_rep"), F.col("least.cid").alias("group_cid"),
                     F.coalesce("class_links", F.lit(0)).alias("class_links"), F.coalesce("document_links", F.lit(0)).alias("document_links")))
    return sketched.select("doc_id", "cid"), found


def similarity_join(docs: DataFrame, **options) -> DataFrame:
    """Of every row: doc_id, class_id (least id of the group of documents that links
    connect it with), n_links (documents it is linked with, copies included),
    n_class_links (different shingle sets it is linked with), copies (rows with its
    set) and copy_id (least id of those)."""
    rows, found = similarity_classes(docs, **options)
    joined = rows.join(found, "cid", "left")
    return joined.select(
        "doc_id", F.coalesce("group_rep", "doc_id").alias("class_id"),
        F.coalesce(F.col("document_links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_links", F.lit(0)).cast("long").alias("n_class_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), F.coalesce("rep", "doc_id").alias("copy_id"))


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                      **options) -> DataFrame:
    """The documents, one for each group of linked ones: the least id's.  Documents
    without words all stay."""
    _, found = similarity_classes(docs, id_col=id_col, text_col=text_col, size=size, **options)
    columns = docs.columns
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)], F.col(text_col).alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("cid", T.BinaryType())])
    keep = len(columns)

    def keyed(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(keep)):
                row, value = shingles(data, offsets, size)
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(lo, hi - lo) for i in range(keep)],
                                                  pa.array(class_keys(row_starts(row, hi - lo), value), pa.binary())], names=schema.names)

    rows = source.mapInArrow(keyed, schema)
    own = f"k{columns.index(id_col)}"
    first = found.where("cid = group_cid").select("cid", F.col("rep"))
    # the class that represents the group, in it the least id, of repeated rows one
    kept = rows.join(first, "cid").where(F.col(own).eqNullSafe(F.col("rep"))).drop("rep").dropDuplicates(["cid"])
    return (kept.drop("cid").unionByName(rows.where("cid is null").drop("cid"))
            .select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(columns)]))
