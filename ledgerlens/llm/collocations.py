"""Phrase collocation mining: an FM-index over word ids for each shard.

A shard is a run of documents inside a Spark task.  Its words are numbered, and
the Burrows-Wheeler transforms of the word sequence and of its reverse are kept
side by side: a phrase is an interval in each.  Extending it by a word on its
right is a step in the reverse transform and a shift in the forward one; on its
left, the other way round.  Phrases have three words at most, so suffixes are put
in order by their first three words only: intervals of such phrases and their
extensions need no more.  Counts are summed across shards:

1. all words and pairs of each shard; those with fewer than ``LEAST`` in all go;
2. every pair left is extended to phrases of three words.  A three-word phrase is
   as frequent as ``LEAST`` only if both its pairs are, so shards emit those whose
   pairs are in a bitmap of the frequent pairs.  The bitmap is sized by their
   number, at most ``MAX_BITS``; a pair that is in it by chance costs a row, never
   a result, since the sums decide.

Words are known by 64-bit hashes of language and lower-case text until the end;
two words of one hash are noticed when phrases are spelled and raise.

Defined results: null and empty texts have no words; a null language counts as
``und``; repeated rows count each time; an empty table, or one without frequent
phrases, gives no rows; equally ranked phrases of a language go by their text, so
ranks are never shared; other columns are never read.  A shard holds a longest
document at least, and memory follows that or ``SHARD_WORDS``: a shard goes before
the next one is read, its phrases are extended and written out ``PART`` occurrences
at a time, and texts are kept only where phrases are spelled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.textops import LOWER_ASCII, mix, prefix_hash, row_runs, slice_hash, text_chunks, word_bounds
from ledgerlens.session import scratch_path

#: Fewest occurrences of a candidate.
LEAST = 10
#: A phrase goes when a longer one that holds it has this share (per cent) of its count.
COVERED = 50
#: Phrases returned of each language.
TOP = 2000
#: Most words of a phrase.
DEPTH = 3
#: Words of a shard.
SHARD_WORDS = 1_000_000
#: Occurrences that are extended at a time (one interval at least), and rows written at a time.
PART = 1 << 17
#: Bytes of text hashed at a time.
TEXT_BYTES = 1 << 18
#: Bits of the frequent pairs' bitmap for each pair, and at most (32 MB).
BITS_EACH, MAX_BITS = 16, 1 << 28
#: Scores are whole numbers of this fraction.
SCORE_UNITS = 1_000_000

# Bytes that end a piece, and bytes between words.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\f\r"]] = True
IN_WORD = ~ENDS
IN_WORD[[0x20, 0x09]] = False


# ---- one shard -------------------------------------------------------------

class Transform:
    """Burrows-Wheeler transform of symbols whose last is 0, suffixes ordered by ``depth`` symbols."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int):
        self.n, self.symbols = len(text), symbols
        bits = int(symbols).bit_length()
        if bits * depth <= 63:
            key = text.astype(np.int64)
            for k in range(1, depth):
                key <<= bits
                key[:self.n - k] |= text[k:]
            order = np.argsort(key)
            del key
        else:
            order = np.lexsort([np.concatenate((text[k:], np.zeros(min(k, self.n), text.dtype))) for k in range(depth)][::-1])
        self.bwt = text[order - 1]
        del order
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    @cached_property
    def entries(self) -> np.ndarray:
        """Symbol and place of every entry, in the order of the suffixes that the entries begin."""
        out = self.bwt.astype(np.int64)
        out *= self.n
        out += np.arange(self.n)
        out.sort()
        return out

    @cached_property
    def ends(self) -> np.ndarray:
        """How many entries before each place are no words."""
        return np.concatenate(([0], np.cumsum(self.bwt < 2, dtype=np.int32)), dtype=np.int32)

    def counts(self, low: np.ndarray, count: np.ndarray):
        """Every interval with each symbol before it: (interval, symbol, occurrences)."""
        which = np.repeat(np.arange(len(low)), count)
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(len(which))
        pairs, times = np.unique(which * self.symbols + self.bwt[at], return_counts=True)
        return *np.divmod(pairs, self.symbols), times

    def extensions(self, low: np.ndarray, count: np.ndarray):
        """Every interval with each word before it: (interval, word, occurrences, start of
        the longer phrase's interval, occurrences of the interval under lesser symbols)."""
        which, word, times = self.counts(low, count)
        start = np.searchsorted(self.entries, word * self.n + low[which])
        before = np.cumsum(times) - times
        lesser = before - before[np.searchsorted(which, which)]
        real = word >= 2
        return which[real], word[real], times[real], start[real], lesser[real]

    def extended(self, low: np.ndarray, count: np.ndarray) -> np.ndarray:
        """How many occurrences of each interval have a word before them in their piece."""
        return count - (self.ends[low + count] - self.ends[low])


class Phrases:
    """Phrases of one length: words (a row each), intervals in both transforms, counts."""

    def __init__(self, words: np.ndarray, forward: np.ndarray, backward: np.ndarray, count: np.ndarray):
        self.words, self.forward, self.backward, self.count = words, forward, backward, count

    def only(self, mask: np.ndarray | slice) -> Phrases:
        return Phrases(self.words[mask], self.forward[mask], self.backward[mask], self.count[mask])

    def parts(self) -> Iterator[Phrases]:
        """Consecutive phrases with ``PART`` occurrences at most, one phrase at least."""
        for lo, hi in row_runs(np.concatenate(([0], np.cumsum(self.count))), PART):
            yield self.only(slice(lo, hi))

    @staticmethod
    def joined(parts: list[Phrases]) -> Phrases:
        return Phrases(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("words", "forward", "backward", "count")))


class WordIndex:
    """Both transforms of a shard's pieces (word numbers from 2; 1 stands between pieces)."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int = DEPTH):
        self.text, self.symbols, self.depth = text, symbols, depth

    @cached_property
    def forward(self) -> Transform:
        return Transform(np.append(self.text, self.text.dtype.type(0)), self.symbols, self.depth)

    @cached_property
    def backward(self) -> Transform:
        return Transform(np.append(self.text[::-1], self.text.dtype.type(0)), self.symbols, self.depth)

    def words(self) -> Phrases:
        """All words; their intervals are the same in both transforms."""
        first = self.backward.first
        return Phrases(np.arange(2, self.symbols)[:, None], first[2:-1], first[2:-1], np.diff(first)[2:])

    def right(self, phrases: Phrases) -> Phrases:
        """The phrases with every word that follows them."""
        which, word, count, start, lesser = self.backward.extensions(phrases.backward, phrases.count)
        return self.phrases((phrases.words[which], word), phrases.forward[which] + lesser, start, count)

    def followed(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Words and counts of ``right``, without the intervals."""
        which, word, count = self.backward.counts(phrases.backward, phrases.count)
        real = word >= 2
        return np.column_stack((phrases.words[which[real]], word[real])), count[real]

    def left(self, phrases: Phrases) -> Phrases:
        """The phrases with every word that stands before them."""
        which, word, count, start, lesser = self.forward.extensions(phrases.forward, phrases.count)
        return self.phrases((word, phrases.words[which]), start, phrases.backward[which] + lesser, count)

    def phrases(self, words, *intervals: np.ndarray) -> Phrases:
        """Phrases in the numbers' type of the text."""
        return Phrases(*(x.astype(self.text.dtype, copy=False) for x in (np.column_stack(words), *intervals)))

    def extended(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each phrase with a word on their left, and on their right."""
        return (self.forward.extended(phrases.forward, phrases.count),
                self.backward.extended(phrases.backward, phrases.count))


class Shard:
    """Words of some documents: hashes of language and text, piece starts, words by
    language and, if they are to be spelled, the bytes."""

    def __init__(self, spell: bool = True):
        self.spell = spell
        self.keys: list[np.ndarray] = []
        self.starts_piece: list[np.ndarray] = []
        self.bytes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.languages: list[tuple[list[str], np.ndarray]] = []
        self.totals: dict[str, int] = {}
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, languages: list[str]) -> None:
        low = LOWER_ASCII[data]
        start, end, row = word_bounds(IN_WORD[low], offsets)
        if not len(start):
            return
        own = np.array([language_hash(x) for x in languages], np.uint64)
        self.keys.append(mix(slice_hash(prefix_hash(low), start, end) ^ own[row]).view(np.int64))
        ends = np.concatenate(([0], np.cumsum(ENDS[low])))
        new = np.ones(len(start), bool)
        new[1:] = (row[1:] != row[:-1]) | (ends[start[1:]] > ends[end[:-1]])
        self.starts_piece.append(new)
        if self.spell:  # a text has fewer than 2**31 bytes
            self.bytes.append((low, start.astype(np.int32), end.astype(np.int32)))
            self.languages.append((languages, row.astype(np.int32)))
        for i, n in zip(*np.unique(row, return_counts=True)):
            self.totals[languages[i]] = self.totals.get(languages[i], 0) + int(n)
        self.size += len(start)

    def index(self, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, WordIndex]:
        """Distinct keys, the place of a first occurrence of each, and the index over their
        numbers.  The words' keys are given up."""
        keys, new = np.concatenate(self.keys), np.concatenate(self.starts_piece)
        self.keys, self.starts_piece = [], []
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        head = np.concatenate(([True], keys[1:] != keys[:-1]))
        distinct, first = keys[head], order[head]
        del keys
        number = np.empty(len(order), np.int32)
        number[order] = np.cumsum(head, dtype=np.int32) + 1
        del order
        text = np.ones(len(number) + new.sum() + 1, np.int32)
        at = np.cumsum(new)
        at += np.arange(len(number))
        text[at] = number
        return distinct, first, WordIndex(text, len(distinct) + 2, depth)

    def spelled(self, places: np.ndarray) -> tuple[list[str], list[str]]:
        """Words at places in the shard, and their languages."""
        edges = np.cumsum([0, *(len(start) for _, start, _ in self.bytes)])
        chunk = np.searchsorted(edges, places, side="right") - 1
        words, languages = np.empty(len(places), object), np.empty(len(places), object)
        for c in np.unique(chunk):
            own = np.flatnonzero(chunk == c)
            i = places[own] - edges[c]
            low, start, end = self.bytes[c]
            text = low.tobytes()
            words[own] = [text[a:b].decode("utf-8") for a, b in zip(start[i].tolist(), end[i].tolist())]
            names, row = self.languages[c]
            languages[own] = [names[r] for r in row[i].tolist()]
        return words.tolist(), languages.tolist()


_LANGUAGES: dict[str, int] = {}


def language_hash(name: str) -> int:
    if name not in _LANGUAGES:
        if len(_LANGUAGES) > 10_000:
            _LANGUAGES.clear()
        _LANGUAGES[name] = int.from_bytes(hashlib.blake2b(name.encode("utf-8"), digest_size=8).digest(), "little")
    return _LANGUAGES[name]


def shards(batches: Iterator[pa.RecordBatch], shard_words: int, spell: bool = True) -> Iterator[Shard]:
    """Shards of the task's documents (columns language, text).  Callers drop a shard
    before they ask for the next one."""
    shard = Shard(spell)
    for batch in batches:
        languages = ["und" if x is None else x for x in batch.column(0).to_pylist()]
        for lo, _, data, offsets in text_chunks(batch.column(1)):
            for i, j in row_runs(offsets, TEXT_BYTES):
                shard.add(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], languages[lo + i:lo + j])
            if shard.size >= shard_words:
                yield shard
                shard = Shard(spell)
    if shard.size:
        yield shard


# ---- passes ------------------------------------------------------------------

def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def word_and_pair_counts(source: DataFrame, shard_words: int) -> DataFrame:
    """h1, h2 (null for a word), f: counts of all words and pairs."""
    def counted(shard):
        keys, _, index = shard.index(depth=2)
        words = index.words()
        yield from pa.Table.from_arrays([longs(keys), pa.nulls(len(keys), pa.int64()), longs(words.count)], names=["h1", "h2", "n"]).to_batches(PART)
        for part in words.parts():
            pairs, count = index.followed(part)
            yield pa.RecordBatch.from_arrays([longs(keys[pairs[:, 0] - 2]), longs(keys[pairs[:, 1] - 2]), longs(count)], names=["h1", "h2", "n"])

    def run(batches):
        for shard in shards(batches, shard_words, spell=False):
            yield from counted(shard)
            del shard

    return source.mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("f"))


def pair_places(first: np.ndarray, second: np.ndarray, mask: int) -> list[np.ndarray]:
    """The two places of a pair of hashes in the bitmap."""
    return [(first ^ (second << 1)) & mask, ((first >> 24) ^ (second >> 11)) & mask]


def pair_places_sql(mask: int) -> list[Column]:
    """The same of the columns h1, h2."""
    return [F.expr(f"(h1 ^ shiftleft(h2, 1)) & {mask}L"), F.expr(f"(shiftright(h1, 24) ^ shiftright(h2, 11)) & {mask}L")]


def pair_bitmap(pairs: DataFrame, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bitmap of the pairs: bits for each pair up to ``max_bits`` in all."""
    n = pairs.count()
    bits = min(max_bits, max(1 << 16, 1 << (BITS_EACH * max(n, 1) - 1).bit_length()))
    made = (pairs.select(F.explode(F.array(*pair_places_sql(bits - 1))).alias("place"))
            .groupBy(F.shiftright("place", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63L AS int)))").alias("bits")).toArrow())
    out = np.zeros(bits >> 6, np.int64)
    out[made.column("at").to_numpy()] = made.column("bits").to_numpy()
    return out


def in_bitmap(bitmap: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    both = [bitmap[place >> 6] >> (place & 63) & 1 for place in pair_places(first, second, (len(bitmap) << 6) - 1)]
    return (both[0] & both[1]).astype(bool)


def phrase_rows(source: DataFrame, bitmap, shard_words: int) -> DataFrame:
    """Three rows in one: three-word phrases (h1, h2, h3, n, and how many of the n have a
    word on the left and on the right) whose pairs are in the bitmap, words of such pairs
    (h1, word, lang), and the words of a language (lang, n)."""
    names = ["h1", "h2", "h3", "n", "n_left", "n_right", "word", "lang"]

    def rows(count, **columns):
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[name], kind) if name in columns else pa.nulls(count, kind) for name, kind in zip(names, kinds)], names=names)

    def found(shard, frequent):
        keys, first, index = shard.index()

        def known(phrases):
            """Those whose last two words are in the bitmap."""
            return phrases.only(in_bitmap(frequent, keys[phrases.words[:, -2] - 2], keys[phrases.words[:, -1] - 2]))

        pairs = Phrases.joined([known(index.right(part)) for part in index.words().parts()])
        for part in pairs.parts():
            triples = known(index.right(part))
            left, right = index.extended(triples)
            h = keys[triples.words - 2]
            yield rows(len(h), h1=h[:, 0], h2=h[:, 1], h3=h[:, 2], n=triples.count, n_left=left, n_right=right)
        used = np.unique(pairs.words) - 2
        for i in range(0, len(used), PART):
            own = used[i:i + PART]
            word, language = shard.spelled(first[own])
            yield rows(len(own), h1=keys[own], word=word, lang=language)
        yield rows(len(shard.totals), lang=list(shard.totals), n=list(shard.totals.values()))

    def run(batches):
        for shard in shards(batches, shard_words):
            yield from found(shard, bitmap.value)
            del shard

    return source.mapInArrow(run, "h1 long, h2 long, h3 long, n long, n_left long, n_right long, word string, lang string")


def stored(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(units * a * a / (left * right)), in whole decimals."""
    whole = F.lit(SCORE_UNITS).cast("decimal(7,0)") * a.cast("decimal(15,0)") * a.cast("decimal(15,0)")
    return F.call_function("div", whole.cast("decimal(38,0)"), left.cast("decimal(18,0)") * right.cast("decimal(18,0)"))


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 covered: int = COVERED, top: int = TOP, shard_words: int = SHARD_WORDS,
                 max_bits: int = MAX_BITS) -> DataFrame:
    """The best ``top`` phrases of two or three words of each language: lang, rank, phrase,
    a, l, r, n, score, and of the a occurrences of three words how many go on in their
    piece to the left and to the right (NULL for pairs)."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("t"))
    frequent = stored(word_and_pair_counts(source, shard_words).where(F.col("f") >= least), "phrase-counts")
    pairs = frequent.where("h2 is not null")
    bitmap = spark.sparkContext.broadcast(pair_bitmap(pairs, max_bits))
    found = stored(phrase_rows(source, bitmap, shard_words), "phrases")
    triples = (found.where("h3 is not null").groupBy("h1", "h2", "h3")
               .agg(F.sum("n").alias("a"), F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
               .where(F.col("a") >= least))
    totals = found.where("h1 is null").groupBy("lang").agg(F.sum("n").alias("n"))
    spelled = found.where("word is not null").select("h1", "word", "lang").distinct()
    one = F.count("word") == 1
    words = (spelled.groupBy("h1").agg(F.when(one, F.min("word")).otherwise(F.raise_error(F.lit("two words of one hash"))).alias("word"),
                                       F.min("lang").alias("lang"))
             .join(frequent.where("h2 is null").select("h1", "f"), "h1"))

    def word(i: int) -> DataFrame:
        return words.select(F.col("h1").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"),
                            *([F.col("lang")] if i == 1 else []))

    def pair(i: int) -> DataFrame:
        return pairs.select(F.col("h1").alias(f"h{i}"), F.col("h2").alias(f"h{i + 1}"), F.col("f").alias(f"f{i}{i + 1}"))

    longer = (triples.select(F.explode(F.array(F.struct("h1", "h2", "a"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))).alias("p"))
              .select("p.h1", "p.h2", "p.a").groupBy("h1", "h2").agg(F.max("a").alias("within")))
    kept = (pairs.withColumnRenamed("f", "a").join(longer, ["h1", "h2"], "left")
            .where(F.coalesce(100 * F.col("within") < covered * F.col("a"), F.lit(True))).drop("within"))
    two = kept.join(word(1), "h1").join(word(2), "h2").select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        cut_score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
        F.lit(None).cast("long").alias("n_left"), F.lit(None).cast("long").alias("n_right"))
    cuts = [F.struct(cut_score(F.col("a"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"),
                     F.col(left).alias("l"), F.col(right).alias("r")) for k, (left, right) in enumerate((("f1", "f23"), ("f12", "f3")), 1)]
    three = (triples.join(pair(1), ["h1", "h2"]).join(pair(2), ["h2", "h3"])
             .join(word(1), "h1").join(word(2), "h2").join(word(3), "h3")
             .withColumn("cut", F.least(*cuts))
             .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score", "n_left", "n_right"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"),
        "n_left", "n_right")
