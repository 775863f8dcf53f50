"""Document fingerprints by invertible Bloom lookup sketches.

A text is cut into paragraphs by its content: between two words whose common hash
is 0 modulo a number that grows with the text's length class.  A cut depends only on
the words beside it, so an edit anywhere leaves the paragraphs elsewhere as they are.
Each text is cut twice, for its own class and for the next one, so texts of neighbouring
classes are compared by the cuts that both have.  Each different paragraph is hashed to a digest, and every digest is
added to one cell in each of ``PARTS`` parts of a small table: a cell holds the
number of its digests, their XOR, and the XOR of their check hashes.  The tables
of two texts subtract cell by cell; what both share cancels out.  Peeling then
takes a digest out of every cell that holds just one, until the table is empty:
the digests that differ are recovered.  If cells are left over, both texts are
sketched again, larger: into tables of the same form, as many as the paragraphs
need, then four times as many; a table that still fails gives way to the exact
difference.

Everything is DataFrame expressions.  A document's successor is found by a
window within ranges of ids; each range gets the first row of the next one, so
no window spans the table.

Defined results: texts more than a class apart (4 to 16 times as long) have no
paragraph in common; null counts as the empty text, without paragraphs; two texts
without paragraphs are alike (1.0); ids must be numbers, null ids come last, rows
with equal or null ids are ordered by a hash of the text, then the text; repeated
rows follow each other; the only
row of a table is its own successor; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a table; cells of a part in a fingerprint and in the tables of a larger sketch (powers of two).
PARTS, CELLS, MORE_CELLS = 4, 4, 8
#: A word and the space after it.  Characters of scripts that are written without spaces are words.
SPACE, SINGLE = r" \t\n\x0B\f\r", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\U0010ffff"
WORD = f"(?:[^{SPACE}{SINGLE}]+|[{SINGLE}])[{SPACE}]*|[{SPACE}]+"
#: Characters from which a text is in the next class, and of how many gaps between words one is a cut
#: in each class (each divides the next, so a cut of a class is one of all classes before).  The short
#: classes have more cuts, or the half that an edit keeps might hold no whole paragraph.
CLASSES = tuple(64 * 4 ** i for i in range(10))
ONE_IN = (1, 1, 4, *(32 * 4 ** i for i in range(9)))
#: Differing digests that a table of a larger sketch is made for.
LOAD = 12
#: Rounds of peeling before a sketch counts as failed.
ROUNDS = 8
#: Segments of the id range by quantiles, and rows that a range is made for.
SEGMENTS, RANGE_ROWS = 64, 16_384


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cut(text: Column) -> Column:
    """struct(level, fine, coarse, fine_cells, coarse_cells): a text's length class, its
    different paragraph digests for that class and the next one, and their cells."""
    def level_of(length: Column) -> Column:
        return sum(((length >= n).cast("int") for n in CLASSES), F.lit(0))

    def one_in(level: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, ONE_IN)), level + 1)

    def digests(words: Column, starts: Column) -> Column:
        return F.array_distinct(F.transform(starts, lambda a, j: F.xxhash64(
            F.slice(words, a + 1, F.coalesce(F.get(starts, j + 1), F.size(words)) - a))))

    def paragraphs(words: Column, level: Column) -> Column:
        def cuts(places: Column, k: Column) -> Column:
            return F.filter(places, lambda i: (i == 0) | (F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), k) == 0))

        places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
        # numbers that every gap is compared with are worked out once for each text
        return let(F.struct(one_in(level).alias("a"), one_in(level + 1).alias("b")), lambda k: let(cuts(places, k["a"]), lambda fine: F.struct(
            level.alias("level"), digests(words, fine).alias("fine"), let(cuts(fine, k["b"]), lambda coarse: digests(words, coarse)).alias("coarse"))))

    def with_cells(p: Column) -> Column:
        return let(F.transform(F.array(p["fine"], p["coarse"]), lambda d: let(items(d, 1, CELLS), lambda i: sketch(i, CELLS))), lambda cells: F.struct(
            p["level"].alias("level"), p["fine"].alias("fine"), p["coarse"].alias("coarse"), cells[0].alias("fine_cells"), cells[1].alias("coarse_cells")))

    words = F.struct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"), level_of(F.length(text)).alias("level"))
    return let(let(words, lambda w: paragraphs(w["words"], w["level"])), with_cells)


def alike_level(a: str, b: str, field: str) -> Column:
    """Of the text ``a`` what compares with ``b``: its coarser cuts where it is of a lower class."""
    return F.when(F.col(a)["level"] < F.col(b)["level"], F.col(a)[f"coarse{field}"]).otherwise(F.col(a)[f"fine{field}"])


def check(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest), 32)


def item(sign: Column, digest: Column, cells: int) -> Column:
    """A signed digest with its check hash and its cell in each part (numbered through)."""
    return F.struct(sign.cast("int").alias("sign"), digest.alias("digest"), check(digest).alias("check"), *[
        (F.shiftrightunsigned(digest, 12 * r).bitwiseAND(F.lit(cells - 1).cast("long")).cast("int") + r * cells).alias(f"c{r}") for r in range(PARTS)])


def items(digests_: Column, sign: int, cells: int) -> Column:
    return F.transform(digests_, lambda d: item(F.lit(sign), d, cells))


def add(cell: Column, sign: Column, i: Column) -> Column:
    return F.struct((cell["n"] + sign).alias("n"), cell["key"].bitwiseXOR(i["digest"]).alias("key"),
                    cell["check"].bitwiseXOR(i["check"]).alias("check"))


def sketch(items_: Column, cells: int) -> Column:
    """The cells of items, part by part."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))

    def part(r: int) -> Column:
        return F.transform(F.sequence(F.lit(r * cells), F.lit((r + 1) * cells - 1)), lambda j: F.aggregate(
            F.filter(items_, lambda i: i[f"c{r}"] == j), nothing, lambda c, i: add(c, i["sign"], i)))

    return F.concat(*map(part, range(PARTS)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"),
                                                  x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(table: Column, cells: int) -> Column:
    """struct(done, found): whether the table came out empty, and the signed digests taken out."""
    nothing = F.array().cast("array<struct<sign:int,digest:bigint>>")

    def step(state, _):
        single = F.filter(state["cells"], lambda c: ((c["n"] == 1) | (c["n"] == -1)) & (c["check"] == check(c["key"])))
        keys = F.transform(F.array_distinct(F.transform(single, lambda c: F.struct(c["n"].alias("sign"), c["key"].alias("digest")))),
                           lambda k: item(k["sign"], k["digest"], cells))

        def removed(k):
            # a round that finds nothing is the last one that does any work
            return F.when(F.size(k) == 0, F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("live"))).otherwise(F.struct(
                subtract(state["cells"], sketch(k, cells)).alias("cells"),
                F.concat(state["found"], F.transform(k, lambda x: F.struct(x["sign"].alias("sign"), x["digest"].alias("digest")))).alias("found"),
                F.lit(True).alias("live")))

        return F.when(state["live"], let(keys, removed)).otherwise(state)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)),
                      F.struct(table.alias("cells"), nothing.alias("found"), F.lit(True).alias("live")), step)
    return let(end, lambda s: F.struct(
        F.forall(s["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)).alias("done"), s["found"].alias("found")))


def larger(items_: Column, tables: Column) -> Column:
    """``peel`` of a sketch of so many tables; a digest's high bits choose its table."""
    parts = F.transform(F.sequence(F.lit(0).cast("long"), tables - 1), lambda g: let(
        F.filter(items_, lambda i: F.pmod(F.shiftrightunsigned(i["digest"], 48), tables) == g),
        lambda own: peel(sketch(own, MORE_CELLS), MORE_CELLS)))
    return let(parts, lambda p: F.struct(F.forall(p, lambda x: x["done"]).alias("done"), F.flatten(F.transform(p, lambda x: x["found"])).alias("found")))


def signed(digests_: Column, sign: int) -> Column:
    return F.transform(digests_, lambda d: F.struct(F.lit(sign).alias("sign"), d.alias("digest")))


def with_difference(rows: DataFrame, name: str, a: str, b: str, cells_a: str, cells_b: str) -> DataFrame:
    """Add column ``name``: the signed digests in which two texts differ (1: only the
    first has it), from the columns of their digests and cells.  The attempts are
    columns of their own, so that each is evaluated once, and later ones only on failure."""
    first, both, second, third = (f"{name}_{k}" for k in range(4))
    tables = F.ceil((F.size(a) + F.size(b)) / LOAD).cast("long")
    rows = rows.withColumn(first, peel(subtract(F.col(cells_a), F.col(cells_b)), CELLS))
    rows = rows.withColumn(both, F.when(~F.col(first)["done"], F.concat(items(F.col(a), 1, MORE_CELLS), items(F.col(b), -1, MORE_CELLS))))
    rows = rows.withColumn(second, F.when(~F.col(first)["done"], larger(F.col(both), tables)))
    rows = rows.withColumn(third, F.when(~F.col(second)["done"], larger(F.col(both), tables * 4)))
    exact = F.concat(signed(F.array_except(a, b), 1), signed(F.array_except(b, a), -1))
    found = (F.when(F.col(first)["done"], F.col(first)["found"]).when(F.col(second)["done"], F.col(second)["found"])
             .when(F.col(third)["done"], F.col(third)["found"]).otherwise(exact))
    return rows.withColumn(name, found).drop(first, both, second, third)


def likeness(a: Column, b: Column, differing: Column) -> Column:
    """Share of the paragraphs of both texts that are common to them."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(1.0 - F.size(differing) / total)


def text_form(of: str) -> Column:
    """A cut text's class and cells as text: count, key and check of each."""
    def cells(field: str) -> Column:
        return F.array_join(F.transform(F.col(of)[field], lambda c: F.concat_ws(".", c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"]))), " ")

    return F.concat_ws("/", F.col(of)["level"].cast("string"), cells("fine_cells"), cells("coarse_cells"))


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, t -> doc_id, t, own (its ``cut``), next_t and next: text and cut of the next
    document by descending id (after the last one: of the first)."""
    docs = docs.withColumn("place", F.shiftrightunsigned(F.xxhash64("t"), 32))
    n_rows, n_ids = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    bounds = docs.select(F.col("doc_id").cast("double").alias("d")).stat.approxQuantile("d", [i / SEGMENTS for i in range(SEGMENTS + 1)], 0.002)
    bounds = sorted(set(bounds))
    if len(bounds) < 2:
        bucket = F.when(F.col("doc_id").isNotNull(), F.lit(0).cast("long"))
    else:
        # within a segment, ranges of equal width
        parts = max(1, -(-n_ids // (len(bounds) * range_rows)))
        edges = F.array(*map(F.lit, bounds[:-1]))
        ends = F.array(*map(F.lit, bounds[1:]))
        place = F.greatest(F.size(F.filter(edges, lambda b: b <= F.col("doc_id"))), F.lit(1))
        inside = (F.col("doc_id") - F.element_at(edges, place)) / (F.element_at(ends, place) - F.element_at(edges, place))
        part = F.least(F.greatest(F.floor(inside * parts), F.lit(0).cast("long")), F.lit(parts - 1).cast("long"))
        bucket = place * parts + part
    # rows without an id: ranges of the hash, below all others
    split = max(1, -(-(n_rows - n_ids) // range_rows))
    bucket = F.when(F.col("doc_id").isNull(), F.shiftright(F.col("place") * split, 32) - split).otherwise(bucket)
    rows = docs.withColumn("bucket", bucket)
    own = F.struct("doc_id", "place", "t")
    first = rows.groupBy("bucket").agg(F.max(own).alias("first"))
    # a row for each range: the first row of the next one down (the order of the ranges is found from their numbers alone)
    down = Window.orderBy(F.desc("bucket"))
    after = rows.select("bucket").distinct().select("bucket", F.coalesce(F.lead("bucket").over(down), F.first("bucket").over(down)).alias("of"))
    follows = (after.join(first.select(F.col("bucket").alias("of"), "first"), "of").select("first.doc_id", "first.place", "first.t", "bucket")
               .withColumn("borrowed", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("borrowed", F.desc_nulls_last("doc_id"), F.desc("place"), F.desc("t"))
    # texts are cut after their shuffle: the digests need not travel
    dealt = rows.withColumn("borrowed", F.lit(False)).unionByName(follows).repartition("bucket").withColumn("own", cut(F.col("t")))
    return (dealt.withColumn("next", F.lead(F.struct("t", "own")).over(order)).where(~F.col("borrowed"))
            .select("doc_id", "t", "own", F.col("next.t").alias("next_t"), F.col("next.own").alias("next")))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, differing_edited (signed digests in which the edited text differs)."""
    rows = with_next(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")), range_rows)
    half = F.floor(F.length("t") / 2).cast("int")
    rows = rows.withColumn("edited_t", F.concat(F.substring("t", F.lit(1), F.length("t") - half), F.substring("next_t", F.lit(1), half)))
    rows = rows.select("doc_id", F.length("t").cast("long").alias("n_chars"), F.sha2("edited_t", 256).alias("edited_sha256"),
                       "own", cut(F.col("edited_t")).alias("edited"), "next")
    for other in ("edited", "next"):
        sides = {"a": ("own", other), "b": (other, "own")}
        for side, of in sides.items():
            rows = rows.withColumn(f"{other}_{side}", alike_level(*of, "")).withColumn(f"{other}_cells_{side}", alike_level(*of, "_cells"))
        rows = with_difference(rows, f"differing_{other}", f"{other}_a", f"{other}_b", f"{other}_cells_a", f"{other}_cells_b")
        rows = rows.withColumn(f"near_{other}", likeness(F.col(f"{other}_a"), F.col(f"{other}_b"), F.col(f"differing_{other}")))
    return rows.select("doc_id", "n_chars", "edited_sha256", text_form("own").alias("fingerprint"), text_form("edited").alias("edited_fingerprint"),
                       "near_edited", "near_next", "differing_edited")


def fingerprint_report(docs: DataFrame, **options) -> DataFrame:
    return fingerprints(docs, **options).drop("differing_edited")
