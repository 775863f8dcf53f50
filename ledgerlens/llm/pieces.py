"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

A merge-type model starts from single characters and joins the adjacent pair
whose joined piece scores highest, leftmost first, until no pair can be joined.
The same pieces are found here without a merge queue:

* an Aho-Corasick automaton over the pieces names the longest one at a position;
  each piece knows the next shorter one that it begins with;
* the longest piece is taken if it is compatible with the one before it: the two
  joined texts, merged anew, must come apart into just these two;
* if no piece fits at a position, no merging of the text has a cut there: the
  position's bit is set, the piece before is taken back and a shorter one tried.

Every part of a merged text is merged as it would be alone, and pieces that are
compatible in pairs are compatible as a whole, so what is found is what the
merging gives.  Pieces that merging never reaches are left out of the automaton.
A character that is no piece of its own becomes the ids of its UTF-8 bytes.

The text is cut before every run of word marks that follows another character
when no piece reaches over such a place (``cuts_at_marks``); the cuts then meet
no merge, nor does one between characters that are neighbours in no piece.  Equal
cuts are encoded once for as long as a worker remembers them.

Defined results: null counts as empty and has no ids; repeated rows each get
theirs; an empty table gives no rows; very long texts are encoded whole, in
memory that follows the longest text; other columns are never read.  Models must
be merge-type with byte pieces and without unused pieces; others raise.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The mark that stands for a space in pieces (fixed by the library).
MARK = "▁"
#: The score of a pair that is no piece.
NEVER = float("-inf")
CUTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: The largest model file that is broadcast.
MAX_MODEL_BYTES = 64 << 20
#: Cut texts (in each of two generations) and pairs of pieces that a worker remembers.
REMEMBERED = 450_000
#: Longer cuts (in characters) are encoded every time.
REMEMBERED_LENGTH = 48


class PieceModel:
    """Pieces, scores and byte ids of a model, with its encoding and decoding.

    Inside, a piece is known by its number: the merged pieces and the single
    characters of the alphabet (also those that are no piece of their own)."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.spelled: list[str] = []
        self.silent: set[int] = set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.spelled.append(piece.replace(MARK, " "))
            if sp.is_unused(i):
                raise ValueError(f"unused piece {piece!r}: not supported")
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif sp.is_control(i):
                self.silent.add(i)
            elif not sp.is_unknown(i):
                ids[piece] = i
                self.score[piece] = sp.get_score(i)
        if len(self.byte_ids) != 256:
            raise ValueError("a model without byte pieces is not supported")
        self.unknown = sp.unk_id()
        self.plain = [None if i in self.byte_of or i in self.silent or i == self.unknown else t
                      for i, t in enumerate(self.spelled)]
        self.adds_mark = sp.normalize("a").startswith(MARK)
        merged = [p for p in ids if len(p) > 1 and self.merge(p) == [p]]
        self.cuts_at_marks = not any(re.search(f"[^{MARK}]{MARK}", p) for p in merged)
        self.neighbours = {pair for p in merged for pair in zip(p, p[1:])}
        #: texts of the numbered pieces, shorter ones before those they begin
        self.text = sorted(set("".join(ids)), key=ord) + sorted(merged, key=len)
        number = {p: i for i, p in enumerate(self.text)}
        self.single = {p: i for p, i in number.items() if len(p) == 1}
        self.outside = re.compile(f"([^{re.escape(''.join(self.single))}])")
        self.size = [len(p) for p in self.text]
        #: the next shorter piece that a piece begins with; -1 for single characters
        self.shorter = [next((number[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in number), -1) for p in self.text]
        self.ids_of = [[ids[p]] if p in ids else self.bytes_ids(p) for p in self.text]
        self.automaton = ahocorasick.Automaton()
        for i, p in enumerate(self.text):
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.after_mark = Remembered(lambda word: self.part(MARK + word))
        self.known = Remembered(self.part)

    def bytes_ids(self, text: str) -> list[int]:
        return [self.byte_ids[b] for b in text.encode("utf-8")]

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best score first, then leftmost."""
        parts, score = list(text), self.score.get
        joined = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while joined:
            best = max(joined)
            if best == NEVER:
                break
            at = joined.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(joined):
                joined[at] = score(parts[at] + parts[at + 1], NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether two adjacent pieces stay apart when their text is merged anew."""
        if len(self.fits) >= REMEMBERED:
            self.fits.clear()
        a, b = self.text[left], self.text[right]
        fit = self.fits[left * len(self.text) + right] = self.merge(a + b) == [a, b]
        return fit

    def split(self, text: str) -> list[int]:
        """The numbered pieces of a text over the alphabet."""
        n, count = len(text), len(self.text)
        size, shorter, fits = self.size, self.shorter, self.fits
        failed = bytearray((n >> 3) + 1)
        taken: list[int] = []
        at, before, moved = 0, -1, False
        longest = self.automaton.iter_long(text)
        piece = next(longest)[1] if n else -1
        while at < n:
            while piece >= 0:
                end = at + size[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if before < 0:
                        break
                    fit = fits.get(before * count + piece)
                    if self.compatible(before, piece) if fit is None else fit:
                        break
                piece, moved = shorter[piece], True
            if piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= size[piece]
                before = taken[-1] if taken else -1
                piece, moved = shorter[piece], True
                continue
            taken.append(piece)
            at, before = end, piece
            if at < n:
                if moved:
                    longest, moved = self.automaton.iter_long(text, at), False
                piece = next(longest)[1]
        return taken

    def part_ids(self, text: str) -> list[int]:
        """The ids of a normalised text that no merge reaches out of."""
        ids_of = self.ids_of
        if not self.outside.search(text):
            return [i for piece in self.split(text) for i in ids_of[piece]]
        out: list[int] = []
        for n, run in enumerate(self.outside.split(text)):
            out += self.bytes_ids(run) if n % 2 else [i for piece in self.split(run) for i in ids_of[piece]]
        return out

    def cuts(self, text: str) -> list[str]:
        """A normalised text in parts that no piece reaches over."""
        return CUTS.findall(text) if self.cuts_at_marks else [text] if text else []

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        return [i for part in self.cuts(self.library.normalize(text)) for i in self.part_ids(part)]

    def spell(self, ids: list[int]) -> str:
        """The text of some ids, marks as spaces; the first one's mark is kept."""
        try:
            return "".join([self.plain[i] for i in ids])
        except TypeError:  # ids of bytes, or that are not text
            pass
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(spelled_bytes(run))
                run = bytearray()
            if i == self.unknown:
                out.append(" \u2047 ")
            elif i not in self.silent:
                out.append(self.spelled[i])
        if run:
            out.append(spelled_bytes(run))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of a document's ids: the mark put in front of it goes."""
        text = self.spell(ids)
        first = next((i for i in ids if i not in self.silent), self.unknown)
        return text if first == self.unknown or first in self.byte_of else self.without_mark(text)

    def without_mark(self, text: str) -> str:
        return text[1:] if self.adds_mark and text.startswith(" ") else text

    def part(self, text: str) -> tuple[str, str]:
        """The ids of a part as decimal text, and what they spell.  A part is cut once
        more between neighbours that stand next to each other in no piece."""
        pairs = self.neighbours
        at = [i for i, pair in enumerate(zip(text, text[1:]), 1) if pair not in pairs]
        if not at:
            ids = self.part_ids(text)
            return ",".join(map(str, ids)), self.spell(ids)
        known = self.known
        parts = [known[text[i:j]] for i, j in zip([0, *at], [*at, len(text)])]
        return ",".join([p[0] for p in parts]), "".join([p[1] for p in parts])

    def ids_and_text(self, text: str) -> tuple[str, str]:
        """A whole text's ids as decimal text joined by commas, and the text they decode to."""
        text = self.library.normalize(text)
        words = text.split(MARK)
        if self.cuts_at_marks and not words[0] and len(words) > 1 and "" not in words[1:]:
            known = self.after_mark  # every word stands behind one mark
            parts = [known[w] for w in words[1:]]
        else:
            known = self.known
            parts = [known[c] for c in self.cuts(text)]
        return ",".join([p[0] for p in parts]), self.without_mark("".join([p[1] for p in parts]))


class Remembered(dict):
    """Values by key, made when first asked for.  Two generations are kept: once the
    young one is full it becomes the old one, and what is asked for again stays."""

    def __init__(self, make: Callable[[str], tuple[str, str]]):
        super().__init__()
        self.make = make
        self.old: dict[str, tuple[str, str]] = {}

    def __missing__(self, key: str) -> tuple[str, str]:
        value = self.old.get(key) or self.make(key)
        if len(key) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def spelled_bytes(run: bytearray) -> str:
    """Bytes as text; each byte that is no part of a valid character is replaced."""
    out = bytes(run).decode("utf-8", "replace") if is_utf8(run) else None
    if out is not None:
        return out
    text, at = [], 0
    while at < len(run):
        for size in (1, 2, 3, 4):
            if is_utf8(run[at:at + size]) and at + size <= len(run):
                text.append(bytes(run[at:at + size]).decode("utf-8"))
                at += size
                break
        else:
            text.append("�")
            at += 1
    return "".join(text)


def is_utf8(run: bytearray) -> bool:
    try:
        bytes(run).decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


#: A worker's model, by the digest of its file; one is kept.
_MODELS: dict[str, PieceModel] = {}


def model_of(model: bytes) -> PieceModel:
    key = hashlib.sha256(model).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(model)
    return _MODELS[key]


def read_model(path: str) -> bytes:
    if os.path.getsize(path) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: a model of more than {MAX_MODEL_BYTES} bytes is not broadcast")
    with open(path, "rb") as fh:
        return fh.read()


def map_texts(docs: DataFrame, model_file: str, text_col: str, keep: list[str], fields: list[T.StructField],
              of_text: Callable[[PieceModel, str | None], tuple]) -> DataFrame:
    """The columns ``keep`` of every row and what ``of_text`` makes of its text."""
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_file))
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                         F.col(f"`{text_col}`").cast("string").alias("t"))
    schema = T.StructType([*source.schema.fields[:-1], *fields])
    arrow = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    kinds = [arrow[f.dataType.simpleString()] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = model_of(model.value)
        for batch in batches:
            rows = [of_text(encoder, t.as_py()) for t in batch.column(batch.num_columns - 1)]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(batch.num_columns - 1)] + made,
                                             names=[f.name for f in schema.fields])

    return source.mapInArrow(run, schema).select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[f.name for f in fields])


def encode_documents(docs: DataFrame, model_file: str, *, text_col: str = "text",
                     keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``, the ids of the whole text."""
    return map_texts(docs, model_file, text_col, ["doc_id"] if keep is None else keep,
                     [T.StructField("ids", T.ArrayType(T.IntegerType()))],
                     lambda model, text: (model.encode(text or ""),))


def decode_documents(rows: DataFrame, model_file: str, *, ids_col: str = "ids",
                     keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``text``, the text of the ids (null: empty; null ids are passed over)."""
    joined = rows.select("*", F.concat_ws(",", F.col(f"`{ids_col}`").cast("array<string>")).alias("__ids"))
    return map_texts(joined, model_file, "__ids", ["doc_id"] if keep is None else keep,
                     [T.StructField("text", T.StringType())],
                     lambda model, ids: (model.decode([int(i) for i in ids.split(",")] if ids else []),))


def digest_row(model: PieceModel, text: str | None) -> tuple[int, str, str]:
    ids, decoded = model.ids_and_text(text or "")
    return (ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode("utf-8")).hexdigest())


def encoding_report(docs: DataFrame, model_file: str, *, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the encoding query: ids of each whole text, decoded again."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return map_texts(docs, model_file, text_col, [id_col], fields, digest_row)
