"""Exact encoding and decoding with a merge-type (BPE) SentencePiece model.

The library merges the best-scored neighbours of a whole text until none is left.
Here the same pieces come from a search that reads the text once:

* An Aho-Corasick automaton of the pieces finds, at every position, the longest
  piece that starts there; shorter ones are its prefixes.  Pieces that merging
  their own characters does not give back are left out.
* Neighbours ``a b`` are compatible if merging the characters of ``ab`` gives
  ``a b`` again.  A text's merged form is the only way to cut it into such pieces
  whose neighbours are all compatible: the first merge that crossed a cut would
  also cross it in the two pieces alone.
* The search takes the longest compatible piece, then shorter ones, and steps back
  over its last piece when none fits.  A position that failed is marked in a
  bitfield and never entered again, so the work is in proportion to the length.

No piece of the usual models has a space mark after another character, and some
characters occur in no piece but their own.  No merge crosses such places (both are
read from the vocabulary), so a text is cut there first and the pieces of each part
are remembered per worker, up to ``MEMO_PARTS``.

The model file is read on the driver and broadcast: its size is that of a vocabulary
(under 1 MB here), whatever the size of the table, and checked against
``MAX_MODEL_BYTES``.

Edge cases: a null or empty text has the begin and end ids only and decodes to an
empty text; a null id stays null; repeated rows are repeated; an empty table gives an
empty table; extra columns are ignored, whatever their names.  A text of any length
is encoded whole, in memory in proportion to it.  Ids without a piece raise when decoded.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.hashing import slices

SPACE_MARK = "▁"
# Remembered parts (two generations of so many) and neighbour checks per worker.
MEMO_PARTS = 300_000
MEMO_PAIRS = 500_000
MAX_PART_CHARS = 64
MAX_MODEL_BYTES = 64 << 20
# What the library writes for the unknown piece (fixed value).
UNKNOWN_TEXT = " ⁇ "


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("tidewater-each-byte", _each_byte)


class PieceModel:
    """Vocabulary, encoder and decoder of one model, inside a worker."""

    def __init__(self, model: bytes):
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        own = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.ids = {names[i]: i for i in own}
        self.scores = {names[i]: sp.get_score(i) for i in own}
        self.bytes_ids = {int(names[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown, self.begin, self.end = sp.unk_id(), sp.bos_id(), sp.eos_id()
        self.longest_name = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for name in self.ids:
            if len(name) > 1 and self.merged(name) == [name]:
                self.automaton.add_word(name, len(name))
        self.automaton.make_automaton()
        self.valid = set(self.automaton)
        self.part = self._part_pattern()
        self.parts: dict[str, bytes] = {}
        self.old_parts: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.edges: dict[str, list[tuple[float | None, str, str]]] = {}
        self.surfaces = [self._surface(i, names[i]) for i in range(size)]
        self.controls = {i for i in range(size) if sp.is_control(i)}
        self.marked = {i for i in own if names[i].startswith(SPACE_MARK)}
        self.drops_mark = sp.decode(sp.encode("a")) == "a" and sp.normalize("a").startswith(SPACE_MARK)

    # --- vocabulary ---------------------------------------------------------------

    def _part_pattern(self) -> re.Pattern:
        """Parts that no merge crosses the bounds of."""
        long = [n for n in self.ids if len(n) > 1]
        marks_lead = all(SPACE_MARK not in n.lstrip(SPACE_MARK) for n in long)
        joined = {c for n in long for c in n} - {SPACE_MARK}
        if not marks_lead or not joined:
            return re.compile(r"(?s).+")
        inner = "".join(re.escape(c) for c in sorted(joined))
        return re.compile(f"(?s){SPACE_MARK}*[{inner}]+|{SPACE_MARK}+|.")

    def _surface(self, i: int, name: str) -> bytes:
        sp = self.processor
        if sp.is_control(i):
            return b""
        if sp.is_unknown(i):
            return UNKNOWN_TEXT.encode()
        if sp.is_byte(i):
            return bytes([int(name[1:-1], 16)])
        return name.replace(SPACE_MARK, " ").encode()

    # --- encoding -------------------------------------------------------------------

    def merges(self, text: str) -> Iterator[tuple[float | None, list[str]]]:
        """The states of a short text while its best neighbours merge, leftmost first, each
        with the score of the merge that ends it (None at last)."""
        out = list(text)
        score = self.scores.get
        while True:
            best, at = None, -1
            for i in range(len(out) - 1):
                s = score(out[i] + out[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            yield best, out
            if at < 0:
                return
            out[at:at + 2] = [out[at] + out[at + 1]]

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging."""
        for _, state in self.merges(text):
            pass
        return state

    def _edges(self, piece: str) -> list[tuple[float | None, str, str]]:
        """Of each state of a piece's merging: the next merge's score, first and last part."""
        known = self.edges.get(piece)
        if known is None:
            known = [(score, state[0], state[-1]) for score, state in self.merges(piece)]
            if len(self.edges) < MEMO_PAIRS:
                self.edges[piece] = known
        return known

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging ``ab`` gives ``a b``: both are merged again side by side, best
        first, and no merge may join the last part of one and the first of the other."""
        key = (a, b)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._stay_apart(self._edges(a), self._edges(b))
        return known

    def _stay_apart(self, left: list, right: list) -> bool:
        i = j = 0
        across = self.scores.get
        while True:
            in_left, _, last = left[i]
            in_right, first, _ = right[j]
            s = across(last + first)
            # Of equal scores the leftmost merges: in the left piece, across, in the right one.
            if s is not None and (in_left is None or s > in_left) and (in_right is None or s >= in_right):
                return False
            if in_left is not None and (in_right is None or in_left >= in_right):
                i += 1
            elif in_right is not None:
                j += 1
            else:
                return True

    def cut(self, text: str) -> list[str]:
        """The pieces of a text: longest first, back over failed positions."""
        n = len(text)
        longest = [1] * n
        for last, length in self.automaton.iter(text):
            longest[last - length + 1] = length  # ends ascend, so the longest comes last
        failed = bytearray(n // 8 + 1)
        pieces: list[str] = []
        previous = None
        at = 0
        length = longest[0] if n else 0
        while at < n:
            while length:
                to = at + length
                if not failed[to >> 3] >> (to & 7) & 1:
                    piece = text[at:to]
                    if (length == 1 or piece in self.valid) and (previous is None or self.compatible(previous, piece)):
                        break
                length -= 1
            if length:
                pieces.append(piece)
                previous = piece
                at = to
                length = longest[at] if at < n else 0
            else:
                failed[at >> 3] |= 1 << (at & 7)
                if not pieces:
                    raise ValueError("no compatible pieces")
                length = len(pieces.pop()) - 1
                at -= length + 1
                previous = pieces[-1] if pieces else None
        return pieces

    def _part_ids(self, part: str) -> bytes:
        out: list[int] = []
        for piece in self.cut(part):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.bytes_ids:
                out.extend(self.bytes_ids[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str | None) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        known = self.parts
        found = self.part.findall(self.processor.normalize(text)) if text else []
        out = [struct.pack("<I", self.begin)]
        for part in found:
            ids = known.get(part)
            if ids is None:
                ids = self.old_parts.get(part) or self._part_ids(part)
                if len(part) <= MAX_PART_CHARS:
                    if len(known) >= MEMO_PARTS:
                        # Parts used since the last turn stay.
                        self.old_parts = known
                        known = self.parts = {}
                    known[part] = ids
            out.append(ids)
        out.append(struct.pack("<I", self.end))
        return b"".join(out)

    # --- decoding -------------------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, the one before the text goes, bytes that
        are no UTF-8 become U+FFFD each."""
        surfaces = self.surfaces
        controls = [at for at, i in enumerate(ids) if i in self.controls]
        runs = [ids[a + 1:b] for a, b in zip([-1, *controls], [*controls, len(ids)], strict=True)]
        out = []
        for run in runs:
            if not run:
                continue
            joined = b"".join([surfaces[i] for i in run])
            if self.drops_mark and not out and run[0] in self.marked:
                joined = joined[1:]
            out.append(joined.decode("utf-8", "tidewater-each-byte"))
        return "".join(out)


_models: dict[bytes, PieceModel] = {}


def _loaded(model: bytes) -> PieceModel:
    if model not in _models:
        _models.clear()
        _models[model] = PieceModel(model)
    return _models[model]


def _broadcast(spark: SparkSession, model_file: str):
    with open(model_file, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"{model_file} is larger than {MAX_MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast(model)


def _packed_lists(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encode(docs: DataFrame, model_file: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(``ident``, ``ids`` array of int) of every row, begin and end ids included."""
    kept = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    model = _broadcast(docs.sparkSession, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value)
        for batch in batches:
            for part in slices(batch):
                packed = [pieces.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), _packed_lists(packed)], ["ident", "ids"])

    ids = kept.mapInArrow(run, f"ident {kept.schema['ident'].dataType.simpleString()}, ids array<int>")
    return ids.withColumnRenamed("ident", ident)


def decode(encoded: DataFrame, model_file: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(``ident``, ``text``) of rows of ids; null ids decode to an empty text."""
    kept = encoded.select(F.col(ident).alias("ident"), F.col(ids).cast("array<int>").alias("ids"))
    model = _broadcast(encoded.sparkSession, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value)
        for batch in batches:
            texts = [pieces.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["ident", "text"])

    text = kept.mapInArrow(run, f"ident {kept.schema['ident'].dataType.simpleString()}, text string")
    return text.withColumnRenamed("ident", ident)


def round_trip(docs: DataFrame, model_file: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(``ident``, ``ids`` packed as little-endian 32-bit integers, ``decoded``), encoded and
    decoded again in one pass over the texts."""
    kept = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    model = _broadcast(docs.sparkSession, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(model.value)
        for batch in batches:
            for part in slices(batch):
                packed = [pieces.encode(t) for t in part.column(1).to_pylist()]
                decoded = [pieces.decode(np.frombuffer(p, "<u4").tolist()) for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), pa.array(decoded, pa.string())],
                    ["ident", "ids", "decoded"])

    out = kept.mapInArrow(run, f"ident {kept.schema['ident'].dataType.simpleString()}, ids binary, decoded string")
    return out.withColumnRenamed("ident", ident)


def digest(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return round_trip(docs, model_file).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
