"""Encoding and decoding with merge-type SentencePiece vocabularies.

A chunk of text starts as one symbol per character. An agenda holds the adjacent pairs of symbols that are pieces
together, best score first and leftmost among equals; the first is merged, and the pairs with its new neighbours join the
agenda. Text is cut into chunks where no piece of the vocabulary reaches across, so each distinct chunk is
merged once and then looked up. Every new chunk, and every decoded text, is compared with the library, one
Arrow batch at a time.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain, islice, pairwise
from operator import add

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: Distinct chunks that a worker remembers (about 250 bytes each), and the longest. Frequent chunks are met first, so the
#: first ones stay; others are merged again in each batch that has them.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: Texts of so many characters are worked on together.
_TOGETHER = 1 << 21
_LETTER, _SIGNS = "[0-9A-Za-zÀ-ÖØ-öø-ÿ]", "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
_UNKNOWN_SURFACE = " ⁇ "


class _Known(dict):
    """The ids of the chunks met so far; a new one is merged on demand and noted."""

    def __init__(self, codec: Codec):
        self.codec, self.new = codec, []

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        self.new.append(chunk)
        ids = self[chunk] = self.codec.chunk_ids(chunk)
        return ids


class Codec:
    """A vocabulary file of the kind ``bpe`` with identity normalisation and a space put before each text."""

    def __init__(self, model_file: str, check: bool = True):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.check = check
        lib = self.library
        size = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(size)]
        self.unknown = lib.unk_id()
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) for i in range(size)]
        if any(lib.is_unused(i) for i in range(size)) or lib.encode("a ½ b", out_type=str)[-1][-1] != "b":
            raise ValueError("vocabularies with unused pieces or text normalisation are not supported")
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        scores = sorted({lib.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        self.rank = {p: place[lib.get_score(i)] for p, i in self.ids.items() if len(p) > 1}
        self.bytes = {lib.piece_to_id(f"<0x{b:02X}>"): b for b in range(256) if lib.is_byte(lib.piece_to_id(f"<0x{b:02X}>"))}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        self.surface = [
            _UNKNOWN_SURFACE.encode()
            if i == self.unknown
            else bytes([self.bytes[i]])
            if i in self.bytes
            else b""
            if special[i]
            else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.chunks = re.compile(self._cuts(), re.DOTALL)
        self.known = _Known(self)

    def _cuts(self) -> str:
        """Chunks begin before spaces, if no piece has one after another character, and around lone characters.

        A word also ends before a sign that no piece has after a letter or digit.
        """
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank):
            return ".+"
        alone = re.escape("".join(c for c in "\n\t\r" if not any(c in p for p in self.rank)))
        after_letter = {b for p in self.rank for a, b in pairwise(p) if re.match(_LETTER, a)}
        signs = re.escape("".join(c for c in _SIGNS if c not in after_letter))
        return "|".join(
            [
                *([f"[{alone}]"] if alone else []),
                *([f" +{_LETTER}++(?=[{signs}])"] if signs else []),
                f" +[^ {alone}]*",
                f"[^ {alone}]+",
            ]
        )

    def merge(self, chunk: str) -> list[str]:
        """The pieces of a chunk, by the agenda."""
        rank = self.rank
        symbols = list(chunk)
        n = len(symbols)
        agenda = [(rank[both], i, both) for i, both in enumerate(map(add, chunk, chunk[1:])) if both in rank]
        if not agenda:
            return symbols
        heapq.heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            _, i, both = heapq.heappop(agenda)
            j = after[i]
            # a pair is out of date when either symbol has been merged since
            if j >= n or not symbols[i] or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                wider = both + symbols[k]
                if wider in rank:
                    heapq.heappush(agenda, (rank[wider], i, wider))
            h = before[i]
            if h >= 0:
                wider = symbols[h] + both
                if wider in rank:
                    heapq.heappush(agenda, (rank[wider], h, wider))
        return [s for s in symbols if s]

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.merge(chunk.replace(" ", SPACE)):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode())
            elif not (out and out[-1] == self.unknown):
                out.append(self.unknown)
        return tuple(out)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, without begin or end ids. An empty text has none."""
        find, known = self.chunks.findall, self.known
        ids_of = known.__getitem__
        out = [
            list(chain.from_iterable(map(ids_of, find(" " + t.replace(SPACE, " "))))) if t else [] for t in texts
        ]
        new, known.new = known.new, []
        if self.check:
            self._compare_chunks(new)
        for c in new:
            if len(c) > REMEMBERED_CHARS:
                del known[c]
        if len(known) > REMEMBERED:
            for c in list(islice(known, REMEMBERED, None)):
                del known[c]
        return out

    def _compare_chunks(self, chunks: list[str]) -> None:
        """The library puts a space before what it is given: a chunk without one is given after a line feed."""
        skip = len(self.library.encode("\n"))
        given = [c[1:] if c[0] == " " else "\n" + c for c in chunks]
        for c, theirs in zip(chunks, self.library.encode(given, num_threads=1) if given else [], strict=True):
            if c == " ":
                continue  # an empty text to the library
            ours = self.known[c]
            if ours != tuple(theirs if c[0] == " " else theirs[skip:]):
                raise ValueError(f"ids of {c!r} differ from the library's: {ours}, {theirs}")

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD each."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        if ids and raw[:1] == b" " and ids[0] not in self.bytes and ids[0] != self.unknown:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return raw.decode(errors="one_each")

    def decode_all(self, many: list[list[int]]) -> list[str]:
        out = [self.decode(ids) for ids in many]
        if self.check:
            for ids, ours, theirs in zip(many, out, self.library.decode(many) if many else [], strict=True):
                if ours != theirs:
                    raise ValueError(f"text of {ids[:50]} differs from the library's")
        return out


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def _codec(model_file: str, check: bool) -> Codec:
    """One codec per worker process: workers outlive tasks, and so do the chunks they know."""
    import codecs

    codecs.register_error("one_each", _one_each)
    home = sys.modules.setdefault("_sentencepiece_codecs", types.ModuleType("_sentencepiece_codecs"))
    key = f"{model_file}:{check}"
    if key not in vars(home):
        setattr(home, key, Codec(model_file, check))
    return getattr(home, key)


def _together(texts: list[str]) -> Iterator[tuple[int, int]]:
    at, chars = 0, 0
    for i, t in enumerate(texts):
        if chars and chars + len(t) > _TOGETHER:
            yield at, i
            at, chars = i, 0
        chars += len(t)
    if at < len(texts):
        yield at, len(texts)


def _run(model_file: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_file, check)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for at, to in _together(texts):
                ids = codec.encode(texts[at:to])
                decoded = codec.decode_all(ids)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(at, to - at) for c in batch.columns[:-1]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array(decoded, pa.string()),
                    ],
                    names=[*batch.schema.names[:-1], "ids", "decoded"],
                )

    return run


def encode_and_decode(
    docs: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", check: bool = True
) -> DataFrame:
    """The columns ``keep`` of each row with ids (array<int>) and decoded (text of these ids).

    ids are those of the sentencepiece library's encode without begin or end ids and without sampling; decoded is
    its decode. With ``check`` the job fails if they ever differ. ``model_file`` must exist on every executor.

    A null text counts as empty: no ids, an empty text. Repeated rows are rows like others, null columns stay null,
    other columns are ignored, an empty table gives no rows. Columns in ``keep`` must not be called ids or decoded.
    """
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(_run(model_file, check), schema)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids, ","), 256)
