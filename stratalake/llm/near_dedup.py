"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

SuperMinHash (Ertl, 2017) gives each element one random permutation of the signature's slots and one
uniform value per step: at step j the element offers ``j + value`` to the j-th slot of its permutation. The
slots of an element are correlated, which lowers the variance, and once every slot is below j no later step can
change anything, so most elements stop after the first steps. Here a step is done for all elements of a slice
of documents at once, and documents leave as soon as they are settled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linking import link, meeting
from .scratch import store
from .words import LOWER, NON_SPACE, U64, batches_of_words, mix, window_hashes

#: 128 slots in 32 bands of 4: two sets of similarity 0.8 share no band with probability (1 - 0.8**4)**32 = 5e-8.
BANDS, ROWS = 32, 4
#: Bits of the parity sketch by which impossible pairs are left out.
SKETCH_BITS = 1024
_STEP = 48
_GAMMA = U64(0x9E3779B97F4A7C15)
#: Elements of unsettled documents that hold a permutation at the same time.
_ELEMENTS = 1 << 17


def _draws(elements: np.ndarray, step: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """For each element the slot index from step on that it swaps in, and its offer."""
    r = mix(elements + U64(((step + 1) * int(_GAMMA)) & (2**64 - 1)))
    swap = step + (((r >> U64(40)) * U64(slots - step)) >> U64(24)).astype(np.int64)
    value = (U64(step) << U64(_STEP)) | (mix(r) >> U64(64 - _STEP))
    return swap, value


def superminhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, slots: int) -> np.ndarray:
    """Signatures (n_sets x slots) of the sets of ``elements``; ``owner`` is the set of each, ascending.

    Sets without elements keep the largest value in every slot.
    """
    out = np.full((n_sets, slots), np.iinfo(U64).max, U64)
    if not len(elements):
        return out
    flat = out.reshape(-1)
    swap, value = _draws(elements, 0, slots)
    np.minimum.at(flat, owner * slots + swap, value)
    filled = np.bincount(owner, minlength=n_sets) > 0
    open_sets = filled & (out.max(axis=1) >= U64(1 << _STEP))
    todo = np.flatnonzero(open_sets[owner])
    # whole sets, a bounded number of elements at a time
    at = 0
    while at < len(todo):
        to = min(len(todo), at + _ELEMENTS)
        while to < len(todo) and owner[todo[to]] == owner[todo[to - 1]]:
            to += 1
        _settle(elements[todo[at:to]], owner[todo[at:to]], swap[todo[at:to]], out)
        at = to
    return out


def _settle(elements: np.ndarray, owner: np.ndarray, swap: np.ndarray, out: np.ndarray) -> None:
    slots = out.shape[1]
    flat = out.reshape(-1)
    order = np.broadcast_to(np.arange(slots, dtype=np.uint16), (len(elements), slots)).copy()
    rows = np.arange(len(elements))
    order[rows, 0], order[rows, swap] = order[rows, swap], order[rows, 0]
    for step in range(1, slots):
        swap, value = _draws(elements, step, slots)
        chosen = order[rows, swap]
        order[rows, swap] = order[rows, step]
        order[rows, step] = chosen
        np.minimum.at(flat, owner * slots + chosen, value)
        sets = np.unique(owner)
        still = np.zeros(len(out), bool)
        still[sets] = out[sets].max(axis=1) >= U64((step + 1) << _STEP)
        keep = still[owner]
        if not keep.any():
            return
        if not keep.all():
            elements, owner, order = elements[keep], owner[keep], order[keep]
            rows = np.arange(len(elements))


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * _GAMMA, (len(signatures), bands)).copy()
    for r in range(rows):
        key = mix(key ^ signatures[:, r::rows][:, :bands]) + _GAMMA
    return key.view(np.int64)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice of rows: its range, and the distinct shingle hashes with the row (from the range's start) of each.

    Words are those of ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. A text of fewer words than ``size`` has its
    whole sequence as one shingle.
    """
    for at, to, words in batches_of_words(column, NON_SPACE, LOWER):
        h, text_of = words.hashes(), words.text_of
        begin = words.window_starts(size)
        found, owner = [window_hashes(h, begin, size)], [text_of[begin]]
        for short in range(1, size):
            those = np.flatnonzero(words.counts == short)
            if len(those):
                found.append(window_hashes(h, words.first[those], short))
                owner.append(those)
        elements, owner = np.concatenate(found), np.concatenate(owner)
        order = np.argsort(elements)
        order = order[np.argsort(owner[order], kind="stable")]
        elements, owner = elements[order], owner[order]
        new = np.ones(len(elements), bool)
        new[1:] = (elements[1:] != elements[:-1]) | (owner[1:] != owner[:-1])
        yield at, to, elements[new], owner[new]


def _signer(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            for at, to, elements, owner in shingle_sets(text, size):
                n = to - at
                counts = np.bincount(owner, minlength=n)
                keys = band_keys(superminhash(elements, owner, n, bands * rows), bands, rows)
                full = counts > 0
                part = text.slice(at, n).to_pylist()
                digest = [
                    hashlib.md5(b" ".join(x.encode().lower().split())).digest() if f else None
                    for x, f in zip(part, full, strict=True)
                ]
                ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, n),
                        pa.array(counts.astype(np.int64)),
                        pa.array(digest, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].reshape(-1))),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bands"],
                )

    return run


def odd_sketch(elements: np.ndarray, owner: np.ndarray, n_sets: int) -> np.ndarray:
    """For each set the parity of its elements in each of the cells, as 64-bit words."""
    cell = (elements & U64(SKETCH_BITS - 1)).astype(np.int64)
    odd = np.bincount(owner * SKETCH_BITS + cell, minlength=n_sets * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n_sets, SKETCH_BITS), axis=1).view(np.int64)


def can_be_linked(x: Column, y: Column, percent: int) -> Column:
    """Whether two sets (structs n, parity) can have the similarity.

    Each element that only one of them has flips one bit, so differing bits never outnumber such elements, and
    similarity t allows at most (1 - t) / (1 + t) of the two sizes' sum of these. No link is refused.
    """
    differing = sum(
        (F.bit_count(F.get(x["parity"], F.lit(i)).bitwiseXOR(F.get(y["parity"], F.lit(i)))) for i in range(SKETCH_BITS // 64)),
        start=F.lit(0),
    )
    return differing * (100 + percent) <= (x["n"] + y["n"]) * (100 - percent)


def _packer(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, elements, owner in shingle_sets(batch.column(1), size):
                ends = np.searchsorted(owner, np.arange(to - at + 1))
                packed = [elements[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                parity = odd_sketch(elements, owner, to - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        pa.array(packed, pa.binary()),
                        pa.array(list(parity), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "shingles", "parity"],
                )

    return run


def _judge(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p = np.frombuffer(x.as_buffer(), U64)
                q = np.frombuffer(y.as_buffer(), U64)
                common = 0
                if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                    both = np.concatenate([p, q])
                    both.sort(kind="stable")
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if ``100 * intersection >= percent * union`` for their sets of distinct ``shingle``-word
    shingles; component_id is the smallest doc_id reachable over links and kept says whether it is the own one.
    Documents with the same words form one class, by a 128-bit digest; candidates between classes share a band of
    their signatures; each link is confirmed on the two full sets. Signature banding can miss a link, at
    similarity 0.8 with probability 5e-8.

    A null or wordless text has an empty set and no link. Rows that repeat a doc_id are one document that
    has the links of all its rows. A row with a null doc_id takes no part: its component_id is null, kept true.
    Other columns are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = store(
        docs.mapInArrow(
            _signer(shingle, bands, rows), "doc_id long, n_shingles long, digest binary, bands array<long>"
        ),
        "signed",
    )
    classes = (
        signed.where("doc_id is not null and digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("class_id"))
    )
    in_class = store(
        signed.select("doc_id", "n_shingles", "digest")
        .join(classes, "digest", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id")),
        "classes",
    )
    signatures = signed.join(classes, "digest").where("doc_id = class_id").select("doc_id", "bands")
    live = meeting(signatures.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("node")))
    wanted = live.select(F.col("node").alias("doc_id")).distinct()
    sets = store(
        docs.join(wanted, "doc_id", "left_semi").mapInArrow(
            _packer(shingle), "doc_id long, shingles binary, parity array<long>"
        ),
        "sets",
    )
    traits = sets.select(
        F.col("doc_id").alias("node"),
        F.struct((F.octet_length("shingles") / 8).cast("int").alias("n"), "parity").alias("trait"),
    )

    def verify(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("p")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("q")), "b")
            .select("a", "b", "p", "q")
            .mapInArrow(_judge(percent), "a long, b long")
        )

    # rows of one doc_id in several classes
    several = (
        in_class.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z")).where("a < z")
    )
    known = in_class.join(several, "doc_id").where("class_id > a").select("a", F.col("class_id").alias("b"))
    labels = link(live, verify, traits, lambda x, y: can_be_linked(x, y, percent), known)
    own = in_class.join(
        labels.select(F.col("node").alias("class_id"), "component"), "class_id", "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "class_id", "doc_id").alias("component_id"))
    return own.withColumn(
        "kept", F.when(F.col("doc_id").isNull(), F.lit(True)).otherwise(F.col("doc_id") == F.col("component_id"))
    )
