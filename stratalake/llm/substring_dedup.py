"""Removal of passages that a document with a smaller id already has.

A passage of ``window`` words holds, wherever it lies, a whole block of half its length that begins at a
multiple of the block length in its document. So it is enough to index these non-overlapping blocks and
to probe them with the block at every word of every document. Each hit is then extended: the windows around it are
compared by their whole content, and neighbouring equal windows join into maximal repeats.

What is shuffled is packed: a row holds, for one slice of documents and one bucket of hash values, all probes.
A hash that a slice has several times is sent once, and later each window once per slice and smallest document; so a
passage in a third of all documents does not gather at one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NON_SPACE, U64, Words, batches_of_words, window_hashes

#: Bytes of text whose probes share a bucket; a task holds one bucket at a time.
BUCKET_BYTES = 16 << 20
_ALIGNED, _SEVERAL, _POSITION = np.uint32(1 << 31), np.uint32(1 << 30), np.uint32((1 << 30) - 1)
_PACKED = "bucket int, doc_id long, row_key int, span long, packed binary"
_SPANS = pa.schema(
    [
        ("bucket", pa.int32()),
        ("doc_id", pa.int64()),
        ("row_key", pa.int32()),
        ("span", pa.int64()),
        ("packed", pa.binary()),
    ]
)


def _planes(a: np.ndarray) -> bytes:
    """Bytes of equal weight side by side: the upper ones of small numbers then compress to nothing."""
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, n).T.copy().view(kind).reshape(n)


def _pack(columns: list[np.ndarray], ids: np.ndarray, keys: np.ndarray) -> bytes:
    """Entries in the order of their documents; runs of one document name it once."""
    n = len(ids)
    new = np.ones(n, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, n)).astype(np.uint32)
    head = np.array([n, len(heads)], np.uint32).tobytes()
    return head + b"".join(_planes(np.ascontiguousarray(c)) for c in (ids[heads], keys[heads], runs, *columns))


def _unpack(raw: bytes, kinds: list[type]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    n, docs = (int(x) for x in np.frombuffer(raw[:8], np.uint32))
    at, out = 8, []
    for kind, length in [(np.int64, docs), (np.int32, docs), (np.uint32, docs), *((k, n) for k in kinds)]:
        size = np.dtype(kind).itemsize * length
        out.append(_from_planes(raw[at : at + size], kind, length))
        at += size
    ids, keys, runs = out[:3]
    return out[3:], np.repeat(ids, runs), np.repeat(keys, runs)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int32)


def _packed_rows(columns: list[np.ndarray], bucket: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    bucket, ids, keys = bucket[order], ids[order], keys[order]
    columns = [c[order] for c in columns]
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(heads[1:], len(bucket))
    packed = [
        _pack([c[a:b] for c in columns], ids[a:b], keys[a:b]) for a, b in zip(heads.tolist(), ends.tolist(), strict=True)
    ]
    n = len(heads)
    none = [pa.nulls(n, f.type) for f in list(_SPANS)[1:4]]
    return pa.RecordBatch.from_arrays([pa.array(bucket[heads]), *none, pa.array(packed, pa.binary())], schema=_SPANS)


def _span_rows(bucket: np.ndarray, ids: np.ndarray, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    """First and last place of each span in one number: lists of numbers are a quarter of the size of lists of pairs."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket.astype(np.int32)),
            pa.array(ids),
            pa.array(keys),
            pa.array(lo.astype(np.int64) << 32 | hi.astype(np.int64)),
            pa.nulls(len(ids), pa.binary()),
        ],
        schema=_SPANS,
    )


def _bounds(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spans = np.asarray(spans, np.int64)
    return spans >> 32, spans & 0xFFFFFFFF


def _runs(marked: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked words as (text, first, last), counted within the text."""
    before = np.zeros(len(marked), bool)
    before[1:] = marked[:-1]
    before[words.first[:-1][words.counts > 0]] = False
    after = np.zeros(len(marked), bool)
    after[:-1] = marked[1:]
    after[words.first[1:][words.counts > 0] - 1] = False
    a, b = np.flatnonzero(marked & ~before), np.flatnonzero(marked & ~after)
    text = np.searchsorted(words.first, a, "right") - 1
    return text, a - words.first[text], b - words.first[text]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal keys together, where each group begins in it, and the group of each place."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return order, np.flatnonzero(new), np.cumsum(new) - 1


Rows = Iterator[pa.RecordBatch]


def _probe(window: int, buckets: int) -> Callable[[Rows], Rows]:
    """Probes of every word's block; a block that a slice has several times is a hit at once."""
    block = (window + 1) // 2

    def run(batches: Rows) -> Rows:
        for batch in batches:
            doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, to, words in batches_of_words(batch.column(2), NON_SPACE):
                long = words.counts >= window
                begin = words.window_starts(block)
                text = words.text_of[begin]
                begin, text = begin[long[text]], text[long[text]]
                if not len(begin):
                    continue
                ids, keys = doc[at:to], key[at:to]
                position = begin - words.first[text]
                h = window_hashes(words.hashes(), begin, block)
                order, heads, group = _groups(h)
                aligned = np.logical_or.reduceat((position % block == 0)[order], heads)
                several = np.diff(np.append(heads, len(order))) > 1
                # the smallest position first, for the entries of a row go by document
                some = np.argsort(order[heads])
                entry = order[heads][some]
                tagged = position[entry].astype(np.uint32)
                tagged |= np.where(aligned[some], _ALIGNED, np.uint32(0)) | np.where(several[some], _SEVERAL, np.uint32(0))
                yield _packed_rows(
                    [(h[entry] & U64(0xFFFFFFFF)).astype(np.uint32), tagged],
                    _bucket(h[entry], buckets),
                    ids[text[entry]],
                    keys[text[entry]],
                )
                marked = np.zeros(len(words.starts), bool)
                marked[begin[order[several[group]]]] = True
                t, lo, hi = _runs(marked, words)
                if len(t):
                    yield _span_rows(t % buckets, ids[t], keys[t], np.maximum(lo - (window - block), 0), hi)

    return run


def _by_bucket(batches: Rows) -> Iterator[tuple[list[bytes], pa.RecordBatch | None]]:
    """Packed rows of one bucket after the other, from rows sorted by bucket; span rows as they come."""
    now, held = None, []
    for batch in batches:
        packed = batch.column(4)
        spans = batch.filter(packed.is_null())
        if spans.num_rows:
            yield [], spans
        for bucket, raw in zip(batch.column(0).to_pylist(), packed.to_pylist(), strict=True):
            if raw is None:
                continue
            if bucket != now and held:
                yield held, None
                held = []
            now = bucket
            held.append(raw)
    if held:
        yield held, None


def _match_blocks(window: int) -> Callable[[Rows], Rows]:
    """Spans of window starts around each probe whose block is indexed and occurs again."""
    block = (window + 1) // 2

    def run(batches: Rows) -> Rows:
        for held, spans in _by_bucket(batches):
            if spans is not None:
                yield spans
                continue
            parts = [_unpack(raw, [np.uint32, np.uint32]) for raw in held]
            value, tagged = (np.concatenate([p[0][i] for p in parts]) for i in (0, 1))
            order, heads, group = _groups(value)
            flags = np.bitwise_or.reduceat(tagged[order], heads)
            size = np.diff(np.append(heads, len(order)))
            found = (size > 1) & (flags & _ALIGNED > 0)
            hit = order[found[group]]
            hit = hit[tagged[hit] & _SEVERAL == 0]
            if len(hit):
                ids, keys = (np.concatenate([p[i] for p in parts])[hit] for i in (1, 2))
                position = (tagged[hit] & _POSITION).astype(np.int64)
                yield _span_rows(
                    np.zeros(len(hit)), ids, keys, np.maximum(position - (window - block), 0), position
                )

    return run


def _compare_windows(window: int, buckets: int) -> Callable[[Rows], Rows]:
    """The content of all windows that begin in a span. Repeats within the slice are settled at once."""

    def run(batches: Rows) -> Rows:
        for batch in batches:
            batch = batch.filter(batch.column(3).is_valid())
            if not batch.num_rows:
                continue
            doc, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spans = batch.column(3)
            ends = spans.offsets.to_numpy()
            lows, highs = _bounds(spans.values.to_numpy())
            for at, to, words in batches_of_words(batch.column(2), NON_SPACE):
                part = slice(ends[at], ends[to])
                of = np.repeat(np.arange(to - at), np.diff(ends[at : to + 1]))
                low = words.first[of] + lows[part]
                high = words.first[of] + np.minimum(highs[part], words.counts[of] - window)
                use = high >= low
                step = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(step, low[use], 1)
                np.add.at(step, high[use] + 1, -1)
                begin = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                if not len(begin):
                    continue
                h, g = (window_hashes(words.hashes(i), begin, window, i) for i in (0, 1))
                text = words.text_of[begin]
                ids, keys = doc[at:to], key[at:to]
                order, heads, group = _groups(h, g)
                mine = ids[text[order]]
                least = np.minimum.reduceat(mine, heads)[group]
                marked = np.zeros(len(words.starts), bool)
                marked[begin[order[mine > least]]] = True
                t, lo, hi = _runs(marked, words)
                if len(t):
                    yield _span_rows(t % buckets, ids[t], keys[t], lo, hi)
                send = np.sort(order[mine == least])
                text, begin = text[send], begin[send]
                yield _packed_rows(
                    [h[send], (g[send] >> U64(32)).astype(np.uint32), (begin - words.first[text]).astype(np.uint32)],
                    _bucket(h[send], buckets),
                    ids[text],
                    keys[text],
                )

    return run


def _match_windows(batches: Rows) -> Rows:
    """Windows that a smaller document has."""
    for held, spans in _by_bucket(batches):
        if spans is not None:
            yield spans
            continue
        parts = [_unpack(raw, [U64, np.uint32, np.uint32]) for raw in held]
        h, g, position = (np.concatenate([p[0][i] for p in parts]) for i in range(3))
        ids, keys = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        order, heads, group = _groups(h, g)
        mine = ids[order]
        gone = np.sort(order[mine > np.minimum.reduceat(mine, heads)[group]])
        if len(gone):
            yield _span_rows(np.zeros(len(gone)), ids[gone], keys[gone], position[gone], position[gone])


def _cut(window: int) -> Callable[[Rows], Rows]:
    """Words that are left, and the maximal repeats that went."""
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Rows) -> Rows:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            n_words, n_removed, kept, repeats = [], [], [], []
            for raw, spans in zip(texts, batch.column(3).to_pylist(), strict=True):
                words = (raw or b"").split()
                n_words.append(len(words))
                gone: list[dict] = []
                for lo, last in zip(*(x.tolist() for x in _bounds(np.sort(spans))), strict=True) if spans else ():
                    hi = last + window
                    if gone and lo <= gone[-1]["end"]:
                        gone[-1]["end"] = max(gone[-1]["end"], hi)
                    else:
                        gone.append({"begin": lo, "end": hi})
                left, at = [], 0
                for span in gone:
                    left += words[at : span["begin"]]
                    at = span["end"]
                left += words[at:]
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
                repeats.append(gone)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(repeats, kind),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", "repeats"],
            )

    return run


def _gathered(spans: DataFrame) -> DataFrame:
    """The spans of each document; a document has at most as many as words."""
    return spans.groupBy("doc_id", "row_key").agg(F.collect_list("span").alias("spans"))


def remove_repeats(
    docs: DataFrame, window: int = 50, buckets: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (text), repeats (spans of words, end exclusive).

    Words are those of ``[^\\x20\\x09-\\x0D]+``. Each word goes that a window of ``window`` words covers whose words also
    follow each other in a document with a smaller doc_id. Windows are judged on the input. Windows count as equal by
    96 bits of two hashes that have nothing in common. ``buckets`` follows from the size of the texts unless given.

    A null or wordless text has no words and stays empty. Rows that repeat a doc_id are cut each by its own text and
    never because of each other. A row with a null doc_id is returned whole and is no reason to cut another. Other
    columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
        buckets = max(partitions, -(-size // BUCKET_BYTES))
    # a partition takes its buckets one after the other
    partitions = min(buckets, max(partitions, -(-buckets // 4)))
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.hash(F.col(text_col).cast("string")).alias("row_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    packed = docs.where("doc_id is not null").mapInArrow(_probe(window, buckets), _PACKED)
    near = (
        packed.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_match_blocks(window), _PACKED)
    )
    compared = (
        docs.join(_gathered(near), ["doc_id", "row_key"], "left")
        .select("doc_id", "row_key", "text", "spans")
        .mapInArrow(_compare_windows(window, buckets), _PACKED)
    )
    gone = (
        compared.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(_match_windows, _PACKED)
    )
    return (
        docs.join(_gathered(gone), ["doc_id", "row_key"], "left")
        .select("doc_id", "row_key", "text", "spans")
        .mapInArrow(
            _cut(window),
            "doc_id long, n_words long, n_removed long, kept string, repeats array<struct<begin:int,end:int>>",
        )
    )
