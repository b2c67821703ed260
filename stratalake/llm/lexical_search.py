"""Ranked search for the terms of items by scanning the documents, without an index of the documents.

The terms of all items form one Aho-Corasick automaton, each guarded by a separator on either side, which is broadcast. A
scan of the documents, with every other character turned into a separator, counts each term of any item straight from the
text. Its outputs map to the items. The counts are stored; a second pass over them, which is far smaller than the texts,
scores documents once the numbers of all documents are known.

Terms are the longest runs of ASCII letters, digits and other characters from U+0080 on, with A-Z lower-cased. N, L, n, df and tf,
the weight and the score are as in :func:`rank`. Rows of equal item id are one item with the terms of all, also for the null id. Items
without terms and documents without terms give nothing. Documents are rows: equal ids are ranked side by side, and the null id comes last
among equal scores. Empty tables give an empty result. Other columns do not matter, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .scratch import store
from .words import byte_class, slices, utf8

#: An automaton takes items with terms of at most so many bytes together (a single item may have more), and some 60 times
#: as much memory. Further items go to further automata, each with a scan of its own.
AUTOMATON_BYTES = 1 << 20
#: Longer texts are given to the automaton in pieces that end at separators.
PIECE_BYTES = 1 << 20
#: Sums of document and item that are worked out at once.
CELLS = 1 << 21

_TERM = byte_class(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
#: What the automaton is to read for each byte.
_READ = np.where(_TERM, np.arange(256), 0x20).astype(np.uint8)
_READ[ord("A") : ord("Z") + 1] += 32
_PATTERN = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The distinct terms of each item: ``item_id`` and ``term``."""
    lowered = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    found = F.regexp_extract_all(lowered, F.lit(_PATTERN), F.lit(0))
    return items.select(F.col(id_col).alias("item_id"), F.explode(found).alias("term")).distinct()


def build_automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Outputs the number of each term that stands between two separators."""
    automaton = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        automaton.add_word(f" {term} ", number)
    automaton.make_automaton()
    return automaton


def _pieces(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        to = raw.find(b" ", at + PIECE_BYTES)
        to = len(raw) if to < 0 else to
        yield raw[at:to]
        at = to


def count_terms(automaton: ahocorasick.Automaton, read: bytes) -> Counter:
    """How often each term occurs in a text whose separators are spaces already."""
    counts: Counter = Counter()
    for piece in _pieces(read):
        counts.update(map(itemgetter(1), automaton.iter(f" {piece.decode('utf-8', 'surrogateescape')} ")))
    return counts


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for at, to in slices(offsets):
                part, edges = data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
                inside = _TERM[part]
                begins = inside.copy()
                begins[1:] &= ~inside[:-1]
                heads = edges[:-1][np.diff(edges) > 0]
                begins[heads] = inside[heads]
                n = np.diff(np.concatenate([[0], np.cumsum(begins)])[edges])
                read = _READ[part]
                full = np.flatnonzero(n)
                counts = [count_terms(automaton, read[edges[i] : edges[i + 1]].tobytes()) for i in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at).take(pa.array(full)),
                        pa.array(n[full], pa.int64()),
                        pa.array([list(c.keys()) for c in counts], pa.list_(pa.int32())),
                        pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "tf"],
                )

    return run


def scan_documents(docs: DataFrame, automaton: ahocorasick.Automaton, id_col: str, text_col: str) -> DataFrame:
    """Per document with terms: ``doc_id``, its terms with repeats ``n``, and numbers and counts of the automaton's ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return chosen.mapInArrow(_scan(shared), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class _Best:
    """The k best documents of each item so far, among equal scores those of the least id."""

    def __init__(self, items: int, k: int):
        self.k, self.least, self.pending = k, np.ones(items, np.int64), 0
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.least[item]
        self.parts.append((item[good], score[good], doc[good], null[good]))
        self.pending += int(good.sum())
        if self.pending > max(1 << 16, 4 * self.k * len(self.least)):
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        item, score, doc, null = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        order, item = order[rank < self.k], item[rank < self.k]
        self.parts = [(item, score[order], doc[order], null[order])]
        self.pending = 0
        last = rank[rank < self.k] == self.k - 1
        self.least[item[last]] = score[order][last]
        return self.parts[0]


def _sums(cell: np.ndarray, value: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of whole numbers by cell: the cells above zero and their sums. Exact: halves of 31 bits are added as doubles."""
    if cells <= 2 * CELLS:
        low = np.bincount(cell, value & 0x7FFFFFFF, cells).astype(np.int64)
        total = (np.bincount(cell, value >> 31, cells).astype(np.int64) << 31) + low
        found = np.flatnonzero(total)
        return found, total[found]
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    total = np.add.reduceat(value[order], first)
    return cell[first][total > 0], total[total > 0]


def _score(shared, documents: int, all_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, first, members, items = shared.value
        best = _Best(items, k)
        for batch in batches:
            null = np.asarray(batch.column(0).is_null())
            doc = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            # of any size: 90 times a long text times very many documents leaves 64 bits
            m = np.array([10 + 90 * n * documents // all_terms for n in batch.column(1).to_pylist()], np.int64)
            edges = batch.column(2).offsets.to_numpy()
            term, tf = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            edges = edges - edges[0]
            owner = np.repeat(np.arange(len(m)), np.diff(edges))
            value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner]))
            spread = first[term + 1] - first[term]
            work = np.concatenate([[0], np.cumsum(spread)])[edges]
            at = 0
            while at < len(m):
                to = min(int(np.searchsorted(work, work[at] + CELLS, "right")) - 1, at + max(1, CELLS // items))
                to = max(at + 1, to)
                cut = slice(edges[at], edges[to])
                n = spread[cut]
                place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[cut]], n)
                cell = np.repeat(owner[cut] - at, n) * items + members[place]
                cells, total = _sums(cell, np.repeat(value[cut], n), (to - at) * items)
                row = cells // items + at
                best.add(cells % items, total, doc[row], null[row])
                at = to
        if best.parts:
            item, score, doc, null = best.settle()
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(doc, pa.int64(), mask=null), pa.array(score, pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return run


def _search(docs: DataFrame, pairs: list[Row], kind: str, id_col: str, text_col: str, k: int) -> DataFrame | None:
    """The best documents of the items of one automaton; None if no document has a term."""
    spark = docs.sparkSession
    terms = sorted({p["term"] for p in pairs})
    number = {t: i for i, t in enumerate(terms)}
    ids = list(dict.fromkeys(p["item_id"] for p in pairs))
    item = {x: i for i, x in enumerate(ids)}
    counted = store(scan_documents(docs, build_automaton(terms), id_col, text_col), "term-counts")
    total = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    if not total["documents"]:
        return None
    # one row per term of the automaton
    holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(total["documents"], holding.get(i, 0)) for i in range(len(terms))], np.int64)
    outputs = sorted((number[p["term"]], item[p["item_id"]]) for p in pairs)
    first = np.searchsorted([t for t, _ in outputs], np.arange(len(terms) + 1))
    shared = spark.sparkContext.broadcast((weights, first, np.array([i for _, i in outputs]), len(ids)))
    near = counted.mapInArrow(
        _score(shared, total["documents"], total["terms"], k), "item int, doc_id bigint, score bigint"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = spark.createDataFrame([(i, x) for x, i in item.items()], f"item int, item_id {kind}")
    return ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` documents of highest score above zero for each item: ``item_id``, ``rank``, ``doc_id``, ``score``.

    N documents have terms, L in all, n one document; df of them hold a term, which occurs tf times in one. A term weighs
    w = floor(1000 ln((2N + 2) / (2 df + 1))), a document has m = 10 + 90 n N div L, and its score is the sum of
    w (10^9 tf div (1000 tf + 8 m)) over the distinct terms of the item. Ids of documents are whole numbers.
    """
    pairs = store(item_terms(items, item_col, item_text_col), "item-terms")
    size = pairs.agg(F.coalesce(F.sum(F.octet_length("term") + 2), F.lit(0))).first()[0]
    groups = max(1, -(-size // AUTOMATON_BYTES))
    group = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    kind = pairs.schema["item_id"].dataType.simpleString()
    found = []
    for g in range(groups if size else 0):
        # at most about AUTOMATON_BYTES, see above
        chosen = pairs.where(group == g).collect()
        if chosen:
            found.append(_search(docs, chosen, kind, id_col, text_col, k))
    found = [x for x in found if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found)
