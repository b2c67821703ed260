"""Documents that hold passages of benchmark items: found, and removed whole or by their spans.

The distinct n-word windows of the benchmark are a hash table on every executor. Each window of each document is
looked up in a bitmap of the hashes of first words; those that pass are looked up in the table by their words
themselves, which verifies the hit. One pass over the documents does it all, and only hits and one row
per document are shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of digits, a-z and everything beyond ASCII, after A-Z are lower-cased. Other characters are gaps.
_GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_UPPER = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
#: Beyond so many benchmark windows (about 250 bytes each) the lookup is a shuffled join.
BROADCAST_WINDOWS = 400_000
#: First words of a window that the bitmap knows, and its bits. A full bitmap lets more windows pass, no less.
PREFIX, BITS = 3, 1 << 18


def normal_words(text: Column) -> Column:
    """The words of a text; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _UPPER + _GAPS, _UPPER.lower() + " " * len(_GAPS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _slot(words: list[Column]) -> Column:
    """The bit of some first words; null ones do not count."""
    return F.xxhash64(*words).bitwiseAND(F.lit(BITS - 1)).cast("int")


def item_windows(benchmark: DataFrame, size: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Columns window (its words) and items (ids of the items that hold it).

    An item of fewer words than ``size``, but not none, is one window. Items with a null id give windows, but no id.
    """
    items = benchmark.select(
        F.col(id_col).cast("string").alias("item_id"), normal_words(F.col(text_col).cast("string")).alias("words")
    )
    begins = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        items.where(F.size("words") > 0)
        .select("item_id", F.explode(F.transform(begins, lambda i: F.slice("words", i, size))).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, row_key (hash of the text), n_words, hits (numbers of its words inside a benchmark
    window), items (their ids).

    Both sides are lower-cased (A-Z) and cut into words; a window is ``size`` consecutive words, or all words of an item
    that has fewer. ``items`` are strings in ascending order.

    A null or wordless text has no words and no hits. Rows that repeat a doc_id are judged each by its own text; rows
    with a null doc_id are judged too. Repeated items count once, items without words never, and items without an id count for hits but are not in ``items``. Other columns are
    ignored. Without documents there are no rows, without items no hits.
    """
    windows = item_windows(benchmark, size, item_col, item_text_col)
    first_words = windows.select(
        F.size("window").alias("n"), _slot([F.get("window", F.lit(k)) for k in range(PREFIX)]).alias("slot")
    )
    n_windows, slots = windows.count(), first_words.groupBy("n").agg(F.collect_set("slot")).collect()
    if n_windows <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    text = F.col(text_col).cast("string")
    split = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row_key"), normal_words(text).alias("words")
    )

    def of_length(n: int, slots: list[int]) -> Column:
        bits = np.zeros(BITS // 64, np.uint64)
        np.bitwise_or.at(bits, np.array(slots) >> 6, np.uint64(1) << (np.array(slots) & 63).astype(np.uint64))
        bitmap = F.lit(bits.view(np.int64))

        def may_begin(i: Column) -> Column:
            slot = _slot([F.get("words", i + k) for k in range(min(n, PREFIX))])
            word = F.get(bitmap, F.shiftright(slot, 6))
            return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)))) != 0

        begins = F.when(F.size("words") >= n, F.sequence(F.lit(0), F.size("words") - n)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            F.filter(begins, may_begin),
            lambda i: F.struct(
                (i + 1).alias("at"), F.lit(0).alias("n_words"), F.slice("words", i + 1, n).alias("window")
            ),
        )

    # one row without a window stands for the document itself; no other column of words may outlive the inline()
    self_row = F.array(
        F.struct(
            F.lit(0).alias("at"), F.size("words").alias("n_words"), F.lit(None).cast("array<string>").alias("window")
        )
    )
    scanned = split.select("doc_id", "row_key", F.inline(F.concat(self_row, *(of_length(*r) for r in slots))))
    found = scanned.join(windows, "window", "left").where("at = 0 or items is not null")
    covered = F.when(F.col("at") > 0, F.sequence("at", F.col("at") + F.size("window") - 1))
    return (
        found.groupBy("doc_id", "row_key")
        .agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if(F.col("at") == 0).cast("int").alias("copies"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(covered)))).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        .select("doc_id", "row_key", "n_words", "hits", "items", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        .drop("copy")
    )
