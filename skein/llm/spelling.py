"""Spelling variants of a corpus: words one edit apart, by forward and reversed sorted dictionaries.

One edit leaves one half of a word intact. Let a and b be one edit apart, a of length L and b of length L or L + 1. They agree
up to some place p, and from p + 1 on in a. If p lies in the window [s, e) of a's places, then a without the window and b
without its (one character longer) window are equal, so both stand in the block of that key. Windows of the first level are the
halves of a: words with a common first half are neighbours in the sorted dictionary, words with a common second half in the
dictionary of reversed words. A word is looked for as the shorter and as the longer of a pair, so it has four rows.

A block of more than BLOCK words is subdivided: its words go on with both halves of the window, until blocks are small or the
window is one character long (then at most as many words share it as there are characters). Blocks are dealt by ranges of their
keys and scanned in order; within a task the same subdivision goes on down to SCAN words, which are compared. A pair
counts in the window that holds p, so once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.chunks import arrow_map
from skein.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a block that one task works on; larger blocks are subdivided by Spark.
BLOCK = 512
#: Rows that are compared with each other.
SCAN = 24
#: Rows of the dictionaries that one task scans.
TASK_ROWS = 50_000
#: A block: length of the shorter word, first and last (exclusive) place of the window, what is before and (backwards) after it.
KEYS = ["size", "at", "upto", "head", "tail"]


def corpus_words(docs: DataFrame, least: int = 7, twice: int = 2, drop_one_in: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of `least` or more characters, that occur `twice` or more.

    h is the CRC-32 of `<id>:<run>`; where drop_one_in divides it, the run loses its character h % length. A null text has no
    runs, a null id is the empty string. Repeated rows count as often as they stand there.
    """
    run = "[A-Za-z\\u00C0-\\u00FF]{%d,}" % least
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("k"), F.explode(F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(run), F.lit(0))).alias("w"))
    rows = rows.withColumn("w", F.translate("w", UPPER, LOWER))
    rows = rows.withColumn("h", F.crc32(F.encode(F.concat("k", F.lit(":"), "w"), "UTF-8")))
    less = F.expr("concat(substring(w, 1, int(h % length(w))), substring(w, int(h % length(w)) + 2))")
    found = rows.select(F.when(F.col("h") % drop_one_in == 0, less).otherwise(F.col("w")).alias("word")).filter(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= twice)


def _windows(rows: DataFrame, windows: F.Column) -> DataFrame:
    """Rows of words (word, n, size and what stays) in the blocks of the given windows (array of at, upto)."""
    longer = F.length("word") - F.col("size")
    rows = rows.select("word", "n", "size", F.explode(windows).alias("x")).select("word", "n", "size", "x.at", "x.upto")
    return rows.select("word", "n", "size", "at", "upto", F.expr("substring(word, 1, at)").alias("head"), F.reverse(F.substring("word", F.col("upto") + longer + 1, F.length("word"))).alias("tail"))


def _halves(at: F.Column, upto: F.Column) -> F.Column:
    middle = F.floor((at + upto) / 2).cast("int")
    return F.array(F.struct(at.alias("at"), middle.alias("upto")), F.struct(middle.alias("at"), upto.alias("upto")))


def dictionaries(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, *KEYS) of words (word, n): four rows a word, more for those of subdivided blocks. No block that can be divided has over `block` rows."""
    sizes = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size")).filter(F.col("size") >= 1)
    todo, done = materialize(_windows(sizes, _halves(F.lit(0), F.col("size"))), "spelling-rows"), []
    while True:
        large = materialize(todo.groupBy(*KEYS).agg(F.count("*").alias("rows")).filter((F.col("rows") > block) & (F.col("upto") - F.col("at") > 1)).select(*KEYS), "spelling-large")
        if large.isEmpty():
            return reduce(DataFrame.union, [*done, todo])
        done.append(todo.join(large, KEYS, "left_anti").select(*todo.columns))
        todo = materialize(_windows(todo.join(large, KEYS, "left_semi"), _halves(F.col("at"), F.col("upto"))).select(*todo.columns), "spelling-rows")


def _edit(a: str, b: str, last: bool) -> bool:
    """Whether a and b, both windows of a block, differ by one replaced character or by one that b has more.

    last: a's window ends its word. If it doesn't, a character added after all of a counts in a later window.
    """
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    p = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[p:] == b[p + 1 :] and (p < len(a) or last)


def near_in_block(block: list[tuple[str, int]], size: int, at: int, upto: int) -> Iterator[tuple[str, int, str, int]]:
    """Pairs of a block, first those of the shorter word's length; large blocks are subdivided."""
    todo = [(block, at, upto)]
    while todo:
        rows, at, upto = todo.pop()
        if len(rows) > SCAN and upto - at > 1:
            middle = (at + upto) // 2
            left, right = defaultdict(list), defaultdict(list)
            for r in rows:
                more = len(r[0]) - size
                left[r[0][middle + more : upto + more]].append(r)
                right[r[0][at:middle]].append(r)
            todo += [(x, at, middle) for x in left.values() if len(x) > 1]
            todo += [(x, middle, upto) for x in right.values() if len(x) > 1]
            continue
        last = upto == size
        short = [(w[at:upto], w, n) for w, n in rows if len(w) == size]
        long = [(w[at : upto + 1], w, n) for w, n in rows if len(w) > size]
        for i, (x, w, n) in enumerate(short):
            for group in (short[i + 1 :], long):
                for y, v, m in group:
                    if _edit(x, y, last):
                        yield w, n, v, m


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n, near, near_n): each two of the words (word, n; a word once) that are one edit apart, in both orders."""
    rows = materialize(dictionaries(words, block), "spelling-dictionaries")
    tasks = max(1, min(100_000, rows.count() // TASK_ROWS + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, found = None, [], []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(len(KEYS) + 2)]
            for word, n, *k in zip(*cols, strict=True):
                if k != key:
                    if len(block) > 1:
                        found += near_in_block(block, *key[:3])
                    key, block = k, []
                block.append((word, n))
            if len(found) > 1000:
                yield both(found)
                found = []
        if len(block) > 1:
            found += near_in_block(block, *key[:3])
        yield both(found)

    def both(found: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
        w, n, v, m = map(list, zip(*found, strict=True)) if found else ([], [], [], [])
        return pa.RecordBatch.from_pydict({"word": pa.array(w + v, pa.string()), "n": pa.array(n + m, pa.int64()), "near": pa.array(v + w, pa.string()), "near_n": pa.array(m + n, pa.int64())})

    dealt = rows.repartitionByRange(tasks, *KEYS).sortWithinPartitions(*KEYS)
    return arrow_map(dealt, scan, "word string, n long, near string, near_n long")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form), each word once and without cycles: forms followed to the last, twice as far each round."""
    spark, now = links.sparkSession, materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = materialize(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, times: int = 10, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n; a word once).

    A word's form is the most frequent word one edit apart (of equals the first in code-point order), if that is at least
    `times` as frequent; else null, and so is form_n. The root is the last of the forms after it, or the word. `times` must be
    more than 1, so that forms end. An empty table gives an empty one; very long words are compared like others; a word that
    stands twice must be summed before; other columns take no part.
    """
    if times <= 1:
        raise ValueError("times must be more than 1")
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, block).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near"))).alias("best"))
    found = words.join(near, "word", "left")
    has_form = -F.col("best.rank") >= F.col("n") * times
    found = materialize(found.select("word", F.when(has_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, -F.col("best.rank")).alias("form_n")), "spelling-forms")
    ends = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
