"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame expressions only.

A sketch is the ascending array of the K least 64-bit hashes of a text's distinct shingles (all of them if fewer). The
sketch of a union is the K least of both sketches, so parts merge; equal texts have equal sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from skein.storage import shuffle_partitions

K, WIDTH = 128, 5
_SPACES = "' ' || char(9) || char(10) || char(11) || char(12) || char(13)"


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words, maximal runs without ASCII white space; an empty array for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.expr(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(trimmed, "[\\x20\\x09-\\x0D]+"), lambda w: F.xxhash64(w)))


def sketch(hashes: str, k: int = K, width: int = WIDTH) -> Column:
    """Sketch of the shingles of a column of word hashes; fewer words than width make one shingle, none an empty sketch."""
    h = F.col(hashes)
    part = lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(width)))
    many = F.transform(F.sequence(F.lit(0), F.size(h) - width), part)
    grams = F.when(F.size(h) >= width, many).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return F.slice(F.sort_array(F.array_distinct(grams)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1; two empty sketches are alike."""
    u = merge(a, b, k)
    return F.when(F.size(u) == 0, 1.0).otherwise(F.size(F.array_intersect(u, F.array_intersect(a, b))) / F.size(u))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b, 0 to 1; an empty a is in anything."""
    j = resemblance(a, b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j * distinct_shingles(merge(a, b, k), k) / distinct_shingles(a, k)))


def as_text(a: Column) -> Column:
    """16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _ranges(docs: DataFrame, id_col: str, rows_a_range: int = 2000) -> tuple[DataFrame, int]:
    """docs with _range, its number among ranges of ids cut at quantiles (null ids come first), and how many there may be."""
    count, low = docs.select(F.count(F.lit(1)), F.min(id_col)).first()
    n = int(max(1, min(10_000, max(4 * shuffle_partitions(docs.sparkSession), count // rows_a_range))))
    cuts = docs.select(F.percentile_approx(id_col, [i / n for i in range(1, n)], 20_000)).first()[0] if n > 1 and low is not None else []
    cuts = sorted(set(cuts or []))
    if not cuts:
        return docs.withColumn("_range", F.lit(0)), 1
    step = max(1, int(len(cuts) ** 0.5))  # two short searches instead of a long one
    coarse = F.array(*map(F.lit, cuts[::step]))
    fine = F.array(*(F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step)))
    first = docs.withColumn("_coarse", F.when(F.col(id_col).isNull(), 0).otherwise(F.size(F.filter(coarse, lambda x: x <= F.col(id_col)))))
    inner = F.size(F.filter(F.get(fine, F.col("_coarse") - 1), lambda x: x <= F.col(id_col)))
    return first.withColumn("_range", F.when(F.col("_coarse") > 0, (F.col("_coarse") - 1) * step + inner).otherwise(0)).drop("_coarse"), len(cuts) + 1


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last quarter gives way to the start of the next text.

    Columns: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and estimates
    n_shingles and contained_in_edited. Null texts are empty. Null ids come first, equal ids in the order of their texts.
    Repeated rows each have a row, and are each other's next; a single row is its own next. An empty table gives an empty
    result. Other columns take no part.

    Each text and its sketch are shuffled once, into ranges of ids; the row after a range's last is the first of the next
    range, whose text is joined by the number of its range. Only ids and numbers of ranges (at most 10,000) meet in one task.
    Ids are numbers: cast or number others first. Rows of one id are one range.
    """
    if not isinstance(docs.schema[id_col].dataType, NumericType):
        raise TypeError(f"{id_col} must be a number, as ranges of ids are cut at quantiles")
    base = docs.select(F.col(f"`{id_col}`").alias("k"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    dealt, _ = _ranges(base, "k")

    def sketched(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("h", word_hashes(F.col("t"))).withColumn(name, sketch("h", k, width)).drop("h")

    least = dealt.groupBy("_range").agg(F.min(F.struct(F.col("k").isNotNull().alias("n"), F.col("k").alias("k"))).alias("m"))
    order = Window.orderBy("_range")  # a number and an id a range
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_range").over(order), F.last("_range").over(whole))
    numbered = least.select(F.col("_range").alias("hr"), F.col("m.k").alias("hk"), before.alias("before"))
    firsts = dealt.join(F.broadcast(numbered), (F.col("_range") == F.col("hr")) & F.col("k").eqNullSafe(F.col("hk")))  # at most 10,000 ids
    heads = sketched(firsts.groupBy("before").agg(F.min("t").alias("t")), "s")
    own = F.struct("t", "s")
    after = heads.select(F.col("before").alias("_range"), own.alias("head"))
    w = Window.partitionBy("_range").orderBy(F.col("k").asc_nulls_first(), "t")
    led = sketched(dealt, "s").withColumn("next", F.lead(own).over(w)).join(after, "_range", "left").withColumn("next", F.coalesce("next", "head"))
    n = F.char_length("t")
    quarter = F.floor(n / 4).cast("int")
    edited = led.select("k", "s", F.col("next.s").alias("s2"), n.cast("long").alias("n_chars"), F.concat(F.substring("t", F.lit(1), n - quarter), F.substring("next.t", F.lit(1), quarter)).alias("e"))
    hashed = edited.withColumn("h", word_hashes(F.col("e"))).withColumn("e2", sketch("h", k, width))
    return hashed.select(
        F.col("k").alias(id_col), "n_chars", F.sha2(F.encode("e", "UTF-8"), 256).alias("edited_sha256"), as_text(F.col("s")).alias("fingerprint"), as_text(F.col("e2")).alias("edited_fingerprint"),
        resemblance(F.col("s"), F.col("e2"), k).alias("near_edited"), resemblance(F.col("s"), F.col("s2"), k).alias("near_next"), distinct_shingles(F.col("s"), k).alias("n_shingles"), containment(F.col("s"), F.col("e2"), k).alias("contained_in_edited"),
    )
