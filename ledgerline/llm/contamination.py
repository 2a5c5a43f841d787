"""Benchmark decontamination by winnowing, with DataFrame functions only.

A window is ``WINDOW`` consecutive words.  Of the hashes of its ``GRAM``-word strings the
smallest is its fingerprint, so any window that a document shares with an item has the
same fingerprint in both: no shared span of that length is missed.  Neighbouring windows
mostly share their fingerprint, which leaves a third of them to be joined.

1. Every document's distinct fingerprints are written once, then joined to the items'.
2. Hits are extended: only the windows of hit documents whose fingerprint was met are
   spelled out and joined to the items' windows by their words.

Items with fewer words than a window are windows of their own length, whose hash is
their fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.sources.staging import stage

WINDOW = 13
GRAM = 8

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered, as strings that are equal where the words are.

    Bytes are read as Latin-1, so lowering leaves each character's kind to its number of
    trailing bytes and only A-Z can become equal to another word byte for byte.
    """
    plain = F.lower(F.decode(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), "ISO-8859-1"))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def _places(of: Column, width: Column | int) -> Column:
    """1-based starts of the runs of ``width`` elements; empty if there are too few."""
    n = F.size(of) - width + 1
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _marks(hashes: Column, length: int) -> Column:
    """The fingerprint of every window of ``length`` words, by the window's start."""
    if length < WINDOW:
        return F.transform(_places(hashes, length), lambda i: F.xxhash64(F.slice(hashes, i, length), F.lit(length)))
    grams = F.transform(_places(hashes, GRAM), lambda i: F.xxhash64(F.slice(hashes, i, GRAM)))
    span = WINDOW - GRAM + 1
    return _let(grams, lambda g: F.transform(_places(g, span), lambda i: F.array_min(F.slice(g, i, span))))


def _marks_near(length: int, body):
    """For ``_let``: ``body`` of the fingerprints of bound word hashes."""
    return lambda hashes: _let(_marks(hashes, length), body)


def _hashes(of: Column) -> Column:
    return F.transform(of, lambda w: F.xxhash64(w))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["text_key"].eqNullSafe(b["text_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def item_windows(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """``item_id, length, window, mark`` of all items, written once, and the lengths that occur.

    There are at most ``WINDOW`` lengths.
    """
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words"))
    split = split.where(F.size("words") > 0)
    short = F.size("words") < WINDOW
    whole = split.where(short).select("item_id", F.size("words").alias("length"), F.col("words").alias("window"))
    place = F.explode(_places(F.col("words"), WINDOW)).alias("i")
    full = split.where(~short).select("item_id", "words", place)
    full = full.select("item_id", F.lit(WINDOW).alias("length"), F.slice("words", F.col("i"), WINDOW).alias("window"))
    both = whole.unionByName(full)
    mark = F.lit(None).cast("long")
    for length in range(1, WINDOW + 1):
        mark = F.when(F.col("length") == length, _marks(_hashes(F.col("window")), length)[0]).otherwise(mark)
    made = both.withColumn("mark", mark).withColumn("window", F.array_join("window", " ")).distinct()
    made = stage(made, "windows")
    return made, sorted(r.length for r in made.select("length").distinct().collect())


def contamination(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, item_ids, contaminated, text_key`` for every row of ``docs``.

    A word is hit if it lies in an occurrence of an item's window; ``item_ids`` are the
    items with occurring windows, in ascending order; a document is contaminated from
    a hit word in ``share``.  Null and empty texts have no words and no hits; items with null
    or wordless texts have no windows; repeated rows, and rows with a null or repeated
    doc_id, are judged each by its own text; repeated item_ids count as one item; other
    columns are ignored; an empty table gives no rows.
    """
    windows, lengths = item_windows(items)
    keyed = _keyed(docs)

    # 1. fingerprints of all documents, with their numbers of words
    def prints(w: Column) -> Column:
        def of(h: Column) -> Column:
            return F.array_distinct(F.concat(F.array().cast("array<bigint>"), *[_marks(h, n) for n in lengths]))

        return F.struct(F.size(w).cast("long").alias("n_words"), _let(_hashes(w), of).alias("prints"))

    made = keyed.select("doc_id", "text_key", _let(words(F.col("text")), prints).alias("x"))
    made = stage(made.select("doc_id", "text_key", "x.n_words", "x.prints"), "prints")
    marks = stage(windows.select("mark").distinct(), "marks")
    exploded = made.select("doc_id", "text_key", F.explode("prints").alias("mark"))
    met = exploded.join(marks, "mark").groupBy("doc_id", "text_key").agg(F.collect_set("mark").alias("met"))
    met = stage(met, "met")

    # 2. windows of hit documents whose fingerprint was met, compared by their words
    # written first, so that only hit documents are split into words again
    hit = stage(keyed.join(met, _same(keyed, met)).select(keyed["doc_id"], keyed["text_key"], "met", "text"), "hit")
    hit = hit.select("doc_id", "text_key", "met", words(F.col("text")).alias("words"))
    spelled = None
    for length in lengths:
        near = lambda m: F.filter(_places(m, 1), lambda i: F.array_contains(F.col("met"), F.element_at(m, i)))
        found = _let(_hashes(F.col("words")), _marks_near(length, near))
        some = hit.select("doc_id", "text_key", "words", F.explode(found).alias("start")).select(
            "doc_id", "text_key", "start", F.lit(length).alias("length"),
            F.array_join(F.slice("words", F.col("start"), length), " ").alias("window"),
        )
        spelled = some if spelled is None else spelled.unionByName(some)
    if spelled is None:
        counts = made.select("doc_id", "text_key", "n_words")
        return counts.select(
            "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
            F.array().cast("array<string>").alias("item_ids"), F.lit(False).alias("contaminated"), "text_key",
        )
    hits = spelled.distinct().join(windows.select("length", "window").distinct(), ["length", "window"])
    hits = stage(hits, "hits")

    # words in the union of the hit ranges, range by range in order of their starts
    ends = hits.select("doc_id", "text_key", "start", (F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("doc_id", "text_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    done = F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    added = ends.select("doc_id", "text_key", F.greatest(F.col("end") - done, F.lit(0)).alias("added"))
    n_hit = added.groupBy("doc_id", "text_key").agg(F.sum("added").alias("n_hit"))
    pairs = hits.select("doc_id", "text_key", "length", "window").distinct().join(windows, ["length", "window"])
    found = pairs.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    both = n_hit.join(found, _same(n_hit, found)).select(n_hit["doc_id"], n_hit["text_key"], "n_hit", "item_ids")
    every = made.select("doc_id", "text_key", "n_words")
    joined = every.join(both, _same(every, both), "left").select(
        every["doc_id"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), every["text_key"],
    )
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return joined.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids",
        bad.alias("contaminated"), "text_key",
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = contamination(docs, items).where("contaminated").select(F.col("doc_id").alias("bad_id"), "text_key").distinct()
    bad = stage(bad, "bad")
    same = docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["text_key"])
    return docs.join(bad, same, "left_anti")
