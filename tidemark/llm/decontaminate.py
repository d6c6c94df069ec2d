"""Benchmark decontamination by a distributed positional inverted index.

Test texts are cut into windows of ``WINDOW`` words (a shorter text is one window). Terms are counted over
the whole corpus; the index stores the postings (term, document, position) of each window's rarest two
terms, which is what the windows are looked up by. Lists are intersected from the rarest term: its postings,
less the term's offset in the window, are the places where the window may start; the second term must
stand there too, at its own offset. Windows that are left over are compared word by word with the
document, so that matches are exact.

Everything is DataFrame operations. Terms and windows are tables of the test set; they are written first, so
that the optimizer knows their size, broadcasts them while they are small and shuffles them beyond that.
The corpus is read three times (count, index, compare). Postings are dealt by term and document, so that a
frequent term is not one task's. A document is known by its id and its text's hash: null ids and repeated ids
are fine, repeated rows get the same answer each.

Words are runs of digits, letters and whatever is not ASCII, A-Z in lower case. Null or empty texts have no
words, are never hit, and as test items have no window. Test items with a null id count as one item with an
empty name. Other columns of the tables are not read. An empty benchmark leaves all documents clean; an empty
corpus gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, written

WINDOW = 10
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_DOC = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), _BETWEEN), "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``phrase, terms, items``: each distinct window once, its words, and the items it is from."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("terms"))
    items = items.where(F.size("terms") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("terms") - size + 1))
    cut = items.select("item", "terms", F.explode(starts).alias("at")).select("item", F.slice("terms", F.col("at"), size).alias("terms"))
    named = cut.groupBy(F.array_join("terms", " ").alias("phrase")).agg(F.collect_set("item").alias("items"))
    return written(named.select("phrase", F.split("phrase", " ").alias("terms"), "items"), "windows")


def _postings(docs: DataFrame) -> DataFrame:
    """Every word of every document: doc_id, text_hash, position (from 0), term."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    return texts.select(*_DOC, F.posexplode("words").alias("position", "term"))


def rarest(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``phrase, first, first_at, second, second_at``: the two rarest terms of each window and their offsets.

    Terms that no document has are the rarest. A window of one word has no second term.
    """
    placed = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    terms = written(placed.select("term").distinct(), "terms")
    counted = _postings(docs).select("term").join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))
    ranked = placed.join(written(counted, "counts"), "term", "left")
    ranked = ranked.groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("by"))
    one, two = F.col("by")[0], F.get("by", F.lit(1))
    found = ranked.where(one["n"] > 0).select(
        "phrase",
        one["term"].alias("first"),
        one["offset"].alias("first_at"),
        two["term"].alias("second"),
        two["offset"].alias("second_at"),
    )
    return written(found, "rarest")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored postings of ``terms (term)``: term, doc_id, text_hash, position, in that order."""
    kept = _postings(docs).join(terms, "term").select("term", *_DOC, "position")
    salted = kept.repartition("term", F.pmod(F.col("text_hash"), F.lit(64)))
    return written(salted.sortWithinPartitions("term", *_DOC, "position"), "postings")


def phrase_candidates(index: DataFrame, lookup: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, phrase`` where a window's two rarest terms stand as they do in the window."""
    first = index.withColumnRenamed("term", "first").join(lookup, "first")
    placed = first.select(*_DOC, (F.col("position") - F.col("first_at")).alias("start"), "phrase", "second", "second_at")
    placed = placed.where("start >= 0")
    alone = placed.where("second IS NULL").select(*_DOC, "start", "phrase")
    other = index.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("term").alias("second"), F.col("position").alias("p"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")) & (placed["second"] == other["second"])
    both = placed.join(other, same & (F.col("start") + F.col("second_at") == F.col("p")), "left_semi")
    return alone.unionByName(both.select(*_DOC, "start", "phrase")).distinct()


def proximity(index: DataFrame, pairs: DataFrame, distance: int) -> DataFrame:
    """``one, two, doc_id, text_hash, position, other``: places where two terms stand ``distance`` words apart or less.

    ``pairs (one, two)`` are indexed terms. Positions meet in cells of ``distance + 1`` words and their
    neighbours, so that a list is compared with what is near, not with all of the other list.
    """
    cell = F.floor(F.col("position") / (distance + 1))
    left = index.withColumnRenamed("term", "one").join(pairs, "one").withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    right = index.select(
        F.col("term").alias("two"), F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), F.col("position").alias("other"), cell.alias("cell")
    )
    met = left.join(right, ["two", "cell"]).where(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")))
    met = met.where((F.abs(F.col("position") - F.col("other")) <= distance) & (F.col("position") != F.col("other")))
    return met.select("one", "two", *_DOC, "position", "other").distinct()


def find(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of each document as the struct ``kept``, with n_words, n_hit and ``items`` (sorted names)."""
    phrases = windows(benchmark)
    lookup = rarest(docs, phrases)
    terms = lookup.select(F.col("first").alias("term")).union(lookup.where("second IS NOT NULL").select("second")).distinct()
    index = build_index(docs, written(terms, "terms"))
    candidates = phrase_candidates(index, lookup).join(phrases, "phrase")
    of_doc = candidates.groupBy(*_DOC).agg(F.collect_list(F.struct("start", "terms", "items")).alias("candidates"))
    of_doc = written(of_doc.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "candidates"), "candidates")

    texts = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text"
    )
    joined = texts.join(of_doc, F.col("id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    cut = joined.select("kept", words(F.col("text")).alias("words"), "candidates")
    exact = F.filter("candidates", lambda c: F.slice(F.col("words"), c["start"] + 1, F.size(c["terms"])) == c["terms"])
    hits = cut.select("kept", F.size("words").cast("bigint").alias("n_words"), F.coalesce(exact, F.array()).alias("hits"))
    covered = F.flatten(F.transform("hits", lambda c: F.sequence(c["start"], c["start"] + F.size(c["terms"]) - 1)))
    return hits.select(
        "kept",
        "n_words",
        F.size(F.array_distinct(covered)).cast("bigint").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda c: c["items"])))).alias("items"),
    )
