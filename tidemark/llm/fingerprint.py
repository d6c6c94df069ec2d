"""Document fingerprints: consistent weighted sampling of words.

A text is its words with their counts. For each of ``SAMPLES`` samples every (word, count) draws from the word
alone r, c ~ Gamma(2, 1) and b ~ Uniform(0, 1), and with t = floor(ln count / r + b) its value is
ln a = ln c - r (t - b + 1); the word of least value is the sample, together with its t. Two texts agree on a
sample with a probability that is the sum of the smaller counts over the sum of the larger ones, so the share
of equal samples estimates their generalised Jaccard similarity. Draws are hashes of the word, so equal texts
have equal fingerprints, whatever else is in the table. A fingerprint is 16 bits of hash per sample, in
hexadecimal; a text without words has zeros only, and is like another such text and no other.

Everything is DataFrame operations. Texts are shuffled once, by document; counting words, sampling and the
minima follow in the same tasks. A word's samples are drawn ``AT_ONCE`` at a time, from rows that say which,
which keeps the generated code small enough to be compiled.

The next document is the one of the next greater id, null first; rows of one id follow by their texts' hash, and
repeated rows (same id, same text) are one document whose result row is repeated. After the last comes the
first; a document alone is next to itself. Null texts are empty. Other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, written

SAMPLES, AT_ONCE = 64, 4
#: Steps per unit of ln a when values are compared, and what is added so that all are positive.
_STEPS, _SHIFT = 1 << 34, 128.0
_KEY = ["k1", "k2"]
#: A digest in four numbers that goes along with a document's words, as rows of their own: no word holds a space.
_RIDERS = ("sha0", "sha1", "sha2", "sha3")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACES}]+"), "")


def _keyed(docs: DataFrame) -> DataFrame:
    no_id = F.col("doc_id").isNull()
    key = [F.coalesce("doc_id", F.lit(0)).alias("k1"), F.xxhash64("text", no_id).alias("k2")]
    return docs.select(*key, F.coalesce("text", F.lit("")).alias("text"), no_id.cast("int").alias("no_id"))


def followers(docs: DataFrame) -> DataFrame:
    """``k1, k2, next1, next2, chars, no_id, rows``: every document, the one after it, its length, its repeated rows."""
    each = _keyed(docs).groupBy(*_KEY).agg(F.max(F.char_length("text")).alias("chars"), F.max("no_id").alias("no_id"), F.count("*").alias("rows"))
    order = [F.col("no_id").desc(), F.col("k1"), F.col("k2")]
    placed = written(each.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("n", F.monotonically_increasing_id()), "order")
    placed = placed.withColumn("part", F.shiftright("n", 33)).withColumn("row", F.col("n").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    whole = F.sum("size").over(Window.partitionBy(F.lit(0)))
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), whole.alias("total"))
    placed = placed.join(F.broadcast(bases), "part").withColumn("place", F.col("base") + F.col("row"))
    ahead = placed.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.pmod(F.col("place") - 1, F.col("total")).alias("place"))
    return written(placed.join(ahead, "place").select(*_KEY, "next1", "next2", "chars", "no_id", "rows"), "next")


def edited(docs: DataFrame, after: DataFrame) -> DataFrame:
    """``k1, k2, text, edited, riders`` of each document: the last quarter is replaced by the next text's start."""
    texts = _keyed(docs).groupBy(*_KEY).agg(F.first("text").alias("text"))  # repeated rows are one document
    cut = F.floor(F.col("chars") / 4).cast("int").alias("cut")
    asked = after.select(F.col("next1").alias("k1"), F.col("next2").alias("k2"), F.col("k1").alias("of1"), F.col("k2").alias("of2"), cut)
    starts = texts.join(asked, _KEY).select(F.col("of1").alias("k1"), F.col("of2").alias("k2"), F.expr("substring(text, 1, cut)").alias("start"))
    both = texts.join(starts, _KEY).withColumn("n", F.char_length("text"))
    both = both.select(*_KEY, "text", F.concat(F.expr("substring(text, 1, n - n div 4)"), "start").alias("edited"))
    both = both.withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    numbers = [F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(4)]
    return both.select(*_KEY, "text", "edited", F.array(*numbers).alias("riders"))


def counts(pairs: DataFrame) -> DataFrame:
    """``k1, k2, term, mine, edit``: how often a word is in the text and in the edited one; and the riders."""
    both = pairs.select(*_KEY, words(F.col("text")).alias("a"), words(F.col("edited")).alias("b"), "riders")
    names = F.array(*[F.lit(f" {name}") for name in _RIDERS])
    rows = both.select(*_KEY, F.size("a").alias("n_a"), F.size("b").alias("n_b"), "riders", F.posexplode(F.concat("a", "b", names)).alias("p", "term"))
    rider = F.col("riders")[F.col("p") - F.col("n_a") - F.col("n_b")]
    mine = F.when(F.col("p") < F.col("n_a"), F.lit(1)).when(F.col("p") < F.col("n_a") + F.col("n_b"), F.lit(0)).otherwise(rider)
    edit = (F.col("p") >= F.col("n_a")) & (F.col("p") < F.col("n_a") + F.col("n_b"))
    rows = rows.select(*_KEY, "term", mine.alias("mine"), edit.cast("bigint").alias("edit"))
    return rows.groupBy(*_KEY, "term").agg(F.sum("mine").alias("mine"), F.sum("edit").alias("edit"))


def _unit(bits: Column) -> Column:
    """32 bits as a number between 0 and 1."""
    return (bits + F.lit(0.5)) * F.lit(2.0**-32)


def samples(terms: DataFrame) -> DataFrame:
    """``k1, k2, g, a0.., b0..``: for each run of samples the least values of text and edited text, hash in the low bits."""
    numbers = range(AT_ONCE)
    is_word = ~F.col("term").startswith(" ")
    logs = [F.when(F.col(c) > 0, F.ln(c)).alias(f"ln_{c}") for c in ("mine", "edit")]
    rows = terms.where(is_word).select(*_KEY, F.xxhash64("term").alias("h"), *logs)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // AT_ONCE - 1))).alias("g"))
    number = [F.col("g") * AT_ONCE + k for k in numbers]
    rows = rows.select("*", *[F.xxhash64("h", number[k], F.lit(s)).alias(f"x{s}_{k}") for k in numbers for s in range(3)])

    def gamma(x: str) -> Column:
        return -F.ln(_unit(F.shiftrightunsigned(x, 32)) * _unit(F.col(x).bitwiseAND(0xFFFFFFFF)))

    drawn = [(gamma(f"x0_{k}").alias(f"r{k}"), F.ln(gamma(f"x1_{k}")).alias(f"c{k}"), _unit(F.shiftrightunsigned(f"x2_{k}", 32)).alias(f"u{k}")) for k in numbers]
    rows = rows.select(*_KEY, "h", "g", "ln_mine", "ln_edit", *[c for cs in drawn for c in cs])
    steps = [F.floor(F.col(f"ln_{c}") / F.col(f"r{k}") + F.col(f"u{k}")).alias(f"t_{c}{k}") for k in numbers for c in ("mine", "edit")]
    rows = rows.select("*", *steps)

    def value(c: str, k: int) -> Column:
        t = F.col(f"t_{c}{k}")
        log_a = F.col(f"c{k}") - F.col(f"r{k}") * (t - F.col(f"u{k}") + 1)
        mark = F.xxhash64("h", t, F.lit(7)).bitwiseAND(0xFFFF)
        return F.when(t.isNotNull(), F.shiftleft(((log_a + _SHIFT) * _STEPS).cast("bigint"), 16).bitwiseOR(mark))

    least = [F.min(value(c, k)).alias(f"{n}{k}") for c, n in (("mine", "a"), ("edit", "b")) for k in numbers]
    return rows.groupBy(*_KEY, "g").agg(*least)


def fingerprints(terms: DataFrame) -> DataFrame:
    """``k1, k2, fingerprint, edited_fingerprint`` and the riders of each document."""
    sampled = samples(terms)

    def text_of(name: str) -> Column:
        marks = [F.lpad(F.hex(F.coalesce(F.col(f"{name}{k}"), F.lit(0)).bitwiseAND(0xFFFF)), 4, "0") for k in range(AT_ONCE)]
        return F.lower(F.concat(*marks))

    marks = sampled.select(*_KEY, F.struct("g", text_of("a").alias("a"), text_of("b").alias("b")).alias("s"))
    riders = terms.where(F.col("term").startswith(" ")).select(*_KEY, "term", "mine")
    # words' samples and riders meet by document, where they already are
    joined = marks.groupBy(*_KEY).agg(F.array_sort(F.collect_list("s")).alias("s"))
    numbers = riders.groupBy(*_KEY).agg(*[F.max(F.when(F.col("term") == f" {n}", F.col("mine"))).alias(n) for n in _RIDERS])
    none = F.lit("0" * (SAMPLES * 4))
    return numbers.join(joined, _KEY, "left").select(
        *_KEY,
        *_RIDERS,
        F.coalesce(F.array_join(F.transform("s", lambda s: s["a"]), ""), none).alias("fingerprint"),
        F.coalesce(F.array_join(F.transform("s", lambda s: s["b"]), ""), none).alias("edited_fingerprint"),
    )


def likeness(a: str, b: str) -> Column:
    """The share of samples that two fingerprints have in common."""
    same = "aggregate(sequence(0, {n}), 0, (s, i) -> s + if(substring({a}, 4 * i + 1, 4) = substring({b}, 4 * i + 1, 4), 1, 0))"
    return F.expr(same.format(n=SAMPLES - 1, a=a, b=b)) / F.lit(float(SAMPLES))


def compare(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and its likeness to that and to the next document."""
    after = followers(docs)
    found = written(fingerprints(counts(edited(docs, after))), "fingerprints")
    ahead = found.select(F.col("k1").alias("next1"), F.col("k2").alias("next2"), F.col("fingerprint").alias("next_fingerprint"))
    near = found.join(after, _KEY).join(ahead, ["next1", "next2"])
    sha = F.lower(F.concat(*[F.lpad(F.hex(f"sha{k}"), 16, "0") for k in range(4)]))
    each = near.select(
        F.when(F.col("no_id") == 0, F.col("k1")).alias("doc_id"),
        F.col("chars").cast("bigint").alias("n_chars"),
        sha.alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
        F.explode(F.sequence(F.lit(1), "rows")).alias("row"),
    )
    return each.drop("row")
