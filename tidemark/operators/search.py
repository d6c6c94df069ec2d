"""Search over the replicated rows, newest ids first; one query, or many in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark import schema as S
from tidemark.functions.text import GRAM, containing, contains_ignoring_case, grams, is_id_query, literal_pieces, shares_word, tokens, trimmed

RAREST = 4  # grams of a query that are intersected before texts are looked at
BLOCK_BITS = 6  # ids of a block of grams: as many as a bigint has bits
BLOCK = 1 << BLOCK_BITS
MOST = 1000  # up to this many rows per group are cut out before the shuffle


def matches(query: Column) -> Column:
    """Blank finds all, digits find an id, other text any shared word or the exact email or name."""
    text = trimmed(query)
    return (
        F.when(text == "", F.lit(True))
        .when(is_id_query(text), F.col("id") == text.try_cast("bigint"))
        .otherwise(shares_word(F.col("name"), text) | (F.col("email") == text) | (F.col("name") == text))
    )


def search(records: DataFrame, query: str, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    return records.where(matches(F.lit(query))).orderBy(F.col("id").desc()).limit(limit)


def write_words(records: DataFrame, path: str) -> None:
    """The table (word, id) of the records' names, laid out by word, newest ids first.

    Built once, when records are written; a frequent word is cut by id, so no task has all of it.
    """
    words = records.select(F.explode(tokens(F.col("name"))).alias("word"), "id")
    newest = F.col("id").desc()
    words.repartitionByRange("word", newest).sortWithinPartitions("word", newest).write.parquet(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word STRING, id BIGINT").parquet(path)


def search_words(records: DataFrame, words: DataFrame, query: str, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    """``search`` by a table of words: the query's words are pushed to its reader, texts are not looked into.

    What the words do not answer (blank and id queries, exact email or name) are plain filters.
    """
    asked = records.sparkSession.range(1).select(trimmed(F.lit(query)).alias("text"), tokens(trimmed(F.lit(query))).alias("words"))
    text, wanted = asked.first()  # one row
    if not text or text.isascii() and text.isdigit():
        return search(records, query, limit)
    exact = records.where((F.col("email") == text) | (F.col("name") == text)).select("id")
    by_word = words.where(F.col("word").isin(wanted)).select("id")
    newest = by_word.union(exact).distinct().orderBy(F.col("id").desc()).limit(limit)
    return records.join(newest, "id", "left_semi").orderBy(F.col("id").desc())


def _holds(query: str) -> Column:
    q = F.lit(query)
    return (
        contains_ignoring_case(F.col("email"), q)
        | contains_ignoring_case(F.col("name"), q)
        | (F.col("id").cast("string") == q)
    )


def search_like(records: DataFrame, query: str, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    """Rows whose email or name contains the query in any case, or whose id it is."""
    return records.where(_holds(query)).orderBy(F.col("id").desc()).limit(limit)


def write_grams(records: DataFrame, path: str) -> None:
    """The table (gram, block, ids) of emails and names, laid out by gram, newest ids first.

    A block is ``BLOCK`` ids in a row, ``ids`` a bit for each that has the gram; rows that lie together by id are put
    together before the shuffle, and a text is cut up once. A gram that stands in very many rows is cut by block, so no
    task has all of it. Rows without an id are left out.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("id").bitwiseAND(BLOCK - 1).cast("int"))
    both = F.explode(F.concat(grams(F.col("email")), grams(F.col("name")))).alias("gram")
    found = records.where(F.col("id").isNotNull()).select(both, F.shiftright("id", BLOCK_BITS).alias("block"), bit.alias("bit"))
    rows = found.groupBy("gram", "block").agg(F.bit_or("bit").alias("ids"))
    newest = F.col("block").desc()
    rows.repartitionByRange("gram", newest).sortWithinPartitions("gram", newest).write.parquet(path)


def read_grams(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gram STRING, block BIGINT, ids BIGINT").parquet(path)


def query_grams(spark: SparkSession, query: str) -> list[str]:
    """Grams that a text must have to contain the query, wildcards between them left out."""
    pattern = spark.range(1).select(F.lower(containing(F.lit(query)))).first()[0]  # as ILIKE sees it
    pieces = literal_pieces(pattern)
    return sorted({piece[at : at + GRAM] for piece in pieces for at in range(len(piece) - GRAM + 1)})


def search_grams(records: DataFrame, table: DataFrame, query: str, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    """``search_like`` by a table of grams (``write_grams``) of the same records; null ids aside, the same rows.

    The query's grams are pushed to the table's reader and counted; ids that have the rarest of them are candidates,
    whose texts are looked at. A query too short for a gram is a scan.
    """
    spark = records.sparkSession
    wanted = query_grams(spark, query)[:MOST]  # any of them narrow the candidates, the texts decide
    if not wanted:
        return search_like(records, query, limit)
    counts = table.where(F.col("gram").isin(wanted)).groupBy("gram").agg(F.sum(F.bit_count("ids")).alias("n")).collect()
    rows_of = dict.fromkeys(wanted, 0) | {r["gram"]: r["n"] for r in counts}  # one row per gram asked for
    rarest = sorted(wanted, key=lambda gram: (rows_of[gram], gram))[:RAREST]
    if not rows_of[rarest[0]]:
        rarest = rarest[:1]  # no text has it
    blocks = table.where(F.col("gram").isin(rarest)).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.bit_and("ids").alias("ids"))
    blocks = blocks.where((F.col("n") == len(rarest)) & (F.col("ids") != 0))
    placed = blocks.select("block", "ids", F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))).alias("at"))
    candidates = placed.where(F.getbit("ids", F.col("at")) == 1).select((F.col("block") * BLOCK + F.col("at")).alias("id"))
    if query.isascii() and query.isdigit():
        candidates = candidates.union(spark.range(1).select(F.lit(query).try_cast("bigint")))
    near = records.join(candidates, "id", "left_semi")
    return near.where(_holds(query)).orderBy(F.col("id").desc()).limit(limit)


def _terms(kind: str, values: Column) -> Column:
    return F.transform(values, lambda value: F.struct(F.lit(kind).alias("kind"), value.alias("term")))


def record_terms(records: DataFrame, *columns: str) -> DataFrame:
    """``kind, term`` of everything a query can match a row by, with its id and the columns named.

    A name without words can only match as a whole. Words are taken from each text once.
    """
    none = F.array().cast("array<string>")
    worded = records.select("id", "email", "name", *columns, F.coalesce(tokens(F.col("name")), none).alias("_words"))
    whole_name = F.when(F.size("_words") == 0, F.array("name")).otherwise(none)
    sized = worded.select(
        "id", *columns, F.size("_words").alias("_n"),
        F.concat("_words", whole_name, F.array("email"), F.array(F.col("id").cast("string"))).alias("_terms"),
    )
    placed = sized.select("id", *columns, "_n", F.size("_terms").alias("_all"), F.posexplode("_terms").alias("_at", "term"))
    kind = F.when(F.col("_at") < F.col("_n"), "word").when(F.col("_at") == F.col("_all") - 1, "id")
    kind = kind.when(F.col("_at") == F.col("_all") - 2, "email").otherwise("name")
    return placed.select("id", *columns, kind.alias("kind"), "term")


def query_terms(queries: DataFrame) -> DataFrame:
    text = trimmed(F.col("query"))
    any_of = F.concat(
        _terms("word", tokens(text)), _terms("name", F.array(text)), _terms("email", F.array(text))
    )
    looked_for = (
        F.when(text == "", _terms("all", F.array(F.lit(""))))
        .when(is_id_query(text), _terms("id", F.array(text.try_cast("bigint").cast("string"))))
        .otherwise(any_of)
    )
    return queries.select("query_id", F.inline(looked_for)).where(F.col("term").isNotNull())


def _newest_per_term(terms: DataFrame, limit: int) -> DataFrame:
    per_term = Window.partitionBy("kind", "term").orderBy(F.col("id").desc())
    return terms.withColumn("_rank", F.row_number().over(per_term)).where(F.col("_rank") <= limit).drop("_rank")


def _newest_wanted(terms: DataFrame, wanted: DataFrame, limit: int) -> DataFrame:
    """The newest rows of each term that some query asks for; other words leave their task only if the
    terms asked for are too many for the optimizer to send them to every task."""
    asked = wanted.select("kind", "term").distinct()
    return _newest_per_term(terms.join(asked, ["kind", "term"], "left_semi").select("kind", "term", "id"), limit)


def search_many(records: DataFrame, queries: DataFrame, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    """The first ``limit`` ids of each (query_id, query), ranked; ``limit`` is ``MOST`` at most.

    A query's newest matches are among the newest matches of its terms, so each term keeps only
    its newest ``limit`` rows, cut down before the shuffle, before it meets the queries. A word
    found in every row, or a query that matches all of them, costs ``limit`` rows per task.
    """
    return _search_many(record_terms(records), records, queries, limit)


def search_many_terms(terms: DataFrame, queries: DataFrame, limit: int = S.SEARCH_SHOWN) -> DataFrame:
    """``search_many`` by a table of terms (``record_terms``) that was made before: no text is looked into."""
    return _search_many(terms, terms.where("kind = 'id'"), queries, limit)


def asked_for(queries: DataFrame) -> Column | None:
    """What a reader of terms can be given: the queries' terms, up to ``MOST`` of them; None if there are more.

    A query that finds all rows needs every id.
    """
    found = query_terms(queries).select("kind", "term").distinct().limit(MOST + 1).collect()  # a bounded number of rows
    if len(found) > MOST:
        return None
    by_term = F.col("term").isin([r["term"] for r in found])
    return by_term | (F.col("kind") == "id") if any(r["kind"] == "all" for r in found) else by_term


def _search_many(terms: DataFrame, ids: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    if limit > MOST:
        raise ValueError(f"limit is {limit}; a word in every row would gather more than {MOST} rows per task")
    wanted = query_terms(queries)
    newest_of_all = ids.orderBy(F.col("id").desc()).limit(limit).select(
        F.lit("all").alias("kind"), F.lit("").alias("term"), "id"
    )
    newest = _newest_wanted(terms, wanted, limit).unionByName(newest_of_all)
    # An id found by several terms has one dense rank, so the cut per query needs no distinct first.
    per_query = Window.partitionBy("query_id").orderBy(F.col("id").desc())
    return (
        newest.join(wanted, ["kind", "term"])
        .select("query_id", F.dense_rank().over(per_query).alias("rank"), "id")
        .where(F.col("rank") <= limit)
        .distinct()
        .select("query_id", F.col("rank").cast("bigint").alias("rank"), "id")
    )


def record_detail(source: DataFrame, sink: DataFrame) -> DataFrame:
    """Source row and sink document side by side; either may be missing."""
    side = lambda rows, name: rows.select(
        "id", F.col("version").alias(f"{name}_version"), F.col("updated_at").alias(f"{name}_updated_at")
    )
    return side(source, "source").join(side(sink, "sink"), "id", "full_outer")


def by_number(rows: DataFrame, column: str = "id", descending: bool = False) -> DataFrame:
    """Rows in the numeric order of an id that is text."""
    number = F.col(column).cast("bigint")
    return rows.orderBy(number.desc() if descending else number)
