"""Search for what a text contains, from a table of grams: the same rows as a scan."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import literal_pieces
from tidemark.operators import search
from tidemark.session import new_dir

NAMES = ["Ada Löve", "ada  LOVE", "ΟΔΟΣ Σίγμα", "100% sure_thing", "back\\slash", "東京都庁 tower", None, "", "ab", "\U0001f600\U0001f600\U0001f600 ok", "İstanbul", "line\nbreak"]


@pytest.fixture(scope="module")
def given(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice([f"User{i}@x.org", None, "", f"a_{i}%b@y.net"]), draw.choice(NAMES)) for i in range(-5, 400)]
    records = spark.createDataFrame([*rows, *rows[:9]], "id BIGINT, email STRING, name STRING").repartition(4)
    path = new_dir(spark, "grams")
    search.write_grams(records, path)
    return records, search.read_grams(spark, path)


@pytest.mark.parametrize(
    "query",
    ["user1", "SER1_3@", "ada", "ada%love", "LÖVE", "ΟΔΟΣ", "Σίγμα", "100\\% s", "e_thing", "sure\\_th", "k\\\\sla", "東京都", "ab", "", "%", "_", "42", "-3", "007", "399"]
    + ["\U0001f600\U0001f600\U0001f600", "istanbul", "İST", "ne\nbr", "nobody here", "x.org%zzz", "a\\bc", "tower\\", "user" * 600, "99999999999999999999"],
)
def test_equal_to_a_scan(given, query):
    records, table = given
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(search.search_grams(records, table, query, 10**6)) == rows(search.search_like(records, query, 10**6))
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(search.search_grams(records, table, query, 7)) == ids(search.search_like(records, query, 7))


def test_reader_is_given_the_rarest_grams(given):
    records, table = given
    found = search.search_grams(records, table, "user12")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [" in plan and "r12" in plan
    assert table.where(F.length("gram") != 3).isEmpty()


def test_neighbours_share_a_row(spark):
    records = spark.range(-64, 128).select("id", F.lit("a😀b😀").alias("email"), F.lit(None).cast("string").alias("name"))
    path = new_dir(spark, "grams")
    search.write_grams(records, path)
    table = search.read_grams(spark, path)
    assert sorted(r["gram"] for r in table.collect()) == sorted(["a😀b", "😀b😀"] * 3)
    assert [r["id"] for r in search.search_grams(records, table, "😀B", 200).collect()] == [*range(127, -65, -1)]


def test_empty_table(spark, given):
    none = given[0].limit(0)
    path = new_dir(spark, "grams")
    search.write_grams(none, path)
    assert search.search_grams(none, search.read_grams(spark, path), "user1").collect() == []


def test_pieces():
    assert literal_pieces("%a\\%b_c\\\\%") == ["", "a%b", "c\\", ""]
