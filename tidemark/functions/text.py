"""Text expressions for search."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What separates words, and what counts as an id query.
WORD_BREAK = r"[^\p{L}\p{N}\p{M}_]+"
ALONE = r"([\p{IsHan}\p{IsHiragana}]\p{M}*)"  # each a word of its own
MAYBE_ALONE = r"[\x{2E80}-\x{FAFF}\x{16FE0}-\x{3FFFF}]"
BLANK = "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
ID_QUERY = r"^[0-9]+$"
# End of fixed values.

GRAM = 3  # characters; a query whose pieces are all shorter is answered by a scan


def tokens(text: Column) -> Column:
    """Distinct lower-case words of a text.

    Runs of letters, digits, underscores and the marks that go with them; Han and Hiragana characters
    stand alone. A search server's Unicode word-break rules keep some strings whole
    (``example.com``) that this splits.
    """
    low = F.lower(text)
    # a range is looked up faster than a script; it holds both scripts and more
    apart = F.when(F.rlike(low, F.lit(MAYBE_ALONE)), F.regexp_replace(low, ALONE, " $1 ")).otherwise(low)
    return F.array_remove(F.array_distinct(F.split(apart, WORD_BREAK)), "")


def shares_word(text: Column, query: Column) -> Column:
    """Whether the text has any word of the query."""
    return F.arrays_overlap(tokens(text), tokens(query))


def trimmed(query: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(F.coalesce(query, F.lit("")), F.lit(BLANK))


def is_id_query(query: Column) -> Column:
    return query.rlike(ID_QUERY)


def contains_ignoring_case(column: Column, query: Column) -> Column:
    """``%`` and ``_`` in the query keep their LIKE meaning; a backslash takes the next character as it is."""
    return F.ilike(column, containing(query))


def containing(query: Column) -> Column:
    """The LIKE pattern of what contains the query."""
    escaped = F.regexp_replace(query, r"(?<!\\)((?:\\\\)*)\\([^%_\\])", "$1$2")
    return F.concat(F.lit("%"), escaped, F.lit("%"))


def grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` characters of a text in lower case; none of a shorter or missing text."""
    # one pass of a pattern that looks ahead for a gram and takes one character
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"(?s)(?=({'.' * GRAM}))."), 1)
    return F.array_distinct(F.coalesce(runs, F.array().cast("array<string>")))


def literal_pieces(pattern: str) -> list[str]:
    """What stands between the wildcards of a LIKE pattern."""
    pieces, at = [""], 0
    while at < len(pattern):
        if pattern[at] in "%_":
            pieces.append("")
        else:
            at += pattern[at] == "\\"
            pieces[-1] += pattern[at : at + 1]
        at += 1
    return pieces
