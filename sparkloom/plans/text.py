"""Vocabulary statistics over a table of text.

The input is any frame with a text column, either one row per line or one row per document: a line break
ends a word just as a space does, so both give the same words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOWELS = ["a", "e", "i", "o", "u"]


def lines(documents: DataFrame, column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents as a line table, with `line_no` from 0 and the kept columns.

    Line ends are made alike first, which leaves a plain one-character split.
    """
    unix = F.replace(F.replace(column, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return documents.select(*keep, F.posexplode(F.split(unix, "\n")).alias("line_no", "value"))


def tokens(text: str | Column) -> Column:
    """Array of space-separated parts of a line; a run of spaces yields empty parts."""
    return F.split(text, " ")


def cleaned_words(text: str | Column) -> Column:
    """Array of the leading a-z run of every lower-cased part; parts that start otherwise are dropped.

    One regular expression over the whole text does the splitting and cleaning at once, so no
    intermediate row is made for a part that is thrown away.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?<![^ \r\n])[a-z]+"), F.lit(0))


def initials(text: str | Column) -> Column:
    """Array of the first character of every non-empty part, as written."""
    return F.regexp_extract_all(text, F.lit(r"([^ \r\n])[^ \r\n]*+"), F.lit(1))


def words(texts: DataFrame, column: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per cleaned word."""
    return texts.select(*keep, F.explode(cleaned_words(column)).alias("word"))


def _count(frame: DataFrame, *keys) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("count"))


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Uses of each word, most frequent first."""
    return _count(words(texts, column), "word").orderBy(F.desc("count"), "word")


def word_count_by(texts: DataFrame, source: str, column: str = "text") -> DataFrame:
    """Uses of each word per source."""
    return _count(words(texts, column, (source,)), source, "word")


def distinct_word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Size of the vocabulary."""
    return words(texts, column).distinct().agg(F.count("*").alias("distinct_words"))


def words_once(texts: DataFrame, column: str = "text") -> DataFrame:
    """Words used exactly once."""
    return _count(words(texts, column), "word").where(F.col("count") == 1)


def first_words_once(texts: DataFrame, k: int = 5, column: str = "text") -> DataFrame:
    """The first k of the words used exactly once, in alphabetical order."""
    return words_once(texts, column).orderBy("word").limit(k)


def _letters(texts: DataFrame, column: str) -> DataFrame:
    letter = texts.select(F.explode(initials(column)).alias("letter")).select(F.lower("letter").alias("letter"))
    return letter.where(F.col("letter").rlike("[a-z]"))


def initial_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """Uses of each initial letter."""
    return _count(_letters(texts, column), "letter")


def top_initials(texts: DataFrame, k: int = 5, column: str = "text") -> DataFrame:
    """The k most frequent initial letters."""
    return initial_counts(texts, column).orderBy(F.desc("count"), "letter").limit(k)


def vowel_initials(texts: DataFrame, column: str = "text") -> DataFrame:
    """Parts that start with a vowel against those that start with another letter."""
    return _count(_letters(texts, column), F.col("letter").isin(VOWELS).alias("is_vowel"))


def line_lengths(line_table: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Characters per line."""
    return line_table.select(*keep, F.length(column).alias("number_of_char"))


def filter_words(word_table: DataFrame, exclude: list[str] | None = None, longer_than: int | None = None) -> DataFrame:
    """Words outside a list and, if asked, longer than a number of characters."""
    if exclude:
        word = F.col("word")
        word_table = word_table.where(word != exclude[0] if len(exclude) == 1 else ~word.isin(exclude))
    if longer_than is not None:
        word_table = word_table.where(F.length("word") > longer_than)
    return word_table


def part_count(texts: DataFrame, column: str = "value") -> DataFrame:
    """Uses of each raw part between spaces and line ends, empty parts included; lines or whole documents alike."""
    unix = F.replace(F.replace(column, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return _count(texts.select(F.explode(tokens(F.translate(unix, "\n", " "))).alias("word")), "word")
