"""Vocabulary jobs over the documents table."""

from __future__ import annotations

from sparkloom.bindings.inputs import table, wide
from sparkloom.plans import text


def _documents(spark, folder):
    return table(spark, folder, "documents")


def _filtered(spark, folder):
    kept = text.filter_words(text.words(_documents(spark, folder)), ["the", "und", "pour", "una", "that"], 3)
    return kept.groupBy("word").count()


def _not_is(spark, folder):
    kept = text.filter_words(text.words(_documents(spark, folder)), ["the"])
    return kept.groupBy("word").count()


def _line_lengths(spark, folder):
    lines = text.lines(_documents(spark, folder), keep=("doc_id",))
    return wide(text.line_lengths(lines, keep=("doc_id", "line_no")))


QUERIES = {
    "word_count": lambda s, d: text.word_count(_documents(s, d)),
    "word_count_multi": lambda s, d: text.word_count_by(_documents(s, d), "lang"),
    "distinct_word_count": lambda s, d: text.distinct_word_count(_documents(s, d)),
    "words_once": lambda s, d: text.words_once(_documents(s, d)),
    "words_once_first": lambda s, d: text.first_words_once(_documents(s, d), 5),
    "initial_counts": lambda s, d: text.initial_counts(_documents(s, d)),
    "top_initials": lambda s, d: text.top_initials(_documents(s, d), 5),
    "vowel_initials": lambda s, d: text.vowel_initials(_documents(s, d)),
    "line_lengths": _line_lengths,
    "word_filters": _filtered,
    "word_filter_not_equal": _not_is,
}

_PARTS = """lines AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents),
     parts AS (SELECT lang, unnest(string_split(line, ' ')) AS part FROM lines)"""
_WORDS = f"""{_PARTS},
     words AS (SELECT lang, regexp_extract(lower(part), '[a-z]*') AS word FROM parts),
     clean AS (SELECT lang, word FROM words WHERE word <> '')"""
_LETTERS = f"""{_PARTS},
     letters AS (SELECT lower(substr(part, 1, 1)) AS letter FROM parts),
     clean AS (SELECT letter FROM letters WHERE regexp_matches(letter, '[a-z]'))"""

ORACLES = {
    "word_count": f'WITH {_WORDS} SELECT word, count(*) AS "count" FROM clean GROUP BY word',
    "word_count_multi": f'WITH {_WORDS} SELECT lang, word, count(*) AS "count" FROM clean GROUP BY lang, word',
    "distinct_word_count": f"WITH {_WORDS} SELECT count(DISTINCT word) AS distinct_words FROM clean",
    "words_once": f'WITH {_WORDS} SELECT word, count(*) AS "count" FROM clean GROUP BY word HAVING count(*) = 1',
    "words_once_first": f"""WITH {_WORDS} SELECT word, count(*) AS "count" FROM clean
        GROUP BY word HAVING count(*) = 1 ORDER BY word LIMIT 5""",
    "initial_counts": f'WITH {_LETTERS} SELECT letter, count(*) AS "count" FROM clean GROUP BY letter',
    "top_initials": f"""WITH {_LETTERS} SELECT letter, count(*) AS "count" FROM clean
        GROUP BY letter ORDER BY 2 DESC, 1 LIMIT 5""",
    "vowel_initials": f"""WITH {_LETTERS} SELECT letter IN ('a', 'e', 'i', 'o', 'u') AS is_vowel,
        count(*) AS "count" FROM clean GROUP BY 1""",
    "line_lengths": """WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
        numbered AS (SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM split)
        SELECT doc_id, line_no, length(line) AS number_of_char FROM numbered""",
    "word_filters": f"""WITH {_WORDS} SELECT word, count(*) AS "count" FROM clean
        WHERE word NOT IN ('the', 'und', 'pour', 'una', 'that') AND length(word) > 3 GROUP BY word""",
    "word_filter_not_equal": f"""WITH {_WORDS} SELECT word, count(*) AS "count" FROM clean
        WHERE word <> 'the' GROUP BY word""",
}
