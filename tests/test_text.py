import random
import re
from collections import Counter

from sparkloom.plans import text
from tests.helpers import bag, plan, rows

LINES = ["'Tis don't  STOP", "stop Élan 3rd x", "", "the end"]


def frame(spark, lines=LINES):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_cleaning_rules(spark):
    words = [r[0] for r in rows(text.words(frame(spark), "value"))]
    assert sorted(words) == ["don", "end", "stop", "stop", "the", "x"]


def test_documents_and_lines_give_the_same_words(spark):
    for mark in ("\n", "\r\n", "\r"):
        whole = spark.createDataFrame([(mark.join(LINES),)], "text string")
        assert bag(text.words(whole)) == bag(text.words(frame(spark), "value"))
        assert [r.value for r in text.lines(whole).orderBy("line_no").collect()] == LINES


def test_counts(spark):
    counted = rows(text.word_count(frame(spark), "value"))
    assert counted[0] == ("stop", 2) and counted[1:] == [("don", 1), ("end", 1), ("the", 1), ("x", 1)]
    assert rows(text.distinct_word_count(frame(spark), "value")) == [(5,)]
    assert bag(text.words_once(frame(spark), "value")) == {(w, 1): 1 for w in ("don", "end", "the", "x")}
    assert rows(text.first_words_once(frame(spark), 2, "value")) == [("don", 1), ("end", 1)]


def test_initials_use_raw_parts(spark):
    assert rows(text.top_initials(frame(spark), 2, "value")) == [("s", 2), ("d", 1)]
    assert bag(text.vowel_initials(frame(spark), "value")) == {(True, 1): 1, (False, 5): 1}


def test_lengths_and_filters(spark):
    assert [r[0] for r in rows(text.line_lengths(frame(spark)))] == [len(line) for line in LINES]
    words = text.words(frame(spark), "value")
    assert bag(text.filter_words(words, ["stop", "the"], 2)) == {("don",): 1, ("end",): 1}
    assert ("stop",) not in bag(text.filter_words(words, ["stop"]))


def test_raw_parts_keep_empty_ones(spark):
    assert bag(text.part_count(frame(spark, ["a  b a", ""]))) == {("a", 2): 1, ("", 2): 1, ("b", 1): 1}


def test_null_text(spark):
    empty = spark.createDataFrame([(None,)], "text string")
    assert rows(text.words(empty)) == [] and rows(text.lines(empty)) == []


def test_plan_is_one_shuffle_without_python(spark):
    shown = plan(text.word_count_by(spark.createDataFrame([("a", "b")], "lang string, text string"), "lang"))
    assert "Python" not in shown and "partial_count" in shown


def test_against_brute_force(spark):
    """Random documents of letters, marks, accents and every kind of line end."""
    random.seed(7)
    alphabet = "abzAZ é'1-\t\n\r  ßŒ\u2028"
    documents = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 120))) for _ in range(300)]
    documents += ["\r\n".join(documents[:20]), ""]
    frame_ = spark.createDataFrame([(d,) for d in documents], "text string")
    lines = [line for d in documents for line in re.split("\r\n|\n|\r", d)]
    parts = [part for line in lines for part in line.split(" ")]
    cleaned = [re.match("[a-z]*", part.lower()).group() for part in parts]
    first = [part[:1].lower() for part in parts]
    assert bag(text.words(frame_)) == Counter((w,) for w in cleaned if w)
    assert bag(text.initial_counts(frame_)) == Counter(
        Counter(c for c in first if re.search("[a-z]", c)).items())
    assert Counter(r.value for r in text.lines(frame_).collect()) == Counter(lines)
    assert bag(text.part_count(text.lines(frame_))) == Counter(Counter(parts).items())
