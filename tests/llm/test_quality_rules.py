import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from awkward import awkward_rows, prose
from merchantlake.llm.quality_rules import Rule, quality_rules

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = sum((text or "").count(x) for x in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


TEXTS = [
    None, "", "a b c d e a b c d e", "a a a a a a a", "one two three four five six seven eight nine ten",
    "x\n\nx\n x\ny\ny\n \n", "#*$%&|<> #   b", "a b c d e f " * 7, prose(1, 300) + "\n" + prose(2, 30) + "\n" + prose(2, 30),
    "1 2 3 4 5 6 7 1 2 3 4 5 9 9 3 4 5 6 7 0 " + prose(4, 50),
]


def test_counts_equal_brute_force(spark, rows):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = rows(quality_rules(docs), F.col("document.doc_id"), *COUNTS)
    assert got == sorted(((k, *counted(t)) for k, t in enumerate(TEXTS)), key=repr)


def test_awkward_rows(awkward, rows):
    got = quality_rules(awkward)
    expected = sorted(((t, *counted(t)) for _, t, *_ in awkward_rows()), key=repr)
    assert rows(got, F.col("document.text"), *COUNTS) == expected
    assert got.where("document.kept = 'x' and document.n_words = 'x'").count() == awkward.count()


def test_no_documents(no_documents):
    assert quality_rules(no_documents).count() == 0


@pytest.mark.parametrize(
    "rule, failed",
    [
        (Rule("long", "n_words", high=5), True),
        (Rule("short", "n_words", low=5), False),
        (Rule("few", "n_symbols", "n_words", high=0.0), True),
        (Rule("later", "n_symbols", "n_words", high=0.0, from_words=100), False),
    ],
)
def test_a_rule_decides(spark, rule, failed):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten # eleven")], "doc_id bigint, text string")
    got = quality_rules(docs, rules=(rule,)).first()
    assert got.failed_rules == ([rule.name] if failed else []) and got.kept is not failed


def test_ratios_over_nothing_pass(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    got = quality_rules(docs).first()
    assert got.failed_rules == [] and got.base_failed and not got.kept
