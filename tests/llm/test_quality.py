"""Which lines are boilerplate, by code and by SQL."""

import random

import duckdb
import pytest

from checks.compare import rows_of_spark, rows_of_sql
from rxtrail.llm import quality

ARTICLE = " ".join(f"word{i} goes" for i in range(2500))
SECOND = " ".join(f"other{i} went" for i in range(2500))
SENTENCE = "She put the cookie on a plate, read the terms of use aloud and went out into the rain to see what the matter was"
BANNERS = [
    "We use cookies.", "This site uses cookies to give you the best experience", "© 2020 Acme. All rights reserved.",
    "Privacy Policy | Terms of Use", "Please enable JavaScript", "Copyright (c) 2024 Acme", "Click here!", "©Acme",
    "cookies cookies cookies",
]
CLEAN = ["Cookieless days are here", "The policy on privacy is long", "(c) the third of these points", "Copyrights and wrongs", "The cookié is good"]


def verdicts(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    connection = duckdb.connect()
    documents = frame.toArrow()  # noqa: F841
    connection.execute("CREATE TABLE documents AS SELECT * FROM documents")
    found = quality.report(frame)
    assert rows_of_spark(found) == rows_of_sql(connection, quality.SQL_REPORT)
    return {r.doc_id: r.kept for r in found.collect()}, {r.doc_id: r.text for r in quality.cleaned(frame).collect()}


def test_long_lines_that_say_a_phrase_stay(spark):
    texts = [f"{ARTICLE} cookie {SECOND}", f"© {ARTICLE} {SECOND}", f"{SENTENCE}\n{SENTENCE[::-1]}", f"{ARTICLE}\nterms of use\n{SECOND}"]
    texts += [f"{SENTENCE[50:]} and then some more of it was said at last {x}" for x in ("cookies", "© Acme", "click here")]
    kept, cleaned = verdicts(spark, texts)
    assert all(kept.values())
    assert cleaned == {i: t.replace("\nterms of use", "") for i, t in enumerate(texts)}


@pytest.mark.parametrize("line", BANNERS + CLEAN)
def test_short_lines(spark, line):
    _, cleaned = verdicts(spark, [f"{line}\n{ARTICLE}"])
    assert cleaned[0] == (ARTICLE if line in BANNERS else f"{line}\n{ARTICLE}")


def test_random_lines(spark):
    pick = random.Random(31)
    parts = ["cookies", "©", "privacy", "policy", "(c)", "copyright", "a!!", "b??", "|", "»", "$", "Home", "the", "long", "words", "É", "ſ", "K", "\t"]
    texts = ["\n".join(" ".join(pick.choice(parts) for _ in range(pick.randrange(9))) for _ in range(pick.randrange(14))) for _ in range(400)]
    assert set(verdicts(spark, texts)[0].values()) == {True, False}
