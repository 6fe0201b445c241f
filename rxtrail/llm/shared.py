"""What the corpus operators have in common: words, local bindings, shared folders."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtrail.sources.staging import Staging

#: What separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
#: The same separators for str.split after translation: Python alone splits at more characters.
ONE_SPACE = str.maketrans(SPACES, " " * len(SPACES))


#: Rows that go to a Python worker at once. Texts may be long, and a batch is held whole.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, unless they are smaller."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def staging(spark: SparkSession) -> Staging:
    """Intermediate tables in the session's shared folder; local sessions may have none set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rxtrail-"))
        root = spark.sparkContext.getCheckpointDir()
    return Staging(spark, root)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row, also if lambdas use it."""
    return F.transform(F.array(value), body)[0]


def python_words(text: str | None) -> list[str]:
    """The words of a text, as `words` has them."""
    return [w for w in (text or "").translate(ONE_SPACE).split(" ") if w]


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else 256 and up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


#: Longer keys are not remembered, which bounds a memo in bytes and not in entries only.
LONGEST_KEY = 256


class Memo(dict):
    """Values by key, at most about twice ``size`` of them: the recent ones in two generations."""

    def __init__(self, size: int, make: Callable):
        super().__init__()
        self.size, self.make, self.old = size, make, {}

    def __missing__(self, key):
        if len(key) > LONGEST_KEY:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value
