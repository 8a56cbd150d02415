"""Files in order, read in waves: no more of them than a byte budget needs.

Sizes come from Spark's own listing, which opens no file. A wave takes the next files whose sizes are about what is
still wanted, as measured by how much text a byte of a file gave so far; each wave is at least as large as all before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.clean import running_total
from weft.storage import stored

#: What a wave reads at least, so that many small files aren't many waves.
LEAST_BYTES = 1 << 20


def listed(spark: SparkSession, path: str, endings: tuple[str, ...]) -> DataFrame:
    """(path, length, before): the files of these endings in order of path, and the bytes before each."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{" + ",".join(endings) + "}")
    return stored(spark, running_total(spark, reader.load(path).select("path", "length"), "path", "length"), "files")


def literal(path: str) -> str:
    """A path that readers take for itself: none of its characters is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


class Waves:
    """Lists of paths, wave by wave. ``wanted`` bytes of text are to come; ``gave`` says what the last wave gave.

    Files without bytes have no text and needn't be in any wave.
    """

    def __init__(self, files: DataFrame, wanted: int, least: int = LEAST_BYTES):
        self.files, self.wanted, self.least = files, wanted, least
        self.read, self.text = 0, 0

    def gave(self, text_bytes: int) -> None:
        self.text += text_bytes

    def __iter__(self) -> Iterator[list[str]]:
        after = F.col("before") + F.col("length")
        end, at = self.files.agg(F.coalesce(F.max(after), F.lit(0))).first()[0], 0
        while self.text < self.wanted and at < end:
            share = self.text / self.read if self.text else 1.0
            to = at + max(self.least, self.read, int((self.wanted - self.text) / share) + 1)
            some = self.files.filter((F.col("before") >= at) & (F.col("before") < to)).orderBy("before", "path").select("path", after.alias("after")).collect()
            at = to
            if some:
                self.read = some[-1]["after"]
                yield [r["path"] for r in some]
