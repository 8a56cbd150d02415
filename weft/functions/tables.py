"""Table functions: the pages of a PDF file and the sentences of a text, a row each, for lateral joins and SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from weft.functions.text import SENTENCE_END
from weft.sources.files import pdf_pages


def pdf_function(pages: Callable[[bytes], list[str]] = pdf_pages):
    """A table function (content) -> (page, text): pages without text are left out, a broken file gives one row with an error."""

    class Pages:
        def eval(self, content: bytes) -> Iterator[tuple]:
            if content is None:
                return
            try:
                for k, text in enumerate(pages(bytes(content))):
                    if text.strip():
                        yield k, text.strip(), None
            except Exception as why:
                yield None, None, f"{type(why).__name__}: {why}"

    return udtf(Pages, returnType="page int, text string, error string")


class Sentences:
    def __init__(self):
        self.end = regex.compile(SENTENCE_END, regex.A)

    def eval(self, text: str) -> Iterator[tuple]:
        if text is not None:
            kept = (s.strip() for s in self.end.split(text))
            yield from enumerate(s for s in kept if s)


#: (text) -> (place, sentence): the sentences that aren't blank.
sentences = udtf(Sentences, returnType="place int, sentence string")


def register(spark: SparkSession) -> None:
    """Makes both known to SQL as pdf_pages and sentences."""
    spark.udtf.register("pdf_pages", pdf_function())
    spark.udtf.register("sentences", sentences)


def with_pages(spark: SparkSession, files: DataFrame, pages: Callable[[bytes], list[str]] = pdf_pages) -> DataFrame:
    """path, page, text and error of PDF files (path, content): a row for each page that has a text."""
    read = pdf_function(pages)
    return files.select("path", "content").lateralJoin(read(F.col("content").outer())).select("path", "page", "text", "error")


def with_sentences(docs: DataFrame) -> DataFrame:
    """doc_id, place and sentence."""
    return docs.select("doc_id", "text").lateralJoin(sentences(F.col("text").outer())).select("doc_id", "place", "sentence")
