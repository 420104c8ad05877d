"""Events as concatenated JSON: several objects on a line, objects over several lines, broken ones between.

A record begins at an opening brace and ends where its brackets close. A record is broken off, and given as it is, where it can't go on: at
the end of a line within a string (JSON has no raw line feeds in strings), and before an opening brace right after a value, or
after a comma of an object, as neither may stand there within a record. So one broken record costs no other, with one exception: a record
cut off right after a colon takes the next record for its value, and both are given as one broken text. Text between records is a broken
record up to the next opening bracket or the end of its line.

Files are read in splits. Whatever stands before it, a brace after a value begins a record, and so does the line after a string that
is not closed: from the first such place on, a split is worked on by itself. What lies before it, and what is left open at the
end, is put together per file and read again; that is a record or two a split. A line must fit a task, as with any text source, and
so must a record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

TOKEN = re.compile(r'"(?:[^"\\\n]|\\[^\n])*\\?"?|[{}\[\],:\n]|[^\s"{}\[\],:]+')
#: Something behind a closing bracket that may not follow it within a record, or an opening brace where no value may stand.
SEVERAL = r"[}\]]\s*[^\s,:}\]]|[^\s:\[]\s*\{"
VALUE, COMMA, OTHER = "value", "comma", "other"
# Python holds so many lines at a time, and sends records on once they have so many characters.
ROWS, TEXT_SIZE = 256, 1 << 19
PIECES = "kind string, value string, file string, block long"


class Splitter:
    """Cuts text into records. With `synced=False` it first looks for a place where a record surely begins; `head` is what came before."""

    def __init__(self, synced: bool = True):
        self.synced, self.head = synced, []
        self.parts: list[str] = []
        self.open: list[str] = []
        self.last = OTHER

    def close(self) -> list[str]:
        """The text so far as a record, if there is any."""
        text = "".join(self.parts).strip()
        self.parts, self.open, self.last = [], [], OTHER
        return [text] if text.strip(", ") else []  # a comma between records is none

    def sync(self) -> None:
        self.synced, self.head = True, self.parts
        self.parts, self.open, self.last = [], [], OTHER

    def feed(self, text: str) -> Iterator[str]:
        """Records that end within the text."""
        done = 0  # the text before is in parts

        def take(end: int) -> None:
            nonlocal done
            self.parts.append(text[done:end])
            done = end

        for found in TOKEN.finditer(text):
            token, begin, end = found.group(), found.start(), found.end()
            sign = token[0]
            if sign == "{":
                after_value = self.last == VALUE
                if not self.synced:
                    if after_value:
                        take(begin)
                        self.sync()
                elif not self.open or after_value or (self.last == COMMA and self.open[-1] == "{"):
                    take(begin)
                    yield from self.close()
                self.open.append(sign)
                self.last = OTHER
            elif sign == "[":
                if self.synced and not self.open:
                    take(begin)
                    yield from self.close()
                self.open.append(sign)
                self.last = OTHER
            elif sign in "}]":
                match = "{" if sign == "}" else "["
                if match in self.open:
                    while self.open.pop() != match:
                        pass
                    if self.synced and not self.open:
                        take(end)
                        yield from self.close()
                self.last = VALUE
            elif sign == "\n":
                if self.synced and not self.open:
                    take(end)
                    yield from self.close()
            elif sign == '"' and (len(token) == 1 or token[-1] != '"' or not closed(token)):
                take(end)
                if self.synced:
                    yield from self.close()
                else:
                    self.sync()
            else:
                self.last = COMMA if sign == "," else OTHER if sign == ":" else VALUE
        take(len(text))


def closed(string: str) -> bool:
    """Whether the last quote of a token is not an escaped one."""
    before = string[1:-1]
    return (len(before) - len(before.rstrip("\\"))) % 2 == 0


def split_text(text: str) -> list[str]:
    splitter = Splitter()
    return [*splitter.feed(text), *splitter.close()]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _split(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: None if text is None else split_text(text))


def records_of(value: Column) -> Column:
    """The records of a text as an array. Only a text that may hold several goes to Python."""
    trimmed = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.when(F.regexp_like(value, F.lit(SEVERAL)), _split(F.when(F.regexp_like(value, F.lit(SEVERAL)), value))).otherwise(F.array(trimmed))


def _pieces(lines: DataFrame) -> DataFrame:
    """Records of each split, and what lies before the first sure beginning (`head`) and after the last record (`tail`)."""

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, splitter = None, None

        def batch_of(kind: str, texts: list[str]) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(kind), n), pa.array(texts, pa.string()), pa.repeat(pa.scalar(now[0], pa.string()), n), pa.repeat(pa.scalar(now[1], pa.int64()), n)], ["kind", "value", "file", "block"])

        def finish() -> Iterator[pa.RecordBatch]:
            rest = "".join(splitter.parts)
            if now[2]:  # the whole file
                yield batch_of("record", splitter.close())
            elif splitter.synced:
                if now[1]:
                    yield batch_of("head", ["".join(splitter.head)])
                yield batch_of("tail", [rest])
            else:
                yield batch_of("head", [rest])

        for rows in (batch.slice(k, ROWS) for batch in batches for k in range(0, batch.num_rows, ROWS)):
            keys = zip(*(rows.column(c).to_pylist() for c in ("file", "block", "whole")))
            found, size = [], 0
            for key, value in zip(keys, rows.column("value")):
                if key != now:
                    if now is not None:
                        yield batch_of("record", found)
                        yield from finish()
                        found, size = [], 0
                    now, splitter = key, Splitter(synced=key[1] == 0)
                text = value.as_py() + "\n"
                for record in splitter.feed(text):
                    found.append(record)
                    size += len(record)
                    if size >= TEXT_SIZE:
                        yield batch_of("record", found)
                        found, size = [], 0
            if found:
                yield batch_of("record", found)
        if now is not None:
            yield from finish()

    return lines.mapInArrow(give, PIECES)


def whole_records(lines: DataFrame) -> DataFrame:
    """(value): each record once, good or broken, from lines as `text_lines` gives them."""
    inside = _pieces(lines).filter("kind = 'record'").select("value")
    borders = _pieces(lines.filter("NOT whole")).filter("kind <> 'record'")
    place = Window.partitionBy("file").orderBy("block", "kind")  # a head comes before the tail of its split
    numbered = borders.withColumn("record", F.count_if(F.col("kind") == "tail").over(place))
    texts = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda x: x["value"]), "")
    between = texts.select(F.explode(_split(joined)).alias("value"))
    return inside.unionByName(between)


def text_lines(reader, path: str) -> DataFrame:
    """Lines with their file, their split, and whether the split is the whole file. `reader`: spark.read or spark.readStream."""
    meta = "_metadata"
    whole = (F.col(f"{meta}.file_block_start") == 0) & (F.col(f"{meta}.file_block_length") >= F.col(f"{meta}.file_size"))
    return reader.text(path).select("value", F.col(f"{meta}.file_path").alias("file"), F.col(f"{meta}.file_block_start").alias("block"), whole.alias("whole"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(value): the records of concatenated JSON files."""
    return whole_records(text_lines(spark.read, path))


def each_batch(spark: SparkSession, path: str, handle, checkpoint: str, files_per_trigger: int | None = None) -> DataStreamWriter:
    """A stream over a folder of such files: `handle(records, batch_id)` gets the records (value) of each micro-batch's files."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else spark.readStream
    lines = text_lines(reader, path)
    return lines.writeStream.foreachBatch(lambda batch, batch_id: handle(whole_records(batch), batch_id)).option("checkpointLocation", checkpoint)
