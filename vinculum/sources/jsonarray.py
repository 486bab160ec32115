"""JSON arrays of any size as one row per element (S2), read in splits.

Spark's text source cuts a file at every ``}`` (its line separator here), so a file is read by
as many tasks as it has splits and no task holds more than a record.  Whether a piece of text
begins inside a string, and how deep, depends on all pieces before it:

1. every split counts its unescaped quotes (one pass, two numbers a split);
2. running sums per file tell each split whether it begins inside a string;
3. likewise for the depth, whose change in a split follows from that;
4. each split then gives the elements that begin in it.  The pieces of the few elements that
   reach over the end of a split are put together by file and split.

A string can hold braces, brackets and escaped quotes; elements may be of any kind.  What stands
between two commas of the array is an element whether it parses or not, so a broken element is
one invalid record as long as its quotes and brackets are balanced.  Where they aren't, the end
of the element can't be told: what follows is given in parts of at most ``RECORD_BYTES``, each an
invalid record.  A file that isn't an array is given likewise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vinculum.session import share_package
from vinculum.sources.store import stage_table

#: Longest element (in characters) that is put together.
RECORD_BYTES = 16 << 20
#: Splits whose state is broadcast: a row of about 150 bytes each.
BROADCAST_SPLITS = 200_000

_ESCAPED = re.compile(r"\\.", re.DOTALL)
_STRING = re.compile(r'"[^"]*(?:"|\Z)', re.DOTALL)
#: The rest of a string that began earlier, with its closing quote.
_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?\Z)|[{}\[\],]|[^"{}\[\],]+', re.DOTALL)
#: The usual piece: a comma and an object without its last brace.
_PLAIN = re.compile(r'\s*,?\s*(\{(?:[^"{}\[\]]|"(?:[^"\\]|\\.)*")*)', re.DOTALL)
#: The same for Arrow's regex engine, whose blanks are fewer: what it passes over goes piece by piece.
_PLAIN_PIECE = r'(?s)^[ \t\r\n]*,?[ \t\r\n]*\{(?:[^"{}\[\]]|"(?:[^"\\]|\\.)*")*$'
#: Quotes and brackets by their bytes, and what a bracket adds to the depth.
_QUOTE = ord('"')
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_MARK = _STEP != 0
_MARK[_QUOTE] = True


def depth_change(piece: str, in_string: bool) -> int:
    """Brackets opened less those closed in a piece that begins inside or outside a string."""
    text = _ESCAPED.sub("", piece)
    text = _STRING.sub("", f'"{text}' if in_string else text)
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def quotes(piece: str) -> int:
    return _ESCAPED.sub("", piece).count('"')


class Elements:
    """Splits the pieces of one file split into elements of the array at depth 1.

    ``done`` gathers (text, began earlier, goes on): elements, and at either end of the split
    parts of those that reach over it.
    """

    def __init__(self, in_string: bool, depth: int, is_array: bool) -> None:
        self.in_string, self.depth, self.is_array = in_string, depth, is_array
        self.parts: list[str] = []
        self.size = 0
        self.carried = in_string or depth > 1 or not is_array
        self.done: list[tuple[str, bool, bool]] = []

    def _put(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)
        if self.size > RECORD_BYTES:
            self._end(True)
            self.carried = True

    def _end(self, goes_on: bool = False) -> None:
        text = "".join(self.parts)
        if not self.carried and not goes_on:
            text = text.strip()
        if text.strip() or (goes_on and text) or (self.carried and text):
            self.done.append((text, self.carried, goes_on))
        elif self.carried and not goes_on:
            self.done.append(("", True, False))
        self.parts, self.size, self.carried = [], 0, False

    def piece(self, text: str, closed: bool, first: bool = False, last: bool = False) -> None:
        """One piece, with the brace behind it unless the file (or the array) ends there."""
        if first:
            text = text.removeprefix("﻿")
        if not self.is_array:
            self._put(text + "}" * closed)
            return
        if self.depth == 1 and not self.in_string and not self.parts and closed and (plain := _PLAIN.fullmatch(text)):
            self.parts.append(plain[1] + "}")
            self._end()
            return
        at = 0
        if self.in_string:
            rest = _REST.match(text)
            if rest is None:
                self._put(text + "}" * closed)
                return
            self._put(rest[0])
            at, self.in_string = rest.end(), False
        for token in _TOKEN.findall(text, at):
            if token[0] == '"':
                self._put(token)
                # no closing quote: the string goes on behind the piece
                self.in_string = quotes(token) % 2 == 1
            elif token in "{[":
                self.depth += 1
                if self.depth > 1 or token == "{":
                    self._put(token)
            elif token in "}]":
                self._close(token)
            elif token == "," and self.depth == 1:
                self._end()
            else:
                self._put(token)
        if last and self.depth == 0:
            return
        if closed and self.in_string:
            self._put("}")
        elif closed:
            self._close("}")

    def between(self) -> bool:
        """Whether the next piece begins between two elements of the array."""
        return self.is_array and self.depth == 1 and not (self.in_string or self.parts or self.carried)

    def _close(self, token: str) -> None:
        self.depth -= 1
        if self.depth > 0 or token == "}":
            self._put(token)
        if self.depth <= 1:
            self._end()


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The parts of a batch that are of one split each."""
    file, block, n = batch.column("file"), batch.column("block"), batch.num_rows
    cuts = []
    if n > 1:
        other = pc.or_(pc.not_equal(block[1:], block[:-1]), pc.not_equal(file[1:], file[:-1]))
        cuts = (np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist()
    for start, stop in zip([0, *cuts], [*cuts, n]):
        if stop > start:
            yield batch.slice(start, stop - start)


def _first(run: pa.RecordBatch, *columns: str) -> list:
    return [run.column(c)[0].as_py() for c in columns]


def _closed(pieces: pa.Array) -> pa.Array:
    """The pieces, each with the brace behind it."""
    return pc.binary_join_element_wise(pieces, "", "}")


def _bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of all texts, one behind the other."""
    texts = texts.cast(pa.large_binary())
    data = texts.buffers()[2]
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)


def changes(pieces: pa.Array) -> tuple[int, int, int]:
    """Quotes of closed pieces, and their change of depth if the first begins outside, or inside a
    string: :func:`quotes` and :func:`depth_change` of each, the braces outside strings closing."""
    if pc.any(pc.match_substring(pieces, "\\")).as_py():
        pieces = pc.replace_substring_regex(pieces, pattern=r"(?s)\\.", replacement="")
    marks = _bytes(_closed(pieces))
    marks = marks[_MARK[marks]]
    is_quote = marks == _QUOTE
    inside = np.cumsum(is_quote) % 2 == 1
    steps = _STEP[marks]
    return int(is_quote.sum()), int(steps[~inside].sum(dtype=np.int64)), int(steps[inside].sum(dtype=np.int64))


_COUNTED = "file string, block long, size long, quotes long, outside long, inside long, bytes long, pieces long, is_array boolean"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: its quotes, and its change of depth if it begins outside or inside a string."""
    key, totals, opened = None, [0] * 5, None

    def record() -> pa.RecordBatch:
        values = [*key, *totals, opened]
        types = [pa.string(), *[pa.int64()] * 7, pa.bool_()]
        names = [c.split()[0] for c in _COUNTED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    for batch in batches:
        for run in _runs(batch):
            split = _first(run, "file", "block", "size")
            if split != key:
                if key is not None:
                    yield record()
                key, totals, opened = split, [0] * 5, None
            values = run.column("value")
            for value in values if opened is None else ():
                if start := value.as_py().removeprefix("﻿").lstrip():
                    opened = start[0] == "["
                    break
            n, outside, inside = changes(values)
            if totals[0] % 2:
                outside, inside = inside, outside
            totals = [
                totals[0] + n,
                totals[1] + outside,
                totals[2] + inside,
                totals[3] + pc.sum(pc.binary_length(values)).as_py() + len(values),
                totals[4] + len(values),
            ]
    if key is not None:
        yield record()


_FOUND = "file string, block long, row long, text string, carried boolean, goes_on boolean"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements, and parts of elements, of each split.  Pieces that are a whole plain object
    each are taken together; the others go one by one through :class:`Elements`."""
    key, split, n, row, size, out = None, None, 0, 0, 0, []
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal out, size
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        out, size = [], 0

    def take() -> None:
        nonlocal row
        for text, carried, goes_on in split.done:
            out.append((*key, row, text, carried, goes_on))
            row += 1
        split.done.clear()

    def finish() -> None:
        if split.parts or split.in_string or split.depth > 1:
            split._end(True)
        take()

    def objects(pieces: pa.Array) -> pa.RecordBatch:
        nonlocal row
        texts = _closed(pc.ascii_ltrim(pieces, " \t\r\n,")).cast(pa.string())
        m = len(texts)
        at = pa.array(np.arange(row, row + m))
        row += m
        return pa.RecordBatch.from_arrays([pa.repeat(key[0], m), pa.repeat(pa.scalar(key[1], pa.int64()), m), at, texts, pa.repeat(False, m), pa.repeat(False, m)], names=names)

    for batch in batches:
        for run in _runs(batch):
            file, block, in_string, depth, is_array, pieces, is_last, open_end = _first(run, "file", "block", "in_string", "depth", "is_array", "pieces", "is_last", "open_end")
            if (file, block) != key:
                if split is not None:
                    finish()
                key, split, n, row = (file, block), Elements(in_string, depth, is_array), 0, 0
            values = run.column("value")
            plain = pc.match_substring_regex(values, _PLAIN_PIECE).to_numpy(zero_copy_only=False).copy()
            if block == 0 and n == 0:
                plain[0] = False  # a byte-order mark
            if is_last and n < pieces <= n + len(values):
                plain[pieces - n - 1] = False  # perhaps no brace behind it
            others, i = [*np.flatnonzero(~plain).tolist(), len(values)], 0
            for other in others:
                while i < min(other + 1, len(values)):
                    if i < other and split.between():
                        yield objects(values[i:other])
                        n, i = n + other - i, other
                        continue
                    value = values[i].as_py()
                    n, i = n + 1, i + 1
                    last = is_last and n == pieces
                    split.piece(value, not (last and open_end), block == 0 and n == 1, last)
                    size += len(value)
                    if split.done:
                        take()
                    if size > 1 << 22:
                        yield from flush()
    if split is not None:
        finish()
    yield from flush()


def read_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, row, text): the elements of the JSON arrays at ``path``, in file order."""
    share_package(spark)
    meta = [F.col(f"_metadata.{name}").alias(alias) for name, alias in (("file_path", "file"), ("file_block_start", "block"), ("file_size", "size"))]
    pieces = spark.read.option("lineSep", "}").text(path).select("value", *meta)
    counted = stage_table(pieces.select("file", "block", "size", "value").mapInArrow(_counted, _COUNTED), "json-splits")

    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    whole = Window.partitionBy("file")
    states = counted.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    states = states.select(
        "file",
        "block",
        "in_string",
        F.coalesce(F.sum(change).over(before), F.lit(0)).cast("int").alias("depth"),
        F.coalesce(F.min_by("is_array", "block").over(whole), F.lit(True)).alias("is_array"),
        "pieces",
        (F.max("block").over(whole) == F.col("block")).alias("is_last"),
        # Without a brace behind its last piece the file has a byte less than the pieces say (a
        # byte-order mark, which the reader drops, is three more).
        (F.sum("bytes").over(whole) - F.col("size")).isin(1, -2).alias("open_end"),
    )
    states = stage_table(states, "json-states")
    columns = ["file", "block", "value", "in_string", "depth", "is_array", "pieces", "is_last", "open_end"]
    if states.count() <= BROADCAST_SPLITS:
        rows = pieces.select("file", "block", "value").join(F.broadcast(states), ["file", "block"]).select(columns)
    else:
        at = F.monotonically_increasing_id()
        rows = pieces.select("file", "block", "value", at.alias("at")).join(states, ["file", "block"])
        rows = rows.repartition("file", "block").sortWithinPartitions("file", "block", "at").select(columns)
    found = stage_table(rows.mapInArrow(_found, _FOUND), "json-elements")

    done = found.filter(~F.col("carried") & ~F.col("goes_on")).select("file", "block", "row", "text")
    parts = found.filter(F.col("carried") | F.col("goes_on"))  # at most two a split, but for unbalanced files
    in_order = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("element", F.sum(F.when(~F.col("carried"), 1).otherwise(0)).over(in_order))
    parts = parts.withColumn("length", F.sum(F.length("text")).over(Window.partitionBy("file", "element")))
    short = parts.filter(F.col("length") <= RECORD_BYTES).groupBy("file", "element").agg(
        F.min(F.struct("block", "row")).alias("at"), F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("parts")
    )
    short = short.select("file", "at.block", "at.row", F.array_join(F.col("parts.text"), "").alias("text"))
    long = parts.filter(F.col("length") > RECORD_BYTES).select("file", "block", "row", "text")
    glued = short.unionByName(long).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", ""))
    return done.unionByName(glued).filter("text <> ''")
