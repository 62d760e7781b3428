"""JSON documents of any size, each read by as many tasks as it has file blocks.

A document is read in pieces that end at a closing brace, wherever it stands. Whether a brace is text or structure, and how
deep it lies, depends on all that stands before it; so each block is first summed up by what it does to these two: whether
it turns the quote state, and by how much it changes the depth if it begins outside or inside a string. These sums,
composed in the order of the blocks, say in which state each block begins, and then every block finds the elements of its
document's list on its own. Only the element that lies across the end of a block is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statline.schemas import SEQ

BROADCAST_BLOCKS = 500_000
_PACKED = r"\.(gz|bz2|zst|snappy|lz4|deflate|xz)$"
_BLANKS = " \t\r\n\f"
_SIGNS = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[\[\]{},]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path)
    meta = F.col("_metadata")
    return text.select("value", meta.file_path.alias("file"), meta.file_block_start.alias("block"), meta.file_size.alias("size"),
                       F.unix_micros(meta.file_modification_time.cast("timestamp")).alias("modified"))


def _structure(values: pa.Array, inside: np.ndarray) -> pa.Array:
    """The pieces without their strings, given which of them begin inside one; escaped signs are gone already."""
    opened = pc.binary_join_element_wise(pc.if_else(pa.array(inside), '"', ""), values, "")
    return pc.replace_substring_regex(opened, r'"[^"]*("|$)', "")


def _unescaped(values: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(values, r"(?s)\\.", "")


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def _turns(unescaped: pa.Array) -> np.ndarray:
    """1 for a piece that leaves the other quote state than it found."""
    return _numbers(pc.count_substring(unescaped, '"')) & 1


def _change(structure: pa.Array) -> np.ndarray:
    """Brackets opened less brackets closed, without the brace that ends the piece."""
    return _numbers(pc.count_substring_regex(structure, r"[\[{]")) - _numbers(pc.count_substring_regex(structure, r"[\]}]"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """``(file, block), first, end`` of the rows of each block in a batch."""
    if not batch.num_rows:
        return
    block, file = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
    number = file.indices.to_numpy()
    edges = np.flatnonzero((np.diff(block) != 0) | (np.diff(number) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        yield (file.dictionary[int(number[a])].as_py(), int(block[a])), int(a), int(b)


_SUMS = "file string, block long, size long, n_bytes long, turn int, outside long, inside long, top string"


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: what it does to the quote state and to the depth."""
    names = [c.split()[0] for c in _SUMS.split(", ")]
    key, sums = None, []

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(names, (*key, *sums)))], pa.schema(
            [(n, pa.string() if n in ("file", "top") else pa.int32() if n == "turn" else pa.int64()) for n in names]))

    for batch in batches:
        for here, a, b in _runs(batch):
            if here != key:
                if key:
                    yield row()
                first = batch.column("value")[a].as_py().lstrip(_BLANKS) if here[1] == 0 else ""
                key, sums = here, [batch.column("size")[a].as_py(), 0, 0, 0, 0, first[:1] if here[1] == 0 else None]
            values = batch.column("value").slice(a, b - a)
            plain = _unescaped(values)
            turns = _turns(plain)
            before = (np.cumsum(turns) - turns) & 1  # if the rows begin outside a string
            change = [_change(_structure(plain, before ^ start == 1)) - ((before ^ start ^ turns) == 0) for start in (0, 1)]
            outside, inside = (int(c.sum()) for c in change)
            if sums[2]:
                outside, inside = inside, outside
            sums[1] += int(_numbers(pc.binary_length(values)).sum()) + b - a
            sums[3], sums[4] = sums[3] + outside, sums[4] + inside
            sums[2] ^= int(turns.sum()) & 1
    if key:
        yield row()


def block_states(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, quote, depth, top, last, open, broken``: the state in which each block begins, the document's first
    sign, its last block, whether its last piece has no brace after it, and whether its brackets or strings do not close."""
    sums = _pieces(spark, path).mapInArrow(_sum_up, _SUMS)
    order = Window.partitionBy("file").orderBy("block")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    quoted = sums.withColumn("quote", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    changed = quoted.withColumn("change", F.when(F.col("quote") == 0, F.col("outside")).otherwise(F.col("inside")))
    depth = F.sum("change").over(whole)
    packed = F.col("file").rlike(_PACKED)
    is_open = F.when(packed, (depth < 0).cast("int")).otherwise(F.sum("n_bytes").over(whole) - F.col("size"))
    return changed.select(
        "file", "block", F.col("quote").cast("int").alias("quote"),
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), F.max("top").over(whole).alias("top"),
        F.max("block").over(whole).alias("last"), (is_open > 0).alias("open"),
        ((F.sum("turn").over(whole) % 2 != 0) | (depth + is_open != 0)).alias("broken"))


class _Elements:
    """The elements of one block, piece by piece: those of the document's list, or the whole of any other document."""

    def __init__(self, quote: int, depth: int, top: str, first: bool):
        self.inside, self.depth, self.listed = quote, depth, top == "["
        self.done = self.listed and not first and depth == 0
        self.fresh, self.begun, self.text, self.found = first, first or self.done, [], []

    def _end(self, text: str, last: bool = False) -> None:
        self.text.append(text)
        whole = "".join(self.text).rstrip(_BLANKS)
        whole = whole.lstrip(_BLANKS) if self.begun else whole
        if whole or not (last and self.fresh):
            self.found.append((whole, self.begun, True))
        self.text, self.begun, self.fresh = [], True, False

    def _scan(self, text: str) -> None:
        """Cut one piece, with its brace, at the commas of the list."""
        at = begin = 0
        if self.inside:
            end = _STRING_END.match(text)
            if not end:
                self.text.append(text)
                return
            at = end.end()
        for m in _SIGNS.finditer(text, at):
            sign = m.group()
            if sign[0] == '"':
                continue
            if sign in "[{":
                self.depth += 1
                if self.depth == 1 and self.listed and not self.done:
                    begin = m.end()
            elif sign == ",":
                if self.depth == 1 and self.listed and not self.done:
                    self._end(text[begin:m.start()])
                    begin = m.end()
            else:
                self.depth -= 1
                if self.depth == 0 and self.listed and not self.done:
                    self._end(text[begin:m.start()], last=True)
                    begin, self.done = m.end() if sign == "]" else m.start(), True  # a wrong sign is left over
        self.text.append(text[begin:])

    def feed(self, values: pa.Array, is_open: bool) -> None:
        """Take pieces of the block; ``is_open`` says that no brace follows the last of them."""
        plain = _unescaped(values)
        turns = _turns(plain)
        inside = self.inside ^ ((np.cumsum(turns) - turns) & 1)
        structure = _structure(plain, inside == 1)
        change, after = _change(structure), inside ^ turns
        braces = np.ones(len(values), np.int64)
        if is_open:
            braces[-1] = 0
        change -= (after == 0) * braces
        depth = self.depth + np.cumsum(change)
        before = depth - change
        closed = _numbers(pc.count_substring_regex(structure, r"[\]}]")) + 1
        inner = before - closed >= 2 if self.listed else np.ones(len(values), bool)
        flat = np.zeros(len(values), bool)
        if self.listed and not self.done:
            one = pc.match_substring_regex(structure, r"^[ \t\r\n\f]*,[ \t\r\n\f]*\{[^\[\]{}]*$").to_numpy(zero_copy_only=False)
            flat = one & (before == 1) & (depth == 1) & (inside == 0) & (braces == 1)
        texts = pc.binary_join_element_wise(values, pc.if_else(pa.array(braces == 1), "}", ""), "").to_pylist()
        kinds = np.where(flat, 2, np.where(inner, 1, 0))
        edges = np.flatnonzero(np.diff(kinds)) + 1
        for a, b in zip([0, *edges], [*edges, len(texts)]):
            if kinds[a] == 2:  # each comma ends the element before it
                self._end("")
                own = [t.lstrip(_BLANKS)[1:] for t in texts[a:b]]
                self.found += [(t.strip(_BLANKS), True, True) for t in own[:-1]]
                self.text = [own[-1]]
            elif kinds[a] == 1:
                self.text += texts[a:b]
                self.depth = int(depth[b - 1])
            else:
                for i in range(a, b):
                    self.inside, self.depth = int(inside[i]), int(before[i])
                    self._scan(texts[i])
        self.inside, self.depth = int(after[-1]), int(depth[-1])

    def close(self, last: bool) -> list[tuple[str, bool, bool]]:
        """All elements of the block as ``(text, begun here, ended here)``; the rest of the last block is one as well."""
        rest = "".join(self.text)
        if not self.done or rest.strip(_BLANKS):
            ends = last or self.done
            if not (ends and self.begun and not rest.strip(_BLANKS)):
                self.found.append((rest.strip(_BLANKS) if ends and self.begun else rest, self.begun, ends))
        return self.found


_ELEMENTS = "file string, modified long, block long, place long, text string, begun boolean, ended boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each block, those across its ends in parts."""
    key = block = None
    state, written = (), 0

    def rows(found):
        nonlocal written
        n, at = len(found), written
        written += n
        texts, begun, ended = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n, pa.string()), pa.array([state[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.int64()),
             pa.array(range(at, at + n), pa.int64()), pa.array(texts, pa.string()), pa.array(begun, pa.bool_()),
             pa.array(ended, pa.bool_())], names=[c.split()[0] for c in _ELEMENTS.split(", ")])

    held = None  # the last piece seen of a block: whether a brace follows it is known once the block has ended

    for batch in batches:
        for here, a, b in _runs(batch):
            if here != key:
                if key:
                    block.feed(held, state[1] and state[2])
                    yield rows(block.close(state[1]))
                key, written = here, 0
                one = {c: batch.column(c)[a].as_py() for c in ("modified", "quote", "depth", "top", "last", "open")}
                state = (one["modified"], here[1] == one["last"], one["open"])
                block, held = _Elements(one["quote"], one["depth"], one["top"], here[1] == 0), None
            values = batch.column("value").slice(a, b - a)
            if held is not None:
                block.feed(held, False)
            if len(values) > 1:
                block.feed(values.slice(0, len(values) - 1), False)
            held = values.slice(len(values) - 1)
            if block.found:
                yield rows(block.found)
                block.found = []
    if key:
        block.feed(held, state[1] and state[2])
        yield rows(block.close(state[1]))


def elements(spark: SparkSession, path: str, states: DataFrame) -> DataFrame:
    """``file, modified, block, place, text`` of every element of the sound documents' lists, or of the document itself where
    it is no list. ``states`` are the stored :func:`block_states`; ``place`` counts from 0 in each block, in which the element
    begins."""
    sound = states.filter(~F.col("broken")).drop("broken")
    if states.count() <= BROADCAST_BLOCKS:
        sound = F.broadcast(sound)
    cut = _pieces(spark, path).join(sound, ["file", "block"]).mapInArrow(_cut, _ELEMENTS)
    columns = ("file", "modified", "block", "place", "text")
    is_whole = F.col("begun") & F.col("ended")
    order = Window.partitionBy("file").orderBy("block", "place")
    parts = cut.filter(~is_whole).withColumn("number", F.sum(F.col("begun").cast("int")).over(order))
    in_order = F.array_sort(F.collect_list(F.struct("block", "place", "text", "modified")))
    joined = parts.groupBy("file", "number").agg(in_order.alias("parts")).select(
        "file", F.col("parts")[0].modified.alias("modified"), F.col("parts")[0].block.alias("block"),
        F.col("parts")[0].place.alias("place"),
        F.regexp_replace(F.array_join(F.transform("parts", lambda p: p.text), ""), r"^[ \t\r\n\f]+|[ \t\r\n\f]+$", "").alias("text"))
    return cut.filter(is_whole).select(*columns).unionByName(joined.filter(F.col("text") != "").select(*columns))


def records(found: DataFrame, schema: T.StructType) -> DataFrame:
    """Elements with ``_place``, ``_text``, their arrival position and, where one is a record, ``_record``. An element that is
    no single object, or has none of the fields, is no record."""
    text = F.col("text")
    single = text.startswith("{") & (F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1)
    cell = F.struct(F.timestamp_micros("modified").alias("modified"), "file", "block", F.lit(0).cast("bigint").alias("position"))
    read = found.select("file", F.col("place").alias("_place"), text.alias("_text"),
                        F.struct(cell.alias("cell"), F.col("place").alias("record")).alias(SEQ),
                        F.when(single, F.from_json(text, schema)).alias("_record"))
    filled = F.coalesce(*[F.col(f"_record.{f.name}") for f in schema])
    return read.withColumns({"_record": F.when(filled.isNotNull(), F.col("_record")),
                             "_text": F.coalesce(F.get_json_object("_text", "$"), F.col("_text"))})
