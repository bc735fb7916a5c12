"""Fill-in-the-middle texts by displacement: each byte of a batch learns how far it moves, and one scatter moves all.

A batch of texts is one array of bytes.  Cuts are counted in code points and found by a scan of the bytes that begin
one.  The parts of a text (prefix, middle, suffix) differ only in their shift, output place less input place; a
difference array holds the changes of the shift at the parts' first bytes, its running sum the shift of every byte.
Restoring looks for the three marks in the output, and gathers by the opposite shifts.  Scans, sums and moves run over
slices of the array, so that a task holds its batch, the output and a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import limit_batches

# Bytes looked at together.
SLICE = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
# The share of texts that stay plain, and of the others that put the suffix first, in percent.
PLAIN_PERCENT, SPM_PERCENT = 10, 20


def _slices(n: int) -> Iterator[tuple[int, int]]:
    for low in range(0, n, SLICE):
        yield low, min(n, low + SLICE)


def _begins(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a code point of UTF-8."""
    return (data & 0xC0) != 0x80


def points_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many code points begin ahead of each of the ascending byte offsets ``at``."""
    out, done = np.zeros(len(at), dtype=np.int64), 0
    for low, high in _slices(len(data)):
        a, b = np.searchsorted(at, [low, high], side="right")
        counts = np.concatenate([[0], np.cumsum(_begins(data[low:high]))])
        out[a:b] = done + counts[at[a:b] - low]
        done += int(counts[-1])
    return out


def bytes_of(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Byte offsets of the code points with these numbers; a number past the last is the end."""
    out, done = np.full(len(points), len(data), dtype=np.int64), 0
    for low, high in _slices(len(data)):
        begins = np.flatnonzero(_begins(data[low:high]))
        here = (points >= done) & (points < done + len(begins))
        out[here] = low + begins[points[here] - done]
        done += len(begins)
    return out


def _shifts(n: int, at: np.ndarray, shift: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slices of positions below ``n`` with the shift of each.  Part i begins at ``at[i]`` (ascending; parts may be
    empty) and has ``shift[i]``."""
    change = np.diff(shift, prepend=0)
    carry = 0
    for low, high in _slices(n):
        a, b = np.searchsorted(at, [low, high])
        steps = np.zeros(high - low, dtype=np.int64)
        np.add.at(steps, at[a:b] - low, change[a:b])
        steps[0] += carry
        np.cumsum(steps, out=steps)
        carry = int(steps[-1])
        yield np.arange(low, high), steps


def scatter(data: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of texts that lie back to back, and the ends of the outputs.  ``ends`` are the ends of the texts,
    ``first`` and ``second`` the byte offsets where the middle begins and ends."""
    begins = np.concatenate([[0], ends])[:-1]
    moved = form != PLAIN
    out_ends = np.cumsum(ends - begins + 9 * moved)
    base = out_ends - (ends - begins) - 9 * moved
    prefix, suffix = first - begins, ends - second
    spm = form == SPM
    to_prefix = np.where(moved, base + 3 + spm * (suffix + 3), base)
    to_suffix = np.where(moved, base + 3 + ~spm * (prefix + 3), base + second - begins)
    to_middle = np.where(moved, base + prefix + suffix + 9, base + prefix)
    at = np.stack([begins, first, second], axis=1).ravel()
    shift = np.stack([to_prefix - begins, to_middle - first, to_suffix - second], axis=1).ravel()
    out = np.empty(int(out_ends[-1]) if len(out_ends) else 0, dtype=np.uint8)
    for place, by in _shifts(len(data), at, shift):
        out[place + by] = data[place[0]:place[-1] + 1]
    for part, place in (("prefix", to_prefix), ("suffix", to_suffix), ("middle", to_middle)):
        for i, byte in enumerate(MARKS[part]):
            out[place[moved] - 3 + i] = byte
    return out, out_ends


def _marks(out: np.ndarray) -> np.ndarray:
    """Where marks begin."""
    found = []
    for low, high in _slices(max(0, len(out) - 2)):
        window = out[low:high + 2]
        hit = (window[:-2] == ord("<")) & (window[2:] == ord(">")) & np.isin(window[1:-1], np.frombuffer(b"PSM", dtype=np.uint8))
        found.append(np.flatnonzero(hit) + low)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def gather(out: np.ndarray, out_ends: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that :func:`scatter` was given, from outputs and forms alone.  A text that was cut holds no mark,
    and no cut can make one, so each such output has exactly three."""
    begins = np.concatenate([[0], out_ends])[:-1]
    moved = np.flatnonzero(form != PLAIN)
    at = _marks(out)
    owner = np.searchsorted(out_ends, at, side="right")
    # What looks like a mark across the border of two texts is none.
    at = at[(form[owner] != PLAIN) & (at + 3 <= out_ends[owner])].reshape(len(moved), 3)
    psm = form[moved] == PSM
    # Parts as the output has them: prefix and suffix (or the other way round) behind the first two marks, the middle last.
    one, two, three = at[:, 0] + 3, at[:, 1] + 3, at[:, 2] + 3
    sizes = np.zeros((len(form), 3), dtype=np.int64)
    sizes[:, 0] = out_ends - begins
    starts = np.repeat(begins[:, None], 3, axis=1)
    first_size, second_size, middle = at[:, 1] - one, at[:, 2] - two, out_ends[moved] - three
    sizes[moved] = np.stack([np.where(psm, first_size, second_size), middle, np.where(psm, second_size, first_size)], axis=1)
    starts[moved] = np.stack([np.where(psm, one, two), three, np.where(psm, two, one)], axis=1)
    stops = np.cumsum(sizes.ravel())
    places = stops - sizes.ravel()
    text = np.empty(int(stops[-1]) if len(stops) else 0, dtype=np.uint8)
    for place, by in _shifts(len(text), places, starts.ravel() - places):
        text[place] = out[place + by]
    return text, stops[2::3]


def _column(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.string())


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and where each text ends."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets[1:] - offsets[0]


def _dice(key: Column, number: int) -> Column:
    """The ``number``-th group of eight digits of the key's digest, as an unsigned number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", plain: int = PLAIN_PERCENT, spm: int = SPM_PERCENT,
                   carry: bool = False) -> DataFrame:
    """Cut every text at two places that its id draws, and put the middle last, behind marks.

    Returns, one row per input row, ``key, n`` (code points), ``form`` (plain, psm or spm), ``prefix_chars, middle_chars``
    (null if plain), ``output`` and ``restored``, the text rebuilt from output and form; with ``carry`` also ``row``, all
    columns of the input, whatever their names.  A text that is empty, null (which counts as empty) or
    holds a mark stays plain, as do ``plain`` percent of the others.  Rows of one id are cut by the same draws, each in
    its own text; rows without an id draw as if the id were empty text.  No shuffle: each row is made from itself alone.
    """
    limit_batches(docs.sparkSession)
    source, told = F.coalesce(F.col(text), F.lit("")), F.col(key)
    kept = F.contains(source, F.lit("<P>")) | F.contains(source, F.lit("<S>")) | F.contains(source, F.lit("<M>"))
    form = (F.when((source == "") | kept | (_dice(told, 3) % 100 >= 100 - plain), PLAIN)
             .when(_dice(told, 4) % 100 < spm, SPM).otherwise(PSM))
    row = [F.struct("*").alias("row")] if carry else []
    rows = docs.select(told.alias("_key"), *row, source.alias("_text"), form.alias("_form"), _dice(told, 1).alias("_a"), _dice(told, 2).alias("_b"))
    names = pa.array(["plain", "psm", "spm"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _raw(batch.column("_text"))
            kind = batch.column("_form").to_numpy(zero_copy_only=False)
            begins = np.concatenate([[0], ends])[:-1]
            before = points_before(data, np.concatenate([begins, [len(data)]]))
            n = np.diff(before)
            drawn = [batch.column(c).to_numpy(zero_copy_only=False) % (n + 1) for c in ("_a", "_b")]
            low, high = np.minimum(*drawn), np.maximum(*drawn)
            first, second = (np.minimum(bytes_of(data, before[:-1] + c), ends) for c in (low, high))
            out, out_ends = scatter(data, ends, first, second, kind)
            text_again, text_ends = gather(out, out_ends, kind)
            off = kind == PLAIN
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(n), names.take(pa.array(kind)), pa.array(low, mask=off), pa.array(high - low, mask=off),
                 _column(out, out_ends), _column(text_again, text_ends), *([batch.column("row")] if carry else [])],
                names=["_key", *fields])

    fields = ["n", "form", "prefix_chars", "middle_chars", "output", "restored", *(["row"] if carry else [])]
    schema = T.StructType([rows.schema["_key"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
                           T.StructField("output", T.StringType()), T.StructField("restored", T.StringType()),
                           *([rows.schema["row"]] if carry else [])])
    return rows.mapInArrow(scan, schema).withColumnRenamed("_key", key)


def restore_middle(made: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Adds ``name``, the text that an output of :func:`fill_in_middle` was made of, to rows that hold output and form.
    A null output or form gives null.  Outputs that do not hold exactly their three marks stop the job."""
    limit_batches(made.sparkSession)
    rows = made.select(F.struct("*").alias("row"), F.coalesce(F.col(output), F.lit("")).alias("_out"),
                       F.coalesce(F.when(F.col(output).isNull(), PLAIN).when(F.col(form) == "psm", PSM).when(F.col(form) == "spm", SPM), F.lit(PLAIN)).alias("_form"),
                       (F.col(output).isNull() | F.col(form).isNull()).alias("_none"))

    def scan(batches):
        for batch in batches:
            again = _column(*gather(*_raw(batch.column("_out")), batch.column("_form").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), again, batch.column("_none")], names=["row", "_again", "_none"])
    out = rows.mapInArrow(scan, T.StructType([rows.schema["row"], T.StructField("_again", T.StringType()), rows.schema["_none"]]))
    kept = [F.col(f"row.`{c}`").alias(c) for c in made.columns if c != name]
    return out.select(*kept, F.when(~F.col("_none"), F.col("_again")).alias(name))
