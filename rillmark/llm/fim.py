"""Fill-in-the-middle by displacement scatter.

A batch of texts is one array of bytes.  Scans over it find the lines and the two cuts of every text; the
pieces between the cuts each move by one distance.  These distances go into a difference array at the first
byte of each piece, its cumulative sum is the displacement of every byte, and one scatter writes the
outputs.  The way back sums the same differences over the bytes of the text and gathers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SEED = 7
# of 100 texts, so many are cut, and so many of those have the suffix first
RATE = 100
SUFFIX_FIRST = 50
# fixed values: the marks before prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], dtype=object)
# bytes of texts rearranged at a time (a longer text is one group of its own), and bytes with displacements at a time
GROUP = 4 << 20
WINDOW = 1 << 18


def _windows(size: int) -> Iterator[tuple[int, int]]:
    for at in range(0, size, WINDOW):
        yield at, min(at + WINDOW, size)


def _line_feeds(data: np.ndarray) -> np.ndarray:
    found = [np.flatnonzero(data[a:b] == 0x0A) + a for a, b in _windows(len(data))]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _marks(data: np.ndarray) -> np.ndarray:
    """Where ``<P>``, ``<S>`` or ``<M>`` begins."""
    found = [np.zeros(0, np.int64)]
    for a, b in _windows(len(data)):
        opens = np.flatnonzero(data[a:b] == PREFIX[0]) + a
        opens = opens[opens + 2 < len(data)]
        letter = data[opens + 1]
        named = (letter == PREFIX[1]) | (letter == SUFFIX[1]) | (letter == MIDDLE[1])
        found.append(opens[named & (data[opens + 2] == PREFIX[2])])
    return np.concatenate(found)


def _characters_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Code points that begin before each of the ascending places."""
    counts, before = np.zeros(len(places), np.int64), 0
    for a, b in _windows(len(data)):
        upto = np.concatenate([[0], np.cumsum((data[a:b] & 0xC0) != 0x80)])
        first, last = np.searchsorted(places, [a, b], "left")
        counts[first:last] = before + upto[places[first:last] - a]
        before += int(upto[-1])
    counts[np.searchsorted(places, len(data), "left") :] = before
    return counts


def _displacements(places: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The shift of every byte, window by window: ``shifts[i]`` holds from the ascending ``places[i]`` on."""
    steps = np.diff(shifts, prepend=0)
    carried = 0
    for a, b in _windows(size):
        first, last = np.searchsorted(places, [a, b], "left")
        moved = np.zeros(b - a, np.int64)
        np.add.at(moved, places[first:last] - a, steps[first:last])
        moved[0] += carried
        np.cumsum(moved, out=moved)
        carried = int(moved[-1])
        yield a, b, moved


def _layout(form: np.ndarray, starts: np.ndarray, cuts: tuple[np.ndarray, np.ndarray], ends: np.ndarray, into: np.ndarray):
    """Where prefix, middle and suffix of every text go, and the three marks, if its output begins at ``into``."""
    first, second = cuts
    prefix, suffix = first - starts, ends - second
    to_prefix = np.where(form == PSM, into + MARK, into + 2 * MARK + suffix)
    to_suffix = np.where(form == PSM, into + 2 * MARK + prefix, into + MARK)
    to_middle = into + 3 * MARK + prefix + suffix
    plain = form == PLAIN
    to_prefix, to_middle, to_suffix = (
        np.where(plain, into + at - starts, to) for at, to in ((starts, to_prefix), (first, to_middle), (second, to_suffix))
    )
    return to_prefix, to_middle, to_suffix


def _interleaved(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, 1).ravel()


class Group:
    """Consecutive texts as one array of bytes and their bounds in it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data = data[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        self.starts, self.ends = bounds[:-1], bounds[1:]

    def cut(self, draws: np.ndarray, rate: int, suffix_first: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """Lines, form and the two cuts of every text; ``draws`` has four numbers for each."""
        feeds = _line_feeds(self.data)
        before = np.searchsorted(feeds, self.starts)
        ended = np.searchsorted(feeds, self.ends) - before
        some = self.ends > self.starts
        open_end = np.zeros(len(some), bool)
        open_end[some] = self.data[self.ends[some] - 1] != 0x0A
        lines = ended + open_end

        def place(unit: np.ndarray) -> np.ndarray:
            inner = (unit > 0) & (unit <= ended)
            at = np.where(unit == 0, self.starts, self.ends)
            at[inner] = feeds[before[inner] + unit[inner] - 1] + 1
            return at

        one, two = draws[0] % (lines + 1), draws[1] % (lines + 1)
        marks = _marks(self.data)
        holder = np.searchsorted(self.ends, marks, "right")
        marked = np.zeros(len(lines), bool)
        marked[holder[marks + MARK <= self.ends[holder]]] = True
        plain = ~some | marked | (draws[2] % 100 >= rate)
        form = np.where(plain, PLAIN, np.where(draws[3] % 100 < suffix_first, SPM, PSM))
        return lines, form, (place(np.minimum(one, two)), place(np.maximum(one, two)))

    def characters(self, cuts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Code points of prefixes and middles."""
        at = _characters_before(self.data, _interleaved(self.starts, *cuts)).reshape(-1, 3)
        return at[:, 1] - at[:, 0], at[:, 2] - at[:, 1]

    def scatter(self, form: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The outputs as bytes and bounds."""
        sizes = self.ends - self.starts + np.where(form == PLAIN, 0, 3 * MARK)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        into = bounds[:-1]
        to = _layout(form, self.starts, cuts, self.ends, into)
        out = np.empty(bounds[-1], np.uint8)
        places = _interleaved(self.starts, *cuts)
        for a, b, moved in _displacements(places, _interleaved(*to) - places, len(self.data)):
            moved += np.arange(a, b)
            out[moved] = self.data[a:b]
        cut = form != PLAIN
        # each mark stands right before its piece
        for mark, at in zip((PREFIX, MIDDLE, SUFFIX), to, strict=True):
            out[at[cut][:, None] - MARK + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
        return out, bounds

    def gather(self, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts, as bytes and bounds, of outputs of these forms."""
        cut = form != PLAIN
        marks = _marks(self.data)
        holder = np.searchsorted(self.ends, marks, "right")
        marks = marks[cut[holder]]
        if len(marks) != 3 * cut.sum():
            raise ValueError("an output has other marks than its form says")
        second, third = np.zeros((2, len(form)), np.int64)
        second[cut], third[cut] = marks[1::3], marks[2::3]
        sizes = self.ends - self.starts - np.where(cut, 3 * MARK, 0)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        starts, ends = bounds[:-1], bounds[1:]
        # the piece after the first mark, and the one after the second
        one, two = second - self.starts - MARK, third - second - MARK
        prefix, suffix = np.where(form == PSM, one, two), np.where(form == PSM, two, one)
        cuts = (np.where(cut, starts + prefix, starts), np.where(cut, ends - suffix, starts))
        places = _interleaved(starts, *cuts)
        from_ = _interleaved(*_layout(form, starts, cuts, ends, self.starts))
        out = np.empty(bounds[-1], np.uint8)
        for a, b, moved in _displacements(places, from_ - places, len(out)):
            moved += np.arange(a, b)
            out[a:b] = self.data[moved]
        return out, bounds


def _groups(texts: pa.Array) -> Iterator[tuple[int, int, Group]]:
    """Texts of one batch in groups of some ``GROUP`` bytes: first row, row after the last, group."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + GROUP, "right")) - 1)
        yield first, last, Group(data, bounds[first : last + 1])
        first = last


def _strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, buffers)


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """Per row: id, ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A line goes up to and with its line feed.  Two lines drawn from the hash of seed and id cut the text into
    prefix, middle and suffix; ``psm`` and ``spm`` say in which order they stand, after their marks.  Plain
    texts stay as they are and have no counts: empty ones, those that hold a mark, and those beyond ``rate`` per cent.
    A null text counts as empty, a null id as the empty text; repeated rows get the same result each, an
    empty table gives none.  Other columns are not read.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    source = docs.select(F.col(doc_id), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), *draws)
    schema = StructType(
        [
            StructField(doc_id, docs.schema[doc_id].dataType),
            StructField("n", LongType()),
            StructField("form", StringType()),
            StructField("prefix_chars", LongType()),
            StructField("middle_chars", LongType()),
            StructField("output", StringType()),
        ]
    )

    def rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)]
            for first, last, group in _groups(batch.column(1)):
                lines, form, cuts = group.cut(np.stack([h[first:last] for h in numbers]), rate, suffix_first)
                prefix, middle = group.characters(cuts)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(lines, pa.int64()),
                        pa.array(FORMS[form], pa.string()),
                        pa.array(prefix, pa.int64(), mask=plain),
                        pa.array(middle, pa.int64(), mask=plain),
                        _strings(*group.scatter(form, cuts)),
                    ],
                    names=schema.names,
                )

    return source.mapInArrow(rearranged, schema)


def restore(filled: DataFrame, keep: list[str], form: str = "form", output: str = "output", restored_as: str = "restored") -> DataFrame:
    """The columns ``keep`` and the text rebuilt from output and form alone; a null output counts as empty."""
    schema = StructType([*(filled.schema[c] for c in keep), StructField(restored_as, StringType())])
    body = F.coalesce(F.col(output), F.lit(""))

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(len(keep)).to_numpy(zero_copy_only=False)
            forms = np.where(names == "psm", PSM, np.where(names == "spm", SPM, PLAIN))
            for first, last, group in _groups(batch.column(len(keep) + 1)):
                kept = [batch.column(i).slice(first, last - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, _strings(*group.gather(forms[first:last]))], names=schema.names)

    return filled.select(*keep, F.col(form).alias("form_of"), body.alias("output_of")).mapInArrow(gathered, schema)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``fill_in_middle`` with the SHA-256 of the output, and of the text that ``restore`` makes of it."""
    filled = fill_in_middle(docs, doc_id, text).withColumn("output_sha256", F.sha2("output", 256))
    kept = [doc_id, "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return restore(filled, kept).select(*kept, F.sha2("restored", 256).alias("restored_sha256"))
