"""What the text operators share: table access, batches in Python tasks, hashing of words.

Texts travel to Python as Arrow batches and are worked on in blocks of about a
megabyte, so the memory of a task does not depend on its number of rows.
Settings that bound a batch in bytes (``spark.sql.execution.arrow.maxBytesPerBatch``)
apply as usual.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

U64 = np.uint64
BLOCK_CHARS = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, NULL text as empty, under fixed names."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, made longer until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches cut into parts of ``rows`` rows, so that a task holds less of them as Python values."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def number_lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a column of lists of numbers, none of them NULL, as views of its buffer."""
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(column.flatten().to_numpy(), ends[:-1])


def map_batches(
    df: DataFrame, work: Callable[[dict[str, list]], dict], schema: str, arrays: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """``work`` turns the columns of a batch into the columns of ``schema``.

    Columns are lists of Python values; those named in ``arrays`` hold lists of
    numbers and come as NumPy arrays, eight bytes a number instead of forty.
    ``rows`` cuts batches into parts of so many.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if rows is None else slices(batches, rows):
            if batch.num_rows:
                columns = {
                    name: number_lists(values) if name in arrays else values.to_pylist()
                    for name, values in zip(batch.schema.names, batch.columns)
                }
                yield pa.RecordBatch.from_pydict(work(columns), schema=arrow)

    return df.mapInArrow(run, schema)


def text_blocks(texts: Sequence[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of ``texts`` of about ``limit`` characters; a longer text is alone."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their sums and bits behave as random."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Space and tab to carriage return, as the contracts define the gaps between words.
GAPS = np.zeros(256, bool)
GAPS[[0x20, *range(0x09, 0x0E)]] = True
LONG_WORD = 64  # bytes
KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word, eight bytes at a time; longer words one by one.

    No step is linear, so no rule of spelling makes two words meet, and words of
    one length of up to eight bytes never do. Nothing is kept between calls.
    """
    length = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight_from = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    hashes = mixed(length.astype(U64) + U64(0x9E3779B97F4A7C15))
    at = np.flatnonzero(length <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        at = at[length[at] > k]
        if not len(at):
            break
        letters = eight_from[start[at] + k] & KEPT[np.minimum(length[at] - k, 8)]
        hashes[at] = mixed((hashes[at] ^ letters) * U64(0xD6E8FEB86659FD93) + U64(k + 1))
    for i in np.flatnonzero(length > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[start[i]:end[i]].tobytes())
    return hashes


class Words:
    """All words of a block of texts: ``hash``, ``doc`` (place in the block), ``start``, ``end``.

    Places are bytes of ``data``, in which every text follows a line feed.
    """

    def __init__(self, texts: Sequence[str], lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"\n" + b"\n".join(raw) + b"\n"
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        self.begin = np.cumsum([1, *(len(r) + 1 for r in raw)])
        gap = GAPS[self.data]
        self.start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        self.end = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        self.hash = word_hashes(self.data, self.start, self.end)
        self.doc = np.searchsorted(self.begin, self.start, side="right") - 1
        self.docs = len(raw)

    def first(self) -> np.ndarray:
        """Where each text's words begin; one entry more than texts."""
        return np.searchsorted(self.doc, np.arange(self.docs + 1))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words of one text, and its first word."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.empty(0, U64), np.empty(0, np.int64)
        total = np.zeros(n, U64)
        for k in range(size):
            total += self.hash[k:k + n] * POWERS_OF_PLACE[k]
        same = np.flatnonzero(self.doc[:n] == self.doc[size - 1:])
        return mixed(total[same]), same


POWERS_OF_PLACE = mixed(np.arange(1, 65, dtype=U64)) | U64(1)


def shingle_sets(texts: Sequence[str], size: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of ``size`` lower-cased words in a row.

    A text of fewer words gives one hash of all of them, a text without words none.
    """
    out: list[np.ndarray] = []
    for low, high in text_blocks(texts):
        words = Words(texts[low:high], lower=True)
        hashes, place = words.windows(size)
        bounds = np.searchsorted(words.doc[place], np.arange(high - low + 1))
        first = words.first()
        for i in range(high - low):
            own = hashes[bounds[i]:bounds[i + 1]]
            if not len(own) and (n := first[i + 1] - first[i]):
                few = words.hash[first[i]:first[i + 1]] * POWERS_OF_PLACE[:n]
                own = mixed(few.sum(dtype=U64, keepdims=True) + U64(n))
            out.append(np.unique(own))
    return out


def gather(starts: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """``flat[start:start + count]`` of each row, one after the other."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


def row_hash(column: Column | str, seed: int = 0) -> Column:
    """A fixed pseudo-random order of rows, to draw bounded training samples."""
    return F.xxhash64(F.lit(seed), column)
