"""Product codes of vectors: integer k-means per part, with nearest entries found through memoised grid cells.

A vector's components become integers, and the vector is cut into parts with a codebook each. To assign a part, its space is cut into cubes of
``cell`` units. The part's cube is the key of a memo. For a cube that the memo doesn't hold, the least and the largest distance from any point of
the cube to each entry are added up from one small table per dimension; an entry whose least distance is above the smallest of the largest
distances can be nearest nowhere in the cube. The entries that are left go into the memo, and only these are compared exactly with the points of the cube.
So the result is exact whatever the cell; its width only decides how many points share a cube and how many entries remain.

A round of k-means is one narrow pass over the vectors: tasks send sums and counts per entry, Spark adds them up, and the driver gets one row
per entry component (at most 256 entries, so the size follows the vectors' length and not their number). Tasks hold no state that a lost executor would take away.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRIES = 256
#: Integer components beyond this are refused: squared distances must fit 64 bits.
MOST = 1 << 26
#: Cells that a part's memo holds before it starts afresh, and vectors that are assigned together.
MEMO_CELLS, STEP = 1 << 14, 4096
_CHUNK = 512


def _bounds(cells: np.ndarray, width: int, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between each cell's points and each entry. Cells share their coordinates, so each dimension's terms are worked out once per coordinate."""
    least, largest = (np.zeros((len(cells), len(book)), np.int64) for _ in range(2))
    for j in range(cells.shape[1]):
        at, which = np.unique(cells[:, j], return_inverse=True)
        low = at[:, None] * width - book[:, j]
        high = low + width - 1
        least += (np.maximum(np.maximum(low, -high), 0) ** 2)[which]
        largest += (np.maximum(np.abs(low), np.abs(high)) ** 2)[which]
    return least, largest


def _candidates(cells: np.ndarray, width: int, book: np.ndarray) -> np.ndarray:
    least, largest = _bounds(cells, width, book)
    return least <= largest.min(1)[:, None]


def cell_width(book: np.ndarray, share: float = 0.125) -> int:
    """The widest power of two whose cells leave at most ``share`` of the entries on average, tried on the cells midway between neighbouring entries."""
    if len(book) < 2:
        return MOST
    middle = (book + np.roll(book, 1, axis=0)) // 2
    width = 1
    while width < MOST and _candidates(middle // (2 * width), 2 * width, book).mean() <= share:
        width *= 2
    return width


class Cells:
    """The memo of one part: assigns points to their nearest entries, ties to the lower index."""

    def __init__(self, book: np.ndarray, width: int | None = None, most: int = MEMO_CELLS):
        self.book, self.most = book, most
        self.width = width or cell_width(book)
        self.place: dict[bytes, int] = {}
        self.left = np.zeros((most, len(book)), bool)
        self.points = self.cells = self.compared = 0

    def _look_up(self, cells: np.ndarray) -> np.ndarray:
        """Each cell's row in ``left``; cells that aren't there are worked out. At most ``most`` cells."""
        keys = np.ascontiguousarray(cells, np.int32).view(f"V{4 * cells.shape[1]}").reshape(-1).tolist()
        new = {key: k for k, key in enumerate(keys) if key not in self.place}
        if len(self.place) + len(new) > self.most:
            self.place.clear()
            new = {key: k for k, key in enumerate(keys)}
        at, some = len(self.place), np.fromiter(new.values(), np.int64, len(new))
        for k in range(0, len(some), _CHUNK):
            self.left[at + k : at + min(k + _CHUNK, len(some))] = _candidates(cells[some[k : k + _CHUNK]], self.width, self.book)
        self.place.update(zip(new, range(at, at + len(new)), strict=True))
        self.cells += len(new)
        return np.array([self.place[key] for key in keys], np.int64)

    def assign(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point."""
        code, error = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        self.points += len(points)
        if not points.shape[1]:
            return code, error
        step = max(1, min(STEP, self.most))
        for at in range(0, len(points), step):
            some = points[at : at + step]
            rows = self._look_up(some // self.width)
            for k in range(0, len(some), _CHUNK):
                end = min(k + _CHUNK, len(some))
                code[at + k : at + end], error[at + k : at + end] = self._nearest(some[k:end], self.left[rows[k:end]])
        return code, error

    def _nearest(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        point, entry = np.nonzero(left)
        self.compared += len(point)
        apart = np.zeros(len(point), np.int64)
        for j in range(points.shape[1]):
            apart += (points[point, j] - self.book[entry, j]) ** 2
        first = np.searchsorted(point, np.arange(len(points)))
        least = np.minimum.reduceat(apart, first)
        hits = np.flatnonzero(apart == least[point])
        return entry[hits[np.searchsorted(point[hits], np.arange(len(points)))]], least


@dataclass
class Codebooks:
    """books: per part an array (entries, components). A vector of ``length`` components is cut at ``cuts``; ``cells``: the memos' cell widths, chosen by the first codebooks if ``cell`` is None."""

    length: int
    books: list[np.ndarray]
    cell: int | None = None
    cuts: list[int] = field(init=False)
    cells: list[int] = field(init=False)

    def __post_init__(self):
        self.cuts = [p * self.length // len(self.books) for p in range(len(self.books) + 1)]
        self.cells = [self.cell or cell_width(b) for b in self.books]

    def memos(self) -> list[Cells]:
        return [Cells(b, w) for b, w in zip(self.books, self.cells, strict=True)]

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def _whole(vector: F.Column) -> F.Column:
    """Not null, no null and only finite components. NaN counts as larger than infinity."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))


def integers(vectors: pa.Array, length: int) -> np.ndarray:
    """floor(1024 * x) of all components, one row for each vector."""
    made = np.floor(pc.list_flatten(vectors).to_numpy(zero_copy_only=False) * 1024.0)
    if len(made) and np.abs(made).max() > MOST:
        raise ValueError(f"a component lies beyond {MOST // 1024} in size")
    return made.astype(np.int64).reshape(-1, length)


def _usable(vectors: DataFrame, vector_col: str, length: int) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    return vectors.where(_whole(vector) & (F.size(vector) == length))


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 4, rounds: int = 4, cell: int | None = None) -> Codebooks:
    """Codebooks of the usable vectors after ``rounds`` rounds from the parts of the 256 smallest ids (fewer if there are fewer; rows with one id go by their components; null ids aren't
    among them but count in every round). Entries that no vector is nearest to stay.

    Vectors that are null or hold null or non-finite components are skipped, and so are those of another length than the usable vector with the smallest id. An empty table gives
    codebooks without entries. A length that ``parts`` doesn't divide is cut as evenly as can be. Other columns aren't read. A component beyond 65536 in size is an error.
    """
    vector = F.col(vector_col).cast("array<double>")
    known = vectors.where(_whole(vector) & F.col(id_col).isNotNull() & (F.size(vector) > 0)).select(F.col(id_col).alias("i"), vector.alias("v"))
    first = known.orderBy("i", "v").first()
    length = len(first["v"]) if first else 0
    start = known.where(F.size("v") == length).orderBy("i", "v").limit(ENTRIES).select("v").collect() if first else []
    n = len(start)
    whole = integers(pa.array([r["v"] for r in start], pa.list_(pa.float64())), max(length, 1)).reshape(n, length)
    cuts = [p * length // parts for p in range(parts + 1)]
    made = Codebooks(length, [np.ascontiguousarray(whole[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], cell)
    if not n:
        return made
    rows, sc = _usable(vectors, vector_col, length).select(vector.alias("v")), vectors.sparkSession.sparkContext
    width = length + parts
    for _ in range(rounds):
        shared = sc.broadcast(made)

        def run(batches, shared=shared):
            books = shared.value
            memos, total = books.memos(), np.zeros((n, width), np.int64)
            for batch in batches:
                z = integers(batch.column("v"), length)
                for p, memo in enumerate(memos):
                    code, _ = memo.assign(z[:, cuts[p] : cuts[p + 1]])
                    for j in range(cuts[p], cuts[p + 1]):
                        np.add.at(total[:, j], code, z[:, j])
                    total[:, length + p] += np.bincount(code, minlength=n)
            used = np.repeat(total[:, length:] > 0, np.diff(cuts), axis=1)
            slot = np.flatnonzero(np.concatenate((used, total[:, length:] > 0), axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.reshape(-1)[slot])], names=["slot", "amount"])

        sums = rows.mapInArrow(run, "slot long, amount long").groupBy("slot").agg(F.sum("amount").alias("amount")).collect()
        shared.destroy()
        total = np.zeros(n * width, np.int64)
        for r in sums:
            total[r["slot"]] = r["amount"]
        total = total.reshape(n, width)
        for p, book in enumerate(made.books):
            count = total[:, length + p]
            book[count > 0] = total[count > 0, cuts[p] : cuts[p + 1]] // count[count > 0, None]
    return made


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """The usable rows with all their columns, ``code`` (two hex digits for each part's entry) and ``error`` (squared distances summed over the parts); columns of these names are replaced.

    Rows that ``fit`` skips are left out; repeated rows get equal codes; an empty table, or codebooks without entries, give no rows.
    """
    vectors = vectors.drop("code", "error")
    schema = T.StructType([*vectors.schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    rows = _usable(vectors, vector_col, books.length).where(F.lit(books.length > 0))
    shared, names = vectors.sparkSession.sparkContext.broadcast(books), vectors.columns
    at = names.index(vector_col)

    def run(batches):
        books = shared.value
        memos = books.memos()
        for batch in batches:
            z = integers(batch.column(at).cast(pa.list_(pa.float64())), books.length)
            code, error = np.zeros((len(z), len(memos)), np.uint8), np.zeros(len(z), np.int64)
            for p, memo in enumerate(memos):
                code[:, p], apart = memo.assign(z[:, books.cuts[p] : books.cuts[p + 1]])
                error += apart
            text = [c.tobytes().hex() for c in code]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string()), pa.array(error)], names=[*names, "code", "error"])

    return rows.mapInArrow(run, schema)
