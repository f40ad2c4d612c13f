"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, one kept occurrence per connected group.

A line is normalised (lower case, digits as 0, other signs as one blank). Two lines are linked if their edit similarity, 1 - edits / longer length, is at
least ``least``. Equal normalised lines are one class from the start.

Candidates come from SimHashes of B blocks of 32 bits. Each feature of a line is dealt to one block, and votes on the bits of that block only. So an edit can
change only the blocks of the features that it removes or adds, two of B for a word that is replaced, and by the pigeonhole principle lines that differ in few features agree
in a whole block however long they are; with votes on all bits the distance would grow with the share of changed features, and no block long enough to be selective would survive.
Pairs that agree in a block are tested. Features are the distinct words of at least ``WORD_BYTES``, or the distinct three-byte windows in lines of fewer than eight words; B grows with the number of words
(``LEVELS``), and a line just above the border of a level signs for the level below as well. Blocks with too little in them to be selective don't sign.

Lines so short that one edit is all that ``least`` allows (9 to 19 bytes at 0.9) have too few windows for that: one edit reaches most blocks. They sign with themselves and with each
of their texts less one byte; two lines one edit apart always share one of these, so none is lost there. Still shorter lines can't be similar without being equal.

Counts of letters refute most candidates that aren't similar, without loss: an edit changes two counts at most. The candidates' texts then decide exactly. Pairs whose edits reach all blocks are lost; the recall, against all pairs of lines, is measured in tests/llm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secdata.llm.shared import connected, join_hot, only_ids, release, settle, star_links
from secdata.llm.text import Words, byte_table, flat_bytes, mix, pieces, ranges

#: (fewest words, blocks) of each level. The first level's features are byte windows.
LEVELS = ((0, 6), (8, 3), (16, 4), (32, 6), (64, 8))
#: The part by which a line may exceed a level's border and still sign for the level below.
OVERLAP = 0.15
#: A block signs if its words have so many bytes, or if it has so many windows.
WORD_BYTES, BLOCK_BYTES, BLOCK_WINDOWS = 4, 12, 3
#: Classes that a task remembers, so that it signs for a class once.
REMEMBERED = 1 << 21
_SIGNS = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
_SIGNS[48:58] = 48
#: A byte's bits as eight counters.
_EIGHT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
#: Letters are counted in buckets of seven bits, seven to a number.
PACKED, PER_PACK = 4, 7
_LETTERS = [f"l{i}" for i in range(PACKED)]
_LINES = "doc long, line int, class long, len int, sigs array<long>, " + ", ".join(f"{c} long" for c in _LETTERS)


def normalised(text: str) -> str:
    """What is compared: the words of a line, joined by blanks, as bytes in Latin-1 (one character a byte)."""
    return " ".join(_SIGNS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("latin-1").replace("\0", " ").split())


def normalised_bytes(lines: pa.Array) -> pa.Array:
    """``normalised`` of many lines, as bytes."""
    words = Words(lines, _SIGNS)
    size = words.end - words.begin + 1  # a word with the blank after it
    total = np.concatenate(([0], np.cumsum(size)))[words.first]
    keep = np.ones(int(size.sum()), bool)
    keep[total[1:][words.counts > 0] - 1] = False
    data = words.data[ranges(words.begin, size)]
    data = np.where(data == 0, np.uint8(32), data)[keep]
    ends = np.concatenate(([0], np.cumsum(np.maximum(0, np.diff(total) - (words.counts > 0)))))
    return pa.Array.from_buffers(pa.large_binary(), len(lines), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _grouped(key: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """An order in which equal keys, and equal values of ``spread`` within them, stand together."""
    left = np.uint64(64 - int(key.max()).bit_length())
    if left >= 24:
        # One number to sort by: the key, and as much of the other value as fits.
        both = (key.astype(np.uint64) << left) | (spread & ((np.uint64(1) << left) - np.uint64(1)))
        order = np.argsort(both)
        both, other = both[order], spread[order]
        if not ((both[1:] == both[:-1]) & (other[1:] != other[:-1])).any():
            return order
    return np.lexsort((spread, key))


def _votes(line: np.ndarray, feature: np.ndarray, size: np.ndarray, level: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, signature) of the blocks that hold at least ``least``, from features with their line, size and level. A tie in a bit goes to the smallest feature."""
    if not len(line):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blocks = np.array([b for _, b in LEVELS], np.uint64)[level]
    spread = mix(feature + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    key = (line << 8) | (level << 5) | ((spread >> np.uint64(32)) * blocks >> np.uint64(32)).astype(np.int64)
    order = _grouped(key, spread)
    order = order[np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (spread[order][1:] != spread[order][:-1])))]
    key, size, spread = key[order], size[order], spread[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(first, len(key)))
    values = (spread & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.uint8).reshape(-1, 4)
    on = np.empty((len(first), 32), np.int32)
    for i in range(4):
        on[:, 8 * i : 8 * i + 8] = np.add.reduceat(_EIGHT[values[:, i]], first).view(np.uint8).reshape(-1, 8)
    for k in np.flatnonzero(count > 255):  # more than a counter holds
        on[k] = np.unpackbits(values[first[k] : first[k] + count[k]], axis=1).sum(0, dtype=np.int32)
    on *= 2
    low = np.minimum.reduceat(spread & np.uint64(0xFFFFFFFF), first)
    tie = np.unpackbits(low.astype(np.uint32).view(np.uint8).reshape(-1, 4), axis=1)
    made = np.where(on == count[:, None], tie, on > count[:, None]).astype(np.uint8)
    sim = np.packbits(made, axis=1).view(np.uint32).ravel().astype(np.uint64)
    good = np.add.reduceat(size, first) >= least
    where = (key[first] & 255).astype(np.uint64)
    sig = mix((sim << np.uint64(8) | where) + (np.minimum(count, 1 << 20).astype(np.uint64) << np.uint64(40)))
    return (key[first] >> 8)[good], sig[good]


def edit_lengths(least: float) -> tuple[int, int, int]:
    """The least length of a line that may have a similar one, and the least lengths of the longer line at which two and three edits are allowed."""
    one, two, three = (int(np.ceil(edits / max(1 - least, 1e-6) - 1e-6)) for edits in (1, 2, 3))
    return max(1, one - 1), two, three


def _bytes(words: Words, lines: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The normalised texts of the given lines as rows, filled up with zeros."""
    pick = np.isin(words.owners(), lines)
    size = (words.end - words.begin)[pick] + 1  # a word with the blank after it; a line's last blank is cut below
    data = words.data[ranges(words.begin[pick], size)].astype(np.uint64)
    n = length[lines]
    begin = np.cumsum(n + 1) - (n + 1)
    place = np.arange(int(n.max()))
    return np.where(place < n[:, None], data[np.minimum(begin[:, None] + place, len(data) - 1)], np.uint64(0))


def _text_hash(rows: np.ndarray, tag: int | np.ndarray) -> np.ndarray:
    powers = np.cumprod(np.full(rows.shape[1], 0x9E3779B97F4A7C15, np.uint64))
    return mix((rows * powers).sum(1, dtype=np.uint64) + np.asarray(tag).astype(np.uint64))


def _halves(words: Words, chosen: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, signature) of the chosen lines' halves from either end, of half the length and of one byte less, since the other line may be shorter."""
    lines = np.flatnonzero(chosen)
    if not len(lines):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, n = _bytes(words, lines, length), length[lines]
    place = np.arange(text.shape[1])
    found = []
    for less in (0, 1):
        half = n // 2 - less
        head = np.where(place < half[:, None], text, np.uint64(0))
        tail = np.where(place < half[:, None], text[np.arange(len(lines))[:, None], np.minimum((n - half)[:, None] + place, text.shape[1] - 1)], np.uint64(0))
        found += [(lines, _text_hash(head, (half << 8) + 1)), (lines, _text_hash(tail, (half << 8) + 2))]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _shortened(words: Words, chosen: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, signature) of the chosen lines themselves and of their texts less one byte each."""
    lines = np.flatnonzero(chosen)
    if not len(lines):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text, n = _bytes(words, lines, length), length[lines]
    found = [(lines, _text_hash(text, n))]
    for gone in range(text.shape[1]):
        has = n > gone
        found.append((lines[has], _text_hash(np.delete(text[has], gone, axis=1), n[has] - 1)))
    line, sig = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((sig, line))
    line, sig = line[order], sig[order]
    once = np.concatenate(([True], (line[1:] != line[:-1]) | (sig[1:] != sig[:-1])))
    return line[once], sig[once]


def signatures(words: Words, chosen: np.ndarray, length: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(line, signature), by line, of the chosen lines (a mask): their blocks that sign, and the shortened texts of short lines. ``length`` is that of the normalised lines."""
    shortest, two, three = edit_lengths(least)
    short = _shortened(words, chosen & (length >= shortest) & (length < two), length)
    halves = _halves(words, chosen & (length >= max(4, two - 2)) & (length < three), length)
    # A line may differ from one of ``two`` bytes by two in length.
    chosen = chosen & (length >= two - 2)
    borders = np.array([w for w, _ in LEVELS])
    counts = words.counts
    level = np.searchsorted(borders, counts, "right") - 1
    below = chosen & (level > 0) & (counts < borders[level] * (1 + OVERLAP) + 1)
    hashes, owner = words.hashes(), words.owners()
    size = (words.end - words.begin).astype(np.int64)
    found = [short, halves]
    for lines, at in ((chosen & (level > 0), level), (below & (level > 1), level - 1)):
        pick = lines[owner] & (size >= WORD_BYTES)
        found.append(_votes(owner[pick], hashes[pick], size[pick], at[owner[pick]], BLOCK_BYTES))
    pick = ((chosen & (level == 0)) | (below & (level == 1)))[owner]
    spot = ranges(words.begin[pick], size[pick] + 1)  # the words' bytes, with one blank after each
    line, data = np.repeat(owner[pick], size[pick] + 1), words.data[spot].astype(np.uint64)
    if len(data) > 2:
        code = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
        whole = line[:-2] == line[2:]
        line, code = line[:-2][whole], mix(code[whole] + np.uint64(1))
        found.append(_votes(line, code, np.ones(len(line), np.int64), np.zeros(len(line), np.int64), BLOCK_WINDOWS))
    line, sig = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(line, kind="stable")
    return line[order], sig[order]


def letter_counts(words: Words) -> np.ndarray:
    """For each line, its letters counted by bucket (at most 127), packed."""
    n = len(words.counts)
    size = words.end - words.begin
    buckets = PACKED * PER_PACK
    spot = ranges(words.begin, size)
    cell = np.repeat(words.owners() * buckets, size) + (words.data[spot] & 31) % buckets
    counts = np.minimum(np.bincount(cell, minlength=n * buckets), 127).reshape(n, PACKED, PER_PACK)
    return (counts << (8 * np.arange(PER_PACK))).sum(2)


def _lanes(value: int, width: int, n: int) -> F.Column:
    """``value`` in each of the n lowest lanes of ``width`` bits."""
    return F.lit(sum(value << (width * k) for k in range(n))).cast("long")


def _letters_apart(x: str, y: str) -> F.Column:
    """The sum of the differences of two lines' letter counts, those of a pack at once: 128 + p - q needs no borrow from the next count, and its highest bit tells which of the two is larger.
    Each pack is taken as not null and is written out a few times only: code of more than 8000 bytes would be interpreted, not compiled, by the JVM."""
    top, ones, pairs = _lanes(128, 8, PER_PACK), _lanes(1, 8, PER_PACK), _lanes(255, 16, 4)
    total = F.lit(0).cast("long")
    for c in _LETTERS:
        p, q = (F.coalesce(F.col(f"{z}.{c}"), F.lit(0).cast("long")) for z in (x, y))
        apart = p.bitwiseOR(top) - q
        less = ones - F.shiftright(apart.bitwiseAND(top), 7)  # 1 where p is less than q
        apart = apart.bitwiseAND(_lanes(127, 8, PER_PACK)).bitwiseXOR(less * F.lit(127).cast("long")) + less
        total = total + apart.bitwiseAND(pairs) + F.shiftright(apart, 8).bitwiseAND(pairs)
    # 2^16 leaves 1, so the remainder is the sum of the lanes.
    return total % F.lit(0xFFFF).cast("long")


def _scan(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(doc, text) to one row per line that has a word; the task's first line of each class has the class's signatures."""
    seen = np.zeros(0, np.uint64)
    for piece in pieces(batches, "text"):
        lines = pc.split_pattern(piece.column("text").cast(pa.large_string()), "\n")
        per_doc = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        words = Words(lines.flatten(), _SIGNS)
        has = words.counts > 0
        hashes = words.hashes()
        place = np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))))
        kind = mix(total[words.first[1:]] - total[words.first[:-1]])
        size = np.concatenate(([0], np.cumsum(words.end - words.begin + 1)))
        length = np.maximum(0, size[words.first[1:]] - size[words.first[:-1]] - 1)
        number = np.arange(len(has)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        doc = np.repeat(piece.column("doc").to_numpy(zero_copy_only=False).astype(np.int64), per_doc)
        fresh, once = np.unique(kind, return_index=True)
        fresh = ~np.isin(fresh, seen)
        chosen = np.zeros(len(has), bool)
        chosen[once[fresh]] = True
        chosen &= has & (length >= edit_lengths(least)[0])
        seen = np.concatenate((seen if len(seen) < REMEMBERED else seen[:0], kind[chosen]))
        line, sig = signatures(words, chosen, length, least)
        ends = np.searchsorted(line, np.flatnonzero(has), "right")
        offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
        sigs = pa.ListArray.from_arrays(offsets, pa.array(sig.view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(doc[has]), pa.array(number[has].astype(np.int32)), pa.array(kind[has].view(np.int64)), pa.array(length[has].astype(np.int32)), sigs, *map(pa.array, letter_counts(words)[has].T.copy())], names=["doc", "line", "class", "len", "sigs", *_LETTERS])


def _slide(x: bytes, y: bytes, i: int, j: int) -> int:
    """The first place from ``i`` on where x differs from y, which starts at ``j``."""
    n, step, grow = min(len(x) - i, len(y) - j), 1, True
    at = 0
    while at < n:
        step = min(step, n - at)
        if x[i + at : i + at + step] == y[j + at : j + at + step]:
            at += step
            step = 2 * step if grow else step
        elif step == 1:
            break
        else:
            step, grow = step // 2, False
    return i + at


def few_edits(x: bytes, y: bytes, most: int) -> int | None:
    """The edit distance if it is at most ``most``, else None: the furthest place that each diagonal reaches with 0, 1, 2 ... edits. Equal stretches cost next to nothing, however long."""
    goal = len(y) - len(x)
    far = {0: _slide(x, y, 0, 0)}
    for e in range(most + 1):
        if far.get(goal, -1) >= len(x):
            return e
        left = most - e - 1  # edits after the next one: diagonals further from the goal are of no use
        after = {}
        for k in range(max(-e - 1, goal - left), min(e + 1, goal + left) + 1):
            i = min(max(far.get(k, -2) + 1, far.get(k - 1, -2), far.get(k + 1, -2) + 1), len(x), len(y) - k)
            if i >= 0 and i + k >= 0:
                after[k] = _slide(x, y, i, i + k)
        far = after
    return None


def bounded_edits(x: bytes, y: bytes, most: int) -> int:
    """The edit distance, or ``most`` + 1 if it is larger. A few edits are looked for first; then a column of the distance table, as the bits of two numbers, is one step (Myers 1999, Hyyrö 2003).

    Time grows with the product of the lengths, 64 cells to an operation; memory takes one bit of x for each distinct byte, about five times x for text in ASCII.
    """
    if abs(len(x) - len(y)) > most:
        return most + 1
    m = len(x)
    found = few_edits(x, y, min(most, int(m**0.5 / 4)))
    if found is not None or not m:
        return min(len(y), most + 1) if found is None else found
    data = np.frombuffer(x, np.uint8)
    places = {c: int.from_bytes(np.packbits(data == c, bitorder="little").tobytes(), "little") for c in set(x)}
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, left = full, 0, m, len(y)
    for c in y:
        same = places.get(c, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(across | up)), up & across
        score += 1 if more & last else -1 if less & last else 0
        left -= 1
        if score - left > most:
            return most + 1
        more = more << 1 | 1
        up, down = (less << 1 | ~(vertical | more)) & full, more & vertical & full
    return score


#: Pairs of one table of ``within``, the most bytes of their lines, the columns after which hopeless pairs leave, and the edits that are looked for first.
TOGETHER, LONGEST, LEAVE, FEW = 1024, 4096, 64, 24


def _rows(data: np.ndarray, begin: np.ndarray, size: np.ndarray, fill: int, right: bool = False) -> np.ndarray:
    """Stretches of flat bytes as the rows of a matrix, at its left or right, filled up."""
    width = int(size.max(initial=0))
    made = np.full((len(size), width), fill, np.uint8)
    place = np.arange(width) >= (width - size)[:, None] if right else np.arange(width) < size[:, None]
    made[place] = data[ranges(begin, size)]
    return made


def _same(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each row, the columns before the first one that differs."""
    width = min(x.shape[1], y.shape[1])
    apart = x[:, :width] != y[:, :width]
    return np.where(apart.any(1), apart.argmax(1), width) if width else np.zeros(len(x), np.int64)


def _ends(x: tuple, y: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that two lines of each pair have in common at their beginnings, and then at their ends. A line is (data, begin, size)."""
    head = np.minimum(_same(_rows(*x, 0), _rows(*y, 1)), np.minimum(x[2], y[2]))
    backwards = (_rows(*z, fill, right=True)[:, ::-1] for z, fill in ((x, 0), (y, 1)))
    tail = np.minimum(_same(*backwards), np.minimum(x[2], y[2]) - head)
    return head, tail


def _table(x: tuple, y: tuple, most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of each pair is at most ``most``: the distance table of all pairs at once, 64 rows of a column to a number (Myers 1999, Hyyrö 2003).

    Only the numbers that the widest pair's diagonals 0 to ``most`` reach are computed; those outside count as one more for each step, never as less than they are,
    and a path of ``most`` edits doesn't go there. Every ``LEAVE`` columns the pairs leave that can't come down to ``most`` any more. Pairs are sorted by the size of y, largest first.
    """
    one, ones, top = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(63)
    left, right = _rows(*x, 0), _rows(*y, 0)
    m, n, most = x[2].astype(np.int64), y[2].astype(np.int64), most.astype(np.int64)
    code = np.zeros(256, np.int64)
    used = np.flatnonzero(np.bincount(left.ravel(), minlength=256) + np.bincount(right.ravel(), minlength=256))
    code[used] = np.arange(len(used))
    deep = max(1, -(-left.shape[1] // 64))
    places = np.zeros((deep, len(m), len(used)), np.uint64)
    inside = np.arange(left.shape[1]) < m[:, None]
    for k, c in enumerate(used):
        bits = np.zeros((len(m), deep * 8), np.uint8)
        packed = np.packbits((left == c) & inside, axis=1, bitorder="little")
        bits[:, : packed.shape[1]] = packed
        places[:, :, k] = bits.view(np.uint64).T
    right = code[right].T.copy()
    good, who, base = np.zeros(len(m), bool), np.arange(len(m)), np.arange(len(m)) * len(used)
    up, down = np.full((deep, len(m)), ones), np.zeros((deep, len(m)), np.uint64)
    reach = int(most.max())
    last = min(deep - 1, reach // 64)
    score = np.full(len(m), 64 * (last + 1), np.int64)
    for j in range(right.shape[0]):
        live = int(np.searchsorted(-n, -j, "left"))  # pairs with a column j
        if not live:
            break
        if j and j % LEAVE == 0:
            # The table's column: the last number's lowest row is known, the others by the steps between.
            first = max(0, (j - 1 - reach) // 64)
            steps = [(np.unpackbits(v[first : last + 1, :live].T.copy().view(np.uint8), axis=1, bitorder="little")).astype(np.int16) for v in (up, down)]
            steps = steps[0] - steps[1]
            value = score[:live, None] - (steps.sum(1, dtype=np.int64)[:, None] - np.cumsum(steps, axis=1, dtype=np.int16))
            row = 64 * first + 1 + np.arange(value.shape[1])
            least = value + np.abs((m[:live, None] - row) - (n[:live, None] - j))
            least[row > m[:live, None]] = 1 << 30
            stay = least.min(1) <= most[:live]
            if first == 0:
                stay |= j + np.abs(m[:live] - (n[:live] - j)) <= most[:live]  # row 0
            if stay.sum() <= 0.8 * live:
                keep = np.flatnonzero(stay)
                m, n, most, who, score, up, down = m[keep], n[keep], most[keep], who[keep], score[keep], up[:, keep], down[:, keep]
                places, right, live = places[:, keep], right[:, keep], len(keep)
                if not live:
                    break
                reach = int(most.max())
        first, end = max(0, (j - reach) // 64), min(deep - 1, (j + reach) // 64)
        while last < end:
            last += 1
            score += 64
        at = base[:live] + right[j, :live]
        more, less = np.ones(live, np.uint64), np.zeros(live, np.uint64)  # the step along the row above
        for w in range(first, last + 1):
            u, d = up[w, :live], down[w, :live]
            same = places[w].ravel().take(at)
            vertical = same | d
            same |= less
            across = (((same & u) + u) ^ u) | same
            plus, minus = d | ~(across | u), u & across
            out = plus >> top, minus >> top
            plus, minus = plus << one | more, minus << one | less
            up[w, :live], down[w, :live] = minus | ~(vertical | plus), plus & vertical
            more, less = out
        score[:live] += more.astype(np.int64) - less.astype(np.int64)
        done = np.flatnonzero(n[:live] == j + 1)
        if len(done):
            beyond = np.minimum(64, np.maximum(0, 64 * (np.arange(deep)[:, None] + 1) - m[done]))  # rows below the last one of x
            mask = np.where(beyond == 0, np.uint64(0), ones << np.minimum(63, 64 - beyond).astype(np.uint64))
            mask[last + 1 :] = 0
            steps = np.bitwise_count(up[:, done] & mask).astype(np.int64) - np.bitwise_count(down[:, done] & mask)
            good[who[done]] = score[done] - steps.sum(0) <= most[done]
    return good


def within(x: tuple, y: tuple, most: np.ndarray) -> np.ndarray:
    """Whether the edit distance of x and y, flat bytes as (data, begin, size), is at most ``most`` for each pair. A common head and tail doesn't change the distance.

    Lines of up to ``LONGEST`` bytes are compared many pairs at a time, longer ones and few pairs one by one.
    """
    good, short = np.zeros(len(most), bool), np.zeros(len(most), bool)
    x, y = ((z[0], np.array(z[1]), np.array(z[2])) for z in (x, y))
    larger = np.maximum(x[2], y[2])
    near = np.abs(x[2] - y[2]) <= most
    order = np.flatnonzero(near & (larger <= LONGEST))
    if len(order) >= 32:
        order = order[np.argsort(larger[order], kind="stable")]
        for some in np.array_split(order, -(-len(order) // TOGETHER)):
            head, tail = _ends(*((z[0], z[1][some], z[2][some]) for z in (x, y)))
            for z in (x, y):
                z[1][some] += head
                z[2][some] -= head + tail
        short[order] = True
    for k in np.flatnonzero(near & ~short):
        p, q = (z[0][z[1][k] : z[1][k] + z[2][k]].tobytes() for z in (x, y))
        head = _slide(p, q, 0, 0)
        p, q = p[head:], q[head:]
        tail = _slide(p[::-1], q[::-1], 0, 0)
        p, q = p[: len(p) - tail], q[: len(q) - tail]
        good[k] = max(len(p), len(q)) <= most[k] or bounded_edits(p, q, int(most[k])) <= most[k]
    good |= short & (np.maximum(x[2], y[2]) <= most)
    for limit in (np.minimum(most, FEW), most):
        # Few edits need few diagonals.
        order = np.flatnonzero(short & ~good & (np.abs(x[2] - y[2]) <= limit) & ((most > FEW) | (limit is not most)))
        order = order[np.argsort(-y[2][order], kind="stable")]
        for some in np.array_split(order, -(-len(order) // TOGETHER)) if len(order) else ():
            good[some] = _table(*((z[0], z[1][some], z[2][some]) for z in (x, y)), limit[some])
    return good


def _tester(least: float):
    """(a, b, x, y) to the pairs (a, b) whose lines x and y, as bytes, are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("x", "y"):
                data, starts = flat_bytes(batch.column(name))
                sides.append((data, starts[:-1], np.diff(starts)))
            most = np.floor((1 - least) * np.maximum(sides[0][2], sides[1][2]) + 1e-9).astype(np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(within(*sides, most), pa.bool_()))

    return run


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")


def _linked(source: DataFrame, lines: DataFrame, least: float) -> DataFrame:
    """Settled (node, root) of the classes that have a link; root is the smallest class that links reach."""
    spread = lines.where("size(sigs) > 0").select("class", F.explode("sigs").alias("sig"))
    # A lone class of a signature, the usual case, must not cross the network a second time: one shuffle finds the company of each.
    group = Window.partitionBy("sig")
    several = spread.select("sig", "class", F.count("*").over(group).cast("int").alias("c"), F.min("class").over(group).alias("leader"), F.max("class").over(group).alias("__last")).where("leader < __last")
    posts = settle(several.drop("__last").distinct().withColumn("up", F.lit(True)))
    mine = only_ids(lines.where("size(sigs) > 0").select("class", "len", *_LETTERS), "class", posts.select("class").distinct())
    known = settle(mine.groupBy("class").agg(*[F.first(c).alias(c) for c in ("len", *_LETTERS)]))

    def near(x: str, y: str) -> F.Column:
        long, short = F.greatest(f"{x}.len", f"{y}.len"), F.least(f"{x}.len", f"{y}.len")
        return (long - short <= (1 - least) * long + 1e-9) & (_letters_apart(x, y) <= 2 * (1 - least) * long + 1e-9)

    held: list[DataFrame] = []

    def tests(needed: DataFrame):
        places = lines.where("size(sigs) > 0").select("class", "doc", "line").join(needed, "class").groupBy("class").agg(F.min(F.struct("doc", "line")).alias("at"))
        wanted = places.select(F.col("at.doc").alias("doc"), F.struct(F.col("at.line").alias("line"), "class").alias("w"))
        wanted = settle(wanted.groupBy("doc").agg(F.collect_list("w").alias("w")))  # lines of one document

        def pick(batches):
            for batch in batches:
                kinds, texts = [], []
                for text, rows in zip(batch.column("text").to_pylist(), batch.column("w").to_pylist(), strict=True):
                    parts = text.split("\n")
                    for r in rows:
                        if r["line"] < len(parts):
                            kinds.append(r["class"])
                            texts.append(parts[r["line"]])
                yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int64()), normalised_bytes(pa.array(texts, pa.large_string()))], names=["class", "norm"])

        texts = settle(only_ids(source, "doc", wanted).join(wanted, "doc").mapInArrow(pick, "class long, norm binary").groupBy("class").agg(F.first("norm").alias("norm")))
        held.extend((wanted, texts))

        def similar(candidates: DataFrame) -> DataFrame:
            both = join_hot(candidates, texts.select(F.col("class").alias("a"), F.col("norm").alias("x")), "a").join(texts.select(F.col("class").alias("b"), F.col("norm").alias("y")), "b")
            return both.select("a", "b", "x", "y").mapInArrow(_tester(least), "a long, b long")

        return similar

    links = settle(star_links(posts, known, ["len", *_LETTERS], near, tests))
    roots = connected(links)
    release(posts, known, links, *held)
    return roots


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """(doc, line, class, root): every line with a word, and the smallest class that links reach from its own."""
    source = _source(docs, id_col, text_col)
    lines = settle(source.mapInArrow(lambda batches: _scan(batches, least), _LINES))
    rooted = lines.select("class").distinct().join(_linked(source, lines, least).withColumnRenamed("node", "class"), "class")
    return join_hot(lines.select("doc", "line", "class"), rooted, "class", "left").select("doc", "line", "class", F.coalesce("root", "class").alias("root"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """(doc, dropped): for each document that loses lines, their numbers (from 0) in order.

    Of each connected group the occurrence with the smallest (id, line number) is kept, wherever else it occurs. Lines without a word (blank, only
    signs) are never dropped; null texts have no lines; null ids are left out. Rows with equal ids share their line numbers. Lines and texts may have any length. Empty tables
    give an empty result. Other columns aren't read, whatever their names. Ids must be numbers.
    """
    source = _source(docs, id_col, text_col)
    lines = settle(source.mapInArrow(lambda batches: _scan(batches, least), _LINES))
    linked = _linked(source, lines, least)
    # A class is one row from here on, however many lines it has.
    firsts = lines.groupBy("class").agg(F.min(F.struct("doc", "line")).alias("at"), F.count("*").alias("n"))
    kinds = settle(firsts.join(linked.withColumnRenamed("node", "class"), "class", "left").where("n > 1 OR root IS NOT NULL"))
    lead = kinds.where("root IS NOT NULL").groupBy("root").agg(F.min("at").alias("first"))
    kept = settle(join_hot(kinds.where("root IS NOT NULL").select("class", "root"), lead, "root").select("class", "first").unionByName(kinds.where("root IS NULL").select("class", F.col("at").alias("first"))))
    release(kinds)
    gone = join_hot(lines.select("doc", "line", "class"), kept, "class").where(F.struct("doc", "line") != F.col("first"))
    gone = settle(gone.groupBy("doc").agg(F.array_sort(F.collect_set("line")).alias("dropped")))  # lines of one document
    release(lines, linked, kept)
    return gone


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts; all rows and columns stay, a text may become empty. A column ``__doc`` or ``__dropped`` would clash."""
    gone = dropped_lines(docs, id_col, text_col, least).withColumnRenamed("doc", "__doc").withColumnRenamed("dropped", "__dropped")
    kept = F.array_join(F.filter(F.split(text_col, "\n"), lambda _, i: ~F.array_contains("__dropped", i)), "\n")
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__doc"), "left").withColumn(text_col, F.when(F.col("__dropped").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    gone = dropped_lines(docs).withColumnRenamed("doc", "doc_id")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    counted = docs.select("doc_id", n.cast("long").alias("n_lines"))
    return counted.join(gone, "doc_id", "left").select("doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.array_join(F.coalesce("dropped", F.array().cast("array<int>")), ",").alias("dropped"))
