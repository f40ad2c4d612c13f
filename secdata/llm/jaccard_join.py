"""N-gram Jaccard self-join with PartEnum signatures.

Steps (``link_classes``), none of which gathers a group or emits all pairs of one:

1. One pass over the texts hashes the shingles of every document, names its class (documents with the same set), and makes
   the PartEnum signatures of the set. Signatures travel as packed arrays, one per piece of input and range of
   signatures, with four bytes for a signature; a truncated signature can only add candidates. A signature that many
   documents of one task share leaves the packed arrays: its further documents go, dealt by their own hash, straight to the output.
2. Each range keeps the signatures that two different classes share. These rows (signature, class) are few.
3. Every signature names a leader, its smallest upper class; the leader is compared with the other classes of the signature.
4. Components of the links found so far are formed. Only pairs of one signature that lie in *different* components can still matter.
   Some rounds test a few of them a class and form the components again; then all that still matter are tested (all classes
   against those outside the signature's largest component), so no link is lost.

Before sets are compared exactly, a parity sketch refutes most pairs without loss: the sketches of two sets differ in
no more bits than the sets differ in features. Texts are read again only for classes
that have an unrefuted partner; a second sketch, as wide as the set is large, and only then the sets themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secdata.llm.partenum import Bands, set_hash, shingles, signatures
from secdata.llm.shared import connected, join_hot, only_ids, reducers, release, settle, star_links
from secdata.llm.text import SPACED_BYTES, Words, mix, pieces, ranges

SKETCH_WORDS = 16
_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
_PACKED = "part int, what int, ids binary, data binary, marks binary"
_FOUND = "sig long, class long, up boolean, leader long, c int, doc long, n int, sketch binary"
_NAMES = [x.split()[0] for x in _FOUND.split(", ")]
#: Documents of one task that share a signature, before further ones leave the packed arrays.
_MANY = 8


def _sketches(owner: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
    bits = SKETCH_WORDS * 64
    odd = np.bincount(owner * bits + (features & np.uint64(bits - 1)).astype(np.int64), minlength=n * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1)


def _packer(n: int, num: int, den: int, parts: int):
    """Documents to packed rows: kind 0 has signatures of a range, 1 has signatures of many, 2 has the documents themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den, 1 << 16)
        heavy = np.zeros(0, np.uint64)
        turn = 0
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"), SPACED_BYTES)
            owner, features = shingles(words, n)
            size = piece.num_rows
            counts = np.bincount(owner, minlength=size)
            if size and counts.max() > bands.hi[-2]:
                bands = Bands(num, den, int(counts.max()))
            kinds = set_hash(owner, features, size)
            rows: list[tuple] = []
            ids = piece.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            sketches = _sketches(owner, features, size)
            turn += 1
            rows.append(((hash((int(kinds[0]), turn)) if size else 0) % parts, 2, np.column_stack((ids.view(np.uint64), kinds, counts.astype(np.uint64))).tobytes(), sketches.tobytes(), b""))
            _, only = np.unique(kinds, return_index=True)  # one document of each class signs
            keep = np.zeros(size, bool)
            keep[only] = True
            keep &= counts > 0
            at = keep[owner]
            renumbered = np.cumsum(keep) - 1
            sig, who, up = signatures(renumbered[owner[at]], features[at], int(keep.sum()), bands)
            classes = kinds[keep]
            order = np.lexsort((who, sig))
            sig, who, up = sig[order], who[order], up[order]
            first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1]))) if len(sig) else np.zeros(0, np.int64)
            many = np.diff(np.append(first, len(sig))) > _MANY
            known = heavy
            if many.any():
                heavy = np.union1d(heavy, sig[first[many]])
            out = np.isin(sig, heavy) if len(heavy) else np.zeros(len(sig), bool)
            marks = up.astype(np.uint8)
            if out.any():
                s, c = sig[out], classes[who[out]]
                spread = ((s ^ c) >> np.uint64(32)) % np.uint64(parts)
                for p in np.unique(spread):
                    x = spread == p
                    rows.append((int(p), 1, c[x].tobytes(), s[x].tobytes(), marks[out][x].tobytes()))
                # The first document of a signature that has just become one of many stays in the packed arrays, marked.
                fresh = out & ~np.isin(sig, known)
                fresh &= np.concatenate(([True], sig[1:] != sig[:-1]))
                marks[fresh] |= 2
                stay = ~out | fresh
                sig, who, marks = sig[stay], who[stay], marks[stay]
            part = (sig >> np.uint64(32)) % np.uint64(parts)
            order = np.lexsort((who, part))
            sig, who, marks, part = sig[order], who[order], marks[order], part[order]
            ends = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)):
                a, b = ends[p], ends[p + 1]
                used, many_of = np.unique(who[a:b], return_counts=True)  # a set has fewer than 65536 signatures in a range, or repeats itself
                if many_of.max() > 65535:
                    used, many_of = np.repeat(used, -(-many_of // 65535)), np.concatenate([np.diff(np.append(np.arange(0, m, 65535), m)) for m in many_of])
                bits = np.packbits(marks[a:b] & 1).tobytes() + (np.packbits(marks[a:b] >> 1).tobytes() if (marks[a:b] & 2).any() else b"")
                rows.append((int(p), 0, classes[used].tobytes() + many_of.astype(np.uint16).tobytes(), sig[a:b].astype(np.uint32).tobytes(), bits))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "what", "ids", "data", "marks"])

    return run


def _finder(parts: int):
    """Packed rows to the rows of documents, and to posts: (sig, class, up, leader, c) for signatures that c > 1 classes have.

    Of a signature with two classes only the pair (class, leader) is returned, without sig; of signatures with the same classes only one. leader and c are
    null for signatures of many, whose classes come from several tasks.
    """

    def posted(sig, kind, up, leader, c):
        n = len(kind)
        made = [pa.nulls(n, pa.int64()) if sig is None else pa.array(sig.astype(np.int64)), pa.array(kind.view(np.int64)), pa.array(up), pa.nulls(n, pa.int64()) if leader is None else pa.array(leader.view(np.int64)), pa.nulls(n, pa.int32()) if c is None else pa.array(c.astype(np.int32))]
        return pa.RecordBatch.from_arrays([*made, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, classes, marks = [], [], []
        for batch in batches:
            for part, what, ids, data, more in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if what == 2:
                    table = np.frombuffer(ids, np.uint64).reshape(-1, 3)
                    n = len(table)
                    sketch = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * SKETCH_WORDS * 8).astype(np.int32)), pa.py_buffer(data)])
                    made = [pa.nulls(n, pa.int64()), pa.array(table[:, 1].copy().view(np.int64)), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
                    yield pa.RecordBatch.from_arrays([*made, pa.array(table[:, 0].copy().view(np.int64)), pa.array(table[:, 2].astype(np.int32)), sketch], names=_NAMES)
                elif what == 1:
                    sig, kind = np.frombuffer(data, np.uint64), np.frombuffer(ids, np.uint64)
                    yield posted((((sig >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (sig & np.uint64(0xFFFFFFFF)), kind, np.frombuffer(more, np.uint8) & 1 == 1, None, None)
                else:
                    sig = np.frombuffer(data, np.uint32)
                    used = len(ids) // 10
                    counts = np.frombuffer(ids[8 * used :], np.uint16)
                    bits = np.frombuffer(more, np.uint8)
                    width = -(-len(sig) // 8)
                    mark = np.unpackbits(bits[:width], count=len(sig))
                    if len(bits) > width:
                        mark |= np.unpackbits(bits[width:], count=len(sig)) << 1
                    sigs.append((np.uint64(part) << np.uint64(32)) | sig.astype(np.uint64))
                    classes.append(np.repeat(np.frombuffer(ids[: 8 * used], np.uint64), counts))
                    marks.append(mark)
        if not sigs:
            return
        sig, kind, mark = np.concatenate(sigs), np.concatenate(classes), np.concatenate(marks)
        del sigs, classes, marks
        order = np.lexsort((kind, sig))
        sig, kind, mark = sig[order], kind[order], mark[order]
        at = np.flatnonzero(np.concatenate(([True], (sig[1:] != sig[:-1]) | (kind[1:] != kind[:-1]))))
        sig, kind, mark = sig[at], kind[at], np.bitwise_or.reduceat(mark, at)
        at = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        count = np.diff(np.append(at, len(sig)))
        seen = np.bitwise_or.reduceat(mark, at)
        far = np.uint64(0xFFFFFFFFFFFFFFFF)
        shifted = kind ^ np.uint64(1 << 63)  # the order of signed numbers
        leader = np.minimum.reduceat(np.where(mark & 1 > 0, shifted, far), at) ^ np.uint64(1 << 63)
        same = mix(np.add.reduceat(mix(kind + (mark & 1)), at))
        several = (seen & 2 == 0) & (seen & 1 > 0) & (count > 1)
        _, once = np.unique(same[several], return_index=True)
        chosen = np.zeros(len(at), bool)
        chosen[np.flatnonzero(several)[once]] = True

        def rows(groups):
            return ranges(at[groups], count[groups])

        two = chosen & (count == 2)
        r, lead = rows(two), np.repeat(leader[two], 2)
        r, lead = r[kind[r] != lead], lead[kind[r] != lead]
        yield posted(None, kind[r], mark[r] & 1 == 1, lead, np.full(len(r), 2))
        for groups in np.array_split(np.flatnonzero(chosen & (count > 2)), max(1, int(count[chosen].sum()) // 100_000)):
            r = rows(groups)
            yield posted(sig[r], kind[r], mark[r] & 1 == 1, np.repeat(leader[groups], count[groups]), np.repeat(count[groups], count[groups]))
        r = rows(seen & 2 > 0)
        yield posted(sig[r], kind[r], mark[r] & 1 == 1, None, None)

    return run


def _wide_sketch(features: np.ndarray) -> bytes:
    """A parity sketch of at least 1.5 bits a feature; two of different sizes are compared by folding the larger."""
    bits = 1 << max(9, int(len(features) * 3 // 2).bit_length())
    return np.packbits((np.bincount((features & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(x.reshape(-1, size), 0)


def _sketcher(n: int):
    """(class, text) to (class, text, n, wide sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            owner, features = shingles(Words(piece.column("text"), SPACED_BYTES), n)
            sizes = np.bincount(owner, minlength=piece.num_rows)
            sketches = [_wide_sketch(f) for f in np.split(features, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([piece.column("class"), piece.column("text"), pa.array(sizes), pa.array(sketches, pa.binary())], names=["class", "text", "n", "wide"])

    return run


def _refuter(num: int, den: int):
    """(a, b, x, y) with n and the wide sketches of a and b, to the pairs that those don't refute."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for n, m, x, y in zip(batch.column("xn").to_pylist(), batch.column("yn").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                size = min(len(p), len(q))
                apart = int(np.bitwise_count(_folded(p, size) ^ _folded(q, size)).sum())
                good.append(apart * (den + num) <= (n + m) * (den - num))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _setter(n: int):
    """(class, text) to (class, the sorted shingle hashes as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            owner, features = shingles(Words(piece.column("text"), SPACED_BYTES), n)
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=piece.num_rows)))) * 8
            made = pa.Array.from_buffers(pa.large_binary(), piece.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(features)])
            yield pa.RecordBatch.from_arrays([piece.column("class"), made.cast(pa.binary())], names=["class", "features"])

    return run


def _tester(num: int, den: int):
    """(a, b, x, y) with the sets of a and b as bytes, to the pairs that are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((p, q))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(den * common >= num * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _near(x: str, y: str, num: int, den: int) -> F.Column:
    """False only where sizes or sketches prove that two classes aren't similar."""
    apart = sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _SKETCH), F.lit(0))
    return (apart * (den + num) <= (F.col(f"{x}.n") + F.col(f"{y}.n")) * (den - num)) & (F.col(f"{x}.n") * num <= F.col(f"{y}.n") * den) & (F.col(f"{y}.n") * num <= F.col(f"{x}.n") * den)


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 3, den: int = 4) -> tuple[DataFrame, DataFrame]:
    """Returns (members, links): members has (doc, class, n), one row per row of ``docs``; links has pairs (a, b) of
    classes that connect exactly what the full join connects. Class 0 holds documents without words.
    """
    spark = docs.sparkSession
    ranges_ = reducers(spark)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id IS NOT NULL")
    packed = source.mapInArrow(_packer(words, num, den, ranges_), _PACKED).repartitionById(ranges_, F.col("part"))
    found = settle(packed.mapInArrow(_finder(ranges_), _FOUND))
    members = found.where("doc IS NOT NULL").select("doc", "class", "n")
    posts = found.where("doc IS NULL").select("sig", "class", "up", "leader", "c")
    many = posts.where("leader IS NULL").groupBy("sig", "class").agg(F.max("up").alias("up"))
    heads = many.groupBy("sig").agg(F.min(F.when(F.col("up"), F.col("class"))).alias("leader"), F.count("*").cast("int").alias("c"))
    posts = settle(posts.where("leader IS NOT NULL").unionByName(many.join(heads, "sig").where("leader IS NOT NULL")))

    as_long = [F.conv(F.hex(F.substring("sketch", 8 * i + 1, 8)), 16, -10).cast("long").alias(s) for i, s in enumerate(_SKETCH)]
    documents = found.where("doc IS NOT NULL AND n > 0").groupBy("class").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    known = documents.join(posts.select("class").unionByName(posts.select(F.col("leader").alias("class"))).distinct(), "class", "left_semi").select("class", "doc", "n", *as_long)
    known = settle(known)
    held: list[DataFrame] = []

    def near(x: str, y: str) -> F.Column:
        return _near(x, y, num, den)

    def tests(needed: DataFrame):
        wanted = settle(documents.join(needed, "class").select("class", F.col("doc").alias("id")))
        # Two Python steps in one stage would keep two workers a core; what stands between them is settled.
        chosen = settle(wanted.join(only_ids(source, "id", wanted), "id").select("class", "text"))
        texts = settle(chosen.mapInArrow(_sketcher(words), "class long, text string, n long, wide binary"))
        release(chosen)
        held.extend((wanted, texts))

        def both(pairs: DataFrame, table: DataFrame, of: dict[str, str]) -> DataFrame:
            x, y = (table.select(F.col("class").alias(side), *[F.col(c).alias(other + suffix) for c, suffix in of.items()]) for side, other in (("a", "x"), ("b", "y")))
            return join_hot(pairs, x, "a").join(y, "b")

        def similar(pairs: DataFrame) -> DataFrame:
            left = both(pairs, texts, {"wide": "", "n": "n"}).select("a", "b", "x", "y", "xn", "yn").mapInArrow(_refuter(num, den), "a long, b long")
            left = settle(left)
            used = left.select(F.explode(F.array("a", "b")).alias("class")).distinct()
            sets = settle(texts.select("class", "text").join(used, "class").mapInArrow(_setter(words), "class long, features binary"))
            good = settle(both(left, sets, {"features": ""}).select("a", "b", "x", "y").mapInArrow(_tester(num, den), "a long, b long"))
            release(left, sets)
            return good

        return similar

    links = settle(star_links(posts, known, ["n", *_SKETCH], near, tests))
    release(posts, known, *held)
    return members, links


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One row (doc, n, component) per row of ``docs`` with an id: the set size and the smallest id that links reach.

    Null and empty texts have n = 0 and are components of their own. Equal ids with different texts are linked through the id only in
    that they share a label. Ties need no rule: every result is a minimum.
    """
    members, links = link_classes(docs, id_col, text_col, words, num, den)
    least = members.where("n > 0").groupBy("class").agg(F.min("doc").alias("low"))
    rooted = least.join(connected(links).withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    lowest = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component")), "root").select("class", "component")
    return members.join(lowest, "class", "left").select("doc", F.col("n").cast("long").alias("n"), F.coalesce("component", "doc").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """``docs`` without the documents that are not the smallest of their component; all columns stay. Rows without id stay; repeated rows with one id all stay or go together."""
    gone = components(docs, id_col, text_col, words, num, den).where("doc <> component").select(F.col("doc").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")
