"""Line-level labels: alignment of two versions of a function, gates, dependences, fusion with external labels, renumbering.

The long table has one row per union line of a sample: (key, union_line, before_text, after_text, in_before, in_after, is_added, is_removed, is_sig).
Only ``align`` runs in Python, once per sample; all that follows are joins, windows and aggregations by (key, union_line). Where the lines' texts aren't asked for, the alignment is one
row a sample (COMPACT), which meets the sample's graph in one join; no line is a row then, and no text crosses the network.
"""

from __future__ import annotations

import difflib
import itertools
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secdata.functions.normalize import BLANK, joern_key, strip
from secdata.operators.joins import join_hot

# Parser name of a language, comment signs, gates.
LANGUAGES = {"c": "c", "c++": "cpp", "cpp": "cpp", "c/c++": "c", "java": "java", "javascript": "javascript", "typescript": "typescript", "python": "python", "php": "php", "ruby": "ruby", "go": "go", "c#": "csharp", "csharp": "csharp", "rust": "rust", "scala": "scala", "kotlin": "kotlin", "perl": "perl", "objective-c": "objc", "objective-c++": "objc", "objectivec": "objc", "objc": "objc", "swift": "swift", "lua": "lua"}
SLASH = {"c", "cpp", "objc", "java", "javascript", "typescript", "csharp", "go", "rust", "scala", "kotlin", "swift", "php"}
HASH = {"python", "ruby", "perl"}
MAX_LINES, MAX_RATIO, MIN_CHANGED, MIN_COVERAGE = 8000, 0.70, 0, 0.20
# Statuses whose lines can be used, and that of a sample that wasn't labelled because external lines exist.
USABLE = ["joern_ok", "joern_add_only", "joern_delete_only", "ok_delete_only", "no_pdg_signal"]
REMOVED_ONLY = ["no_pdg_signal"]
SKIPPED = "skipped_has_bigvul"

#: Characters of code per table that the alignment hands back.
PIECE_CHARS = 4_000_000

_STRING = r"""'(?:\\.|[^\\'\n])*'|"(?:\\.|[^\\"\n])*\""""
_SLASH_COMMENT = re.compile(_STRING + r"|//[^\n]*|/\*.*?\*/", re.S)
_HASH_COMMENT = re.compile(_STRING + r"|#[^\n]*", re.S)

LONG = "key string, union_line int, before_text string, after_text string, in_before boolean, in_after boolean, is_added boolean, is_removed boolean, is_sig boolean"
#: The alignment as one row a sample, without texts (``align`` with compact): line ends in both versions, whether code is missing, the number of union lines, the union lines that were removed, that were
#: added, and that stand in the before version without text; for each union line its number in the before version (0: added), the added lines' numbers in the after version, and the before version's signature.
COMPACT = "n_breaks long, no_code boolean, n_lines int, removed array<int>, added array<int>, blank array<int>, before_line array<int>, added_fa array<int>, own_sig array<int>"


def resolve(language: Column) -> Column:
    """The parser name of a language, null if unsupported."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv]), F.lower(strip(language)))


def strip_comments(code: str, lang: str) -> str:
    """The code without comments; strings stay, and so does every line break."""
    def blank(m: re.Match) -> str:
        return m[0] if m[0][0] in "'\"" else "\n" * m[0].count("\n")

    for pattern, langs in ((_SLASH_COMMENT, SLASH), (_HASH_COMMENT, HASH | {"php"})):
        if lang in langs:
            code = pattern.sub(blank, code)
    return code


def signature_lines(lines: list[str]) -> set[int]:
    """Numbers (from 1) of the lines that declare the function: the first with text, on while parentheses are open (seven more at most), and a brace alone after it."""
    filled = [i for i, t in enumerate(lines, 1) if t.strip()]
    if not filled:
        return set()
    last, depth = filled[0], 0
    for last in range(filled[0], min(len(lines), filled[0] + 7) + 1):
        depth += lines[last - 1].count("(") - lines[last - 1].count(")")
        if depth <= 0:
            break
    following = next((i for i in filled if i > last), None)
    brace = {following} if following and lines[following - 1].strip() == "{" else set()
    return set(range(filled[0], last + 1)) | brace


def opcodes(a: list[str], b: list[str]) -> Iterator[tuple[str, int, int, int, int]]:
    """The standard matcher's opcodes, without its work on the common lines at either end, if each of these occurs once in either version.

    Such a line can only be matched with its one partner, and the common lines up to the first difference form a block that no other block holds a line of. The matcher takes that
    block sooner or later, and finds in the rest what it finds without it. If a single line of the block occurs again, other blocks compete with it, and nothing is cut.
    """
    once = {t for t, n in Counter(a).items() if n == 1} & {t for t, n in Counter(b).items() if n == 1}

    def common(x: Iterable[str], y: Iterable[str]) -> int:
        same = list(itertools.takewhile(lambda p: p[0] == p[1], zip(x, y)))  # noqa: B905  up to the end of the shorter one
        return len(same) if all(t in once for t, _ in same) else 0

    head = common(a, b)
    tail = common(reversed(a[head:]), reversed(b[head:]))
    if head:
        yield "equal", 0, head, 0, head
    for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a[head : len(a) - tail], b[head : len(b) - tail], autojunk=False).get_opcodes():
        yield tag, i1 + head, i2 + head, j1 + head, j2 + head
    if tail:
        yield "equal", len(a) - tail, len(a), len(b) - tail, len(b)


def align_pair(before: str | None, after: str | None, lang: str | None, drop_comments: bool) -> list[tuple]:
    """The union lines of two versions, as in LONG without the key. A line of one version stands in the other's view behind a comment sign."""
    mark = "#" if lang in HASH else "//"
    a, b = ([] if x is None else (strip_comments(x, lang) if drop_comments else x).splitlines() for x in (before, after))
    rows: list[tuple] = []
    for tag, i1, i2, j1, j2 in opcodes(a, b):
        if tag == "equal":
            rows += [(t, t, True, True, False, False) for t in a[i1:i2]]
        else:
            rows += [(t, f"{mark} {t}", True, False, False, True) for t in a[i1:i2]]
            rows += [(f"{mark} {t}", t, False, True, True, False) for t in b[j1:j2]]
    sig = signature_lines([r[0] for r in rows])
    return [(i, *r, i in sig) for i, r in enumerate(rows, 1)]


def compact_pair(before: str | None, after: str | None, lang: str | None, drop_comments: bool, max_lines: int | None) -> tuple:
    """The values of COMPACT for two versions; without lines if they have more line ends than ``max_lines``."""
    no_code = before is None or after is None or not before.strip(BLANK)
    before, after = before or "", after or ""
    breaks = before.count("\n") + after.count("\n")
    if max_lines is not None and breaks > max_lines:
        return breaks, no_code, 0, [], [], [], [], [], sorted(signature_lines(before.splitlines()))
    a, b = ((strip_comments(x, lang) if drop_comments else x).splitlines() for x in (before, after))
    removed, added, numbers, added_fa = [], [], [], []
    for tag, i1, i2, j1, j2 in opcodes(a, b):
        if tag != "equal":
            removed += range(len(numbers) + 1, len(numbers) + 1 + i2 - i1)
        numbers += range(i1 + 1, i2 + 1)
        if tag != "equal":
            added += range(len(numbers) + 1, len(numbers) + 1 + j2 - j1)
            added_fa += range(j1 + 1, j2 + 1)
            numbers += [0] * (j2 - j1)
    blank = [u for u, k in enumerate(numbers, 1) if k and not a[k - 1].strip(BLANK)]
    return breaks, no_code, len(numbers), removed, added, blank, numbers, added_fa, sorted(signature_lines(before.splitlines()))


def _compact(pairs: DataFrame, drop_comments: bool, max_lines: int | None) -> DataFrame:
    made = T.StructType.fromDDL(COMPACT)
    rest = [c for c in pairs.columns if c not in ("before", "after")]
    kinds = [pa.int64(), pa.bool_(), pa.int32(), *[pa.list_(pa.int32())] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, texts = batch.select(rest), [batch.column(c) for c in ("before", "after", "lang")]
            first, held, out = 0, 0, []
            for at in range(batch.num_rows):
                before, after, lang = (t[at].as_py() for t in texts)
                out.append(compact_pair(before, after, lang, drop_comments, max_lines))
                held += len(before or "") + len(after or "")
                if held > PIECE_CHARS or at + 1 == batch.num_rows:
                    values = [pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*kept.slice(first, at + 1 - first).columns, *values], names=[*rest, *made.names])
                    first, held, out = at + 1, 0, []

    return pairs.mapInArrow(run, T.StructType([*pairs.select(*[F.col(f"`{c}`") for c in rest]).schema.fields, *made.fields]))


def align(pairs: DataFrame, drop_comments: bool = True, max_lines: int | None = None, compact: bool = False) -> DataFrame:
    """pairs (key, before, after, lang) to the long table, whatever a pair's size.

    ``max_lines`` leaves out pairs with more line ends in sum. Labelling may set it to ``4 * MAX_LINES``: beyond that a pair fails the size gate whatever its diff.
    ``compact``: one row a pair instead, COMPACT and the pair's columns other than before and after; pairs beyond ``max_lines`` stay, as rows without lines. Columns named like COMPACT's clash.
    """
    if compact:
        return _compact(pairs, drop_comments, max_lines)
    columns = [f.split()[0] for f in LONG.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out, held = [], 0
            for key, before, after, lang in zip(f["key"], f["before"], f["after"], f["lang"], strict=True):
                before, after = before or "", after or ""
                if max_lines is None or before.count("\n") + after.count("\n") <= max_lines:
                    out += [(key, *r) for r in align_pair(before, after, lang, drop_comments)]
                    held += len(before) + len(after)
                if held > PIECE_CHARS:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    return pairs.select("key", "before", "after", "lang").mapInPandas(run, LONG)


#: Line pairs that a task should have to look at; so many tasks at most.
TASK_COST, MOST_TASKS = 50_000_000, 100_000


def align_distinct(pairs: DataFrame, drop_comments: bool = True, max_lines: int | None = None, task_cost: int = TASK_COST) -> DataFrame:
    """As ``align``, but each distinct content (before, after, lang) is aligned once, however many keys have it, and the pairs are dealt by what they cost.

    The cost of a pair is the product of its numbers of lines, as the matcher's worst case has it; there are as many tasks as the sum asks for, and long pairs spread over them by their hash.
    """
    c = pairs.select("key", joern_key(F.col("before"), F.col("after"), F.col("lang")).alias("__content"), "before", "after", "lang")
    once = c.groupBy("__content").agg(*[F.first(x).alias(x) for x in ("before", "after", "lang")])
    size = [F.regexp_count(F.coalesce(x, F.lit("")), F.lit("\n")).cast("double") + 1 for x in ("before", "after")]
    total = c.agg(F.sum(size[0] * size[1])).first()[0] or 0
    tasks = int(min(MOST_TASKS, max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // task_cost)))
    dealt = once.withColumnRenamed("__content", "key").repartition(tasks, "key")
    long = align(dealt, drop_comments, max_lines).withColumnRenamed("key", "__content")
    return join_hot(c.select("key", "__content"), long, "__content", "inner").select([f.split()[0] for f in LONG.split(", ")])


def graph_edges(graphs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (key, lang, offset, lines, cdg, rd) with JSON lists: edges (key, a, b, kind), both directions, and sizes (key, n_graph_lines, n_cdg, n_ddg).

    The offset is taken off, self edges and lines below 1 are dropped, repeated edges count once.
    """
    def pairs(c: str, kind: str) -> DataFrame:
        e = graphs.select("key", "offset", F.explode(F.from_json(c, "array<array<int>>")).alias("e"))
        x, y = F.col("e")[0] - F.col("offset"), F.col("e")[1] - F.col("offset")
        return e.select("key", F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.lit(kind).alias("kind")).where("a >= 1 AND a <> b").distinct()

    once = pairs("cdg", "cdg").unionByName(pairs("rd", "ddg"))
    counts = once.groupBy("key").agg(F.count_if(F.col("kind") == "cdg").alias("n_cdg"), F.count_if(F.col("kind") == "ddg").alias("n_ddg"))
    lines = graphs.select("key", F.size(F.filter(F.array_distinct(F.transform(F.from_json("lines", "array<int>"), lambda x: x - F.col("offset"))), lambda x: x >= 1)).alias("n_graph_lines"))
    sizes = lines.join(counts, "key", "left").select("key", "n_graph_lines", F.coalesce("n_cdg", F.lit(0)).alias("n_cdg"), F.coalesce("n_ddg", F.lit(0)).alias("n_ddg"))
    return once.unionByName(once.select("key", F.col("b").alias("a"), F.col("a").alias("b"), "kind")), sizes


def graph_rows(graphs: DataFrame) -> DataFrame:
    """What ``graph_edges`` finds, as one row a graph, without a shuffle: (key, n_graph_lines, n_cdg, n_ddg, edges). An edge is a number: its smaller line times 2^32, and its larger line."""
    off = F.col("offset")

    def edges(c: str) -> Column:
        def one(e: Column) -> Column:
            x, y = F.get(e, F.lit(0)) - off, F.get(e, F.lit(1)) - off
            return F.when((F.least(x, y) >= 1) & (x != y), F.shiftleft(F.least(x, y).cast("long"), 32) + F.greatest(x, y))

        found = F.filter(F.transform(F.from_json(c, "array<array<int>>"), one), lambda e: e.isNotNull())
        return F.coalesce(F.array_distinct(found), F.array().cast("array<bigint>"))

    known = F.size(F.filter(F.array_distinct(F.transform(F.from_json("lines", "array<int>"), lambda x: x - off)), lambda x: x >= 1))
    g = graphs.select("key", known.alias("n_graph_lines"), edges("cdg").alias("__c"), edges("rd").alias("__d"))
    return g.select("key", "n_graph_lines", F.size("__c").cast("long").alias("n_cdg"), F.size("__d").cast("long").alias("n_ddg"), F.array_union("__c", "__d").alias("edges"))


def graph_lines(graphs: DataFrame) -> DataFrame:
    """(key, union_line) of the lines that a graph knows."""
    return graphs.select("key", F.explode(F.from_json("lines", "array<int>")).alias("l"), "offset").select("key", (F.col("l") - F.col("offset")).alias("union_line")).where("union_line >= 1").distinct()


def gates(pairs: DataFrame, long: DataFrame, max_ratio: float = MAX_RATIO, min_changed: int = MIN_CHANGED) -> DataFrame:
    """(key, gate, n_lines, n_removed, n_added): the first gate that a sample fails, null if none."""
    per = long.groupBy("key").agg(F.count("*").alias("n_lines"), F.count_if("is_removed").alias("n_removed"), F.count_if("is_added").alias("n_added"))
    j = pairs.select("key", "lang", "before", "after").join(per, "key", "left").fillna(0, ["n_lines", "n_removed", "n_added"])
    size = F.regexp_count(F.coalesce("before", F.lit("")), F.lit("\n")) + F.regexp_count(F.coalesce("after", F.lit("")), F.lit("\n"))
    changed = F.col("n_removed") + F.col("n_added")
    no_code = F.col("before").isNull() | F.col("after").isNull() | (strip(F.col("before")) == "")
    gate = _gate(F.col("lang"), no_code, F.col("n_lines"), size, changed, max_ratio, min_changed)
    return j.select("key", gate.alias("gate"), "n_lines", "n_removed", "n_added")


def depadd(long: DataFrame, edges: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(key, union_line): neighbours of added lines that aren't added themselves and stand in the before version (or in ``before``)."""
    added = long.where("is_added").select("key", F.col("union_line").alias("a"))
    near = edges.select("key", "a", "b").join(added, ["key", "a"]).select("key", F.col("b").alias("union_line")).distinct()
    allowed = long.where("in_before").select("key", "union_line") if before is None else before
    return near.join(long.where("is_added").select("key", "union_line"), ["key", "union_line"], "left_anti").join(allowed, ["key", "union_line"], "left_semi")


def line_labels(pairs: DataFrame, long: DataFrame, edges: DataFrame, sizes: DataFrame, max_ratio: float = MAX_RATIO, min_changed: int = MIN_CHANGED, before: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(status table, labelled lines). Status: (key, status, confidence, n_lines, n_removed, n_added, n_cdg, n_ddg, n_vul). Lines: (key, union_line, from_removed, from_depadd).

    A graph counts only with an edge and lines for a fifth of the union view. Without one, or if it leaves no line, removed lines alone are labelled.
    """
    gate = gates(pairs, long, max_ratio, min_changed).join(sizes, "key", "left")
    open_ = gate.withColumn("graph_ok", _graph_ok())
    dep = depadd(long, edges, before).join(open_.where("graph_ok AND gate IS NULL").select("key"), "key", "left_semi")
    marked = long.where("is_removed").select("key", "union_line", F.lit(True).alias("r"), F.lit(False).alias("d")).unionByName(dep.select("key", "union_line", F.lit(False).alias("r"), F.lit(True).alias("d")))
    lines = marked.groupBy("key", "union_line").agg(F.max("r").alias("from_removed"), F.max("d").alias("from_depadd")).join(open_.where("gate IS NULL").select("key"), "key", "left_semi")
    filled = long.where(strip(F.col("before_text")) != "").select("key", "union_line")
    lines = lines.join(filled, ["key", "union_line"], "left_semi")
    n = lines.groupBy("key").agg(F.count("*").alias("n_vul"))
    s = open_.join(n, "key", "left").withColumn("n_vul", F.coalesce("n_vul", F.lit(0)))
    status, conf = _verdict(F.col("gate"), F.col("graph_ok"), F.col("n_removed"), F.col("n_added"), F.col("n_vul"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cdg", "n_ddg")]
    return s.select("key", status.alias("status"), conf.alias("confidence"), "n_lines", "n_removed", "n_added", *zero, "n_vul"), lines


def _gate(lang: Column, no_code: Column, n_lines: Column, n_breaks: Column, changed: Column, max_ratio: float, min_changed: int) -> Column:
    return (
        F.when(lang.isNull(), F.lit("unsupported_language"))
        .when(no_code, F.lit("missing_code"))
        .when((n_lines > MAX_LINES) | (n_breaks > 4 * MAX_LINES), F.lit("too_large"))
        .when(n_lines == 0, F.lit("missing_code"))
        .when(changed == 0, F.lit("no_change"))
        .when((F.try_divide(changed, n_lines) > max_ratio) & (changed >= min_changed), F.lit("diff_too_large"))
    )


def _verdict(gate: Column, graph_ok: Column, n_removed: Column, n_added: Column, n_vul: Column) -> tuple[Column, Column]:
    """Status and confidence."""
    some = graph_ok & (n_vul > 0)
    by_graph = F.when(n_added == 0, F.lit("joern_delete_only")).when(n_removed == 0, F.lit("joern_add_only")).otherwise(F.lit("joern_ok"))
    alone = F.when(n_added == 0, F.lit("ok_delete_only")).when(graph_ok & (n_removed == 0), F.lit("add_only_no_dep")).otherwise(F.lit("no_pdg_signal"))
    status = F.when(gate.isNotNull(), gate).when(some, by_graph).otherwise(alone)
    return status, F.when(gate.isNotNull(), F.lit("none")).when(some | (n_added == 0), F.lit("high")).otherwise(F.lit("low"))


def _graph_ok() -> Column:
    return F.coalesce((F.col("n_cdg") + F.col("n_ddg") > 0) & (F.col("n_graph_lines") >= MIN_COVERAGE * F.col("n_lines")), F.lit(False))


def sample_labels(rows: DataFrame, graphs: DataFrame, max_ratio: float = MAX_RATIO, min_changed: int = MIN_CHANGED, by: str = "key") -> DataFrame:
    """What ``line_labels`` and ``renumbered`` find, as one row a sample: ``rows`` (lang and others, COMPACT) with status, confidence, n_removed, n_added, n_cdg, n_ddg, n_vul, vul_lines (of the union view),
    vul_lines_fb, removed_lines_fb, depadd_lines_fb, added_lines_fa, and without COMPACT's columns but n_lines and own_sig. graphs: ``graph_rows``, one row a key, found by the column ``by``."""
    j = rows.join(graphs.select(F.col("key").alias(by), "n_graph_lines", "n_cdg", "n_ddg", "edges"), by, "left")
    none = F.array().cast("array<int>")
    n_removed, n_added = (F.size(c).cast("long") for c in ("removed", "added"))
    j = j.withColumns({"n_removed": n_removed, "n_added": n_added, "__ok": _graph_ok()})
    j = j.withColumn("__gate", _gate(F.col("lang"), F.col("no_code"), F.col("n_lines"), F.col("n_breaks"), F.col("n_removed") + F.col("n_added"), max_ratio, min_changed))

    def low(e: Column) -> Column:
        return F.shiftright(e, 32).cast("int")

    def high(e: Column) -> Column:
        return e.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).cast("int")

    def number(u: Column) -> Column:
        """0 for an added line, null outside the view."""
        return F.get("before_line", u - 1)

    def beside(x: Callable[[Column], Column], y: Callable[[Column], Column]) -> Column:
        """The ends y, in the before version, of edges from an added line x."""
        return F.transform(F.filter("edges", lambda e: (number(x(e)) == 0) & (number(y(e)) > 0)), y)

    near = F.concat(beside(low, high), beside(high, low))
    dep = F.when(F.col("__gate").isNull() & F.col("__ok"), F.array_sort(F.array_except(near, "blank")))
    j = j.withColumns({"__removed": F.when(F.col("__gate").isNull(), F.array_except("removed", "blank")).otherwise(none), "__dep": F.coalesce(dep, none)})
    j = j.withColumn("vul_lines", F.array_sort(F.array_union("__removed", "__dep"))).withColumn("n_vul", F.size("vul_lines").cast("long"))
    status, confidence = _verdict(F.col("__gate"), F.col("__ok"), F.col("n_removed"), F.col("n_added"), F.col("n_vul"))
    named = {"vul_lines_fb": "vul_lines", "removed_lines_fb": "__removed", "depadd_lines_fb": "__dep"}
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in T.StructType.fromDDL(COMPACT).names]
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cdg", "n_ddg")]
    numbers = [F.transform(c, number).alias(k) for k, c in named.items()]
    return j.select(*kept, status.alias("status"), confidence.alias("confidence"), F.col("n_lines").cast("long").alias("n_lines"), "n_removed", "n_added", *zero, "n_vul", "vul_lines", *numbers, F.col("added_fa").alias("added_lines_fa"), "own_sig")


def renumber(long: DataFrame) -> DataFrame:
    """Adds before_line and after_line: a union line's number in either version, null where it isn't part of it."""
    w = Window.partitionBy("key").orderBy("union_line")  # the lines of one function
    for side in ("before", "after"):
        inside = F.col(f"in_{side}")
        long = long.withColumn(f"{side}_line", F.when(inside, F.sum(F.when(inside, 1).otherwise(0)).over(w)).cast("int"))
    return long


def external_lines(long: DataFrame, flaws: DataFrame) -> DataFrame:
    """(key, union_line) of lines whose trimmed text is among a sample's external flaw lines (key, text)."""
    texts = flaws.select("key", strip(F.col("text")).alias("t")).where("t <> ''").distinct()
    return long.select("key", "union_line", strip(F.col("before_text")).alias("t")).join(texts, ["key", "t"], "left_semi").select("key", "union_line")


def fuse(status: DataFrame, derived: DataFrame, external: DataFrame) -> tuple[DataFrame, DataFrame]:
    """External labels win where any of their lines was found; else derived ones. Adds label_source, coord_space, completeness, has_line_label to status; returns the final lines too."""
    found = external.select("key").distinct().withColumn("__x", F.lit(True))
    s = status.join(found, "key", "left")
    ext = F.coalesce(F.col("__x"), F.lit(False))
    got = F.col("n_vul") > 0
    s = s.withColumns(
        {
            "label_source": F.when(ext, F.lit("bigvul")).when(got, F.lit("derived")).otherwise(F.lit("none")),
            "coord_space": F.when(ext, F.lit("raw")).when(got, F.lit("no_comments")).otherwise(F.lit("")),
            "completeness": F.when(ext, F.lit("bigvul")).when(got & F.col("status").startswith("joern"), F.lit("full")).when(got & (F.col("status") == "ok_delete_only"), F.lit("full")).when(got, F.lit("removed_only")).otherwise(F.lit("")),
            "has_line_label": ext | got,
        }
    ).drop("__x")
    final = external.withColumns({"from_removed": F.lit(False), "from_depadd": F.lit(False)}).unionByName(derived.join(found.select("key"), "key", "left_anti").select("key", "union_line", "from_removed", "from_depadd"))
    return s, final


def without_signature(lines: DataFrame, long: DataFrame) -> DataFrame:
    """The lines but those of the signature that only a dependence gave; external labels (neither removed nor dependent) stay."""
    sig = long.where("is_sig").select("key", "union_line", F.lit(True).alias("__s"))
    return lines.join(sig, ["key", "union_line"], "left").where("__s IS NULL OR from_removed OR NOT from_depadd").drop("__s")


def collapse(lines: DataFrame, column: str, number: str = "union_line") -> DataFrame:
    """(key, column): the sorted line numbers of a sample joined by ';'."""
    return lines.where(F.col(number).isNotNull()).groupBy("key").agg(F.array_join(F.array_sort(F.collect_list(F.col(number))), ";").alias(column))


def label_text(lines: DataFrame, long: DataFrame) -> DataFrame:
    """(key, vul_text): the labelled lines' text in order."""
    t = lines.select("key", "union_line").join(long.select("key", "union_line", "before_text"), ["key", "union_line"])
    return t.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("union_line", "before_text"))), lambda s: s["before_text"]), "\n").alias("vul_text"))


def dedupe_reference(reference: DataFrame) -> DataFrame:
    """One row per ``h`` (norm_hash): rows with lines first, then vul = 1, then file and position. Rows of a frequent function are reduced before the shuffle."""
    order = F.struct(F.coalesce(strip(F.col("lines_before")), F.lit("")) == "", F.coalesce(F.col("vul") != 1, F.lit(True)), "file", "pos")
    row = F.struct(*[f"`{c}`" for c in reference.columns])
    return reference.where("h IS NOT NULL").groupBy("h").agg(F.min_by(row, order).alias("__row")).select("__row.*")


def attach_flaw_lines(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Joins external lines by the hash of the before version; adds flaw_lines, line_count, matched and match_level (what besides the function agrees)."""
    best = dedupe_reference(reference).select("h", "lines_before", F.col("cve").alias("__cve"), F.col("commit").alias("__commit"))
    j = join_hot(rows, best, "h")
    kept = F.filter(F.split("lines_before", "\n"), lambda t: strip(t) != "")
    cve, commit = F.coalesce(F.col("cve_id") == F.col("__cve"), F.lit(False)), F.coalesce(F.col("commit_sha") == F.col("__commit"), F.lit(False))
    matched = F.coalesce(strip(F.col("lines_before")), F.lit("")) != ""
    level = F.when(~matched, F.lit(None)).when(cve & commit, F.lit("func_commit_cve")).when(commit, F.lit("func_and_commit")).when(cve, F.lit("func_and_cve")).otherwise(F.lit("func_only"))
    return j.withColumns({"flaw_lines": F.when(matched, kept), "line_count": F.when(matched, F.size(kept)).otherwise(0), "matched": matched, "match_level": level}).drop("lines_before", "__cve", "__commit")


def agreement(pairs: DataFrame) -> DataFrame:
    """(relation, n) over rows with arrays ours and theirs: exact, subset, overlap or disjoint sets of trimmed texts."""
    x, y = (F.array_distinct(F.transform(c, lambda t: strip(t))) for c in ("ours", "theirs"))
    common = F.size(F.array_intersect(x, y))
    rel = F.when((common == F.size(x)) & (common == F.size(y)), F.lit("exact")).when(common == F.size(y), F.lit("subset")).when(common > 0, F.lit("overlap")).otherwise(F.lit("disjoint"))
    return pairs.groupBy(rel.alias("relation")).agg(F.count("*").alias("n"))


def precision_recall(pairs: DataFrame) -> DataFrame:
    """One row over rows with arrays ours and given: precision, recall, F1 (micro) and the number of exact matches."""
    hit = F.sum(F.size(F.array_intersect("ours", "given")))
    out = pairs.agg(hit.alias("hit"), F.sum(F.size("ours")).alias("n_ours"), F.sum(F.size("given")).alias("n_given"), F.count_if(F.array_sort("ours") == F.array_sort("given")).alias("exact"), F.count("*").alias("n"))
    p, r = F.try_divide("hit", "n_ours"), F.try_divide("hit", "n_given")
    return out.select("n", "exact", F.round(p, 6).alias("precision_"), F.round(r, 6).alias("recall_"), F.round(F.try_divide(2 * p * r, p + r), 6).alias("f1"))


def split_by_project(rows: DataFrame, test_part: float = 0.2, key: str = "project_key") -> DataFrame:
    """Adds split: whole projects go to train or test by a hash of their key; rows without one are train."""
    share = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(10_000))
    return rows.withColumn("split", F.when(F.col(key).isNotNull() & (share < int(test_part * 10_000)), F.lit("test")).otherwise(F.lit("train")))


def pending(rows: DataFrame, cache: DataFrame, key: str = "sample_key") -> DataFrame:
    """The distinct keys' rows that no cached result has."""
    return rows.dropDuplicates([key]).join(cache.select(key).distinct(), key, "left_anti")


def keep_last(cache: DataFrame, fresh: DataFrame, key: str = "sample_key", order: str = "load") -> DataFrame:
    """Cached and fresh results; of equal keys the one loaded last. Copies are reduced before the shuffle."""
    rows = cache.unionByName(fresh)
    return rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(F.struct(*[f"`{c}`" for c in rows.columns]), F.struct(order)).alias("__row")).select("__row.*")


def to_label(rows: DataFrame, languages: list[str] | None = None, every: bool = False, external: str = "has_bigvul_lines") -> DataFrame:
    """The samples to label: those in the listed languages (all without a list) that have no external lines, unless ``every``. A null flag counts as none."""
    kept = rows if languages is None else rows.where(F.col("lang").isin(languages))
    return kept if every else kept.where(~F.coalesce(F.col(external), F.lit(False)))


def merge_results(rows: DataFrame, results: DataFrame, key: str = "key") -> DataFrame:
    """All samples with the results (key, status, n_vul, ..) of those that were labelled; the others get the status ``skipped_has_bigvul``. Adds derived_ok: usable, with a line at least."""
    status = F.coalesce("status", F.lit(SKIPPED))
    ok = status.isin(USABLE) & (F.coalesce("n_vul", F.lit(0)) > 0)
    return rows.join(results, key, "left").withColumns({"status": status, "derived_ok": ok})


def renumbered(long: DataFrame, found: DataFrame, final: DataFrame | None = None) -> DataFrame:
    """One row a sample: the labelled lines as sorted arrays of numbers in the version that they belong to.

    vul_lines_fb, removed_lines_fb and depadd_lines_fb are numbers of the before version, added_lines_fa of the after version. ``final`` (key, union_line) gives vul_lines_fb; without it all of ``found`` does.
    """
    marks = found.select("key", "union_line", "from_removed", "from_depadd")
    chosen = (found if final is None else final).select("key", "union_line", F.lit(True).alias("__vul"))
    j = renumber(long).join(marks, ["key", "union_line"], "left").join(chosen, ["key", "union_line"], "left")

    def numbers(condition: str, line: str, name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.expr(condition), F.col(line)))).alias(name)

    return j.groupBy("key").agg(
        numbers("__vul", "before_line", "vul_lines_fb"), numbers("from_removed", "before_line", "removed_lines_fb"),
        numbers("from_depadd", "before_line", "depadd_lines_fb"), numbers("is_added", "after_line", "added_lines_fa"),
    )


def change_labels(rows: DataFrame, graphs: DataFrame, max_ratio: float = 0.80, min_changed: int = 10) -> DataFrame:
    """Labels aligned samples (key, lang, deleted and others, COMPACT) that come with their deleted lines, as in JSON line-change sets. graphs: ``graph_rows`` by key.

    The label is the given deleted lines and the dependence lines found here (vul_lines_linevd), less the lines of the function's own signature that weren't deleted (vul_lines_final).
    One row a sample, with status columns, renumbered lines, derived_ok, label_completeness and has_line_label.
    """
    j = sample_labels(rows.withColumn("deleted", F.array_distinct(F.coalesce("deleted", F.array().cast("array<int>")))), graphs, max_ratio, min_changed)
    j = j.withColumn("derived_ok", F.col("status").isin(USABLE) & (F.col("n_vul") > 0)).withColumn("vul_lines_linevd", F.array_sort(F.array_union("deleted", "depadd_lines_fb")))
    j = j.withColumn("vul_lines_final", F.filter("vul_lines_linevd", lambda n: ~F.array_contains("own_sig", n) | F.array_contains("deleted", n)))
    whole = F.when(~F.col("derived_ok"), F.lit("")).when(F.col("status").isin(REMOVED_ONLY), F.lit("removed_only")).otherwise(F.lit("full"))
    return j.withColumns({"label_completeness": whole, "has_line_label": F.size("vul_lines_final") > 0}).drop("own_sig", "vul_lines", "lang")


def line_change_labels(samples: DataFrame, edges: DataFrame, sizes: DataFrame, max_ratio: float = 0.80, min_changed: int = 10) -> DataFrame:
    """``change_labels`` of samples (key, before, after, lang, deleted) that aren't aligned yet, with the graphs as ``graph_edges`` gives them."""
    code = F.shiftleft(F.least("a", "b").cast("long"), 32) + F.greatest("a", "b")
    by_key = edges.where("a >= 1 AND b >= 1").groupBy("key").agg(F.collect_set(code).alias("edges"))  # the edges of one function
    graphs = sizes.select("key", "n_graph_lines", "n_cdg", "n_ddg").join(by_key, "key", "left")
    return change_labels(align(samples.select("key", "before", "after", "lang", "deleted"), max_lines=4 * MAX_LINES, compact=True), graphs, max_ratio, min_changed)
