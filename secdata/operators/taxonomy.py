"""CWE taxonomies: closures over the weakness tree, class and type of a CWE, mechanism groups.

A catalog is a dict of tables: node (id, name, text), parent (child, parent), child (parent, child), cat699 (member, category), all ids as strings.
Classification runs once per distinct CWE, by frontier joins over the catalog; samples are joined to the resulting dimension table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secdata.functions import rules
from secdata.functions.binding import let
from secdata.operators.joins import join_hot
from secdata.sources import sinks

# Class of a CWE-699 category, of a level-2 node, of a CWE-1000 pillar; overrides, catch-all categories, ids that tell nothing.
CATEGORY_TO_CLASS = {"1218": "BND", "189": "BND", "399": "LFC", "465": "LFC", "452": "LFC", "411": "LFC", "557": "LFC", "387": "LFC", "137": "NTR", "133": "NTR", "1215": "NTR", "1219": "NTR", "1211": "PRT", "1212": "PRT", "1210": "PRT", "255": "PRT", "417": "PRT", "310": "PRT", "320": "PRT", "1216": "PRT", "275": "PRT", "265": "PRT", "355": "PRT", "1217": "PRT", "199": "PRT", "1213": "PRT", "389": "PRT", "429": "PRT", "1228": "PRT", "1214": "PRT", "136": "BND", "569": "BND", "1227": "PRT", "19": "BND", "438": "NTR", "840": "PRT", "371": "LFC", "1006": "PRT", "1226": "BND", "1225": "PRT"}
LEVEL2_TO_CLASS = {"913": "NTR", "706": "NTR", "610": "NTR", "668": "PRT", "922": "PRT", "118": "BND", "666": "LFC", "404": "LFC", "662": "LFC", "665": "LFC", "672": "LFC", "825": "LFC", "911": "LFC", "400": "BND", "834": "BND", "407": "BND"}
PILLAR_TO_CLASS = {"664": "LFC", "682": "BND", "707": "NTR", "284": "PRT", "693": "PRT", "703": "PRT", "691": "LFC", "710": "PRT", "697": "BND", "435": "NTR"}
CLASS_OVERRIDE = {"384": "PRT", "264": "PRT", "16": "PRT", "21": "NTR", "534": "PRT"}
CATCH_ALL = ["399", "19", "438"]
NO_INFO = ["17", "18"]
TYPE_CATEGORIES = {
    "Exception Handling": ["389", "429", "1228"],
    "Concurrency": ["557", "387"],
    "Input Validation": ["1215", "133", "137"],
    "Access Control & Info Sec": ["1211", "1212", "1210", "255", "417", "310", "320", "1216", "275", "265", "355", "1217", "199"],
    "Resource Management": ["1218", "411", "465", "452", "1219", "399"],
    "State Management": ["1006", "438", "840", "1226", "1225", "371"],
    "Type and Data Handling": ["1214", "1227", "569", "1213", "189", "136", "19"],
}
TYPE_TO_GROUP = {"Resource Management": "Resource", "Concurrency": "Resource", "Input Validation": "Data", "Type and Data Handling": "Data", "Exception Handling": "Behavior", "State Management": "Behavior", "Access Control & Info Sec": "Policy"}
TYPE_OVERRIDE = {"384": "Access Control & Info Sec", "264": "Access Control & Info Sec", "16": "State Management", "21": "Resource Management", "534": "Access Control & Info Sec"}
PILLAR_TO_TYPE = {"284": "Access Control & Info Sec", "693": "Access Control & Info Sec", "664": "Resource Management", "682": "Type and Data Handling", "697": "Type and Data Handling", "691": "State Management", "710": "State Management", "435": "State Management", "703": "Exception Handling", "707": "Input Validation"}
# Names of the deciding rules and tiers, as they stand in results.
INVALID, NOTHING, OVERRIDDEN, REDIRECTED, NEAR, DIRECT, LEVEL2, PILLAR = "6_không_hợp_lệ", "0_không_thông_tin", "0_override", "1_deprecated_redirect", "2a_cha_node2", "2_category_699", "2_node_mức2", "2_pillar_1000"
UP, UP_LEVEL2, DOWN, FAR_LEVEL2, FAR_PILLAR, CATCH, NONE = "3_leo_lên", "3_leo_lên_node2", "4_leo_xuống", "5_node_mức2", "5_pillar_1000", "5b_catch_all", "6_không_phân_được"
TIERS = ["1_cwe_cụ_thể", "2_text_mạnh", "3_cwe_category", "4_text_yếu", "5_code_dòng_lỗi", "6_code_toàn_hàm", "7_chưa", "7_project", "8_mặc_định"]


@dataclass
class Scheme:
    """The literal tables of one taxonomy."""

    category: dict[str, str]
    pillar: dict[str, str]
    override: dict[str, str]
    level2: dict[str, str] = field(default_factory=dict)
    catch_all: list[str] = field(default_factory=list)


CLASSES = Scheme(CATEGORY_TO_CLASS, PILLAR_TO_CLASS, CLASS_OVERRIDE, LEVEL2_TO_CLASS, CATCH_ALL)
TYPES = Scheme({c: t for t, cs in TYPE_CATEGORIES.items() for c in cs}, PILLAR_TO_TYPE, TYPE_OVERRIDE)


def _table(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()) or [], f"{key} string, {value} string")


def closure(roots: DataFrame, edges: DataFrame, start: str, end: str, depth: int) -> DataFrame:
    """(root, node, depth): what ``roots`` (root) reach over edges start -> end in 1 .. ``depth`` steps, with the least depth."""
    step = edges.select(F.col(start).alias("node"), F.col(end).alias("next")).distinct()
    return reached(roots, step.withColumn("open", F.lit(True)), depth)


def reached(roots: DataFrame, step: DataFrame, depth: int) -> DataFrame:
    """(root, node, depth) along step (node, next, open), where a node that isn't open is passed only by its own root. The root itself isn't among its nodes.

    A breadth-first walk from all roots at once: each round steps on from the nodes that the round before reached first, and drops those that were reached already. So a node is
    passed once per root, however many paths lead to it, and circles end. Rounds are tables in the shared folder; they end with the longest shortest path.
    """
    spark = roots.sparkSession
    folder = sinks.work_folder(spark)
    step = sinks.stage_table(step.select("node", "next", "open").distinct(), folder, "step")
    front = roots.select("root").distinct().select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))
    # Roots that lead anywhere; the first round starts from the roots, closed or not.
    front = seen = sinks.stage_table(front.join(step.select("node").distinct(), "node", "left_semi").select("root", "node", "depth"), folder, "0")
    for d in range(1, depth + 1):
        ways = step if d == 1 else step.where("open")
        new = front.join(ways, "node").select("root", F.col("next").alias("node"), F.lit(d).alias("depth")).distinct()
        front = sinks.stage_table(new.join(seen.select("root", "node"), ["root", "node"], "left_anti"), folder, str(d))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen.where("depth > 0").select("root", "node", "depth")


def ancestors(cwes: DataFrame, parent: DataFrame, depth: int = 12) -> DataFrame:
    return closure(cwes, parent, "child", "parent", depth)


def _direct(spark: SparkSession, catalog: dict[str, DataFrame], scheme: Scheme) -> DataFrame:
    """(node, classes): what an id's own category, or its CWE-699 categories unless all are catch-alls, say."""
    category = F.broadcast(_table(spark, scheme.category, "category", "class"))
    own = category.select(F.col("category").alias("node"), F.array("class").alias("classes"))
    sets = catalog["cat699"].join(category, "category").groupBy(F.col("member").alias("node")).agg(F.array_sort(F.collect_set("class")).alias("classes"), F.bool_and(F.col("category").isin(scheme.catch_all)).alias("vague"))
    return own.unionByName(sets.where(~F.col("vague")).select("node", "classes").join(own, "node", "left_anti"))


def classify(cwes: DataFrame, catalog: dict[str, DataFrame], scheme: Scheme, max_depth: int = 6, far: int = 12) -> DataFrame:
    """(cwe, classes, rule) for the distinct values of column ``cwe``; classes is sorted and empty if nothing decides.

    First of: nothing to say, override, redirect of a deprecated entry, level-2 parents, categories, own level-2 node or pillar, nearest ancestor with a class (ties:
    smallest number), majority of the nearest classified descendants (all winners), nearest level-2 node or pillar at any depth, catch-all category.
    """
    spark = cwes.sparkSession
    asked = cwes.select("cwe").distinct().withColumn("id", F.replace(F.upper(F.trim("cwe")), F.lit("CWE-"), F.lit("")))
    node = catalog["node"]
    target = F.regexp_extract("text", r"(?i)(?:duplicate of|transferred to|replaced by)\s+CWE-(\d+)", 1)
    moved = node.where(F.col("name").startswith("DEPRECATED")).select(F.col("id"), target.alias("to")).where("to <> ''")
    special = [*scheme.override, *NO_INFO]
    resolved = asked.withColumns({"at": F.col("id"), "moved": F.lit(False)})
    for _ in range(3):  # chains of redirects
        hop = F.col("to").isNotNull() & ~F.col("at").isin(special)
        resolved = resolved.join(F.broadcast(moved.select(F.col("id").alias("at"), "to")), "at", "left").select("cwe", "id", F.when(hop, F.col("to")).otherwise(F.col("at")).alias("at"), (F.col("moved") | hop).alias("moved"))
    roots = resolved.where(F.col("at").rlike(r"^\d+$")).select(F.col("at").alias("root")).distinct()

    direct = _direct(spark, catalog, scheme)
    level2 = _table(spark, scheme.level2, "node", "class").select("node", F.array("class").alias("classes"))
    pillar = _table(spark, scheme.pillar, "node", "class").select("node", F.array("class").alias("classes"))
    up = closure(roots, catalog["parent"], "child", "parent", max(max_depth, far))

    near = catalog["parent"].select(F.col("child").alias("root"), F.col("parent").alias("node")).join(level2, "node").groupBy("root").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("classes"))
    stops = direct.withColumn("rule", F.lit(UP)).unionByName(level2.join(direct, "node", "left_anti").withColumn("rule", F.lit(UP_LEVEL2)))
    place = F.struct("depth", F.col("node").cast("int"))
    climbed = up.where(F.col("depth") <= max_depth).join(stops, "node").groupBy("root").agg(F.min_by(F.struct("classes", "rule"), place).alias("c"))
    last = level2.withColumn("rule", F.lit(FAR_LEVEL2)).unionByName(pillar.join(level2, "node", "left_anti").withColumn("rule", F.lit(FAR_PILLAR)))
    topped = up.join(last, "node").groupBy("root").agg(F.min_by(F.struct("classes", "rule"), place).alias("c"))

    shut = direct.select("node", F.lit(True).alias("shut"))
    step = catalog["child"].select(F.col("parent").alias("node"), F.col("child").alias("next")).distinct().join(shut, "node", "left").select("node", "next", F.col("shut").isNull().alias("open"))
    tally = reached(roots, step, max_depth).join(direct, "node").select("root", F.explode("classes").alias("class")).groupBy("root", "class").agg(F.count("*").alias("n"))
    most = tally.groupBy("root").agg(F.max("n").alias("n"))
    voted = tally.join(most, ["root", "n"]).groupBy("root").agg(F.array_sort(F.collect_set("class")).alias("classes"))
    caught = catalog["cat699"].where(F.col("category").isin(scheme.catch_all)).groupBy(F.col("member").alias("root")).agg(F.min("category").alias("category")).join(F.broadcast(_table(spark, scheme.category, "category", "class")), "category").select("root", F.array("class").alias("classes"))

    over = F.create_map(*[F.lit(x) for kv in scheme.override.items() for x in kv])
    out = resolved.withColumnRenamed("at", "root")
    parts = {"near": near, "direct": direct.withColumnRenamed("node", "root"), "l2": level2.withColumnRenamed("node", "root"), "pl": pillar.withColumnRenamed("node", "root"), "down": voted, "caught": caught}
    for name, table in parts.items():
        out = out.join(table.select("root", F.col("classes").alias(name)), "root", "left")
    out = out.join(climbed.withColumnRenamed("c", "up"), "root", "left").join(topped.withColumnRenamed("c", "top"), "root", "left")

    def pick(when: Column, classes: Column, rule: Column | str) -> Column:
        return F.when(when, F.struct(classes.alias("classes"), (F.lit(rule) if isinstance(rule, str) else rule).alias("rule")))

    none = F.array().cast("array<string>")
    have = {n: F.col(n).isNotNull() for n in [*parts, "up", "top"]}
    decided = F.coalesce(
        pick(~F.col("id").rlike(r"^\d+$"), none, INVALID if scheme.level2 else NONE),
        pick(F.col("root").isin(NO_INFO), none, NOTHING),
        pick(F.col("root").isin([*scheme.override]), F.array(F.try_element_at(over, F.col("root"))), OVERRIDDEN),
        pick(have["near"], F.col("near"), NEAR),
        pick(have["direct"], F.col("direct"), DIRECT),
        *([pick(have["l2"], F.col("l2"), LEVEL2), pick(have["pl"], F.col("pl"), PILLAR)] if scheme.level2 else []),
        pick(have["up"], F.col("up.classes"), F.col("up.rule")),
        pick(have["down"], F.col("down"), DOWN),
        pick(have["top"], F.col("top.classes"), F.col("top.rule")),
        pick(have["pl"], F.col("pl"), FAR_PILLAR),
        pick(have["caught"], F.col("caught"), CATCH),
        pick(F.lit(True), none, NONE),
    )
    return out.withColumn("d", decided).select("cwe", "d.classes", F.when(F.col("moved"), F.lit(REDIRECTED)).otherwise(F.col("d.rule")).alias("rule"))


def cwe_items(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, r"[;,\s]+"), lambda t: F.trim(t)), lambda x: F.upper(x).startswith("CWE-"))


def classify_many(rows: DataFrame, column: str, dim: DataFrame, prefix: str) -> DataFrame:
    """Adds {prefix} (first class of the first CWE that has one), {prefix}_all (sorted, joined by ';'), {prefix}_rule and n_{prefix}.

    The dimension joins the distinct values of the column, not the rows, and those join back by the value.
    """
    values = rows.select(column).distinct()
    each = values.select(column, F.posexplode(cwe_items(F.col(column))).alias("pos", "cwe")).join(dim, "cwe").where(F.size("classes") > 0)
    found = each.groupBy(column).agg(F.min_by(F.struct(F.array_min("classes").alias("first"), "rule"), "pos").alias("p"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("classes")))).alias("every"))
    out = join_hot(rows.withColumn("__v", F.col(column)), found.withColumnRenamed(column, "__v"), "__v")
    return out.withColumns({prefix: F.col("p.first"), f"{prefix}_all": F.coalesce(F.array_join("every", ";"), F.lit("")), f"{prefix}_rule": F.coalesce(F.col("p.rule"), F.lit(NONE)), f"n_{prefix}": F.coalesce(F.size("every"), F.lit(0))}).drop("__v", "p", "every")


def prune_ancestors(rows: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Adds cwe_pruned: the CWEs of a list that aren't ancestors of another one in it, in order, joined by ';'. Works on distinct lists."""
    lists = rows.select(F.col(column).alias("__list")).distinct()
    items = lists.select("__list", F.posexplode(rules.split_cwes(F.col("__list"))).alias("pos", "cwe")).withColumn("id", F.replace("cwe", F.lit("CWE-"), F.lit("")))
    up = ancestors(items.select(F.col("id").alias("root")).distinct(), parent)
    covered = items.select("__list", F.col("id").alias("root")).join(up, "root").select("__list", F.col("node").alias("id")).distinct()
    kept = items.join(covered, ["__list", "id"], "left_anti").groupBy("__list").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cwe"))), lambda s: s["cwe"]), ";").alias("cwe_pruned"))
    return join_hot(rows.withColumn("__list", F.col(column)), kept, "__list").drop("__list").withColumn("cwe_pruned", F.coalesce("cwe_pruned", F.lit("")))


def _tier(name: str):
    return lambda g: F.when(g.isNotNull(), F.struct(g.alias("g"), F.lit(name).alias("t")))


def assign_group(rows: DataFrame, code: str = "func_before", lines: str = "vul_lines_text") -> DataFrame:
    """Adds cwe_group, cwe_group_src (the deciding tier) and groups (all) from cwe_pruned, message, description and code.

    Tiers: specific CWE, strong text, informative category CWE, weak text, code pattern on labelled lines, code pattern on the first 6000 characters.
    """
    cwes = rules.split_cwes(F.col("cwe_pruned"))
    told = F.filter(cwes, rules.informative)
    text = F.concat(F.coalesce("commit_message", F.lit("")), F.lit("\n"), F.coalesce("cve_description", F.lit("")))
    steps = [
        rules.group_of(F.get(F.filter(told, rules.is_precise), F.lit(0))),
        rules.first_match(rules.TEXT_STRONG, text),
        rules.group_of(F.get(told, F.lit(0))),
        rules.first_match(rules.TEXT_WEAK, text),
        rules.first_match(rules.CODE_PATTERNS, F.col(lines)),
        rules.first_match(rules.CODE_PATTERNS, F.substring(code, 1, 6000)),
    ]
    steps[0] = F.when(F.size(F.filter(told, rules.is_precise)) > 0, steps[0])
    steps[2] = F.when(F.size(told) > 0, steps[2])
    pick = F.coalesce(*[let(s, _tier(t)) for s, t in zip(steps, TIERS, strict=False)])
    out = rows.withColumn("__p", pick)
    groups = F.array_sort(F.array_distinct(F.concat(F.filter(F.transform(told, rules.group_of), lambda g: g != "other"), F.when(F.col("__p").isNotNull(), F.array("__p.g")).otherwise(F.array().cast("array<string>")))))
    return out.withColumns({"cwe_group": F.col("__p.g"), "cwe_group_src": F.coalesce(F.col("__p.t"), F.lit(TIERS[6])), "groups": groups}).drop("__p")


def add_groups(rows: DataFrame, code: str = "func_before", lines: str = "vul_lines_text") -> DataFrame:
    """assign_group, then the project's majority (ties: smallest), then mem_spatial; memory split; all groups, their number and whether there are several."""
    rows = assign_group(rows, code, lines)
    counts = rows.where("cwe_group IS NOT NULL AND project_key IS NOT NULL").groupBy("project_key", "cwe_group").agg(F.count("*").alias("n"))
    major = counts.groupBy("project_key").agg(F.min_by("cwe_group", F.struct(-F.col("n"), "cwe_group")).alias("major"))
    out = rows.join(major, "project_key", "left")
    source = F.when(F.col("cwe_group").isNotNull(), F.col("cwe_group_src")).when(F.col("major").isNotNull(), F.lit(TIERS[7])).otherwise(F.lit(TIERS[8]))
    group = rules.split_memory(F.coalesce("cwe_group", "major", F.lit("mem_spatial")), F.col(code))
    out = out.withColumns({"cwe_group_src": source, "cwe_group": group})
    every = F.array_sort(F.array_distinct(F.concat(F.transform("groups", lambda g: rules.split_memory(g, F.col(code))), F.array("cwe_group"))))
    return out.withColumns({"cwe_group_all": F.array_join(every, ";"), "n_cwe_groups": F.size(every), "cwe_multi_label": F.size(every) > 1}).drop("groups", "major")


def hierarchy(catalog: dict[str, DataFrame]) -> DataFrame:
    """(child, parent, kind): ChildOf of weaknesses and, where the catalog has them, MemberOf of categories; only parents that have a name, so that views and lost entries end no path."""
    edges = catalog["parent"].select("child", "parent", F.lit("ChildOf").alias("kind"))
    if "member_of" in catalog:
        edges = edges.unionByName(catalog["member_of"].select("child", "parent", F.lit("MemberOf").alias("kind")))
    return edges.distinct().join(catalog["node"].select(F.col("id").alias("parent")).distinct(), "parent", "left_semi").select("child", "parent", "kind")


def top_ancestors(cwes: DataFrame, catalog: dict[str, DataFrame], depth: int = 12) -> DataFrame:
    """(cwe, tops, depth, multi_parent, kinds): parentless named nodes above a CWE over ``hierarchy`` by depth and id, the least depth (-1 for an unknown CWE), whether any node on
    the way has several parents, and the kinds of edges above it (sorted, joined by ';'). Ids that no catalog entry has are unknown, whatever their form."""
    named = hierarchy(catalog)
    names = catalog["node"].select(F.col("id").alias("node")).distinct()
    roots = cwes.select("cwe").distinct().withColumn("root", F.replace(F.upper(F.trim("cwe")), F.lit("CWE-"), F.lit("")))
    asked = roots.select("root").distinct()
    up = closure(asked, named, "child", "parent", depth).unionByName(asked.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")))
    over = named.groupBy(F.col("child").alias("node")).agg(F.countDistinct("parent").alias("k"), F.collect_set("kind").alias("kinds"))
    # Edges tell whether a node has parents: a node on the way may have no name only if it is the root.
    known = up.join(names.withColumn("named", F.lit(True)), "node", "left").join(over, "node", "left").where("named OR depth = 0")
    per = known.groupBy("root").agg(
        F.array_sort(F.collect_list(F.when(F.col("k").isNull() & F.col("named"), F.struct("depth", "node")))).alias("t"),
        F.max(F.coalesce("k", F.lit(0)) > 1).alias("multi_parent"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("kinds")))), ";").alias("kinds"),
    )
    out = roots.join(per, "root", "left")
    return out.select("cwe", F.coalesce(F.array_join(F.transform("t", lambda s: s["node"]), ";"), F.lit("")).alias("tops"), F.coalesce(F.get("t", F.lit(0))["depth"], F.lit(-1)).alias("depth"), F.coalesce("multi_parent", F.lit(False)).alias("multi_parent"), F.coalesce("kinds", F.lit("")).alias("kinds"))
