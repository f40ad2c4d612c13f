"""Language labelling jobs: priors by repository and token, reconciliation, rule pass, group vote, manual overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secdata.functions import language_rules as L

TRUSTED = ["extension", "file_name", "commit_link_path"]
# Margins from which the token witness counts.
TOKEN_MARGIN = {"C/C++": 0, "Java": 3, "Python": 0, "Ruby": 0}


def cascade(rows: DataFrame) -> DataFrame:
    """Adds language, language_source and language_confidence from extension, file name, or the path in the commit link; null where none decides."""
    tries = [("extension", L.language_from_extension(F.col("extension"))), ("file_name", L.language_from_path(F.col("file_name"))), ("commit_link_path", L.language_from_commit_link(F.col("commit_link")))]
    pick = F.coalesce(*[F.when(c.isNotNull(), F.struct(c.alias("l"), F.lit(s).alias("s"))) for s, c in tries])
    out = rows.withColumn("__p", pick)
    return out.withColumns({"language": F.col("__p.l"), "language_source": F.col("__p.s"), "language_confidence": F.when(F.col("__p").isNotNull(), F.lit("high"))}).drop("__p")


def language_prior(rows: DataFrame, key: str, language: str = "language", min_purity: float = 0.90, min_support: int = 1) -> DataFrame:
    """(key, prior, purity, support) of trusted rows: the key's top language (ties: smallest), its share and its count. Counted per (key, language) first."""
    counts = rows.where(F.col(key).isNotNull() & F.col(language).isNotNull()).groupBy(key, F.col(language).alias("l")).agg(F.count("*").alias("n"))
    top = counts.groupBy(key).agg(F.min_by("l", F.struct(-F.col("n"), "l")).alias("prior"), (F.max("n") / F.sum("n")).alias("purity"), F.max("n").alias("support"))
    return top.where((F.col("purity") >= min_purity) & (F.col("support") >= min_support))


def attach_prior(rows: DataFrame, by_repo: DataFrame, by_project: DataFrame) -> DataFrame:
    """Adds repo_prior_language: the repository's prior, else the project's."""
    a, b = by_repo.select("repo_key", F.col("prior").alias("__r")), by_project.select("project_key", F.col("prior").alias("__p"))
    return rows.join(a, "repo_key", "left").join(b, "project_key", "left").withColumn("repo_prior_language", F.coalesce("__r", "__p")).drop("__r", "__p")


def token_prior(rows: DataFrame, code: str, label: str, min_support: int = 8, min_purity: float = 0.97) -> DataFrame:
    """(token, label, purity, support) over distinct tokens of trusted rows."""
    tokens = rows.where(F.col(label).isNotNull()).select(F.explode(L.tokenize(F.col(code))).alias("token"), F.col(label).alias("l"))
    counts = tokens.groupBy("token", "l").agg(F.count("*").alias("n"))
    best = counts.groupBy("token").agg(F.min_by("l", F.struct(-F.col("n"), "l")).alias("label"), (F.max("n") / F.sum("n")).alias("purity"), F.sum("n").alias("support"))
    return best.where((F.col("support") >= min_support) & (F.col("purity") >= min_purity))


def token_scores(rows: DataFrame, key: str, code: str, prior: DataFrame) -> DataFrame:
    """(key, token_group, token_score, token_margin, token_confident): the label with the largest sum of log1p(support) * purity (ties: smallest)."""
    hits = rows.select(key, F.explode(L.tokenize(F.col(code))).alias("token")).join(prior, "token")
    sums = hits.groupBy(key, "label").agg(F.sum(F.log1p("support") * F.col("purity")).alias("s"))
    two = sums.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("neg"), "label"))), 1, 2).alias("t"))  # labels are few
    top, second = F.col("t")[0], F.get("t", F.lit(1))
    margin = -top["neg"] + F.coalesce(second["neg"], F.lit(0.0))
    return two.select(key, top["label"].alias("token_group"), (-top["neg"]).alias("token_score"), margin.alias("token_margin"), L.is_confident(top["label"], margin, TOKEN_MARGIN).alias("token_confident"))


def reconcile(rows: DataFrame, inferred: str = "github_linguist") -> DataFrame:
    """Reconciles rows inferred by the classifier with the repository prior, or without one with the message's family; adds reconcile_case."""
    lang, prior = F.col("language"), F.col("repo_prior_language")
    inf, unknown = F.coalesce(F.col("language_source") == inferred, F.lit(False)), lang == "Unknown"
    msg = L.family_from_commit_message(F.col("commit_message"))
    case = (
        F.when(~inf, F.lit(None))
        .when(prior.isNull(), F.when(~unknown & (msg == L.language_family(lang)), F.lit("message_confirms")).otherwise(F.lit("no_prior")))
        .when(unknown, F.lit("prior_fills_unknown"))
        .when(prior == lang, F.lit("prior_confirms"))
        .when(L.language_family(prior) == L.language_family(lang), F.lit("prior_refines_family"))
        .otherwise(F.lit("prior_overrides"))
    )
    out = rows.withColumn("reconcile_case", case)
    c = F.col("reconcile_case")
    takes = c.isin("prior_fills_unknown", "prior_refines_family", "prior_overrides")
    source = F.when(c == "message_confirms", F.lit("linguist+commit_message")).when(c.isin("prior_confirms", "prior_refines_family"), F.lit("linguist+repo_prior")).when(c.isin("prior_fills_unknown", "prior_overrides"), F.lit("repo_prior")).otherwise(F.col("language_source"))
    conf = F.when(c == "prior_confirms", F.lit("high")).when(takes, F.lit("medium")).when((c == "message_confirms") & (F.col("language_confidence") == "low"), F.lit("medium")).otherwise(F.col("language_confidence"))
    decision = F.when(c == "prior_fills_unknown", F.lit("repo_prior_fills_unknown")).when(c == "prior_overrides", F.lit("repo_prior_overrides_linguist")).when(c == "prior_confirms", F.concat("language_decision", F.lit("+repo_confirms"))).when(c == "prior_refines_family", F.concat("language_decision", F.lit("+repo_refines"))).otherwise(F.col("language_decision"))
    review = F.when(c == "prior_overrides", F.lit(True)).when(c.isin("prior_fills_unknown", "prior_confirms", "prior_refines_family"), F.lit(False)).otherwise(F.col("needs_language_review"))
    new = F.when(takes, prior).otherwise(lang)
    return out.withColumns({"language_source": source, "language_confidence": conf, "language_decision": decision, "needs_language_review": review, "language_family": F.when(takes, L.language_family(prior)).otherwise(F.col("language_family")), "language": new})


def finalise(rows: DataFrame) -> DataFrame:
    """Null becomes Unknown, for review, with low confidence."""
    none = F.col("language").isNull() | (F.col("language") == "Unknown")
    return rows.withColumns({"needs_language_review": none | F.coalesce("needs_language_review", F.lit(False)), "language_confidence": F.when(none, F.lit("low")).otherwise(F.col("language_confidence")), "language_family": F.coalesce("language_family", F.lit("Unknown")), "language": F.coalesce("language", F.lit("Unknown"))})


def rule_pass(rows: DataFrame, before: str = "func_before", after: str = "func_after") -> DataFrame:
    """Rule detection on rows for review whose source isn't trusted: confirm, override, unsure or no output (column rule_case)."""
    r = L.detect_with_agreement(F.col("__b"), F.col("__a"))
    target = F.coalesce(F.col("needs_language_review"), F.lit(False)) & ~F.coalesce(F.col("language_source").isin(TRUSTED), F.lit(False))
    out = rows.withColumn("__t", target).withColumns({"__b": F.when(F.col("__t"), L.detect_language(F.col(before))), "__a": F.when(F.col("__t"), L.detect_language(F.col(after)))}).withColumn("__r", r)
    fam, margin = F.col("__r.family"), F.col("__r.margin")
    same = fam == L.family_of(F.col("language"))
    case = (
        F.when(~F.col("__t"), F.lit(None))
        .when(F.col("__r").isNull(), F.lit("no_rule_output"))
        .when(same, F.when(L.is_confident(fam, margin, L.CONFIRM), F.lit("confirmed")).otherwise(F.lit("rule_unsure")))
        .when(L.is_confident(fam, margin, L.OVERRIDE) & F.col("__r.agreement"), F.lit("overridden"))
        .otherwise(F.lit("rule_unsure"))
    )
    out = out.withColumn("rule_case", case)
    c = F.col("rule_case")
    over, conf = c == "overridden", c == "confirmed"
    return out.withColumns(
        {
            "needs_language_review": F.when(conf, F.lit(False)).otherwise(F.col("needs_language_review")),
            "language_confidence": F.when(over | (conf & (F.col("language_confidence") == "low")), F.lit("medium")).otherwise(F.col("language_confidence")),
            "language_source": F.when(over, F.lit("rule_based")).when(conf, F.concat("language_source", F.lit("+rule"))).otherwise(F.col("language_source")),
            "language_decision": F.when(over, F.concat(F.lit("rule_overrides_"), "language_decision")).when(conf, F.concat("language_decision", F.lit("+rule_confirms"))).otherwise(F.col("language_decision")),
            "language_family": F.when(over, fam).otherwise(F.col("language_family")),
            "language": F.when(over, F.col("__r.language")).otherwise(F.col("language")),
            "rule_language": F.col("__r.language"),
            "rule_margin": margin,
        }
    ).drop("__t", "__b", "__a", "__r")


def group_vote(rows: DataFrame) -> DataFrame:
    """Votes of four witnesses (columns classifier, prior, rule_group with rule_margin, token_group; groups or null) on rows whose source isn't trusted.

    Adds language_group, group_source, group_confidence, group_n_sources, needs_group_review. All agree; else a confident rule; else a majority; else a tie
    goes to prior, rule, token, classifier.
    """
    votes = F.filter(F.array("classifier", "prior", "rule_group", "token_group"), lambda v: v.isNotNull())
    kinds = F.array_distinct(votes)

    def support(c: Column) -> Column:
        return F.size(F.filter("__v", lambda v: v == c))

    most = F.array_max(F.transform("__k", support))
    winners = F.filter("__k", lambda k: support(k) == F.array_max(F.transform("__k", support)))
    trusted = F.coalesce(F.col("language_source").isin(TRUSTED), F.lit(False))
    rule_ok = F.col("rule_group").isNotNull() & L.is_confident(F.col("rule_group"), F.col("rule_margin"), L.GROUP)
    rule_n = support(F.col("rule_group"))
    tie = F.coalesce("prior", "rule_group", "token_group", "classifier")
    tie_source = F.when(F.col("prior").isNotNull(), F.lit("tie_break_repo_prior")).when(F.col("rule_group").isNotNull(), F.lit("tie_break_rule")).when(F.col("token_group").isNotNull(), F.lit("tie_break_token")).otherwise(F.lit("tie_break_linguist"))

    def made(group, source, conf, n, review=False) -> Column:
        return F.struct(group.alias("g"), source.alias("s"), conf.alias("c"), n.cast("int").alias("n"), F.lit(review).alias("r"))

    one = F.size("__k") == 1
    several = F.size("__v") >= 2
    out = rows.withColumn("__v", votes).withColumn("__k", kinds)
    decided = (
        F.when(trusted, made(L.family_of(F.col("language")), F.col("language_source"), F.col("language_confidence"), F.lit(4)))
        .when(one, made(F.col("__k")[0], F.when(several, F.lit("all_sources_agree")).otherwise(F.lit("single_source")), F.when(several, F.lit("high")).otherwise(F.lit("low")), F.size("__v")))
        .when(rule_ok, made(F.col("rule_group"), F.when(rule_n >= 2, F.lit("rule+other")).otherwise(F.lit("rule_based")), F.when(rule_n >= 2, F.lit("high")).otherwise(F.lit("medium")), rule_n))
        .when((F.size("__v") > 0) & (F.size(winners) == 1), made(winners[0], F.lit("majority_vote"), F.lit("medium"), most))
        .when(F.size("__v") > 0, made(tie, tie_source, F.when(F.col("prior").isNotNull(), F.lit("medium")).otherwise(F.lit("low")), support(tie)))
        .otherwise(made(L.family_of(F.col("language")), F.col("language_source"), F.lit("low"), F.lit(0), True))
    )
    out = out.withColumn("__d", decided)
    return out.withColumns({"language_group": F.col("__d.g"), "group_source": F.col("__d.s"), "group_confidence": F.col("__d.c"), "group_n_sources": F.col("__d.n"), "needs_group_review": F.col("__d.r")}).drop("__v", "__k", "__d")


def apply_manual(rows: DataFrame, manual: DataFrame) -> DataFrame:
    """Overrides language_group by sample_id; overridden rows get source manual, confidence high, no review."""
    m = manual.select("sample_id", F.col("language_group").alias("__m"))
    j = rows.join(m, "sample_id", "left")
    hit = F.col("__m").isNotNull()
    return j.withColumns({"group_source": F.when(hit, F.lit("manual")).otherwise(F.col("group_source")), "group_confidence": F.when(hit, F.lit("high")).otherwise(F.col("group_confidence")), "needs_group_review": ~hit & F.col("needs_group_review"), "language_group": F.coalesce("__m", "language_group")}).drop("__m")


def manual_audit(rows: DataFrame, manual: DataFrame) -> DataFrame:
    """(sample_id, problem): rows for review that nobody labelled, and manual labels for rows that aren't there or need none."""
    need = rows.where("needs_group_review").select("sample_id", F.lit(True).alias("need"))
    j = need.join(manual.select("sample_id", F.lit(True).alias("given")), "sample_id", "full_outer")
    return j.where("need IS NULL OR given IS NULL").select("sample_id", F.when(F.col("given").isNull(), F.lit("missing")).otherwise(F.lit("extra")).alias("problem"))
