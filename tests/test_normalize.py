from pyspark.sql import functions as F

from secdata.functions import language_rules as L
from secdata.functions import normalize as N
from secdata.functions import rules


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()[0]


def test_labels(spark):
    assert one(spark, "cwe-089", N.normalize_cwe) == ["CWE-89"]
    assert one(spark, "CWE-94,CWE-94", N.normalize_cwe) == ["CWE-94"]
    assert one(spark, "CWE-416, CWE-284, CWE-264", N.normalize_cwe) == ["CWE-416", "CWE-284", "CWE-264"]
    assert one(spark, "NVD-CWE-noinfo", N.normalize_cwe) == []
    assert one(spark, None, N.normalize_cwe) == []
    assert one(spark, "CVE-2014-3176, ", N.normalize_cve) == ["CVE-2014-3176"]
    assert one(spark, " NaN ", N.present) is None


def test_commit_links(spark):
    sha = "a" * 39 + "b"
    for link, expected in [
        (f"https://github.com/o/r/commit/{sha}", sha),
        (f"https://github.com/o/r/commit/{sha[:9]}.patch", sha[:9]),
        (f"https://gitlab.com/o/r/-/commit/{sha}", sha),
        (f"https://android.googlesource.com/p/+/{sha}", sha),
        (f"https://git.php.net/?p=php-src.git;a=commit;h={sha}", sha),
        (f"https://git.kernel.org/linux.git/commit/?id={sha}", sha),
        (f"https://x.org/{sha}", None),
        (f"https://x.org/commit?x={sha}&y={'c' * 40}", None),
        (f"https://x.org/view?about=commit&x={sha}", sha),
        ("", None),
        (None, None),
    ]:
        assert one(spark, link, N.extract_commit_sha) == expected, link
    assert one(spark, f"(cherry picked from commit {sha})\nFixes: {'d' * 40}", N.extract_alt_shas) == [sha]


def test_repo_keys(spark):
    assert one(spark, "https://git.kernel.org/cgit/linux/kernel/git/torvalds/linux.git/commit/?id=1", L.repo_key) == "git.kernel.org/cgit/linux/kernel/git/torvalds/linux"
    assert one(spark, "https://github.com/torvalds/linux/commit/1", L.project_key) == "linux"
    assert one(spark, "nothing", L.repo_key) is None


def test_rules(spark):
    assert one(spark, "A NULL pointer dereference", rules.predict_from_description)["cwe"] == "CWE-476"
    assert one(spark, "buffer overflow", rules.predict_from_description) is None
    assert one(spark, "CWE-787", rules.group_of) == "mem_spatial"


def test_detect_language(spark):
    code = "#include <stdio.h>\nint main(void) {\n  char *p = NULL;\n  return sizeof(p);\n}\n"
    assert one(spark, code, L.detect_language)["language"] == "C"
    assert one(spark, "def f(self):\n    return self.x is None and True\n", L.detect_language)["language"] == "Python"
    assert one(spark, "short", L.detect_language) is None
