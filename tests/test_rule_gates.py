"""Rule patterns behind the literals that they need, against the patterns alone."""

import re

from pyspark.sql import functions as F

from secdata.functions import language_rules as L
from secdata.functions import rules
from secdata.functions.binding import literals, meets

TEXTS = [
    "#include <stdio.h>\nstruct a *p; unsigned int n; /* x */\nint main(void) { char *p = NULL; p->q = 1; return 0; }\n",
    "import java.util.List;\n@Override\npublic static void main(String[] a) throws IOException { System.out.println(new Foo()); }\n",
    "def f(self):\n    if self.x is None:\n        raise ValueError('bad')\n    print(True)\n",
    "package main\nfunc main() {\n if err != nil { defer x() }\n y := 1\n fmt.Println(y)\n}\n",
    "pub fn main() { let mut s = String::new(); s.unwrap() }\nuse std::io;\nimpl Foo { }\n",
    "template <class T> class A : public B { std::vector<T> v; virtual ~A(); bool ok = true; operator[](int); };\nnamespace x { }\n",
    "<?php foreach ($a as $b) { echo $this->x; } public function f($y) { isset($z); }\n",
    "@interface A\n- (void) f { NSString *s = @\"x\"; [a b]; }\n@end YES\n",
    "const x = require('y'); module.exports = (a) => { console.log(typeof a === 'b'); };\n",
    "fix SQL Injection and XSS; Use-After-Free, out of bounds read, TOCTOU race condition, weak cipher, KKLR unhandled exception",
    "memcpy(dst, src, n); kfree(p); lock(m); if (x == NULL) goto out; a[i + 1] = sizeof(y) * 2; SELECT 1; open(\"../x\");",
    "café :string x;\n:string y = 1; string z;\n", "", "\n\n", "éè 한국어 _ * ( [",
]


def test_every_match_has_a_needed_literal():
    patterns = [(p, False) for signs in [*L.FAMILIES.values(), L.CPP, L.OBJC] for _, p in signs] + [(p, True) for p, _ in [*rules.TEXT_STRONG, *rules.TEXT_WEAK, *rules.CODE_PATTERNS]]
    hits = 0
    for pattern, fold in patterns:
        needed = literals(pattern, fold)
        for text in TEXTS:
            if needed and re.search(pattern, text, re.M | re.A | (re.I if fold else 0)):
                hits += 1
                assert any(x in (text.lower() if fold else text) for x in needed), (pattern, text)
    assert hits > 100
    assert literals(r"a+(bc|de)?f{2}") == ["f"] or literals(r"a+(bc|de)?f{2}") == ["a"]
    assert literals(r"\w+|x") is None and literals(r"(?:ab|cde)\s") == ["ab", "cde"] and literals("Foo[Bb]ar", True) == ["foo"]


def test_gated_patterns_match_as_the_patterns_alone(spark):
    docs = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "text string")
    code = [p for signs in [L.FAMILIES["C/C++"], L.FAMILIES["PHP"], L.FAMILIES["TypeScript"], L.CPP] for _, p in signs]
    apart = [F.count_if(~meets(F.col("text"), p, "md").eqNullSafe(F.col("text").rlike(f"(?md){p}"))) for p in code]
    apart += [F.count_if(~meets(F.col("text"), p, "i", F.lower("text")).eqNullSafe(F.col("text").rlike(f"(?i){p}"))) for p, _ in [*rules.TEXT_STRONG, *rules.CODE_PATTERNS]]
    assert set(docs.agg(*[c.alias(f"c{i}") for i, c in enumerate(apart)]).first()) == {0}


def test_detection_by_plain_scores(spark):
    """The detected family and score are those of all patterns tried one by one."""
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").select("i", L.detect_language(F.col("text")).alias("d")).collect()
    for row in rows:
        text = TEXTS[row.i].strip()
        scores = {f: sum(w for w, p in signs if re.search(p, text, re.M | re.A)) for f, signs in L.FAMILIES.items()}
        best = max(scores, key=scores.get)  # the first of the largest
        if len(text) < L.MIN_CODE or not scores[best]:
            assert row.d is None, row
        else:
            assert (row.d.family, row.d.score, row.d.margin) == (best, scores[best], scores[best] - sorted(scores.values())[-2]), row
