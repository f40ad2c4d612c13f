"""Programming-language detection by weighted patterns, file names and links, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from secdata.functions import normalize as N
from secdata.functions.binding import let, meets

# Language of a file extension.
EXTENSIONS = {
    "c": "C",
    "h": "C/C++",
    "cc": "C++", "cpp": "C++", "cxx": "C++", "hpp": "C++", "hh": "C++", "hxx": "C++", "c++": "C++", "h++": "C++", "ipp": "C++", "tpp": "C++", "inl": "C++",
    "m": "Objective-C",
    "mm": "Objective-C++",
    "java": "Java",
    "py": "Python", "pyw": "Python", "pyx": "Python", "pxd": "Python",
    "js": "JavaScript", "jsx": "JavaScript", "mjs": "JavaScript", "cjs": "JavaScript",
    "ts": "TypeScript", "tsx": "TypeScript",
    "php": "PHP", "phtml": "PHP", "php3": "PHP", "php4": "PHP", "php5": "PHP", "inc": "PHP",
    "go": "Go",
    "kt": "Kotlin", "kts": "Kotlin",
    "rb": "Ruby", "rake": "Ruby",
    "cs": "C#",
    "swift": "Swift",
    "rs": "Rust",
    "scala": "Scala",
    "lua": "Lua",
    "pl": "Perl", "pm": "Perl", "pod": "Perl", "t": "Perl",
    "sh": "Shell", "bash": "Shell", "zsh": "Shell",
    "s": "Assembly", "asm": "Assembly",
    "erl": "Erlang", "hrl": "Erlang",
    "ex": "Elixir", "exs": "Elixir",
    "dart": "Dart",
    "groovy": "Groovy",
    "clj": "Clojure",
    "hs": "Haskell",
    "ml": "OCaml",
    "r": "R",
    "vb": "Visual Basic",
    "f": "Fortran", "f90": "Fortran",
    "d": "D",
    "nim": "Nim",
    "zig": "Zig",
}
# Margins from which a family's detection confirms, overrides or decides a group.
CONFIRM = {"C/C++": 0, "Java": 0, "Go": 0, "Python": 3, "Ruby": 3, "C#": 6, "Rust": 6, "JavaScript": 8, "PHP": 26}
OVERRIDE = {"C/C++": 3, "Java": 3, "Python": 4, "Ruby": 5, "Go": 1, "Rust": 6, "C#": 8, "JavaScript": 14, "PHP": 26}
GROUP = {"C/C++": 1, "Java": 0, "Go": 0, "Python": 3, "Ruby": 3, "C#": 6, "Rust": 6, "JavaScript": 10, "PHP": 26}
# Weight and pattern of each family's signs.
FAMILIES = {
    "C/C++": [
        (5, r"^\s*#\s*include\s*[<\"]"), (3, r"^\s*#\s*(define|ifdef|ifndef|endif|pragma)\b"), (3, r"\bstruct\s+\w+\s*\*"), (3, r"\b(unsigned|signed)\s+(char|int|long|short)\b"), (3, r"\b(size_t|uint\d+_t|int\d+_t|u8|u16|u32|u64)\b"),
        (2, r"\bNULL\b"), (3, r"\bsizeof\s*\("), (3, r"\b(malloc|calloc|realloc|free|memcpy|memset|strlen|strcmp)\s*\("), (2, r"^\s*(static|extern|inline)\s+\w+"), (2, r"\bgoto\s+\w+\s*;"), (2, r"\bchar\s*\*"), (2, r"\bvoid\s*\*"),
        (2, r"\b(int|void|char|long|short|float|double)\s+\**\w+\s*\("), (2, r"\b(int|unsigned|char|void|long|short|float|double|size_t)\s+\**\w+\s*[,)]"), (2, r"\b\w+_[tT]\s+\**\w+\s*[,);=]"), (2, r"\b\w+Ptr\s+\w+\s*[,);=]"),
        (3, r"^\s*\w+\s+\*+\w+\s*[;,=)]"), (3, r"\(\s*\w+\s+\*+\w+\s*[,)]"), (3, r",\s*\w+\s+\*+\w+\s*[,)]"), (5, r"\bstd::"), (4, r"\b\w+::~?\w+\s*\("), (4, r"\bthis->\w+"), (4, r"\)\s*const\s*(\{|$)"), (3, r"\bconst\s+\w+\s*&\s*\w+"),
        (4, r"^\s*(inline|virtual|explicit|static)\s+\w+.*::"),
    ],
    "JavaScript": [
        (4, r"\bfunction\s*\w*\s*\([^)]*\)\s*\{"), (4, r"\b(var|let|const)\s+\w+\s*="), (4, r"=>\s*\{"), (5, r"\brequire\s*\(\s*['\"]"), (5, r"\bmodule\.exports\b"), (2, r"\bthis\.\w+\s*="), (5, r"\.prototype\.\w+"), (4, r"===|!=="),
        (3, r"\btypeof\s+\w+"), (3, r"\bundefined\b"), (3, r"\b(async\s+function|await\s+\w+)"), (4, r"\bnew\s+Promise\b"), (4, r"\bconsole\.(log|error|warn)\b"), (3, r"\bJSON\.(parse|stringify)\b"),
    ],
    "Java": [
        (6, r"^\s*import\s+java(x)?\."), (4, r"^\s*package\s+[\w\.]+\s*;"), (6, r"@Override\b"), (4, r"\b(public|private|protected)\s+(static\s+)?(final\s+)?(void|int|boolean|String|long|double)\b"), (4, r"\bString\s*\[\]\s*\w+"),
        (5, r"\bSystem\.(out|err)\."), (2, r"\bnew\s+[A-Z]\w*\s*\("), (4, r"\bthrows\s+\w*Exception\b"), (3, r"\bextends\s+\w+|\bimplements\s+\w+"), (2, r"\bfinal\s+\w+\s+\w+\s*="),
    ],
    "Python": [
        (6, r"^\s*def\s+\w+\s*\([^)]*\)\s*:"), (5, r"^\s*class\s+\w+\s*(\([^)]*\))?\s*:"), (4, r"^\s*(from\s+[\w\.]+\s+)?import\s+\w+"), (4, r"\bself\.\w+"), (3, r"^\s*(if|for|while|try|else|elif|except|with)\b[^{]*:\s*$"), (3, r"\b(True|False|None)\b"),
        (2, r"^\s*@\w+\s*$"), (1, r"\bprint\s*\("), (3, r"\braise\s+\w*(Error|Exception)\b"),
    ],
    "PHP": [
        (8, r"<\?php"), (5, r"\$\w+\s*="), (8, r"\$this\s*->"), (6, r"\bfunction\s+\w+\s*\([^)]*\$"), (4, r"\becho\s+[\$'\"]"), (2, r"\barray\s*\(|\[\s*['\"]\w+['\"]\s*\]\s*="), (5, r"\bpublic\s+function\b"), (6, r"\b(isset|unset|empty)\s*\(\s*\$"), (6, r"\bforeach\s*\(\s*\$"),
    ],
    "Go": [(6, r"^\s*func\s+(\(\s*\w+\s+\*?\w+\s*\)\s*)?\w+\s*\("), (5, r":="), (5, r"^\s*package\s+\w+\s*$"), (6, r"\bif\s+err\s*!=\s*nil\b"), (2, r"\bnil\b"), (3, r"^\s*import\s*\("), (4, r"\bdefer\s+\w+"), (4, r"\bfmt\.\w+")],
    "Ruby": [(5, r"^\s*def\s+\w+[?!]?\s*(\([^)]*\))?\s*$"), (4, r"^\s*end\s*$"), (3, r"@\w+\s*="), (5, r"\bdo\s*\|\w+"), (3, r"\brequire\s+['\"]"), (2, r"\bnil\b"), (2, r"\.each\b|\.map\b"), (5, r"^\s*(attr_accessor|attr_reader|module)\b")],
    "C#": [
        (8, r"^\s*using\s+System"), (3, r"^\s*using\s+[\w\.]+\s*;"), (4, r"^\s*namespace\s+[\w\.]+"), (2, r"\bpublic\s+(sealed\s+|partial\s+|abstract\s+)?class\b"), (5, r"(?<!:)\bstring\s+\w+\s*[=;,)]"), (6, r"\bvar\s+\w+\s*=\s*new\b"),
        (8, r"\{\s*get\s*;\s*(private\s+)?set\s*;\s*\}"), (6, r"\bConsole\.\w+"), (5, r"\b(readonly|internal|sealed)\s+\w+"), (2, r"\boverride\s+\w+"), (7, r"\bforeach\s*\(\s*var\b"), (3, r"\bobject\s+\w+\s*[=;,)]"), (3, r"\?\?"), (5, r"\bIEnumerable\s*<"),
    ],
    "TypeScript": [
        (7, r"^\s*(export\s+)?interface\s+\w+\s*\{"), (6, r"(?<!:):\s*(string|number|boolean|any|unknown)\b"), (6, r"^\s*(export\s+)?type\s+\w+\s*="), (6, r"\b(private|public|protected|readonly)\s+\w+\s*:"), (4, r"^\s*import\s+.*\bfrom\s+['\"]"),
        (4, r"\bexport\s+(default\s+|const\s+|function\s+|class\s+)"), (5, r"\bas\s+(string|number|any|unknown)\b"), (5, r"\benum\s+\w+\s*\{"),
    ],
    "Scala": [
        (5, r"^\s*(case\s+)?class\s+\w+\s*\("), (5, r"^\s*(private\s+|protected\s+)?def\s+\w+.*[:=]"), (7, r"\bval\s+\w+\s*[:=]"), (3, r"\bvar\s+\w+\s*:\s*\w+\s*="), (7, r"^\s*object\s+\w+"), (6, r"^\s*(trait|sealed)\s+\w+"), (2, r"=>\s*\w+|\bmatch\s*\{"),
        (6, r"\bOption\[|\bSeq\[|\bList\["), (8, r"^\s*import\s+scala\."),
    ],
    "Rust": [(6, r"^\s*(pub\s+)?fn\s+\w+"), (6, r"\blet\s+mut\b"), (5, r"\bimpl\s+\w+"), (4, r"(?::|->)\s*&(?:'\w+\s+)?str\b|\bString::"), (2, r"\bmatch\s+\w+\s*\{"), (5, r"\bOption<|\bResult<"), (4, r"\bunwrap\(\)|\bexpect\("), (3, r"^\s*use\s+[\w:]+;")],
    "Perl": [(5, r"^\s*sub\s+\w+\s*\{"), (6, r"\bmy\s+[\$@%]\w+"), (3, r"[\$@%]\w+\s*="), (5, r"=~\s*[ms]?/"), (6, r"\buse\s+strict\b"), (4, r"\bqw\s*\(")],
    "Swift": [(5, r"^\s*(public\s+|private\s+)?func\s+\w+"), (4, r"\blet\s+\w+\s*(:|=)"), (4, r"\bvar\s+\w+\s*:\s*\w+"), (5, r"\bguard\s+\w+"), (6, r"\bimport\s+(Foundation|UIKit|Swift)"), (2, r"\?\?|\w+?\.")],
}
CPP = [
    (6, r"\bstd::"), (6, r"\btemplate\s*<"), (6, r"^\s*namespace\s+\w+|\busing\s+namespace\b"), (5, r"\b(public|private|protected)\s*:"), (6, r"\bnullptr\b"), (5, r"\bclass\s+\w+\s*(:\s*(public|private|protected)\s+\w+)?\s*\{"), (4, r"\b\w+::\w+"),
    (5, r"\bvirtual\s+\w+"), (5, r"\boperator\s*(\[\]|\(\)|[-+*/=<>!]+)\s*\("), (4, r"\bnew\s+\w+(\s*\[|\s*\(|\s*;)"), (5, r"\bdelete\s+(\[\]\s*)?\w+"), (4, r"\bcatch\s*\(|\bthrow\s+\w+"), (6, r"\b(static_cast|dynamic_cast|reinterpret_cast|const_cast)\s*<"),
    (4, r"\b(constexpr|explicit|friend|typename|mutable)\b"), (2, r"\bbool\s+\w+\s*=\s*(true|false)\b"), (1, r"&\s*\w+\s*[,)]"),
]
OBJC = [(8, r"^\s*[-+]\s*\(\s*\w+\s*\**\s*\)\s*\w+"), (8, r"@(interface|implementation|end|property|synthesize)\b"), (3, r"\[\s*\w+\s+\w+(:|\s*\])"), (6, r"\bNS(String|Array|Dictionary|Object|Error)\b"), (5, r"@\"[^\"]*\""), (2, r"\bnil\b|\bYES\b|\bNO\b")]
# Words that say nothing about a language.
STOP_WORDS = [
    "the", "and", "for", "not", "int", "char", "void", "long", "float", "double", "short", "unsigned", "signed", "const", "static", "return", "sizeof", "struct", "union", "enum", "typedef", "else",
    "while", "break", "continue", "switch", "case", "default", "goto", "null", "true", "false", "NULL", "TRUE", "FALSE", "if", "do", "new", "delete", "this", "self", "def", "end", "class", "public",
    "private", "protected", "function", "var", "let", "value", "data", "size", "len", "buf", "buffer", "result", "error", "err", "ret", "res", "tmp", "temp", "index", "count", "num", "str", "string",
    "name", "type", "flags", "flag", "state", "status", "code", "get", "set", "add", "remove", "init", "free", "alloc", "read", "write", "open", "close", "start", "stop", "next", "prev", "first",
    "last", "list", "item", "node", "head", "tail", "key", "val", "out", "in", "off", "offset", "ptr", "pos", "end_", "max", "min", "args", "argv", "argc",
]
MAX_CODE, MIN_CODE, MAX_TOKENS = 20_000, 30, 5_000
FAMILY = {"C": "C/C++", "C++": "C/C++", "Objective-C": "C/C++", "Objective-C++": "C/C++"}


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _extension_map() -> Column:
    return _map(EXTENSIONS)


def language_family(language: Column) -> Column:
    """C, C++ and C/C++ as one family."""
    return F.when(language.isin("C", "C++"), F.lit("C/C++")).otherwise(language)


def family_of(language: Column) -> Column:
    """As language_family, with Objective-C and Objective-C++ in the C family too."""
    return F.when(language.isin(*FAMILY), F.lit("C/C++")).otherwise(language)


def normalize_extension(ext: Column) -> Column:
    last = F.element_at(F.split(F.lower(N.strip(N.present(ext))), "/"), -1)
    return F.nullif(N.strip(F.element_at(F.split(F.regexp_replace(last, r"^\.+", ""), r"\."), -1)), F.lit(""))


def extension_from_filename(name: Column) -> Column:
    return let(F.element_at(F.split(N.strip(name), "/"), -1), lambda base: F.when(base.contains("."), normalize_extension(F.element_at(F.split(base, r"\."), -1))))


def language_from_extension(ext: Column) -> Column:
    return F.try_element_at(_extension_map(), normalize_extension(ext))


def language_from_path(path: Column) -> Column:
    return F.try_element_at(_extension_map(), extension_from_filename(path))


def language_from_commit_link(link: Column) -> Column:
    """From the file path that some hosts put between /commit/ and the query."""
    decoded = F.coalesce(F.try_url_decode(link), link)
    path = F.regexp_extract(decoded, r"/commit/([^?#]+?)(?:\?|#|$)", 1)
    return F.when(path != "", language_from_path(path))


def family_from_commit_message(message: Column) -> Column:
    """The family of the files that a message mentions, null unless it is one."""
    names = F.regexp_extract_all(message, F.lit(r"[\w][\w/\-\.]*\.[A-Za-z0-9\+]{1,6}\b"), F.lit(0))
    families = F.array_distinct(F.filter(F.transform(names, lambda n: let(language_from_path(n), language_family)), lambda f: f.isNotNull()))
    return let(families, lambda f: F.when(F.size(f) == 1, f[0]))


def _url(link: Column) -> tuple[Column, Column, Column]:
    text = N.strip(link)
    host = F.lower(F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    path = F.regexp_extract(text, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return host, F.filter(F.split(path, "/"), lambda s: s != ""), query


def repo_key(link: Column) -> Column:
    """host/owner/repo on the large hosts, host/project for gitweb's p=, else host and the path before a commit marker or up to '.git'; null without a host."""
    host, parts, query = _url(link)
    large = host.rlike(r"github\.com|gitlab\.com|bitbucket\.org") & (F.size(parts) >= 2)
    named = F.regexp_extract(query, r"p=([^;&]+)", 1)
    marks = F.array(*[F.lit(m) for m in ("commit", "commitdiff", "diff", "patch", "log", "tree", "blob")])
    stops = F.transform(parts, lambda s, i: F.when(F.array_contains(marks, s), i).when(s.endswith(".git"), i + 1))
    cut = F.coalesce(F.get(F.filter(stops, lambda x: x.isNotNull()), F.lit(0)), F.size(parts))
    path = F.regexp_replace(F.array_join(F.slice(parts, 1, F.greatest(cut, F.lit(1))), "/"), r"\.git$", "")
    key = F.when(large, F.concat_ws("/", host, F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).when(named != "", F.concat_ws("/", host, named)).when(F.size(parts) > 0, F.concat_ws("/", host, path)).otherwise(host)
    return F.when(host != "", F.lower(key))


def project_key(link: Column) -> Column:
    """The last part of repo_key, without '.git'."""
    parts = F.filter(F.split(F.regexp_replace(repo_key(link), r"\.git\b", ""), "[/;]"), lambda s: s != "")
    return F.when(F.size(parts) > 0, F.element_at(parts, -1))


def project_key_ownerrepo(link: Column) -> Column:
    """owner/repo: the first two parts of the path."""
    _, parts, _ = _url(link)
    return F.when(F.size(parts) >= 2, F.lower(F.array_join(F.slice(parts, 1, 2), "/")))


def _score(code: Column, signs: list[tuple[int, str]]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(meets(code, p, "md"), F.lit(w)).otherwise(F.lit(0)) for w, p in signs])


def detect_language(code: Column) -> Column:
    """struct<language, family, score, margin, runner_up> of the family whose signs weigh most (ties: the order of FAMILIES); null for short or unknown code."""
    def scored(text: Column) -> Column:
        each = F.array(*[F.struct(_score(text, signs).alias("score"), F.lit(-i).alias("order"), F.lit(f).alias("family")) for i, (f, signs) in enumerate(FAMILIES.items())])
        return let(F.reverse(F.array_sort(each)), lambda ranked: chosen(text, ranked[0], ranked[1]))

    def chosen(text: Column, best: Column, second: Column) -> Column:
        in_c = let(F.struct(_score(text, OBJC).alias("objc"), _score(text, CPP).alias("cpp")), lambda s: F.when((s["objc"] >= 8) & (s["objc"] > s["cpp"]), F.lit("Objective-C")).when(s["cpp"] >= 8, F.lit("C++")).otherwise(F.lit("C")))
        language = F.when(best["family"] != "C/C++", best["family"]).otherwise(in_c)
        made = F.struct(language.alias("language"), best["family"].alias("family"), best["score"].alias("score"), (best["score"] - second["score"]).alias("margin"), F.when(second["score"] > 0, second["family"]).alias("runner_up"))
        return F.when(best["score"] > 0, made)

    return let(N.strip(code), lambda whole: F.when(F.length(whole) >= MIN_CODE, let(F.substring(whole, 1, MAX_CODE), scored)))


def detect_with_agreement(before: Column, after: Column) -> Column:
    """struct<language, family, margin, agreement> from two detections: null if their families differ; the margin is the smaller one."""
    stronger = F.when(before["margin"] >= after["margin"], before["language"]).otherwise(after["language"])
    both = F.struct(stronger.alias("language"), before["family"].alias("family"), F.least(before["margin"], after["margin"]).alias("margin"), F.lit(True).alias("agreement"))
    single = F.coalesce(before, after)
    one = F.struct(single["language"].alias("language"), single["family"].alias("family"), single["margin"].alias("margin"), F.lit(False).alias("agreement"))
    return F.when(before.isNotNull() & after.isNotNull(), F.when(before["family"] == after["family"], both)).when(single.isNotNull(), one)


def best_of(before: Column, after: Column) -> Column:
    """The detection with the larger margin, before on ties."""
    return F.when(after.isNull() | (before["margin"] >= after["margin"]), before).otherwise(after)


def is_confident(family: Column, margin: Column, thresholds: dict[str, int]) -> Column:
    return F.coalesce(margin >= F.try_element_at(_map(thresholds), family), F.lit(False))


def get_confidence(score: Column, margin: Column, agreement: bool) -> Column:
    (s1, m1), (s2, m2) = ((0.55, 0.15), (0.30, 0.08)) if agreement else ((0.70, 0.20), (0.50, 0.12))
    return F.when((score >= s1) & (margin >= m1), F.lit("high")).when((score >= s2) & (margin >= m2), F.lit("medium")).otherwise(F.lit("low"))


def combine_predictions(before: Column, after: Column) -> Column:
    """struct<language, language_family, score, margin, confidence, agree, exact_agree, decision, review> from two predictions struct<language, score, margin>, either of which may be null."""
    return let(F.struct(before.alias("before"), after.alias("after")), lambda both: _combined(both["before"], both["after"]))


def _combined(before: Column, after: Column) -> Column:
    def made(p: Column, score, margin, confidence, agree: bool, exact: bool, decision: str) -> Column:
        review = F.lit(decision.startswith("disagree_")) | (confidence == "low") | (p["language"] == "Unknown")
        return F.struct(p["language"].alias("language"), language_family(p["language"]).alias("language_family"), score.alias("score"), margin.alias("margin"), confidence.alias("confidence"), F.lit(agree).alias("agree"), F.lit(exact).alias("exact_agree"), F.lit(decision).alias("decision"), review.alias("review"))

    def alone(p: Column, decision: str) -> Column:
        return made(p, p["score"], p["margin"], get_confidence(p["score"], p["margin"], False), False, False, decision)

    def lowered(p: Column, decision: str) -> Column:
        c = get_confidence(p["score"], p["margin"], False)
        return made(p, p["score"], p["margin"], F.when(c == "high", F.lit("medium")).otherwise(c), False, False, decision)

    score, margin = (before["score"] + after["score"]) / 2, (before["margin"] + after["margin"]) / 2
    agreed = get_confidence(score, margin, True)
    first = before["score"] + before["margin"] >= after["score"] + after["margin"]
    same_family = language_family(before["language"]) == language_family(after["language"])
    nothing = F.struct(F.lit("Unknown").alias("language"), F.lit("Unknown").alias("language_family"), F.lit(0.0).alias("score"), F.lit(0.0).alias("margin"), F.lit("low").alias("confidence"), F.lit(False).alias("agree"), F.lit(False).alias("exact_agree"), F.lit("no_prediction").alias("decision"), F.lit(True).alias("review"))
    return (
        F.when(before.isNull() & after.isNull(), nothing)
        .when(after.isNull(), alone(before, "before_only"))
        .when(before.isNull(), alone(after, "after_only"))
        .when(before["language"] == after["language"], made(before, score, margin, agreed, True, True, "before_after_exact_agree"))
        .when(same_family & first, made(before, score, margin, agreed, True, False, "before_after_family_agree_choose_before"))
        .when(same_family, made(after, score, margin, agreed, True, False, "before_after_family_agree_choose_after"))
        .when(first, lowered(before, "disagree_choose_before"))
        .otherwise(lowered(after, "disagree_choose_after"))
    )


def tokenize(code: Column) -> Column:
    """Distinct identifiers of three characters or more in the first 5000 characters, without stop words in either case."""
    found = F.array_distinct(F.regexp_extract_all(F.substring(code, 1, MAX_TOKENS), F.lit(r"[A-Za-z_][A-Za-z0-9_]{2,}"), F.lit(0)))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return N.no_strings(F.filter(F.array_except(found, stop), lambda t: ~F.array_contains(stop, F.lower(t))))
