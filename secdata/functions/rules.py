"""Ordered rule tables over text, and the expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secdata.functions.binding import let, meets

# Fixed values: (rule, pattern, CWE, accuracy in percent); the first that matches wins.
DESCRIPTION_RULES = [
    ("null_deref", r"null\s*(?:pointer\s*)?(?:dereference|deref)", "CWE-476", 76.8),
    ("use_after_free", r"use[\s-]?after[\s-]?free", "CWE-416", 71.0),
    ("double_free", r"double[\s-]free", "CWE-415", 73.6),
    ("oob_write", r"out[\s-]of[\s-]bounds?\s+write", "CWE-787", 68.9),
    ("oob_read", r"out[\s-]of[\s-]bounds?\s+read|buffer\s+over[\s-]?read|over[\s-]?read", "CWE-125", 78.2),
    ("xss", r"cross[\s-]site\s+scripting|\bxss\b", "CWE-79", 95.3),
    ("sqli", r"sql\s+injection", "CWE-89", 98.4),
    ("csrf", r"cross[\s-]site\s+request\s+forgery|\bcsrf\b", "CWE-352", 92.3),
    ("path_traversal", r"(?:directory|path)\s+traversal", "CWE-22", 91.8),
    ("integer_overflow", r"integer\s+overflow", "CWE-190", 62.5),
    ("div_by_zero", r"divide[\s-]by[\s-]zero|division\s+by\s+zero", "CWE-369", 84.4),
    ("race", r"race\s+condition", "CWE-362", 86.0),
    ("format_string", r"format\s+string", "CWE-134", 77.8),
    ("ssrf", r"server[\s-]side\s+request\s+forgery|\bssrf\b", "CWE-918", 94.1),
    ("open_redirect", r"open\s+redirect", "CWE-601", 89.5),
]
COARSE_RULE = ("buffer_overflow_coarse", r"buffer\s+overflow|heap[\s-]based\s+buffer|stack[\s-]based\s+buffer", "CWE-119", 45.0)

# Mechanism groups by pattern over message and description (strong, weak) and over code.
TEXT_STRONG = [
    (r"sql injection|sqli\b|prepared statement|parameteri[sz]ed quer", "injection"),
    (r"cross[- ]site scripting|\bxss\b|html escap|innerhtml", "injection"),
    (r"out[- ]of[- ]bounds|buffer over(flow|read|run)|overread|oob[ _-]?(read|write)|heap overflow|stack overflow|bounds check|off[- ]by[- ]one|array index|index out of", "mem_spatial"),
    (r"deseriali[sz]|unsafe (pickle|yaml|unmarshal)|object injection|prototype pollution|gadget chain", "injection"),
    (r"path traversal|directory traversal|\.\./|zip[- ]slip|symlink attack|arbitrary file (read|write|overwrite)|canonical path", "path_file"),
    (r"use[- ]after[- ]free|double[- ]free|dangling pointer|freed memory|after free|premature free", "mem_lifetime"),
    (r"memory leak|resource leak|leak(s|ed|ing)? (memory|fd|file descriptor|handle)|not freed|fail(s|ed)? to free", "mem_lifetime"),
    (r"integer overflow|integer underflow|signed(ness)? (error|issue)|wrap[- ]?around|divide by zero|division by zero|truncat\w+", "numeric"),
    (r"\bssrf\b|server[- ]side request forgery|\bcsrf\b|cross[- ]site request forgery|open redirect|session fixation|clickjacking", "web_session"),
    (r"null[- ]pointer|null deref|nullptr|dereferenc\w* null|check for null|missing null", "null_deref"),
    (r"race condition|data race|toctou|time[- ]of[- ]check|deadlock|concurren\w+|not (thread|atomic)|missing lock", "concurrency"),
]
TEXT_WEAK = [
    (r"\btls\b|\bssl\b|certificate (validation|verif)|weak (cipher|hash|random)|predictable|insecure random|constant[- ]time|timing attack|signature verif", "crypto"),
    (r"permission check|privilege escalation|access control|authoriz\w+|unauthori[sz]ed|missing (auth|permission)|bypass.{0,20}(auth|check|restriction)", "access_control"),
    (r"information (leak|disclosure|exposure)|sensitive (data|information)|expose\w* .{0,15}(memory|kernel|address)|kaslr", "info_exposure"),
    (r"authentication|credential|password|login bypass|session (token|hijack)|api key", "access_control"),
    (r"error handling|return value (not|un)checked|ignore\w* (error|return)|assertion failure|reachable assert|unhandled exception", "error_handling"),
    (r"uninitiali[sz]ed|not initiali[sz]ed|garbage value", "mem_lifetime"),
    (r"input validation|missing check|sanity check|malformed input", "mem_spatial"),
]
_COPY = "memcpy|memmove|strcpy|strcat|sprintf|vsprintf|bcopy|wcscpy|strncpy|snprintf|copy_from_user|copy_to_user|alloca"
CODE_PATTERNS = [
    (rf"\b({_COPY})\s*\(", "mem_spatial"),
    (r"\b(SSL|TLS|EVP_|RSA|AES|SHA|MD5|HMAC|cipher|encrypt|decrypt|X509)\w*", "crypto"),
    (r"\b(SELECT|INSERT|UPDATE|DELETE|WHERE|query|execute|prepare)\b", "injection"),
    (r"\b(open|fopen|realpath|readlink|basename|dirname|mkdir|unlink|rename|chdir)\s*\(|\.\./", "path_file"),
    (r"\b(lock|unlock|mutex|spin_lock|atomic|rcu_|synchronized|pthread)\w*", "concurrency"),
    (r"\b(capable|permission|allow|deny|access|priv|uid|gid|role|admin|auth)\w*", "access_control"),
    (r"\b(free|kfree|vfree|g_free|release|unref|dispose|destroy)\s*[\(\s]", "mem_lifetime"),
    (r"(==\s*NULL|!=\s*NULL|is\s+None|==\s*null|!=\s*null)", "null_deref"),
    (r"(\+|\*|<<)\s*(sizeof|[0-9]+)|\boverflow\b", "numeric"),
    (r"\[\s*[a-z_][a-z0-9_]*\s*(\+|-|\*)", "mem_spatial"),
    (r"\b(errno|goto\s+(err|fail|out|cleanup)|assert|BUG_ON|WARN_ON)\b", "error_handling"),
]
COPY_API = rf"\b({_COPY}|CopyMemory|RtlCopyMemory)\s*\("

# Mechanism group of a CWE number; numbers that name a category, and numbers that tell no mechanism.
GROUP_CWES = {
    "mem_spatial": [125, 787, 119, 120, 121, 122, 123, 124, 126, 127, 128, 129, 131, 170, 193, 680, 786, 788, 805, 806, 823, 843],
    "mem_lifetime": [416, 415, 401, 399, 404, 457, 459, 590, 626, 665, 666, 672, 761, 762, 763, 772, 824, 825, 908, 909, 911, 1341],
    "null_deref": [476, 690],
    "numeric": [190, 191, 189, 194, 195, 196, 197, 369, 466, 681, 682, 1339],
    "injection": [74, 77, 78, 79, 80, 88, 89, 90, 91, 93, 94, 96, 113, 116, 117, 134, 150, 159, 172, 173, 176, 184, 185, 228, 235, 444, 470, 502, 565, 611, 913, 915, 917, 918, 943, 1236, 1321],
    "path_file": [22, 23, 29, 36, 41, 59, 61, 73, 98, 377, 378, 379, 426, 427, 428, 434, 552, 620, 641],
    "access_control": [250, 264, 266, 269, 270, 271, 273, 275, 276, 280, 281, 284, 285, 287, 288, 290, 294, 303, 305, 306, 307, 425, 521, 522, 639, 640, 732, 749, 798, 842, 862, 863, 1187],
    "web_session": [346, 352, 384, 601, 613, 942, 1021, 1275],
    "crypto": [295, 297, 310, 311, 312, 319, 320, 321, 322, 323, 325, 326, 327, 328, 330, 331, 335, 337, 338, 344, 345, 347, 354, 358, 759, 760, 916],
    "concurrency": [362, 364, 365, 366, 367, 543, 662, 667, 833, 1088, 1223],
    "dos_resource": [400, 405, 406, 407, 409, 606, 674, 770, 774, 776, 789, 834, 835, 920, 1050, 1333],
    "error_handling": [241, 248, 252, 253, 388, 390, 391, 393, 436, 460, 617, 636, 670, 684, 696, 703, 704, 705, 706, 754, 755, 1077],
    "info_exposure": [200, 203, 208, 209, 212, 213, 215, 226, 359, 402, 497, 524, 526, 532, 534, 538, 668, 922, 924, 1258],
    "input_validation": [20, 1173, 1284, 1287],
}
IMPRECISE = [16, 17, 18, 19, 20, 21, 119, 189, 254, 255, 264, 284, 310, 399, 404, 664, 668, 674, 691, 693, 703, 707, 710, 834, 1103, 1173]
NO_MECHANISM = [16, 17, 18, 19, 20, 21, 254, 255, 388, 664, 691, 693, 707, 710, 1103, 1173, 1284, 1287]


def predict_from_description(text: Column, coarse: bool = False) -> Column:
    """struct<cwe, rule, accuracy> of the first rule that the text meets, else null. ``coarse`` adds the generic overflow rule at the end."""
    rules = [*DESCRIPTION_RULES, *([COARSE_RULE] if coarse else [])]
    return F.coalesce(*[F.when(text.rlike(f"(?i){p}"), F.struct(F.lit(cwe).alias("cwe"), F.lit(name).alias("rule"), F.lit(acc).alias("accuracy"))) for name, p, cwe, acc in rules])


def first_match(patterns: list[tuple[str, str]], text: Column) -> Column:
    """The value of the first pattern that the text meets, in any case, else null."""
    def found(t: Column) -> Column:
        return F.coalesce(*[F.when(meets(t["text"], p, "i", t["lower"]), F.lit(g)) for p, g in patterns])

    return let(F.struct(text.alias("text"), F.lower(text).alias("lower")), found)


def cwe_number(cwe: Column) -> Column:
    return F.replace(F.upper(F.trim(cwe)), F.lit("CWE-"), F.lit("")).try_cast("int")


def group_of(cwe: Column) -> Column:
    """The mechanism group of a CWE, ``other`` if it has none."""
    n = cwe_number(cwe)
    found = F.lit(None).cast("string")
    for group in reversed(GROUP_CWES):
        found = F.when(n.isin(GROUP_CWES[group]), F.lit(group)).otherwise(found)
    return F.coalesce(found, F.lit("other"))


def is_precise(cwe: Column) -> Column:
    return F.coalesce(~cwe_number(cwe).isin(IMPRECISE), F.lit(False))


def informative(cwe: Column) -> Column:
    return F.coalesce(~cwe_number(cwe).isin(NO_MECHANISM), F.lit(False)) & (group_of(cwe) != "other")


def split_cwes(value: Column) -> Column:
    """The CWE names of a list joined by ';' or ',', trimmed, upper case, in order without repeats; [] for null."""
    names = F.transform(F.split(value, "[;,]"), lambda x: F.upper(F.trim(x)))
    return F.coalesce(F.array_distinct(F.filter(names, lambda x: x.startswith("CWE-"))), F.array().cast("array<string>"))


def split_memory(group: Column, code: Column) -> Column:
    """mem_spatial as mem_copy if a copying call stands in the first 6000 characters, else as mem_index."""
    copies = F.coalesce(F.substring(code, 1, 6000).rlike(f"(?i){COPY_API}"), F.lit(False))
    return F.when(group != "mem_spatial", group).when(copies, F.lit("mem_copy")).otherwise(F.when(group.isNotNull(), F.lit("mem_index")))
