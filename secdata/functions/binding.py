"""Values that an expression uses often, computed once, and patterns behind the literals that they need."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

try:
    from re import _constants as C
    from re import _parser as P
except ImportError:  # Python 3.10
    import sre_constants as C
    import sre_parse as P

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` names it. Inside a condition Spark would compute it at each place, and nested uses make an expression grow exponentially."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _needs(parsed) -> set[str] | None:
    """Literals of which each match has one at least: the set whose shortest literal is longest over the parts of a sequence; None if there is none."""
    found, run = [], ""
    for op, arg in parsed:
        if op is C.LITERAL:
            run += chr(arg)
            continue
        if run:
            found.append({run})
            run = ""
        if op is C.SUBPATTERN:
            inner = _needs(arg[-1])
        elif op is C.BRANCH:
            each = [_needs(b) for b in arg[1]]
            inner = None if None in each else set().union(*each)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] > 0:
            inner = _needs(arg[2])
        else:
            inner = None
        if inner:
            found.append(inner)
    if run:
        found.append({run})
    return max(found, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def literals(pattern: str, ignore_case: bool = False) -> list[str] | None:
    """Strings of which every text that the pattern matches contains at least one (in lower case with ``ignore_case``); None if the pattern tells none."""
    found = _needs(P.parse(pattern, re.M))
    return sorted({x.lower() if ignore_case else x for x in found}) if found else None


def meets(text: Column, pattern: str, flags: str, lower: Column | None = None) -> Column:
    """``text`` has a match of the pattern under the inline flags. The pattern is run only on texts with a literal that it needs, which a plain byte search finds. ``lower``, the text in
    lower case, is given where case is ignored."""
    needed = literals(pattern, lower is not None)
    match = text.rlike(f"(?{flags}){pattern}")
    if not needed:
        return match
    return reduce(lambda a, b: a | b, [F.contains(text if lower is None else lower, F.lit(x)) for x in needed]) & match
