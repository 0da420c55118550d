"""Name helpers: user account -> full name, header normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _cap_first(s: Column) -> Column:
    # upper-case the first character only; the rest is kept as is
    return F.concat(F.upper(s.substr(1, 1)), s.substr(F.lit(2), F.length(s) - 1))


def account_fullname(account) -> Column:
    """``first.last`` -> ``First Last``.

    Split at the first dot; both parts get a capital first letter (the rest is
    untouched, so ``rob.mcDonald`` -> ``Rob McDonald``). Without a dot, or
    with an empty first part, only the second part is used: ``admin`` ->
    ``Admin``, ``.smith`` -> ``Smith``. ``mark.`` gives ``Mark `` (trailing
    space) and ``a.b.c`` gives ``A B.c``.
    """
    a = F.col(account) if isinstance(account, str) else account
    dot = F.instr(a, ".")
    first = _cap_first(a.substr(F.lit(1), dot - 1))
    last = _cap_first(a.substr(dot + 1, F.length(a)))
    return F.when(first == "", last).otherwise(F.concat(first, F.lit(" "), last))


def normalize_header(name: str) -> str:
    """Lower-case a column header, ``/`` and space become ``_``."""
    return str(name).lower().replace("/", "_").replace(" ", "_")

