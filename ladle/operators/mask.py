"""T7 MASK_RANGE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.plans.recipe import RecipeError, as_list, same_columns, step


def _char_class(alphabet: list[str]) -> str:
    """Characters masked inside the range: letters and digits always;
    whitespace and symbols only when their class is listed."""
    names = {a.upper() for a in alphabet}
    ws, sym = "WHITESPACE" in names, "SYMBOLS" in names
    if ws and sym:
        return r"(?s)."
    if sym:
        return r"\S"
    if ws:
        return r"[\p{L}\p{N}\s]"
    return r"[\p{L}\p{N}]"


def mask_first_n(c: Column, n: int, symbol: str = "#", alphabet: list[str] | None = None) -> Column:
    """Replace masked characters among the first ``n`` with ``symbol``; length kept."""
    text = c.cast("string")
    head = F.substring(text, 1, n)
    repl = symbol.replace("\\", "\\\\").replace("$", "\\$")
    masked = F.regexp_replace(head, _char_class(alphabet or []), repl)
    return F.concat(masked, F.substring(text, n + 1, 2147483647))


@step("MASK_RANGE", kind="expr", writes=same_columns, kinds={"alphabet": "list"})
def _mask_range_step(df, ctx, sourceColumns, maskMode="MASK_FIRST_N", firstN=None, stop=None,
                     maskSymbol="#", alphabet=None, **_):
    if str(maskMode).upper() != "MASK_FIRST_N":
        raise RecipeError(f"MASK_RANGE: unsupported maskMode {maskMode!r}")
    n = int(firstN if firstN is not None else stop)
    return {c: mask_first_n(F.col(c), n, maskSymbol, as_list(alphabet)) for c in as_list(sourceColumns)}
