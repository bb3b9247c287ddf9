"""Recipe model, step registry and application.

A recipe is a JSON list of ``{"Action": {"Operation": ..., "Parameters":
{...}}}``.  Every parameter value arrives as a *string*; lists and maps
are JSON text inside that string.  Which parameters these are is part of an
operation's registration, so a pattern may begin with a bracket and a value
may be ``True``.  We decode on the driver, check every
step (operation, parameters, keys, and its columns against those the steps
before it leave) before the first job, and then fold the steps into one
DataFrame.  Most of it is lazy; steps that need a first pass over the data
(group sizes, ranks) run it while the plan is built.

Steps come in two kinds:

* expression steps return ``{column: Column}``; neighbouring expression
  steps are fused into one ``withColumns`` projection unless a later one
  reads a column an earlier one writes;
* frame steps return a new DataFrame (grouping, joins, filters).
"""

from __future__ import annotations

import inspect
import json
from dataclasses import dataclass, field, replace
from typing import Any, Callable

from pyspark.sql import Column, DataFrame

_REGISTRY: dict[str, "_StepDef"] = {}


class RecipeError(ValueError):
    """Raised on the driver, before any job starts."""


@dataclass(frozen=True)
class _StepDef:
    name: str
    fn: Callable[..., Any]
    kind: str  # "expr" or "frame"
    reads: Callable[[dict], list[str]]
    writes: Callable[[dict, list[str]], list[str] | None]
    kinds: dict[str, str] = field(default_factory=dict)


#: Parameters that mean the same in every operation.
COMMON_KINDS = {"sourceColumns": "list", "groupByColumns": "list"}
KINDS = ("text", "list", "map", "flag")


def _unknown(params: dict, columns: list[str]) -> None:
    return None


def same_columns(params: dict, columns: list[str]) -> list[str]:
    return columns


def target_column(params: dict, columns: list[str]) -> list[str]:
    return [*columns, *as_list(params.get("targetColumn"))]


def step(name: str, kind: str = "frame", reads: Callable[[dict], list[str]] | None = None,
         writes: Callable[[dict, list[str]], list[str] | None] = _unknown, kinds: dict[str, str] | None = None):
    """Register ``fn(df, ctx, **params)`` as recipe operation ``name``.

    ``kinds``: how to decode its parameters, by name: ``list`` (JSON list, or
    one text), ``map`` (JSON object), ``flag`` (true or false).  All others are
    text and reach ``fn`` as they are written, whatever they begin with.

    ``reads``: the columns it needs.  ``writes``: the columns it leaves, from
    its parameters and those before it, so a recipe can be checked without
    running it; None (the default) means only the data can tell, and the
    columns of later steps are checked when they are applied.
    """

    unknown = set((kinds or {}).values()) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown kinds {sorted(unknown)}; expected some of {KINDS}")

    def deco(fn):
        _REGISTRY[name] = _StepDef(name, fn, kind, reads or source_columns, writes, {**COMMON_KINDS, **(kinds or {})})
        return fn

    return deco


def registered_operations() -> list[str]:
    _load_builtin_steps()
    return sorted(_REGISTRY)


@dataclass
class RecipeContext:
    """Run-time inputs a recipe needs but must not carry in its text.

    ``secrets`` maps a secret id / key id to raw key bytes (callers fetch
    them from their secret store).  ``seed`` drives the random steps so a
    retried task recomputes the same values.
    """

    secrets: dict[str, bytes] = field(default_factory=dict)
    seed: int = 42
    day_first_when_ambiguous: bool = False
    options: dict[str, Any] = field(default_factory=dict)
    # Operation names after which the frame is checkpointed (reliable
    # checkpoint in spark.checkpoint.dir) to cut a long lineage.
    checkpoint_after: tuple[str, ...] = ()
    # Place of the step being applied; random steps seed with it.
    step_index: int = 0

    def secret(self, key_id: str) -> bytes:
        if key_id not in self.secrets:
            raise RecipeError(f"no key material supplied for {key_id!r}")
        return self.secrets[key_id]


@dataclass(frozen=True)
class Step:
    operation: str
    params: dict[str, Any]

    @staticmethod
    def from_action(action: dict) -> "Step":
        body = action.get("Action", action)
        op = body.get("Operation")
        if not op:
            raise RecipeError(f"step without Operation: {action!r}")
        raw = body.get("Parameters", {}) or {}
        _load_builtin_steps()
        kinds = _REGISTRY[op].kinds if op in _REGISTRY else {}  # an unknown operation is refused when checked
        return Step(op, {k: decode_param(v, kinds.get(k, "text"), f"{op}: {k}") for k, v in raw.items()})


@dataclass(frozen=True)
class Recipe:
    steps: tuple[Step, ...] = ()

    def __len__(self):
        return len(self.steps)


def decode_param(value: Any, kind: str | None = None, what: str = "parameter") -> Any:
    """One string parameter by its kind (``step``); without one, by its looks: JSON lists/maps, booleans, else text."""
    if not isinstance(value, str) or kind == "text":
        return value
    text = value.strip()
    if kind == "flag" or (kind is None and text.lower() in ("true", "false")):
        if text.lower() not in ("true", "false"):
            raise RecipeError(f"{what} must be true or false, not {value!r}")
        return text.lower() == "true"
    if kind == "map" and not text:
        return {}
    if kind == "map" or text[:1] == "[" or (kind is None and text[:1] == "{"):
        try:
            got = json.loads(text)
        except json.JSONDecodeError as err:
            raise RecipeError(f"{what}: bad JSON {value!r}: {err}") from None
        if kind is not None and not isinstance(got, dict if kind == "map" else list):
            raise RecipeError(f"{what} must be a JSON {'object' if kind == 'map' else 'list'}, not {value!r}")
        return got
    return value


def parse_recipe(source: str | list | Recipe | None) -> Recipe:
    """JSON text, a parsed list, or None (= empty recipe = identity)."""
    if source is None:
        return Recipe()
    if isinstance(source, Recipe):
        return source
    if isinstance(source, (str, bytes)):
        text = source.decode() if isinstance(source, bytes) else source
        source = json.loads(text) if text.strip() else []
    if not isinstance(source, list):
        raise RecipeError("a recipe is a JSON list of steps")
    return Recipe(tuple(Step.from_action(a) for a in source))


def as_list(value: Any) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def source_columns(params: dict) -> list[str]:
    cols = as_list(params.get("sourceColumns")) + as_list(params.get("sourceColumn"))
    cols += as_list(params.get("groupByColumns"))
    return [c for c in cols if isinstance(c, str)]


def _check_columns(st: Step, sdef: _StepDef, columns: list[str]) -> None:
    missing = [c for c in sdef.reads(st.params) if c not in columns]
    if missing:
        raise RecipeError(f"{st.operation}: unknown column(s) {missing}; have {sorted(set(columns))}")


def validate(columns: list[str], recipe: str | list | Recipe | None, ctx: "RecipeContext | None" = None) -> None:
    """Check every step of a recipe on column names alone; no job runs."""
    _load_builtin_steps()
    known: list[str] | None = list(columns)
    for st in parse_recipe(recipe).steps:
        if st.operation not in _REGISTRY:
            raise RecipeError(f"unknown operation {st.operation!r}")
        sdef = _REGISTRY[st.operation]
        try:
            inspect.signature(sdef.fn).bind(None, ctx, **st.params)
        except TypeError as err:
            raise RecipeError(f"{st.operation}: {err}") from None
        for name in ("secretId", "kmsKeyArn"):
            if ctx is not None and st.params.get(name) is not None:
                ctx.secret(st.params[name])
        for name in ("firstN", "lowerBound", "upperBound", "topX"):
            if name in st.params and not str(st.params[name]).strip().lstrip("+-").isdigit():
                raise RecipeError(f"{st.operation}: {name} must be a whole number, not {st.params[name]!r}")
        if known is not None:
            _check_columns(st, sdef, known)
            known = sdef.writes(st.params, known)


def _load_builtin_steps() -> None:
    # Importing the operator modules registers their steps.
    from ladle.operators import (category, crypto, dates, flag, group, impute,  # noqa: F401
                                 mask, randomize)


def apply_recipe(df: DataFrame, recipe: str | list | Recipe | None,
                 ctx: RecipeContext | None = None) -> DataFrame:
    """Apply the steps in list order (checked first); returns one DataFrame."""
    _load_builtin_steps()
    ctx = ctx or RecipeContext()
    rec = parse_recipe(recipe)
    validate(df.columns, rec, ctx)

    pending: dict[str, Column] = {}

    def flush(frame: DataFrame) -> DataFrame:
        if not pending:
            return frame
        out = frame.withColumns(dict(pending))
        pending.clear()
        return out

    for i, st in enumerate(rec.steps):
        sdef = _REGISTRY[st.operation]
        ctx = replace(ctx, step_index=i)
        reads = set(sdef.reads(st.params))
        if pending and reads & set(pending):
            df = flush(df)
        _check_columns(st, sdef, [*df.columns, *pending])
        if sdef.kind == "expr":
            exprs = sdef.fn(df, ctx, **st.params)
            if set(exprs) & set(pending):
                df = flush(df)
            pending.update(exprs)
        else:
            df = flush(df)
            df = sdef.fn(df, ctx, **st.params)
        if st.operation in ctx.checkpoint_after:
            from ladle.session import checkpoint_root
            df = flush(df)
            checkpoint_root(df.sparkSession)
            df = df.checkpoint(eager=True)
    return flush(df)


def load_recipe(spark, location: str | None) -> Recipe:
    """Read a recipe file from any Hadoop-supported location.

    No location, or an empty file, is the empty recipe (identity).  A recipe
    file is small; it is read as one whole-text row.
    """
    if not location:
        return Recipe()
    row = spark.read.option("wholetext", True).text(location).first()
    return parse_recipe(row[0] if row else "")
