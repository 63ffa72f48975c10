"""Feature catalogue: what each feature is, independent of how Spark computes it.

Three kinds of features (names and definitions in ``catalogue.yml``):

* :class:`Aggregate` - ``sum(added) - sum(subtracted)`` over accounts, null read as 0;
* :class:`Ratio` - ``numerator / denominator`` of two other features, null on a zero
  or null denominator;
* :class:`Custom` - a registered formula over this year's and last year's accounts,
  nulls propagate (see :mod:`tallyframe.operators.formulas`).

A second, flat dialect (:class:`ConfigFeature`) is a signed sum of accounts,
optionally divided by another signed sum; accounts ending in ``_1y`` or
``_ly`` are last year's.

Catalogues are plain driver-side metadata (a few hundred entries); they are
compiled into ``Column`` expressions, never shipped as data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from tallyframe.operators.formulas import formula_inputs, registered_formulas

HERE = Path(__file__).resolve().parent
DEFAULT_CATALOGUE = HERE / "catalogue.yml"
EXAMPLE_RATIO_CONFIG = HERE / "ratio_config.yml"

# Function names of the three feature kinds in a catalogue written in
# the name -> {func, args} dialect.
FUNC_AGGREGATE = "calculate_financial_aggregate"
FUNC_RATIO = "calculate_financial_ratio"
FUNC_CUSTOM = "calculate_custom_financial_ratio"

# Suffixes that mark a last-year account in the flat config dialect.
LAST_YEAR_SUFFIXES = ("_1y", "_ly")


@dataclass(frozen=True)
class Aggregate:
    name: str
    added: tuple[str, ...]
    subtracted: tuple[str, ...] = ()
    kind: str = field(default="aggregate", init=False)


@dataclass(frozen=True)
class Ratio:
    name: str
    numerator: str
    denominator: str
    kind: str = field(default="ratio", init=False)


@dataclass(frozen=True)
class Custom:
    name: str
    required: tuple[str, ...]
    shifted: tuple[str, ...] = ()
    kind: str = field(default="custom", init=False)

    def inputs(self) -> tuple[list[str], list[str]]:
        """(this year's, last year's) accounts its formula reads; the declared ones while none is registered."""
        return formula_inputs(self.name) if self.name in registered_formulas() else (list(self.required), list(self.shifted))


@dataclass(frozen=True)
class ConfigFeature:
    """Flat dialect: ``signed(numerator, neg_numerator) [/ signed(denominator, neg_denominator)]``."""
    name: str
    numerator: tuple[str, ...] = ()
    neg_numerator: tuple[str, ...] = ()
    denominator: tuple[str, ...] = ()
    neg_denominator: tuple[str, ...] = ()
    kind: str = field(default="config", init=False)

    @property
    def has_denominator(self) -> bool:
        return bool(self.denominator or self.neg_denominator)

    def columns(self) -> list[str]:
        return [*self.numerator, *self.neg_numerator, *self.denominator, *self.neg_denominator]


Feature = Aggregate | Ratio | Custom

_DEFAULT: "Catalog | None" = None


def is_last_year(column: str) -> bool:
    return column.endswith(LAST_YEAR_SUFFIXES)


def base_account(column: str) -> str:
    """``X_1y`` / ``X_ly`` -> ``X``; other names unchanged."""
    return column[:-3] if is_last_year(column) else column


class Catalog:
    """Ordered, validated mapping name -> feature."""

    def __init__(self, features: Iterable[Feature]):
        self._features: dict[str, Feature] = {}
        for f in features:
            if f.name in self._features:
                raise ValueError(f"duplicate feature name {f.name!r}")
            self._features[f.name] = f
        self._check_acyclic()

    # -- loading ---------------------------------------------------------------
    @classmethod
    def default(cls) -> Catalog:
        """The shipped 474-feature catalogue (parsed once per process; catalogues are immutable)."""
        global _DEFAULT
        if _DEFAULT is None:
            _DEFAULT = cls.from_yaml(DEFAULT_CATALOGUE)
        return _DEFAULT

    @classmethod
    def from_yaml(cls, path: str | Path) -> Catalog:
        """Read either our compact layout or the name -> {func, args} dialect."""
        with open(path) as fh:
            doc = yaml.load(fh, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
        if isinstance(doc, Mapping) and {"aggregates", "ratios", "custom"} & set(doc):
            return cls.from_compact(doc)
        return cls.from_func_dialect(doc)

    @classmethod
    def from_compact(cls, doc: Mapping) -> Catalog:
        feats: list[Feature] = []
        for name, (added, subtracted) in (doc.get("aggregates") or {}).items():
            feats.append(Aggregate(name, tuple(added or ()), tuple(subtracted or ())))
        for name, (num, den) in (doc.get("ratios") or {}).items():
            feats.append(Ratio(name, num, den))
        for name, (required, shifted) in (doc.get("custom") or {}).items():
            feats.append(Custom(name, tuple(required or ()), tuple(shifted or ())))
        return cls(feats)

    @classmethod
    def from_func_dialect(cls, doc: Mapping) -> Catalog:
        """Catalogue in the name -> {func, args: {...}} dialect."""
        feats: list[Feature] = []
        for name, spec in doc.items():
            func, args = spec["func"], spec.get("args") or {}
            if func == FUNC_AGGREGATE:
                feats.append(Aggregate(name, tuple(args.get("added_accounts") or ()),
                                       tuple(args.get("subtracted_accounts") or ())))
            elif func == FUNC_RATIO:
                feats.append(Ratio(name, args["numerator_column_name"], args["denominator_column_name"]))
            elif func == FUNC_CUSTOM:
                feats.append(Custom(name, tuple(args.get("required_columns") or ()),
                                    tuple(args.get("columns_to_shift") or ())))
            else:
                raise ValueError(f"feature {name!r}: unknown func {func!r}")
        return cls(feats)

    # -- access ----------------------------------------------------------------
    def __iter__(self):
        return iter(self._features.values())

    def __len__(self) -> int:
        return len(self._features)

    def __contains__(self, name: str) -> bool:
        return name in self._features

    def __getitem__(self, name: str) -> Feature:
        return self._features[name]

    @property
    def names(self) -> list[str]:
        return list(self._features)

    def of_kind(self, kind: str) -> list[Feature]:
        return [f for f in self if f.kind == kind]

    def subset(self, names: Iterable[str]) -> list[Feature]:
        return [self[n] for n in names]

    def family(self, prefix: str, kind: str = "ratio") -> list[str]:
        """Names of features of ``kind`` whose name starts with ``prefix`` (e.g. ``"DC_"``)."""
        return [f.name for f in self if f.kind == kind and f.name.startswith(prefix)]

    # -- dependencies ----------------------------------------------------------
    def parents(self, name: str) -> list[str]:
        f = self[name]
        return [f.numerator, f.denominator] if isinstance(f, Ratio) else []

    def raw_dependencies(self, name: str) -> set[str]:
        """Accounts a feature reads, through ratio parents; unknown parents count as accounts."""
        f = self[name]
        if isinstance(f, Aggregate):
            return set(f.added) | set(f.subtracted)
        if isinstance(f, Custom):
            current, previous = f.inputs()
            return set(current) | set(previous)
        deps: set[str] = set()
        for parent in self.parents(name):
            deps |= self.raw_dependencies(parent) if parent in self else {parent}
        return deps

    def current_dependencies(self, name: str) -> set[str]:
        """Accounts a feature reads for the current year."""
        f = self[name]
        if isinstance(f, Aggregate):
            return set(f.added) | set(f.subtracted)
        if isinstance(f, Custom):
            return set(f.inputs()[0])
        out: set[str] = set()
        for parent in self.parents(name):
            out |= self.current_dependencies(parent) if parent in self else {parent}
        return out

    def shifted_dependencies(self, name: str) -> set[str]:
        """Accounts a feature also reads for the previous year."""
        f = self[name]
        if isinstance(f, Custom):
            return set(f.inputs()[1])
        out: set[str] = set()
        for parent in self.parents(name):
            if parent in self:
                out |= self.shifted_dependencies(parent)
        return out

    def closure(self, names: Iterable[str]) -> list[str]:
        """``names`` plus every catalogue feature they are computed from, in catalogue order."""
        names = list(names)
        unknown = [n for n in names if n not in self]
        if unknown:
            raise KeyError(f"not found in catalogue: {unknown}")
        need: set[str] = set()
        stack = names
        while stack:
            n = stack.pop()
            if n in need:
                continue
            need.add(n)
            # A parent outside the catalogue is a raw column, read as is.
            stack.extend(p for p in self.parents(n) if p in self)
        return [n for n in self.names if n in need]

    def accounts(self, names: Iterable[str] | None = None) -> list[str]:
        """Sorted accounts read by ``names`` (default: all features)."""
        names = self.names if names is None else names
        out: set[str] = set()
        for n in names:
            out |= self.raw_dependencies(n)
        return sorted(out)

    def shifted_accounts(self, names: Iterable[str] | None = None) -> list[str]:
        names = self.names if names is None else names
        out: set[str] = set()
        for n in names:
            out |= self.shifted_dependencies(n)
        return sorted(out)

    def _check_acyclic(self) -> None:
        state: dict[str, int] = {}

        def visit(n: str, path: list[str]) -> None:
            if state.get(n) == 2 or n not in self._features:
                return
            if state.get(n) == 1:
                raise ValueError("cycle in catalogue: " + " -> ".join(path + [n]))
            state[n] = 1
            for p in self.parents(n):
                visit(p, path + [n])
            state[n] = 2

        for n in self._features:
            visit(n, [])


def load_ratio_config(source: str | Path | Mapping) -> list[ConfigFeature]:
    """Flat dialect: ``{features: {name: {numerator, neg_numerator, denominator, neg_denominator}}}``."""
    if not isinstance(source, Mapping):
        with open(source) as fh:
            source = yaml.safe_load(fh)
    feats = source.get("features", source)
    out = []
    for name, spec in feats.items():
        spec = spec or {}
        out.append(ConfigFeature(
            name,
            tuple(spec.get("numerator") or ()), tuple(spec.get("neg_numerator") or ()),
            tuple(spec.get("denominator") or ()), tuple(spec.get("neg_denominator") or ()),
        ))
    return out


def config_columns(features: Iterable[ConfigFeature]) -> tuple[list[str], list[str]]:
    """(this-year accounts, last-year accounts) read by a flat config, each sorted."""
    cols: set[str] = set()
    for f in features:
        cols.update(f.columns())
    current = sorted(c for c in cols if not is_last_year(c))
    last_year = sorted({base_account(c) for c in cols if is_last_year(c)})
    return current, last_year
