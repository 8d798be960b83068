"""Table contracts: what a landing file must look like and how it is loaded."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import types as T

from intake.functions.casts import INT_TYPES
from intake.operators.rules import CORRUPT, Castable, IntCastable, NotNull, Rule, WellFormed

ON_VIOLATION = ("quarantine", "drop", "fail")
ON_DUPLICATE = ("skip", "report", "error")

# The classic landing format (headerless, positional).
DELIMITER = ";"
LANDING_COLUMNS = ("id", "name", "datetime", "department_id", "job_id")
LANDING_INT_COLUMNS = ("id", "department_id", "job_id")
LANDING_TEXT_COLUMNS = ("name", "datetime")

#: Encodings that Spark's reader takes; those with several bytes for a line end need the whole file at once.
ENCODINGS = ("UTF-8", "US-ASCII", "ISO-8859-1")
WIDE_ENCODINGS = ("UTF-16", "UTF-16BE", "UTF-16LE", "UTF-32")

#: Columns that steps add to a table's own; these, and all names that begin with ``_``, are not for contracts.
RESERVED = ("reasons", "verdict", "raw_line", "batch_id", "n_in_batch", "in_target")


@dataclass(frozen=True)
class Field:
    """A landing column and the type it gets in the serving table."""

    name: str
    data_type: str = "string"


@dataclass(frozen=True)
class TableContract:
    """Columns, rules and key of a table, and how its landing files are written.

    With ``multi_line`` a quoted value may hold line ends; such a file is one task's work, so land
    large ones in parts. ``line_sep`` is the one character that ends a line there; without
    it the first line end found in a file is taken for the file's own. ``escape`` stands before a quote in a
    quoted value; a quote itself doubles it.
    """

    name: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    on_violation: str = "quarantine"
    on_duplicate: str = "skip"
    delimiter: str = DELIMITER
    file_glob: str | None = None
    max_records_per_file: int = 0
    encoding: str = "UTF-8"
    multi_line: bool = False
    line_sep: str | None = None
    escape: str = "\\"

    def __post_init__(self):
        if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", self.name):
            raise ValueError(f"table name {self.name!r} is not a plain identifier")
        names = self.columns
        if len({c.lower() for c in names}) != len(names):
            raise ValueError(f"{self.name}: a column is declared twice")
        taken = [c for c in names if c.lower() in RESERVED or c.startswith("_")]
        if taken:
            raise ValueError(f"{self.name}: the names {taken} are reserved for helper columns")
        unknown = {
            c
            for c in (*self.key, *self.order_by, *(r.column for r in self.rules))
            if c not in names and c != CORRUPT
        }
        if unknown:
            raise ValueError(f"{self.name}: undeclared columns {sorted(unknown)}")
        if self.encoding not in ENCODINGS + WIDE_ENCODINGS:
            raise ValueError(f"{self.name}: encoding must be one of {ENCODINGS + WIDE_ENCODINGS}")
        if self.encoding in WIDE_ENCODINGS and not self.multi_line:
            raise ValueError(f"{self.name}: {self.encoding} is read with multi_line only")
        if self.line_sep is not None and len(self.line_sep) != 1 or len(self.escape) != 1:
            raise ValueError(f"{self.name}: line_sep and escape are one character each")
        if self.on_violation not in ON_VIOLATION:
            raise ValueError(f"{self.name}: on_violation must be one of {ON_VIOLATION}")
        if self.on_duplicate not in ON_DUPLICATE:
            raise ValueError(f"{self.name}: on_duplicate must be one of {ON_DUPLICATE}")
        # A null key never matches another key, so it must be refused as a
        # violation before de-duplication sees it.
        checked = {r.column for r in self.rules if isinstance(r, (NotNull, IntCastable))}
        if set(self.key) - checked:
            raise ValueError(
                f"{self.name}: key columns {sorted(set(self.key) - checked)} "
                "need a NotNull or IntCastable rule"
            )

    @cached_property
    def checks(self) -> tuple[tuple[str, Rule], ...]:
        """Every rule with its reason: those declared, then one for each typed field.

        Rule and projection cast alike, so an accepted value is never loaded as null. A reason
        that stands twice gets a number.
        """
        types = {f.name: f.data_type for f in self.fields}
        rules = [
            replace(r, data_type=types[r.column])
            if isinstance(r, IntCastable) and types[r.column] in INT_TYPES
            else r
            for r in self.rules
        ]
        cast = {r.column for r in rules if isinstance(r, IntCastable) and types[r.column] in INT_TYPES}
        rules += [
            Castable(f.name, f.data_type, self.mode_of(f.name))
            for f in self.fields
            if f.data_type != "string" and f.name not in cast
        ]
        named, seen = [], {}
        for rule in rules:
            seen[rule.reason] = n = seen.get(rule.reason, 0) + 1
            named.append((rule.reason if n == 1 else f"{rule.reason}#{n}", rule))
        return tuple(named)

    @property
    def wants_raw_line(self) -> bool:
        return any(isinstance(r, WellFormed) for r in self.rules)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def landing_schema(self) -> T.StructType:
        """Everything arrives as text."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType.fromDDL(
            ", ".join(f"`{f.name}` {f.data_type}" for f in self.fields)
        )

    @property
    def glob(self) -> str:
        """Files of this table: its name, then anything, then ``.csv``."""
        return self.file_glob or f"{self.name}{{.,.*.}}[cC][sS][vV]"

    def mode_of(self, column: str) -> str:
        """Cast mode of a column, as declared by its rule."""
        for rule in self.rules:
            if isinstance(rule, IntCastable) and rule.column == column:
                return rule.mode
        return "lenient"

    def but(self, **changes) -> TableContract:
        return replace(self, **changes)


def landing_contract(
    name: str, mode: str = "lenient", typed: bool = False, well_formed: bool = True, **options
) -> TableContract:
    """Contract of the classic five-column landing file, keyed by ``id``.

    ``typed=False`` keeps every column as text in the serving table too. Lines of
    another width are violations, unless ``well_formed=False`` says otherwise.
    """
    int_type = "int" if typed else "string"
    time_type = "timestamp_ntz" if typed else "string"
    types = {c: int_type for c in LANDING_INT_COLUMNS} | {"datetime": time_type}
    rules = [IntCastable(c, mode) for c in LANDING_INT_COLUMNS]
    rules += [NotNull(c) for c in LANDING_TEXT_COLUMNS]
    rules += [WellFormed()] if well_formed else []
    defaults = {"rules": tuple(rules), "key": ("id",)}
    return TableContract(
        name=name,
        fields=tuple(Field(c, types.get(c, "string")) for c in LANDING_COLUMNS),
        **(defaults | options),
    )


def contract_for(contracts: Mapping[str, TableContract], table: str) -> TableContract:
    """Look a table up by name; an undeclared table is an error."""
    if table not in contracts:
        known = ", ".join(sorted(contracts)) or "none"
        raise ValueError(f"no contract for table {table!r} (declared: {known})")
    return contracts[table]


def by_name(contracts: Iterable[TableContract]) -> dict[str, TableContract]:
    return {c.name: c for c in contracts}
