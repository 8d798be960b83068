"""Validation rules: each one names a column, a reason and a test.

A rule's ``violated(slot)`` is a boolean Column that is never null, so rules can be
counted, collected into an array of reasons or negated into a filter. ``slot`` is the
rule's place in its contract; helper columns are named by it, so that two rules of
one kind on one column stay apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.functions.casts import int_cast, quoted, typed_value

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Rule:
    column: str

    kind = "rule"

    @property
    def reason(self) -> str:
        return f"{self.kind}:{self.column}"

    def violated(self, slot: int = 0) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class NotNull(Rule):
    """The value must be present (an empty landing field is null)."""

    kind = "null"

    def violated(self, slot: int = 0) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class IntCastable(Rule):
    """The value must be present and an int, or of the integer type its field declares."""

    mode: str = "lenient"
    data_type: str = "int"

    kind = "not_int"

    def violated(self, slot: int = 0) -> Column:
        return int_cast(self.column, self.mode, self.data_type).isNull()


@dataclass(frozen=True)
class Castable(Rule):
    """A present value must fit the type of its field; implied for every typed field."""

    data_type: str = "string"
    mode: str = "lenient"

    @property
    def reason(self) -> str:
        return f"not_{self.data_type}:{self.column}"

    def violated(self, slot: int = 0) -> Column:
        value = typed_value(self.column, self.data_type, self.mode)
        return F.col(quoted(self.column)).isNotNull() & value.isNull()


@dataclass(frozen=True)
class InSet(Rule):
    """A present value must be one of a short list kept in the contract."""

    allowed: tuple[str, ...] = ()

    kind = "not_in_set"

    def violated(self, slot: int = 0) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~F.coalesce(c.isin(*self.allowed), F.lit(False))


@dataclass(frozen=True)
class WellFormed(Rule):
    """The line must have exactly the declared number of fields.

    Spark refuses a query of a text file that uses the raw line and no other
    column, so a bare count of these violations needs a declared column beside it.
    """

    column: str = CORRUPT

    kind = "malformed"

    @property
    def reason(self) -> str:
        return self.kind

    def violated(self, slot: int = 0) -> Column:
        return F.col(CORRUPT).isNotNull()


@dataclass(frozen=True)
class Decoded(Rule):
    """A present value must not hold U+FFFD, which stands for bytes that the contract's encoding does not know."""

    kind = "undecoded"

    def violated(self, slot: int = 0) -> Column:
        return F.coalesce(F.col(self.column).contains("\ufffd"), F.lit(False))


@dataclass(frozen=True, eq=False)
class References(Rule):
    """A present value must exist as ``key`` in the ``dimension`` table.

    ``attach`` joins the distinct dimension keys once. No broadcast hint: Spark
    broadcasts a dimension that is under its own size threshold and shuffles a
    larger one, where adaptive execution splits a hot value.
    """

    dimension: DataFrame = None
    key: str = ""
    data_type: str = "int"
    mode: str = "lenient"

    kind = "no_reference"

    def attach(self, df: DataFrame, slot: int = 0) -> DataFrame:
        key = f"try_cast({quoted(self.key)} AS {self.data_type})"
        keys = (
            self.dimension.select(F.expr(key).alias(f"_ref_value_{slot}"))
            .where(F.col(f"_ref_value_{slot}").isNotNull())
            .distinct()
            .withColumn(f"_ref_found_{slot}", F.lit(True))
        )
        value = typed_value(self.column, self.data_type, self.mode)
        return df.withColumn(f"_ref_value_{slot}", value).join(keys, f"_ref_value_{slot}", "left")

    def detach(self, df: DataFrame, slot: int = 0) -> DataFrame:
        return df.drop(f"_ref_value_{slot}", f"_ref_found_{slot}")

    def violated(self, slot: int = 0) -> Column:
        return F.col(self.column).isNotNull() & F.col(f"_ref_found_{slot}").isNull()
