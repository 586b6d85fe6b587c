"""Table specifications: what a row element holds and how its columns are typed."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tagloom.errors import IngestError
from tagloom.functions import convert as cv


@dataclass(frozen=True)
class Kind:
    """A column type: its Spark type, its conversion and the rule a bad value breaks.

    `convert` takes trimmed text and gives NULL for NULL. `minds_space` says that it
    could take untrimmed text for another value than the trimmed text.
    """

    name: str
    data_type: T.DataType
    convert: Callable[[Column], Column]
    fault: Callable[[Column], Column]
    minds_space: bool = False


def _whole_number_fault(value: Column) -> Column:
    return F.when(cv.is_int_text(value), F.lit("out_of_range")).otherwise(F.lit("not_convertible"))


def _plain_fault(_: Column) -> Column:
    return F.lit("not_convertible")


# Conversions of trimmed text; `tagloom.functions.convert` has them for any text.
INTEGER = Kind("integer", T.IntegerType(), lambda v: v.try_cast("int"), _whole_number_fault)
BIGINT = Kind("bigint", T.LongType(), lambda v: v.try_cast("bigint"), _whole_number_fault)
VARCHAR = Kind("varchar", T.StringType(), lambda v: v, _plain_fault, True)
BOOLEAN = Kind("boolean", T.BooleanType(), cv.is_true_word, _plain_fault, True)
UUID = Kind("uuid", T.StringType(), cv.uuid_of, lambda _: F.lit("bad_format"))
DOUBLE = Kind("double", T.DoubleType(), cv.floating, _plain_fault)
DATE = Kind("date", T.DateType(), lambda v: v.try_cast("date"), _plain_fault)
TIMESTAMP = Kind("timestamp", T.TimestampNTZType(), cv.date_time, _plain_fault)


@dataclass(frozen=True)
class Field:
    """One column.

    `child` is the XML child element it is read from (default: `name`), `column`
    the output name (default: `name`). `convert` replaces the conversion of the
    kind; it gets trimmed text and must return NULL for text it cannot convert. Several
    columns may be read from one child.
    """

    name: str
    kind: Kind = VARCHAR
    required: bool = True
    child: str | None = None
    column: str | None = None
    default: object = None
    convert: Callable[[Column], Column] | None = None

    @property
    def source(self) -> str:
        return self.child or self.name

    @property
    def target(self) -> str:
        return self.column or self.name

    @property
    def minds_space(self) -> bool:
        return self.convert is not None or self.kind.minds_space

    def value(self, raw: Column) -> Column:
        """The converted value; an absent optional value takes the default."""
        if self.convert is None:
            converted = self.kind.convert(raw)
        else:
            converted = F.when(raw.isNotNull(), self.convert(raw)).cast(self.kind.data_type)
        if self.required or self.default is None:
            # an absent required value is a violation, never a made-up value
            return converted
        fallback = F.lit(self.default).cast(self.kind.data_type)
        return F.when(raw.isNull(), fallback).otherwise(converted)


@dataclass(frozen=True)
class TableSpec:
    """A table and the row element of the same name."""

    name: str
    fields: tuple[Field, ...]

    def __post_init__(self) -> None:
        if not self.name.startswith("t_"):
            raise IngestError(f"a table name must start with t_: {self.name}")
        for what, names in (("child", self.children), ("column", self.columns)):
            if len({n.lower() for n in names}) != len(names):
                raise IngestError(f"{self.name}: {what} declared twice")

    @property
    def columns(self) -> list[str]:
        return [f.target for f in self.fields]

    @property
    def children(self) -> list[str]:
        return list(dict.fromkeys(f.source for f in self.fields))

    @property
    def required(self) -> list[str]:
        return [f.target for f in self.fields if f.required]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.target, f.kind.data_type, True) for f in self.fields])

    def column_sql(self) -> str:
        """Column list of CREATE TABLE, in declaration order."""
        return ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in self.schema)


@dataclass
class Registry:
    """The known tables."""

    specs: dict[str, TableSpec] = field(default_factory=dict)

    @classmethod
    def of(cls, *specs: TableSpec) -> Registry:
        registry = cls()
        for spec in specs:
            registry.register(spec)
        return registry

    def register(self, spec: TableSpec) -> TableSpec:
        self.specs[spec.name] = spec
        return spec

    def __iter__(self) -> Iterable[TableSpec]:
        return iter(self.specs.values())

    def __contains__(self, name: str) -> bool:
        return name in self.specs

    def __getitem__(self, name: str) -> TableSpec:
        if name not in self.specs:
            raise IngestError(f"table {name} is not known; known tables: {self.names()}")
        return self.specs[name]

    def names(self) -> list[str]:
        return list(self.specs)

    def is_known(self, tag: Column) -> Column:
        return tag.isin(*self.names())

    def children(self) -> list[str]:
        """Every child element any table reads, once per name regardless of case."""
        seen: dict[str, str] = {}
        for spec in self:
            for child in spec.children:
                seen.setdefault(child.lower(), child)
        return list(seen.values())

    def spellings(self) -> tuple[list[str], list[str]]:
        """Declared child names: those spelled in one way, and those that differ in case somewhere."""
        ways: dict[str, set[str]] = {}
        for spec in self:
            for child in spec.children:
                ways.setdefault(child.lower(), set()).add(child)
        one = [next(iter(w)) for w in ways.values() if len(w) == 1]
        return one, [name for w in ways.values() if len(w) > 1 for name in sorted(w)]

    def listing(self, spark: SparkSession) -> DataFrame:
        """One row per declared column: table, position, column, type, required."""
        rows = [
            (spec.name, i, f.target, f.kind.name, f.required)
            for spec in self
            for i, f in enumerate(spec.fields, 1)
        ]
        return spark.createDataFrame(
            rows,
            "table_name string, position int, column_name string, type string, required boolean",
        )

    def to_json(self) -> str:
        return json.dumps({"supported_tables": self.names(), "count": len(self.specs)}, indent=2)

    def to_csv(self) -> str:
        return "\n".join(["table_name", *self.names()])


def _fields(kind: Kind, *names: str) -> tuple[Field, ...]:
    return tuple(Field(n, kind) for n in names)


# The three tables, in column order.
T_OBJECT = TableSpec(
    "t_object",
    (
        Field("class_id", INTEGER),
        Field("name", VARCHAR),
        Field("category_id", INTEGER),
        Field("index", INTEGER),
        Field("object_id", INTEGER),
        Field("show", BOOLEAN),
        Field("guid", UUID, required=False, child="GUID"),
    ),
)
T_PROPERTY = TableSpec(
    "t_property",
    (
        Field("property_id", INTEGER),
        Field("collection_id", INTEGER),
        Field("enum_id", INTEGER, required=False),
        Field("name", VARCHAR),
        Field("summary_name", VARCHAR),
        Field("unit_id", INTEGER),
        Field("summary_unit_id", INTEGER),
        Field("is_multi_band", BOOLEAN),
        Field("is_period", BOOLEAN),
        Field("is_summary", BOOLEAN),
        Field("lang_id", INTEGER),
    ),
)
T_KEY = TableSpec(
    "t_key",
    _fields(INTEGER, "key_id", "membership_id", "phase_id", "property_id", "period_type_id"),
)
# End of fixed values.


def default_registry() -> Registry:
    return Registry.of(T_OBJECT, T_PROPERTY, T_KEY)
