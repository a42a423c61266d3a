"""Column types that widen over deliveries.

Cells are read as text and told apart by their form. The forms make a small
lattice: whole numbers below numbers, dates below times, and text above all.
What is kept of a delivery is how many cells of each form a column of each file
has. Those counts add up, and the least type above a set of forms does not
depend on their order, so neither does the outcome depend on the order of files.

A column that was declared stays in the family of its declared type (numbers,
times, truth values) and widens within it; cells of another family are not
compatible, and their rows are quarantined. Declared text takes everything. A
column that was not declared takes the least type above all of its cells and is
text where they are of several families.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# The forms of a family, each above the ones before it, and the Spark types that hold them.
FAMILIES = {
    "boolean": ("boolean",),
    "number": ("long", "double"),
    "time": ("date", "timestamp"),
    "text": ("text",),
}
FORMS = tuple(form for forms in FAMILIES.values() for form in forms)
SPARK_TYPES = {
    "boolean": "boolean", "long": "bigint", "double": "double", "date": "date",
    "timestamp": "timestamp_ntz", "text": "string",
}
# The form that a declared type begins with; all other types are text.
DECLARED = {
    "boolean": "boolean", "tinyint": "long", "smallint": "long", "int": "long", "bigint": "long",
    "float": "double", "double": "double", "date": "date", "timestamp": "timestamp",
    "timestamp_ntz": "timestamp", "string": "text",
}

REASONS = "_not_compatible"

_LONG = r"^[+-]?[0-9]{1,18}$"
_DOUBLE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"


def family_of(form: str) -> str:
    return next(name for name, forms in FAMILIES.items() if form in forms)


def cell_form(cell: Column) -> Column:
    """The least form that holds a cell; NULL for a missing or blank one, which every type holds."""
    text = F.trim(cell)
    whole_day = text.rlike(_DATE) & F.try_to_date(text, "yyyy-MM-dd").isNotNull()
    moment = text.rlike(_TIMESTAMP) & text.try_cast("timestamp_ntz").isNotNull()
    return (
        F.when(text == "", None)
        .when(text.rlike(_LONG), "long")
        .when(text.rlike(_DOUBLE), "double")
        .when(F.lower(text).isin("true", "false"), "boolean")
        .when(whole_day, "date")
        .when(moment, "timestamp")
        .when(text.isNotNull(), "text")
    )


def form_counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, column_name, form, cells: how many cells of each form each text column has.

    One pass, counted below the shuffle: a task sends one row per value of ``by``,
    such as the file, also where one file holds most rows. Forms that don't
    occur have no row; blank cells are not counted. Tables of counts, of any
    deliveries, can be put together with a union.
    """
    columns = [c for c in rows.columns if c not in by]
    prefix = "c"
    while any(name.lower().startswith(prefix) for name in by):
        prefix += "_"
    named = [f"{prefix}{i}" for i in range(len(columns))]
    forms = rows.select(*by, *[cell_form(F.col(f"`{c}`")).alias(n) for c, n in zip(columns, named)])
    counts = forms.groupBy(*by).agg(
        *[F.count_if(F.col(n) == form).alias(f"{n}_{form}") for n in named for form in FORMS]
    )
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(form).alias("form"), F.col(f"{n}_{form}").alias("cells"))
        for c, n in zip(columns, named)
        for form in FORMS
    ]
    if not cells:
        raise ValueError("no columns to tell forms of")
    return counts.select(*by, F.inline(F.array(*cells))).where("cells > 0")


def declared_forms(schema: StructType) -> dict[str, str]:
    """The form that each declared column begins with."""

    def form(kind: DataType) -> str:
        name = kind.simpleString()
        return "double" if name.startswith("decimal") else DECLARED.get(name, "text")

    return {f.name: form(f.dataType) for f in schema}


def least_above(forms: Sequence[str]) -> str | None:
    """The least form above all of ``forms``: text where they are of several families; None for none."""

    def join(one: str, other: str) -> str:
        family = family_of(one)
        if family != family_of(other):
            return "text"
        return max(one, other, key=FAMILIES[family].index)

    return reduce(join, forms) if forms else None


def widened(
    counts: DataFrame, declared: StructType, known: dict[str, str] | None = None
) -> dict[str, str]:
    """The form of every column, from the counts and the forms ``known`` from earlier deliveries.

    A row per column and form comes to the driver: six per column at most.
    Columns without a cell and without declaration are left out, as nothing is
    known of them.
    """
    found: dict[str, set[str]] = {}
    for row in counts.select("column_name", "form").distinct().collect():
        found.setdefault(row.column_name, set()).add(row.form)
    known, first = dict(known or {}), declared_forms(declared)
    forms = {}
    for name in [*first, *sorted((known.keys() | found.keys()) - first.keys())]:
        seen = [*filter(None, [first.get(name), known.get(name)]), *sorted(found.get(name, ()))]
        if name in first:  # others are quarantined, unless all is text
            seen = [f for f in seen if family_of(f) == family_of(first[name])]
        forms[name] = least_above(seen)
    return forms


def _holds(form: str) -> tuple[str, ...]:
    """The forms of the cells that a column of this form takes."""
    if form == "text":
        return FORMS
    forms = FAMILIES[family_of(form)]
    return forms[: forms.index(form) + 1]


def typed(rows: DataFrame, forms: dict[str, str], keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The rows whose cells all fit, cast to the types of ``forms``; and the others, as text.

    The second has the names of the columns that did not fit in
    ``_not_compatible``. Columns in ``keep`` are passed on as they are; of others
    those without a form stay text, and those that the rows lack are NULL. Every
    row is in exactly one of the two.
    """
    present = [c for c in forms if c in rows.columns]
    checked = [
        F.when(~cell_form(F.col(f"`{c}`")).isin(*_holds(forms[c])), F.lit(c))
        for c in present
        if forms[c] != "text"
    ]
    reasons = F.array_compact(F.array(*checked)) if checked else F.array().cast("array<string>")
    marked = rows.withColumn(REASONS, reasons)

    def cast(name: str) -> Column:
        kind = SPARK_TYPES[forms[name]]
        if name not in present:
            return F.lit(None).cast(kind).alias(name)
        cell = F.col(f"`{name}`")
        return (cell if kind == "string" else F.nullif(F.trim(cell), F.lit("")).cast(kind)).alias(name)

    others = [f"`{c}`" for c in rows.columns if c not in forms and c not in keep]
    fit = marked.where(F.size(REASONS) == 0).select(*map(cast, forms), *others, *keep)
    return fit, marked.where(F.size(REASONS) > 0)
