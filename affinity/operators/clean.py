"""Raw lines to typed tables.

Every line is classified once: it is kept, dropped because its last field is
empty, or rejected with a reason. Nothing raises and nothing is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions.text import fields, middle, strip, to_double, to_int
from affinity.schemas import TABLES

EMPTY_LAST = "empty last field"
TOO_FEW = "too few fields"
TOO_MANY = "too many fields"
BAD_VALUE = "bad value"


def _count(parts: Column, least: int, most: int | None) -> Column:
    """What is wrong with the number of fields, or null."""
    wrong = F.when(F.size(parts) < least, TOO_FEW)
    return wrong.when(F.size(parts) > most, TOO_MANY) if most else wrong


def _links(parts: Column) -> tuple[Column, list[Column]]:
    return _count(parts, 3, 3), [to_int(F.get(parts, F.lit(i))) for i in range(3)]


def _ratings(parts: Column) -> tuple[Column, list[Column]]:
    casts = (to_int, to_int, to_double, to_int)
    return _count(parts, 4, 4), [cast(F.get(parts, F.lit(i))) for i, cast in enumerate(casts)]


def _tags(parts: Column) -> tuple[Column, list[Column]]:
    # The tag is free text between the others, commas included.
    return _count(parts, 4, None), [
        to_int(F.get(parts, F.lit(0))),
        to_int(F.get(parts, F.lit(1))),
        strip(middle(parts, before=2, after=1)),
        to_int(F.element_at(parts, -1)),
    ]


def _movies(record: Column) -> tuple[Column, list[Column]]:
    missing = record["title"].isNull() | record["genres"].isNull()
    wrong = F.when(missing, TOO_FEW).when(record["surplus"].isNotNull(), TOO_MANY)
    return wrong, [to_int(record["movieId"]), strip(record["title"]), strip(record["genres"])]


def _quoted(line: Column) -> Column:
    """Three fields of a line in which the title may be quoted; ``surplus`` if not three."""
    return F.from_csv(
        line,
        "movieId string, title string, genres string, surplus string",
        {"escape": '"', "columnNameOfCorruptRecord": "surplus"},
    )


_RULES = {
    "links": (fields, _links),
    "movies": (_quoted, _movies),
    "ratings": (fields, _ratings),
    "tags": (fields, _tags),
}


def _classified(records: DataFrame, table: str, wrong: Column, typed: list[Column]) -> DataFrame:
    names = TABLES[table].names
    # A row made by ``inline`` is computed once: filters on it are not pushed below
    # and do not parse the line again.
    parsed = F.struct(wrong.alias("_wrong"), *[c.alias(n) for c, n in zip(typed, names)])
    rows = records.select("value", F.inline(F.array(parsed)))
    unread = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])
    reason = (
        F.when(F.col("value").endswith(","), EMPTY_LAST)
        .when(F.col("_wrong").isNotNull(), F.col("_wrong"))
        .when(unread, BAD_VALUE)
    )
    return rows.withColumn("reason", reason).drop("_wrong")


def classify(lines: DataFrame, table: str) -> DataFrame:
    """``value``, the typed columns of ``table`` and ``reason`` (null for a kept line)."""
    record_of, typed_of = _RULES[table]
    records = lines.select("value", record_of(F.col("value")).alias("_record"))
    return _classified(records, table, *typed_of(F.col("_record")))


# How a CSV field becomes a value of each type of the schemas.
_TYPED = {"integer": to_int, "double": to_double, "string": strip}
_CORRUPT = "_corrupt"


def classify_csv(lines: DataFrame, table: str) -> DataFrame:
    """The same for CSV records: any field may be quoted, and a quote inside it is doubled.

    Parsing is permissive. The record itself is kept where it has not as many fields as the
    table has columns, and its delimiters outside quotes then tell which way it is wrong.
    """
    schema = TABLES[table]
    texts = ", ".join(f"{name} string" for name in [*schema.names, _CORRUPT])
    # With this mark for null, a field that is empty is null and one that is quoted and empty is "".
    options = {"escape": '"', "nullValue": "\x00", "columnNameOfCorruptRecord": _CORRUPT}
    record = F.from_csv(F.col("value"), texts, options)
    records = lines.select("value", record.alias("_record"))
    corrupt = F.col(f"_record.{_CORRUPT}")
    bare = F.regexp_replace(corrupt, '"[^"]*"', "")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    wrong = (
        F.when(n_fields < len(schema), TOO_FEW)
        .when(n_fields > len(schema), TOO_MANY)
        .when(corrupt.isNotNull(), BAD_VALUE)
    )
    typed = [_TYPED[f.dataType.typeName()](F.col(f"_record.{f.name}")) for f in schema]
    return _classified(records, table, wrong, typed)


def kept(classified: DataFrame, table: str) -> DataFrame:
    return classified.filter(F.col("reason").isNull()).select(*TABLES[table].names)


def rejected(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNotNull()).select("value", "reason")


def counts(classified: DataFrame, table: str) -> DataFrame:
    """Lines kept, dropped and rejected, in one pass."""
    reason = F.col("reason")
    return classified.agg(
        F.count_if(reason.isNull()).alias("kept"),
        F.count_if(reason == EMPTY_LAST).alias("dropped"),
        F.count_if(reason.isNotNull() & (reason != EMPTY_LAST)).alias("rejected"),
    ).select(F.lit(table).alias("table_name"), "kept", "dropped", "rejected")


def clean(lines: DataFrame, table: str) -> DataFrame:
    return kept(classify(lines, table), table)
