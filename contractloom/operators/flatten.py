"""Contract rows: the long form without any limit, and the wide one with a column per field and occurrence.

The long form has a row for each record, with its number in its contract. The wide row is
a view of it, as wide as the fullest contract. Lines without a contract share one key
and may be any number; they do not widen the view, and those of them that it has no
columns for are in the long form alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractloom.functions.lines import bytes_sql, cut_sql
from contractloom.operators.records import NO_CONTRACT, occurrence_limits, occurrence_number
from contractloom.sources.fixed_width import detail_records
from contractloom.spec.layouts import LAYOUTS, REPEATING_TYPES, Field

META_COLUMNS = ("file", "first_line")


@dataclass(frozen=True)
class WideColumn:
    """A column of the wide row. ``slot`` is 0 where the name has no number."""

    name: str
    record_type: str
    slot: int
    field: Field


def slots_of(record_type: str, limits: dict[str, int]) -> list[int]:
    """The numbered occurrences of a type, or just 0 when its columns are not numbered."""
    most = limits.get(record_type, 0)
    if LAYOUTS[record_type].repeats and most > 1:
        return list(range(1, most + 1))
    return [0]


def wide_columns(limits: dict[str, int]) -> list[WideColumn]:
    """The columns by type, then occurrence, then layout order."""
    return [
        WideColumn(f"{t}_{f.name}" + (f"_{slot}" if slot else ""), t, slot, f)
        for t in sorted(limits)
        for slot in slots_of(t, limits)
        for f in LAYOUTS[t].data_fields
    ]


def flatten_long(records: DataFrame) -> DataFrame:
    """Every detail record with ``occ``, its number in its contract and type; nothing is gathered."""
    return occurrence_number(records)


def numbered_slots(records: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Detail records with ``occ`` and ``slot``, the occurrence under which the wide row has their cells.

    ``slot`` is 0 where a type's columns have no number, and null for a record without a
    contract that the wide row has no columns for.
    """
    beyond = (F.col("contract") == NO_CONTRACT) & _repeats() & (F.col("occ") > _limit(limits))
    return occurrence_number(records).withColumn("slot", F.when(~beyond, _slot(limits)))


def numbered_contracts(records: DataFrame, limits: dict[str, int]) -> DataFrame:
    """``numbered_slots`` of records with a contract, dealt by file and contract: a contract has few records."""
    order = Window.partitionBy("file", "contract", "record_type").orderBy("line_no", "raw")
    dealt = detail_records(records).repartition("file", "contract")
    return dealt.withColumn("occ", F.row_number().over(order).cast("bigint")).withColumn("slot", _slot(limits))


def _slot(limits: dict[str, int]) -> Column:
    numbered = [t for t in sorted(limits) if slots_of(t, limits) != [0]]
    return F.when(F.col("record_type").isin(*numbered), F.col("occ")).otherwise(F.lit(0).cast("bigint"))


def unplaced(records: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Records without a contract that the wide row has no columns for, in the long form."""
    stray = occurrence_number(records.filter(F.col("contract") == NO_CONTRACT))
    return stray.filter(_repeats() & (F.col("occ") > _limit(limits)))


def _repeats() -> Column:
    return F.col("record_type").isin(*REPEATING_TYPES)


def _limit(limits: dict[str, int]) -> Column:
    """The most occurrences of a record's type in a contract, one at least."""
    known = F.create_map(*(F.lit(x) for item in (limits or {"": 1}).items() for x in item))
    return F.greatest(F.coalesce(known[F.col("record_type")], F.lit(1)), F.lit(1))


def placed(records: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The records that the wide row has columns for: all but ``unplaced``."""
    stray = F.col("contract") == NO_CONTRACT
    shown = occurrence_number(records.filter(stray)).filter(~_repeats() | (F.col("occ") <= _limit(limits)))
    return detail_records(records).filter(~stray).unionByName(shown.drop("occ"))


def flatten(records: DataFrame, limits: dict[str, int] | None = None, *, counted: bool = False) -> DataFrame:
    """One wide row per file and contract.

    ``limits`` is the most occurrences per type in a contract. They are counted by one small
    job, unless ``counted`` says that the given ones are such counts, and lower ones
    are refused before anything is gathered. So what is gathered for a contract is
    its own row. A single type is reduced to its last record before the shuffle.
    """
    if not counted:
        most = occurrence_limits(records)
        limits = most if limits is None else limits
        for t, n in most.items():
            if n > max(1, limits.get(t, 0)) and LAYOUTS[t].repeats:
                raise ValueError(f"a contract has {n} records of type {t}, more than {limits.get(t, 0)}")
    columns = wide_columns(limits)
    numbered = [t for t in sorted(limits) if slots_of(t, limits) != [0]]
    single = [t for t in sorted(limits) if slots_of(t, limits) == [0]]
    t, line_no, raw = F.col("record_type"), F.col("line_no"), F.col("raw")

    gathered = placed(records, limits).groupBy("file", "contract").agg(
        F.min("line_no").alias("first_line"),
        *(F.max_by(F.when(t == s, raw), F.when(t == s, line_no)).alias(f"one_{s}") for s in single),
        *(
            F.array_sort(F.collect_list(F.when(t == n, F.struct("line_no", "raw")))).alias(f"all_{n}")
            for n in numbered
        ),
    )
    slots = gathered.select(
        "file",
        "first_line",
        F.col("contract").alias("Contract_Number"),
        *(f"one_{s}" for s in single),
        *(
            F.get(F.col(f"all_{n}"), F.lit(slot - 1))["raw"].alias(f"one_{n}_{slot}")
            for n in numbered for slot in slots_of(n, limits)
        ),
    )

    # Cells are cut by bytes where they can be: to cut a character, Spark walks there from the start of the line.
    lines = [c for c in slots.columns if c.startswith("one_")]
    slots = slots.selectExpr("*", *(f"{bytes_sql(line)} AS `bytes_{line}`" for line in lines))

    # Hundreds of columns: SQL text is read in one call each.
    def cell(c: WideColumn) -> str:
        line = f"one_{c.record_type}" + (f"_{c.slot}" if c.slot else "")
        return f"coalesce({cut_sql(line, c.field, f'bytes_{line}')}, '') AS `{c.name}`"

    return slots.selectExpr("file", "first_line", "Contract_Number", *(cell(c) for c in columns))


def union_files(wides: list[DataFrame]) -> DataFrame:
    """Wide rows of files with different columns; the missing cells are empty."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wides)
    return merged.na.fill("")


def csv_rows(wide: DataFrame) -> DataFrame:
    """The wide row as it is written: without the columns that say where it came from."""
    return wide.drop(*META_COLUMNS)
