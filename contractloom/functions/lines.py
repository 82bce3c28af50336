"""Expressions over one fixed-width line."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractloom.functions.text import WHITESPACE, strip
from contractloom.spec.layouts import EXTENSION_FIELDS, LAYOUTS, Field, extension_field


def detect_record_type(line: Column) -> Column:
    """The record type of a line, null when it is none of the known ones."""
    kind = F.substring(line, 2, 2)
    detail = F.substring(line, 2, 4)
    known = [t for t in LAYOUTS if len(t) == 4]
    code = (
        F.when(kind.isin("10", "12", "40", "42"), F.concat(kind, F.lit("0")))
        .when(detail.isin(*known), detail)
    )
    # Not by the length, for which all characters of the line are counted.
    return F.when(F.substring(line, 5, 1) != "", code)


def cut(line: Column, field: Field) -> Column:
    """One field of a line, stripped; empty when the line is too short for it."""
    return strip(F.substring(line, field.start, field.width))


def bytes_sql(line: str) -> str:
    """The bytes of a line as SQL text, null where a character has more than one."""
    return f"if(octet_length(`{line}`) = length(`{line}`), cast(`{line}` AS binary), null)"


def cut_sql(line: str, field: Field, line_bytes: str) -> str:
    """``cut`` of a column by name, as SQL text; ``line_bytes`` is the column of its ``bytes_sql``."""
    blanks = "".join(f"\\u{ord(c):04x}" for c in WHITESPACE)
    place = f"{field.start}, {field.width}"
    text = f"if(`{line_bytes}` IS NULL, substring(`{line}`, {place}), cast(substring(`{line_bytes}`, {place}) AS string))"
    return f"btrim(trim({text}), '{blanks}')"


def field_of(line: Column, record_type: str, name: str) -> Column:
    return cut(line, LAYOUTS[record_type].field(name))


def contract_of(line: Column, record_type: Column) -> Column:
    """The contract number of a detail record, empty for headers."""
    detail = F.length(record_type) == 4
    return F.when(detail, cut(line, LAYOUTS["1301"].field("Contract_Number"))).otherwise(F.lit(""))


def contra_of(line: Column) -> Column:
    """The contra participant in the extension of an extended contract header, else null."""
    header = (F.substring(line, 2, 4) == "1301") & (F.length(line) == 336)
    return F.when(header, cut(line, extension_field("Ext_Contra_Participant")))


def describe(record_type: Column) -> Column:
    """The description of a record type, ``Unknown`` when there is none."""
    names = F.from_json(
        F.lit(json.dumps({t: layout.description for t, layout in LAYOUTS.items()})),
        "map<string,string>",
    )
    return F.coalesce(names[record_type], F.lit("Unknown"))


def _spans(data_only: bool) -> Column:
    """A constant map: record type to its field positions."""
    spans = {
        t: [{"name": f.name, "start": f.start, "width": f.width}
            for f in (layout.data_fields if data_only else layout.fields)]
        for t, layout in LAYOUTS.items()
    }
    schema = "map<string,array<struct<name:string,start:int,width:int>>>"
    return F.from_json(F.lit(json.dumps(spans)), schema)


def fields_map(line: Column, record_type: Column) -> Column:
    """All fields of a line by name, fillers included."""
    return F.map_from_entries(F.transform(
        _spans(False)[record_type],
        lambda s: F.struct(s["name"], strip(F.substring(line, s["start"], s["width"]))),
    ))


def data_values(line: Column, record_type: Column) -> Column:
    """The data fields of a line as an array of (name, value), in layout order."""
    return F.transform(
        _spans(True)[record_type],
        lambda s: F.struct(
            s["name"].alias("name"),
            strip(F.substring(line, s["start"], s["width"])).alias("value"),
        ),
    )


def data_count(record_type: Column) -> Column:
    """How many data fields a record type has."""
    return F.size(_spans(True)[record_type])


def data_part(line: Column, record_type: Column, types: list[str]) -> Column:
    """The data fields of a line one behind the other as they stand there, without the blanks at its end; null for other types."""
    def part(t: str) -> Column:
        runs: list[list[int]] = []  # fields with nothing between them are cut as one
        for f in LAYOUTS[t].data_fields:
            if runs and sum(runs[-1]) == f.start:
                runs[-1][1] += f.width
            else:
                runs.append([f.start, f.width])
        return F.rtrim(F.concat(*(F.substring(line, start, width) for start, width in runs)))

    return F.coalesce(*(F.when(record_type == t, part(t)) for t in types), F.lit(None).cast("string"))


def part_values(part: Column, record_type: Column) -> Column:
    """The values of a ``data_part`` in layout order."""
    places = {}
    for t, layout in LAYOUTS.items():
        at = 1
        places[t] = []
        for f in layout.data_fields:
            places[t].append({"start": at, "width": f.width})
            at += f.width
    known = F.from_json(F.lit(json.dumps(places)), "map<string,array<struct<start:int,width:int>>>")
    return F.transform(known[record_type], lambda s: strip(F.substring(part, s["start"], s["width"])))


def render_core(record_type: str, values: dict[str, Column]) -> Column:
    """A line from field values: each padded on the right and cut to its width."""
    layout = LAYOUTS[record_type]
    unknown = set(values) - {f.name for f in layout.fields}
    if unknown:
        raise KeyError(f"{record_type} has no fields {sorted(unknown)}")
    parts, gap = [], 0

    def flush() -> None:
        nonlocal gap
        if gap:
            parts.append(F.lit(" " * gap))
            gap = 0

    for f in layout.fields:
        value = values.get(f.name)
        if value is None:
            gap += f.width
        else:
            flush()
            parts.append(F.rpad(F.coalesce(value, F.lit("")), f.width, " "))
    flush()
    return F.concat(*parts)


def render_extended(record_type: str, core: Column, extension: Column) -> Column:
    """The extended form of a rendered line: core and extension, cut at 336."""
    if LAYOUTS[record_type].width > 300:
        return F.substring(core, 1, 336)
    return F.concat(core, F.rpad(extension, 36, " "))


def render_extension(values: dict[str, Column]) -> Column:
    return F.concat(*(
        F.rpad(F.coalesce(values.get(f.name, F.lit("")), F.lit("")), f.width, " ")
        for f in EXTENSION_FIELDS
    ))
