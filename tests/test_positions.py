"""Small files through scan, parse, flatten and reconcile, against plain Python."""

import pytest
from pyspark.sql import functions as F

from contractloom.operators import contracts, flatten, reconcile, records
from contractloom.plans import pipeline
from contractloom.sources import fixed_width, tables
from contractloom.spec.layouts import EXTENSION_FIELDS, LAYOUTS


def line(record_type, contract="", **values):
    layout = LAYOUTS[record_type]
    head = {"Record_Type": record_type[:2], "Contract_Number": contract,
            "Sequence_Number": record_type[2:] if len(record_type) == 4 else ""}
    head[layout.fields[0].name] = "P"
    out = "".join(str({**head, **values}.get(f.name, "")).ljust(f.width)[:f.width] for f in layout.fields)
    return out


def extended(record_type, contract="", contra="", **values):
    core = line(record_type, contract, **values)
    if len(core) > 300:
        return core[:336]
    return core + "".join({"Ext_Contra_Participant": contra}.get(f.name, "").ljust(f.width)
                          for f in EXTENSION_FIELDS)


STANDARD = [
    "HDR.SOMETHING",
    line("100", Valuation_Date="20260320"),
    line("120"),
    line("1301", "C1", CUSIP_Number="CU1", Contract_Status="VA"),
    line("1303", "C1", Fund_Value="10.00"),
    "",
    line("1303", "C1", Fund_Value="20.00"),
    line("1301", "C2", CUSIP_Number="CU2"),
    "ZZ9 junk",
    line("1303", "", Fund_Value="5.00"),
    "   ",
    "END.SOMETHING",
]


@pytest.fixture(scope="module")
def standard(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("std") / "F.03212026.txt"
    path.write_text("\n".join(STANDARD) + "\n")
    return pipeline.flatten_positions(spark, str(path))


def test_line_numbers_over_many_splits(spark, tmp_path):
    texts = {}
    for name, n in (("a.txt", 5000), ("b.txt", 1), ("c.txt", 1777)):
        texts[name] = [f"{name} line {i}" + "x" * (i % 50) for i in range(1, n + 1)]
        (tmp_path / name).write_text("\n".join(texts[name]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = fixed_width.scan_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["value"] for r in rows}
    assert got == {(n, i): v for n, t in texts.items() for i, v in enumerate(t, 1)}


def test_file_metadata(standard):
    row = standard.files.first()
    assert (row["file_type"], row["file_format"], row["valuation_date"]) == ("POV", "standard", "20260320")
    assert (row["total_lines"], row["parsed_lines"], row["skipped_lines"]) == (12, 7, 5)
    assert row["error_count"] == 1
    assert row["record_type_counts"] == {"100": 1, "120": 1, "1301": 2, "1303": 3}


def test_rejects(standard):
    rows = standard.rejects.collect()
    assert [(r["line_no"], r["error"]) for r in rows] == [
        (9, "Line 9: unrecognised record type (first 5 chars: 'ZZ9 j')")]


def test_extended_metadata_from_name_and_details(spark, tmp_path):
    body = [extended("1302", "C1") for _ in range(3)] + ["bad"]
    (tmp_path / "F.03202026.txt").write_text("\n".join(body) + "\n")
    far = [extended("4305", "C1") for _ in range(60)] + [extended("1301", "C1")]
    (tmp_path / "G.txt").write_text("\n".join(far) + "\n")
    lines = fixed_width.scan_lines(spark, str(tmp_path))
    whole = {r["file"].rsplit("/", 1)[1]: r["file_type"] for r in fixed_width.file_metadata(lines).collect()}
    assert whole == {"F.03202026.txt": "POV", "G.txt": "POV"}
    rows = {r["file"].rsplit("/", 1)[1]: r
            for r in fixed_width.file_metadata(lines, sample_details=50).collect()}
    f, g = rows["F.03202026.txt"], rows["G.txt"]
    assert (f["file_type"], f["file_format"], f["valuation_date"], f["error_count"]) == (
        "POV", "extended", "20260320", 1)
    assert (g["file_type"], g["valuation_date"]) == ("FAR", "")


@pytest.mark.parametrize("lines,expected", [
    ([], "standard"), (["HDR"], "standard"), ([line("100")], "standard"),
    ([extended("1301", "C")], "extended"), ([line("1301", "C")], "standard"),
    (["", "   ", extended("1301", "C")], "extended"), (["odd"] * 20 + [extended("1301", "C")], "extended"),
])
def test_detect_format(spark, lines, expected):
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines, 1)],
                               "file string, line_no bigint, value string")
    rows = fixed_width.detect_format(df).collect()
    assert [r["file_format"] for r in rows] == ([expected] if lines else [])


def test_flatten(standard):
    rows = {r["Contract_Number"]: r.asDict() for r in standard.wide.collect()}
    assert set(rows) == {"C1", "C2", records.NO_CONTRACT}
    assert rows["C1"]["1303_Fund_Value_1"] == "10.00"
    assert rows["C1"]["1303_Fund_Value_2"] == "20.00"
    assert rows["C2"]["1303_Fund_Value_1"] == ""
    assert rows["C1"]["1301_CUSIP_Number"] == "CU1"
    assert rows[records.NO_CONTRACT]["1303_Fund_Value_1"] == "5.00"
    assert not [c for c in standard.wide.columns if "Filler" in c]
    assert standard.limits == {"1301": 1, "1303": 2}


def test_flatten_refuses_limits_that_would_drop_records(spark, standard):
    three = spark.createDataFrame(
        [("f", i, line("1303", "C")) for i in range(3)], "file string, line_no bigint, value string")
    with pytest.raises(Exception, match="3 records of type 1303, more than 2"):
        flatten.flatten(records.parse_records(three), {"1303": 2})


def test_flatten_with_many_lines_of_no_contract(spark):
    """Stray lines do not widen the table; those without a column stay in the long form."""
    lines = [line("1303", "", Fund_Value=f"{i}.00") for i in range(1500)] + [line("1303", "C", Fund_Value="1.00")] * 3
    parsed = records.parse_records(spark.createDataFrame(
        [("f", i, v) for i, v in enumerate(lines)], "file string, line_no bigint, value string"))
    limits = records.occurrence_limits(parsed)
    assert limits == {"1303": 3}
    wide = {r["Contract_Number"]: r.asDict() for r in flatten.flatten(parsed).collect()}
    assert [wide[records.NO_CONTRACT][f"1303_Fund_Value_{i}"] for i in (1, 2, 3)] == ["0.00", "1.00", "2.00"]
    assert wide["C"]["1303_Fund_Value_3"] == "1.00"
    assert flatten.flatten_long(parsed).count() == 1503
    assert sorted(r["occ"] for r in flatten.unplaced(parsed, limits).collect()) == list(range(4, 1501))
    report = reconcile.report(parsed, flatten.flatten(parsed)).first()
    assert report["valid"] and report["total_fields_checked"] == 6 * 14


def test_records_without_a_column_are_written_and_counted(spark, tmp_path):
    lines = [line("1303", "", Fund_Value=f"{i}.00") for i in range(20)] + [line("1303", "C", Fund_Value="1.00")] * 3
    (tmp_path / "F.03212026.txt").write_text("\n".join(lines) + "\n")
    pos = pipeline.flatten_positions(spark, str(tmp_path / "F.03212026.txt"))
    assert pos.report().first()["unplaced_records"] == 17 and pos.unplaced.count() == 17
    wide, left_out = pos.write(str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(wide).count() == 2
    assert sorted(int(r["occ"]) for r in spark.read.option("header", True).csv(left_out).collect()) == list(range(4, 21))


def test_format_and_kind_beyond_the_first_lines(spark):
    lines = ["odd"] * 300 + [line("1301", "C").ljust(300) + " " * 36] + ["y"] * 100
    lines = [v if len(v) < 300 else (v + " " * 336)[:336] for v in lines]
    df = spark.createDataFrame([("F.20260101.txt", i, v) for i, v in enumerate(lines, 1)],
                               "file string, line_no bigint, value string")
    assert fixed_width.detect_format(df).first()["file_format"] == "extended"
    meta = fixed_width.file_metadata(df)
    assert (meta.first()["file_format"], meta.first()["file_type"]) == ("extended", "POV")
    totals = fixed_width.run_totals(meta).first()
    assert (totals["files"], totals["total_lines"], totals["parsed_lines"]) == (1, 401, 1)


def test_reconcile_valid_and_tampered(spark, standard):
    report = standard.report().first()
    assert report["valid"] and report["mismatch_count"] == 0
    assert report["total_fields_checked"] == 2 * 18 + 3 * 14
    assert report["expected_contracts"] == report["actual_contracts"] == 3

    wrong = standard.wide.withColumn(
        "1303_Fund_Value_2", F.when(F.col("Contract_Number") == "C1", "99").otherwise(F.col("1303_Fund_Value_2")))
    found = standard.mismatches(wrong).collect()
    assert [(r["contract_number"], r["field_name"], r["expected"], r["actual"], r["occurrence"])
            for r in found] == [("C1", "Fund_Value", "20.00", "99", 2)]
    assert not standard.report(wrong).first()["valid"]

    short = standard.wide.filter("Contract_Number <> 'C2'").drop("1301_CUSIP_Number").withColumn("odd", F.lit(1))
    report = standard.report(short).first()
    assert not report["valid"]
    assert report["errors"] == ["Contract count mismatch: expected 3, got 2",
                                "Missing CSV columns: ['1301_CUSIP_Number']", "Extra CSV columns: ['odd']"]
    assert report["error_count"] == 4
    assert [r["contract"] for r in reconcile.missing_contracts(standard.records, short).collect()] == ["C2"]
    missing = {(r["contract"], r["record_type"])
               for r in reconcile.missing_record_types(standard.records, short, standard.limits).collect()}
    assert missing == {("C1", "1301"), ("C2", "1301")}
    assert report["missing_record_type_count"] == 2


def test_second_header_overwrites_and_is_reported(spark):
    body = [line("1301", "C", Contract_Status="VA"), line("1301", "C", Contract_Status="SU")]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(body)],
                               "file string, line_no bigint, value string")
    parsed = records.parse_records(df)
    wide = flatten.flatten(parsed)
    assert wide.first()["1301_Contract_Status"] == "SU"
    found = reconcile.mismatches(parsed, wide).collect()
    assert [(r["expected"], r["actual"], r["occurrence"]) for r in found] == [("VA", "SU", None)]


def test_wide_csv_round_trip(spark, standard, tmp_path):
    path = tables.write_csv(flatten.csv_rows(standard.wide), str(tmp_path / "wide"))
    back = spark.read.option("header", True).csv(path).na.fill("")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flatten.csv_rows(standard.wide).collect()))


def test_numbering_is_exact_for_a_group_over_many_blocks(spark):
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "other").otherwise("hot").alias("key"), (n - F.col("id")).alias("line_no"))
    got = records.number_in_group(df, ["key"], ["line_no"], F.shiftright("line_no", 6), "occ").collect()
    for key in ("hot", "other"):
        ordered = [r["occ"] for r in sorted((r for r in got if r["key"] == key), key=lambda r: r["line_no"])]
        assert ordered == list(range(1, len(ordered) + 1))


def test_fields_map_has_every_field(spark, standard):
    for r in records.with_fields(standard.records).collect():
        layout = LAYOUTS[r["record_type"]]
        assert r["fields"] == {f.name: r["raw"][f.start - 1:f.start - 1 + f.width].strip()
                               for f in layout.fields}


def test_facts_of_records_and_of_wide_rows_agree(spark, sf):
    from contractloom.workloads import fixture

    lines = fixture.position_lines(spark, sf)
    parsed = records.parse_records(lines)
    a = contracts.facts_from_records(parsed).drop("contra")
    b = contracts.facts_from_wide(flatten.flatten(parsed)).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
