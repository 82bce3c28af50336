"""What reading a line costs: its type without counting its characters, groups sorted by contract, fields in parts."""

import glob
import os

from pyspark.sql import functions as F

from contractloom.operators import contracts, flatten, records
from contractloom.sources.shared import written
from contractloom.spec.layouts import LAYOUTS
from contractloom.workloads import queries
from contractloom.workloads.shared import shared_folder

LINES = "file string, line_no bigint, value string"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))


def line(record_type, **values):
    width = max(f.start + f.width - 1 for f in LAYOUTS[record_type].fields)
    chars = list("P" + record_type + " " * (width - 5))
    for name, value in values.items():
        f = LAYOUTS[record_type].field(name)
        chars[f.start - 1:f.start - 1 + f.width] = value.ljust(f.width)[:f.width]
    return "".join(chars)


def test_types_of_short_and_of_non_ascii_lines(spark):
    texts = ["P130", "P1301", "é1302", "é130", "", None, "P10", "P10xx", "P9999"]
    lines = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], LINES)
    parsed = records.parse_records(lines)
    assert {r["line_no"]: r["record_type"] for r in parsed.collect()} == {1: "1301", 2: "1302", 7: "100"}
    assert "length(value" not in plan(parsed).split("== Optimized Logical Plan ==")[1]


def test_facts_of_non_ascii_lines_sorted_by_contract(spark):
    party = "Ünal".ljust(35) + "Zoë".ljust(25)
    lines = spark.createDataFrame([
        ("f", 1, line("1301", Contract_Number="Cé1", Contract_Status="VA", Distributors_Account_ID="Añ", Contract_State="07")),
        ("f", 2, line("1302", Contract_Number="Cé1", Contract_Value_Amount_2=" 12.50", Contract_Value_Qualifier_2="RA",
                      Contract_Value_Amount_5="99.25", Contract_Value_Qualifier_5="SC")),
        ("f", 3, line("1305", Contract_Number="Cé1", Agent_Non_Natural_Name="Bé", Agent_Last_Name="N1234567")),
        ("f", 4, line("1309", Contract_Number="Cé1", Party_Non_Natural_Entity_Name=party, Party_Last_Name="OKé77")),
        ("f", 5, line("1315", Contract_Number="Cé1", Service_Feature_Program_Type="R", Service_Feature_Type_Code_1="204",
                      Service_Feature_Value="5")),
    ], LINES)
    facts = contracts.facts_from_records(records.parse_records(lines))
    (r,) = facts.collect()
    assert (r["contract"], r["status"], r["account"], r["state"]) == ("Cé1", "VA", "Añ", "07")
    assert (r["ra_amount"], r["sc_amount"], r["tw_amount"], r["total_value"], r["rider"]) == (12.5, 99.25, None, 99.25, True)
    assert (r["agent_name"], r["agent_last_name"], r["owner_fallback_id"]) == ("Bé", "N1234567", "é77")
    assert tuple(r["owner"]) == ("Ünal", "Zoë", "", "é77")
    by_id = contracts.party_id_fallback(records.parse_records(lines), contracts.OWNER_ROLES)
    assert [tuple(x) for x in by_id.collect()] == [("f", "Cé1", "é77")]
    for df in (facts, by_id):
        sorts = [x for x in plan(df).split("== Physical Plan ==")[1].splitlines() if "Sort [" in x]
        assert sorts and all("Sort [contract#" in x for x in sorts)


def test_cells_of_the_wide_row_by_bytes_and_by_characters(spark):
    rows = [("f", i, line("1301", Contract_Number=f"C{i}", CUSIP_Number=c, Contract_State="09")) for i, c in enumerate(("AB", "é9"))]
    wide = flatten.flatten(records.parse_records(spark.createDataFrame(rows, LINES)))
    cells = wide.select("Contract_Number", F.col("1301_CUSIP_Number"), F.col("1301_Contract_State"))
    assert sorted(tuple(r) for r in cells.collect()) == [("C0", "AB", "09"), ("C1", "é9", "09")]
    assert "as binary" in plan(wide).lower()


def test_written_tables_are_small(spark):
    table = written(spark.range(10), "small")
    files = table.inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert glob.glob(os.path.join(shared_folder(spark), "small-*"))


def test_values_of_a_layout_field_are_dealt_by_value(spark, sf):
    text = plan(queries.QUERIES["parse_all_layouts"](spark, sf)).split("== Physical Plan ==")[1]
    assert "hashpartitioning(place" in text and "hashpartitioning(record_type" not in text
