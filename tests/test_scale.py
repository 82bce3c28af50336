"""What keeps the work of a line and the files of a query small."""

import os
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from contractloom.functions import text
from contractloom.operators import contracts, documents, flatten, reconcile, records, rules
from contractloom.plans import pipeline
from contractloom.sources import fixed_width, shared, tables
from contractloom.spec.layouts import LAYOUTS
from contractloom.workloads import fixture, queries

LINES = "file string, line_no bigint, value string"


def method_sizes(df, capsys):
    """The bytes of the largest method of each generated stage; the JVM only interprets one of more than 8000."""
    capsys.readouterr()
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the stages are not known before they run
    try:
        df.select("*").explain(mode="codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]


def test_facts_are_cut_by_compiled_methods(spark, capsys):
    lines = spark.createDataFrame([("f", 1, "P1301" + " " * 331)], LINES)
    facts = contracts.facts_from_records(records.parse_records(lines))
    sizes = method_sizes(facts, capsys)
    assert sizes and max(sizes) < 8000


def test_amounts_are_cut_by_compiled_methods(spark, capsys):
    lines = spark.createDataFrame([("f", 1, "P1302" + " " * 331)], LINES)
    sizes = method_sizes(contracts.qualifier_amount(records.parse_records(lines), "RA"), capsys)
    assert sizes and max(sizes) < 8000


def test_requests_are_mapped_and_audited_by_compiled_methods(spark, capsys):
    lines = spark.createDataFrame([("f", 1, "P1301" + " " * 331)], LINES)
    facts = contracts.facts_from_records(records.parse_records(lines))
    for distributor in (None, "0015"):
        audited = pipeline.quote_requests(facts, run_ts=queries.RUN_TS, distributor=distributor).validation
        sizes = method_sizes(audited, capsys)
        assert sizes and max(sizes) < 8000


def test_ends_of_short_texts(spark):
    texts = ["", "1", "12x", "1-2-3", "1234", "12345", "ab", "é1", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.last4(F.col("t")), text.strip_suffix(F.col("t")))
    assert [tuple(r)[1:] for r in rows.orderBy("i").collect()] == [
        ("", ""), ("1", "1"), ("12", "12x"), ("123", "1-2-3"), ("1234", "1234"), ("2345", "12345"), ("", "ab"), ("1", "é1"), ("", None)]


def test_line_files_are_packed_and_in_order(spark, sf):
    path = queries._line_files(spark, sf, extended=True)
    characters = fixture.position_lines(spark, sf).agg(F.sum(F.length("value") + 1)).first()[0]
    written = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert sum(os.path.getsize(f) for f in written) * 5 < characters
    back = fixed_width.scan_lines(spark, f"{path}/*").withColumn("bucket", F.regexp_extract("file", "bucket=([0-9])", 1))
    in_files = Window.partitionBy("bucket").orderBy("file", "line_no")
    in_table = Window.partitionBy("bucket").orderBy("line_no")
    got = back.select("bucket", F.row_number().over(in_files).alias("n"), "value")
    want = fixture.position_lines(spark, sf).withColumn("bucket", F.substring("file", 5, 1)).select("bucket", F.row_number().over(in_table).alias("n"), "value")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_lines_are_written_once_however_they_are_asked_for(spark, sf):
    assert fixture.position_lines(spark, sf) is fixture.position_lines(spark, sf, extended=True)


def test_missing_contracts_are_found_without_a_broadcast(spark, capsys):
    """The keys of the wide table are as many as the contracts, however few of its bytes they are."""
    rows = [("f", "C1", "1301"), ("f", "C1", "1302"), ("f", "C1", "1302"), ("f", "C2", "1301"), ("g", "C1", "1301"), (None, "C3", "1301"), ("f", "", "100")]
    parsed = spark.createDataFrame(rows, "file string, contract string, record_type string")
    wide = spark.createDataFrame([("f", "C1 ", ""), ("f", "C1", ""), (None, "C3", ""), ("f", "C9", ""), ("g", None, "")],
                                 "file string, Contract_Number string, `1301_CUSIP_Number` string")
    lost = reconcile.missing_contracts(parsed, wide)
    types = reconcile.missing_record_types(parsed, wide, {"1301": 1, "1302": 1})
    assert sorted(map(tuple, lost.collect()), key=str) == [("f", "C2"), ("g", "C1"), (None, "C3")]
    assert sorted(map(tuple, types.collect()), key=str) == [
        ("f", "C1", "1302"), ("f", "C2", "1301"), ("g", "C1", "1301"), (None, "C3", "1301")]
    capsys.readouterr()
    for df in (lost, types):
        df.explain()
        assert "Join" not in capsys.readouterr().out


def test_occurrences_are_counted_once_for_parts_of_the_records(spark, sf, monkeypatch):
    queries._limits(spark, sf)
    monkeypatch.setattr(flatten, "occurrence_limits", None)
    n = queries._records(spark, sf).select("file", "contract").filter("contract is not null").distinct().count()
    assert queries.union_files(spark, sf).count() == 2 * n


def test_lines_of_contracts_are_dealt_once_to_be_reconciled(spark, capsys):
    """One shuffle of the lines for their numbers and for the wide row they meet, and no unpivoted slots."""
    lines = spark.createDataFrame([("f", i, f"P1303{' ' * 295}") for i in range(3)], LINES)
    parsed = records.parse_records(lines)
    limits = {"1301": 1, "1303": 3}
    wide = flatten.flatten(parsed, limits, counted=True)
    wide = spark.createDataFrame(wide.collect(), wide.schema)
    capsys.readouterr()
    reconcile.mismatches(parsed, wide, limits).explain()
    plan = capsys.readouterr().out
    assert "inline(" not in plan and "record_type#" in plan
    assert plan.count("REPARTITION_BY_COL") == 1 and "file#" in plan.split("REPARTITION_BY_COL")[0].rsplit("hashpartitioning(", 1)[1]
    assert not [p for p in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if "slot#" in p]


def test_reconciliation_of_empty_odd_and_stray_slots(spark):
    """Empty slots, slots beyond the wide row, types it does not know, lines without a contract, null and repeated keys."""
    def line(t, contract, value=""):
        spans = {f.name: f for f in LAYOUTS[t].fields}
        cells = [" "] * 300
        for at, v in ((1, "P" + t), (spans["Contract_Number"].start, contract), (LAYOUTS[t].data_fields[0].start, value)):
            cells[at - 1:at - 1 + len(v)] = v
        return "".join(cells)

    rows = [("f", "1303", "A", "X"), ("f", "1303", "A", ""), ("f", "1303", "A", "Y"), ("f", "1305", "A", ""), ("f", "1301", "B", "Z"),
            ("f", "1303", "", "S1"), ("f", "1303", "", "S2"), ("f", "1303", "", "S3"), (None, "1303", "A", "N")]
    lines = spark.createDataFrame([(f, i, line(t, c, v)) for i, (f, t, c, v) in enumerate(rows)], LINES)
    parsed, first = records.parse_records(lines), LAYOUTS["1303"].data_fields[0].name
    wide = spark.createDataFrame(
        [("f", "A ", " X ", None), ("f", "A", "", "W"), ("f", records.NO_CONTRACT, "S1", "S2"), (None, "A", "N", "")],
        f"file string, Contract_Number string, `1303_{first}_1` string, `1303_{first}_2` string")
    limits = {"1301": 1, "1303": 2}
    got = sorted((r["contract_number"], r["line_no"], r["field_name"], r["expected"], r["actual"]) for r in reconcile.mismatches(parsed, wide, limits).collect())
    assert got == [("A", 0, first, "X", ""), ("A", 1, first, "", "W")]
    report = reconcile.report(parsed, wide, limits).first()
    assert (report["mismatch_count"], report["unplaced_records"]) == (2, 1)
    assert report["total_fields_checked"] == 6 * len(LAYOUTS["1303"].data_fields)


def test_a_line_is_compared_at_once_and_by_fields_where_it_differs(spark):
    """Cells travel as one text filled up to the widths; long, short, odd and indented ones are compared as before."""
    fields = LAYOUTS["1303"].data_fields
    a, b, last = fields[0], fields[1], fields[-1]

    def line(contract, values):
        cells = [" "] * 300
        for f, v in {LAYOUTS["1303"].field("Contract_Number"): contract, **values}.items():
            cells[f.start - 1:f.start - 1 + f.width] = v.ljust(f.width)
        cells[:5] = "P1303"
        return "".join(cells)

    rows = {"A": ({a: "X", last: "Z"}, {a: "X", last: "Z"}, []),
            "B": ({a: "  X"}, {a: "X"}, []),  # not at the left of its field
            "C": ({a: "é", b: "\tY"}, {a: " é", b: "Y "}, []),
            "D": ({a: "X"}, {a: "X" * (a.width + 1)}, [(a.name, "X", "X" * (a.width + 1))]),
            "E": ({a: "X" * a.width}, {a: "X" * a.width + "\t", b: ""}, []),
            "F": ({b: "Y"}, {a: "Y"}, [(a.name, "", "Y"), (b.name, "Y", "")]),
            "G": ({}, {a: None, b: " "}, [])}
    lines = spark.createDataFrame([("f", i, line(c, said)) for i, (c, (said, *_)) in enumerate(rows.items())] + [("f", 9, line("H", {a: "X"}).rstrip())], LINES)
    wide = spark.createDataFrame(
        [("f", c, *(shown.get(f, "") for f in fields)) for c, (_, shown, _) in rows.items()] + [("f", "H", "X", *[""] * (len(fields) - 1))],
        "file string, Contract_Number string, " + ", ".join(f"`1303_{f.name}` string" for f in fields))
    packed = {r["contract"]: r["packed"][0][0] for r in reconcile.packed_rows(wide, {"1303": 1}).collect()}
    assert packed["A"]["part"] == line("", {a: "X", last: "Z"})[a.start - 1:a.start - 1 + 140] + line("", {last: "Z"})[288:].rstrip()
    assert packed["G"]["part"] == "" and packed["A"]["list"] is None and packed["D"]["part"] is None and packed["D"]["list"][0] == "X" * (a.width + 1)
    found = reconcile.mismatches(records.parse_records(lines), wide, {"1303": 1}).collect()
    assert sorted((r["contract_number"], r["field_name"], r["expected"], r["actual"]) for r in found) == sorted(
        (c, *d) for c, (_, _, different) in rows.items() for d in different)
    assert reconcile.report(records.parse_records(lines), wide, {"1303": 1}).first()["total_fields_checked"] == 8 * len(fields)


def test_lists_of_errors_are_made_by_compiled_code(spark, capsys):
    """A lambda over the list of errors would have every rule worked out without compiling it."""
    rows = spark.createDataFrame([(1, "a", None, "c"), (2, None, None, None), (3, "a", "", "a")], "i int, x string, y string, z string")
    items = [F.col(c) for c in "xyz"]
    got = rows.select("i", text.those_present(items).alias("new"), F.array_compact(F.array(*items)).alias("old"), text.those_present([]).alias("none"))
    assert [(r["new"], r["none"]) for r in got.orderBy("i").collect()] == [(r["old"], []) for r in got.orderBy("i").collect()]
    requests = spark.createDataFrame([], tables.request_schema())
    capsys.readouterr()
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        rules.apply_rules(requests).explain()
        documents.validate_documents(spark.createDataFrame([], "xml string")).select("errors").explain()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    plan = capsys.readouterr().out
    assert "flatten(" in plan and "isnotnull(lambda" not in plan
    assert plan.count("trim(TransExeDate#") == 1  # a value is stripped in one place, however many rules look at it


def test_parties_with_a_null_among_them(spark):
    docs = spark.createDataFrame([(True, ["Party_Agent", None], None), (True, None, []), (False, [], [])],
                                 "olife boolean, parties array<string>, relations array<string>").select(F.struct("*").alias("doc"))
    errors = docs.select(text.those_present(documents.presence_errors(F.col("doc"))).alias("e")).collect()
    assert [len(r["e"]) for r in errors] == [3, 4, 1] and errors[2]["e"] == ["OLifE element not found"]


def test_written_tables_have_no_file_of_many_rows(spark, monkeypatch):
    """A file of one row group is one task's work, whatever its lines compress to."""
    monkeypatch.setattr(shared, "ROWS_PER_FILE", 10)
    back = shared.written(spark.range(95).repartition(1), "rows")
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()]
    assert max(sizes) == 10 and sum(sizes) == 95
    back = shared.written(spark.range(20).repartition(1).select("id", *(F.lit(i).alias(f"c{i}") for i in range(400))), "wide-rows")
    assert back.select("_metadata.file_path").distinct().count() == 10  # fewer of wider rows


def test_lines_are_not_shuffled_for_their_numbers(spark, tmp_path, capsys):
    (tmp_path / "a.txt").write_text("x\ny\nz\n")
    (tmp_path / "b.txt").write_text("u\n")
    scanned = fixed_width.scan_lines(spark, str(tmp_path))
    capsys.readouterr()
    scanned.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    assert sorted((r["file"][-5:], r["line_no"], r["value"]) for r in scanned.collect()) == [
        ("a.txt", 1, "x"), ("a.txt", 2, "y"), ("a.txt", 3, "z"), ("b.txt", 1, "u")]


def test_documents_stores_and_request_files_are_compressed(spark, sf, tmp_path):
    """Documents of one layout and lines full of blanks take a fraction of their characters."""
    texts = spark.range(2000).select(F.concat(F.lit("<a>" + "some tag of every document " * 40), F.md5(F.col("id").cast("string"))).alias("xml"),
                                     F.lit("success").alias("outcome"))
    tables.write_by_outcome(texts, str(tmp_path / "out"), run_id="r")
    names = [os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "out") for f in fs if f.endswith(".parquet")]
    assert names and all(".zstd." in n for n in names)
    folder = queries._store(spark, sf).folder
    assert all(".zstd." in f for _, _, fs in os.walk(f"{folder}/lines") for f in fs if f.endswith(".parquet"))
    assert all(f.endswith(".csv.gz") for f in os.listdir(queries._request_csv(spark, sf)) if f.startswith("part-"))
    path = tables.write_csv(texts.limit(3), str(tmp_path / "plain"))
    assert all(f.endswith(".csv") for f in os.listdir(path) if f.startswith("part-"))


def test_tables_dealt_already_are_not_shuffled_again_to_be_written(spark, sf, monkeypatch):
    """Requests come dealt by contract and verdicts in the files of their requests."""
    spread = []
    monkeypatch.setattr(queries, "written", lambda df, name, by=None, **kw: spread.append((name, by)) or shared.written(df, name, by, **kw))
    queries._broken.__wrapped__(spark, sf)
    queries._checked.__wrapped__(spark, sf)
    queries.reconcile_stray_report(spark, sf)
    assert dict(spread) == {"requests": None, "checked": None, "stray-wide": None}


def test_requests_are_dealt_to_several_tasks_a_core_to_be_made_documents(spark, sf, capsys):
    capsys.readouterr()
    queries.scorecard(spark, sf).explain()
    assert f", {4 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in capsys.readouterr().out
