"""The record store, the tag stack and the sinks."""

import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from contractloom.operators import documents, reconcile, responses
from contractloom.operators.tag_stack import Node, read
from contractloom.plans import pipeline
from contractloom.sources import fixed_width, record_store, tables
from test_positions import STANDARD, extended


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text_of(rows):
    return "\n".join(rows) + "\n"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("positions")
    (folder / "A.03212026.txt").write_text(text_of(STANDARD))
    body = [extended("1301", f"C{i}", CUSIP_Number="CU") for i in range(200)] + ["bad", "", extended("4305", "C1")]
    (folder / "B.03202026.txt").write_text(text_of(body))
    return str(folder)


def test_store_matches_the_scan(spark, files, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # many blocks to a file
    try:
        store = record_store.build(spark, files, str(tmp_path / "store"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    lines = fixed_width.scan_lines(spark, files)
    want = sorted(map(tuple, lines.select("file", "line_no", "value").collect()))
    assert sorted(map(tuple, store.lines().collect())) == want
    facts = lambda df: sorted(tuple(str(x) for x in r) for r in df.collect())
    assert facts(store.files()) == facts(fixed_width.file_metadata(lines))
    assert facts(store.rejects()) == facts(fixed_width.rejects(lines, fixed_width.detect_format(lines)))
    assert store.records("1303").count() == 3 and store.records().filter("record_type = '1301'").count() == 202


def test_readers_open_their_partitions_and_no_text(spark, files):
    store = record_store.build(spark, files)
    some = plan(store.records("1303", "1305"))
    assert "PartitionFilters: [isnotnull(kind" in some or "PartitionFilters: [kind" in some
    assert "FileScan text" not in some
    facts = plan(store.files())
    assert "value" not in [c for part in facts.split("ReadSchema: struct<")[1:] for c in part.split(">")[0].replace(":", ",").split(",")]
    positions = pipeline.flatten_positions(spark, files)
    for df in (positions.wide, positions.rejects, positions.files, positions.unplaced, positions.report()):
        assert "FileScan text" not in plan(df)


def test_records_are_joined_with_their_own_slot(spark, files):
    positions = pipeline.flatten_positions(spark, files)
    slots = reconcile.slot_rows(positions.wide, positions.limits)
    assert slots.count() == positions.wide.count() * len(slots.select("record_type", "slot").distinct().collect())
    assert positions.report().first()["valid"]
    wrong = positions.wide.withColumn("1303_Fund_Value_2", F.when(F.col("Contract_Number") == "C1", "20.01").otherwise(F.col("1303_Fund_Value_2")))
    rows = reconcile.mismatches(positions.records, wrong, positions.limits).collect()
    found = {(r["contract_number"], r["field_name"], r["expected"], r["actual"], r["occurrence"]) for r in rows if r["file"].endswith("A.03212026.txt")}
    assert found == {("C1", "Fund_Value", "20.00", "20.01", 2)}


def test_empty_files_have_no_rows(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    store = record_store.build(spark, str(tmp_path))
    assert store.lines().count() == store.files().count() == store.rejects().count() == 0


# --- The tag stack ------------------------------------------------------------------------------

TREES = [
    '<a xmlns="u"><b x="1">t<c/>u</b><b x="2"/></a>',
    '<p:a xmlns:p="u"><q:b xmlns:q="u" x="1"> t </q:b></p:a>',
    '<a xmlns="u"><b xmlns="v" x="1"/><b x="3">three</b></a>',
    '<p:a xmlns:p="u"><p:b xmlns:p="v" x="1"/></p:a>',
    '<!DOCTYPE a [<!ENTITY e "text">]><a xmlns="u"><b>&e;</b></a>',
    "<r><a xmlns='u'><b x='deep'/></a></r>",
]


@pytest.mark.parametrize("text", TREES)
def test_first_elements_are_those_of_a_tree(text):
    top = {"u wrap": Node(), "u b": Node(attributes={"x": "x"}, text="t", exists="there")}
    found = read(text, top)
    element = ET.fromstring(text).find(".//{u}b")
    assert found.get("there", False) == (element is not None)
    if element is not None:
        assert (found["x"], found["t"]) == (element.get("x"), (element.text or "").strip() or None)
    assert list(found["tags"]) == list(dict.fromkeys(e.tag.split("}")[-1] for e in ET.fromstring(text).iter()))


@pytest.mark.parametrize("text", [None, "", "x", "<a>", "<a></b>", "<a/><b/>", "<a/>x", "<p:a/>", "<a><p:b/></a>", "<a>&none;</a>", "<a x=1/>", "<a x='1' x='2'/>"])
def test_what_is_no_document(text):
    assert read(text, {}) is None


def test_parties_of_the_first_tree_alone_count(spark):
    acord = "http://ACORD.org/Standards/Life/2"
    inner = '<OLifE><Party id="One"/><Relation id="R"/></OLifE><OLifE><Party id="Two"/></OLifE>'
    text = f'<e><VI21208_Msg xmlns="{acord}"><TXLife><TXLifeRequest>{inner}</TXLifeRequest></TXLife></VI21208_Msg></e>'
    doc = documents.parse_documents(spark.createDataFrame([(text,)], "xml string")).first()["doc"]
    assert (doc["parties"], doc["relations"], doc["message"], doc["operation"]) == (["One"], ["R"], True, False)


# --- Sinks --------------------------------------------------------------------------------------

def test_a_run_replaces_itself_alone(spark, tmp_path):
    path = str(tmp_path / "runs")
    both = spark.createDataFrame([("a", "<a/>", "success"), ("b", "<b/>", "unsuccessful")], "filename string, xml string, outcome string")
    tables.write_by_outcome(both, path, run_id="20260330")
    tables.write_by_outcome(both, path, run_id="r-2")
    tables.write_by_outcome(both.filter("filename = 'a'"), path, run_id="r-2")
    assert sorted(map(tuple, tables.read_runs(spark, path).select("run_id", "filename").collect())) == [("20260330", "a"), ("20260330", "b"), ("r-2", "a")]
    assert tables.read_runs(spark, path, "20260330").count() == 2
    with pytest.raises(ValueError):
        tables.write_by_outcome(both, path, run_id="../x")


def test_packs_hold_every_document_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PACK_BYTES", 1000)
    rows = [(f"d{i}", "ü" * (i * 7 % 400) + str(i), "success" if i % 2 else "unsuccessful") for i in range(100)] + [("none", None, "success"), ("empty", "", "success")]
    df = spark.createDataFrame(rows, "filename string, xml string, outcome string").repartition(3)
    index = tables.pack_documents(df, str(tmp_path / "packs"))
    assert index.count() == 102 and 10 < index.select("pack").distinct().count() < 60
    back = {r["filename"]: (r["outcome"], r["xml"]) for r in tables.read_packed(spark, str(tmp_path / "packs")).collect()}
    assert back == {n: (o, x or "") for n, x, o in rows}
    some = tables.read_packed(spark, str(tmp_path / "packs"), df.filter("filename in ('d7', 'd8', 'none')").select("filename"))
    assert sorted(r["filename"] for r in some.collect()) == ["d7", "d8", "none"]


def test_wide_tables_of_different_columns_are_one(spark, tmp_path):
    path = str(tmp_path / "wide")
    tables.write_wide(spark.createDataFrame([("1", "x")], "Contract_Number string, a string"), path, "one")
    tables.write_wide(spark.createDataFrame([("2", "y")], "Contract_Number string, b string"), path, "two")
    got = sorted((r["Contract_Number"], r["a"], r["b"]) for r in tables.read_wide(spark, path).collect())
    assert got == [("1", "x", ""), ("2", "", "y")]


def test_broken_responses_are_set_aside(spark, tmp_path):
    (tmp_path / "r.csv").write_text('Status,Policy_Number\nFailure,0012\nonly\nSuccess,"a,b"\nx,y,z\n')
    assert sorted(r["Policy_Number"] for r in responses.read_responses(spark, str(tmp_path)).collect()) == ["0012", "a,b"]
    assert responses.read_responses(spark, str(tmp_path)).select("Status").count() == 2
    assert sorted(r["line"] for r in responses.response_rejects(spark, str(tmp_path)).collect()) == ["only", "x,y,z"]


def test_csv_stands_in_order_of_first_appearance(spark, tmp_path):
    df = spark.range(2000).select(F.lit("f").alias("file"), (F.col("id") * 7919 % 2000).alias("first_line"), F.col("id").cast("string").alias("Contract_Number"))
    path = tables.write_csv(df.repartition(8), str(tmp_path / "csv"), order=["file", "first_line"], drop=["file", "first_line"])
    lines = [x for p in sorted((tmp_path / "csv").glob("part-*")) for x in p.read_text().splitlines()[1:]]
    place = {str(i): i * 7919 % 2000 for i in range(2000)}
    assert path and [place[x] for x in lines] == list(range(2000))
