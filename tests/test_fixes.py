"""Cases that once gave a wrong or an unordered result."""

from pyspark.sql import functions as F

from contractloom.operators import contracts, documents, requests, responses
from contractloom.workloads import fixture, queries

XML = '<Envelope xmlns="http://www.w3.org/2003/05/soap-envelope"><Body/></Envelope>'


def test_status_filter_without_a_status_column(spark):
    wide = spark.createDataFrame([("C1", "x"), ("C2", "y")], "Contract_Number string, 1301_CUSIP_Number string")
    assert contracts.filter_active(contracts.facts_from_wide(wide)).count() == 2
    wide = wide.withColumn("1301_Contract_Status", F.when(F.col("Contract_Number") == "C1", "").otherwise("ZZ"))
    assert contracts.filter_active(contracts.facts_from_wide(wide)).count() == 0


def test_blank_policies_do_not_multiply(spark):
    left = spark.createDataFrame([("", "Failure"), ("000", "Failure"), ("0012", "Success"), (None, "Success")], "Policy_Number string, Status string")
    right = spark.createDataFrame([("", "a"), ("0", "b"), ("12", "c")], "PolNumber string, Result string")
    rows = responses.crossref_responses(left, right).collect()
    assert len(rows) == 4
    got = {r["Policy_Number"]: r["Result"] for r in rows}
    assert got == {"0012": "c", "000": "b", "": None, None: None}


def test_counts_come_most_frequent_first(spark):
    rows = [("A; B", "1"), ("B", "2"), ("B", "2"), ("C; A", "1")]
    table = spark.createDataFrame(rows, "Failure_Reasons string, Predicted_Error_Codes string")
    got = [(r["kind"], r["item"], r["n"]) for r in requests.failure_breakdown(table).collect()]
    assert got == [("code", "1", 2), ("code", "2", 2), ("reason", "B", 3), ("reason", "A", 2), ("reason", "C", 1)]


def test_document_type_and_spaced_declarations_are_well_formed(spark):
    texts = [
        "<!DOCTYPE Envelope>" + XML,
        '<!DOCTYPE Envelope [<!ELEMENT Body EMPTY>]>' + XML,
        '<s:Envelope xmlns:s ="http://www.w3.org/2003/05/soap-envelope"><s:Body/></s:Envelope>',
        '<s:Envelope><s:Body/></s:Envelope>', XML + "x", XML[:-3],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, xml string")
    bad = documents.parse_documents(df).orderBy("i").select("doc.malformed").collect()
    assert [r[0] for r in bad] == [False, False, False, True, True, True]


def test_responses_are_read_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text('Status,Policy_Number,Other\nFailure,0012,x\nSuccess,"a ""b""",y\n')
    rows = responses.read_responses(spark, str(tmp_path)).orderBy("Status").collect()
    assert [(r["Policy_Number"], r["Status"], r["Result_code"]) for r in rows] == [("0012", "Failure", None), ('a "b"', "Success", None)]


def test_enhanced_scorecard_is_whole(spark, sf):
    """Every column of the scorecard is in the result, so that none of its lists is left out."""
    made = queries.enhanced_scorecard(spark, sf)
    want = ["PolNumber", "FileName", "Status", "ErrorDetails", "MatchedFields", "MatchedCount", "MissingFields", "MissingCount",
            "CustomFields", "CustomCount", "ConformancePct", "Timestamp"]
    assert made.columns == want
    for r in made.limit(5).collect():
        assert len(r["MatchedFields"].split("; ")) == int(r["MatchedCount"]) and len(r["MissingFields"].split("; ")) == int(r["MissingCount"])
        assert (r["ErrorDetails"] is None) == (r["Status"] == "PASS") and r["Timestamp"] == queries.RUN_TS


def test_places_are_summed_beyond_64_bits(spark, monkeypatch):
    lines = spark.createDataFrame([("f", (1 << 62) + i, f"P1303{' ' * 31}{i}") for i in range(9)], "file string, line_no bigint, value string")
    monkeypatch.setattr(fixture, "layout_lines", lambda spark, sf: lines.filter("line_no < 0"))
    headers = lines.select("file", "line_no", F.lit("P1301" + " " * 295).alias("value"))
    for given in (lines, headers):
        one = given.withColumn("file", F.col("line_no").cast("string"))  # the first of its contract in each file
        monkeypatch.setattr(queries, "_lines", lambda spark, sf, one=one: one)
        got = queries.occurrence_numbers(spark, "").collect()
        assert [(r["occ"], r["n"], int(r["places"])) for r in got] == [(1, 9, 9 * (1 << 62) + 36)]
