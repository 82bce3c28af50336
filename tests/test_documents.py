import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from contractloom.operators import contracts, documents, requests, rules
from contractloom.plans import pipeline
from contractloom.sources import tables
from contractloom.spec.dictionary import COLUMNS, RELATIONS, field_tags

NS3 = "{http://ACORD.org/Standards/Life/2}"


def valid_row(policy="POL-1", **changes):
    values = {**requests.PROTOCOL, **{k: v for k, v in requests.DEFAULTS.items() if k in COLUMNS}}
    values |= {
        "TransRefGUID": "0123456789abcdef0123-x", "TransExeDate": "2026-01-02",
        "TransExeTime": "03:04:05+00:00", "PolNumber": policy, "CusipNum": "CU1",
        "DistributorClientAcctNum": "ACCT", "Policy_CarrierCode": "4500", "Party_Carrier_CarrierCode": "4500",
        "Party_Agent_NIPRNumber": "1234567", "ModalAmt": "5.00",
    }
    for role, kind in (("Agent", "Person"), ("PrimaryOwner", "Person"), ("PrimaryAnnuitant", "Person"),
                       ("Distributor", "Organization"), ("Carrier", "Organization")):
        p = f"Party_{role}"
        values |= {f"{p}_id": p, f"{p}_PartyTypeCode_text": kind,
                   f"{p}_PartyTypeCode_tc": "1" if kind == "Person" else "2"}
        if kind == "Person":
            values |= {f"{p}_FirstName": "ANY", f"{p}_LastName": "ONE", f"{p}_IDPart": "1234",
                       f"{p}_PartialIDType_tc": "1", f"{p}_PartialIDType_text": "SSN"}
        else:
            values |= {f"{p}_DTCCMemberCode": "0015", f"{p}_DTCCAssociatedMemberCode": "0015"}
    for role, code, text, party in RELATIONS:
        p = f"Relation_{role}"
        values |= {f"{p}_id": f"{role}_Relation", f"{p}_OriginatingObjectID": "Holding_1",
                   f"{p}_RelatedObjectID": party, f"{p}_OriginatingObjectType_tc": "4",
                   f"{p}_OriginatingObjectType_text": "Holding", f"{p}_RelatedObjectType_tc": "6",
                   f"{p}_RelatedObjectType_text": "Party", f"{p}_RoleCode_tc": code,
                   f"{p}_RoleCode_text": text}
    return {**values, **changes}


def request_frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in COLUMNS) for r in rows],
                                 tables.request_schema())


@pytest.fixture(scope="module")
def good_xml(spark):
    return documents.render_documents(request_frame(spark, [valid_row()])).first()["xml"]


def test_render_is_well_formed_and_whole(good_xml):
    root = ET.fromstring(good_xml)
    tags = {e.tag.split("}")[-1] for e in root.iter()}
    assert set(field_tags()) - tags == {"operationNs", "OriginatingObjectID", "RelatedObjectID"}
    assert root.find(f".//{NS3}PolNumber").text == "POL-1"
    assert root.find(".//ModalAmt").text == "5.00"
    assert [p.get("id") for p in root.iter(f"{NS3}Party")] == [
        "Party_Agent", "Party_Distributor", "Party_Carrier", "Party_PrimaryOwner", "Party_PrimaryAnnuitant"]
    assert good_xml.endswith("</soap:Envelope>\n") and "\n\n" not in good_xml


def test_render_leaves_out_and_escapes(spark):
    rows = [valid_row("A&B<1>", ModalAmt=" ", Party_PrimaryAnnuitant_id=None, TransRefGUID="",
                      Holding_id='H"1', OLifEExtension_VendorCode="", AmountQualifier_tc="", TaxState_id="",
                      PendingResponseOK_tc="", PendingResponseOK_text="", TransType_tc="")]
    xml = documents.render_documents(request_frame(spark, rows)).first()["xml"]
    root = ET.fromstring(xml)
    assert root.find(f".//{NS3}PolNumber").text == "A&B<1>"
    assert root.find(f".//{NS3}Holding").get("id") == 'H"1'
    assert root.find(f".//{NS3}TransRefGUID").text is None
    assert "tc" not in root.find(f".//{NS3}TransType").attrib
    for gone in ("ModalAmt", "OLifEExtension", "PendingResponseOK", "Party_PrimaryAnnuitant\"><"):
        assert f"{gone}>" not in xml
    assert len(root.findall(f".//{NS3}TaxWithholding")) == 1


def validate(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, xml string")
    return documents.validate_documents(frame).orderBy("i").collect()


def test_validate_good_and_broken(spark, good_xml):
    def swap(a, b):
        assert a in good_xml
        return good_xml.replace(a, b)

    two = good_xml.replace('<ns3:TaxWithholdingPlace tc="2">State', '<ns3:TaxWithholdingPlace tc="1">Federal')
    cases = [
        (good_xml, []),
        (swap(">POL-1<", "><"), ["Required field 'PolNumber' is missing or empty"]),
        (swap('tc="212"', 'tc="9"'), ["Field 'TransType_tc' has invalid value '9'; allowed: ['212']"]),
        (swap("2026-01-02", "02/01/2026"), [
            "Field 'TransExeDate' value '02/01/2026' does not match pattern ^\\d{4}-\\d{2}-\\d{2}$"]),
        (swap("<ModalAmt>5.00</ModalAmt>", ""), [
            "Conditional field 'ModalAmt' required when ArrSubType tc=4 (Specified Amount)"]),
        (swap("<ModalAmt>5.00</ModalAmt>", "<ns3:ModalAmt>5.00</ns3:ModalAmt>"), [
            "Conditional field 'ModalAmt' required when ArrSubType tc=4 (Specified Amount)"]),
        (swap('<ns3:Party id="Party_Agent">', '<ns3:Party id="Other">'), [
            "Required Party 'Party_Agent' not found"]),
        (swap('id="Owner_Relation"', 'id="x"'), ["Required Relation 'Owner_Relation' not found"]),
        (swap("<ns3:Annuity/>", ""), ["Required field 'Annuity_present' is missing or empty"]),
        (two, [f"Required field 'TaxState_{c}' is missing or empty" for c in (
            "id", "AppliesToPartyID", "Place_tc", "Place_text", "Type_tc", "Type_text")]),
        (swap(">POL-1<", ">" + "P" * 31 + "<"), ["Field 'PolNumber' exceeds max length 30 (got 31)"]),
    ]
    got = validate(spark, [x for x, _ in cases])
    assert [r["errors"] for r in got] == [e for _, e in cases]
    assert [r["valid"] for r in got] == [not e for _, e in cases]
    assert got[0]["policy_number"] == "POL-1" and got[1]["policy_number"] == "UNKNOWN"


def test_validate_malformed_and_foreign(spark, good_xml):
    malformed = ["<a><b></a>", "", "not xml", None, "<a></a><b></b>", "<q:a/>"]
    for row in validate(spark, malformed):
        assert (row["policy_number"], row["valid"], row["errors"]) == ("UNKNOWN", False, [documents.MALFORMED])
    wrong, other_ns, bare = validate(spark, [
        "<Wrong>x</Wrong>", good_xml.replace("http://ACORD.org/Standards/Life/2", "urn:other"),
        '<TXLife xmlns="http://ACORD.org/Standards/Life/2"><TXLifeRequest/></TXLife>'])
    assert wrong["errors"][0] == "SOAP Envelope element not found"
    assert wrong["errors"][-1] == "OLifE element not found"
    assert "Required field 'MessageType' is missing or empty" in other_ns["errors"]
    assert "Required field 'OperationName' is missing or empty" not in other_ns["errors"]
    assert not bare["valid"]


def test_the_first_of_repeated_elements_counts(spark, good_xml):
    twice = good_xml.replace("<ns3:PolNumber>POL-1</ns3:PolNumber>",
                             "<ns3:PolNumber>FIRST</ns3:PolNumber><ns3:PolNumber>SECOND</ns3:PolNumber>")
    assert validate(spark, [twice])[0]["policy_number"] == "FIRST"


def test_analysis(spark, good_xml):
    extra = good_xml.replace("<ns3:Annuity/>", "<ns3:Custom/><!-- <Hidden/> -->")
    frame = spark.createDataFrame([(0, good_xml), (1, extra), (2, "<broken")], "i int, xml string")
    full, custom, bad = documents.analyze_documents(frame).orderBy("i").collect()
    assert full["status"] == "PASS" and full["conformance_pct"] == round(42 / 45 * 100, 1)
    assert custom["custom_fields"] == ["Custom"] and "Annuity" in custom["missing_fields"]
    assert (bad["matched_fields"], bad["conformance_pct"], bad["status"]) == ([], 0.0, "FAIL")


def test_conformance_rounds_like_python(spark):
    known = [f"t{i:02}" for i in range(45)]
    frame = spark.createDataFrame([(n, known[:n]) for n in range(46)], "n int, tags array<string>")
    out = frame.select("n", documents.tag_analysis(F.col("tags"), known)["conformance_pct"].alias("p"))
    assert {r["n"]: r["p"] for r in out.collect()} == {n: round(n / 45 * 100, 1) for n in range(46)}


def test_scorecards_outcomes_and_files(spark, tmp_path):
    rows = [valid_row("P1"), valid_row("P2", ArrMode_tc="", ExpectedToPass="0", FailureReason="mode")]
    routed, card = pipeline.score_requests(request_frame(spark, rows), timestamp="T")
    got = {r["PolNumber"]: r for r in card.collect()}
    assert (got["P1"]["Status"], got["P1"]["ErrorDetails"], got["P1"]["ExpectedResult"]) == (
        "PASS", None, "ExpectedToPass=1")
    assert (got["P2"]["Status"], got["P2"]["ExpectedResult"]) == ("FAIL", "ExpectedToPass=0; Reason=mode")
    assert got["P2"]["ErrorDetails"] == "Required field 'ArrMode_tc' is missing or empty"
    folder = str(tmp_path / "out")
    assert tables.export_documents(routed, folder).count() == 2
    assert (tmp_path / "out" / "success" / "WDQuote_P1.xml").exists()
    assert (tmp_path / "out" / "unsuccessful" / "WDQuote_P2.xml").exists()
    analyzed, enhanced = pipeline.analyze_external(spark, folder + "/*", timestamp="T")
    assert {r["filename"]: r["outcome"] for r in analyzed.collect()} == {
        "WDQuote_P1.xml": "success", "WDQuote_P2.xml": "unsuccessful"}
    assert [f.dataType.simpleString() for f in enhanced.schema] == ["string"] * 10 + ["float", "string"]


def test_last_request_of_a_file_name_wins(spark):
    frame = request_frame(spark, [valid_row("P/1", CusipNum="A"), valid_row("P_1", CusipNum="B")])
    numbered = frame.withColumn("first_line", F.when(F.col("CusipNum") == "A", 1).otherwise(2))
    rows = documents.document_table(numbered, ["first_line"]).collect()
    assert [r["filename"] for r in rows] == ["WDQuote_P_1.xml"] and "<ns3:CusipNum>B<" in rows[0]["xml"]


def test_rules_on_tables(spark):
    rows = [valid_row("P1"), valid_row("P2", Relation_Owner_RoleCode_tc="9", ModalAmt=""),
            valid_row("P3", AmountQualifier_tc="", Relation_Annuitant_id="")]
    frame = request_frame(spark, rows)
    got = {r["PolNumber"]: r["errors"] for r in rules.apply_rules(frame).collect()}
    assert got["P1"] == [] and got["P3"] == []
    assert got["P2"] == ["Field 'Relation_Owner_RoleCode_tc' has invalid value '9'; allowed: ['8']",
                         "Conditional field 'ModalAmt' required when ArrSubType tc=4 (Specified Amount)"]
    strict = rules.apply_rules(frame, [], rules.OPTIONAL_CONDITIONS).collect()
    assert {r["PolNumber"]: len(r["errors"]) for r in strict} == {"P1": 0, "P2": 0, "P3": 2}


def test_request_csv_view_and_table(spark, tmp_path):
    row = valid_row("P1", FailureReason='say "x", y')
    text = ",".join(COLUMNS) + "\n" + ",".join(
        '"' + (row.get(c) or "").replace('"', '""') + '"' for c in COLUMNS) + "\n"
    (tmp_path / "r.csv").write_text("﻿" + text, encoding="utf-8")
    df = tables.load_csv(spark, str(tmp_path / "r.csv"), "requests_view")
    got = tables.read_table(spark, "requests_view").first()
    assert df.columns == list(COLUMNS)
    assert (got["SoapEnvelopeNs"], got["PolNumber"], got["FailureReason"]) == (
        row["SoapEnvelopeNs"], "P1", 'say "x", y')
    latin = tmp_path / "l.csv"
    latin.write_bytes(text.replace("ANY", "Jé").encode("latin-1"))
    assert tables.read_request_csv(spark, str(latin), encoding="ISO-8859-1").first()["Party_Agent_FirstName"] == "Jé"
    assert requests.filter_expected(df).count() == 1


def test_facts_to_documents(spark, sf):
    """The whole chain on the driver's tables: documents of complete contracts only lack the agent id."""
    from contractloom.workloads.queries import _quotes

    quotes = _quotes(spark, sf)
    failing = documents.validate_documents(documents.render_documents(quotes.requests)).filter("not valid")
    assert quotes.requests.count() > 0 and failing.count() == 0
    assert contracts.withdrawal_distribution(quotes.classified).count() == 5


def test_request_table_in_a_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE contractloom_test LOCATION '{tmp_path / 'db'}'")
    try:
        for _ in range(2):
            name = tables.create_request_table(spark, "requests", "contractloom_test")
        table = tables.read_table(spark, "requests", "contractloom_test")
        assert name == "contractloom_test.requests" and table.columns == list(COLUMNS)
        assert table.schema["PolNumber"].metadata["comment"] == "Policy number"
        (tmp_path / "r.csv").write_text("PolNumber\nP1\nP2\n")
        schema = tables.request_schema()
        one = type(schema)([schema["PolNumber"]])
        for _ in range(2):
            tables.load_csv(spark, str(tmp_path / "r.csv"), "loaded", schema=one, database="contractloom_test")
        assert tables.read_table(spark, "loaded", "contractloom_test").count() == 2
    finally:
        spark.sql("DROP DATABASE contractloom_test CASCADE")
