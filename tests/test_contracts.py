from conftest import evaluate
from pyspark.sql import functions as F

from contractloom.operators import contracts, requests


def wide(spark, rows):
    columns = list({c: None for r in rows for c in r})
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows],
                                 ", ".join(f"`{c}` string" for c in columns))


def facts(spark, rows):
    return {r["contract"]: r for r in contracts.facts_from_wide(wide(spark, rows)).collect()}


def name(last, first="", middle=""):
    return last.ljust(35) + first.ljust(25) + middle.ljust(25)


NAME, LAST = "1309_Party_Non_Natural_Entity_Name", "1309_Party_Last_Name"


def test_parties(spark):
    rows = [
        {"Contract_Number": "P1", f"{NAME}_1": name("SMITH", "JOHN", "Q"), f"{LAST}_1": "OK123456789"},
        {"Contract_Number": "P2", f"{NAME}_1": "CUSTODIAL ACCT", f"{LAST}_1": "HA987654321"},
        {"Contract_Number": "P3", f"{NAME}_1": name("SMITH", "JOHN"), f"{LAST}_1": "G2111111111"},
        {"Contract_Number": "P4", f"{NAME}_1": "   ", f"{LAST}_1": "OK123456789"},
        {"Contract_Number": "P5", f"{NAME}_1": "TRUST ONLY", f"{LAST}_1": "OK222222222",
         f"{NAME}_2": name("DOE", "JANE"), f"{LAST}_2": "OK333333333"},
        {"Contract_Number": "P6", f"{NAME}_25": name("LATE", "OCC"), f"{LAST}_25": "G5555555555"},
    ]
    got = facts(spark, rows)
    assert tuple(got["P1"]["owner"]) == ("SMITH", "JOHN", "Q", "123456789")
    assert tuple(got["P2"]["owner"]) == ("CUSTODIAL ACCT", "", "", "987654321")
    assert tuple(got["P3"]["owner"]) == ("", "", "", "")
    assert got["P3"]["annuitant"]["first"] == "JOHN"
    assert tuple(got["P4"]["owner"]) == ("", "", "", "")
    assert got["P4"]["owner_fallback_id"] == "123456789"
    assert got["P5"]["owner"]["first"] == "JANE"
    assert got["P6"]["annuitant"]["first"] == "OCC"


def test_amounts_and_riders(spark):
    q, a = "1302_Contract_Value_Qualifier_1", "1302_Contract_Value_Amount_1"
    p, c, v = ("1315_Service_Feature_Program_Type", "1315_Service_Feature_Type_Code_1",
               "1315_Service_Feature_Value")
    rows = [
        {"Contract_Number": "A", f"{q}_1": "RA", f"{a}_1": "5000", f"{p}_1": "R", f"{c}_1": "204", f"{v}_1": "100"},
        {"Contract_Number": "B", f"{q}_1": "SC", f"{a}_1": "1200", f"{q}_2": "RA", f"{a}_2": "3000",
         f"{p}_1": "R", f"{c}_1": "336", f"{v}_1": "0"},
        {"Contract_Number": "C", f"{q}_1": "RA", f"{a}_1": "0", f"{p}_1": "X", f"{c}_1": "204", f"{v}_1": "9"},
        {"Contract_Number": "D", f"{q}_1": "TW", f"{a}_1": "800", f"{p}_1": "R", f"{c}_1": "999", f"{v}_1": "9"},
        {"Contract_Number": "E", f"{p}_2": "R", f"{c}_2": "215", f"{v}_2": "50"},
    ]
    got = facts(spark, rows)
    assert [got[k]["ra_amount"] for k in "ABCDE"] == [5000.0, 3000.0, None, None, None]
    assert got["B"]["sc_amount"] == 1200.0 and got["D"]["tw_amount"] == 800.0
    assert [got[k]["rider"] for k in "ABCDE"] == [True, False, False, False, True]
    assert [got[k]["total_value"] for k in "ABCDE"] == [5000.0, 3000.0, 0.0, 800.0, 0.0]
    # A field without a number in its name is found as well.
    alone = facts(spark, [{"Contract_Number": "F", p: "R", c: "204", v: "1", q: "TW", a: "7"}])
    assert alone["F"]["rider"] and alone["F"]["tw_amount"] == 7.0


def test_classification_priority(spark):
    schema = ("file string, contract string, ra_amount double, sc_amount double, tw_amount double, "
              "total_value double, rider boolean")
    rows = [("f", "1", 10.0, 5.0, 4.0, 99.0, True), ("f", "2", None, 5.0, 4.0, 99.0, True),
            ("f", "3", None, 5.0, 4.0, 99.0, False), ("f", "4", None, None, 4.0, 99.0, False),
            ("f", "5", None, None, None, 99.0, False), ("f", "6", None, None, None, 0.0, False)]
    got = {r["contract"]: r for r in contracts.classify(spark.createDataFrame(rows, schema)).collect()}
    assert [got[k]["withdrawal_type"] for k in "123456"] == [
        "RMD", "Rider Free", "Interest Only", "Surrender Free", "Partial Withdrawal", "Partial Withdrawal"]
    assert [got[k]["base_amount"] for k in "123456"] == [10.0, 99.0, 5.0, 4.0, 99.0, 0.0]
    for r in got.values():
        tenth = f"{r['base_amount'] * 0.10:.2f}"
        assert r["withdrawal_value"] == ("10.00" if r["value_type"] == "Percent" else tenth)


def test_dedup_keeps_the_longest_agent_text(spark):
    agent = "1305_Agent_Last_Name"
    rows = [{"Contract_Number": n, agent: t} for n, t in (
        ("ABC123", "N12345"), ("ABC123MV", "700001              N12345   N102"), ("ABC123TR", "N12345   N102"),
        ("DEF456", "N99999"), ("DEF456XE", "999999              N99999   N102"), ("GHI789", "N77777"))]
    frame = wide(spark, rows)
    for kept in (contracts.dedup_contracts(contracts.facts_from_wide(frame))
                 .select("contract", "agent_last_name"),
                 contracts.dedup_wide(frame).select("Contract_Number", agent)):
        assert dict(map(tuple, kept.collect())) == {
            "ABC123": "700001              N12345   N102", "DEF456": "999999              N99999   N102",
            "GHI789": "N77777"}


def test_resolve_column(spark):
    row = spark.createDataFrame([(None, "one", "two")], "base string, base_1 string, other_1 string")
    got = row.select(contracts.resolve_column(row, "base"), contracts.resolve_column(row, "other"),
                     contracts.resolve_column(row, "none")).first()
    assert tuple(got) == ("", "two", "")


def test_filters(spark):
    df = spark.createDataFrame([("0015", "VA"), ("0255", " AA"), (None, "SU")], "contra string, status string")
    assert contracts.filter_distributor(df, "0015").count() == 1
    assert contracts.filter_distributor(df, "ALL").count() == 3
    assert contracts.filter_active(df).count() == 2


def test_map_requests(spark):
    rows = [{"Contract_Number": "POL001MV", "1301_CUSIP_Number": "CUS1", "1301_Distributors_Account_ID": "D1",
             "1305_Agent_Non_Natural_Name": name("AGENT", "FIRST"), "1305_Agent_Last_Name": "x N1234567",
             f"{NAME}_1": name("OWNER", "OFIRST", "M"), f"{LAST}_1": "OK123456789",
             f"{NAME}_2": name("ANN", "AFIRST"), f"{LAST}_2": "G2987654321"},
            {"Contract_Number": "POL002", f"{NAME}_1": name("OWNER", "OFIRST"), f"{LAST}_1": "OK12-34"},
            {"Contract_Number": "POL003", f"{LAST}_1": "HA555AB"}]
    facts_df = contracts.classify(contracts.facts_from_wide(wide(spark, rows)))
    got = {r["PolNumber"]: r for r in requests.map_requests(facts_df, run_ts="2026-01-02 03:04:05").collect()}
    one, two, three = got["POL001"], got["POL002"], got["POL003"]
    assert len([c for c in one.asDict() if c in requests.COLUMNS]) == 132
    assert (one["CusipNum"], one["DistributorClientAcctNum"], one["Party_Agent_NIPRNumber"]) == ("CUS1", "D1", "1234567")
    assert (one["Party_PrimaryOwner_IDPart"], one["Party_PrimaryAnnuitant_IDPart"]) == ("6789", "4321")
    assert (one["TransExeDate"], one["TransExeTime"]) == ("2026-01-02", "03:04:05+00:00")
    assert len(one["TransRefGUID"]) == 36
    assert one["Relation_Agent_RoleCode_tc"] == "38" and one["Party_Carrier_PartyTypeCode_tc"] == "2"
    assert (two["Party_PrimaryAnnuitant_FirstName"], two["Party_PrimaryAnnuitant_IDPart"]) == ("OFIRST", "1234")
    # The fallback takes the last four characters, not digits.
    assert (three["Party_PrimaryOwner_IDPart"], three["Party_PrimaryOwner_PartialIDType_text"]) == ("55AB", "SSN")


def test_failures(spark):
    columns = ["NIPRNumber", "OwnFirstName", "OwnLastName", "OwnSSN", "AnnSSN", "Withdrawal_Value"]
    rows = [("1", "a", "b", "c", "d", "10.00"), ("nan", "a", "b", "c", "d", "5"), ("1", "a", "b", " ", None, "0.00"),
            ("1", "a", "b", "c", "d", "nan"), ("1", "a", "b", "c", "d", "")]
    got = requests.enrich_failures(
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))).collect()
    assert [r["Result"] for r in got] == ["PASS", "2108-C075", "1004900735-X173; 2108-C075",
                                          "1004900735-X173", "1004900735-X173"]
    assert got[2]["Failure_Reasons"] == ("Owner SSN (last 4) missing; Annuitant SSN (last 4) missing; "
                                         "Withdrawal value is 0 or missing")


def test_rider_expression(spark):
    build = lambda F: contracts.active_rider(F.col("p"), F.col("c"), F.col("v"))
    assert evaluate(spark, build, [("R", "204", "1"), ("R", "204", "x"), (None, "204", "1")],
                    "p string, c string, v string") == [True, False, False]


def test_arrangement_summary_limits_rows_before_the_shuffle(spark):
    df = spark.range(10).select(
        F.when(F.col("id") >= 0, "RMD").alias("Withdrawal_Type"), F.lit("Amount").alias("Withdrawal_Value_Type"),
        F.lit("f").alias("file"), F.col("id").alias("first_line"), F.lit("4").alias("ArrSubType_tc"),
        F.lit("Specified Amount").alias("ArrSubType_text"), F.col("id").cast("string").alias("ModalAmt"))
    out = requests.arrangement_summary(df)
    row = out.first()
    assert row["sample_amounts"] == ["0", "1", "2"] and row["n"] == 10
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()
