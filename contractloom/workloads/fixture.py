"""Position lines, responses and broken requests made by Spark from the order tables.

All values are synthetic. With ``k`` the order key and ``c`` the customer key:

* contract ``C<10 digits>``; a twin ``MV`` when k % 10 = 0 and ``TR`` when k % 20 = 0
* file ``POS_<k % 4>_20260331.txt``; lines of a contract lie together
* 1301: status from the order status; a second one with other values when k % 50 = 0
* 1302: the order price (0 when k % 17 = 0), qualifier by priority; a second record
  with a third pair when k % 19 = 0
* 1303: one per line item; 1305: the supplier of the first line item
* 1309: HA without a name when k % 7 = 0, a trust when k % 9 = 0, else a person; an
  annuitant when k % 3 = 0
* 1315: an active rider when k % 11 = 0, else a near miss
* a junk line when k % 97 = 0, a blank line when k % 89 = 0
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractloom.functions.lines import render_core, render_extended, render_extension
from contractloom.spec.layouts import LAYOUTS
from contractloom.workloads.shared import written

# Lines a contract may take in its file: line numbers are (3k + twin) * 2^20 + place.
PLACES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _twins(df: DataFrame, key: str) -> DataFrame:
    """One row per contract of an order, with its key, twin, contract, file and first place."""
    k = F.col(key)
    twins = F.array_compact(F.array(
        F.struct(F.lit(0).alias("twin"), F.lit("").alias("suffix")),
        F.when(k % 10 == 0, F.struct(F.lit(1).alias("twin"), F.lit("MV").alias("suffix"))),
        F.when(k % 20 == 0, F.struct(F.lit(2).alias("twin"), F.lit("TR").alias("suffix"))),
    ))
    return (
        df.withColumn("_t", F.explode(twins))
        .withColumn("k", k)
        .withColumn("twin", F.col("_t.twin"))
        .withColumn("contract", F.concat(F.lit("C"), F.lpad(k.cast("string"), 10, "0"), "_t.suffix"))
        .withColumn("file", F.concat(F.lit("POS_"), (k % 4).cast("string"), F.lit("_20260331.txt")))
        .withColumn("base", (k * 3 + F.col("twin")) * F.lit(PLACES).cast("bigint"))
        .drop("_t")
    )


def _record(record_type: str, values: dict[str, Column], extended: bool,
            contra: Column | None = None) -> Column:
    core = render_core(record_type, {
        "Submitters_Code": F.lit("P"),
        "Record_Type": F.lit(record_type[:2]),
        "Sequence_Number": F.lit(record_type[2:]),
        "Contract_Number": F.col("contract"),
        **values,
    })
    if not extended:
        return core
    extension = render_extension({
        "Ext_Carrier_Routing_Code": F.lit("RTE1"),
        "Ext_File_Format_Type": F.lit("POV"),
        "Ext_Contra_Participant": F.lit("") if contra is None else contra,
        "Ext_Firm_Abbreviation": F.lit("FRM"),
        "Ext_Contract_Ref": F.col("contract"),
        "Ext_Record_Sequence": F.lit("01"),
    })
    return render_extended(record_type, core, extension)


def _name(last: Column, first: str = "", middle: str = "") -> Column:
    return F.concat(F.rpad(last, 35, " "), F.rpad(F.lit(first), 25, " "), F.rpad(F.lit(middle), 25, " "))


def money(x: Column) -> Column:
    return x.cast("decimal(18,2)").cast("string")


def _order_lines(orders: DataFrame, extended: bool) -> DataFrame:
    k, c, twin = F.col("k"), F.col("o_custkey"), F.col("twin")
    ctext = c.cast("string")
    contra = F.when((c + F.when(twin == 2, 1).otherwise(0)) % 2 == 0, "0015").otherwise("0255")
    status = F.when(F.col("o_orderstatus") == "O", "VA").when(
        F.col("o_orderstatus") == "F", "AA").otherwise("SU")
    qualifier = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "RA")
        .when(F.col("o_orderpriority") == "2-HIGH", "SC")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "TW")
        .otherwise("AV")
    )

    def header(account: str, state: Column) -> Column:
        return _record("1301", {
            "CUSIP_Number": F.concat(F.lit("CU"), F.lpad(ctext, 7, "0")),
            "Contract_Status": status,
            "Distributors_Account_ID": F.concat(F.lit(account), ctext),
            "Product_Type_Code": F.lit("ANN"),
            "Contract_State": F.lpad((state % 50).cast("string"), 2, "0"),
        }, extended, contra)

    def values(fields: dict[str, Column]) -> Column:
        return _record("1302", fields, extended)

    def party(name: Column, role: Column | str, id_: Column) -> Column:
        role = F.lit(role) if isinstance(role, str) else role
        return _record("1309", {
            "Party_Non_Natural_Entity_Name": name,
            "Party_Last_Name": F.concat(role, id_),
        }, extended)

    def rider(program: Column | str, code: Column | str, value: Column | str) -> Column:
        as_col = lambda x: F.lit(x) if isinstance(x, str) else x
        return _record("1315", {
            "Service_Feature_Program_Type": as_col(program),
            "Service_Feature_Type_Code_1": as_col(code),
            "Service_Feature_Value": as_col(value),
        }, extended)

    id_ = F.when(k % 31 == 0, "").otherwise(F.concat(F.lit("1"), F.lpad(ctext, 8, "0")))
    ann_id = F.when(k % 12 == 0, "").otherwise(F.concat(F.lit("2"), F.lpad(ctext, 8, "0")))
    person = _name(F.concat(F.lit("OWNER"), ctext), "CASEY", "M")
    trust = _name(F.concat(F.lit("TRUST"), ctext))
    active = k % 11 == 0
    near = k % 12
    lines = [
        (1, None, header("A", c)),
        (2, k % 50 == 0, header("B", c + 1)),
        (10, None, values({
            "Contract_Value_Amount_1": F.when(k % 17 == 0, "0.00").otherwise(
                money(F.col("o_totalprice"))),
            "Contract_Value_Qualifier_1": qualifier,
            "Contract_Value_Amount_2": F.concat((k % 1000).cast("string"), F.lit(".50")),
            "Contract_Value_Qualifier_2": F.lit("CSV"),
        })),
        (11, k % 19 == 0, values({
            "Contract_Value_Amount_3": F.concat((k % 500).cast("string"), F.lit(".25")),
            "Contract_Value_Qualifier_3": F.lit("SC"),
        })),
        (30, k % 7 == 0, party(F.lit(""), "HA", id_)),
        (30, (k % 7 != 0) & (k % 9 == 0), party(trust, "HC", id_)),
        (30, (k % 7 != 0) & (k % 9 != 0), party(person, "OK", id_)),
        (31, (k % 7 != 0) & (k % 27 == 0), party(person, "OK", id_)),
        (35, k % 3 == 0, party(
            _name(F.concat(F.lit("ANN"), ctext), "ROBIN"),
            F.when(k % 6 == 0, "G2").otherwise("G5"), ann_id)),
        (50, None, rider(
            F.when(active, "R").when(near == 0, "X").otherwise("R"),
            F.when(active, "204").when(near == 1, "999").otherwise("204"),
            F.when(active, "150.00").when(near <= 1, "100.00").otherwise("0.00"))),
        (51, None, rider("", "", "")),
        (90, (k % 97 == 0) & (twin == 0), F.concat(F.lit("XX9junk"), k.cast("string"))),
        (91, (k % 89 == 0) & (twin == 0), F.lit("   ")),
    ]
    contracts = _twins(orders, "o_orderkey")
    branches = [
        (contracts if when is None else contracts.filter(when)).select(
            "file", (F.col("base") + place).alias("line_no"), text.alias("value"))
        for place, when, text in lines
    ]
    return reduce(DataFrame.unionByName, branches)


def _item_lines(items: DataFrame, extended: bool) -> DataFrame:
    place = 1000 + F.col("l_linenumber") * 100_000 + F.col("l_partkey") % 100_000
    return _twins(items, "l_orderkey").select(
        "file",
        (F.col("base") + place).alias("line_no"),
        _record("1303", {
            "CUSIP_Fund_ID_Sub_Fund_ID": F.concat(
                F.lit("F"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")),
            "Fund_Value": money(F.col("l_extendedprice")),
            "Fund_Units": money(F.col("l_quantity")),
        }, extended).alias("value"),
    )


def _agent_lines(items: DataFrame, extended: bool) -> DataFrame:
    first = items.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f")
    ).select("l_orderkey", F.col("f.l_suppkey").alias("s"))
    k, twin, s = F.col("k"), F.col("twin"), F.col("s")
    number = F.concat(F.lit("N"), F.lpad((s + 1_000_000).cast("string"), 7, "0"), F.lit("   N102"))
    last_name = (
        F.when(k % 13 == 0, "NOAGENT")
        .when(twin == 0, number)
        .when(k % 70 == 0, "LONG AGENT TEXT WITHOUT A NUMBER")
        .otherwise(F.concat(F.rpad(F.lit("700001"), 20, " "), number))
    )

    def agent(last: Column, name: Column) -> Column:
        return _record("1305", {"Agent_Non_Natural_Name": name, "Agent_Last_Name": last}, extended)

    contracts = _twins(first, "l_orderkey")
    name = _name(F.concat(F.lit("AGENT"), s.cast("string")), "ALEX", "Q")
    main = contracts.select(
        "file", (F.col("base") + 20).alias("line_no"), agent(last_name, name).alias("value"))
    second = contracts.filter(k % 6 == 0).select(
        "file", (F.col("base") + 21).alias("line_no"),
        agent(F.lit("N9999999"), _name(F.lit("SECOND"), "SAM")).alias("value"))
    return main.unionByName(second)


def _frame_lines(orders: DataFrame) -> DataFrame:
    """Text frame and header records of the standard files."""
    bucket = (F.col("o_orderkey") % 4).cast("string")
    header = render_core("100", {
        "Submitters_Code": F.lit("P"), "Record_Type": F.lit("10"),
        "Submitting_Participant_Number": F.lit("7001"), "IPS_Business_Code": F.lit("POV"),
        "Valuation_Date": F.lit("20260331"),
    })
    firm = render_core("120", {
        "Submitters_Code": F.lit("P"), "Record_Type": F.lit("12"),
        "Contra_Participant_Number": F.lit("0015"),
    })
    placed = F.array(*(
        F.struct(F.lit(place).cast("bigint").alias("line_no"), value.alias("value"))
        for place, value in (
            (-4, F.lit("HDR.POSITIONS")), (-3, header), (-2, firm), (1 << 62, F.lit("END.POSITIONS")),
        )
    ))
    return (
        orders.select(F.concat(F.lit("POS_"), bucket, F.lit("_20260331.txt")).alias("file"))
        .distinct()
        .select("file", F.explode(placed).alias("l"))
        .select("file", "l.line_no", "l.value")
    )


def render_lines(spark: SparkSession, sf_dir: str, *, extended: bool = True) -> DataFrame:
    """``file, line_no, value``: all lines of the position files. Line numbers grow but have gaps."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    lines = (
        _order_lines(orders, extended)
        .unionByName(_item_lines(items, extended))
        .unionByName(_agent_lines(items, extended))
    )
    return lines if extended else lines.unionByName(_frame_lines(orders))


def position_lines(spark: SparkSession, sf_dir: str, *, extended: bool = True) -> DataFrame:
    """The rendered lines as a written table: what a query reads in place of the files."""
    return _written_lines(spark, sf_dir, extended)


@lru_cache(maxsize=16)
def _written_lines(spark: SparkSession, sf_dir: str, extended: bool) -> DataFrame:
    return written(render_lines(spark, sf_dir, extended=extended), "position-lines")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order: success when k % 3 = 0, else a failure with an error list.

    The list is JSON with one or two errors, and for some keys plain text, an
    empty list, a JSON object or null.
    """
    k = F.col("o_orderkey")
    codes = F.array(*(F.lit(c) for c in RESPONSE_CODES))
    n = len(RESPONSE_CODES)

    def error(i: Column) -> Column:
        code = F.get(codes, (i % n).cast("int"))
        return F.concat(F.lit('{"ResultInfoCode": "'), code, F.lit('", "ResultInfoDesc": "about '),
                        code, F.lit(' in row '), (k % 5).cast("string"), F.lit('"}'))

    one = F.concat(F.lit("["), error(k), F.lit("]"))
    two = F.concat(F.lit("["), error(k), F.lit(", "), error(k + 3), F.lit("]"))
    text = (
        F.when(k % 41 == 0, None)
        .when(k % 37 == 0, "[]")
        .when(k % 29 == 0, "300-System is not available at this time, please try again later")
        .when(k % 23 == 0, '{"ResultInfoCode": "2027"}')
        .when(k % 2 == 0, two)
        .otherwise(one)
    )
    types = F.array(*(F.lit(t) for t in WITHDRAWAL_TYPES))
    ok = k % 3 == 0
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("00"), F.lpad(k.cast("string"), 10, "0")).alias("Policy_Number"),
        F.get(types, (k % len(WITHDRAWAL_TYPES)).cast("int")).alias("Withdrawal_Type"),
        F.when(ok, "Success").otherwise("Failure").alias("Status"),
        F.when(ok & (k % 6 == 0), "2").when(ok, "1").otherwise("5").alias("Result_code"),
        F.when(~ok, text).alias("Error_Descriptions"),
    )


RESPONSE_CODES = (
    "2109-None", "100-F058", "100-A687", "1004900735-X173", "2028-ET38", "1004903053", "300-System",
    "3013-None", "2027", "100-BA11", "WDS3", "A452", "E487",
)
WITHDRAWAL_TYPES = ("RMD", "Rider Free", "Interest Only", "Surrender Free", "Partial Withdrawal")


def break_requests(requests: DataFrame) -> DataFrame:
    """Requests with one column broken per policy, by the digits at the end of its number."""
    k = F.right("PolNumber", F.lit(6)).cast("bigint")
    broken = {
        "PolNumber": F.when(k % 23 == 0, F.concat("PolNumber", F.lit("#"))).otherwise(F.col("PolNumber")),
        "TransRefGUID": F.when(k % 29 == 0, "short").otherwise(F.col("TransRefGUID")),
        "ArrMode_tc": F.when(k % 31 == 0, "").otherwise(F.col("ArrMode_tc")),
        "ArrMode_text": F.when(k % 37 == 0, "A mode text that is far too long for it").otherwise(
            F.col("ArrMode_text")),
        "TransType_tc": F.when(k % 41 == 0, "213").otherwise(F.col("TransType_tc")),
        "ModalAmt": F.when(k % 43 == 0, "").otherwise(F.col("ModalAmt")),
        "TaxState_Place_tc": F.when(k % 47 == 0, "3").otherwise(F.col("TaxState_Place_tc")),
        "Party_Carrier_id": F.when(k % 53 == 0, "").otherwise(F.col("Party_Carrier_id")),
        "Relation_Owner_id": F.when(k % 59 == 0, "Other").otherwise(F.col("Relation_Owner_id")),
        "ExpectedToPass": F.when(k % 23 == 0, "0").otherwise("1"),
        "FailureReason": F.when(k % 23 == 0, "bad number").otherwise(""),
    }
    return requests.withColumns(broken)


def damage_documents(made: DataFrame) -> DataFrame:
    """Documents with a fault in their marks, by the order key in their file name.

    k % 9 = 0: cut off; 1: another root; 2: a document type (harmless); 3: the message in
    another namespace by a declaration of its own; 4: the message's prefix declared anew under
    another name (harmless); 5: a prefix that nothing declares; 6: text behind the root; 7:
    the message in a default namespace (its amount is in that too); else none.
    """
    k, xml = F.regexp_extract("filename", "C([0-9]+)", 1).cast("bigint") % 9, F.col("xml")
    uri = "http://ACORD.org/Standards/Life/2"
    wrong = (
        F.when(k == 0, F.substring(xml, F.lit(1), F.length(xml) - 30))
        .when(k == 1, F.replace(xml, F.lit("soap:Envelope"), F.lit("soap:Wrapping")))
        .when(k == 2, F.concat(F.lit("<!DOCTYPE Envelope [<!ELEMENT Extra EMPTY>]>"), xml))
        .when(k == 3, F.replace(xml, F.lit("<ns3:VI21208_Msg>"), F.lit('<ns3:VI21208_Msg xmlns:ns3="urn:other">')))
        .when(k == 4, F.replace(F.replace(F.replace(xml, F.lit("<ns3:"), F.lit("<q:")), F.lit("</ns3:"), F.lit("</q:")),
                                F.lit("<q:VI21208_Msg>"), F.lit(f'<q:VI21208_Msg xmlns:q="{uri}" xmlns:ns3="urn:unused">')))
        .when(k == 5, F.replace(xml, F.lit("</soap:Body>"), F.lit("<zz:none/></soap:Body>")))
        .when(k == 6, F.concat(xml, F.lit("behind")))
        .when(k == 7, F.replace(F.replace(F.replace(xml, F.lit("<ns3:"), F.lit("<")), F.lit("</ns3:"), F.lit("</")),
                                F.lit("<VI21208_Msg>"), F.lit(f'<VI21208_Msg xmlns="{uri}">')))
        .otherwise(xml)
    )
    return made.withColumn("xml", wrong)


def response_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value``: the responses as lines of CSV; one is cut short when k % 101 = 0, one has a field too many when k % 103 = 0."""
    def field(name: str) -> Column:
        quoted = F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(quoted, F.lit(""))

    names = ("Policy_Number", "Withdrawal_Type", "Status", "Result_code", "Error_Descriptions")
    k = F.col("Policy_Number").cast("bigint")
    return responses(spark, sf_dir).select(
        F.when(k % 101 == 0, F.concat_ws(",", "Policy_Number", "Status"))
        .when(k % 103 == 0, F.concat(F.concat_ws(",", *(field(n) for n in names)), F.lit(",more")))
        .otherwise(F.concat_ws(",", *(field(n) for n in names))).alias("value")
    )


@lru_cache(maxsize=16)
def layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file, line_no, value``: a line of every record type for each part, all data fields filled, as a written table.

    Field i of type t holds the digits of md5(t|part) from place 1 + i % 16, cut to its width.
    """
    key, parts = F.col("p_partkey").cast("string"), table(spark, sf_dir, "part")

    def rendered(n: int, t: str) -> DataFrame:
        digits, layout = F.repeat(F.md5(F.concat(F.lit(f"{t}|"), key)), 12), LAYOUTS[t]
        codes = {"Record_Type": F.lit(t[:2]), "Sequence_Number": F.lit(t[2:]), "Contract_Number": F.concat(F.lit("K"), key)}
        codes = {name: value for name, value in codes.items() if any(f.name == name for f in layout.fields)}
        values = {f.name: F.substring(digits, 1 + i % 16, f.width) for i, f in enumerate(layout.fields) if f.is_data}
        values[layout.fields[0].name] = F.lit("P")
        line = render_core(t, {**values, **codes}).alias("value")
        return parts.select(F.lit("ALL.txt").alias("file"), (F.col("p_partkey").cast("bigint") * 100 + n).alias("line_no"), line)

    return written(reduce(DataFrame.unionByName, (rendered(n, t) for n, t in enumerate(LAYOUTS, 1))), "layout-lines")
