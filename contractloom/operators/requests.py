"""Request rows: contracts mapped to the request table, and the audit of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractloom.functions.text import (
    blank_to_null,
    extract_producer,
    is_blank,
    last4,
    remove_whitespace,
    split_name,
    stable_guid,
    strip,
    strip_suffix,
    to_number,
)
from contractloom.operators.fence import fence
from contractloom.spec.dictionary import (
    COLUMNS,
    MESSAGE,
    OPERATION,
    OPERATION_NS,
    RELATIONS,
    SOAP_NS,
)

# What every request says.
PROTOCOL = {
    "SoapEnvelopeNs": SOAP_NS,
    "SoapBodyPresent": "1",
    "OperationName": OPERATION,
    "OperationNs": OPERATION_NS,
    "MessageType": MESSAGE,
    "TXLifeRequest_PrimaryObjectID": "Holding_1",
    "TransType_tc": "212",
    "TransType_text": "Values Inquiry",
    "TransSubType_tc": "21208",
    "TransSubType_text": "Withdrawal Quote",
    "PendingResponseOK_tc": "0",
    "PendingResponseOK_text": "False",
    "Holding_id": "Holding_1",
    "HoldingTypeCode_tc": "2",
    "HoldingTypeCode_text": "Policy",
    "Policy_CarrierPartyID": "Party_Carrier",
    "Annuity_present": "1",
    "TaxFed_id": "ID_1",
    "TaxFed_AppliesToPartyID": "Party_PrimaryOwner",
    "TaxFed_Place_tc": "1",
    "TaxFed_Place_text": "Federal",
    "TaxState_id": "ID_2",
    "TaxState_AppliesToPartyID": "Party_PrimaryOwner",
    "TaxState_Place_tc": "2",
    "TaxState_Place_text": "State",
    "OLifEExtension_VendorCode": "87726",
    "OLifEExtension_ExtensionCode": "EXT",
    "AmountQualifier_tc": "2",
    "AmountQualifier_text": "Gross",
    "ExpectedToPass": "1",
    "FailureReason": "",
}

# Defaults that differ by carrier and kind of request.
DEFAULTS = {
    "carrier_code": "4500",
    "carrier_member": "4602",
    "distributor_member": "0015",
    "ArrMode_tc": "9",
    "ArrMode_text": "Single Pay",
    "ArrType_tc": "1004900058",
    "ArrType_text": "OneTimeWithdrawal",
    "ArrSubType_tc": "4",
    "ArrSubType_text": "Specified Amount",
    "ModalAmt": "2000.00",
    "SourceTransferAmtType_tc": "6",
    "SourceTransferAmtType_text": "ProrataAllFunds",
    "TaxFed_Type_tc": "1",
    "TaxFed_Type_text": "Default",
    "TaxState_Type_tc": "1",
    "TaxState_Type_text": "Default",
}

# Columns that go with the request columns: where a row came from and its class.
CARRIED = {
    "file": "file",
    "first_line": "first_line",
    "contract_state": "state",
    "Withdrawal_Type": "withdrawal_type",
    "Withdrawal_Value_Type": "value_type",
    "Withdrawal_Value": "withdrawal_value",
}


def _relations() -> dict[str, Column]:
    out = {}
    for role, code, text, party in RELATIONS:
        fixed = {
            "id": f"{role}_Relation", "OriginatingObjectID": "Holding_1", "RelatedObjectID": party,
            "OriginatingObjectType_tc": "4", "OriginatingObjectType_text": "Holding",
            "RelatedObjectType_tc": "6", "RelatedObjectType_text": "Party",
            "RoleCode_tc": code, "RoleCode_text": text,
        }
        out |= {f"Relation_{role}_{k}": F.lit(v) for k, v in fixed.items()}
    return out


def _parties(options: dict[str, str]) -> dict[str, Column]:
    out = {}
    for role, kind in (("Agent", "Person"), ("Distributor", "Organization"),
                       ("Carrier", "Organization"), ("PrimaryOwner", "Person"),
                       ("PrimaryAnnuitant", "Person")):
        p = f"Party_{role}"
        out |= {f"{p}_id": F.lit(p), f"{p}_PartyTypeCode_text": F.lit(kind),
                f"{p}_PartyTypeCode_tc": F.lit("1" if kind == "Person" else "2")}
    for role in ("distributor", "carrier"):
        member = F.lit(options[f"{role}_member"])
        p = f"Party_{role.capitalize()}"
        out |= {f"{p}_DTCCMemberCode": member, f"{p}_DTCCAssociatedMemberCode": member}
    return out | {"Party_Carrier_CarrierCode": F.lit(options["carrier_code"])}


def _identity(prefix: str, first: Column, last: Column, main_id: Column,
              fallback_id: Column) -> dict[str, Column]:
    """Name and partial id of a person. The digits of the main id count; without
    any, the last four characters of the fallback id."""
    digits = last4(main_id)
    use_fallback = (digits == "") & (fallback_id != "")
    part = F.when(use_fallback, F.substring(fallback_id, -4, 4)).otherwise(digits)
    known = (main_id != "") | use_fallback
    return {
        f"{prefix}_FirstName": first,
        f"{prefix}_LastName": last,
        f"{prefix}_IDPart": part,
        f"{prefix}_PartialIDType_tc": F.when(known, "1").otherwise(""),
        f"{prefix}_PartialIDType_text": F.when(known, "SSN").otherwise(""),
    }


def map_requests(facts: DataFrame, *, run_ts: str, guid: Column | None = None,
                 **options: str) -> DataFrame:
    """The request table: 132 columns and, when there, the columns carried along.

    ``run_ts`` is the time of the run as ``YYYY-MM-DD HH:MM:SS`` in UTC. The
    identifier of a request depends on the run and the policy unless ``guid`` is given.
    """
    unknown = set(options) - set(DEFAULTS)
    if unknown:
        raise KeyError(f"unknown options {sorted(unknown)}")
    settings = {**DEFAULTS, **options}
    run = F.lit(run_ts).cast("timestamp_ntz")
    policy = strip_suffix(F.col("contract"))
    agent = split_name(F.col("agent_name"))
    owner, annuitant = F.col("owner"), F.col("annuitant")
    own = (annuitant["last"] != "") | (annuitant["first"] != "")

    def holder(name: str) -> Column:
        return F.when(own, annuitant[name]).otherwise(owner[name])

    values = {
        **{c: F.lit(v) for c, v in PROTOCOL.items()},
        **{c: F.lit(v) for c, v in settings.items() if c in COLUMNS},
        **_parties(settings),
        **_relations(),
        "Policy_CarrierCode": F.lit(settings["carrier_code"]),
        "TransRefGUID": stable_guid(F.lit(run_ts), policy) if guid is None else guid,
        "TransExeDate": F.date_format(run, "yyyy-MM-dd"),
        "TransExeTime": F.concat(F.date_format(run, "HH:mm:ss"), F.lit("+00:00")),
        "PolNumber": policy,
        "CusipNum": F.col("cusip"),
        "DistributorClientAcctNum": F.col("account"),
        "Party_Agent_FirstName": agent["first"],
        "Party_Agent_LastName": agent["last"],
        "Party_Agent_NIPRNumber": extract_producer(F.col("agent_last_name")),
        **_identity("Party_PrimaryOwner", owner["first"], owner["last"], owner["id"],
                    F.col("owner_fallback_id")),
        **_identity("Party_PrimaryAnnuitant", holder("first"), holder("last"), holder("id"),
                    F.col("annuitant_fallback_id")),
    }
    carried = [F.col(src).alias(name) for name, src in CARRIED.items() if src in facts.columns]
    return facts.select(*(values.get(c, F.lit("")).alias(c) for c in COLUMNS), *carried)


def sync_arrangement(requests: DataFrame) -> DataFrame:
    """Take the amount from the withdrawal value; percent rows get the percent sub-type."""
    percent = F.col("Withdrawal_Value_Type") == "Percent"
    return requests.withColumns({
        "ModalAmt": F.col("Withdrawal_Value"),
        "ArrSubType_tc": F.when(percent, "6").otherwise(F.col("ArrSubType_tc")),
        "ArrSubType_text": F.when(percent, "Percentage").otherwise(F.col("ArrSubType_text")),
    })


def arrangement_summary(requests: DataFrame, *, samples: int = 3) -> DataFrame:
    """Per withdrawal type and value type: rows, sub-type, and the first few amounts.

    The row limit of the window is applied before the shuffle, so a group of any
    size sends a few rows per task.
    """
    keys = ["Withdrawal_Type", "Withdrawal_Value_Type"]
    order = ["file", "first_line"]
    first = Window.partitionBy(*keys).orderBy(*order)
    slim = requests.select(*keys, *order, "ArrSubType_tc", "ArrSubType_text", "ModalAmt")
    sampled = (
        slim.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") <= samples)
        .groupBy(*keys)
        .agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_n", "ModalAmt"))),
                        lambda s: s["ModalAmt"]).alias("sample_amounts"),
            F.min_by("ArrSubType_tc", "_n").alias("ArrSubType_tc"),
            F.min_by("ArrSubType_text", "_n").alias("ArrSubType_text"),
        )
    )
    return slim.groupBy(*keys).agg(F.count("*").alias("n")).join(sampled, keys)


# Validation column and the request column it shows.
VALIDATION_COLUMNS = {
    "Withdrawal_Type": "Withdrawal_Type",
    "Withdrawal_Value_Type": "Withdrawal_Value_Type",
    "Withdrawal_Value": "Withdrawal_Value",
    "PolNumber": "PolNumber",
    "CusipNum": "CusipNum",
    "NIPRNumber": "Party_Agent_NIPRNumber",
    "AgtFirstName": "Party_Agent_FirstName",
    "AgtLastName": "Party_Agent_LastName",
    "AgtSSN": "Party_Agent_IDPart",
    "OwnFirstName": "Party_PrimaryOwner_FirstName",
    "OwnLastName": "Party_PrimaryOwner_LastName",
    "OwnSSN": "Party_PrimaryOwner_IDPart",
    "AnnSSN": "Party_PrimaryAnnuitant_IDPart",
    "Rguid": "TransRefGUID",
    "Federal_TaxWithholdingType": "TaxFed_Type_text",
    "State_TaxWithholdingType": "TaxState_Type_text",
    "State": "contract_state",
}

# Mandatory column, what is reported, predicted error code.
MANDATORY = (
    ("NIPRNumber", "Agent NPN/NIPR missing", "2108-C075"),
    ("OwnFirstName", "Owner first name missing", "2108-C075"),
    ("OwnLastName", "Owner last name missing", "2108-C075"),
    ("OwnSSN", "Owner SSN (last 4) missing", "2108-C075"),
    ("AnnSSN", "Annuitant SSN (last 4) missing", "2108-C075"),
)
NO_VALUE = ("Withdrawal value is 0 or missing", "1004900735-X173")


def validation_table(requests: DataFrame) -> DataFrame:
    """The 17 columns that are audited before documents are made, with ``file`` in front."""
    def shown(name: str, source: str) -> Column:
        if source not in requests.columns:
            return F.lit("").alias(name)
        value = F.col(source)
        return (remove_whitespace(value) if name == "PolNumber" else value).alias(name)

    place = [c for c in ("file", "first_line") if c in requests.columns]
    return requests.select(*place, *(shown(n, s) for n, s in VALIDATION_COLUMNS.items()))


def enrich_failures(validation: DataFrame) -> DataFrame:
    """Add failure reasons, predicted error codes and the result of every row."""
    value = to_number(F.col("Withdrawal_Value"))
    no_value = value.isNull() | (value <= 0)
    found = [(is_blank(F.col(c)), label, code) for c, label, code in MANDATORY]
    found.append((no_value, *NO_VALUE))
    reasons = F.array_compact(F.array(*(F.when(bad, F.lit(label)) for bad, label, _ in found)))
    codes = F.array_sort(F.array_distinct(F.array_compact(
        F.array(*(F.when(bad, F.lit(code)) for bad, _, code in found)))))
    return fence(
        validation
        .withColumn("Failure_Reasons", F.array_join(reasons, "; "))
        .withColumn("Predicted_Error_Codes", F.array_join(codes, "; "))
        .withColumn("Result", F.coalesce(F.nullif("Predicted_Error_Codes", F.lit("")), F.lit("PASS")))
    )


def _failures(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("Predicted_Error_Codes") != "")


def failure_breakdown(enriched: DataFrame) -> DataFrame:
    """Counts per reason and per code, the most frequent first, ties by name."""
    items = F.array(
        F.struct(F.lit("reason").alias("kind"), F.split("Failure_Reasons", "; ").alias("items")),
        F.struct(F.lit("code").alias("kind"), F.split("Predicted_Error_Codes", "; ").alias("items")),
    )
    return (
        _failures(enriched)
        .select(F.inline(items))
        .select("kind", F.explode("items").alias("item"))
        .groupBy("kind", "item")
        .agg(F.count("*").alias("n"))
        .orderBy("kind", F.desc("n"), "item")
    )


def pass_fail_summary(enriched: DataFrame) -> DataFrame:
    """One row: totals, passes, failures, and failures with several reasons."""
    failed = F.col("Predicted_Error_Codes") != ""
    return enriched.agg(
        F.count("*").alias("total"),
        F.count_if(~failed).alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(failed & F.contains("Failure_Reasons", F.lit(";"))).alias("several_reasons"),
    )


def sample_failures(enriched: DataFrame, k: int) -> DataFrame:
    """The first ``k`` failures in file order."""
    return _failures(enriched).orderBy("file", "first_line").limit(k)


def _present(column: str) -> Column:
    return blank_to_null(F.col(f"`{column}`").cast("string")).isNotNull()


def column_coverage(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: how many rows have a value, of how many. One pass over the rows."""
    columns = [c for c in (columns or df.columns) if c not in ("file", "first_line")]
    counted = df.agg(
        F.count("*").alias("total"),
        F.array(*(
            F.struct(F.lit(c).alias("column_name"), F.count_if(_present(c)).alias("filled"))
            for c in columns
        )).alias("per_column"),
    )
    return counted.select(F.inline("per_column"), "total")


def blanket_warnings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns without a value in any row; none when there are no rows."""
    return (
        column_coverage(df, columns)
        .filter((F.col("filled") == 0) & (F.col("total") > 0))
        .select("column_name", "total")
    )


# Name parts of the columns that are shown in a preview.
PREVIEW_MARKS = (
    "Contract_Number", "CUSIP", "Contract_Status", "Distributors_Account", "Product_Type",
    "Contract_State", "Agent_First", "Agent_Last", "National_Producer", "Agent_Tax_ID",
    "Party_First", "Party_Last", "Party_Role", "Party_ID", "Party_Date_of_Birth", "Party_Gender",
)


def field_preview(wide: DataFrame) -> DataFrame:
    """Per key column: the first value in file order, null when all are empty."""
    columns = [c for c in wide.columns if any(m in c for m in PREVIEW_MARKS)]
    place = F.struct("file", "first_line")
    first = wide.agg(F.array(*(
        F.struct(
            F.lit(c).alias("column_name"),
            F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`") != "", place)).alias("sample"),
        )
        for c in columns
    )).alias("p"))
    return first.select(F.inline("p"))


def missing_provenance(enriched: DataFrame, facts: DataFrame) -> DataFrame:
    """Per missing field: is it absent at the source, or lost with a dropped row.

    ``facts`` are the contracts before de-duplication; they are reduced to one
    row of flags per base contract before the join.
    """
    labels = [label for _, label, _ in MANDATORY]
    owner, annuitant = F.col("owner"), F.col("annuitant")
    present = [
        extract_producer(F.col("agent_last_name")) != "",
        owner["first"] != "",
        owner["last"] != "",
        last4(owner["id"]) != "",
        last4(annuitant["id"]) != "",
    ]
    sources = facts.groupBy("file", F.col("base").alias("PolNumber")).agg(
        *(F.bool_or(p).alias(f"has_{i}") for i, p in enumerate(present))
    )
    missing = F.array_compact(F.array(*(
        F.when(F.contains("Failure_Reasons", F.lit(label)), F.struct(
            F.lit(label).alias("reason"),
            F.coalesce(F.col(f"has_{i}"), F.lit(False)).alias("elsewhere"),
        ))
        for i, label in enumerate(labels)
    )))
    return (
        _failures(enriched)
        .select("file", strip(F.col("PolNumber")).alias("PolNumber"), "Failure_Reasons")
        .join(sources, ["file", "PolNumber"], "left")
        .select(F.inline(missing))
        .groupBy(F.replace("reason", F.lit(" missing"), F.lit("")).alias("missing_field"))
        .agg(
            F.count("*").alias("total_missing"),
            F.count_if(~F.col("elsewhere")).alias("absent_at_source"),
            F.count_if("elsewhere").alias("dedup_artifact"),
        )
    )


def filter_expected(requests: DataFrame, *, include_invalid: bool = False) -> DataFrame:
    """Rows that are expected to pass, or all of them."""
    return requests if include_invalid else requests.filter(F.col("ExpectedToPass") == "1")
