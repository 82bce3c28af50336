"""The data dictionary of the withdrawal-quote request: 132 string columns.

Most columns come in pairs, the ``tc`` code and the text of one XML element, and most
groups repeat per role.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Namespaces and names of the message.
SOAP_NS = "http://www.w3.org/2003/05/soap-envelope"
OPERATION_NS = "http://service.iwa.dtcc.com/"
ACORD_NS = "http://ACORD.org/Standards/Life/2"
OPERATION = "processValueInquiry21208"
MESSAGE = "VI21208_Msg"

FLAG = "^[01]$"
DIGITS = "^\\d+$"

# The conditions under which an optional field is needed.
PER_CARRIER = "Conditional per carrier"
WHEN_SPECIFIED = "Required when ArrSubType tc=4"
WHEN_SPECIFIED_AMOUNT = "Required when ArrSubType tc=4 (Specified Amount)"
WHEN_QUALIFIED = "Required when AmountQualifier present"
WHEN_ANNUITANT = "Required when Annuitant Party present"


@dataclass(frozen=True)
class Entry:
    """One column of the request table and the rules for its value."""

    column_name: str
    group: str
    xml_tag: str
    required: bool = True
    conditional: str = ""
    tc_code: str = ""
    description: str = ""
    max_length: int = 0
    regex: str = ""
    allowed_values: tuple[str, ...] = ()

    spark_type = "STRING"


# Role, role code, role text, party.
RELATIONS = (
    ("Agent", "38", "Servicing Agent", "Party_Agent"),
    ("Distributor", "83", "Broker Dealer", "Party_Distributor"),
    ("Carrier", "87", "Carrier", "Party_Carrier"),
    ("Owner", "8", "Owner", "Party_PrimaryOwner"),
    ("Annuitant", "35", "Annuitant", "Party_PrimaryAnnuitant"),
)

# The dictionary. Column, group, element, required, condition, code,
# description, greatest length (0: none), pattern, allowed values (none: any).
DICTIONARY: tuple[Entry, ...] = (
    # soap
    Entry("SoapEnvelopeNs", "soap", "Envelope", True, "", "",
          "Namespace of the envelope", 0, "", ("http://www.w3.org/2003/05/soap-envelope",)),
    Entry("SoapBodyPresent", "soap", "Body", True, "", "",
          "1 when the body is there", 1, FLAG, ("1",)),
    Entry("OperationName", "soap", "processValueInquiry21208", True, "", "",
          "Name of the operation", 50, "", ()),
    Entry("OperationNs", "soap", "operationNs", True, "", "",
          "Namespace of the operation", 0, "", ("http://service.iwa.dtcc.com/",)),
    Entry("MessageType", "soap", "VI21208_Msg", True, "", "",
          "Name of the message element", 20, "", ()),
    # txlife_request
    Entry("TXLifeRequest_PrimaryObjectID", "txlife_request", "TXLifeRequest", True, "", "",
          "Object the request is about", 50, "", ()),
    Entry("TransRefGUID", "txlife_request", "TransRefGUID", True, "", "",
          "Identifier of the request", 36, "^[0-9a-zA-Z\\-]{20,36}$", ()),
    Entry("TransType_tc", "txlife_request", "TransType", True, "", "212",
          "Code of TransType", 10, "", ("212",)),
    Entry("TransType_text", "txlife_request", "TransType_text", True, "", "",
          "Text of TransType", 50, "", ("Values Inquiry",)),
    Entry("TransSubType_tc", "txlife_request", "TransSubType", True, "", "21208",
          "Code of TransSubType", 10, "", ("21208",)),
    Entry("TransSubType_text", "txlife_request", "TransSubType_text", True, "", "",
          "Text of TransSubType", 50, "", ("Withdrawal Quote",)),
    Entry("TransExeDate", "txlife_request", "TransExeDate", True, "", "",
          "Date of the request", 10, "^\\d{4}-\\d{2}-\\d{2}$", ()),
    Entry("TransExeTime", "txlife_request", "TransExeTime", True, "", "",
          "Time of the request, with zone", 20, "", ()),
    Entry("PendingResponseOK_tc", "txlife_request", "PendingResponseOK", True, "", "0",
          "Code of PendingResponseOK", 5, "", ("0", "1")),
    Entry("PendingResponseOK_text", "txlife_request", "PendingResponseOK_text", True, "", "",
          "Text of PendingResponseOK", 10, "", ("False", "True")),
    # holding
    Entry("Holding_id", "holding", "Holding", True, "", "",
          "Id of the holding", 50, "", ()),
    Entry("HoldingTypeCode_tc", "holding", "HoldingTypeCode", True, "", "2",
          "Code of HoldingTypeCode", 5, "", ("2",)),
    Entry("HoldingTypeCode_text", "holding", "HoldingTypeCode_text", True, "", "",
          "Text of HoldingTypeCode", 20, "", ("Policy",)),
    Entry("DistributorClientAcctNum", "holding", "DistributorClientAcctNum", False, PER_CARRIER, "",
          "Account at the distributor", 30, "", ()),
    # policy
    Entry("Policy_CarrierPartyID", "policy", "Policy", True, "", "",
          "Party id of the carrier", 50, "", ()),
    Entry("PolNumber", "policy", "PolNumber", True, "", "",
          "Policy number", 30, "^[A-Za-z0-9\\-]+$", ()),
    Entry("Policy_CarrierCode", "policy", "CarrierCode", True, "", "",
          "Carrier code of the policy", 10, DIGITS, ()),
    Entry("CusipNum", "policy", "CusipNum", False, PER_CARRIER, "",
          "Security identifier", 15, "", ()),
    Entry("Annuity_present", "policy", "Annuity", True, "", "",
          "1 when the annuity element is there", 1, FLAG, ("0", "1")),
    # arrangement
    Entry("ArrMode_tc", "arrangement", "ArrMode", True, "", "",
          "Code of ArrMode", 5, "", ()),
    Entry("ArrMode_text", "arrangement", "ArrMode_text", True, "", "",
          "Text of ArrMode", 30, "", ()),
    Entry("ArrType_tc", "arrangement", "ArrType", True, "", "",
          "Code of ArrType", 20, "", ()),
    Entry("ArrType_text", "arrangement", "ArrType_text", True, "", "",
          "Text of ArrType", 50, "", ()),
    Entry("ArrSubType_tc", "arrangement", "ArrSubType", True, "", "",
          "Code of ArrSubType", 5, "", ()),
    Entry("ArrSubType_text", "arrangement", "ArrSubType_text", True, "", "",
          "Text of ArrSubType", 50, "", ()),
    Entry("ModalAmt", "arrangement", "ModalAmt", False, WHEN_SPECIFIED_AMOUNT, "",
          "Amount to withdraw", 20, "", ()),
    Entry("SourceTransferAmtType_tc", "arrangement", "SourceTransferAmtType", True, "", "",
          "Code of SourceTransferAmtType", 5, "", ()),
    Entry("SourceTransferAmtType_text", "arrangement", "SourceTransferAmtType_text", True, "", "",
          "Text of SourceTransferAmtType", 50, "", ()),
    # tax_fed
    Entry("TaxFed_id", "tax_fed", "TaxWithholding", True, "", "",
          "Id of the Federal withholding", 20, "", ()),
    Entry("TaxFed_AppliesToPartyID", "tax_fed", "TaxWithholding_AppliesTo", True, "", "",
          "Party the Federal withholding is for", 50, "", ()),
    Entry("TaxFed_Place_tc", "tax_fed", "TaxWithholdingPlace", True, "", "1",
          "Code of TaxWithholdingPlace", 5, "", ("1",)),
    Entry("TaxFed_Place_text", "tax_fed", "TaxWithholdingPlace_text", True, "", "",
          "Text of TaxWithholdingPlace", 20, "", ("Federal",)),
    Entry("TaxFed_Type_tc", "tax_fed", "TaxWithholdingType", True, "", "",
          "Code of TaxWithholdingType", 5, "", ()),
    Entry("TaxFed_Type_text", "tax_fed", "TaxWithholdingType_text", True, "", "",
          "Text of TaxWithholdingType", 20, "", ()),
    # tax_state
    Entry("TaxState_id", "tax_state", "TaxWithholding", True, "", "",
          "Id of the State withholding", 20, "", ()),
    Entry("TaxState_AppliesToPartyID", "tax_state", "TaxWithholding_AppliesTo", True, "", "",
          "Party the State withholding is for", 50, "", ()),
    Entry("TaxState_Place_tc", "tax_state", "TaxWithholdingPlace", True, "", "2",
          "Code of TaxWithholdingPlace", 5, "", ("2",)),
    Entry("TaxState_Place_text", "tax_state", "TaxWithholdingPlace_text", True, "", "",
          "Text of TaxWithholdingPlace", 20, "", ("State",)),
    Entry("TaxState_Type_tc", "tax_state", "TaxWithholdingType", True, "", "",
          "Code of TaxWithholdingType", 5, "", ()),
    Entry("TaxState_Type_text", "tax_state", "TaxWithholdingType_text", True, "", "",
          "Text of TaxWithholdingType", 20, "", ()),
    # olife_extension
    Entry("OLifEExtension_VendorCode", "olife_extension", "OLifEExtension", False, WHEN_QUALIFIED, "",
          "Vendor code of the extension", 10, "", ()),
    Entry("OLifEExtension_ExtensionCode", "olife_extension", "OLifEExtension_ext", False, WHEN_QUALIFIED, "",
          "Code of the extension", 10, "", ()),
    Entry("AmountQualifier_tc", "olife_extension", "AmountQualifier", False, WHEN_SPECIFIED, "",
          "Code of AmountQualifier", 5, "", ()),
    Entry("AmountQualifier_text", "olife_extension", "AmountQualifier_text", False, WHEN_SPECIFIED, "",
          "Text of AmountQualifier", 20, "", ()),
    # party_agent
    Entry("Party_Agent_id", "party_agent", "Party", True, "", "",
          "Party of Agent", 50, "", ()),
    Entry("Party_Agent_PartyTypeCode_tc", "party_agent", "PartyTypeCode", True, "", "",
          "Code of PartyTypeCode", 5, "", ("1", "2")),
    Entry("Party_Agent_PartyTypeCode_text", "party_agent", "PartyTypeCode_text", True, "", "",
          "Text of PartyTypeCode", 20, "", ("Person", "Organization")),
    Entry("Party_Agent_FirstName", "party_agent", "FirstName", True, "", "",
          "FirstName of Agent", 50, "", ()),
    Entry("Party_Agent_LastName", "party_agent", "LastName", True, "", "",
          "LastName of Agent", 50, "", ()),
    Entry("Party_Agent_NIPRNumber", "party_agent", "NIPRNumber", False, PER_CARRIER, "",
          "NIPRNumber of Agent", 20, "", ()),
    Entry("Party_Agent_IDPart", "party_agent", "IdentificationPart", True, "", "",
          "IdentificationPart of Agent", 10, "", ()),
    Entry("Party_Agent_PartialIDType_tc", "party_agent", "PartialIDType", True, "", "",
          "Code of PartialIDType", 5, "", ()),
    Entry("Party_Agent_PartialIDType_text", "party_agent", "PartialIDType_text", True, "", "",
          "Text of PartialIDType", 20, "", ()),
    # party_distributor
    Entry("Party_Distributor_id", "party_distributor", "Party", True, "", "",
          "Party of Distributor", 50, "", ()),
    Entry("Party_Distributor_PartyTypeCode_tc", "party_distributor", "PartyTypeCode", True, "", "2",
          "Code of PartyTypeCode", 5, "", ("2",)),
    Entry("Party_Distributor_PartyTypeCode_text", "party_distributor", "PartyTypeCode_text", True, "", "",
          "Text of PartyTypeCode", 20, "", ("Organization",)),
    Entry("Party_Distributor_DTCCMemberCode", "party_distributor", "DTCCMemberCode", True, "", "",
          "DTCCMemberCode of Distributor", 10, "", ()),
    Entry("Party_Distributor_DTCCAssociatedMemberCode", "party_distributor", "DTCCAssociatedMemberCode", True, "", "",
          "DTCCAssociatedMemberCode of Distributor", 10, "", ()),
    # party_carrier
    Entry("Party_Carrier_id", "party_carrier", "Party", True, "", "",
          "Party of Carrier", 50, "", ()),
    Entry("Party_Carrier_PartyTypeCode_tc", "party_carrier", "PartyTypeCode", True, "", "2",
          "Code of PartyTypeCode", 5, "", ("2",)),
    Entry("Party_Carrier_PartyTypeCode_text", "party_carrier", "PartyTypeCode_text", True, "", "",
          "Text of PartyTypeCode", 20, "", ("Organization",)),
    Entry("Party_Carrier_DTCCMemberCode", "party_carrier", "DTCCMemberCode", True, "", "",
          "DTCCMemberCode of Carrier", 10, "", ()),
    Entry("Party_Carrier_DTCCAssociatedMemberCode", "party_carrier", "DTCCAssociatedMemberCode", True, "", "",
          "DTCCAssociatedMemberCode of Carrier", 10, "", ()),
    Entry("Party_Carrier_CarrierCode", "party_carrier", "CarrierCode", True, "", "",
          "CarrierCode of Carrier", 10, DIGITS, ()),
    # party_owner
    Entry("Party_PrimaryOwner_id", "party_owner", "Party", True, "", "",
          "Party of PrimaryOwner", 50, "", ()),
    Entry("Party_PrimaryOwner_PartyTypeCode_tc", "party_owner", "PartyTypeCode", True, "", "",
          "Code of PartyTypeCode", 5, "", ("1", "2")),
    Entry("Party_PrimaryOwner_PartyTypeCode_text", "party_owner", "PartyTypeCode_text", True, "", "",
          "Text of PartyTypeCode", 20, "", ("Person", "Organization")),
    Entry("Party_PrimaryOwner_FirstName", "party_owner", "FirstName", True, "", "",
          "FirstName of PrimaryOwner", 50, "", ()),
    Entry("Party_PrimaryOwner_LastName", "party_owner", "LastName", True, "", "",
          "LastName of PrimaryOwner", 50, "", ()),
    Entry("Party_PrimaryOwner_IDPart", "party_owner", "IdentificationPart", True, "", "",
          "IdentificationPart of PrimaryOwner", 10, "", ()),
    Entry("Party_PrimaryOwner_PartialIDType_tc", "party_owner", "PartialIDType", True, "", "",
          "Code of PartialIDType", 5, "", ()),
    Entry("Party_PrimaryOwner_PartialIDType_text", "party_owner", "PartialIDType_text", True, "", "",
          "Text of PartialIDType", 20, "", ()),
    # party_annuitant
    Entry("Party_PrimaryAnnuitant_id", "party_annuitant", "Party", False, PER_CARRIER, "",
          "Party of PrimaryAnnuitant", 50, "", ()),
    Entry("Party_PrimaryAnnuitant_PartyTypeCode_tc", "party_annuitant", "PartyTypeCode", False, PER_CARRIER, "",
          "Code of PartyTypeCode", 5, "", ("1", "2")),
    Entry("Party_PrimaryAnnuitant_PartyTypeCode_text", "party_annuitant", "PartyTypeCode_text", False, PER_CARRIER, "",
          "Text of PartyTypeCode", 20, "", ("Person", "Organization")),
    Entry("Party_PrimaryAnnuitant_FirstName", "party_annuitant", "FirstName", False, PER_CARRIER, "",
          "FirstName of PrimaryAnnuitant", 50, "", ()),
    Entry("Party_PrimaryAnnuitant_LastName", "party_annuitant", "LastName", False, PER_CARRIER, "",
          "LastName of PrimaryAnnuitant", 50, "", ()),
    Entry("Party_PrimaryAnnuitant_IDPart", "party_annuitant", "IdentificationPart", False, PER_CARRIER, "",
          "IdentificationPart of PrimaryAnnuitant", 10, "", ()),
    Entry("Party_PrimaryAnnuitant_PartialIDType_tc", "party_annuitant", "PartialIDType", False, PER_CARRIER, "",
          "Code of PartialIDType", 5, "", ()),
    Entry("Party_PrimaryAnnuitant_PartialIDType_text", "party_annuitant", "PartialIDType_text", False, PER_CARRIER, "",
          "Text of PartialIDType", 20, "", ()),
    # relation_agent
    Entry("Relation_Agent_id", "relation_agent", "Relation", True, "", "",
          "Relation of Agent", 50, "", ()),
    Entry("Relation_Agent_OriginatingObjectID", "relation_agent", "OriginatingObjectID", True, "", "",
          "OriginatingObjectID of Agent", 50, "", ()),
    Entry("Relation_Agent_RelatedObjectID", "relation_agent", "RelatedObjectID", True, "", "",
          "RelatedObjectID of Agent", 50, "", ()),
    Entry("Relation_Agent_OriginatingObjectType_tc", "relation_agent", "OriginatingObjectType", True, "", "4",
          "Code of OriginatingObjectType", 5, "", ("4",)),
    Entry("Relation_Agent_OriginatingObjectType_text", "relation_agent", "OriginatingObjectType_text", True, "", "",
          "Text of OriginatingObjectType", 20, "", ("Holding",)),
    Entry("Relation_Agent_RelatedObjectType_tc", "relation_agent", "RelatedObjectType", True, "", "6",
          "Code of RelatedObjectType", 5, "", ("6",)),
    Entry("Relation_Agent_RelatedObjectType_text", "relation_agent", "RelatedObjectType_text", True, "", "",
          "Text of RelatedObjectType", 20, "", ("Party",)),
    Entry("Relation_Agent_RoleCode_tc", "relation_agent", "RelationRoleCode", True, "", "38",
          "Code of RelationRoleCode", 5, "", ("38",)),
    Entry("Relation_Agent_RoleCode_text", "relation_agent", "RelationRoleCode_text", True, "", "",
          "Text of RelationRoleCode", 30, "", ("Servicing Agent",)),
    # relation_distributor
    Entry("Relation_Distributor_id", "relation_distributor", "Relation", True, "", "",
          "Relation of Distributor", 50, "", ()),
    Entry("Relation_Distributor_OriginatingObjectID", "relation_distributor", "OriginatingObjectID", True, "", "",
          "OriginatingObjectID of Distributor", 50, "", ()),
    Entry("Relation_Distributor_RelatedObjectID", "relation_distributor", "RelatedObjectID", True, "", "",
          "RelatedObjectID of Distributor", 50, "", ()),
    Entry("Relation_Distributor_OriginatingObjectType_tc", "relation_distributor", "OriginatingObjectType", True, "", "4",
          "Code of OriginatingObjectType", 5, "", ("4",)),
    Entry("Relation_Distributor_OriginatingObjectType_text", "relation_distributor", "OriginatingObjectType_text", True, "", "",
          "Text of OriginatingObjectType", 20, "", ("Holding",)),
    Entry("Relation_Distributor_RelatedObjectType_tc", "relation_distributor", "RelatedObjectType", True, "", "6",
          "Code of RelatedObjectType", 5, "", ("6",)),
    Entry("Relation_Distributor_RelatedObjectType_text", "relation_distributor", "RelatedObjectType_text", True, "", "",
          "Text of RelatedObjectType", 20, "", ("Party",)),
    Entry("Relation_Distributor_RoleCode_tc", "relation_distributor", "RelationRoleCode", True, "", "83",
          "Code of RelationRoleCode", 5, "", ("83",)),
    Entry("Relation_Distributor_RoleCode_text", "relation_distributor", "RelationRoleCode_text", True, "", "",
          "Text of RelationRoleCode", 30, "", ("Broker Dealer",)),
    # relation_carrier
    Entry("Relation_Carrier_id", "relation_carrier", "Relation", True, "", "",
          "Relation of Carrier", 50, "", ()),
    Entry("Relation_Carrier_OriginatingObjectID", "relation_carrier", "OriginatingObjectID", True, "", "",
          "OriginatingObjectID of Carrier", 50, "", ()),
    Entry("Relation_Carrier_RelatedObjectID", "relation_carrier", "RelatedObjectID", True, "", "",
          "RelatedObjectID of Carrier", 50, "", ()),
    Entry("Relation_Carrier_OriginatingObjectType_tc", "relation_carrier", "OriginatingObjectType", True, "", "4",
          "Code of OriginatingObjectType", 5, "", ("4",)),
    Entry("Relation_Carrier_OriginatingObjectType_text", "relation_carrier", "OriginatingObjectType_text", True, "", "",
          "Text of OriginatingObjectType", 20, "", ("Holding",)),
    Entry("Relation_Carrier_RelatedObjectType_tc", "relation_carrier", "RelatedObjectType", True, "", "6",
          "Code of RelatedObjectType", 5, "", ("6",)),
    Entry("Relation_Carrier_RelatedObjectType_text", "relation_carrier", "RelatedObjectType_text", True, "", "",
          "Text of RelatedObjectType", 20, "", ("Party",)),
    Entry("Relation_Carrier_RoleCode_tc", "relation_carrier", "RelationRoleCode", True, "", "87",
          "Code of RelationRoleCode", 5, "", ("87",)),
    Entry("Relation_Carrier_RoleCode_text", "relation_carrier", "RelationRoleCode_text", True, "", "",
          "Text of RelationRoleCode", 30, "", ("Carrier",)),
    # relation_owner
    Entry("Relation_Owner_id", "relation_owner", "Relation", True, "", "",
          "Relation of Owner", 50, "", ()),
    Entry("Relation_Owner_OriginatingObjectID", "relation_owner", "OriginatingObjectID", True, "", "",
          "OriginatingObjectID of Owner", 50, "", ()),
    Entry("Relation_Owner_RelatedObjectID", "relation_owner", "RelatedObjectID", True, "", "",
          "RelatedObjectID of Owner", 50, "", ()),
    Entry("Relation_Owner_OriginatingObjectType_tc", "relation_owner", "OriginatingObjectType", True, "", "4",
          "Code of OriginatingObjectType", 5, "", ("4",)),
    Entry("Relation_Owner_OriginatingObjectType_text", "relation_owner", "OriginatingObjectType_text", True, "", "",
          "Text of OriginatingObjectType", 20, "", ("Holding",)),
    Entry("Relation_Owner_RelatedObjectType_tc", "relation_owner", "RelatedObjectType", True, "", "6",
          "Code of RelatedObjectType", 5, "", ("6",)),
    Entry("Relation_Owner_RelatedObjectType_text", "relation_owner", "RelatedObjectType_text", True, "", "",
          "Text of RelatedObjectType", 20, "", ("Party",)),
    Entry("Relation_Owner_RoleCode_tc", "relation_owner", "RelationRoleCode", True, "", "8",
          "Code of RelationRoleCode", 5, "", ("8",)),
    Entry("Relation_Owner_RoleCode_text", "relation_owner", "RelationRoleCode_text", True, "", "",
          "Text of RelationRoleCode", 30, "", ("Owner",)),
    # relation_annuitant
    Entry("Relation_Annuitant_id", "relation_annuitant", "Relation", False, WHEN_ANNUITANT, "",
          "Relation of Annuitant", 50, "", ()),
    Entry("Relation_Annuitant_OriginatingObjectID", "relation_annuitant", "OriginatingObjectID", False, WHEN_ANNUITANT, "",
          "OriginatingObjectID of Annuitant", 50, "", ()),
    Entry("Relation_Annuitant_RelatedObjectID", "relation_annuitant", "RelatedObjectID", False, WHEN_ANNUITANT, "",
          "RelatedObjectID of Annuitant", 50, "", ()),
    Entry("Relation_Annuitant_OriginatingObjectType_tc", "relation_annuitant", "OriginatingObjectType", False, WHEN_ANNUITANT, "4",
          "Code of OriginatingObjectType", 5, "", ("4",)),
    Entry("Relation_Annuitant_OriginatingObjectType_text", "relation_annuitant", "OriginatingObjectType_text", False, WHEN_ANNUITANT, "",
          "Text of OriginatingObjectType", 20, "", ("Holding",)),
    Entry("Relation_Annuitant_RelatedObjectType_tc", "relation_annuitant", "RelatedObjectType", False, WHEN_ANNUITANT, "6",
          "Code of RelatedObjectType", 5, "", ("6",)),
    Entry("Relation_Annuitant_RelatedObjectType_text", "relation_annuitant", "RelatedObjectType_text", False, WHEN_ANNUITANT, "",
          "Text of RelatedObjectType", 20, "", ("Party",)),
    Entry("Relation_Annuitant_RoleCode_tc", "relation_annuitant", "RelationRoleCode", False, WHEN_ANNUITANT, "35",
          "Code of RelationRoleCode", 5, "", ("35",)),
    Entry("Relation_Annuitant_RoleCode_text", "relation_annuitant", "RelationRoleCode_text", False, WHEN_ANNUITANT, "",
          "Text of RelationRoleCode", 30, "", ("Annuitant",)),
    # metadata
    Entry("ExpectedToPass", "metadata", "", False, "", "",
          "1 when the row should pass", 1, FLAG, ("0", "1")),
    Entry("FailureReason", "metadata", "", False, "", "",
          "Why the row should fail", 0, "", ()),
)
COLUMNS: tuple[str, ...] = tuple(e.column_name for e in DICTIONARY)

# Elements that hold others; never reported as custom.
STRUCTURAL_TAGS = (
    "Envelope", "Body", OPERATION, MESSAGE, "TXLife", "TXLifeRequest", "OLifE", "Holding",
    "Policy", "Arrangement", "Annuity", "TaxWithholding", "OLifEExtension", "Party", "Person",
    "Organization", "Producer", "Carrier", "PartialIdentification", "Relation",
)


def field_tags() -> list[str]:
    """The element names a document is scored against, sorted."""
    marks = ("_text", "_ext", "_AppliesTo")
    return sorted({e.xml_tag for e in DICTIONARY
                   if e.group != "metadata" and e.xml_tag and not any(m in e.xml_tag for m in marks)})


def request_schema() -> T.StructType:
    """The request table: every column a nullable string, with its description."""
    return T.StructType([
        T.StructField(e.column_name, T.StringType(), True, {"comment": e.description})
        for e in DICTIONARY
    ])


def dictionary_frame(spark: SparkSession) -> DataFrame:
    """The dictionary as a DataFrame, one row per column, in order."""
    rows = [
        (i, e.column_name, e.spark_type, e.group, e.xml_tag, e.required, e.conditional, e.tc_code,
         e.description, e.max_length, e.regex, list(e.allowed_values))
        for i, e in enumerate(DICTIONARY, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "ord int, column_name string, spark_type string, `group` string, xml_tag string, "
        "required boolean, conditional string, tc_code string, description string, "
        "max_length int, regex string, allowed_values array<string>",
    )


def required_fields(rules: DataFrame) -> DataFrame:
    return rules.filter("required")


def fields_of_group(rules: DataFrame, group: str) -> DataFrame:
    return rules.filter(rules["group"] == group)


def field_of_column(rules: DataFrame, column_name: str) -> DataFrame:
    return rules.filter(rules["column_name"] == column_name)


def data_fields(rules: DataFrame) -> DataFrame:
    """All but the test metadata."""
    return rules.filter(rules["group"] != "metadata")
