"""Contract operators: one fact row per contract, de-duplication, filters, classification.

A fact row holds what the later steps need of a contract. It comes from records in
one aggregation that combines before the shuffle, or from wide rows by expressions
alone:

``file, contract, base, first_line, cusip, status, account, state, contra,
agent_name, agent_last_name, ra_amount, sc_amount, tw_amount, total_value, rider,
owner, annuitant, owner_fallback_id, annuitant_fallback_id``
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractloom.functions.lines import contra_of, contract_of, field_of
from contractloom.functions.text import (
    any_of,
    extract_producer,
    hash_below_half,
    number_of,
    split_name,
    strip,
    strip_suffix,
    to_number,
    two_decimals,
)
from contractloom.operators.fence import fence
from contractloom.sources.fixed_width import detail_records
from contractloom.spec.layouts import LAYOUTS

# Roles, statuses, qualifiers and rider codes.
OWNER_ROLES = ("OK", "HA", "JV", "HC")
ANNUITANT_ROLES = ("G2", "G5")
ACTIVE_STATUSES = ("VA", "AA")
RIDER_CODES = ("204", "336", "215")
QUALIFIERS = {"ra_amount": "RA", "sc_amount": "SC", "tw_amount": "TW"}
VALUE_PAIRS = range(1, 6)

PARTY = "struct<last:string,first:string,middle:string,id:string>"


# Expressions over one value record, given as (amount, qualifier) pairs.

def greatest_amount(pairs: Sequence[tuple[Column, Column]], code: str) -> Column:
    """The largest positive amount with a qualifier, null when there is none."""
    found = [
        F.when((strip(q) == code) & (to_number(a) > 0), to_number(a)) for a, q in pairs
    ]
    return F.greatest(*found) if len(found) > 1 else found[0]


def greatest_value(amounts: Sequence[Column]) -> Column:
    """The largest amount, at least 0."""
    return F.greatest(F.lit(0.0), *(to_number(a) for a in amounts))


def active_rider(program: Column, code: Column, value: Column) -> Column:
    """Whether one service feature is an active rider."""
    found = (strip(program) == "R") & strip(code).isin(*RIDER_CODES) & (to_number(value) > 0)
    return F.coalesce(found, F.lit(False))


def party_of(composite: Column, last_name: Column, roles: Sequence[str]) -> Column:
    """Name parts and id of a party with one of the roles; null for any other."""
    name = split_name(composite)
    matches = F.substring(last_name, 1, 2).isin(*roles) & (strip(composite) != "")
    return F.when(matches, F.struct(
        name["last"].alias("last"), name["first"].alias("first"), name["middle"].alias("middle"),
        strip(F.substring(last_name, 3, 20)).alias("id"),
    ))


def party_id_of(last_name: Column, roles: Sequence[str]) -> Column:
    """The id in the last-name field for a role, whatever the composite name says."""
    matches = F.substring(last_name, 1, 2).isin(*roles)
    return F.when(matches, F.nullif(strip(F.substring(last_name, 3, 20)), F.lit("")))


def _value_pairs(raw: Column) -> list[tuple[Column, Column]]:
    return [
        (field_of(raw, "1302", f"Contract_Value_Amount_{i}"),
         field_of(raw, "1302", f"Contract_Value_Qualifier_{i}"))
        for i in VALUE_PAIRS
    ]


def _value_list(line: Column, first: int = 1) -> Column:
    """The amounts and qualifiers of a value record as a list of (amount, qualifier).

    ``line`` may be a part of the record that begins at its character ``first``. Pairs are cut out
    whole, as each cut counts the characters of the text it is made from.
    """
    fields = [
        (LAYOUTS["1302"].field(f"Contract_Value_Amount_{i}"), LAYOUTS["1302"].field(f"Contract_Value_Qualifier_{i}"))
        for i in VALUE_PAIRS
    ]
    (shape,) = {(a.width, q.start - a.start + 1, q.width) for a, q in fields}  # alike in all pairs
    width, q_at, q_width = shape
    starts = F.array(*(F.lit(a.start - first + 1) for a, _ in fields))
    pairs = F.transform(starts, lambda at: F.substring(line, at, F.lit(q_at + q_width - 1)))
    texts = F.transform(pairs, lambda p: F.struct(
        strip(F.substring(p, 1, width)).alias("amount"), strip(F.substring(p, q_at, q_width)).alias("qualifier")))
    return F.transform(texts, lambda t: F.struct(number_of(t["amount"]).alias("amount"), t["qualifier"].alias("qualifier")))


def _largest(pairs: Column | str, code: str) -> Column:
    """The largest positive amount with a qualifier in a list of ``_value_list``, null when there is none."""
    return F.array_max(F.transform(pairs, lambda p: F.when((p["qualifier"] == code) & (p["amount"] > 0), p["amount"])))


def qualifier_amount(records: DataFrame, code: str) -> DataFrame:
    """Per contract: the largest positive amount with a qualifier, over all value records."""
    values = records.filter(F.col("record_type") == "1302").select(
        "file", "contract", _largest(_value_list(F.col("raw")), code).alias("amount"))
    return (
        fence(values)
        .filter(F.col("amount").isNotNull())
        .groupBy("file", "contract")
        .agg(F.max("amount").alias("amount"))
    )


def total_value(records: DataFrame) -> DataFrame:
    """Per contract: the largest of all value amounts, at least 0."""
    amounts = [a for a, _ in _value_pairs(F.col("raw"))]
    value = F.when(F.col("record_type") == "1302", greatest_value(amounts))
    return (
        detail_records(records)
        .groupBy("file", "contract")
        .agg(F.coalesce(F.max(value), F.lit(0.0)).alias("total_value"))
    )


# The fields that facts are made of, by record type.
FACT_FIELDS = {
    "1301": ("CUSIP_Number", "Contract_Status", "Distributors_Account_ID", "Contract_State"),
    "1302": tuple(f"Contract_Value_{n}_{i}" for i in VALUE_PAIRS for n in ("Amount", "Qualifier")),
    "1305": ("Agent_Non_Natural_Name", "Agent_Last_Name"),
    "1309": ("Party_Non_Natural_Entity_Name", "Party_Last_Name"),
    "1315": ("Service_Feature_Program_Type", "Service_Feature_Type_Code_1", "Service_Feature_Value"),
}


def _first_place(record_type: str) -> int:
    return min(LAYOUTS[record_type].field(n).start for n in FACT_FIELDS[record_type])


def _part(raw: Column, record_type: Column) -> Column:
    """The part of a line that its ``FACT_FIELDS`` are in, from the first to the last; null for other types."""
    def part(t: str) -> Column:
        first, fields = _first_place(t), [LAYOUTS[t].field(n) for n in FACT_FIELDS[t]]
        return F.substring(raw, first, max(f.start + f.width for f in fields) - first)

    out = F.lit(None).cast("string")
    for t in FACT_FIELDS:
        out = F.when(record_type == t, part(t)).otherwise(out)
    return out


def _part_field(part: Column, record_type: str, name: str) -> Column:
    """One field, stripped, of the part of a line."""
    field = LAYOUTS[record_type].field(name)
    return strip(F.substring(part, field.start - _first_place(record_type) + 1, field.width))


def _rider_flag(line: Column, field=field_of) -> Column:
    return active_rider(*(field(line, "1315", name) for name in FACT_FIELDS["1315"]))


def rider_contracts(records: DataFrame) -> DataFrame:
    """Contracts with an active rider in any occurrence."""
    return (
        records.filter(F.col("record_type") == "1315")
        .filter(_rider_flag(F.col("raw")))
        .select("file", "contract")
        .distinct()
    )


def _first_party(party: Column, order: Column) -> Column:
    """The first party with a first name, else the first one."""
    rank = F.when(party.isNotNull(), F.struct((party["first"] == "").alias("unnamed"), order))
    return F.min_by(party, rank)


def party_by_role(records: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Per contract: the party that holds one of the roles."""
    part = F.col("part")
    party = party_of(_part_field(part, "1309", "Party_Non_Natural_Entity_Name"),
                     _part_field(part, "1309", "Party_Last_Name"), roles)
    return (
        records.filter(F.col("record_type") == "1309")
        .select("file", "contract", "line_no", _part(F.col("raw"), F.lit("1309")).alias("part"))
        .select("file", "contract", "line_no", party.alias("party"))
        .filter(F.col("party").isNotNull())
        .groupBy("contract", "file")
        .agg(_first_party(F.col("party"), F.col("line_no")).alias("party"))
        .select("file", "contract", "party.last", "party.first", "party.middle", "party.id")
    )


def party_id_fallback(records: DataFrame, roles: Sequence[str], *,
                      text_order: bool = False) -> DataFrame:
    """Per contract: the first id found in the last-name field for a role.

    ``text_order`` takes occurrences in the order of their numbers as text
    (1, 10, 2) and needs records with ``occ``.
    """
    order = F.struct(F.col("occ").cast("string")) if text_order else F.struct("line_no")
    found = party_id_of(F.col("last_name"), roles)
    return (
        records.filter(F.col("record_type") == "1309")
        .select("file", "contract", order.alias("o"), _part(F.col("raw"), F.lit("1309")).alias("part"))
        .select("file", "contract", "o", _part_field(F.col("part"), "1309", "Party_Last_Name").alias("last_name"))
        .select("file", "contract", "o", found.alias("id"))
        .filter(F.col("id").isNotNull())
        .groupBy("contract", "file")
        .agg(F.min_by("id", "o").alias("id"))
        .select("file", "contract", "id")
    )


def contra_lookup(lines: DataFrame) -> DataFrame:
    """Base contract to contra participant, from the extended contract headers.

    The last line of a contract counts; of several contracts with one base, the
    one that appears last.
    """
    value, line_no = F.col("value"), F.col("line_no")
    return (
        lines.filter(F.substring(value, 2, 4) == "1301").filter(F.length(value) == 336)
        .select("file", "line_no", contract_of(value, F.lit("1301")).alias("contract"),
                contra_of(value).alias("contra"))
        .groupBy("contract", "file")
        .agg(F.max_by("contra", line_no).alias("contra"), F.min(line_no).alias("first_line"))
        .groupBy(strip_suffix(F.col("contract")).alias("base"), "file")
        .agg(F.max_by("contra", "first_line").alias("contra"))
        .select("file", "base", "contra")
    )


def facts_from_records(records: DataFrame) -> DataFrame:
    """One fact row per contract, by one aggregation over the record types it needs.

    Contracts without any of these types still get a row.
    """
    t, raw, line_no, part = F.col("record_type"), F.col("raw"), F.col("line_no"), F.col("part")

    def when(record_type: str, value: Column) -> Column:
        return F.when(t == record_type, value)

    def fields(record_type: str, *names: str) -> Column:
        values = zip(FACT_FIELDS[record_type], names, strict=True)
        return F.struct(*(_part_field(part, record_type, f).alias(n) for f, n in values))

    # Values that are used more than once become columns first. Pairs of an amount and a qualifier
    # are one list: a column for each made a method so large that the JVM only interpreted it.
    # Fields are cut from a part of the line, as a cut walks over the characters of its text.
    parts = detail_records(records).select(
        "file", "contract", "line_no", "record_type",
        when("1301", contra_of(raw)).alias("contra"), _part(raw, t).alias("part"),
    )
    cut_out = parts.select(
        "file", "contract", "line_no", "record_type", "contra",
        when("1301", fields("1301", "cusip", "status", "account", "state")).alias("header"),
        when("1305", fields("1305", "name", "last_name")).alias("agent"),
        when("1315", _rider_flag(part, _part_field)).alias("rider"),
        when("1302", _value_list(part, _first_place("1302"))).alias("pairs"),
        when("1309", _part_field(part, "1309", "Party_Non_Natural_Entity_Name")).alias("composite"),
        when("1309", _part_field(part, "1309", "Party_Last_Name")).alias("last_name"),
    )
    composite, last_name = F.col("composite"), F.col("last_name")
    named = cut_out.select(
        "file", "contract", "line_no", "header", "contra", "agent", "rider", "pairs",
        F.substring(last_name, 1, 2).alias("role"),
        party_of(composite, last_name, OWNER_ROLES + ANNUITANT_ROLES).alias("party"),
        party_id_of(last_name, OWNER_ROLES + ANNUITANT_ROLES).alias("party_id"),
    )

    owner, annuitant = (F.col("role").isin(*roles) for roles in (OWNER_ROLES, ANNUITANT_ROLES))
    narrow = named.select(
        "file", "contract", "line_no", "header", "contra", "agent", "rider",
        *(_largest("pairs", q).alias(n) for n, q in QUALIFIERS.items()),
        F.array_max(F.transform("pairs", lambda p: p["amount"])).alias("total_value"),
        F.when(owner, F.col("party")).alias("owner"),
        F.when(annuitant, F.col("party")).alias("annuitant"),
        F.when(owner, F.col("party_id")).alias("owner_id"),
        F.when(annuitant, F.col("party_id")).alias("annuitant_id"),
    )

    def present(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), line_no)

    # Rows are sorted by the group for texts and structs: contracts differ in their first bytes, file names do not.
    grouped = narrow.groupBy("contract", "file").agg(
        F.min("line_no").alias("first_line"),
        F.max_by("header", present("header")).alias("header"),
        F.max_by("contra", present("contra")).alias("contra"),
        F.min_by("agent", present("agent")).alias("agent"),
        *(F.max(n).alias(n) for n in QUALIFIERS),
        F.greatest(F.max("total_value"), F.lit(0.0)).alias("total_value"),
        F.coalesce(F.bool_or("rider"), F.lit(False)).alias("rider"),
        _first_party(F.col("owner"), line_no).alias("owner"),
        _first_party(F.col("annuitant"), line_no).alias("annuitant"),
        F.min_by("owner_id", present("owner_id")).alias("owner_fallback_id"),
        F.min_by("annuitant_id", present("annuitant_id")).alias("annuitant_fallback_id"),
    )
    blank = F.lit("")
    return grouped.select(
        "file", "contract", strip_suffix(F.col("contract")).alias("base"), "first_line",
        *(F.coalesce(f"header.{c}", blank).alias(c) for c in ("cusip", "status", "account", "state")),
        "contra",
        F.coalesce("agent.name", blank).alias("agent_name"),
        F.coalesce("agent.last_name", blank).alias("agent_last_name"),
        *QUALIFIERS, "total_value", "rider", *_filled_parties(),
    )


def _filled_parties() -> list[Column]:
    none = F.struct(*(F.lit("").alias(n) for n in ("last", "first", "middle", "id")))
    return [
        *(F.coalesce(F.col(p), none).cast(PARTY).alias(p) for p in ("owner", "annuitant")),
        *(F.coalesce(f"{p}_fallback_id", F.lit("")).alias(f"{p}_fallback_id")
          for p in ("owner", "annuitant")),
    ]


def resolve_column(df: DataFrame, base: str) -> Column:
    """The column, else its first occurrence, else empty; null reads as empty."""
    for name in (base, f"{base}_1"):
        if name in df.columns:
            return F.coalesce(F.col(f"`{name}`"), F.lit(""))
    return F.lit("")


def _occurrences(df: DataFrame, base: str) -> list[str]:
    """The suffixes under which a wide field occurs, in numeric order."""
    found = [""] if base in df.columns else []
    numbers = sorted(
        int(c[len(base) + 1:]) for c in df.columns
        if c.startswith(base + "_") and c[len(base) + 1:].isdigit()
    )
    return found + [f"_{n}" for n in numbers]


def facts_from_wide(wide: DataFrame, contra: DataFrame | None = None) -> DataFrame:
    """One fact row per wide row, by expressions over its columns; no shuffle.

    ``contra`` is the result of ``contra_lookup``, joined on the base contract.
    """
    def col(base: str, suffix: str) -> Column:
        name = base + suffix
        return F.coalesce(F.col(f"`{name}`"), F.lit("")) if name in wide.columns else F.lit("")

    pairs = [
        (col(f"1302_Contract_Value_Amount_{i}", s), col(f"1302_Contract_Value_Qualifier_{i}", s))
        for i in VALUE_PAIRS for s in _occurrences(wide, f"1302_Contract_Value_Amount_{i}")
    ]
    riders = [
        active_rider(col("1315_Service_Feature_Program_Type", s),
                     col("1315_Service_Feature_Type_Code_1", s),
                     col("1315_Service_Feature_Value", s))
        for s in _occurrences(wide, "1315_Service_Feature_Program_Type")
    ]
    suffixes = _occurrences(wide, "1309_Party_Last_Name")

    def party(roles: Sequence[str]) -> Column:
        all_ = F.array_compact(F.array(*(
            party_of(col("1309_Party_Non_Natural_Entity_Name", s), col("1309_Party_Last_Name", s),
                     roles)
            for s in suffixes
        ))) if suffixes else F.array().cast(f"array<{PARTY}>")
        named = F.filter(all_, lambda p: p["first"] != "")
        return F.coalesce(F.get(named, F.lit(0)), F.get(all_, F.lit(0)))

    def party_id(roles: Sequence[str]) -> Column:
        ids = [party_id_of(col("1309_Party_Last_Name", s), roles) for s in suffixes]
        return F.coalesce(*ids, F.lit(""))

    no_amount = F.lit(None).cast("double")
    out = wide.select(
        F.col("file") if "file" in wide.columns else F.lit("").alias("file"),
        strip(F.col("Contract_Number")).alias("contract"),
        strip_suffix(strip(F.col("Contract_Number"))).alias("base"),
        F.col("first_line") if "first_line" in wide.columns
        else F.monotonically_increasing_id().alias("first_line"),
        resolve_column(wide, "1301_CUSIP_Number").alias("cusip"),
        (resolve_column(wide, "1301_Contract_Status")
         if {"1301_Contract_Status", "1301_Contract_Status_1"} & set(wide.columns)
         else F.lit(None).cast("string")).alias("status"),
        resolve_column(wide, "1301_Distributors_Account_ID").alias("account"),
        resolve_column(wide, "1301_Contract_State").alias("state"),
        resolve_column(wide, "1305_Agent_Non_Natural_Name").alias("agent_name"),
        resolve_column(wide, "1305_Agent_Last_Name").alias("agent_last_name"),
        *((greatest_amount(pairs, q) if pairs else no_amount).alias(n)
          for n, q in QUALIFIERS.items()),
        (greatest_value([a for a, _ in pairs]) if pairs else F.lit(0.0)).alias("total_value"),
        any_of(riders).alias("rider"),
        party(OWNER_ROLES).alias("owner"),
        party(ANNUITANT_ROLES).alias("annuitant"),
        party_id(OWNER_ROLES).alias("owner_fallback_id"),
        party_id(ANNUITANT_ROLES).alias("annuitant_fallback_id"),
    )
    if contra is None:
        out = out.withColumn("contra", F.lit(None).cast("string"))
    else:
        keys = ["file", "base"] if "file" in wide.columns else ["base"]
        out = out.join(contra.select(*keys, "contra"), keys, "left")
    names = ["file", "contract", "base", "first_line", "cusip", "status", "account", "state",
             "contra", "agent_name", "agent_last_name", *QUALIFIERS, "total_value", "rider"]
    return out.select(*names, *_filled_parties())


def dedup_contracts(facts: DataFrame) -> DataFrame:
    """One row per base contract: the one with the longest agent text, then the first.

    The contract becomes the base; the contra participant is that of the
    contract that appears last.
    """
    row = F.struct(*(F.col(c) for c in facts.columns))
    best = F.struct(F.length("agent_last_name"), -F.col("first_line"))
    seen = F.when(F.col("contra").isNotNull(), F.col("first_line"))
    kept = facts.groupBy("base", "file").agg(
        F.max_by(row, best).alias("r"), F.max_by("contra", seen).alias("contra")
    )
    return kept.select(*(
        F.col("base").alias("contract") if c == "contract"
        else F.col(c) if c in ("file", "base", "contra") else F.col(f"r.{c}").alias(c)
        for c in facts.columns
    ))


def dedup_wide(wide: DataFrame) -> DataFrame:
    """De-duplicate wide rows as they are, by the first agent last-name column."""
    agent = next((c for c in wide.columns if c.startswith("1305_Agent_Last_Name")), None)
    length = F.length(F.coalesce(F.col(f"`{agent}`"), F.lit(""))) if agent else F.lit(0)
    order = -F.col("first_line") if "first_line" in wide.columns else F.lit(0)
    keys = ["file"] if "file" in wide.columns else []
    row = F.struct(*(F.col(f"`{c}`") for c in wide.columns))
    kept = wide.groupBy(*keys, strip_suffix(strip(F.col("Contract_Number"))).alias("_base")).agg(
        F.max_by(row, F.struct(length, order)).alias("r")
    )
    return kept.select(*(
        F.col("_base").alias(c) if c == "Contract_Number" else F.col(f"r.`{c}`").alias(c)
        for c in wide.columns
    ))


def filter_distributor(facts: DataFrame, distributor: str | None) -> DataFrame:
    """Contracts of one contra participant; ``None`` or ``ALL`` keeps all."""
    if distributor in (None, "", "ALL"):
        return facts
    return facts.filter(F.col("contra") == distributor)


def filter_active(facts: DataFrame) -> DataFrame:
    """Contracts in force. A null status says that the input has no such column: all stay."""
    status = F.col("status")
    return facts.filter(status.isNull() | strip(status).isin(*ACTIVE_STATUSES))


def excluded_by_status(facts: DataFrame) -> DataFrame:
    """How many contracts the status filter drops, by status."""
    return (
        facts.filter(~strip(F.col("status")).isin(*ACTIVE_STATUSES))
        .groupBy(strip(F.col("status")).alias("status"))
        .agg(F.count("*").alias("n"))
    )


def classify(facts: DataFrame) -> DataFrame:
    """Add the withdrawal type, the base amount, and the value as percent or amount."""
    typed = facts.withColumn(
        "withdrawal_type",
        F.when(F.col("ra_amount") > 0, "RMD")
        .when(F.col("rider"), "Rider Free")
        .when(F.col("sc_amount") > 0, "Interest Only")
        .when(F.col("tw_amount") > 0, "Surrender Free")
        .otherwise("Partial Withdrawal"),
    ).withColumn(
        "base_amount",
        F.when(F.col("withdrawal_type") == "RMD", F.col("ra_amount"))
        .when(F.col("withdrawal_type") == "Interest Only", F.col("sc_amount"))
        .when(F.col("withdrawal_type") == "Surrender Free", F.col("tw_amount"))
        .otherwise(F.col("total_value")),
    )
    tenth = F.when(F.col("base_amount") > 0, two_decimals(F.col("base_amount") * 0.10))
    return typed.withColumn(
        "value_type", F.when(hash_below_half(F.col("contract")), "Percent").otherwise("Amount")
    ).withColumn(
        "withdrawal_value",
        F.when(F.col("value_type") == "Percent", "10.00").otherwise(F.coalesce(tenth, F.lit("0.00"))),
    )


def withdrawal_distribution(classified: DataFrame) -> DataFrame:
    """Contracts per withdrawal type, split by percent and amount; the most frequent first."""
    return classified.groupBy("withdrawal_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value_type") == "Percent").alias("percent_n"),
        F.count_if(F.col("value_type") == "Amount").alias("amount_n"),
    ).orderBy(F.desc("n"), "withdrawal_type")


def producer_number(facts: DataFrame) -> Column:
    return extract_producer(facts["agent_last_name"])


