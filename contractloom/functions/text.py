"""Text, number and date functions: Column in, Column out, all built-in."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that is stripped from both ends of a field.
WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"

# Product codes at the end of a contract number.
CONTRACT_SUFFIXES = ("MV", "XE", "TR")

# A producer number, and dates in file names with the year first or last.
PRODUCER_PATTERN = r"N(\d{5,10})"
DATE_YEAR_FIRST = r"(20\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])"
DATE_YEAR_LAST = r"(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])(20\d{2})"

ERROR_SCHEMA = "array<struct<ResultInfoCode:string,ResultInfoDesc:string>>"


def strip(x: Column) -> Column:
    """Strip white space at both ends. Spaces go first, in the fast path."""
    return F.btrim(F.trim(x), F.lit(WHITESPACE))


def blank_to_null(x: Column) -> Column:
    """The stripped value, or null when nothing is left."""
    return F.nullif(strip(x), F.lit(""))


def is_blank(x: Column) -> Column:
    """Null, empty, white space, or the text ``nan`` in any case."""
    s = strip(x)
    return x.isNull() | (s == "") | (F.lower(s) == "nan")


def strip_suffix(contract: Column) -> Column:
    """Drop a trailing MV, XE or TR (any case) and the blanks before it."""
    cut = F.rtrim(F.substring(contract, F.lit(1), F.length(contract) - 2))
    marked = (F.length(contract) >= 3) & F.upper(F.substring(contract, -2, 2)).isin(*CONTRACT_SUFFIXES)
    return F.when(marked, cut).otherwise(contract)


def extract_producer(agent_last_name: Column) -> Column:
    """The first producer number, ``N`` and 5 to 10 digits, without the N; else empty."""
    return F.coalesce(F.regexp_extract(agent_last_name, PRODUCER_PATTERN, 1), F.lit(""))


def split_name(composite: Column) -> Column:
    """Struct of last, first and middle name from a composite name field."""
    def part(start: int, width: int) -> Column:
        return F.coalesce(strip(F.substring(composite, start, width)), F.lit(""))

    return F.struct(
        part(1, 35).alias("last"), part(36, 25).alias("first"), part(61, 25).alias("middle")
    )


def last4(x: Column) -> Column:
    """The last four digits, all of them if fewer."""
    return F.coalesce(F.substring(F.regexp_replace(x, r"\D", ""), -4, 4), F.lit(""))  # right() would look for digits twice


def remove_whitespace(x: Column) -> Column:
    return F.regexp_replace(x, r"\s+", "")


def strip_leading_zeros(x: Column) -> Column:
    return F.ltrim(x, F.lit("0"))


def to_number(x: Column) -> Column:
    """A double, or null when the text is not a finite number."""
    return number_of(strip(x))


def number_of(text: Column) -> Column:
    """``to_number`` of a text that is stripped already."""
    number = F.nullif(text, F.lit("")).try_cast("double")  # an empty text would cost an exception
    typed = F.lower(F.right(text, F.lit(1))).isin("d", "f", "y", "n")
    return F.when(~typed, number)


def two_decimals(x: Column) -> Column:
    """Fixed text with two decimals, rounded on the exact binary value."""
    return F.call_function("format_number", x, F.lit("0.00"))


def xml_text(x: Column) -> Column:
    """Escape a value for element text."""
    out = F.replace(x, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def xml_attribute(x: Column) -> Column:
    """Escape a value for an attribute in double quotes."""
    return F.replace(xml_text(x), F.lit('"'), F.lit("&quot;"))


def safe_filename(policy: Column) -> Column:
    """``WDQuote_<policy>.xml`` with slashes made safe; UNKNOWN when there is no policy."""
    name = F.translate(F.coalesce(blank_to_null(policy), F.lit("UNKNOWN")), "/\\", "__")
    return F.concat(F.lit("WDQuote_"), name, F.lit(".xml"))


def join_or_null(items: Column) -> Column:
    """A list joined by ``; ``, null when it is empty."""
    return F.when(F.size(items) > 0, F.array_join(items, "; "))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def filename_date(path: Column) -> Column:
    """A date in the file name as YYYYMMDD: year first, else year last, else empty."""
    name = base_name(path)
    first = F.regexp_extract(name, DATE_YEAR_FIRST, 0)
    last = F.concat(*(F.regexp_extract(name, DATE_YEAR_LAST, g) for g in (3, 1, 2)))
    return F.when(first != "", first).otherwise(F.coalesce(last, F.lit("")))


def hash_below_half(key: Column) -> Column:
    """True for half of all keys, the same half on every run."""
    return F.substring(F.md5(key.cast("binary")), 1, 1) < "8"


def stable_guid(*parts: Column) -> Column:
    """A GUID-shaped text that depends on its parts only."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    spans = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(h, start, width) for start, width in spans))


def parse_errors(text: Column) -> Column:
    """Error pairs from a JSON list of objects.

    Null gives no pairs. Anything that is not a list of objects gives one pair:
    its first 40 characters and the whole text.
    """
    pairs = F.when(F.ltrim(text).startswith("["), F.from_json(text, ERROR_SCHEMA))
    whole = F.array(F.struct(F.left(text, F.lit(40)).alias("ResultInfoCode"),
                             text.alias("ResultInfoDesc")))
    shaped = F.transform(
        F.coalesce(pairs, whole),
        lambda e: F.struct(
            F.coalesce(e["ResultInfoCode"], F.lit("")).alias("code"),
            F.coalesce(e["ResultInfoDesc"], F.lit("")).alias("description"),
        ),
    )
    empty = F.array().cast("array<struct<code:string,description:string>>")
    return F.when(text.isNull(), empty).otherwise(shaped)


def error_codes(pairs: Column) -> Column:
    """The codes of error pairs, joined by ``; ``."""
    return F.array_join(F.transform(pairs, lambda e: e["code"]), "; ")


# Advice by error code; the first pattern found in the code decides.
CODE_TAGS = (
    ("2109", "[DATA] POV contra-participant stale"),
    ("F058", "[CARRIER] Surrender Free field validation"),
    ("A687", "[CARRIER] Surrender Free field validation"),
    ("X173", "[DATA] Carrier rider value = 0"),
    ("ET38", "[CODE] Owner party extraction gap"),
    ("1004903053", "[DATA] POV status lag"),
    ("300", "[TRANSIENT] System unavailable"),
    ("3013", "[TRANSIENT] Internal error"),
    ("2027", "[DATA] Contract restricted"),
    ("BA11", "[KNOWN] Agent SSN unavailable in POV"),
    ("WDS3", "[INFO] Disclosure warning"),
    ("A452", "[INVESTIGATE] Missing field A452"),
    ("E487", "[INVESTIGATE] Missing field E487"),
)


def code_tag(code: Column) -> Column:
    """Advice for an error code, empty when there is none."""
    tagged = [F.when(code.contains(mark), F.lit(tag)) for mark, tag in CODE_TAGS]
    return F.coalesce(*tagged, F.lit(""))


def first_present(columns: Iterable[Column]) -> Column:
    return F.coalesce(*columns)


def those_present(items: Iterable[Column]) -> Column:
    """The texts that are not null, in order, as a list.

    As ``array_compact`` of them, whose items Spark would work out one by one without compiling them.
    """
    none = F.array().cast("array<string>")
    lists = [F.when(i.isNotNull(), F.array(i)).otherwise(none) for i in items]
    return F.flatten(F.array(*lists)) if lists else none


def any_of(flags: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags, F.lit(False))
