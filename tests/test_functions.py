import random

from conftest import evaluate

from contractloom.functions import lines, text


def one(spark, fn, values):
    return evaluate(spark, lambda F: fn(F.col("x")), [(v,) for v in values], "x string")


def test_strip_suffix(spark):
    cases = {"ABC123MV": "ABC123", "POL999TR": "POL999", "POL999XE": "POL999", "ABC12345": "ABC12345",
             "MVCONTRACT": "MVCONTRACT", "": "", None: None, "MV": "MV", "AMV": "A", "ABC  MV": "ABC",
             "ABC123mv": "ABC123", "ABC123Tr": "ABC123", "ABCMVTR": "ABCMV"}
    assert one(spark, text.strip_suffix, cases) == list(cases.values())
    twice = one(spark, lambda x: text.strip_suffix(text.strip_suffix(x)), ["ABCMVTR"])
    assert twice == ["ABC"]


def test_last4(spark):
    cases = {"123456789": "6789", "***-**-6789": "6789", "12": "12", "5678": "5678", "": "", None: "",
             "SSN:1234": "1234", "ABCDEF": ""}
    assert one(spark, text.last4, cases) == list(cases.values())


def test_extract_producer(spark):
    cases = {"N1234567   N102": "1234567", "700001              N1234567   N102": "1234567",
             "N12345": "12345", "N1234567890": "1234567890", "NOAGENTDATA": "", "": "", None: "",
             "N1234": "", "N11111 N22222": "11111"}
    assert one(spark, text.extract_producer, cases) == list(cases.values())


def test_split_name(spark):
    full = "SMITH".ljust(35) + "JOHN".ljust(25) + "MICHAEL".ljust(25)
    cases = {full: ("SMITH", "JOHN", "MICHAEL"), "DOE": ("DOE", "", ""),
             "JONES".ljust(35) + "ALICE": ("JONES", "ALICE", ""), "": ("", "", ""),
             "   ": ("", "", ""), None: ("", "", "")}
    assert [tuple(r) for r in one(spark, text.split_name, cases)] == list(cases.values())


def test_strip_takes_all_white_space(spark):
    cases = [" \t a b \r\n", "\x0bx\x0c", "", "\xa0y\xa0", None]
    assert one(spark, text.strip, cases) == ["a b", "x", "", "y", None]


def test_is_blank(spark):
    cases = {None: True, "": True, "  ": True, "nan": True, " NaN ": True, "0": False, "x": False}
    assert one(spark, text.is_blank, cases) == list(cases.values())


def test_to_number(spark):
    cases = {" 12.5 ": 12.5, "": None, "abc": None, "nan": None, "1e3": 1000.0, "12d": None, "-4": -4.0}
    assert one(spark, text.to_number, cases) == list(cases.values())


def test_two_decimals_round_like_the_exact_value(spark):
    rng = random.Random(7)
    values = [round(rng.uniform(0, 500_000), 2) * 0.10 for _ in range(3000)] + [2.675, 0.125, 123.455]
    got = evaluate(spark, lambda F: text.two_decimals(F.col("x")), [(v,) for v in values], "x double")
    assert got == [f"{v:.2f}" for v in values]


def test_filename_date(spark):
    cases = {"/a/F.20260320_0305.txt": "20260320", "F.03202026.txt": "20260320", "F.txt": "",
             "/20250101/plain.txt": "", "F.20261320.txt": "", "C:\\d\\F.12312025.txt": "20251231"}
    assert one(spark, text.filename_date, cases) == list(cases.values())


def test_parse_errors(spark):
    cases = [
        ('[{"ResultInfoCode": "A", "ResultInfoDesc": "d"}, {"ResultInfoCode": "B"}]', [("A", "d"), ("B", "")]),
        ("[]", []), (None, []), ("plain text", [("plain text", "plain text")]), ("12", [("12", "12")]),
        ('{"ResultInfoCode": "A"}', [('{"ResultInfoCode": "A"}', '{"ResultInfoCode": "A"}')]),
        ("x" * 50, [("x" * 40, "x" * 50)]),
    ]
    got = one(spark, text.parse_errors, [c for c, _ in cases])
    assert [[tuple(p) for p in r] for r in got] == [e for _, e in cases]


def test_escapes_and_file_names(spark):
    assert one(spark, text.xml_text, ["a&b<c>", "&amp;"]) == ["a&amp;b&lt;c&gt;", "&amp;amp;"]
    assert one(spark, text.xml_attribute, ['"a"']) == ["&quot;a&quot;"]
    assert one(spark, text.safe_filename, ["A/B\\C", "", None, " P1 "]) == [
        "WDQuote_A_B_C.xml", "WDQuote_UNKNOWN.xml", "WDQuote_UNKNOWN.xml", "WDQuote_P1.xml"]


def test_code_tag_order(spark):
    cases = {"100-F058": "[CARRIER] Surrender Free field validation",
             "3013-None": "[TRANSIENT] Internal error", "300-System": "[TRANSIENT] System unavailable",
             "zzz": ""}
    assert one(spark, text.code_tag, cases) == list(cases.values())


def test_detect_record_type(spark):
    cases = {"P10x0": "100", "P12x0": "120", "P1301": "1301", "P1399": None, "P130": None, "F4305": "4305",
             "F40xx": "400", "F42xx": "420", "F4310": None, "HDR.x": None, "": None, None: None}
    assert one(spark, lines.detect_record_type, cases) == list(cases.values())
