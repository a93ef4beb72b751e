"""Edge tables for the scalar functions (expected values from FIXTURES.md §D)."""

from pyspark.sql import functions as F

from rsvpflow.functions import scalars as S
from rsvpflow.sources.tables import clean_header


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_safe_int(spark):
    vals = ["12", " 12 ", "3.9", "-3.9", "1e3", "nan", "inf", "", "abc", "1,000", "1d", "0x10", None]
    assert one_col(spark, vals, S.safe_int) == [12, 12, 3, -3, 1000, 0, 0, 0, 0, 0, 0, 0, 0]


def test_title_case(spark):
    vals = ["o'brien & l&t", "2nd round", "  x-ray_lab 3m ", "ab12cd", None, ""]
    assert one_col(spark, vals, S.title_case) == ["O'Brien & L&T", "2Nd Round", "X-Ray_Lab 3M", "Ab12Cd", None, ""]


def test_title_matches_python(spark):
    vals = ["hello world", "MIXED case-Words", "a1b2 c3", "new  delhi", "élan vital", "x"]
    assert one_col(spark, vals, S.title_case) == [v.strip().title() for v in vals]


def test_weight_and_label(spark):
    vals = ["2 Positive", "0 Negative", " 3  maybe", "Positive", "2", "2Positive", None]
    assert one_col(spark, vals, S.response_weight) == [2, 0, 3, 1, 1, 1, 1]
    assert one_col(spark, vals, S.response_label) == ["Positive", "Negative", "Maybe", "Positive", "2",
                                                      "2Positive", None]


def test_numeric_prefix(spark):
    vals = ["Registered", "1 Positive", "-1x", "1.0", " 1", "1e0z", "", ".5", None]
    assert one_col(spark, vals, S.numeric_prefix) == [0.0, 1.0, -1.0, 1.0, 1.0, 1.0, 0.0, 0.5, None]


def test_region(spark):
    vals = ["Navi Mumbai", "new delhi", "Kota Bangalore", "Paris", None, " Pune ", "KOLKATA"]
    assert one_col(spark, vals, S.region_of) == ["West", "North", "South", "Other", "Unknown", "West", "East"]


def test_conversion_rate(spark):
    df = spark.createDataFrame([("3", "4"), ("1", "0"), ("0", "5"), ("abc", "x")], "r string, i string")
    got = [r[0] for r in df.select(S.conversion_rate(S.safe_int("r"), S.safe_int("i"))).collect()]
    assert got == [75.0, 0.0, 0.0, 0.0]


def test_vcard_escape_and_defaults(spark):
    # Python strips the trailing newline before escaping; inner newlines become a literal \n
    assert one_col(spark, ["a\\b,c;d\n"], S.vcard_escape) == [r"a\\b\,c\;d"]
    df = spark.createDataFrame([(None, None, None, "+1", None)], "n string, d string, c string, p string, e string")
    card = df.select(S.vcard_card("n", "d", "c", "p", "e")).first()[0]
    assert card == "BEGIN:VCARD\nVERSION:3.0\nFN:Unknown Company\nN:Company;Unknown;;;\nTEL;TYPE=WORK,VOICE:+1\nEND:VCARD"
    df = spark.createDataFrame([("Ann", "VP, Tax", "Acme; Inc", "", "a@x")], "n string, d string, c string, p string, e string")
    card = df.select(S.vcard_card("n", "d", "c", "p", "e")).first()[0]
    assert card == ("BEGIN:VCARD\nVERSION:3.0\nFN:Ann (VP\\, Tax) Acme\\; Inc\nN:Acme\\; Inc;Ann (VP\\, Tax);;;\n"
                    "EMAIL;TYPE=WORK:a@x\nEND:VCARD")


def test_escape_inner_newline(spark):
    assert one_col(spark, ["a\nb"], S.vcard_escape) == ["a\\nb"]


def test_dates(spark):
    got = one_col(spark, ["2024-01-05", "not a date", None, "2024/02/03", "2024-03-04 10:11:12"], S.parse_date)
    assert [str(x) if x else None for x in got] == ["2024-01-05", None, None, "2024-02-03", "2024-03-04"]


def test_header_clean():
    assert [clean_header(h, i) for i, h in enumerate(["", "Client Name", "# Invitees", "Circle-Back", "a.b"])] == [
        "Unnamed_Column_1", "Client_Name", "num_Invitees", "Circle_Back", "a_b"]


def test_strip_is_python_strip(spark):
    vals = ["\tjohn smith\n", "\u00a0x\u2003", " \x1f a b \x85", "\u3000", ""]
    assert one_col(spark, vals, S.strip) == [v.strip() for v in vals]
    assert one_col(spark, vals, S.title_case) == [v.strip().title() for v in vals]
    assert one_col(spark, ["\n2 positive", "2\u00a0positive", "\t7\tx"], S.response_weight) == [2, 2, 7]
    assert one_col(spark, ["\n2 positive", "2\u00a0positive", "Registered\n"], S.response_label) == ["Positive", "Positive", "Registered"]
    assert one_col(spark, ["Registered\n", " \u00a0POSITIVE"], S.clean_response) == ["registered", "positive"]


def test_dates_month_first_and_names(spark):
    vals = ["05-03-2024", "25-03-2024", "12/25/2024", "25-Dec-2024", "25-DEC-2024", "25 dec 2024", "Dec 25, 2024", "2024-12-25T10:11:12",
            "2024-12-25 10:11:12", "20241225", "2024/1/5", "nonsense", "13/13/2024", None]
    assert [d and str(d) for d in one_col(spark, vals, S.parse_date)] == [
        "2024-05-03", "2024-03-25", "2024-12-25", "2024-12-25", "2024-12-25", "2024-12-25", "2024-12-25", "2024-12-25", "2024-12-25",
        "2024-12-25", "2024-01-05", None, None, None]


def test_rates_round_like_python(spark):
    pairs = [(1, 800), (1, 32), (3, 800), (7, 800), (2, 3), (0, 5)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long").orderBy("i")
    assert [r[0] for r in df.select(S.conversion_rate(F.col("a"), F.col("b"))).collect()] == [round(a / b * 100, 2) for a, b in pairs]


def test_headers_of_any_script():
    assert clean_header("nan", 3) == "Unnamed_Column_4"
    assert clean_header("Größe", 0) == "Größe" and clean_header("名前", 0) == "名前" and clean_header("a#b c-d.e", 0) == "anumb_c_d_e"


def test_dates_as_written_in_sheets(spark):
    vals = {"2024-01-02 10:11": "2024-01-02", "2024-01-02T10:11:12Z": "2024-01-02", "2024-01-02 10:11:12.123456": "2024-01-02",
            "2024-01-02T23:59:59+05:30": "2024-01-02", "January 5, 2024": "2024-01-05", "5 January 2024": "2024-01-05", "1/2/24": "2024-01-02",
            "05-Mar-24": "2024-03-05", "01/02/2024 10:30": "2024-01-02", "13/02/2024": "2024-02-13", "5th Sept 2024": "2024-09-05", "May 3 99": "1999-05-03",
            "20240105": "2024-01-05", "20240105 1:02 pm": "2024-01-05", " 2024/1/5\u00a0": "2024-01-05", "29-Feb-2024": "2024-02-29", "29-Feb-2023": None,
            "2024-13-01": None, "2024-01-02 25:00": None, "1/2-2024": None, "31/31/2024": None, "2024": None, "2024-05": None, "5 Janvier 2024": None,
            "2024-01-02 x": None, "=2024-01-02": None, "now": None, "": None, "12": None, "1/2/345": None}
    got = one_col(spark, list(vals), S.parse_date)
    assert {k: d and str(d) for k, d in zip(vals, got)} == vals


def test_dates_follow_the_vote_of_their_column(spark):
    rows = [("13/01/2024", "01-02-24", "31012024"), ("05/03/2024", "99-12-25", "05032024"), ("04/25/2024", "24-11-30", "20240105"), (None, "x", "")]
    df = spark.createDataFrame(rows * 3 + [("20/02/2024", "24-01-31", "28022024")], "a string, b string, c string")
    assert {k: v for k, v in S.date_orders(df, "a").items() if k == "/4"} == {"/4": "dmy"}
    got = S.with_inferred_dates(df, {"a": "da", "b": "db", "c": "dc"}).limit(4).collect()
    assert [[x and str(x) for x in r[3:]] for r in got] == [["2024-01-13", "2001-02-24", "2024-01-31"], ["2024-03-05", "1999-12-25", "2024-03-05"],
                                                           [None, "2024-11-30", None], [None, None, None]]
