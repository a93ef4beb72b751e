"""Scalar column functions.

All functions (but ``date_orders`` and ``with_inferred_dates``, which look at a whole column) return ``pyspark.sql.Column``
built only from built-in expressions, on the JVM without Python.  All but the general case
of title-casing (an interpreted higher-order function) take part in code generation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "present", "safe_int", "title_case", "conversion_rate", "region_of", "REGIONS",
    "response_label", "response_weight", "parse_date", "date_orders", "with_inferred_dates", "DATE_SHAPES", "clean_response",
    "numeric_prefix", "vcard_escape", "vcard_card", "client_contact_label",
    "is_registered", "col_of", "strip", "round2", "WHITESPACE", "WS_CLASS",
]

# The characters that Python's str.strip() removes and its \\s matches.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
              "\u200a\u2028\u2029\u202f\u205f\u3000")
#: The same set as a regular-expression class.
WS_CLASS = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Python ``str.strip()``: all Unicode white space, not blanks alone."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def round2(c: Column) -> Column:
    """Two decimals, ties to even (``rint(x * 100) / 100``; Python's ``round`` looks at the binary value instead, which
    differs by 0.01 where a third decimal 5 has no exact binary form)."""
    return F.bround(c * F.lit(100.0), 0) / F.lit(100.0)


# ---------------------------------------------------------------- predicates
def present(c: str | Column) -> Column:
    """A phone is present when it is non-NULL and not the empty string (no trim)."""
    c = col_of(c)
    return c.isNotNull() & (c != F.lit(""))


def is_registered(c: str | Column) -> Column:
    """``lower(x) = 'registered'`` (no trim); NULL -> false."""
    return F.coalesce(F.lower(col_of(c)) == F.lit("registered"), F.lit(False))


# ---------------------------------------------------------------- numbers
# A decimal / scientific literal as Python's float() accepts it (surrounding whitespace allowed).
_FLOAT_FULL = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
# MySQL string->number coercion reads the longest numeric prefix.
_FLOAT_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def safe_int(c: str | Column) -> Column:
    """``int(float(str(v)))`` with every failure -> 0 (truncates toward zero)."""
    num = F.regexp_extract(col_of(c), _FLOAT_FULL, 1)
    as_double = F.nullif(num, F.lit("")).try_cast("double")
    return F.coalesce(as_double.try_cast("bigint"), F.lit(0).cast("bigint"))


def numeric_prefix(c: str | Column) -> Column:
    """MySQL-style numeric coercion of text: leading numeric prefix, else 0; NULL stays NULL."""
    c = col_of(c)
    num = F.nullif(F.regexp_extract(c, _FLOAT_PREFIX, 1), F.lit("")).try_cast("double")
    return F.when(c.isNotNull(), F.coalesce(num, F.lit(0.0)))


def conversion_rate(registrations: Column, invitees: Column) -> Column:
    """``round(reg / inv * 100, 2)``, ties to even; 0 when inv <= 0."""
    return F.when(invitees > 0, round2(registrations / invitees * F.lit(100.0))).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- text
def title_case(c: str | Column) -> Column:
    """Python ``str(x).strip().title()``: capitalise the first letter of every letter run.

    Letters-and-spaces values (most names) take the native ``initcap`` fast path, which agrees
    with ``title()`` there; anything else is split into letter / non-letter runs.
    """
    t = strip(c)
    runs = F.regexp_extract_all(t, F.lit(r"(\p{L}+|[^\p{L}]+)"), 0)
    general = F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30)))),
        "",
    )
    return F.when(t.rlike(r"^[\p{L} ]*$"), F.initcap(t)).otherwise(general)


def clean_response(c: str | Column) -> Column:
    """F8: ``lower(trim(x))``."""
    return F.lower(strip(c))


def response_label(c: str | Column) -> Column:
    """title-case, then drop a leading ``<digits><space>`` prefix when text follows."""
    t = title_case(c)
    pattern = rf"^[0-9]+{WS_CLASS}+([^\n]+)$"
    return F.when(t.rlike(pattern), F.regexp_extract(t, pattern, 1)).otherwise(t)


def response_weight(c: str | Column) -> Column:
    """leading integer followed by whitespace, else 1 (NULL -> 1)."""
    digits = F.regexp_extract(strip(c), rf"^([0-9]+){WS_CLASS}+", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(1).cast("bigint"))


def client_contact_label(client: str | Column, contact: str | Column) -> Column:
    """``Client (Contact)``; NULL when either part is NULL (SQL CONCAT)."""
    return F.concat(col_of(client), F.lit(" ("), col_of(contact), F.lit(")"))


# ---------------------------------------------------------------- regions
# Region -> city list, matched in this order, case-insensitive substring;
# the first region with a hit wins, no hit -> 'Other', NULL -> 'Unknown'.
REGIONS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("North", ("Delhi", "New Delhi", "Gurugram", "Gurgaon", "Noida", "Faridabad", "Manesar", "Bawal")),
    ("South", ("Bangalore", "Chennai", "Hyderabad", "Visakhapatnam", "Kochi", "Mangalore",
               "Tirupati", "Chengalpattu")),
    ("East", ("Kolkata", "Jamshedpur", "Orrisa", "Odisha")),
    ("West", ("Mumbai", "Pune", "Ahmedabad", "Surat", "Aurangabad", "Silvassa", "Maharashtra",
              "Nagpur", "Kota", "Udaipur", "Wasim", "Vapi")),
)


def region_pattern(cities: Sequence[str]) -> str:
    return "|".join(city.lower() for city in cities)


def region_of(c: str | Column, regions=REGIONS) -> Column:
    """ordered case-insensitive substring match of a location to a region."""
    c = col_of(c)
    low = F.lower(strip(c))
    expr = None
    for name, cities in regions:
        cond = low.rlike(region_pattern(cities))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.when(c.isNull(), F.lit("Unknown")).otherwise(expr.otherwise(F.lit("Other")))


# ---------------------------------------------------------------- dates
# An optional time of day, with or without zone, up to the end of the (lowered) text; the date is the one that is written.
_CLOCK = (r"(?:[ t]+(?:[01]?[0-9]|2[0-3]):[0-5]?[0-9](?::[0-5]?[0-9](?:[.,][0-9]{1,9})?)?(?: ?[ap]m)?"
          r"(?: ?(?:z|utc|gmt|[+-][0-9]{2}:?[0-9]{2}))?)?$")
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_NAME = r"(?=(?:" + "|".join(_MONTHS) + "|sept|" + "|".join(m[:3] for m in _MONTHS) + r")[^a-z])([a-z]{3})[a-z]*"
_YEAR, _M, _D = "([0-9]{4}|[0-9]{2})", "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])"
#: Shapes of all-digit dates whose field order a column has to settle: separator and digits of the year, or eight digits.
DATE_SHAPES = {"/4": ("mdy", "dmy"), "-4": ("mdy", "dmy"), "/2": ("mdy", "dmy", "ymd"), "-2": ("mdy", "dmy", "ymd"), "8": ("ymd", "dmy", "mdy")}


def _digits(order: str, sep: str, year: str) -> tuple[str, str]:
    """Pattern of an all-digit date in a field order, and its rewriting as year-month-day."""
    field = {"y": f"({year})", "m": _M if sep else "(0[1-9]|1[0-2])", "d": _D if sep else "(0[1-9]|[12][0-9]|3[01])"}
    return "^" + sep.join(field[f] for f in order) + _CLOCK, "=" + "-".join(f"${order.index(f) + 1}" for f in "ymd")


def _date_rules(orders: Mapping[str, str] | None) -> list[tuple[str, str]]:
    """Patterns over a stripped, lowered text; what one has rewritten (it begins with =) no other matches."""
    rules = [(r"^([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})" + _CLOCK, "=$1-$3-$4")]
    if orders is None:  # month first, day first where that cannot be
        rules += [(rf"^{_M}([-/]){_D}\2{_YEAR}" + _CLOCK, "=$4-$1-$3"), (rf"^{_D}([-/]){_M}\2{_YEAR}" + _CLOCK, "=$4-$3-$1"),
                  _digits("ymd", "", "[0-9]{4}")]
    else:
        for shape, order in orders.items():
            rules.append(_digits(order, shape[0], "[0-9]{%s}" % shape[1]) if shape != "8" else _digits(order, "", "[0-9]{4}"))
    rules += [(rf"^([0-9]{{1,2}})(?:st|nd|rd|th)?[- ]{_NAME}[.,]?[- ]{_YEAR}" + _CLOCK, "=$3-$2-$1"),
              (rf"^{_NAME}[.]?[- ]([0-9]{{1,2}})(?:st|nd|rd|th)?,?[- ]{_YEAR}" + _CLOCK, "=$3-$1-$2"),
              ("^=(?=(?:[0-5][0-9]|6[0-8])-)", "=20"), ("^=(?=[0-9]{2}-)", "=19")]
    return rules


def parse_date(c: str | Column, orders: Mapping[str, str] | None = None) -> Column:
    """tolerant text -> date (unparseable -> NULL); month names in any case, a time of day is passed over.

    The text is rewritten to year-month-day by its shape, each step with one reference to the one before, and cast once:
    the expression stays small enough for generated code.  All-digit dates with the year last are month first where
    that can be, else day first; ``orders`` (shape of ``DATE_SHAPES`` -> order) settles them for a whole column.  Two-digit
    years are 1969 to 2068.
    """
    c = F.replace(F.lower(strip(c)), F.lit("="), F.lit("?"))  # a mark of what is rewritten, no part of any date
    for pattern, to in _date_rules(orders):
        c = F.regexp_replace(c, pattern, to)
    for n, name in enumerate(_MONTHS, 1):
        c = F.replace(c, F.lit(f"-{name[:3]}-"), F.lit(f"-{n}-"))
    return F.regexp_extract(c, "^=([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})$", 1).try_cast("date")


def date_orders(df: DataFrame, col: str) -> dict[str, str]:
    """The field order of each all-digit shape of a text column, voted by its values: the order that most of them can
    have (their ranges allow it), the first of ``DATE_SHAPES`` among equals.  One aggregation; three counts a shape come back."""
    t = F.lower(strip(col))
    triple = r"^([0-9]{1,2})([-/])([0-9]{1,2})\2([0-9]{4}|[0-9]{2})" + _CLOCK
    eight = "^[0-9]{8}" + _CLOCK
    x = df.select(t.alias("t")).filter(F.col("t").rlike(triple) | F.col("t").rlike(eight))
    whole = F.col("t").rlike(eight)
    parts = [F.regexp_extract("t", triple, k) for k in (1, 3, 4)]
    x = x.select(F.when(whole, "8").otherwise(F.concat(F.regexp_extract("t", triple, 2), F.length(parts[2]).cast("string"))).alias("shape"), "t", *[
        p.alias(n) for p, n in zip(parts, "abc")])

    def can(order):
        # the fields of a triple, or cut from eight digits with the year where the order has it
        at, places = 1, {}
        for k, f in enumerate(order):
            width = 4 if f == "y" else 2
            places[f] = F.when(F.col("shape") == "8", F.substring("t", at, width)).otherwise(F.col("abc"[k])).try_cast("int")
            at += width
        return F.count_if(places["m"].between(1, 12) & places["d"].between(1, 31)).alias(order)

    got = {r["shape"]: r for r in x.groupBy("shape").agg(*[can(o) for o in ("mdy", "dmy", "ymd")]).collect()}
    return {s: max(orders, key=lambda o: (got[s][o] if s in got else 0, -orders.index(o))) for s, orders in DATE_SHAPES.items()}


def with_inferred_dates(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """F7 as a column is read: per text column one vote on its all-digit shapes, then each value parsed once under it
    (a value that the voted order cannot read is NULL).  ``cols``: text column -> new date column."""
    return df.select("*", *[parse_date(c, date_orders(df, c)).alias(new) for c, new in cols.items()])


# ---------------------------------------------------------------- contact cards
def vcard_escape(c: str | Column) -> Column:
    """strip surrounding whitespace (as Python ``str.strip``), then escape backslash,
    comma, semicolon, newline (literal replacements)."""
    t = strip(c)
    for a, b in (("\\", "\\\\"), (",", "\\,"), (";", "\\;"), ("\n", "\\n")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.coalesce(t, F.lit(""))


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def vcard_card(name: str | Column, designation: str | Column, client: str | Column,
               phone: str | Column, email: str | Column) -> Column:
    """one vCard 3.0 text: FN/N from name (designation) + client, optional TEL / EMAIL."""
    name, designation, client, phone, email = map(col_of, (name, designation, client, phone, email))
    first = F.concat_ws(
        " ",
        F.when(_truthy(name), vcard_escape(name)),
        F.when(_truthy(designation), F.concat(F.lit("("), vcard_escape(designation), F.lit(")"))),
    )
    first = F.when(_truthy(name) | _truthy(designation), first).otherwise(F.lit("Unknown"))
    last = F.when(_truthy(client), vcard_escape(client)).otherwise(F.lit("Company"))
    tel = vcard_escape(phone)
    mail = vcard_escape(email)
    # The lines of the vCard 3.0 format.
    return F.concat_ws(
        "\n",
        F.lit("BEGIN:VCARD"),
        F.lit("VERSION:3.0"),
        F.concat(F.lit("FN:"), first, F.lit(" "), last),
        F.concat(F.lit("N:"), last, F.lit(";"), first, F.lit(";;;")),
        F.when(tel != F.lit(""), F.concat(F.lit("TEL;TYPE=WORK,VOICE:"), tel)),
        F.when(mail != F.lit(""), F.concat(F.lit("EMAIL;TYPE=WORK:"), mail)),
        F.lit("END:VCARD"),
    )
