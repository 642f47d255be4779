"""Column expressions: cleaning, typing, labels and buckets.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions``; they stay inside whole-stage codegen and work the
same on batch and streaming DataFrames.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalink import config as C

ColumnOrName = Column | str

# Blank characters stripped from both ends: exactly the characters Python's
# ``str.isspace`` accepts (generated by rule, in code-point order).
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_JAVA_SUFFIX = ("d", "D", "f", "F")
_NUMBER_START = tuple("0123456789+-.")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -------------------------------------------------------------------

def strip(c: ColumnOrName) -> Column:
    """Strip leading/trailing Unicode blanks (plain ``trim`` keeps U+00A0).

    A character-set trim, not a regex: it is on the hot path of every cleaner."""
    return F.btrim(_col(c), F.lit(BLANKS))


def normalize_whitespace(c: ColumnOrName) -> Column:
    """Non-breaking blank to a plain blank, then strip."""
    return strip(F.replace(_col(c), F.lit("\u00a0"), F.lit(" ")))


def missing_to_null(c: ColumnOrName, tokens: Sequence[str] = C.MISSING_TOKENS) -> Column:
    """Strip, then turn placeholder tokens into null."""
    s = strip(_col(c).cast("string"))
    return F.when(~s.isin(*tokens), s)


def nullable_double(c: ColumnOrName, tokens: Sequence[str] = C.MISSING_TOKENS) -> Column:
    """Missing tokens to null, then a safe double parse (one strip)."""
    return parse_double(missing_to_null(c, tokens))


def is_non_ascii(c: ColumnOrName) -> Column:
    return _col(c).rlike(r"[^\x00-\x7F]")


def truncate(c: ColumnOrName, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def percent_text(c: ColumnOrName, digits: int = 2) -> Column:
    """``12.34%`` style text."""
    return F.concat(F.bround(_col(c), digits).cast("string"), F.lit("%"))


def sorted_set_joined(c: ColumnOrName, sep: str = "|") -> Column:
    """Aggregate: sorted distinct non-null strings joined by ``sep``."""
    return F.array_join(F.array_sort(F.collect_set(_col(c).cast("string"))), sep)


# --- numbers ----------------------------------------------------------------

def parse_double_raw(s: Column) -> Column:
    """Stripped text to double with ``try_cast``, minus the Java-only float
    suffixes (``12d``, ``12f``) pandas rejects.  NaN is still possible.

    Only text starting like a number is cast: a failing ``try_cast`` costs an
    exception per row, which dominates on junk-heavy columns (``N/A``)."""
    numeric_start = F.substring(s, 1, 1).isin(*_NUMBER_START)
    return F.when(numeric_start & ~F.right(s, F.lit(1)).isin(*_JAVA_SUFFIX), s.try_cast("double"))


def nan_to_null(d: Column) -> Column:
    return F.nanvl(d, F.lit(None).cast("double"))


def parse_double(s: Column) -> Column:
    """Stripped text to double; NaN reads as null."""
    return nan_to_null(parse_double_raw(s))


def long_from_double(d: Column, s: Column) -> Column:
    """Integral double -> bigint (exact below 2**53); larger integral values
    take the exact string -> bigint cast.  Pass column references: ``d`` is
    used several times."""
    integral = d == F.floor(d)
    exact = F.abs(d) < F.lit(float(2 ** 53))
    inside = (d >= F.lit(-float(2 ** 63))) & (d < F.lit(float(2 ** 63)))
    # a text of digits keeps its exact value up to the type's bounds
    return (F.when(integral & exact, d.cast("bigint"))
             .when(integral, F.coalesce(s.try_cast("bigint"), F.when(inside & ~s.rlike(r"^[+-]?[0-9]+$"), d.cast("bigint")))))


def safe_double(c: ColumnOrName) -> Column:
    """Text to double; anything pandas would not parse becomes null."""
    return parse_double(strip(_col(c).cast("string")))


def parse_long(s: Column) -> Column:
    """Stripped text to bigint; non-integral or unparsable values become null.

    Parses as a double first (exact for integers below 2**53, and no failed
    cast per row: a failing ``try_cast`` costs an exception).  For large
    frames use ``typed_columns`` in ``operators.cleaning``, which stages the
    parse so each intermediate is computed once."""
    return long_from_double(parse_double(s), s)


def safe_long(c: ColumnOrName) -> Column:
    """Text to nullable bigint; non-integral or unparsable values become null."""
    return parse_long(strip(_col(c).cast("string")))


def nullable_long(c: ColumnOrName, tokens: Sequence[str] = C.MISSING_TOKENS) -> Column:
    """Missing tokens to null, then a safe bigint cast (one strip)."""
    return parse_long(missing_to_null(c, tokens))


def cents_to_price(c: ColumnOrName) -> Column:
    """Integer cents text to currency with two decimals (half to even)."""
    cents = parse_double(missing_to_null(c, C.PRICE_MISSING_TOKENS))
    return F.bround(cents / F.lit(100.0), 2)


def owners_bounds(c: ColumnOrName) -> Column:
    """``'1,000 .. 2,000'`` to struct<low, high, mid>; unparsable parts are 0."""
    parts = F.split(F.replace(_col(c), F.lit(","), F.lit("")), r"\.\.")
    # parse as a number, fill 0, truncate to an integer
    low = F.coalesce(safe_double(F.get(parts, 0)).try_cast("bigint"), F.lit(0).cast("bigint"))
    high = F.coalesce(safe_double(F.get(parts, 1)).try_cast("bigint"), F.lit(0).cast("bigint"))
    mid = F.floor((low + high) / F.lit(2)).cast("bigint")
    return F.struct(low.alias("low"), high.alias("high"), mid.alias("mid"))


def replace_value(c: ColumnOrName, old, new) -> Column:
    c = _col(c)
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def cap(c: ColumnOrName, upper) -> Column:
    c = _col(c)
    return F.when(c.isNull(), c).otherwise(F.least(c, F.lit(upper)))


def safe_log10(c: ColumnOrName) -> Column:
    """log10 that is null (not -inf, not an error) for values <= 0."""
    c = _col(c)
    return F.when(c > 0, F.log10(c))


# --- price and labels -------------------------------------------------------

def fill_free_price(price: ColumnOrName, is_free: ColumnOrName) -> Column:
    """Free titles with no price cost 0; everything else keeps its price."""
    price, is_free = _col(price), _col(is_free)
    return F.when((is_free == 1) & price.isNull(), F.lit(0.0)).otherwise(price.cast("double"))


def monetization_label(is_free: ColumnOrName, price_unknown: ColumnOrName) -> Column:
    is_free, price_unknown = _col(is_free), _col(price_unknown)
    return (F.when(F.coalesce(is_free == 1, F.lit(False)), "Free to Play")
             .when(F.coalesce(price_unknown, F.lit(False)), "Price Unknown")
             .otherwise("Paid"))


def code_label(c: ColumnOrName, mapping: dict) -> Column:
    """Map a few codes to labels; others become null."""
    c = _col(c)
    out = None
    for code, label in mapping.items():
        out = (F.when(c == F.lit(code), F.lit(label)) if out is None
               else out.when(c == F.lit(code), F.lit(label)))
    return out


def quadrant(player_ratio: ColumnOrName, critic: ColumnOrName,
             player_threshold: float, critic_threshold: float) -> Column:
    """Four-way label; a null side counts as 'not loved'."""
    p_ok = F.coalesce(_col(player_ratio) >= F.lit(player_threshold), F.lit(False))
    c_ok = F.coalesce(_col(critic) >= F.lit(critic_threshold), F.lit(False))
    return (F.when(p_ok & c_ok, C.QUADRANTS[0])
             .when(p_ok, C.QUADRANTS[1])
             .when(c_ok, C.QUADRANTS[2])
             .otherwise(C.QUADRANTS[3]))


def score_bucket(score: ColumnOrName) -> Column:
    s = _col(score)
    out = None
    for floor_, label in C.SCORE_BUCKETS:
        out = F.when(s >= floor_, label) if out is None else out.when(s >= floor_, label)
    return out.when(s.isNotNull(), C.SCORE_BUCKET_FLOOR)


def right_closed_label(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
                       include_lowest: bool = True, open_top: bool = False) -> Column:
    """Bins (e0,e1] (e1,e2] ...; with ``open_top`` the last label is (e_last, inf].

    Values outside the edges are null, as with pandas ``cut``.
    """
    x = _col(c)
    low = x >= edges[0] if include_lowest else x > edges[0]
    out = None
    uppers = list(edges[1:])
    for i, label in enumerate(labels):
        if i < len(uppers):
            cond = low & (x <= F.lit(uppers[i]))
        else:  # open top bin
            cond = x > F.lit(edges[-1])
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def left_closed_label(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins [e0,e1) [e1,e2) ... [e_last, inf]; below e0 is null."""
    x = _col(c)
    out = None
    for i, label in enumerate(labels):
        cond = x >= F.lit(edges[i])
        if i + 1 < len(edges):
            cond = cond & (x < F.lit(edges[i + 1]))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def critic_label(c: ColumnOrName) -> Column:
    return right_closed_label(c, C.CRITIC_EDGES, C.CRITIC_LABELS, include_lowest=True)


def price_bucket(c: ColumnOrName) -> Column:
    return right_closed_label(c, C.PRICE_EDGES, C.PRICE_LABELS, include_lowest=False,
                              open_top=True)


def volume_bucket(c: ColumnOrName, edges: Sequence[float] = C.VOLUME_EDGES,
                  labels: Sequence[str] = C.VOLUME_LABELS) -> Column:
    return left_closed_label(c, edges, labels)


def label_rank(c: ColumnOrName, labels: Sequence[str]) -> Column:
    """1-based position of a label in an ordered list, null if absent."""
    r = F.array_position(F.array(*[F.lit(v) for v in labels]), _col(c))
    return F.when(r > 0, r.cast("int"))


def width_bin(c: ColumnOrName, lo: float, hi: float, width: float) -> Column:
    """Right-closed fixed-width bin ordinal 1..k over [lo, hi], first bin includes lo."""
    x = _col(c)
    k = int(round((hi - lo) / width))
    return F.when((x >= lo) & (x <= hi),
                  F.least(F.greatest(F.ceil((x - F.lit(lo)) / F.lit(width)), F.lit(1)),
                          F.lit(k)).cast("int"))


def presented(c: ColumnOrName, digits: int = 1) -> Column:
    """Rounded for reading to ``digits`` decimals, halves to the even digit; whole numbers
    (bigint) for 0 digits."""
    x = F.rint(_col(c) * F.lit(10.0 ** digits))
    return x.cast("bigint") if digits == 0 else x / F.lit(10.0 ** digits)


# --- matching predicates ----------------------------------------------------

def keyword_regex(keywords: Iterable[str]) -> str:
    """Case-insensitive whole-word alternation with escaped keywords."""
    return r"(?i)\b(" + "|".join(re.escape(k) for k in keywords) + r")\b"


def keyword_on_one_side(a: ColumnOrName, b: ColumnOrName,
                        keywords: Iterable[str] = C.RISK_KEYWORDS) -> Column:
    """True when the whole-word keyword pattern matches exactly one of two titles."""
    pat = keyword_regex(keywords)
    ha = F.coalesce(_col(a).rlike(pat), F.lit(False))
    hb = F.coalesce(_col(b).rlike(pat), F.lit(False))
    return ha != hb


def edition_mismatch(a: ColumnOrName, b: ColumnOrName,
                     keywords: Iterable[str] = C.VERSION_KEYWORDS) -> Column:
    """True when any keyword is a substring of one lower-cased title only."""
    la = F.lower(F.coalesce(_col(a), F.lit("")))
    lb = F.lower(F.coalesce(_col(b), F.lit("")))
    out = F.lit(False)
    for kw in keywords:
        out = out | (la.contains(kw) != lb.contains(kw))
    return out


def length_gap(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.abs(F.length(_col(a)) - F.length(_col(b))).cast("bigint")
