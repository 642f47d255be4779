"""Table cleaners: the long (id, value) pipeline and the wide pipeline.

Long: normalise blanks -> map variants -> keep vocabulary values -> distinct
pairs -> sort.  Wide: keep / drop columns -> placeholder tokens to null ->
typed casts (unparsable becomes null) -> optional null-key drop -> first row
per key -> sort.  Column lists are checked against the frame at plan-build
time, so absent columns are skipped rather than failing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink import config as C
from catalink.functions.expressions import (
    long_from_double,
    nan_to_null,
    normalize_whitespace,
    parse_double_raw,
    strip,
)
from catalink.operators.dedupe import distinct_pairs, keep_first
from catalink.operators.ranking import sort_rows
from catalink.operators.vocab import apply_mapping, vocab_filter


def clean_long(df: DataFrame, key: str, value: str, mapping: DataFrame | None,
               vocab: DataFrame | None) -> DataFrame:
    """Long-table pipeline; ``vocab=None`` keeps every observed value."""
    out = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()) \
            .withColumn(value, normalize_whitespace(value))
    if mapping is not None:
        out = apply_mapping(out, value, mapping)
    out = vocab_filter(out, value, vocab)
    return sort_rows(distinct_pairs(out, [key, value]), [(key, False), (value, False)])


def typed_columns(df: DataFrame, longs: Sequence[str] = (), doubles: Sequence[str] = (),
                  prices: Sequence[str] = (), tokens: Sequence[str] = C.MISSING_TOKENS,
                  price_tokens: Sequence[str] = C.PRICE_MISSING_TOKENS) -> DataFrame:
    """Strip every text column, placeholder tokens to null, parse numbers.

    Staged projections (strip -> tokens -> double -> integer): each stage
    refers to the previous one by column, so every intermediate is computed
    once per value instead of being re-expanded inside each ``CASE`` branch.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    stripped = df.withColumns({c: strip(c) for c in texts})
    nulled = stripped.withColumns({
        c: F.when(~F.col(c).isin(*(price_tokens if c in prices else tokens)), F.col(c))
        for c in texts})
    numeric = [c for c in (*longs, *doubles, *prices) if c in df.columns]
    parsed = nulled.withColumns({f"_d_{c}": parse_double_raw(F.col(c).cast("string")) for c in numeric})
    out = parsed.withColumns({
        **{c: long_from_double(nan_to_null(F.col(f"_d_{c}")), F.col(c).cast("string"))
           for c in longs if c in df.columns},
        **{c: nan_to_null(F.col(f"_d_{c}")) for c in doubles if c in df.columns},
        **{c: F.bround(nan_to_null(F.col(f"_d_{c}")) / F.lit(100.0), 2) for c in prices if c in df.columns},
    })
    return out.drop(*[f"_d_{c}" for c in numeric])


def clean_wide(df: DataFrame, key: str, keep: Sequence[str] | None = None,
               drop: Sequence[str] = (), longs: Sequence[str] = (), doubles: Sequence[str] = (),
               prices: Sequence[str] = (), order: Sequence[str] | None = None,
               drop_null_key: bool = True, tokens: Sequence[str] = C.MISSING_TOKENS,
               sort: bool = True) -> DataFrame:
    """Wide-table pipeline (present columns only).

    ``order`` gives the keep-first order (e.g. ``_seq`` from the scan);
    default is the rest of the row, which is deterministic but not file order.
    """
    cols = [c for c in (keep or df.columns) if c in df.columns and c not in drop]
    typed = typed_columns(df.select(*cols), longs, doubles, prices, tokens)
    order = list(order or [c for c in cols if c not in (key, "_seq")])
    first = keep_first(typed, [key], order, drop_null_key=drop_null_key)
    if "_seq" in first.columns:
        first = first.drop("_seq")
    return sort_rows(first, [(key, False)]) if sort else first


def clean_reviews(raw: DataFrame, key: str = "app_id",
                  drop: Sequence[str] = C.REVIEW_DROP_COLUMNS,
                  numeric: Sequence[str] = C.REVIEW_NUMERIC_COLUMNS,
                  order: Sequence[str] | None = None) -> DataFrame:
    """Review cleaner: drop low-value columns, tokens to null everywhere,
    numeric columns to nullable bigint, one row per key (a null key is kept
    once, as in the source's defensive dedupe)."""
    return clean_wide(raw, key, drop=drop, longs=numeric, order=order, drop_null_key=False)
