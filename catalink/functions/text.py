"""Text functions for title matching, all as column expressions (JVM side).

``token_sort_ratio`` needs the length of a longest common subsequence.  It is a bit-parallel
fold: one text's characters are bits of 62-bit words (a sum of two words and a carry stays a
positive bigint), the other text's characters are folded over them.  It is only ever applied
to the N top-1 rows, not to the N x M candidate pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalink.functions.expressions import BLANKS

_BLANKS = r"[\s\p{Z}]+"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Blank-separated words of a text (no empty tokens)."""
    trimmed = F.btrim(_col(c), F.lit(BLANKS))
    return F.filter(F.split(trimmed, _BLANKS), lambda w: F.length(w) > 0)


def char_wb_ngrams(c, n_min: int = 3, n_max: int = 5) -> Column:
    """Word-bounded character n-grams of a lower-cased text.

    Each word is padded with one blank on both sides; every n from ``n_min``
    up to the padded length (at most ``n_max``) contributes all its windows,
    so a padded word shorter than ``n_max`` also yields itself once.
    """
    padded = F.transform(words(F.lower(_col(c))), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))  # once a word, not once a gram

    def grams_of_word(p):
        plen = F.length(p)
        top = F.least(plen, F.lit(n_max))
        ns = F.sequence(F.lit(n_min), F.greatest(top, F.lit(n_min)))
        return F.flatten(F.transform(
            ns, lambda n: F.transform(F.sequence(F.lit(1), plen - n + 1),
                                      lambda i: F.substring(p, i, n))))

    return F.flatten(F.transform(padded, grams_of_word))


def counted(values) -> Column:
    """An array's distinct values with their counts, as structs (gram, tf)."""
    def runs(s: Column, begins: Column) -> Column:
        end = lambda i: F.coalesce(F.get(begins, i + 1), F.size(s))
        return F.transform(begins, lambda b, i: F.struct(F.get(s, b).alias("gram"), (end(i) - b).cast("bigint").alias("tf")))

    def of(g: Column) -> Column:
        once = F.transform(F.array_distinct(g), lambda x: F.struct(x.alias("gram"), F.lit(1).cast("bigint").alias("tf")))
        begins = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return (F.when(F.size(F.array_distinct(g)) == F.size(g), once)
                 .otherwise(_let(F.sort_array(g), lambda s: _let(begins(s), lambda b: runs(s, b)))))

    return _let(_col(values), of)


def token_sort_key(c) -> Column:
    """Tokens sorted by code point and re-joined with one blank."""
    return F.array_join(F.array_sort(words(_col(c))), " ")


# --- longest common subsequence -------------------------------------------------

#: Bits of a word.
WORD = 62
_FULL = (1 << WORD) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once (an expression named inside a lambda is
    computed at each of its calls)."""
    return F.get(F.transform(F.array(value), body), 0)


def _characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda ch: F.length(ch) > 0)


def _bits(chars: Column, ch: Column) -> Column:
    """The places of a character among at most ``WORD``, the first in the lowest bit."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    return F.aggregate(F.reverse(chars), zero, lambda m, x: m * 2 + F.when(x == ch, one).otherwise(zero))


def _places(chars: Column, of: Callable[[Column], Column]) -> Column:
    return F.map_from_entries(F.transform(F.array_distinct(chars), lambda ch: F.struct(ch, of(ch))))


def _word_step(v: Column, m: Column, carry: Column) -> tuple[Column, Column]:
    """A word after one character, ``(v + (v & m)) | (v & ~m)``, and the carry out of it."""
    total = v + v.bitwiseAND(m) + carry
    return (total.bitwiseAND(F.lit(_FULL)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))), F.shiftright(total, WORD))


def _advance(words_: Column, places: Column) -> Column:
    """All words after one character, the carry handed from each to the next."""
    zero = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("done"))

    def one(state: Column, w: Column) -> Column:
        new, carry = _word_step(w.getField("v"), w.getField("m"), state.getField("carry"))
        return F.struct(carry.alias("carry"), F.concat(state.getField("done"), F.array(new)).alias("done"))

    pairs = F.zip_with(words_, places, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
    return F.aggregate(pairs, zero, one, lambda state: state.getField("done"))


def _fold(chars: Column, places: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """``step`` for each character that the other text has as well."""
    found = F.filter(F.transform(chars, lambda ch: F.try_element_at(places, ch)), lambda m: m.isNotNull())
    return F.aggregate(found, start, step)


def _lcs_one_word(short: Column, long: Column) -> Column:
    places = _places(short, lambda ch: _bits(short, ch))
    no_carry = F.lit(0).cast("bigint")
    return _let(places, lambda found: WORD - F.bit_count(
        _fold(_characters(long), found, F.lit(_FULL), lambda v, m: _word_step(v, m, no_carry)[0])).cast("bigint"))


def _lcs_words(short: Column, long: Column) -> Column:
    begins = F.sequence(F.lit(1), F.size(short), F.lit(WORD))
    places = _places(short, lambda ch: F.transform(begins, lambda begin: _bits(F.slice(short, begin, WORD), ch)))
    start = F.array_repeat(F.lit(_FULL), F.ceil(F.size(short) / WORD).cast("int"))
    last = _let(places, lambda found: _fold(_characters(long), found, start, _advance))
    return F.aggregate(last, F.lit(0).cast("bigint"), lambda n, w: n + WORD - F.bit_count(w))


def lcs_length(a, b) -> Column:
    """Length of the longest common subsequence of two texts, in characters; any lengths (the
    shorter text gives the words; one word is folded without arrays)."""
    a, b = _col(a), _col(b)
    swap = F.length(a) > F.length(b)
    short, long = F.when(swap, b).otherwise(a), F.when(swap, a).otherwise(b)
    n = F.length(short)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("bigint")).when(n == 0, F.lit(0).cast("bigint"))
             .when(n <= WORD, _let(_characters(short), lambda chars: _lcs_one_word(chars, long)))
             .otherwise(_let(_characters(short), lambda chars: _lcs_words(chars, long))))


def indel_ratio(a, b) -> Column:
    """0-100 similarity ``200 * LCS / (len a + len b)``; both empty gives 100, a null gives null."""
    return _let(F.struct(_col(a).alias("a"), _col(b).alias("b")), lambda t: _ratio(t.getField("a"), t.getField("b")))


def _ratio(a: Column, b: Column) -> Column:
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * lcs_length(a, b) / total)


def token_sort_ratio(a, b, casefold: bool = False) -> Column:
    """Token-sort ratio: sort blank-separated tokens on both sides, then the
    indel ratio of the re-joined strings.  Case-sensitive by default."""
    a, b = _col(a), _col(b)
    if casefold:
        a, b = F.lower(a), F.lower(b)
    return indel_ratio(token_sort_key(a), token_sort_key(b))
