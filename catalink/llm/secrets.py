"""Secret scans: a trigram index finds the texts that a rule can match.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives
are joined by OR, the literals of an alternative by AND.  The index holds, for each trigram
that some query asks for, the rows whose lower-cased text has it (postings).  For each
alternative the postings are intersected by a count per row; the rows left are the
candidates, on which the regular expression is run.  A rule one of whose alternatives has no
trigram (such as a run of hex digits) scans every row.  Everything is DataFrame expressions.

Spans are in code points, end exclusive; leftmost and non-overlapping within a rule.

Defined results: null texts are empty and have no spans; postings meet by the hash of a
row, so repeated rows share candidates and each gets its spans (a collision would only add
a candidate); columns other than the result's are kept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.llm.common import row_key

MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs in Java; ``group`` must have ``least`` characters or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


#: The kinds, patterns and lengths that the base scan asks for.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),  # the runs of at least 16; shorter runs would be dropped
)
#: Forms of keys that their issuers publish.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def _alternatives(parsed) -> list[tuple]:
    """Literal strings that a parsed expression requires, by alternative; None breaks a string.
    A step that would give more than ``MOST_ALTERNATIVES`` counts as a break."""
    out: list[tuple] = [()]
    for op, arg in parsed:
        if op is sre.LITERAL:
            step = [(chr(arg).lower(),)]
        elif op is sre.IN and all(k is sre.LITERAL for k, _ in arg):
            step = [(c,) for c in sorted({chr(v).lower() for _, v in arg})]
        elif op is sre.SUBPATTERN:
            step = _alternatives(arg[3])
        elif op is sre.BRANCH:
            step = [a for branch in arg[1] for a in _alternatives(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, item = arg
            if (least, most) == (0, 1):
                step = [(), *_alternatives(item)]
            else:
                step = [(*a, None) for a in _alternatives(item)] if least else [(None,)]
        else:
            step = [(None,)]
        more = dict.fromkeys(a + b for a in out for b in step)
        if len(more) > MOST_ALTERNATIVES:  # what is required so far stays required
            more = dict.fromkeys((*a, None) for a in out)
        out = list(more)
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The query as alternatives of trigrams that all must occur; None where an alternative
    has no trigram."""
    query = set()
    for alternative in _alternatives(_parser.parse(pattern)):
        strings = "".join("\0" if x is None else x for x in alternative).split("\0")
        grams = frozenset(s[i: i + 3] for s in strings for i in range(len(s) - 2))
        if not grams:
            return None
        query.add(grams)
    return sorted((q for q in query if not any(o < q for o in query)), key=sorted)


def postings(df: DataFrame, text: str, trigrams: Sequence[str]) -> DataFrame:
    """The index: ``trigram``, ``_key`` of the rows whose lower-cased text has it."""
    low = df.select("_key", F.lower(F.col(text)).alias("_low"))
    has = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("_key", F.explode(has).alias("trigram"))


def candidates(df: DataFrame, text: str, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """``_key`` and ``_rules`` (a bit for each rule that the row is a candidate of)."""
    rows = [(rule, branch, t, bit, len(grams)) for rule, query in queries.items()
            for branch, grams in enumerate(query) for bit, t in enumerate(sorted(grams))]
    asked = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(b).alias("branch"), F.lit(t).alias("trigram"),
                 F.lit(1 << bit).cast("long").alias("bit"), F.lit((1 << need) - 1).cast("long").alias("need"))
        for r, b, t, bit, need in rows])))
    index = postings(df, text, sorted({r[2] for r in rows}))
    met = (index.join(F.broadcast(asked), "trigram")  # as many rows as the rules have trigrams
           .groupBy("_key", "rule", "branch", "need").agg(F.bit_or("bit").alias("met"))
           .where("met = need"))
    return met.groupBy("_key").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("rule"))).alias("_rules"))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans (start, end, rule number) of a rule in a text.  Splitting at the pattern gives
    the gaps before the matches; their lengths add up to the positions."""
    whole = F.regexp_extract_all(text, F.lit(rule.java), 0)
    part = F.regexp_extract_all(text, F.lit(rule.java), rule.group) if rule.group else whole
    found = F.arrays_zip(F.split(text, rule.java, -1).alias("gap"), whole.alias("whole"), part.alias("part"))
    found = F.filter(found, lambda x: x["whole"].isNotNull())
    none = F.array().cast("array<struct<start:bigint,end:bigint,rule:int>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.struct(start.alias("start"), end.alias("end"), F.lit(number).alias("rule"))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= rule.least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(found, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), add, lambda a: a["out"])


def scan(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """All rows with ``secrets``: spans (start, end, rule number) by start, then rule.
    ``key``: columns that, with the text, tell rows apart."""
    keep = [c for c in df.columns if c not in ("secrets", "_key", "_rules")]
    rows = df.select(*keep, row_key(*dict.fromkeys([*key, text])).alias("_key"))
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,end:bigint,rule:int>>")
    if queries:
        rows = rows.join(candidates(rows, text, queries), "_key", "left")
    else:
        rows = rows.withColumn("_rules", F.lit(0).cast("long"))
    spans = []
    for i, rule in enumerate(rules):
        found = rule_spans(body, rule, i)
        if i in queries:
            found = F.when(F.coalesce("_rules", F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0, found).otherwise(none)
        spans.append(found)
    return rows.select(*keep, F.array_sort(F.concat(*spans)).alias("secrets"))


def span_text(spans: Column, rules: Sequence[Rule] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] < acc["at"], F.lit("")).otherwise(
            F.concat(F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    return F.aggregate(spans, start, add, lambda a: F.concat(a["out"], F.substr(text, (a["at"] + 1).cast("int"))))
