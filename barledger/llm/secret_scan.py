"""Secret scans by a trigram inverted index, with DataFrame functions only.

Each rule's regular expression is read for strings of which a match must contain one; their trigrams make a Boolean
query. The index is a table by trigram: for each trigram that some rule asks for, ordered lists of the documents that have
it, one list for each block of documents. A rule's candidates are what intersecting and uniting these lists leaves, and
only they are searched with its expression. A rule without a mandatory trigram searches every document.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as codes
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barledger.llm.shared import join_small, stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern` whose group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int


#: Fixed kinds and patterns, in the order in which they are reported.
RULES = (
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
        r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Strings that a part of an expression may be expanded to; beyond, the part is taken for a gap.
EXPANSIONS = 64
#: Documents of a block of the index, about.
BLOCK_DOCS = 4096
REPLACEMENT = "[redacted]"

Factors = list[list[frozenset[str]]]


def class_letters(items) -> set[str] | None:
    """The characters of a class in lower case, None if they are many or not listed."""
    out: set[str] = set()
    for op, value in items:
        if op is codes.LITERAL:
            out.add(chr(value).lower())
        elif op is codes.RANGE and value[1] - value[0] < EXPANSIONS:
            out.update(chr(x).lower() for x in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= 3 else None


def strings_of(item) -> set[str] | None:
    """All strings that one item of a parsed expression matches, in lower case; None for a gap."""
    op, value = item
    if op is codes.LITERAL:
        return {chr(value).lower()}
    if op is codes.IN:
        return class_letters(value)
    if op is codes.SUBPATTERN:
        return strings_of_all(value[-1])
    if op is codes.BRANCH:
        parts = [strings_of_all(x) for x in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is codes.MAX_REPEAT and value[1] == 1:
        inner = strings_of_all(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def strings_of_all(items) -> set[str] | None:
    out = {""}
    for item in items:
        part = strings_of(item)
        if part is None or len(out) * len(part) > EXPANSIONS:
            return None
        out = {a + b for a, b in itertools.product(out, part)}
    return out


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> Factors:
    """Of each factor one alternative must hold, of an alternative all trigrams; no factors: nothing is mandatory."""
    factors, held = [], {""}

    def close(strings: set[str]) -> None:
        if strings and min(map(len, strings)) >= 3:
            factors.append(sorted({trigrams(s) for s in strings}, key=sorted))

    for item in parser.parse(pattern):
        part = strings_of(item)
        if part is not None and len(held) * len(part) <= EXPANSIONS:
            held = {a + b for a, b in itertools.product(held, part)}
            continue
        close(held)
        held = part if part is not None and len(part) <= EXPANSIONS else {""}
    close(held)
    # an alternative with more trigrams than another one holds only if that one does
    return [[a for a in factor if not any(b < a for b in factor)] for factor in factors]


def postings(docs: DataFrame, wanted: list[str], blocks: int) -> DataFrame:
    """trigram, block, docs: for each wanted trigram (of lower-cased texts) the ordered documents of a block that contain it.

    A block holds about BLOCK_DOCS documents by a hash of their names, so a list is bounded however common its trigram is.
    """
    low = docs.select("doc", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)))
    single = low.select("doc", F.explode(found).alias("trigram")).distinct()
    return single.groupBy("trigram", F.pmod(F.xxhash64("doc"), F.lit(blocks)).alias("block")).agg(
        F.array_sort(F.collect_list("doc")).alias("docs")
    )


def candidates(index: DataFrame, queries: dict[str, Factors]) -> DataFrame:
    """doc and, for each rule, whether its Boolean query over the postings holds for the document.

    The lists of a block meet in one row. Lists of an alternative's trigrams are intersected, those of the alternatives
    of a factor united, and those of the factors intersected.
    """
    lists = F.map_from_entries(F.collect_list(F.struct("trigram", "docs"))).alias("lists")
    block = index.groupBy("block").agg(lists)
    none = F.array().cast("array<string>")

    def folded(parts: list[Column], join) -> Column:
        out = parts[0]
        for part in parts[1:]:
            out = join(out, part)
        return out

    def documents(factors: Factors) -> Column:
        listed = lambda t: F.coalesce(F.try_element_at("lists", F.lit(t)), none)
        return folded(
            [folded([folded([listed(t) for t in sorted(alt)], F.array_intersect) for alt in f], F.array_union) for f in factors],
            F.array_intersect,
        )

    def named(kind: str) -> Column:
        return F.transform(kind, lambda d: F.struct(d.alias("doc"), F.lit(kind).alias("kind")))

    found = block.select(*(documents(factors).alias(kind) for kind, factors in queries.items()))
    rows = found.select(F.explode(F.flatten(F.array(*map(named, queries)))).alias("one")).select("one.*")
    return rows.groupBy("doc").agg(*(F.max(F.col("kind") == kind).alias(kind) for kind in queries))


def spans_of(rule: Rule, number: int, text: Column) -> Column:
    """Spans (start, order, stop) of the rule's leftmost matches; the text between them gives their places."""
    pattern = F.lit(rule.pattern)
    matches, values = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), values.alias("value")
    )
    empty = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        stop = start + F.char_length(part["match"])
        one = F.struct(start.alias("start"), F.lit(number).alias("kind"), stop.alias("stop"))
        found = F.when(F.char_length(part["value"]) >= rule.least, F.concat(state["found"], F.array(one)))
        return F.struct(stop.alias("at"), found.otherwise(state["found"]).alias("found"))

    whole = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda s: s["found"])
    return F.when(F.regexp_like(text, F.lit(quick(rule))), whole).otherwise(empty)


def quick(rule: Rule) -> str:
    """An expression that every text with a long enough match has a match of; it spares other texts the spans."""
    return rule.pattern[:-1] + f"{{{rule.least},}}" if rule.pattern == r"[0-9a-f]+" else rule.pattern


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES,
    others: Column | None = None,
) -> DataFrame:
    """doc_id, text, spans array<struct<start, kind, stop>>, and `others` if given: a row for each row of docs.

    Places are code points, ends exclusive, kinds indices of rules; spans are in order of start and kind. Null texts are
    scanned as empty and come back null; repeated rows are scanned one by one; other columns are not read. An empty
    table gives no rows.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: factors for kind, factors in queries.items() if factors}
    others = F.lit(None).cast("int") if others is None else others
    # ids as text, null told apart, so that a join finds null ids too
    doc = F.when(F.col(id_col).isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), F.col(id_col).cast("string")))
    picked = docs.select(doc.alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), others.alias("others"))
    joined = picked
    if indexed:
        wanted = sorted({t for factors in indexed.values() for factor in factors for alt in factor for t in alt})
        blocks = 1 + docs.count() // BLOCK_DOCS
        index = postings(picked.select("doc", "text"), wanted, blocks).repartitionByRange("trigram", "block")
        found = stored(candidates(stored(index.sortWithinPartitions("trigram", "block"), "postings"), indexed), "candidates")
        joined = join_small(picked, found, ["doc"], "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    by_rule = []
    for number, rule in enumerate(rules):
        spans = spans_of(rule, number, text)
        by_rule.append(F.when(F.col(rule.kind), spans).otherwise(none) if rule.kind in indexed else spans)
    return joined.select("doc_id", "text", F.array_sort(F.concat(*by_rule)).alias("spans"), "others")


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digests of scan()."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    joined = F.array_join(
        F.transform(
            "spans",
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{r.kind}") for n, r in enumerate(rules)
    ]
    return scanned.select("doc_id", *counts, F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """text with each span, or run of overlapping spans, replaced."""

    def step(state: Column, span: Column) -> Column:
        fresh = F.concat(
            state["done"], F.substring(text, state["at"] + 1, span["start"] - state["at"]), F.lit(REPLACEMENT)
        )
        return F.struct(
            F.when(span["start"] >= state["at"], fresh).otherwise(state["done"]).alias("done"),
            F.greatest(state["at"], span["stop"]).alias("at"),
        )

    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    cut = F.aggregate(spans, start, step, lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cut).otherwise(text)
