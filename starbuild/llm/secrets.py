"""Secret scans by a trigram index.

Each rule is a regular expression. From its parse tree comes a Boolean query over trigrams of the lower-cased text that
every match meets: any of the alternatives, all trigrams of each. The index lists, for each trigram that
some query names, the documents that hold it; the postings are intersected for each alternative, and only the
candidates are searched with the expression. A rule without a literal of three characters has no mandatory trigram
and scans all texts.

Matches are leftmost and non-overlapping for each rule; those that fail its length rule are dropped afterwards, so they
still consume what they matched. Spans are in code points, end exclusive.

Defined results: null and empty texts have no spans (hash of the empty string, empty list). Rows of one doc_id are scanned
each on its own. Null ids and repeated rows are kept; extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import let

# The base patterns and lengths of the contract, then well-known public key formats.
KEYWORD = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)


#: A class of so many letters is spelled out; a larger one may be anything.
LETTERS = 8
#: Strings a part of a pattern, and alternatives a query, may have.
ALTERNATIVES = 64


def _letters(members: Iterable) -> set[str] | None:
    """The lower-cased characters of a class, None if it has too many or names them by category."""
    found: set[str] = set()
    for kind, value in members:
        name = str(kind)
        if name == "LITERAL":
            found.add(chr(value).lower())
        elif name == "RANGE" and value[1] - value[0] < 2 * LETTERS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= LETTERS else None


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    """The strings that a sequence of parts stands for, None if one of them may be anything or there are too many."""
    out = {""}
    for part in parts:
        if part is None or len(out) * len(part) > ALTERNATIVES:
            return None
        out = {a + b for a in out for b in part}
    return out


def _parts(tree: Iterable) -> list[set[str] | None]:
    """What must follow one another in a match: sets of strings of which one is there, None for anything or nothing."""
    out: list[set[str] | None] = []
    for kind, value in tree:
        name = str(kind)
        if name == "LITERAL":
            out.append({chr(value).lower()})
        elif name == "IN":
            out.append(_letters(value))
        elif name == "SUBPATTERN":
            out += _parts(value[-1])
        elif name == "BRANCH":
            each = [_joined(_parts(way)) for way in value[1]]
            out.append(None if None in each else set().union(*each))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = value
            once = _joined(_parts(inner))
            if once is not None and (low, high) == (0, 1):
                out.append(once | {""})
            else:
                # a part that comes several times is known to come once, and something may follow
                out += _parts(inner) if low else []
                out += [] if (low, high) == (1, 1) else [None]
        elif name != "AT":
            out.append(None)
    return out


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


@lru_cache(maxsize=None)
def trigram_query(pattern: str) -> tuple[frozenset[str], ...]:
    """Alternatives, each a set of trigrams: every match of `pattern`, in lower case, has all trigrams of one of them.

    Empty if some match needs no trigram. A run of fixed parts must be in a match as one of its strings; the runs of a pattern are
    required together, those with fewest strings first, as long as the alternatives are few.
    """
    runs: list[set[str]] = [{""}]
    for part in [*_parts(re._parser.parse(pattern)), None]:
        longer = None if part is None else _joined([runs[-1], part])
        if longer is not None:
            runs[-1] = longer
        else:
            runs.append({""} if part is None else part)
    needs = [{trigrams(x) for x in run} for run in runs]
    query: set[frozenset[str]] = {frozenset()}
    for need in sorted((n for n in needs if all(n)), key=len):
        if len(query) * len(need) <= ALTERNATIVES:
            query = {a | b for a, b in product(query, need)}
    # an alternative that asks for more than another one adds nothing
    query = {q for q in query if not any(other < q for other in query)}
    return tuple(sorted(query, key=sorted)) if all(query) else ()


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: This group of the pattern must have so many characters.
    group: int = 0
    least: int = 0
    base: bool = True

    def branches(self) -> list[list[str]]:
        """For each alternative the trigrams that a match of it holds; none if nothing is mandatory."""
        return [sorted(x) for x in trigram_query(self.pattern)]


RULES = (
    Rule("assign", rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]{32,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("google", "AIza[A-Za-z0-9_-]{35}", base=False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", base=False),
)


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """trigram, row_key: the texts that hold each trigram some rule asks for."""
    wanted = sorted({t for rule in rules for branch in rule.branches() for t in branch})
    held = let(
        F.lower("text"),
        lambda text: F.array_compact(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in wanted])),
    )
    return docs.select("row_key", F.explode_outer(held).alias("trigram")).where("trigram is not null")


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """row_key, and for each rule with mandatory trigrams whether its postings intersect there."""
    asked = [(rule.kind, i, t) for rule in rules for i, b in enumerate(rule.branches()) for t in b]
    need = {(rule.kind, i): len(b) for rule in rules for i, b in enumerate(rule.branches())}
    names = sorted({t for *_, t in asked})
    held = index.groupBy("row_key").agg(*[F.max(F.col("trigram") == t).alias(f"t{i}") for i, t in enumerate(names)])
    at = {t: f"t{i}" for i, t in enumerate(names)}

    def meets(kind: str) -> Column:
        branches = [
            reduce(lambda a, b: a & b, [F.col(at[t]) for k, j, t in asked if (k, j) == (kind, i)])
            for (own, i) in need
            if own == kind
        ]
        return reduce(lambda a, b: a | b, branches)

    kinds = list(dict.fromkeys(kind for kind, *_ in asked))
    found = held.select("row_key", *[meets(kind).alias(f"maybe_{kind}") for kind in kinds])
    return found.where(reduce(lambda a, b: a | b, [F.col(f"maybe_{kind}") for kind in kinds]))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, kind_order, kind, end) of the rule's matches in `text`.

    One search gives the matches and one the text before each; their lengths add up to the positions.
    """
    # Each search starts where the last match ended and nowhere else, so what follows the last match is read once.
    whole = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    keep = rule.group + 2

    def placed(gaps: Column, matches: Column, tested: Column) -> Column:
        steps = F.zip_with(
            F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"))),
            tested,
            lambda p, t: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), F.length(t).alias("tested")),
        )
        empty = F.array().cast("array<struct<start:int,kind_order:int,kind:string,end:int>>")
        zero = F.struct(F.lit(0).alias("at"), empty.alias("found"))

        def step(state: Column, p: Column) -> Column:
            start, end = state["at"] + p["gap"], state["at"] + p["gap"] + p["size"]
            span = F.struct(
                start.alias("start"), F.lit(order).alias("kind_order"), F.lit(rule.kind).alias("kind"), end.alias("end")
            )
            return F.struct(
                end.alias("at"),
                F.when(p["tested"] >= rule.least, F.concat(state["found"], F.array(span)))
                .otherwise(state["found"])
                .alias("found"),
            )

        return F.aggregate(steps, zero, step, lambda s: s["found"])

    matches = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    some = let(
        matches,
        lambda m: F.when(
            F.size(m) > 0,
            placed(
                F.regexp_extract_all(text, whole, F.lit(1)),
                m,
                F.regexp_extract_all(text, whole, F.lit(keep)) if rule.group else m,
            ),
        ).otherwise(F.array().cast("array<struct<start:int,kind_order:int,kind:string,end:int>>")),
    )
    return some


def listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with `found`: the spans of all rules by start, then rule."""
    keyed = docs.withColumn("_row_key", F.xxhash64("doc_id", "text"))
    hits = candidates(postings(keyed.select(F.col("_row_key").alias("row_key"), "text"), rules), rules)
    hits = hits.withColumnRenamed("row_key", "_hit_key")
    joined = keyed.join(hits, F.col("_row_key") == F.col("_hit_key"), "left")
    empty = F.array().cast("array<struct<start:int,kind_order:int,kind:string,end:int>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = []
    for i, rule in enumerate(rules):
        every = spans(text, rule, i)
        parts.append(F.when(F.col(f"maybe_{rule.kind}"), every).otherwise(empty) if rule.branches() else every)
    return joined.select(*[docs[c] for c in docs.columns], F.array_sort(F.concat(*parts)).alias("found"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans of every row of `docs` (doc_id, text)."""
    base = [r.kind for r in rules if r.base]
    rows = scanned(docs.select("doc_id", "text"), rules).select("doc_id", "found")
    own = F.filter("found", lambda s: s["kind"].isin(base))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(count, base),
        F.sha2(listed(own), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark` (overlapping spans by one) and n_chars set anew."""
    found = scanned(docs, rules)

    def cut(text: Column, spans_: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        done = F.aggregate(
            spans_,
            zero,
            lambda state, s: F.struct(
                F.greatest(state["at"], s["end"]).alias("at"),
                F.when(s["start"] < state["at"], state["out"])
                .otherwise(
                    F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
                )
                .alias("out"),
            ),
        )
        return let(done, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))

    text = F.when(F.size("found") > 0, cut(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    out = found.withColumn("text", text).drop("found")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
