"""Secret scan over a trigram inverted index.

Each rule is a regular expression. Its mandatory trigrams become a Boolean query; the postings of
the trigrams that any query mentions are stored as a table, the lists are intersected per text and
rule, and only candidates are verified with the expression. A rule without mandatory trigrams
(long hexadecimal runs) scans every text. All of it is DataFrame code.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notevalue.llm.rows import let
from notevalue.llm.trigrams import trigram_query, trigrams
from notevalue.session import cut


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches are leftmost and do not overlap; those whose `group` is shorter than `least` characters go."""

    kind: str
    expression: str
    least: int = 1
    group: int = 0


# Expressions that Java and the trigram reader both understand. The first three are fixed values;
# their spans are always part of the result.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )?PRIVATE KEY-----)?"),
    Rule("login", r"[a-z]{3,10}://[A-Za-z0-9._-]+:[^\s:@/]{3,}@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE


def postings(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`gram, id`: which of the texts (`id, text`) hold which of the trigrams that the rules need."""
    wanted = sorted(set().union(*(trigrams(trigram_query(r.expression)) for r in rules)))
    low = F.lower("text")
    held = F.filter(F.array(*[F.lit(g) for g in wanted]), lambda g: F.contains(F.col("low"), g))
    return texts.select("id", low.alias("low")).select("id", F.explode(held).alias("gram"))


def _holds(query, grams: str) -> Column:
    if isinstance(query, str):
        return F.array_contains(grams, query)
    return reduce(and_ if query[0] == "and" else or_, [_holds(q, grams) for q in query[1:]])


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`id, kinds`: the texts whose postings satisfy a rule's query, with the kinds of those rules."""
    queries = [(r.kind, trigram_query(r.expression)) for r in rules]
    tests = [F.when(_holds(q, "grams"), F.lit(kind)) for kind, q in queries if q is not None]
    gathered = index.groupBy("id").agg(F.collect_set("gram").alias("grams"))
    return gathered.select("id", F.array_compact(F.array(*tests)).alias("kinds")).filter(F.size("kinds") > 0)


def _spans(rule: Rule, text: Column) -> Column:
    """`start, kind, end` of a rule's matches in `text`, in code points, end exclusive."""
    expression = rule.expression
    if rule.group == 0 and rule.least > 1 and expression.endswith("+"):
        # One greedy run: a shorter match can only fail as a whole, so the bound may stand inside.
        head = expression[: expression.rindex("[")]
        expression = f"{expression[:-1]}{{{rule.least - len(head)},}}"
    match = F.lit(expression)
    lengths = F.transform(F.regexp_extract_all(text, match, F.lit(0)), F.length)
    tested = F.transform(F.regexp_extract_all(text, match, F.lit(rule.group)), F.length) if rule.group else lengths
    before = F.transform(F.split(text, expression, -1), F.length)
    gaps = F.slice(before, 1, F.size(lengths))
    steps = F.arrays_zip(gaps.alias("gap"), lengths.alias("n"), tested.alias("t"))
    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state: Column, s: Column) -> Column:
        begin, end = state["at"] + s["gap"], state["at"] + s["gap"] + s["n"]
        span = F.array(F.struct(begin.alias("start"), F.lit(rule.kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s["t"] >= rule.least, F.concat(state["found"], span)).otherwise(state["found"]).alias("found"))

    walked = F.aggregate(steps, start, step)["found"]
    return F.when(F.regexp_like(text, match), walked).otherwise(none)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`docs` with `secret_spans`: structs (start, kind, end) ordered by start, then the rules' order.

    Offsets are code points, end exclusive. Spans of different kinds may overlap. A null text is an
    empty one and has no span. Rows are told apart by key and text, so repeated rows, repeated keys
    and null keys each get their own spans; other columns are carried along untouched, but
    `secret_spans` replaces a column of that name. No rows give no rows.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    columns = [c for c in docs.columns if c != "secret_spans"]
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"), F.xxhash64(docs[key], docs[text]).alias("id"))
    body = F.coalesce(F.col("row")[text], F.lit(""))
    found = cut(candidates(postings(rows.select("id", body.alias("text")), rules), rules))
    joined = rows.join(found, "id", "left")
    tests = []
    for rule in rules:
        spans = _spans(rule, body)
        if trigram_query(rule.expression) is not None:
            spans = F.when(F.array_contains("kinds", rule.kind), spans)
        tests.append(F.coalesce(spans, F.array().cast("array<struct<start:int,kind:string,end:int>>")))
    ranked = F.transform(F.concat(*tests), lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    spans = F.transform(F.array_sort(ranked), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return joined.select("row.*", spans.alias("secret_spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` of `find_secrets` with every covered stretch of `text` replaced by `mark`.

    Overlapping and touching spans give one mark. Texts without spans, null ones too, stay as they are.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        fresh = F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        inside = (s["start"] <= state["at"]) & (state["at"] > 0)
        return F.struct(F.when(inside, state["out"]).otherwise(fresh).alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    masked = let(F.aggregate("secret_spans", start, step), lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(text))))
    return docs.withColumn(text, F.when(F.size("secret_spans") > 0, masked).otherwise(F.col(text)))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The counts, the base digest and all spans of `find_secrets` as columns."""

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    def text(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("secret_spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        key, count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secret_spans")).alias("spans"),
    )
