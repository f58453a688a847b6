"""Personal data by weak supervision.

Regular expressions propose candidate spans.  Regex, gazetteer and context labelers then vote on each: 1 for
personal data, -1 against, 0 for no opinion.  Candidates are counted by kind and vote pattern over all documents
(a table bounded by the number of patterns, not by the data), expectation-maximisation estimates every labeler's
reliability and the share of true spans without any labels, and a logistic span classifier is trained on the
resulting posteriors.  The classifier decides which candidates beyond the base patterns are spans; spans of the
base patterns always stay.

Everything that touches documents is a Spark SQL expression.  The patterns are anchored at the start of a run
and possessive, so that each scans a text once, also a run of 100,000 digits; they match exactly where the plain
patterns in the comments do.  Offsets count code points, ends are exclusive.

Nulls and empty texts have no spans.  Repeated rows are scanned each for itself.  Input columns named like an
output column are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suturestar.llm.frames import fresh, once, read

KINDS = ("email", "ip", "card", "phone", "secret")

# Base patterns, by contract:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "[A-Za-z0-9-]++"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidates beyond the base, decided by the classifier.
WIDE = {
    "email": rf"(?<![{_LOCAL}])[A-Za-z0-9._-]++\x20?[\[(](?:at|AT)[\])]\x20?{_LABEL}(?:\x20?[\[(](?:dot|DOT)[\])]\x20?{_LABEL})++",
    "ip": r"[0-9A-Fa-f](?<![0-9A-Fa-f:][0-9A-Fa-f])[0-9A-Fa-f]{0,3}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "phone": r"(?:\([0-9]{3}\)\x20?|[0-9](?<![0-9+A-Za-z][0-9])[0-9]{2}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_])(?=[A-Za-z_-]*+[0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{32,64}|[A-Za-z0-9_-]{40})(?![A-Za-z0-9_])",
}
# What every match of a pattern holds: one of these strings, or else a digit.  Texts without it skip the pattern.
HOLDS = {("email", True): ["@"], ("phone", True): ["+"], ("email", False): ["[at]", "(at)", "[AT]", "(AT)"], ("ip", False): [":"]}
SPAN = "array<struct<kind:string,start:bigint,end:bigint,hit:string,before:string,after:string,base:boolean>>"
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"

# Gazetteers (fixed values).
TLDS = "com net org edu gov io info biz dev app co uk de fr es it eu us ca ch at nl be"
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 98"
CONTEXT = {
    "email": "mail e-mail contact write reply from to",
    "ip": "ip host server address addr client login from",
    "card": "card visa mastercard amex credit debit payment iban account",
    "phone": "phone tel call mobile cell fax contact whatsapp",
    "secret": "token key secret password passwd pwd auth bearer api",
}
LABELERS = ("shape", "checksum", "gazetteer", "context", "edges", "variety")
AROUND = 24

EM_ROUNDS = 60
FIT_ROUNDS = 400
ACCEPT = 0.5


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = lambda i: F.when(i % 2 == 1, F.substring(digits, n - i, 1).cast("int") * 2).otherwise(
        F.substring(digits, n - i, 1).cast("int")
    )
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + doubled(i) - F.when(doubled(i) > 9, 9).otherwise(0)
    )
    return total % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _passes(kind: str, hit: Column) -> Column:
    """Whether a match of the base pattern counts."""
    digits = _digits(hit)
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        return F.length(digits).between(16, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _matches(text: Column, kind: str, pattern: str, base: bool, any_digit: Column) -> Column:
    """Structs of every match: kind, start, end, hit, before, after, base."""
    holds = HOLDS.get((kind, base))
    may = any_digit if holds is None else reduce(lambda a, b: a | b, [text.contains(x) for x in holds])

    def place(s: Column) -> Column:
        total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + F.length(x))

        def one(hit: Column, i: Column) -> Column:
            start = total(F.slice(s["gaps"], 1, i + 1)) + total(F.slice(s["hits"], 1, i))
            return F.struct(
                F.lit(kind).alias("kind"),
                start.cast("long").alias("start"),
                (start + F.length(hit)).cast("long").alias("end"),
                hit.alias("hit"),
                F.right(s["gaps"][i], F.lit(AROUND)).alias("before"),
                F.left(s["gaps"][i + 1], F.lit(AROUND)).alias("after"),
                F.lit(base).alias("base"),
            )

        return F.transform(s["hits"], one)

    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = once(F.struct(gaps.alias("gaps"), hits.alias("hits")), place)
    if base:
        found = F.filter(found, lambda c: _passes(kind, c["hit"]))
    return F.coalesce(F.when(may, found), F.array().cast(SPAN))


def candidates(text: Column) -> Column:
    """All candidate spans of a text; wide ones only where no base span of their kind overlaps."""

    def scan(t: Column) -> Column:
        base = F.flatten(F.array(*[_matches(t["text"], k, BASE[k], True, t["digit"]) for k in BASE]))
        wide = F.flatten(F.array(*[_matches(t["text"], k, WIDE[k], False, t["digit"]) for k in KINDS]))
        return F.struct(base.alias("base"), wide.alias("wide"))

    def merge(s: Column) -> Column:
        new = F.filter(
            s["wide"],
            lambda w: ~F.exists(s["base"], lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
        )
        return F.concat(s["base"], new)

    text = F.coalesce(text, F.lit(""))
    return once(once(F.struct(text.alias("text"), text.rlike("[0-9]").alias("digit")), scan), merge)


def _words(values: str) -> str:
    return "|".join(values.replace("-", "\\-").split())


def _by_kind(c: Column, per_kind: dict[str, Column], other: Column) -> Column:
    out = None
    for k, v in per_kind.items():
        out = F.when(c["kind"] == k, v) if out is None else out.when(c["kind"] == k, v)
    return other if out is None else out.otherwise(other)


def votes(c: Column) -> Column:
    """The labelers' votes on a candidate, in the order of LABELERS."""
    hit, digits = c["hit"], _digits(c["hit"])
    vote = lambda yes, no=None: F.when(yes, 1).when(no if no is not None else ~yes, -1).otherwise(0)
    n = F.length(digits)
    shape = F.when(c["base"], 1).otherwise(
        _by_kind(c, {"secret": vote(hit.rlike("^(AKIA|gh[pousr]_)|^[0-9a-f]+$")), "ip": F.lit(1)}, F.lit(0))
    )
    checksum = _by_kind(
        c,
        {
            "ip": vote(hit.rlike(OCTETS) | hit.contains(":")),
            "card": vote(_luhn(digits)),
            "phone": vote(n.between(8, 15)),
            "secret": vote(hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")),
        },
        F.lit(0),
    )
    gazetteer = _by_kind(
        c,
        {
            "email": vote(hit.rlike(rf"(?i)(?:{_words(TLDS)})$"), hit.rlike("(?i)[0-9]$")),
            "card": vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)")),
            "phone": F.when(hit.startswith("+"), vote(digits.rlike(f"^(?:{_words(CALLING)})"))).otherwise(0),
            "ip": vote(~hit.rlike(r"^(?:0|255)\."), hit.rlike(r"^0\.")),
            "secret": F.when(hit.rlike("^(AKIA|gh[pousr]_)"), 1).otherwise(0),
        },
        F.lit(0),
    )
    near = F.lower(c["before"])
    context = _by_kind(
        c, {k: F.when(near.rlike(rf"(?:^|[^a-z])(?:{_words(w)})[^a-z]"), 1).otherwise(0) for k, w in CONTEXT.items()}, F.lit(0)
    )
    joined = c["before"].rlike(r"[A-Za-z0-9]$") | c["after"].rlike(r"^[A-Za-z0-9]")
    edges = F.when(joined, -1).otherwise(1)
    kinds_of_character = F.size(F.array_distinct(F.split(F.regexp_replace(hit, "[^A-Za-z0-9]", ""), "")))
    variety = F.when(kinds_of_character >= 5, 1).when(kinds_of_character <= 3, -1).otherwise(0)
    return F.array(*[v.cast("int") for v in (shape, checksum, gazetteer, context, edges, variety)])


@dataclass
class Model:
    """Reliabilities by kind and labeler: P(vote | true), P(vote | false); and the classifier's weights."""

    share: dict[str, float]
    reliability: dict[tuple[str, int, int], tuple[float, float]]
    bias: dict[str, float]
    weight: dict[tuple[str, int, int], float]

    def probability(self, kind: str, pattern: tuple[int, ...]) -> float:
        z = self.bias[kind] + sum(self.weight[kind, i, v] for i, v in enumerate(pattern))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


Counts = dict[tuple[str, tuple[int, ...]], int]


def _posterior(kind, pattern, share, reliability) -> float:
    yes, no = math.log(share[kind]), math.log(1 - share[kind])
    for i, v in enumerate(pattern):
        a, b = reliability[kind, i, v]
        yes, no = yes + math.log(a), no + math.log(b)
    return 1 / (1 + math.exp(max(-50.0, min(50.0, no - yes))))


def estimate(counts: Counts) -> Model:
    """EM over pattern counts, then a logistic classifier on the posteriors.  Kinds without candidates keep the prior."""
    share = dict.fromkeys(KINDS, 0.7)
    reliability = {
        (k, i, v): {1: (0.6, 0.2), 0: (0.3, 0.4), -1: (0.1, 0.4)}[v] for k in KINDS for i in range(len(LABELERS)) for v in (1, 0, -1)
    }
    prior = dict(reliability)
    for _ in range(EM_ROUNDS):
        post = {key: _posterior(*key, share, reliability) for key in counts}
        for k in KINDS:
            mine = [(p, n, post[kind, p]) for (kind, p), n in counts.items() if kind == k]
            # The priors weigh as much as ten candidates, so that rare kinds and votes stay defined.
            true, all_ = 7 + sum(n * q for _, n, q in mine), 10 + sum(n for _, n, _ in mine)
            share[k] = min(0.999, max(0.001, true / all_))
            for i in range(len(LABELERS)):
                for v in (1, 0, -1):
                    a, b = prior[k, i, v]
                    yes = sum(n * q for p, n, q in mine if p[i] == v) + 10 * a
                    no = sum(n * (1 - q) for p, n, q in mine if p[i] == v) + 10 * b
                    reliability[k, i, v] = (yes / (true + 3), no / (all_ - true + 7))
    bias, weight = {}, {}
    for k in KINDS:
        # Start from the generative model's log odds, then fit to the posteriors.
        bias[k] = math.log(share[k] / (1 - share[k]))
        w = {(i, v): math.log(reliability[k, i, v][0] / reliability[k, i, v][1]) for i in range(len(LABELERS)) for v in (1, 0, -1)}
        mine = [(p, n, _posterior(k, p, share, reliability)) for (kind, p), n in counts.items() if kind == k]
        total = sum(n for _, n, _ in mine)
        for _ in range(FIT_ROUNDS if total else 0):
            step = dict.fromkeys(w, 0.0)
            at_bias = 0.0
            for p, n, q in mine:
                z = bias[k] + sum(w[i, v] for i, v in enumerate(p))
                g = n / total * (q - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                at_bias += g
                for i, v in enumerate(p):
                    step[i, v] += g
            bias[k] += 0.5 * at_bias
            for key in w:
                w[key] += 0.5 * step[key]
        weight |= {(k, i, v): x for (i, v), x in w.items()}
    return Model(share, reliability, bias, weight)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Vote patterns of all candidates of all documents, counted; at most kinds x 3^labelers rows reach the driver."""
    # The outer form: a plain explode makes the optimizer add a filter that scans every text again.
    found = docs.select(F.explode_outer(candidates(F.col(text))).alias("c")).filter(F.col("c").isNotNull())
    rows = found.groupBy(F.col("c.kind").alias("kind"), votes(F.col("c")).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    return estimate({(r.kind, tuple(r.pattern)): r.n for r in rows.collect()})


def _accepted(c: Column, model: Model) -> Column:
    def z(v: Column) -> Column:
        per_kind = {}
        for k in KINDS:
            terms = [F.lit(model.bias[k])]
            for i in range(len(LABELERS)):
                w = model.weight
                terms.append(F.when(v[i] == 1, w[k, i, 1]).when(v[i] == -1, w[k, i, -1]).otherwise(w[k, i, 0]))
            per_kind[k] = reduce(lambda a, b: a + b, terms)
        return _by_kind(c, per_kind, F.lit(-30.0))

    return c["base"] | (once(votes(c), z) > math.log(ACCEPT / (1 - ACCEPT)))


def spans(docs: DataFrame, model: Model, text: str = "text", out: str = "spans") -> DataFrame:
    """Every row with its spans (kind, start, end, base), by kind in the order of KINDS, then by start."""
    order = F.expr("map(" + ",".join(f"'{k}',{i}" for i, k in enumerate(KINDS)) + ")")
    kept = F.filter(candidates(F.col(text)), lambda c: _accepted(c, model))
    plain = F.transform(
        kept,
        lambda c: F.struct(
            order[c["kind"]].alias("rank"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base")
        ),
    )
    return docs.withColumn(out, F.array_sort(plain))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The same rows and columns, each span of the text replaced by its kind in brackets; overlaps go as one."""
    found = fresh("spans")

    def cut(s: Column) -> Column:
        start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))

        def step(acc: Column, x: Column) -> Column:
            gap = F.when(x["start"] >= acc["at"], F.concat(
                acc["done"],
                F.substring(s["text"], (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")),
                F.lit("["), F.upper(x["kind"]), F.lit("]"),
            )).otherwise(acc["done"])
            return F.struct(gap.alias("done"), F.greatest(acc["at"], x["end"]).alias("at"))

        by_place = F.array_sort(F.transform(s["found"], lambda x: F.struct(x["start"], x["end"], x["kind"])))
        return F.aggregate(
            by_place, start, step,
            lambda acc: F.concat(acc["done"], F.substring(s["text"], (acc["at"] + 1).cast("int"), F.length(s["text"]))),
        )

    clean = once(F.struct(F.col(text).alias("text"), F.col(found).alias("found")), cut)
    with_spans = spans(docs, model, text, found)
    return with_spans.withColumn(text, F.when(F.size(found) > 0, clean).otherwise(F.col(text))).drop(found)


def listed(xs: Column) -> Column:
    return F.array_join(
        F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def op7_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = spans(docs, fit(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda x: x["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
