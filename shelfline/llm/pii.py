"""Personal data in texts: base patterns, and further spans that boosted trees select.

Wide patterns propose candidate spans of each kind, which may overlap each other and the base
spans. Gradient boosted trees score each candidate by features of its format (lengths, groups,
separators, check digit, size of parts) and of its context (what stands before and after it). They
are fitted on a bounded sample of distinct candidates, as many of each kind and label. A label says
whether a base span of the kind covers the candidate, or its normal form, with the marks and
separators that only the wide patterns know replaced, passes the check of the base; that rule is no
feature. For each kind the threshold is the lowest score at which all candidates of all documents
have the wanted precision, and also those alone that no base span covers, as these are what it adds.
Candidates with the same features are one to the trees, so they are counted by features first, and
these counts are all that is drawn from and calibrated on. Spans count code points, ends are
exclusive.

A text is cut once by each pattern, into gaps and matches. Offsets are running sums of their
lengths, context comes from the neighbouring gap and match, and what base spans cover from running
maxima over both sorted together; each takes a logarithmic number of passes, so the work on a text
with very many candidates stays in proportion to it.

DataFrame functions only. Null counts as empty; a text without candidates has only its base spans.
Equal rows keep a row each, ties of scores are decided alike for all. With no candidates of both
labels nothing is added. An empty table has an empty result. Repeated groups in the patterns are
possessive, so long texts need no deep stack.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.store import keeps_columns, neutral, stored

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. A match of an e-mail address starts where its run of characters starts, or
#: where the last match ended; so no run is searched from each of its characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What proposes candidates, by kind.
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@| ?[\[(](?:at|AT)[\])] ?)[A-Za-z0-9-]++(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:[.:_-][0-9]{1,3}){3}",
    "card": r"[0-9](?:[\x20.-]?[0-9]){11,18}",
    "phone": r"\+?\(?[0-9]{2,4}\)?(?:[\x20.-]?\(?[0-9]{2,4}\)?){2,4}",
}
#: What a text must have for a kind to be looked for.
NEEDS = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|credit|account|pay",
    "phone": "phone|tel|call|mobile|fax",
}
#: What stands for @ and for a point in addresses.
AT, DOT = r"\x20?[\[(](?:at|AT)[\])]\x20?", r"\x20?[\[(](?:dot|DOT)[\])]\x20?"
#: What tells a phone number from other digits: a country code or an area in brackets in it, or a country code or a word before it.
AREA, COUNTRY, CALLED = r"^\+|\([0-9]{2,4}\)", r"\+[0-9]{1,3}[\x20.-]?$", r"\b(?:phone|telephone|tel|call|mobile|fax)\b[^0-9]*$"
FEATURES = [
    "kind", "length", "digits", "letters", "separators", "groups", "longest", "shortest",
    "even", "dotted", "luhn", "octets", "area", "word", "called", "country", "opens", "closes", "joined",
]
#: Code points before a span that count as its context, and after it; of the match before it and what is between at most.
BEFORE, AFTER = 24, 2
#: Distinct candidates that the trees are fitted on at most, and the precision they keep.
SAMPLE_ROWS, PRECISION = 20_000, 0.95
SPAN = "array<struct<kind: int, start: int, end: int, found: string, before: string, after: string>>"


def bound(x: Column, use: Callable[[Column], Column]) -> Column:
    """`use(x)`, with x computed once."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """At each place the values up to there joined, in a logarithmic number of passes."""
    steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda d: d < F.size(values))
    return F.aggregate(steps, values, lambda acc, d: F.transform(acc, lambda v, i: F.when(i >= d, join(v, F.get(acc, i - d))).otherwise(v)))


def found(text: Column, kind: int, pattern: str) -> Column:
    """The leftmost non-overlapping matches: kind, start, end, matched text, what stands before and after."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def spans(p: Column, ends: Column) -> Column:
        hit = lambda i: F.coalesce(F.get(p, i)["hit"], F.lit(""))
        before = lambda i: F.concat(F.when(i > 0, hit(i - 1)).otherwise(""), F.get(p, i)["gap"])
        after = lambda i: F.concat(F.get(p, i + 1)["gap"], hit(i + 1))
        last = F.size(p) - 1
        return F.transform(
            F.slice(p, F.lit(1), last),
            lambda x, i: F.struct(
                F.lit(kind).alias("kind"), (F.get(ends, i) - F.length(x["hit"])).alias("start"), F.get(ends, i).alias("end"), x["hit"].alias("found"),
                F.right(before(i), F.lit(BEFORE)).alias("before"), F.left(after(i), F.lit(AFTER)).alias("after"),
            ),
        )

    lengths = lambda p: F.transform(p, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))
    placed = bound(pieces, lambda p: bound(bound(lengths(p), lambda n: running(n, lambda a, b: a + b)), lambda ends: spans(p, ends)))
    none = F.expr(f"cast(array() as {SPAN})")
    return F.when(text.rlike(NEEDS[KINDS[kind]]), placed).otherwise(none)


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.coalesce(F.when(d > 9, d - 9).otherwise(d), F.lit(0))) % 10 == 0


def valid(kind: str, x: Column) -> Column:
    digits = digits_of(x)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])?"  # of zeros alone nothing is left
        return x.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    return F.length(digits).between(9, 15)


def checked(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda s: valid(kind, s["found"]))


def with_base(docs: DataFrame) -> DataFrame:
    """The documents with the base spans of each kind."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({f"_{k}": checked(k, found(text, i, BASE[k])) for i, k in enumerate(KINDS)})


def with_candidates(docs: DataFrame) -> DataFrame:
    """Documents that have `base` spans, with the features of their candidates."""
    text = F.coalesce("text", F.lit(""))
    spans = F.concat(*[found(text, i, WIDE[k]) for i, k in enumerate(KINDS)])
    return docs.withColumn("_spans", spans).withColumn("_candidates", judged(F.transform("_spans", features), F.col("_base")))


def judged(candidates: Column, base: Column) -> Column:
    """The candidates by start, each with `new`, whether no base span covers it, and its label.

    Both are sorted together by start, base spans first; the running maximum of the ends of a kind
    tells whether one of its base spans reaches a candidate's end.
    """
    ends = lambda s: [F.when(s["kind"] == i, s["end"]).otherwise(-1).alias(k) for i, k in enumerate(KINDS)]
    none = [F.lit(-1).alias(k) for k in KINDS]
    at = lambda s, order, i, far: [s["start"].alias("start"), F.lit(order).alias("order"), i.alias("i"), F.struct(*far).alias("far")]
    marks = lambda bs, cs: F.concat(
        F.transform(bs, lambda b, i: F.struct(*at(b, 0, i, ends(b)), F.get(cs, F.lit(-1)).alias("c"))),
        F.transform(cs, lambda c, i: F.struct(*at(c, 1, i, none), c.alias("c"))),
    )
    join = lambda a, b: F.struct(*[F.greatest(a[k], b[k]).alias(k) for k in KINDS])

    def told(m: Column, far: Column) -> Column:
        c, same = m["c"], F.lit(-1)
        for i, k in enumerate(KINDS):
            same = F.when(m["c"]["kind"] == i, far[k]).otherwise(same)
        label = (c["reads"] | (same >= c["end"])).cast("long").alias("label")
        new = (F.greatest(*[far[k] for k in KINDS]) < c["end"]).cast("long").alias("new")
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), *[c[f].alias(f) for f in FEATURES], label, new)

    def each(m: Column) -> Column:
        far = bound(F.transform(m, lambda x: x["far"]), lambda values: running(values, join))
        pairs = F.filter(F.arrays_zip(m.alias("m"), far.alias("far")), lambda x: x["m"]["order"] == 1)
        return F.transform(pairs, lambda x: told(x["m"], x["far"]))

    return bound(base, lambda bs: bound(candidates, lambda cs: bound(F.array_sort(marks(bs, cs)), each)))


def reads(s: Column) -> Column:
    """Whether the normal form of a candidate passes the check of its kind, and the candidate is no part of a longer form.

    Parts of an IP address or a card have the same separator all through, so that clock times and
    neighbouring numbers are neither; digits alone are a phone number only by what marks them as one.
    """
    x, context = s["found"], F.lower(s["before"])
    apart = lambda sep: ~joined(s, sep)
    point = F.regexp_extract(x, "[.:_-]", 0)
    address = F.regexp_replace(F.regexp_replace(x, AT, "@"), DOT, ".")
    tests = {
        "email": address.rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$"),
        "ip": x.rlike(r"^[0-9]++([.:_-])[0-9]++\1[0-9]++\1[0-9]++$") & valid("ip", F.regexp_replace(x, "[:_-]", ".")) & apart(lambda c: c == point),
        "card": x.rlike(r"^[0-9]++(?:([\x20.-])[0-9]++(?:\1[0-9]++)*+)?+$") & valid("card", x) & apart(lambda c: c.rlike(r"^[\x20.-]")),
        "phone": valid("phone", x) & (context.rlike(COUNTRY) | ((x.rlike(AREA) | context.rlike(CALLED)) & apart(lambda c: c.rlike("^[.-]")))),
    }
    out = F.lit(False)
    for i, k in enumerate(KINDS):
        out = F.when(s["kind"] == i, tests[k]).otherwise(out)
    return out


def joined(s: Column, sep: Callable[[Column], Column]) -> Column:
    """Whether a letter or digit, or a separator and a digit, stand right beside the span."""
    one, two = F.right(s["before"], F.lit(1)), F.left(F.right(s["before"], F.lit(2)), F.lit(1))
    next1, next2 = F.left(s["after"], F.lit(1)), F.substring(s["after"], 2, 1)
    digit, wordy = "^[0-9]", "^[A-Za-z0-9]"
    two = F.when(F.length(s["before"]) > 1, two).otherwise("")
    return one.rlike(wordy) | next1.rlike(wordy) | (sep(one) & two.rlike(digit)) | (sep(next1) & next2.rlike(digit))


def features(s: Column) -> Column:
    """Start, end, the features, and the rule that labels are made by."""
    x, kind, context = s["found"], s["kind"], F.lower(s["before"])
    word = F.lit(False)
    for i, k in enumerate(KINDS):
        word = word | ((kind == i) & context.rlike(CONTEXT[k]))
    around = lambda c: F.when(c == "", 1).otherwise(c.rlike(r"[\s(\"'<]").cast("int"))
    runs = F.split(x, "[^A-Za-z0-9]+")
    sizes = F.transform(F.filter(runs, lambda r: r != ""), lambda r: F.length(r))
    values = {
        "kind": kind,
        "length": F.length(x),
        "digits": F.length(digits_of(x)),
        "letters": F.length(F.regexp_replace(x, "[^A-Za-z]", "")),
        "separators": F.length(F.regexp_replace(x, "[A-Za-z0-9]", "")),
        "groups": F.size(runs),
        "longest": F.array_max(sizes),
        "shortest": F.array_min(sizes),
        "even": x.rlike(r"^[0-9]++(?:([^A-Za-z0-9])[0-9]++(?:\1[0-9]++)*+)?+$").cast("int"),
        "dotted": F.size(F.regexp_extract_all(x, F.lit(rf"\.|{DOT}"), F.lit(0))),
        "luhn": F.when(kind == KINDS.index("card"), luhn(digits_of(x)).cast("int")).otherwise(0),
        "octets": F.when(kind == KINDS.index("ip"), valid("ip", F.regexp_replace(x, "[:_-]", ".")).cast("int")).otherwise(0),
        "area": x.rlike(AREA).cast("int"),
        "word": word.cast("int"),
        "called": context.rlike(CALLED).cast("int"),
        "country": context.rlike(COUNTRY).cast("int"),
        "opens": around(F.right(s["before"], F.lit(1))),
        "closes": around(F.left(s["after"], F.lit(1))),
        "joined": joined(s, lambda c: c.rlike("^[.:_-]")).cast("int"),
    }
    named = [F.coalesce(values[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES]
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), *named, F.coalesce(reads(s), F.lit(False)).alias("reads"))


@dataclass
class Trees:
    """Boosted trees as text, their weights, and the least score by kind, in hundredths."""

    trees: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    least: dict[int, int] = field(default_factory=dict)

    def score(self, c: Column) -> Column:
        margin = sum((F.lit(float(w)) * tree_column(t, c) for t, w in zip(self.trees, self.weights)), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def bin(self, c: Column) -> Column:
        """The score in whole hundredths."""
        return F.floor(self.score(c) * 100)

    def selects(self, c: Column) -> Column:
        out = F.lit(False)
        for kind, least in self.least.items():
            out = out | ((c["kind"] == kind) & (self.bin(c) >= least))
        return out


def tree_column(text: str, c: Column) -> Column:
    """A regression tree, printed by Spark, as one expression over a candidate's features."""
    lines = [x.strip() for x in text.splitlines() if re.match(r"\s*(If|Else|Predict)", x)]

    def node(at: int) -> tuple[Column, int]:
        if m := re.match(r"Predict: (\S+)", lines[at]):
            return F.lit(float(m[1])), at + 1
        feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        low, at = node(at + 1)
        high, at = node(at + 1)
        return F.when(c[FEATURES[int(feature)]] <= float(bound), low).otherwise(high), at

    return node(0)[0]


def counted(docs: DataFrame) -> DataFrame:
    """The distinct features of all candidates, how many have them (n), how many of these are positive (good); both without covered ones (new, new_good)."""
    base = with_base(docs.select("text")).withColumn("_base", F.concat(*[F.col(f"_{k}") for k in KINDS])).select("text", "_base")
    each = with_candidates(base).select(F.explode("_candidates").alias("c")).select("c.*")
    new_good = F.sum(F.col("label") * F.col("new"))
    return each.groupBy(*FEATURES).agg(F.sum("label").alias("good"), F.count("*").alias("n"), new_good.alias("new_good"), F.sum("new").alias("new"))


def drawn(seen: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most `rows` of the distinct candidates: of each kind and label as many, those that come first by hash.

    Features that have both labels are drawn for each, weighted by its share.
    """
    share = {0: 1 - F.col("good") / F.col("n"), 1: F.col("good") / F.col("n")}
    order = [F.xxhash64(F.lit(seed), *FEATURES), *FEATURES]
    strata = [
        seen.where((F.col("kind") == kind) & (weight > 0)).orderBy(*order).limit(rows // (2 * len(KINDS))).select(*FEATURES, F.lit(float(y)).alias("label"), weight.alias("weight"))
        for kind in range(len(KINDS))
        for y, weight in share.items()
    ]
    return reduce(DataFrame.unionAll, strata)


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, precision: float = PRECISION, seed: int = 42) -> Trees:
    """Fitted on at most `rows` distinct candidates, and calibrated on all candidates of all documents."""
    seen = stored(counted(docs))
    learn = stored(drawn(seen, rows, seed))
    if learn.select("label").distinct().count() < 2:
        return Trees()
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(learn)
    model = GBTClassifier(maxIter=20, maxDepth=5, seed=seed, weightCol="weight").fit(assembled)
    out = Trees([t.toDebugString for t in model.trees], list(model.treeWeights))
    sums = ["good", "n", "new_good", "new"]
    binned = seen.select("kind", *sums, out.bin(F.struct(*FEATURES)).alias("bin"))
    counts = binned.groupBy("kind", "bin").agg(*[F.sum(x).alias(x) for x in sums]).collect()  # at most 404 rows
    for kind in range(len(KINDS)):
        good, n, new_good, new = 0, 0, 0, 0
        for r in sorted((r for r in counts if r["kind"] == kind), key=lambda r: -r["bin"]):
            good, n, new_good, new = good + r["good"], n + r["n"], new_good + r["new_good"], new + r["new"]
            if good >= precision * n and new_good >= precision * new:
                out.least[kind] = r["bin"]
    return out


def named(spans: Column) -> Column:
    """The spans as kind:start:end, joined by commas in the given order."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """The documents with base (spans that the patterns find) and spans (with those selected).

    Columns of the documents called like these two are replaced.
    """
    trees = trees or train(docs)
    own = docs.drop("base", "spans")
    based = with_base(neutral(own)).withColumn("_base", F.concat(*[F.col(f"_{k}") for k in KINDS]))
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"].cast("int").alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    more = F.filter("_candidates", lambda c: trees.selects(c) & (c["new"] == 1))
    out = with_candidates(based).withColumn("base", plain(F.col("_base"))).withColumn("spans", F.array_sort(F.concat("base", plain(more))))
    return out.drop("_base", "_spans", "_candidates", *[f"_{k}" for k in KINDS]).toDF(*own.columns, "base", "spans")


@keeps_columns
def redacted(docs: DataFrame, trees: Trees | None = None, mark: str = "▇") -> DataFrame:
    """The documents with every code point of a span replaced in their text; length stays."""
    out = personal_data(docs, trees)
    masked = F.aggregate("spans", F.coalesce("text", F.lit("")), lambda t, s: F.overlay(t, F.repeat(F.lit(mark), s["end"] - s["start"]), s["start"] + 1, s["end"] - s["start"]))
    return out.withColumn("text", F.when(F.col("text").isNotNull(), masked)).select(*docs.columns)


def report(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document."""
    out = personal_data(docs.select("doc_id", "text"), trees)
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
