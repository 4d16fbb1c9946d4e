"""Personal data: fixed patterns, and boosted trees over overlapping candidates that the patterns miss.

The base spans are those of four patterns with their checks (octets, Luhn, digit counts). A pattern takes the longest
run it can and gives it up whole if the check fails, so a card number next to another number is missed, as is a
phone number without a plus. Loose generators therefore propose more spans, which may overlap. Gradient-boosted trees
judge them by format (length, digits, separators, checks) and context (what stands before and after). They learn from
the base: a candidate that is a base span is personal data, one that cuts a base span or fails its own check is not,
and any other is unknown. A quarter of the documents is kept out of training, and on all its known candidates the
lowest score with the wanted precision is taken as the threshold of each kind. Unknown candidates at or above it are added.

Everything stays in columns: matches and gaps of a pattern give the positions, and the trees become nested CASE
expressions, so one scan finds spans and candidates, and they are written, without text, for training and judging.

Cases: a null text is empty; a null doc_id stays null; repeated rows give repeated rows; an empty table gives no rows
and trains nothing; with candidates of one class only nothing is added; other columns are not read.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.tables import written

KINDS = ("email", "ip", "card", "phone")
#: Fixed values, written so that no position is tried twice and no group repeats by recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be personal data: (kind, pattern).
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9.-]++"),
    ("ip", r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    ("phone", r"\+?\(?(?<![0-9])[0-9]{1,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![0-9])"),
    ("phone", r"\(?(?<![0-9])[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
)
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: Bound of the training sample: known candidates, taken by a hash of their place.
SAMPLE = 10_000
TREES = 10
DEPTH = 3
PRECISION = 0.98
STEPS = 200
SPAN = "array<struct<start:bigint,end:bigint>>"
CANDIDATE = "array<struct<kind:string,start:bigint,end:bigint,valid:boolean,features:array<double>>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _base_valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    return {
        "email": F.lit(True),
        "ip": match.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\z"),
        "card": F.when(n.between(16, 19), luhn(_digits(match))).otherwise(False),
        "phone": n.between(8, 15),
    }[kind]


def _loose_valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    return {
        "email": match.rlike(r"[A-Za-z0-9] ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}\.?\z") & ~match.contains(".."),
        "ip": match.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\z"),
        "card": F.when(n.between(13, 19), luhn(_digits(match))).otherwise(False),
        "phone": n.between(8, 15),
    }[kind]


def _pieces(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with the text before and after each, up to its neighbours."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("before"), found.alias("match"), F.slice(gaps, 2, F.size(found)).alias("after"))


def _positions(pieces: Column, kept: Callable[[Column], Column], made: Callable[[Column, Column, Column], Column], kind: str) -> Column:
    """``made(piece, start, end)`` of the pieces that are ``kept``, in order, with code point positions."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("out"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["before"])
        end = start + F.length(piece["match"])
        out = F.when(kept(piece["match"]), F.concat(state["out"], F.array(made(piece, start, end)).cast(kind))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    return F.aggregate(pieces, zero, step, lambda state: state["out"])


def base_spans(text: Column, kind: str) -> Column:
    found = _positions(_pieces(text, BASE[kind]), lambda m: _base_valid(kind, m), lambda _, s, e: F.struct(s.alias("start"), e.alias("end")), SPAN)
    return F.when(text.contains("@") if kind == "email" else text.rlike("[0-9]"), found).otherwise(F.array().cast(SPAN))


def _sort_of(character: Column) -> Column:
    return (
        F.when(character == "", 0.0).when(character.rlike("[0-9]"), 1.0).when(character.rlike(r"\p{L}"), 2.0).when(character.rlike(r"\s"), 3.0).otherwise(4.0)
    )


FEATURES = ("generator", "length", "digits", "digit_share", "separators", "plus", "brackets", "longest_part", "luhn", "valid", "before", "after", "before_2", "after_2")


def _features(number: int, kind: str, piece: Column) -> Column:
    match, digits = piece["match"], _digits(piece["match"])
    length, n = F.length(match), F.length(digits)
    parts = F.transform(F.split(match, r"[^0-9A-Za-z]+", -1), lambda p: F.length(p))
    values = [
        F.lit(float(number)), length, n, n / length, F.size(F.split(match, r"[ .-]", -1)) - 1, match.startswith("+").cast("int"),
        match.contains("(").cast("int"), F.array_max(parts), F.when(n.between(8, 19), luhn(digits).cast("int")).otherwise(0), _loose_valid(kind, match).cast("int"),
        _sort_of(F.right(piece["before"], F.lit(1))), _sort_of(F.left(piece["after"], F.lit(1))),
        _sort_of(F.left(F.right(piece["before"], F.lit(2)), F.lit(1))), _sort_of(F.right(F.left(piece["after"], F.lit(2)), F.lit(1))),
    ]
    return F.array(*[v.cast("double") for v in values])


def candidates(text: Column) -> Column:
    """All proposals of all generators: (kind, start, end, valid, features)."""
    proposed = [
        _positions(
            _pieces(text, pattern), lambda _: F.lit(True),
            lambda p, s, e, number=number, kind=kind: F.struct(F.lit(kind).alias("kind"), s.alias("start"), e.alias("end"), _loose_valid(kind, p["match"]).alias("valid"), _features(number, kind, p).alias("features")),
            CANDIDATE,
        )
        for number, (kind, pattern) in enumerate(GENERATORS)
    ]
    return F.when(text.rlike(r"[0-9]|@|\(at\)|\[at\]"), F.concat(*proposed)).otherwise(F.array().cast(CANDIDATE))


def _labelled(candidate: Column, base: dict[str, Column]) -> Column:
    """1 for a base span, 0 for what cuts one or fails its check, null for the unknown."""
    same = functools.reduce(operator.or_, [
        (candidate["kind"] == kind) & F.exists(base[kind], lambda b: (b["start"] == candidate["start"]) & (b["end"] == candidate["end"])) for kind in KINDS
    ])
    cuts = F.exists(F.concat(*base.values()), lambda b: (b["start"] < candidate["end"]) & (b["end"] > candidate["start"]))
    return F.when(same, 1).when(cuts | ~candidate["valid"], 0)


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, email, ip, card, phone, candidates) of every row; the spans are (start, end), candidates carry a label."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", *[base_spans(text, kind).alias(kind) for kind in KINDS], candidates(text).alias("proposed"))
    found = written(found, "pii-spans")
    base = {kind: F.col(kind) for kind in KINDS}
    labelled = F.transform("proposed", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["features"].alias("features"), _labelled(c, base).alias("label")))
    return found.select("doc_id", *KINDS, labelled.alias("candidates"))


def _tree(node, features: Column) -> Column:
    """A fitted tree as a CASE expression."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(features[split.featureIndex()] <= float(split.threshold()), _tree(node.leftChild(), features)).otherwise(_tree(node.rightChild(), features))


Scorer = Callable[[Column], Column]


def fit(found: DataFrame) -> tuple[Scorer, dict[str, float]] | None:
    """A scorer of features and the threshold of each kind; None if the candidates teach nothing."""
    known = found.where(F.size("candidates") > 0).select(F.xxhash64("doc_id").alias("place"), F.explode("candidates").alias("c")).where("c.label is not null")
    known = known.select("place", "c.kind", "c.features", F.col("c.label").cast("double").alias("label"), F.xxhash64("place", "c.start", "c.end", "c.kind").alias("draw"))
    kept_out = F.pmod("place", F.lit(4)) == 0
    sample = written(known.where(~kept_out).orderBy("draw", "features", "label").limit(SAMPLE).select(array_to_vector("features").alias("vector"), "label"), "pii-sample")
    classes = sample.agg(F.min("label"), F.max("label")).first()
    if classes[0] is None or classes[0] == classes[1]:
        return None
    model = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=5).fit(sample)
    trees = [(tree._call_java("rootNode"), weight) for tree, weight in zip(model.trees, model.treeWeights)]

    def score(features: Column) -> Column:
        margin = functools.reduce(operator.add, [_tree(root, features) * float(weight) for root, weight in trees])
        return 1 / (1 + F.exp(-2 * margin))

    scored = known.where(kept_out).select("kind", "label", F.floor(score(F.col("features")) * STEPS).alias("step"))
    steps = scored.groupBy("kind", "step").agg(F.count("*").alias("n"), F.sum("label").alias("right")).orderBy("kind", F.col("step").desc()).collect()
    thresholds: dict[str, float] = {}
    for kind in KINDS:
        n = right = 0
        for row in (r for r in steps if r["kind"] == kind):
            n, right = n + row["n"], right + row["right"]
            if row["right"] and right >= PRECISION * n:
                thresholds[kind] = row["step"] / STEPS
    return score, thresholds


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, email, ip, card, phone, added): base spans of each kind, and ``added`` (kind, start, end) of the trees."""
    found = find(docs)
    fitted = fit(found)
    added = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    if fitted is not None:
        score, thresholds = fitted

        def wanted(c: Column) -> Column:
            # a kind without a threshold adds nothing
            limit = functools.reduce(lambda rest, k: F.when(c["kind"] == k, F.lit(thresholds[k])).otherwise(rest), thresholds, F.lit(2.0))
            return c["label"].isNull() & (score(c["features"]) >= limit)

        added = F.array_distinct(F.transform(F.filter("candidates", wanted), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    return found.select("doc_id", *KINDS, added.alias("added"))


def redact(text: Column, spans: Column, mark: str = "[redacted]") -> Column:
    """``text`` with every span of ``spans`` (start, end), which may overlap, replaced by ``mark``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], text.substr((state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int")), F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.aggregate(ordered, zero, step, lambda s: F.concat(s["out"], text.substr((s["at"] + 1).cast("int"), F.length(text))))


def _texts(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def _with_added(kind: str) -> Column:
    more = F.filter("added", lambda a: a["kind"] == kind)
    return F.array_sort(F.concat(F.col(kind), F.transform(more, lambda a: F.struct(a["start"].alias("start"), a["end"].alias("end")))))


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of each row of ``detect``."""
    base = F.array_join(F.concat(*[_texts(kind, F.col(kind)) for kind in KINDS]), ",")
    every = F.array_join(F.concat(*[_texts(kind, _with_added(kind)) for kind in KINDS]), ",")
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))
