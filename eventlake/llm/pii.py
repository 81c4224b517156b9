"""Personal data: spans by fixed rules, and more spans from boosted trees over candidates.

Base spans follow four rules (email, ip, card, phone) with their checks. High-recall generators
then propose overlapping spans in looser formats ("name at host dot com", numbers without a plus
sign, other separators). Gradient-boosted trees score each proposal by its format and context,
and a threshold per kind, calibrated on a held-out fold to a wanted precision, selects those that
are added. Base spans always stay; an added span never overlaps one.

The trees learn from the corpus itself: base spans, also rewritten in looser formats, are
positive; proposals that no rule accepts even when normalised, and base spans with changed
digits, are negative. Training and calibration see every distinct span with its context, unless
``sample_rows`` bounds them; spans with equal features are one row with their number as its weight.
The result is applied inside the same expressions as CASE trees, so texts are never shuffled.

Offsets count code points, ends are exclusive. A missing text counts as empty and has no spans;
rows with equal ids each keep their own; without spans to learn from, nothing is added.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.work import stored, whole

KINDS = ("email", "ip", "card", "phone")

#: The rules with possessive repeats and start guards, which change no match but keep the
#: search linear in the text and free of recursion.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
HOST = "[A-Za-z0-9-]{1,63}"
WIDE = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+ ?(?:@|\(at\)|\[at\]|(?<= )at(?= )) ?{HOST}(?: ?(?:\.|\(dot\)|\[dot\]|(?<= )dot(?= )) ?{HOST}){{1,8}}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?: ?\. ?|\[\.\]| dot )[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][ ./-])[0-9](?:[ ./-]?+[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{3,4}(?:[ .-]?[0-9]{2,4})?(?![0-9])",
}
FEATURES = (
    "is_email is_ip is_card is_phone chars digits letters seps kinds_of_seps groups "
    "luhn octets plus at dots spelled spaced cue left_joined right_joined"
).split()
SPELLED = r"\(dot\)|\[dot\]|\[\.\]| dot "
CUE = r"(?i)\b(e-?mail|mail|contact|reach|phone|tel|call|fax|mobile|card|visa|pay|ip|host|addr|server)\b"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check of payment cards; false without digits."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def octets(text: Column) -> Column:
    """Whether the text is four numbers of at most 255."""
    parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(
        parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    )
    return (F.size(parts) == 4) & small


def valid(kind: Column | str, text: Column) -> Column:
    """Whether a text passes the checks of a kind."""
    digits, n = digits_of(text), F.length(digits_of(text))
    tests = {
        "email": F.lit(True),
        "ip": octets(text),
        "card": n.between(14, 19) & luhn(digits),
        "phone": n.between(10, 15),
    }
    if isinstance(kind, str):
        return tests[kind]
    out = F.lit(False)
    for k, test in tests.items():
        out = F.when(kind == k, test).otherwise(out)
    return out


def accepted_as(kind: str):
    return lambda x: valid(kind, x["text"])


def matches(text: Column, pattern: str, kind: str, order: int) -> Column:
    """All matches as structs (start, order, end, kind, text): places follow from the lengths of
    the pieces between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        F.arrays_zip(pieces.alias("gap"), F.transform(found, F.length).alias("length")),
        start,
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + F.coalesce(x["length"], F.lit(0))).alias("at"),
            F.array_append(s["starts"], s["at"] + x["gap"]).alias("starts"),
        ),
        lambda s: s["starts"],
    )
    spans = F.transform(
        F.arrays_zip(found.alias("text"), F.slice(starts, F.lit(1), F.size(found)).alias("start")),
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("order"),
            (x["start"] + F.length(x["text"])).alias("end"),
            F.lit(kind).alias("kind"),
            x["text"].alias("text"),
        ),
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,text:string>>")
    return F.when(F.size(found) == 0, none).otherwise(spans)


def overlaps(x: Column, y: Column) -> Column:
    return (x["start"] < y["end"]) & (y["start"] < x["end"])


def find_spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, base spans and proposals of every document, in one pass over the texts."""
    text = F.col("text")
    base = F.array_sort(
        F.concat(
            *[
                F.filter(matches(text, BASE[k], k, i), accepted_as(k))
                for i, k in enumerate(KINDS)
            ]
        )
    )
    proposed = F.concat(*[matches(text, WIDE[k], k, i) for i, k in enumerate(KINDS)])
    rows = docs.select(key, whole().alias("text")).withColumn("base", base)
    context = lambda x: F.struct(
        *[x[c] for c in ("start", "order", "end", "kind", "text")],
        F.substring(text, F.greatest(F.lit(1), x["start"] - 23), F.least(F.lit(24), x["start"])).alias("left"),
        F.substr(text, x["end"] + 1, F.lit(1)).alias("right"),
    )
    return rows.select(
        key,
        F.transform("base", context).alias("base"),
        F.transform(
            F.filter(proposed, lambda x: ~F.exists("base", lambda b: overlaps(x, b))), context
        ).alias("proposed"),
    )


def normalised(kind: Column, text: Column) -> Column:
    """A loose format rewritten as the rules expect it."""
    dotted = F.regexp_replace(F.regexp_replace(text, r" ?(?:\(dot\)|\[dot\]|\[\.\]| dot ) ?", "."), r" ?\. ?", ".")
    return (
        F.when(kind == "email", F.regexp_replace(dotted, r" ?(?:@|\(at\)|\[at\]| at ) ?", "@"))
        .when(kind == "ip", dotted)
        .otherwise(F.regexp_replace(text, r"[./]", "-"))
    )


def features(x) -> dict[str, Column]:
    """Format and context features of a span with text, kind, left and right."""
    kind, text = x["kind"], x["text"]
    plain = normalised(kind, text)
    seps = F.regexp_replace(text, "[A-Za-z0-9]", "")
    has = lambda part: F.contains(text, F.lit(part)).cast("int")
    kinds_of_seps = F.size(F.array_distinct(F.split(seps, "")))
    made = {f"is_{k}": (kind == k).cast("int") for k in KINDS} | {
        "chars": F.length(text),
        "digits": F.length(digits_of(text)),
        "letters": F.length(F.regexp_replace(text, "[^A-Za-z]", "")),
        "seps": F.length(seps),
        "kinds_of_seps": kinds_of_seps,
        "groups": F.size(F.split(text, "[^A-Za-z0-9]+")),
        "luhn": luhn(digits_of(plain)).cast("int"),
        "octets": octets(plain).cast("int"),
        "plus": has("+"),
        "at": F.contains(plain, F.lit("@")).cast("int"),
        "dots": F.length(F.regexp_replace(plain, r"[^.]", "")),
        "spelled": F.rlike(text, F.lit(SPELLED)).cast("int"),
        "spaced": F.rlike(text, F.lit(r"\s")).cast("int"),
        "cue": F.rlike(x["left"], F.lit(CUE)).cast("int"),
        "left_joined": F.rlike(x["left"], F.lit(r"[\p{L}\p{N}]$")).cast("int"),
        "right_joined": F.rlike(x["right"], F.lit(r"^[\p{L}\p{N}]")).cast("int"),
    }
    return {name: made[name].cast("double") for name in FEATURES}


def training_rows(spans: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """Labelled spans: all base spans and proposals, or at most ``sample_rows`` of each, drawn by hash."""
    cols = ("kind", "text", "left", "right")

    def drawn(column: str) -> DataFrame:
        x = spans.select(F.explode(column).alias("x")).select(*[f"x.{c}" for c in cols])
        x = x.distinct()
        return x if sample_rows is None else x.orderBy(F.xxhash64(*cols), *cols).limit(sample_rows)

    base, proposed = drawn("base"), drawn("proposed")
    loose = F.when(
        F.col("kind") == "email",
        F.regexp_replace(F.regexp_replace("text", "@", " at "), r"\.", " dot "),
    ).when(F.col("kind") == "ip", F.regexp_replace("text", r"\.", " . "))
    loose = loose.when(F.col("kind") == "phone", F.regexp_replace("text", r"^\+[0-9] ?", ""))
    loose = loose.otherwise(F.regexp_replace("text", "([0-9]{4})(?=[0-9])", "$1."))
    broken = (
        F.when(F.col("kind") == "ip", F.regexp_replace("text", r"^[0-9]+", "777"))
        .when(F.col("kind") == "card", F.translate("text", "1234567890", "2345678901"))
        .when(F.col("kind") == "phone", F.substring("text", 1, 8))
        .otherwise(F.regexp_replace("text", "@.*", "@"))
    )
    one, zero = F.lit(1.0).alias("label"), F.lit(0.0).alias("label")
    plain = normalised(F.col("kind"), F.col("text"))
    written = (F.col("kind") != "email") | F.contains("text", F.lit("@")) | F.rlike("text", F.lit(SPELLED))
    accepted = (valid(F.col("kind"), plain) & written).cast("double").alias("label")
    return (
        base.select(*cols, one)
        .union(base.withColumn("text", loose).select(*cols, one))
        .union(base.withColumn("text", broken).select(*cols, zero))
        .union(proposed.select(*cols, accepted))
    )


def tree_sql(debug: str) -> list[str]:
    """The trees of a fitted model as CASE expressions over ``{feature}`` names."""
    lines = [line.strip() for line in debug.splitlines()]
    trees, at = [], 0

    def node() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if leaf := re.match(r"Predict: (\S+)", line):
            return f"{float(leaf[1])!r}D"
        feature, value = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        yes = node()
        at += 1  # the matching Else
        no = node()
        return f"CASE WHEN {{{FEATURES[int(feature)]}}} <= {float(value)!r}D THEN {yes} ELSE {no} END"

    while at < len(lines):
        if weight := re.match(r"Tree \d+ \(weight (\S+)\):", lines[at]):
            at += 1
            trees.append(f"{float(weight[1])!r}D * ({node()})")
        else:
            at += 1
    return trees


def weighted_rows(spans: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """The labelled spans by kind, fold, label and features, and their number as ``weight``."""
    made = features({c: F.col(c) for c in ("kind", "text", "left", "right")})
    held_out = (F.pmod(F.xxhash64("text"), F.lit(4)) == 0).alias("held_out")
    rows = training_rows(spans, sample_rows).select("kind", held_out, "label", *[c.alias(n) for n, c in made.items()])
    keys = ("kind", "held_out", "label", *FEATURES)
    return rows.groupBy(*keys).agg(F.count("*").cast("double").alias("weight")).orderBy(*keys)


def fit(spans: DataFrame, sample_rows: int | None, trees: int, depth: int, precision: float):
    """CASE trees and thresholds per kind, or None where there is nothing to learn from."""
    rows = stored(weighted_rows(spans, sample_rows), "pii-train")
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    train = rows.where(~F.col("held_out"))
    if train.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, stepSize=0.3, weightCol="weight").fit(train)
    case = tree_sql(model.toDebugString)
    score = margin(case, {c: F.col(c) for c in FEATURES})
    steps = (
        rows.where("held_out")
        .withColumn("step", F.floor(score * 20) / 20)
        .groupBy("kind", "step")
        .agg(F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("all"))
        .collect()
    )  # one row for each kind and twentieth of the margin, of which the trees have a bounded number
    thresholds = {}
    for kind in KINDS:
        right = n = 0
        for s in sorted((s for s in steps if s.kind == kind), key=lambda s: -s.step):
            right, n = right + s.right, n + s["all"]
            if right >= precision * n:
                thresholds[kind] = s.step
            else:
                break
    return case, thresholds


def margin(case: list[str], values: dict[str, Column]) -> Column:
    """Sum of the trees for features given as columns."""

    def build(sql: str) -> Column:
        if not (test := re.match(r"CASE WHEN \{(\w+)\} <= (\S+)D THEN ", sql)):
            return F.lit(float(sql.removesuffix("D")))
        depth, at = 1, test.end()
        split = None
        for word in re.finditer(r"CASE|ELSE|END", sql[at:]):
            depth += {"CASE": 1, "END": -1}.get(word[0], 0)
            if word[0] == "ELSE" and depth == 1:
                split = at + word.start()
        yes, no = sql[at:split].strip(), sql[split + 4 : -3].strip()
        return F.when(values[test[1]] <= float(test[2]), build(yes)).otherwise(build(no))

    total = F.lit(0.0)
    for tree in case:
        weight, body = tree.split("D * (", 1)
        total = total + F.lit(float(weight)) * build(body[:-1])
    return total


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def detect(
    docs: DataFrame,
    sample_rows: int | None = None,
    trees: int = 12,
    depth: int = 4,
    precision: float = 0.95,
) -> DataFrame:
    """Per document: base spans and all spans, sorted by start and kind."""
    spans = stored(find_spans(docs), "pii-spans")
    return selected_spans(spans, "doc_id", fit(spans, sample_rows, trees, depth, precision))


def selected_spans(spans: DataFrame, key: str, fitted) -> DataFrame:
    """``key``, the base spans, and with them the proposals that pass their threshold."""
    plain = lambda x: F.struct(*[x[c] for c in ("start", "order", "end", "kind", "text")])
    added = F.lit(None)
    if fitted:
        case, thresholds = fitted

        def selected(x: Column) -> Column:
            wanted = F.lit(None).cast("double")
            for kind, least in thresholds.items():
                wanted = F.when(x["kind"] == kind, F.lit(float(least))).otherwise(wanted)
            return F.coalesce(x["score"] >= wanted, F.lit(False))

        scored = F.transform(
            "proposed",
            lambda x: F.struct(
                *[x[c] for c in ("start", "order", "end", "kind", "text")],
                margin(case, features(x)).alias("score"),
            ),
        )
        added = F.transform(F.filter(scored, selected), plain)
    base = F.transform("base", plain)
    return spans.select(
        key,
        base.alias("base"),
        F.array_sort(F.concat(base, F.coalesce(added, F.slice(base, 1, 0)))).alias("spans"),
    )


def redact(
    docs: DataFrame, sample_rows: int | None = None, trees: int = 12, depth: int = 4, precision: float = 0.95
) -> DataFrame:
    """The columns of ``docs`` with every selected span replaced by its kind in brackets.

    Overlapping spans are replaced as one, named by the first. A first pass over the texts fits the
    model, a second one finds the spans of each row beside it, so ids do not matter.
    """
    fitted = fit(stored(find_spans(docs), "pii-spans"), sample_rows, trees, depth, precision)
    rows = docs.select(F.struct(*docs.columns).alias("record"), "text")
    found = selected_spans(find_spans(rows, "record"), "record", fitted)
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = whole("record.text")
    cut = F.aggregate(
        "spans",
        state,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] < s["at"], s["out"])
            .otherwise(
                F.concat(
                    s["out"],
                    F.substr(text, s["at"] + 1, x["start"] - s["at"]),
                    F.lit("["),
                    x["kind"],
                    F.lit("]"),
                )
            )
            .alias("out"),
        ),
        lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))),
    )
    masked = F.when(F.size("spans") > 0, cut).otherwise(F.col("record.text"))
    return found.select(*[(masked if c == "text" else F.col("record")[c]).alias(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
