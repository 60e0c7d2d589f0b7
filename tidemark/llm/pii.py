"""Personal data in texts: base spans by pattern, further ones by boosted trees.

Everything is column code on the row of the text: no rows are moved but the counts of
equal candidates. Patterns give the base spans, which always stay. Wider generators propose candidates that may overlap; their format and surroundings are the
features of gradient-boosted trees, which learn from the base matches that pass or fail
their kind's rule and from digits inside longer strings. The trees are read back as one
column expression; each kind has a threshold. Both come from all candidates of the table:
the thresholds from how trees score the fold of candidates that they did not learn from. Of overlapping picks the best one stays, and none may touch a base span.

Work grows with a text and its matches, not with their square: positions and overlaps come
from running sums and maxima over sorted spans, taken in runs, and a long text is read at
fixed width, so that what surrounds a span is found without counting characters from its start.

A null text counts as empty: no spans. Positions are code points, ends exclusive. Rows
with equal or null ids are read each on its own. An empty table gives an empty result;
with only one class of candidates nothing is added. Of candidates with equal scores the one
that starts first stays. Other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import stored

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the base spans. Where a greedy run cannot give back characters to any
# use it is possessive, and a run is entered at its start or where the last match ended:
# the matches are the same, the time linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[(]at[\])]\x20?|\x20@\x20)[A-Za-z0-9-]{1,63}+"
              r"(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]{1,63}+){1,6}+",),
    "ip": (r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20?\.\x20?)[0-9]{1,3}){3}(?![0-9])",),
    "card": (r"(?<![0-9])[0-9]{13,19}(?![0-9])", r"(?<![0-9])[0-9]{4}(?:[\x20./-][0-9]{4}){3}(?![0-9])"),
    "phone": (r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])",
              r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
}
CUE = r"(?i)(?:mail|phone|tel|call|fax|mobile|card|visa|ip|host|addr|contact)\W*$"

# Folds of the candidates; thresholds are set on each as seen by trees fitted on the others.
CALIBRATION_FOLDS = 4
TREES, DEPTH = 12, 3
PRECISION, LEAST_SCORE = 0.99, 0.8
AROUND = 16
# Values of one run, and characters beyond which a text is read at fixed width; they change no result.
RUN, LONG = 64, 20_000
FAR = (1 << 31) - 1


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def part(values: Column, start: Column, end: Column) -> Column:
    """Elements from ``start`` to before ``end``, of which there is one at least, each fetched by its place."""
    return F.transform(F.sequence(start, end - 1), lambda k: F.get(values, k))


def running(values: Column, op, zero: int) -> Column:
    """For each value, ``op`` over all values before it: inside runs, then over the runs."""
    empty = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))

    def placed(run: Column) -> Column:
        return F.aggregate(run, empty, lambda acc, x: F.struct(
            op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def joined(runs: Column) -> Column:
        before = placed(F.transform(runs, lambda r: r["at"]))["out"]
        return F.flatten(F.zip_with(runs, before, lambda r, b: F.transform(r["out"], lambda x: op(b, x))))

    def in_runs(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int"))
        return let(F.transform(numbers, lambda i: placed(part(v, i * RUN, F.least((i + 1) * RUN, F.size(v))))), joined)

    return let(values, lambda v: F.when(F.size(v) <= RUN, placed(v)["out"]).otherwise(in_runs(v)))


def most_before(spans: Column) -> Column:
    """For each of the sorted spans, the largest end before it."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest, 0)


def wide(text: Column) -> Column:
    """A long text with four bytes a character; null for the others."""
    return F.when(F.char_length(text) > LONG, F.encode(text, "UTF-32"))


def cut(text: Column, at_width: Column, start: Column, n: Column) -> Column:
    """``n`` characters from ``start`` on."""
    return F.when(at_width.isNull(), F.substring(text, start + 1, n)).otherwise(
        F.decode(F.substring(at_width, start * 4 + 1, n * 4), "UTF-32"))


def found(text: Column, pattern: str, kind: str) -> Column:
    """All matches, leftmost and not overlapping, as structs of kind, start, end and match.

    The pieces between the matches give the positions.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)
    pairs = F.zip_with(matches, between, lambda m, p: F.struct(m.alias("m"), F.char_length(p).alias("p"), F.char_length(m).alias("n")))

    def placed(x: Column) -> Column:
        before = running(F.transform(x, lambda pair: pair["p"] + pair["n"]), lambda a, b: a + b, 0)
        return F.zip_with(x, before, lambda pair, at: F.struct(
            F.lit(kind).alias("kind"), (at + pair["p"]).alias("start"), (at + pair["p"] + pair["n"]).alias("end"), pair["m"].alias("value")))

    return let(F.filter(pairs, lambda x: x["m"].isNotNull()), placed)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    size = F.char_length(number)

    def step(total, i):
        d = F.substring(number, size - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), step) % 10 == 0


def small_parts(value: Column) -> Column:
    return F.forall(F.split(value, r"[^0-9]+"), lambda p: F.regexp_replace(p, "^0+", "").rlike(
        "^(?:|[1-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))


def valid(kind: str, value: Column) -> Column:
    """The rule that a match of the kind must pass."""
    number = digits(value)
    size = F.char_length(number)
    return {
        "email": F.lit(True),
        "ip": small_parts(value),
        "card": size.between(13, 19) & F.when(size.between(13, 19), luhn(number)).otherwise(False),
        "phone": size.between(9, 15),
    }[kind]


def _text(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``: the whole row in one struct, so that no name of it can clash."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _none() -> Column:
    return F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")


def matched(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text`` and per kind all base matches, whether they pass their rule or not."""
    text = F.col("text")
    tests = {"email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike("[0-9]\\."), "card": text.rlike("[0-9][\\x20-]?[0-9]")}
    return _text(docs).select("row", "doc_id", "text", wide(text).alias("wide"), *(
        F.when(tests[k], found(text, BASE[k], k)).otherwise(_none()).alias(k) for k in KINDS))


def with_base(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text, wide, base, failed``: the matches that pass and those that fail."""
    rows = matched(docs)

    def kept(kind, passes):
        return F.filter(kind, lambda m: valid(kind, m["value"]) == passes)

    passed, failed = [kept(k, True) for k in KINDS], [kept(k, False) for k in KINDS]
    return rows.select("row", "doc_id", "text", "wide", F.concat(*passed).alias("base"), F.concat(*failed).alias("failed"))


FEATURES = ("is_email", "is_ip", "is_card", "is_phone", "n_chars", "n_digits", "n_other", "rule", "before", "after", "cue", "sign")


def features(text: Column, c: Column) -> Column:
    """Format and surroundings of a candidate as a struct of doubles."""
    value, number = c["value"], digits(c["value"])
    start = F.greatest(c["start"] - AROUND, F.lit(0))
    before = cut(text, F.col("wide"), start, c["start"] - start)
    after = cut(text, F.col("wide"), c["end"], F.lit(1))
    rule = reduce(lambda rest, k: F.when(c["kind"] == k, valid(k, value)).otherwise(rest), KINDS, F.lit(False))
    values = {
        **{f"is_{k}": c["kind"] == k for k in KINDS},
        "n_chars": F.char_length(value), "n_digits": F.char_length(number),
        "n_other": F.char_length(F.regexp_replace(value, "[A-Za-z0-9]", "")), "rule": rule,
        "before": before.rlike(r"[\p{L}0-9=_/-]$"), "after": after.rlike(r"^[\p{L}0-9=_/-]"),
        "cue": before.rlike(CUE), "sign": value.startswith("+"),
    }
    return F.struct(*(values[n].cast("double").alias(n) for n in FEATURES))


def candidates(rows: DataFrame) -> DataFrame:
    """Adds ``proposed``: candidates of the generators that touch no base span, with their features."""
    text = F.col("text")
    digit = text.rlike("[0-9].?.?.?[0-9]")
    tests = {"email": text.rlike(r"[\[(]at[\])]|\x20@\x20"), "phone": digit, "ip": digit, "card": digit}
    raw = F.concat(*(
        F.when(tests[k], found(text, pattern, k)).otherwise(_none()) for k in KINDS for pattern in GENERATORS[k]))
    def apart(spans: Column) -> Column:
        return F.filter(F.array_distinct(spans), lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    free = let(raw, lambda spans: F.when(F.size(spans) <= RUN, apart(spans)).otherwise(free_of(spans, F.col("base"))))
    return rows.withColumn("proposed", F.transform(free, lambda c: F.struct(c.alias("span"), features(text, c).alias("f"))))


def free_of(spans: Column, base: Column) -> Column:
    """The distinct spans that touch no base span, by one pass over all of them in order."""
    def named(c: Column, is_base: bool) -> Column:
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(is_base).alias("base"), c.alias("span"))

    every = F.array_sort(F.concat(F.transform(base, lambda b: named(b, True)), F.transform(spans, lambda c: named(c, False))))

    def kept(x: Column) -> Column:
        ends = running(F.transform(x, lambda s: F.when(s["base"], s["end"]).otherwise(0)), F.greatest, 0)
        starts = F.reverse(running(F.reverse(F.transform(x, lambda s: F.when(s["base"], s["start"]).otherwise(FAR))), F.least, FAR))
        around = F.zip_with(ends, starts, lambda e, n: F.struct(e.alias("end"), n.alias("start")))
        same = F.zip_with(x, F.concat(F.array(F.lit(None)), F.slice(x, F.lit(1), F.size(x) - 1)), lambda s, last: s.eqNullSafe(last))
        marked = F.zip_with(F.zip_with(x, around, lambda s, a: F.struct(s.alias("s"), a.alias("a"))), same, lambda m, again: F.struct(m["s"].alias("s"), m["a"].alias("a"), again.alias("again")))
        good = F.filter(marked, lambda m: ~m["s"]["base"] & ~m["again"] & (m["a"]["end"] <= m["s"]["start"]) & (m["a"]["start"] >= m["s"]["end"]))
        return F.transform(good, lambda m: m["s"]["span"])

    return let(every, kept)


def examples(rows: DataFrame) -> DataFrame:
    """Labelled candidates: base matches that pass (1) or fail (0), proposals inside longer strings (0)."""
    text = F.col("text")

    def marked(spans, label):
        return F.transform(spans, lambda c: F.struct(c["kind"].alias("kind"), F.lit(label).alias("label"), features(text, c).alias("f")))

    inside = F.filter("proposed", lambda c: (c["f"]["before"] == 1) | (c["f"]["after"] == 1))
    wrong = F.transform(inside, lambda c: F.struct(c["span"]["kind"].alias("kind"), F.lit(0.0).alias("label"), c["f"].alias("f")))
    every = F.concat(marked(F.col("base"), 1.0), marked(F.col("failed"), 0.0), wrong)
    return rows.filter(F.size(every) > 0).select("doc_id", F.posexplode(every).alias("place", "x")).select(
        "x.kind", "x.label", "x.f.*", F.pmod(F.xxhash64("doc_id", "place"), F.lit(1 << 30)).alias("draw"))


def tree_column(node, f: Column) -> Column:
    """A fitted tree as nested conditions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(f[FEATURES[split.featureIndex()]] <= split.threshold(), tree_column(node.leftChild(), f)).otherwise(
        tree_column(node.rightChild(), f))


class Model:
    """The trees and one threshold per kind; without trees nothing is picked."""

    def __init__(self, trees=None, thresholds: dict[str, float] | None = None):
        self.trees, self.thresholds = trees, thresholds or {}

    def score(self, f: Column) -> Column:
        margin = reduce(lambda a, b: a + b, (
            tree_column(t._call_java("rootNode"), f) * w for t, w in zip(self.trees.trees, self.trees.treeWeights)))
        return 1 / (1 + F.exp(-2 * margin))

    def least(self, kind: Column) -> Column:
        return reduce(lambda rest, k: F.when(kind == k, self.thresholds[k]).otherwise(rest), self.thresholds, F.lit(2.0))


def grouped(table: DataFrame) -> DataFrame:
    """Examples that agree in everything as one row with their number ``n``, by fold: no example is left out.

    Features are small numbers and flags, so the rows are few, however many examples there are.
    """
    fold = F.pmod("draw", F.lit(CALIBRATION_FOLDS)).alias("fold")
    return table.groupBy("kind", "label", *FEATURES, fold).agg(F.count("*").alias("n"))


def fit(docs: DataFrame) -> Model:
    """Fit on every example; thresholds on every example, too, each scored by trees that learned without its fold."""
    table = stored(grouped(examples(candidates(with_base(docs)))), "pii-examples")
    seen = {(r["fold"], r["label"]) for r in table.select("fold", "label").distinct().collect()}
    folds = [k for k in range(CALIBRATION_FOLDS) if len({label for fold, label in seen if fold != k}) == 2]
    if not folds:
        return Model()
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, checkpointInterval=-1, weightCol="n")

    def held(k: int) -> DataFrame:
        return learner.fit(table.filter(F.col("fold") != k)).transform(table.filter(F.col("fold") == k))

    levels = reduce(DataFrame.unionByName, [held(k) for k in folds if any(fold == k for fold, _ in seen)]).groupBy(
        "kind", F.floor(vector_to_array("probability")[1] * 100).alias("level")).agg(
        F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("all")).collect()  # 101 a kind
    return Model(learner.fit(table), {k: calibrated([r for r in levels if r["kind"] == k]) for k in KINDS})


def calibrated(levels: list) -> float:
    """The least score from which on the candidates, scored by trees that did not learn from them, are right often enough."""
    best, good, total = 1.0, 0.0, 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        good, total = good + r["good"], total + r["all"]
        if good >= PRECISION * total:
            best = r["level"] / 100
    return max(LEAST_SCORE, best) if levels else LEAST_SCORE


def detect(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``row, doc_id, text, base, spans``: base spans and all spans, as arrays of kind, start, end and value.

    Both are in the order of ``KINDS``, then start.
    """
    model = model or fit(docs)
    rows = with_base(docs)
    if model.trees is None:
        return rows.select("row", "doc_id", "text", ordered("base").alias("base"), ordered("base").alias("spans"))
    rows = candidates(rows)
    scored = F.transform("proposed", lambda c: F.struct(
        (-model.score(c["f"])).alias("cost"), c["span"].alias("span"), model.least(c["span"]["kind"]).alias("least")))
    picked = F.array_sort(F.filter(scored, lambda c: -c["cost"] >= c["least"]))
    # Without candidates, as in most texts, nothing of this is evaluated.
    added = F.when(F.size("proposed") == 0, _none()).otherwise(
        let(picked, lambda p: F.when(F.size(p) <= RUN, best_of(p)).otherwise(best_of_groups(p))))
    return rows.select("row", "doc_id", "text", "base", added.alias("added")).select(
        "row", "doc_id", "text", ordered("base").alias("base"), ordered(F.concat("base", "added")).alias("spans"))


def best_of(picks: Column) -> Column:
    """The spans of picks sorted by cost, each if it overlaps none before it."""
    def add(taken, c):
        clash = F.exists(taken, lambda t: (t["start"] < c["span"]["end"]) & (c["span"]["start"] < t["end"]))
        return F.when(clash, taken).otherwise(F.concat(taken, F.array(c["span"])))

    return F.aggregate(picks, _none(), add)


def best_of_groups(picks: Column) -> Column:
    """The same for many picks: only those in one run of overlapping spans have to do with each other."""
    in_order = F.array_sort(F.transform(picks, lambda c: F.struct(c["span"]["start"].alias("start"), c["span"]["end"].alias("end"), c.alias("pick"))))

    def parted(x: Column) -> Column:
        first = F.zip_with(x, most_before(x), lambda s, end: s["start"] >= end)
        places = F.filter(F.zip_with(first, F.sequence(F.lit(0), F.size(x) - 1), lambda f, i: F.when(f, i)), lambda i: i.isNotNull())

        def each(at: Column) -> Column:
            following = F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(x)))
            groups = F.zip_with(at, following, lambda i, j: part(x, i, j))
            return F.flatten(F.transform(groups, lambda g: best_of(F.array_sort(F.transform(g, lambda s: s["pick"])))))

        return let(places, each)

    return let(in_order, parted)


def ordered(spans) -> Column:
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.concat(*(F.array_sort(of_kind(spans, k)) for k in KINDS))


def of_kind(spans, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found_rows: DataFrame) -> DataFrame:
    """``doc_id``, base counts, the hash of the base spans and the list of all spans."""
    return found_rows.select(
        "doc_id", *(F.size(of_kind("base", k)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redacted(text: Column, at_width: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones as one, replaced by the kind in brackets."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def joined(x: Column) -> Column:
        pieces = F.zip_with(x, most_before(x), lambda s, at: F.when(s["start"] >= at, F.concat(
            cut(text, at_width, at, s["start"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(""))
        last = F.array_max(F.transform(x, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), cut(text, at_width, last, F.char_length(text) - last))

    return F.when(F.size(spans) == 0, text).otherwise(let(in_order, joined))


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All rows with all columns; ``text`` without its spans, ``n_chars``, if there, counted anew. A null text stays null."""
    rows = detect(docs, model).withColumn("wide", wide(F.col("text")))
    rows = rows.withColumn("clean", F.when(F.col("row.text").isNotNull(), redacted(F.col("text"), F.col("wide"), F.col("spans"))))
    new = {"text": F.col("clean"), "n_chars": F.coalesce(F.char_length("clean"), F.lit(0))}
    return rows.select(*(
        (new[f.name].cast(f.dataType) if f.name in new else F.col(f"row.`{f.name}`")).alias(f.name) for f in docs.schema))
