"""Operator 7: personal data by candidate gradient boosting (DataFrame functions only).

Base spans come from four patterns with their checks (number ranges, Luhn, digit counts).
They always stay.  High-recall generators propose further, overlapping spans: loose numbers,
numbers by format (national grouping, dotted, digits only) that may lie inside the loose ones,
and loose addresses ("name (at) host (dot) com").  Of accepted spans that overlap the best scored stays.  A boosted-tree classifier judges each
candidate by its format (length, digits, groups, separators) and its context (the characters
and words around it).  It learns from the corpus itself by labelling functions: a candidate is
positive if it coincides with a base span, if it is an address once "(at)" and "(dot)" are
written out, or if it has the grouping of a national phone number; else negative.  The checks
are no features, so candidates that look and stand like personal data but miss a check
by a digit score high, too.
All documents' candidates are counted by feature vector and fold; the features are small
bounded integers, so the trees learn from a bounded table of weighted vectors that covers the
whole corpus.  On the held-out fold, the lowest score from which on the precision stays above
``PRECISION`` becomes the threshold (none: nothing is added).  The trees are written as one
column expression, and texts are scored map-only.

Positions: every match is wrapped in \\x01 by ``regexp_replace``, the text is split there, and
running sums of the pieces' lengths (two-level, so that many matches don't cost their
square) are the offsets, in code points.  A \\x01 of the text itself counts as another control
character.  The patterns use possessive loops and start only at edges of their character
runs (or where the last match ended), which finds the same matches without backtracking; groups are repeated
possessively or a bounded number of times, so the depth of a match doesn't grow with its length.

Cases: null and empty texts have no spans; matches that fail their check are dropped without
retry; repeated rows and null ids each give their row; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

KINDS = ("email", "ip", "card", "phone")
EMAIL_RUN = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{EMAIL_RUN})|\G){EMAIL_RUN}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE_NUMBER = r"(?<![0-9A-Za-z.])[+(]?[0-9][0-9\x20().-]{5,40}[0-9](?![0-9A-Za-z])"
LOOSE_ADDRESS = (rf"(?<!{EMAIL_RUN}){EMAIL_RUN}{{1,64}}(?:@|\x20?(?:\(at\)|\[at\])\x20?)[A-Za-z0-9-]{{1,63}}"
                 r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63})++")
#: Numbers by format, whose matches may lie inside or across those of LOOSE_NUMBER.
FORMATS = {
    "national": r"(?<![0-9A-Za-z])(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "run": r"(?<![0-9A-Za-z])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){2,4}|[0-9]{7,19})(?![0-9A-Za-z])",
}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = (r"(?i)(?:tel|phone|fon|call|mobile|cell|fax|mail|contact|card|visa|account|konto|iban|ip|addr|address|host|server)\W{0,3}$")
MARK, OTHER = "\x01", "\x02"
BLOCK = 1000  # pieces summed in one list
TREES, TREE_DEPTH, SEED = 12, 4, 7
PRECISION = 0.9
FOLD = 5  # every fifth document calibrates
ARRAY = "array<struct<start:int,stop:int,kind:string,said:string,before:string,after:string>>"


def running_starts(lengths: Column) -> Column:
    """Sums of the lengths before each element (and of all, at the end)."""
    def sums(part: Column) -> Column:
        zero = F.array(F.lit(0))
        return F.aggregate(part, zero, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    n_blocks = F.ceil(F.size(lengths) / BLOCK).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    firsts = sums(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x)))
    return F.flatten(F.zip_with(parts, firsts, lambda p, first: F.when(p.isNotNull(), F.transform(
        F.slice(sums(p), 1, F.size(p)), lambda s: s + first)).otherwise(F.array(first))))


def pieces(text: Column, pattern: str) -> Column:
    """The text cut before and after every match: matches are the elements at odd places (from 0)."""
    return F.split(F.regexp_replace(text, F.lit(f"(?:{pattern})"), F.lit(f"{MARK}$0{MARK}")), MARK, -1)


def located(cut: Column, starts: Column, kind: str) -> Column:
    """Matches as structs with positions and the text around them."""
    def one(i: Column) -> Column:
        said = F.get(cut, i)
        first = F.get(starts, i)
        return F.struct(first.alias("start"), (first + F.char_length(said)).alias("stop"), F.lit(kind).alias("kind"), said.alias("said"),
                        F.right(F.get(cut, i - 1), F.lit(16)).alias("before"), F.left(F.get(cut, i + 1), F.lit(4)).alias("after"))

    return F.when(F.size(cut) > 1, F.transform(F.sequence(F.lit(1), F.size(cut) - 2, F.lit(2)), one)).otherwise(F.array().cast(ARRAY)).cast(ARRAY)


def digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), add) % 10 == 0


CHECKS = {
    "email": lambda s: F.lit(True),
    "ip": lambda s: s["said"].rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": lambda s: F.when(F.char_length(digits(s["said"])).between(12, 19), luhn(digits(s["said"]))).otherwise(F.lit(False)),
    "phone": lambda s: F.char_length(digits(s["said"])).between(9, 15),
}


def with_spans(docs: DataFrame, text_col: str) -> DataFrame:
    """The documents with columns __base (checked spans) and __loose (candidates)."""
    patterns = PATTERNS | {"number": LOOSE_NUMBER, "address": LOOSE_ADDRESS} | FORMATS
    out = docs.withColumn("__text", F.translate(F.coalesce(F.col(text_col), F.lit("")), MARK, OTHER))
    out = out.withColumns({f"__cut_{k}": pieces(F.col("__text"), p) for k, p in patterns.items()})
    out = out.withColumns({f"__at_{k}": F.when(F.size(f"__cut_{k}") > 1, running_starts(F.transform(f"__cut_{k}", F.char_length))) for k in patterns})
    out = out.withColumns({f"__all_{k}": located(F.col(f"__cut_{k}"), F.col(f"__at_{k}"), "number" if k in FORMATS else k) for k in patterns})
    out = out.withColumn("__base", F.array_sort(F.concat(*[F.filter(f"__all_{k}", CHECKS[k]) for k in KINDS]), in_order))
    out = out.withColumn("__loose", F.array_distinct(F.concat("__all_number", "__all_address", *[f"__all_{k}" for k in FORMATS])))
    return out.drop("__text", *[f"__{x}_{k}" for x in ("cut", "at", "all") for k in patterns])


def rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def in_order(a: Column, b: Column) -> Column:
    """By start, then kind in the listed order."""
    by_kind = rank(a["kind"]) - rank(b["kind"])
    return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(by_kind).cast("int")


def features(s: Column) -> list[Column]:
    """Bounded small integers that describe a candidate's format and context."""
    said, before, after = s["said"], s["before"], s["after"]
    number = digits(said)
    flag = lambda c: c.cast("int")
    side = lambda c: F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike("^[A-Za-z]$"), 2).when(c.rlike("^[0-9]$"), 3).when(c.rlike("^[=:#\"']$"), 4).otherwise(5)
    return [flag(s["kind"] == "address"), F.least(F.char_length(number), F.lit(21)), F.least(F.size(F.split(said, "[^0-9]+")), F.lit(7)),
            flag(said.contains("(")), F.least(F.size(F.split(said, r"\.")), F.lit(6)), F.least(F.size(F.split(said, "-")), F.lit(5)),
            F.least(F.size(F.split(said, " ")), F.lit(7)), F.least(F.floor(F.char_length(said) / 4), F.lit(12)).cast("int"),
            flag(said.startswith("0")), side(F.right(before, F.lit(1))), side(F.left(after, F.lit(1))), flag(before.rlike(CONTEXT))]


N_FEATURES = 12


def weak_label(c: Column) -> Column:
    """Labelling functions beyond the base spans: spelt-out addresses, national phone grouping."""
    plain = F.regexp_replace(F.regexp_replace(c["said"], r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
    address = (c["kind"] == "address") & plain.rlike(r"^[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++$")
    return address | (c["kind"] == "number") & c["said"].rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$")


def training_table(spanned: DataFrame, id_col: str) -> DataFrame:
    """(fold, x, y, n): how often each feature vector occurs, labelled personal data (1) or not (0)."""
    same = lambda c: (F.exists("__base", lambda b: (b["start"] == c["start"]) & (b["stop"] == c["stop"])) | weak_label(c)).cast("int")
    seen = spanned.select((F.pmod(F.xxhash64(id_col), F.lit(FOLD)) == 0).alias("fold"),
                          F.explode(F.transform("__loose", lambda c: F.struct(F.array(*features(c)).alias("x"), same(c).alias("y")))).alias("c"))
    return saved(seen.groupBy("fold", "c.x", "c.y").agg(F.count("*").alias("n")))


NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>|in|not in) (.*)\)$|^(\s*)Predict: (\S+)$")


def tree_column(lines: list[str], x: list[Column]) -> Column:
    """One regression tree's debug text as a nested CASE expression."""
    m = NODE.match(lines.pop(0))
    if m[7]:
        return F.lit(float(m[7]))
    below = tree_column(lines, x)
    lines.pop(0)  # Else
    above = tree_column(lines, x)
    return F.when(x[int(m[3])] <= float(m[5]), below).otherwise(above)


def margin(model, x: list[Column]) -> Column:
    """The boosted trees' weighted sum."""
    total = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights):
        total = total + F.lit(float(weight)) * tree_column([line for line in tree.toDebugString.splitlines()[1:] if line.strip()], x)
    return total


def learn(table: DataFrame) -> tuple | None:
    """(model, threshold) or None if the corpus has not both classes or no threshold holds."""
    held = table.where("fold")
    train = table.where("not fold")
    if train.select("y").distinct().count() < 2 or held.isEmpty():
        return None
    vectors = lambda t: t.select(array_to_vector(F.col("x").cast("array<double>")).alias("features"), F.col("y").cast("double").alias("label"),
                                 F.col("n").cast("double").alias("weight"))
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, weightCol="weight", seed=SEED).fit(saved(vectors(train)))
    x = [F.get("x", k) for k in range(N_FEATURES)]
    scored = held.select(F.round(margin(model, x), 9).alias("s"), "y", "n").groupBy("s").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("hits"))
    # at most one row per leaf combination of the trees over the bounded vectors
    best, n, hits = None, 0, 0
    for row in scored.orderBy(F.desc("s")).toLocalIterator():
        n, hits = n + row["n"], hits + row["hits"]
        if hits < PRECISION * n:
            break
        best = row["s"]
    return None if best is None else (model, best)


def added(model_and_threshold: tuple | None) -> Column:
    """Accepted candidates that touch no base span and no better accepted one, as (start, stop, kind).

    Better is the higher score, then the shorter and the earlier one.
    """
    if model_and_threshold is None:
        return F.array().cast("array<struct<start:int,stop:int,kind:string>>")
    model, least = model_and_threshold
    free = lambda c: ~F.exists("__base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))
    vectors = F.transform(F.filter("__loose", free), lambda c: F.struct(c.alias("c"), F.array(*features(c)).alias("x")))
    scored = F.transform(vectors, lambda v: F.struct(
        (-F.round(margin(model, [F.get(v["x"], k) for k in range(N_FEATURES)]), 9)).alias("worse"),
        (v["c"]["stop"] - v["c"]["start"]).alias("length"), v["c"]["start"].alias("start"), v["c"].alias("c")))
    best_first = F.array_sort(F.filter(scored, lambda v: v["worse"] <= -least))
    good = F.aggregate(best_first, F.filter(best_first, lambda v: F.lit(False)), lambda kept, v: F.when(
        F.exists(kept, lambda k: (k["start"] < v["c"]["stop"]) & (v["start"] < k["c"]["stop"])), kept).otherwise(F.concat(kept, F.array(v))))
    kind = lambda c: F.when(c["kind"] == "address", "email").when(c["said"].rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip").when(
        F.char_length(digits(c["said"])) >= 12, "card").otherwise("phone")
    return F.transform(good, lambda v: F.struct(v["c"]["start"].alias("start"), v["c"]["stop"].alias("stop"), kind(v["c"]).alias("kind")))


def judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents with columns __base and __spans (base and added, in order)."""
    learned = learn(training_table(with_spans(docs.select(id_col, text_col), text_col), id_col))
    spanned = with_spans(docs, text_col)
    plain = F.transform("__base", lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("stop"), b["kind"].alias("kind")))
    spanned = spanned.withColumn("__added", F.when(F.size("__loose") > 0, added(learned)).otherwise(added(None)))
    return spanned.withColumn("__spans", F.array_sort(F.concat(plain, "__added"), in_order)).drop("__added", "__loose")


def listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all)."""
    out = judged(docs.select(id_col, text_col), id_col, text_col)
    of_kind = lambda k: F.size(F.filter("__base", lambda b: b["kind"] == k))
    counts = [of_kind(k).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select(id_col, *counts, F.sha2(listed("__base").cast("binary"), 256).alias("base_sha256"), listed("__spans").alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with every span replaced by its kind in brackets; overlapping spans become one."""
    out = judged(docs, id_col, text_col)
    none = F.array().cast("array<struct<start:int,stop:int,kind:string>>")

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"), last["kind"].alias("kind"))
        touches = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] > s["start"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    out = out.withColumn("__apart", F.aggregate("__spans", none, merge))
    text = F.col(text_col)
    before = F.transform("__apart", lambda s, i: F.concat(
        F.substring(text, F.when(i == 0, 0).otherwise(F.get(F.col("__apart"), i - 1)["stop"]) + 1,
                    s["start"] - F.when(i == 0, 0).otherwise(F.get(F.col("__apart"), i - 1)["stop"])),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    rest = F.substring(text, F.element_at("__apart", -1)["stop"] + 1, F.char_length(text))
    clean = F.when(F.size("__apart") > 0, F.concat(F.array_join(before, ""), rest)).otherwise(text)
    return out.withColumn(text_col, clean).select(docs.columns)
