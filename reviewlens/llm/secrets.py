"""Secrets in texts: fixed patterns, and a battery of randomness tests. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import let, running, text_or_empty

#: Kinds in the order in which spans of one start are listed. Fixed values.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# Shorter runs than these would be dropped, and a run's tail is shorter still: same as dropping them later.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGNED = 8
#: Strings that the randomness tests look at, and the alphabets they may be written in.
LEAST = 24
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base32lower": UPPER.lower() + "234567",
    "base36": DIGITS + UPPER.lower(),
    "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + UPPER.lower(),
    "base64": UPPER + UPPER.lower() + DIGITS + "+/",
    "base64url": UPPER + UPPER.lower() + DIGITS + "-_",
}
#: Digits and both cases, or digits and letters: without them a string is a word or a number.
MIXED = {
    "hex": "(?=.*[0-9]).*[a-f]",
    "HEX": "(?=.*[0-9]).*[A-F]",
    "base32": "(?=.*[2-7]).*[A-Z]",
    "base32lower": "(?=.*[2-7]).*[a-z]",
    "base36": "(?=.*[0-9]).*[a-z]",
    "BASE36": "(?=.*[0-9]).*[A-Z]",
    "base62": "(?=.*[0-9])(?=.*[A-Z]).*[a-z]",
    "base64": "(?=.*[0-9])(?=.*[A-Z]).*[a-z]",
    "base64url": "(?=.*[0-9])(?=.*[A-Z]).*[a-z]",
}
#: Bins per factor of ten of a p-value, and the number of bins.
BINS, MOST = 20, 400

def located(df: DataFrame, text: str, pattern: str, out: str, group: int = 0) -> DataFrame:
    """Adds ``out``: ``start``, ``end`` (code points) and ``value`` (a group) of all matches, from the left.

    The pieces between the matches and the matches themselves follow each other, so running sums of
    their lengths give the places.
    """
    hit = F.col(text).rlike(pattern)
    none = F.array().cast("array<string>")
    df = df.withColumns(
        {
            "_between": F.when(hit, F.split(F.col(text), pattern, -1)).otherwise(none),
            "_found": F.when(hit, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none),
            "_value": F.when(hit, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))).otherwise(none),
        }
    )
    df = df.withColumn("_gap", F.transform(F.slice("_between", 1, F.size("_found")), lambda x: F.length(x)))
    df = df.withColumn("_long", F.transform("_found", lambda x: F.length(x)))
    both = F.zip_with("_gap", "_long", lambda a, b: a + b)
    df = df.withColumn("_both", both)
    df = df.withColumn("_at", F.when(F.size("_both") > 0, running(F.col("_both"))).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_start", F.zip_with("_at", "_gap", lambda a, b: a + b))
    spans = F.transform(
        F.arrays_zip("_start", "_long", "_value"),
        lambda x: F.struct(
            x["_start"].alias("start"), (x["_start"] + x["_long"]).alias("end"), x["_value"].alias("value")
        ),
    )
    return df.withColumn(out, spans).drop("_between", "_found", "_value", "_gap", "_long", "_both", "_at", "_start")


def upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, by a rational approximation (error below 1e-7)."""
    a = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * a)
    tail = F.lit(1.330274429)
    for c in (-1.821255978, 1.781477937, -0.356563782, 0.319381530):
        tail = tail * t + c
    tail = tail * t * F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def extended(items: Column, names: list[str], **more) -> Column:
    """An array of structs with fields ``names``, each struct extended by functions of it."""
    return F.transform(
        items, lambda c: F.struct(*[c[n].alias(n) for n in names], *[make(c).alias(n) for n, make in more.items()])
    )


def battery(items: Column, names: list[str]) -> Column:
    """``items`` with ``p``: how likely a uniform random string is to look as regular as ``codes``.

    ``codes`` are letter numbers of an alphabet of ``k`` letters. Fisher's combination of three
    tests: chi-squared of the letter counts, with its exact mean and variance at this length; the
    number of runs above and below the middle letter; and the correlation of neighbours. Each stage
    adds fields that the next one reads, so nothing is computed twice.
    """

    def total(array: Column, f=lambda x: x) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda s, x: s + f(x))

    def squared_counts(c: Column) -> Column:
        count = lambda v: F.size(F.filter(c["codes"], lambda x: x == v)).cast("double")
        return total(F.transform(F.transform(F.array_distinct(c["codes"]), count), lambda n: n * n))

    def neighbours(c: Column, f) -> Column:
        pairs = F.size(c["codes"]) - 1
        return total(F.zip_with(F.slice(c["codes"], F.lit(1), pairs), F.slice(c["codes"], F.lit(2), pairs), f))

    stages = (
        {
            "n": lambda c: F.size(c["codes"]).cast("double"),
            "sum": lambda c: total(c["codes"]),
            "squares": lambda c: total(c["codes"], lambda x: x * x),
            "counts": squared_counts,
            "high": lambda c: F.size(F.filter(c["codes"], lambda x: x >= c["k"] / 2)).cast("double"),
            "turns": lambda c: neighbours(c, lambda x, y: F.when((x >= c["k"] / 2) == (y >= c["k"] / 2), 0.0).otherwise(1.0)),
        },
        {
            "mean": lambda c: c["sum"] / c["n"],
            "product": lambda c: 2 * c["high"] * (c["n"] - c["high"]),
        },
        {
            "z_chi": lambda c: (c["counts"] * c["k"] / c["n"] - c["n"] - (c["k"] - 1))
            / F.sqrt(2 * (c["k"] - 1) * (1 - 1 / c["n"])),
            "spread": lambda c: c["product"] * (c["product"] - c["n"]) / (c["n"] * c["n"] * (c["n"] - 1)),
            "square": lambda c: c["squares"] - c["n"] * c["mean"] * c["mean"],
            "cross": lambda c: neighbours(c, lambda x, y: (x - c["mean"]) * (y - c["mean"])),
        },
        {
            "z_runs": lambda c: F.when(c["spread"] > 0, F.abs(c["turns"] - 1 - c["product"] / c["n"]) / F.sqrt(c["spread"])),
            "z_serial": lambda c: F.when(c["square"] > 0, F.abs(c["cross"] / c["square"] + 1 / c["n"]) * F.sqrt(c["n"])),
        },
        {
            "p_chi": lambda c: upper_tail(c["z_chi"]),
            "p_runs": lambda c: F.coalesce(2 * upper_tail(c["z_runs"]), F.lit(0.0)),
            "p_serial": lambda c: F.coalesce(2 * upper_tail(c["z_serial"]), F.lit(0.0)),
        },
        {
            "half": lambda c: -sum((F.log(F.greatest(c[p], F.lit(1e-100))) for p in ("p_chi", "p_runs", "p_serial")), F.lit(0.0)),
        },
        {"p": lambda c: F.exp(-c["half"]) * (1 + c["half"] + c["half"] * c["half"] / 2)},
    )
    for stage in stages:
        items = extended(items, names, **stage)
        names = [*names, *stage]
    return items


def encoding_of(value: Column) -> Column:
    """The first alphabet that a string keeps to and looks mixed in, or null."""
    found = F.lit(None).cast("string")
    for name, letters in reversed(ALPHABETS.items()):
        inside = f"^[{letters.replace('-', chr(92) + '-')}]*$"
        found = F.when(F.regexp_like(value, F.lit(inside)) & F.regexp_like(value, F.lit(MIXED[name])), name).otherwise(found)
    return found


def parts(run: Column) -> Column:
    """The parts of a run (``start``, ``value``) between ``/ + - _`` that are long enough for the tests."""
    found = F.split(run["value"], "[/+_-]", -1)
    begin = running(F.transform(found, lambda x: F.length(x) + 1))
    spans = F.zip_with(
        found, begin,
        lambda x, at: F.struct((run["start"] + at).alias("start"), (run["start"] + at + F.length(x)).alias("end"), x.alias("value")),
    )
    return F.filter(spans, lambda c: F.length(c["value"]) >= LEAST)


def with_candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: ``start, end, class, p`` of the strings that may be random.

    A run that has no encoding as a whole is tested in its parts. ``class`` joins the inferred encoding and the power of two of the length.
    """
    df = located(docs, text, CANDIDATE, "_cand")
    fields = ["start", "end", "value"]
    coded = extended(F.col("_cand"), fields, encoding=lambda c: encoding_of(c["value"]))
    df = df.withColumn("_cand", coded)
    rest = F.filter("_cand", lambda c: c["encoding"].isNull())
    df = df.withColumn("_part", F.flatten(F.transform(rest, parts)))
    part = extended(F.col("_part"), fields, encoding=lambda c: encoding_of(c["value"]))
    df = df.withColumn("_cand", F.filter(F.concat("_cand", part), lambda c: c["encoding"].isNotNull())).drop("_part")
    letters = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    spelled = extended(
        F.col("_cand"),
        ["start", "end", "value", "encoding"],
        letters=lambda c: F.element_at(letters, c["encoding"]),
    )
    number = lambda c: F.transform(F.split(c["value"], ""), lambda x: (F.position(x, c["letters"]) - 1).cast("double"))
    items = extended(
        spelled,
        ["start", "end"],
        **{
            "class": lambda c: F.concat_ws("-", c["encoding"], F.floor(F.log2(F.length(c["value"])))),
            "k": lambda c: F.length(c["letters"]).cast("double"),
            "codes": lambda c: F.filter(number(c), lambda x: x >= 0),
        },
    )
    tested = battery(items, ["start", "end", "class", "k", "codes"])
    return df.withColumn(out, extended(tested, ["start", "end", "class", "p"])).drop("_cand")


def ordinary_below(docs: DataFrame, text: str = "text", rate: float = 0.05) -> dict[str, float]:
    """For each class of strings, the p-value up to which randomness is rejected.

    Benjamini-Hochberg over all strings of a class in the corpus, classes being lengths (powers of
    two) of one encoding: of the strings cleared as ordinary, a share of ``rate`` at most is random.
    p-values are counted in bins, of which there are few whatever the corpus, and a bin counts by
    its upper edge, so the rate holds.
    """
    df = with_candidates(docs.select(text_or_empty(text).alias("_text")), "_text", "_tested")
    # A plain explode would be given a filter that evaluates all tests a second time.
    rows = df.select(F.explode_outer("_tested").alias("c")).filter("c IS NOT NULL").select("c.class", "c.p")
    bin_ = F.least(F.floor(-F.log10(F.greatest("p", F.lit(1e-100))) * BINS), F.lit(MOST)).cast("int")
    counts = rows.groupBy("class", bin_.alias("bin")).agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("class")
    seen = counts.withColumns(
        {
            "upto": F.sum("n").over(of_class.orderBy(F.desc("bin"))),
            "all": F.sum("n").over(of_class),
            "edge": F.pow(F.lit(10.0), -F.col("bin") / BINS),
        }
    )
    passed = seen.filter(F.col("edge") <= rate * F.col("upto") / F.col("all"))
    return {r["class"]: r["edge"] for r in passed.groupBy("class").agg(F.max("edge").alias("edge")).collect()}


def scan(
    docs: DataFrame, text: str = "text", thresholds: dict[str, float] | None = None, out: str = "secret_spans"
) -> DataFrame:
    """``docs`` with spans in column ``out``: sorted structs ``start, order, end, kind`` (code points, end exclusive).

    ``assign``, ``access`` and ``hex`` are the fixed patterns, each leftmost and without overlap
    among its kind. ``random`` spans are strings in an inferred encoding for which the tests did not
    reject randomness at the corpus's false-discovery threshold (``thresholds``, from
    ``ordinary_below`` by default); those inside another span are left out.

    The threshold bounds the random strings among those cleared, that is the missed secrets. Nothing
    bounds the false reports: an ordinary string of mixed letters and digits that looks no more
    regular than chance, such as a long identifier, is reported.

    Whole texts are searched. A null text counts as empty and has no spans, like an empty table no
    rows; repeated rows get the same spans. A column of ``docs`` with the name ``out`` is replaced;
    all others are kept, whatever their names.
    """
    if thresholds is None:
        thresholds = ordinary_below(docs, text)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != out]
    # The given columns travel in one struct, so that no name of theirs can clash with those used here.
    given = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    df = docs.select(given.alias("_given"), text_or_empty(f"`{text}`").alias("_scanned"))
    df = located(df, "_scanned", ASSIGN, "_assign", 2)
    df = located(df, "_scanned", ACCESS, "_access")
    df = located(df, "_scanned", HEX, "_hex")
    df = with_candidates(df, "_scanned", "_random")
    df = df.withColumn("_assign", F.filter("_assign", lambda c: F.length(c["value"]) >= MIN_ASSIGNED))

    def span(kind: str):
        order = F.lit(KINDS.index(kind))
        return lambda c: F.struct(c["start"].alias("start"), order.alias("order"), c["end"].alias("end"), F.lit(kind).alias("kind"))

    random = F.col("_random")
    if thresholds:
        limits = F.create_map(*[F.lit(x) for pair in sorted(thresholds.items()) for x in pair])
        random = F.filter(random, lambda c: c["p"] > F.coalesce(F.try_element_at(limits, c["class"]), F.lit(0.0)))
    every = [F.transform(f"_{kind}", span(kind)) for kind in KINDS[:3]] + [F.transform(random, span("random"))]
    df = df.withColumn("_every", F.array_sort(F.concat(*every)))
    # In this order a span that another one holds comes after it: its end is no later than the latest so far.
    base_end = lambda c: F.when(c["order"] < len(KINDS) - 1, c["end"]).otherwise(0)
    df = df.withColumn("_reach", reach(F.transform("_every", base_end)))
    known = F.zip_with("_every", "_reach", lambda c, r: F.struct(c.alias("c"), r.alias("r")))
    kept = F.filter(known, lambda x: (x["c"]["order"] < len(KINDS) - 1) | (x["r"] < x["c"]["end"]))
    columns = [F.col("_given").getField(c).alias(c) for c in docs.columns if c != out]
    return df.select(*columns, F.transform(kept, lambda x: x["c"]).alias(out))


def reach(ends: Column) -> Column:
    """The greatest of all earlier items, for each item of an array of ints; 0 before the first."""
    none = F.array().cast("array<int>")
    return F.when(F.size(ends) > 0, running(ends, lambda a, x: F.greatest(a, x))).otherwise(none)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda c: c["kind"].isin(*kinds))


#: Marks that are put into one piece of a text.
MARKS = 256


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each run of overlapping or touching spans replaced by ``mark``.

    The gaps between the runs are cut out of pieces of the text with ``MARKS`` runs each and joined
    once, as finding a place in a text takes as long as the text before it.
    """
    place = lambda name: F.transform(spans, lambda c: c[name])
    placed = F.zip_with(place("start"), reach(place("end")), lambda s, r: F.struct(s.alias("start"), r.alias("reach")))
    # A run begins at each start beyond all earlier ends; the run before it ends where those reach.
    fresh = F.filter(placed, lambda c, i: (i == 0) | (c["start"] > c["reach"]))
    last = F.aggregate(spans, F.lit(0), lambda a, c: F.greatest(a, c["end"]))
    gaps = F.concat(fresh, F.array(F.struct(F.length(text).alias("start"), last.alias("reach"))))

    def cut(own: Column) -> Column:
        first, last_ = F.get(own, 0)["reach"], F.get(own, F.size(own) - 1)["start"]
        piece = F.array_repeat(F.struct(F.substring(text, first + 1, last_ - first).alias("text"), first.alias("at")), F.size(own))
        return F.zip_with(own, piece, lambda g, p: F.substring(p["text"], g["reach"] - p["at"] + 1, g["start"] - g["reach"]))

    def joined(gaps: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / MARKS).cast("int"))
        return F.array_join(F.flatten(F.transform(blocks, lambda b: let(F.slice(gaps, b * MARKS + 1, MARKS), cut))), mark)

    return F.when(F.size(spans) > 0, let(gaps, joined)).otherwise(text)
