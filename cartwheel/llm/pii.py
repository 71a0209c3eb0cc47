"""Personal data: exact base patterns, and bootstrapped contextual extraction.

Base spans are the leftmost non-overlapping matches of four patterns, checked
by value. A fifth kind, ``secret``, has seeds by shape: a long hexadecimal
string, or a key with a public vendor prefix, that is assigned to a name. Base
spans and these seed the contextual method: the one and two words before a
seed, the word behind it, and the words on both sides are lexical patterns;
identifier-like tokens in a pattern are its instances. Over the graph of
patterns and distinct instances in all documents, a pattern's score is the
share of its instances that are known, an instance's score the noisy-or of its
patterns, for ROUNDS rounds. Patterns that stay at CONFIDENT with MIN_SEEDS
distinct seeds discover the unseen identifiers in them. DataFrame functions
only.

Defined results: a null text is empty and has no spans; equal rows get equal
results each; without seeds nothing is added; an empty table gives no rows;
other columns are ignored (``redact`` keeps them). Positions are code points.
The time of a text is near linear in its length and its matches. A word of
context counts by the CONTEXT_CHARS characters nearest to the place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import LOWER, UPPER, bind, materialise, of_columns, scan

KINDS = ("email", "ip", "card", "phone")
#: The kind that only the method adds, after the base kinds in the order of spans.
SECRET = "secret"
#: Anchored at the start of a run or the end of the match before, and possessive: the same leftmost matches as the
#: plain patterns (nothing could be given back), in time linear in the text and without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
# Shapes of machine secrets (a hash or key of 32 or more hex digits; prefixes that vendors publish).
SECRET_SHAPES = (r"(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}", r"AKIA[0-9A-Z]{16}", r"gh[pousr]_[A-Za-z0-9]{36,}")
#: A token by its shape, with = or : before it and a quote or nothing around it.
SECRET_TOKEN = r"[=:][\x20]{0,2}[\"']?$"
SECRET_VALUE = rf"^(?:{'|'.join(SECRET_SHAPES)})$"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: An unseen identifier has an @, this many digits, or digits and letters in a run this long.
MIN_DIGITS = 6
MIN_MIXED = 12
MIXED = rf"^(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{{{MIN_MIXED},}}$"
CONTEXT_CHARS = 64
MIN_SEEDS = 5
CONFIDENT = 0.8
ROUNDS = 3
#: Patterns sent to every task; beyond it they are shuffled.
BROADCAST_PATTERNS = 100_000
SPAN = "struct<kind:string,start:int,end:int>"


def matches(text: Column, pattern: str, context: bool = False) -> Column:
    """(start, end, value), with ``context`` also before and after, of each
    match: the gaps that ``split`` leaves give the positions."""
    def place(gaps: Column, found: Column) -> Column:
        def item(i: Column, before: Column) -> Column:
            gap, value = F.get(gaps, i), F.get(found, i)
            start = before + F.length(gap)
            near = [F.right(gap, F.lit(CONTEXT_CHARS)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(CONTEXT_CHARS)).alias("after")]
            return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), *(near if context else []))
        steps = F.transform(found, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))
        return F.transform(scan(steps, lambda a, b: a + b, F.lit(0)), lambda before, i: item(i, before))
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bind(gaps, lambda g: bind(found, lambda f: place(g, f)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    places = F.transform(F.split(F.reverse(number), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(places, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0))) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(digits(value))
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def base_matches(text: Column) -> Column:
    """Array of (kind, start, end, value) in the order of KINDS, then place."""
    def of_kind(kind: str) -> Column:
        good = F.filter(matches(text, PATTERNS[kind]), lambda m: valid(kind, m["value"]))
        at = F.transform(good, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
        may = F.lit(True) if kind == "email" else text.rlike("[0-9]")
        may = may & text.contains(NEEDS[kind]) if kind in NEEDS else may
        return F.when(may, at).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>"))
    return F.concat(*[of_kind(kind) for kind in KINDS])


def rows_of(documents: DataFrame) -> DataFrame:
    """(of, of_hash, text, base) of every row."""
    d = of_columns(documents, "doc_id", "text").select(
        F.col("doc_id").alias("of"), F.xxhash64("text").alias("of_hash"), F.coalesce("text", F.lit("")).alias("text"))
    return d.withColumn("base", base_matches(F.col("text")))


def context(before: Column, after: Column) -> Column:
    """The lexical patterns of a place: the last word before it, the last two,
    the first word behind it, and one word on both sides."""
    def plain(part: Column) -> Column:
        bare = F.regexp_replace(F.translate(part, UPPER, LOWER), r"[^\p{L}\p{N}]+", " ")
        return F.filter(F.split(bare, " "), lambda x: x != "")

    def patterns(left: Column, right: Column) -> Column:
        one, behind = F.element_at(left, -1), F.get(right, F.lit(0))
        two = F.when(F.size(left) > 1, F.concat_ws(" ", F.slice(left, -2, 2), F.lit("_")))
        return F.filter(F.array(F.concat_ws(" ", one, F.lit("_")), two, F.concat_ws(" ", F.lit("_"), behind),
                                F.concat_ws(" ", one, F.lit("_"), behind)), lambda p: p.isNotNull() & (p != "_"))
    return F.array_distinct(bind(plain(before), lambda left: bind(plain(after), lambda right: patterns(
        F.when(F.size(left) > 0, left), F.when(F.size(right) > 0, right)))))


def instances(documents: DataFrame) -> DataFrame:
    """(of, of_hash, start, end, value, kind, own, patterns): identifier-like
    tokens with the kind of the seed that starts in them, null for unseen
    ones; ``own`` marks seeds of the method's kind, which are spans too.

    A text's tokens and base spans meet in the order of their places: a span
    belongs to the token that began last before it, and a token that begins
    inside a span is a part of that."""
    text = F.coalesce("text", F.lit(""))
    item = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"
    tokens = F.when(text.rlike("[0-9@]"), F.transform(matches(text, TOKEN, context=True), lambda m: F.struct(
        F.lit(None).cast("string").alias("kind"), m["start"], m["end"], m["value"], m["before"], m["after"])))
    base = F.transform(base_matches(text), lambda b: F.struct(
        b["kind"], b["start"], b["end"], b["value"], F.lit(None).cast("string").alias("before"), F.lit(None).cast("string").alias("after")))
    none = F.array().cast(item)
    d = of_columns(documents, "doc_id", "text").select(
        F.col("doc_id").alias("of"), F.xxhash64("text").alias("of_hash"),
        F.explode(F.concat(F.coalesce(tokens.cast(item), none), base.cast(item))).alias("t"))
    one = Window.partitionBy("of", "of_hash")
    upto = one.orderBy("t.start", F.col("t.kind").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    is_token, token = F.col("t.kind").isNull(), F.struct("t.start", "t.end")
    t = d.distinct().withColumn("token", F.last(F.when(is_token, token), ignorenulls=True).over(upto))
    # a base span that begins where a token does comes behind it and isn't around it
    t = t.withColumn("within", F.max(F.when(~is_token, F.col("t.end"))).over(upto))
    seeds = t.where(~is_token & (F.col("t.start") < F.col("token.end"))).groupBy("of", "of_hash", "token").agg(
        F.min_by("t", F.struct("t.start", "t.kind")).alias("seed")).withColumnsRenamed({"of": "id", "of_hash": "id_hash", "token": "there"})
    t = t.where(is_token & (F.coalesce("within", F.lit(0)) <= F.col("t.start"))).join(
        seeds, F.col("of").eqNullSafe(F.col("id")) & F.col("of_hash").eqNullSafe(F.col("id_hash")) & (F.col("token") == F.col("there")), "left")
    lead = F.regexp_extract("t.value", r"^[^\p{L}\p{N}+]+", 0)
    bare = F.regexp_replace(F.regexp_replace("t.value", r"^[^\p{L}\p{N}+]+", ""), r"[^\p{L}\p{N}]+$", "")
    # name=value in one token: the value alone is the identifier
    t = t.withColumns({"lead": lead, "bare": bare}).withColumn("name", F.regexp_extract("bare", r"^[\p{L}_-]+(?:=|:)[\"']?(?=[^/])", 0))
    t = t.withColumn("lead", F.concat("lead", "name")).withColumn("bare", F.expr("substring(bare, length(name) + 1)"))
    secret = F.col("seed").isNull() & F.col("bare").rlike(SECRET_VALUE) & F.concat("t.before", "lead").rlike(SECRET_TOKEN)
    unseen = F.col("bare").contains("@") | (F.length(digits(F.col("bare"))) >= MIN_DIGITS) | F.col("bare").rlike(MIXED)
    start = F.coalesce("seed.start", F.col("t.start") + F.length("lead"))
    return t.where(F.col("seed").isNotNull() | secret | unseen).select(
        "of", "of_hash", start.alias("start"), F.coalesce("seed.end", start + F.length("bare")).alias("end"),
        F.coalesce("seed.value", "bare").alias("value"), F.coalesce("seed.kind", F.when(secret, F.lit(SECRET))).alias("kind"),
        secret.alias("own"), context(F.concat("t.before", "lead"), F.col("t.after")).alias("patterns"))


def score_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence) of the confident patterns."""
    edges = found.select(F.explode("patterns").alias("pattern"), "value", "kind").groupBy("pattern", "value").agg(F.max("kind").alias("kind"))
    support = edges.groupBy("pattern").agg(F.count("*").alias("total"), F.count("kind").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
    edges = materialise(edges.join(support.drop("seeds"), "pattern"), few=True)
    seeds = edges.where("kind is not null").select("value", "kind", F.lit(1.0).alias("known")).distinct()
    known, scored = seeds, None
    for _ in range(rounds):
        share = F.sum("known") / (F.first("total") + 1)
        scored = materialise(edges.select("pattern", "value", "total").join(known, "value").groupBy("pattern", "kind").agg(share.alias("confidence")), few=True)
        unlike = F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))
        derived = (edges.where("kind is null").select("pattern", "value").join(scored.where("confidence >= 0.5"), "pattern")
                   .groupBy("value", "kind").agg((1 - F.exp(F.sum(unlike))).alias("known")))
        known = seeds.unionByName(derived)
    return scored.where(F.col("confidence") >= CONFIDENT)


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """(of, of_hash, added): spans of unseen tokens in confident patterns, and
    the seeds that are not base spans."""
    patterns = materialise(patterns, few=True)
    n = patterns.count()
    side = F.broadcast(patterns) if n <= BROADCAST_PATTERNS else patterns
    unseen = found.where("kind is null").select("of", "of_hash", "start", "end", F.explode("patterns").alias("pattern"))
    best = F.max_by(F.col("kind"), F.struct("confidence", "kind")).alias("kind")
    behind = unseen.join(side, "pattern").groupBy("of", "of_hash", "start", "end").agg(best)
    own = found.where("own").select("of", "of_hash", "start", "end", "kind").distinct()
    return behind.unionByName(own).groupBy("of", "of_hash").agg(F.collect_set(F.struct("kind", "start", "end").cast(SPAN)).alias("added"))


def find(documents: DataFrame) -> DataFrame:
    """(of, of_hash, base, spans) of every row: base spans, and all spans."""
    base = rows_of(documents)
    found = materialise(instances(documents), few=True)
    added = discovered(found, score_patterns(found)).withColumnsRenamed({"of": "id", "of_hash": "id_hash"})
    plain = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]).cast(SPAN))
    own = base.select("of", "of_hash", plain.alias("base"))
    spans = F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    order = F.create_map(*[x for i, k in enumerate((*KINDS, SECRET)) for x in (F.lit(k), F.lit(i))])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.element_at(order, s["kind"]).alias("o"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return own.join(added, own["of"].eqNullSafe(added["id"]) & (own["of_hash"] == added["id_hash"]), "left").select(
        "of", "of_hash", "base", F.transform(keyed, lambda s: F.struct(s["kind"], s["start"], s["end"])).alias("spans"))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redact(documents: DataFrame, mark: str = "[{}]") -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in
    capitals; overlapping spans count as the first of them."""
    f = find(documents).where(F.size("spans") > 0).groupBy("of", "of_hash").agg(F.first("spans").alias("spans"))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = documents["text"]
    left, right = (F.lit(part) for part in mark.split("{}"))

    def replaced(spans: Column, chars: Column) -> Column:
        upto = scan(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(0))
        first = F.filter(F.zip_with(spans, upto, lambda s, m: F.struct(m.alias("from"), s["start"].alias("to"), s["kind"].alias("kind"))),
                         lambda r: r["to"] >= r["from"])  # the first of those that overlap
        pieces = F.transform(first, lambda r: F.concat(
            F.array_join(F.slice(chars, r["from"] + 1, r["to"] - r["from"]), ""), left, F.upper(r["kind"]), right))
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), F.array_join(F.slice(chars, end + 1, F.greatest(F.lit(0), F.size(chars) - end)), ""))
    done = bind(ordered, lambda spans: bind(F.split(text, ""), lambda chars: replaced(spans, chars)))
    clean = F.when(F.col("spans").isNull(), text).otherwise(done)
    on = documents["doc_id"].eqNullSafe(f["of"]) & (F.xxhash64(text) == f["of_hash"])
    return documents.join(f, on, "left").select(*[clean.alias("text") if c == "text" else documents[c] for c in documents.columns])
