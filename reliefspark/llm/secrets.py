"""Secret scanning and multipart credential linking, in DataFrame functions only.

Base kinds stand on their own: assignments to secret-like names, access identifiers and
long hexadecimal runs.  Weak kinds - endpoints, short assigned values and mixed-case
random-looking strings - say little alone; each is reported only where a complementary
part of a credential lies within SCOPE code points of it.  That interval join is a sweep:
rows sorted by start carry the furthest end of the parts before and the nearest start of
those behind, so no pairs are formed.

Positions are code points.  A pattern's matches and the text between them (the same
leftmost, non-overlapping walk) give lengths whose running sums are the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Code points between the edges of a weak part and of its complement, at most.
SCOPE = 300

#: (kind, pattern, group whose length counts, least length), in the order of the kinds.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
WEAK = (
    ("endpoint", r"(?:https?|ftp|jdbc:[a-z0-9]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9.:@/_%?&=+-]{4,}", 0, 10),
    ("random", r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*+[0-9])(?=[A-Z0-9+/]*+[a-z])(?=[a-z0-9+/]*+[A-Z])[A-Za-z0-9+/]{20,}", 0, 20),
)
KINDS = [k[0] for k in BASE] + ["short"] + [k[0] for k in WEAK]
#: Which kinds complete a weak one.
COMPLETES = {"short": ("access", "endpoint"), "endpoint": ("access", "assign"), "random": ("access", "endpoint")}
#: A short assigned value has this many characters at least (and fewer than a base one).
SHORT_LEAST = 4


def _gates(text: Column) -> dict[str, Column]:
    """What a text must hold, by plain search, for a kind's pattern to be tried at all.

    Weak kinds count beside a complement only: a random string or an endpoint needs an identifier, an endpoint or an assignment.
    """
    sign, access, endpoint = text.contains(":") | text.contains("="), text.contains("AKIA"), text.contains("://")
    return {"assign": sign, "access": access, "hex": F.lit(True), "endpoint": endpoint, "random": access | endpoint}


def _any_span(text: Column) -> Column:
    """False only for texts without spans: there is a base kind's or a short assignment's match, or an endpoint with a random string."""
    gate, pattern = _gates(text), {k: p for k, p, _, _ in (*BASE, *WEAK)}
    alone = [gate[k] & text.rlike(pattern[k]) for k in ("access", "assign", "hex")]
    both = gate["endpoint"] & text.rlike(pattern["endpoint"]) & text.rlike(pattern["random"])
    return F.coalesce(alone[0] | alone[1] | alone[2] | both, F.lit(False))


def _found(text: Column, gate: Column, kind: int, pattern: str, group: int, least: int) -> Column:
    """Of one pattern: array of (kind, n, gap before, length, counted length); the gap of row n follows match n - 1."""
    p = F.lit(pattern)
    matches = F.regexp_extract_all(text, p, F.lit(0))
    counted = F.regexp_extract_all(text, p, F.lit(group)) if group else matches
    gaps = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g"), counted.alias("c")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("n"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["c"]).alias("counted")),
    )
    # Without a match the text is not split a second time.
    return F.when(gate & text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<kind:int,n:int,gap:int,size:int,counted:int>>"))


def spans(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row per row of docs (keys..., text): keys..., spans = array of (start, kind number, kind, end, base, link).

    link: for a weak span, the start of the part before or behind it that completes it.
    A null or empty text has no spans; repeated rows keep a row each, whatever the keys' names. Spans of equal
    starts are ordered by kind; texts are read whole, however long; an empty table gives no rows.
    """
    names, own = keys, [f"key_{k}" for k in range(len(keys))]
    docs = docs.select(*[F.col(k).alias(x) for k, x in zip(names, own, strict=True)], "text")
    keys = own
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gates = _gates(F.col("text"))
    found = F.concat(*[_found(F.col("text"), gates[k], KINDS.index(k), p, g, n) for k, p, g, n in (*BASE, *WEAK)])
    # The row number is fixed by the input's partitions, so a repeated task numbers alike.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *keys, text.alias("text")).select("row", *keys, F.explode_outer(found).alias("f")).select("row", *keys, "f.*")
    rows = rows.repartition("row")
    walk = Window.partitionBy("row", "kind").orderBy("n")
    start = F.sum(F.col("gap").cast("long") + F.col("size")).over(walk) - F.col("size")
    rows = rows.withColumn("start", start).withColumn("end", F.col("start") + F.col("size"))
    least = F.when(F.lit(False), 0)
    for k, _, _, n in (*BASE, *WEAK):
        least = least.when(F.col("kind") == KINDS.index(k), n)
    short = (F.col("kind") == KINDS.index("assign")) & (F.col("counted") < BASE[0][3])
    rows = rows.withColumn("kind", F.when(short & (F.col("counted") >= SHORT_LEAST), KINDS.index("short")).when((F.col("counted") < least), None).otherwise(F.col("kind")))
    base = F.col("kind") < len(BASE)
    before = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    # Sweep state: the furthest base end before, the nearest base start behind, and both per completing kind.
    rows = rows.withColumn("covered", (F.coalesce(F.max(F.when(base, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (F.coalesce(F.min(F.when(base, F.col("start"))).over(behind), F.lit(1 << 60)) < F.col("end")))
    link: Column = F.lit(None).cast("long")
    for weak, parts in COMPLETES.items():
        mine = F.col("kind").isin(*[KINDS.index(k) for k in parts])
        last = F.max(F.when(mine, F.struct("end", "start"))).over(before)
        following = F.min(F.when(mine, F.col("start"))).over(behind)
        near = F.when(last["end"] >= F.col("start") - SCOPE, last["start"]).when(following <= F.col("end") + SCOPE, following)
        link = F.when(F.col("kind") == KINDS.index(weak), near).otherwise(link)
    rows = rows.withColumn("link", link)
    keep = F.col("kind").isNotNull() & (base | (F.col("link").isNotNull() & ~F.col("covered")))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.when(keep, F.struct("start", F.col("kind").alias("number"), name.alias("kind"), "end", base.alias("base"), "link"))
    return rows.groupBy("row").agg(*[F.first(k).alias(k) for k in keys], F.sort_array(F.collect_list(span)).alias("spans")).select(*[F.col(k).alias(x) for k, x in zip(own, names, strict=True)], "spans")


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, their digest and all spans as a string."""
    base = F.filter("spans", lambda s: s["base"])

    def count(k: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    counts = [count(k) for k, *_ in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def mask(docs: DataFrame) -> DataFrame:
    """docs with every span of `text` overwritten by as many asterisks; columns and rows stay, in no order.

    A null, empty or clean text stays as it is, and repeated rows stay; no column's name clashes. An empty table gives no rows.
    """
    key, found_spans = (f"__{name}{len(docs.columns)}_{max(map(len, docs.columns), default=0)}" for name in ("key", "spans"))
    text = F.col("text").cast("string")
    hit = _any_span(text)
    # Only texts that a pattern matches are shuffled. Equal texts have equal spans: one row for each, found by its digest.
    keyed = docs.filter(hit).withColumn(key, F.sha2(text.cast("binary"), 256))
    found = spans(keyed.select(key, "text"), [key]).filter(F.size("spans") > 0).groupBy(key).agg(F.first("spans").alias(found_spans))
    masked = F.aggregate(found_spans, text, lambda t, s: F.overlay(t, F.repeat(F.lit("*"), (s["end"] - s["start"]).cast("int")), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    changed = keyed.join(found, key, "left").withColumn("text", F.when(F.col(found_spans).isNotNull(), masked).otherwise(text))
    return docs.filter(~hit).withColumn("text", text).unionByName(changed.select(*docs.columns))
