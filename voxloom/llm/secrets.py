"""Secret scan in DataFrame functions only: fixed patterns and sliding-window entropy.

Patterns find assignments, access ids and long hex runs. The method adds candidate strings, runs
of one character class with a digit, in which some window of WINDOW characters has a Shannon
entropy of the class's threshold or more. Symbol counts of the window move with it, one symbol in and
one out, so a string costs one pass whatever the window. Strings on the allow list, and those inside a
pattern's span, are not added; a harmless word counts as one symbol repeated, and leaves the rest of its run as it is.
A hex run may stand after and before separators, so the value of KEY=value is measured by itself.

Everything is one narrow projection: no shuffle, no limit on a text's length. Offsets are code points.

Edge cases: a null or empty text has no spans and the digest of the empty string; rows that repeat
are reported each; spans of different kinds may overlap and all stay; equal starts go by kind in
the order of KINDS; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns of the base kinds; least length of the group named
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CUE = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

# fixed values: class, pattern of a candidate run, its alphabet, least bits of entropy a window must have
WINDOW = 20
CLASSES = (
    ("window_hex", r"(?<![A-Za-z0-9])(?<!(?i:sha(?:1|256|384|512))-)[0-9a-fA-F]{20,}(?![A-Za-z0-9])", "0123456789abcdefABCDEF", 3.0),
    ("window_base64", r"[A-Za-z0-9+/_=-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
)
# fixed values: strings that look random and are known to be harmless, as words in a run and as whole runs
HARMLESS = ("EXAMPLE", "0123456789", "abcdefghij")
ALLOWED = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^(sha(1|256|384|512)-|data:|iVBORw0KGgo)|^[^0-9]*$"
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
_SPAN = "array<struct<start:bigint,rank:int,stop:bigint,kind:string,found:string>>"


def _located(text: Column, pattern: str, kind: str, group: Column | None = None, least: int = 0) -> Column:
    """Spans of all matches, from the pieces between them; those whose group is shorter than least are dropped."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.transform(group, lambda g: F.length(g)) if group is not None else F.transform(matches, lambda m: F.length(m))
    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), size.alias("size"))

    def step(seen: Column, x: Column) -> Column:
        start = seen["at"] + F.length(x["piece"])
        stop = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.array(F.struct(start.cast("bigint").alias("start"), F.lit(KINDS.index(kind)).cast("int").alias("rank"), stop.cast("bigint").alias("stop"), F.lit(kind).alias("kind"), x["match"].alias("found"))).cast(_SPAN)
        return F.struct(stop.cast("bigint").alias("at"), F.when(F.coalesce(x["size"], F.lit(-1)) >= least, F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    return F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("spans")), step, lambda s: s["spans"])


def _entropic(found: Column, alphabet: str, bits: float) -> Column:
    """struct(first, last): starts of the first and the last window of at least `bits` entropy; null if there is none."""
    plain = found
    for word in HARMLESS:
        plain = F.regexp_replace(plain, f"(?i){word}", "0" * len(word))
    letters = F.split(plain, "")
    place = F.transform(letters, lambda ch: F.position(ch, F.lit(alphabet)) - 1)
    weight = lambda n: F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))
    limit = WINDOW * (math.log2(WINDOW) - bits) + 1e-9
    start = F.struct(
        F.array_repeat(F.lit(0.0), len(alphabet)).alias("counts"),
        F.lit(0.0).alias("mass"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(s: Column, i: Column, places: Column) -> Column:
        into = F.element_at(places, i + 1)
        out = F.when(i >= WINDOW, F.element_at(places, F.greatest(i - WINDOW + 1, F.lit(1)))).otherwise(F.lit(-1))
        moved = into != out
        a, b = F.element_at(s["counts"], into + 1), F.when(out >= 0, F.element_at(s["counts"], F.greatest(out + 1, F.lit(1)))).otherwise(F.lit(0.0))
        # incremental: only the entering and the leaving symbol change the sum of n log2 n
        mass = F.when(moved, s["mass"] + weight(a + 1) - weight(a) + F.when(out >= 0, weight(b - 1) - weight(b)).otherwise(0.0)).otherwise(s["mass"])
        counts = F.when(moved, F.transform(s["counts"], lambda v, k: v + F.when(k == into, 1.0).otherwise(0.0) - F.when(k == out, 1.0).otherwise(0.0))).otherwise(s["counts"])
        at = i - (WINDOW - 1)
        hit = (i >= WINDOW - 1) & (mass <= limit)
        return F.struct(counts.alias("counts"), mass.alias("mass"), F.when(hit, F.coalesce(s["first"], at)).otherwise(s["first"]).cast("int").alias("first"), F.when(hit, at).otherwise(s["last"]).cast("int").alias("last"))

    walk = lambda places: F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, lambda s, i: step(s, i, places), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))
    # a one-element transform binds the places once, so they aren't computed anew for each symbol
    return F.element_at(F.transform(F.array(place), walk), 1)


def _measured(runs: Column, alphabet: str, bits: float) -> Column:
    return F.transform(runs, lambda s: F.struct(s.alias("s"), _entropic(s["found"], alphabet, bits).alias("w")))


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, added) for every row: arrays of (start, rank, stop, kind, found) spans, base sorted by start and kind."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast(_SPAN)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = {
        "assign": F.when(F.col("text").rlike(ASSIGN_CUE), _located(F.col("text"), ASSIGN, "assign", F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), ASSIGN_LEAST)).otherwise(none),
        "access": F.when(F.col("text").rlike(ACCESS), _located(F.col("text"), ACCESS, "access")).otherwise(none),
        "hex": F.when(F.col("text").rlike(HEX), _located(F.col("text"), HEX, "hex")).otherwise(none),
    }
    rows = rows.withColumn("base", F.array_sort(F.concat(*found.values())))
    added = []
    for kind, pattern, alphabet, bits in CLASSES:
        runs = F.filter(_located(F.col("text"), pattern, kind), lambda s: s["found"].rlike("[0-9]") & ~s["found"].rlike(ALLOWED))
        measured = _measured(runs, alphabet, bits)
        hits = F.filter(measured, lambda m: m["w"]["first"].isNotNull())
        spans = F.transform(
            hits,
            lambda m: F.struct(
                (m["s"]["start"] + m["w"]["first"]).cast("bigint").alias("start"),
                m["s"]["rank"].alias("rank"),
                (m["s"]["start"] + m["w"]["last"] + WINDOW).cast("bigint").alias("stop"),
                m["s"]["kind"].alias("kind"),
                F.substring(m["s"]["found"], m["w"]["first"] + 1, m["w"]["last"] - m["w"]["first"] + WINDOW).alias("found"),
            ),
        )
        added.append(F.when(F.col("text").rlike(pattern), spans.cast(_SPAN)).otherwise(none))
    rows = rows.withColumn("all", F.concat(*added))
    inside = lambda s: F.exists("base", lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"]))
    rows = rows.withColumn("hexed", F.filter("all", lambda s: ~inside(s) & (s["kind"] == CLASSES[0][0])))
    wider = F.filter("all", lambda s: ~inside(s) & (s["kind"] != CLASSES[0][0]) & ~F.exists("hexed", lambda b: (b["start"] <= s["start"]) & (b["stop"] >= s["stop"])))
    return rows.select("doc_id", "base", F.concat("hexed", wider).alias("added"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added) for every row of docs."""
    found = find_secrets(docs)
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[number(k) for k in KINDS[:3]],
        F.sha2(F.encode(_joined(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
