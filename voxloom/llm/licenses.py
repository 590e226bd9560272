"""Licence scan in DataFrame functions only: a trained paragraph classifier and template comparison.

A multinomial logistic regression over sparse word 1- and 2-grams learns the licence families from
their templates, windows and shortened forms of them, and a class `unknown` from hand-written near misses
and a bounded sample of corpus lines (MAX_UNKNOWN, a parameter). A curve fitted on wordings that training
never saw turns the model's probability of a family into the chance that it is right, which must be LEAST or more.
A predicted family is then confirmed by comparison: the paragraph must cover CONFIRM of the 2-grams of one of its
templates, or be covered that far by all of them. A line that is a licence's name and nothing else, and an
identifier of an SPDX expression, are confirmed as such, whatever the model says.

A text's blocks end at blank lines (lines of comment signs alone are blank). Scored are every line by itself and every
block's lines joined, in windows of WINDOW words at every half of it, so wrapped notices are met whole. Grams made of words that
FREQUENT of the sampled lines hold are no features; so each feature has a rarer word, and a line or window without any
such word has no feature: the model cannot tell it from any other, it is `unknown` and is not scored further. The model
has a row for each template n-gram and family, so its broadcast is bounded by the templates.

Edge cases: null, empty and cue-free texts have no licence; repeated rows each have their row; a block
repeated in a text counts each time; ties between families go to the more probable, then to the name; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.license_texts import NAMES, NEAR_MISSES, OTHER_WORDINGS, SPDX, TEMPLATES
from voxloom.llm.workspace import Workspace

# fixed values: words that make a line one about licences; lines with one but without a family are reported as unknown
CUES = r"(?i)licen[cs]e|copyright|all rights reserved|spdx|redistribut|warranty|public domain|permission|creative commons|\bGPL|\bCC ?(BY|0)|mozilla public|apache"
MAX_UNKNOWN = 500
CONFIRM = 0.6
LEAST = 0.5
WINDOW = 48
FREQUENT = 0.02
MIN_ROWS = 4
SEPARATE = r"[^a-z0-9.]+"
BLANK = r"\n(?:[ \t\r#*/;!%-]*\n)+"


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), SEPARATE, " "), r"\.( |$)", " ")
    return F.filter(F.split(F.trim(plain), r" +"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    padded = F.concat(F.array(F.lit("^")), words, F.array(F.lit("$")))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(padded) - 1), lambda i: F.concat_ws(" ", F.element_at(padded, i), F.element_at(padded, i + 1))))


def _grams(words: Column) -> Column:
    return F.array_distinct(F.concat(words, _pairs(words)))


def _windows(words: str) -> Column:
    """Windows of WINDOW words at every half of it; a shorter array is its own window."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - WINDOW // 2), F.lit(WINDOW // 2))
    return F.transform(starts, lambda i: F.slice(words, i, WINDOW))


def _table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A small table as one literal, without an RDD."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def templates(spark: SparkSession) -> DataFrame:
    rows = [{"family": f, "template": k, "text": t} for f, ts in TEMPLATES.items() for k, t in enumerate(ts)]
    return _table(spark, rows, "family:string,template:int,text:string")


def sampled_lines(docs: DataFrame, most: int = MAX_UNKNOWN) -> DataFrame:
    """(words, draw) of at most `most` whole lines without a cue, of at most `most` documents, both those of least hash.

    Lines of which a quarter of the 2-grams are those of templates are pieces of wrapped notices and left out.
    """
    # ids first, at most `most` of them, then their texts: no whole text is sorted or gathered to be left out
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id", "left_semi")
    lines = sample.select(F.explode(F.split("text", "\n", -1)).alias("text")).where(~F.col("text").rlike(CUES)).select(_words(F.col("text")).alias("words"), F.xxhash64("text").alias("draw"))
    # bounded by the templates
    known = [r[0] for r in templates(docs.sparkSession).select(F.explode(_pairs(_words(F.col("text"))))).distinct().collect()]
    foreign = F.size(F.array_except("pairs", F.array(*[F.lit(p) for p in sorted(known)]))) > 0.75 * F.size("pairs")
    drawn = lines.where(F.size("words") > 0).orderBy("draw").limit(most)
    return drawn.withColumn("pairs", _pairs(F.col("words"))).where(foreign).select("words", "draw")


def training_paragraphs(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(family, variant, words): windows of templates with every eighth word left out in turn, near misses, and sampled lines."""
    known = templates(spark).select("family", _words(F.col("text")).alias("words"))
    known = known.select("family", F.explode(_windows("words")).alias("words"))
    varied = known.select("family", "words", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("variant"))
    left_out = F.filter("words", lambda w, i: (F.col("variant") % 2 == 0) | (F.size("words") < 6) | (F.pmod(i, F.lit(8)) != F.floor(F.col("variant") / 2)))
    known = varied.select("family", "variant", left_out.alias("words"))
    near = _table(spark, [{"text": t} for t in NEAR_MISSES], "text:string").select(F.lit("unknown").alias("family"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("variant"), _words(F.col("text")).alias("words"))
    corpus = lines.select(F.lit("unknown").alias("family"), F.pmod("draw", F.lit(16)).cast("int").alias("variant"), "words")
    return known.unionAll(near).unionAll(corpus)


class LicenseModel:
    """weights: (gram, family, weight) of the non-zero coefficients; intercepts by family; slope and shift of the fitted curve; anchors: every feature holds one of these words."""

    def __init__(self, weights: DataFrame, intercepts: dict[str, float], slope: float, shift: float, anchors: list[str]):
        self.weights, self.intercepts, self.slope, self.shift, self.anchors = weights, intercepts, slope, shift, anchors

    @property
    def gate(self) -> str:
        """A pattern that lower-cased text with a feature or a cue matches."""
        by_first: dict[str, list[str]] = {}
        for a in self.anchors:
            by_first.setdefault(a[0], []).append(re.escape(a[1:]))
        features = "|".join(f"{re.escape(c)}(?:{'|'.join(rest)})" for c, rest in sorted(by_first.items()))
        return f"{CUES}|(?<![a-z0-9])(?:{features})(?![a-z0-9])" if features else CUES


def fitted_curve(seen: list[tuple[float, bool]]) -> tuple[float, float]:
    """(slope, shift): chance of being right = sigmoid(slope * log-odds + shift), by Newton steps with smoothed targets."""
    right = sum(ok for _, ok in seen)
    high, low = (right + 1) / (right + 2), 1 / (len(seen) - right + 2)
    slope, shift = 1.0, 0.0
    for _ in range(50):
        # a weak pull to the uncorrected odds keeps the curve finite
        g0, g1, h00, h01, h11 = 1e-2 * (slope - 1.0), 1e-2 * shift, 1e-2, 0.0, 1e-2
        for x, ok in seen:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, slope * x + shift))))
            d, w = p - (high if ok else low), p * (1 - p)
            g0, g1, h00, h01, h11 = g0 + d * x, g1 + d, h00 + w * x * x, h01 + w * x, h11 + w
        det = h00 * h11 - h01 * h01
        slope, shift = slope - (h11 * g0 - h01 * g1) / det, shift - (h00 * g1 - h01 * g0) / det
    return (slope, shift) if math.isfinite(slope + shift) and slope > 0 else (1.0, 0.0)


def fit(ws: Workspace, docs: DataFrame) -> LicenseModel:
    spark = docs.sparkSession
    families = sorted([*TEMPLATES, "unknown"])
    label = F.coalesce(*[F.when(F.col("family") == f, float(i)) for i, f in enumerate(families)])
    lines = ws.table(sampled_lines(docs).coalesce(1), "sampled")
    rows = ws.table(training_paragraphs(spark, lines).select("variant", label.alias("label"), _grams(F.col("words")).alias("grams"), (F.col("family") != "unknown").alias("known")).coalesce(1), "training")
    total = lines.count()
    held = lines.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    share = {r["w"]: r["n"] / total for r in held.collect()}
    common = lambda w: w in ("^", "$") or (share.get(w, 0.0) >= FREQUENT and share[w] * total >= 3)
    # the vocabulary is that of templates; other words say nothing about a licence
    grams = [r["g"] for r in rows.where("known").select(F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_ROWS).orderBy("g").collect()]
    rarest = {g: min((w for w in g.split(" ") if not common(w)), key=lambda w: (share.get(w, 0.0), -len(w), w), default=None) for g in grams}
    vocabulary = [g for g in grams if rarest[g] is not None]
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True)
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60).fit(counter.transform(rows).where(F.col("known") | (F.col("variant") % 5 != 4)))
    other = _table(spark, [{"family": f, "text": t} for f, ts in OTHER_WORDINGS.items() for t in ts], "family:string,text:string")
    other = other.select(label.alias("label"), _grams(_words(F.col("text"))).alias("grams"))
    unseen = other.unionAll(rows.where(~F.col("known") & (F.col("variant") % 5 == 4)).select("label", "grams"))
    # rows of other wordings and of the sample: bounded by both
    seen = []
    for r in model.transform(counter.transform(unseen)).select("probability", "prediction", "label").collect():
        if families[int(r["prediction"])] != "unknown":
            p = min(max(r["probability"]), 1 - 1e-12)
            seen.append((math.log(p / (1 - p)), r["prediction"] == r["label"]))
    slope, shift = fitted_curve(seen)
    matrix = model.coefficientMatrix.toArray()
    entries = [{"gram": g, "family": families[k], "weight": float(matrix[k, j])} for j, g in enumerate(vocabulary) for k in range(len(families)) if abs(matrix[k, j]) > 1e-9]
    anchors = sorted({rarest[e["gram"]] for e in entries})
    return LicenseModel(_table(spark, entries, "gram:string,family:string,weight:double"), dict(zip(families, map(float, model.interceptVector), strict=True)), slope, shift, anchors)


def _units(docs: DataFrame, model: LicenseModel) -> tuple[DataFrame, DataFrame]:
    """(row, block, unit, cue, words) of the lines and windows with a feature or a cue, and (row, block, unit, family) of SPDX identifiers."""
    speaks = lambda c: F.lower(c).rlike(model.gate)
    blocks = docs.where(speaks("text")).select("row", F.posexplode(F.split("text", BLANK, -1)).alias("block", "part")).where(speaks("part"))
    lines = blocks.select("row", "block", F.posexplode(F.split("part", "\n", -1)).alias("unit", "line")).where(speaks("line"))
    named = F.flatten(F.transform(F.regexp_extract_all(F.lower("line"), F.lit(r"spdx-license-identifier:([^\n]*)"), F.lit(1)), lambda e: F.split(e, r"[^a-z0-9.+-]+")))
    # the plain search comes before all patterns, so texts without the mark are read at the cost of that
    marked = lambda c: F.lower(c).contains("spdx-license-identifier:")
    marks = docs.where(marked("text")).select("row", F.posexplode(F.split("text", BLANK, -1)).alias("block", "part")).where(marked("part"))
    ids = marks.select("row", "block", F.posexplode(F.split("part", "\n", -1)).alias("unit", "line")).where(marked("line")).select("row", "block", "unit", F.explode(named).alias("id"))
    family = F.coalesce(*[F.when(F.col("id").rlike(f"^(?:{p})(?:-only|-or-later|\\+)?$"), f) for f, p in SPDX.items()])
    ids = ids.select("row", "block", "unit", family.alias("family")).where("family is not null")
    single = lines.select("row", "block", "unit", F.col("line").rlike(CUES).alias("cue"), _words(F.col("line")).alias("words")).where(F.size("words") > 0)
    # one explode of one array binds the words: windows do not split the block again
    joined = blocks.select("row", "block", F.instr("part", "\n").alias("several"), F.explode(F.array(_words(F.col("part")))).alias("words"))
    joined = joined.where((F.col("several") > 0) | (F.size("words") > WINDOW)).select("row", "block", F.posexplode(_windows("words")).alias("at", "words"))
    anchors = F.array(*[F.lit(a) for a in model.anchors]).cast("array<string>")
    joined = joined.where(F.arrays_overlap("words", anchors)).select("row", "block", (-1 - F.col("at")).alias("unit"), F.lit(False).alias("cue"), "words")
    return single.unionAll(joined), ids


def scan_paragraphs(ws: Workspace, docs: DataFrame, model: LicenseModel) -> DataFrame:
    """(row, block, unit, cue, family, probability, similarity, confirmed) of every line (unit from 0) and window (below 0) with a feature or a cue; row as in docs."""
    spark = docs.sparkSession
    key = ["row", "block", "unit"]
    units, ids = _units(docs, model)
    # read by several branches below: the few units are written once; rows equal in id and text are reported alike
    units = ws.table(units.dropDuplicates(key), "units")
    grams = units.select(*key, F.explode(_grams(F.col("words"))).alias("gram"))
    # both tables are bounded by the templates, not by the data
    summed = grams.join(F.broadcast(model.weights), "gram").groupBy(*key, "family").agg(F.sum("weight").alias("z"))
    bias = F.create_map(*[x for f, b in model.intercepts.items() for x in (F.lit(f), F.lit(b))])
    families = F.array(*[F.lit(f) for f in model.intercepts])
    scores = summed.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("family", "z"))).alias("z"))
    names = _table(spark, [{"family": f, "text": t} for f, ts in NAMES.items() for t in ts], "family:string,text:string")
    names = names.select(F.col("family").alias("named"), F.concat_ws(" ", _words(F.col("text"))).alias("name")).dropDuplicates(["name"])
    keyed = units.select(*key, "cue", F.when(F.col("unit") >= 0, F.concat_ws(" ", "words")).alias("name")).join(F.broadcast(names), "name", "left").drop("name")
    scores = keyed.join(scores, key, "left")
    logits = F.transform(families, lambda f: F.struct((F.element_at(bias, f) + F.coalesce(F.try_element_at("z", f), F.lit(0.0))).alias("z"), f.alias("family")))
    scores = scores.withColumn("logits", logits).withColumn("top", F.array_max("logits"))
    others = F.aggregate("logits", F.lit(0.0), lambda s, x: s + F.exp(x["z"] - F.col("top")["z"])) - 1.0
    curve = 1.0 / (1.0 + F.exp(-(F.lit(model.slope) * -F.log(F.greatest(others, F.lit(1e-12))) + F.lit(model.shift))))
    # a unit without a feature has nothing but intercepts
    guess = F.when(F.col("z").isNull(), "unknown").otherwise(F.col("top")["family"])
    guessed = scores.select(*key, "cue", F.coalesce("named", guess).alias("family"), F.when(F.col("named").isNotNull(), 1.0).otherwise(curve).alias("probability"), "named")
    known = templates(spark).select("family", "template", _pairs(_words(F.col("text"))).alias("pairs"))
    each = known.select("family", "template", F.size("pairs").alias("size"), F.explode("pairs").alias("pair"))
    own = units.select(*key, F.explode(_pairs(F.col("words"))).alias("pair"))
    met = own.join(F.broadcast(each), "pair").groupBy(*key, "family", "template").agg((F.count("*") / F.first("size")).alias("covered"))
    best = met.groupBy(*key, "family").agg(F.max("covered").alias("covered"))
    shared = own.join(F.broadcast(each.select("family", "pair").distinct()), "pair").groupBy(*key, "family").agg(F.count("*").alias("common"))
    sizes = units.select(*key, F.size(_pairs(F.col("words"))).alias("own_size"))
    joined = guessed.join(best, [*key, "family"], "left").join(shared, [*key, "family"], "left").join(sizes, key)
    alike = F.coalesce(F.greatest("covered", F.when(F.col("own_size") >= 6, F.col("common") / F.col("own_size"))), F.lit(0.0))
    joined = joined.withColumn("similarity", F.when(F.col("named").isNotNull(), 1.0).otherwise(alike))
    scored = joined.select(*key, "cue", "family", "probability", "similarity", ((F.col("family") != "unknown") & (F.col("probability") >= LEAST) & (F.col("similarity") >= CONFIRM)).alias("confirmed"))
    by_id = ids.select(*key, F.lit(True).alias("cue"), "family", F.lit(1.0).alias("probability"), F.lit(1.0).alias("similarity"), F.lit(True).alias("confirmed")).distinct()
    return scored.unionAll(by_id)


def license_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, n_confirmed, license, families, probability) for every row of docs.

    n_paragraphs: blocks with a cue word or a confirmed family, n_confirmed those with a confirmed one. license: the
    most probable confirmed family, `unknown` if there are such blocks but no family, else `none`.
    """
    text = F.col("text").cast("string")
    # a name that follows from the row's values: the same whenever a partition is computed again
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), F.xxhash64(text).cast("string"))
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    with Workspace(docs.sparkSession, "licenses") as ws:
        found = ws.keep(scan_paragraphs(ws, rows.select("row", "text"), fit(ws, docs)).where("cue or confirmed"))
    by_row = found.groupBy("row").agg(
        F.size(F.collect_set("block")).alias("n_paragraphs"),
        F.size(F.collect_set(F.when(F.col("confirmed"), F.col("block")))).alias("n_confirmed"),
        F.max(F.when(F.col("confirmed"), F.struct("probability", "family"))).alias("best"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
    )
    return rows.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id",
        F.coalesce(F.col("n_paragraphs").cast("long"), F.lit(0)).alias("n_paragraphs"),
        F.coalesce(F.col("n_confirmed").cast("long"), F.lit(0)).alias("n_confirmed"),
        F.coalesce("best.family", F.when(F.col("n_paragraphs") > 0, "unknown"), F.lit("none")).alias("license"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.round("best.probability", 6).alias("probability"),
    )
