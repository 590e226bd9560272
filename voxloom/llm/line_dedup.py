"""Fuzzy line deduplication by MinHash, in DataFrame functions only.

A line's set holds its character shingles: every SHINGLE consecutive characters, case folded (signatures, which only
propose, take UTF-16 units, the same but for rare signs). Lines
equal but for case and outer blanks are one. Of all shingles MINIMA minima are drawn: of HASHES hashes under
xor masks (the element nearest a random point in the xor metric is a fair draw from the set). BANDS
bands, each of ROWS of the minima, overlap in single minima, which spares most of the draws: lines that agree
on a whole band are candidates, at a similarity of 0.8 with a chance of 0.97, of 0.85 of 0.99. Each
candidate is verified by the exact Jaccard similarity of all shingles (as 64-bit hashes) of both lines,
links become components, and of a component the first line by (doc_id, text hash, line number) stays.

Every bucket has a leader, its least line, which all its other lines meet; then the leader leaves the bucket, and a
bucket whose lines are all of one component is done. In those still open the lines outside the most frequent component are strays. If there
are at most FEW, they meet every line of another component; the lines of the other buckets are finished exactly: of all their pairs across components those are verified
that set sizes and prefixes (rarest shingles first) allow to be similar enough, so no bucket keeps an unverified pair. Pairs that bitmaps of the
lines rule out need not be verified.
A frequent shingle's lines are met in blocks of BLOCK, spread over the tasks.

Edge cases: a null text has no lines; blank lines always stay and are no duplicates; a line shorter
than SHINGLE is its own shingle; rows that repeat an id but differ in text are documents of their own; rows
equal in id and text are one document, reported alike and kept once; a document whose lines all go is dropped by
dedup_documents, one that never had a line that isn't blank stays; a null doc_id is a document of
its own value, last in order; empty tables give empty results; further columns are kept, whatever their names.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.components import connected_components
from voxloom.llm.names import free_name
from voxloom.llm.workspace import Workspace

SHINGLE = 6
# blanks that don't count at the ends of a line
OUTER = " \t\r\x0b\x0c"
MINIMA = 24
HASHES = 3
BANDS = 14
ROWS = 5
# strays of a bucket that meet all its lines
FEW = 64
PERCENT = 80
SKETCH = 1 << 17
BLOCK = 512
# 64-bit words of a bitmap
WORDS = 32
NARROW = 8
# shingles hashed side by side in one row
STRIDE = 4
# one line of so many counts for the order of shingles
COUNTED = 8


def _masks() -> list[int]:
    """One mask for each minimum; those of one hash differ in their first bits, so they draw from different parts of it."""
    each = MINIMA // HASHES
    return [(k // HASHES - each // 2) * (1 << 61) + random.Random(f"line-{k}").getrandbits(61) for k in range(MINIMA)]


def _bands() -> list[list[int]]:
    """BANDS choices of ROWS minima which overlap as little as a greedy search finds."""
    draw, bands, used = random.Random("bands"), [], [0] * MINIMA
    for _ in range(BANDS):
        tries = [sorted(draw.sample(range(MINIMA), ROWS)) for _ in range(300)]
        best = min(tries, key=lambda t: (sum(len(set(t) & set(b)) ** 2 for b in bands), sum(used[i] for i in t)))
        bands.append(best)
        for i in best:
            used[i] += 1
    return bands


def normal_form(line: Column) -> Column:
    """Case folded, outer blanks off: what makes two lines equal."""
    return F.btrim(F.lower(line), F.lit(OUTER))


def line_id(normal: Column) -> Column:
    return F.xxhash64(normal, F.lit(17))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, th, line_no, normal) of every line that isn't blank; th: hash of the whole text."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    # folding case makes no line blank: a filter on the normal form would fold every line twice
    return lines.where(F.btrim("line", F.lit(OUTER)) != "").select("doc_id", "th", "line_no", normal_form(F.col("line")).alias("normal"))


# units holds two bytes for each character; a substring of binary needs no search for its place
_LAST = f"greatest(0, cast(octet_length(units) / 2 as int) - {SHINGLE})"


def _shingle(at: str) -> str:
    return f"xxhash64(substring(units, 2 * ({at}) + 1, {2 * SHINGLE}))"


def hashed_shingles(line: str = "normal") -> Column:
    """Hashes of all shingles, repeats included; four bytes for each character, so a substring needs no search for its place."""
    return F.expr(f"transform(array(encode({line}, 'UTF-32')), u -> transform(sequence(0, greatest(0, cast(octet_length(u) / 4 as int) - {SHINGLE})), i -> xxhash64(substring(u, 4 * i + 1, {4 * SHINGLE}))))[0]")


def signed_lines(occurrences: DataFrame) -> DataFrame:
    """(line, normal, bands): a row for each different line, its text and the hash of each band.

    Repeats go before and after the exchange by line, and minima are grouped where it left the
    texts, so a frequent line fills no task and shingles are never shuffled.
    """
    texts = occurrences.select("line", "normal").dropDuplicates(["line"])
    places = texts.select("line", F.expr("encode(normal, 'UTF-16BE')").alias("units")).select("line", "units", F.expr(f"explode(sequence(0, {_LAST}, {STRIDE}))").alias("i"))
    hashed = places.select("line", *[F.expr(_shingle(f"least(i + {c}, {_LAST})")).alias(f"s{c}") for c in range(STRIDE)])
    # every group of minima has a hash of its own: minima of one hash under many masks fall on the same few shingles
    hashed = hashed.select("line", *[(F.col(f"s{c}") if h == 0 else F.xxhash64(f"s{c}", F.lit(h))).alias(f"h{c}_{h}") for c in range(STRIDE) for h in range(HASHES)])
    nearest = [F.least(*[F.col(f"h{c}_{k % HASHES}").bitwiseXOR(F.lit(m)) for c in range(STRIDE)]) for k, m in enumerate(_masks())]
    minima = hashed.groupBy("line").agg(*[F.min(x).alias(f"m{k}") for k, x in enumerate(nearest)])
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.col(f"m{k}") for k in rows]) for b, rows in enumerate(_bands())])
    return texts.join(minima.select("line", bands.alias("bands")), "line")


def _shared(ws: Workspace, signed: DataFrame) -> DataFrame:
    """(band, line, leader) of the buckets that hold several lines. Bands are shuffled once, as two numbers."""
    bucket = Window.partitionBy("band")
    bands = signed.select("line", F.explode("bands").alias("band"))
    met = bands.select("band", "line", F.min("line").over(bucket).alias("leader"), F.max("line").over(bucket).alias("last"))
    return ws.table(met.where("leader <> last").drop("last"), "shared")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. Texts travel, not their sets, which are many times as large.

    Set sizes come with the texts: they rule pairs out before a set is made, and the union follows from the intersection.
    """
    left = texts.select(F.col("line").alias("a"), F.col("normal").alias("x"), F.col("n").alias("nx"))
    right = texts.select(F.col("line").alias("b"), F.col("normal").alias("y"), F.col("n").alias("ny"))
    near = F.lit(100) * F.least("nx", "ny") >= F.lit(PERCENT) * F.greatest("nx", "ny")
    common = F.size(F.array_intersect(hashed_shingles("x"), hashed_shingles("y")))
    # by a last: it is no leader, so the pairs of a frequent leader are verified in many tasks
    return pairs.join(right, "b").join(left, "a").where(near & _enough(common, F.col("nx") + F.col("ny"))).select("a", "b").distinct()


def _enough(most: Column, of: Column) -> Column:
    """Whether sets of that many elements together can be similar enough if they share that many at most."""
    return F.lit(100 + PERCENT) * most >= F.lit(PERCENT) * of


def _most_common(x: list[Column], y: list[Column], nx: Column, ny: Column) -> Column:
    """The most elements sets of nx and ny can share, given the words of their bitmaps."""
    alone = lambda p, q: sum((F.bit_count(a.bitwiseAND(F.bitwise_not(b))) for a, b in zip(p, q)), F.lit(0))
    return F.least(nx - alone(x, y), ny - alone(y, x))


def _bitmaps(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """(line, n, w0, w1, ...) of these lines: a bit of one bitmap alone stands for a shingle of that line alone: it bounds what two lines share, in no text's length."""
    chars = texts.join(lines, "line", "left_semi").repartition("line").select("line", "n", F.expr("encode(normal, 'UTF-32')").alias("chars"))
    places = chars.select("line", "n", "chars", F.expr(f"explode(sequence(0, greatest(0, cast(octet_length(chars) / 4 as int) - {SHINGLE})))").alias("i"))
    hashed = places.select("line", "n", F.expr(f"xxhash64(substring(chars, 4 * i + 1, {4 * SHINGLE}))").alias("h"))
    words = hashed.groupBy("line", "n", F.expr(f"cast(h & {WORDS - 1}L as int)").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) as int))")).alias("w"))
    found = words.groupBy("line", "n").agg(F.map_from_entries(F.collect_list(F.struct("k", "w"))).alias("words"))
    return found.select("line", "n", *[F.coalesce(F.try_element_at("words", F.lit(k)), F.lit(0).cast("long")).alias(f"w{k}") for k in range(WORDS)])


def _allowed(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) that the lines' bitmaps allow to be similar enough."""
    one = bits.select(F.col("line").alias("a"), F.col("n").alias("na"), *[F.col(f"w{k}").alias(f"x{k}") for k in range(WORDS)])
    two = bits.select(F.col("line").alias("b"), F.col("n").alias("nb"), *[F.col(f"w{k}").alias(f"y{k}") for k in range(WORDS)])
    wide = _most_common([F.col(f"x{k}") for k in range(WORDS)], [F.col(f"y{k}") for k in range(WORDS)], F.col("na"), F.col("nb"))
    return pairs.join(two, "b").join(one, "a").where(_enough(wide, F.col("na") + F.col("nb"))).select("a", "b")


def _left_over(ws: Workspace, lines: DataFrame, texts: DataFrame, bits: DataFrame) -> DataFrame:
    """(a, b): every pair of lines (line, component) of different components that can still be similar enough.

    Sets are ordered by how often their shingles' places of a sketch were seen, then by hash. Similar sets share an
    element among the first n - least + 1 of each, where least is what the similarity asks of a set of n. Any order gives
    the same pairs, so one line of COUNTED is enough to find it; sets are ordered as arrays, not as a row for each shingle.
    """
    sets = lines.join(texts, "line").select("line", "component", "n", F.array_distinct(hashed_shingles()).alias("hs"))
    sets = ws.table(sets, "left-sets")
    place = F.pmod(F.col("h"), F.lit(SKETCH))
    # bounded by SKETCH, so the order needs no exchange by shingle and fits one row
    counted = sets.where(F.pmod(F.xxhash64("line", F.lit(5)), F.lit(COUNTED)) == 0).select(F.explode("hs").alias("h"))
    every = counted.select(place.alias("place"), F.lit(1).alias("one")).unionAll(counted.sparkSession.range(SKETCH).select(F.col("id"), F.lit(0)))
    seen = every.groupBy("place").agg(F.sum("one").alias("seen")).agg(F.array_sort(F.collect_list(F.struct("place", "seen"))).alias("seen"))
    seen = ws.table(seen.select(F.col("seen.seen").alias("seen")), "left-seen")
    bits = ws.table(bits.join(lines.select("line"), "line", "left_semi"), "left-bits")
    ranked = F.expr(f"array_sort(transform(hs, h -> struct(seen[cast(pmod(h, {SKETCH}L) as int)] as seen, h as h)))")
    ordered = sets.crossJoin(F.broadcast(seen)).select("line", "component", "n", ranked.alias("hs"))
    # words NARROW apart fold into one: a smaller bitmap that travels with every place a line is posted to
    folded = [reduce(Column.bitwiseOR, [F.col(f"w{k}") for k in range(f, WORDS, NARROW)]).alias(f"f{f}") for f in range(NARROW)]
    prefix = F.slice("hs", F.lit(1), (F.col("n") - F.floor((F.lit(PERCENT) * F.col("n") + 99) / 100) + 1).cast("int"))
    prefixes = ws.table(ordered.select("line", "component", "n", prefix.alias("hs")).join(bits.select("line", *folded), "line"), "left-prefixes")
    ws.drop("left-sets")
    ws.drop("left-seen")
    posted = prefixes.select("line", "component", "n", *[f"f{f}" for f in range(NARROW)], F.posexplode("hs").alias("at", "e")).withColumn("h", F.col("e.h")).drop("e").withColumn("place", place)
    posts = ws.table(posted.groupBy("place").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), "left-posts")
    posted = posted.join(F.broadcast(posts), "place").withColumn("own", F.pmod(F.xxhash64("line", F.lit(3)), F.col("parts")))
    # blocks meet pairwise, each in the lower role with itself and those above, in the higher with itself and those below
    every = ["h", "low", "high", "line", "component", "n", "at", *[f"f{f}" for f in range(NARROW)]]
    x = posted.withColumn("low", F.col("own")).withColumn("high", F.explode(F.sequence("own", F.col("parts") - 1))).select(*every).alias("x")
    y = posted.withColumn("high", F.col("own")).withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), "own"))).select(*every).alias("y")
    met = (F.col("x.h") == F.col("y.h")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    once = (F.col("x.low") != F.col("x.high")) | (F.col("x.line") > F.col("y.line"))
    # at their first common element no more than the rest of either set can be common
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    both = F.col("x.n") + F.col("y.n")
    narrow = _most_common([F.col(f"x.f{f}") for f in range(NARROW)], [F.col(f"y.f{f}") for f in range(NARROW)], F.col("x.n"), F.col("y.n"))
    pairs = x.join(y, met & (F.col("x.component") != F.col("y.component")) & once & _enough(rest, both) & _enough(narrow, both))
    pairs = pairs.select(F.greatest("x.line", "y.line").alias("a"), F.least("x.line", "y.line").alias("b")).distinct()
    return _allowed(pairs, bits)


def _labelled(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(band, line, component) of the rows of the buckets; a line without a link is its own component."""
    return shared.select("band", "line").join(groups.select(F.col("node").alias("line"), "component"), "line", "left").select("band", "line", F.coalesce("component", "line").alias("component"))


def _open(ws: Workspace, labelled: DataFrame, name: str) -> DataFrame:
    """The rows (band, line, component) of buckets of several components, with whether the line is a stray and their number in the bucket."""
    bucket = Window.partitionBy("band")
    met = labelled.withColumn("alike", F.count("*").over(Window.partitionBy("band", "component")))
    met = met.select("band", "line", "component", F.max(F.struct("alike", "component")).over(bucket)["component"].alias("main"))
    met = met.select("band", "line", "component", (F.col("component") != F.col("main")).alias("stray"))
    return ws.table(met.withColumn("strays", F.count_if("stray").over(bucket)).where("strays > 0"), name)


def _of_strays(few: DataFrame) -> DataFrame:
    """(a, b): the pairs within buckets across components; one of each is a stray, as the others are of one component."""
    x, y = few.where("stray").alias("x"), few.alias("y")
    once = ~F.col("y.stray") | (F.col("x.line") > F.col("y.line"))
    met = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.component") != F.col("y.component")) & once)
    return met.select(F.greatest("x.line", "y.line").alias("a"), F.least("x.line", "y.line").alias("b")).distinct()


def line_components(ws: Workspace, occurrences: DataFrame) -> DataFrame:
    """(node, component) of the lines that have a link."""
    signed = ws.table(signed_lines(occurrences), "signed")
    shared = _shared(ws, signed)
    texts = signed.select("line", "normal").join(shared.select("line").distinct(), "line", "left_semi")
    texts = ws.table(texts.select("line", "normal", F.size(F.array_distinct(hashed_shingles())).alias("n")), "texts")
    ws.drop("signed")
    tried = ws.table(shared.where("line <> leader").select(F.col("line").alias("a"), F.col("leader").alias("b")).distinct(), "tried")
    groups = connected_components(ws, ws.table(_verified(tried, texts), "found"), "cc-first")
    now = _open(ws, _labelled(shared.where("line <> leader"), groups), "open")
    ws.drop("shared")
    bits = ws.table(_bitmaps(now.select("line").distinct(), texts), "bitmaps")
    few = _of_strays(now.where(F.col("strays") <= FEW)).join(tried, ["a", "b"], "left_anti")
    few = ws.table(_allowed(few, bits), "pairs-few")
    links = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(_verified(few, texts))
    many = now.where(F.col("strays") > FEW).select("band", "line")
    if many.limit(1).count():
        # the finish meets all pairs across components, which links found by now leave few of
        groups = connected_components(ws, links, "cc-many")
        links = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        left = _open(ws, _labelled(many, groups), "open-many").select("line", "component").distinct()
        rest = ws.table(_left_over(ws, left, texts, bits).join(tried, ["a", "b"], "left_anti"), "pairs-left")
        links = links.unionAll(ws.table(_verified(rest, texts), "found-left"))
    return ws.table(connected_components(ws, links, "cc"), "groups")


def duplicate_lines(ws: Workspace, docs: DataFrame) -> DataFrame:
    """(doc_id, th, line_no) of every line that goes."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "line_no")
    occurrences = lines_of(docs).select("doc_id", "th", "line_no", line_id(F.col("normal")).alias("line"), "normal")
    groups = line_components(ws, occurrences)
    named = occurrences.drop("normal").join(groups.select(F.col("node").alias("line"), "component"), "line", "left").select("doc_id", "th", "line_no", F.coalesce("component", "line").alias("component"))
    named = ws.table(named, "named")
    first = ws.table(named.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("copies")).where("copies > 1"), "first")
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")) & (F.col("line_no") == F.col("first.line_no"))
    return ws.table(named.join(first, "component").where(~kept).select("doc_id", "th", "line_no"), "gone")


def _gone_of(ws: Workspace, docs: DataFrame, of: str, th: str, gone: str) -> DataFrame:
    """(of, th, gone): the numbers of the lines that go, for each document that loses any, under these names."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return duplicate_lines(ws, rows).groupBy(F.col("doc_id").alias(of), F.col("th").alias(th)).agg(F.array_sort(F.collect_set("line_no")).alias(gone))


def _same(of: str, th: str) -> Column:
    return F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.xxhash64(F.col("text").cast("string")) == F.col(th))


def line_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped) for every row of docs; dropped: numbers of the lines that go, from 0."""
    with Workspace(docs.sparkSession, "lines") as ws:
        gone = _gone_of(ws, docs, "of", "of_th", "gone")
        count = F.coalesce(F.greatest(F.size(F.split(F.col("text").cast("string"), "\n", -1)), F.lit(0)), F.lit(0))
        sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("th"), count.alias("n_lines"))
        joined = sizes.join(gone, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("of_th")), "left")
        return ws.keep(joined.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).alias("n_dropped"), F.coalesce("gone", F.array().cast("array<int>")).alias("dropped")))


def dedup_documents(docs: DataFrame) -> DataFrame:
    """docs with the duplicate lines cut out of text (and n_chars, if there is such a column, made to fit).

    Documents left without a line go; of rows equal in id and text one stays, whatever their further columns.
    """
    of, th, lost, new = (free_name(n, docs.columns) for n in ("__of", "__th", "__gone", "__text"))
    with Workspace(docs.sparkSession, "lines") as ws:
        gone = ws.keep(_gone_of(ws, docs, of, th, lost), "dropped")
        ids = docs.select(F.col("doc_id").cast("long").alias(of), F.xxhash64(F.col("text").cast("string")).alias(th))
        repeated = ws.keep(ids.groupBy(of, th).agg(F.count("*").alias("copies")).where((F.col("copies") > 1) & (F.col(th) != F.xxhash64(F.lit(None).cast("string")))), "repeated").select(of, th)
    if repeated.limit(1).count():
        once = docs.join(repeated, _same(of, th), "left_semi").dropDuplicates(["doc_id", "text"])
        docs = docs.join(repeated, _same(of, th), "left_anti").unionByName(once)
    # lines and places are bound once, so a long text costs as much as it has lines
    lines = F.split(F.col("text"), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    rest = F.transform(F.array(F.struct(lines.alias("lines"), kept.alias("kept"))), lambda x: F.array_join(F.transform(x["kept"], lambda i: F.get(x["lines"], i)), "\n"))
    new_text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(rest[0])
    cut = docs.join(gone, _same(of, th), "left").withColumn(new, new_text).where(F.col(lost).isNull() | F.col(new).rlike(r"\S"))
    out = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.col(new).alias("text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col(lost).isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select(*out.values())
