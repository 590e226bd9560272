"""N-gram Jaccard join by adaptive multi-match prefixes.

Documents are sets of distinct five-word shingles; two link at a Jaccard similarity of 0.8 or
more. Shingles of a set are ordered from rare to frequent. If two sets of required overlap a
meet, prefixes of |x| - a + l shingles share at least l. Each document picks the prefix step l with
the least estimated cost: the candidates its prefix would meet, and for each the work to verify it,
which falls as l shared shingles are demanded. Frequencies come from a count of all shingles of
all documents in SKETCH hashed buckets, a broadcast of fixed size; they only order and estimate,
so the join is exact whatever they are.

Equal sets are one node, so copies are never paired. Candidate pairs within a group that is linked
already are not made: first every set meets only the most central set of each of its lists, links
are contracted, then the pairs between different components that pass the length, multi-match and
positional bounds go on. Bitmaps bound what a pair can share and rule most others out; the rest is
verified on the whole sets. No link between different components is lost.

Sets are compared by 64-bit hashes of shingles and identified by a 64-bit sum of them.

Edge cases: null and empty texts have the empty set and stay alone; fewer than five words make one
shingle; rows repeating an id keep a row each; a null id keeps its row, never names a component
(one of null ids only has a null component_id); ties go to the smaller id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.components import connected_components
from voxloom.llm.tokens import long_lists, mix, shingle_sets, slices
from voxloom.llm.names import free_name
from voxloom.llm.workspace import Workspace

WIDTH = 5
SKETCH = 1 << 17
STEPS = 4
PROBE_COST = 4.0


def _identity(tokens: np.ndarray) -> int:
    return int(mix(np.array([mix(tokens).sum(dtype=np.uint64) if len(tokens) else 0], np.uint64) + np.uint64(len(tokens)))[0].view(np.int64))


def _buckets(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def describe_sets(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, n, sid) of the documents and, apart from them, (bucket, c) of the shingle counts of a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                sets = list(shingle_sets(text.slice(a, b - a), width))
                sketch += np.bincount(_buckets(np.concatenate(sets)), minlength=SKETCH)
                none = pa.nulls(b - a, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array([_identity(s) for s in sets], pa.int64()), none, none], ["doc_id", "n", "sid", "bucket", "c"])
        used = np.flatnonzero(sketch)
        for at in range(0, len(used), 50_000):
            part = used[at : at + 50_000]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(part), pa.array(sketch[part])], ["doc_id", "n", "sid", "bucket", "c"])

    return docs.mapInArrow(scan, "doc_id long, n long, sid long, bucket long, c long")


class ShingleOrder:
    """Rare-to-frequent order of shingles. Buckets within the noise of their mean count as rare; among rare ones the hash decides."""

    def __init__(self, counts: np.ndarray):
        mean = counts.mean()
        noise = 4 * np.sqrt(mean) + 2
        self.frequency = np.where(counts > mean + noise, counts - mean, 0).astype(np.float32)

    def sort(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        f = self.frequency[_buckets(tokens)]
        order = np.argsort(f, kind="stable")
        return tokens[order], f[order]


def required(n: np.ndarray | int, percent: int):
    """Least overlap of a set of n with any partner: ceil(percent * n / 100)."""
    return (percent * n + 99) // 100


def bit_places(tokens: np.ndarray) -> np.ndarray:
    """A set's bitmap: every shingle sets one of at least four times as many bits, a power of two."""
    size = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[((tokens >> np.uint64(7)) & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits)


def most_common(a: np.ndarray, na: int, b: np.ndarray, nb: int) -> int:
    """Bound on the shingles two sets share: a bit of one alone stands for a shingle of it alone. The larger bitmap is folded onto the other."""
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    return int(min(na - np.bitwise_count(a & ~b).sum(), nb - np.bitwise_count(b & ~a).sum()))


def prefixes(docs: DataFrame, order: ShingleOrder, width: int, percent: int) -> DataFrame:
    """(sid, n, steps, light, prefix, bits): the longest prefix of each non-empty set, its own step count, its number of rare shingles and its bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                out: list[tuple] = []
                for tokens in shingle_sets(text.slice(a, b - a), width):
                    n = len(tokens)
                    if not n:
                        continue
                    need = required(n, percent)
                    ordered, f = rank.sort(tokens)
                    most = min(STEPS, need)
                    longest = n - need + most
                    meets = np.cumsum(f[:longest])
                    met = meets[[n - need + step - 1 for step in range(1, most + 1)]]
                    steps = np.arange(1, most + 1)
                    cost = PROBE_COST * met + n * met / steps
                    out.append((_identity(tokens), n, int(np.argmin(cost)) + 1, int(np.searchsorted(f, 0.5)), ordered[:longest], bit_places(tokens).tobytes()))
                if out:
                    sid, n, steps, light, prefix, bits = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(n, pa.int32()), pa.array(steps, pa.int32()), pa.array(light, pa.int32()), long_lists(list(prefix)), pa.array(bits, pa.binary())], ["sid", "n", "steps", "light", "prefix", "bits"])

    return docs.mapInArrow(scan, "sid long, n int, steps int, light int, prefix array<long>, bits binary")


def shingle_table(docs: DataFrame, width: int) -> DataFrame:
    """(sid, tokens) of docs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for a, b in slices(text):
                sets = list(shingle_sets(text.slice(a, b - a), width))
                yield pa.RecordBatch.from_arrays([pa.array([_identity(s) for s in sets], pa.int64()), long_lists(sets)], ["sid", "tokens"])

    return docs.mapInArrow(scan, "sid long, tokens array<long>")


def _likely(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) that bitmaps, a sixteenth of the sets' size, don't rule out, with the bound on what they share; no similar pair goes."""
    left = bitmaps.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x"))
    right = bitmaps.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    names = pairs.columns

    def rule_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column("na").to_pylist(), batch.column("nb").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            bound = np.array([most_common(np.frombuffer(x, np.uint8), na, np.frombuffer(y, np.uint8), nb) for na, nb, x, y in sizes], np.int64)
            both = batch.column("na").to_numpy().astype(np.int64) + batch.column("nb").to_numpy()
            keep = pa.array((100 + percent) * bound >= percent * both)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(bound)], [*names, "bound"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").mapInArrow(rule_out, ", ".join(f"{c} long" for c in names) + ", bound long")


def _verified(ws: Workspace, pairs: DataFrame, rows: DataFrame, ids: DataFrame, width: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. Only sets of the pairs are read, each from one document that has it.

    Every pair ships a set to its partner, so pairs go in rounds of at most four times the number
    of sets: a round moves a few times the sets' own size, however many pairs there are.
    """
    asked = pairs.count()
    if not asked:
        return pairs.select("a", "b")
    wanted = pairs.select(F.col("a").alias("sid")).unionAll(pairs.select(F.col("b").alias("sid"))).distinct()
    owners = ws.table(wanted.join(ids, "sid").select("sid", "first_id"), f"{name}-owners")
    texts = rows.join(owners.where("first_id is not null").select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    if owners.where("first_id is null").limit(1).count():
        texts = texts.unionAll(rows.where("doc_id is null").select("doc_id", "text"))
    # an id may repeat with other texts: sets are told apart by sid
    sets = ws.table(shingle_table(texts, width).join(owners, "sid", "left_semi").dropDuplicates(["sid"]), f"{name}-sets")
    rounds = max(1, -(-asked // max(1, 4 * sets.count())))
    found = None
    for k in range(rounds):
        part = pairs.select("a", "b") if rounds == 1 else pairs.select("a", "b").where(F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == k)
        left = sets.select(F.col("sid").alias("a"), F.col("tokens").alias("x"))
        right = sets.select(F.col("sid").alias("b"), F.col("tokens").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        alike = part.join(left, "a").join(right, "b").where(100 * common >= percent * (F.size("x") + F.size("y") - common))
        done = ws.table(alike.select("a", "b"), f"{name}-{k}")
        found = done if found is None else found.unionAll(done)
    ws.drop(f"{name}-sets")
    return found


def _grouped(lists: DataFrame, groups: DataFrame) -> DataFrame:
    return lists.join(groups.select(F.col("node").alias("sid"), "component"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))


def link_components(docs: DataFrame, width: int = WIDTH, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, links) for every row of docs.

    links: verified links of the document's set found on the way, not all there are inside a component.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _components(rows, width, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "links")


def _components(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, sid, n, component, component_id, links) for every row (doc_id, text); component: least sid of the group."""
    spark = rows.sparkSession
    with Workspace(spark, "ngram") as ws:
        seen = ws.table(describe_sets(rows, width), "sets")
        each = seen.where("bucket is null").select("doc_id", "n", "sid")
        counted = seen.where("bucket is not null").groupBy("bucket").agg(F.sum("c").alias("c")).toPandas()
        counts = np.zeros(SKETCH, np.int64)
        counts[counted["bucket"].to_numpy(np.int64)] = counted["c"].to_numpy(np.int64)
        ids = each.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first_id"))

        own = ws.table(prefixes(rows, ShingleOrder(counts), width, percent).dropDuplicates(["sid"]), "prefixes")
        bitmaps = own.select("sid", "n", "bits")
        at = F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")
        rank = F.shiftleft((F.col("light").cast("long") * 1000 / F.col("n")).cast("int"), 4) + F.col("steps")
        posted = own.select("sid", "n", "steps", "light", F.posexplode("prefix").alias("pos", "token")).select("token", "sid", at.alias("at"), rank.alias("rank"))
        central = F.min(F.struct(F.shiftright("rank", 4), F.col("sid").alias("leader"), F.shiftright("at", 32).alias("leader_n")))
        heads = posted.repartition("token").groupBy("token").agg(F.count("*").alias("members"), central.alias("head")).where("members > 1").select("token", "head.leader", "head.leader_n")
        # a table of its own: the join then meets two plain exchanges, of which a skewed one is split at run time
        heads = ws.table(heads, "heads")
        wide = posted.join(heads, "token").select("token", "sid", F.shiftright("at", 32).cast("int").alias("n"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("pos"), F.col("rank").bitwiseAND(15).alias("steps"), "leader", F.col("leader_n").cast("int").alias("leader_n"))
        lists = ws.table(wide, "lists")

        met = lists.where("sid <> leader and 100 * least(n, leader_n) >= %d * greatest(n, leader_n)" % percent)
        # a first guess only: pairs that share little of their prefixes are left to the exact step below
        worth = F.expr(f"shared * 4 >= n - ({percent} * n + 99) div 100 + 1")
        best = met.groupBy("sid", "leader").agg(F.count("*").alias("shared"), F.first("n").alias("n")).where(worth).groupBy("sid").agg(F.max(F.struct("shared", "leader")).alias("m"))
        first = ws.table(best.select(F.col("sid").alias("a"), F.col("m.leader").alias("b")), "first")
        found = _verified(ws, ws.table(_likely(first, bitmaps, percent), "likely-1"), rows, ids, width, percent, "found-1")
        groups = ws.table(connected_components(ws, found, "cc1"), "groups")
        labelled = ws.table(_grouped(lists.select("token", "sid", "n", "steps", "pos"), groups), "labelled")
        mixed = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
        open_ = ws.table(labelled.join(ws.table(mixed, "mixed"), "token"), "open")
        for name in ("lists", "labelled", "first"):
            ws.drop(name)

        # the side of fewer sets is spread first, and only its sets of a fitting size
        sides = open_.groupBy("token", "component").agg(F.count("*").alias("members"), F.min("n").alias("low"), F.max("n").alias("high"))
        few = sides.select("token", F.col("component").alias("ca"), F.struct("members", "component").alias("size_a"), F.col("low").alias("la_n"), F.col("high").alias("ha_n"))
        many = sides.select("token", F.col("component").alias("cb"), F.struct("members", "component").alias("size_b"), "low", "high")
        fits = F.expr(f"size_a < size_b and 100 * ha_n >= {percent} * low and 100 * high >= {percent} * la_n")
        across = few.join(many, "token").where(fits).select("token", "ca", "cb", "low", "high")
        a = open_.select("token", F.col("component").alias("ca"), F.col("sid").alias("a"), F.col("n").alias("na"), F.col("steps").alias("la"), F.col("pos").alias("pa"))
        b = open_.select("token", F.col("component").alias("cb"), F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("steps").alias("lb"), F.col("pos").alias("pb"))
        need = lambda n: f"(({percent} * {n} + 99) div 100)"
        steps = "if(na > nb or (na = nb and a > b), la, lb)"
        spread = across.join(a, ["token", "ca"]).where(f"100 * na >= {percent} * low and 100 * high >= {percent} * na").drop("low", "high")
        both = spread.join(b, ["token", "cb"]).where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        # the larger set's step count rules the pair: places beyond that prefix don't count, and the shingles after a
        # match bound what the pair can still share (up to `steps` matches are counted in the bound's favour)
        both = both.where(
            f"pa < na - {need('na')} + ({steps}) and pb < nb - {need('nb')} + ({steps}) "
            f"and ({100 + percent}) * (({steps}) + least(na - pa - 1, nb - pb - 1)) >= {percent} * (na + nb)"
        )
        pairs = both.groupBy("a", "b", "ca", "cb").agg(F.count("*").alias("shared"), F.min(F.expr(f"least({steps}, {need('least(na, nb)')})")).alias("steps")).where("shared >= steps").select("a", "b", "ca", "cb")
        likely = ws.table(_likely(ws.table(pairs, "pairs"), bitmaps, percent), "likely-2")
        for name in ("open", "pairs"):
            ws.drop(name)
        # two components need one link: their most promising pair is read first, the others only if they are still apart
        ends = [F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")]
        promising = likely.groupBy(*ends).agg(F.max(F.struct("bound", "a", "b")).alias("m")).select("m.a", "m.b")
        links = found.unionAll(_verified(ws, ws.table(promising, "promising"), rows, ids, width, percent, "found-2"))
        groups = ws.table(connected_components(ws, links, "cc2"), "groups-2")
        label = groups.select(F.col("node").alias("sid"), "component")
        rest = likely.select("a", "b").join(promising, ["a", "b"], "left_anti")
        rest = rest.join(label.withColumnsRenamed({"sid": "a", "component": "ga"}), "a", "left").join(label.withColumnsRenamed({"sid": "b", "component": "gb"}), "b", "left")
        rest = ws.table(rest.where("coalesce(ga, a) <> coalesce(gb, b)").select("a", "b"), "rest")
        more = _verified(ws, rest, rows, ids, width, percent, "found-3")
        if more.limit(1).count():
            links = links.unionAll(more)
            groups = ws.table(connected_components(ws, links, "cc3"), "components")
        degree = links.select(F.col("a").alias("sid")).unionAll(links.select(F.col("b").alias("sid"))).groupBy("sid").agg(F.count("*").alias("links"))
        named = ws.table(_grouped(ids, groups), "named")
        least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        by_set = named.join(ws.table(least, "least"), "component").join(degree, "sid", "left").select("sid", "component", "component_id", F.coalesce("links", F.lit(0)).alias("links"))
        by_set = ws.table(by_set, "by-set")
        return ws.keep(
            each.join(by_set, "sid", "left").select(
                "doc_id",
                "sid",
                "n",
                "component",
                F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                F.when(F.col("n") > 0, F.col("links")).otherwise(0).alias("links"),
            )
        )


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = 80) -> DataFrame:
    """docs with one row of each component; rows with empty sets all stay.

    The row of the least (id, set) stays, an id of null last. Rows that repeat an id are told apart by their sets;
    of rows equal in id and set one stays.
    """
    key, of = (free_name(n, docs.columns) for n in ("__set", "__of"))
    with Workspace(docs.sparkSession, "keep") as ws:
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        linked = ws.table(_components(rows, width, percent), "linked")
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sid")
        best = ws.table(linked.where("n > 0").groupBy("component").agg(F.min(order).alias("best"), F.count("*").alias("rows")).where("rows > 1"), "best")
        kept = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("sid") == F.col("best.sid"))
        gone = ws.keep(linked.where("n > 0").join(best, "component").where(~kept).select(F.col("doc_id").alias(of), F.col("sid").alias(key)).distinct(), "gone")
        copies = ws.keep(linked.where("n > 0").groupBy(F.col("doc_id").alias(of), F.col("sid").alias(key)).agg(F.count("*").alias("copies")).where("copies > 1").select(of, key), "copies")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(of))
    suspects = gone.select(of).unionAll(copies.select(of)).distinct()
    # only rows whose id is among those are read again for their sets
    untouched = docs.join(suspects, same, "left_anti")
    again = with_sets(docs.join(suspects, same, "left_semi"), width, key)
    again = again.join(gone, same & (again[key] == gone[key]), "left_anti")
    single = again.join(copies, same & (again[key] == copies[key]), "left_anti")
    once = again.join(copies, same & (again[key] == copies[key]), "left_semi").dropDuplicates(["doc_id", key])
    return untouched.unionByName(single.unionAll(once).select(*[F.col(f"`{c}`") for c in docs.columns]))


def with_sets(docs: DataFrame, width: int, name: str) -> DataFrame:
    """docs with the identity of each row's set; null for the empty set."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, out = batch.column(batch.schema.get_field_index("text")), []
            for a, b in slices(text):
                out += [_identity(s) if len(s) else None for s in shingle_sets(text.slice(a, b - a), width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, name])

    return docs.mapInArrow(scan, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{name}` long")
