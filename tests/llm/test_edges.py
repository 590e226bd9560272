"""Empty tables, rows that repeat ids, clashing column names, inputs that come out of a shuffle, and whole scores by brute force."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from voxloom.llm import decontaminate, licenses, line_dedup, ngram_join, packing, quality, secrets, suffix_tree, vafile, warc

DATA = "/root/testdata/sf0.001"
# names that stages use themselves or might
CLASH = "doc_id long, text string, quality_score double, component long, line long, sid long, n_chars long, row string, bound int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 1, 2, 3, len(t or ""), "r", 4) for i, t in rows], CLASH)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_empty_tables(spark):
    none = docs(spark, []).where("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert warc.round_trip(pages).count() == 0
    assert suffix_tree.score_documents(none).count() == 0
    assert quality.classify(none, labels).count() == 0
    assert vafile.top_k(vectors).count() == 0
    assert decontaminate.find_overlaps(none, bench).count() == 0
    assert decontaminate.remove_contaminated(none, bench).count() == 0
    assert secrets.secret_report(none).count() == 0
    assert line_dedup.line_report(none).count() == 0
    assert packing.assign_batches(none).count() == 0
    assert licenses.license_report(none).count() == 0


def test_keep_one_with_repeated_ids(spark):
    rng = random.Random(8)
    a, b, c = (sentence(rng, 40) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, c), (9, None), (9, ""), (None, a), (None, sentence(rng, 30))]
    kept = ngram_join.keep_one(docs(spark, rows))
    assert kept.columns == [x.split()[0] for x in CLASH.split(", ")]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    # the copy of a in row 5 goes, the text that row 5 alone has stays; equal rows of 7 are one; empty sets all stay
    assert got == sorted([(1, a), (5, b), (7, c), (9, None), (9, ""), rows[-1]], key=repr)


def test_line_dedup_with_repeated_ids(spark):
    rng = random.Random(9)
    x, y, z, u = (sentence(rng, 12) for _ in range(4))
    rows = [(1, f"{x}\n{y}"), (1, f"{x}\n{z}"), (2, f"{y}\n\n{u}"), (3, x), (4, u), (4, u), (6, None), (7, "  \n")]
    out = line_dedup.dedup_documents(docs(spark, rows))
    assert out.columns == [c.split()[0] for c in CLASH.split(", ")]
    got = Counter((r["doc_id"], line) for r in out.collect() for line in (r["text"] or "").split("\n") if line.strip())
    # every line stays once, in a document of the least id that has it; rows of one id lose only lines of their own
    owners = defaultdict(set)
    for i, line in got.elements():
        owners[line].add(i)
    assert max(got.values()) == 1 and owners == {x: {1}, y: {1}, z: {1}, u: {2}}
    assert {r["doc_id"] for r in out.collect()} == {1, 2, 6, 7}
    assert all(r["n_chars"] == len(r["text"] or "") for r in out.collect())


def test_license_report_of_a_shuffled_input(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")}
    table = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("row", F.lit("clash"))
    want = sorted(map(tuple, licenses.license_report(table).select("doc_id", "n_paragraphs", "license").collect()))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "8k")
        got = sorted(map(tuple, licenses.license_report(table.repartition("doc_id")).select("doc_id", "n_paragraphs", "license").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and any(x[2] not in ("none", "unknown") for x in got)


def brute_tree_scores(train, texts):
    """log10 probabilities by the published rule over plain dictionaries: every context is counted, tested and smoothed on its own."""
    depth, smooth = suffix_tree.DEPTH, suffix_tree.SMOOTHING
    stream = lambda t: b"\n" * depth + b" ".join((t or "").encode().lower().split()) + b"\n"
    counts = defaultdict(Counter)
    for t in train:
        s = stream(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                counts[s[i - d : i]][s[i]] += 1
    memo = {}

    def p(ctx, sym):
        """Smoothed probability with every counted context as a parent."""
        if (ctx, sym) not in memo:
            up = p(ctx[1:], sym) if ctx else 1 / 256
            seen = counts.get(ctx, Counter())
            memo[ctx, sym] = (seen[sym] + smooth * up) / (sum(seen.values()) + smooth)
        return memo[ctx, sym]

    kept = {b""}
    for ctx, seen in counts.items():
        total = sum(seen.values())
        if ctx and total >= suffix_tree.MIN_COUNT and sum(n * math.log(n / total / p(ctx[1:], sym)) for sym, n in seen.items()) >= suffix_tree.MIN_GAIN:
            kept |= {ctx[k:] for k in range(len(ctx))}

    def score(t):
        s, out = stream(t), 0.0
        for i in range(depth, len(s)):
            ctx = next(s[i - d : i] for d in range(depth, -1, -1) if s[i - d : i] in kept)
            out += math.log10(p(ctx, s[i]))
        return out

    return [score(t) for t in texts]


def test_suffix_tree_scores_by_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [sentence(rng, 1)[: rng.randrange(2, 7)] for _ in range(40)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) for _ in range(60)] + [None, "", "Ünseen wörds", "a" * 3000]
    out = zlib.crc32
    train = [t for i, t in enumerate(texts) if out(str(i).encode()) % 10]
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score_documents(docs(spark, list(enumerate(texts)))).collect()}
    want = brute_tree_scores(train, texts)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, rel=1e-9)


def test_pipeline_edges(spark):
    import corpus_pipeline

    rng = random.Random(3)
    good = [" ".join(t.split()[:120]) for (t,) in spark.read.parquet(f"{DATA}/documents.parquet").where("lang = 'en' and n_chars between 400 and 3000").orderBy("doc_id").select("text").limit(6).collect()]
    rows = [*enumerate(good), (2, good[0]), (2, sentence(rng, 50)), (40, good[1]), (40, good[1]), (41, None), (42, ""), (None, sentence(rng, 60)), (43, "\n".join([good[3]] * 3)), (44, "wörd " * 5000)]
    df = docs(spark, rows)
    columns = df.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "quality_classifier":
            stage(spark, df, DATA).count()  # judges freely; the other stages go on with every row
            continue
        df = stage(spark, df, DATA)
        assert df.columns == columns, name
        df = spark.createDataFrame(df.collect(), df.schema)
    left = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert {41, 42}.issubset({i for i, _ in left}) and len(left) == len(set(left))
    packed = corpus_pipeline.STAGES[-1][1](spark, df, DATA).collect()
    assert len(packed) == len(left)


def test_vafile_large_components(spark):
    rng = random.Random(6)
    vectors = [[rng.uniform(-3e5, 3e5) for _ in range(8)] for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    whole = [[math.floor(1024 * x) for x in v] for v in vectors]
    want = {}
    for q in range(0, 300, 100):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=True)), i) for i, w in enumerate(whole) if i != q)[:10]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores)}
    assert max(abs(s) for _, s in want.values()) > 1 << 53
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in vafile.top_k(df).collect()} == want
