"""Registered queries over the shared tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import signal as S
from voxloom.functions import text as T
from voxloom.operators import cluster, dedup, intervals, labeling, quality, rollups, transcripts
from voxloom.plans import adapters
from voxloom.plans.adapters import ADAPTER_SQL, read
from voxloom.streaming import turns

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, uses: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its function's name with its SQL over the named adapters."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            head = ", ".join(ADAPTER_SQL[u] for u in uses)
            body = sql.strip()
            if body.startswith(","):
                body = f"WITH RECURSIVE {ADAPTER_SQL['vox']}{body}"
            elif head:
                body = f"WITH {head}, {body[1:]}" if body.startswith("+") else f"WITH {head} {body}"
            _SQL[f.__name__] = body
        return f

    return add


@query(
    """+ f AS (SELECT speaker, text, row_number() OVER (PARTITION BY speaker ORDER BY episode, ordinal) AS rn FROM seg),
    t AS (SELECT speaker, string_agg(text, '|' ORDER BY rn) AS sample_texts FROM f WHERE rn <= 5 GROUP BY speaker),
    a AS (SELECT speaker, count(*) AS total_segments, round(sum("end" - "start"), 6) AS total_duration, count(DISTINCT episode) AS episodes FROM seg GROUP BY speaker)
    SELECT a.*, t.sample_texts FROM a JOIN t USING (speaker)""",
    ("seg",),
)
def speaker_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.speaker_analysis(adapters.segments(spark, sf_dir)).withColumn("total_duration", F.round("total_duration", 6))



@query("""SELECT episode, speaker, ordinal, row_number() OVER (PARTITION BY episode, speaker ORDER BY ordinal)::INTEGER AS number FROM seg WHERE "end" - "start" >= 1.0 AND trim(text) <> '' AND speaker <> ''""", ("seg",))
def diarised_clips(spark, sf_dir):
    return intervals.number_clips(adapters.segments(spark, sf_dir)).select("episode", "speaker", "ordinal", "number")


@query(
    """+ t AS (SELECT * FROM seg WHERE text NOT IN ('view', 'click')), r AS (SELECT * FROM seg WHERE text IN ('view', 'click')),
    m AS (SELECT t.episode, t.ordinal, r.speaker, least(t."end", r."end") - greatest(t."start", r."start") AS ov, r.ordinal AS ro FROM t JOIN r ON t.episode = r.episode AND r."start" < t."end" AND r."end" > t."start"),
    b AS (SELECT *, row_number() OVER (PARTITION BY episode, ordinal ORDER BY ov DESC, ro) AS rn FROM m)
    SELECT t.episode, t.ordinal, b.speaker AS aligned_speaker, round(coalesce(b.ov, 0.0), 6) AS overlap FROM t LEFT JOIN b ON t.episode = b.episode AND t.ordinal = b.ordinal AND b.rn = 1""",
    ("seg",),
)
def align_transcript_speaker(spark, sf_dir):
    seg = adapters.segments(spark, sf_dir)
    turn = F.col("text").isin("view", "click")
    return intervals.align_speakers(seg.where(~turn), seg.where(turn)).select("episode", "ordinal", "aligned_speaker", F.round("overlap", 6).alias("overlap"))


@query(
    """SELECT a.episode, a.speaker, a.ordinal AS left_ordinal, b.ordinal AS right_ordinal, round(least(a."end", b."end") - greatest(a."start", b."start"), 6) AS overlap
    FROM seg a JOIN seg b ON a.episode = b.episode AND a.speaker = b.speaker AND a.ordinal < b.ordinal AND a."start" < b."end" AND a."end" > b."start"
    WHERE (least(a."end", b."end") - greatest(a."start", b."start")) / nullif(a."end" - a."start", 0) > 0.5 OR (least(a."end", b."end") - greatest(a."start", b."start")) / nullif(b."end" - b."start", 0) > 0.5""",
    ("seg",),
)
def self_overlap_pairs(spark, sf_dir):
    return intervals.self_overlaps(adapters.segments(spark, sf_dir)).withColumn("overlap", F.round("overlap", 6))


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang, lower(text) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def exact_text_dedup(spark, sf_dir):
    return dedup.first_texts(read(spark, sf_dir, "documents"), "lang", "text", "doc_id").select("doc_id", "lang")


@query()
def overlap_evict_dedup(spark, sf_dir):
    seg = adapters.segments(spark, sf_dir).withColumn("text", F.concat_ws(" ", "text", "ordinal"))
    return dedup.evict_overlaps(seg)


CHARACTERS = [("SPEAKER_00", "anna"), ("SPEAKER_01", "ben")]
ALIASES = [("speaker_02", "cara"), ("Speaker_03", "dan")]


@query(
    """SELECT episode, ordinal, CASE speaker WHEN 'SPEAKER_00' THEN 'anna' WHEN 'SPEAKER_01' THEN 'ben' WHEN 'SPEAKER_02' THEN 'cara' WHEN 'SPEAKER_03' THEN 'dan' ELSE speaker END AS character FROM seg""",
    ("seg",),
)
def character_mapping(spark, sf_dir):
    return _characters(spark, sf_dir).select("episode", "ordinal", "character")


def _characters(spark, sf_dir):
    return transcripts.map_characters(adapters.segments(spark, sf_dir), spark.createDataFrame(CHARACTERS, "speaker string, character string"), spark.createDataFrame(ALIASES, "alias string, character string"))


@query(
    """+ c AS (SELECT *, CASE speaker WHEN 'SPEAKER_00' THEN 'anna' WHEN 'SPEAKER_01' THEN 'ben' WHEN 'SPEAKER_02' THEN 'cara' WHEN 'SPEAKER_03' THEN 'dan' ELSE speaker END AS character FROM seg),
    e AS (SELECT episode, character, count(*) AS n, sum(duration) AS s FROM c GROUP BY 1, 2)
    SELECT character, sum(n)::BIGINT AS segments, count(*) AS episodes, round(sum(s) / 3600, 6) AS hours, round(CASE character WHEN 'anna' THEN sum(s) / 3600 / 2.0 * 100 ELSE 0.0 END, 4) AS completion FROM e GROUP BY character""",
    ("seg",),
)
def segmentation_summary(spark, sf_dir):
    out = transcripts.segmentation_summary(_characters(spark, sf_dir), spark.createDataFrame([("anna", 2.0), ("ben", 0.0)], "character string, target_hours double"))
    return out.withColumns({"hours": F.round("hours", 6), "completion": F.round("completion", 4)})


@query("""SELECT episode, ordinal FROM seg WHERE duration BETWEEN 2.0 AND 20.0 AND confidence >= -0.5""", ("seg",))
def segment_filter(spark, sf_dir):
    return adapters.segments(spark, sf_dir).where("duration between 2.0 and 20.0 and confidence >= -0.5").select("episode", "ordinal")


@query(
    r"""+ t AS (SELECT episode, ordinal, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS x FROM utt), w AS (SELECT *, len(list_filter(regexp_split_to_array(x, '\s+'), lambda s: s <> ''))::INTEGER AS word_count FROM t)
    SELECT episode, ordinal, word_count, NOT (x = '' OR x LIKE '%...' OR x LIKE '...%' OR word_count < 2 OR lower(x) IN ('uh','um','ah','oh','the','and','to','a') OR x LIKE '% the' OR x LIKE '% a' OR x LIKE '% and' OR (x LIKE 'the %' AND word_count < 4)) AS complete FROM w""",
    ("utt",),
)
def text_quality(spark, sf_dir):
    return adapters.utterances(spark, sf_dir).select("episode", "ordinal", T.word_count(F.col("text")).alias("word_count"), T.complete_words(F.col("text")).alias("complete"))


_METRICS = """m AS (SELECT clip_id, samples, list_transform(samples, lambda x: abs(x)) AS a, sqrt(list_sum(list_transform(samples, lambda x: x * x)) / len(samples)) AS rms FROM clip),
    u AS (SELECT clip_id, quantile_cont(x, 0.95) AS p95, quantile_cont(x, 0.05) AS p5, quantile_cont(x, 0.9) AS p90, quantile_cont(x, 0.1) AS p10 FROM (SELECT clip_id, unnest(a) AS x FROM m) GROUP BY clip_id),
    k AS (SELECT m.clip_id, greatest(0.0, 20 * log10(p95 / p5)) AS snr, least(60.0, greatest(0.0, 20 * log10(p90 / p10))) AS snr_clamped, 20 * log10(p95 / p5) AS dynamic_range,
      len(list_filter(a, lambda x: x >= CASE WHEN list_max(a) > 0.9 THEN 0.99 * list_max(a) ELSE 0.99 END))::DOUBLE / len(a) AS clipping, len(list_filter(a, lambda x: x < 0.01 * rms))::DOUBLE / len(a) AS silence, list_sum(samples) / len(samples) AS dc_offset, rms FROM m JOIN u USING (clip_id))"""


@query(f"+ {_METRICS} SELECT clip_id, round(snr, 6) AS snr, round(snr_clamped, 6) AS snr_clamped, round(dynamic_range, 6) AS dynamic_range, round(clipping, 6) AS clipping, round(silence, 6) AS silence, round(dc_offset, 6) AS dc_offset, round(rms, 6) AS rms FROM k", ("clip",))
def clip_metrics(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    return m.select("clip_id", *[F.round(c, 6).alias(c) for c in ("snr", "snr_clamped", "dynamic_range", "clipping", "silence", "dc_offset", "rms")])


def _metrics(spark, sf_dir):
    x = F.col("samples")
    return adapters.clips(spark, sf_dir).select("clip_id", "samples", "sample_rate", S.snr(x).alias("snr"), S.snr_clamped(x).alias("snr_clamped"), S.dynamic_range(x).alias("dynamic_range"), S.clipping(x).alias("clipping"), S.silence(x).alias("silence"), S.dc_offset(x).alias("dc_offset"), S.rms(x).alias("rms"))


@query(
    f"""+ {_METRICS}, s AS (SELECT *, greatest(0.0, least(10.0, 10.0 - 0.2 * greatest(0.0, 20 - snr) - 50 * clipping - 10 * greatest(0.0, silence - 0.3) - 0.1 * greatest(0.0, 20 - dynamic_range))) AS score,
      (snr < 15)::INT + (clipping > 0.01)::INT + (silence > 0.5)::INT + (dynamic_range < 10)::INT + (abs(dc_offset) > 0.01)::INT + 2 AS n_issues FROM k)
    SELECT clip_id, n_issues, round(score, 5) AS score FROM s""",
    ("clip",),
)
def audio_issues(spark, sf_dir):
    m = _metrics(spark, sf_dir).withColumn("duration", F.size("samples") / F.col("sample_rate"))
    return m.select("clip_id", F.size(quality.audio_issues()).alias("n_issues"), F.round(quality.file_score(), 5).alias("score"))


@query(
    """+ f AS (SELECT clip_id, list_transform(range(0, len(samples) - 3), lambda i: list_sum(list_transform(samples[i + 1 : i + 4], lambda x: x * x))) AS e,
      list_transform(range(0, len(samples) - 16, 8), lambda i: sqrt(list_sum(list_transform(samples[i + 1 : i + 16], lambda x: x * x)) / 16)) AS r FROM clip),
    q AS (SELECT clip_id, e, r, list_avg(r) AS mean, list_stddev_pop(r) AS sd, list_aggregate(e, 'quantile_cont', 0.3) AS p FROM f)
    SELECT clip_id, round(len(list_filter(e, lambda x: x > p))::DOUBLE / len(e), 6) AS speech_ratio, round(greatest(0.0, 1 - least(1.0, sd / mean)), 6) AS stability FROM q""",
    ("clip",),
)
def energy_measures(spark, sf_dir):
    x = F.col("samples")
    c = adapters.clips(spark, sf_dir).select("clip_id", S.energies(S.frames(x, 4, 1)).alias("e"), F.transform(S.frames(x, 16, 8, end_exclusive=True), S.rms).alias("r"))
    return c.select("clip_id", F.round(S.speech_ratio(F.col("e")), 6).alias("speech_ratio"), F.round(S.stability(F.col("r")), 6).alias("stability"))


_SCORED = """g AS (SELECT l_orderkey, l_linenumber, l_suppkey::VARCHAR AS speaker, l_quantity AS duration, l_tax * 300 AS snr, 0.4 + l_discount * 4 AS speech_ratio, (l_partkey % 7)::INTEGER AS word_count, l_returnflag <> 'R' AS complete FROM lineitem),
    h AS (SELECT *, 0.25 * CASE WHEN duration < 1 THEN 0.0 WHEN duration < 2 THEN 0.3 WHEN duration <= 8 THEN 1.0 WHEN duration <= 15 THEN 0.8 ELSE 0.4 END + 0.25 * greatest(0.0, least(1.0, (snr - 8) / 20)) + 0.2 * speech_ratio + 0.15 * least(1.0, word_count / 5.0) + 0.05 * 0.5 + 0.1 * CASE WHEN complete THEN 1.0 ELSE 0.4 END AS quality FROM g),
    j AS (SELECT *, CASE WHEN duration < 2 THEN 'too_short' WHEN duration > 15 THEN 'too_long' WHEN snr < 12 THEN 'low_snr' WHEN speech_ratio < 0.5 THEN 'low_speech_ratio' WHEN word_count < 3 THEN 'too_few_words' WHEN NOT complete THEN 'incomplete_words' WHEN quality < 0.5 THEN 'low_quality' END AS reason FROM h),
    r AS (SELECT speaker, count(*) AS n_input, count(*) FILTER (reason IS NULL) AS n_accepted, count(*) FILTER (reason IS NOT NULL) AS n_rejected, (count(*) FILTER (reason IS NULL))::DOUBLE / count(*) AS acceptance_rate, coalesce(sum(duration) FILTER (reason IS NULL), 0.0) AS accepted_seconds, coalesce(avg(quality) FILTER (reason IS NULL), 0.0) AS mean_quality FROM j GROUP BY speaker)"""


def _scored(spark, sf_dir):
    c = F.col
    g = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_suppkey").cast("string").alias("speaker"), c("l_quantity").alias("duration"), (c("l_tax") * 300).alias("snr"), (0.4 + c("l_discount") * 4).alias("speech_ratio"), (c("l_partkey") % 7).cast("int").alias("word_count"), (c("l_returnflag") != "R").alias("complete"))
    g = g.withColumn("quality", quality.quality_score(c("duration"), c("snr"), c("speech_ratio"), c("word_count"), F.lit(0.5), c("complete")))
    return g.withColumn("reason", quality.reason())


@query(f"WITH {_SCORED} SELECT l_orderkey, l_linenumber, round(quality, 6) AS quality, reason FROM j")
def accept_cascade(spark, sf_dir):
    return _scored(spark, sf_dir).select("l_orderkey", "l_linenumber", F.round("quality", 6).alias("quality"), "reason")


@query(f"WITH {_SCORED} SELECT speaker, n_input, n_accepted, n_rejected, round(acceptance_rate, 6) AS acceptance_rate, round(accepted_seconds, 6) AS accepted_seconds, round(mean_quality, 6) AS mean_quality FROM r")
def speaker_report(spark, sf_dir):
    return quality.speaker_report(_scored(spark, sf_dir)).withColumns({x: F.round(x, 6) for x in ("acceptance_rate", "accepted_seconds", "mean_quality")})


@query(f"WITH {_SCORED} SELECT count(*) AS speakers, sum(n_input)::BIGINT AS n_input, sum(n_accepted)::BIGINT AS n_accepted, round(sum(n_accepted)::DOUBLE / sum(n_input), 6) AS acceptance_rate, round(sum(accepted_seconds) / 3600, 6) AS hours, round(avg(mean_quality), 6) AS mean_quality FROM r")
def overall_report(spark, sf_dir):
    return quality.overall_report(quality.speaker_report(_scored(spark, sf_dir))).withColumns({x: F.round(x, 6) for x in ("acceptance_rate", "hours", "mean_quality")})


@query(f"WITH {_SCORED} SELECT reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY reason")
def rejection_reasons(spark, sf_dir):
    return quality.reasons(_scored(spark, sf_dir))


@query(
    """SELECT p_partkey, CASE WHEN p_retailprice < 10 THEN 'too_short' WHEN p_retailprice > 1500 THEN 'too_long' WHEN p_size % 9 = 0 THEN 'no_audio' WHEN p_partkey * 1000 < 1048576 THEN 'too_small' WHEN p_size * 1000 > 0 AND p_size * 1000 < 16000 THEN 'low_rate' END AS reason FROM part"""
)
def media_validity(spark, sf_dir):
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("duration"), (F.col("p_size") % 9 != 0).alias("has_audio"), (F.col("p_partkey") * 1000).alias("file_size"), (F.col("p_size") * 1000).alias("rate"))
    return p.select("p_partkey", quality.media_reason(quality.MediaRules(max_seconds=1500.0)).alias("reason"))


@query(
    r"""WITH c AS (SELECT page_id, coalesce(nullif(trim(trim(regexp_replace(translate(url, '<>:"/\|?*', '_________'), '_{2,}', '_', 'g'), '_')), ''), 'unnamed') AS clean FROM pages),
    n AS (SELECT *, row_number() OVER (PARTITION BY clean ORDER BY page_id) - 1 AS k FROM c) SELECT n.page_id, clean, CASE WHEN k > 0 THEN clean || '_' || k ELSE clean END AS unique_name, replace(rtrim(regexp_replace(url, '[^\p{L}\p{N} _-]', '', 'g')), ' ', '_') AS archive FROM n JOIN pages ON pages.page_id = n.page_id"""
)
def clean_names(spark, sf_dir):
    return transcripts.unique_names(read(spark, sf_dir, "pages"), "url", "page_id").select("page_id", "clean", "unique_name", T.archive_name(F.col("url")).alias("archive"))


@query("SELECT label::VARCHAR AS label, count(*) AS segments, round(sum(1.0 + vec_id % 7), 6)::DOUBLE AS total_duration, count(DISTINCT vec_id % 20) AS episodes, 1::BIGINT AS speakers, round(avg(vec_id * 37 % 100 / 100.0), 6) AS quality FROM embeddings GROUP BY label")
def cluster_stats(spark, sf_dir):
    return cluster.cluster_stats(adapters.voices(spark, sf_dir).withColumn("label", F.col("speaker")), "label").withColumns({"quality": F.round("quality", 6), "total_duration": F.round("total_duration", 6)})


@query("SELECT speaker, (pos - 1)::INTEGER AS pos, round(avg(x), 6) AS x FROM (SELECT speaker, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM vox) GROUP BY ALL", ("vox",))
def cluster_centroids(spark, sf_dir):
    return cluster.centroids(adapters.voices(spark, sf_dir), "speaker").withColumn("x", F.round("x", 6))


@query(
    """+ s AS (SELECT speaker, count(*) AS n, sum(duration) AS d, count(DISTINCT episode) AS e FROM vox GROUP BY speaker)
    SELECT count(*) AS clusters, round(sum(d) / 3600, 6) AS hours, round(avg(n), 6) AS mean_size, count(*) FILTER (d >= 30 AND e >= 3 AND n >= 10) AS good, round((count(*) FILTER (d >= 30 AND e >= 3 AND n >= 10))::DOUBLE / count(*), 6) AS good_rate FROM s""",
    ("vox",),
)
def cluster_quality(spark, sf_dir):
    v = adapters.voices(spark, sf_dir)
    return cluster.cluster_quality(cluster.cluster_stats(v.withColumn("label", F.col("speaker")), "label")).withColumns({x: F.round(x, 6) for x in ("hours", "mean_size", "good_rate")})


@query(
    """+ a AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY quality DESC, vec_id) AS rn, row_number() OVER (PARTITION BY speaker, episode ORDER BY quality DESC, vec_id) AS er FROM vox),
    b AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY rn)::INTEGER AS place FROM a WHERE rn <= 2 OR er = 1) SELECT speaker, place, vec_id, episode, quality FROM b WHERE place <= 5""",
    ("vox",),
)
def representative_samples(spark, sf_dir):
    return cluster.representatives(adapters.voices(spark, sf_dir), "speaker")


@query("SELECT episode, speaker, (arg_max(vec_id, vec_id) % 5)::INTEGER AS cluster_id FROM vox WHERE vec_id % 5 <> 4 GROUP BY 1, 2", ("vox",))
def speaker_mapping_last(spark, sf_dir):
    v = adapters.voices(spark, sf_dir).withColumn("cluster_id", F.when(F.col("vec_id") % 5 == 4, -1).otherwise(F.col("vec_id") % 5).cast("int"))
    return cluster.last_mapping(v)


@query("+ m AS (SELECT episode, speaker, (max(vec_id) % 5)::INTEGER AS cluster_id FROM vox WHERE vec_id % 5 <> 4 GROUP BY 1, 2) SELECT cluster_id, episode, speaker, CASE cluster_id WHEN 0 THEN 'anna' WHEN 1 THEN 'ben' ELSE 'cluster_' || cluster_id END AS label FROM m", ("vox",))
def apply_labels(spark, sf_dir):
    return cluster.apply_labels(speaker_mapping_last(spark, sf_dir), spark.createDataFrame([(0, "anna"), (1, "ben")], "cluster_id int, label string"))


EPS, MIN_SAMPLES = 0.66, 3


@query("SELECT a.vec_id AS a, b.vec_id AS b FROM vox a JOIN vox b ON 1 - list_inner_product(a.embedding, b.embedding) <= 0.66", ("vox",))
def pairwise_neighbours(spark, sf_dir):
    return cluster.neighbours(adapters.voices(spark, sf_dir), EPS)


@query(
    """, e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vox a JOIN vox b ON 1 - list_inner_product(a.embedding, b.embedding) <= 0.66),
    c AS (SELECT a FROM e GROUP BY a HAVING count(*) >= 3), r(id, root) AS (SELECT a, a FROM c UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id WHERE e.b IN (SELECT a FROM c)),
    l AS (SELECT id, min(root) AS root FROM r GROUP BY id), n AS (SELECT id, (dense_rank() OVER (ORDER BY root) - 1)::INTEGER AS k FROM l),
    o AS (SELECT e.a AS id, min(n.k) AS k FROM e JOIN n ON n.id = e.b WHERE e.a NOT IN (SELECT a FROM c) GROUP BY e.a), z AS (SELECT * FROM n UNION ALL SELECT * FROM o)
    SELECT vec_id, coalesce(k, -1)::INTEGER AS cluster_id FROM vox LEFT JOIN z ON z.id = vec_id"""
)
def dbscan(spark, sf_dir):
    return cluster.dbscan(adapters.voices(spark, sf_dir), EPS, MIN_SAMPLES)


PATTERNS = [("anna", 0, "the"), ("anna", 1, "and"), ("ben", 2, "is"), ("ben", 3, "of")]


def _scores(spark, sf_dir):
    u = adapters.utterances(spark, sf_dir)
    themes = labeling.theme_ratio(u, ["ing", "tion"])
    return labeling.pattern_scores(u, PATTERNS, themes), themes


@query("SELECT speaker, count(*) AS segments, count(*) FILTER (regexp_matches(text, '(?i)ing|tion')) AS theme, round((count(*) FILTER (regexp_matches(text, '(?i)ing|tion')))::DOUBLE / count(*), 6) AS theme_ratio FROM utt GROUP BY speaker", ("utt",))
def theme_ratio(spark, sf_dir):
    return _scores(spark, sf_dir)[1].withColumn("theme_ratio", F.round("theme_ratio", 6))


@query(
    """+ p(label, pattern) AS (VALUES ('anna', 'the'), ('anna', 'and'), ('ben', 'is'), ('ben', 'of')), h AS (SELECT speaker, label, sum(len(regexp_extract_all(lower(text), pattern)))::BIGINT AS hits FROM utt CROSS JOIN p GROUP BY 1, 2),
    g AS (SELECT speaker, count(*) AS n, (count(*) FILTER (regexp_matches(text, '(?i)ing|tion')))::DOUBLE / count(*) AS theme FROM utt GROUP BY speaker)
    SELECT speaker, label, hits, round(hits::DOUBLE / n * greatest(0.0, 1 - 2 * theme), 6) AS score FROM h JOIN g USING (speaker)""",
    ("utt",),
)
def pattern_scores(spark, sf_dir):
    return _scores(spark, sf_dir)[0].select("speaker", "label", "hits", F.round("score", 6).alias("score"))


@query()
def label_assignment(spark, sf_dir):
    scores, themes = _scores(spark, sf_dir)
    u = adapters.utterances(spark, sf_dir)
    stats = u.groupBy("speaker").agg((F.count("*") * 2.0).alias("total_duration"), F.count_distinct("episode").alias("episodes"), F.count_if(F.length("text") > 10).alias("dialogue")).join(themes, "speaker")
    return labeling.assign_labels(scores, stats, ["anna", "ben"])


@query(
    """SELECT episode, ordinal, CASE speaker WHEN 'user' THEN 0 ELSE 1 END::INTEGER AS cluster_id, '[' || lpad((ordinal // 60)::VARCHAR, 2, '0') || ':' || lpad((ordinal % 60)::VARCHAR, 2, '0') || '] ' || speaker || ': "' || trim(text, ' ' || chr(9) || chr(10) || chr(13)) || '"' AS line FROM utt WHERE speaker IN ('user', 'assistant') AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
    ("utt",),
)
def cluster_transcript(spark, sf_dir):
    u = adapters.utterances(spark, sf_dir)
    mapping = u.where(F.col("speaker").isin("user", "assistant")).select(F.concat("episode", F.lit("_SPEAKER")).alias("episode"), "speaker", F.when(F.col("speaker") == "user", 0).otherwise(1).alias("cluster_id")).distinct()
    return transcripts.cluster_lines(u, mapping)


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_refs(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


def _events(spark, sf_dir):
    return read(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 20).alias("speaker"), F.col("value").alias("duration"), F.col("event_type").alias("text"))


@query("SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start, user_id % 20 AS speaker, count(*) AS n, round(sum(value), 6) AS seconds FROM events GROUP BY 1, 2")
def stream_tumbling(spark, sf_dir):
    out = turns.window_counts(_events(spark, sf_dir))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "speaker", "n", F.round("seconds", 6).alias("seconds"))


@query(
    """WITH e AS (SELECT ts, user_id % 20 AS speaker, lag(ts) OVER (PARTITION BY user_id % 20 ORDER BY ts) AS p FROM events),
    s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY speaker ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT min(ts) AS turn_start, max(ts) + INTERVAL 30 MINUTE AS turn_end, speaker, count(*) AS n FROM s GROUP BY speaker, k"""
)
def stream_sessions(spark, sf_dir):
    return turns.turns(_events(spark, sf_dir)).withColumns({x: F.col(x).cast("timestamp_ntz") for x in ("turn_start", "turn_end")})


def queries() -> dict[str, Query]:
    from voxloom.plans import registry_clips, registry_runs  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from voxloom.plans import registry_clips, registry_runs  # noqa: F401

    return dict(_SQL)
